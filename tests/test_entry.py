import __spark_entry__ as entry


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) >= 50


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
