from pyspark.sql import functions as F

from folioforge.functions import text as tx


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("r")).first()["r"]


def test_title_case_restarts_after_other_signs(spark):
    assert [one(spark, v, tx.title_case("x")) for v in ("o'neil", "part-no", "3d view")] == ["O'Neil", "Part-No", "3D View"]


def test_clean(spark):
    assert one(spark, "  “A” –  b® ", tx.clean("x")) == '"A" - b'
    assert one(spark, None, tx.clean("x")) == ""
    assert one(spark, "é", tx.clean("x", compose=True)) == "é"


def test_value_unit(spark):
    got = {v: one(spark, v, tx.value_unit("x")) for v in ("3/8 in", "3,000 psi", "25.4mm", "120V", "MS12B", '12" x 12"', "4-40 (M3 x 0.5)", "1/0 in", "", None)}
    assert [got[k] and (got[k]["value"], got[k]["unit"]) for k in ("3/8 in", "3,000 psi", "25.4mm", "120V")] == [(0.375, "in"), (3000.0, "psi"), (25.4, "mm"), (120.0, "V")]
    assert all(got[k] is None for k in ("MS12B", '12" x 12"', "4-40 (M3 x 0.5)", "1/0 in", "", None))


def test_ids_are_stable(spark):
    import hashlib

    assert one(spark, "a", tx.stable_id("SI", F.col("x"), F.lit("b"))) == "SI-" + hashlib.sha256(b"a\x1fb").hexdigest()[:16]
    assert one(spark, 'a"b', tx.json_list_id("prod", "x", F.lit("c"))) == "prod_" + hashlib.sha1(b'["a\\"b", "c"]').hexdigest()[:12]


def test_headings_and_identifiers(spark):
    assert one(spark, "Valve", tx.within_heading("x", F.lit("Ball Valves")))
    assert not one(spark, "Valve seat", tx.within_heading("x", F.lit("Ball Valves")))
    assert one(spark, "see A.1/B now", tx.holds_identifier("x", F.lit("A.1/B")))
    assert not one(spark, "see XA.1/B", tx.holds_identifier("x", F.lit("A.1/B")))


def test_small_functions(spark):
    assert one(spark, "abcdef  ghi", tx.ellipsis("x", 7)) == "abcdef…"
    assert one(spark, "N/A", tx.null_word("x")) is None and one(spark, " a ", tx.null_word("x")) == "a"
    assert one(spark, "s__p12__c003", tx.chunk_page("x")) == 12 and one(spark, "s", tx.chunk_page("x")) == 1
    assert one(spark, "\u0001\u0002ab", tx.odd_share("x")) == 0.5
    assert one(spark, "A > B >  > C ", tx.split_breadcrumb("x")) == ["A", "B", "C"]
