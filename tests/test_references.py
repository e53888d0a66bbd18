import datetime as dt
import random

import pytest

from folioforge.operators import references as R

REFS = "target string, scope string, ref_key string, t timestamp_ntz, record_id long, extra string"
PARENTS = "target string, scope string, ref_key string, begins timestamp_ntz, ends timestamp_ntz, extra int"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def brute(refs, parents):
    out = set()
    for target, scope, key, t, rid, _ in refs:
        if key is None or t is None:
            continue
        if not any(p[0] == target and p[1] == scope and scope is not None and p[2] == key and p[3] is not None and p[3] <= t and (p[4] is None or p[4] > t) for p in parents):
            out.add(rid)
    return out


def run(spark, refs, parents):
    return {r["record_id"] for r in R.find_orphans(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS)).collect()}


def test_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)
    keys = ["hot"] * 6 + [f"k{i}" for i in range(12)] + [None, ""]
    refs = [("p", rng.choice(["a", "b", None]), rng.choice(keys), rng.choice([day(rng.randrange(200)), None] if rng.random() < 0.1 else [day(rng.randrange(200))]), i, "x") for i in range(600)]
    parents = [("p", rng.choice(["a", "b", None]), rng.choice(keys), rng.choice([day(rng.randrange(200)), None]), rng.choice([None, day(rng.randrange(200))]), 1) for _ in range(120)]
    parents += parents[:20]
    assert run(spark, refs, parents) == brute(refs, parents)


def test_borders_and_empty_tables(spark):
    refs = [("p", "a", "k", day(5), 1, None), ("p", "a", "k", day(7), 2, None), ("p", "a", "k", day(4), 3, None)]
    assert run(spark, refs, [("p", "a", "k", day(5), day(7), 0)]) == {2, 3}
    assert run(spark, refs, [("p", "a", "k", day(7), day(5), 0)]) == {1, 2, 3}
    assert run(spark, refs, []) == {1, 2, 3}
    assert run(spark, [], [("p", "a", "k", day(5), None, 0)]) == set()


@pytest.mark.parametrize("bits", [1 << 10, 1 << 26])
def test_buckets_prove_as_much_as_one_filter(spark, monkeypatch, bits):
    monkeypatch.setattr(R, "MAX_FILTER_BITS", bits)
    monkeypatch.setattr(R, "BUCKET_BITS", 1 << 12)
    monkeypatch.setattr(R, "BUCKET_ROWS", 100)
    refs = [("p", "a", f"k{i}", day(1), i, None) for i in range(4000)] + [("p", "a", "gone", day(1), 10_000 + i, None) for i in range(2000)] + [("p", None, "k0", day(1), 20_000, None)]
    parents = [("p", "a", f"k{i}", day(0), None, 0) for i in range(0, 4000, 2)] * 2
    out = R.find_orphans(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS)).collect()
    assert sorted(r["record_id"] for r in out) == [*range(1, 4000, 2), *range(10_000, 12_000), 20_000]
    assert sum(r["proved"] for r in out) > 0.95 * len(out) and {r["extra"] for r in out} == {None}
