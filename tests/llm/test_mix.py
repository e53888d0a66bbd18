import random

import pytest

from folioforge.llm import mix as M

DOCS = "doc_id long, text string, lang string, source string, doc_stem string, tokens int"
TARGETS = "source string, target_share double, max_repeats int"


def test_water_level_respects_the_limit():
    parts = [(0.5, 10.0), (2.0, 10.0)]
    f = M.water_level(20.0, parts, 2.0)
    assert sum(min(2.0, f * w) * c for w, c in parts) == pytest.approx(20.0)
    assert M.water_level(100.0, parts, 2.0) * 0.5 >= 2.0 and M.water_level(1.0, [], 2.0) == 0.0


def test_amounts():
    got = M.source_amounts({"a": 100.0, "b": 10.0}, {"a": (0.5, 1), "b": (0.4, 2), "c": (0.1, 9)}, 100.0)
    assert got == {"a": pytest.approx(80.0), "b": pytest.approx(20.0), "c": 0.0}
    assert sum(M.source_amounts({}, {"a": (1.0, 1)}, 10.0).values()) == 0


def test_raking_meets_all_margins_where_they_can_be_met():
    rng = random.Random(1)
    cells = {(s, l, t): float(rng.randint(50, 100)) for s in "ab" for l in "xyz" for t in "uv"}
    w = M.rake(cells, {"a": (0.3, 5), "b": (0.7, 5)})
    total = sum(cells.values())
    for axis, share in ((0, {"a": 0.3, "b": 0.7}), (1, None), (2, None)):
        for v in {k[axis] for k in cells}:
            goal = share[v] if share else sum(c for k, c in cells.items() if k[axis] == v) / total
            assert sum(w[k] * c for k, c in cells.items() if k[axis] == v) / total == pytest.approx(goal, abs=1e-3)


def test_drawn_shares(spark):
    rng = random.Random(2)
    rows = [(i, "word " * rng.randint(1, 60), rng.choice(["en", "de", "EN-x", None]), "ab"[i % 3 == 0], rng.choice(["x_motion_01_document", None]), 0) for i in range(900)]
    rows += [(1000 + i, t, "en", s, "d", 0) for i, (t, s) in enumerate([(None, "a"), ("", "a"), (" ", "a"), ("left out", None), ("left out", "z"), ("tiny", "c")])]
    docs = spark.createDataFrame(rows, DOCS)
    goal = spark.createDataFrame([("a", 0.35, 3), ("b", 0.6, 3), ("c", 0.05, 2), ("none", 0.0, 1)], TARGETS)
    drawn = M.draw(docs, goal).collect()
    total = sum(r["tokens"] * r["copies"] for r in drawn)
    share = {s: sum(r["tokens"] * r["copies"] for r in drawn if r["source"] == s) / total for s in "abc"}
    assert abs(share["a"] / share["b"] - 0.35 / 0.6) < 0.02 and {r["source"] for r in drawn} == set("abc")
    assert max(r["copies"] for r in drawn) <= 3 and [r["copies"] for r in drawn if r["source"] == "c"] == [2]
    assert len({r["doc_id"] for r in drawn}) == len(drawn)
    again = M.draw(docs.repartition(7), goal).collect()
    assert {tuple(r) for r in drawn} == {tuple(r) for r in again}


def test_empty_tables(spark):
    docs, goal = spark.createDataFrame([], DOCS), spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    assert M.draw(docs, goal).count() == 0
    assert M.draw(spark.createDataFrame([(1, "x", "en", "a", None, 0)], DOCS), spark.createDataFrame([], TARGETS)).count() == 0


def test_margins_are_reported(spark, tmp_path):
    docs = [(n, "word " * (5 + n % 7), ["a", "b", "c", "none", None][n % 5], ["en", "de-DE", None][n % 3], f"x_{['pumps', 'valves'][n % 2]}_{n}") for n in range(400)] + [(900, None, "a", "en", None), (901, "", "a", "en", None)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, doc_stem string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("a", 0.6, 2), ("b", 0.2, 1), ("c", 0.2, 1), ("gone", 0.0, 1)], "source string, target_share double, max_repeats int").write.parquet(f"{tmp_path}/mix_targets.parquet")
    rows = {(r["axis"], r["value"]): r for r in M.mixture_margins(spark, str(tmp_path)).collect()}
    assert abs(rows["source", "a"]["actual"] - 0.6) < 0.02 and abs(rows["source", "a"]["fitted"] - 0.6) < 1e-6
    assert {k[0] for k in rows} == {"source", "lang", "topic"} and all(abs(r["fitted"] - r["goal"]) < 0.02 for r in rows.values())
    for axis in ("source", "lang", "topic"):
        assert abs(sum(r["actual"] for k, r in rows.items() if k[0] == axis) - 1) < 1e-9


def test_slots_follow_the_size_of_a_source(spark, monkeypatch):
    docs = spark.createDataFrame([(n, "word " * 8, "a", "en", "x_pumps_1") for n in range(500)], "doc_id long, text string, source string, lang string, doc_stem string")
    targets = spark.createDataFrame([("a", 1.0, 3)], "source string, target_share double, max_repeats int")
    for size in (7, 50_000):
        monkeypatch.setattr(M, "SLOT_ROWS", size)
        got = M.draw(docs, targets, total=500 * 8 * 1.5).collect()
        assert abs(sum(r["copies"] for r in got) - 750 * 8 / got[0]["tokens"]) <= 2
