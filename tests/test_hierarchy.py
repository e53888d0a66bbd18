import random
from collections import defaultdict

import pytest

from folioforge.operators import hierarchy as H

SCHEMA = "doc_stem string, id string, page int, block_order int, parent_id string, children_ids array<string>, extra string"


def brute_cycles(rows):
    ids = {(d, i) for d, i, *_ in rows if d is not None and i is not None}
    kids = defaultdict(set)
    for d, i, _, _, p, ch, _ in rows:
        if (d, i) not in ids:
            continue
        if (d, p) in ids:
            kids[d, p].add((d, i))
        for c in ch or []:
            if (d, c) in ids:
                kids[d, i].add((d, c))
    reach = {}
    for n in ids:
        seen, todo = set(), list(kids[n])
        while todo:
            v = todo.pop()
            if v not in seen:
                seen.add(v)
                todo += kids[v]
        reach[n] = seen
    return {(n[0], n[1], min(m[1] for m in reach[n] if n in reach[m])) for n in ids if n in reach[n]}


def cycles(spark, rows):
    blocks = spark.createDataFrame(rows, SCHEMA)
    return {tuple(r) for r in H.find_cycles(H.block_links(blocks, H.block_nodes(blocks))).select("doc_stem", "id", "cycle_id").collect()}


def tree(n, docs, rng, parent):
    rows = []
    for d in range(docs):
        for i in range(n):
            rows.append((f"d{d}", f"b{i:03d}", i // 5, i % 5, parent(i, rng), None, "x"))
    return rows


@pytest.mark.parametrize("slice_pages", [64, 1])
def test_cycles_against_brute_force(spark, monkeypatch, slice_pages):
    monkeypatch.setattr(H, "PAGES", slice_pages)
    rng = random.Random(slice_pages)
    rows = tree(30, 3, rng, lambda i, r: f"b{r.randrange(30):03d}" if r.random() < 0.8 else None)
    rows += [("d9", "a", 0, 0, "a", None, None), ("d9", "b", 0, 1, "a", ["c", "c", "zz", None], None), ("d9", "c", 0, 2, None, None, None), ("d9", None, 0, 3, "a", ["a"], None), (None, "q", 0, 0, "q", None, None)]
    assert cycles(spark, rows + rows[:10]) == brute_cycles(rows)


def test_contradicting_parents(spark, monkeypatch):
    monkeypatch.setattr(H, "PAGES", 1)
    rng = random.Random(3)
    rows = tree(16, 2, rng, lambda i, r: f"b{r.randrange(16):03d}" if r.random() < 0.5 else None)
    rows = [(*r[:5], [f"b{rng.randrange(16):03d}"] if rng.random() < 0.4 else None, None) for r in rows]
    assert cycles(spark, rows) == brute_cycles(rows)


@pytest.mark.parametrize("slice_pages", [64, 1])
def test_paths_and_tours(spark, monkeypatch, slice_pages):
    monkeypatch.setattr(H, "PAGES", slice_pages)
    rng = random.Random(8)
    rows = tree(40, 2, rng, lambda i, r: f"b{r.randrange(i):03d}" if i and r.random() < 0.9 else "gone" if r.random() < 0.5 else None)
    parent = {(d, i): (d, p) for d, i, _, _, p, _, _ in rows if p not in (None, "gone")}
    out = {(r["doc_stem"], r["id"]): r for r in H.hierarchy(spark.createDataFrame(rows + rows[:5], SCHEMA)).collect()}
    assert len(out) == len(rows)
    below = defaultdict(int)
    for n in out:
        path, v = [n[1]], n
        while v in parent:
            v = parent[v]
            path.append(v[1])
            below[v] += 1
        r = out[n]
        assert r["path"] == path[::-1] and r["depth"] == len(path) - 1 and r["root"] == path[-1] and r["cycle_id"] is None
    for n, r in out.items():
        assert r["descendants"] == below[n]
        inside = {m[1] for m, s in out.items() if m[0] == n[0] and s["root"] == r["root"] and r["tour_in"] < s["tour_in"] and s["tour_out"] < r["tour_out"]}
        assert len(inside) == below[n] and all(n[1] in out[n[0], m]["path"] for m in inside)


def test_empty_table(spark):
    assert H.hierarchy(spark.createDataFrame([], SCHEMA)).count() == 0


def counted(monkeypatch, label):
    made = []
    whole = H.cut
    monkeypatch.setattr(H, "cut", lambda df, name="step": (made.append(name), whole(df, name))[1])
    return lambda: made.count(label)


def test_chains_through_many_slices_take_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(H, "PAGES", 1)
    monkeypatch.setattr(H, "AT_ONCE", 50)
    n, rounds = 300, None
    chain = [("chain", f"b{i:04d}", i, 0, f"b{i - 1:04d}" if i else None, None, None) for i in range(n)]
    ring = [("ring", f"b{i:04d}", i, 0, f"b{(i - 1) % n:04d}", None, None) for i in range(n)] + [("ring", f"t{i:04d}", i, 1, f"t{i - 1:04d}" if i else "b0007", None, None) for i in range(n)]
    small = [("small", "x", 0, 0, "y", None, None), ("small", "y", 0, 1, "x", None, None), ("small", "z", 1, 0, "x", None, None), ("small", "w", 2, 0, "z", None, None)]
    rounds, peels = counted(monkeypatch, "doubled"), counted(monkeypatch, "peel")
    got = cycles(spark, chain + ring + small)
    assert got == {("ring", f"b{i:04d}", "b0000") for i in range(n)} | {("small", "x", "x"), ("small", "y", "x")}
    assert rounds() <= 12 and peels() == 1


def test_descendants_by_intervals_and_by_paths(spark, monkeypatch):
    monkeypatch.setattr(H, "PAGES", 2)
    rng = random.Random(4)
    rows = tree(30, 2, rng, lambda i, r: f"b{r.randrange(i):03d}" if i > 1 and r.random() < 0.9 else "b001" if i == 1 else None)
    rows = [(*r[:4], r[1] if r[1] == "b001" else r[4], None, None) for r in rows]  # b001 is a cycle of its own
    out = H.hierarchy(spark.createDataFrame(rows, SCHEMA)).cache()
    pairs = {tuple(r) for r in H.descendants(out).collect()}
    path = {(r["doc_stem"], r["id"]): r["path"] for r in out.collect()}
    assert pairs == {(d, a, i, len(p) - 1 - k) for (d, i), p in path.items() for k, a in enumerate(p[:-1])}
    wanted = spark.createDataFrame([("d0", "b000"), ("d0", "b001"), ("d1", "b002"), ("d1", "none"), ("d0", "b000")], "doc_stem string, id string")
    assert {tuple(r) for r in H.below(out, wanted).collect()} == {p for p in pairs if (p[0], p[1]) in {("d0", "b000"), ("d0", "b001"), ("d1", "b002")}}


def test_slices_come_whole_in_bounded_frames(monkeypatch):
    monkeypatch.setattr(H, "AT_ONCE", 4)
    rows = H.pd.DataFrame({"k": list("aaabbbbbbbccd"), "n": range(13)})
    out = list(H.in_slices(iter([rows[i : i + 3] for i in range(0, 13, 3)]), "k"))
    assert H.pd.concat(out)["n"].tolist() == list(range(13)) and max(map(len, out)) <= 10
    assert all(set(a["k"]).isdisjoint(b["k"]) for a, b in zip(out, out[1:]))
