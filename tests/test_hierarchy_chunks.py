import random
from collections import defaultdict

from folioforge.operators import hierarchy as H
from folioforge.operators import outline as O

SCHEMA = "doc_stem string, id string, page int, block_order int, parent_id string, children_ids array<string>, type string, text string"
KINDS = ("heading", "heading", "product_card", "specification", "table", "paragraph", None)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made(docs, n, rng):
    rows = []
    for d in range(docs):
        for i in range(n):
            kind = rng.choice(KINDS)
            parent = f"b{rng.randrange(i):03d}" if i and rng.random() < 0.8 else None
            rows.append((f"d{d}", f"b{i:03d}", i // 5, i % 5, parent, None, kind, rng.choice((" t%d " % i, None)) if kind == "heading" else None))
    return rows


def brute(rows):
    by, kids, out = {r[:2]: r for r in rows}, defaultdict(list), {}
    for r in rows:
        kids[r[0], r[4]].append(r[1])
    kind = lambda d, i: by[d, i][6] if i is not None else None
    for doc in {r[0] for r in rows}:
        chunks, owners, todo = {}, {}, [(i, ()) for i in reversed(kids[doc, None])]
        while todo:
            i, above = todo.pop()
            up = above[-1] if above else None
            top = above[-2] if len(above) > 1 else None
            k = kind(doc, i)
            if k == "heading" or up is None and k in ("table", "specification", "product_card"):
                titles = [by[doc, a][7] for a in (*above, i) if kind(doc, a) == "heading"]
                chunks[i] = (len(chunks) + 1, [t and t.strip() for t in titles] if k == "heading" else ["(unlabelled)"])
                owners[i] = i
            elif kind(doc, up) == "heading":
                owners[i] = up
            elif kind(doc, up) == "product_card" and kind(doc, top) == "heading" and k in ("specification", "table", "paragraph"):
                owners[i] = top
            todo += [(c, (*above, i)) for c in reversed(kids[doc, i])]
        out |= {(doc, i): chunks[o] for i, o in owners.items()}
    return out


def test_chunks_against_brute_force_and_without_broadcasts(spark):
    """Its plan reads each stored frame a few times only, and sends none of them through the driver."""
    rows = made(3, 60, random.Random(5))
    blocks = spark.createDataFrame(rows + rows[:7], SCHEMA)
    out = O.hierarchy_chunks(blocks, H.hierarchy(blocks))
    planned = plan(out)
    assert "BroadcastHashJoin" not in planned and planned.count("Scan parquet") <= 6
    got = out.collect()
    assert {(r["doc_stem"], r["id"]): (r["chunk_no"], r["section_path"]) for r in got} == brute(rows) and len(got) == len(brute(rows))


def test_frames_of_all_nodes_are_not_broadcast(spark):
    """Stored tables of a few bytes a row stay below the broadcast threshold with millions of rows."""
    blocks = H.cut(spark.createDataFrame(made(2, 40, random.Random(6)), SCHEMA), "blocks")
    nodes = H.cut(H.block_nodes(blocks), "nodes")
    links = H.block_links(blocks, nodes)
    assert "BroadcastHashJoin" not in plan(links)
    lists = H.tour_lists(nodes, H.cut(links, "links"), H.cut(H.find_cycles(links), "cycles"))
    # cycles are left out of the tree and named in one more join; only their size is left to the planner
    sent = [line for line in plan(lists).splitlines() if "BroadcastHashJoin" in line and "LeftAnti" not in line]
    assert len(sent) <= 1
