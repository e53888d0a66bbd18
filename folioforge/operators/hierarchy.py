"""Parent-child links to full hierarchies, with cycles found.

Blocks are worked on in slices of a document (PAGES x ORDERS blocks at most), so a document of any size is spread over
tasks, and a task streams its slices and holds few of them at a time. Inside a slice the steps below run to their end at
once; only links between slices need rounds, whose number grows with the logarithm of the slices that a chain passes
through (with the slices themselves only in documents whose records contradict each other about a block's parent).

1. Peeling: nodes without a remaining child, or without a remaining parent, go until nothing changes. What stays lies on
   cycles, between them, or on chains that pass through several slices. Where blocks have one parent, chains are
   contracted inside their slices and followed by doubled steps; strongly connected components tell the rest.
2. Euler tours: each node is entered and left once; a successor list runs through each tree. Chains inside a slice are
   contracted, the rest is ranked by pointer jumping. Ranks counted from the end give entry and exit, depth and root.
3. Paths: inside a slice from the parents, beyond it by pointer doubling on the slice's outer parents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.runtime import cut, release, table

PAGES, ORDERS = 64, 4096
NODE = ["doc_stem", "id"]


def slice_of(page: str, order: str):
    return F.concat_ws(":", (F.coalesce(F.col(page), F.lit(0)) / PAGES).cast("int"), (F.coalesce(F.col(order), F.lit(0)) / ORDERS).cast("int"))


def block_nodes(blocks: DataFrame) -> DataFrame:
    """Each block once: doc_stem, id, page, ord, slice. Blocks without doc_stem or id are no nodes."""
    return (
        blocks.where("doc_stem is not null and id is not null")
        .groupBy(*NODE)
        .agg(F.min("page").alias("page"), F.min("block_order").alias("ord"))
        .withColumn("slice", slice_of("page", "ord"))
    )


def block_links(blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each link between existing blocks once: doc_stem, child, parent, own (recorded in parent_id), both slices."""
    known = blocks.where("doc_stem is not null and id is not null")
    up = known.where("parent_id is not null").select("doc_stem", F.col("id").alias("child"), F.col("parent_id").alias("parent"), F.lit(True).alias("own"))
    down = known.select("doc_stem", F.explode(F.array_distinct("children_ids")).alias("child"), F.col("id").alias("parent"), F.lit(False).alias("own")).where("child is not null")
    links = up.unionByName(down).groupBy("doc_stem", "child", "parent").agg(F.max("own").alias("own"))
    child = nodes.select("doc_stem", F.col("id").alias("child"), F.col("slice").alias("child_slice"))
    parent = nodes.select("doc_stem", F.col("id").alias("parent"), F.col("slice").alias("parent_slice"))
    # merged: a stored table is many times smaller than its rows, and by its size the driver would get all nodes
    return links.join(child.hint("merge"), ["doc_stem", "child"]).join(parent.hint("merge"), ["doc_stem", "parent"])


# ---------------------------------------------------------------- cycles


def _csr(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    return np.concatenate(([0], np.cumsum(np.bincount(keys, minlength=n)))), order


def _edges_at(starts: np.ndarray, order: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    lengths = starts[nodes + 1] - starts[nodes]
    total = int(lengths.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    shift = np.repeat(starts[nodes] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return order[np.arange(total) + shift]


def peel(child: np.ndarray, parent: np.ndarray, n: int, mine: np.ndarray) -> np.ndarray:
    """Edges left (as a mask) once nodes of this slice without a child, or without a parent, are gone for good."""
    left = np.ones(len(child), dtype=bool)
    kids, parents = np.bincount(parent, minlength=n), np.bincount(child, minlength=n)
    as_child, as_parent = _csr(child, n), _csr(parent, n)
    front = np.flatnonzero(mine & ((kids == 0) | (parents == 0)))
    gone = np.zeros(n, dtype=bool)
    while len(front):
        gone[front] = True
        edges = np.unique(np.concatenate((_edges_at(*as_child, front), _edges_at(*as_parent, front))))
        edges = edges[left[edges]]
        left[edges] = False
        np.subtract.at(kids, parent[edges], 1)
        np.subtract.at(parents, child[edges], 1)
        near = np.unique(np.concatenate((parent[edges], child[edges])))
        front = near[mine[near] & ~gone[near] & ((kids[near] == 0) | (parents[near] == 0))]
    return left


def components(child: np.ndarray, parent: np.ndarray, n: int) -> list[list[int]]:
    """Strongly connected components that hold a cycle (Tarjan, without recursion)."""
    starts, order = _csr(parent, n)
    index, low, on, stack, found, count = [-1] * n, [0] * n, [False] * n, [], [], 0
    for root in range(n):
        if index[root] >= 0 or starts[root] == starts[root + 1]:
            continue
        work = [(root, int(starts[root]))]
        index[root] = low[root] = count
        count += 1
        stack.append(root)
        on[root] = True
        while work:
            v, at = work.pop()
            if at < starts[v + 1]:
                work.append((v, at + 1))
                w = int(child[order[at]])
                if index[w] < 0:
                    index[w] = low[w] = count
                    count += 1
                    stack.append(w)
                    on[w] = True
                    work.append((w, int(starts[w])))
                elif on[w]:
                    low[v] = min(low[v], index[w])
                continue
            if low[v] == index[v]:
                group = []
                while True:
                    w = stack.pop()
                    on[w] = False
                    group.append(w)
                    if w == v:
                        break
                if len(group) > 1 or v in child[order[starts[v] : starts[v + 1]]]:
                    found.append(group)
            if work:
                low[work[-1][0]] = min(low[work[-1][0]], low[v])
    return found


#: Rows of whole slices that are worked on at a time.
AT_ONCE = 100_000


def in_slices(batches: Iterator[pd.DataFrame], *key: str) -> Iterator[pd.DataFrame]:
    """Rows sorted by key as frames of whole groups, of AT_ONCE rows or the size of one group if that is larger."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        if sum(map(len, held)) >= AT_ONCE:
            same = (batch[list(key)] == batch[list(key)].iloc[0]).all(axis=1)
            if not (held[-1][list(key)].iloc[-1] == batch[list(key)].iloc[0]).all():
                yield pd.concat(held, ignore_index=True)
                held = []
            elif not same.all():
                yield pd.concat([*held, batch[same]], ignore_index=True)
                held, batch = [], batch[~same]
        held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def by_slice(df: DataFrame, slice_: str) -> DataFrame:
    return df.repartition("doc_stem", slice_).sortWithinPartitions("doc_stem", slice_)


def weak_components(child: np.ndarray, parent: np.ndarray, n: int) -> np.ndarray:
    """A label for each node, the same for linked ones: least labels spread along links and jump to their own label, so
    long chains take a logarithmic number of passes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[child], label[parent])
        new = label.copy()
        for side in (child, parent):
            np.minimum.at(new, label[side], low)
            np.minimum.at(new, side, low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == label).all():
            return label
        label = new


def coded(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Links of slices as numbers: child, parent, the names behind them, and which nodes lie in the slice they are seen from."""
    here = frame["at"]
    names = pd.concat((frame["doc_stem"] + "\x1f" + frame["child"] + "\x1f" + here, frame["doc_stem"] + "\x1f" + frame["parent"] + "\x1f" + here), ignore_index=True)
    codes, labels = pd.factorize(names)
    child, parent = codes[: len(frame)], codes[len(frame) :]
    mine = np.zeros(len(labels), dtype=bool)
    mine[child[(frame["child_slice"] == here).to_numpy()]] = True
    mine[parent[(frame["parent_slice"] == here).to_numpy()]] = True
    return child, parent, labels, mine


CYCLE_STEP = "doc_stem string, child string, parent string, child_slice string, parent_slice string, cycle_id string"


def cycles_in_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Peels slices; gives members of closed cycles (with cycle_id) and the links still open."""
    for frame in in_slices(batches, "doc_stem", "at"):
        child, parent, labels, mine = coded(frame)
        n = len(labels)
        left = peel(child, parent, n, mine)
        frame, child, parent = frame[left], child[left], parent[left]
        if frame.empty:
            continue
        # weak components that touch another slice stay open; the others are closed here
        label = weak_components(child, parent, n)
        touched = np.zeros(n, dtype=bool)
        touched[label[~mine]] = True
        closed = ~touched[label[child]]
        out = []
        if closed.any():
            for group in components(child[closed], parent[closed], n):
                members = [labels[v].split("\x1f") for v in group]
                first = min(m[1] for m in members)
                out += [(m[0], m[1], first) for m in members]
        if out:
            cycles = pd.DataFrame(out, columns=["doc_stem", "child", "cycle_id"])
            yield cycles.assign(parent=None, child_slice=None, parent_slice=None)[["doc_stem", "child", "parent", "child_slice", "parent_slice", "cycle_id"]]
        rest = frame[~closed]
        if len(rest):
            yield rest[["doc_stem", "child", "parent", "child_slice", "parent_slice"]].assign(cycle_id=None)


PIECE = "doc_stem string, id string, ptr string, least string, members array<string>"


def _followed(frame: pd.DataFrame) -> tuple[list[str], dict[int, int], list[int], list[str | None]]:
    """Names, parent by child, entries (blocks with a child in another slice) and the slice of each child's parent if it is
    another one; every block has one parent here."""
    child, parent, labels, mine = coded(frame)
    other = (frame["parent_slice"] != frame["at"]).to_numpy()
    outside = (frame["child_slice"] != frame["at"]).to_numpy()
    up = dict(zip(child[~outside].tolist(), parent[~outside].tolist()))
    leaves = set(child[~outside & other].tolist())
    return labels, up, sorted(set(parent[outside].tolist())), leaves


def contracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each block a chain enters a slice by: the block of another slice it goes on to, or null if it ends or goes round
    in here, and the least id on the way. Cycles inside the slice come out as members."""
    for frame in in_slices(batches, "doc_stem", "at"):
        labels, up, entries, leaves = _followed(frame)
        name = lambda v: labels[v].split("\x1f")
        ends: dict[int, tuple[int | None, str | None]] = {}  # block -> (where its chain leaves the slice, least id on the way)
        rows = []
        for start in [*entries, *up]:
            trail, seen, v = [], {}, start
            while v in up and v not in ends and v not in seen:
                seen[v] = len(trail)
                trail.append(v)
                if v in leaves:
                    break
                v = up[v]
            if trail and trail[-1] in leaves and trail[-1] not in ends:
                last = trail.pop()
                ends[last] = (up[last], name(last)[1])
                v = last
            elif v in seen and v not in ends:  # a cycle of this slice
                ring = trail[seen[v] :]
                doc, first = name(v)[0], min(name(w)[1] for w in ring)
                rows.append((doc, None, None, first, [name(w)[1] for w in ring]))
                ends.update((w, (None, None)) for w in ring)
                trail = trail[: seen[v]]
            elif v not in ends:
                ends[v] = (None, None)
            target, least = ends[v]
            for w in reversed(trail):
                least = None if target is None else min(least, name(w)[1])
                ends[w] = (target, least)
        for e in entries:
            target, least = ends.get(e, (None, None))
            doc, id_, _ = name(e)
            rows.append((doc, id_, name(target)[1] if target is not None else None, least, None))
        if rows:
            yield pd.DataFrame(rows, columns=["doc_stem", "id", "ptr", "least", "members"])


MEMBER = "doc_stem string, id string, cycle_id string"


def ways_through(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members of cycles through several slices: the way from each entry on a cycle (rows with colour) out of the slice."""
    for frame in in_slices(batches, "doc_stem", "at"):
        links, marks = frame[frame["colour"].isna()], frame[frame["colour"].notna()]
        if marks.empty:
            continue
        up = dict(zip(zip(links["doc_stem"], links["child"], links["at"]), links["parent"]))
        own = set(zip(links["doc_stem"], links["child"], links["at"], links["child_slice"]))
        rows = set()
        for doc, id_, at, colour in zip(marks["doc_stem"], marks["child"], marks["at"], marks["colour"]):
            while (doc, id_, at, at) in own and (doc, id_, colour) not in rows:
                rows.add((doc, id_, colour))
                id_ = up[doc, id_, at]
        if rows:
            yield pd.DataFrame(sorted(rows), columns=["doc_stem", "id", "cycle_id"])


def seen_from(edges: DataFrame) -> DataFrame:
    """Each link once for the slice of each of its ends."""
    return edges.withColumn("at", F.explode(F.array_distinct(F.array("child_slice", "parent_slice"))))


def chained_cycles(edges: DataFrame) -> DataFrame:
    """Cycles among open links of documents in which every block has one parent: (doc_stem, id, cycle_id).

    Chains are contracted to the blocks by which they enter slices. Steps over these are doubled until the blocks they end
    on, which are those on cycles, become no fewer and the least ids on the way no less."""
    both = cut(seen_from(edges), "both")
    step = cut(by_slice(both, "at").mapInPandas(contracted, PIECE), "entries")
    inner = step.where("members is not null").select("doc_stem", F.explode("members").alias("id"), F.col("least").alias("cycle_id"))
    state = step.where("id is not null and ptr is not null").select("doc_stem", "id", "ptr", F.col("least").alias("colour"))
    state, before = cut(state.withColumn("moved", F.lit(True)), "doubled"), None
    while True:
        on = state.select("doc_stem", F.col("ptr").alias("id")).distinct().count()
        if on == 0 or (on == before and state.where("moved").isEmpty()):
            break
        before = on
        far = state.select("doc_stem", F.col("id").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("colour").alias("colour2"))
        # a chain that ends is on no cycle
        new = state.drop("moved").join(far, ["doc_stem", "ptr"]).select("doc_stem", "id", F.col("ptr2").alias("ptr"), F.least("colour", "colour2").alias("colour"), (F.col("colour2") < F.col("colour")).alias("moved"))
        new = cut(new, "doubled")
        release(state)
        state = new
    ring = state.join(state.select("doc_stem", F.col("ptr").alias("id")).distinct(), NODE, "left_semi").select("doc_stem", F.col("id").alias("child"), "colour")
    at = edges.where("child_slice <> parent_slice").select("doc_stem", F.col("parent").alias("child"), F.col("parent_slice").alias("at")).distinct()
    marks = ring.join(at, ["doc_stem", "child"]).select("doc_stem", "child", F.lit(None).cast("string").alias("parent"), F.col("at").alias("child_slice"), "at", "colour")
    links = both.select("doc_stem", "child", "parent", "child_slice", "at", F.lit(None).cast("string").alias("colour"))
    return inner.unionByName(by_slice(links.unionByName(marks), "at").mapInPandas(ways_through, MEMBER))


def spanning_cycles(edges: DataFrame) -> DataFrame:
    """Cycles among links that pass through several slices and that peeling no longer shrinks: (doc_stem, id, cycle_id).

    Components by colouring: the smallest id that reaches a node is its colour, and the nodes of a colour that reach its
    origin are a component; they go, and the rest is coloured again. Colours spread with doubled steps where every node
    has one parent (disjoint cycles), link by link otherwise (contradicting records only).
    """
    edges, found = cut(edges.select("doc_stem", "child", "parent"), "core"), None
    while True:
        simple = edges.groupBy("doc_stem", "child").count().where("count > 1").isEmpty()
        state = edges.groupBy("doc_stem", F.col("child").alias("id")).agg(F.min("parent").alias("ptr"))
        state = cut(state.withColumn("colour", F.least("id", "ptr")), "colour")
        while True:
            if simple:
                far = state.select("doc_stem", F.col("id").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("colour").alias("colour2"))
                new = state.join(far, ["doc_stem", "ptr"], "left").select("doc_stem", "id", F.coalesce("ptr2", "ptr").alias("ptr"), F.least("colour", "colour2").alias("colour"), (F.col("colour2") < F.col("colour")).alias("moved"))
            else:
                above = edges.join(state.select("doc_stem", F.col("id").alias("parent"), F.col("colour").alias("c")), ["doc_stem", "parent"]).groupBy("doc_stem", F.col("child").alias("id")).agg(F.min("c").alias("c"))
                new = state.join(above, NODE, "left").select("doc_stem", "id", "ptr", F.least("colour", "c").alias("colour"), (F.col("c") < F.col("colour")).alias("moved"))
            new = cut(new, "colour")
            release(state)
            state = new.drop("moved")
            state._folioforge_path = new._folioforge_path
            if new.where("moved").isEmpty():
                break
        colours = state.select("doc_stem", "id", "colour")
        if simple:
            members = colours.withColumnRenamed("colour", "cycle_id")
            return members if found is None else found.unionByName(members)
        same = (
            edges.join(colours.select("doc_stem", F.col("id").alias("child"), "colour"), ["doc_stem", "child"])
            .join(colours.select("doc_stem", F.col("id").alias("parent"), F.col("colour").alias("colour_p")), ["doc_stem", "parent"])
            .where("colour = colour_p")
            .select("doc_stem", "child", "parent", "colour")
        )
        same = cut(same, "same")
        back = cut(colours.where("id = colour"), "back")
        while True:
            more = same.join(back.select("doc_stem", F.col("id").alias("child")), ["doc_stem", "child"], "left_semi").select("doc_stem", F.col("parent").alias("id"), "colour").distinct().join(back, NODE, "left_anti")
            grown = cut(back.unionByName(more), "back")
            done = grown.count() == back.count()
            release(back)
            back = grown
            if done:
                break
        on_cycle = same.join(back.select("doc_stem", F.col("id").alias("child")), ["doc_stem", "child"], "left_semi").join(back.select("doc_stem", F.col("id").alias("parent")), ["doc_stem", "parent"], "left_semi")
        members = on_cycle.select("doc_stem", F.col("child").alias("id"), F.col("colour").alias("cycle_id")).distinct()
        found = members if found is None else found.unionByName(members)
        inside = back.select("doc_stem", "id")
        rest = edges.join(inside.withColumnRenamed("id", "child"), ["doc_stem", "child"], "left_anti").join(inside.withColumnRenamed("id", "parent"), ["doc_stem", "parent"], "left_anti")
        # what is left may hang on what went: only nodes with both a parent and a child can still be on cycles
        while True:
            both = rest.select("doc_stem", F.col("child").alias("id")).intersect(rest.select("doc_stem", F.col("parent").alias("id")))
            slim = cut(rest.join(both.withColumnRenamed("id", "child"), ["doc_stem", "child"], "left_semi").join(both.withColumnRenamed("id", "parent"), ["doc_stem", "parent"], "left_semi"), "core")
            if slim.isEmpty():
                return found
            if slim.count() == rest.count():
                break
            rest = slim
        edges = slim


def find_cycles(links: DataFrame) -> DataFrame:
    """(doc_stem, id, cycle_id): blocks on a cycle of links; cycle_id is the smallest id of the cycle, or, where cycles
    share blocks, of all cycles linked that way. Blocks that hang below a cycle are not on it. No links give no rows."""
    edges, done, before = links.select("doc_stem", "child", "parent", "child_slice", "parent_slice"), [], None
    while True:
        step = cut(by_slice(seen_from(edges), "at").mapInPandas(cycles_in_slices, CYCLE_STEP), "peel")
        done.append(step.where("cycle_id is not null").select("doc_stem", F.col("child").alias("id"), "cycle_id"))
        open_ = step.where("cycle_id is null").drop("cycle_id")
        inner = open_.where("child_slice = parent_slice")
        # a link between slices is left only if both of them left it
        outer = open_.where("child_slice <> parent_slice").groupBy(*open_.columns).count().where("count = 2").drop("count")
        edges = inner.unionByName(outer)
        if before is None and not edges.isEmpty():
            edges = cut(edges, "open")
            several = cut(edges.groupBy("doc_stem", "child").count().where("count > 1").select("doc_stem").distinct(), "several")
            done.append(chained_cycles(edges.join(several, "doc_stem", "left_anti")))
            edges = edges.join(several, "doc_stem", "left_semi")
        left = edges.count()
        if left == 0:
            break
        if left == before:
            done.append(spanning_cycles(edges))
            break
        before = left
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


# ---------------------------------------------------------------- tours

SEGMENT = (
    "doc_stem string, id string, slice string, enter_head string, enter_off bigint, enter_dep bigint, exit_head string, exit_off bigint, "
    "chain string, next string, last_doc string, last_id string, len bigint, dsum bigint, top string, outer string, path array<string>, cycle_id string"
)


def tours_in_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Contracts the tour lists of the partition's slices and gives the local part of each path.

    Elements 2i and 2i+1 enter and leave node i. Rows with a node tell its place in two local chains; rows with a chain
    tell that chain's successor, length and sum of depth changes, needed only where lists pass through several slices.
    """
    for frame in in_slices(batches, "doc_stem", "slice"):
        yield from tours_of(frame)


def tours_of(f: pd.DataFrame) -> Iterator[pd.DataFrame]:
    n = len(f)
    names = (f["doc_stem"] + "\x1f" + f["id"]).to_numpy(dtype=object)
    place = {(name, s): i for i, (name, s) in enumerate(zip(names, f["slice"]))}
    docs, slices = f["doc_stem"].tolist(), f["slice"].tolist()
    succ = np.full(2 * n, -1, dtype=np.int64)
    foreign: dict[int, str] = {}
    local_parent = np.full(n, -1, dtype=np.int64)
    foreign_pred = np.zeros(2 * n, dtype=bool)

    def link(e: int, i: int, other, other_slice, side: int):
        key = docs[i] + "\x1f" + other
        j = place.get((key, other_slice)) if other_slice == slices[i] else None
        if j is None:
            foreign[e] = f"{key}\x1f{side}"
        else:
            succ[e] = 2 * j + side

    cols = zip(range(n), f["parent"], f["parent_slice"], f["first_child"], f["first_slice"], f["sibling"], f["sibling_slice"])
    for i, parent, p_slice, first, f_slice, sibling, s_slice in cols:
        if first is None:
            succ[2 * i] = 2 * i + 1
        else:
            link(2 * i, i, first, f_slice, 0)
        if parent is not None:
            if sibling is not None:
                link(2 * i + 1, i, sibling, s_slice, 0)
            else:
                link(2 * i + 1, i, parent, p_slice, 1)
            if p_slice == slices[i]:
                local_parent[i] = place.get((docs[i] + "\x1f" + parent, p_slice), -1)
    has_pred = np.zeros(2 * n, dtype=bool)
    has_pred[succ[succ >= 0]] = True
    heads = np.flatnonzero(~has_pred)
    head_of, off = np.empty(2 * n, dtype=np.int64), np.empty(2 * n, dtype=np.int64)
    dep = np.empty(2 * n, dtype=np.int64)
    roots = np.zeros(2 * n, dtype=bool)
    for i, parent in enumerate(f["parent"]):
        roots[2 * i] = parent is None
    key = lambda e: f"{names[e >> 1]}\x1f{e & 1}"
    chains = []
    nexts = succ.tolist()
    whole = {}
    for h in heads.tolist():
        e, k, d = h, 0, 0
        while True:
            head_of[e], off[e], dep[e] = h, k, d
            d += -1 if e & 1 else 1
            k += 1
            if nexts[e] < 0:
                break
            e = nexts[e]
        after = foreign.get(e)
        if after is None and roots[h]:
            whole[h] = (k, e >> 1)  # the whole list lies here
        else:
            chains.append((key(h), after, docs[e >> 1], f["id"].iat[e >> 1], k, d))
    # local paths: up to the first ancestor whose parent lies elsewhere
    paths: list = [None] * n
    tops = np.full(n, -1, dtype=np.int64)
    ids = f["id"].tolist()
    for i in range(n):
        trail, v = [], i
        while paths[v] is None and local_parent[v] >= 0:
            trail.append(v)
            v = int(local_parent[v])
        if paths[v] is None:
            paths[v], tops[v] = [ids[v]], v
        for w in reversed(trail):
            p = int(local_parent[w])
            paths[w], tops[w] = [*paths[p], ids[w]], tops[p]
    enter, leave = 2 * np.arange(n), 2 * np.arange(n) + 1
    parents = f["parent"].tolist()
    rows = pd.DataFrame(
        {
            "doc_stem": docs, "id": ids, "slice": slices,
            "enter_head": [None if h in whole else key(h) for h in head_of[enter].tolist()],
            "enter_off": [o - whole[h][0] if h in whole else o for h, o in zip(head_of[enter].tolist(), off[enter].tolist())],
            "enter_dep": dep[enter],
            "exit_head": [None if h in whole else key(h) for h in head_of[leave].tolist()],
            "exit_off": [o - whole[h][0] if h in whole else o for h, o in zip(head_of[leave].tolist(), off[leave].tolist())],
            "chain": None, "next": None, "last_doc": None,
            "last_id": [ids[whole[h][1]] if h in whole else None for h in head_of[enter].tolist()],
            "len": None, "dsum": None,
            "top": [ids[t] for t in tops.tolist()], "outer": [parents[t] for t in tops.tolist()], "path": paths,
            "cycle_id": f["cycle_id"],
        }
    )
    rows["len"] = rows["len"].astype("Int64")
    rows["dsum"] = rows["dsum"].astype("Int64")
    yield rows
    if chains:
        c = pd.DataFrame(chains, columns=["chain", "next", "last_doc", "last_id", "len", "dsum"])
        for name in ("doc_stem", "id", "slice", "enter_head", "exit_head", "top", "outer", "path", "cycle_id"):
            c[name] = None
        for name in ("enter_off", "enter_dep", "exit_off"):
            c[name] = pd.Series([pd.NA] * len(c), dtype="Int64")
        yield c[rows.columns.tolist()]


def tour_lists(nodes: DataFrame, links: DataFrame, cycles: DataFrame) -> DataFrame:
    """For each node its tree parent, first child and next sibling, with their slices.

    Of several parents the one recorded in parent_id counts, then the smallest id. Blocks on cycles are roots. Siblings
    are ordered by page, order and id: inside a page by one window, over pages by another, so a parent of very many
    blocks is split by page. Frames that grow with the nodes are merged, whatever size their stored tables suggest.
    """
    on_cycle = cycles.select("doc_stem", F.col("id").alias("child"))
    tree = links.groupBy("doc_stem", "child").agg(F.min(F.struct(~F.col("own"), "parent", "parent_slice")).alias("p")).join(on_cycle, ["doc_stem", "child"], "left_anti")
    tree = tree.select("doc_stem", F.col("child").alias("id"), F.col("p.parent").alias("parent"), F.col("p.parent_slice").alias("parent_slice"))
    full = nodes.join(tree.hint("merge"), NODE, "left").withColumn("_page", F.coalesce("page", F.lit(-1)))
    me = F.struct("id", "slice")
    in_page = Window.partitionBy("doc_stem", "parent", "_page").orderBy("ord", "id")
    kids = full.where("parent is not null").withColumn("_next", F.lead(me).over(in_page)).withColumn("_first", F.row_number().over(in_page) == 1)
    pages = kids.where("_first").select("doc_stem", "parent", "_page", me.alias("_head"))
    over_pages = Window.partitionBy("doc_stem", "parent").orderBy("_page")
    pages = pages.withColumn("_turn", F.lead("_head").over(over_pages)).withColumn("_eldest", F.row_number().over(over_pages) == 1)
    eldest = pages.where("_eldest").select("doc_stem", F.col("parent").alias("id"), F.col("_head").alias("_child"))
    kids = kids.join(pages.select("doc_stem", "parent", "_page", "_turn").hint("merge"), ["doc_stem", "parent", "_page"], "left").withColumn("_sibling", F.coalesce("_next", "_turn"))
    columns = ["doc_stem", "id", "slice", "parent", "parent_slice"]
    all_ = kids.select(*columns, "_sibling").unionByName(full.where("parent is null").select(*columns).withColumn("_sibling", F.lit(None).cast(kids.schema["_sibling"].dataType)))
    return (
        all_.join(eldest.hint("merge"), NODE, "left")
        .join(cycles, NODE, "left")
        .select(*columns, F.col("_child.id").alias("first_child"), F.col("_child.slice").alias("first_slice"), F.col("_sibling.id").alias("sibling"), F.col("_sibling.slice").alias("sibling_slice"), "cycle_id")
    )


def rank_chains(chains: DataFrame) -> DataFrame:
    """Pointer jumping over contracted chains: (chain, rest, dsum, root) counted to the end of each list."""
    state = cut(chains.select("chain", F.col("next").alias("ptr"), F.col("len").alias("rest"), "dsum", F.when(F.col("next").isNull(), F.col("last_id")).alias("root")), "rank")
    while not state.where("ptr is not null").isEmpty():
        far = state.select(F.col("chain").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("rest").alias("rest2"), F.col("dsum").alias("dsum2"), F.col("root").alias("root2"))
        new = state.join(far, "ptr", "left").select("chain", F.col("ptr2").alias("ptr"), (F.col("rest") + F.coalesce("rest2", F.lit(0))).alias("rest"), (F.col("dsum") + F.coalesce("dsum2", F.lit(0))).alias("dsum"), F.coalesce("root", "root2").alias("root"))
        new = cut(new, "rank")
        release(state)
        state = new
    return state.drop("ptr")


def outer_paths(segments: DataFrame) -> DataFrame:
    """Paths of the nodes whose parent lies in another slice, by doubling: (doc_stem, top, above), above without top itself."""
    tops = segments.where("top = id and outer is not null").select("doc_stem", F.col("id").alias("top"), "outer")
    over = segments.select("doc_stem", F.col("id").alias("outer"), F.col("top").alias("ptr"), F.col("path").alias("above"), F.col("outer").alias("_more"))
    state = tops.join(over, ["doc_stem", "outer"]).select("doc_stem", "top", F.when(F.col("_more").isNotNull(), F.col("ptr")).alias("ptr"), "above")
    state = cut(state, "paths")
    while not state.where("ptr is not null").isEmpty():
        far = state.select("doc_stem", F.col("top").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("above").alias("above2"))
        new = state.join(far, ["doc_stem", "ptr"], "left").select("doc_stem", "top", F.col("ptr2").alias("ptr"), F.when(F.col("above2").isNotNull(), F.concat("above2", "above")).otherwise(F.col("above")).alias("above"))
        new = cut(new, "paths")
        release(state)
        state = new
    return state.drop("ptr")


def hierarchy(blocks: DataFrame) -> DataFrame:
    """One row per block: doc_stem, id, parent, root, depth, path, tour_in, tour_out, descendants, cycle_id.

    path holds the ids from the root to the block; tour_in and tour_out are places in the Euler tour of the root's tree,
    counted back from its end (-1 is the root's exit), and block d lies below block b of the same root if and only if
    b.tour_in < d.tour_in and d.tour_out < b.tour_out; descendants is their number. Blocks on a cycle are roots with
    cycle_id set, and what hangs below a cycle hangs below its block. Links to blocks that are not there count as none;
    blocks without doc_stem or id have no row; repeated blocks count once. Extra columns are ignored.
    """
    nodes = cut(block_nodes(blocks), "nodes")
    links = cut(block_links(blocks, nodes), "links")
    cycles = cut(find_cycles(links), "cycles")
    lists = tour_lists(nodes, links, cycles)
    segments = cut(by_slice(lists, "slice").mapInPandas(tours_in_slices, SEGMENT), "segments")
    for step in (nodes, links, cycles):
        release(step)
    places, chains = segments.where("id is not null"), segments.where("chain is not null")
    ranks = rank_chains(chains)
    at_enter = ranks.select(F.col("chain").alias("enter_head"), F.col("rest").alias("r1"), F.col("dsum").alias("d1"), "root")
    at_exit = ranks.select(F.col("chain").alias("exit_head"), F.col("rest").alias("r2"))
    ranked = (
        places.join(at_enter, "enter_head", "left")
        .join(at_exit, "exit_head", "left")
        .select(
            "doc_stem", "id", "top", "path", "cycle_id",
            F.coalesce("root", "last_id").alias("root"),
            (F.col("enter_off") - F.coalesce("r1", F.lit(0))).alias("tour_in"),
            (F.col("exit_off") - F.coalesce("r2", F.lit(0))).alias("tour_out"),
            (F.col("enter_dep") - F.coalesce("d1", F.lit(0))).cast("int").alias("depth"),
        )
    )
    whole = F.when(F.col("above").isNotNull(), F.concat("above", "path")).otherwise(F.col("path"))
    return ranked.join(outer_paths(places), ["doc_stem", "top"], "left").select(
        "doc_stem", "id", F.try_element_at(whole, F.lit(-2)).alias("parent"), "root", "depth", whole.alias("path"), "tour_in", "tour_out",
        ((F.col("tour_out") - F.col("tour_in") - 1) / 2).cast("bigint").alias("descendants"), "cycle_id",
    )


def below(tree: DataFrame, wanted: DataFrame) -> DataFrame:
    """All descendants of the wanted blocks (doc_stem, id): doc_stem, id, descendant, distance.

    A range join of Euler intervals inside each tree; adaptive execution splits a tree of very many blocks. A block on a
    cycle is above what hangs below it, not above its cycle. Wanted blocks that are not there have no rows."""
    up = tree.join(wanted.select(*NODE).distinct(), NODE, "left_semi").select("doc_stem", "root", "id", F.col("tour_in").alias("_in"), F.col("tour_out").alias("_out"), F.col("depth").alias("_depth"))
    down = tree.select("doc_stem", "root", F.col("id").alias("descendant"), "tour_in", "tour_out", "depth")
    return up.join(down, ["doc_stem", "root"]).where("_in < tour_in and tour_out < _out").select("doc_stem", "id", "descendant", (F.col("depth") - F.col("_depth")).alias("distance"))


def descendants(tree: DataFrame) -> DataFrame:
    """All descendants of all blocks: doc_stem, id, descendant, distance. A block's ancestors are its path, so every link
    comes from one row and nothing is joined."""
    links = tree.select("doc_stem", F.col("id").alias("descendant"), "depth", F.posexplode(F.slice("path", F.lit(1), F.col("depth"))).alias("_at", "id"))
    return links.select("doc_stem", "id", "descendant", (F.col("depth") - F.col("_at")).alias("distance"))


def block_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descendants(block_hierarchy(spark, sf_dir))


def block_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """block_hierarchy without tours, paths as text."""
    tree = block_hierarchy(spark, sf_dir)
    return tree.select("doc_stem", "id", "parent", "root", F.col("depth").cast("bigint").alias("depth"), F.array_join("path", " > ").alias("path"), "descendants", "cycle_id")


def block_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy(table(spark, sf_dir, "semantic_blocks").select(*NODE, "page", "block_order", "parent_id", "children_ids"))


def block_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = table(spark, sf_dir, "semantic_blocks").select(*NODE, "page", "block_order", "parent_id", "children_ids")
    nodes = cut(block_nodes(blocks), "nodes")
    return find_cycles(block_links(blocks, nodes)).select("doc_stem", "id", "cycle_id")
