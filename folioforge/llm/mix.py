"""Mixing sources to target weights.

Documents are weighted by iterative proportional fitting: the token weights of the cells (source, language, topic) are
raked until sources have their targets and languages and topics keep their shares of the corpus; no weight exceeds the
source's repeats. Documents are then drawn by their calibrated expected copies, systematically along their sizes, so the
tokens of a source miss their target by about one document. Only the cells, whose number is bounded, reach the driver.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.llm.encode import VOCABULARY, token_count_column
from folioforge.runtime import cut, table

#: Languages and topics told apart; rarer ones are raked together, none is left out.
LANGUAGES, TOPICS = 32, 64
#: Most sources mix_targets may name; it is a register.
MAX_TARGETS = 1_000
#: Raking ends when no margin that can be met is off by more than this share, or after so many rounds.
CLOSE, ROUNDS = 1e-6, 500
#: Documents of a source and size that one task orders for the draw.
SLOT_ROWS = 50_000
SEED = 17


def water_level(amount: float, parts: list[tuple[float, float]], limit: float) -> float:
    """Factor f with sum(min(limit, f * weight) * tokens) = amount over parts (weight, tokens); the largest useful one if the limit binds first."""
    live = sorted(((limit / w, w, c) for w, c in parts if w > 0 and c > 0), key=lambda p: p[0])
    full, rest = 0.0, sum(w * c for _, w, c in live)
    for at, w, c in live:
        if full + at * rest >= amount:
            return (amount - full) / rest if rest else at
        full += limit * c
        rest -= w * c
    return live[-1][0] if live else 0.0


def source_amounts(available: dict[str, float], targets: dict[str, tuple[float, int]], total: float) -> dict[str, float]:
    """Tokens per source: shares of total, none above its repeats; what capped sources leave open goes to the others in proportion."""
    amounts = {s: 0.0 for s in targets}
    open_ = {s for s in targets if available.get(s, 0) > 0 and targets[s][0] > 0 and targets[s][1] > 0}
    left = total
    while open_ and left > 0:
        share = sum(targets[s][0] for s in open_)
        capped = {s for s in open_ if left * targets[s][0] / share >= available[s] * targets[s][1]}
        if not capped:
            for s in open_:
                amounts[s] = left * targets[s][0] / share
            break
        for s in capped:
            amounts[s] = available[s] * targets[s][1]
            left -= amounts[s]
        open_ -= capped
    return amounts


def rake(cells: dict[tuple[str, str, str], float], targets: dict[str, tuple[float, int]], total: float | None = None, rounds: int = ROUNDS) -> dict[tuple[str, str, str], float]:
    """Expected copies per cell (source, language, topic). Sources are fitted last in every round, so theirs are exact."""
    cells = {k: c for k, c in cells.items() if k[0] in targets and c > 0}
    available: dict[str, float] = defaultdict(float)
    for (s, _, _), c in cells.items():
        available[s] += c
    everything = sum(available.values())
    amounts = source_amounts(available, targets, everything if total is None else total)
    reached = sum(amounts.values())
    margins = []
    for axis in (1, 2):
        margin: dict[str, float] = defaultdict(float)
        for k, c in cells.items():
            margin[k[axis]] += c * reached / everything
        margins.append((axis, margin))
    weights = {k: amounts[k[0]] / available[k[0]] for k in cells}
    by_source: dict[str, list] = defaultdict(list)
    for k in cells:
        by_source[k[0]].append(k)
    for _ in range(rounds):
        before = dict(weights)
        for axis, margin in margins:
            now: dict[str, float] = defaultdict(float)
            for k, c in cells.items():
                now[k[axis]] += weights[k] * c
            for k in cells:
                if now[k[axis]] > 0:
                    weights[k] *= margin[k[axis]] / now[k[axis]]
        for s, keys in by_source.items():
            limit = float(targets[s][1])
            level = water_level(amounts[s], [(weights[k], cells[k]) for k in keys], limit)
            for k in keys:
                weights[k] = min(limit, weights[k] * level)
        if all(abs(weights[k] - before[k]) <= CLOSE * max(weights[k], 1e-12) for k in cells):
            break
    return weights


def pooled(df: DataFrame, column: str, keep: int) -> DataFrame:
    """Keeps the values with most tokens apart and names the others '(other)'."""
    top = df.groupBy(column).agg(F.sum("tokens").alias("_t")).orderBy(F.desc("_t"), column).limit(keep).select(column, F.lit(True).alias("_kept"))
    return df.join(F.broadcast(top), column, "left").withColumn(column, F.when(F.col("_kept"), F.col(column)).otherwise(F.lit("(other)"))).drop("_kept")


def sized_documents(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, source, lang, topic and tokens of the documents that can be drawn."""
    named = targets.where("source is not null").select("source").distinct()
    # the number of targets is bounded by read_targets, so this side is small whatever the corpus
    docs = documents.where("text is not null").join(F.broadcast(named), "source", "left_semi")
    lang = F.lower(F.regexp_extract(F.coalesce("lang", F.lit("")), "^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    topic = F.regexp_extract(F.coalesce("doc_stem", F.lit("")), "([^_]+?)(?:_[0-9]+)?(?:_document)?$", 1)
    sized = docs.select("doc_id", "source", lang.alias("lang"), topic.alias("topic"), token_count_column(F.col("text"), vocabulary).alias("tokens")).where("tokens > 0")
    return pooled(pooled(cut(sized, "sized"), "lang", LANGUAGES), "topic", TOPICS)


def read_targets(targets: DataFrame) -> dict[str, tuple[float, int]]:
    rows = targets.where("source is not null and target_share > 0 and max_repeats > 0").groupBy("source").agg(F.max("target_share").alias("s"), F.max("max_repeats").alias("r")).limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"mix_targets names more than {MAX_TARGETS} sources")
    return {r["source"]: (float(r["s"]), int(r["r"])) for r in rows}


def drawn(documents: DataFrame, targets: DataFrame, total: float | None = None, seed: int = SEED, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(what draw gives, with lang, topic and weight; the cells with their tokens and weights)."""
    spark = documents.sparkSession
    wanted = read_targets(targets)
    docs = cut(sized_documents(documents, targets, vocabulary), "cells")
    cells = {(r["source"], r["lang"], r["topic"]): float(r["t"]) for r in docs.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("t")).collect()}
    weights = [(*k, cells[k], w) for k, w in rake(cells, wanted, total).items()]
    fitted = spark.createDataFrame(weights, "source string, lang string, topic string, available double, weight double")
    weighted = docs.join(F.broadcast(fitted.drop("available")), ["source", "lang", "topic"])
    # order of the systematic draw: source, size, hash; running sums in two steps, so a large source is spread over tasks:
    # each size class of a source has as many slots as its documents need
    spread = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30))
    placed = weighted.withColumn("_size", F.floor(F.log2("tokens") * 4).cast("int")).withColumn("_spread", spread)
    classes = placed.groupBy("source", "_size").agg(F.ceil(F.count(F.lit(1)) / SLOT_ROWS).alias("_slots"))
    # as many rows as sources and size classes (four a doubling of the size)
    placed = placed.join(F.broadcast(classes), ["source", "_size"]).withColumn("_slot", F.floor(F.col("_spread") * F.col("_slots") / (1 << 30)).cast("int"))
    slots = placed.groupBy("source", "_size", "_slot").agg(F.sum("weight").alias("_w"))
    over = Window.partitionBy("source").orderBy("_size", "_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("source", "_size", "_slot", F.coalesce(F.sum("_w").over(over), F.lit(0.0)).alias("_before"))
    inside = Window.partitionBy("source", "_size", "_slot").orderBy("_spread", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    run = F.col("_before") + F.sum("weight").over(inside)
    start = F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(1 << 20)) / (1 << 20)
    copies = F.floor(run + start + 1e-9) - F.floor(run - F.col("weight") + start + 1e-9)
    # sums round: no document may slip above its limit by that
    limits = spark.createDataFrame([(s, r) for s, (_, r) in wanted.items()], "source string, _limit int")
    taken = (
        placed.join(slots, ["source", "_size", "_slot"])
        .withColumn("copies", copies.cast("int"))
        .join(F.broadcast(limits), "source")
        .select("doc_id", "source", "lang", "topic", "tokens", F.least("copies", "_limit").alias("copies"))
        .where("copies > 0")
    )
    return taken, fitted


def draw(documents: DataFrame, targets: DataFrame, total: float | None = None, seed: int = SEED, vocabulary: str = VOCABULARY) -> DataFrame:
    """The mixed corpus: doc_id, source, tokens, copies (1 or more, at most the source's max_repeats).

    total is the size aimed at, in tokens; by default that of the texts of all sources with a target. Null and empty texts,
    null sources and sources without a target contribute nothing; a source whose texts, repeated as often as allowed, do
    not reach its share gives all of them, and the others share the rest in proportion to their targets. The draw depends
    on seed and doc_id only, not on partitioning. Repeated texts are documents of their own. Empty tables give no rows.
    """
    taken, _ = drawn(documents, targets, total, seed, vocabulary)
    return taken.select("doc_id", "source", "tokens", "copies")


def mixture_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(axis, value, goal, fitted, actual): for each source, language and topic the share of the mixture's tokens aimed at,
    that of the raked weights, and that of the drawn documents. Languages and topics aim at their shares of the texts of
    all sources with a target; where repeats bind, sources go before them."""
    documents, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")
    taken, fitted = drawn(documents, targets)
    named = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("goal"))
    # cells are as few as sources, languages and topics told apart
    fitted, taken = cut(fitted, "fitted"), cut(taken.groupBy("source", "lang", "topic").agg(F.sum(F.col("tokens") * F.col("copies")).alias("got")), "got")
    cells = fitted.join(taken, ["source", "lang", "topic"], "left").na.fill(0, ["got"])
    whole = cells.agg(F.sum("available").alias("a"), F.sum(F.col("available") * F.col("weight")).alias("f"), F.sum("got").alias("g")).first()
    share = lambda part: F.lit(0.0) if not whole[part] else F.col(part) / F.lit(float(whole[part]))
    out = None
    for axis in ("source", "lang", "topic"):
        sums = cells.groupBy(F.col(axis).alias("value")).agg(F.sum("available").alias("a"), F.sum(F.col("available") * F.col("weight")).alias("f"), F.sum("got").alias("g"))
        if axis == "source":
            sums = sums.join(named.withColumnRenamed("source", "value"), "value", "left")
        else:
            sums = sums.withColumn("goal", share("a"))
        rows = sums.select(F.lit(axis).alias("axis"), "value", "goal", share("f").alias("fitted"), share("g").alias("actual"))
        out = rows if out is None else out.unionByName(rows)
    return out


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def mixture_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, target_share, actual_share, tokens, documents, copies, max_repeats) of each source with a target."""
    drawn = mixture(spark, sf_dir).groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.sum("copies").alias("copies"))
    goal = table(spark, sf_dir, "mix_targets").where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    out = goal.join(drawn, "source", "left").na.fill(0, ["tokens", "documents", "copies"])
    total = F.sum("tokens").over(Window.partitionBy())
    return out.select("source", "target_share", F.when(total > 0, F.col("tokens") / total).otherwise(F.lit(0.0)).alias("actual_share"), "tokens", "documents", "copies", "max_repeats")
