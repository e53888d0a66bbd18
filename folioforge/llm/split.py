"""Oversized items cut into pieces at natural boundaries, with overlap.

Recursive bisection: a part above the limit is cut at the strongest boundary near its middle, both halves are cut on, and
at the end each piece but the first is led in by the last characters of its predecessor. The parts are cut to the limit
less the overlap, so no piece exceeds the limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.runtime import table

LIMIT, OVERLAP = 3000, 200

# Boundaries from strong to weak; a cut falls at the end of the match.
BOUNDARIES = tuple(
    re.compile(p)
    for p in (
        r"(?:\r?\n[ \t]*){2,}",  # paragraph
        r"\r?\n|\r|</tr>|</p>|</li>",  # line or row
        r"[.!?][\"'”’»)\]]*\s+|[。！？．][」』”’）)]*|[।؟۔][\"'”’»)\]]*\s*",  # sentence
        r"[;:,،、，；]\s*",  # clause
        r"\s+",  # word
    )
)
_MARK = re.compile(r"[̀-ͯัิ-ฺ็-๎ऺ-ॏً-ٟ‍️\U0001f3fb-\U0001f3ff]")


def cut_point(text: str, start: int, end: int, size: int) -> int:
    """The strongest boundary within size // 4 of the middle of text[start:end], or farther where no piece more comes of
    it; without any, a place near the middle that tears no character apart. A half left above the size is cut again."""
    length = end - start
    middle = start + length // 2
    # the smallest number of pieces leaves slack: a cut may move by it without making a piece more
    pieces, reach = -(-length // size), size // 4
    if pieces > 2:
        middle = start + (pieces // 2) * length // pieces
    else:
        reach = max(reach, min(size - length // 2, length // 2) - 1)
    low, high = max(start + 1, middle - reach), min(end - 1, middle + reach)
    for pattern in BOUNDARIES:
        best = None
        for m in pattern.finditer(text, max(start, low - 64), min(end, high + 64)):
            if low <= m.end() <= high and (best is None or abs(m.end() - middle) < abs(best - middle)):
                best = m.end()
        if best is not None:
            return best
    at = middle
    while at > low and (_MARK.match(text, at) or text[at - 1] == "‍"):
        at -= 1
    return at


def bisect(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Pieces as (start, end) offsets: in order, from 0 to the end, each of limit characters at most, each but the first
    beginning exactly overlap characters before its predecessor's end. A text within the limit is one piece; an empty
    text is one empty piece. A boundary moves no piece above the limit: where there is none near, the cut is plain."""
    if overlap < 0 or limit <= 2 * overlap:
        raise ValueError("the limit must exceed twice the overlap")
    if len(text) <= limit:
        return [(0, len(text))]
    size, cuts, todo = limit - overlap, [], [(0, len(text))]
    while todo:
        start, end = todo.pop()
        if end - start <= size:
            cuts.append((start, end))
            continue
        at = cut_point(text, start, end, size)
        todo += [(at, end), (start, at)]
    return [(max(0, s - overlap) if s else 0, e) for s, e in cuts]


SPANS = "doc_stem string, id string, spans array<struct<starts:int,ends:int>>"


def cut_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        spans = [[{"starts": s, "ends": e} for s, e in bisect(text)] for text in frame["text"]]
        yield pd.DataFrame({"doc_stem": frame["doc_stem"], "id": frame["id"], "spans": spans})


def oversized_pieces(blocks: DataFrame) -> DataFrame:
    """Pieces of every block of more than LIMIT code points: part_id, chunk_id, doc_stem, id, piece, pieces, starts, ends, text.

    Blocks within the limit, and null texts, are not cut and have no row. Repeated deliveries count once. Parts are
    numbered through a chunk in reading order, from 1, so part ids are unique; a block without chunk_id keeps a null
    part_id. Extra columns are ignored.
    """
    wanted = blocks.select("doc_stem", "id", "chunk_id", "page", "block_order", "text").where(F.length("text") > LIMIT)
    # texts are shuffled once, by the block's key; the pieces are cut from them where they lie
    once = wanted.dropDuplicates(["doc_stem", "id"])
    spans = once.select("doc_stem", "id", "text").mapInPandas(cut_blocks, SPANS)
    # numbering needs how many pieces earlier blocks of the chunk have, and no texts; blocks without chunk get no number
    sizes = spans.select("doc_stem", "id", F.size("spans").alias("_n"))
    places = wanted.where("chunk_id is not null").groupBy("doc_stem", "id").agg(F.first("chunk_id").alias("chunk_id"), F.first("page").alias("page"), F.first("block_order").alias("block_order"))
    chunk = Window.partitionBy("doc_stem", "chunk_id").orderBy("page", "block_order", "id").rowsBetween(Window.unboundedPreceding, -1)
    before = places.join(sizes, ["doc_stem", "id"]).select("doc_stem", "id", F.coalesce(F.sum("_n").over(chunk), F.lit(0)).alias("_before"))
    cut = once.alias("o").join(spans.alias("s"), F.expr("o.doc_stem <=> s.doc_stem and o.id <=> s.id")).join(before.alias("b"), F.expr("o.doc_stem <=> b.doc_stem and o.id <=> b.id"), "left")
    rows = cut.select("o.chunk_id", "o.doc_stem", "o.id", "o.text", "_before", F.size("spans").alias("pieces"), F.posexplode("spans").alias("piece", "span"))
    return rows.select(
        F.concat("chunk_id", F.lit("__part"), (F.col("_before") + F.col("piece") + 1).cast("string")).alias("part_id"), "chunk_id", "doc_stem", "id", (F.col("piece") + 1).alias("piece"), "pieces",
        F.col("span.starts").alias("starts"), F.col("span.ends").alias("ends"), F.substr("text", F.col("span.starts") + 1, F.col("span.ends") - F.col("span.starts")).alias("text"),
    )


def block_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oversized_pieces(table(spark, sf_dir, "semantic_blocks"))


def oversized_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chunk_id, id) of the blocks the operator cut."""
    return block_pieces(spark, sf_dir).where("pieces > 1").select("chunk_id", "id").distinct()
