"""From recognized pages to typed, ordered blocks."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.text import col, label, plain_lines

# Labels of layout recognition by what they mean.
HEADINGS = ("title", "heading", "subtitle", "section_title", "section", "chapter", "paragraph_title", "doc_title", "page_title")
TABLES = ("table", "table_body", "table_caption", "table_title")
FIGURES = ("figure", "image", "chart", "diagram", "graph", "plot", "figure_title", "figure_caption")
PRODUCTS = ("product", "product_card", "item", "sku", "catalog_item")
SPECIFICATIONS = ("specification", "spec", "attributes", "attribute", "key_value", "kv", "vision_footnote")
CHROME = ("footer", "header", "number")
TOP_LEVEL = ("title", "chapter", "doc_title")
SECOND_LEVEL = ("heading", "subtitle", "section", "section_title", "paragraph_title")
DETAIL_TITLES = ("specifications", "technical specifications", "features", "ordering information")

# A line that states a value, a price, a dimension and a word that could be a model.
KEY_VALUE = r"(?m)^[^:\n]{2,40}:\s*.+$"
PRICE = r"[$€£]\s?\d"
DIMENSION = r"(?i)\b\d+(?:\.\d+)?\s?(?:in|mm|cm|m|ft|lb|oz|kg|g|w|v|amp|amps)\b"
MODEL_TOKEN = r"\b[A-Z0-9][A-Z0-9\-_/]{2,}\b"


def box(b: str | Column) -> Column:
    """[left, top, right, bottom] of four corners or of a polygon; anything else is null."""
    b = col(b).cast("array<double>")
    xs, ys = F.filter(b, lambda x, i: i % 2 == 0), F.filter(b, lambda x, i: i % 2 == 1)
    return F.when(F.size(b) == 4, b).when(F.size(b) >= 8, F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))


def is_specification(text: str | Column) -> Column:
    """Two 'key: value' lines, or three lines of which two hold a colon."""
    text = col(text)
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return (F.regexp_count(text, F.lit(KEY_VALUE)) >= 2) | ((F.size(lines) >= 3) & (F.size(F.filter(lines, lambda x: x.contains(":"))) >= 2))


def card_score(text: str | Column) -> Column:
    """How many of price, dimension, model token, three lines and specification a text shows."""
    text = col(text)
    signs = (text.rlike(PRICE), text.rlike(DIMENSION), text.rlike(MODEL_TOKEN), F.regexp_count(text, F.lit("\n")) >= 2, is_specification(text))
    return sum((s.cast("int") for s in signs), F.lit(0))


def semantic_type(source_type: str | Column, text: str | Column) -> Column:
    """heading, table, figure, product_card, specification or paragraph: by label first, then by text."""
    name, text = label(source_type), plain_lines(text)
    return (
        F.when(name.isin(*HEADINGS), "heading")
        .when(name.isin(*TABLES), "table")
        .when(name.isin(*FIGURES), "figure")
        .when(name.isin(*PRODUCTS), "product_card")
        .when(name.isin(*SPECIFICATIONS), "specification")
        .when(text.startswith("#"), "heading")
        .when((text != "") & (card_score(text) >= 3), "product_card")
        .when(is_specification(text), "specification")
        .otherwise("paragraph")
    )


def heading_level(source_type: str | Column, text: str | Column, explicit: Column | None = None) -> Column:
    """Explicit level, number of leading #, depth of a section number (6 at most), level of the label, 2 if short, else 3."""
    name, text = label(source_type), plain_lines(text)
    numbered = F.regexp_extract(text, r"^(\d+(?:\.\d+)*)\.?\s+[A-Za-z]", 1)
    by_text = (
        F.when(text.startswith("#"), F.length(F.regexp_extract(text, "^#+", 0)))
        .when(numbered != "", F.least(F.lit(6), F.length(F.regexp_replace(numbered, r"[^.]", "")) + 1))
        .when((name == "paragraph_title") & F.lower(text).isin(*DETAIL_TITLES), 3)
        .when(name.isin(*TOP_LEVEL), 1)
        .when(name.isin(*SECOND_LEVEL), 2)
        .when((text != "") & (F.size(F.split(text, r"(?U)\s+")) <= 6) & (F.length(text) <= 60), 2)
        .otherwise(3)
    )
    return by_text if explicit is None else F.when(explicit > 0, explicit).otherwise(by_text)


def block_name(text: str | Column, kind: str | Column, order: str | Column) -> Column:
    """First line without leading #; '{type}-{order}' where there is none."""
    first = F.trim(F.regexp_replace(F.split(plain_lines(text), "\n")[0], "^#+", ""))
    return F.when(first != "", first).otherwise(F.format_string("%s-%d", col(kind), col(order)))


def page_blocks(pages: DataFrame) -> DataFrame:
    """One row per block of parsing_res_list, with its id, page and place. Null lists give no rows."""
    rows = pages.select("doc_stem", (F.col("page_index") + 1).alias("page"), F.posexplode("parsing_res_list").alias("pos", "b"))
    return rows.select("doc_stem", F.format_string("p%d_b%03d", "page", "pos").alias("id"), "page", "pos", F.col("b.block_label").alias("label"), F.col("b.block_content").alias("text"), box("b.block_bbox").alias("bbox"))


def page_boxes(pages: DataFrame) -> DataFrame:
    rows = pages.select("doc_stem", (F.col("page_index") + 1).alias("page"), F.posexplode("layout_det_res.boxes").alias("rank", "x"))
    return rows.select("doc_stem", "page", "rank", F.col("x.score").alias("score"), box("x.coordinate").alias("box"))


def join_scores(blocks: DataFrame, boxes: DataFrame, tolerance: float = 3.0) -> DataFrame:
    """Adds the confidence of the detected box a block came from.

    Corners equal when rounded come first, then corners equal on a grid of five, then corners within the tolerance; of
    several boxes the first detected. The last tier is an equi-join on the grid cell of the top left corner and its
    neighbours, so boxes of a page are not paired with all its blocks. Blocks without a box keep a null confidence.
    """
    key = ["doc_stem", "page"]
    rounded = lambda b, step: F.concat_ws(",", *[(F.bround(F.col(b)[i] / step) * step).cast("bigint").cast("string") for i in range(4)])
    cell = lambda b, i: F.floor(F.col(b)[i] / (2 * tolerance))
    left = blocks.withColumn("_x", cell("bbox", 0)).withColumn("_y", cell("bbox", 1))
    near = [F.lit(i) for i in (-1, 0, 1)]
    right = boxes.where("box is not null").withColumn("_x", F.explode(F.array(*[cell("box", 0) + n for n in near]))).withColumn("_y", F.explode(F.array(*[cell("box", 1) + n for n in near])))
    band = left.where("bbox is not null").join(right, [*key, "_x", "_y"])
    for i in range(4):
        band = band.where(F.abs(F.col("bbox")[i] - F.col("box")[i]) <= 2 * tolerance)
    close = F.lit(True)
    for i in range(4):
        close = close & (F.abs(F.col("bbox")[i] - F.col("box")[i]) <= tolerance)
    tier = F.when(rounded("bbox", 1) == rounded("box", 1), 0).when(rounded("bbox", 5) == rounded("box", 5), 1).when(close, 2)
    best = band.withColumn("_tier", tier).where("_tier is not null").groupBy("doc_stem", "id").agg(F.min(F.struct("_tier", "rank", "score")).alias("_best"))
    return blocks.join(best, ["doc_stem", "id"], "left").withColumn("confidence", F.col("_best.score")).withColumn("tier", F.col("_best._tier")).drop("_best")


def reading_order(blocks: DataFrame, order: str = "block_order") -> DataFrame:
    """Adds the place on the page: by order, then top, then left; blocks without a box come last among equals."""
    far = F.lit(1e9)
    w = Window.partitionBy("doc_stem", "page").orderBy(order, F.coalesce(F.get("bbox", F.lit(1)), far), F.coalesce(F.get("bbox", F.lit(0)), far), "id")
    return blocks.withColumn("place", F.row_number().over(w))


def markdown_blocks(text: str | Column) -> Column:
    """array<struct<kind, text>> of Markdown: headings, pipe tables, list items and paragraphs in order.

    Lines of one kind that follow each other without a blank line are one table or one paragraph; headings and list items
    stand alone."""


    @F.pandas_udf("array<struct<kind:string,text:string>>")
    def read(texts: pd.Series) -> pd.Series:
        return pd.Series([markdown_parts(t) for t in texts], dtype=object)

    return read(plain_lines(text))


_KINDS = (("heading", re.compile(r"\s*#", re.A)), ("table", re.compile(r"\s*\|", re.A)), ("list", re.compile(r"\s*(?:[-*+]|\d+\.)\s", re.A)))


def markdown_parts(text: str) -> list[tuple[str, str]]:
    """(kind, text) of the parts of a text, in one pass over its lines."""
    out: list[tuple[str, list[str]]] = []
    open_ = None
    for line in text.split("\n"):
        body = line.strip(" ")
        kind = next((k for k, p in _KINDS if p.match(line)), "paragraph") if body else None
        if kind and kind == open_ and kind in ("table", "paragraph"):
            out[-1][1].append(body)
        elif kind:
            out.append((kind, [body]))
        open_ = kind
    return [(kind, "\n".join(lines)) for kind, lines in out]


def zipped_lines(texts: str | Column, boxes: str | Column, scores: str | Column) -> Column:
    """array<struct<text, box, score>> of parallel lists of unequal length; lines without text are left out."""
    rows = F.arrays_zip(col(texts).alias("texts"), col(boxes).alias("boxes"), col(scores).alias("scores"))
    named = F.transform(rows, lambda r: F.struct(r["texts"].alias("text"), r["boxes"].alias("box"), r["scores"].alias("score")))
    return F.filter(named, lambda r: F.coalesce(F.trim(r["text"]), F.lit("")) != "")


def image_blocks(images: str | Column) -> Column:
    """Figure blocks of a map from image name to box, ordered from 1000."""
    entries = F.map_entries(col(images))
    return F.transform(entries, lambda e, i: F.struct(F.lit("figure").alias("kind"), e["key"].alias("source_ref"), box(e["value"]).alias("bbox"), (i + 1000).alias("block_order")))
