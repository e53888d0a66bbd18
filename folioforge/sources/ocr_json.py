"""Reading recognized documents of any of the known shapes as VARIANT, one row per page."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.text import plain_lines
from folioforge.operators.layout import box

# Names under which pages, texts, confidences and orders are stored.
PAGE_LISTS = ("layoutParsingResults", "pages", "ocrResults")
TEXT_KEYS = ("block_content", "block_text", "text", "content", "markdown_text", "markdownText", "rec_text", "label", "name")
SCORE_KEYS = ("confidence", "score", "block_score", "rec_score", "dt_score")
ORDER_KEYS = ("block_order", "order", "seq", "idx", "index", "reading_order")
LABEL_KEYS = ("block_label", "label", "type", "category")
BOX_KEYS = ("block_bbox", "bbox", "coordinate", "box")


def find_files(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """(path, size, modified) of all files below a path; no contents are read. Names give an order where one is needed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def missing_files(spark: SparkSession, expected: DataFrame, path: str, pattern: str = "*") -> DataFrame:
    """Rows of expected (name) for which there is no file."""
    have = find_files(spark, path, pattern).select(F.substring_index("path", "/", -1).alias("name"))
    return expected.join(have, "name", "left_anti")


def require_files(spark: SparkSession, expected: DataFrame, path: str, pattern: str = "*", shown: int = 20) -> None:
    """A FileNotFoundError naming the first missing files, if any of expected (name) is not there; nothing else is run."""
    gone = [r["name"] for r in missing_files(spark, expected, path, pattern).orderBy("name").limit(shown).collect()]
    if gone:
        raise FileNotFoundError(f"not below {path}: {', '.join(gone)}")


def content_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, sha256) of files, to tell stale results from current ones by an equi-join."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def read_documents(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """(path, doc_stem, raw): each file as VARIANT; a file that is no JSON has a null raw."""
    files = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path)
    name = F.regexp_replace(F.substring_index(F.col("_metadata.file_path"), "/", -1), r"(_\d+_res)?\.json$", "")
    return files.select(F.col("_metadata.file_path").alias("path"), name.alias("doc_stem"), F.try_parse_json("value").alias("raw"))


def inspect(documents: DataFrame, preview: int = 2000) -> DataFrame:
    """(path, root_type, keys, preview) of documents of unknown shape."""
    text = F.to_json("raw")
    kind = F.when(F.col("raw").isNull(), "invalid").when(text.startswith("{"), "object").when(text.startswith("["), "array").otherwise("value")
    return documents.select("path", kind.alias("root_type"), F.json_object_keys(text).alias("keys"), F.substring(text, 1, preview).alias("preview"))


def _list(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "array<variant>")


def page_records(documents: DataFrame) -> DataFrame:
    """(path, doc_stem, page, place, item): one row per page.

    A document with parsing_res_list is one page; else pages stand in a list under one of the known names, or the document
    is the list, or it is the one page. Page number: page_index + 1, else page or page_number, else the place in the list.
    """
    raw = F.col("raw")
    flat = F.try_variant_get(raw, "$.parsing_res_list", "array<variant>").isNotNull()
    single = F.array(raw)
    pages = F.when(flat, single).otherwise(F.coalesce(*[_list(raw, f"$.{k}") for k in PAGE_LISTS], _list(raw, "$"), single))
    rows = documents.where("raw is not null").select("path", "doc_stem", F.posexplode(pages).alias("n", "item"))
    number = lambda k: F.try_variant_get("item", f"$.{k}", "int")
    index = number("page_index")
    page = F.coalesce(F.when(index >= 0, index + 1), number("page"), number("page_number"), F.col("n") + 1)
    return rows.select("path", "doc_stem", page.alias("page"), (F.col("n") + 1).alias("place"), "item")


def first_text(v: Column) -> Column:
    """The first text that is not blank under the known names, else Markdown text, else the joined texts; '' without one."""
    named = [F.try_variant_get(v, f"$.{k}", "string") for k in TEXT_KEYS]
    lists = F.array_join(F.filter(F.try_variant_get(v, "$.texts", "array<string>"), lambda x: F.trim(x) != ""), "\n")
    ways = [*named, F.try_variant_get(v, "$.markdown.text", "string"), lists]
    return F.coalesce(*[F.when(F.trim(w) != "", plain_lines(w)) for w in ways], F.lit(""))


def first_score(v: Column) -> Column:
    """The first confidence under the known names, else the mean of scores."""
    scores = F.try_variant_get(v, "$.scores", "array<double>")
    mean = F.when(F.size(scores) > 0, F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.size(scores))
    return F.coalesce(*[F.try_variant_get(v, f"$.{k}", "double") for k in SCORE_KEYS], mean)


def stated_box(v: Column) -> Column:
    """The box of an object: four corners or a polygon, the two corners left_top and right_bottom, or any of these under bbox
    inside the box; null for anything else."""

    def read(path: str) -> list[Column]:
        near, far = (F.coalesce(*[F.try_variant_get(v, f"{path}.{k}", "array<double>") for k in names]) for names in (("left_top", "leftTop"), ("right_bottom", "rightBottom")))
        corners = F.when((F.size(near) >= 2) & (F.size(far) >= 2), F.array(near[0], near[1], far[0], far[1]))
        return [box(F.try_variant_get(v, path, "array<double>")), corners]

    return F.coalesce(*[way for k in BOX_KEYS for path in (f"$.{k}", f"$.{k}.bbox") for way in read(path)])


WALKED = "path string, doc_stem string, page int, place int, source_ref string, block string"


def walk_blocks(pages: DataFrame) -> DataFrame:
    """Objects anywhere in a page that have a box and a label or a text, in the order of the document: path, doc_stem, page,
    place (from 1), source_ref (where it stands), block (VARIANT).

    Pages are walked without recursion, in Arrow batches, so depth has no limit; a page is one record of its file."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for path, doc, page, text in zip(frame["path"], frame["doc_stem"], frame["page"], frame["text"]):
                found, todo = 0, [("$", json.loads(text))]
                while todo:
                    at, node = todo.pop()
                    if isinstance(node, dict):
                        if any(node.get(k) for k in BOX_KEYS) and any(isinstance(node.get(k), str) for k in (*LABEL_KEYS, *TEXT_KEYS)):
                            found += 1
                            out.append((path, doc, page, found, at, json.dumps(node, ensure_ascii=False)))
                        inner = [(f"{at}.{k}", x) for k, x in node.items()]
                    else:
                        inner = [(f"{at}[{n}]", x) for n, x in enumerate(node)] if isinstance(node, list) else []
                    todo += [(a, x) for a, x in reversed(inner) if isinstance(x, (dict, list))]
            yield pd.DataFrame(out, columns=["path", "doc_stem", "page", "place", "source_ref", "block"])

    rows = pages.select("path", "doc_stem", "page", F.to_json("item").alias("text")).where("text is not null")
    return rows.mapInPandas(walk, WALKED).withColumn("block", F.parse_json("block"))


def walked_candidates(pages: DataFrame) -> DataFrame:
    """What page_candidates gives, of the objects of walk_blocks: for pages that keep their blocks under other names."""
    label = F.coalesce(*[F.try_variant_get("block", f"$.{k}", "string") for k in LABEL_KEYS])
    order = F.coalesce(*[F.try_variant_get("block", f"$.{k}", "int") for k in ORDER_KEYS], F.col("place"))
    out = walk_blocks(pages).select("doc_stem", "page", order.alias("block_order"), F.lower(F.trim(label)).alias("label"), first_text(F.col("block")).alias("text"), stated_box(F.col("block")).alias("bbox"), first_score(F.col("block")).alias("confidence"), "source_ref")
    return out.where("bbox is not null and (label is not null or text <> '')")


def page_candidates(pages: DataFrame) -> DataFrame:
    """(doc_stem, page, block_order, label, text, bbox, confidence): blocks of pages whatever their shape.

    Blocks are the members of parsing_res_list, of prunedResult's or the page's own list of boxes or blocks; an object is a
    block if it has a box and a label or a text."""
    lists = ("$.parsing_res_list", "$.prunedResult.parsing_res_list", "$.prunedResult.boxes", "$.boxes", "$.blocks", "$.layout_det_res.boxes")
    found = F.coalesce(*[_list(F.col("item"), p) for p in lists])
    rows = pages.select("doc_stem", "page", F.posexplode(found).alias("n", "b"))
    label = F.coalesce(*[F.try_variant_get("b", f"$.{k}", "string") for k in LABEL_KEYS])
    order = F.coalesce(*[F.try_variant_get("b", f"$.{k}", "int") for k in ORDER_KEYS], F.col("n"))
    out = rows.select("doc_stem", "page", order.alias("block_order"), F.lower(F.trim(label)).alias("label"), first_text(F.col("b")).alias("text"), stated_box(F.col("b")).alias("bbox"), first_score(F.col("b")).alias("confidence"))
    return out.where("bbox is not null and (label is not null or text <> '')")
