"""Tables as the catalog operators read them: each record once, however often it was delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.runtime import table


def once(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = table(spark, sf_dir, name)
    return (df.select(*columns) if columns else df.drop("ingested_at")).distinct()


BLOCK_COLUMNS = ("doc_stem", "id", "page", "type", "source_type", "text", "bbox", "block_order", "heading_level", "chunk_id")


def blocks(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Blocks once each; columns that a query does not name are neither read nor shuffled. The key always comes along."""
    return once(spark, sf_dir, "semantic_blocks", *dict.fromkeys(("doc_stem", "id", *(columns or BLOCK_COLUMNS))))


def outlined(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Blocks once each with the texts of headings only, for operators that look at no other text."""
    names = dict.fromkeys(("doc_stem", "id", "page", "type", "source_type", "block_order", "heading_level", *columns))
    text = F.when(F.col("type") == "heading", F.col("text")).alias("text")
    return table(spark, sf_dir, "semantic_blocks").select(*names, text).distinct()


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "ocr_pages", "doc_stem", "page_index", "parsing_res_list", "layout_det_res")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


BLOCKS = "blocks as (select distinct doc_stem, id, page, type, source_type, text, bbox, block_order, heading_level, chunk_id from semantic_blocks)"
PAGES = "pages as (select distinct doc_stem, page_index, parsing_res_list, layout_det_res from ocr_pages)"


def sql_strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def sql_lines(c: str) -> str:
    return sql_strip(rf"regexp_replace(coalesce({c}, ''), '\r\n?', chr(10), 'g')")
