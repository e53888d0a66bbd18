"""Nodes and edges of the catalog graph, with ids that are the same in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import chunk_page, json_list_id
from folioforge.operators.normalize import identified, merge_products, resolve_owner
from folioforge.runtime import cut


def _blank(c):
    return F.coalesce(F.col(c), F.lit(""))


def node_parts(products: DataFrame, attributes: DataFrame, runs: DataFrame) -> dict[str, DataFrame]:
    merged = merge_products(products).withColumn("code", F.when(F.col("kind") == "sku", F.col("ident")).otherwise(F.lit("")))
    return {
        "Document": runs.select("doc_stem").distinct().select(json_list_id("doc", "doc_stem").alias("id"), F.col("doc_stem").alias("name"), "doc_stem"),
        "Section": runs.select("doc_stem", "chunk_id").distinct().select(json_list_id("sec", "doc_stem", "chunk_id").alias("id"), F.col("chunk_id").alias("name"), "doc_stem", chunk_page("chunk_id").alias("page")),
        "Product": merged.select(json_list_id("prod", "doc_stem", "name", "code").alias("id"), "name", "doc_stem", "kind", "ident", "category", "first_chunk"),
        "Category": merged.where("category is not null").select(json_list_id("cat", "category").alias("id"), F.col("category").alias("name")).distinct(),
        "Attribute": attributes.select(json_list_id("attr", *[_blank(c) for c in ("doc_stem", "entity", "key", "value", "unit", "location", "chunk_id")]).alias("id"), F.col("key").alias("name"), "doc_stem", "entity").distinct(),
    }


def nodes(products: DataFrame, attributes: DataFrame, runs: DataFrame) -> DataFrame:
    """(id, label, name), each node once however often it is stated."""
    parts = [df.select("id", F.lit(label).alias("label"), "name") for label, df in node_parts(products, attributes, runs).items()]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.groupBy("id", "label").agg(F.min("name").alias("name"))


def edges(products: DataFrame, attributes: DataFrame, runs: DataFrame, relations: DataFrame) -> DataFrame:
    """(src, dst, rel): HAS_SECTION, CONTAINS (from the first chunk), BELONGS_TO, HAS_ATTRIBUTE, and IS_VARIANT_OF and
    HAS_MATERIAL where both ends are products; unresolved ends, self-loops and other predicates are left out."""
    n = node_parts(products, attributes, runs)
    # all kinds of edges but one begin or end at products, which are merged once
    sections, prods = n["Section"], cut(n["Product"], "products")
    has_section = sections.select(json_list_id("doc", "doc_stem").alias("src"), F.col("id").alias("dst"), F.lit("HAS_SECTION").alias("rel"))
    contains = prods.where("first_chunk is not null").select(json_list_id("sec", "doc_stem", "first_chunk").alias("src"), F.col("id").alias("dst"), F.lit("CONTAINS").alias("rel")).join(sections.select(F.col("id").alias("src")), "src", "left_semi")
    belongs = prods.where("category is not null").select(F.col("id").alias("src"), json_list_id("cat", "category").alias("dst"), F.lit("BELONGS_TO").alias("rel"))
    ids = prods.groupBy("doc_stem", F.col("ident").alias("owner_ident")).agg(F.min("id").alias("pid"))
    owned = resolve_owner(n["Attribute"].withColumnRenamed("id", "aid"), products).join(ids, ["doc_stem", "owner_ident"])
    has_attribute = owned.select(F.col("pid").alias("src"), F.col("aid").alias("dst"), F.lit("HAS_ATTRIBUTE").alias("rel"))
    typed = relations.where("predicate in ('IS_VARIANT_OF', 'HAS_MATERIAL')")
    ends = resolve_owner(typed.withColumn("entity", F.col("subject")), products).withColumnRenamed("owner_ident", "s").drop("entity")
    ends = resolve_owner(ends.withColumn("entity", F.col("object")), products).withColumnRenamed("owner_ident", "o")
    at = lambda a, b: ids.select("doc_stem", F.col("owner_ident").alias(a), F.col("pid").alias(b))
    between = ends.join(at("s", "src"), ["doc_stem", "s"]).join(at("o", "dst"), ["doc_stem", "o"]).where("src <> dst").select("src", "dst", F.col("predicate").alias("rel"))
    return has_section.unionByName(contains).unionByName(belongs).unionByName(has_attribute).unionByName(between).distinct()


def product_relations(products: DataFrame) -> DataFrame:
    """Relations the records state: variants of the smallest code of their group."""
    rows = identified(products).where("kind = 'sku' and variant_group is not null")
    head = rows.groupBy("doc_stem", "variant_group").agg(F.min("ident").alias("object"))
    return rows.join(head, ["doc_stem", "variant_group"]).where("ident <> object").select("doc_stem", F.col("ident").alias("subject"), F.lit("IS_VARIANT_OF").alias("predicate"), "object", "product_id")
