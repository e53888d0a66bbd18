"""Checks of extracted records: each rule gives rows (rule, severity, doc_stem, record_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.text import odd_share, strip
from folioforge.operators.normalize import filled, first_by, identified
from folioforge.operators.replies import PREDICATES

MATERIAL = r"(?i)^\d{3}L?\s+stainless(?:\s+steel)?$"


def _issue(df: DataFrame, rule: str, severity: str, where: Column, key: str) -> DataFrame:
    return df.where(where).select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "doc_stem", F.col(key).alias("record_id"))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def blank(c: str) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def product_issues(p: DataFrame) -> DataFrame:
    return _all(
        [
            _issue(p, "SCHEMA_ERROR", "error", blank("name"), "product_id"),
            _issue(p, "SHORT_NAME", "warning", ~blank("name") & (F.length(strip("name")) < 2), "product_id"),
            _issue(p, "GARBAGE_TEXT", "warning", odd_share("name") > 0.15, "product_id"),
            _issue(p, "MISSING_SKU", "info", blank("sku"), "product_id"),
            _issue(p, "MATERIAL_IS_NOT_MODEL", "info", strip("model").rlike(MATERIAL), "product_id"),
        ]
    )


def attribute_issues(a: DataFrame) -> DataFrame:
    return _all(
        [
            _issue(a, "SCHEMA_ERROR", "error", blank("entity") | blank("key") | blank("value"), "attr_id"),
            _issue(a, "GARBAGE_TEXT", "warning", odd_share("value") > 0.15, "attr_id"),
            _issue(a, "VALUE_TOO_LONG", "warning", F.length("value") > 500, "attr_id"),
        ]
    )


def relation_issues(r: DataFrame) -> DataFrame:
    return _all(
        [
            _issue(r, "SCHEMA_ERROR", "error", blank("subject") | blank("predicate") | blank("object") | (F.lower("subject") == F.lower("object")), "product_id"),
            _issue(r, "UNKNOWN_PREDICATE", "warning", ~F.upper("predicate").isin(*PREDICATES), "product_id"),
        ]
    )


def duplicate_codes(p: DataFrame) -> DataFrame:
    """Later products with a code, whatever its case. The first of a code is found by an aggregation, so a hot code is not sorted in one task."""
    rows = p.where(~blank("sku")).withColumn("_code", F.upper(strip("sku")))
    first = rows.groupBy("doc_stem", "_code").agg(F.min("product_id").alias("_first"))
    return _issue(rows.join(first, ["doc_stem", "_code"]), "DUPLICATE_SKU", "warning", F.col("product_id") != F.col("_first"), "product_id")


def orphaned_attributes(a: DataFrame, p: DataFrame, scope: str = "doc") -> DataFrame:
    """Attributes whose entity is no name or code: of the document, exactly (error); of the chunk, whatever its case (warning)."""
    if scope == "doc":
        known = p.select("doc_stem", F.explode(F.array("name", "sku")).alias("entity")).where("entity is not null").distinct()
        return _issue(a.join(known, ["doc_stem", "entity"], "left_anti"), "ORPHANED_ATTRIBUTE", "error", F.lit(True), "attr_id")
    known = p.select("doc_stem", "chunk_id", F.explode(F.array(F.lower("name"), F.lower("sku"))).alias("_e")).where("_e is not null").distinct()
    return _issue(a.withColumn("_e", F.lower(strip("entity"))).join(known, ["doc_stem", "chunk_id", "_e"], "left_anti"), "ORPHANED_ATTRIBUTE_IN_CHUNK", "warning", F.lit(True), "attr_id")


def ambiguous_owners(a: DataFrame, p: DataFrame) -> DataFrame:
    """Attributes whose entity names products of several identities."""
    owners = identified(p).select("doc_stem", F.explode(F.array("name", filled("sku"))).alias("entity"), "kind", "ident").where("entity is not null")
    many = owners.groupBy("doc_stem", "entity").agg(F.min(F.struct("kind", "ident")).alias("a"), F.max(F.struct("kind", "ident")).alias("b")).where("a <> b").select("doc_stem", "entity")
    return _issue(a.join(many, ["doc_stem", "entity"], "left_semi"), "AMBIGUOUS_ATTRIBUTE_OWNER", "error", F.lit(True), "attr_id")


def code_conflicts(p: DataFrame) -> DataFrame:
    """Codes with several models, and models with several categories: (rule, severity, doc_stem, subject, choices)."""
    models = p.where(~blank("sku") & ~blank("model")).groupBy("doc_stem", strip("sku").alias("subject")).agg(F.count_distinct(strip("model")).alias("choices")).where("choices > 1")
    categories = p.where(~blank("model") & ~blank("category")).groupBy("doc_stem", strip("model").alias("subject")).agg(F.count_distinct(strip("category")).alias("choices")).where("choices > 1")
    cols = ["doc_stem", "subject", "choices"]
    return models.select(F.lit("CONFLICTING_SKU_MODEL").alias("rule"), F.lit("error").alias("severity"), *cols).unionByName(categories.select(F.lit("MULTIPLE_MODEL_CATEGORIES").alias("rule"), F.lit("warning").alias("severity"), *cols))


def code_tokens(blocks: DataFrame) -> DataFrame:
    """(doc_stem, chunk_id, code): words of block texts that could be codes, each once per chunk, upper case."""
    words = F.regexp_extract_all(F.upper("text"), F.lit(r"(?U)(?<![\w/.-])(?=[A-Z./-]*\d)([A-Z0-9][\w/.-]*\w)"), F.lit(1))
    return blocks.where("text is not null and chunk_id is not null").select("doc_stem", "chunk_id", F.explode(F.array_distinct(words)).alias("code")).distinct()


def unsupported_codes(p: DataFrame, blocks: DataFrame) -> DataFrame:
    """Products whose code stands nowhere in the texts of their chunk: an anti-join on words instead of a search of every text for every code."""
    rows = p.where(~blank("sku")).withColumn("_chunk", F.regexp_replace("chunk_id", "__part[0-9]+$", "")).withColumn("_code", F.upper(strip("sku")))
    words = code_tokens(blocks).select("doc_stem", F.col("chunk_id").alias("_chunk"), F.col("code").alias("_code"))
    return _issue(rows.join(words, ["doc_stem", "_chunk", "_code"], "left_anti"), "UNSUPPORTED_IDENTIFIER", "error", F.lit(True), "product_id")


def missing_codes(found: DataFrame, p: DataFrame) -> DataFrame:
    """Codes of table rows that no product of the document has: (doc_stem, code)."""
    known = p.where(~blank("sku")).select("doc_stem", F.upper(strip("sku")).alias("code")).distinct()
    return found.select("doc_stem", F.upper("code").alias("code")).distinct().join(known, ["doc_stem", "code"], "left_anti")


# Words of headings that name nothing, headers of names and of prices in table rows.
HEADING_WORDS = ("the", "of", "for", "and", "page", "section", "overview")
ROW_NAMES, ROW_PRICES = ("description", "product name", "name"), ("price", "list price", "usd", "eur", "gbp", "$", "€", "£")
MODEL_WORDS = r"(?i)model\s*(?:number|no\.?|#)?\s*[:=]?\s*([^\s,;()\[\]]+)"


def heading_terms(c: Column) -> Column:
    """Words of a name, without a plural s and words that name nothing."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"(?U)(\w+)"), F.lit(1))
    return F.filter(F.transform(words, lambda w: F.when(F.length(w) > 3, F.regexp_replace(w, "s+$", "")).otherwise(w)), lambda w: ~w.isin(*HEADING_WORDS))


def _chunk(c: str = "chunk_id") -> Column:
    return F.regexp_replace(c, "__part[0-9]+$", "")


def concrete_names(rows: DataFrame) -> DataFrame:
    """(doc_stem, _chunk, _name): names that stand in a table row of the chunk beside a price."""
    pairs = rows.select("doc_stem", _chunk().alias("_chunk"), F.zip_with("headers", "cells", lambda k, v: F.struct(F.lower(F.trim(k)).alias("k"), v.alias("v"))).alias("_r"))
    priced = pairs.where(F.exists("_r", lambda c: c["k"].isin(*ROW_PRICES) & c["v"].rlike(r"\d")))
    return priced.select("doc_stem", "_chunk", F.explode(F.filter("_r", lambda c: c["k"].isin(*ROW_NAMES))).alias("c")).select("doc_stem", "_chunk", F.lower("c.v").alias("_name")).distinct()


def unsupported_items(p: DataFrame, rows: DataFrame) -> DataFrame:
    """Products without code and model that no priced row of their chunk names: HEADING_AS_PRODUCT where all words of the
    name stand in one heading of the section path, else UNSUPPORTED_SELLABLE_ITEM.

    p: products with section_path; rows: table rows with chunk_id."""
    bare = p.where(blank("sku") & blank("model")).withColumn("_chunk", _chunk()).withColumn("_name", F.lower("name")).join(concrete_names(rows), ["doc_stem", "_chunk", "_name"], "left_anti")
    terms = heading_terms(F.coalesce("name", F.lit("")))
    bare = bare.withColumn("_t", terms)
    heading = F.coalesce((F.size("_t") > 0) & F.exists("section_path", lambda h: F.size(F.array_except("_t", heading_terms(h))) == 0), F.lit(False))
    return bare.select(F.when(heading, "HEADING_AS_PRODUCT").otherwise("UNSUPPORTED_SELLABLE_ITEM").alias("rule"), F.lit("error").alias("severity"), "doc_stem", F.col("product_id").alias("record_id"))


def unconfirmed_models(p: DataFrame, rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Products whose model is their code, which neither a model column nor the words 'model X' in their chunk confirm."""
    same = p.where(~blank("sku") & (strip("model") == strip("sku"))).withColumn("_chunk", _chunk()).withColumn("_m", strip("model"))
    cells = rows.select("doc_stem", _chunk().alias("_chunk"), F.explode(F.filter(F.zip_with("headers", "cells", lambda k, v: F.struct(k.alias("k"), v.alias("v"))), lambda c: F.lower(F.trim(c["k"])) == "model")).alias("c")).select("doc_stem", "_chunk", strip("c.v").alias("_m"))
    said = texts.where("text is not null and chunk_id is not null").select("doc_stem", _chunk().alias("_chunk"), F.explode(F.regexp_extract_all("text", F.lit(MODEL_WORDS), F.lit(1))).alias("_m"))
    said = said.select("doc_stem", "_chunk", F.regexp_replace("_m", r"(?U)[^\w]+$", "").alias("_m"))
    return _issue(same.join(cells.unionByName(said).distinct(), ["doc_stem", "_chunk", "_m"], "left_anti"), "SKU_IS_NOT_A_CONFIRMED_MODEL", "info", F.lit(True), "product_id")


def without_models(p: DataFrame, issues: DataFrame) -> DataFrame:
    """Products with the model set to null where an issue says that it is a material or no confirmed model."""
    bad = issues.where(F.col("rule").isin("MATERIAL_IS_NOT_MODEL", "SKU_IS_NOT_A_CONFIRMED_MODEL")).select(F.col("record_id").alias("product_id"), F.lit(True).alias("_bad")).distinct()
    return p.join(bad, "product_id", "left").withColumn("model", F.when(F.col("_bad").isNull(), F.col("model"))).drop("_bad")


def without_unsupported(p: DataFrame, a: DataFrame, issues: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products, attributes) without the products of unsupported_items and the attributes of their chunk that are called
    like them, unless a product that stays bears the name or code."""
    bad = issues.where(F.col("rule").isin("HEADING_AS_PRODUCT", "UNSUPPORTED_SELLABLE_ITEM")).select(F.col("record_id").alias("product_id")).distinct()
    kept, gone = p.join(bad, "product_id", "left_anti"), p.join(bad, "product_id", "left_semi")
    names = kept.select("doc_stem", "chunk_id", F.explode(F.array("name", "sku")).alias("entity")).where("entity is not null").distinct()
    lost = gone.select("doc_stem", "chunk_id", F.col("name").alias("entity")).distinct().join(names, ["doc_stem", "chunk_id", "entity"], "left_anti")
    return kept, a.join(lost, ["doc_stem", "chunk_id", "entity"], "left_anti")


def ignored_notes(p: DataFrame, issues: DataFrame) -> DataFrame:
    """(rule, severity, doc_stem, chunk_id, name): notes on the products that were taken out, one for each name of a chunk."""
    bad = issues.where(F.col("rule").isin("HEADING_AS_PRODUCT", "UNSUPPORTED_SELLABLE_ITEM"))
    met = bad.select("rule", F.col("record_id").alias("product_id")).join(p.select("product_id", "doc_stem", "chunk_id", "name").distinct(), "product_id")
    any_item = F.bool_or(F.col("rule") == "UNSUPPORTED_SELLABLE_ITEM")
    return met.groupBy("doc_stem", "chunk_id", "name").agg(F.when(any_item, "UNSUPPORTED_ITEM_IGNORED").otherwise("HEADING_FAMILY_IGNORED").alias("rule")).select("rule", F.lit("info").alias("severity"), "doc_stem", "chunk_id", "name")


def structure_issues(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """CATALOG_STRUCTURE: nodes without type, identifier or title, identifiers that are not unique, links from a node to one
    of its own or a higher level (models may stand under any category), and amounts that are negative or not finite.

    nodes: doc_stem, identifier, level (1 category, 2 model, 3 item, 4 price), title, amount; edges: doc_stem, parent, child."""
    holes = nodes.where(F.col("level").isNull() | blank("identifier") | blank("title"))
    twice = nodes.groupBy("doc_stem", "identifier").count().where("count > 1 and identifier is not null")
    amounts = nodes.where(F.col("amount").isNotNull() & ~((F.col("amount") >= 0) & (F.col("amount") < float("inf"))))
    level = nodes.select("doc_stem", "identifier", "level").distinct()
    up = edges.join(level.select("doc_stem", F.col("identifier").alias("parent"), F.col("level").alias("_up")), ["doc_stem", "parent"], "left")
    both = up.join(level.select("doc_stem", F.col("identifier").alias("child"), F.col("level").alias("_down")), ["doc_stem", "child"], "left")
    wrong = both.where(F.col("_up").isNull() | F.col("_down").isNull() | ((F.col("_up") >= F.col("_down")) & ~((F.col("_up") == 1) & (F.col("_down") == 1))))
    found = [(holes, "identifier"), (twice, "identifier"), (amounts, "identifier"), (wrong, "child")]
    return _all([df.select(F.lit("CATALOG_STRUCTURE").alias("rule"), F.lit("error").alias("severity"), "doc_stem", F.col(key).alias("record_id")) for df, key in found])


def report(issues: DataFrame) -> DataFrame:
    return issues.groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_stem").alias("documents"))


def provenance(p: DataFrame, blocks: DataFrame) -> DataFrame:
    """First and last page and number of blocks of each product's chunk."""
    chunks = blocks.where("chunk_id is not null").groupBy("doc_stem", F.col("chunk_id").alias("_chunk")).agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count(F.lit(1)).alias("blocks"))
    return p.withColumn("_chunk", F.regexp_replace("chunk_id", "__part[0-9]+$", "")).join(chunks, ["doc_stem", "_chunk"], "left").select("product_id", "first_page", "last_page", "blocks")
