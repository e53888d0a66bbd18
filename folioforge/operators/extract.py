"""Products and attributes read from table rows and page texts without a model, and what is left for one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.text import breadcrumb, strip
from folioforge.operators import tables

# Codes in the text layer of a page, a price behind a dotted leader, rows of codes above a price.
NATIVE_CODE = r"\d{4,5}[A-Z]\d{2,5}"
NATIVE_PRICE = r"(?<![\d.])([$€£])?\s*(\d{1,5}(?:,\d{3})*\.\d{2})(?![\d.])"
STACKED = r"(?m)((?:^[A-Z]{2,6}\d{2,6}(?:/[A-Z0-9]{1,4})?[ \t]*\n){1,3})^\$[ \t]*\n(\d{1,3}(?:,\d{3})*\.\d{2})"
NATIVE_REACH = 120
ORPHAN_PRICE = r"^[$€£]?\s*\d+(?:,\d{3})*\.\d{2}$"

ROW = ["doc_stem", "id", "row_no"]


def _lower(c: Column) -> Column:
    return F.lower(F.trim(c))


def _first_of(row: Column, names: tuple[str, ...]) -> Column:
    """The first filled cell under one of the headers."""
    return F.get(F.transform(F.filter(row, lambda c: _lower(c["k"]).isin(*names) & (c["v"] != "")), lambda c: c["v"]), F.lit(0))


def amount_of(value: Column) -> Column:
    """A price without sign and group marks; any other text stays as it is, for review."""
    plain = F.regexp_extract(F.trim(value), r"^(?:[$€£]|(?i:USD|EUR|GBP|JPY|CNY|INR|AUD))?\s*((?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?)$", 1)
    return F.when(plain != "", F.replace(plain, F.lit(","), F.lit(""))).otherwise(value)


def read_rows(rows: DataFrame) -> DataFrame:
    """What each table row states: codes, description, model, properties and prices, and the way it was read: explicit (codes
    of code columns, or of columns that hold codes), inline (codes run together with prices) or unresolved.

    rows: doc_stem, id, method, row_no, headers, cells and section_path. Rows and columns are read as they stand; a cell
    that is a code of the row is no property of it, and a price that is not well formed is kept as it is."""
    # a row's codes are no more than its cells
    held = tables.content_codes(rows).where("row_no >= 0").groupBy(*ROW).agg(F.array_sort(F.collect_set("code")).alias("_content"))
    rows = rows.join(held, ROW, "left").withColumn("_codes", F.array_union(tables.row_codes("headers", "cells"), F.coalesce("_content", F.array().cast("array<string>"))))
    row = tables.realigned("headers", "cells")
    is_code = lambda c: F.trim(c["k"]).rlike(f"(?i)^{tables.CODE_HEADER}$")
    priced = lambda c: _lower(c["k"]).isin(*tables.PRICE_HEADERS)
    told = lambda c: _lower(c["k"]).isin(*tables.NAME_HEADERS, *tables.MODEL_HEADERS)
    units = F.create_map(*[F.lit(x) for pair in tables.PRICE_HEADERS.items() if pair[1] for x in pair])
    prefix = lambda c: F.when(c["v"].rlike(tables.PRICE_PREFIX), F.upper(F.regexp_extract(c["v"], tables.PRICE_PREFIX, 1)))
    filled = F.filter(row, lambda c: (c["v"] != "") & ~is_code(c) & ~told(c) & ~F.array_contains("_codes", F.trim(c["v"])))
    out = rows.select(
        *ROW, "section_path", "headers", "cells",
        F.col("_codes").alias("codes"),
        tables.inline_pairs("headers", "cells").alias("pairs"),
        _first_of(row, tables.NAME_HEADERS).alias("description"),
        F.coalesce(_first_of(row, tables.MODEL_HEADERS), tables.heading_model("section_path")).alias("model"),
        F.transform(F.filter(filled, lambda c: ~priced(c)), lambda c: F.struct(c["k"].alias("key"), c["v"].alias("value"), F.lit(None).cast("string").alias("unit"))).alias("properties"),
        F.transform(F.filter(filled, priced), lambda c: F.struct(F.lit("Price").alias("key"), amount_of(c["v"]).alias("value"), F.coalesce(F.try_element_at(units, _lower(c["k"])), prefix(c)).alias("unit"))).alias("prices"),
    )
    return out.withColumn("way", F.when(F.size("codes") > 0, "explicit").when(F.size("pairs") > 0, "inline").otherwise("unresolved"))


def row_products(read: DataFrame) -> DataFrame:
    """(doc_stem, id, row_no, name, model, sku, description, category, variant_group, way): a product for each code of a
    resolved row. Codes of one row are variants of a group. An inline product is called by its description or its section."""
    group = F.substring(F.sha2(F.to_json(F.struct("id", "headers", "cells")), 256), 1, 16)
    section = F.try_element_at("section_path", F.lit(-1))
    explicit = F.transform("codes", lambda c: F.struct(c.alias("sku"), F.coalesce("description", c).alias("name")))
    inline = F.transform("pairs", lambda p: F.struct(p["code"].alias("sku"), F.coalesce("description", section, F.lit("Catalog item")).alias("name")))
    found = read.where("way <> 'unresolved'").withColumn("_p", F.explode(F.when(F.col("way") == "explicit", explicit).otherwise(inline)))
    path = F.when(F.size("section_path") > 0, breadcrumb("section_path"))
    told = F.when(F.col("way") == "explicit", F.col("description")).when(F.col("_p.name") != "Catalog item", F.col("_p.name"))
    return found.select(*ROW, "_p.name", "model", "_p.sku", told.alias("description"), path.alias("category"), group.alias("variant_group"), "way")


def row_attributes(read: DataFrame) -> DataFrame:
    """(doc_stem, id, row_no, entity, key, value, unit): properties and prices of each code of an explicit row, the price
    next to each code of an inline one."""
    explicit = read.where("way = 'explicit'").select(*ROW, F.explode("codes").alias("entity"), "properties", "prices")
    explicit = explicit.select(*ROW, "entity", F.explode(F.concat("properties", "prices")).alias("a")).select(*ROW, "entity", "a.key", "a.value", "a.unit")
    inline = read.where("way = 'inline'").select(*ROW, F.explode("pairs").alias("p")).select(*ROW, F.col("p.code").alias("entity"), F.lit("Price").alias("key"), F.col("p.amount").alias("value"), F.col("p.currency").alias("unit"))
    return explicit.unionByName(inline)


def hybrid_requests(records: DataFrame, read: DataFrame) -> DataFrame:
    """Evidence left for a model: records whose row is not resolved, with the products already read from their chunk.

    records: doc_stem, chunk_id, id, row_no (null where a record is no table row) and further columns. The first anchors of
    a chunk are all it needs to name them, so they are held as a sorted set of codes, bounded by the chunk's own rows."""
    done = read.where("way <> 'unresolved'").select(*ROW)
    left = records.join(done, ROW, "left_anti")
    resolved = records.select("doc_stem", "chunk_id", "id", "row_no").join(row_products(read).select(*ROW, "name", "sku"), ROW)
    anchors = resolved.groupBy("doc_stem", "chunk_id").agg(F.array_sort(F.collect_set(F.struct("sku", "name"))).alias("product_anchors"))
    return left.join(anchors, ["doc_stem", "chunk_id"], "left")


def with_requests(results: DataFrame, requests: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Results with their requests; a result without a request is an error, as it could not be checked."""
    known = requests.select(key, F.struct(*[c for c in requests.columns if c != key]).alias("request"))
    joined = results.join(known, key, "left")
    checked = F.when(F.col("request").isNull(), F.raise_error(F.concat(F.lit("no request for "), F.coalesce(F.col(key), F.lit("null"))))).otherwise(F.col("request"))
    return joined.withColumn("request", checked)


def with_tables(chunks: DataFrame, parsed: DataFrame) -> DataFrame:
    """Table blocks of chunks with their parsed rows, or their own text as the one row where none were parsed.

    chunks: doc_stem, chunk_id, id, text; parsed: rows of tables.table_rows."""
    raw = [F.lit("raw").alias("method"), F.lit(0).alias("row_no"), F.array(F.lit("raw_text")).alias("headers"), F.array(F.trim("text")).alias("cells")]
    met = chunks.join(parsed, ["doc_stem", "id"], "left_semi").select("doc_stem", "chunk_id", "id").join(parsed, ["doc_stem", "id"])
    rest = chunks.join(parsed, ["doc_stem", "id"], "left_anti").where("trim(text) <> ''").select("doc_stem", "chunk_id", "id", *raw)
    return met.select(rest.columns).unionByName(rest)


# ---------------------------------------------------------------- text layers of pages


def native_pairs(pages: DataFrame, code: str = NATIVE_CODE) -> DataFrame:
    """(doc_stem, page, sku, price, currency): codes with a price behind a dotted leader, before the next code and within
    NATIVE_REACH characters; unpriced mentions are none. pages: doc_stem, page, text."""
    head = rf"(?<![A-Z0-9])(?={code}(?![A-Z0-9]))"
    pieces = pages.select("doc_stem", "page", F.posexplode(F.split("text", head)).alias("_n", "_p"))
    cut = pieces.select("doc_stem", "page", "_n", F.regexp_extract("_p", f"^({code})(?![A-Z0-9])", 1).alias("sku"), "_p").where("sku <> ''")
    tail = F.substr("_p", F.length("sku") + 1, F.lit(NATIVE_REACH))
    first = "(?s)^(.*?)" + NATIVE_PRICE
    found = cut.withColumn("_t", tail).withColumn("_a", F.regexp_extract("_t", first, 3)).where("_a <> ''")
    before = F.regexp_extract("_t", first, 1)
    signs = F.create_map(*[F.lit(x) for pair in tables.SIGN_CURRENCIES.items() for x in pair])
    return found.where(before.contains(".")).select("doc_stem", "page", F.col("_n").alias("place"), "sku", F.col("_a").alias("price"), F.try_element_at(signs, F.regexp_extract("_t", first, 2)).alias("currency"))


def stacked_pairs(pages: DataFrame) -> DataFrame:
    """(doc_stem, page, sku, price): one to three codes on lines of their own above a price."""
    hits = F.arrays_zip(F.regexp_extract_all("text", F.lit(STACKED), F.lit(1)).alias("codes"), F.regexp_extract_all("text", F.lit(STACKED), F.lit(2)).alias("price"))
    rows = pages.select("doc_stem", "page", F.explode(hits).alias("h"))
    return rows.select("doc_stem", "page", F.explode(F.split(F.trim("h.codes"), r"\s*\n\s*")).alias("sku"), F.col("h.price").alias("price")).where("sku <> ''")


def supplement(pairs: DataFrame, products: DataFrame, evidence: DataFrame) -> DataFrame:
    """Native pairs whose code no product of the document has: (doc_stem, page, section_path, sku, price, currency, grp).

    Each code counts once, at its first place. It belongs to the first section on its page whose evidence holds the code, else
    to the page's first section with a path, else to none. Pairs of a page and section are a group, numbered in the
    document. evidence: doc_stem, page, pos, section_path, codes (array of the codes in it)."""
    known = products.select("doc_stem", strip("sku").alias("sku")).where("sku <> ''").distinct()
    new = pairs.join(known, ["doc_stem", "sku"], "left_anti")
    first = new.groupBy("doc_stem", "sku").agg(F.min(F.struct("page", "place", "price", "currency")).alias("p")).select("doc_stem", "sku", "p.*")
    pages = evidence.where("size(section_path) > 0").groupBy("doc_stem", "page").agg(F.min(F.struct("pos", "section_path"))["section_path"].alias("_page_path"))
    exact = evidence.select("doc_stem", "page", "pos", "section_path", F.explode("codes").alias("sku")).groupBy("doc_stem", "page", "sku").agg(F.min(F.struct("pos", "section_path"))["section_path"].alias("_path"))
    met = first.join(exact, ["doc_stem", "page", "sku"], "left").join(pages, ["doc_stem", "page"], "left")
    met = met.withColumn("section_path", F.coalesce("_path", "_page_path", F.array().cast("array<string>")))
    # groups in order of their first code; a document has at most as many as pages and sections
    groups = met.groupBy("doc_stem", "page", "section_path").agg(F.min("place").alias("_at"))
    groups = groups.withColumn("grp", F.row_number().over(Window.partitionBy("doc_stem").orderBy("page", "_at", F.to_json("section_path"))))
    return met.join(groups.drop("_at"), ["doc_stem", "page", "section_path"]).select("doc_stem", "page", "section_path", "sku", "price", "currency", "grp")


def fragment_notes(failed: DataFrame, native: DataFrame) -> DataFrame:
    """Notes on failed replies whose evidence is table rows and whose codes the text layer supplies with prices:
    (doc_stem, chunk_id, code). failed: doc_stem, chunk_id, cells (all of the rows; null if a record is no row)."""
    values = F.filter("cells", lambda v: F.trim(v) != "")
    codes = F.array_distinct(F.flatten(F.transform(values, lambda v: F.regexp_extract_all(v, F.lit(rf"(?<![A-Z0-9])({NATIVE_CODE})(?![A-Z0-9])"), F.lit(1)))))
    rows = failed.where("cells is not null").select("doc_stem", "chunk_id", values.alias("_v"), codes.alias("_c"))
    lone = rows.where(F.size("_c") == 0).where(F.forall("_v", lambda v: F.trim(v).rlike(ORPHAN_PRICE))).select("doc_stem", "chunk_id", F.lit("ORPHANED_PRICE_FRAGMENT").alias("code"))
    asked = rows.where(F.size("_c") > 0).select("doc_stem", "chunk_id", F.explode("_c").alias("sku"))
    known = native.select("doc_stem", "sku", F.lit(True).alias("_known")).distinct()
    met = asked.join(known, ["doc_stem", "sku"], "left").groupBy("doc_stem", "chunk_id").agg(F.bool_and(F.coalesce("_known", F.lit(False))).alias("_all")).where("_all")
    return lone.unionByName(met.select("doc_stem", "chunk_id", F.lit("TABLE_FRAGMENT_RECOVERED_FROM_SOURCE").alias("code")))
