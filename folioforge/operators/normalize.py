"""Extracted records to one record per identity.

List order matters in these merges (the first value wins), so every record carries its id as its place. Groups are folded
by aggregations with map-side combine; only distinct values of a group are ever brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.text import clean, col, strip, title_case, value_unit
from folioforge.runtime import cut, release

IDENTITY = ["doc_stem", "kind", "ident"]


def filled(c: str | Column) -> Column:
    """The stripped text, null if it is blank."""
    return F.when(strip(c) != "", strip(c))


def identified(products: DataFrame) -> DataFrame:
    """Adds kind ('sku' or 'name') and ident: the code where there is one, else cleaned name and model."""
    by_name = F.concat_ws("\x1f", clean("name"), F.coalesce(strip("model"), F.lit("")))
    sku = filled("sku")
    return products.withColumn("kind", F.when(sku.isNotNull(), "sku").otherwise("name")).withColumn("ident", F.coalesce(sku, by_name))


def first_by(value: Column, place: str) -> Column:
    """Aggregate: the value of the lowest place among those that are not null."""
    return F.min(F.when(value.isNotNull(), F.struct(F.col(place).alias("p"), value.alias("v"))))["v"]


def merge_texts(texts: Column) -> Column:
    """Folds texts in order: one that holds the other replaces it, others are appended as paragraphs."""
    step = lambda a, d: F.when(a.isNull() | d.contains(a), d).when(a.contains(d), a).otherwise(F.concat(a, F.lit("\n\n"), d))
    return F.aggregate(texts, F.lit(None).cast("string"), step)


def merge_products(products: DataFrame, place: str = "product_id") -> DataFrame:
    """One row per product identity of a document: name, model, category, description, chunks, first_chunk, categories.

    The first non-null value wins; descriptions are folded together; chunks and categories are counted. Products without
    code and name are left out. Repeated records change nothing."""
    rows = identified(products).where("ident <> '\x1f'")
    heads = rows.groupBy(*IDENTITY).agg(
        first_by(clean("name"), place).alias("name"), first_by(filled("model"), place).alias("model"), first_by(F.nullif(clean("category"), F.lit("")), place).alias("category"),
        first_by(F.col("variant_group"), place).alias("variant_group"), first_by(F.col("chunk_id"), place).alias("first_chunk"),
    )
    # distinct values first, so a hot identity reaches the second step folded
    chunks = rows.groupBy(*IDENTITY, "chunk_id").agg(F.lit(1).alias("x")).groupBy(*IDENTITY).agg(F.count("chunk_id").alias("chunks"))
    categories = rows.where("category is not null").groupBy(*IDENTITY, clean("category").alias("c")).agg(F.lit(1).alias("x")).groupBy(*IDENTITY).agg(F.count("c").alias("categories"))
    texts = rows.where("description is not null").groupBy(*IDENTITY, "description").agg(F.min(place).alias("p"))
    texts = texts.groupBy(*IDENTITY).agg(merge_texts(F.transform(F.array_sort(F.collect_list(F.struct("p", "description"))), lambda s: s["description"])).alias("description"))
    return heads.join(chunks, IDENTITY).join(texts, IDENTITY, "left").join(categories, IDENTITY, "left").na.fill(0, ["categories"])


def product_sources(products: DataFrame, place: str = "product_id") -> DataFrame:
    """(identity, source, value, rank): the chunks, categories and evidence blocks of each product identity, each once, in the
    order of their first record. As rows, so an identity with very many sources is no row of its own.

    products: with source_evidence (array of page and block_id). Blank categories and null chunks are no sources."""
    rows = identified(products).where("ident <> '\x1f'")
    block = F.transform(F.coalesce("source_evidence", F.array().cast("array<struct<page:int,block_id:string>>")), lambda e: F.concat_ws(":", e["page"].cast("string"), e["block_id"]))
    stated = F.array(
        F.struct(F.lit("chunk").alias("source"), F.array("chunk_id").alias("values")),
        F.struct(F.lit("category").alias("source"), F.array(F.nullif(clean("category"), F.lit(""))).alias("values")),
        F.struct(F.lit("evidence").alias("source"), block.alias("values")),
    )
    each = rows.select(*IDENTITY, place, F.explode(stated).alias("s")).select(*IDENTITY, place, "s.source", F.posexplode("s.values").alias("_n", "value")).where("value is not null")
    first = each.groupBy(*IDENTITY, "source", "value").agg(F.min(F.struct(place, "_n")).alias("_f"))
    order = Window.partitionBy(*IDENTITY, "source").orderBy("_f", "value")
    return first.select(*IDENTITY, "source", "value", F.row_number().over(order).alias("rank"))


def normalized_attributes(attributes: DataFrame) -> DataFrame:
    """Keys in title case, measurements split into number and canonical unit; a given unit that contradicts the measured one is kept and marked.

    Keys that name codes keep their values as they are."""
    key = title_case(clean("key"))
    measure = F.when(~F.lower(key).isin("sku", "model", "part number", "article number", "description", "thread size"), value_unit(clean("value")))
    from folioforge.functions.text import unit_alias

    given = F.when(clean("unit") != "", F.coalesce(unit_alias(clean("unit")), F.lower(clean("unit"))))
    return (
        attributes.withColumn("key_norm", key).withColumn("_m", measure).withColumn("_u", given)
        .withColumn("unit_norm", F.coalesce("_u", F.col("_m.unit")))
        .withColumn("number", F.col("_m.value"))
        .withColumn("value_norm", F.when(F.col("_m").isNotNull(), F.col("_m.value").cast("string")).otherwise(clean("value")))
        .withColumn("conflict", F.coalesce(F.col("_u") != F.col("_m.unit"), F.lit(False)))
        .drop("_m", "_u")
    )


def first_of_each(df: DataFrame, keys: list[str], place: str) -> DataFrame:
    """The row of the lowest place for each key, nulls being equal; folded before it is shuffled."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(F.col(place).alias("_p"), *rest)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}") for c in rest])


def unique_alias(products: DataFrame) -> DataFrame:
    """(doc_stem, alias, owner): aliases (names and codes) that stand for exactly one canonical name."""
    names = identified(products)
    canonical = names.groupBy(*IDENTITY).agg(first_by(clean("name"), "product_id").alias("owner"))
    both = names.join(canonical, IDENTITY).select("doc_stem", F.explode(F.array("name", filled("sku"))).alias("alias"), "owner").where("alias is not null and alias <> ''")
    return both.groupBy("doc_stem", "alias").agg(F.min("owner").alias("owner"), F.max("owner").alias("_other")).where("owner = _other").drop("_other")


def variant_components(products: DataFrame) -> DataFrame:
    """(doc_stem, variant_group, root): groups linked by shared codes get the smallest group linked to them.

    Labels spread over codes, halving the distance by following roots, until none changes."""
    edges = cut(products.where("variant_group is not null and trim(sku) <> ''").select("doc_stem", "variant_group", strip("sku").alias("sku")).distinct(), "variants")
    labels = cut(edges.select("doc_stem", "variant_group").distinct().withColumn("root", F.col("variant_group")), "labels")
    while True:
        low = edges.join(labels, ["doc_stem", "variant_group"]).groupBy("doc_stem", "sku").agg(F.min("root").alias("root"))
        near = edges.join(low, ["doc_stem", "sku"]).groupBy("doc_stem", "variant_group").agg(F.min("root").alias("new"))
        jump = labels.select("doc_stem", F.col("variant_group").alias("new"), F.col("root").alias("far"))
        new = near.join(jump, ["doc_stem", "new"], "left").join(labels, ["doc_stem", "variant_group"])
        new = cut(new.select("doc_stem", "variant_group", F.least("root", "new", "far").alias("root"), (F.least("new", "far") < F.col("root")).alias("moved")), "labels")
        release(labels)
        labels = new.drop("moved")
        labels._folioforge_path = new._folioforge_path
        if new.where("moved").isEmpty():
            return labels


def resolve_owner(attributes: DataFrame, products: DataFrame) -> DataFrame:
    """Adds owner_ident: the product whose code is the entity, else the one product of that name, else null."""
    rows = identified(products).select(*IDENTITY, F.lower(clean("name")).alias("low")).distinct()
    by_code = rows.where("kind = 'sku'").select("doc_stem", F.col("ident").alias("_e"), F.col("ident").alias("by_code")).distinct()
    by_name = rows.where("low <> ''").groupBy("doc_stem", F.col("low").alias("_n")).agg(F.min("ident").alias("by_name"), F.max("ident").alias("_x")).where("by_name = _x").drop("_x")
    out = attributes.withColumn("_e", strip("entity")).withColumn("_n", F.lower(clean("entity")))
    return out.join(by_code, ["doc_stem", "_e"], "left").join(by_name, ["doc_stem", "_n"], "left").withColumn("owner_ident", F.coalesce("by_code", "by_name")).drop("_e", "_n", "by_code", "by_name")


def item_attributes(products: DataFrame, attributes: DataFrame) -> DataFrame:
    """(doc_stem, ident, attr_id, key, value): attributes of an item by its code or its name; the two ways are two equi-joins, never an OR."""
    items = identified(products).groupBy(*IDENTITY).agg(first_by(clean("name"), "product_id").alias("name"))
    attrs = attributes.select("doc_stem", strip("entity").alias("entity"), "attr_id", "key", "value")
    by_code = items.where("kind = 'sku'").select("doc_stem", "ident", F.col("ident").alias("entity"))
    by_name = items.select("doc_stem", "ident", F.col("name").alias("entity"))
    return by_code.unionByName(by_name).distinct().join(attrs, ["doc_stem", "entity"]).select("doc_stem", "ident", "attr_id", "key", "value").distinct()


def property_lists(rows: DataFrame, owner: list[str]) -> DataFrame:
    """One row per owner and key with its distinct values in order of appearance."""
    once = rows.groupBy(*owner, "key", "value").agg(F.min("attr_id").alias("p"))
    return once.groupBy(*owner, "key").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "value"))), lambda s: s["value"]).alias("values"))


def upsert(found: DataFrame, existing: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Full outer merge: existing values stay where they are filled, found ones fill the rest; origin tells which side had the key."""
    a = existing.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(True).alias("_a"))
    b = found.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(True).alias("_b"))
    origin = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "kept").otherwise("merged")
    return a.join(b, keys, "full").select(*keys, *[F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns], origin.alias("origin"))


def seeded_sample(df: DataFrame, group: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows of each group, chosen by a seeded hash: the same for any partitioning. Two steps keep a hot group spread."""
    h = F.md5(F.concat_ws("\x1f", F.lit(str(seed)), F.col(key).cast("string")))
    part = F.pmod(F.xxhash64(F.col(key)), F.lit(64))
    near = df.withColumn("_h", h).withColumn("_part", part)
    w1 = Window.partitionBy(group, "_part").orderBy("_h", key)
    w2 = Window.partitionBy(group).orderBy("_h", key)
    return near.withColumn("_n", F.row_number().over(w1)).where(F.col("_n") <= n).withColumn("_n", F.row_number().over(w2)).where(F.col("_n") <= n).drop("_h", "_part", "_n")
