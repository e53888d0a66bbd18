"""The catalog: categories, models and items, their tree, evaluation and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.text import breadcrumb, split_breadcrumb, stable_id, strip
from folioforge.operators.normalize import identified

UNCLASSIFIED = "Unclassified Products"


def model_key() -> Column:
    """What puts items under one model: the model, else the variant group, else the code, else the name."""
    ways = (("model", "model"), ("row", "variant_group"), ("code", "sku"), ("name", "name"))
    return F.coalesce(*[F.when(strip(c) != "", F.concat(F.lit(f"{k}\x1f"), strip(c))) for k, c in ways])


def catalog_items(products: DataFrame) -> DataFrame:
    """(doc_stem, model_key, item, path, title, item_id): each item once; a model stands where its first item stands."""
    category = F.when(strip("category") != "", F.col("category")).otherwise(F.lit(UNCLASSIFIED))
    rows = identified(products).withColumn("model_key", model_key()).withColumn("path", split_breadcrumb(category)).where("model_key is not null")
    home = rows.groupBy("doc_stem", "model_key").agg(F.min(F.struct("product_id", "path")).alias("h"))
    items = rows.groupBy("doc_stem", "model_key", F.col("ident").alias("item")).agg(F.min(F.struct("product_id", "name")).alias("f"))
    return items.join(home, ["doc_stem", "model_key"]).select("doc_stem", "model_key", "item", F.col("h.path").alias("path"), F.col("f.name").alias("title"), stable_id("SI", "doc_stem", "model_key", "item").alias("item_id"))


def category_nodes(items: DataFrame) -> DataFrame:
    """(doc_stem, depth, path, title, identifier, items): every category and, at depth 0, the document, with the items below it."""
    full = F.concat(F.array("doc_stem"), F.col("path"))
    rows = items.select("doc_stem", full.alias("full")).withColumn("depth", F.explode(F.sequence(F.lit(0), F.size("full") - 1)))
    nodes = rows.withColumn("path", F.slice("full", F.lit(1), F.col("depth") + 1)).groupBy("doc_stem", "depth", "path").agg(F.count(F.lit(1)).alias("items"))
    return nodes.select("doc_stem", "depth", breadcrumb("path").alias("path"), F.element_at("path", -1).alias("title"), stable_id("PC", F.concat_ws("\x1f", "path")).alias("identifier"), "items")


def catalog_tree(items: DataFrame) -> DataFrame:
    """One row per document and category with its models and their items nested, for a JSON sink.

    Nesting collects what one category of one document holds, which is what the sink writes as one record."""
    models = items.groupBy("doc_stem", "path", "model_key").agg(F.array_sort(F.collect_list(F.struct("item", "title", "item_id"))).alias("sellable_items"))
    return models.groupBy("doc_stem", "path").agg(F.array_sort(F.collect_list(F.struct("model_key", "sellable_items"))).alias("models"))


def flatten_tree(tree: DataFrame) -> DataFrame:
    """The items of nested categories again, with their path."""
    models = tree.select("doc_stem", "path", F.explode("models").alias("m"))
    return models.select("doc_stem", "path", "m.model_key", F.explode("m.sellable_items").alias("i")).select("doc_stem", breadcrumb("path").alias("category"), "model_key", "i.item", "i.title", "i.item_id")


def evaluate(products: DataFrame, attributes: DataFrame) -> DataFrame:
    """Counts per document; products and attributes are folded apart, so neither multiplies the other."""
    p = identified(products).groupBy("doc_stem").agg(
        F.count_distinct("kind", "ident").alias("items"), F.count_distinct(F.when(F.col("kind") == "sku", F.col("ident"))).alias("article_numbers"),
        F.count_distinct("model").alias("models"), F.count_distinct("category").alias("categories"), F.count_distinct("chunk_id").alias("chunks"),
    )
    a = attributes.groupBy("doc_stem").agg(F.count(F.lit(1)).alias("attributes"), F.count_distinct("key").alias("keys"))
    return p.join(a, "doc_stem", "full").na.fill(0)


def search(products: DataFrame, query: str) -> DataFrame:
    """Products whose code, name, description, model or category holds the query, whatever its case; all for a blank one."""
    q = query.strip().lower()
    fields = F.lower(F.concat_ws(" ", "sku", "name", "description", "model", "category"))
    return products if not q else products.where(fields.contains(q))


PRODUCT = "product_id bigint, doc_stem string, chunk_id string, name string, model string, sku string, category string, description string, variant_group string"
ATTRIBUTE = "attr_id bigint, doc_stem string, chunk_id string, entity string, key string, value string, unit string, location string"


class Catalog:
    """Read access to published catalog tables."""

    def __init__(self, products: DataFrame, attributes: DataFrame):
        self.products, self.attributes = products, attributes

    @classmethod
    def load(cls, spark: SparkSession, path: str, fmt: str = "json") -> Catalog:
        """The published tables products and attributes below a path. Records that cannot be read are left out."""

        def read(name: str, schema: str) -> DataFrame:
            reader = spark.read.schema(schema)
            return reader.option("mode", "DROPMALFORMED").json(f"{path}/{name}") if fmt == "json" else reader.format(fmt).load(f"{path}/{name}")

        return cls(read("products", PRODUCT), read("attributes", ATTRIBUTE))

    def catalogs(self) -> DataFrame:
        return self.products.select("doc_stem").distinct()

    def catalog(self, stem: str) -> DataFrame:
        """Items of one catalog; a LookupError if there is no such catalog."""
        own = self.products.where(F.col("doc_stem") == stem)
        if own.isEmpty():
            raise LookupError(f"no catalog {stem!r}")
        return catalog_items(own)

    def search(self, stem: str, query: str) -> DataFrame:
        self.catalog(stem)
        return search(self.products.where(F.col("doc_stem") == stem), query)

    def metrics(self) -> DataFrame:
        return evaluate(self.products, self.attributes)

    def health(self) -> dict:
        return {"status": "ok", "catalogs": self.catalogs().count()}
