"""Attribute-value rows into a wide table with typed columns.

Log-structured upserts: the rows of each arrival batch become sparse wide deltas (one row per entity, a versioned cell per
attribute), stored as a run sorted by entity; runs are compacted to the latest version of each cell. A batch is read once,
when it arrives: a later one costs its own rows, not those before it. Both steps are aggregations with map-side combine, so
a hot entity is folded before it is shuffled and its batches go to different tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.records import Definitions, definitions, reading
from folioforge.functions.units import common_unit, registered_conversions
from folioforge.operators.references import trimmed
from folioforge.runtime import drop_path, list_paths, scratch_path, table

VALUE = {"number": "number", "integer": "whole", "boolean": "flag", "text": "text"}
SPARK_TYPE = {"number": "double", "integer": "bigint", "boolean": "boolean", "text": "string"}
ENTITY, VERSION = ["doc_stem", "entity"], ["extracted_at", "attr_id"]
COLUMNS = ["attr_id", "doc_stem", "entity", "key", "value", "unit", "extracted_at", "ingested_at"]


def attribute_conversions(spark: SparkSession, defs: Definitions) -> DataFrame:
    """(attr_name, quantity, unit, common_unit, scale, offset) to the common unit of each measured attribute; as large as
    the registers of units and attributes. The compositions are those checked around every cycle."""
    to_target: dict = {}
    for quantity, source, target, scale, offset, _ in registered_conversions():
        to_target.setdefault((quantity, target), []).append((source, scale, offset))
    rows = []
    for attr, (quantity, unit, kind) in defs.kinds.items():
        target = common_unit(quantity, unit) if kind == "number" and quantity and unit else None
        rows += [(attr, quantity, source, unit, scale, offset) for source, scale, offset in to_target.get((quantity, target), ())]
    return spark.createDataFrame(rows, "attr_name string, quantity string, unit string, common_unit string, scale double, offset double").coalesce(1)


def in_range(number: Column) -> Column:
    """The number, or null where it is beyond the range of a double."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def read_attributes(spark: SparkSession, attributes: DataFrame, defs: Definitions) -> DataFrame:
    """Adds what each row states; amounts come in the common unit of their attribute."""
    read = attributes.withColumn("entity", trimmed("entity")).where("entity <> ''").withColumn("r", reading(defs, F.col("key"), F.col("value"), F.col("unit")))
    kept = [c for c in attributes.columns if c not in ("key", "value", "unit")]
    read = read.where("r.attr_name is not null and (r.number is not null or r.text is not null or r.flag is not null or r.whole is not null)").select(*kept, "r.*")
    conversions = attribute_conversions(spark, defs).select("attr_name", "unit", "scale", "offset")
    return (
        read.join(F.broadcast(conversions), ["attr_name", "unit"], "left")
        .withColumn("number", in_range(F.when(F.col("scale").isNotNull(), F.col("number") * F.col("scale") + F.col("offset")).otherwise(F.col("number"))))
        .drop("scale", "offset")
    )


def cell(attr: str, kind: str, version: list[str]) -> Column:
    value = F.col(VALUE[kind]).cast(SPARK_TYPE[kind]).alias("value")
    return F.when((F.col("attr_name") == attr) & value.isNotNull(), F.struct(*version, value))


def deltas(rows: DataFrame, defs: Definitions, entity: list[str], batch: Column, version: list[str]) -> DataFrame:
    """One sparse wide row per entity and batch: for each attribute the batch's latest version, or null."""
    cells = [F.max(cell(a, k, version)).alias(a) for a, (_, _, k) in defs.kinds.items()]
    return rows.groupBy(*entity, batch.alias("_batch")).agg(*cells)


def compact(runs: DataFrame, defs: Definitions, entity: list[str]) -> DataFrame:
    """Merges runs of deltas to the latest version of each cell."""
    return runs.groupBy(*entity).agg(*[F.max(a).alias(a) for a in defs.kinds])


def plain(cells: DataFrame, defs: Definitions) -> DataFrame:
    return cells.select(*ENTITY, *[F.col(a)["value"].alias(a) for a in defs.kinds])


class CellStore:
    """Runs of versioned cells below a folder all executors see.

    apply() adds a batch as one sorted run, compact() replaces the runs by one, wide() is the table as of now. Versions
    decide, not arrival: a late batch does not overwrite newer cells, and a batch applied twice changes nothing. A run
    counts once its folder is complete; as merging a cell twice gives the same cell, a compaction that ends between
    writing the new run and deleting the old ones loses nothing and counts nothing twice. One writer compacts at a time.
    """

    def __init__(self, spark: SparkSession, path: str, defs: Definitions):
        self.spark, self.path, self.defs = spark, path.rstrip("/"), defs
        cells = [f"`{a}` struct<extracted_at:timestamp_ntz,attr_id:bigint,value:{SPARK_TYPE[k]}>" for a, (_, _, k) in defs.kinds.items()]
        self.schema = ", ".join(["doc_stem string", "entity string", *cells])

    def runs(self) -> list[str]:
        return [p for p in list_paths(self.spark, self.path) if list_paths(self.spark, f"{p}/_SUCCESS")]

    def read(self, runs: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*runs) if runs else self.spark.createDataFrame([], self.schema)

    def write(self, cells: DataFrame) -> str:
        run = f"{self.path}/run-{uuid.uuid4().hex}"
        version = lambda a: F.struct(F.col(a)["extracted_at"].cast("timestamp_ntz").alias("extracted_at"), F.col(a)["attr_id"].cast("bigint").alias("attr_id"), F.col(a)["value"].alias("value"))
        cells.select(*ENTITY, *[F.when(F.col(a).isNotNull(), version(a)).alias(a) for a in self.defs.kinds]).sortWithinPartitions(*ENTITY).write.parquet(run)
        return run

    def apply(self, attributes: DataFrame) -> str:
        """Stores a batch of attribute rows as a run; gives its folder. Months of arrival inside a batch are folded apart,
        so a hot entity of a large batch is spread over tasks."""
        rows = read_attributes(self.spark, attributes.select(*COLUMNS), self.defs)
        return self.write(deltas(rows, self.defs, ENTITY, F.date_trunc("month", "ingested_at"), VERSION).drop("_batch"))

    def compact(self) -> str | None:
        """Merges all runs into one; none are left as they are."""
        old = self.runs()
        if len(old) < 2:
            return old[0] if old else None
        run = self.write(compact(self.read(old), self.defs, ENTITY))
        for path in old:
            drop_path(self.spark, path)
        return run

    def wide(self) -> DataFrame:
        """One row per entity with the latest value of each cell. The runs must stay until the result is read."""
        return plain(compact(self.read(self.runs()), self.defs, ENTITY), self.defs)


def wide_table(spark: SparkSession, attributes: DataFrame, defs_df: DataFrame) -> DataFrame:
    """One row per (doc_stem, entity) with one typed column per attribute of defs_df.

    Null and blank entities, keys that mean no attribute and values that are none of the attribute's type are left out;
    an entity left with no cell has no row. Numbers beyond the range of a double, and whole numbers beyond that of bigint,
    fit no column and are no values; all others are exact. Of contradicting rows the one extracted last counts, then the
    one of the highest attr_id; deliveries of the same row are the same version. Extra columns are ignored. Empty tables
    give no rows. The batch is stored as a run of a store of its own, which ends with the session.
    """
    defs = definitions(defs_df)
    if not defs.kinds:  # no attributes, no columns and no cells
        return attributes.select("doc_stem", "entity").where(F.lit(False))
    store = CellStore(spark, scratch_path(spark, "cells"), defs)
    store.apply(attributes)
    return store.wide()


def attribute_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_table(spark, table(spark, sf_dir, "retry_attributes"), table(spark, sf_dir, "attribute_defs"))


def filled_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_stem, entity, attr_name) of the cells of the wide table that hold a value."""
    wide = attribute_wide(spark, sf_dir)
    names = [c for c in wide.columns if c not in ("doc_stem", "entity")]
    filled = F.filter(F.array(*[F.when(F.col(f"`{n}`").isNotNull(), F.lit(n)) for n in names]).cast("array<string>"), lambda x: x.isNotNull())
    return wide.select("doc_stem", "entity", F.explode(filled).alias("attr_name"))
