"""Quantities recorded in different units, brought to common units.

Conversions are edges of a graph with affine functions. Their shortest compositions are computed once, checked for
consistency around every cycle, and stored as a small table; all values are then converted by an equi-join on the source
unit and the canonical target. Units are found wherever they are written (folioforge.functions.records).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.records import definitions, reading
from folioforge.operators.references import trimmed
from folioforge.operators.widetable import attribute_conversions, in_range
from folioforge.runtime import table

#: Amounts agree if they differ by this share of the larger at most.
TOLERANCE = 0.005
#: Slack of the band join, far above rounding errors and far below the tolerance.
SLACK = 1e-9
#: Bands are so many tolerances wide: wider ones repeat fewer rows at their edges, narrower ones compare fewer.
BAND_WIDTH = 2


def measured_attributes(spark: SparkSession, attributes: DataFrame, defs_df: DataFrame) -> DataFrame:
    """Every record that states an amount: attr_id, doc_stem, entity, attr_name, number, unit, amount, common_unit.

    Records that state no number, or no unit in value, unit or key, have no amount and no row; nor have amounts beyond the
    range of a double, before or after conversion. Repeated deliveries keep their rows; null and blank entities are kept
    here. Empty tables give no rows.
    """
    defs = definitions(defs_df)
    wanted = attribute_conversions(spark, defs)
    return (
        attributes.select("attr_id", "doc_stem", trimmed("entity").alias("entity"), reading(defs, F.col("key"), F.col("value"), F.col("unit")).alias("r"))
        .select("attr_id", "doc_stem", "entity", "r.attr_name", "r.number", "r.unit")
        .where("number is not null and unit is not null")
        .join(F.broadcast(wanted.drop("quantity")), ["attr_name", "unit"])
        .withColumn("amount", in_range(F.col("number") * F.col("scale") + F.col("offset")))
        .where("amount is not null")
        .select("attr_id", "doc_stem", "entity", "attr_name", "number", "unit", "amount", "common_unit")
    )


def place(amount: Column) -> Column:
    """Logarithmic place, in tolerances: amounts that agree lie less than one apart. Zeros have a place of their own."""
    width = -math.log(1 - TOLERANCE) * (1 + SLACK)
    return F.when(amount == 0, F.lit(-1e9)).otherwise(F.log(F.abs(amount)) / F.lit(width))


def agreeing_pairs(amounts: DataFrame, group: list[str]) -> DataFrame:
    """(attr_id_a, attr_id_b): records of one group that state agreeing amounts in different units.

    A band join: each record has a home in the band of its amount and visits it, and the band below where that is less
    than a tolerance away, to meet amounts that are not larger. A hot group is spread over its bands. Which units a band
    holds is aggregated first (never more than the unit register has), so a record visits only bands with another unit,
    once for each, and records of the same unit never meet, however often a value is repeated. Zeros agree with zeros
    only. Null, infinite and undefined amounts, and nulls in a group column, make no pair; repeated records count once.
    """
    rows = amounts.where(" and ".join(f"{g} is not null" for g in group)).where(F.abs("amount") < F.lit(float("inf"))).select("attr_id", *group, "unit", "amount").dropDuplicates(["attr_id"])
    at = place(F.col("amount"))
    rows = rows.withColumn("_sign", F.signum("amount").cast("int")).withColumn("_place", at).withColumn("_band", F.floor(F.col("_place") / BAND_WIDTH))
    band = [*group, "_sign", "_band"]
    home = rows.select(*band, *[F.col(c).alias(f"{c}_h") for c in ("attr_id", "unit", "amount")])
    units = rows.groupBy(*band).agg(F.collect_set("unit").alias("_units"))
    near_edge = F.col("_place") - F.col("_band") * BAND_WIDTH < 1 + 2 * SLACK
    bands = F.when(near_edge, F.array(F.col("_band"), F.col("_band") - 1)).otherwise(F.array("_band"))
    visits = rows.select(*group, "_sign", F.explode(bands).alias("_band"), *[F.col(c).alias(f"{c}_v") for c in ("attr_id", "unit", "amount")])
    visits = visits.join(units, band).select(*band, "attr_id_v", "unit_v", "amount_v", F.explode(F.array_remove("_units", F.col("unit_v"))).alias("unit_h"))
    low, high = F.abs("amount_h"), F.abs("amount_v")
    return (
        home.join(visits, [*band, "unit_h"])
        .where((low < high) | ((low == high) & (F.col("unit_h") < F.col("unit_v"))))
        .where(high - low <= F.lit(TOLERANCE * (1 + SLACK)) * high)
        .select(F.least("attr_id_h", "attr_id_v").alias("attr_id_a"), F.greatest("attr_id_h", "attr_id_v").alias("attr_id_b"))
    )


def common_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each measured record once, in the common unit of its attribute."""
    return measured_attributes(spark, table(spark, sf_dir, "retry_attributes"), table(spark, sf_dir, "attribute_defs")).dropDuplicates(["attr_id"])


def equal_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measured_attributes(spark, table(spark, sf_dir, "retry_attributes"), table(spark, sf_dir, "attribute_defs"))
    return agreeing_pairs(rows.where("entity <> ''"), ["doc_stem", "entity", "attr_name"])
