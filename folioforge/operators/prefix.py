"""Running values over documents of any size.

A window over a whole document puts it into one task. Here the running value is taken per page, and what earlier pages
carry over comes from a window over pages; a hot document is spread over its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(df: DataFrame, doc: list[str], page: str, order: list, values: dict[str, Column], how: str = "max") -> DataFrame:
    """Adds for each value its running maximum (or sum) from the document's start to the row, the row included.

    Rows are ordered by page and then by order; nulls are skipped. A null page is page 0."""
    combine = {"max": F.max, "sum": F.sum}[how]
    df = df.withColumn("_page", F.coalesce(F.col(page), F.lit(0)))
    for name, value in values.items():
        df = df.withColumn(f"_v_{name}", value)
    pages = df.groupBy(*doc, "_page").agg(*[combine(f"_v_{n}").alias(f"_t_{n}") for n in values])
    before = Window.partitionBy(*doc).orderBy("_page").rowsBetween(Window.unboundedPreceding, -1)
    carried = pages.select(*doc, "_page", *[combine(f"_t_{n}").over(before).alias(f"_c_{n}") for n in values])
    inside = Window.partitionBy(*doc, "_page").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.join(carried, [*doc, "_page"], "left")
    for name in values:
        here, earlier = combine(f"_v_{name}").over(inside), F.col(f"_c_{name}")
        # in-page values come later than carried ones, and a maximum of positions prefers the later by itself
        total = F.greatest(here, earlier) if how == "max" else F.coalesce(here, F.lit(0)) + F.coalesce(earlier, F.lit(0))
        out = out.withColumn(name, total)
    return out.drop("_page", *[f"_v_{n}" for n in values], *[f"_c_{n}" for n in values])


def neighbour(df: DataFrame, doc: list[str], page: str, order: list, value: Column, name: str) -> DataFrame:
    """Adds the value of the previous row of the document, over page ends; null for the first row."""
    df = df.withColumn("_page", F.coalesce(F.col(page), F.lit(0))).withColumn("_nb_value", F.struct(value.alias("v")))
    inside = Window.partitionBy(*doc, "_page").orderBy(*order)
    df = df.withColumn("_nb_prev", F.lag("_nb_value").over(inside)).withColumn("_nb_last", F.lead("_nb_value").over(inside).isNull())
    ends = df.where("_nb_last").select(*doc, "_page", F.col("_nb_value").alias("_nb_end"))
    over = Window.partitionBy(*doc).orderBy("_page")
    ends = ends.select(*doc, "_page", F.lag("_nb_end").over(over).alias("_nb_end"))
    return df.join(ends, [*doc, "_page"], "left").withColumn(name, F.coalesce("_nb_prev", "_nb_end")["v"]).drop("_page", "_nb_value", "_nb_prev", "_nb_last", "_nb_end")
