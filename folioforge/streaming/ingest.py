"""Pages as they arrive: a file stream through the same operators as the tables. An extension, bounded by its watermark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from folioforge.operators.layout import heading_level, page_blocks, semantic_type


def page_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 16) -> DataFrame:
    """Parquet files of recognized pages, so many per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def typed_blocks(pages: DataFrame) -> DataFrame:
    """Blocks of the pages with type and level; works on tables and streams alike, without state."""
    b = page_blocks(pages)
    return b.withColumn("type", semantic_type("label", "text")).withColumn("level", F.when(F.col("type") == "heading", heading_level("label", "text")))


def page_counts(pages: DataFrame, lateness: str = "1 day", width: str = "1 hour") -> DataFrame:
    """Pages and documents per arrival window; pages later than the watermark are left out and state before it is dropped."""
    timed = pages.withColumn("at", F.col("ingested_at").cast("timestamp")).withWatermark("at", lateness)
    return timed.groupBy(F.window("at", width).alias("w")).agg(F.count(F.lit(1)).alias("pages"), F.approx_count_distinct("doc_stem").alias("documents")).select("w.start", "w.end", "pages", "documents")


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Processes what has arrived and stops; the checkpoint makes a later call go on from there."""
    query = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def recognized(pages: DataFrame, engine: Callable[[list], list], schema: str, batch: int = 16) -> DataFrame:
    """Pages through a recognition engine, so many at a time: the pages' key columns doc_stem and page and the engine's result
    as result (of the schema given). pages: doc_stem, page and payload.

    The engine gets payloads in order and must give a result for each; fewer or more are an error, as no result could be
    told to its page. A task holds one batch. Works on tables and streams alike."""
    out = T.StructType([*pages.select("doc_stem", "page").schema.fields, T.StructField("result", T._parse_datatype_string(schema))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                results = engine(part["payload"].tolist())
                if len(results) != len(part):
                    raise ValueError(f"{len(results)} results for {len(part)} pages")
                yield pd.DataFrame({"doc_stem": part["doc_stem"].to_numpy(), "page": part["page"].to_numpy(), "result": pd.Series(results, dtype=object)})

    return pages.select("doc_stem", "page", "payload").mapInPandas(run, out)


def progress(query: StreamingQuery) -> list[dict]:
    """Rows and duration of each micro-batch."""
    return [{"batch": p["batchId"], "rows": p["numInputRows"], "ms": p["durationMs"].get("triggerExecution")} for p in query.recentProgress]
