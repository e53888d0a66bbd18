"""Writing results so that readers see whole runs only."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(df: DataFrame, path: str):
    sc = df.sparkSession.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ("doc_stem",), keep: bool = True) -> str:
    """Writes df beside path, moves what is there aside, and puts the new result in its place by renaming. Gives the path.

    The states of a run are rows of '<path>.status': running, then complete or failed. A run that fails leaves the old
    result in its place: also one that fails between the two renames, which moves it back. keep: the old result stays
    under '<path>.previous'; the one before it goes only once the new one is in place."""
    run = uuid.uuid4().hex
    staged, aside = f"{path}.staged-{run}", f"{path}.aside-{run}"
    record_status(df.sparkSession, path, run, "running")
    fs, target = _fs(df, path)
    at = lambda p: _fs(df, p)[1]
    try:
        writer = df.write.format(fmt)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(staged)
        had = fs.exists(target)
        if had and not fs.rename(target, at(aside)):
            raise OSError(f"cannot move {path} aside")
        try:
            if not fs.rename(at(staged), target):
                raise OSError(f"cannot put {staged} in place")
        except Exception:
            if had:
                fs.rename(at(aside), target)
            raise
        if had:
            previous = at(f"{path}.previous")
            fs.delete(previous, True)
            if keep:
                fs.rename(at(aside), previous)
            else:
                fs.delete(at(aside), True)
    except Exception as e:
        fs.delete(at(staged), True)
        record_status(df.sparkSession, path, run, "failed", str(e)[:500])
        raise
    record_status(df.sparkSession, path, run, "complete")
    return path


STATUS = "run string, state string, detail string, recorded timestamp"


def record_status(spark: SparkSession, path: str, run: str, state: str, detail: str | None = None) -> None:
    """One row more in the status table of a result."""
    row = spark.createDataFrame([(run, state, detail)], "run string, state string, detail string")
    row.withColumn("recorded", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}.status")


def last_status(spark: SparkSession, path: str) -> DataFrame:
    """(run, state, detail, recorded): the last state of each run that wrote a result."""
    rows = spark.read.schema(STATUS).parquet(f"{path}.status")
    done = F.max(F.struct((F.col("state") != "running").alias("ended"), "recorded", "state", "detail")).alias("s")
    return rows.groupBy("run").agg(done).select("run", "s.state", "s.detail", "s.recorded")


def reusable(saved: DataFrame, requests: DataFrame) -> DataFrame:
    """Saved extractions (doc_stem, chunk_id, place and more) of the documents whose chunks are the same, in the same order,
    as those of requests (doc_stem, chunk_id, place): all others must be extracted again.

    Sequences are compared by their number and two sums of hashes of (place, id), so no sequence is collected."""

    def prints(df: DataFrame) -> DataFrame:
        once = df.select("doc_stem", "chunk_id", "place").distinct()
        sums = [F.sum(F.xxhash64(F.lit(seed), "place", "chunk_id").cast("decimal(38,0)")).alias(f"_s{seed}") for seed in (1, 2)]
        return once.groupBy("doc_stem").agg(F.count(F.lit(1)).alias("_n"), *sums)

    same = prints(saved).join(prints(requests), ["doc_stem", "_n", "_s1", "_s2"], "left_semi").select("doc_stem")
    return saved.join(same, "doc_stem", "left_semi")


def write_json(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("doc_stem",)) -> str:
    return publish(df, path, "json", partition_by)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> tuple[str, str]:
    """Node and edge tables; both are sets, so writing them again changes nothing."""
    return publish(nodes, f"{path}/nodes", partition_by=("label",)), publish(edges, f"{path}/edges", partition_by=("rel",))
