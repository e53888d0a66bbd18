"""Session settings, table access and lineage cuts shared by all operators."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder all executors see: below spark.checkpoint.dir, or, where that is unset (tests), a local one.

    Tables written here replace cached blocks, so a lost executor costs no more than the tasks it ran. Executors of a
    cluster share no local folder, so there the setting is needed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder shared by all executors of {master}")
        made = getattr(shared_folder, "made", None)
        if made is None:
            made = shared_folder.made = tempfile.mkdtemp(prefix="folioforge-")
        base = made
    return f"{base.rstrip('/')}/folioforge"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder, deleted at exit."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    atexit.register(drop_path, spark, path)
    return path


def cut(df: DataFrame, label: str = "step", by: str | None = None) -> DataFrame:
    """Writes df into the shared folder and reads it back: lineage ends here and shuffle files can go.

    by: a column of few values; readers of some of them skip the files of the others."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._folioforge_path = path
    return back


def release(df: DataFrame | None) -> None:
    """Deletes the table behind a frame made by cut() that no later step reads."""
    path = getattr(df, "_folioforge_path", None)
    if path:
        drop_path(df.sparkSession, path)


def list_paths(spark: SparkSession, path: str) -> list[str]:
    """Folders and files right below a folder, or the file itself; none if it is not there."""
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def drop_path(spark: SparkSession, path: str) -> None:
    try:
        sc = spark.sparkContext
        hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True)
    except Exception:  # the session may have ended; then the folder's owner clears it
        pass


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "folioforge") -> SparkSession:
    """Session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FOLIOFORGE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
