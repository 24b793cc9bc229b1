"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "tallygrid", cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter builds its own."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", _local_folder())
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tallygrid-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for derived files.

    Clusters name a shared folder in `spark.checkpoint.dir`, and it is an error if they don't.
    On a single machine (a local master) a temporary folder, removed at exit, takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Cut lineage through a Parquet table in the shared folder.

    The files outlive executors, so a lost executor costs re-reading one task's input.
    With `free`, what was shuffled to make the table is deleted as soon as it is written, and not when
    the driver happens to collect its garbage.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, None)
    if free:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if free:
            spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.parquet(path)


def clear_scratch(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete the files behind written scratch tables, once nothing reads them any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = spark.conf.get("spark.checkpoint.dir", None) or _local_folder()
    for folder in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if root.removeprefix("file:").lstrip("/") in folder:  # never anything but scratch
            path.getFileSystem(conf).delete(path, True)
