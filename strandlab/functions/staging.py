"""Tables written below the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share, as ``spark.checkpoint.dir`` names it.

    Where the setting is absent on one machine (tests) a temporary folder is made and kept for the session; on a cluster
    that is an error, as no other folder is known to be shared."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='strandlab-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: cuts the lineage, survives lost executors. ``by`` names a
    column that parts the files, so that a filter on it reads only its own.

    The table goes when the driver ends; :func:`unstage` drops it sooner."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strandlab/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path, partitionBy=by)
    files, where = _file_system(spark, path)
    files.deleteOnExit(where)
    out = spark.read.schema(schema).parquet(path)
    out._staged_at = path
    return out


def unstage(*tables: DataFrame | None) -> None:
    """Drop staged tables that nothing reads any more; None and others are left alone."""
    for df in tables:
        if path := getattr(df, "_staged_at", None):
            files, where = _file_system(df.sparkSession, path)
            files.delete(where, True)
