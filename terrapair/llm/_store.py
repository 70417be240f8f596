"""Cutting lineage: tables written to the folder that the cluster shares."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from terrapair.sources.tables import shared_dir

def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "lz4") -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back.

    Unlike cached blocks, the files outlive any executor. They are Parquet so that
    later reads prune columns.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files behind a frame that `stored` returned and that is read no more."""
    spark = df.sparkSession
    jvm = spark._jvm
    for name in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(name).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of frames that are no longer referenced.

    Python's handles go first and are released in the background, hence two rounds.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.3)
        spark._jvm.System.gc()
    time.sleep(0.3)
