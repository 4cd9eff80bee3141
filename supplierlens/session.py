"""Session settings for tests, benchmarks and local runs, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", name: str = "supplierlens", **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Larger generated methods than this are never compiled by HotSpot.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE_PARTITIONS", cores))
        .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "8g"))
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written tables, below the cluster's shared checkpoint folder.

    Only a local session without that setting gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="supplierlens-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back, so that it is computed once and its
    rows stay the same however often they are read and whichever executor is lost."""
    folder = work_folder(df.sparkSession, purpose)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
