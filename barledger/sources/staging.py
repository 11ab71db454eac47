"""Intermediate results written once to the cluster's shared folder.

A multi-consumer intermediate (task assessments, campaign source rows) is written as
Parquet under ``spark.checkpoint.dir`` and read back.  That cuts lineage, survives lost
executors, keeps column pruning and gives later joins exact sizes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only in local mode without a setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a shared folder before running on a cluster.")
    fallback = tempfile.mkdtemp(prefix="spark-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return the frame that reads it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/barledger-stage/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
