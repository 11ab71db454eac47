"""Incremental form of the daily normalizer over newly landed files.

The normalizers are stateless projections, so the same function serves a stream of landed
JSON; checks and the publish gate stay batch jobs per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from barledger.operators.normalize import daily_bars
from barledger.operators.units import UnitProvenance
from barledger.sources.store import RAW_DAILY_SCHEMA


def landed_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(RAW_DAILY_SCHEMA).json(path)


def normalize_landed(
    spark: SparkSession,
    path: str,
    output: str,
    checkpoint: str,
    ingestion: Column,
    exchange: str = "HOSE",
    provenance: UnitProvenance | None = None,
):
    """Normalize every file landed since the last run, then stop."""
    bars = daily_bars(landed_daily(spark, path), ingestion, exchange, provenance)
    return (
        bars.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .partitionBy("symbol")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
