"""Small literal frames used by several tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from barledger.operators import normalize
from barledger.operators.units import KBS, VCI  # noqa: F401

RAW = (
    "symbol string, time string, open double, high double, low double, close double, "
    "volume double"
)


def stamp():
    return F.lit("2026-07-04T00:00:00Z").cast("timestamp")


def raw_bars(spark, rows):
    """rows: (symbol, time, open, high, low, close, volume)."""
    return spark.createDataFrame(rows, RAW)


def flat_bars(spark, rows):
    """rows: (symbol, time, close, volume) with a flat bar."""
    return raw_bars(spark, [(s, t, c, c, c, c, float(v)) for s, t, c, v in rows])


def daily(spark, rows, record=None):
    return normalize.daily_bars(flat_bars(spark, rows), stamp(), "HOSE", record)


def symbols(spark, names):
    return spark.createDataFrame([(n,) for n in names], "symbol string")


def names(results):
    return {r["check_name"]: r for r in results.collect()}
