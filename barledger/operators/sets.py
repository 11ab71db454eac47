"""Set and keyed-merge operators over frames (union, difference, equality, override)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.functions.exprs import clean_text, strip


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate frames; a column missing from one of them reads as NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def clean_symbols(df: DataFrame, column: str = "symbol") -> DataFrame:
    """Distinct normalized symbols without blanks."""
    return df.select(clean_text(F.col(column)).alias("symbol")).where("symbol is not null").distinct()


def upper_symbols(df: DataFrame, column: str = "symbol") -> DataFrame:
    """Distinct upper-cased symbols of observed rows; blank text is kept as a symbol."""
    return (
        df.where(F.col(column).isNotNull())
        .select(F.upper(strip(F.col(column).cast("string"))).alias("symbol"))
        .distinct()
    )


def symbol_union(frames: list[DataFrame]) -> DataFrame:
    return union_all([f.select("symbol") for f in frames]).distinct()


def missing_symbols(requested: DataFrame, returned: DataFrame) -> DataFrame:
    """Requested symbols for which no row came back."""
    wanted = clean_symbols(requested)
    got = returned.select("symbol").where("symbol is not null").distinct()
    return wanted.join(got, "symbol", "left_anti")


def frame_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows (with multiplicity) only on the left, only on the right, and equality."""
    columns = left.columns
    key = F.struct(*columns)
    signed = left.select(key.alias("r"), F.lit(1).alias("s")).unionAll(
        right.select(*columns).select(key.alias("r"), F.lit(-1).alias("s"))
    )
    net = signed.groupBy("r").agg(F.sum("s").alias("n"))
    return net.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("n"))), F.lit(0))
        .cast("bigint")
        .alias("left_only_count"),
        F.coalesce(F.sum(F.when(F.col("n") < 0, -F.col("n"))), F.lit(0))
        .cast("bigint")
        .alias("right_only_count"),
    ).withColumn("equal", (F.col("left_only_count") == 0) & (F.col("right_only_count") == 0))


def set_differences(left: DataFrame, right: DataFrame, column: str = "symbol") -> DataFrame:
    """Set (not multiset) comparison of one column."""
    return frame_differences(
        left.select(column).distinct(), right.select(column).distinct()
    )


def merge_by_key(base: DataFrame, override: DataFrame, key: str) -> DataFrame:
    """Override rows replace base rows with the same key; unmatched overrides are added."""
    columns = base.columns
    taken = override.select(key).distinct()
    return base.join(taken, key, "left_anti").select(*columns).unionByName(
        override.select(*columns)
    )
