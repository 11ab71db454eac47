"""Order-dependent operators that never put an unbounded group into one task.

A plain ``row_number``/``lag`` over a key sends every row of a hot key to one task.  The
operators here cut a key's rows into sub-buckets of bounded size first, work inside the
sub-buckets, and stitch the (few) sub-bucket summaries together.  Results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barledger.functions.exprs import count_where
from barledger.sources.staging import staged

def _ranged(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """``df`` written once, range-partitioned by ``order``, with the number of its range.

    Range bounds are quantiles that Spark samples, so ranges hold about equally many rows
    however sparse or dense the values are; a hash of the whole row splits equal ones.
    """
    ranged = df.repartitionByRange(*order, F.xxhash64(*df.columns))
    return staged(ranged.withColumn("__range", F.spark_partition_id()))


def exact_rank(
    df: DataFrame,
    keys: list[str],
    day: str,
    position: str,
    ties: list[str] = (),
    name: str = "rank",
) -> DataFrame:
    """1-based rank of each row in its key by (day nulls last, position, ties).

    A two-level prefix scan over ranges of (key, day, position, ties): rows are sorted inside
    their range once, and only the count and the first place of each key and range are summed
    up over the key; a rank is then a difference of places.
    """
    # Hidden non-null text keys: the offset join is a plain equality.
    hidden = {
        f"__k{i}": F.coalesce(F.col(k).cast("string"), F.lit("\u0000"))
        for i, k in enumerate(keys)
    }
    order = [*hidden, F.col(day).asc_nulls_last(), position, *ties, F.xxhash64(*df.columns)]
    placed = df.withColumns(hidden).repartitionByRange(*order).sortWithinPartitions(*order)
    # The generated id holds the range above bit 33 and the place in the range below.
    rows = staged(placed.withColumn("__at", F.monotonically_increasing_id()))
    rows = rows.withColumn("__range", F.shiftright("__at", 33))
    cell = [*hidden, "__range"]
    sizes = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = (
        Window.partitionBy(*hidden)
        .orderBy("__range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *cell, "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    return rows.join(offsets, cell).withColumn(
        name, (F.col("__at") - F.col("__first") + F.col("__offset") + 1).cast("bigint")
    ).drop(*cell, "__at", "__first", "__offset")


def number_rows(df: DataFrame, order: list[str | Column], name: str = "position") -> DataFrame:
    """1-based place of each row in the total order ``order``; ties get places in input order.

    A two-level prefix scan: ranges are cut at quantiles that Spark samples, rows are sorted
    inside their range and written once with their local number, and only the ranges' row
    counts (one row a range) are summed up.  The input ordinal is the last range key, so rows
    that are equal in every other key are split between ranges too.
    """
    rows = staged(df.withColumn("__tie", F.monotonically_increasing_id()))
    keys = [*order, "__tie"]
    # The generated id holds the range above bit 33 and the place in the range below.
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = staged(placed.withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumn("__range", F.shiftright("__at", 33))
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    local = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "__range").withColumn(
        name, (local + F.col("__offset") + 1).cast("bigint")
    ).drop("__tie", "__at", "__range", "__offset")


def order_breaks(
    df: DataFrame,
    position: str | list[str],
    sort_keys: list[Column],
    partition: list[str] = (),
) -> DataFrame:
    """Number of adjacent input rows (by ``position``) whose sort key goes down.

    One row per ``partition`` (a single row without one) with ``order_break_count`` and
    ``row_count``.  Zero breaks means the rows already are in sort order.  Ranges of the
    position are scanned by themselves; only the first and last row of each are stitched.
    """
    part = list(partition)
    places = [position] if isinstance(position, str) else list(position)
    rows = df.select(
        *part,
        F.struct(*places).alias("__p"),
        F.struct(*[k.alias(f"k{i}") for i, k in enumerate(sort_keys)]).alias("__k"),
    )
    rows = _ranged(rows, [*part, "__p"])
    inside = Window.partitionBy(*part, "__range").orderBy("__p")
    stepped = rows.withColumn("__prev", F.lag("__k").over(inside))
    ranges = stepped.groupBy(*part, "__range").agg(
        count_where(_descends(F.col("__prev"), F.col("__k"), len(sort_keys))).alias("breaks"),
        F.count(F.lit(1)).alias("n"),
        F.min_by("__k", "__p").alias("first"),
        F.max_by("__k", "__p").alias("last"),
    )
    across = Window.partitionBy(*(part or [F.lit(0)])).orderBy("__range")
    edges = ranges.withColumn("__prev_last", F.lag("last").over(across)).withColumn(
        "edge", _descends(F.col("__prev_last"), F.col("first"), len(sort_keys))
    )
    return edges.groupBy(*part).agg(
        (F.coalesce(F.sum("breaks"), F.lit(0)) + count_where(F.col("edge")))
        .cast("bigint")
        .alias("order_break_count"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
    )


def _descends(previous: Column, current: Column, parts: int) -> Column:
    """True where ``current`` sorts before ``previous``; missing values sort last."""
    down, tied = F.lit(False), F.lit(True)
    for i in range(parts):
        a, b = previous[f"k{i}"], current[f"k{i}"]
        less = (b < a) | (a.isNull() & b.isNotNull())
        down = down | (tied & F.coalesce(less, F.lit(False)))
        tied = tied & a.eqNullSafe(b)
    return previous.isNotNull() & down


def duplicate_counts(df: DataFrame, keys: list[str | Column], group: list[str] = ()) -> DataFrame:
    """Rows beyond the first per key (keep-first) and rows in repeated keys (keep-all)."""
    per_key = df.groupBy(*group, *keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.groupBy(*group).agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicate_count"),
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0))
        .cast("bigint")
        .alias("repeated_row_count"),
    )


def previous_value_by_day(
    df: DataFrame, keys: list[str], day: str, position: Column, value: str, name: str
) -> DataFrame:
    """Value of the observation before each (key, day), one row per key and day.

    Days are compacted first, so the lag window holds at most one row per calendar day.
    A day with several rows looks back at its own earlier rows before the day before.
    """
    rows = df.where(F.col(day).isNotNull()).select(
        *keys, day, position.alias("__p"), F.col(value).alias("__v")
    )
    days = rows.groupBy(*keys, day).agg(
        F.count(F.lit(1)).alias("__n"),
        F.max("__p").alias("__last_p"),
        F.max_by("__v", "__p").alias("__last_v"),
    )
    walk = Window.partitionBy(*keys).orderBy(day)
    lagged = days.withColumn("__before", F.lag("__last_v").over(walk))
    repeated = days.where("__n > 1").select(*keys, day, "__last_p")
    within = (
        rows.join(repeated, [*keys, day])
        .where(F.col("__p") < F.col("__last_p"))
        .where(F.col("__v").isNotNull())
        .groupBy(*keys, day)
        .agg(F.max_by("__v", "__p").alias("__within"))
    )
    return lagged.join(within, [*keys, day], "left").select(
        *keys, day, F.coalesce("__within", "__before").alias(name)
    )


def session_gaps(
    df: DataFrame, keys: list[str], instant: str, minutes: int = 90
) -> DataFrame:
    """Gaps longer than ``minutes`` between consecutive instants, counted per key.

    Inside one bucket of ``minutes`` no gap can be that long, so only the first and last
    instant of each non-empty bucket matter: rows collapse map-side to bucket edges.
    """
    micros = F.unix_micros(F.col(instant).cast("timestamp"))
    width = minutes * 60 * 1_000_000
    edges = (
        df.where(F.col(instant).isNotNull())
        .select(*keys, micros.alias("__t"))
        .groupBy(*keys, F.floor(F.col("__t") / F.lit(width)).alias("__b"))
        .agg(F.min("__t").alias("__lo"), F.max("__t").alias("__hi"))
    )
    walk = Window.partitionBy(*keys).orderBy("__b")
    gap = F.col("__lo") - F.lag("__hi").over(walk)
    return (
        edges.withColumn("__gap", gap)
        .groupBy(*keys)
        .agg(count_where(F.col("__gap") > width).alias("gap_count"))
    )


def top_rows(
    df: DataFrame, group: list[str], order: list[str | Column], limit: int, name: str = "position"
) -> DataFrame:
    """First ``limit`` rows per group; Spark prunes with a map-side window group limit."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= limit)
