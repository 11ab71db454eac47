"""Exact-run coverage audit per symbol and its summary."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barledger.contracts import (
    COVERAGE_STATUSES,
    COVERAGE_VERSION,
    DAILY_COVERAGE,
    KNOWN_COVERAGE_RISKS,
    VALUE_COLUMNS,
)
from barledger.functions.exprs import (
    any_of,
    count_where,
    holds,
    invalid_ohlc,
    is_weekday,
    lit_date,
    non_integer,
    null_ohlc,
    reasons,
    safe_ratio,
    strip,
    to_day,
    to_number,
    weekday_index,
    weekdays_between,
)
from barledger.operators.panel import require_columns
from barledger.operators.sets import symbol_union, union_all
from barledger.operators.units import facts_of_records, provenance_records, resolve_facts


@dataclass(frozen=True)
class CoverageConfig:
    min_history_observations: int = 500
    min_span_coverage_ratio: float = 0.9
    stale_after_calendar_days: int = 7
    max_zero_volume_frequency: float = 0.2


def day_facts(rows: DataFrame) -> DataFrame:
    """Rows compacted to (symbol, date): counts of every defect and a conflict flag.

    A day conflicts when some value column takes two values (a missing value counts as a
    value).  Only longs and doubles are aggregated, so this stays a hash aggregate with
    map-side combine whatever the number of copies of a day.
    """
    volume = F.col("volume")
    differs = any_of(
        holds(F.col(f"lo_{c}") != F.col(f"hi_{c}"))
        | ((F.col(f"ct_{c}") > 0) & (F.col(f"ct_{c}") < F.col("n")))
        for c in VALUE_COLUMNS
    )
    spread = []
    for c in VALUE_COLUMNS:
        spread += [
            F.min(c).alias(f"lo_{c}"),
            F.max(c).alias(f"hi_{c}"),
            F.count(c).alias(f"ct_{c}"),
        ]
    return (
        rows.groupBy("symbol", "date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            count_where(null_ohlc()).alias("missing_ohlc"),
            count_where(invalid_ohlc()).alias("invalid_ohlc"),
            count_where(volume.isNull()).alias("missing_volume"),
            count_where(volume < 0).alias("negative_volume"),
            count_where(non_integer(volume)).alias("non_integer_volume"),
            count_where(volume == 0).alias("zero_volume"),
            *spread,
        )
        .withColumn("conflict", F.col("date").isNotNull() & (F.col("n") > 1) & differs)
        .drop(*[f"{p}_{c}" for c in VALUE_COLUMNS for p in ("lo", "hi", "ct")])
    )


def _gap_steps(days: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the weekday gap before each day and the day's weekday index.

    ``days`` has one row per key and date, so a key's window holds at most one row per
    calendar day.  Weekday indexes replace an expanded calendar.
    """
    walk = Window.partitionBy(*keys).orderBy(F.col("date").asc_nulls_last())
    weekday = is_weekday(F.col("date"))
    index = F.when(weekday, weekday_index(F.col("date")))
    seen = F.max(index).over(walk.rowsBetween(Window.unboundedPreceding, -1))
    start = weekday_index(F.date_sub(F.first("date").over(walk), 1))
    return days.withColumns(
        {"__gap": index - F.coalesce(seen, start) - 1, "__index": index}
    )


def _longest_gap() -> Column:
    """Aggregate over gap steps: the longest run of missing weekdays in the observed span."""
    edge = F.coalesce(F.max("__index"), weekday_index(F.date_sub(F.min("date"), 1)))
    tail = weekday_index(F.max("date")) - edge
    return F.greatest(F.coalesce(F.max("__gap"), F.lit(0)), tail, F.lit(0)).cast("bigint")


def longest_gaps(days: DataFrame, keys: list[str] = ("symbol",)) -> DataFrame:
    """Longest run of missing weekdays inside each key's observed span."""
    steps = _gap_steps(days.where("date is not null"), list(keys))
    return steps.groupBy(*keys).agg(_longest_gap().alias("longest_missing_weekday_streak"))


def _symbol_facts(days: DataFrame) -> DataFrame:
    """Counts and the longest gap per symbol; window and aggregate share one shuffle."""
    dated = F.col("date").isNotNull()
    weekday = holds(is_weekday(F.col("date")))

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return _gap_steps(days, ["symbol"]).groupBy("symbol").agg(
        _longest_gap().alias("longest_missing_weekday_streak"),
        F.min("date").alias("first_observation_date"),
        F.max("date").alias("last_observation_date"),
        total(F.col("n")).alias("observation_count"),
        count_where(dated).alias("unique_observation_date_count"),
        count_where(weekday).alias("observed_weekdays"),
        total(F.when(dated, F.col("n") - 1)).alias("duplicate_row_count"),
        count_where(F.col("conflict")).alias("conflicting_duplicate_date_count"),
        total(F.when(dated & ~weekday, F.col("n"))).alias("weekend_observation_count"),
        total(F.when(~dated, F.col("n"))).alias("invalid_date_count"),
        *[
            total(F.col(c)).alias(f"{c}_count")
            for c in (
                "missing_ohlc",
                "invalid_ohlc",
                "missing_volume",
                "negative_volume",
                "non_integer_volume",
                "zero_volume",
            )
        ],
    )


def source_file_counts(rows: DataFrame, path: str = "__input_path") -> DataFrame:
    """Distinct source files per symbol (reads two columns only)."""
    return (
        rows.where(F.col(path).isNotNull())
        .groupBy("symbol", path)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("source_file_count"))
    )


def audit_coverage(
    daily: DataFrame,
    universe: DataFrame,
    requested: DataFrame,
    snapshot_date: dt.date | str,
    run_id: str,
    start: dt.date | str,
    end: dt.date | str,
    config: CoverageConfig = CoverageConfig(),
) -> DataFrame:
    """One row per symbol that is in the universe, was requested, or was observed."""
    if str(start) > str(end):
        raise ValueError("The start date must not be after the end date.")
    require_columns(daily, ["symbol", "date", *VALUE_COLUMNS], "normalized daily")
    rows = daily.withColumns(
        {
            "symbol": F.upper(strip(F.col("symbol").cast("string"))),
            "date": to_day(daily, "date"),
            **{c: to_number(daily, c) for c in VALUE_COLUMNS},
        }
    )
    in_scope = F.col("date").between(lit_date(start), lit_date(end)) | F.col("date").isNull()
    rows = rows.where(in_scope & F.col("symbol").isNotNull())
    stats = _symbol_facts(day_facts(rows))

    def listed(df: DataFrame, flag: str) -> DataFrame:
        named = df.select(F.upper(strip(F.col("symbol"))).alias("symbol")).where("symbol <> ''")
        return named.withColumn(flag, F.lit(True))

    sources = [listed(universe, "in_universe"), listed(requested, "in_request")]
    spine = (
        union_all([*sources, stats.select("symbol")])
        .groupBy("symbol")
        .agg(F.bool_or("in_universe").alias("in_universe"), F.bool_or("in_request").alias("in_request"))
    )
    # Distinct (symbol, record, file) combinations serve both the unit policy and the
    # file count, so the wide text columns are scanned once.
    by = ["symbol", "__input_path"] if "__input_path" in rows.columns else ["symbol"]
    records = provenance_records(rows, by)
    units = facts_of_records(records, rows.columns, ["symbol"])
    joined = spine.join(stats, "symbol", "left").join(units, "symbol", "left")
    if "__input_path" in rows.columns:
        joined = joined.join(source_file_counts(records), "symbol", "left")
    else:
        joined = joined.withColumn("source_file_count", F.lit(0))
    joined = joined.withColumns(
        {
            "fact_has_source_columns": F.coalesce("fact_has_source_columns", F.lit(False)),
            "fact_has_all_columns": F.coalesce("fact_has_all_columns", F.lit(False)),
        }
    )
    return _classify(resolve_facts(joined), snapshot_date, run_id, start, end, config)


def _classify(df: DataFrame, snapshot_date, run_id, start, end, config) -> DataFrame:
    counts = [
        c
        for c in df.columns
        if c.endswith("_count") or c in ("observed_weekdays", "longest_missing_weekday_streak")
    ]
    m = df.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in counts})
    first, last = F.col("first_observation_date"), F.col("last_observation_date")
    span = F.coalesce(weekdays_between(first, last), F.lit(0)).cast("bigint")
    expected = weekdays_between(lit_date(start), lit_date(end)).cast("bigint")
    m = m.withColumns(
        {
            "requested_weekday_count": expected,
            "observed_span_weekday_count": span,
            "observed_span_missing_weekday_count": span - F.col("observed_weekdays"),
            "stale_calendar_days": F.greatest(
                F.datediff(lit_date(end), last), F.when(last.isNotNull(), F.lit(0))
            ).cast("bigint"),
            "in_universe": holds(F.col("in_universe")),
            "in_request": holds(F.col("in_request")),
        }
    )
    m = m.withColumns(
        {
            "requested_weekday_coverage_ratio": safe_ratio(
                F.col("observed_weekdays"), F.col("requested_weekday_count")
            ),
            "observed_span_coverage_ratio": safe_ratio(
                F.col("observed_weekdays"), F.col("observed_span_weekday_count")
            ),
            "zero_volume_frequency": safe_ratio(
                F.col("zero_volume_count"),
                F.col("observation_count") - F.col("missing_volume_count"),
            ),
            "stale": holds(F.col("stale_calendar_days") > config.stale_after_calendar_days),
        }
    )
    empty, asked = F.col("observation_count") == 0, F.col("in_request")
    blockers = reasons(
        (~asked & ~empty, "observed_symbol_not_declared_in_source_manifest"),
        (F.col("invalid_date_count") > 0, "invalid_dates"),
        (F.col("duplicate_row_count") > 0, "duplicate_symbol_date_rows"),
        (F.col("conflicting_duplicate_date_count") > 0, "conflicting_duplicate_values"),
        (F.col("missing_ohlc_count") > 0, "missing_ohlc_values"),
        (F.col("invalid_ohlc_count") > 0, "invalid_ohlc_relationships"),
        (F.col("missing_volume_count") > 0, "missing_volume_values"),
        (F.col("negative_volume_count") > 0, "negative_volume_values"),
        (F.col("non_integer_volume_count") > 0, "non_integer_volume_values"),
        (F.col("weekend_observation_count") > 0, "weekend_observations"),
    )
    m = m.withColumn("__blockers", blockers)
    short = F.col("unique_observation_date_count") < config.min_history_observations
    thin = F.coalesce(
        F.col("observed_span_coverage_ratio") < config.min_span_coverage_ratio, F.lit(True)
    )
    idle = F.coalesce(
        F.col("zero_volume_frequency") > config.max_zero_volume_frequency, F.lit(True)
    )
    permitted = F.col("vnd_traded_value_permitted")
    ladder = [
        (empty & ~asked, "not_ingested", ["symbol_not_requested_in_source_run"]),
        (empty, "absent", ["requested_symbol_has_no_daily_observations"]),
        (F.size("__blockers") > 0, "blocking_quality_issues", None),
        (F.col("stale"), "stale", ["last_observation_is_stale"]),
        (short, "insufficient_history", ["history_observations_below_minimum"]),
        (thin, "sparse", ["observed_span_coverage_below_minimum"]),
        (idle, "sparse", ["zero_volume_frequency_above_maximum"]),
        (permitted, "usable_vnd", ["raw_ohlcv_coverage_passed", "vnd_unit_provenance_verified"]),
        (
            F.lit(True),
            "usable_non_monetary",
            ["raw_ohlcv_coverage_passed", "vnd_unit_provenance_unverified"],
        ),
    ]
    status = F.coalesce(*[F.when(cond, F.lit(name)) for cond, name, _ in ladder])
    why = F.coalesce(
        *[
            F.when(
                cond,
                F.col("__blockers") if labels is None else F.array(*[F.lit(x) for x in labels]),
            )
            for cond, _, labels in ladder
        ]
    )
    m = m.withColumn("coverage_status", status)
    usable = F.col("coverage_status").isin("usable_vnd", "usable_non_monetary")
    output = m.withColumns(
        {
            "feature_input_contract_version": F.lit(COVERAGE_VERSION),
            "universe_snapshot_date": lit_date(snapshot_date),
            "current_universe_snapshot_status": F.when(
                F.col("in_universe"), "current_snapshot_candidate"
            ).otherwise("not_in_selected_current_snapshot"),
            "source_run_request_status": F.when(asked, "requested")
            .when(~empty, "not_requested_but_observed")
            .otherwise("not_requested"),
            "daily_run_id": F.lit(run_id),
            "requested_start_date": lit_date(start),
            "requested_end_date": lit_date(end),
            "minimum_history_observations": F.lit(config.min_history_observations).cast("bigint"),
            "minimum_span_coverage_ratio": F.lit(float(config.min_span_coverage_ratio)),
            "maximum_zero_volume_frequency": F.lit(float(config.max_zero_volume_frequency)),
            "provider": F.col("policy_provider"),
            "data_backend": F.col("policy_data_backend"),
            "raw_ohlcv_research_usable": usable,
            "vnd_liquidity_research_usable": usable & permitted,
            "adjusted_price_research_usable": F.lit(False),
            "point_in_time_universe_research_usable": F.lit(False),
            "coverage_reasons": why,
            "known_risks": F.array(*[F.lit(r) for r in KNOWN_COVERAGE_RISKS]),
        }
    )
    return output.select(*DAILY_COVERAGE.columns)


def coverage_symbol_count(
    daily: DataFrame, universe: DataFrame, requested: DataFrame, start, end
) -> DataFrame:
    """Expected number of audited symbols; blank symbols are not expected."""
    inside = F.col("date").between(lit_date(start), lit_date(end)) | F.col("date").isNull()
    named = [
        df.select(F.upper(strip(F.col("symbol").cast("string"))).alias("symbol")).where(
            "symbol <> ''"
        )
        for df in (daily.where(inside), universe, requested)
    ]
    return symbol_union(named).agg(F.count(F.lit(1)).alias("expected_symbol_count"))


def summarize_coverage(coverage: DataFrame) -> DataFrame:
    """One row of counts, date bounds and the overlap usable by every current symbol."""
    candidate = F.col("current_universe_snapshot_status") == "current_snapshot_candidate"
    vnd = F.col("vnd_liquidity_research_usable")
    present = F.col("observation_count") > 0
    summary = coverage.agg(
        F.count(F.lit(1)).alias("audited_symbol_count"),
        count_where(candidate).alias("current_snapshot_symbol_count"),
        count_where(F.col("source_run_request_status") == "requested").alias(
            "source_run_requested_symbol_count"
        ),
        count_where(present).alias("symbols_with_daily_data"),
        count_where(F.col("raw_ohlcv_research_usable")).alias("raw_ohlcv_usable_symbol_count"),
        count_where(vnd).alias("vnd_liquidity_usable_symbol_count"),
        count_where(vnd & candidate).alias("current_snapshot_vnd_usable_symbol_count"),
        *[
            count_where(F.col("coverage_status") == s).alias(f"status_{s}")
            for s in COVERAGE_STATUSES
        ],
        F.min(F.when(present, F.col("first_observation_date"))).alias("earliest_observation_date"),
        F.max(F.when(present, F.col("last_observation_date"))).alias("latest_observation_date"),
        F.max(F.when(vnd & candidate, F.col("first_observation_date"))).alias("__from"),
        F.min(F.when(vnd & candidate, F.col("last_observation_date"))).alias("__to"),
    )
    overlap = holds(F.col("__from") <= F.col("__to"))
    return summary.withColumns(
        {
            "common_vnd_overlap_available": overlap,
            "common_vnd_start_date": F.when(overlap, F.col("__from")),
            "common_vnd_end_date": F.when(overlap, F.col("__to")),
        }
    ).drop("__from", "__to")


def coverage_provenance_counts(coverage: DataFrame) -> DataFrame:
    return coverage.groupBy("unit_provenance_status").agg(
        F.count(F.lit(1)).alias("symbol_count")
    )


def usable_symbols(coverage: DataFrame) -> DataFrame:
    """The symbol lists of the summary as rows (list_name, symbol)."""
    candidate = F.col("current_universe_snapshot_status") == "current_snapshot_candidate"
    vnd = F.col("vnd_liquidity_research_usable")
    lists = reasons(
        (F.col("raw_ohlcv_research_usable"), "raw_ohlcv_usable"),
        (vnd, "vnd_liquidity_usable"),
        (vnd & candidate, "current_snapshot_vnd_usable"),
        (F.col("source_run_request_status") == "requested", "source_run_requested"),
    )
    return coverage.select(F.explode(lists).alias("list_name"), "symbol")


__all__ = [
    "CoverageConfig",
    "audit_coverage",
    "coverage_provenance_counts",
    "coverage_symbol_count",
    "day_facts",
    "longest_gaps",
    "source_file_counts",
    "summarize_coverage",
    "usable_symbols",
]
