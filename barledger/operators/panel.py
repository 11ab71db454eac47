"""Daily panel, availability diagnostics and trailing-window liquidity."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.contracts import (
    AVAILABILITY_VERSION,
    DAILY_PANEL,
    DAILY_PANEL_VERSION,
    HOLIDAY_STATUS,
    LIQUIDITY_VERSION,
    MARKET_TIMEZONE,
    PANEL_SOURCE_REQUIRED,
    PROVENANCE_COLUMNS,
    VALUE_COLUMNS,
)
from barledger.functions.exprs import (
    clean_text,
    count_where,
    holds,
    invalid_ohlc,
    is_weekday,
    lit_date,
    null_ohlc,
    reasons,
    safe_ratio,
    to_day,
    to_number,
    trailing_weekday_start,
    weekdays_between,
)
from barledger.operators.units import (
    effective_columns,
    ensure_provenance_columns,
    policy_value,
    provenance_output_columns,
)


def require_columns(df: DataFrame, required: list[str], dataset: str) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{dataset} is missing required columns: {', '.join(missing)}.")


def _ordered_range(start, end) -> None:
    if str(start) > str(end):
        raise ValueError("The start date must not be after the end date.")


def select_window(
    daily: DataFrame, start, end, symbols: DataFrame | None = None, keep_undated: bool = False
) -> DataFrame:
    """Symbol-list and date-range selection; undated rows stay only for audits."""
    inside = F.col("date").between(lit_date(start), lit_date(end))
    rows = daily.where(inside | F.col("date").isNull() if keep_undated else inside)
    if symbols is not None:
        rows = rows.join(symbols.select("symbol").distinct(), "symbol", "left_semi")
    return rows


def _clean_daily(daily: DataFrame, values: list[str]) -> DataFrame:
    """Normalized symbol, DATE label and numeric values; other columns pass through."""
    return daily.withColumns(
        {
            "symbol": clean_text(F.col("symbol")),
            "date": to_day(daily, "date"),
            **{c: to_number(daily, c) for c in values},
        }
    )


def daily_panel(
    daily: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    symbols: DataFrame | None = None,
    carry: list[str] = (),
) -> DataFrame:
    """Observed bars in range with their effective unit policy; never filled or resampled.

    ``carry`` keeps extra source columns (row lineage) without a second join.
    """
    _ordered_range(start, end)
    require_columns(daily, PANEL_SOURCE_REQUIRED, "normalized daily")
    rows = _clean_daily(ensure_provenance_columns(daily), VALUE_COLUMNS)
    rows = select_window(rows, start, end, symbols)
    policy = policy_value(rows)
    stamped = rows.withColumn("__policy", policy)
    flag = F.col("adjusted_flag")
    output = stamped.withColumns(
        {
            "feature_input_contract_version": F.lit(DAILY_PANEL_VERSION),
            "observation_status": F.lit("observed_provider_bar"),
            "price_adjustment_status": F.when(flag.isNull(), "unknown").otherwise(
                "provider_flag_unverified"
            ),
            "source_adjusted_flag": flag,
            "source_ingestion_timestamp_utc": F.col("ingestion_timestamp_utc").try_cast(
                "timestamp"
            ),
            "source_dataset": F.lit("normalized/vnstock/daily"),
            "daily_date_semantics": F.lit("provider_trading_date_unlocalized"),
            "timestamp_status": F.lit("daily_date_no_intraday_timestamp"),
            "market_timezone_convention": F.lit(MARKET_TIMEZONE),
            **effective_columns(F.col("__policy")),
        }
    )
    return output.select(*DAILY_PANEL.columns, *carry)


def availability(
    daily: DataFrame, symbols: DataFrame, start: dt.date | str, end: dt.date | str
) -> DataFrame:
    """Per-symbol availability; requested symbols without rows still get a row."""
    _ordered_range(start, end)
    require_columns(daily, ["symbol", "date", *VALUE_COLUMNS], "daily observations")
    rows = select_window(
        _clean_daily(daily.select("symbol", "date", *VALUE_COLUMNS), VALUE_COLUMNS), start, end
    )
    per_day = rows.groupBy("symbol", "date").agg(
        F.count(F.lit(1)).alias("n"),
        count_where(null_ohlc()).alias("missing_ohlc"),
        count_where(invalid_ohlc()).alias("invalid_ohlc"),
        count_where(F.col("volume") == 0).alias("zero_volume"),
    )
    stats = per_day.groupBy("symbol").agg(
        F.min("date").alias("observed_start_date"),
        F.max("date").alias("observed_end_date"),
        F.sum("n").alias("observation_count"),
        F.sum(F.col("n") - 1).alias("duplicate_count"),
        F.sum("missing_ohlc").alias("missing_ohlc_count"),
        F.sum("invalid_ohlc").alias("invalid_ohlc_count"),
        F.sum("zero_volume").alias("zero_volume_count"),
        count_where(is_weekday(F.col("date"))).alias("observed_expected_weekday_count"),
        F.sum(F.when(~is_weekday(F.col("date")), F.col("n"))).alias("weekend_observation_count"),
    )
    spine = symbols.select(clean_text(F.col("symbol")).alias("symbol")).where(
        "symbol is not null"
    ).distinct()
    expected = weekdays_between(lit_date(start), lit_date(end)).cast("bigint")

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)

    observed = F.coalesce("observed_expected_weekday_count", F.lit(0)).cast("bigint")
    return spine.join(stats, "symbol", "left").select(
        F.lit(AVAILABILITY_VERSION).alias("feature_input_contract_version"),
        "symbol",
        lit_date(start).alias("requested_start_date"),
        lit_date(end).alias("requested_end_date"),
        "observed_start_date",
        "observed_end_date",
        zero("observation_count"),
        zero("duplicate_count"),
        zero("missing_ohlc_count"),
        zero("invalid_ohlc_count"),
        zero("zero_volume_count"),
        expected.alias("expected_weekday_count"),
        zero("observed_expected_weekday_count"),
        (expected - observed).alias("missing_expected_weekday_count"),
        safe_ratio(observed, expected).alias("weekday_coverage_ratio"),
        zero("weekend_observation_count"),
        F.col("observation_count").isNull().alias("absence_of_data"),
        F.lit("weekdays_only").alias("expected_session_model"),
        F.lit(HOLIDAY_STATUS).alias("holiday_calendar_status"),
    )


@dataclass(frozen=True)
class LiquidityConfig:
    window_weekdays: int = 20
    min_history_observations: int = 15
    min_trading_frequency: float | None = 0.8
    max_zero_volume_frequency: float | None = 0.2
    min_average_volume: float | None = None
    min_average_traded_value_vnd: float | None = None

    def __post_init__(self) -> None:
        if self.window_weekdays < 1 or self.min_history_observations < 1:
            raise ValueError("Window and minimum history must be positive.")
        if self.min_history_observations > self.window_weekdays:
            raise ValueError("Minimum history cannot exceed the window.")


def liquidity_window(reference: dt.date | str, config: LiquidityConfig) -> Column:
    return trailing_weekday_start(lit_date(reference), config.window_weekdays)


def last_valid(value: str, usable: Column | None = None) -> tuple[Column, Column]:
    """Aggregates ``recent_<value>`` and ``recent_date``: the newest non-null value of usable rows."""
    usable = F.lit(True) if usable is None else usable
    date = F.when(usable & F.col(value).isNotNull(), F.col("date"))
    return F.max_by(value, date).alias(f"recent_{value}"), F.max(date).alias("recent_date")


def liquidity(
    daily: DataFrame,
    symbols: DataFrame,
    reference: dt.date | str,
    config: LiquidityConfig = LiquidityConfig(),
) -> DataFrame:
    """Per-symbol trading metrics over the trailing weekday window, and the screen.

    Repeated (symbol, date) keys or negative volumes anywhere in the requested symbols'
    rows fail the job, as does a VND threshold without verified units.  VND sums use
    decimals, so the result does not depend on the order partial sums are merged.
    """
    require_columns(daily, ["symbol", "date", "close", "volume"], "daily panel")
    keep = [c for c in PROVENANCE_COLUMNS if c in daily.columns]
    rows = _clean_daily(
        daily.select("symbol", "date", "close", "volume", *keep), ["close", "volume"]
    )
    spine = symbols.select(clean_text(F.col("symbol")).alias("symbol")).where(
        "symbol is not null"
    ).distinct()
    rows = rows.join(spine, "symbol", "left_semi")
    reference_day = lit_date(reference)
    start = liquidity_window(reference, config)
    in_window = F.col("date").between(start, reference_day)
    policy = policy_value(rows.where(in_window))
    # Every surviving row has the expected key shape: one row per (symbol, date).
    per_day = rows.groupBy("symbol", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("volume").alias("volume"),
        F.min("close").alias("close"),
    )
    valued = per_day.withColumns(
        {
            "in_window": holds(in_window),
            "in_calendar": holds(in_window & is_weekday(F.col("date"))),
            "policy": policy,
        }
    )
    cal = F.col("in_calendar")
    volume, close = F.col("volume"), F.col("close")
    worth = (
        close * F.col("policy")["price_scale"] * volume * F.col("policy")["volume_scale"]
    ).cast("decimal(38,4)")
    has_worth = cal & close.isNotNull() & volume.isNotNull()
    stats = valued.groupBy("symbol").agg(
        F.max("n").alias("max_n"),
        F.min("volume").alias("min_volume"),
        count_where(F.col("in_window") & ~cal).alias("out_count"),
        count_where(cal).alias("observed"),
        count_where(cal & volume.isNotNull()).alias("valid_volume"),
        count_where(cal & holds(volume > 0)).alias("positive_volume"),
        count_where(cal & holds(volume == 0)).alias("zero_volume"),
        F.sum(F.when(cal, volume.cast("decimal(38,4)"))).alias("volume_sum"),
        F.sum(F.when(has_worth, worth)).alias("worth_sum"),
        count_where(has_worth).alias("worth_count"),
        *last_valid("close", cal),
    )
    joined = spine.join(stats, "symbol", "left").withColumn("policy", policy)

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint")

    verified = F.col("policy")["vnd_traded_value_permitted"]
    guard = F.lit(True)
    guard = F.when(
        F.col("max_n") > 1, F.raise_error(F.lit("Liquidity input repeats symbol/date keys."))
    ).when(
        F.col("min_volume") < 0, F.raise_error(F.lit("Liquidity input has negative volume."))
    )
    if config.min_average_traded_value_vnd is not None:
        guard = guard.when(
            ~verified, F.raise_error(F.lit("A VND threshold needs verified unit provenance."))
        )
    checked = joined.where(guard.otherwise(F.lit(True)))
    m = checked.select(
        "symbol",
        "policy",
        zero("out_count").alias("out_count"),
        zero("observed").alias("observed"),
        zero("valid_volume").alias("valid_volume"),
        zero("positive_volume").alias("positive_volume"),
        zero("zero_volume").alias("zero_volume"),
        "recent_close",
        "recent_date",
        (zero("positive_volume").cast("double") / F.lit(float(config.window_weekdays))).alias(
            "trading_frequency"
        ),
        safe_ratio(zero("zero_volume"), zero("valid_volume")).alias("zero_frequency"),
        safe_ratio(F.col("volume_sum"), zero("valid_volume")).alias("average_volume"),
        F.when(verified, safe_ratio(F.col("worth_sum"), zero("worth_count"))).alias(
            "average_value"
        ),
    )
    insufficient = F.col("observed") < config.min_history_observations
    failures = reasons(*_screen_rules(config))
    absent = F.col("observed") == 0
    base_reasons = (
        F.when(absent, F.array(F.lit("no_daily_observations")))
        .when(insufficient, F.array(F.lit("insufficient_history")))
        .when(F.size(failures) > 0, failures)
        .otherwise(F.array(F.lit("configured_liquidity_criteria_passed")))
    )
    base_status = (
        F.when(absent, "absent_data")
        .when(insufficient, "insufficient_history")
        .when(F.size(failures) > 0, "failed")
        .otherwise("passed")
    )
    outside = F.col("out_count") > 0
    return m.select(
        F.lit(LIQUIDITY_VERSION).alias("feature_input_contract_version"),
        "symbol",
        reference_day.alias("reference_date"),
        start.alias("window_start_date"),
        F.lit(config.window_weekdays).cast("bigint").alias("window_weekdays"),
        F.col("observed").alias("observed_date_count"),
        F.col("valid_volume").alias("valid_volume_observation_count"),
        F.col("positive_volume").alias("positive_volume_observation_count"),
        F.col("zero_volume").alias("zero_volume_observation_count"),
        F.col("out_count").alias("out_of_weekday_calendar_observation_count"),
        "trading_frequency",
        F.col("zero_frequency").alias("zero_volume_frequency"),
        F.col("average_volume").alias("average_volume_provider_units"),
        F.col("average_value").alias("average_traded_value_vnd"),
        F.col("recent_close").alias("recent_valid_close"),
        F.col("recent_date").alias("recent_valid_close_date"),
        insufficient.alias("insufficient_history"),
        F.when(absent, "absent")
        .when(F.col("observed") >= config.window_weekdays, "complete_weekday_coverage")
        .otherwise("partial")
        .alias("missing_data_status"),
        F.when(outside, "failed").otherwise(base_status).alias("screen_status"),
        F.when(
            outside,
            F.array_append(base_reasons, F.lit("out_of_weekday_calendar_observations")),
        )
        .otherwise(base_reasons)
        .alias("screen_reasons"),
        *[c.alias(n) for n, c in provenance_output_columns(F.col("policy")).items()],
        *[c.alias(n) for n, c in effective_columns(F.col("policy")).items()],
    )


def _screen_rules(config: LiquidityConfig) -> list[tuple[Column, str]]:
    def below(name: str, minimum: float | None) -> Column:
        if minimum is None:
            return F.lit(False)
        return F.coalesce(F.col(name) < minimum, F.lit(True))

    if config.max_zero_volume_frequency is None:
        idle = F.lit(False)
    else:
        idle = F.coalesce(
            F.col("zero_frequency") > config.max_zero_volume_frequency, F.lit(True)
        )
    return [
        (below("trading_frequency", config.min_trading_frequency), "trading_frequency_below_minimum"),
        (idle, "zero_volume_frequency_above_maximum"),
        (below("average_volume", config.min_average_volume), "average_volume_below_minimum"),
        (
            below("average_value", config.min_average_traded_value_vnd),
            "average_traded_value_vnd_below_minimum",
        ),
    ]


__all__ = [
    "LiquidityConfig",
    "availability",
    "daily_panel",
    "liquidity",
    "liquidity_window",
    "require_columns",
    "select_window",
]
