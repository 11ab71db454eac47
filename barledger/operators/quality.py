"""Check catalogs per dataset, on top of the generic evaluator in ``checks``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barledger.contracts import (
    ASSEMBLED_DAILY,
    ASSEMBLED_VERSION,
    AVAILABILITY,
    COVERAGE_COUNT_COLUMNS,
    COVERAGE_STATUSES,
    DAILY_COVERAGE,
    DAILY_PANEL,
    DAILY_REQUIRED,
    EFFECTIVE_UNIT_COLUMNS,
    LIQUIDITY,
    PRICE_COLUMNS,
    RESEARCH_UNIVERSE,
    VALUE_COLUMNS,
)
from barledger.functions.exprs import (
    any_of,
    high_below_low,
    high_below_open_close,
    holds,
    lit_date,
    low_above_open_close,
    non_integer,
    null_ohlc,
    strip,
)
from barledger.operators.checks import (
    ERROR,
    INFO,
    WARNING,
    Rule,
    fact_check,
    non_negative,
    required_columns,
    run_checks,
    uniqueness_check,
)
from barledger.operators.normalize import universe_diagnostics
from barledger.operators.ordering import order_breaks, session_gaps
from barledger.operators.sets import missing_symbols, union_all
from barledger.operators.units import ensure_provenance_columns, policy_value, unit_policy

_DAY_KEYS = ["symbol", "date"]


def ohlc_rules() -> list[Rule]:
    return [
        Rule("high_gte_low", ERROR, high_below_low(), PRICE_COLUMNS, "High is below low."),
        Rule(
            "high_gte_open_close",
            ERROR,
            high_below_open_close(),
            PRICE_COLUMNS,
            "High is below open or close.",
        ),
        Rule(
            "low_lte_open_close",
            ERROR,
            low_above_open_close(),
            PRICE_COLUMNS,
            "Low is above open or close.",
        ),
        Rule(
            "volume_integer_like",
            ERROR,
            non_integer(F.col("volume")),
            ["volume"],
            "Volume is not a whole number.",
        ),
    ]


def future_rule(as_of: dt.date | str) -> Rule:
    return Rule(
        "future_dates",
        ERROR,
        F.col("date") > F.date_add(lit_date(as_of), 1),
        ["date"],
        "Dates lie beyond the calendar tolerance.",
    )


def daily_row_rules(as_of: dt.date | str) -> list[Rule]:
    """Row-level blocking rules of daily bars (uniqueness is a separate aggregate)."""
    return [*non_negative(VALUE_COLUMNS), *ohlc_rules(), future_rule(as_of)]


def daily_row_blocked(as_of: dt.date | str) -> Column:
    return any_of(r.fails for r in daily_row_rules(as_of))


def _sortedness(
    df: DataFrame, dataset: str, name: str, severity: str, position: str, keys: list[Column]
) -> DataFrame:
    breaks = order_breaks(df, position, keys)
    return fact_check(
        breaks, dataset, name, severity, F.col("order_break_count") > 0, message="Rows are not sorted."
    )


def check_daily(
    df: DataFrame,
    as_of: dt.date | str,
    position: str | None = None,
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """Checks of daily bars; ``counts`` are observed metrics of ``daily_row_rules``."""
    dataset = "daily"
    gate = required_columns(df, dataset, DAILY_REQUIRED)
    if gate is not None:
        return gate
    parts = [
        run_checks(df, dataset, daily_row_rules(as_of), _DAY_KEYS, counts),
        uniqueness_check(df, dataset, "duplicate_symbol_date", _DAY_KEYS),
    ]
    if position:
        parts.append(
            _sortedness(
                df, dataset, "sorted_symbol_date", WARNING, position,
                [F.col("symbol"), F.col("date")],
            )
        )
    policy = unit_policy(df)
    level = F.when(F.col("unit_verification_status") == "verified", INFO).otherwise(WARNING)
    parts.append(
        fact_check(
            policy, dataset, "daily_unit_provenance", level, F.lit(True), F.col("row_count"),
            ["provider", "source_resolution"], F.col("unit_verification_reason"),
        )
    )
    return union_all(parts)


_INTRADAY_REQUIRED = [
    "provider", "symbol", "timestamp", "trading_date", "resolution", *VALUE_COLUMNS,
    "volume_semantics", "bar_status", "ingestion_timestamp_utc",
]
_INTRADAY_PROVENANCE = [
    "provider_timestamp_raw", "timestamp_timezone_status", "timestamp_interpretation",
    "timestamp_localization_applied",
]


def intraday_instant(df: DataFrame) -> Column:
    """Comparable instant: UTC where the source was zoned, else the wall clock."""
    if "timestamp_utc" in df.columns:
        return F.coalesce(F.col("timestamp_utc"), F.col("timestamp").cast("timestamp"))
    return F.col("timestamp").cast("timestamp")


def _zoned(df: DataFrame) -> Column:
    zoned = F.col("timestamp_utc").isNotNull() if "timestamp_utc" in df.columns else F.lit(False)
    return F.lit(True) if isinstance(df.schema["timestamp"].dataType, T.TimestampType) else zoned


def intraday_row_rules(df: DataFrame) -> list[Rule]:
    """Row-level rules for bars with the columns of ``df``."""
    zoned = _zoned(df)
    rules = [
        *non_negative(VALUE_COLUMNS),
        Rule(
            "timestamp_parse", ERROR, F.col("timestamp").isNull(), ["timestamp"],
            "The timestamp could not be parsed.",
        ),
        Rule(
            "timestamp_timezone_naive", WARNING, F.col("timestamp").isNotNull() & ~zoned,
            ["timestamp"], "Timestamps carry no time zone.", counts_rows=False,
        ),
    ]
    missing = sorted(set(_INTRADAY_PROVENANCE) - set(df.columns))
    if missing:
        rules.append(
            Rule("legacy_timestamp_provenance_missing", WARNING, F.lit(True), missing)
        )
    else:
        rules.append(
            Rule(
                "no_unverified_naive_localization",
                ERROR,
                (F.col("timestamp_timezone_status") == "naive")
                & holds(F.col("timestamp_localization_applied")),
                _INTRADAY_PROVENANCE,
            )
        )
    return rules


def check_intraday(
    df: DataFrame, position: str | None = None, counts: dict[str, int] | None = None
) -> DataFrame:
    """Checks of intraday bars; ``counts`` are observed metrics of ``intraday_row_rules``."""
    dataset = "intraday"
    gate = required_columns(df, dataset, _INTRADAY_REQUIRED)
    if gate is not None:
        return gate
    keyed = df.withColumns(
        {"__zoned": _zoned(df), "__instant": intraday_instant(df)}
    )
    parts = [
        run_checks(df, dataset, intraday_row_rules(df), ["symbol", "timestamp"], counts),
        uniqueness_check(
            keyed, dataset, "duplicate_symbol_resolution_timestamp",
            ["symbol", "resolution", "__zoned", "__instant"],
            sample_keys=["symbol", "resolution", "__instant"],
        ).withColumn(
            "affected_columns", F.array(*[F.lit(c) for c in ("symbol", "resolution", "timestamp")])
        ),
        fact_check(
            session_gaps(keyed, ["symbol", "resolution"], "__instant"), dataset,
            "session_break_gaps", INFO, F.col("gap_count") > 0, F.col("gap_count"),
            ["timestamp"], "Large gaps consistent with session breaks.",
        ),
    ]
    if position:
        parts.append(
            _sortedness(
                keyed, dataset, "sorted_symbol_resolution_timestamp", WARNING, position,
                [F.col("symbol"), F.col("resolution"), F.col("__instant")],
            )
        )
    return union_all(parts)


_UNIVERSE_REQUIRED = [
    "provider", "exchange", "symbol", "organ_name", "english_organ_name", "security_type",
    "provider_id", "snapshot_timestamp_utc", "raw_exchange_field", "raw_type_field",
]


def check_universe(rows: DataFrame, exchange: str) -> DataFrame:
    """Checks of a snapshot; ``rows`` are the normalized rows before the exchange filter."""
    dataset = "universe"
    gate = required_columns(rows, dataset, _UNIVERSE_REQUIRED)
    if gate is not None:
        return gate
    kept = rows.where(F.col("exchange") == exchange.upper())
    before = universe_diagnostics(rows)
    after = kept.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("kept_duplicates")
    )
    facts = before.withColumn("kept_duplicates", after.scalar())
    own = F.col("kept_duplicates") > 0
    return union_all(
        [
            run_checks(
                kept, dataset, [Rule("symbol_not_null", ERROR, F.col("symbol").isNull(), ["symbol"])]
            ),
            fact_check(
                facts, dataset, "duplicate_symbols", ERROR, own | (F.col("duplicate_symbols") > 0),
                F.when(own, F.col("kept_duplicates")).otherwise(F.col("duplicate_symbols")),
                ["symbol"],
            ),
            fact_check(
                facts, dataset, "null_exchange_fields", WARNING, F.col("null_exchange_rows") > 0,
                F.col("null_exchange_rows"), ["exchange", "raw_exchange_field"],
            ),
            fact_check(
                facts, dataset, "hose_filtering", INFO, F.lit(True), F.col("total_returned_rows"),
                message=F.concat(
                    F.col("total_returned_rows").cast("string"), F.lit(" rows returned, "),
                    F.col("hose_rows").cast("string"), F.lit(" on HOSE."),
                ),
            ),
        ]
    )


def check_research_universe(df: DataFrame, expected_rows: int | Column) -> DataFrame:
    dataset = "research_universe"
    gate = required_columns(df, dataset, RESEARCH_UNIVERSE.columns)
    if gate is not None:
        return gate
    requested = F.col("requested_reference_date")
    observed = F.col("source_snapshot_observed_at_utc")
    wrong_status = (
        requested.isNotNull()
        & (F.col("historical_membership_status") != "requested_reference_unverified")
        & ~holds(requested == observed.cast("date"))
    )
    rules = [
        Rule(
            "no_false_historical_membership", ERROR, F.col("historical_membership_verified"),
            ["historical_membership_verified"], counts_rows=False,
        ),
        Rule(
            "requested_reference_is_not_membership_evidence", ERROR, wrong_status,
            ["requested_reference_date", "historical_membership_status"],
        ),
        Rule(
            "snapshot_observation_timestamp", ERROR, observed.isNull(),
            ["source_snapshot_observed_at_utc"],
        ),
        Rule(
            "snapshot_timezone_awareness", ERROR,
            F.coalesce(F.col("source_snapshot_timezone_status") != "aware", F.lit(True)),
            ["source_snapshot_timezone_status"],
        ),
    ]
    return union_all(
        [
            _row_count(df, dataset, "input_rows_auditable", expected_rows),
            uniqueness_check(df, dataset, "input_row_number_unique", ["input_row_number"]),
            run_checks(df, dataset, rules),
        ]
    )


def _row_count(df: DataFrame, dataset: str, name: str, expected: int | Column) -> DataFrame:
    expected = expected if isinstance(expected, Column) else F.lit(expected)
    counted = df.agg(F.count(F.lit(1)).alias("n")).withColumn("expected", expected)
    return fact_check(
        counted, dataset, name, ERROR, F.col("n") != F.col("expected"),
        F.abs(F.col("n") - F.col("expected")),
    )


def unit_mismatch(df: DataFrame) -> DataFrame:
    """Adds ``__mismatch``: effective unit columns differ from the recomputed policy."""
    policy = policy_value(ensure_provenance_columns(df))
    stamped = df.withColumn("__policy", policy)
    differs = any_of(
        ~F.col(c).eqNullSafe(F.col("__policy")[c]) for c in EFFECTIVE_UNIT_COLUMNS if c in df.columns
    )
    return stamped.withColumn("__mismatch", differs).drop("__policy")


def _unit_rule() -> Rule:
    return Rule(
        "effective_unit_provenance_consistency", ERROR, F.col("__mismatch"), EFFECTIVE_UNIT_COLUMNS
    )


def check_daily_panel(
    df: DataFrame, expected_rows: int | Column, position: str | None = None
) -> DataFrame:
    dataset = "daily_panel"
    gate = required_columns(df, dataset, DAILY_PANEL.columns)
    if gate is not None:
        return gate
    rules = [
        _unit_rule(),
        Rule(
            "panel_keys_not_null", ERROR, F.col("symbol").isNull() | F.col("date").isNull(), _DAY_KEYS
        ),
        *non_negative(VALUE_COLUMNS),
        *ohlc_rules(),
        Rule("missing_ohlc_preserved", WARNING, null_ohlc(), PRICE_COLUMNS),
        Rule(
            "no_synthetic_bars", ERROR, F.col("observation_status") != "observed_provider_bar",
            ["observation_status"], counts_rows=False,
        ),
        Rule(
            "price_adjustment_unknown", WARNING, F.col("price_adjustment_status") == "unknown",
            ["price_adjustment_status"],
        ),
    ]
    parts = [
        _row_count(df, dataset, "observed_rows_preserved", expected_rows),
        run_checks(unit_mismatch(df), dataset, rules, _DAY_KEYS),
        uniqueness_check(df, dataset, "duplicate_symbol_date", _DAY_KEYS),
    ]
    if position:
        parts.append(
            _sortedness(
                df, dataset, "deterministic_ordering", ERROR, position,
                [F.col("symbol"), F.col("date")],
            )
        )
    return union_all(parts)


def check_assembled(
    df: DataFrame, expected_rows: int | Column, campaign_id: str, dataset_id: str | Column
) -> DataFrame:
    dataset = "assembled_daily"
    gate = required_columns(df, dataset, ASSEMBLED_DAILY.columns)
    if gate is not None:
        return gate
    expected = {
        "assembly_contract_version": F.lit(ASSEMBLED_VERSION),
        "campaign_id": F.lit(campaign_id),
        "assembled_dataset_id": dataset_id if isinstance(dataset_id, Column) else F.lit(dataset_id),
    }
    lineage = ["source_run_id", "source_normalized_path"]
    blank = any_of(
        F.coalesce(strip(F.col(c).cast("string")) == "", F.lit(True)) for c in lineage
    )
    rules = [
        *[
            Rule(f"{c}_consistent", ERROR, ~F.col(c).eqNullSafe(value), [c])
            for c, value in expected.items()
        ],
        Rule("source_lineage_complete", ERROR, blank, lineage),
    ]
    return union_all(
        [
            _row_count(df, dataset, "assembled_rows_preserved", expected_rows),
            run_checks(df, dataset, rules, _DAY_KEYS),
            uniqueness_check(df, dataset, "assembled_symbol_date_unique", _DAY_KEYS),
        ]
    )


def _outside_unit(c: str) -> Column:
    return ~F.col(c).between(0.0, 1.0)


def check_liquidity(df: DataFrame) -> DataFrame:
    dataset = "liquidity"
    gate = required_columns(df, dataset, LIQUIDITY.columns)
    if gate is not None:
        return gate
    unverified = F.coalesce(F.col("unit_verification_status") != "verified", F.lit(True))
    no_provenance = F.coalesce(F.col("unit_provenance_status") != "verified", F.lit(True))
    permitted = holds(F.col("vnd_traded_value_permitted"))
    has_value = F.col("average_traded_value_vnd").isNotNull()
    rules = [
        *[
            Rule(f"{c}_range", ERROR, _outside_unit(c), [c])
            for c in ("trading_frequency", "zero_volume_frequency")
        ],
        Rule(
            "monetary_units_verified", ERROR,
            (unverified | no_provenance | ~permitted) & has_value, ["average_traded_value_vnd"],
        ),
        Rule(
            "vnd_permission_requires_verified_provenance", ERROR,
            permitted & (unverified | no_provenance), ["vnd_traded_value_permitted"],
        ),
        Rule(
            "traded_value_unit_consistency", ERROR,
            (F.col("traded_value_unit") == "unavailable") & has_value,
            ["traded_value_unit", "average_traded_value_vnd"],
        ),
    ]
    claims = df.where(~unverified | permitted | has_value | (F.col("traded_value_unit") == "vnd"))
    return union_all(
        [
            run_checks(df, dataset, rules),
            run_checks(unit_mismatch(claims), dataset, [_unit_rule()], ["symbol"]),
        ]
    )


def check_availability(df: DataFrame) -> DataFrame:
    dataset = "daily_availability"
    gate = required_columns(df, dataset, AVAILABILITY.columns)
    if gate is not None:
        return gate
    rules = [
        Rule(
            "weekday_coverage_ratio_range", ERROR, _outside_unit("weekday_coverage_ratio"),
            ["weekday_coverage_ratio"],
        ),
        Rule(
            "absence_consistency", ERROR,
            F.col("absence_of_data") & (F.col("observation_count") > 0),
            ["absence_of_data", "observation_count"],
        ),
    ]
    return run_checks(df, dataset, rules)


def check_coverage(df: DataFrame, expected_symbols: int | Column) -> DataFrame:
    dataset = "daily_coverage"
    gate = required_columns(df, dataset, DAILY_COVERAGE.columns)
    if gate is not None:
        return gate
    f = F.col
    status, request = f("coverage_status"), f("source_run_request_status")
    observed = f("observation_count")

    def unlisted(c: Column, allowed: list[str]) -> Column:
        return F.coalesce(~c.isin(allowed), F.lit(True))

    def not_count(c: str) -> Column:
        n = f(c).cast("double")
        return n.isNull() | (n < 0) | (n % 1 != 0)

    usable = status.isin("usable_non_monetary", "usable_vnd")
    raw, vnd = holds(f("raw_ohlcv_research_usable")), holds(f("vnd_liquidity_research_usable"))
    request_mismatch = (
        ((status == "not_ingested") & (request != "not_requested"))
        | ((status == "absent") & (request != "requested"))
        | ((request == "not_requested_but_observed") & (status != "blocking_quality_issues"))
        | ((request == "not_requested") & (observed != 0))
        | ((request == "not_requested_but_observed") & (observed == 0))
    )
    bad_claim = vnd & (
        ~raw
        | ~holds(f("vnd_traded_value_permitted"))
        | ~holds(f("unit_provenance_status") == "verified")
        | ~holds(f("unit_verification_status") == "verified")
        | ~holds(f("traded_value_unit") == "vnd")
        | ~holds(status == "usable_vnd")
    )
    ratios = [
        "requested_weekday_coverage_ratio", "observed_span_coverage_ratio",
        "zero_volume_frequency", "minimum_span_coverage_ratio", "maximum_zero_volume_frequency",
    ]
    rules = [
        Rule(
            "coverage_contract_version", ERROR,
            ~f("feature_input_contract_version").eqNullSafe(F.lit(DAILY_COVERAGE.version)),
            ["feature_input_contract_version"],
        ),
        Rule("coverage_status_enum", ERROR, unlisted(status, COVERAGE_STATUSES), ["coverage_status"]),
        Rule(
            "current_snapshot_status_enum", ERROR,
            unlisted(
                f("current_universe_snapshot_status"),
                ["current_snapshot_candidate", "not_in_selected_current_snapshot"],
            ),
            ["current_universe_snapshot_status"],
        ),
        Rule(
            "source_run_request_status_enum", ERROR,
            unlisted(request, ["requested", "not_requested", "not_requested_but_observed"]),
            ["source_run_request_status"],
        ),
        *[Rule(f"{c}_range", ERROR, _outside_unit(c), [c]) for c in ratios],
        Rule(
            "diagnostic_counts_non_negative_integers", ERROR,
            any_of(not_count(c) for c in COVERAGE_COUNT_COLUMNS), COVERAGE_COUNT_COLUMNS,
        ),
        Rule(
            "absence_status_consistency", ERROR,
            status.isin("absent", "not_ingested") != (observed == 0),
            ["coverage_status", "observation_count"],
        ),
        Rule(
            "source_request_coverage_consistency", ERROR, request_mismatch,
            ["source_run_request_status", "coverage_status"],
        ),
        Rule(
            "raw_usability_status_consistency", ERROR, raw != usable,
            ["coverage_status", "raw_ohlcv_research_usable"],
        ),
        Rule(
            "vnd_usability_status_consistency", ERROR, vnd != (status == "usable_vnd"),
            ["coverage_status", "vnd_liquidity_research_usable"],
        ),
        Rule(
            "vnd_usability_requires_verified_provenance", ERROR, bad_claim,
            ["vnd_liquidity_research_usable", "unit_provenance_status"],
        ),
        Rule(
            "unsupported_research_claims_remain_false", ERROR,
            holds(f("adjusted_price_research_usable"))
            | holds(f("point_in_time_universe_research_usable")),
            ["adjusted_price_research_usable", "point_in_time_universe_research_usable"],
        ),
    ]
    keyed = df.withColumn("__symbol", F.nullif(strip(F.col("symbol")), F.lit("")))
    per_key = keyed.groupBy("symbol", "__symbol").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(
            F.sum(F.when((F.col("n") > 1) | F.col("__symbol").isNull(), F.col("n"))), F.lit(0)
        ).alias("bad")
    )
    return union_all(
        [
            _row_count(df, dataset, "audited_symbol_count", expected_symbols),
            run_checks(df, dataset, rules, ["symbol"]),
            fact_check(
                per_key, dataset, "symbol_key_unique_and_present", ERROR, F.col("bad") > 0,
                F.col("bad"), ["symbol"],
            ),
        ]
    )


_QUOTE_REQUIRED = [
    "provider", "symbol", "snapshot_timestamp_utc", "provider_time_raw", "provider_time_parsed",
    "provider_time_parse_status", "exchange",
]


def check_quotes(df: DataFrame, requested: DataFrame) -> DataFrame:
    """Quote checks.  A price column that is only partly filled raises its numeric warning."""
    dataset = "quotes"
    gate = required_columns(df, dataset, _QUOTE_REQUIRED)
    if gate is not None:
        return gate
    prices = [
        c for c in df.columns if c.endswith("_price") or c in ("price_change", "percent_change")
    ]
    volumes = [c for c in df.columns if "vol" in c or c in ("total_value", "foreign_room")]
    raw = F.col("provider_time_raw").cast("string")
    rules = [
        Rule("provider_time_raw_present", WARNING, raw.isNull(), ["provider_time_raw"]),
        Rule(
            "provider_time_not_misleading_1970", ERROR, F.year("provider_time_parsed") < 2000,
            ["provider_time_parsed", "provider_time_parse_status"],
        ),
        Rule(
            "numeric_provider_time_unparsed", ERROR,
            raw.rlike(r"\A\d+(\.\d+)?\z")
            & F.coalesce(
                F.col("provider_time_parse_status") != "provider_specific_unparsed", F.lit(True)
            ),
            ["provider_time_raw", "provider_time_parse_status"],
        ),
        *non_negative(volumes),
    ]
    fills = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in prices]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in prices]
    )
    partial = fills.select("n", F.explode(pairs).alias("p")).select("n", "p.*")
    gone = missing_symbols(requested, df)
    lost = gone.agg(F.count(F.lit(1)).alias("n"))
    sample = gone.orderBy("symbol").limit(5).agg(
        F.array_sort(F.collect_list("symbol")).alias("s")
    )
    lost = lost.withColumn("s", sample.scalar())
    return union_all(
        [
            fact_check(
                lost, dataset, "missing_requested_symbols", WARNING, F.col("n") > 0, F.col("n"),
                ["symbol"], samples=F.col("s"),
            ),
            run_checks(df, dataset, rules, ["symbol"]),
            fact_check(
                partial, dataset, F.concat(F.col("column"), F.lit("_numeric")), WARNING,
                (F.col("filled") > 0) & (F.col("filled") < F.col("n")),
                columns=F.array("column"), message="Values are partly missing or not numeric.",
            ),
        ]
    )

