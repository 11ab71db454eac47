"""Dataset contracts: versions, keys, orderings and columns.

Everything here is declarative.  Operators stamp the version into their output and
the checks compare a frame's columns with the contract before looking at values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: contract versions -------------------------------------------------
RESEARCH_UNIVERSE_VERSION = "research-universe-v1"
NORMALIZED_DAILY_VERSION = "normalized-daily-v2"
DAILY_PANEL_VERSION = "daily-panel-v2"
LIQUIDITY_VERSION = "liquidity-characterization-v2"
AVAILABILITY_VERSION = "daily-availability-v1"
COVERAGE_VERSION = "daily-coverage-v1"
CAMPAIGN_VERSION = "daily-ingestion-campaign-v1"
READINESS_POLICY_VERSION = "campaign-research-readiness-policy-v1"
ASSEMBLED_VERSION = "assembled-daily-v1"

# --- fixed values: market time -------------------------------------------------------
MARKET_TIMEZONE = "Asia/Ho_Chi_Minh"
HOLIDAY_STATUS = "weekday_only_vietnam_holidays_not_applied"

PROVIDER = "vnstock"
DAILY_RESOLUTION = "1D"
MAX_BARS_PER_REQUEST = 1000
MAX_CHUNK_CALENDAR_DAYS = 1095

PRICE_COLUMNS = ["open", "high", "low", "close"]
VALUE_COLUMNS = [*PRICE_COLUMNS, "volume"]

# --- fixed values: provenance columns, in contract order ------------------------------
PROVENANCE_COLUMNS = [
    "unit_provenance_schema_version",
    "provider",
    "data_backend",
    "source_resolution",
    "source_unit_policy_name",
    "source_unit_policy_version",
    "source_price_unit",
    "source_volume_unit",
    "source_price_scale_to_vnd",
    "source_volume_scale_to_shares",
    "source_unit_evidence_reference",
]
SOURCE_PROVENANCE_COLUMNS = [
    c for c in PROVENANCE_COLUMNS if c not in ("provider", "source_resolution")
]
PROVENANCE_TYPES = {
    c: ("double" if "_scale_" in c else "string") for c in PROVENANCE_COLUMNS
}

# --- fixed values: columns of the effective unit policy -------------------------------
EFFECTIVE_UNIT_COLUMNS = [
    "unit_provenance_status",
    "unit_verification_status",
    "unit_policy_name",
    "unit_policy_version",
    "price_unit",
    "volume_unit",
    "traded_value_unit",
    "unit_evidence_reference",
    "unit_verification_reason",
    "vnd_traded_value_permitted",
]


@dataclass(frozen=True)
class Contract:
    name: str
    version: str
    keys: list[str]
    ordering: list[str]
    columns: list[str]
    nullable: list[str] = field(default_factory=list)

    def missing(self, columns: list[str]) -> list[str]:
        return sorted(set(self.columns) - set(columns))


RESEARCH_UNIVERSE = Contract(
    "research_universe",
    RESEARCH_UNIVERSE_VERSION,
    keys=["source_snapshot_observed_at_utc", "input_row_number"],
    ordering=["candidate_status", "symbol", "input_row_number"],
    columns=[
        "feature_input_contract_version",
        "input_row_number",
        "provider",
        "exchange",
        "symbol_raw",
        "symbol",
        "provider_security_type",
        "classification_provenance",
        "candidate_status",
        "candidate_reasons",
        "tradability_status",
        "source_snapshot_timestamp_raw",
        "source_snapshot_observed_at_utc",
        "source_snapshot_timezone_status",
        "source_snapshot_interpretation",
        "source_snapshot_localization_applied",
        "requested_reference_date",
        "historical_membership_status",
        "historical_membership_verified",
    ],
    nullable=["symbol", "requested_reference_date"],
)

_DAILY_BASE = [
    "provider",
    "symbol",
    "exchange",
    "date",
    *VALUE_COLUMNS,
    "adjusted_flag",
    "source_resolution",
    "ingestion_timestamp_utc",
]

NORMALIZED_DAILY = Contract(
    "normalized_daily",
    NORMALIZED_DAILY_VERSION,
    keys=["symbol", "date"],
    ordering=["symbol", "date"],
    columns=[*_DAILY_BASE, *SOURCE_PROVENANCE_COLUMNS],
    nullable=["exchange", "adjusted_flag"],
)

#: Types of stored daily rows; reading with them needs no merging of file footers.
NORMALIZED_DAILY_TYPES = {
    "date": "date",
    **dict.fromkeys(VALUE_COLUMNS, "double"),
    "adjusted_flag": "boolean",
    "ingestion_timestamp_utc": "timestamp",
    **{c: PROVENANCE_TYPES[c] for c in SOURCE_PROVENANCE_COLUMNS},
}
NORMALIZED_DAILY_SCHEMA = ", ".join(
    f"{c} {NORMALIZED_DAILY_TYPES.get(c, 'string')}" for c in NORMALIZED_DAILY.columns
)

# Columns a daily frame needs before any check can run (legacy frames lack provenance).
DAILY_REQUIRED = [c for c in _DAILY_BASE if c != "exchange"]
PANEL_SOURCE_REQUIRED = list(_DAILY_BASE)

DAILY_PANEL = Contract(
    "daily_panel",
    DAILY_PANEL_VERSION,
    keys=["symbol", "date"],
    ordering=["symbol", "date"],
    columns=[
        "feature_input_contract_version",
        "provider",
        "symbol",
        "exchange",
        "date",
        *VALUE_COLUMNS,
        "observation_status",
        "price_adjustment_status",
        "source_adjusted_flag",
        "source_resolution",
        "data_backend",
        "unit_provenance_schema_version",
        "source_unit_policy_name",
        "source_unit_policy_version",
        "source_price_unit",
        "source_volume_unit",
        "source_price_scale_to_vnd",
        "source_volume_scale_to_shares",
        "source_unit_evidence_reference",
        "source_ingestion_timestamp_utc",
        "source_dataset",
        "daily_date_semantics",
        "timestamp_status",
        "market_timezone_convention",
        *EFFECTIVE_UNIT_COLUMNS,
    ],
)

LIQUIDITY = Contract(
    "liquidity_characterization",
    LIQUIDITY_VERSION,
    keys=["symbol", "reference_date"],
    ordering=["symbol"],
    columns=[
        "feature_input_contract_version",
        *PROVENANCE_COLUMNS,
        "symbol",
        "reference_date",
        "window_start_date",
        "window_weekdays",
        "observed_date_count",
        "out_of_weekday_calendar_observation_count",
        "trading_frequency",
        "zero_volume_frequency",
        "average_volume_provider_units",
        "average_traded_value_vnd",
        "recent_valid_close",
        "recent_valid_close_date",
        "insufficient_history",
        "missing_data_status",
        "screen_status",
        "screen_reasons",
        *EFFECTIVE_UNIT_COLUMNS,
    ],
)

AVAILABILITY = Contract(
    "daily_availability",
    AVAILABILITY_VERSION,
    keys=["symbol", "requested_start_date", "requested_end_date"],
    ordering=["symbol"],
    columns=[
        "feature_input_contract_version",
        "symbol",
        "requested_start_date",
        "requested_end_date",
        "observed_start_date",
        "observed_end_date",
        "observation_count",
        "duplicate_count",
        "missing_ohlc_count",
        "invalid_ohlc_count",
        "zero_volume_count",
        "expected_weekday_count",
        "observed_expected_weekday_count",
        "missing_expected_weekday_count",
        "weekday_coverage_ratio",
        "weekend_observation_count",
        "absence_of_data",
        "expected_session_model",
        "holiday_calendar_status",
    ],
)

COVERAGE_COUNT_COLUMNS = [
    "observation_count",
    "unique_observation_date_count",
    "duplicate_row_count",
    "conflicting_duplicate_date_count",
    "source_file_count",
    "requested_weekday_count",
    "observed_span_weekday_count",
    "observed_span_missing_weekday_count",
    "longest_missing_weekday_streak",
    "weekend_observation_count",
    "invalid_date_count",
    "missing_ohlc_count",
    "invalid_ohlc_count",
    "missing_volume_count",
    "negative_volume_count",
    "non_integer_volume_count",
    "zero_volume_count",
]

DAILY_COVERAGE = Contract(
    "daily_coverage",
    COVERAGE_VERSION,
    keys=["symbol", "universe_snapshot_date", "daily_run_id"],
    ordering=["coverage_status", "symbol"],
    columns=[
        "feature_input_contract_version",
        "symbol",
        "universe_snapshot_date",
        "current_universe_snapshot_status",
        "source_run_request_status",
        "daily_run_id",
        "requested_start_date",
        "requested_end_date",
        "first_observation_date",
        "last_observation_date",
        *COVERAGE_COUNT_COLUMNS[:6],
        "requested_weekday_coverage_ratio",
        "observed_span_weekday_count",
        "observed_span_missing_weekday_count",
        "observed_span_coverage_ratio",
        *COVERAGE_COUNT_COLUMNS[8:],
        "zero_volume_frequency",
        "stale_calendar_days",
        "stale",
        "minimum_history_observations",
        "minimum_span_coverage_ratio",
        "maximum_zero_volume_frequency",
        "provider",
        "data_backend",
        *EFFECTIVE_UNIT_COLUMNS,
        "raw_ohlcv_research_usable",
        "vnd_liquidity_research_usable",
        "adjusted_price_research_usable",
        "point_in_time_universe_research_usable",
        "coverage_status",
        "coverage_reasons",
        "known_risks",
    ],
)

ASSEMBLED_DAILY = Contract(
    "assembled_daily",
    ASSEMBLED_VERSION,
    keys=["symbol", "date"],
    ordering=["symbol", "date"],
    columns=[
        *DAILY_PANEL.columns,
        "assembly_contract_version",
        "campaign_id",
        "assembled_dataset_id",
        "source_run_id",
        "source_normalized_path",
    ],
)

CONTRACTS = {
    c.name: c
    for c in (
        RESEARCH_UNIVERSE,
        NORMALIZED_DAILY,
        DAILY_PANEL,
        LIQUIDITY,
        AVAILABILITY,
        DAILY_COVERAGE,
        ASSEMBLED_DAILY,
    )
}

# --- fixed values: status vocabularies -----------------------------------------------
TASK_STATUSES = ["pending", "complete", "empty", "failed", "stale", "incompatible"]
RESOLVED_TASK_STATUSES = ["complete", "empty"]
COVERAGE_STATUSES = [
    "not_ingested",
    "absent",
    "blocking_quality_issues",
    "stale",
    "insufficient_history",
    "sparse",
    "usable_non_monetary",
    "usable_vnd",
]
CAPABILITY_STATUSES = [
    "VERIFIED",
    "DOCUMENTED_NOT_TESTED",
    "UNAVAILABLE_FREE_TIER",
    "UNAVAILABLE_PACKAGE",
    "AUTHENTICATION_REQUIRED",
    "RATE_LIMITED",
    "NETWORK_ERROR",
    "PROVIDER_ERROR",
    "INVALID_SCHEMA",
    "EMPTY_RESPONSE",
    "UNKNOWN",
]
KNOWN_COVERAGE_RISKS = [
    "weekday_calendar_does_not_remove_vietnam_holidays_or_exchange_closures",
    "price_adjustment_semantics_unverified",
    "corporate_action_completeness_unverified",
    "historical_universe_membership_unverified",
]
