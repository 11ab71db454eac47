"""Research universe: snapshot selection, candidate classification, liquidity merge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.contracts import RESEARCH_UNIVERSE, RESEARCH_UNIVERSE_VERSION
from barledger.functions.exprs import clean_text, holds, lit_date, strip, timestamp_facts

# --- fixed values ---------------------------------------------------------------------
STOCK_TYPES = ["stock", "equity"]
NON_STOCK_TYPES = ["bond", "cw", "etf", "fund", "futures", "warrant"]
SYMBOL_SHAPE = r"\A[A-Z0-9]{1,16}\z"


def _observed(df: DataFrame) -> Column:
    kind = df.schema["snapshot_timestamp_utc"].dataType
    return timestamp_facts(F.col("snapshot_timestamp_utc"), kind)["utc"]


def latest_snapshot(universe: DataFrame, on: dt.date | str | None = None) -> DataFrame:
    """Rows of the newest source-aware snapshot, optionally of one observed date."""
    rows = universe.withColumn("__observed", _observed(universe)).where("__observed is not null")
    if on is not None:
        rows = rows.where(F.col("__observed").cast("date") == lit_date(on))
    newest = rows.agg(F.max("__observed").alias("t")).scalar()
    return rows.where(F.col("__observed") == newest).drop("__observed")


def research_universe(
    universe: DataFrame,
    exchange: str,
    reference: dt.date | str | None = None,
    ordinal: str = "input_ordinal",
) -> DataFrame:
    """Classify every snapshot row; the row count is preserved.

    ``ordinal`` is the row's position in the input.  Repeated symbols are found with an
    aggregate and joined back, so a symbol shared by many rows never meets in one task.
    """
    facts = timestamp_facts(
        F.col("snapshot_timestamp_utc"), universe.schema["snapshot_timestamp_utc"].dataType
    )
    rows = universe.select(
        "*",
        F.col(ordinal).cast("bigint").alias("input_row_number"),
        F.col("symbol").cast("string").alias("symbol_raw"),
        F.upper(strip(F.col("exchange").cast("string"))).alias("__exchange"),
        clean_text(F.col("symbol")).alias("__symbol"),
        F.col("security_type").cast("string").alias("provider_security_type"),
        facts["raw"].alias("source_snapshot_timestamp_raw"),
        facts["utc"].alias("source_snapshot_observed_at_utc"),
        facts["status"].alias("source_snapshot_timezone_status"),
        facts["interpretation"].alias("source_snapshot_interpretation"),
    ).drop("symbol", "exchange", "security_type", "snapshot_timestamp_utc")
    rows = rows.withColumnsRenamed({"__symbol": "symbol", "__exchange": "exchange"})
    repeated = (
        rows.where("symbol is not null")
        .groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .select("symbol", F.lit(True).alias("__repeated"))
    )
    if reference is None:
        historical, requested = F.lit(False), F.lit(None).cast("date")
    else:
        requested = lit_date(reference)
        differs = F.coalesce(
            F.col("source_snapshot_observed_at_utc").cast("date") != requested, F.lit(True)
        )
        historical = rows.agg(
            F.coalesce(F.bool_or(differs), F.lit(False)).alias("historical")
        ).scalar()
    kind = F.lower(strip(F.col("provider_security_type")))
    tagged = rows.join(repeated, "symbol", "left").withColumn("__historical", historical)
    malformed = F.col("symbol").isNull() | ~F.col("symbol").rlike(SYMBOL_SHAPE)
    elsewhere = ~holds(F.col("exchange") == exchange.strip().upper())
    doubled = F.col("__repeated").isNotNull()
    stock, other = holds(kind.isin(STOCK_TYPES)), holds(kind.isin(NON_STOCK_TYPES))
    status = (
        F.when(malformed | elsewhere, "excluded")
        .when(doubled, "uncertain")
        .when(stock, "included_candidate")
        .when(other, "excluded")
        .otherwise("uncertain")
    )
    reason = (
        F.when(malformed, "malformed_or_missing_symbol")
        .when(elsewhere, "exchange_mismatch_or_missing")
        .when(doubled, "duplicate_symbol_records")
        .when(stock, "provider_reported_stock_candidate")
        .when(other, F.concat(F.lit("provider_reported_non_stock_type:"), kind))
        .otherwise("unsupported_or_unknown_security_type")
    )
    unverified = F.col("__historical")
    output = tagged.withColumns(
        {
            "feature_input_contract_version": F.lit(RESEARCH_UNIVERSE_VERSION),
            "classification_provenance": F.lit("provider_reported_unverified"),
            "source_snapshot_localization_applied": F.lit(False),
            "requested_reference_date": requested,
            "historical_membership_status": F.when(
                unverified, "requested_reference_unverified"
            ).otherwise("current_snapshot_only"),
            "historical_membership_verified": F.lit(False),
            "tradability_status": F.lit("not_verified"),
            "candidate_status": status,
            "candidate_reasons": F.array_compact(
                F.array(reason, F.when(unverified, "historical_membership_not_verified"))
            ),
        }
    ).drop("__repeated", "__historical")
    lead = RESEARCH_UNIVERSE.columns
    skip = {*lead, ordinal}
    return output.select(*lead, *[c for c in output.columns if c not in skip])


def included_symbols(universe: DataFrame) -> DataFrame:
    """Distinct symbols of included candidates."""
    return (
        universe.where((F.col("candidate_status") == "included_candidate"))
        .where("symbol is not null")
        .select("symbol")
        .distinct()
    )


def apply_liquidity(universe: DataFrame, liquidity: DataFrame) -> DataFrame:
    """Many-to-one left join on symbol; only included candidates change status.

    A repeated symbol on the liquidity side fails the job.
    """
    renamed = liquidity.select(
        "symbol",
        *[
            F.col(c).alias(f"liquidity_{c}")
            for c in liquidity.columns
            if c not in ("symbol", "feature_input_contract_version")
        ],
    )
    sizes = liquidity.groupBy("symbol").agg(F.count(F.lit(1)).alias("__n"))
    checked = renamed.join(sizes, "symbol").withColumn(
        "__unique",
        F.when(F.col("__n") == 1, F.lit(True)).otherwise(
            F.raise_error(F.lit("Liquidity must carry one row per symbol."))
        ),
    )
    checked = checked.where("__unique").drop("__n", "__unique")
    joined = universe.join(checked, "symbol", "left")
    screen = F.col("liquidity_screen_status")
    included = F.col("candidate_status") == "included_candidate"
    no_history = holds(screen.isin("insufficient_history", "absent_data"))
    status = (
        F.when(~included, F.col("candidate_status"))
        .when(holds(screen == "failed"), "excluded")
        .when(holds(screen == "passed"), F.col("candidate_status"))
        .otherwise("uncertain")
    )
    reason = (
        F.when(holds(screen == "failed"), "liquidity_screen_failed")
        .when(no_history, F.concat(F.lit("liquidity_"), screen))
        .when(holds(screen == "passed"), "liquidity_screen_passed")
        .otherwise("liquidity_not_available")
    )
    columns = [*universe.columns, *[c for c in checked.columns if c != "symbol"]]
    return joined.withColumns(
        {
            "candidate_status": status,
            "candidate_reasons": F.when(
                included, F.array_append("candidate_reasons", reason)
            ).otherwise(F.col("candidate_reasons")),
        }
    ).select(*columns)
