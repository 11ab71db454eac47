"""Second-source qualification: probe inspection, comparison, criteria and verdict.

Probes are a small parameter table supplied by the user (probe_id, case_class, role,
symbol, start_date, end_date, bar_count, expected_empty, determinism_group,
boundary_dates, aggregate).  Responses are landed rows keyed by probe_id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.contracts import PRICE_COLUMNS, VALUE_COLUMNS
from barledger.functions.digests import multiset_digest, row_line
from barledger.functions.exprs import (
    all_of,
    any_of,
    count_where,
    holds,
    reasons,
    safe_ratio,
    weekdays_between,
)
from barledger.operators.ordering import exact_rank, order_breaks, top_rows
from barledger.operators.quality import daily_row_rules
from barledger.operators.units import REGISTERED, UnitProvenance, unit_policy

PROBE = "probe_id"
VERDICT_REQUIRED = [
    "schema_and_date_labels_valid",
    "requested_window_observations_match_probe_expectation",
    "ohlc_invariants_valid",
    "duplicate_dates_absent",
    "empty_response_behavior_verified",
    "end_inclusivity_verified",
    "start_semantics_characterized",
    "countback_through_1200_verified",
    "identical_request_deterministic",
    "vci_unit_provenance_registered",
    "cross_source_comparison_completed",
]
MIN_COMPARED_SYMBOLS = 5
MATERIAL_RATIO = 0.005


def probe_overlaps(probes: DataFrame, tasks: DataFrame) -> DataFrame:
    """Tasks of the probed symbol whose range overlaps the probe's."""
    p = probes.select(
        PROBE, "symbol", F.col("start_date").alias("probe_start"), F.col("end_date").alias("probe_end")
    )
    return p.join(tasks, "symbol").where(
        (F.col("start_date") <= F.col("probe_end")) & (F.col("end_date") >= F.col("probe_start"))
    )


def response_digests(rows: DataFrame, position: str, ties: list[str] = ()) -> DataFrame:
    """Order-sensitive digest per probe over time and values.

    The position inside the response is part of every hashed line, so the same rows in
    another order give another digest, while partial sums still combine map-side.
    """
    ranked = exact_rank(rows.withColumn("__none", F.lit(None).cast("date")), [PROBE], "__none",
                        position, ties, name="__rank")
    line = row_line(["__rank", F.date_format("date", "yyyy-MM-dd").alias("date"), *VALUE_COLUMNS])
    return ranked.groupBy(PROBE).agg(multiset_digest(line).alias("response_digest"))


def inspect_responses(
    probes: DataFrame, rows: DataFrame, position: str, as_of: dt.date | str, ties: list[str] = ()
) -> DataFrame:
    """One row of response metrics per probe.

    ``rows`` are normalized response rows with ``probe_id`` and the landed ordinal.
    Repeated days are compacted first, so one hot probe does not sit in one task.
    """
    bounds = probes.select(
        PROBE, F.col("start_date").alias("p_start"), F.col("end_date").alias("p_end")
    )
    r = rows.join(bounds, PROBE)
    inside = holds(F.col("date").between(F.col("p_start"), F.col("p_end")))
    rules = daily_row_rules(as_of)
    price = [F.col(c) for c in PRICE_COLUMNS]
    flat = all_of(price[0].eqNullSafe(p) for p in price[1:])
    per_day = r.groupBy(PROBE, "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(inside).alias("inside"),
        F.max(holds(F.col("date") < F.col("p_start"))).alias("before"),
        F.max(holds(F.col("date") > F.col("p_end"))).alias("after"),
        count_where(F.col("volume") == 0).alias("zero"),
        count_where(F.col("volume") > 0).alias("positive"),
        count_where(flat).alias("flat"),
        *[count_where(F.col(c).isNull()).alias(f"null_{c}") for c in VALUE_COLUMNS],
        *[count_where(holds(x.fails)).alias(f"r_{x.name}") for x in rules],
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    def windowed(c: str) -> Column:
        return total(F.when(F.col("inside"), F.col(c)))

    extra = F.col("n") - 1
    stats = per_day.groupBy(PROBE).agg(
        total(F.col("n")).alias("raw_row_count"),
        windowed("n").alias("window_row_count"),
        total(F.when(F.col("before"), F.col("n"))).alias("rows_before_requested_start"),
        total(F.when(F.col("after"), F.col("n"))).alias("rows_after_requested_end"),
        total(F.when(F.col("date").isNull(), F.col("n"))).alias("malformed_time_count"),
        F.min("date").alias("earliest_response_date"),
        F.max("date").alias("latest_response_date"),
        total(extra).alias("duplicate_date_count"),
        total(F.when(F.col("inside"), extra)).alias("window_duplicate_date_count"),
        total(F.col("zero")).alias("zero_volume_row_count"),
        windowed("zero").alias("window_zero_volume_row_count"),
        windowed("positive").alias("window_positive_volume_row_count"),
        total(F.col("flat")).alias("flat_ohlc_row_count"),
        *[total(F.col(f"null_{c}")).alias(f"null_{c}_count") for c in VALUE_COLUMNS],
        *[total(F.col(f"r_{x.name}")).alias(f"r_{x.name}") for x in rules],
        *[windowed(f"r_{x.name}").alias(f"w_{x.name}") for x in rules],
    )
    breaks = order_breaks(
        rows.where("date is not null"), position, [F.col("date")], [PROBE]
    ).select(PROBE, "order_break_count")
    digests = response_digests(rows, position, ties)
    boundary = (
        probes.select(PROBE, F.explode("boundary_dates").alias("date"))
        .join(rows.select(PROBE, "date").distinct(), [PROBE, "date"], "left_anti")
        .groupBy(PROBE)
        .agg(F.count(F.lit(1)).alias("boundary_missing"))
    )
    joined = (
        probes.join(stats, PROBE, "left")
        .join(breaks, PROBE, "left")
        .join(digests, PROBE, "left")
        .join(boundary, PROBE, "left")
    )
    numbers = [
        c for c in stats.columns if c.endswith("_count") or c.startswith(("r_", "w_", "rows_"))
    ]
    filled = joined.withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in [*numbers, "boundary_missing"]}
    )
    checks = reasons(
        *[(F.col(f"r_{x.name}") > 0, x.name) for x in rules],
        (F.col("duplicate_date_count") > 0, "duplicate_symbol_date"),
    )
    window_checks = reasons(
        *[(F.col(f"w_{x.name}") > 0, x.name) for x in rules],
        (F.col("window_duplicate_date_count") > 0, "duplicate_symbol_date"),
    )
    empty = F.col("raw_row_count") == 0
    return filled.withColumns(
        {
            "window_expected_weekday_count": weekdays_between(
                F.col("start_date"), F.col("end_date")
            ).cast("bigint"),
            "raw_time_ordering": F.when(
                F.coalesce("order_break_count", F.lit(0)) == 0, "ascending"
            ).otherwise("not_ascending"),
            "boundary_required_count": F.size("boundary_dates").cast("bigint"),
            "boundary_missing_count": F.col("boundary_missing"),
            "count_limit_not_exceeded": F.col("raw_row_count") <= F.col("bar_count"),
            "empty_observed": empty,
            "empty_expectation_matched": empty == F.col("expected_empty"),
            "blocking_checks": checks,
            "window_blocking_checks": window_checks,
        }
    ).drop(
        "order_break_count",
        "boundary_missing",
        *[f"{p}_{x.name}" for x in rules for p in ("r", "w")],
    )


def determinism(inspected: DataFrame) -> DataFrame:
    """Per determinism group: at least two responses, all with one identical digest."""
    return (
        inspected.where("determinism_group is not null")
        .groupBy("determinism_group")
        .agg(
            F.count(F.lit(1)).alias("response_count"),
            F.countDistinct("response_digest").alias("distinct_digests"),
            F.count("response_digest").alias("digest_count"),
        )
        .select(
            "determinism_group",
            "response_count",
            (
                (F.col("response_count") >= 2)
                & (F.col("digest_count") == F.col("response_count"))
                & (F.col("distinct_digests") == 1)
            ).alias("exact_value_match"),
        )
    )


def all_groups_exact(groups: DataFrame) -> DataFrame:
    return groups.agg(
        F.coalesce(F.bool_and("exact_value_match"), F.lit(False)).alias("all_groups_exact")
    )


def _one_side(rows: DataFrame, tag: str) -> DataFrame:
    """One row per (probe, symbol, date); ``tag``_n counts the copies."""
    return rows.where("date is not null").groupBy(PROBE, "symbol", "date").agg(
        F.count(F.lit(1)).alias(f"{tag}_n"), *[F.max(c).alias(f"{tag}_{c}") for c in VALUE_COLUMNS]
    )


def _paired(base: DataFrame, other: DataFrame) -> DataFrame:
    return _one_side(base, "base").join(
        _one_side(other, "other"), [PROBE, "symbol", "date"], "full_outer"
    )


def date_presence(base: DataFrame, other: DataFrame) -> DataFrame:
    """Every day of a probe with the side it occurs on: both, left_only or right_only."""
    return _paired(base, other).select(
        PROBE,
        "symbol",
        "date",
        F.when(F.col("base_n").isNull(), "right_only")
        .when(F.col("other_n").isNull(), "left_only")
        .otherwise("both")
        .alias("presence"),
    )


def _differs(c: str) -> Column:
    return ~F.col(f"base_{c}").eqNullSafe(F.col(f"other_{c}"))


def compare_sources(probes: DataFrame, base: DataFrame, other: DataFrame) -> DataFrame:
    """Per probe: overlap, one-sided days, exact and differing rows, exact ratio medians.

    Both inputs carry probe_id, symbol, date and values, already limited to the probe
    window.  A probe with a side that is empty or repeats a date is left uncompared
    (zeros).  After compaction a probe holds at most one row per calendar day, which
    bounds the exact median's state.
    """
    pairs = _paired(base, other)
    has_base, has_other = F.col("base_n").isNotNull(), F.col("other_n").isNotNull()
    both = has_base & has_other
    differing = any_of(_differs(c) for c in VALUE_COLUMNS)

    def ratio(c: str) -> Column:
        return F.when(both, safe_ratio(F.col(f"other_{c}"), F.col(f"base_{c}")))

    single = (F.coalesce("base_n", F.lit(1)) == 1) & (F.coalesce("other_n", F.lit(1)) == 1)
    stats = pairs.withColumn("__single", single).groupBy(PROBE, "symbol").agg(
        F.coalesce(F.sum("base_n"), F.lit(0)).alias("base_window_row_count"),
        F.coalesce(F.sum("other_n"), F.lit(0)).alias("other_window_row_count"),
        F.coalesce(F.sum(F.col("base_n") - 1), F.lit(0)).alias("base_duplicate_date_count"),
        F.coalesce(F.sum(F.col("other_n") - 1), F.lit(0)).alias("other_duplicate_date_count"),
        count_where(both).alias("overlapping_date_count"),
        count_where(has_base & ~has_other).alias("base_only_date_count"),
        count_where(has_other & ~has_base).alias("other_only_date_count"),
        count_where(both & ~differing).alias("exact_match_count"),
        count_where(both & differing).alias("differing_row_count"),
        *[count_where(both & _differs(c)).alias(f"differing_{c}_count") for c in VALUE_COLUMNS],
        *[F.min(ratio(c)).alias(f"ratio_min_{c}") for c in VALUE_COLUMNS],
        *[F.median(ratio(c)).alias(f"ratio_median_{c}") for c in VALUE_COLUMNS],
        *[F.max(ratio(c)).alias(f"ratio_max_{c}") for c in VALUE_COLUMNS],
    )
    comparable = (
        (F.col("base_window_row_count") > 0)
        & (F.col("other_window_row_count") > 0)
        & (F.col("base_duplicate_date_count") == 0)
        & (F.col("other_duplicate_date_count") == 0)
    )
    joined = probes.select(PROBE, "symbol", "case_class", "aggregate").join(
        stats, [PROBE, "symbol"], "left"
    )
    zeroed = {}
    for c in stats.columns[2:]:
        if c.startswith("ratio_"):
            zeroed[c] = F.when(comparable, F.col(c))
        elif "window_row" in c or "duplicate" in c:
            zeroed[c] = F.coalesce(c, F.lit(0)).cast("bigint")
        else:
            zeroed[c] = F.when(comparable, F.col(c)).otherwise(F.lit(0)).cast("bigint")
    return joined.withColumns({**zeroed, "compared": holds(comparable)})


def top_differences(base: DataFrame, other: DataFrame, limit: int = 5) -> DataFrame:
    """First differing days of each probe whose sides have unique dates."""
    pairs = _paired(base, other).where("base_n is not null and other_n is not null")
    clean = (
        _paired(base, other)
        .groupBy(PROBE)
        .agg(F.max(F.greatest("base_n", "other_n")).alias("most"))
        .where("most = 1")
        .select(PROBE)
    )
    rows = pairs.where(any_of(_differs(c) for c in VALUE_COLUMNS)).join(clean, PROBE, "left_semi")
    return top_rows(rows, [PROBE, "symbol"], ["date"], limit).drop("base_n", "other_n")


def difference_kinds(base: DataFrame, other: DataFrame) -> DataFrame:
    """Overlapping days split into exact, volume-only, price-only and both."""
    pairs = _paired(base, other).where("base_n = 1 and other_n = 1")
    price = any_of(_differs(c) for c in PRICE_COLUMNS)
    kind = (
        F.when(~price & ~_differs("volume"), "exact")
        .when(~price, "volume_only")
        .when(~_differs("volume"), "price_only")
        .otherwise("price_and_volume")
    )
    return pairs.groupBy(PROBE, kind.alias("difference")).agg(
        F.count(F.lit(1)).alias("date_count")
    )


def comparison_accounting(comparisons: DataFrame) -> DataFrame:
    """Aggregate (one broad probe per symbol) versus probe-weighted accounting, one row."""
    seen = comparisons.where("overlapping_date_count > 0")
    chosen = F.col("aggregate")
    off_unity = any_of(
        holds(F.abs(F.col(f"ratio_median_{c}") - 1.0) > MATERIAL_RATIO) for c in PRICE_COLUMNS
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    per_symbol = seen.groupBy("symbol").agg(
        total(F.when(chosen, F.col("overlapping_date_count"))).alias("overlap"),
        total(F.when(chosen, F.col("differing_row_count"))).alias("differing"),
        total(F.col("overlapping_date_count")).alias("weighted_overlap"),
        total(F.col("differing_row_count")).alias("weighted_differing"),
        count_where(chosen).alias("probes"),
        count_where(chosen & off_unity).alias("off"),
    )
    return per_symbol.agg(
        total(F.col("overlap")).alias("overlapping_rows_compared"),
        total(F.col("differing")).alias("rows_with_any_difference"),
        total(F.col("weighted_overlap")).alias("probe_weighted_overlapping_rows"),
        total(F.col("weighted_differing")).alias("probe_weighted_rows_with_any_difference"),
        total(F.col("probes")).alias("aggregate_probe_count"),
        F.coalesce(F.max("probes") <= 1, F.lit(True)).alias("aggregate_symbols_unique"),
        total(F.col("off")).alias("materially_non_unity_count"),
    )


def unit_contract_registered(record: UnitProvenance) -> bool:
    return record in REGISTERED


def unit_decision(rows: DataFrame) -> DataFrame:
    """Unit policy of all probe rows together."""
    return unit_policy(rows).select(
        "unit_verification_status",
        "unit_provenance_status",
        F.col("vnd_traded_value_permitted").alias("vnd_permitted_for_homogeneous_rows"),
        F.lit(False).alias("mixed_source_rows_permitted"),
    )


def criteria(
    inspected: DataFrame,
    comparisons: DataFrame,
    groups: DataFrame,
    registered: bool,
    adjustment_verified: bool = False,
) -> DataFrame:
    """Thirteen booleans (one row).

    ``inspected`` is the inspection of every planned probe with ``executed`` and
    ``error_count``; roles boundary, count_small and count_large mark the special probes.
    """
    f = F.col
    run = f("executed")
    wanted = run & ~f("expected_empty")
    ok_schema = (f("raw_row_count") > 0) & (f("malformed_time_count") == 0)
    ok_window = F.when(f("expected_empty"), f("window_row_count") == 0).otherwise(
        f("window_row_count") > 0
    )

    def every(scope: Column, test: Column, need_one: bool) -> Column:
        failing = F.coalesce(F.bool_or(scope & ~holds(test)), F.lit(False))
        some = F.coalesce(F.bool_or(scope), F.lit(False)) if need_one else F.lit(True)
        return some & ~failing

    def some(test: Column) -> Column:
        return F.coalesce(F.bool_or(holds(test)), F.lit(False))

    boundary = (f("role") == "boundary") & run
    row = inspected.agg(
        every(F.lit(True), run & (f("error_count") == 0), True).alias(
            "all_bounded_probes_executed"
        ),
        every(wanted, ok_schema, True).alias("schema_and_date_labels_valid"),
        every(run, ok_window, True).alias(
            "requested_window_observations_match_probe_expectation"
        ),
        every(wanted, F.size("window_blocking_checks") == 0, True).alias("ohlc_invariants_valid"),
        every(wanted, f("window_duplicate_date_count") == 0, True).alias(
            "duplicate_dates_absent"
        ),
        every(f("expected_empty"), run & f("empty_expectation_matched"), False).alias(
            "empty_response_behavior_verified"
        ),
        some(
            boundary & (f("boundary_missing_count") == 0) & (f("boundary_required_count") == 2)
        ).alias("end_inclusivity_verified"),
        some(boundary & (f("rows_before_requested_start") > 0)).alias(
            "start_semantics_characterized"
        ),
        (
            some(run & (f("role") == "count_small") & (f("raw_row_count") == f("bar_count")))
            & some(run & (f("role") == "count_large") & (f("raw_row_count") == f("bar_count")))
        ).alias("countback_through_1200_verified"),
    )
    compared = comparisons.where("overlapping_date_count > 0").agg(
        F.countDistinct("symbol") >= MIN_COMPARED_SYMBOLS
    )
    return row.withColumns(
        {
            "identical_request_deterministic": all_groups_exact(groups).scalar(),
            "vci_unit_provenance_registered": F.lit(registered),
            "cross_source_comparison_completed": compared.scalar(),
            "adjustment_semantics_verified": F.lit(adjustment_verified),
        }
    )


def verdict(criteria_row: DataFrame) -> DataFrame:
    """Mechanical verdict, its scoped label and the recommendation class."""
    required = all_of(holds(F.col(c)) for c in VERDICT_REQUIRED)
    value = (
        F.when(~holds(F.col("all_bounded_probes_executed")), "unknown")
        .when(~required, "rejected")
        .when(holds(F.col("adjustment_semantics_verified")), "qualified")
        .otherwise("qualified_with_constraints")
    )
    primary = F.col("final_verdict").isin("qualified", "qualified_with_constraints")
    return criteria_row.withColumn("final_verdict", value).withColumns(
        {
            "scoped_verdict": F.when(
                F.col("final_verdict") == "rejected", "rejected_for_canonical_daily_ohlcv"
            ).otherwise(F.col("final_verdict")),
            "recommendation_class": F.when(primary, "primary_source_candidate_only").otherwise(
                "diagnostic_evidence_only"
            ),
            "may_evaluate_as_primary_source": primary,
            "migration_authorized": F.lit(False),
        }
    )


def failure_rows(inspected: DataFrame, comparisons: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Observed failures per probe; a default row when there is none, one when unfinished."""
    sparse = F.col("case_class").isin("suspension_and_kbs_stale", "sparse_trading_and_kbs_stale")
    joined = inspected.join(
        comparisons.select(PROBE, "other_only_date_count"), PROBE, "left"
    ).withColumn("extra", F.coalesce("other_only_date_count", F.lit(0)))
    found = joined.select(
        PROBE,
        F.explode(
            reasons(
                (F.col("error_count") > 0, "provider_error"),
                (
                    F.col("executed") & (F.size("window_blocking_checks") > 0),
                    "requested_window_blocking_ohlc_checks",
                ),
                (
                    F.col("executed") & ~F.col("empty_expectation_matched"),
                    "empty_expectation_mismatch",
                ),
                (
                    sparse & ((F.col("window_zero_volume_row_count") > 0) | (F.col("extra") > 0)),
                    "zero_volume_or_one_sided_dates",
                ),
            )
        ).alias("failure"),
    )
    unfinished = verdicts.where("final_verdict = 'unknown'").select(
        F.lit(None).cast("string").alias(PROBE), F.lit("qualification_incomplete").alias("failure")
    )
    none = found.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        F.lit(None).cast("string").alias(PROBE),
        F.lit("no_wrapper_level_failure").alias("failure"),
    )
    return found.unionByName(none).unionByName(unfinished)


def expectation_checks(inspected: DataFrame) -> DataFrame:
    """Per probe: did the response meet its empty and window expectations?"""
    window_ok = F.when(F.col("expected_empty"), F.col("window_row_count") == 0).otherwise(
        F.col("window_row_count") > 0
    )
    pairs = F.array(
        F.struct(
            F.lit("probe_empty_expectation").alias("check_name"),
            F.col("empty_expectation_matched").alias("ok"),
            F.lit(0).cast("bigint").alias("affected_row_count"),
        ),
        F.struct(
            F.lit("requested_window_observation_expectation").alias("check_name"),
            window_ok.alias("ok"),
            F.col("window_row_count").alias("affected_row_count"),
        ),
    )
    return inspected.select(PROBE, F.explode(pairs).alias("c")).select(
        PROBE,
        "c.check_name",
        F.when(F.col("c.ok"), "INFO").otherwise("ERROR").alias("severity"),
        "c.affected_row_count",
        (~F.col("c.ok")).alias("blocks_output"),
    )


