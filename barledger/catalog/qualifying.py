"""Queries for second-source qualification: odd lines against even lines of the same bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from barledger.catalog import views as v
from barledger.catalog.campaigns import CAMPAIGN_VIEWS, digest_sql, tasks
from barledger.catalog.oracles import HIGH_LOW, HIGH_OC, LOW_OC, calendar, json_list, n_where
from barledger.catalog.registry import query
from barledger.contracts import VALUE_COLUMNS
from barledger.functions import exprs as x
from barledger.operators import qualification as q
from barledger.operators.units import VCI, with_provenance
from barledger.sources.staging import staged

AS_OF = "2001-11-05"


def probes(spark, sf):
    """One probe per supplier, and a repeat of every tenth one."""
    k = F.col("suppkey")
    start = F.date_add(x.lit_date("1996-01-01"), (k % 5).cast("int") * 100)
    classes = [
        "clean", "suspension_and_kbs_stale", "sparse_trading_and_kbs_stale", "row_limit",
        "prelisting_empty", "other",
    ]
    base = v.suppliers(spark, sf).select(
        "suppkey",
        "symbol",
        F.lit(False).alias("repeat"),
        F.element_at(F.array(*[F.lit(c) for c in classes]), (k % 6 + 1).cast("int")).alias(
            "case_class"
        ),
        F.when(k % 50 == 0, "boundary").when(k % 50 == 1, "count_small")
        .when(k % 50 == 2, "count_large").otherwise("plain").alias("role"),
        start.alias("start_date"),
        F.date_add(start, 400).alias("end_date"),
        (k + 60).alias("bar_count"),
        (k % 6 == 4).alias("expected_empty"),
        F.when(k % 10 == 0, F.concat(F.lit("G"), k.cast("string"))).alias("determinism_group"),
        F.when(k % 50 == 0, F.array(start, F.date_add(start, 400)))
        .otherwise(F.array().cast("array<date>"))
        .alias("boundary_dates"),
        F.lit(True).alias("aggregate"),
    )
    again = base.where("suppkey % 10 = 0").withColumns(
        {"repeat": F.lit(True), "aggregate": F.lit(False)}
    )
    letter = F.when(F.col("repeat"), "Q").otherwise("P")
    executed = F.col("suppkey") % 50 != 49
    return base.unionByName(again).withColumns(
        {
            "probe_id": F.concat(letter, F.col("suppkey").cast("string")),
            "executed": executed,
            "error_count": F.when(executed, 0).otherwise(1).cast("bigint"),
        }
    )


def responses(spark, sf):
    """Landed rows of the second source: some early rows, some bad ones, some descending."""
    p = probes(spark, sf).select(
        "probe_id", "suppkey", "repeat", "symbol", "start_date", "end_date", "executed"
    )
    rows = v.source_b(spark, sf).join(p, "symbol")
    kept = rows.where(
        "executed and date between date_sub(start_date, 30) and date_add(end_date, 10)"
        " and (suppkey % 6 <> 4 or suppkey % 12 = 4)"
    )
    ordinal = F.datediff("date", x.lit_date("1990-01-01")) * 100000 + F.col("l_orderkey") % 100000
    backwards = (F.col("suppkey") % 7 == 3) | ((F.col("suppkey") % 20 == 10) & F.col("repeat"))
    landed = kept.select(
        "probe_id", "symbol", "date", *v.LINE_ORDER,
        "open",
        F.when(F.col("l_orderkey") % 97 == 0, F.col("low") - 1)
        .otherwise(F.col("high"))
        .alias("high"),
        "low", "close", "volume",
        F.when(backwards, 1000000000 - ordinal).otherwise(ordinal).cast("bigint").alias("position"),
    )
    return staged(landed)


def in_window(spark, sf, rows, base: bool):
    p = probes(spark, sf).where("executed").select("probe_id", "symbol", "start_date", "end_date")
    keys = "symbol" if base else ["probe_id", "symbol"]
    return rows.join(p, keys).where("date between start_date and end_date").select(
        "probe_id", "symbol", "date", *VALUE_COLUMNS
    )


def sides(spark, sf):
    return (
        in_window(spark, sf, v.source_a(spark, sf), True),
        in_window(spark, sf, responses(spark, sf), False),
    )


def inspected(spark, sf):
    return q.inspect_responses(
        probes(spark, sf), responses(spark, sf), "position", AS_OF, v.LINE_ORDER
    )


def comparisons(spark, sf):
    return q.compare_sources(probes(spark, sf), *sides(spark, sf))


QUALIFY_VIEWS = {
    **CAMPAIGN_VIEWS,
    "probes": """SELECT CASE WHEN again THEN 'Q' ELSE 'P' END || suppkey AS probe_id, suppkey,
          symbol, again, CASE suppkey % 6 WHEN 0 THEN 'clean' WHEN 1
            THEN 'suspension_and_kbs_stale' WHEN 2 THEN 'sparse_trading_and_kbs_stale'
            WHEN 3 THEN 'row_limit' WHEN 4 THEN 'prelisting_empty' ELSE 'other' END AS case_class,
          CASE suppkey % 50 WHEN 0 THEN 'boundary' WHEN 1 THEN 'count_small'
            WHEN 2 THEN 'count_large' ELSE 'plain' END AS role,
          DATE '1996-01-01' + CAST(suppkey % 5 * 100 AS INT) AS start_date,
          DATE '1996-01-01' + CAST(suppkey % 5 * 100 + 400 AS INT) AS end_date,
          suppkey + 60 AS bar_count, suppkey % 6 = 4 AS expected_empty,
          CASE WHEN suppkey % 10 = 0 THEN 'G' || suppkey END AS determinism_group,
          NOT again AS aggregate, suppkey % 50 <> 49 AS executed
        FROM suppliers CROSS JOIN (VALUES (false), (true)) t(again)
        WHERE NOT again OR suppkey % 10 = 0""",
    "resp": """SELECT *, CASE WHEN suppkey % 7 = 3 OR (suppkey % 20 = 10 AND again)
          THEN 1000000000 - o ELSE o END AS position
        FROM (SELECT p.probe_id, p.suppkey, p.again, p.symbol, p.start_date, p.end_date, b.date,
            l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, open,
            CASE WHEN l_orderkey % 97 = 0 THEN low - 1 ELSE high END AS high, low, close, volume,
            date_diff('day', DATE '1990-01-01', b.date) * 100000 + l_orderkey % 100000 AS o,
            b.date BETWEEN p.start_date AND p.end_date AS inside
          FROM source_b b JOIN probes p ON p.symbol = b.symbol
          WHERE executed AND b.date BETWEEN p.start_date - 30 AND p.end_date + 10
            AND (suppkey % 6 <> 4 OR suppkey % 12 = 4))""",
    "resp_step": """SELECT *, lag(date) OVER (PARTITION BY probe_id ORDER BY position) AS before,
          row_number() OVER (PARTITION BY probe_id ORDER BY position, l_orderkey, l_linenumber,
            l_partkey, l_extendedprice, l_quantity) AS rank FROM resp""",
    "resp_line": """SELECT probe_id, '{"__rank":' || rank || ',"date":"' ||
          strftime(date, '%Y-%m-%d') || '","open":' || open || ',"high":' || high || ',"low":' ||
          low || ',"close":' || close || ',"volume":' || volume || '}' AS line FROM resp_step""",
    "digests": f"SELECT probe_id, {digest_sql('resp_line')} AS response_digest FROM resp_line "
    "GROUP BY probe_id",
    "looked": f"""SELECT p.*, d.response_digest, count(r.date) AS raw_rows,
          {n_where("inside")} AS window_rows,
          {n_where("r.date < p.start_date")} AS before_rows,
          {n_where("r.date > p.end_date")} AS after_rows,
          count(r.date) - count(DISTINCT r.date) AS dups,
          {n_where("inside")} - count(DISTINCT CASE WHEN inside THEN r.date END) AS window_dups,
          {n_where("volume = 0")} AS zero_rows,
          {n_where("inside AND volume = 0")} AS window_zero,
          {n_where("inside AND volume > 0")} AS window_positive,
          {n_where("open = high AND high = low AND low = close")} AS flat_rows,
          {n_where("before > r.date")} AS breaks, min(r.date) AS first_d, max(r.date) AS last_d,
          {n_where(HIGH_LOW)} AS hl, {n_where(HIGH_OC)} AS hoc, {n_where(LOW_OC)} AS loc,
          {n_where(f"inside AND {HIGH_LOW}")} AS w_hl, {n_where(f"inside AND {HIGH_OC}")} AS w_hoc,
          {n_where(f"inside AND {LOW_OC}")} AS w_loc,
          CASE WHEN max(role) = 'boundary' THEN 2 - count(DISTINCT CASE WHEN r.date IN
            (p.start_date, p.end_date) THEN r.date END) ELSE 0 END AS boundary_missing
        FROM probes p LEFT JOIN resp_step r ON r.probe_id = p.probe_id
          LEFT JOIN digests d ON d.probe_id = p.probe_id GROUP BY ALL""",
    "win_a": """SELECT p.probe_id, p.symbol, a.date, a.open, a.high, a.low, a.close, a.volume
        FROM probes p JOIN source_a a ON a.symbol = p.symbol
          AND a.date BETWEEN p.start_date AND p.end_date WHERE executed""",
    "win_b": """SELECT probe_id, symbol, date, open, high, low, close, volume FROM resp
        WHERE inside""",
    "sizes": """SELECT p.probe_id, (SELECT count(*) FROM win_a a WHERE a.probe_id = p.probe_id)
            AS na, (SELECT count(DISTINCT date) FROM win_a a WHERE a.probe_id = p.probe_id) AS da,
          (SELECT count(*) FROM win_b b WHERE b.probe_id = p.probe_id) AS nb,
          (SELECT count(DISTINCT date) FROM win_b b WHERE b.probe_id = p.probe_id) AS db
        FROM probes p""",
    "pairs": """SELECT coalesce(a.probe_id, b.probe_id) AS probe_id,
          coalesce(a.date, b.date) AS date, a.date AS ad, b.date AS bd,
          a.open AS ao, a.high AS ah, a.low AS al, a.close AS ac, a.volume AS av,
          b.open AS bo, b.high AS bh, b.low AS bl, b.close AS bc, b.volume AS bv
        FROM (SELECT * FROM win_a WHERE probe_id IN (SELECT probe_id FROM sizes
            WHERE na = da AND nb = db AND na > 0 AND nb > 0)) a
        FULL JOIN (SELECT * FROM win_b WHERE probe_id IN (SELECT probe_id FROM sizes
            WHERE na = da AND nb = db AND na > 0 AND nb > 0)) b
          ON a.probe_id = b.probe_id AND a.date = b.date""",
    "compared": f"""SELECT p.probe_id, p.symbol, p.case_class, p.aggregate, s.*
            EXCLUDE (probe_id), {n_where("ad IS NOT NULL AND bd IS NOT NULL")} AS overlap,
          {n_where("ad IS NOT NULL AND bd IS NULL")} AS a_only,
          {n_where("ad IS NULL AND bd IS NOT NULL")} AS b_only,
          {n_where("ad = bd AND (ao, ah, al, ac, av) = (bo, bh, bl, bc, bv)")} AS exact,
          {n_where("ad = bd AND (ao, ah, al, ac, av) <> (bo, bh, bl, bc, bv)")} AS differing,
          {n_where("ad = bd AND av <> bv")} AS diff_volume,
          {n_where("ad = bd AND ac <> bc")} AS diff_close,
          min(CASE WHEN ad = bd THEN bc / ac END) AS r_min,
          median(CASE WHEN ad = bd THEN bc / ac END) AS r_close,
          median(CASE WHEN ad = bd THEN bo / ao END) AS r_open,
          median(CASE WHEN ad = bd THEN bh / ah END) AS r_high,
          median(CASE WHEN ad = bd THEN bl / al END) AS r_low,
          max(CASE WHEN ad = bd THEN bv / av END) AS r_max_volume
        FROM probes p JOIN sizes s ON s.probe_id = p.probe_id
          LEFT JOIN pairs d ON d.probe_id = p.probe_id GROUP BY ALL""",
}


@query(
    "j14_probe_overlap",
    """SELECT p.probe_id, t.task_id FROM probes p JOIN camp_tasks t ON t.symbol = p.symbol
         AND t.start_date <= p.end_date AND t.end_date >= p.start_date""",
    QUALIFY_VIEWS,
)
def j14_probe_overlap(spark, sf):
    return q.probe_overlaps(probes(spark, sf), tasks(spark, sf)).select("probe_id", "task_id")


@query("a19_response_digest", "SELECT * FROM digests", QUALIFY_VIEWS)
def a19_response_digest(spark, sf):
    return q.response_digests(responses(spark, sf), "position", v.LINE_ORDER)


def _window_checks(prefix: str, dups: str) -> str:
    return json_list(
        [
            (f"{prefix}hl > 0", "high_gte_low"),
            (f"{prefix}hoc > 0", "high_gte_open_close"),
            (f"{prefix}loc > 0", "low_lte_open_close"),
            (f"{dups} > 0", "duplicate_symbol_date"),
        ]
    )


@query(
    "a18_probe_inspection",
    f"""SELECT probe_id, raw_rows AS raw_row_count, window_rows AS window_row_count,
         (SELECT count(*) FROM cal WHERE d BETWEEN start_date AND end_date)
           AS window_expected_weekday_count,
         before_rows AS rows_before_requested_start, after_rows AS rows_after_requested_end,
         CAST(dups AS BIGINT) AS duplicate_date_count,
         CAST(window_dups AS BIGINT) AS window_duplicate_date_count,
         zero_rows AS zero_volume_row_count, window_zero AS window_zero_volume_row_count,
         window_positive AS window_positive_volume_row_count, flat_rows AS flat_ohlc_row_count,
         strftime(first_d, '%Y-%m-%d') AS earliest_response_date,
         strftime(last_d, '%Y-%m-%d') AS latest_response_date,
         CASE WHEN breaks = 0 THEN 'ascending' ELSE 'not_ascending' END AS raw_time_ordering,
         CAST(boundary_missing AS BIGINT) AS boundary_missing_count,
         raw_rows <= bar_count AS count_limit_not_exceeded,
         raw_rows = 0 AS empty_observed,
         (raw_rows = 0) = expected_empty AS empty_expectation_matched,
         {_window_checks("", "dups")} AS blocking_checks,
         {_window_checks("w_", "window_dups")} AS window_blocking_checks, response_digest
       FROM looked""",
    {**QUALIFY_VIEWS, "cal": calendar("1995-01-01", "2001-12-31")},
)
def a18_probe_inspection(spark, sf):
    return inspected(spark, sf).drop(
        "suppkey", "symbol", "repeat", "case_class", "role", "start_date", "end_date",
        "bar_count", "expected_empty", "determinism_group", "boundary_dates", "aggregate",
        "executed", "error_count", "malformed_time_count", "boundary_required_count",
        *[f"null_{c}_count" for c in VALUE_COLUMNS],
    )


@query(
    "a20_determinism",
    """SELECT determinism_group, count(*) AS response_count, count(*) >= 2 AND
         count(response_digest) = count(*) AND count(DISTINCT response_digest) = 1
           AS exact_value_match
       FROM looked WHERE determinism_group IS NOT NULL GROUP BY determinism_group""",
    QUALIFY_VIEWS,
)
def a20_determinism(spark, sf):
    return q.determinism(inspected(spark, sf))


@query(
    "j8_source_compare",
    """SELECT probe_id, strftime(date, '%Y-%m-%d') AS date, CASE WHEN ad IS NULL THEN 'right_only'
         WHEN bd IS NULL THEN 'left_only' ELSE 'both' END AS presence FROM pairs""",
    QUALIFY_VIEWS,
)
def j8_source_compare(spark, sf):
    """Days of each comparable probe by presence on either side."""
    ok = comparisons(spark, sf).where("compared").select("probe_id")
    days = q.date_presence(*sides(spark, sf))
    return days.join(ok, "probe_id", "left_semi").drop("symbol")


@query(
    "a22_compare",
    """SELECT probe_id, symbol, na AS base_window_row_count, nb AS other_window_row_count,
         na - da AS base_duplicate_date_count, nb - db AS other_duplicate_date_count,
         overlap AS overlapping_date_count, a_only AS base_only_date_count,
         b_only AS other_only_date_count, exact AS exact_match_count,
         differing AS differing_row_count, diff_volume AS differing_volume_count,
         diff_close AS differing_close_count, r_min AS ratio_min_close,
         r_close AS ratio_median_close, r_open AS ratio_median_open,
         r_max_volume AS ratio_max_volume,
         na > 0 AND nb > 0 AND na = da AND nb = db AS compared FROM compared""",
    QUALIFY_VIEWS,
)
def a22_compare(spark, sf):
    return comparisons(spark, sf).select(
        "probe_id", "symbol", "base_window_row_count", "other_window_row_count",
        "base_duplicate_date_count", "other_duplicate_date_count", "overlapping_date_count",
        "base_only_date_count", "other_only_date_count", "exact_match_count",
        "differing_row_count", "differing_volume_count", "differing_close_count",
        "ratio_min_close", "ratio_median_close", "ratio_median_open", "ratio_max_volume",
        "compared",
    )


@query(
    "a22_difference_kinds",
    """SELECT probe_id, CASE WHEN p AND v THEN 'price_and_volume' WHEN p THEN 'price_only'
         WHEN v THEN 'volume_only' ELSE 'exact' END AS difference, count(*) AS date_count
       FROM (SELECT a.probe_id, (a.open, a.high, a.low, a.close) <> (b.open, b.high, b.low,
           b.close) AS p, a.volume <> b.volume AS v
         FROM (SELECT * FROM win_a QUALIFY count(*) OVER (PARTITION BY probe_id, date) = 1) a
         JOIN (SELECT * FROM win_b QUALIFY count(*) OVER (PARTITION BY probe_id, date) = 1) b
           ON a.probe_id = b.probe_id AND a.date = b.date) GROUP BY ALL""",
    QUALIFY_VIEWS,
)
def a22_difference_kinds(spark, sf):
    return q.difference_kinds(*sides(spark, sf))


@query(
    "o4_top_differences",
    """SELECT probe_id, strftime(date, '%Y-%m-%d') AS date, ac AS base_close, bc AS other_close,
         av AS base_volume, bv AS other_volume, row_number() OVER (PARTITION BY probe_id
           ORDER BY date) AS position
       FROM pairs WHERE ad = bd AND (ao, ah, al, ac, av) <> (bo, bh, bl, bc, bv)
       QUALIFY position <= 5""",
    QUALIFY_VIEWS,
)
def o4_top_differences(spark, sf):
    return q.top_differences(*sides(spark, sf)).select(
        "probe_id", "date", "base_close", "other_close", "base_volume", "other_volume", "position"
    )


@query(
    "a23_accounting",
    """SELECT CAST(coalesce(sum(overlap) FILTER (WHERE aggregate), 0) AS BIGINT)
           AS overlapping_rows_compared,
         CAST(coalesce(sum(differing) FILTER (WHERE aggregate), 0) AS BIGINT)
           AS rows_with_any_difference,
         CAST(coalesce(sum(overlap), 0) AS BIGINT) AS probe_weighted_overlapping_rows,
         CAST(coalesce(sum(differing), 0) AS BIGINT) AS probe_weighted_rows_with_any_difference,
         CAST(count(*) FILTER (WHERE aggregate) AS BIGINT) AS aggregate_probe_count,
         count(*) FILTER (WHERE aggregate) = count(DISTINCT CASE WHEN aggregate THEN symbol END)
           AS aggregate_symbols_unique,
         CAST(count(*) FILTER (WHERE aggregate AND (abs(r_open - 1) > 0.005 OR
           abs(r_high - 1) > 0.005 OR abs(r_low - 1) > 0.005 OR abs(r_close - 1) > 0.005))
           AS BIGINT) AS materially_non_unity_count
       FROM compared WHERE overlap > 0""",
    QUALIFY_VIEWS,
)
def a23_accounting(spark, sf):
    return q.comparison_accounting(comparisons(spark, sf))


_CRITERIA = """SELECT bool_and(executed) AS all_bounded_probes_executed,
    bool_and(raw_rows > 0) FILTER (WHERE executed AND NOT expected_empty)
      AS schema_and_date_labels_valid,
    bool_and(CASE WHEN expected_empty THEN window_rows = 0 ELSE window_rows > 0 END)
      FILTER (WHERE executed) AS requested_window_observations_match_probe_expectation,
    bool_and(w_hl = 0 AND w_hoc = 0 AND w_loc = 0 AND window_dups = 0)
      FILTER (WHERE executed AND NOT expected_empty) AS ohlc_invariants_valid,
    bool_and(window_dups = 0) FILTER (WHERE executed AND NOT expected_empty)
      AS duplicate_dates_absent,
    bool_and(executed AND raw_rows = 0) FILTER (WHERE expected_empty)
      AS empty_response_behavior_verified,
    bool_or(role = 'boundary' AND boundary_missing = 0) AS end_inclusivity_verified,
    bool_or(role = 'boundary' AND before_rows > 0) AS start_semantics_characterized,
    bool_or(role = 'count_small' AND raw_rows = bar_count) AND
      bool_or(role = 'count_large' AND raw_rows = bar_count) AS countback_through_1200_verified,
    (SELECT bool_and(e) FROM (SELECT count(*) >= 2 AND count(response_digest) = count(*)
      AND count(DISTINCT response_digest) = 1 AS e FROM looked WHERE determinism_group IS NOT NULL
      GROUP BY determinism_group)) AS identical_request_deterministic,
    true AS vci_unit_provenance_registered,
    (SELECT count(DISTINCT symbol) >= 5 FROM compared WHERE overlap > 0)
      AS cross_source_comparison_completed,
    false AS adjustment_semantics_verified FROM looked"""


def criteria(spark, sf):
    seen = staged(inspected(spark, sf))
    return q.criteria(
        seen, comparisons(spark, sf), q.determinism(seen), q.unit_contract_registered(VCI)
    )


@query("a21_criteria", _CRITERIA, QUALIFY_VIEWS)
def a21_criteria(spark, sf):
    return criteria(spark, sf)


@query(
    "a24_verdict",
    """SELECT 'unknown' AS final_verdict, 'unknown' AS scoped_verdict,
         'diagnostic_evidence_only' AS recommendation_class,
         false AS may_evaluate_as_primary_source, false AS migration_authorized
       FROM looked HAVING NOT bool_and(executed)""",
    QUALIFY_VIEWS,
)
def a24_verdict(spark, sf):
    return q.verdict(criteria(spark, sf)).select(
        "final_verdict", "scoped_verdict", "recommendation_class",
        "may_evaluate_as_primary_source", "migration_authorized",
    )


@query(
    "a24_verdict_rules",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'unknown'
         WHEN o_orderkey % 5 = 0 THEN 'rejected' WHEN o_orderkey % 7 = 0 THEN 'qualified'
         ELSE 'qualified_with_constraints' END AS final_verdict FROM orders""",
)
def a24_verdict_rules(spark, sf):
    """Verdict precedence over many criteria rows."""
    k = F.col("o_orderkey")
    names = [c for c in q.VERDICT_REQUIRED if c != "ohlc_invariants_valid"]
    rows = v.table(spark, sf, "orders").select(
        "o_orderkey",
        (k % 3 != 0).alias("all_bounded_probes_executed"),
        (k % 5 != 0).alias("ohlc_invariants_valid"),
        (k % 7 == 0).alias("adjustment_semantics_verified"),
        *[F.lit(True).alias(c) for c in names],
    )
    return q.verdict(rows).select("o_orderkey", "final_verdict")


@query(
    "a25_failure_rows",
    """SELECT probe_id, 'provider_error' AS failure FROM looked WHERE NOT executed
       UNION ALL SELECT probe_id, 'requested_window_blocking_ohlc_checks' FROM looked
         WHERE executed AND (w_hl > 0 OR w_hoc > 0 OR w_loc > 0 OR window_dups > 0)
       UNION ALL SELECT probe_id, 'empty_expectation_mismatch' FROM looked
         WHERE executed AND (raw_rows = 0) <> expected_empty
       UNION ALL SELECT l.probe_id, 'zero_volume_or_one_sided_dates' FROM looked l
         JOIN compared c ON c.probe_id = l.probe_id WHERE l.case_class LIKE '%_and_kbs_stale'
         AND (window_zero > 0 OR b_only > 0)
       UNION ALL SELECT NULL, 'qualification_incomplete' FROM looked HAVING NOT bool_and(executed)""",
    QUALIFY_VIEWS,
)
def a25_failure_rows(spark, sf):
    seen = staged(inspected(spark, sf))
    compared = staged(comparisons(spark, sf))
    row = q.criteria(seen, compared, q.determinism(seen), True)
    return q.failure_rows(seen, compared, q.verdict(row))


@query(
    "p15_expectation_checks",
    """SELECT probe_id, 'probe_empty_expectation' AS check_name,
         CASE WHEN (raw_rows = 0) = expected_empty THEN 'INFO' ELSE 'ERROR' END AS severity,
         CAST(0 AS BIGINT) AS affected_row_count, (raw_rows = 0) <> expected_empty AS blocks_output
       FROM looked
       UNION ALL SELECT probe_id, 'requested_window_observation_expectation',
         CASE WHEN (window_rows = 0) = expected_empty THEN 'INFO' ELSE 'ERROR' END, window_rows,
         (window_rows = 0) <> expected_empty FROM looked""",
    QUALIFY_VIEWS,
)
def p15_expectation_checks(spark, sf):
    return q.expectation_checks(inspected(spark, sf))


@query(
    "a31_unit_decision",
    """SELECT 'verified' AS unit_verification_status, 'verified' AS unit_provenance_status,
         true AS vnd_permitted_for_homogeneous_rows, false AS mixed_source_rows_permitted
       FROM resp HAVING count(*) > 0""",
    QUALIFY_VIEWS,
)
def a31_unit_decision(spark, sf):
    rows = responses(spark, sf).withColumns(
        {"provider": F.lit("vnstock"), "source_resolution": F.lit("1D")}
    )
    return q.unit_decision(with_provenance(rows, VCI))


@query(
    "f4_requested_window",
    "SELECT probe_id, strftime(date, '%Y-%m-%d') AS date, close FROM win_b",
    QUALIFY_VIEWS,
)
def f4_requested_window(spark, sf):
    return in_window(spark, sf, responses(spark, sf), False).select("probe_id", "date", "close")


@query(
    "f10_aggregate_eligible",
    "SELECT probe_id, symbol FROM compared WHERE overlap > 0 AND aggregate",
    QUALIFY_VIEWS,
)
def f10_aggregate_eligible(spark, sf):
    return comparisons(spark, sf).where("overlapping_date_count > 0 and aggregate").select(
        "probe_id", "symbol"
    )
