import datetime as dt

import pytest
from helpers import daily, raw_bars, stamp, symbols
from pyspark.sql import functions as F

from barledger.operators import forensics, normalize, profile, redaction
from barledger.operators import qualification as q


def bars(spark, rows):
    """rows: (date, open, high, low, close); all of one task."""
    raw = raw_bars(spark, [("FPT", d, o, h, lo, c, 5.0) for d, o, h, lo, c in rows])
    return normalize.daily_bars(raw, stamp()).withColumn("task_id", F.lit("t"))


def category(spark, rows):
    frame = bars(spark, rows)
    tasks = spark.createDataFrame([("t",)], "task_id string")
    return forensics.classify_ohlc(tasks, frame, ["task_id"], F.lit(0)).first()


FIRST = ("2026-01-05", 9.0, 10.0, 8.0, 9.5)


def test_ohlc_categories(spark):
    open_ = ("2026-01-06", 9.5, 9.0, 8.0, 8.5)
    close = ("2026-01-07", 9.0, 10.0, 8.0, 11.0)
    r = category(spark, [FIRST, open_])
    assert r.root_cause_category == forensics.OPEN_RANGE
    assert (r.open_violation_row_count, r.open_matches_previous_close_count) == (1, 1)
    r = category(spark, [FIRST, close])
    assert r.root_cause_category == forensics.CLOSE_RANGE and r.high_below_close_count == 1
    assert category(spark, [FIRST, open_, close]).root_cause_category == forensics.MIXED_RANGE
    assert category(spark, [FIRST]).root_cause_category == forensics.NOT_REPRODUCED
    odd = ("2026-01-06", 9.4, 9.0, 8.0, 8.5)
    assert category(spark, [FIRST, odd]).root_cause_category == forensics.GENERIC_RANGE


def test_previous_close_with_repeated_days(spark):
    rows = spark.createDataFrame(
        [("2026-01-05", 0, 1.0), ("2026-01-06", 0, 2.0), ("2026-01-06", 1, None),
         ("2026-01-06", 2, 3.0), ("2026-01-07", 0, 9.0)],
        "d string, position int, close double",
    ).select(F.lit("t").alias("task_id"), F.col("d").cast("date").alias("date"), "position", "close")
    got = forensics.previous_close(rows, ["task_id"], F.col("position")).collect()
    assert {str(r.date): r.previous_close for r in got} == {
        "2026-01-05": None, "2026-01-06": 2.0, "2026-01-07": 3.0,
    }


def test_stale_edges(spark):
    rows = spark.createDataFrame(
        [("2021-12-30", "2026-08-04", "2022-01-10", 500, True),
         ("2026-08-04", "2026-08-04", None, 100, True),
         ("2021-12-30", "2026-08-04", None, 500, False),
         ("2021-12-30", "2026-08-04", None, 1000, True),
         ("2021-12-30", "2026-08-04", None, 500, True)],
        "e string, c string, n string, rows int, same boolean",
    )
    d = {k: F.col(k).cast("date") for k in "ecn"}
    got = rows.select(
        forensics.stale_category(d["e"], d["c"], d["n"], F.col("rows"), F.col("same")).alias("x")
    ).collect()
    assert [r.x for r in got] == [
        forensics.HISTORICAL_STALE, forensics.CURRENT_STALE, forensics.NORMALIZATION_MISMATCH,
        forensics.POSSIBLE_TRUNCATION, forensics.UNRESOLVED_STALE,
    ]


def test_positional_comparison_counts_shifts(spark):
    left = bars(spark, [FIRST, ("2026-01-06", 9.0, 10.0, 8.0, 9.0)]).withColumn(
        "position", F.monotonically_increasing_id()
    )
    same = forensics.compare_raw_and_stored(left, left, ["task_id"], "position").first()
    assert same.exact_match and same.max_absolute_delta_close == 0.0
    other = left.withColumn("close", F.col("close") + 1)
    moved = forensics.compare_raw_and_stored(left, other, ["task_id"], "position").first()
    assert moved.dates_match and not moved.exact_match and moved.max_absolute_delta_close == 1.0
    fewer = forensics.compare_raw_and_stored(
        left, left.where("date = '2026-01-05'"), ["task_id"], "position"
    ).first()
    assert not fewer.row_counts_match and fewer.max_absolute_delta_close is None


def test_only_keys_with_equal_counts_are_ranked(spark, monkeypatch):
    pair = bars(spark, [FIRST, ("2026-01-06", 9.0, 10.0, 8.0, 9.0)]).withColumn(
        "position", F.monotonically_increasing_id()
    )
    raw = pair.unionByName(pair.withColumn("task_id", F.lit("u")))
    stored = raw.where("task_id = 't' or date = '2026-01-05'")
    stored = stored.unionByName(stored.where("task_id = 't'").withColumn("task_id", F.lit("v")))
    ranked, rank = [], forensics.exact_rank

    def counted(df, *args, **kwargs):
        ranked.append({r.task_id for r in df.select("task_id").collect()})
        return rank(df, *args, **kwargs)

    monkeypatch.setattr(forensics, "exact_rank", counted)
    found = forensics.compare_raw_and_stored(raw, stored, ["task_id"], "position").collect()
    got = {r.task_id: (r.raw_row_count, r.stored_row_count, r.exact_match, r.dates_match) for r in found}
    assert got == {"t": (2, 2, True, True), "u": (2, 1, False, False), "v": (0, 2, False, False)}
    assert ranked == [{"t"}, {"t"}]


def test_forensic_records(spark):
    d = dt.date
    state = spark.createDataFrame(
        [("f", "FPT", d(2026, 1, 1), d(2026, 1, 31), "failed", "rf", ["x"]),
         ("s", "HPG", d(2026, 1, 1), d(2026, 1, 31), "stale", "rs", ["y"]),
         ("s2", "HPG", d(2026, 2, 1), d(2026, 2, 28), "complete", "rs2", ["z"])],
        "task_id string, symbol string, start_date date, end_date date, status string, "
        "selected_run_id string, reason_codes array<string>",
    )
    manifests = spark.createDataFrame(
        [("rf", True, "failed", "2026-01-01", "2026-01-31"),
         ("rs", True, "success", "2026-01-01", "2026-01-31")],
        "run_id string, readable boolean, status string, start_date string, end_date string",
    )
    bad = raw_bars(spark, [("FPT", "2026-01-05", 9.0, 10.0, 8.0, 11.0, 5.0)])
    stale = raw_bars(
        spark,
        [("HPG", "2026-01-05", 9.0, 10.0, 8.0, 9.0, 5.0), ("HPG", "2026-02-10", 9.0, 10.0, 8.0, 9.0, 5.0)],
    )
    run = F.when(F.col("symbol") == "FPT", "rf").when(
        F.col("date") > "2026-01-31", "rs2"
    ).otherwise("rs")
    raw = normalize.daily_bars(bad.unionByName(stale), stamp()).withColumns(
        {"run_id": run, "position": F.lit(0).cast("bigint")}
    )
    records = forensics.forensic_records("2026-02-28", state, manifests, raw, raw, raw)
    got = {r.task_id: r for r in records.collect()}
    assert got["f"].root_cause_category == forensics.CLOSE_RANGE
    assert got["s"].root_cause_category == forensics.HISTORICAL_STALE
    assert str(got["s"].next_observation_date) == "2026-02-10"
    assert got["s"].resumption_gap_calendar_days == 36 and got["s"].request_bounds_match_task
    assert got["s"].edge_raw == got["s"].edge_stored
    s = forensics.forensic_summary(records).first()
    assert (s.classified_task_count, s.tasks_with_complete_local_evidence) == (2, 2)
    assert (s.tasks_eligible_for_immediate_retry, s.tasks_requiring_code_fix) == (0, 0)


# --- qualification -------------------------------------------------------------------


def probe(spark, **over):
    base = {
        "probe_id": "p", "symbol": "FPT", "case_class": "clean", "role": "boundary",
        "bar_count": 30, "expected_empty": False, "determinism_group": "g", "aggregate": True,
        "executed": True, "error_count": 0, **over,
    }
    days = [F.lit(x).cast("date") for x in ("2026-07-01", "2026-07-03")]
    return spark.range(1).select(
        *[F.lit(v).alias(k) for k, v in base.items()],
        days[0].alias("start_date"), days[1].alias("end_date"), F.array(*days).alias("boundary_dates"),
    )


def response(spark, order):
    rows = daily(spark, [("FPT", d, 10.0, 5) for d in order]).withColumn("probe_id", F.lit("p"))
    rank = {d: i for i, d in enumerate(order)}
    mapping = F.create_map(*[F.lit(x) for kv in rank.items() for x in kv])
    return rows.withColumn("position", mapping[F.col("date").cast("string")].cast("bigint"))


WINDOW = ["2026-06-30", "2026-07-01", "2026-07-02", "2026-07-03"]


def test_probe_inspection(spark):
    seen = q.inspect_responses(probe(spark), response(spark, WINDOW), "position", "2026-07-04")
    r = seen.first()
    assert (r.rows_before_requested_start, r.window_row_count) == (1, 3)
    assert r.boundary_missing_count == 0 and r.raw_time_ordering == "ascending"
    back = q.inspect_responses(
        probe(spark), response(spark, WINDOW[::-1]), "position", "2026-07-04"
    ).first()
    assert back.raw_time_ordering == "not_ascending"
    assert back.response_digest != r.response_digest
    again = seen.unionByName(seen.withColumn("probe_id", F.lit("p2")))
    assert q.determinism(again).first().exact_value_match
    mixed = seen.unionByName(seen.withColumn("response_digest", F.lit("x")))
    assert not q.determinism(mixed).first().exact_value_match
    assert not q.determinism(seen).first().exact_value_match


def test_verdicts(spark):
    full = dict.fromkeys([*q.VERDICT_REQUIRED, "all_bounded_probes_executed"], True)
    rows = [
        {**full, "adjustment_semantics_verified": False},
        {**full, "ohlc_invariants_valid": False, "adjustment_semantics_verified": False},
        {**full, "all_bounded_probes_executed": False, "adjustment_semantics_verified": True},
        {**full, "adjustment_semantics_verified": True},
    ]
    schema = ", ".join(f"{k} boolean" for k in rows[0])
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    assert [r.final_verdict for r in q.verdict(frame).collect()] == [
        "qualified_with_constraints", "rejected", "unknown", "qualified",
    ]


def test_accounting(spark):
    rows = [("a", "FPT", False, 504, 300), ("b", "FPT", False, 504, 300),
            ("c", "FPT", True, 1000, 700), ("d", "ABR", True, 458, 410), ("e", "X", True, 0, 0)]
    frame = spark.createDataFrame(
        rows,
        "probe_id string, symbol string, aggregate boolean, overlapping_date_count bigint, "
        "differing_row_count bigint",
    ).withColumns({f"ratio_median_{c}": F.lit(1.0) for c in ("open", "high", "low", "close")})
    r = q.comparison_accounting(frame).first()
    assert (r.overlapping_rows_compared, r.rows_with_any_difference) == (1458, 1110)
    assert r.probe_weighted_overlapping_rows == 2466 and r.aggregate_symbols_unique


# --- profile and text ----------------------------------------------------------------


def test_profile(spark):
    rows = spark.createDataFrame(
        [("2026-01-06", 1.0, 0), ("2026-01-05", None, 1), ("2026-01-05", 2.0, 2)],
        "time string, close double, position bigint",
    )
    r = profile.profile(rows, ["volume"], position="position").first()
    assert r.row_count == 3 and r.error_category == "INVALID_SCHEMA"
    assert r.data_quality_findings == [
        "missing_required_columns:volume", "duplicate_timestamps:time",
        "timestamps_not_ascending:time", "null_values:close",
    ]
    assert profile.profile(rows.where("false")).first().error_category == "EMPTY_RESPONSE"
    assert profile.profile(symbols(spark, ["x"])).first().data_quality_findings == [
        "no_recognized_timestamp_column"
    ]
    kept = profile.profile(rows, parse_timestamps=False).first()
    assert kept.timezone_information == "provider-specific/unparsed"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Read timed out: rate limit", "TIMEOUT"),
        ("Too Many Requests", "RATE_LIMIT"),
        ("HTTP 403 Forbidden", "AUTHENTICATION"),
        ("Max retries exceeded", "NETWORK"),
        ("Dữ liệu trống cho mã FPT với interval 1D", "EMPTY_RESPONSE"),
        ("boom", "PROVIDER"),
    ],
)
def test_error_categories(spark, text, want):
    row = redaction.classify_errors(symbols(spark, [text]), "symbol").first()
    assert row.error_category == want


def test_redaction(spark):
    rows = spark.range(1).select(
        F.lit("key abc123 here").alias("t"),
        F.create_map(F.lit("Api_Key"), F.lit("v"), F.lit("note"), F.lit("abc123")).alias("m"),
        F.array(F.lit("abc123")).alias("a"),
    )
    r = redaction.redact(rows, ["t", "m", "a"], ["abc123", ""]).first()
    assert r.t == "key [REDACTED] here" and r.a == ["[REDACTED]"]
    assert r.m == {"Api_Key": "[REDACTED]", "note": "[REDACTED]"}


def test_qualify_source_job(spark):
    from barledger.operators.units import VCI
    from barledger.plans.jobs import profile_landed, qualify_source

    base = daily(spark, [("FPT", d, 10.0, 5) for d in WINDOW[1:3]])
    out = qualify_source(probe(spark), response(spark, WINDOW), base, "2026-07-04", VCI)
    r = out["comparisons"].first()
    assert (r.overlapping_date_count, r.other_only_date_count, r.exact_match_count) == (2, 1, 2)
    assert out["verdict"].first().final_verdict == "rejected"
    assert {x.failure for x in out["failures"].collect()} == {"no_wrapper_level_failure"}
    assert all(x.severity == "INFO" for x in out["checks"].collect())
    landed = {"bars": base, "names": symbols(spark, ["x"])}
    rows = {x.capability_name: x.status for x in profile_landed(landed, {"names": ["time"]}).collect()}
    assert rows == {"bars": "VERIFIED", "names": "INVALID_SCHEMA"}


def test_evidence_locations(spark):
    from barledger.sources.store import evidence_locations

    manifests = spark.createDataFrame(
        [("r1", ["/s/raw/x", "/s/normalized/y"]), ("r2", ["/s/normalized/z"])],
        "run_id string, output_paths array<string>",
    )
    usual = spark.createDataFrame([("r1", "/u/1"), ("r2", "/u/2")], "run_id string, path string")
    got = {r.run_id: r.raw_path for r in evidence_locations(manifests, usual).collect()}
    assert got == {"r1": "/s/raw/x", "r2": "/u/2"}
