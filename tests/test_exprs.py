import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from barledger.functions import exprs as x


def test_weekday_arithmetic_matches_expanded_calendar(spark):
    rnd = random.Random(7)
    base = dt.date(1955, 1, 1)
    pairs = []
    for _ in range(300):
        a = base + dt.timedelta(days=rnd.randrange(40000))
        pairs.append((a, a + dt.timedelta(days=rnd.randrange(60)), rnd.randrange(1, 60)))
    rows = spark.createDataFrame(pairs, "a date, b date, n int")
    got = rows.select(
        "a", "b", "n", x.weekdays_between(F.col("a"), F.col("b")).alias("w")
    ).collect()
    for r in got:
        assert r.w == len(pd.bdate_range(r.a, r.b)), r
    for n in (1, 5, 20, 37):
        starts = rows.select("a", x.trailing_weekday_start(F.col("a"), n).alias("s")).collect()
        for r in starts[:80]:
            assert r.s == pd.bdate_range(end=pd.Timestamp(r.a), periods=n)[0].date(), (r, n)


def test_text_and_number_coercion(spark):
    texts = [" fpt ", " \t", "", None, "a\n", "12.5d", "nan", " 1e3 ", "inf", ".5", "1_0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(
        x.clean_text(F.col("t")).alias("c"), x.to_number(rows, "t").alias("n")
    ).collect()
    assert [r.c for r in got][:5] == ["FPT", None, None, None, "A"]
    assert [r.n for r in got][5:] == [None, None, 1000.0, float("inf"), 0.5, None]


def test_number_turns_nan_into_null(spark):
    rows = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r.n for r in rows.select(x.to_number(rows, "v").alias("n")).collect()] == [None, 1.0]


def test_timestamp_facts_never_localize(spark):
    texts = ["2020-01-02 09:15:00", "2020-01-02T09:15:00+07:00", "12:30", "2020-13-01", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    facts = x.timestamp_facts(F.col("t"), rows.schema["t"].dataType)
    got = rows.select(*[facts[k].alias(k) for k in facts]).collect()
    assert [r.status for r in got] == ["naive", "aware", "invalid", "invalid", "missing"]
    assert got[0].utc is None and got[0].local == dt.datetime(2020, 1, 2, 9, 15)
    assert got[1].utc == dt.datetime(2020, 1, 2, 2, 15)
    assert got[1].local == dt.datetime(2020, 1, 2, 9, 15)


def test_provider_time_keeps_numbers_raw(spark):
    rows = spark.createDataFrame(
        [('1783067546136',), ('"2026-07-03 10:00:00"',), ('"1970-01-01"',), ("null",), ('"123"',),
         ("true",)],
        "j string",
    ).select(F.parse_json("j").alias("v"))
    facts = x.provider_time(F.col("v"), rows.schema["v"].dataType)
    got = rows.select(*[facts[k].alias(k) for k in facts]).collect()
    assert [r.status for r in got] == [
        "provider_specific_unparsed", "parsed", "invalid", "missing", "invalid", "invalid",
    ]
    assert got[0].raw == "1783067546136" and got[0].parsed is None
    assert got[1].parsed == dt.datetime(2026, 7, 3, 10)


def test_day_parses_iso_only(spark):
    rows = spark.createDataFrame(
        [("2020-01-02",), ("2020-01-02T23:30:00+07:00",), ("2020-02-30",), ("x",), (None,)],
        "t string",
    )
    got = [r.d for r in rows.select(x.to_day(rows, "t").alias("d")).collect()]
    assert got == [dt.date(2020, 1, 2), dt.date(2020, 1, 2), None, None, None]
