"""Frame profiles: one aggregate over all columns, plus timestamp uniqueness and order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barledger.contracts import CAPABILITY_STATUSES
from barledger.functions.exprs import timestamp_facts
from barledger.operators.campaign import status_counts
from barledger.operators.ordering import duplicate_counts, order_breaks
from barledger.operators.sets import merge_by_key

TIMESTAMP_CANDIDATES = ("time", "date", "datetime", "tradingDate")


def profile(
    df: DataFrame,
    required: list[str] = (),
    candidates: tuple[str, ...] = TIMESTAMP_CANDIDATES,
    parse_timestamps: bool = True,
    position: str | None = None,
) -> DataFrame:
    """One row: counts, null columns, timestamp range, findings and error category."""
    stamp = next((c for c in candidates if c in df.columns), None)
    missing = sorted(set(required) - set(df.columns))
    columns = list(df.columns)
    parsed = bool(stamp) and parse_timestamps
    facts = timestamp_facts(F.col(stamp), df.schema[stamp].dataType) if parsed else None
    local = facts["local"] if facts else F.lit(None).cast("timestamp_ntz")
    zoned = facts["status"] == "aware" if facts else F.lit(False)
    instant = F.coalesce(facts["utc"], local.cast("timestamp")) if facts else None
    base = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(F.col(f"`{c}`")).alias(f"__c{i}") for i, c in enumerate(columns)],
        F.min(local).alias("earliest_timestamp"),
        F.max(local).alias("latest_timestamp"),
        F.coalesce(F.bool_or(zoned), F.lit(False)).alias("__zoned"),
    )
    if parsed:
        stamped = df.select(
            instant.alias("__t"), *([F.col(position).alias("__p")] if position else [])
        )
        base = base.withColumn(
            "__repeats", duplicate_counts(stamped, ["__t"]).select("duplicate_count").scalar()
        )
        breaks = (
            order_breaks(stamped.where("__t is not null"), "__p", [F.col("__t")])
            .select("order_break_count")
            .scalar()
            if position
            else F.lit(0)
        )
        base = base.withColumn("__breaks", F.coalesce(breaks, F.lit(0)))
    else:
        base = base.withColumns({"__repeats": F.lit(0), "__breaks": F.lit(0)})
    rows = F.col("row_count")
    nulls = F.array_compact(
        F.array(*[F.when(F.col(f"__c{i}") < rows, F.lit(c)) for i, c in enumerate(columns)])
    )
    empty = rows == 0
    unparsed = F.lit(parsed) & F.col("earliest_timestamp").isNull()
    findings = F.array_compact(
        F.array(
            F.when(empty, "response_contained_no_rows"),
            F.when(~empty & F.lit(bool(missing)), "missing_required_columns:" + ",".join(missing)),
            F.when(~empty & F.lit(stamp is None), "no_recognized_timestamp_column"),
            F.when(
                ~empty & F.lit(bool(stamp) and not parse_timestamps),
                f"timestamp_column_preserved_unparsed:{stamp}",
            ),
            F.when(~empty & unparsed, f"timestamp_column_unparsable:{stamp}"),
            F.when(~empty & ~unparsed & (F.col("__repeats") > 0), f"duplicate_timestamps:{stamp}"),
            F.when(~empty & ~unparsed & (F.col("__breaks") > 0), f"timestamps_not_ascending:{stamp}"),
            F.when(
                ~empty & (F.size(nulls) > 0),
                F.concat(F.lit("null_values:"), F.concat_ws(",", nulls)),
            ),
        )
    )
    zone = (
        F.when(F.lit(bool(stamp) and not parse_timestamps), "provider-specific/unparsed")
        .when(F.col("earliest_timestamp").isNull(), F.lit(None))
        .when(F.col("__zoned"), "aware")
        .otherwise("naive/unspecified")
    )
    return base.select(
        "row_count",
        "earliest_timestamp",
        "latest_timestamp",
        zone.alias("timezone_information"),
        F.to_json(
            F.create_map(
                *[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())]
            )
        ).alias("schema_summary"),
        findings.alias("data_quality_findings"),
        F.when(empty, "EMPTY_RESPONSE")
        .when(F.lit(bool(missing)) | unparsed, "INVALID_SCHEMA")
        .otherwise("NONE")
        .alias("error_category"),
    )


def merge_capabilities(documented: DataFrame, live: DataFrame) -> DataFrame:
    """Live capability rows replace documented ones of the same name; new ones are added."""
    return merge_by_key(documented, live, "capability_name")


def capability_counts(capabilities: DataFrame) -> DataFrame:
    return status_counts(capabilities, CAPABILITY_STATUSES)
