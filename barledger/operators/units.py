"""Unit provenance: stamp it on rows and resolve the policy a set of rows supports.

The resolver is fail-closed.  Only rows that all carry one identical, registered
provenance record permit a VND interpretation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barledger.contracts import (
    EFFECTIVE_UNIT_COLUMNS,
    PROVENANCE_COLUMNS,
    PROVENANCE_TYPES,
    PROVIDER,
    SOURCE_PROVENANCE_COLUMNS,
)
from barledger.functions.exprs import all_of, any_of, strip


@dataclass(frozen=True)
class UnitProvenance:
    """One provenance record; attribute order follows PROVENANCE_COLUMNS."""

    schema_version: str
    provider: str
    data_backend: str
    source_resolution: str
    policy_name: str
    policy_version: str
    price_unit: str
    volume_unit: str
    price_scale_to_vnd: float
    volume_scale_to_shares: float
    evidence_reference: str

    def by_column(self) -> dict[str, object]:
        return dict(zip(PROVENANCE_COLUMNS, self.__dict__.values(), strict=True))


# --- fixed values: the registered records ---------------------------------------------
KBS = UnitProvenance(
    "daily-unit-provenance-v1",
    PROVIDER,
    "kbs",
    "1D",
    "vnstock-kbs-daily-ohlcv",
    "1",
    "thousand_vnd",
    "shares",
    1000.0,
    1.0,
    "vnstock-kbs-ohlcv-units@2026-01-31",
)
VCI = UnitProvenance(
    "daily-unit-provenance-v1",
    PROVIDER,
    "vci",
    "1D",
    "vnstock-vci-daily-ohlcv",
    "1",
    "thousand_vnd",
    "shares",
    1000.0,
    1.0,
    "vnstock-vci-ohlcv-wrapper-units@2026-08-06",
)
REGISTERED = (KBS, VCI)
PRICE_UNITS = ["unknown", "vnd", "thousand_vnd"]
VOLUME_UNITS = ["provider_units", "shares"]
# --------------------------------------------------------------------------------------

_REASONS = {
    "no_data": "No rows were selected, so units cannot be verified.",
    "legacy_missing": "Rows predate unit provenance; only non-monetary metrics are allowed.",
    "incomplete": "Unit provenance is incomplete on the selected rows.",
    "ambiguous": "Selected rows do not share one complete provenance record.",
    "incompatible": "The provenance record is not a registered unit contract.",
    "verified": "All selected rows carry one identical registered provenance record.",
}
_UNIFORM = {
    "provider": "provider",
    "data_backend": "data_backend",
    "source_resolution": "source_resolution",
    "source_unit_evidence_reference": "evidence",
}


def registry(spark: SparkSession) -> DataFrame:
    schema = ", ".join(f"{c} {PROVENANCE_TYPES[c]}" for c in PROVENANCE_COLUMNS)
    return spark.createDataFrame([tuple(r.by_column().values()) for r in REGISTERED], schema)


def provenance_literals(record: UnitProvenance | None) -> dict[str, Column]:
    """The nine source-specific columns of a record, or typed NULLs."""
    values = record.by_column() if record else {}
    return {
        c: F.lit(values.get(c)).cast(PROVENANCE_TYPES[c]) for c in SOURCE_PROVENANCE_COLUMNS
    }


def with_provenance(df: DataFrame, record: UnitProvenance | None) -> DataFrame:
    return df.withColumns(provenance_literals(record))


def ensure_provenance_columns(df: DataFrame) -> DataFrame:
    missing = {
        c: F.lit(None).cast(PROVENANCE_TYPES[c])
        for c in SOURCE_PROVENANCE_COLUMNS
        if c not in df.columns
    }
    return df.withColumns(missing) if missing else df


def matches_record(record: UnitProvenance, source: str | None = None) -> Column:
    """Row (or struct) equals the record on all eleven fields; missing fields are unequal."""
    get = (lambda c: F.col(source)[c]) if source else F.col
    return all_of(
        F.coalesce(get(c) == F.lit(v).cast(PROVENANCE_TYPES[c]), F.lit(False))
        for c, v in record.by_column().items()
    )


def provenance_records(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Distinct provenance records per group with their row count; few rows, combined map-side."""
    typed = df.select(
        *by,
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(PROVENANCE_TYPES[c]).alias(c)
            for c in PROVENANCE_COLUMNS
        ],
    )
    return typed.groupBy(*by, *PROVENANCE_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


def provenance_facts(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Facts the resolver needs, one row per group (exactly one row without a group)."""
    return facts_of_records(provenance_records(df, list(by)), df.columns, by)


def facts_of_records(records: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Facts from distinct records; ``columns`` are those of the frame the records came from."""
    by = list(by)
    present = [c for c in SOURCE_PROVENANCE_COLUMNS if c in columns]
    absent = [c for c in PROVENANCE_COLUMNS if c not in columns]
    no_source = all_of(F.col(c).isNull() for c in SOURCE_PROVENANCE_COLUMNS)
    complete = all_of(F.col(c).isNotNull() for c in PROVENANCE_COLUMNS)
    record = F.when(complete, F.struct(*PROVENANCE_COLUMNS))
    texts = {
        alias: F.nullif(strip(F.col(c)), F.lit("")) for c, alias in _UNIFORM.items()
    }
    facts = records.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows"),
        F.coalesce(F.sum(F.when(no_source, F.col("n"))), F.lit(0)).alias("fact_no_source"),
        F.coalesce(F.sum(F.when(complete, F.col("n"))), F.lit(0)).alias("fact_complete"),
        F.coalesce(F.max(record) == F.min(record), F.lit(True)).alias("fact_one_record"),
        F.max(record).alias("fact_record"),
        *[
            F.when(F.min(t) == F.max(t), F.min(t)).alias(f"fact_uniform_{a}")
            for a, t in texts.items()
        ],
    )
    return facts.withColumns(
        {
            "fact_has_source_columns": F.lit(bool(present)),
            "fact_has_all_columns": F.lit(not absent),
        }
    )


def _status() -> Column:
    f = F.col
    record = f("fact_record")
    valid = F.coalesce(
        record["source_price_unit"].isin(PRICE_UNITS)
        & record["source_volume_unit"].isin(VOLUME_UNITS)
        & (record["source_price_scale_to_vnd"] > 0)
        & (record["source_volume_scale_to_shares"] > 0),
        F.lit(False),
    )
    registered = any_of(matches_record(r, "fact_record") for r in REGISTERED)
    return (
        F.when(f("fact_rows").isNull() | (f("fact_rows") == 0), "no_data")
        .when(~f("fact_has_source_columns"), "legacy_missing")
        .when(~f("fact_has_all_columns"), "incomplete")
        .when(f("fact_no_source") == f("fact_rows"), "legacy_missing")
        .when((f("fact_complete") < f("fact_rows")) & (f("fact_complete") > 0), "ambiguous")
        .when(f("fact_complete") < f("fact_rows"), "incomplete")
        .when(~f("fact_one_record"), "ambiguous")
        .when(~valid, "incompatible")
        .when(~registered, "unregistered")
        .otherwise("verified")
    )


def resolve_facts(facts: DataFrame) -> DataFrame:
    """Turn provenance facts into the effective policy; works after a left join too."""
    df = facts.withColumn("__s", _status())
    known_record = F.col("__s").isin("verified", "unregistered")
    status = F.when(F.col("__s") == "unregistered", "incompatible").otherwise(F.col("__s"))
    ok = F.col("__s") == "verified"
    record = F.col("fact_record")

    def either(field: str, uniform: str) -> Column:
        return F.when(known_record, record[field]).otherwise(F.col(f"fact_uniform_{uniform}"))

    source = {
        c: F.when(known_record, record[c]).alias(c) for c in SOURCE_PROVENANCE_COLUMNS
    }
    reason = F.coalesce(
        *[F.when(status == s, F.lit(text)) for s, text in _REASONS.items()]
    )
    policy = {
        "policy_provider": either("provider", "provider"),
        "policy_data_backend": either("data_backend", "data_backend"),
        "policy_source_resolution": either("source_resolution", "source_resolution"),
        "unit_provenance_status": status,
        "unit_verification_status": F.when(ok, "verified").otherwise("unverified"),
        "unit_policy_name": F.when(ok, record["source_unit_policy_name"]).otherwise("unverified"),
        "unit_policy_version": F.when(ok, record["source_unit_policy_version"]).otherwise("1"),
        "price_unit": F.when(ok, record["source_price_unit"]).otherwise("unknown"),
        "volume_unit": F.when(ok, record["source_volume_unit"]).otherwise("provider_units"),
        "traded_value_unit": F.when(ok, "vnd").otherwise("unavailable"),
        "unit_evidence_reference": either("source_unit_evidence_reference", "evidence"),
        "unit_verification_reason": reason,
        "vnd_traded_value_permitted": ok,
        "row_count": F.coalesce(F.col("fact_rows"), F.lit(0)).cast("bigint"),
        "price_scale": F.when(ok, record["source_price_scale_to_vnd"]),
        "volume_scale": F.when(ok, record["source_volume_scale_to_shares"]),
    }
    facts_columns = [c for c in facts.columns if c.startswith("fact_")]
    nested = F.struct(*source.values()).alias("policy_source")
    return df.withColumns(policy).withColumn("policy_source", nested).drop(
        "__s", *facts_columns
    )


def unit_policy(df: DataFrame, by: list[str] = ()) -> DataFrame:
    """Effective unit policy of all rows, or of each group of rows."""
    return resolve_facts(provenance_facts(df, by))


def policy_value(df: DataFrame) -> Column:
    """The frame-wide policy as a scalar-subquery struct, to stamp onto other rows."""
    policy = unit_policy(df)
    return policy.select(F.struct(*policy.columns).alias("policy")).scalar()


def effective_columns(policy: Column) -> dict[str, Column]:
    return {c: policy[c] for c in EFFECTIVE_UNIT_COLUMNS}


def provenance_output_columns(policy: Column) -> dict[str, Column]:
    """The eleven provenance columns a policy reports (liquidity output)."""
    columns = {
        "provider": policy["policy_provider"],
        "source_resolution": policy["policy_source_resolution"],
    }
    columns.update({c: policy["policy_source"][c] for c in SOURCE_PROVENANCE_COLUMNS})
    columns["data_backend"] = policy["policy_data_backend"]
    return columns
