"""Secret redaction and error-text classification over text columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barledger.operators.campaign import status_counts

# --- fixed values ---------------------------------------------------------------------
SENSITIVE_KEY_PARTS = ["authorization", "api_key", "apikey", "token", "secret", "password"]
REDACTION = "[REDACTED]"
ERROR_TEXT_LIMIT = 500
CATEGORY_PHRASES = {
    "TIMEOUT": ["timeout", "timed out"],
    "PACKAGE_NOT_INSTALLED": ["no module named"],
    "RATE_LIMIT": ["rate limit", "too many requests", "429"],
    "AUTHENTICATION": ["unauthorized", "forbidden", "invalid api", "api key", "401", "403"],
    "NETWORK": [
        "connection",
        "network",
        "name resolution",
        "nodename nor servname",
        "max retries",
        "dns",
    ],
}
EMPTY_RESPONSE_PHRASES = [
    ["dữ liệu trống cho mã", "với interval"],
    ["không tìm thấy dữ liệu", "kiểm tra lại mã chứng khoán hoặc thời gian truy xuất"],
]
CATEGORY_STATUS = {
    "AUTHENTICATION": "AUTHENTICATION_REQUIRED",
    "RATE_LIMIT": "RATE_LIMITED",
    "NETWORK": "NETWORK_ERROR",
    "TIMEOUT": "NETWORK_ERROR",
    "EMPTY_RESPONSE": "EMPTY_RESPONSE",
    "INVALID_SCHEMA": "INVALID_SCHEMA",
    "PACKAGE_NOT_INSTALLED": "UNAVAILABLE_PACKAGE",
}
CATEGORIES = [
    "NONE",
    "AUTHENTICATION",
    "RATE_LIMIT",
    "NETWORK",
    "TIMEOUT",
    "PROVIDER",
    "INVALID_SCHEMA",
    "EMPTY_RESPONSE",
    "PACKAGE_NOT_INSTALLED",
    "UNKNOWN",
]
# --------------------------------------------------------------------------------------


def redact_text(c: Column, secrets: list[str]) -> Column:
    known = [s for s in secrets if s]
    return reduce(lambda text, s: F.replace(text, F.lit(s), F.lit(REDACTION)), known, c)


def redact_map(c: Column, secrets: list[str], key_parts: list[str] = SENSITIVE_KEY_PARTS) -> Column:
    """Mask values under sensitive keys, and known secrets in all other values."""

    def mask(key: Column, value: Column) -> Column:
        lowered = F.lower(key)
        sensitive = reduce(
            lambda a, b: a | b, [F.contains(lowered, F.lit(p)) for p in key_parts]
        )
        return F.when(sensitive, F.lit(REDACTION)).otherwise(redact_text(value, secrets))

    return F.transform_values(c, mask)


def redact(
    df: DataFrame,
    columns: list[str],
    secrets: list[str],
    key_parts: list[str] = SENSITIVE_KEY_PARTS,
) -> DataFrame:
    """Redact text, string-map and string-array columns of a frame."""
    changed = {}
    for name in columns:
        kind = df.schema[name].dataType
        if isinstance(kind, T.MapType):
            changed[name] = redact_map(F.col(name), secrets, key_parts)
        elif isinstance(kind, T.ArrayType):
            changed[name] = F.transform(name, lambda item: redact_text(item, secrets))
        else:
            changed[name] = redact_text(F.col(name), secrets)
    return df.withColumns(changed)


def sanitized_error(c: Column, secrets: list[str]) -> Column:
    """Redacted error text, cut to the stored error length."""
    return F.substring(redact_text(c, secrets), 1, ERROR_TEXT_LIMIT)


def error_category(c: Column) -> Column:
    text = F.lower(c)

    def any_phrase(phrases: list[str]) -> Column:
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases])

    def all_phrases(phrases: list[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.contains(text, F.lit(p)) for p in phrases])

    empty = reduce(lambda a, b: a | b, [all_phrases(p) for p in EMPTY_RESPONSE_PHRASES])
    return (
        F.when(any_phrase(CATEGORY_PHRASES["TIMEOUT"]), "TIMEOUT")
        .when(any_phrase(CATEGORY_PHRASES["PACKAGE_NOT_INSTALLED"]), "PACKAGE_NOT_INSTALLED")
        .when(empty, "EMPTY_RESPONSE")
        .when(any_phrase(CATEGORY_PHRASES["RATE_LIMIT"]), "RATE_LIMIT")
        .when(any_phrase(CATEGORY_PHRASES["AUTHENTICATION"]), "AUTHENTICATION")
        .when(any_phrase(CATEGORY_PHRASES["NETWORK"]), "NETWORK")
        .otherwise("PROVIDER")
    )


def category_status(category: Column) -> Column:
    chain = F.lit("PROVIDER_ERROR")
    for name, status in CATEGORY_STATUS.items():
        chain = F.when(category == name, status).otherwise(chain)
    return chain


def classify_errors(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("error_category", error_category(F.col(column))).withColumn(
        "capability_status", category_status(F.col("error_category"))
    )


def error_counts(df: DataFrame, column: str) -> DataFrame:
    classified = classify_errors(df, column)
    return status_counts(classified, CATEGORIES, "error_category")
