"""Registration of queries with their oracle SQL, and uniform result presentation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barledger.catalog.views import oracle

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def present(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, arrays as JSON text, integers as BIGINT."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.VariantType):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, views: dict[str, str] | None = None):
    """Register a query; ``sql`` may use any view of ``views.VIEW_SQL`` by name."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return present(fn(spark, sf_dir))

        if name in ENTRIES:
            raise ValueError(f"Query {name} is registered twice.")
        ENTRIES[name] = Entry(name, run, oracle(sql, views) if sql else None)
        return fn

    return register
