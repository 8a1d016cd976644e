"""Named queries: a Spark function and, where SQL can say it, the SQL to check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adperf.plans import oracle
from adperf.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`; `sql` may use the shared CTEs of `oracle`."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(configure(spark), sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = oracle.with_ctes(sql)
        return fn

    return register


def tidy(df: DataFrame) -> DataFrame:
    """Result types both engines share: long, double to 6 places, text, boolean.

    Doubles are lifted by 1e-9 before rounding, here and in the SQL: a value that
    lies exactly between two results then rounds up in both engines, whatever the
    last digits of a sum are.
    """
    return df.select(*[_tidy(f).alias(f.name) for f in df.schema.fields])


def _tidy(field: T.StructField) -> Column:
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return c.cast("long")
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.round(c.cast("double") + F.lit(1e-9), 6)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, T.ArrayType):
        return F.array_join(c.cast("array<string>"), ",")
    return c
