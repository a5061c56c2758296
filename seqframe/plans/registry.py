"""Registration of queries: one name, the same column types in Spark and in SQL, and the views that the SQL reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqframe.plans.fixtures import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
# Spark's and SQL's names of the types; doubles are compared to six decimals.
_TYPES = {"s": ("string", "varchar"), "n": ("bigint", "bigint"), "d": ("double", "double"), "b": ("boolean", "boolean")}


def query(name: str, columns: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable:
    """Register fn(spark, sf_dir). columns: ``name:type`` words, type s, n, d or b.

    sql is a query over the driver's tables and the named views; its columns have the same names.
    """
    typed = [w.split(":") for w in columns.split()]

    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return df.select(*[F.round(F.col(c).cast("double"), 6).alias(c) if t == "d" else F.col(c).cast(_TYPES[t][0]).alias(c) for c, t in typed])

        QUERIES[name] = run
        if sql is not None:
            casts = ", ".join(f"round(cast({c} as double), 6) as {c}" if t == "d" else f"cast({c} as {_TYPES[t][1]}) as {c}" for c, t in typed)
            SQL[name] = (with_views(*views) if views else "") + f"select {casts} from ({sql}) as answer"
        return fn

    return add


def joined(column: str, spark_side: bool = True):
    """An array of numbers as comma-joined text."""
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",")
