"""Quality checks: each returns the rows that fail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, failures) for every column, in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns))).alias("x")).select("x.*")


def non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*(F.count_if(F.col(c) < 0).alias(c) for c in columns))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns))).alias("x")).select("x.*")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key the parent lacks; a null key is no orphan."""
    return child.where(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def components_add_up(mart: DataFrame) -> DataFrame:
    return mart.where("gross_cents <> price_cents + freight_cents")


def arpu_formulas(mart: DataFrame) -> DataFrame:
    arpu = F.floor(F.col("paid_cents").cast("double") / F.col("active_customers") + 0.5)
    return mart.where((F.col("arpu_cents") != arpu) | ~F.col("repeat_rate").between(0, 1))


def allocation_balance(allocation: DataFrame) -> DataFrame:
    """Orders whose allocations miss the payments by more than a cent an item."""
    per = allocation.where("order_gross_cents <> 0 and paid_cents is not null").groupBy("order_id").agg(F.sum("allocated_cents").alias("allocated_cents"), F.max("paid_cents").alias("paid_cents"), F.count("*").alias("items"))
    return per.where(F.abs(F.col("allocated_cents") - F.col("paid_cents")) > F.col("items"))


def name_diff(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values that only one side has."""
    a, b = left.select(column).distinct(), right.select(column).distinct()
    return a.join(b, column, "left_anti").withColumn("side", F.lit("left_only")).unionByName(b.join(a, column, "left_anti").withColumn("side", F.lit("right_only")))


def gate(**failures: DataFrame) -> DataFrame:
    """(check_name, failures, passed) of several failing-row tables."""
    out = None
    for name, df in failures.items():
        row = df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check_name"), "failures", (F.col("failures") == 0).alias("passed"))
        out = row if out is None else out.unionByName(row)
    return out
