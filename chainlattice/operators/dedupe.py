"""Keyed choices that depend on order: first or last row of a key, order-aware collections, counters.

Spark's dropDuplicates and first() promise no order; every choice here is by an explicit one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_wins(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row that comes first of each key."""
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__rank = 1").drop("__rank")


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_wins(df, keys, [F.desc(c) for c in order])


def in_order(order: list[str], value: Column) -> Column:
    """Aggregate: the non-null values of a group in the order given."""
    rows = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*order, value.alias("__value")))))
    return F.transform(rows, lambda r: r["__value"])


def union_sorted(*values: Column) -> Column:
    """Aggregate: sorted distinct members of all arrays of a group."""
    return F.array_sort(F.array_distinct(F.flatten(F.concat(*[F.collect_list(v) for v in values]))))


def counts(df: DataFrame, key: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def delta(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys whose number of rows differs, with both numbers and the difference. One pass and one shuffle."""
    both = before.select(key, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(after.select(key, F.lit(0).alias("b"), F.lit(1).alias("a")))
    out = both.groupBy(key).agg(F.sum("b").alias("before"), F.sum("a").alias("after"))
    return out.where("before != after").withColumn("delta", F.col("after") - F.col("before"))


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys in all, in both, and in one alone. Null is a key."""
    both = a.select(key, F.lit(True).alias("in_a"), F.lit(False).alias("in_b")).unionByName(b.select(key, F.lit(False).alias("in_a"), F.lit(True).alias("in_b")))
    each = both.groupBy(key).agg(F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b"))
    return each.agg(F.count("*").alias("total"), F.count_if(F.expr("in_a and in_b")).alias("both"), F.count_if(F.expr("in_a and not in_b")).alias("only_a"), F.count_if(F.expr("in_b and not in_a")).alias("only_b"))


def top(df: DataFrame, key: str, k: int, order: str) -> DataFrame:
    """The k most frequent keys; equal ones by first appearance."""
    each = df.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("__first"))
    return each.orderBy(F.desc("n"), "__first").limit(k).drop("__first")


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by a seeded hash of their key: the same rows at every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)
