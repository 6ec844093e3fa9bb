"""Grouped statistics. Null values are left out of every statistic; a null group is a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def moments(df: DataFrame, group: str, value: str) -> DataFrame:
    v = F.col(value)
    return df.groupBy(group).agg(F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_pop(v), 6).alias("std"), F.min(v).alias("least"), F.max(v).alias("most"), F.sum(v).cast("long").alias("total"))


def percentiles(df: DataFrame, group: str, value: str, points=(25, 50, 75, 90, 95, 99)) -> DataFrame:
    """Exact percentiles with linear interpolation. Values are counted first: the aggregate's state grows with distinct values, not rows."""
    counted = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    out = counted.groupBy(group).agg(F.percentile(value, F.array(*[F.lit(p / 100) for p in points]), F.col("_n")).alias("_p"))
    return out.select(group, *[F.round(F.col("_p")[i], 6).alias(f"p{p}") for i, p in enumerate(points)])


def upper_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """The value in the middle, the upper one of two, found on counts of distinct values."""
    counted = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(group)
    upto = counted.withColumn("_u", F.sum("_n").over(w.orderBy(value))).withColumn("_t", F.sum("_n").over(w))
    return upto.where("_u - _n <= _t div 2 and _t div 2 < _u").select(group, F.col(value).alias("upper_median"))


def shares(df: DataFrame, group: str) -> DataFrame:
    counted = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6))


def histogram(df: DataFrame, value: str, step: int = 100) -> DataFrame:
    """Counts of values per bin of width ``step``, by the bin's lower edge."""
    return df.where(F.col(value).isNotNull()).groupBy((F.floor(F.col(value) / step) * step).cast("long").alias("edge")).agg(F.count(F.lit(1)).alias("n"))


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group with their rank ``k``; Spark limits each task's share of a group before the shuffle."""
    return df.withColumn("k", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("k") <= k)


def top_with_examples(df: DataFrame, value: str, order: Column, example: Column, first: Column, top: int, examples: int) -> DataFrame:
    """The most frequent values (ties by first occurrence, then value) with their first examples, joined by a space."""
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("_f")).orderBy(F.desc("n"), "_f", value).limit(top)
    few = df.select(value, order.alias("_o"), example.alias("_e")).join(F.broadcast(counted.select(value)), value, "left_semi")
    ranked = top_k_per_group(few, [value], [F.asc("_o")], examples)
    shown = ranked.groupBy(value).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "_e"))), lambda x: x["_e"]), " ").alias("examples"))
    return counted.join(shown, value).select(F.col(value).alias("value"), "n", "examples")


def group_concat(df: DataFrame, group: str, order: list[str], text: str, separator: str) -> DataFrame:
    """All texts of a group in order; callers bound the size of a group first, for the result is one value."""
    packed = F.sort_array(F.collect_list(F.struct(*order, text)))
    return df.groupBy(group).agg(F.array_join(F.transform(packed, lambda x: x[text]), separator).alias("text"))
