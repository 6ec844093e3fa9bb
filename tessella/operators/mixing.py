"""Deduplication by content and interleaving of sources."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.spark_util import cut


def keep_first(df: DataFrame, text: str, order: str) -> DataFrame:
    """One row per distinct text, the first by ``order``: ``order, digest, n_copies``; null texts are left out. Only digests are shuffled."""
    return df.where(F.col(text).isNotNull()).select(order, F.sha2(text, 256).alias("digest")).groupBy("digest").agg(F.min(order).alias(order), F.count(F.lit(1)).alias("n_copies"))


def ranks(df: DataFrame, group: str, order: list[str], buckets: int = 4096) -> DataFrame:
    """``df`` with ``rank`` from 0 within each group, in hash order of ``order``.

    Rows are numbered within hash buckets and the buckets' counts added up, so no
    task sorts a whole group however large it is.
    """
    placed = df.withColumn("_u", F.xxhash64(*order)).withColumn("_b", F.shiftrightunsigned("_u", 64 - buckets.bit_length() + 1))
    within = placed.withColumn("_k", F.row_number().over(Window.partitionBy(group, "_b").orderBy("_u", *order)))
    sizes = placed.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy(group).orderBy("_b")) - F.col("_n")).drop("_n")
    return within.join(F.broadcast(before), [group, "_b"]).withColumn("rank", F.col("_k") + F.col("_before") - 1).drop("_u", "_b", "_k", "_before")


def interleave(df: DataFrame, weights: dict[str, float], seed: int, buckets: int = 4096) -> DataFrame:
    """Rows of several sources in a mixed order with shares near the weights, until the first source is used up.

    Columns ``position, source, id, text``: every row draws a place by its rank in its
    source divided by the weight, shifted by a seeded hash below one step; places
    beyond the end of the source that ends first are cut off. Sources without a
    weight, and rows with a null source, are left out; a source with a weight but no
    rows ends the mix at once.
    """
    weight = F.create_map(*map(F.lit, chain(*weights.items())))
    ranked = ranks(df.where(F.col("source").isin(*weights)).select("source", "id"), "source", ["id"], buckets)
    shift = F.pmod(F.xxhash64("source", "id", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    drawn = cut(ranked.withColumn("place", (F.col("rank") + shift) / weight[F.col("source")]))
    ends = drawn.groupBy("source").agg(((F.max("rank") + 1) / F.max(weight[F.col("source")])).alias("end"))
    last = ends.agg(F.when(F.count(F.lit(1)) == len(weights), F.min("end")).otherwise(F.lit(0.0)).alias("last"))
    kept = drawn.join(F.broadcast(last), F.col("place") < F.col("last")).select("source", "id", F.col("place").alias("position"))
    return kept.join(df, ["source", "id"]).select("position", "source", "id", "text")
