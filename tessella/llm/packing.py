"""Filling containers of fixed capacity by best-two-fit."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.budget import items_once, label
from tessella.spark_util import cut

#: Items that one task fills containers with; more of a granularity are spread over several such groups.
GROUP_ITEMS = 20_000
#: One in so many containers of each group (at least ``REOPENED_LEAST``), the last ones, is opened again and its items packed
#: with those of so many groups; what is loose then is about one container in as many groups.
REOPENED = 20
REOPENED_LEAST = 5


class _Sizes:
    """How many items of each size are left, with a bit set for every size there is."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left = counts.tolist()
        self.bits = sum(1 << s for s, n in enumerate(self.left) if n)

    def take(self, size: int) -> None:
        self.left[size] -= 1
        if not self.left[size]:
            self.bits &= ~(1 << size)

    def give(self, size: int) -> None:
        self.left[size] += 1
        self.bits |= 1 << size

    def largest(self, most: int) -> int:
        """The largest size up to ``most``, -1 if none."""
        return (self.bits & ((1 << (most + 1)) - 1)).bit_length() - 1

    def best_two(self, gap: int) -> tuple[int, int, int]:
        """The two sizes (not 0) that fit the gap best, after their sum; the sum 0 if no two fit."""
        best = (0, 0, 0)
        a = self.largest(gap - 1)
        while a > 0 and 2 * a > best[0]:
            b = self.largest(min(a, gap - a))
            if b == a and self.left[a] < 2:
                b = self.largest(a - 1)
            if b > 0 and a + b > best[0]:
                best = (a + b, a, b)
                if best[0] == gap:
                    break
            a = self.largest(a - 1)
        return best


def best_two_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of sizes: each is filled greedily with the largest that fits, then its smallest item gives way to two
    left-over items if these fill the room better, for as long as that helps. Sizes of 0 go to the last bin."""
    pool = _Sizes(np.bincount(sizes, minlength=capacity + 1))
    nothing, pool.left[0] = pool.left[0], 0
    pool.bits &= ~1
    bins: list[list[int]] = []
    while pool.bits:
        own, gap = [], capacity
        while (size := pool.largest(gap)) > 0:
            pool.take(size)
            own.append(size)
            gap -= size
        while gap and pool.bits:
            smallest = own[-1]
            total, a, b = pool.best_two(gap + smallest)
            if total <= smallest:
                break
            own.pop()
            pool.take(a)
            pool.take(b)
            pool.give(smallest)
            own = sorted([*own, a, b], reverse=True)
            gap -= total - smallest
        bins.append(own)
    if nothing:
        bins = bins or [[]]
        bins[-1] = [*bins[-1], *[0] * nothing]
    return bins


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """Number of the container (and its free room) for the pieces of one group, and whether it is one of the last."""
    capacity = int(rows["capacity"].iloc[0])
    rows = rows.sort_values(["size", "seq", "item_id", "piece"], ignore_index=True, na_position="first")
    sizes = rows["size"].to_numpy(np.int64)
    first = np.searchsorted(sizes, np.arange(capacity + 1)).tolist()
    container, free = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    bins = best_two_fit(sizes, capacity)
    for number, own in enumerate(bins):
        room = capacity - sum(own)
        for size in own:
            container[first[size]], free[first[size]] = number, room
            first[size] += 1
    return rows.assign(number=container, free=free, tail=(len(bins) - container) <= max(REOPENED_LEAST, len(bins) // REOPENED))


def pieces(items: DataFrame, limits: DataFrame) -> DataFrame:
    """Items of each granularity once, those larger than its capacity cut into full pieces and a rest.

    ``item_id, granularity, seq, capacity, piece, n_pieces, size, start_char, end_char``; a
    piece's place in the text goes by four characters to a token, where the size was
    counted so. Granularities without a positive limit have a null capacity.
    """
    most = limits.where("max_tokens > 0").groupBy(label("granularity").alias("granularity")).agg(F.max("max_tokens").alias("capacity"))
    chars = items.where("item_id is not null").groupBy("item_id").agg(F.max(F.length("text")).cast("long").alias("chars"))
    once = items_once(items).withColumn("size", F.greatest("size", F.lit(0))).join(chars, "item_id").join(F.broadcast(most), "granularity", "left")
    split = once.withColumn("n_pieces", F.when(F.col("size") > F.col("capacity"), F.expr("(size + capacity - 1) div capacity")).otherwise(F.lit(1)).cast("long"))
    each = split.select("*", F.explode(F.expr("sequence(0L, n_pieces - 1)")).alias("piece"))
    at, upto = F.col("piece") * F.col("capacity"), F.least(F.col("size"), (F.col("piece") + 1) * F.col("capacity"))
    whole = F.col("n_pieces") == 1
    place = lambda t: F.when(F.expr("chars div 4 = size"), t * 4).otherwise(F.floor(F.col("chars") * t / F.col("size")))
    return each.select(
        "item_id", "granularity", "seq", "capacity", "piece", "n_pieces", F.when(whole, F.col("size")).otherwise(upto - at).alias("size"),
        F.when(whole, F.lit(0)).otherwise(place(at)).cast("long").alias("start_char"), F.when(F.col("piece") == F.col("n_pieces") - 1, F.col("chars")).otherwise(place(upto)).cast("long").alias("end_char"),
    )


def pack(items: DataFrame, limits: DataFrame, group_items: int = GROUP_ITEMS) -> DataFrame:
    """The container of every item or piece: ``granularity, container, item_id, piece, n_pieces, start_char, end_char, tokens, capacity, unused``.

    Every item_id counts once (its latest row); missing sizes are a quarter of the
    text's characters, negative ones 0; null ids are left out; items of a
    granularity without a limit keep a null container. Only (id, seq, size) rows
    travel, spread by hash over groups of about ``group_items``, so a granularity that
    holds most items is filled by many tasks. The last containers of each
    group, among them the loose ones, are opened again and their items packed together, by the
    same method; pieces of full capacity are a container of their own.
    """
    parts = pieces(items, limits)
    counts = parts.groupBy("granularity").agg(F.ceil(F.count(F.lit(1)) / F.lit(group_items)).alias("n_groups"))
    spread = parts.join(counts, "granularity").withColumn("grp", F.pmod(F.xxhash64("item_id", "piece"), F.col("n_groups")))
    full = spread.where("size = capacity").withColumn("container", F.concat_ws(":", F.lit("full"), "granularity", "item_id", "piece")).withColumn("free", F.lit(0).cast("long"))
    fill = lambda rows: rows.groupBy("granularity", "grp").applyInPandas(_fill, ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", number long, free long, tail boolean")
    named = lambda rows, name: rows.withColumn("container", F.concat_ws(":", F.lit(name), "granularity", "grp", "number")).drop("number", "tail")
    filled = cut(fill(spread.where("size < capacity")))
    loose = (F.col("n_groups") > 1) & F.col("tail")
    again = filled.where(loose).drop("number", "free", "tail").withColumn("grp", F.pmod(F.xxhash64("item_id", "piece"), F.ceil(F.col("n_groups") / F.lit(REOPENED))))
    packed = named(filled.where(~loose), "packed").unionByName(named(fill(again), "rest"))
    none = spread.where("capacity is null").withColumn("container", F.lit(None).cast("string")).withColumn("free", F.lit(None).cast("long"))
    out = full.unionByName(packed).unionByName(none)
    return out.select("granularity", "container", "item_id", "piece", "n_pieces", "start_char", "end_char", F.col("size").alias("tokens"), "capacity", F.col("free").alias("unused"))


def containers(items: DataFrame, limits: DataFrame) -> DataFrame:
    """One row per container: ``granularity, container, capacity, n_items, used, unused``."""
    rows = pack(items, limits).where("container is not null")
    return rows.groupBy("granularity", "container").agg(F.max("capacity").alias("capacity"), F.count(F.lit(1)).alias("n_items"), F.sum("tokens").alias("used"), F.max("unused").alias("unused"))


def fill_report(items: DataFrame, limits: DataFrame) -> DataFrame:
    """By granularity: containers, the fewest possible by total size, and the share of capacity left unused."""
    by = containers(items, limits).groupBy("granularity").agg(F.count(F.lit(1)).alias("n_containers"), F.max("capacity").alias("capacity"), F.sum("used").alias("used"), F.sum("unused").alias("unused"))
    return by.select("granularity", "n_containers", F.ceil(F.col("used") / F.col("capacity")).cast("long").alias("least_containers"), "used", "unused", F.round(F.col("unused") / (F.col("used") + F.col("unused")), 6).alias("unused_share"))
