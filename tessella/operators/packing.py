"""Packing ordered items into chunks of at most so many tokens.

Where a chunk ends depends on all items before it, yet no task holds a whole group:
the sorted items are packed in blocks of neighbours. A block that isn't the first of
its group tells for each number of tokens that a chunk may hold at its start what
comes out at its end; these few rows are followed from block to block, and each
block is then packed from the state it is known to start with. Only (order, tokens)
rows take part. Items with null tokens count 0; null orders come first; ties of the
order go by the item's key.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.spark_util import cut

BLOCK = 100_000
#: State between two items: no chunk open for more, else the tokens of the open one.
CLOSED = -1


def _starts(tokens: np.ndarray, limit: int) -> tuple[Callable, Callable]:
    """Of a block of items two functions: where the next chunk starts if one starts at an item, and if the open one holds so many tokens."""
    sums, large, n = np.cumsum(tokens), np.flatnonzero(tokens > limit), len(tokens)

    def up_to(room: int, at: int) -> int:
        k = np.searchsorted(large, at)
        return int(min(np.searchsorted(sums, room, "right"), large[k] if k < len(large) else n))

    def after(at: int) -> int:
        return at + 1 if tokens[at] > limit else up_to(sums[at] - tokens[at] + limit, at)

    def entering(state: int) -> int:
        return 0 if state == CLOSED else up_to(limit - state, 0)

    return after, entering


def _outcomes(tokens: np.ndarray, limit: int) -> list[tuple[int, int, int, int, int]]:
    """What a block makes of a state: (above, up to, chunks started, state at the end, 1 if what was open is added to that state)."""
    after, entering = _starts(tokens, limit)
    sums, n = np.cumsum(tokens), len(tokens)
    known: dict[int, tuple[int, int]] = {}

    def ending(start: int) -> tuple[int, int]:
        way = []
        while start < n and start not in known:
            way.append(start)
            start = after(start)
        for at in reversed(way):
            if start < n:
                known[at] = (known[start][0] + 1, known[start][1])
            else:
                known[at] = (1, CLOSED if tokens[at] > limit else int(sums[-1] - sums[at] + tokens[at]))
            start = at
        return known[start]

    rows = [(CLOSED - 1, CLOSED, *ending(0), 0)]
    high = limit
    while high >= 0:  # from a full chunk down: the less is open, the later the first start
        start = entering(high)
        low = max(CLOSED, limit - int(sums[start])) if start < n and tokens[start] <= limit else CLOSED
        rows.append((low, high, *ending(start), 0) if start < n else (low, high, 0, int(sums[-1]), 1))
        high = low
    return rows


def pack_in_order(items: DataFrame, group: list[str], order: list[str], tokens: str, most: str | int, block: int = BLOCK) -> DataFrame:
    """Adds ``chunk`` (from 0 within the group) and ``oversize`` to ``items``.

    An item joins the open chunk if the sum stays within ``most`` (a number or a
    column, the same throughout a group), else opens the next. An item over ``most``
    alone is a chunk of its own. The result is that of packing one item after
    another, whatever ``block``, the most rows that a task packs at a time.
    """
    limit = F.col(most) if isinstance(most, str) else F.lit(most)
    narrow = items.select(*group, *order, F.coalesce(tokens, F.lit(0)).cast("long").alias("_t"), limit.cast("long").alias("_most"))
    at = F.monotonically_increasing_id()
    placed = cut(narrow.orderBy(*group, *order).withColumn("_at", at)).withColumn("_block", F.col("_at") - F.pmod(F.col("_at").bitwiseAND((1 << 33) - 1), F.lit(block)))
    key = ", ".join(f"`{n}` {dict(narrow.dtypes)[n]}" for n in group)

    def outcomes(rows: pd.DataFrame) -> pd.DataFrame:
        found = _outcomes(rows.sort_values("_at")["_t"].to_numpy(np.int64), int(rows["_most"].iloc[0]))
        out = pd.DataFrame(found, columns=["_low", "_high", "_n", "_end", "_adds"])
        for n in [*group, "_block"]:
            out[n] = rows[n].iloc[0]
        return out

    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        state, last, entries = CLOSED, -1, []
        for number, own in rows.sort_values("_block").groupby("_block", sort=False):
            entries.append((number, state, last))
            row = own[(own["_low"] < state) & (state <= own["_high"])].iloc[0]
            last, state = last + int(row["_n"]), int(row["_end"]) + (state if row["_adds"] else 0)
        out = pd.DataFrame(entries, columns=["_block", "_state", "_last"])
        for n in group:
            out[n] = rows[n].iloc[0]
        return out

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_at", ignore_index=True)
        sizes, chunks = rows["_t"].to_numpy(np.int64), np.zeros(len(rows), np.int64)
        owner = rows.groupby(group, sort=False, dropna=False).ngroup().to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(rows)]
        states, lasts, limits = (rows[c].to_numpy() for c in ("_state", "_last", "_most"))
        for a, b in zip(bounds, bounds[1:]):
            after, entering = _starts(sizes[a:b], int(limits[a]))
            starts = [entering(int(states[a]))]
            while starts[-1] < b - a:
                starts.append(after(starts[-1]))
            chunks[a:b] = lasts[a] + np.searchsorted(starts, np.arange(b - a), "right")
        return rows.assign(chunk=chunks, oversize=sizes > limits)

    # most groups lie within one block and need no entry
    several = placed.groupBy(*group).agg(F.min("_block").alias("_a"), F.max("_block").alias("_b")).where("_a <> _b").select(*[F.col(n).alias(f"_of_{n}") for n in group])
    split = placed.join(several, [placed[n].eqNullSafe(several[f"_of_{n}"]) for n in group], "left_semi")
    told = split.groupBy(*group, "_block").applyInPandas(outcomes, f"_low long, _high long, _n long, _end long, _adds int, {key}, _block long")
    entries = told.groupBy(*group).applyInPandas(follow, f"_block long, _state long, _last long, {key}")
    started = placed.join(entries, [placed[n].eqNullSafe(entries[n]) for n in [*group, "_block"]], "left").select(*[placed[n] for n in placed.columns], F.coalesce("_state", F.lit(CLOSED)).cast("long").alias("_state"), F.coalesce("_last", F.lit(-1)).cast("long").alias("_last"))
    ddl = ", ".join(f"`{n}` {t}" for n, t in started.dtypes) + ", chunk long, oversize boolean"
    return started.groupBy("_block").applyInPandas(pack, ddl).withColumnRenamed("_t", "n_tokens").drop("_most", "_at", "_block", "_state", "_last")


def chunk_sizes(packed: DataFrame, group: list[str]) -> DataFrame:
    return packed.groupBy(*group, "chunk").agg(F.count(F.lit(1)).alias("n_items"), F.sum("n_tokens").alias("n_tokens"), F.bool_or("oversize").alias("oversize"))


def split_lines(text: Column, most: int, per_line: bool) -> Column:
    """Parts of an oversize text at line ends as structs of ``text, n_tokens``.

    ``per_line`` adds up the tokens of single lines with their ends; otherwise the
    gathered text is measured. A single line over the limit stays whole.
    """
    first = F.struct(F.array().cast("array<struct<text: string, n_tokens: bigint>>").alias("done"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("bigint").alias("n"))

    def step(state, line):
        longer = F.when(state["text"].isNull(), line).otherwise(F.concat(state["text"], F.lit("\n"), line))
        own = F.floor((F.length(line) + (1 if per_line else 0)) / 4)
        grown = state["n"] + own if per_line else F.floor(F.length(longer) / 4)
        # an open but empty text is never closed by measuring the gathered text
        close = state["text"].isNotNull() & (grown > most) & (F.lit(per_line) | (F.coalesce(state["text"], F.lit("")) != ""))
        closed = F.concat(state["done"], F.array(F.struct(state["text"].alias("text"), state["n"].alias("n_tokens"))))
        return F.struct(F.when(close, closed).otherwise(state["done"]).alias("done"), F.when(close, line).otherwise(longer).alias("text"), F.when(close, own).otherwise(grown).cast("bigint").alias("n"))

    def last(state):
        return F.concat(state["done"], F.array(F.struct(state["text"].alias("text"), state["n"].alias("n_tokens"))))

    return F.aggregate(F.split(text, "\n"), first, step, last)


def pack_small_files(files: DataFrame, small: int = 2000, full: int = 4000) -> DataFrame:
    """Per crate, files under ``small`` tokens, largest first, gathered until ``full`` is reached: ``crate, chunk, seq, file_id, n_tokens``; a rest under ``small`` is dropped.

    Files of equal tokens take their places by rank, so the fold of a crate is over
    its distinct sizes, fewer than ``small``, however many files it has.
    """
    few = files.where(F.col("n_tokens") < small).select("crate", "seq", "file_id", "n_tokens")
    sizes = few.groupBy("crate", "n_tokens").agg(F.count(F.lit(1)).alias("_n"))
    ddl = ", ".join(f"`{n}` {t}" for n, t in sizes.dtypes) + ", _chunk long, _room long, _each long, _end long"

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n_tokens", ascending=False, ignore_index=True)
        chunk, total, states = 0, 0, []
        for t, n in zip(rows["n_tokens"].tolist(), rows["_n"].tolist()):
            room, each = (-(-(full - total) // t), -(-full // t)) if t else (n + 1, n + 1)  # files that fill the open chunk, and a new one
            states.append((chunk, room, each))
            if n < room:
                total += n * t
            else:
                chunk, total = chunk + 1 + (n - room) // each, (n - room) % each * t
        rows[["_chunk", "_room", "_each"]] = states
        return rows.assign(_end=chunk if total < small else chunk + 1)

    places = sizes.groupBy("crate").applyInPandas(fold, ddl).drop("_n")
    ranked = few.withColumn("_k", F.row_number().over(Window.partitionBy("crate", "n_tokens").orderBy("seq", "file_id")) - 1)
    chunk = F.when(F.col("_k") < F.col("_room"), F.col("_chunk")).otherwise(F.col("_chunk") + 1 + F.floor((F.col("_k") - F.col("_room")) / F.col("_each")))
    return ranked.join(places, ["crate", "n_tokens"]).withColumn("chunk", chunk).where("chunk < _end").select("crate", "chunk", "seq", "file_id", "n_tokens")


def fan_out(items: DataFrame, sizes: tuple[int, ...] = (4096, 8192, 16384)) -> DataFrame:
    """Every item once for each size, as column ``max_tokens``."""
    return items.withColumn("max_tokens", F.explode(F.array(*[F.lit(x) for x in sizes])))
