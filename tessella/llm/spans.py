"""Long exact spans shared between records, by compact windows over the least hashes of a text.

Each character position has the hash of the ``GRAM`` characters that start there.
A span of at least ``least`` characters holds ``least - GRAM + 1`` such positions;
the first least hash among them lies at the same place of the span in every record
that holds it. A position that is the least of some run that long has a compact
window: the range in which it stays the least, found with a Cartesian tree over
those positions. Records sharing a span therefore share the hash of one window in
whose range the span lies, and joining windows by hash and range, then comparing
the characters around, finds every shared span and no other.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.tokens import slices, text_bytes
from tessella.spark_util import cut, table

LEAST = 200
GRAM = 72
#: Hashes held by more windows than this aren't paired; their spans are found by equal spans of the full length.
CROWD = 48
PLACE_BITS = 28
#: Text hashed at a time in one Python worker (a longer text is hashed whole).
SLICE_BYTES = 1_000_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` code points from each position on (as many as there are whole ones)."""
    n = len(points)
    room = 1 << max(16, (n + 1).bit_length())
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_mixed(points.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, room)[:n], out=sums[1:])
    return _mixed((sums[size:] - sums[:-size]) * _powers(_INVERSE, room)[: n - size + 1])


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points and each text's bounds in them."""
    data, bounds = text_bytes(texts)
    ahead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=ahead[1:])
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), ahead[bounds]


def compact_windows(points: np.ndarray, bounds: np.ndarray, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of all texts: text number, place within it, hash, and how far the window reaches to the left and the right (at most as far as matters)."""
    width = least - gram + 1
    none = np.zeros(0, np.int64)
    if len(points) < least:
        return none, none, none.astype(np.uint64), none, none
    hashes = gram_hashes(points, gram)
    sizes = np.diff(bounds)
    number = np.repeat(np.arange(len(sizes)), sizes)[: len(hashes)]
    place = np.arange(len(hashes))
    whole = place + gram <= bounds[number + 1]
    order = np.where(whole, hashes >> np.uint64(PLACE_BITS), np.uint64((1 << (64 - PLACE_BITS)) - 1)) << np.uint64(PLACE_BITS) | place.astype(np.uint64)
    low, have = order, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    start = np.arange(len(low))
    inside = low[start + width - 1 + gram <= bounds[number[: len(low)] + 1]]
    chosen = (inside[np.append(True, inside[1:] != inside[:-1])] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64) if len(inside) else none
    rank, at = order[chosen], chosen
    left, right = at - bounds[number[at]], bounds[number[at] + 1] - gram - at
    ranks, places, texts = rank.tolist(), at.tolist(), number[at].tolist()
    stack: list[int] = []  # the right spine of the Cartesian tree
    for k in range(len(places)):
        while stack and (texts[stack[-1]] != texts[k] or ranks[stack[-1]] > ranks[k]):
            top = stack.pop()
            if texts[top] == texts[k]:
                right[top] = places[k] - 1 - places[top]
        if stack:
            left[k] = places[k] - places[stack[-1]] - 1
        stack.append(k)
    most = width - 1
    return number[at], at - bounds[number[at]], hashes[at], np.minimum(left, most), np.minimum(right, most)


def records(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """``tab, id, text`` of both tables; null texts and ids are left out, rows repeated under one id are one record."""
    a = documents.select(F.lit("documents").alias("tab"), F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"))
    b = chunks.select(F.lit("doc_chunk").alias("tab"), F.col("chunk_id").cast("long").alias("id"), F.col("content").alias("text"))
    return a.unionByName(b).where("id is not null and text is not null")


def window_rows(recs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """Compact windows of every record: ``h, tab, id, c, l, r``."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column(2), SLICE_BYTES):
                number, place, hashes, left, right = compact_windows(*code_points(texts), least, gram)
                rows = pa.array(number + at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(place.astype(np.int32)), pa.array(left.astype(np.int16)), pa.array(right.astype(np.int16))],
                    names=["h", "tab", "id", "c", "l", "r"],
                )
                at += len(texts)

    return recs.where(F.length("text") >= least).select("tab", "id", "text").mapInArrow(windows, "h long, tab string, id long, c int, l short, r short")


def shared_windows(recs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """Windows whose hash occurs in more than one record, with the characters around them that can matter: adds ``n, before, after``.

    The windows of all records are written once; two shuffles of narrow rows find
    the shared hashes, and only then do texts travel, to their few windows.
    """
    windows = cut(window_rows(recs, least, gram))
    record = F.struct("tab", "id")
    common = windows.groupBy("h").agg(F.min(record).alias("_a"), F.max(record).alias("_b"), F.count(F.lit(1)).alias("n")).where("_a <> _b").select("h", "n")
    kept = windows.join(common, "h").groupBy("tab", "id").agg(F.collect_set(F.struct("h", "c", "l", "r", "n")).alias("_w"))
    reach = least - gram
    placed = recs.where(F.length("text") >= least).join(kept, ["tab", "id"]).select("tab", "id", "text", "_w")

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tab, id_, text, found in zip(*[batch.column(k) for k in range(4)]):
                text, rows = text.as_py(), found.as_py()
                c = [w["c"] for w in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w["h"] for w in rows], pa.int64()), pa.array([tab.as_py()] * len(rows), pa.string()), pa.array([id_.as_py()] * len(rows), pa.int64()), pa.array(c, pa.int32()), pa.array([w["l"] for w in rows], pa.int16()),
                        pa.array([w["r"] for w in rows], pa.int16()), pa.array([w["n"] for w in rows], pa.int64()), pa.array([text[max(0, x - reach) : x] for x in c], pa.string()), pa.array([text[x : x + gram + reach] for x in c], pa.string()),
                    ],
                    names=["h", "tab", "id", "c", "l", "r", "n", "before", "after"],
                )

    return placed.mapInArrow(around, "h long, tab string, id long, c int, l short, r short, n long, before string, after string")


def _same(a: str, b: str) -> int:
    """Length of the common start."""
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def _common(before_a: pa.Array, before_b: pa.Array, after_a: pa.Array, after_b: pa.Array) -> pa.Array:
    back = [_same(a[::-1], b[::-1]) for a, b in zip(before_a.to_pylist(), before_b.to_pylist())]
    forth = [_same(a, b) for a, b in zip(after_a.to_pylist(), after_b.to_pylist())]
    return pa.StructArray.from_arrays([pa.array(back, pa.int32()), pa.array(forth, pa.int32())], names=["back", "forth"])


def _pair_order(a: str, b: str) -> Column:
    return F.struct(f"{a}.tab", f"{a}.id") < F.struct(f"{b}.tab", f"{b}.id")


def _paired(windows: DataFrame, least: int, gram: int, crowd: int) -> DataFrame:
    """Verified spans of hashes that few windows hold: the two records, and the span's place in each."""
    few = windows.where(F.col("n") <= crowd)
    a, b = few.alias("a"), few.alias("b")
    room = F.least("a.l", "b.l") + F.least("a.r", "b.r") >= F.lit(least - gram)
    both = a.join(b, (F.col("a.h") == F.col("b.h")) & _pair_order("a", "b") & room)
    seen = both.select(*[F.col(f"{s}.{x}").alias(f"{x}_{s}") for s in "ab" for x in ("tab", "id", "c")], F.arrow_udf(_common, "back int, forth int")("a.before", "b.before", "a.after", "b.after").alias("m"))
    enough = seen.where(f"m.forth >= {gram} and m.back + m.forth >= {least}")
    return enough.select("tab_a", "id_a", "tab_b", "id_b", *[x.alias(f"{n}_{s}") for s in "ab" for n, x in (("from", F.col(f"c_{s}") - F.col("m.back")), ("to", F.col(f"c_{s}") + F.col("m.forth")))])


def _crowd(windows: DataFrame, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Windows of hashes that many hold, as classes with the same characters around: the members (``h, k, tab, id, origin``), and a row per class.

    Copies of a text fall into the same classes, so what follows works on one of
    them; ``origin`` is where a member's characters begin in its record.
    """
    many = windows.where(F.col("n") > crowd).select("h", F.xxhash64("before", "after").alias("k"), "tab", "id", "c", "before", "after")
    members = many.select("h", "k", "tab", "id", (F.col("c") - F.length("before")).alias("origin")).distinct()
    record = F.struct("tab", "id")
    classes = many.groupBy("h", "k").agg(F.max("before").alias("before"), F.max("after").alias("after"), F.min(record).alias("low"), F.max(record).alias("high"))
    return members, classes


def _class_spans(classes: DataFrame, least: int) -> DataFrame:
    """Every span of just ``least`` characters around a class's window that several records have: ``g, h, k, own, lead`` with the marks ``first`` of spans that no earlier one implies."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                before = part.column(2).to_pylist()
                points, bounds = code_points(pa.array([x + y for x, y in zip(before, part.column(3).to_pylist())], pa.string()))
                if len(points) < least:
                    continue
                hashes = gram_hashes(points, least)
                start = np.arange(len(hashes))
                number = np.searchsorted(bounds, start, "right") - 1
                own = start - bounds[number]
                keep = (start + least <= bounds[number + 1]) & (own <= np.array([len(x) for x in before])[number])
                number, own, start = number[keep], own[keep], start[keep]
                lead = np.where(own > 0, points[start - 1].astype(np.int64), -1)
                rows = pa.array(number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[start].view(np.int64)), *[part.column(i).take(rows) for i in (0, 1)], pa.array(own.astype(np.int32)), pa.array(lead.astype(np.int32)), *[part.column(i).take(rows) for i in (4, 5)]], names=["g", "h", "k", "own", "lead", "low", "high"]
                )

    record = "struct<tab: string, id: bigint>"
    grams = classes.select("h", "k", "before", "after", "low", "high").mapInArrow(spans, f"g long, h long, k long, own int, lead int, low {record}, high {record}")
    common = grams.groupBy("g").agg(F.min("low").alias("_a"), F.max("high").alias("_b"), F.min("lead").alias("_x"), F.max("lead").alias("_y")).where("_a <> _b")
    return grams.select("g", "h", "k", "own").join(common.select("g", F.expr("_x <> _y or _x = -1").alias("first")), "g")


def shared_pairs(recs: DataFrame, least: int = LEAST, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """Pairs of different records with a common span of ``least`` characters or more: ``tab_a, id_a, tab_b, id_b``, each once, the smaller first.

    Case, spaces and line ends count; records that are null, empty or shorter have
    no pairs; a record isn't paired with itself. Where a hash is held by more than
    ``crowd`` windows (a common opening, say), spans of the full length are compared
    by hash instead of window by window, so what is only nearly long enough never
    forms pairs, and windows with the same characters around are compared as one
    class, so copies are spread out only in the result. A span whose preceding character is the same in all its records
    follows from the one before it and is left out of that join.
    """
    windows = cut(shared_windows(recs, least, gram))
    few = _paired(windows, least, gram, crowd).select("tab_a", "id_a", "tab_b", "id_b")
    members, classes = _crowd(windows, crowd)
    held = _class_spans(classes, least).where("first").select("g", "h", "k").distinct()
    a, b = held.alias("a"), held.alias("b")
    alike = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.struct("a.h", "a.k") <= F.struct("b.h", "b.k"))).select(*[F.col(f"{s}.{x}").alias(f"{x}_{s}") for s in "ab" for x in "hk"]).distinct()
    one, other = (members.select(F.col("h").alias(f"h_{s}"), F.col("k").alias(f"k_{s}"), F.struct("tab", "id").alias(f"r_{s}")).distinct() for s in "ab")
    both = alike.join(one, ["h_a", "k_a"]).join(other, ["h_b", "k_b"]).where("r_a <> r_b").select(F.least("r_a", "r_b").alias("a"), F.greatest("r_a", "r_b").alias("b"))
    many = both.select(*[F.col(f"{s}.{x}").alias(f"{x}_{s}") for s in "ab" for x in ("tab", "id")])
    return few.unionByName(many).distinct()


def shared_parts(recs: DataFrame, least: int = LEAST, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """Of each record how much is shared elsewhere: ``tab, id, n_chars, shared_chars, n_spans, share``; every record has a row, an empty one the share 0.

    Shared places are merged within a record, so an overlap of spans counts once.
    """
    windows = cut(shared_windows(recs, least, gram))
    few = _paired(windows, least, gram, crowd)
    members, classes = _crowd(windows, crowd)
    common = _class_spans(classes, least).select("h", "k", "own").distinct()
    island = F.col("own") - F.row_number().over(Window.partitionBy("h", "k").orderBy("own"))
    runs = common.withColumn("_run", island).groupBy("h", "k", "_run").agg(F.min("own").alias("_low"), F.max("own").alias("_high"))
    places = members.join(runs, ["h", "k"]).select("tab", "id", (F.col("origin") + F.col("_low")).alias("from"), (F.col("origin") + F.col("_high") + least).alias("to"))
    for s in "ab":
        places = places.unionByName(few.select(*[F.col(f"{x}_{s}").alias(x) for x in ("tab", "id", "from", "to")]))
    per = Window.partitionBy("tab", "id").orderBy("from", "to")
    ordered = places.distinct().withColumn("_reach", F.max("to").over(per.rowsBetween(Window.unboundedPreceding, -1)))
    new = F.greatest(F.lit(0), F.col("to") - F.greatest("from", F.coalesce("_reach", F.lit(0))))
    covered = ordered.groupBy("tab", "id").agg(F.sum(new).alias("shared_chars"), F.count_if(F.col("_reach").isNull() | (F.col("_reach") < F.col("from"))).alias("n_spans"))
    sizes = recs.groupBy("tab", "id").agg(F.max(F.length("text")).cast("long").alias("n_chars"))
    out = sizes.join(covered, ["tab", "id"], "left").fillna(0, ["shared_chars", "n_spans"])
    return out.withColumn("share", F.round(F.coalesce(F.col("shared_chars") / F.nullif(F.col("n_chars"), F.lit(0)), F.lit(0.0)), 6))


def text_classes(recs: DataFrame) -> DataFrame:
    """Records of one text as a class: ``tab, id, class_tab, class_id`` (its smallest record) and ``n_members``; null texts have none."""
    keyed = recs.select("tab", "id", F.sha2("text", 256).alias("_d")).distinct()
    first = keyed.groupBy("_d").agg(F.min(F.struct("tab", "id")).alias("_c"), F.count(F.lit(1)).alias("n_members"))
    return keyed.join(first, "_d").select("tab", "id", F.col("_c.tab").alias("class_tab"), F.col("_c.id").alias("class_id"), "n_members")


def class_links(recs: DataFrame, least: int = LEAST) -> DataFrame:
    """``shared_pairs`` between the smallest records of classes of one text; with ``text_classes`` all pairs, without one row for each two copies."""
    classes = text_classes(recs).where("tab = class_tab and id = class_id").select("tab", "id")
    return shared_pairs(cut(recs.join(classes, ["tab", "id"], "left_semi")), least)


def found(spark, folder: str) -> DataFrame:
    return shared_pairs(records(table(spark, folder, "documents"), table(spark, folder, "doc_chunk")))


def parts(spark, folder: str) -> DataFrame:
    return shared_parts(records(table(spark, folder, "documents"), table(spark, folder, "doc_chunk")))


def classes(spark, folder: str) -> DataFrame:
    return text_classes(records(table(spark, folder, "documents"), table(spark, folder, "doc_chunk")))


def links(spark, folder: str) -> DataFrame:
    return class_links(records(table(spark, folder, "documents"), table(spark, folder, "doc_chunk")))
