"""Mixing sources to target shares of tokens by capped water-filling."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.budget import label
from tessella.llm.tokens import BYTE_BPE, TOKENIZERS, token_count
from tessella.spark_util import cut

BUCKET_ROWS = 5_000
#: As a total: as many tokens as the target sources hold.
HELD = "held"


def sized_documents(docs: DataFrame, folder: str = TOKENIZERS, name: str = BYTE_BPE) -> DataFrame:
    """``doc_id, source, n_tokens`` with the source in one spelling, written once for the two passes that need it."""
    return cut(docs.select("doc_id", label("source", none=None).alias("source"), token_count("text", folder, name).alias("n_tokens")))


def allocation(sized: DataFrame, targets: DataFrame, total_tokens: int | str | None = None) -> DataFrame:
    """Tokens that each source gives: one row per source of ``targets`` (a source named twice counts once, with the larger share).

    A source holds at most ``max_repeat`` times its tokens. With a total (a number, or ``HELD``), the water
    level is raised until the total is reached: sources at their most stay there and
    what they can't give goes to the others in proportion to their shares. Without a
    total it is the largest at which every source that has tokens reaches its share;
    a source without any leaves its share to the others. Null, zero and negative
    shares or repeats give nothing. Windows here run over the target rows only.
    """
    wanted = targets.groupBy(label("source", none=None).alias("source")).agg(F.max("target_share").alias("target_share"), F.max("max_repeat").cast("long").alias("max_repeat")).where("source is not null")
    held = sized.groupBy("source").agg(F.sum("n_tokens").alias("held"), F.count(F.lit(1)).alias("n_docs"))
    both = F.broadcast(wanted).join(held, "source", "left").fillna(0, ["held", "n_docs"])
    both = both.withColumn("w", F.when((F.col("held") > 0) & (F.col("max_repeat") > 0) & (F.col("target_share") > 0), F.col("target_share")).otherwise(F.lit(0.0)))
    both = both.withColumn("most", F.when(F.col("w") > 0, F.col("held") * F.col("max_repeat")).otherwise(F.lit(0))).withColumn("ratio", F.col("most") / F.nullif(F.col("w"), F.lit(0.0)))
    every, before = Window.partitionBy(), Window.orderBy(F.asc_nulls_last("ratio"), "source").rowsBetween(Window.unboundedPreceding, -1)
    if total_tokens is None:
        both = both.withColumn("level", F.min("ratio").over(every))
    else:
        asked = F.sum("held").over(every).cast("double") if total_tokens == HELD else F.lit(float(total_tokens))
        total = F.least(asked, F.sum("most").over(every))
        left_w = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
        reach = (total - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.nullif(left_w, F.lit(0.0))
        both = both.withColumn("reach", reach)
        open_level = F.min(F.when(F.col("reach") <= F.col("ratio") * (1 + 1e-12), F.struct("ratio", "reach"))).over(every)["reach"]
        both = both.withColumn("level", F.coalesce(open_level, F.max("ratio").over(every)))
    gives = F.coalesce(F.least(F.col("most").cast("double"), F.col("level") * F.col("w")), F.lit(0.0))
    both = both.withColumn("gives", gives).withColumn("whole", F.when(F.col("held") > 0, F.least(F.floor(F.col("gives") / F.col("held")), F.col("max_repeat"))).otherwise(F.lit(0)).cast("long"))
    return both.withColumn("part", F.when(F.col("whole") >= F.col("max_repeat"), F.lit(0.0)).otherwise(F.col("gives") - F.col("whole") * F.col("held"))).select("source", "target_share", "max_repeat", "held", "n_docs", "gives", "whole", "part")


def mix(docs: DataFrame, targets: DataFrame, total_tokens: int | str | None = None, seed: int = 7, folder: str = TOKENIZERS, name: str = BYTE_BPE) -> DataFrame:
    """The mix: one row per used document, ``doc_id, source, n_tokens, repeats``.

    Every document is used the whole number of times its source repeats; the
    remaining fraction goes to the documents that come first in a seeded hash order,
    as many as its tokens need. Where to stop is found in steps, sums of hash
    buckets and then the rows of the one bucket (about ``BUCKET_ROWS`` rows) in which
    the sum is reached, filled as exactly as its documents allow; no source is ever
    sorted as a whole. Documents
    without a source of the targets, and empty ones, are in no mix.
    """
    return _mix(sized_documents(docs, folder, name), targets, total_tokens, seed)


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """Take the documents of one bucket in order, each one that still fits, and in the end one more if that is nearer."""
    rows = rows.sort_values(["u", "doc_id"], ignore_index=True)
    sizes, left = rows["n_tokens"].tolist(), float(rows["part"].iloc[0] - rows["below"].iloc[0])
    extra = [0] * len(sizes)
    for k, size in enumerate(sizes):
        if size <= left:
            extra[k], left = 1, left - size
    over = min((size, k) for k, size in enumerate(sizes) if not extra[k]) if not all(extra) else (math.inf, 0)
    if over[0] - left < left:
        extra[over[1]] = 1
    return rows.assign(extra=extra)


def _mix(sized: DataFrame, targets: DataFrame, total_tokens: int | str | None, seed: int) -> DataFrame:
    given = cut(allocation(sized, targets, total_tokens))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    placed = sized.where("n_tokens > 0").join(F.broadcast(given), "source").select("doc_id", "source", "n_tokens", "whole", "part", "n_docs", order.alias("u"), F.pmod(F.shiftrightunsigned(order, 1), F.ceil(F.col("n_docs") / BUCKET_ROWS)).alias("bucket"))
    # the bucket in which the sum is reached, found among runs of buckets first, so no window sees more than the root of their number
    width = F.ceil(F.sqrt(F.ceil(F.col("n_docs") / BUCKET_ROWS))).cast("long")
    sums = cut(placed.groupBy("source", "part", "bucket", F.floor(F.col("bucket") / width).alias("run")).agg(F.sum("n_tokens").alias("t")))
    runs = sums.groupBy("source", "part", "run").agg(F.sum("t").alias("t"))
    reached = lambda rows, by, below: rows.withColumn("upto", F.sum("t").over(Window.partitionBy("source").orderBy(by)) + below).where("upto - t <= part and part < upto").withColumn("below", F.col("upto") - F.col("t"))
    first = reached(runs, "run", F.lit(0)).select("source", "run", F.col("below").alias("_below"))
    edge = reached(sums.join(F.broadcast(first), ["source", "run"]), "bucket", F.col("_below")).select("source", F.col("bucket").alias("edge"), "below")
    marked = placed.drop("n_docs").join(F.broadcast(edge), "source", "left")
    inside = marked.where("bucket = edge").groupBy("source").applyInPandas(_fill, marked.schema.simpleString()[7:-1] + ", extra long")
    rest = marked.where("edge is null or bucket <> edge").withColumn("extra", F.coalesce(F.col("bucket") < F.col("edge"), F.col("part") > 0).cast("long"))
    return inside.unionByName(rest).select("doc_id", "source", "n_tokens", (F.col("whole") + F.col("extra")).alias("repeats")).where("repeats > 0")


def mix_shares(docs: DataFrame, targets: DataFrame, total_tokens: int | str | None = None, seed: int = 7, folder: str = TOKENIZERS, name: str = BYTE_BPE) -> DataFrame:
    """What the mix came to: target and actual share, tokens, documents used, mean and highest repetition of each source."""
    return _shares(sized_documents(docs, folder, name), targets, total_tokens, seed)


def _shares(sized: DataFrame, targets: DataFrame, total_tokens: int | str | None, seed: int) -> DataFrame:
    used = _mix(sized, targets, total_tokens, seed).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("docs_used"), F.max("repeats").alias("most_repeats"))
    out = allocation(sized, targets, total_tokens).join(F.broadcast(used), "source", "left").fillna(0, ["tokens", "docs_used", "most_repeats"])
    share = F.coalesce(F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy()), F.lit(0)), F.lit(0.0))
    return out.select("source", "target_share", F.round(share, 6).alias("actual_share"), "tokens", F.col("held").alias("tokens_held"), "docs_used", F.round(F.coalesce(F.col("tokens") / F.nullif(F.col("held"), F.lit(0)), F.lit(0.0)), 6).alias("repetition"), "most_repeats", "max_repeat")
