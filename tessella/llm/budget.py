"""Token budget per source, language and subject area."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.tokens import BYTE_BPE, TOKENIZERS, token_count
from tessella.spark_util import latest_per_key

#: Short names of languages that stand for the long ones.
LANGUAGE_NAMES = {"md": "markdown", "rs": "rust", "txt": "text", "py": "python", "js": "javascript", "ts": "typescript", "yml": "yaml"}
NONE = "(none)"


def label(column: str | Column, names: dict[str, str] | None = None, none: str | None = NONE) -> Column:
    """One spelling for a label: case, outer white space and inner gaps don't count, ``names`` maps short names; null and blank become ``none``."""
    column = F.col(column) if isinstance(column, str) else column
    plain = F.regexp_replace(F.regexp_replace(F.lower(column.cast("string")), r"(?U)^\s+|\s+$", ""), r"(?U)[\s\-]+", "_")
    if names:
        known = F.create_map(*map(F.lit, chain(*names.items())))
        plain = F.coalesce(F.try_element_at(known, plain), plain)
    return F.coalesce(F.nullif(plain, F.lit("")), F.lit(none))


def count_documents(docs: DataFrame, folder: str = TOKENIZERS, name: str = BYTE_BPE) -> DataFrame:
    """Each row's exact token count beside the recorded hint.

    Rows ``doc_id, n_tokens, hint, hint_usable, hint_error``: null and empty texts
    have 0 tokens; a hint that is null or not positive for a text that has tokens
    isn't usable and gives a null error. Repeated rows are counted each.
    """
    counted = docs.select("doc_id", token_count("text", folder, name).alias("n_tokens"), F.col("token_count").cast("long").alias("hint"))
    usable = F.coalesce(F.col("hint") > 0, F.lit(False))
    return counted.select("doc_id", "n_tokens", "hint", usable.alias("hint_usable"), F.when(usable & (F.col("n_tokens") > 0), F.col("hint") - F.col("n_tokens")).alias("hint_error"))


def budget(docs: DataFrame, folder: str = TOKENIZERS, name: str = BYTE_BPE) -> DataFrame:
    """Rows and exact tokens by source, lang and topic_area: each alone, all three together, and the total.

    Columns ``level, source, lang, topic_area, n_rows, n_tokens, n_empty``; a label
    outside the level is null, a missing label within it is ``(none)``. The exact
    counts are summed per combination before the levels are formed, so only one
    small row per combination and task is shuffled, also for a label with most rows.
    """
    labelled = docs.select(label("source").alias("source"), label("lang", LANGUAGE_NAMES).alias("lang"), label("topic_area").alias("topic_area"), token_count("text", folder, name).alias("t"))
    fine = labelled.groupBy("source", "lang", "topic_area").agg(F.count(F.lit(1)).alias("r"), F.sum("t").alias("t"), F.count_if(F.col("t") == 0).alias("e"))
    levels = fine.groupingSets([["source", "lang", "topic_area"], ["source"], ["lang"], ["topic_area"], []], "source", "lang", "topic_area").agg(
        F.grouping_id("source", "lang", "topic_area").alias("g"), F.sum("r").alias("n_rows"), F.sum("t").alias("n_tokens"), F.sum("e").alias("n_empty")
    )
    name_of = F.create_map(*map(F.lit, chain(*{0: "source,lang,topic_area", 3: "source", 5: "lang", 6: "topic_area", 7: "total"}.items())))
    return levels.select(name_of[F.col("g").cast("int")].alias("level"), "source", "lang", "topic_area", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), F.coalesce("n_empty", F.lit(0)).cast("long").alias("n_empty"))


def item_tokens() -> Column:
    """The items' own unit: the recorded tokens, else a quarter of the characters, else 0."""
    return F.coalesce(F.col("tokens"), F.expr("length(text) div 4"), F.lit(0)).cast("long")


def items_once(items: DataFrame) -> DataFrame:
    """One row per item_id (the latest by ingested_at): ``item_id, granularity, seq, size``."""
    sized = items.select("item_id", label("granularity").alias("granularity"), "seq", item_tokens().alias("size"), "ingested_at")
    return latest_per_key(sized, ["item_id"], ["granularity", "seq", "size"], ["ingested_at"])


def item_budget(items: DataFrame) -> DataFrame:
    """Rows and tokens of the packing items by granularity; every item_id counts once, null ids not at all."""
    return items_once(items).groupBy("granularity").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_tokens"))
