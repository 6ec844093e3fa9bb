"""Markdown candidates in captured response bodies."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import looks_like_markdown

_KIND = pa.list_(pa.struct([("name", pa.string()), ("content", pa.string())]))


def _contents(body: str | None) -> list[dict]:
    start = (body or "").lstrip()[:1]
    if start not in ("{", "["):
        return []
    try:
        open_ = [json.loads(body)]
    except (ValueError, RecursionError):
        return []
    found = []
    while open_:  # depth first, in document order, without recursion
        node = open_.pop()
        if isinstance(node, dict):
            if isinstance(node.get("content"), str) and node["content"]:
                name = node.get("name") or node.get("title")
                found.append({"name": name if isinstance(name, str) else None, "content": node["content"]})
            open_ += reversed(list(node.values()))
        elif isinstance(node, list):
            open_ += reversed(node)
    return found


def nested_contents(body: Column) -> Column:
    """Every nested object's string ``content`` with its name or title, if the body is JSON; else an empty array."""

    def walk(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for bodies in batches:
            yield pa.array([_contents(b) for b in bodies.to_pylist()], _KIND)

    return F.arrow_udf(walk, "array<struct<name string, content string>>")(body)


def candidates(bodies: DataFrame, key: str, body: str) -> DataFrame:
    """``key, place, name, content, digest``: the body itself if it looks like Markdown, then what is nested in it; repeats within a body once.

    Null and empty bodies have none; broken JSON counts as plain text.
    """
    jsonish = F.col(body).rlike(r"\A\s*[{\[]")
    own = F.when(looks_like_markdown(body), F.array(F.struct(F.lit(None).cast("string").alias("name"), F.col(body).alias("content")))).otherwise(F.array().cast("array<struct<name string, content string>>"))
    nested = F.when(jsonish, nested_contents(F.when(jsonish, F.col(body)))).otherwise(F.array().cast("array<struct<name string, content string>>"))
    each = bodies.where(F.col(body) != "").select(key, F.posexplode(F.concat(own, nested)).alias("place", "c")).select(key, "place", "c.*")
    marked = each.withColumn("digest", F.sha2("content", 256))
    return marked.groupBy(key, "digest").agg(F.min(F.struct("place", "name", "content")).alias("c")).select(key, "c.*", "digest")
