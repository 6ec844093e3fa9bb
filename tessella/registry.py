"""All core queries by operator name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessella.functions.text import token_count
from tessella.operators import extract, packing
from tessella.plans import chunk_queries, code_queries, relational_queries, rust_queries, source_queries, text_queries
from tessella.spark_util import table

_MODULES = (text_queries, relational_queries, chunk_queries, code_queries, rust_queries, source_queries)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Source files of each crate in order, packed into chunks of at most 4 096 tokens: items and tokens per chunk."""
    files = extract.files_once(table(spark, folder, "src_file")).withColumn("n", token_count("code"))
    packed = packing.pack_in_order(files, ["crate"], ["seq", "file_id"], "n", 4096)
    return packing.chunk_sizes(packed, ["crate"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
