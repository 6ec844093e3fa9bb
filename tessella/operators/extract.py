"""Code items of source files by pattern, as fact tables (by syntax: ``rust_facts``).

Each file is read by one Python task batch and gives an array of structs, which is
exploded. Files with null code give no rows; repeated rows of a file give their
items each, so callers take files once or make the facts distinct.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StructType

from tessella.functions import rust_patterns as patterns
from tessella.functions.text import all_matches

ITEM = "kind string, name string, line long, code string, trait_name string, is_public boolean, doc string, count long"
_MATCHED = {"whole_functions": patterns.functions, "whole_types": patterns.structs_and_impls, "line_items": patterns.by_line, "impl_blocks": patterns.impl_blocks}


def facts(files: DataFrame, kind: str) -> DataFrame:
    """``file_id`` and the items that a kind's patterns find in the Rust files."""
    found = ArrayType(StructType.fromDDL(ITEM))
    arrow = to_arrow_type(found)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([_MATCHED[kind](x) for x in part.column(1).to_pylist()], arrow)], names=["file_id", "found"])

    source = files.where("code is not null").where(F.col("file_path").endswith(".rs")).select(F.col("file_id").cast("long"), "code")
    return source.mapInArrow(read, f"file_id long, found {found.simpleString()}").select("file_id", F.explode("found").alias("f")).select("file_id", "f.*")


def files_once(files: DataFrame) -> DataFrame:
    """One row per file_id, so that repeated rows aren't parsed again."""
    return files.where("code is not null").groupBy("file_id").agg(F.max("file_path").alias("file_path"), F.max("code").alias("code"), F.max("crate").alias("crate"), F.max("module").alias("module"), F.min("seq").alias("seq"))


def schema_macros(files: DataFrame, macro: str) -> DataFrame:
    """Every ``macro! { … }`` up to the first closing brace: ``file_id, code``."""
    found = F.transform(all_matches("code", macro + r"!\s*\{[\s\S]*?\}", (0,)), lambda m: m[0])
    return files.where("code is not null").select("file_id", F.explode(found).alias("code"))


def imports_and_exports(files: DataFrame) -> DataFrame:
    """``file_id, kind, name``: paths of use statements and names of public items, each once per file."""
    uses = F.transform(all_matches("code", r"use[ \t\n\r]+([^;]+);"), lambda m: F.struct(F.lit("use").alias("kind"), F.regexp_replace(m[0], r"\A[ \t\n\r]+|[ \t\n\r]+\z", "").alias("name")))
    names = F.transform(all_matches("code", r"pub[ \t\n\r]+(?:async[ \t\n\r]+)?(?:fn|struct|enum|trait|type|const|static)[ \t\n\r]+([A-Za-z0-9_]+)"), lambda m: F.struct(F.lit("pub").alias("kind"), m[0].alias("name")))
    return files.where("code is not null").select("file_id", F.explode(F.concat(uses, names)).alias("x")).select("file_id", "x.*").distinct()
