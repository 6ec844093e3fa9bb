"""Small helpers every operator shares: reading tables, cutting lineage, one row per key."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Table ``name`` of a folder of Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the session names in spark.checkpoint.dir; without one, a temporary folder in local mode (tests) and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder, so that several readers share it and it outlives executors."""
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def latest_per_key(df: DataFrame, key: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """One row per key: ``columns`` of the row that comes last by ``order`` (ties by the columns themselves).

    An aggregate with partial combine, not a window: a key that holds a third of
    all rows is reduced before the shuffle. Rows with a null key are dropped.
    """
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in columns if c not in order])
    best = df.where(" and ".join(f"`{k}` is not null" for k in key)).groupBy(*key).agg(F.max(packed).alias("_row"))
    return best.select(*key, *[F.col("_row")[c].alias(c) for c in columns])


def spread(key: str | Column, parts: int) -> Column:
    """A stable pseudo-random part number below ``parts`` for a key."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
