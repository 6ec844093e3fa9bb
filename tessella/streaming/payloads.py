"""Captured bodies as a stream: candidates once each, with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessella.functions.text import looks_like_markdown


def read(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 64) -> DataFrame:
    """Parquet files of a folder (or a glob) as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def new_contents(stream: DataFrame, text: str, time: str, late: str = "30 days") -> DataFrame:
    """Rows whose text looks like Markdown, the first of each content within ``late`` of event time.

    State holds a digest per content until the watermark passes it; null texts are
    dropped, and rows later than the watermark may be repeated or dropped.
    """
    marked = stream.where(looks_like_markdown(text)).withColumn("digest", F.sha2(text, 256))
    return marked.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(["digest"])


def counts_per_window(stream: DataFrame, time: str, key: str, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Rows per time window and key, final once the watermark has passed the window."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def write(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything that is there now into a Parquet folder; a restart goes on where the checkpoint ends."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start(path)
