"""Writing datasets, their statistics and reports. Every sink writes a folder, one file per task, unless one file is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import slug
from tessella.operators import stats

RULE = "\n" + "=" * 80 + "\n"


def jsonl(df: DataFrame, path: str, one_file: bool = False) -> None:
    """One JSON object per line, UTF-8, null fields kept."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def parquet(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").parquet(path)


def variants(df: DataFrame, path: str, by: tuple[str, ...] = ("granularity", "max_tokens")) -> None:
    """A folder per variant; rows are brought together by variant and a salt first, so a large variant is written by many tasks into few files."""
    df.repartition(*by, F.pmod(F.xxhash64(*df.columns), F.lit(16))).write.mode("overwrite").partitionBy(*by).parquet(path)


def separated_text(df: DataFrame, text: str, path: str) -> None:
    """Texts one after another, each followed by a rule."""
    df.select(F.col(text).alias("value")).write.mode("overwrite").option("lineSep", RULE).text(path)


def named_texts(df: DataFrame, name: str, text: str, path: str) -> None:
    """A folder per name (made a slug) with its texts; texts whose names have one slug lie side by side."""
    df.where(F.col(text).isNotNull()).select(slug(name).alias("name"), F.col(text).alias("value")).write.mode("overwrite").option("lineSep", "\n").partitionBy("name").text(path)


def tree(df: DataFrame, path: str, text: str, root: str) -> None:
    """A file for each row at its path below the root, in UTF-8, whichever file system that is; null texts are left out, a path given twice keeps one of its texts.

    Spark's writers name files themselves, so the tasks write these through the
    file system of the workers; the root must be a folder they share.
    """

    def write(rows) -> None:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        made: set[str] = set()
        for name, content in rows:
            target = f"{base}/{name}"
            if (folder := target.rpartition("/")[0]) not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            with system.open_output_stream(target) as out:
                out.write(content.encode())

    df.where(F.col(path).isNotNull() & F.col(text).isNotNull()).select(path, text).foreachPartition(write)


def statistics(chunks: DataFrame, tokens: str, source: str) -> DataFrame:
    """One row: totals, moments and percentiles of tokens, shares of small, medium and large chunks."""
    t = F.col(tokens)
    counted = chunks.groupBy(t.alias("t")).agg(F.count(F.lit(1)).alias("n"))
    sums = chunks.agg(
        F.count(F.lit(1)).alias("total_chunks"), F.count_distinct(source).alias("unique_sources"), F.sum(t).cast("long").alias("total_tokens"), F.round(F.avg(t), 6).alias("mean"), F.round(F.stddev_pop(t), 6).alias("std"), F.min(t).alias("min"), F.max(t).alias("max"),
        F.count_if(t < 4000).alias("small"), F.count_if((t >= 4000) & (t < 10000)).alias("medium"), F.count_if(t >= 10000).alias("large"),
    )
    points = counted.where("t is not null").agg(F.percentile("t", F.array(*[F.lit(p / 100) for p in (25, 50, 75, 90, 95, 99)]), F.col("n")).alias("p"))
    return sums.join(points).select("*", *[F.round(F.col("p")[i], 6).alias(f"p{p}") for i, p in enumerate((25, 50, 75, 90, 95, 99))]).drop("p")


def statistics_json(chunks: DataFrame, tokens: str, source: str, path: str) -> None:
    one = statistics(chunks, tokens, source)
    one.select(F.to_json(F.struct(*one.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def histogram_json(chunks: DataFrame, tokens: str, path: str, step: int = 100) -> None:
    stats.histogram(chunks, tokens, step).coalesce(1).orderBy("edge").write.mode("overwrite").json(path)


def report(row: dict, title: str) -> str:
    """A short Markdown report from one row of statistics."""
    body = "\n".join(f"| {k.replace('_', ' ')} | {'–' if v is None else v} |" for k, v in row.items())
    return f"# {title}\n\n| measure | value |\n| --- | --- |\n{body}\n"
