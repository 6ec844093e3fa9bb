"""Crate, call and reference graphs as edge DataFrames.

A function is (file_id, start_line, name); a call edge joins on the bare callee
name. Repeated rows count once. Rows whose join key is null take part in no join;
left joins keep them with null or zero on the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import all_matches, lines_between
from tessella.spark_util import cut

#: Calls that say nothing about a program's structure.
COMMON_CALLS = ("Some", "None", "Ok", "Err", "println", "print", "format", "vec", "panic", "assert", "unwrap", "expect")


def files_by_path(files: DataFrame) -> DataFrame:
    """``file_path, code``, one row per path; files without code are left out."""
    return files.where("code is not null").groupBy("file_path").agg(F.max("code").alias("code"))


def files_by_id(files: DataFrame) -> DataFrame:
    return files.where("code is not null").groupBy("file_id").agg(F.max("code").alias("code"))


def functions_once(functions: DataFrame) -> DataFrame:
    return functions.select("file_id", "start_line", "name").distinct()


def calls_once(calls: DataFrame) -> DataFrame:
    return calls.select("caller_file_id", "caller_line", "callee_name", "call_kind", "call_line").distinct()


def structural_calls(calls: DataFrame) -> DataFrame:
    """Calls without those that say nothing about structure; a null callee is none."""
    return calls_once(calls).where(~F.col("callee_name").isin(*COMMON_CALLS))


def snippets(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """Every reference of a chunk with the lines it names; references to missing files are dropped."""
    return referenced_lines(chunks.select("chunk_id", F.explode("source_references").alias("r")).select("chunk_id", "r.*"), files)


def referenced_lines(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Adds ``code``, the lines from ``start_line`` to ``end_line`` of ``file_path``, empty behind the file's end; references to missing files are dropped."""
    return refs.join(files_by_path(files), "file_path").withColumn("code", lines_between("code", F.col("start_line"), F.col("end_line")))


def functions_in(ranges: DataFrame, functions: DataFrame) -> DataFrame:
    """``file_path, start_line, end_line`` of each range with the functions that lie in it as ``file_id, line, name``; a missing end is told by the text's lines."""
    text_end = F.col("start_line") + F.size(F.split("full_text", "\n")) - 1
    places = functions.groupBy("file_path", "file_id", F.col("start_line").alias("line"), "name").agg(F.max(F.coalesce("end_line", text_end)).alias("_last"))
    hit = ranges.select("file_path", "start_line", "end_line").distinct().join(places, "file_path")
    return hit.where("line between start_line and end_line and coalesce(_last, line) <= end_line").drop("_last")


def call_counts(functions: DataFrame, calls: DataFrame, columns: list[str | Column] | None = None) -> DataFrame:
    """Functions with how many calls they make and how many name them. Both counts are aggregated before the join, so a name that most calls have is one row."""
    edges = structural_calls(calls)
    out = edges.groupBy(F.col("caller_file_id").alias("file_id"), F.col("caller_line").alias("start_line")).agg(F.count(F.lit(1)).alias("n_calls"))
    into = edges.groupBy(F.col("callee_name").alias("name")).agg(F.count(F.lit(1)).alias("n_callers"))
    once = functions.select("file_id", "start_line", "name", *(columns or [])).distinct()
    return once.join(out, ["file_id", "start_line"], "left").join(into, "name", "left").fillna(0, ["n_calls", "n_callers"])


def importance(functions: DataFrame, calls: DataFrame) -> DataFrame:
    """Two weighted scores of a function: ``score`` and the call-heavier ``weighted``."""
    flags = ["is_pub", "is_async", F.col("impl_context").isNotNull().alias("in_impl")]
    one = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("long")
    counted = call_counts(functions, calls, flags)
    return counted.select(
        "file_id", "start_line", "name", (F.col("n_calls") + F.col("n_callers") + 5 * one("is_pub") + 3 * one("in_impl")).alias("score"),
        (2 * F.col("n_calls") + 3 * F.col("n_callers") + 10 * one("is_pub") + 5 * one("is_async") + 8 * one("in_impl")).alias("weighted"),
    )


def adjacency_degrees(edges: DataFrame) -> DataFrame:
    """Degree of every node in both directions: callers by place, callees by name."""
    place = F.concat_ws(":", "caller_file_id", "caller_line")
    forward = edges.groupBy(place.alias("node")).agg(F.count(F.lit(1)).alias("degree"), F.count_distinct("callee_name").alias("n_others")).select(F.lit("forward").alias("direction"), "*")
    reverse = edges.groupBy(F.col("callee_name").alias("node")).agg(F.count(F.lit(1)).alias("degree"), F.count_distinct(place).alias("n_others")).select(F.lit("reverse").alias("direction"), "*")
    return forward.unionByName(reverse)


def crate_edges(crates: DataFrame) -> DataFrame:
    """Dependencies between known crates, each once."""
    edges = crates.select(F.col("name").alias("src"), F.explode("local_deps").alias("dst")).distinct()
    return edges.join(crates.select(F.col("name").alias("dst")), "dst", "left_semi").select("src", "dst")


def crate_summary(crates: DataFrame) -> DataFrame:
    """Of each crate: known and unknown local dependencies, dependents, external dependencies."""
    edges = crates.select(F.col("name").alias("src"), F.explode("local_deps").alias("dst")).distinct()
    marked = edges.join(crates.select(F.col("name").alias("dst"), F.lit(True).alias("known")), "dst", "left")
    out = marked.groupBy(F.col("src").alias("crate")).agg(F.count("known").alias("n_known"), F.count_if(F.col("known").isNull()).alias("n_unknown"))
    into = marked.where("known").groupBy(F.col("dst").alias("crate")).agg(F.count(F.lit(1)).alias("n_dependents"))
    base = crates.select(F.col("name").alias("crate"), F.size(F.coalesce("external_deps", F.array().cast("array<string>"))).cast("long").alias("n_external"))
    return base.join(out, "crate", "left").join(into, "crate", "left").fillna(0, ["n_known", "n_unknown", "n_dependents"])


def dependency_locality(crates: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    """Every dependency of a crate and whether it is local: a known crate, or named with one of the prefixes."""
    none = F.array().cast("array<string>")
    each = crates.select(F.col("name").alias("crate"), F.explode(F.array_distinct(F.concat(F.coalesce("local_deps", none), F.coalesce("external_deps", none)))).alias("dep"))
    marked = each.join(crates.select(F.col("name").alias("dep"), F.lit(True).alias("known")).distinct(), "dep", "left")
    local = F.coalesce(F.col("known"), F.lit(False))
    for prefix in prefixes:
        local = local | F.col("dep").startswith(prefix)
    return marked.select("crate", "dep", local.alias("is_local"))


def trait_impls(functions: DataFrame) -> DataFrame:
    """Trait implementations seen on methods, each once: ``trait`` (without generics), ``for_type, crate, file_id``."""
    named = functions.where("impl_context.trait_name is not null")
    return named.select("file_id", "crate", F.regexp_replace("impl_context.trait_name", r"<[\s\S]*", "").alias("trait"), F.col("impl_context.for_type").alias("for_type")).distinct()


GRAM = 3


def importing_files(deps: DataFrame, files: DataFrame) -> DataFrame:
    """Files that import text naming a crate's dependency.

    Names hold no white space, so an import contains one where one of its words does.
    Each distinct word is cut into its substrings of up to ``GRAM`` characters, and a
    name meets the words that hold its first ones by equality; then the whole name is
    looked for. Null and empty names match nothing.
    """
    uses = files.where("code is not null").select("crate", "file_id", F.explode(F.array_distinct(F.transform(all_matches("code", r"use [^;]+;", (0,)), lambda m: m[0]))).alias("u"))
    words = cut(uses.select(F.col("crate").alias("using_crate"), "file_id", F.explode(F.array_distinct(F.split("u", r"\s+"))).alias("word")).where("word <> ''").distinct())
    starts = F.sequence(F.lit(1), F.length("word"))
    cuts = lambda n: F.transform(starts, lambda at: F.substring("word", at, F.lit(n)))
    grams = F.flatten(F.array(*[cuts(n) for n in range(1, GRAM + 1)]))
    each = words.select("word").distinct().select("word", F.explode(F.array_distinct(grams)).alias("gram"))
    names = deps.where("dep <> ''").select("dep").distinct().withColumn("gram", F.substring("dep", 1, GRAM))
    held = each.join(names, "gram").where(F.col("word").contains(F.col("dep"))).select("word", "dep")
    hit = words.join(held, "word").select("dep", "using_crate", "file_id").distinct()
    return deps.join(hit, "dep").select("crate", "dep", "using_crate", "file_id").distinct()
