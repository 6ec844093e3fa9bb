"""Sources, sinks and streams over the given tables, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessella.functions import text as T
from tessella.operators import packing, stats
from tessella.sources import files, payloads, sinks
from tessella.spark_util import shared_folder, table
from tessella.streaming import payloads as streams

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _new(spark) -> str:
    return f"{shared_folder(spark)}/sink-{uuid.uuid4().hex}"


@query("select file_id, file_path from src_file where (starts_with(file_path, 'crates/') or starts_with(file_path, 'src/')) and not list_contains(string_split(file_path, '/'), 'target')")
def S2_S3_tree_scan(s, d):
    return files.crates_and_src(table(s, d, "src_file"), "file_path").select("file_id", "file_path")


@query("""select folder || '/' || name as path, n_chars, byte_size from (select regexp_replace(max(file_path), '/[^/]*$', '') folder, regexp_extract(max(file_path), '[^/]*$') as name, length(max(code)) n_chars, strlen(max(code)) byte_size from src_file where code <> '' and suffix(file_path, '.rs') group by file_path)""")
def S2_rust_tree_round_trip(s, d):
    """The Rust files written out as a tree of folders and scanned back."""
    once = table(s, d, "src_file").where("code <> '' and endswith(file_path, '.rs')").groupBy("file_path").agg(F.max("code").alias("code"))
    sinks.tree(once, "file_path", "code", path := _new(s))
    return files.rust_tree(s, path).select("path", F.length("content").cast("long").alias("n_chars"), "byte_size")


@query("select cast(chunk_id as varchar) as source_file, md5(max(content)) as digest from doc_chunk where content <> '' group by chunk_id")
def S1_K10_markdown_round_trip(s, d):
    """A Markdown file for each chunk, written and scanned back."""
    once = table(s, d, "doc_chunk").where("content <> ''").groupBy("chunk_id").agg(F.max("content").alias("content"))
    sinks.tree(once.select(F.concat("chunk_id", F.lit(".md")).alias("path"), "content"), "path", "content", path := _new(s))
    return files.markdown(s, path).select("source_file", F.md5("content").alias("digest"))


@query("""with f as (select distinct file_path from src_file), m as (select f.file_path, c.name, row_number() over (partition by f.file_path order by length(c.path) desc, c.name desc) k from f join crate_info c on starts_with(f.file_path, c.path || '/'))
    select f.file_path, m.name as owner from f left join m on m.file_path = f.file_path and k = 1""")
def S4_crate_scoped_scan(s, d):
    crates = table(s, d, "crate_info").select("name", F.col("path").alias("folder"))
    return files.with_crate(table(s, d, "src_file").select("file_path").distinct(), crates, "file_path").select("file_path", "owner")


@query()
def S5_manifest_scan(s, d):
    docs = table(s, d, "documents").where(F.lower("lang").isin("toml") & F.col("text").isNotNull())
    return docs.select("doc_id", files.parse_manifest(F.col("text")).alias("m")).select("doc_id", "m.*")


@query("select doc_id, text, lang, n_chars from documents")
def S6_K1_jsonl_round_trip(s, d):
    docs = table(s, d, "documents").select("doc_id", "text", "lang", "n_chars")
    sinks.jsonl(docs, path := _new(s))
    return files.json_lines(s, path, docs.schema)


@query("select chunk_id, heading, content from doc_chunk")
def S7_K2_parquet_round_trip(s, d):
    sinks.parquet(table(s, d, "doc_chunk").select("chunk_id", "heading", "content"), path := _new(s))
    return files.table(s, path)


@query()
def S12_payload_candidates(s, d):
    return payloads.candidates(table(s, d, "documents"), "doc_id", "text")


@query("""select granularity, m as max_tokens, count(*) as n, cast(sum(length(text)) as bigint) as n_chars from pack_item, (values (4096), (8192), (16384)) t(m) group by 1, 2""")
def K3_variant_fanout(s, d):
    items = packing.fan_out(table(s, d, "pack_item").select("granularity", "item_id", "text"))
    sinks.variants(items, path := _new(s))
    return files.table(s, path).groupBy("granularity", "max_tokens").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).cast("long").alias("n_chars"))


@query("select length(content) + 82 as n_chars, count(*) as n from doc_chunk where content is not null group by 1")
def K4_separator_text(s, d):
    sinks.separated_text(table(s, d, "doc_chunk").where("content is not null"), "content", path := _new(s))
    back = s.read.option("lineSep", sinks.RULE).text(path)
    return back.groupBy((F.length("value") + len(sinks.RULE)).cast("long").alias("n_chars")).agg(F.count(F.lit(1)).alias("n"))


_POINTS = ", ".join(f"round(quantile_cont(t, {p / 100}), 6) as p{p}" for p in (25, 50, 75, 90, 95, 99))


@query(f"""with x as (select crate, length(text) // 4 t from documents) select count(*) as total_chunks, count(distinct crate) as unique_sources, cast(sum(t) as bigint) as total_tokens, round(avg(t), 6) as mean, round(stddev_pop(t), 6) as std, min(t) as min, max(t) as max,
    count(*) filter (t < 4000) as small, count(*) filter (t >= 4000 and t < 10000) as medium, count(*) filter (t >= 10000) as large, {_POINTS} from x""")
def K5_stats_json(s, d):
    return sinks.statistics(table(s, d, "documents").select("crate", T.token_count("text").alias("t")), "t", "crate")


@query("select (length(text) // 4) // 100 * 100 as edge, count(*) as n from documents where text is not null group by 1")
def K6_histogram_json(s, d):
    return stats.histogram(table(s, d, "documents").select(T.token_count("text").alias("t")), "t")


@query("""select callee_name as value, count(*) as n from fn_call group by 1 order by 2 desc, 1 limit 50""")
def K7_patterns_json(s, d):
    top = table(s, d, "fn_call").groupBy(F.col("callee_name").alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(50)
    sinks.jsonl(top, path := _new(s))
    return files.json_lines(s, path, top.schema)


_MD = " or ".join(f"regexp_matches(text, '(?m){x}')" for x in T.MARKDOWN_SIGNS)


@query(f"select distinct sha256(text) as digest from documents where {_MD}")
def D2_stream_content_dedup(s, d):
    docs = table(s, d, "documents")
    stream = streams.new_contents(streams.read(s, f"{d}/documents.parquet*", docs.schema), "text", "captured_at", "10000 days")
    streams.write(stream.select("digest"), path := _new(s), _new(s)).awaitTermination()
    return s.read.schema("digest string").parquet(path)


@query("select date_trunc('day', ts) as start, event_type, count(*) as n from events group by 1, 2")
def stream_window_counts(s, d):
    """Events per day and type from a stream; windows still open at the end come with the complete mode."""
    events = table(s, d, "events")
    counts = streams.counts_per_window(streams.read(s, f"{d}/events.parquet*", events.schema), "ts", "event_type", late="10000 days")
    name = "w" + uuid.uuid4().hex
    path = _new(s)
    query_ = counts.writeStream.outputMode("complete").foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path)).option("checkpointLocation", _new(s)).queryName(name).trigger(availableNow=True).start()
    query_.awaitTermination()
    return s.read.schema("start timestamp, event_type string, n long").parquet(path).withColumn("start", F.col("start").cast("timestamp_ntz"))
