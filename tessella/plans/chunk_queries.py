"""Chunking and packing queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions import text as T
from tessella.functions.paths import language_of
from tessella.operators import chunk, graph, packing, render, tokenize
from tessella.plans.text_queries import _STRIP
from tessella.spark_util import cut, latest_per_key, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_MARK = "chr(2) || 'SECTION' || chr(2)"


def _heading_sql(levels: str) -> str:
    line = f"(?m)^(#{{{levels}}}{chunk._GAP}+[^\\n]+)"
    return f"""
        with parts as (select doc_id, string_split(regexp_replace(text, '{line}', {_MARK} || '\\1', 'g'), {_MARK})[2:] p from documents),
             each as (select doc_id, unnest(p) part, generate_subscripts(p, 1) - 1 k from parts)
        select doc_id, k as chunk_index, {_STRIP(f"regexp_extract(part, '^#+{chunk._GAP}+([^\\n]+)', 1)")} as heading, length(regexp_extract(part, '^#+')) as heading_level, {_STRIP('part')} as content from each"""


@query(_heading_sql("1,3"))
def C1_heading_chunk_123(s, d):
    return chunk.by_heading(table(s, d, "documents"), "doc_id", "text").withColumns({"chunk_index": F.col("chunk_index").cast("long"), "heading_level": F.col("heading_level").cast("long")})


@query(_heading_sql("2"))
def C2_heading_chunk_2(s, d):
    return chunk.by_heading(table(s, d, "documents"), "doc_id", "text", "2").withColumns({"chunk_index": F.col("chunk_index").cast("long"), "heading_level": F.col("heading_level").cast("long")})


@query(f"""
    with parts as (select doc_id, list_filter(list_transform(string_split(text, chr(10) || '---' || chr(10)), lambda p: {_STRIP('p')}), lambda p: length(p) >= 100) p from documents),
         each as (select doc_id, unnest(p) part, generate_subscripts(p, 1) - 1 k from parts)
    select doc_id, k as chunk_index, part as content, coalesce(nullif({_STRIP(f"regexp_extract(part, '(?m){T.HEADING}', 2)")}, ''), 'Section ' || k) as heading,
        len(regexp_extract_all(part, '{T.NOT_SPACE}+')) as word_count, len(regexp_extract_all(part, '(?m){T.SUBHEADING}')) as subsection_count, contains(part, '|') and contains(part, '---') as has_tables from each""")
def C3_rule_chunk(s, d):
    rows = chunk.by_rule(table(s, d, "documents"), "doc_id", "text")
    return rows.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "content", "heading", "word_count", "subsection_count", "has_tables")


@query()
def C4_C5_adaptive_chunk(s, d):
    return chunk.adaptive(table(s, d, "documents"), "doc_id", "text")


@query()
def C6_chunk_assemble(s, d):
    """Adaptive chunks with their features, the source lines they refer to, and the call data of the functions in those."""
    key, at = ["doc_id", "chunk_index"], ["file_path", "start_line", "end_line"]
    chunks = cut(chunk.with_features(chunk.adaptive(table(s, d, "documents"), "doc_id", "text"), F.concat(F.lit("Section "), F.col("chunk_index"))))
    refs = chunks.where(F.col("content").contains("]()")).select(*key, F.posexplode(T.source_references("content")).alias("place", "r")).select(*key, "place", "r.*").distinct()
    found = cut(graph.referenced_lines(refs, table(s, d, "src_file")).where("code <> ''").withColumn("n_tokens", T.token_count("code")))
    snippets = found.groupBy(*key).agg(F.count(F.lit(1)).alias("n_snippets"), F.sort_array(F.collect_list(F.struct("place", *at, "code", "n_tokens"))).alias("snippets"))
    within = graph.functions_in(found, table(s, d, "fn_info"))
    functions = render.functions_once(table(s, d, "fn_info"))
    told = within.join(render.call_data(functions, table(s, d, "fn_call")).withColumnRenamed("start_line", "line").drop("file_path"), ["file_id", "line", "name"])
    graphs = found.select(*key, "place", *at).join(told, at).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("place", "file_path", "line", "name", "n_calls", "n_callers", "calls", "called_by", "tree", "sentence"))).alias("call_graph_data"))
    return chunks.join(snippets, key, "left").join(graphs, key, "left").fillna(0, ["n_snippets"])


def _items(s, d):
    rows = table(s, d, "pack_item").withColumn("n", T.token_count("text"))
    return latest_per_key(rows, ["item_id"], ["granularity", "crate", "seq", "text", "n"], ["ingested_at"])


_PACK_SQL = """
    with recursive once as (select item_id, arg_max(struct_pack(g := granularity, c := crate, q := seq, t := length(text) // 4), ingested_at) r from pack_item group by 1),
        o as (select item_id, r.g g, r.c c, coalesce(r.t, 0) t, row_number() over (partition by r.g, r.c order by r.q, item_id) k from once),
        f as (select g, c, k, t, 0 as chunk, case when t > {m} then 0 else t end as total, t <= {m} as holds from o where k = 1
            union all select o.g, o.c, o.k, o.t, case when o.t > {m} or not f.holds or f.total + o.t > {m} then f.chunk + 1 else f.chunk end,
                case when o.t > {m} then 0 when not f.holds or f.total + o.t > {m} then o.t else f.total + o.t end, o.t <= {m} from f join o on o.g = f.g and o.c = f.c and o.k = f.k + 1)
    select g as granularity, c as crate, chunk, count(*) as n_items, cast(sum(t) as bigint) as n_tokens from f group by all"""


@query(_PACK_SQL.format(m=512))
def C7_pack_items(s, d):
    """Items of each granularity and crate in order, at most 512 tokens to a chunk; oversize items whole (their parts: C7_split_oversize)."""
    packed = packing.pack_in_order(_items(s, d), ["granularity", "crate"], ["seq", "item_id"], "n", 512)
    return packing.chunk_sizes(packed, ["granularity", "crate"]).select("granularity", "crate", "chunk", "n_items", "n_tokens")


def _split(s, d, per_line: bool):
    large = _items(s, d).where("n > 512").select("item_id", F.posexplode(packing.split_lines(F.col("text"), 512, per_line)).alias("part", "p"))
    return large.select("item_id", "part", "p.text", "p.n_tokens")


_BIG = """once as (select item_id, arg_max(struct_pack(g := granularity, c := crate, q := seq, t := text, n := length(text) // 4), ingested_at) r from pack_item group by 1), l as (select item_id, unnest(string_split(r.t, chr(10))) line, generate_subscripts(string_split(r.t, chr(10)), 1) k from once where r.n > 512)"""


@query(f"""with recursive {_BIG}, f as (select item_id, k, 0 as part, line as t, length(line) // 4 as n from l where k = 1
        union all select l.item_id, l.k, case when f.t <> '' and (length(f.t) + 1 + length(line)) // 4 > 512 then part + 1 else part end, case when f.t <> '' and (length(f.t) + 1 + length(line)) // 4 > 512 then line else f.t || chr(10) || line end,
            case when f.t <> '' and (length(f.t) + 1 + length(line)) // 4 > 512 then length(line) // 4 else (length(f.t) + 1 + length(line)) // 4 end from f join l on l.item_id = f.item_id and l.k = f.k + 1)
    select item_id, part, arg_max(t, k) as text, arg_max(n, k) as n_tokens from f group by 1, 2""")
def C7_split_oversize(s, d):
    return _split(s, d, per_line=False)


_PARTS = f"""{_BIG}, o as (select *, (length(line) + 1) // 4 n from l), f as (select item_id, k, line, n, 0 as part, n as total from o where k = 1
        union all select o.item_id, o.k, o.line, o.n, case when f.total + o.n > 512 then part + 1 else part end, case when f.total + o.n > 512 then o.n else f.total + o.n end from f join o on o.item_id = f.item_id and o.k = f.k + 1)"""


@query(f"with recursive {_PARTS} select item_id, part, string_agg(line, chr(10) order by k) as text, cast(sum(n) as bigint) as n_tokens from f group by 1, 2")
def C8_split_oversize(s, d):
    return _split(s, d, per_line=True)


@query(f"""with recursive {_PARTS}, each as (select item_id, part, cast(sum(n) as bigint) n, 513 as size from f group by 1, 2 union all select item_id, 0, coalesce(r.n, 0), coalesce(r.n, 0) from once where r.n <= 512 or r.n is null),
        p as (select r.g g, r.c c, n, size, row_number() over (partition by r.g, r.c order by r.q, item_id, part) k from each join once using (item_id)),
        h as (select g, c, k, n, 0 as chunk, case when size > 512 then 0 else size end as total, size <= 512 as holds from p where k = 1
            union all select p.g, p.c, p.k, p.n, case when p.size > 512 or not h.holds or h.total + p.size > 512 then h.chunk + 1 else h.chunk end,
                case when p.size > 512 then 0 when not h.holds or h.total + p.size > 512 then p.size else h.total + p.size end, p.size <= 512 from h join p on p.g = h.g and p.c = h.c and p.k = h.k + 1)
    select g as granularity, c as crate, chunk, count(*) as n_items, cast(sum(n) as bigint) as n_tokens from h group by all""")
def C8_pack_samples(s, d):
    """Items in order, at most 512 tokens to a chunk; oversize ones cut at line ends first, each part a chunk of its own with the sum of its lines' tokens."""
    items = _items(s, d)
    parts = _split(s, d, per_line=True).select("item_id", "part", F.col("n_tokens").alias("own"), F.lit(513).cast("long").alias("size"))
    small = items.where("n <= 512 or n is null").select("item_id", F.lit(0).alias("part"), F.coalesce("n", F.lit(0)).alias("own"), F.coalesce("n", F.lit(0)).alias("size"))
    each = cut(parts.unionByName(small).join(items.select("item_id", "granularity", "crate", "seq"), "item_id"))
    packed = packing.pack_in_order(each, ["granularity", "crate"], ["seq", "item_id", "part"], "size", 512)
    return packed.join(each.select("item_id", "part", "own"), ["item_id", "part"]).groupBy("granularity", "crate", "chunk").agg(F.count(F.lit(1)).alias("n_items"), F.sum("own").alias("n_tokens"))


@query("""with recursive f0 as (select crate, file_id, min(seq) seq, max(length(code)) // 4 t from src_file where code is not null group by 1, 2),
        o as (select *, row_number() over (partition by crate order by t desc, seq, file_id) k from f0 where t < 2000),
        f as (select crate, k, file_id, t, 0 as chunk, t as total from o where k = 1
            union all select o.crate, o.k, o.file_id, o.t, case when f.total >= 4000 then f.chunk + 1 else f.chunk end, case when f.total >= 4000 then o.t else f.total + o.t end from f join o on o.crate = f.crate and o.k = f.k + 1)
    select crate, chunk, count(*) as n_files, cast(sum(t) as bigint) as n_tokens from f group by 1, 2 having sum(t) >= 2000""")
def C9_pack_small_files(s, d):
    files = table(s, d, "src_file").where("code is not null").groupBy("crate", "file_id").agg(F.min("seq").alias("seq"), F.max(T.token_count("code")).alias("n_tokens"))
    return packing.pack_small_files(files).groupBy("crate", "chunk").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_tokens").alias("n_tokens"))


@query()
def C10_tag_pack(s, d):
    """Training texts of doc_chunk: prose, fenced code and referenced source lines within a token budget."""
    chunks = latest_per_key(table(s, d, "doc_chunk"), ["chunk_id"], ["content", "source_references"], ["ingested_at"])
    found = graph.snippets(chunks.select("chunk_id", "source_references"), table(s, d, "src_file")).where("code <> ''")
    gathered = found.groupBy("chunk_id").agg(F.sort_array(F.collect_set(F.struct("file_path", "start_line", "code", language_of(F.col("file_path")).alias("language")))).alias("snippets"))
    return chunk.tagged_samples(chunks.join(gathered, "chunk_id", "left"), "chunk_id")


@query("""with t as (""" + " union all ".join(f"select {m} as max_tokens, * from ({_PACK_SQL.format(m=m)})" for m in (4096, 8192, 16384)) + """) select max_tokens, granularity, crate, chunk, n_items, n_tokens from t""")
def C11_fan_out(s, d):
    packed = packing.pack_in_order(packing.fan_out(_items(s, d)), ["granularity", "crate", "max_tokens"], ["seq", "item_id"], "n", "max_tokens")
    return packing.chunk_sizes(packed, ["granularity", "crate", "max_tokens"]).select("max_tokens", "granularity", "crate", "chunk", "n_items", "n_tokens")


@query()
def C12_truncate_tokenize(s, d):
    return tokenize.truncated_ids(table(s, d, "documents"), "doc_id", "text", 16384)
