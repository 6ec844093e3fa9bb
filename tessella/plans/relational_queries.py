"""Joins, aggregates, windows, top-k, set operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessella.functions import paths as P
from tessella.functions import text as T
from tessella.operators import graph, mixing, stats
from tessella.operators.graph import COMMON_CALLS
from tessella.plans.text_queries import async_category
from tessella.spark_util import latest_per_key, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, folder) under its name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# ---- joins


@query("""
    with refs as (select chunk_id, unnest(source_references) r from (select distinct chunk_id, source_references from doc_chunk)),
         files as (select file_path, max(code) code from src_file where code is not null group by 1)
    select chunk_id, r.file_path as file_path, r.start_line as start_line, r.end_line as end_line, length(code) as file_chars from refs join files on r.file_path = files.file_path""")
def J1_ref_to_file(s, d):
    refs = table(s, d, "doc_chunk").select("chunk_id", "source_references").distinct().select("chunk_id", F.explode("source_references").alias("r"))
    return graph.files_by_path(table(s, d, "src_file")).join(refs.select("chunk_id", F.col("r.*")), "file_path").select("chunk_id", "file_path", "start_line", "end_line", F.length("code").cast("long").alias("file_chars"))


@query("""
    with refs as (select chunk_id, unnest(source_references) r from (select distinct chunk_id, source_references from doc_chunk)),
         files as (select file_path, max(code) code from src_file where code is not null group by 1),
         j as (select chunk_id, r.file_path fp, r.start_line s, r.end_line e, regexp_extract_all(code, '[^\\n]*\\n|[^\\n]+$') l from refs join files on r.file_path = files.file_path)
    select chunk_id, fp as file_path, s as start_line, e as end_line, array_to_string(l[greatest(s, 1):least(e, len(l))], '') as code from j""")
def S9_line_range_read(s, d):
    refs = table(s, d, "doc_chunk").select("chunk_id", "source_references").distinct()
    return graph.snippets(refs, table(s, d, "src_file")).select("chunk_id", "file_path", "start_line", "end_line", "code")


_FN_ONCE = "(select distinct file_id, start_line, name from fn_info)"
_CALL_ONCE = "(select distinct caller_file_id, caller_line, callee_name, call_kind, call_line from fn_call)"
_STOP = f"callee_name not in {COMMON_CALLS}"


@query(f"""
    with c as (select callee_name, count(*) n, min(struct_pack(f := caller_file_id, l := caller_line)) m from {_CALL_ONCE} group by 1)
    select file_id, start_line, name, coalesce(n, 0) as n_callers, m.f || ':' || m.l as first_caller from {_FN_ONCE} f left join c on c.callee_name = f.name""")
def J2_snippet_callers(s, d):
    callers = graph.calls_once(table(s, d, "fn_call")).groupBy(F.col("callee_name").alias("name")).agg(F.count(F.lit(1)).alias("n_callers"), F.min(F.struct("caller_file_id", "caller_line")).alias("_m"))
    return graph.functions_once(table(s, d, "fn_info")).join(callers, "name", "left").select("file_id", "start_line", "name", F.coalesce("n_callers", F.lit(0)).alias("n_callers"), F.when(F.col("_m").isNotNull(), F.concat_ws(":", "_m.caller_file_id", "_m.caller_line")).alias("first_caller"))


@query(f"""
    with o as (select caller_file_id, caller_line, count(*) n from {_CALL_ONCE} where {_STOP} group by 1, 2), i as (select callee_name, count(*) n from {_CALL_ONCE} where {_STOP} group by 1)
    select f.file_id, f.start_line, f.name, coalesce(o.n, 0) as n_calls, coalesce(i.n, 0) as n_callers from {_FN_ONCE} f
    left join o on o.caller_file_id = f.file_id and o.caller_line = f.start_line left join i on i.callee_name = f.name""")
def J3_fn_callers(s, d):
    return graph.call_counts(table(s, d, "fn_info"), table(s, d, "fn_call")).select("file_id", "start_line", "name", "n_calls", "n_callers")


@query("select distinct f.file_id, f.start_line, f.name, f.crate, c.purpose, len(c.local_deps) as n_deps from fn_info f left join crate_info c on c.name = f.crate")
def J4_fn_crate(s, d):
    crates = table(s, d, "crate_info").select(F.col("name").alias("crate"), "purpose", F.when(F.col("local_deps").isNotNull(), F.size("local_deps")).cast("long").alias("n_deps"))
    return table(s, d, "fn_info").select("file_id", "start_line", "name", "crate").distinct().join(crates, "crate", "left")


@query("with e as (select name src, unnest(local_deps) dst from crate_info) select distinct src, dst from e where dst in (select name from crate_info)")
def J5_crate_dep_filter(s, d):
    return graph.crate_edges(table(s, d, "crate_info"))


@query("""with e as (select distinct src, dst from (select name src, unnest(local_deps) dst from crate_info) where dst in (select name from crate_info))
    select dst as crate, count(*) as n_dependents, string_agg(src, ', ' order by src) as dependents from e group by 1""")
def J6_crate_dependents(s, d):
    return graph.crate_edges(table(s, d, "crate_info")).groupBy(F.col("dst").alias("crate")).agg(F.count(F.lit(1)).alias("n_dependents"), F.array_join(F.sort_array(F.collect_set("src")), ", ").alias("dependents"))


@query("select c.name as crate, count(distinct s.module) as n_modules, min(s.module) as first_module from crate_info c left join src_file s on s.crate = c.name group by 1")
def J7_crate_modules(s, d):
    modules = table(s, d, "src_file").select("crate", "module").distinct()
    return table(s, d, "crate_info").select(F.col("name").alias("crate")).join(modules, "crate", "left").groupBy("crate").agg(F.count("module").alias("n_modules"), F.min("module").alias("first_module"))


@query("""
    with i as (select distinct file_id, crate, regexp_replace(impl_context.trait_name, '<[\\s\\S]*', '') trait, impl_context.for_type for_type from fn_info where impl_context.trait_name is not null),
         r as (select *, row_number() over (partition by trait order by file_id, for_type) k from i)
    select trait, count(*) as n_impls, string_agg(for_type, ', ' order by k) filter (k <= 10) as first_types from r group by 1""")
def J8_trait_impls(s, d):
    impls = graph.trait_impls(table(s, d, "fn_info"))
    first = stats.top_k_per_group(impls.select("trait", "file_id", "for_type"), ["trait"], [F.asc("file_id"), F.asc("for_type")], 10)
    shown = first.groupBy("trait").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "for_type"))), lambda x: x["for_type"]), ", ").alias("first_types"))
    return impls.groupBy("trait").agg(F.count(F.lit(1)).alias("n_impls")).join(shown, "trait")


@query("""
    with deps as (select crate, dep from (select name crate, unnest(local_deps) dep, generate_subscripts(local_deps, 1) k from crate_info) where k <= 5),
         files as (select distinct crate, file_id, code from src_file where code is not null),
         uses as (select crate, file_id, unnest(regexp_extract_all(code, 'use [^;]+;')) u from files)
    select distinct deps.crate, deps.dep, uses.crate as using_crate, uses.file_id from deps join uses on contains(u, deps.dep)""")
def J9_dep_importing_files(s, d):
    deps = table(s, d, "crate_info").select(F.col("name").alias("crate"), F.explode(F.slice("local_deps", 1, 5)).alias("dep"))
    return graph.importing_files(deps, table(s, d, "src_file"))


@query("""
    with i as (select *, row_number() over (partition by trait, for_type, crate order by file_id) k from
        (select distinct file_id, crate, regexp_replace(impl_context.trait_name, '<[\\s\\S]*', '') trait, impl_context.for_type for_type from fn_info where impl_context.trait_name is not null)),
         f as (select file_id, max(file_path) file_path from src_file group by 1)
    select i.trait, i.for_type, i.crate, i.file_id, f.file_path from i join f using (file_id) where k = 1 and trait in ('From', 'Into', 'TryFrom', 'TryInto')""")
def J10_conversion_file(s, d):
    first = graph.trait_impls(table(s, d, "fn_info")).where(F.col("trait").isin("From", "Into", "TryFrom", "TryInto")).groupBy("trait", "for_type", "crate").agg(F.min("file_id").alias("file_id"))
    return first.join(table(s, d, "src_file").groupBy("file_id").agg(F.max("file_path").alias("file_path")), "file_id")


@query("""
    with a as (select file_id, start_line, name, unnest(attributes) attr from (select distinct file_id, start_line, name, attributes from fn_info)),
         r as (select *, row_number() over (partition by attr order by file_id, start_line, name) k, count(*) over (partition by attr) n from a)
    select attr, n as n_functions, file_id, start_line, name from r where k = 1""")
def J11_attr_example(s, d):
    each = table(s, d, "fn_info").select("file_id", "start_line", "name", "attributes").distinct().select("file_id", "start_line", "name", F.explode("attributes").alias("attr"))
    return each.groupBy("attr").agg(F.count(F.lit(1)).alias("n_functions"), F.min(F.struct("file_id", "start_line", "name")).alias("_f")).select("attr", "n_functions", "_f.*")


@query("""
    with f as (select file_id, max(code) code from src_file where code is not null group by 1)
    select distinct i.file_id, i.start_line, i.name, contains(f.code, 'fn ' || i.name) as found from fn_info i join f using (file_id)""")
def J12_fn_source_file(s, d):
    files = graph.files_by_id(table(s, d, "src_file"))
    return table(s, d, "fn_info").select("file_id", "start_line", "name").distinct().join(files, "file_id").select("file_id", "start_line", "name", F.col("code").contains(F.concat(F.lit("fn "), F.col("name"))).alias("found"))


@query("""
    with g as (select file_id, count(*) n from (select distinct file_id, start_line, name from fn_info where is_async) group by 1), f as (select file_id, max(code) code from src_file where code is not null group by 1)
    select g.file_id, g.n as n_async, length(f.code) as n_chars from g join f using (file_id)""")
def J13_pattern_file_content(s, d):
    grouped = table(s, d, "fn_info").where("is_async").select("file_id", "start_line", "name").distinct().groupBy("file_id").agg(F.count(F.lit(1)).alias("n_async"))
    return grouped.join(graph.files_by_id(table(s, d, "src_file")), "file_id").select("file_id", "n_async", F.length("code").cast("long").alias("n_chars"))


# ---- aggregates


@query("""select granularity, count(*) as n_rows, count(*) filter (tokens > 100) as n_large, count(*) filter (tokens is null) as n_unknown from pack_item group by 1""")
def A1_conditional_count(s, d):
    return table(s, d, "pack_item").groupBy("granularity").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("tokens") > 100).alias("n_large"), F.count_if(F.col("tokens").isNull()).alias("n_unknown"))


@query("select crate, count(distinct module) as n_modules, string_agg(distinct module, ',' order by module) as modules from src_file group by 1")
def A2_distinct(s, d):
    once = table(s, d, "src_file").select("crate", "module").distinct()
    return once.groupBy("crate").agg(F.count("module").alias("n_modules"), F.nullif(F.array_join(F.sort_array(F.collect_list("module")), ","), F.lit("")).alias("modules"))


@query("select heading_level, count(*) as n from doc_chunk group by 1")
def A3_group_count(s, d):
    return table(s, d, "doc_chunk").groupBy("heading_level").agg(F.count(F.lit(1)).alias("n"))


@query("""select granularity, round(avg(tokens), 6) as mean, round(stddev_pop(tokens), 6) as std, min(tokens) as least, max(tokens) as most, cast(sum(tokens) as bigint) as total from pack_item group by 1""")
def A4_moments(s, d):
    return stats.moments(table(s, d, "pack_item"), "granularity", "tokens")


@query(f"""
    with c as (select callee_name, count(*) n, min(struct_pack(f := caller_file_id, l := caller_line)) f from {_CALL_ONCE} group by 1), t as (select * from c order by n desc, f, callee_name limit 50),
         e as (select *, row_number() over (partition by callee_name order by caller_file_id, caller_line, call_line, call_kind) k from {_CALL_ONCE})
    select t.callee_name as value, t.n as n, string_agg(e.caller_file_id || ':' || e.caller_line || ':' || e.call_line, ' ' order by k) as examples from t join e using (callee_name) where k <= 10 group by 1, 2""")
def A5_top_frequent(s, d):
    calls = graph.calls_once(table(s, d, "fn_call"))
    order = F.struct("caller_file_id", "caller_line", "call_line", "call_kind")
    return stats.top_with_examples(calls, "callee_name", order, F.concat_ws(":", "caller_file_id", "caller_line", "call_line"), F.struct("caller_file_id", "caller_line"), 50, 10)


@query("""select granularity, round(quantile_cont(tokens, 0.25), 6) as p25, round(quantile_cont(tokens, 0.5), 6) as p50, round(quantile_cont(tokens, 0.75), 6) as p75,
    round(quantile_cont(tokens, 0.9), 6) as p90, round(quantile_cont(tokens, 0.95), 6) as p95, round(quantile_cont(tokens, 0.99), 6) as p99 from pack_item group by 1""")
def A6_percentiles(s, d):
    return stats.percentiles(table(s, d, "pack_item"), "granularity", "tokens")


@query("""with x as (select granularity, tokens, row_number() over (partition by granularity order by tokens) - 1 k, count(*) over (partition by granularity) n from pack_item where tokens is not null)
    select granularity, tokens as upper_median from x where k = n // 2""")
def A7_upper_median(s, d):
    return stats.upper_median(table(s, d, "pack_item").where("tokens is not null"), "granularity", "tokens")


@query("""with x as (select case when length(text) < 4000 then 'small' when length(text) < 10000 then 'medium' when length(text) >= 10000 then 'large' end bucket from documents)
    select bucket, count(*) as n, round(count(*) * 100.0::double / sum(count(*)) over (), 6) as share from x group by 1""")
def A8_share(s, d):
    return stats.shares(table(s, d, "documents").select(T.size_bucket(F.length("text")).alias("bucket")), "bucket")


@query("""with f as (select crate, seq, file_id, max(code) code from src_file where code is not null group by all)
    select crate, md5(string_agg(code, chr(10) || chr(10) order by seq, file_id)) as digest, cast(sum(length(code)) + 2 * (count(*) - 1) as bigint) as n_chars from f group by 1 having sum(length(code)) <= 2000000""")
def A9_group_concat(s, d):
    """Texts of a crate in order; crates over two million characters are left out before their texts are gathered (F15)."""
    files = table(s, d, "src_file").where("code is not null").groupBy("crate", "seq", "file_id").agg(F.max("code").alias("code"))
    small = files.groupBy("crate").agg(F.sum(F.length("code")).alias("n"), F.count(F.lit(1)).alias("k")).where("n <= 2000000")
    joined = stats.group_concat(files.join(small.select("crate"), "crate", "left_semi"), "crate", ["seq", "file_id"], "code", "\n\n")
    return joined.select("crate", F.md5("text").alias("digest"), F.length("text").cast("long").alias("n_chars"))


@query("""select string_split(file_path, '/')[1] || '/' || coalesce(string_split(file_path, '/')[2], '') as module_key, count(distinct file_id) as n_files from src_file group by 1""")
def A10_derived_key(s, d):
    parts = F.split("file_path", "/")
    return table(s, d, "src_file").groupBy(F.concat(F.get(parts, F.lit(0)), F.lit("/"), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).alias("module_key")).agg(F.count_distinct("file_id").alias("n_files"))


@query(f"""with e as (select * from {_CALL_ONCE} where {_STOP}) select 'forward' as direction, caller_file_id || ':' || caller_line as node, count(*) as degree, count(distinct callee_name) as n_others from e group by 2
    union all select 'reverse', callee_name, count(*), count(distinct caller_file_id || ':' || caller_line) from e group by 2""")
def A11_adjacency(s, d):
    return graph.adjacency_degrees(graph.structural_calls(table(s, d, "fn_call")))


_SCORED = f"""select f.file_id, f.start_line, f.name, coalesce(o.n, 0) + coalesce(i.n, 0) + case when f.is_pub then 5 else 0 end + case when f.in_impl then 3 else 0 end as score,
    2 * coalesce(o.n, 0) + 3 * coalesce(i.n, 0) + case when f.is_pub then 10 else 0 end + case when f.is_async then 5 else 0 end + case when f.in_impl then 8 else 0 end as weighted
    from (select distinct file_id, start_line, name, is_pub, is_async, impl_context is not null as in_impl from fn_info) f
    left join (select caller_file_id, caller_line, count(*) n from {_CALL_ONCE} where {_STOP} group by 1, 2) o on o.caller_file_id = f.file_id and o.caller_line = f.start_line
    left join (select callee_name, count(*) n from {_CALL_ONCE} where {_STOP} group by 1) i on i.callee_name = f.name"""


@query(_SCORED)
def A12_importance_score(s, d):
    return graph.importance(table(s, d, "fn_info"), table(s, d, "fn_call"))


@query("""select array_to_string(list_sort(attributes), ' ') as attribute_set, count(*) as n from (select distinct file_id, start_line, name, attributes from fn_info where attributes is not null) group by 1""")
def A13_canonical_set(s, d):
    once = table(s, d, "fn_info").where("attributes is not null").select("file_id", "start_line", "name", "attributes").distinct()
    return once.groupBy(F.array_join(F.array_sort("attributes"), " ").alias("attribute_set")).agg(F.count(F.lit(1)).alias("n"))


@query("""select source_file, cast(sum(coalesce(len(source_references), 0)) as bigint) as n_refs, round(avg(coalesce(len(source_references), 0)), 6) as refs_per_chunk,
    cast(sum(coalesce(list_sum(list_transform(source_references, lambda r: r.end_line - r.start_line + 1)), 0)) as bigint) as n_lines from (select distinct chunk_id, source_file, source_references from doc_chunk) group by 1""")
def A14_nested_counts(s, d):
    once = table(s, d, "doc_chunk").select("chunk_id", "source_file", "source_references").distinct()
    n = F.coalesce(F.when(F.col("source_references").isNotNull(), F.size("source_references")), F.lit(0))
    lines = F.coalesce(F.aggregate("source_references", F.lit(0).cast("long"), lambda a, r: a + F.coalesce(r["end_line"] - r["start_line"] + 1, F.lit(0))), F.lit(0))
    return once.groupBy("source_file").agg(F.sum(n).cast("long").alias("n_refs"), F.round(F.avg(n), 6).alias("refs_per_chunk"), F.sum(lines).alias("n_lines"))


# ---- windows, top-k, sets


@query("""select source_file, chunk_id, sum(case when heading_level <= 2 then 1 else 0 end) over (partition by source_file order by chunk_index, chunk_id rows unbounded preceding) as section_id
    from (select distinct source_file, chunk_id, chunk_index, heading_level from doc_chunk)""")
def W1_running_section(s, d):
    w = Window.partitionBy("source_file").orderBy("chunk_index", "chunk_id").rowsBetween(Window.unboundedPreceding, 0)
    once = table(s, d, "doc_chunk").select("source_file", "chunk_id", "chunk_index", "heading_level").distinct()
    return once.select("source_file", "chunk_id", F.sum(F.when(F.col("heading_level") <= 2, 1).otherwise(0)).over(w).alias("section_id"))


@query("select source_file, chunk_id, row_number() over (partition by source_file order by chunk_index, chunk_id) - 1 as emitted_index from (select distinct source_file, chunk_id, chunk_index from doc_chunk)")
def W2_chunk_index(s, d):
    w = Window.partitionBy("source_file").orderBy("chunk_index", "chunk_id")
    return table(s, d, "doc_chunk").select("source_file", "chunk_id", "chunk_index").distinct().select("source_file", "chunk_id", (F.row_number().over(w) - 1).cast("long").alias("emitted_index"))


@query("""select crate, file_id, n_chars, k from (select crate, file_id, n_chars, row_number() over (partition by crate order by n_chars desc, file_id) k
    from (select crate, file_id, max(length(code)) n_chars from src_file where code is not null group by 1, 2)) where k <= 20""")
def W3_top_k_per_group(s, d):
    files = table(s, d, "src_file").where("code is not null").groupBy("crate", "file_id").agg(F.max(F.length("code")).cast("long").alias("n_chars"))
    return stats.top_k_per_group(files, ["crate"], [F.desc("n_chars"), F.asc("file_id")], 20).withColumn("k", F.col("k").cast("long"))


@query("""select source_file, chunk_id, lag(chunk_id, 1) over w as previous, lag(chunk_id, 2) over w as before_previous from (select distinct source_file, chunk_id, chunk_index from doc_chunk) window w as (partition by source_file order by chunk_index, chunk_id)""")
def W4_lookback_2(s, d):
    w = Window.partitionBy("source_file").orderBy("chunk_index", "chunk_id")
    return table(s, d, "doc_chunk").select("source_file", "chunk_id", "chunk_index").distinct().select("source_file", "chunk_id", F.lag("chunk_id", 1).over(w).alias("previous"), F.lag("chunk_id", 2).over(w).alias("before_previous"))


@query("""with r as (select crate, name, file_id, start_line, row_number() over (partition by crate, name order by file_id desc, start_line desc) k, min(file_id) over (partition by crate, name) first_file from fn_info)
    select crate, name, file_id, start_line, first_file from r where k = 1""")
def W5_last_wins(s, d):
    once = latest_per_key(table(s, d, "fn_info"), ["crate", "name"], ["file_id", "start_line"], ["file_id", "start_line"])
    first = table(s, d, "fn_info").groupBy("crate", "name").agg(F.min("file_id").alias("first_file"))
    return once.join(first, ["crate", "name"])


@query(f"""with r as (select callee_name, caller_file_id, caller_line, row_number() over (partition by callee_name order by caller_file_id, caller_line) k from (select distinct callee_name, caller_file_id, caller_line from {_CALL_ONCE}))
    select callee_name, string_agg(caller_file_id || ':' || caller_line, ' ' order by k) as first_callers from r where k <= 15 group by 1""")
def W6_first_n_per_group(s, d):
    callers = graph.calls_once(table(s, d, "fn_call")).select("callee_name", "caller_file_id", "caller_line").distinct()
    first = stats.top_k_per_group(callers, ["callee_name"], [F.asc("caller_file_id"), F.asc("caller_line")], 15)
    return first.groupBy("callee_name").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "caller_file_id", "caller_line"))), lambda x: F.concat_ws(":", x["caller_file_id"], x["caller_line"])), " ").alias("first_callers"))


@query(f"select * from ({_SCORED}) order by weighted desc, file_id, start_line, name limit 500")
def O1_global_top_k(s, d):
    return graph.importance(table(s, d, "fn_info"), table(s, d, "fn_call")).orderBy(F.desc("weighted"), "file_id", "start_line", "name").limit(500)


@query("select file_id, max(file_size) as size from src_file group by 1 order by 2 desc nulls last, 1")
def O2_sort(s, d):
    return table(s, d, "src_file").groupBy("file_id").agg(F.max("file_size").alias("size")).orderBy(F.desc_nulls_last("size"), "file_id")


@query("select name as crate, array_to_string(local_deps[:5], ',') as first_deps, array_to_string(external_deps[:10], ',') as first_external from crate_info order by name limit 100")
def O3_limit(s, d):
    part = lambda c, n: F.array_join(F.slice(c, 1, n), ",")
    return table(s, d, "crate_info").orderBy("name").limit(100).select(F.col("name").alias("crate"), part("local_deps", 5).alias("first_deps"), part("external_deps", 10).alias("first_external"))


@query("""select 'documents' as origin, doc_id as id, text, null as heading from documents union all select 'doc_chunk', chunk_id, content, heading from doc_chunk""")
def U1_union(s, d):
    a = table(s, d, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text")
    b = table(s, d, "doc_chunk").select(F.lit("doc_chunk").alias("origin"), F.col("chunk_id").alias("id"), F.col("content").alias("text"), "heading")
    return a.unionByName(b, allowMissingColumns=True)


@query("select distinct crate, module from src_file")
def D1_distinct(s, d):
    return table(s, d, "src_file").select("crate", "module").distinct()


@query("select min(doc_id) as doc_id, sha256(text) as digest, count(*) as n_copies from documents where text is not null group by 2")
def D2_content_dedup(s, d):
    return mixing.keep_first(table(s, d, "documents"), "text", "doc_id").select("doc_id", "digest", "n_copies")


@query()
def R1_weighted_interleave(s, d):
    docs = table(s, d, "documents").where("text <> ''").select(F.lit("documentation").alias("source"), F.col("doc_id").alias("id"), "text")
    code = table(s, d, "src_file").where("code <> ''").groupBy(F.col("file_id").alias("id")).agg(F.max("code").alias("text")).select(F.lit("code").alias("source"), "id", "text")
    return mixing.interleave(docs.unionByName(code), {"documentation": 0.5, "code": 0.5}, 42)


@query("select doc_id, upper(lang) as label, length(text) as n from documents")
def M1_map_columns(s, d):
    return table(s, d, "documents").select("doc_id", F.upper("lang").alias("label"), F.length("text").cast("long").alias("n"))


# ---- miners on recorded functions


@query("select distinct file_id, start_line, name, crate from fn_info where contains(lower(name), 'validate') or contains(lower(name), 'check')")
def P4_validation(s, d):
    return table(s, d, "fn_info").where(F.lower("name").rlike("validate|check")).select("file_id", "start_line", "name", "crate").distinct()


@query("""select case when regexp_matches(lower(name), 'find|get|fetch') then 'database_query' when regexp_matches(lower(name), 'insert|update|delete') then 'database_mutation' when regexp_matches(lower(name), 'call|request|connector') then 'connector_call'
    when contains(lower(name), 'redis') then 'redis_operation' else 'other_async' end as category, count(*) as n from (select distinct file_id, start_line, name from fn_info where is_async) group by 1""")
def P5_async(s, d):
    once = table(s, d, "fn_info").where("is_async").select("file_id", "start_line", "name").distinct()
    return once.groupBy(async_category(F.col("name")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("""select return_type, count(*) as n, min(file_id) as first_file from (select distinct file_id, start_line, name, return_type from fn_info where contains(return_type, 'Result')) group by 1 order by 2 desc, 3, 1 limit 50""")
def P6_errors(s, d):
    once = table(s, d, "fn_info").where(F.col("return_type").contains("Result")).select("file_id", "start_line", "name", "return_type").distinct()
    return once.groupBy("return_type").agg(F.count(F.lit(1)).alias("n"), F.min("file_id").alias("first_file")).orderBy(F.desc("n"), "first_file", "return_type").limit(50)


@query("""with i as (select distinct file_id, crate, regexp_replace(impl_context.trait_name, '<[\\s\\S]*', '') trait, regexp_extract(impl_context.trait_name, '<([\\s\\S]*)>', 1) source_type, impl_context.for_type for_type from fn_info)
    select file_id, trait, source_type, for_type, case when contains(crate, 'gate') or contains(crate, 'wire') then 'api' when contains(crate, 'core') then 'domain' when contains(crate, 'vault') then 'database' else 'other' end as source_layer,
    case when contains(for_type, 'gate') or contains(for_type, 'wire') then 'api' when contains(for_type, 'core') then 'domain' when contains(for_type, 'vault') then 'database' else 'unknown' end as target_layer
    from i where trait in ('From', 'Into', 'TryFrom', 'TryInto')""")
def P7_conversions(s, d):
    once = table(s, d, "fn_info").select("file_id", "crate", "impl_context.trait_name", "impl_context.for_type").distinct()
    named = once.select("file_id", "crate", F.regexp_replace("trait_name", r"<[\s\S]*", "").alias("trait"), F.regexp_extract("trait_name", r"<([\s\S]*)>", 1).alias("source_type"), "for_type").where(F.col("trait").isin("From", "Into", "TryFrom", "TryInto")).distinct()
    return named.select("file_id", "trait", "source_type", "for_type", P.layer_of(F.col("crate")).alias("source_layer"), P.layer_of(F.col("for_type"), default="unknown").alias("target_layer"))


@query("""with i as (select distinct file_id, impl_context.trait_name trait, impl_context.for_type for_type from fn_info where impl_context.trait_name is not null), c as (select trait, count(*) n, min(file_id) f from i group by 1 order by 2 desc, 3, 1 limit 50),
    r as (select *, row_number() over (partition by trait order by file_id, for_type) k from i) select c.trait as value, c.n as n, string_agg(r.file_id || ':' || r.for_type, ' ' order by k) as examples from c join r using (trait) where k <= 10 group by 1, 2""")
def P8_impls_by_trait(s, d):
    impls = table(s, d, "fn_info").where("impl_context.trait_name is not null").select("file_id", F.col("impl_context.trait_name").alias("trait"), "impl_context.for_type").distinct()
    return stats.top_with_examples(impls, "trait", F.struct("file_id", "for_type"), F.concat_ws(":", "file_id", "for_type"), F.col("file_id"), 50, 10)


@query("""select 'function' as kind, file_id, start_line, name from (select distinct file_id, start_line, name from fn_info where is_pub and contains(lower(name), 'rout'))
    union all select 'impl', file_id, null, for_type from (select distinct file_id, impl_context.for_type for_type from fn_info where contains(impl_context.trait_name, 'Connector'))""")
def P9_routing(s, d):
    f = table(s, d, "fn_info")
    functions = f.where(F.col("is_pub") & F.lower("name").contains("rout")).select(F.lit("function").alias("kind"), "file_id", "start_line", "name").distinct()
    impls = f.where(F.col("impl_context.trait_name").contains("Connector")).select(F.lit("impl").alias("kind"), "file_id", F.lit(None).cast("long").alias("start_line"), F.col("impl_context.for_type").alias("name")).distinct()
    return functions.unionByName(impls)


@query("""with e as (select name src, unnest(list_distinct(local_deps)) dst from crate_info), k as (select *, dst in (select name from crate_info) known from e)
    select name as crate, coalesce(o.n, 0) as n_known, coalesce(o.u, 0) as n_unknown, coalesce(i.n, 0) as n_dependents, len(coalesce(external_deps, [])) as n_external from crate_info
    left join (select src, count(*) filter (known) n, count(*) filter (not known) u from k group by 1) o on o.src = name left join (select dst, count(*) n from k where known group by 1) i on i.dst = name""")
def P11_crate_graph(s, d):
    return graph.crate_summary(table(s, d, "crate_info"))


@query("""with d as (select name crate, unnest(list_distinct(coalesce(local_deps, []) || coalesce(external_deps, []))) dep from crate_info)
    select crate, dep, dep in (select name from crate_info) or starts_with(dep, 'brindle_') as is_local from d""")
def X22_dep_locality(s, d):
    return graph.dependency_locality(table(s, d, "crate_info"), ("brindle_",))


@query("select f.crate as crate, coalesce(c.purpose, '') as purpose, count(*) as n from src_file f left join crate_info c on c.name = f.crate group by 1, 2")
def X23_purpose_lookup(s, d):
    counts = table(s, d, "src_file").groupBy("crate").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(table(s, d, "crate_info").select(F.col("name").alias("crate"), "purpose"), "crate", "left").select("crate", F.coalesce("purpose", F.lit("")).alias("purpose"), "n")
