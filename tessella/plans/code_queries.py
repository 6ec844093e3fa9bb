"""Extraction, miners and renderers over source files and recorded functions, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions import paths as P
from tessella.functions import text as T
from tessella.functions.text import lines_between
from tessella.operators import extract, graph, mining, render, rust_facts
from tessella.plans.relational_queries import _SCORED
from tessella.plans.rust_queries import CRATE_CARDS, ENUMS, FACT_COUNTS, FILE_CARDS, MACROS, MODULE_CARDS, TRAIT_CARDS
from tessella.plans.text_queries import _LANG, _STRIP, async_category
from tessella.spark_util import cut, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(f):
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return register


def _once(s, d):
    return extract.files_once(table(s, d, "src_file"))


for _op, _kind in {"E13_functions_regex": "whole_functions", "E14_structs_impls_regex": "whole_types"}.items():
    query(name=_op)(lambda s, d, kind=_kind: extract.facts(_once(s, d), kind))
for _op, _item in {"E15_X19_functions_by_line": "function", "E16_structs_by_line": "struct", "E17_traits_by_line": "trait", "E18_impls_by_line": "impl"}.items():
    query(name=_op)(lambda s, d, item=_item: extract.facts(_once(s, d), "line_items").where(F.col("kind") == item))
query(name="E19_impl_blocks")(lambda s, d: extract.facts(_once(s, d), "impl_blocks"))


@query("with f as (select file_id, max(code) code from src_file where code is not null group by 1) select file_id, unnest(regexp_extract_all(code, 'table_def!\\s*\\{[\\s\\S]*?\\}')) as code from f")
def E10_schema_macros(s, d):
    return extract.schema_macros(_once(s, d), "table_def")


@query(r"""with f as (select file_id, max(code) code from src_file where code is not null group by 1),
    u as (select file_id, 'use' as kind, unnest(regexp_extract_all(code, 'use[ \t\n\r]+([^;]+);', 1)) as name from f),
    p as (select file_id, 'pub' as kind, unnest(regexp_extract_all(code, 'pub[ \t\n\r]+(?:async[ \t\n\r]+)?(?:fn|struct|enum|trait|type|const|static)[ \t\n\r]+([A-Za-z0-9_]+)', 1)) as name from f)
    select distinct file_id, kind, regexp_replace(regexp_replace(name, '^[ \t\n\r]+', ''), '[ \t\n\r]+$', '') as name from (select * from u union all select * from p)""")
def E19_uses_and_exports(s, d):
    return extract.imports_and_exports(_once(s, d))


@query("""with f as (select file_id, max(code) code from src_file where code is not null group by 1), i as (select distinct file_id, start_line, end_line, name from fn_info where end_line is not null),
    j as (select i.*, regexp_extract_all(f.code, '[^\\n]*\\n|[^\\n]+$') l from i join f using (file_id))
    select file_id, start_line, name, array_to_string(l[greatest(start_line - 50, 1):least(end_line + 50, len(l))], '') as around from j""")
def X21_surrounding_lines(s, d):
    """A recorded function with fifty lines before and behind it; rows without an end line have none."""
    places = table(s, d, "fn_info").where("end_line is not null").select("file_id", "start_line", "end_line", "name").distinct()
    rows = places.join(graph.files_by_id(table(s, d, "src_file")), "file_id")
    return rows.select("file_id", "start_line", "name", lines_between("code", F.col("start_line") - 50, F.col("end_line") + 50).alias("around"))


# ---- miners


@query()
def P1_serde(s, d):
    """The most frequent sets of derives and serde arguments, with their first types."""
    return mining.derive_sets(rust_facts.types(rust_facts.read(_once(s, d))[2]))


@query(ENUMS + """ union all select 'table', file_id, regexp_extract(code, '\\{\\s*(\\w+)', 1), code from (select file_id, unnest(regexp_extract_all(code, 'table_def!\\s*\\{[\\s\\S]*?\\}')) as code from (select file_id, max(code) code from src_file where code is not null group by 1))""")
def P2_schema_tables(s, d):
    """Table macros and attributed enums, by file."""
    files = _once(s, d)
    tables = extract.schema_macros(files, "table_def").select(F.lit("table").alias("kind"), "file_id", F.regexp_extract("code", r"\{\s*(\w+)", 1).alias("name"), "code")
    enums = rust_facts.types(rust_facts.read(files)[2]).where("kind = 'enum' and size(attributes) > 0").select(F.lit("enum").alias("kind"), "file_id", "name", "code")
    return tables.unionByName(enums)


@query(MACROS)
def P3_macros(s, d):
    return mining.frequent_macros(rust_facts.macros(*rust_facts.read(_once(s, d))[:2]))


@query(FACT_COUNTS)
def P12_repository_analysis(s, d):
    """All facts from one parse, written once, as counts per crate."""
    return mining.crate_analysis(_once(s, d))


# ---- renderers

_F = """(select distinct f.file_id, f.start_line, f.name, f.signature, f.visibility, f.full_text, f.crate, f.module, f.file_path, f.is_pub, f.is_async, f.impl_context.trait_name tn, f.impl_context.for_type ft, f.impl_context is not null ic,
    c.purpose, array_to_string(c.local_deps, ', ') deps, coalesce(len(c.local_deps), 0) nd from fn_info f left join crate_info c on c.name = f.crate)"""
_CTX = """array_to_string(list_filter(['// REPO: corpus', '// CRATE: ' || crate, '// CRATE_PURPOSE: ' || nullif(purpose, ''), case when nd > 0 then '// CRATE_DEPS: ' || deps end, '// MODULE: ' || module, '// FUNCTION: ' || name,
    case when visibility <> 'private' then '// VISIBILITY: ' || visibility end, case when ic and tn is not null then '// IMPL: ' || tn || ' for ' || ft when ic then '// IMPL: ' || ft end], lambda x: x is not null), chr(10))"""


def _functions(s, d):
    return render.with_context(render.functions_once(table(s, d, "fn_info")), table(s, d, "crate_info"))


@query(f"select file_id, start_line, name, {_CTX} as context from {_F}")
def T1_fn_context(s, d):
    return _functions(s, d).select("file_id", "start_line", "name", "context")


@query(f"select file_id, start_line, name, {_CTX} || chr(10) || chr(10) || full_text as content from {_F}")
def T2_clm(s, d):
    return _functions(s, d).select("file_id", "start_line", "name", render.clm().alias("content"))


@query(f"""select file_id, start_line, name, '<fim_prefix>' || {_CTX} || chr(10) || chr(10) || signature || ' {{<fim_suffix>' || chr(10) || '}}<fim_middle>' || regexp_extract(full_text, '\\{{[\\s\\S]*') || '<|endoftext|>' as content from {_F}""")
def T3_fim(s, d):
    return _functions(s, d).select("file_id", "start_line", "name", render.fim(F.regexp_extract("full_text", r"\{[\s\S]*", 0)).alias("content"))


_EDGES = f"""f as (select * from {_F}), e as (select distinct caller_file_id, caller_line, callee_name, call_kind, call_line from fn_call where callee_name not in {graph.COMMON_CALLS}),
    pl as (select file_id, start_line, min(name) n, min(file_path) p from f group by 1, 2),
    o as (select *, row_number() over (partition by caller_file_id, caller_line order by call_line, callee_name, call_kind) k, count(*) over (partition by caller_file_id, caller_line) c from e),
    i as (select e.callee_name, pl.n, pl.p, e.call_line, row_number() over (partition by e.callee_name order by e.caller_file_id, e.call_line, pl.n) k, count(*) over (partition by e.callee_name) c
        from e join pl on pl.file_id = e.caller_file_id and pl.start_line = e.caller_line)"""
_GLYPH = "case when k = c then '└─' else '├─' end"
_MORE = "case when max(c) > 10 then chr(10) || '    ... and ' || (max(c) - 10) || ' more {}' else '' end"


@query(f"""with {_EDGES}, ot as (select caller_file_id, caller_line, string_agg('  ├─→ ' || callee_name || ' (line ' || call_line || ')', chr(10) order by k) t from o where k <= 10 group by 1, 2),
    it as (select callee_name, string_agg('  ←─┤ ' || n || ' (' || p || ':' || call_line || ')', chr(10) order by k) t from i where k <= 10 group by 1)
    select file_id, start_line, name, array_to_string(list_filter(['[CALL_GRAPH]', name || ' (' || file_path || ':' || start_line || ')', ot.t, chr(10) || '[CALLED_BY]' || chr(10) || it.t], lambda x: x is not null), chr(10))
        || chr(10) || chr(10) || {_CTX} || chr(10) || chr(10) || full_text as content
    from f left join ot on ot.caller_file_id = file_id and ot.caller_line = start_line left join it on it.callee_name = name""")
def T4_graph_prefix(s, d):
    return render.graph_samples(_functions(s, d), table(s, d, "fn_call")).select("file_id", "start_line", "name", "content")


@query(f"""with {_EDGES}, ot as (select caller_file_id, caller_line, string_agg({_GLYPH} || '→ ' || callee_name || ' (' || call_kind || ', line ' || call_line || ')', chr(10) order by k) || {_MORE.format('calls')} t from o where k <= 10 group by 1, 2),
    it as (select callee_name, string_agg({_GLYPH} || '← ' || n || ' (' || p || ':' || call_line || ')', chr(10) order by k) || {_MORE.format('callers')} t from i where k <= 10 group by 1)
    select file_id, start_line, name, array_to_string(list_filter([name, chr(10) || 'Calls:' || chr(10) || ot.t, chr(10) || 'Called by:' || chr(10) || it.t], lambda x: x is not null), chr(10)) as tree
    from f left join ot on ot.caller_file_id = file_id and ot.caller_line = start_line left join it on it.callee_name = name""")
def T5_ascii_tree(s, d):
    return render.call_trees(_functions(s, d), table(s, d, "fn_call"))


_FEW = lambda rows, total, most: f"{rows} || case when {total} > {most} then ', and ' || ({total} - {most}) || ' others' else '' end"


@query(f"""with {_EDGES}, d as (select *, row_number() over (partition by caller_file_id, caller_line, call_kind order by call_line, callee_name) dk, count(*) over (partition by caller_file_id, caller_line, call_kind) dn from e),
    dt as (select caller_file_id, caller_line, call_kind, {_FEW("string_agg(callee_name, ', ' order by dk) filter (dk <= 5)", "max(dn)", 5)} t from d group by 1, 2, 3), it as (select callee_name, {_FEW("string_agg(n, ', ' order by k) filter (k <= 3)", "max(c)", 3)} t from i group by 1)
    select file_id, start_line, name, array_to_string(list_filter([name || ' is a ' || visibility || ' ' || case when is_async then 'async function' else 'function' end || case when ic and tn is not null then ' implementing ' || tn || ' for ' || ft when ic then ' defined in the implementation of ' || ft else '' end || '.',
        'It ' || nullif(array_to_string(list_filter(['calls ' || a.t, 'invokes methods ' || b.t], lambda x: x is not null), ' and '), '') || '.', 'This function is called by ' || it.t || '.'], lambda x: x is not null), ' ') as sentence
    from f left join dt a on a.caller_file_id = file_id and a.caller_line = start_line and a.call_kind = 'direct' left join dt b on b.caller_file_id = file_id and b.caller_line = start_line and b.call_kind = 'method' left join it on it.callee_name = name""")
def T6_flow_sentence(s, d):
    return render.flow_sentences(_functions(s, d), table(s, d, "fn_call"))


@query("""with e as (select distinct src, dst from (select name src, unnest(local_deps) dst from crate_info) where dst in (select name from crate_info)), rev as (select dst, string_agg(src, ', ' order by src) l from e group by 1)
    select name as crate, array_to_string(list_filter(['// CRATE: ' || name, '// PURPOSE: ' || nullif(purpose, ''), case when len(local_deps) > 0 then '// DEPENDS_ON: ' || array_to_string(local_deps, ', ') end, '// DEPENDED_BY: ' || l], lambda x: x is not null), chr(10)) as header
    from crate_info left join rev on dst = name""")
def T7_crate_header(s, d):
    return render.crate_headers(table(s, d, "crate_info"))


@query(CRATE_CARDS)
def T7_crate_card(s, d):
    return render.crate_cards(table(s, d, "crate_info"), _once(s, d))


@query("""with e as (select distinct src, dst from (select name src, unnest(local_deps) dst from crate_info) where dst in (select name from crate_info)), o as (select src, string_agg(dst, ', ' order by dst) l from e group by 1)
    select string_agg(name || '/' || coalesce(chr(10) || '  Purpose: ' || nullif(purpose, ''), '') || coalesce(chr(10) || '  Depends on: ' || l, ''), chr(10) || chr(10) order by name) as content, count(*) as n_crates from crate_info left join o on src = name""")
def T8_repo_card(s, d):
    return render.repository_card(table(s, d, "crate_info"))


@query(MODULE_CARDS)
def T9_module_card(s, d):
    return render.module_cards(_once(s, d))


@query(TRAIT_CARDS)
def T10_trait_card(s, d):
    return render.trait_cards(_once(s, d))


@query("""select distinct file_id, impl_context.for_type as for_type, '// PATTERN: connector_integration' || chr(10) || '// TRAIT: ' || impl_context.trait_name || chr(10) || '// FOR_TYPE: ' || impl_context.for_type || chr(10) || '// CRATE: ' || crate as content
    from fn_info where contains(impl_context.trait_name, 'Error')""")
def T11_connector_card(s, d):
    return render.trait_pattern_cards(table(s, d, "fn_info"), "Error")


@query("""select name as crate, 'Describe the crate ' || name || ' and what it depends on.' as instruction, coalesce(array_to_string(local_deps, ', '), '') as input, coalesce(purpose, '') as output from crate_info""")
def T12_instruction_row(s, d):
    return render.instruction_rows(table(s, d, "crate_info"))


_SRC = "(select file_id, max(file_path) file_path, max(code) code, max(crate) crate, max(module) module, min(seq) seq from src_file where code is not null group by 1)"


@query(f"select file_id, '<path>' || chr(10) || 'Repository: corpus' || chr(10) || 'Crate: ' || crate || chr(10) || 'File: ' || file_path || chr(10) || 'Size: ' || length(code) || ' characters' || chr(10) || '</path>' || chr(10) || chr(10) || '<file>' || chr(10) || code || chr(10) || '</file>' || chr(10) as content from {_SRC}")
def T13_tagged_file(s, d):
    return render.tagged_files(_once(s, d))


@query(f"""with g as (select crate, count(*) n, sum(length(code) // 4) t, string_agg('// File: ' || file_path || chr(10) || chr(10) || code, chr(10) || chr(10) order by seq, file_id) body from {_SRC} group by 1)
    select crate, n as n_files, cast(t as bigint) as n_tokens, md5('<path>' || chr(10) || 'Repository: corpus' || chr(10) || 'Crate: ' || crate || chr(10) || 'Files: ' || n || chr(10) || '</path>' || chr(10) || chr(10) || '<crate>' || chr(10) || body || chr(10) || '</crate>' || chr(10)) as digest from g where t between 2000 and 16000""")
def T14_combined_group(s, d):
    return render.combined_groups(_once(s, d), "crate", 2000, 16000).select("crate", "n_files", "n_tokens", F.md5("content").alias("digest"))


@query(f"""select file_id, '// File: ' || file_path || chr(10) || '// Module: ' || regexp_replace(array_to_string(list_filter(string_split(file_path, '/'), lambda p: p <> ''), '::'), '^(.*?::)?crates::|\\.rs$', '', 'g') || chr(10) || chr(10) || code as text from {_SRC} where starts_with(file_path, 'crates/') and suffix(file_path, '.rs')""")
def T15_header_comment(s, d):
    rows = _once(s, d).where("startswith(file_path, 'crates/') and endswith(file_path, '.rs')")
    return rows.select("file_id", render.header_comment(F.col("file_path"), P.module_of(F.col("file_path"), "source"), F.col("code")).alias("text"))


@query()
def T16_item_comment(s, d):
    return render.item_comments(_once(s, d))


def _documentation(s, d, layout):
    chunks = table(s, d, "doc_chunk").groupBy("chunk_id").agg(F.max("content").alias("content"), F.max("source_references").alias("source_references"))
    return render.documentation_tags(chunks, graph.snippets(chunks.select("chunk_id", "source_references"), table(s, d, "src_file")), layout)


_TAGS = rf"""with c as (select chunk_id, max(content) t, max(source_references) refs from doc_chunk group by 1), r as (select chunk_id, unnest(refs) r from c), f as (select file_path, max(code) code from src_file where code is not null group by 1),
    j as (select distinct chunk_id, f.file_path, r.start_line s, array_to_string(regexp_extract_all(code, '[^\n]*\n|[^\n]+$')[greatest(r.start_line, 1):least(r.end_line, len(regexp_extract_all(code, '[^\n]*\n|[^\n]+$')))], '') x from r join f on r.file_path = f.file_path),
    e as (select *, regexp_extract(file_path, '[^/]\.([^./]+)$', 1) ext from j where x <> ''),
    g as (select chunk_id, list('<code language="' || case ext when '' then 'text' {_LANG} else ext end || '" source="' || file_path || '">' || chr(10) || x || chr(10) || '</code>' order by file_path, s, x) l from e group by 1),
    p as (select chunk_id, t, {_STRIP(f"regexp_replace(regexp_replace(t, '{T.ANY_FENCE}', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")} prose, list_transform(list_filter(list_transform(list_zip(regexp_extract_all(t, '{T.FENCE}', 1), regexp_extract_all(t, '{T.FENCE}', 2)), lambda b: [coalesce(nullif(b[1], ''), 'text'), {_STRIP("b[2]")}]), lambda b: b[2] <> ''), lambda b: '<code language="' || b[1] || '">' || chr(10) || b[2] || chr(10) || '</code>') inl from c),
    q as (select chunk_id, case when prose <> '' then ['<doc>' || chr(10) || prose || chr(10) || '</doc>'] else [] end d, list_concat(coalesce(inl, []), coalesce(l, [])) c from p left join g using (chunk_id))"""


@query(f"{_TAGS} select chunk_id, array_to_string(list_concat(d, c), chr(10) || chr(10)) as text, 'documentation' as source from q")
def T17_doc_code_tags(s, d):
    return _documentation(s, d, "interleaved").drop("part")


@query(f"{_TAGS} select chunk_id, 0 as part, d[1] as text, 'documentation' as source from q where len(d) > 0 union all select chunk_id, 1, array_to_string(c, chr(10) || chr(10)), 'documentation' from q where len(c) > 0")
def T17_separate(s, d):
    return _documentation(s, d, "separate")


@query(f"{_TAGS} select chunk_id, part, array_to_string(list_concat(d, [c[part + 1]]), chr(10) || chr(10)) as text, 'documentation' as source from (select *, unnest(range(len(c))) as part from q)")
def T17_doc_code_pairs(s, d):
    return _documentation(s, d, "pairs")


@query(f"""select file_id, '<code language="rust" source="' || file_path || '">' || chr(10) || code || chr(10) || '</code>' as text, 'code' as source, file_path as id from {_SRC}""")
def T18_code_tag(s, d):
    return render.code_tags(_once(s, d))


@query()
def T19_pattern_cards(s, d):
    files = _once(s, d)
    return mining.pattern_cards(files, table(s, d, "fn_info"))


@query(FILE_CARDS)
def T20_file_cards(s, d):
    return mining.file_cards(_once(s, d))


@query(f"""with r as (select f.*, coalesce(full_text, '') x, s.weighted from {_F} f join (select distinct file_id, start_line, name, weighted from ({_SCORED})) s using (file_id, start_line, name)),
    b as (select *, row_number() over (partition by crate, module order by weighted desc, file_id, start_line, name, x) k from r), c as (select *, case when regexp_matches(lower(name), 'find|get|fetch') then 'database_query' when regexp_matches(lower(name), 'insert|update|delete') then 'database_mutation'
        when regexp_matches(lower(name), 'call|request|connector') then 'connector_call' when contains(lower(name), 'redis') then 'redis_operation' else 'other_async' end category from r where is_async), d as (select *, row_number() over (partition by category order by file_id, start_line, name, x) k from c)
    select 'functions' as kind, array_to_string(list_filter([crate, module], lambda v: v is not null), '::') as key, '// Crate: ' || coalesce(crate, '') || chr(10) || '// Module: ' || coalesce(module, '') || chr(10) || '// Top functions: ' || string_agg(name, ', ' order by k) || chr(10) || chr(10) || string_agg(x, chr(10) || chr(10) order by k) filter (k <= 5) as content
    from b where k <= 10 group by crate, module union all select 'async', file_id || ':' || start_line || ':' || name, '// Category: ' || category || chr(10) || chr(10) || x from d where k <= 50""")
def T20_function_cards(s, d):
    functions = table(s, d, "fn_info")
    return mining.function_cards(functions, graph.importance(functions, table(s, d, "fn_call")), async_category(F.col("name")))


@query()
def T21_multi_level_cards(s, d):
    return mining.multi_level_cards(_once(s, d))


@query(f"""with top as (select file_id, start_line, name, weighted from ({_SCORED}) order by weighted desc, file_id, start_line, name limit 1000), r as (select f.*, top.weighted from {_F} f join top using (file_id, start_line, name))
    select file_id, start_line, name, weighted, 'clm' as type, {_CTX} || chr(10) || chr(10) || full_text as content from r
    union all select file_id, start_line, name, weighted, 'fim', '<fim_prefix>' || {_CTX} || chr(10) || chr(10) || signature || ' {{<fim_suffix>' || chr(10) || '}}<fim_middle>' || regexp_extract(full_text, '\\{{[\\s\\S]*') || '<|endoftext|>'
    from r where regexp_extract(full_text, '\\{{[\\s\\S]*') <> ''""")
def P10_important_functions(s, d):
    """The thousand functions with the highest weight, as plain and as fill-in-the-middle text."""
    scored = graph.importance(table(s, d, "fn_info"), table(s, d, "fn_call")).orderBy(F.desc("weighted"), "file_id", "start_line", "name").limit(1000)
    rows = cut(_functions(s, d).join(F.broadcast(scored.select("file_id", "start_line", "name", "weighted")), ["file_id", "start_line", "name"]))
    plain = rows.select("file_id", "start_line", "name", "weighted", F.lit("clm").alias("type"), render.clm().alias("content"))
    body = F.regexp_extract("full_text", r"\{[\s\S]*", 0)
    return plain.unionByName(rows.where(body != "").select("file_id", "start_line", "name", "weighted", F.lit("fim").alias("type"), render.fim(body).alias("content")))
