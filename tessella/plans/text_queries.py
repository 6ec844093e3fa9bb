"""Text scalars and filters over whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions import paths as P
from tessella.functions import text as T
from tessella.operators.graph import COMMON_CALLS
from tessella.spark_util import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def add(name: str, source: str, key: str, columns, sql: str | None, where=None) -> None:
    def run(spark, folder):
        df = table(spark, folder, source)
        if where is not None:
            df = df.where(where())
        return df.select(key, *[c.alias(n) for n, c in columns().items()])

    QUERIES[name] = run
    if sql:
        SQL[name] = sql


_S = T.SPACE
_STRIP = lambda x: f"regexp_replace(regexp_replace({x}, '\\A{_S}+', ''), '{_S}+\\z', '')"
_WORDS = lambda x: f"len(regexp_extract_all({x}, '{T.NOT_SPACE}+'))"
_LANG = " ".join(f"when '{k}' then '{v}'" for k, v in T.EXTENSION_LANGUAGES.items())
_TOK = lambda x: f"(length({x}) // 4)"
_BLOCKS = f"list_filter(list_transform(regexp_extract_all(text, '{T.ANY_FENCE}'), lambda b: regexp_extract(b, '{T.FENCE}', 0)), lambda b: b <> '')"

add("X1_strip_preamble", "documents", "doc_id", lambda: {"body": T.strip_preamble("text")}, f"select doc_id, {_STRIP(f"regexp_extract(text, '(?m){T.TITLE}')")} as body from documents")
add(
    "X2_first_heading", "doc_chunk", "chunk_id", lambda: {"found_heading": T.heading_text("content", F.concat(F.lit("Section "), F.col("chunk_index"))), "found_level": T.heading_level("content")},
    f"""select chunk_id, coalesce(nullif({_STRIP(f"regexp_extract(content, '(?m){T.HEADING}', 2)")}, ''), 'Section ' || chunk_index) as found_heading,
        cast(coalesce(nullif(length(regexp_extract(content, '(?m){T.HEADING}', 1)), 0), 2) as integer) as found_level from doc_chunk""",
)
add("X3_subsection_count", "documents", "doc_id", lambda: {"n": T.subsection_count("text").cast("long")}, f"select doc_id, cast(len(regexp_extract_all(text, '(?m){T.SUBHEADING}')) as bigint) as n from documents")
add(
    "X4_fence_extract", "documents", "doc_id", lambda: {"blocks": F.array_join(F.transform(T.code_blocks("text"), lambda b: F.concat(b["language"], F.lit(":"), b["code"])), "\u0001")},
    f"""select doc_id, case when text is not null then array_to_string(list_transform(list_filter(list_transform(list_zip(regexp_extract_all(text, '{T.FENCE}', 1), regexp_extract_all(text, '{T.FENCE}', 2)),
        lambda p: [coalesce(nullif(p[1], ''), 'text'), {_STRIP("p[2]")}]), lambda p: p[2] <> ''), lambda p: p[1] || ':' || p[2]), chr(1)) end as blocks from documents""",
)
add("X5_fence_remove", "documents", "doc_id", lambda: {"prose": T.without_code_blocks("text")}, f"select doc_id, {_STRIP(f"regexp_replace(regexp_replace(text, '{T.ANY_FENCE}', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")} as prose from documents")
add(
    "X6_feature_flags", "documents", "doc_id",
    lambda: {"has_mermaid": F.col("text").contains("mermaid"), "has_code": F.col("text").rlike(T.ANY_FENCE), "has_tables": F.col("text").contains("|") & F.col("text").contains("---")},
    f"select doc_id, contains(text, 'mermaid') as has_mermaid, regexp_matches(text, '{T.ANY_FENCE}') as has_code, contains(text, '|') and contains(text, '---') as has_tables from documents",
)
add("X7_word_count", "documents", "doc_id", lambda: {"words": T.word_count("text")}, f"select doc_id, cast({_WORDS('text')} as bigint) as words from documents")
add("X8_token_count", "documents", "doc_id", lambda: {"chars4": T.token_count("text"), "words13": T.token_count("text", "words13")}, f"select doc_id, cast({_TOK('text')} as bigint) as chars4, cast(floor({_WORDS('text')} * 1.3::double) as bigint) as words13 from documents")
add(
    "X9_token_stats", "documents", "doc_id", lambda: {k: (F.round(T.token_stats("text")[k], 6) if "_" in k and k[0] in "ct" and k not in ("total_tokens", "total_chars") else T.token_stats("text")[k]) for k in ("total_tokens", "total_chars", "compression_ratio", "tokens_per_word")},
    f"""select doc_id, cast({_TOK('text')} as bigint) as total_tokens, length(text) as total_chars, round(coalesce(length(text) / nullif({_TOK('text')}, 0), 0.0), 6) as compression_ratio,
        round(coalesce({_TOK('text')} / nullif({_WORDS('text')}, 0), 0.0), 6) as tokens_per_word from documents""",
)
add(
    "X10_code_share", "documents", "doc_id", lambda: {"share": F.round(T.code_share("text"), 6)},
    f"""select doc_id, case when text is null then 0.0 else round(coalesce(coalesce(list_sum(list_transform(regexp_extract_all(text, '{T.FENCE}', 2), lambda b: length({_STRIP('b')}) // 4)), 0) * 100.0::double / nullif({_TOK('text')}, 0), 0.0), 6) end as share from documents""",
)
add(
    "X11_source_refs", "documents", "doc_id",
    lambda: {"refs": F.array_join(F.transform(T.source_references("text"), lambda r: F.concat_ws(":", r["file_path"], r["start_line"], r["end_line"])), "|"), "n_refs": F.coalesce(F.size(T.source_references("text")), F.lit(0)).cast("long")},
    f"""select doc_id, case when text is not null then array_to_string(list_transform(list_zip(regexp_extract_all(text, '{T.REFERENCE}', 1), regexp_extract_all(text, '{T.REFERENCE}', 2), regexp_extract_all(text, '{T.REFERENCE}', 3)),
        lambda p: p[1] || ':' || cast(try_cast(p[2] as bigint) as varchar) || ':' || cast(try_cast(coalesce(nullif(p[3], ''), p[2]) as bigint) as varchar)), '|') end as refs,
        cast(coalesce(len(regexp_extract_all(text, '{T.REFERENCE}', 1)), 0) as bigint) as n_refs from documents""",
)
_PARTS = "list_filter(string_split(file_path, '/'), lambda p: p <> '')"
add(
    "X12_crate_of_path", "src_file", "file_id", lambda: {"crate_name": P.crate_of(F.col("file_path")), "crate_or_root": P.crate_of(F.col("file_path"), "root"), "crate_or_unknown": P.crate_of(F.col("file_path"), "unknown")},
    f"""with x as (select file_id, {_PARTS} p from src_file), y as (select file_id, p, list_position(p, 'crates') a from x)
        select file_id, case when a > 0 and len(p) > a then p[a + 1] else p[1] end as crate_name, case when a > 0 and len(p) > a then p[a + 1] when len(p) > 1 then p[1] else 'root' end as crate_or_root,
        case when a > 0 and len(p) > a then p[a + 1] when len(p) > 1 then p[1] else 'unknown' end as crate_or_unknown from y""",
)
_NO_RS = lambda x: f"regexp_replace({x}, '\\.rs$', '')"
add(
    "X13_module_of_path", "src_file", "file_id", lambda: {f"module_{s}": P.module_of(F.col("file_path"), s) for s in ("plain", "crate", "source", "path")},
    f"""with x as (select file_id, {_PARTS} p from src_file), y as (select file_id, p, coalesce(list_position(p, 'crates'), 0) a from x),
        z as (select file_id, p, a, case when a > 0 then p[a + 1:] else p end q, case when a > 0 then p[a + 2:] else p end r from y),
        w as (select *, coalesce(list_position(q, 'src'), 0) s, case when r[1] = 'src' then r[2:] else r end t from z)
        select file_id, coalesce(nullif(regexp_replace({_NO_RS("array_to_string(t, '::')")}, '(^|::)(mod|lib)$', ''), ''), 'root') as module_plain,
        {_NO_RS("array_to_string(case when s > 0 then q[:s - 1] || q[s + 1:] else q end, '::')")} as module_crate, {_NO_RS("array_to_string(q, '::')")} as module_source, {_NO_RS("array_to_string(p, '/')")} as module_path from w""",
)
add(
    "X14_crate_info", "src_file", "file_id", lambda: {"crate_name": P.crate_info(F.col("file_path"))["crate"], "module_path": F.array_join(P.crate_info(F.col("file_path"))["module_path"], "::"), "file_name": P.crate_info(F.col("file_path"))["file_name"]},
    f"""with x as (select file_id, {_PARTS} p from src_file), y as (select *, coalesce(list_position(p, 'crates'), 0) a, coalesce(list_position(p, 'src'), 0) s, regexp_replace(p[-1], '(.)\\.[^.]*$', '\\1') stem from x)
        select file_id, case when a > 0 and len(p) > a then p[a + 1] end as crate_name, case when a > 0 and len(p) > a and s > 0 then
        array_to_string(p[s + 1:len(p) - 1] || case when stem in ('mod', 'lib') then [] else [stem] end, '::') else '' end as module_path, p[-1] as file_name from y""",
)
add(
    "X15_slugify", "src_file", "file_id", lambda: {"slug": T.slug("file_path"), "url_name": T.url_file_name(F.concat(F.lit("https://host.example/"), F.col("file_path"), F.lit("?rsc=1#top")))},
    """select file_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(file_path), '[^a-z0-9._-]+', '-', 'g'), '^-+', ''), '-+$', ''), ''), 'file')[:200] as slug,
        coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(string_split(file_path, '/')[-1], '(?i)\\.(json|txt|js|jsx|ts|tsx)$', '')), '[^a-z0-9._-]+', '-', 'g'), '^-+', ''), '-+$', ''), ''), 'file')[:200] as url_name from src_file""",
)
add("X16_lang_from_ext", "src_file", "file_id", lambda: {"language": P.language_of(F.col("file_path"))}, f"with x as (select file_id, regexp_extract(file_path, '[^/]\\.([^./]+)$', 1) e from src_file) select file_id, case e when '' then 'text' {_LANG} else e end as language from x")
add("X17_layer", "src_file", "file_id", lambda: {"layer": P.layer_of(F.col("crate"))}, "select file_id, case when contains(crate, 'gate') or contains(crate, 'wire') then 'api' when contains(crate, 'core') then 'domain' when contains(crate, 'vault') then 'database' else 'other' end as layer from src_file")


#: What names of async functions hold, and the category that tells.
ASYNC_CATEGORIES = (("find|get|fetch", "database_query"), ("insert|update|delete", "database_mutation"), ("call|request|connector", "connector_call"), ("redis", "redis_operation"))


def async_category(name):
    """What an async function is for, by the first part that its name holds."""
    return F.coalesce(*[F.when(F.lower(name).rlike(marks), category) for marks, category in ASYNC_CATEGORIES], F.lit("other_async"))


add(
    "X18_async_category", "fn_info", "file_id", lambda: {"start_line": F.col("start_line"), "category": async_category(F.col("name"))},
    """select file_id, start_line, case when regexp_matches(lower(name), 'find|get|fetch') then 'database_query' when regexp_matches(lower(name), 'insert|update|delete') then 'database_mutation'
        when regexp_matches(lower(name), 'call|request|connector') then 'connector_call' when contains(lower(name), 'redis') then 'redis_operation' else 'other_async' end as category from fn_info""",
)
add("X20_bucket", "documents", "doc_id", lambda: {"bucket": T.size_bucket(F.length("text"))}, "select doc_id, case when length(text) < 4000 then 'small' when length(text) < 10000 then 'medium' when length(text) >= 10000 then 'large' end as bucket from documents")

add("F1_byte_size_range", "src_file", "file_id", lambda: {"n_bytes": F.octet_length("code").cast("long")}, "select file_id, cast(strlen(code) as bigint) as n_bytes from src_file where strlen(code) between 100 and 500000", lambda: F.octet_length("code").between(100, 500000))
add("F2_char_size_range", "src_file", "file_id", lambda: {"n_chars": F.length("code").cast("long")}, "select file_id, length(code) as n_chars from src_file where length(code) between 5000 and 500000", lambda: F.length("code").between(5000, 500000))
add("F3_open_range", "src_file", "file_id", lambda: {"n_bytes": F.octet_length("code").cast("long")}, "select file_id, cast(strlen(code) as bigint) as n_bytes from src_file where strlen(code) > 1000 and strlen(code) < 100000", lambda: (F.octet_length("code") > 1000) & (F.octet_length("code") < 100000))
add("F4_token_range", "src_file", "file_id", lambda: {"n_tokens": T.token_count("code")}, "select file_id, cast(length(code) // 4 as bigint) as n_tokens from src_file where length(code) // 4 between 2000 and 16000", lambda: T.token_count("code").between(2000, 16000))
add(
    "F5_path_exclude", "src_file", "file_id", lambda: {"file_path": F.col("file_path")},
    "select file_id, file_path from src_file where not (contains('/' || file_path, '/target/') or contains('/' || file_path, '/generated/') or contains(file_path, '.gen.rs') or contains('/' || file_path, '/build/'))", lambda: ~P.is_excluded(F.col("file_path")),
)
add("F6_test_file", "src_file", "file_id", lambda: {"is_test": T.is_test_file("file_path", "code")}, "select file_id, contains('/' || file_path, '/tests/') or suffix(file_path, '_test.rs') or coalesce(contains(code, '#[cfg(test)]') or contains(code, 'mod tests {'), false) as is_test from src_file")
add(
    "F7_generated_file", "src_file", "file_id", lambda: {"is_generated": T.is_generated("code")},
    "with x as (select file_id, lower(array_to_string(string_split(code, chr(10))[:10], chr(10))) h from src_file) select file_id, contains(h, '@generated') or contains(h, 'auto-generated') or contains(h, 'this file is generated') or contains(h, 'do not edit') as is_generated from x",
)
add("F8_min_section_len", "doc_chunk", "chunk_id", lambda: {"n_chars": F.length(T.strip("content")).cast("long")}, f"select chunk_id, length({_STRIP('content')}) as n_chars from doc_chunk where length({_STRIP('content')}) >= 100", lambda: F.length(T.strip("content")) >= 100)
add("F9_looks_like_markdown", "documents", "doc_id", lambda: {"is_markdown": T.looks_like_markdown("text")}, "select doc_id, " + " or ".join(f"regexp_matches(text, '(?m){s}')" for s in T.MARKDOWN_SIGNS) + " as is_markdown from documents")
add("F10_name_contains", "fn_info", "file_id", lambda: {"start_line": F.col("start_line"), "name": F.col("name")}, "select file_id, start_line, name from fn_info where contains(lower(name), 'validate') or contains(lower(name), 'check')", lambda: F.lower("name").contains("validate") | F.lower("name").contains("check"))
add("F11_type_contains", "fn_info", "file_id", lambda: {"start_line": F.col("start_line"), "return_type": F.col("return_type")}, "select file_id, start_line, return_type from fn_info where contains(return_type, 'Result')", lambda: F.col("return_type").contains("Result"))
#: Conversion traits.
CONVERSIONS = ("From", "Into", "TryFrom", "TryInto")
_BARE = lambda: F.regexp_replace(F.col("impl_context.trait_name"), r"<[\s\S]*", "")
add("F12_in_list", "fn_info", "file_id", lambda: {"start_line": F.col("start_line"), "trait": _BARE()}, f"select file_id, start_line, regexp_replace(impl_context.trait_name, '<[\\s\\S]*', '') as trait from fn_info where regexp_replace(impl_context.trait_name, '<[\\s\\S]*', '') in {CONVERSIONS}", lambda: _BARE().isin(*CONVERSIONS))
add("F13_call_stoplist", "fn_call", "caller_file_id", lambda: {"caller_line": F.col("caller_line"), "callee_name": F.col("callee_name"), "call_line": F.col("call_line")}, f"select caller_file_id, caller_line, callee_name, call_line from fn_call where callee_name not in {COMMON_CALLS}", lambda: ~F.col("callee_name").isin(*COMMON_CALLS))
add("F18_empty_sample", "documents", "doc_id", lambda: {"n": F.length("text").cast("long")}, "select doc_id, length(text) as n from documents where text <> ''", lambda: F.col("text") != "")


def _group_filter(spark, folder):
    """crates with at least two files whose characters come to between 10 thousand and a million."""
    sized = table(spark, folder, "src_file").groupBy("crate").agg(F.count(F.lit(1)).alias("n_files"), F.sum(F.length("code")).alias("n_chars"))
    return sized.where("n_files >= 2 and n_chars between 10000 and 1000000")


QUERIES["F14_F15_group_filters"] = _group_filter
SQL["F14_F15_group_filters"] = "select crate, count(*) as n_files, cast(sum(length(code)) as bigint) as n_chars from src_file group by crate having count(*) >= 2 and sum(length(code)) between 10000 and 1000000"
QUERIES["F16_first_n_files"] = lambda s, d, n=100: table(s, d, "src_file").select("file_id", "seq", "scanned_at").orderBy("seq", "file_id", "scanned_at").limit(n)
SQL["F16_first_n_files"] = "select file_id, seq, scanned_at from src_file order by seq, file_id, scanned_at limit 100"


def _error_skip(spark, folder):
    """event properties that parse as JSON with an integer k, and how many rows were rejected, by type."""
    e = table(spark, folder, "events").select("event_type", F.get_json_object("props", "$.k").try_cast("long").alias("k"))
    return e.groupBy("event_type").agg(F.count("k").alias("kept"), F.count_if(F.col("k").isNull()).alias("rejected"), F.sum("k").alias("total"))


QUERIES["F17_error_skip"] = _error_skip
SQL["F17_error_skip"] = """with x as (select event_type, try_cast(json_extract_string(props, '$.k') as bigint) k from events)
    select event_type, count(k) as kept, count(*) - count(k) as rejected, cast(sum(k) as bigint) as total from x group by 1"""
