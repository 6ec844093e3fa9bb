"""Items of Rust source files, with their SQL: the same blanking, marking and windows in DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.operators import extract
from tessella.operators import rust_facts as R
from tessella.plans.text_queries import _STRIP
from tessella.spark_util import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _sql(text: str, **names: str) -> str:
    """``text`` with ``@name`` replaced by a pattern, quotes doubled."""
    for name, pattern in sorted(names.items(), key=lambda x: -len(x[0])):
        text = text.replace("@" + name, pattern.replace("'", "''"))
    return text


def _blank(x: str, pattern: str) -> str:
    return f"array_to_string(list_transform(string_split(regexp_replace({x}, '(@{pattern})', '@M\\1@M', 'g'), '@M'), lambda x, i: case when i % 2 = 0 then regexp_replace(x, '[^\\n]', ' ', 'g') else x end), '')"


_OPEN, _W = "('(', '[', '{')", "[ \\t\\r\\n]"
_PLACED = """select file_id, x, k, length(x) n, length(x) - length(replace(x, chr(10), '')) nl, case when k % 2 = 1 then x end tok from (
    select file_id, unnest(p) x, generate_subscripts(p, 1) - 1 k from (select file_id, string_split(regexp_replace(text, '(@PATTERN)', '@M\\1@M', 'g'), '@M') p from lex))"""
_LEX = f"""with f as (select file_id, max(code) code from src_file where code is not null group by 1 having suffix(max(file_path), '.rs')),
    blank as (select file_id, code, {_blank("replace(code, '@M', '?')", "LITERAL")} t from f), lex as (select file_id, code, {_blank("t", "ATTRIBUTE")} as text from blank)"""
_EVENTS = f"""{_LEX}, each as ({_PLACED.replace("@PATTERN", "@TOKEN")}),
    marked as (select *, case when k % 2 = 0 and regexp_matches(x, '@BETWEEN') then regexp_extract(x, '@BETWEEN', 1) end gap, case when tok in {_OPEN} then 1 when tok in (')', ']', '}}') then -1 else 0 end d from each),
    placed as (select *, cast(coalesce(sum(n) over b, 0) as bigint) pos, cast(coalesce(sum(nl) over b, 0) as bigint) + 1 line, cast(sum(least(d, 0)) over o + coalesce(sum(greatest(d, 0)) over b, 0) as bigint) level, lead(gap) over o next_gap, lead(tok, 2) over o next_tok
        from marked window o as (partition by file_id order by k), b as (partition by file_id order by k rows between unbounded preceding and 1 preceding)),
    zoned as (select *, coalesce(last_value(case when tok in ('{{', '}}', ';') then pos + 1 end ignore nulls) over b, 0) zone, case when tok in {_OPEN} then lead(pos) over l end shut, case when tok in {_OPEN} then lead(line) over l end shut_line, regexp_replace(tok, '{_W}*!$', '') m
        from placed where tok is not null window b as (partition by file_id order by k rows between unbounded preceding and 1 preceding), l as (partition by file_id, level order by k)),
    ev as (select *, last_value(case when tok in ('{{', ';') then struct_pack(tok := tok, pos := pos, shut := shut, line := shut_line) end ignore nulls) over a body0, case when tok = 'use' then last_value(case when tok = ';' then struct_pack(tok := tok, pos := pos, shut := null::bigint, line := null::bigint) end ignore nulls) over a else body0 end body, last_value(case when tok in {_OPEN} then struct_pack(pos := pos, shut := shut) end ignore nulls) over a opened,
        case when suffix(tok, '!') and next_tok in {_OPEN} and m not in {R.RESERVED} and (m = 'macro_rules') = (next_gap <> '') then case when m = 'macro_rules' then regexp_replace(next_gap, '{_W}+$', '') else m end end macro
        from zoned window a as (partition by file_id, level order by k desc rows between unbounded preceding and 1 preceding)),
    spans as (select file_id, pos, opened.shut + 1 till from ev where macro is not null and opened.shut is not null)"""
_REACH = "max(till) over (partition by file_id order by pos rows between unbounded preceding and 1 preceding)"
_ITEMS = f"""{_EVENTS}, rows_ as (select file_id, regexp_extract(tok, '^[a-z]+') kind, regexp_replace(tok, '^[a-z]+{_W}*(?:r#)?', '') as name, line, pos, zone, body.tok bt, body.pos op, coalesce(body.shut, body.pos) cl, body.line el
        from ev where regexp_matches(tok, '^(fn|struct|enum|union|trait|impl|use)\\b') and (body.tok = ';' or body.shut is not null) and macro is null),
    free as (select * from (select *, {_REACH} reach from (select * from rows_ union all by name select * from spans)) where kind is not null and (reach is null or pos >= reach)),
    near as (select free.*, code, text, trim(regexp_replace(substr(text, zone + 1, pos - zone), '{_W}+', ' ', 'g')) words, pos - length(regexp_extract(substr(text, zone + 1, pos - zone), '^{_W}*([\\s\\S]*)$', 1)) start from free join lex using (file_id)),
    item as (select file_id, kind, nullif(name, '') as name, line, coalesce(el, line) end_line, case when regexp_extract(words, '^pub ?(?:\\([^()]*\\))?') = '' then 'private' else rtrim(regexp_extract(words, '^pub ?(?:\\([^()]*\\))?')) end visibility, words, pos, op, cl, bt,
        trim(regexp_replace(substr(text, pos + 1, op - pos), '{_W}+', ' ', 'g')) header, substr(code, zone + 1, pos - zone) z, substr(code, pos + 1, cl - pos + 1) own, regexp_replace(substr(code, start + 1, op - start), '{_W}+$', '') signature, substr(code, start + 1, cl - start + 1) full_text from near where regexp_matches(words, '@QUALIFIERS')),
    impl0 as (select *, regexp_extract(replace(header, '->', '  '), '^impl ?(@ANGLE)', 1) generics, trim(substr(header, 5 + length(regexp_extract(replace(header, '->', '  '), '^impl ?(@ANGLE)?')) - 4)) rest from item where kind = 'impl' and bt = '{{'),
    impl1 as (select *, trim(regexp_replace(rest, '\\bwhere\\b[\\s\\S]*$', '')) named, nullif(trim(regexp_extract(rest, '\\bwhere\\b([\\s\\S]*)$', 1)), '') where_clause from impl0),
    impl as (select *, case when regexp_matches(named, ' for [^<]') then trim(regexp_extract(named, '^([\\s\\S]*?) for [^<]', 1)) end trait_name, case when regexp_matches(named, ' for [^<]') then trim(regexp_extract(named, '^[\\s\\S]*? for ([^<][\\s\\S]*)$', 1)) else named end for_type from impl1)"""
_DOCS = "nullif(replace(array_to_string(list_transform(list_zip(regexp_extract_all(replace(z, '@M', '?'), '@DOC', 1), regexp_extract_all(replace(z, '@M', '?'), '@DOC', 2)), lambda p: coalesce(p[1], '') || regexp_replace(coalesce(p[2], ''), '(?m)^[ \\t]*\\*+', '', 'g')), chr(10)), chr(13), ''), '')"
_ATTRIBUTES = "regexp_extract_all(regexp_replace(replace(z, '@M', '?'), '(\"(?:[^\"\\\\]|\\\\[\\s\\S])*\")|//[^\\n]*|@COMMENT', '\\1', 'g'), '@WRITTEN')"
_METHODS = "(select file_id, op, array_to_string(list(name order by spot), ', ') methods from (select a.file_id, a.op, b.name, b.pos spot from {0} a join item b on b.file_id = a.file_id and b.kind = 'fn' and b.pos > a.op and b.pos < a.cl) group by 1, 2)"
_INSIDE = lambda name: f"list_transform(list_filter({_ATTRIBUTES}, lambda a: regexp_matches(a, '^#{_W}*\\[{_W}*{name}{_W}*\\(')), lambda a: trim(regexp_replace(regexp_extract(a, '\\(([\\s\\S]*)\\){_W}*\\]$', 1), '{_W}+', ' ', 'g')))"


def _full(sql: str) -> str:
    return _sql(sql, M=R.MARK, LITERAL=R.LITERAL, ATTRIBUTE=R.ATTRIBUTE, TOKEN=R.TOKEN, BETWEEN=R.BETWEEN, QUALIFIERS=R.QUALIFIERS, ANGLE=R._ANGLE, ROUND=R._ROUND, DOC=R.DOC, COMMENT=R._COMMENTS[1], WRITTEN=R.WRITTEN, CALL=R.CALL)


def _query(sql: str):
    full = _full(sql)

    def register(f):
        def run(s, d):
            return f(*R.read(extract.files_once(table(s, d, "src_file"))))

        QUERIES[f.__name__], SQL[f.__name__] = run, full
        return run

    return register


@_query(f"{_ITEMS} select file_id, kind, name, visibility, cast(line as bigint) as line, cast(end_line as bigint) as end_line from item")
def E1_E2_parse(lex, ev, items):
    """Every item, by kind."""
    return items.select("file_id", "kind", "name", "visibility", "line", "end_line")


_PLAIN = "replace(header, '->', chr(1) || chr(1))"
_FN_HEAD = f"regexp_extract({_PLAIN}, '^fn [^ (<]+ ?(@ANGLE)?')"
_BACK = lambda x: f"nullif(trim(replace({x}, chr(1) || chr(1), '->')), '')"


@_query(f"""{_ITEMS}, fn0 as (select *, {_PLAIN} p, substr({_PLAIN}, length({_FN_HEAD}) + 1) r from item where kind = 'fn' and bt = '{{'), fn1 as (select *, substr(r, length(regexp_extract(r, '^ ?(@ROUND)')) + 1) tail from fn0),
    ctx as (select a.file_id, a.pos, arg_max(struct_pack(t := b.trait_name, f := b.for_type), b.op) c from fn1 a join impl b on a.file_id = b.file_id and a.pos > b.op and a.pos < b.cl group by 1, 2)
    select fn1.file_id, cast(line as bigint) as start_line, cast(end_line as bigint) as end_line, name, signature, visibility, full_text, {_DOCS} as doc_comments, list_contains(string_split(words, ' '), 'async') as is_async, list_contains(string_split(words, ' '), 'unsafe') as is_unsafe,
        list_contains(string_split(words, ' '), 'const') as is_const, visibility = 'pub' as is_pub, {_BACK("regexp_extract(p, '^fn [^ (<]+ ?(@ANGLE)', 1)")} as generics, {_BACK("regexp_extract(r, '^ ?(@ROUND)', 1)")} as params, {_BACK("regexp_extract(tail, '^ ?' || chr(1) || chr(1) || '([\\s\\S]*?)(?: where [\\s\\S]*)?$', 1)")} as return_type,
        {_BACK("regexp_extract(tail, '(?: |^)where ([\\s\\S]*)$', 1)")} as where_clause, array_to_string({_ATTRIBUTES}, chr(10)) as attributes, c.t as trait_name, c.f as for_type from fn1 left join ctx using (file_id, pos)""")
def E3_functions(lex, ev, items):
    return R.functions(items).drop("open", "close")


_CALLS = f"""{_ITEMS}, c0 as ({_PLACED.replace("@PATTERN", "@CALL")}), c1 as (select *, cast(coalesce(sum(n) over b, 0) as bigint) pos, cast(coalesce(sum(nl) over b, 0) as bigint) + 1 line, lag(x) over o prev
        from c0 window o as (partition by file_id order by k), b as (partition by file_id order by k rows between unbounded preceding and 1 preceding)),
    c2 as (select file_id, pos, line, tok, regexp_extract(tok, '([A-Za-z_][A-Za-z0-9_]*){_W}*(?:::{_W}*@ANGLE{_W}*)?\\($', 1) callee, regexp_extract(tok, '^([\\s\\S]*?)(?:r#)?[A-Za-z_][A-Za-z0-9_]*{_W}*(?:::{_W}*@ANGLE{_W}*)?\\($', 1) lead_ from c1 where tok is not null and not regexp_matches(prev, '(?:^|[^A-Za-z0-9_])fn{_W}+$')),
    c3 as (select *, regexp_replace(regexp_replace(lead_, '{_W}', '', 'g'), '^\\.', '') path from c2 where callee not in {R.RESERVED}),
    c4 as (select * from (select *, {_REACH} reach from (select * from c3 union all by name select * from spans)) where tok is not null and (reach is null or pos >= reach))"""


@_query(f"""{_CALLS}
    select c4.file_id, i.name as caller_name, cast(i.line as bigint) as caller_line, callee as callee_name, case when path <> '' then path || callee end as qualified, case when starts_with(tok, '.') then 'method' when path <> '' then 'scoped' else 'direct' end as call_kind,
        cast(c4.line + length(lead_) - length(replace(lead_, chr(10), '')) as bigint) as call_line from c4 join item i on i.file_id = c4.file_id and i.kind = 'fn' and i.bt = '{{' and c4.pos > i.op and c4.pos < i.cl""")
def E4_calls(lex, ev, items):
    return R.calls(lex, ev, items).drop("pos")


@_query(f"""{_ITEMS}, t0 as (select *, regexp_replace(replace(header, '->', '  '), '^trait (?:r#)?[A-Za-z0-9_]+ ?', '') rest from item where kind = 'trait' and bt = '{{'), t1 as (select *, regexp_extract(rest, '^(@ANGLE)', 1) generics from t0), m as {_METHODS.format("t1")}
    select t1.file_id, cast(line as bigint) as line, name, visibility, trim(regexp_extract(substr(rest, length(generics) + 1), '^ ?: ?([\\s\\S]*?)(?: where [\\s\\S]*)?$', 1)) as super_traits, generics,
        array_to_string(regexp_extract_all(replace(own, '@M', '?'), '(?:^|[\\n;{{}}])[ \\t\\r]*type[ \\t]+([A-Za-z_][A-Za-z0-9_]*)', 1), ', ') as associated_types, coalesce(methods, '') as methods, {_DOCS} as doc from t1 left join m using (file_id, op)""")
def E5_traits(lex, ev, items):
    return R.traits(items).withColumn("methods", F.array_join("methods", ", ")).drop("open")


@_query(f"{_ITEMS}, m as {_METHODS.format('impl')} select file_id, cast(line as bigint) as line, trait_name, for_type, generics, where_clause, coalesce(methods, '') as methods from impl left join m using (file_id, op)")
def E6_impls(lex, ev, items):
    return R.with_methods(R.impls(items), items).withColumn("methods", F.array_join("methods", ", ")).drop("open", "close")


@_query(f"{_ITEMS} select file_id, cast(line as bigint) as line, regexp_replace(own, '{_W}+', ' ', 'g') as raw, visibility = 'pub' as is_pub, trim(substr(header, 4)) as path from item where kind = 'use'")
def E7_imports(lex, ev, items):
    return R.imports(items)


_DERIVES = f"list_filter(list_transform(flatten(list_transform({_INSIDE('derive')}, lambda a: string_split(a, ','))), lambda d: trim(d)), lambda d: d <> '')"
_TYPE = "kind in ('struct', 'enum', 'union')"


@_query(f"{_ITEMS} select file_id, kind, name, cast(line as bigint) as line, visibility, array_to_string({_DERIVES}, ', ') as derives, array_to_string({_INSIDE('serde')}, chr(10)) as serde_attrs, array_to_string({_ATTRIBUTES}, chr(10)) as attributes, own as code from item where {_TYPE}")
def E8_E9_types(lex, ev, items):
    return R.types(items).withColumns({"derives": F.array_join("derives", ", "), "serde_attrs": F.array_join("serde_attrs", "\n"), "attributes": F.array_join("attributes", "\n")})


@_query(f"""{_ITEMS}, e as (select *, array_to_string(list_filter({_ATTRIBUTES}, lambda a: contains(a, 'derive(')), chr(10)) attribute, array_to_string({_ATTRIBUTES}, chr(10)) every from item where kind = 'enum')
    select file_id, name, cast(line as bigint) as line, attribute, nullif(regexp_extract(every, 'storage_type{_W}*={_W}*"([^"]*)"', 1), '') as storage_type from e where attribute <> ''""")
def E11_attributed_enums(lex, ev, items):
    """Enums with an attribute that holds ``derive(``, and the storage type that their attributes name (null if none does)."""
    return R.attributed_enums(items, "derive(")


_TOP = f"""found as (select file_id, macro as name, case when starts_with(tok, 'macro_rules') then 'definition' else 'call' end kind, line, pos, opened.shut + 1 till from ev where macro is not null and opened.shut is not null),
    top as (select * from (select *, {_REACH} reach from found) where reach is null or pos >= reach)"""


@_query(f"""{_EVENTS}, {_TOP}
    select file_id, name, kind, cast(line as bigint) as line, substr(code, pos + 1, till - pos) as code from top join lex using (file_id)""")
def E12_macros(lex, ev, items):
    return R.macros(lex, ev).drop("from", "to")


#: Enums with attributes, as the first part of a union.
ENUMS = _full(f"{_ITEMS} select 'enum' as kind, file_id, name, own as code from item where kind = 'enum' and len({_ATTRIBUTES}) > 0")
#: Counts of all facts by crate.
FACT_COUNTS = _full(f"""{_CALLS}, {_TOP}, called as (select c4.file_id from c4 join item i on i.file_id = c4.file_id and i.kind = 'fn' and i.bt = '{{' and c4.pos > i.op and c4.pos < i.cl),
    fact as (select file_id, case when kind in ('struct', 'enum', 'union') then 'type' else kind end as kind, visibility = 'pub' as pub from item where bt = '{{' or kind in ('use', 'struct') union all select file_id, 'macro', false from top union all select file_id, 'call', false from called),
    rust as (select file_id, max(crate) crate from src_file where code is not null group by 1 having suffix(max(file_path), '.rs'))
    select crate, count(distinct rust.file_id) as files, count(*) filter (kind = 'type') as types, count(*) filter (kind = 'trait') as traits, count(*) filter (kind = 'impl') as impls, count(*) filter (kind = 'use') as uses, count(*) filter (kind = 'macro') as macros,
        count(*) filter (kind = 'call') as calls, count(*) filter (kind = 'fn') as functions, count(*) filter (kind = 'fn' and pub) as public_functions from rust left join fact using (file_id) group by 1""")
#: The macros called most often, with their first calls.
MACROS = _full(f"""{_EVENTS}, {_TOP}, c as (select distinct file_id, name, line from top where kind = 'call'), t as (select name, count(*) n, min(file_id) f from c group by 1 order by 2 desc, 3, 1 limit 50), r as (select *, row_number() over (partition by name order by file_id, line) k from c)
    select t.name as value, t.n as n, string_agg(file_id || ':' || line, ' ' order by k) filter (k <= 10) as examples from t join r using (name) group by 1, 2""")
_FILES = "files as (select file_id, max(crate) crate, max(module) module, min(seq) seq from src_file where code is not null group by 1)"
_LINES = lambda *parts: f"array_to_string(list_filter([{', '.join(parts)}], lambda x: x is not null), chr(10))"
_NAMES = lambda kind: f"(select crate, string_agg(name, ', ' order by name) l from (select *, row_number() over (partition by crate order by name) k from (select distinct crate, name from item join files using (file_id) where kind = '{kind}')) where k <= 20 group by 1)"
#: Crate headers with the first public names.
CRATE_CARDS = _full(f"""{_ITEMS}, {_FILES}, st as {_NAMES("struct")}, tr as {_NAMES("trait")}, e as (select distinct src, dst from (select name src, unnest(local_deps) dst from crate_info) where dst in (select name from crate_info)), rev as (select dst, string_agg(src, ', ' order by src) l from e group by 1)
    select name as crate, {_LINES("'// CRATE: ' || name", "'// PURPOSE: ' || nullif(purpose, '')", "case when len(local_deps) > 0 then '// DEPENDS_ON: ' || array_to_string(local_deps, ', ') end", "'// DEPENDED_BY: ' || rev.l", "chr(10) || '## Public API'", "chr(10) || 'Structs: ' || st.l", "chr(10) || 'Traits: ' || tr.l")} as content
    from crate_info left join rev on dst = name left join st on st.crate = name left join tr on tr.crate = name""")
_FIRST = lambda kind: f"array_to_string(list(name order by line, name) filter (kind = '{kind}')[:20], ', ')"
#: The first modules that have types.
MODULE_CARDS = _full(f"""{_ITEMS}, {_FILES}, g as (select file_id, coalesce({_FIRST("struct")}, '') st, coalesce({_FIRST("enum")}, '') en, count(*) filter (kind = 'fn' and bt = '{{') n, count(*) filter (kind in ('struct', 'enum', 'union')) nt,
        list('// ' || regexp_replace(own, '{_W}+', ' ', 'g') order by line, regexp_replace(own, '{_W}+', ' ', 'g')) filter (kind = 'use') u from item group by 1)
    select seq, file_id, crate, module, {_LINES("'// MODULE: ' || coalesce(module, '')", "'// CRATE: ' || coalesce(crate, '')", "chr(10) || '// Structs: ' || st", "'// Enums: ' || en", "'// Functions: ' || n", "chr(10) || '// Imports:' || chr(10) || coalesce(array_to_string(u[:10], chr(10)), '')")} as content
    from g join files using (file_id) where nt > 0 order by seq, file_id limit 100""")
#: Traits with their first implementors and method stubs.
TRAIT_CARDS = _full(f"""{_ITEMS}, {_FILES}, t0 as (select *, regexp_replace(replace(header, '->', '  '), '^trait (?:r#)?[A-Za-z0-9_]+ ?', '') rest from item where kind = 'trait' and bt = '{{'),
    t1 as (select *, trim(regexp_extract(substr(rest, length(regexp_extract(rest, '^(@ANGLE)', 1)) + 1), '^ ?: ?([\\s\\S]*?)(?: where [\\s\\S]*)?$', 1)) supers, {_DOCS} doc from t0),
    m as (select file_id, op, string_agg('    fn ' || name || '(...);', chr(10) order by spot) stubs from (select a.file_id, a.op, b.name, b.pos spot from t1 a join item b on b.file_id = a.file_id and b.kind = 'fn' and b.pos > a.op and b.pos < a.cl) group by 1, 2),
    i as (select distinct regexp_extract(regexp_replace(trait_name, '<[\\s\\S]*', ''), '(\\w+)$', 1) as name, file_id, for_type from impl where trait_name is not null), k as (select *, row_number() over (partition by name order by file_id, for_type) k from i), ty as (select name, string_agg(for_type, ', ' order by k) l from k where k <= 10 group by 1)
    select t1.file_id, cast(line as bigint) as line, t1.name as name, {_LINES("'// TRAIT: ' || t1.name", "'// CRATE: ' || coalesce(crate, '')", "'// MODULE: ' || coalesce(module, '')", "'// SUPER_TRAITS: ' || nullif(regexp_replace(supers, ' ?\\+ ?', ', ', 'g'), '')", "'// IMPLEMENTATIONS: ' || ty.l", f"chr(10) || nullif({_STRIP('doc')}, '')", "chr(10) || 'pub trait ' || t1.name || ' {'", "stubs", "'}'")} as content
    from t1 join files using (file_id) left join m using (file_id, op) left join ty on ty.name = t1.name""")
_N = lambda kind: f"count(*) filter (kind = '{kind}' and (kind = 'struct' or bt = '{{{{'))".replace("{{", "{")
#: Whole files with what they contain.
FILE_CARDS = _full(f"""{_ITEMS}, whole as (select file_id, max(crate) crate, max(file_path) file_path, max(code) code from src_file where code is not null group by 1),
    ty as (select 'types' as kind, file_id, chr(10) || '// Contains: ' || {_N("struct")} || ' structs, ' || {_N("enum")} || ' enums, ' || {_N("fn")} || ' functions, ' || {_N("impl")} || ' impls' has from item group by file_id having count(*) filter (kind in ('struct', 'enum', 'union')) > 0),
    m as (select file_id, len(regexp_extract_all(code, 'table_def!\\s*\\{{[\\s\\S]*?\\}}')) t from whole), en as (select file_id, count(*) e from item where kind = 'enum' and len({_ATTRIBUTES}) > 0 group by 1),
    ta as (select 'tables', file_id, chr(10) || '// Contains: ' || t || ' tables, ' || coalesce(e, 0) || ' attributed enums' from m left join en using (file_id) where t > 0 or e > 0),
    cv as (select 'conversions', file_id, chr(10) || '// Conversions: ' || array_to_string(list(trait_name || ' for ' || for_type order by line, trait_name || ' for ' || for_type)[:10], ', ') from impl where regexp_replace(trait_name, '<[\\s\\S]*', '') in ('From', 'Into', 'TryFrom', 'TryInto') group by file_id),
    la as (select 'large', file_id, '' from (select file_id, row_number() over (partition by crate order by strlen(code) desc, file_id) k from whole where strlen(code) > 1000 and strlen(code) < 100000) where k <= 20)
    select kind, file_id, '// Repository: corpus' || chr(10) || '// Crate: ' || coalesce(crate, '') || chr(10) || '// File: ' || file_path || has || chr(10) || chr(10) || code || chr(10) as content from (select * from ty union all select * from ta union all select * from cv union all select * from la) join whole using (file_id)""")
