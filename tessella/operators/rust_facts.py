"""Items of Rust source files as fact tables, by Spark alone.

Literals, comments and attributes are blanked by two regular expressions that keep
every offset. What is left is split at brackets, keywords and macro names, one narrow
row each; running sums over a file give places, lines and bracket levels, and since
brackets of one level alternate, the next row of its level closes a bracket. Items
are rows of keywords whose qualifiers alone stand between them and the end of what
came before; what lies within a macro is none. Files of null code or another
language give no rows; a file in several rows gives its items for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import all_matches
from tessella.spark_util import cut

#: Marks what was found; a text's own such characters are replaced by ``?``.
MARK = ""
_E = r"[^*/]|\*+[^*/]|/+[^*/]"
_COMMENTS = [rf"/\*(?:{_E})*\*+/"]
for _ in range(3):
    _COMMENTS.append(rf"/\*(?:{_E}|/*(?:{_COMMENTS[-1]}))*\*+/")
#: Strings, characters and comments (block comments nested up to four deep, deeper ones to their first end).
LITERAL = "|".join([
    r"//[^\n]*", _COMMENTS[-1], r"/\*[\s\S]*?\*/", r"/\*[\s\S]*", r'\b[bc]?r"[^"]*"', *[rf'\b[bc]?r{"#" * n}"[\s\S]*?"{"#" * n}' for n in (1, 2, 3)],
    r'"(?:[^"\\]|\\[\s\S])*"', r"'(?:[^'\\\n]|\\(?:u\{[0-9a-fA-F_]*\}|x[0-9a-fA-F][0-9a-fA-F]|[^\n]))'",
])
ATTRIBUTE = r"#!?[ \t\r\n]*\[(?:[^\[\]]|\[(?:[^\[\]]|\[[^\[\]]*\])*\])*\]"
#: An attribute in the text as written, strings and all.
WRITTEN = r'#[ \t\r\n]*\[(?:[^\[\]"]|"(?:[^"\\]|\\[\s\S])*"|\[(?:[^\[\]"]|"(?:[^"\\]|\\[\s\S])*")*\])*\]'
_NAME = r"(?:r#)?[A-Za-z_][A-Za-z0-9_]*"
TOKEN = rf"\bfn[ \t\r\n]+{_NAME}|\b(?:struct|enum|union|trait)[ \t\r\n]+{_NAME}|\bimpl\b|\buse\b|\b[A-Za-z_][A-Za-z0-9_]*[ \t\r\n]*!|[()\[\]{{}};]"
BETWEEN = r"^[ \t\r\n]*([A-Za-z_][A-Za-z0-9_]*[ \t\r\n]*)?$"
QUALIFIERS = r"^(?:pub ?(?:\([^()]*\))?(?: |$))?(?:(?:default|const|async|unsafe|extern)(?: |$))*$"
RESERVED = ("as", "break", "const", "continue", "else", "enum", "extern", "fn", "for", "if", "impl", "in", "let", "loop", "match", "mod", "move", "mut", "pub", "ref", "return", "static", "struct", "trait", "type", "unsafe", "use", "where", "while", "async", "await", "dyn", "yield", "box")
_ANGLE = r"<(?:[^<>]|<(?:[^<>]|<[^<>]*>)*>)*>"
_ROUND = r"\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*\)"
_PATH = rf"(?:\.[ \t\r\n]*)?(?:{_NAME}[ \t\r\n]*::[ \t\r\n]*)*{_NAME}[ \t\r\n]*"
CALL = rf"{_PATH}(?:::[ \t\r\n]*{_ANGLE}[ \t\r\n]*)?\("
DOC = rf"(?m)^[ \t]*///((?:[^/\n][^\n]*)?)$|/\*\*([^*/](?:{_E})*)\*+/"


def _loops(pattern: str) -> str:
    """The pattern for Java: loops over groups that never give back, so that a long text needs no stack."""
    return pattern.replace(")*", ")*+")


def blanked(code: Column, pattern: str) -> Column:
    """``code`` with blanks for all that the pattern finds, line ends kept."""
    parts = F.split(F.regexp_replace(code, f"({_loops(pattern)})", f"{MARK}$1{MARK}"), MARK, -1)
    return F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 1, F.regexp_replace(x, "[^\n]", " ")).otherwise(x)), "")


def lexed(files: DataFrame) -> DataFrame:
    """``file_id, code, text``: the code as it is and with literals, comments and attributes blanked, written once."""
    rust = files.where("code is not null and endswith(file_path, '.rs')").select(F.col("file_id").cast("long").alias("file_id"), "code")
    return cut(rust.withColumn("text", blanked(blanked(F.replace("code", F.lit(MARK), F.lit("?")), LITERAL), ATTRIBUTE)))


def events(lex: DataFrame) -> DataFrame:
    """A row for each bracket, semicolon, keyword and macro name: ``file_id, k, tok, pos`` (from 0), ``line, level, zone`` (where what came before ends), ``close, close_line`` (of brackets), ``body`` (the next brace or semicolon of the level), ``macro``; written once."""
    parts = F.split(F.regexp_replace("text", f"({TOKEN})", f"{MARK}$1{MARK}"), MARK, -1)
    narrow = F.transform(parts, lambda x, i: F.struct(F.length(x).alias("n"), (F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))).alias("nl"), F.when(i % 2 == 1, x).alias("tok"), F.when(i % 2 == 0, F.when(x.rlike(BETWEEN), F.regexp_extract(x, BETWEEN, 1))).alias("gap")))
    each = lex.select("file_id", F.posexplode(narrow).alias("k", "p")).select("file_id", "k", "p.*")
    order = Window.partitionBy("file_id").orderBy("k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    depth = F.when(F.col("tok").isin("(", "[", "{"), 1).when(F.col("tok").isin(")", "]", "}"), -1).otherwise(0)
    placed = each.withColumns({
        "pos": F.coalesce(F.sum("n").over(before), F.lit(0)), "line": F.coalesce(F.sum("nl").over(before), F.lit(0)) + 1, "level": F.sum(F.least(depth, F.lit(0))).over(order) + F.coalesce(F.sum(F.greatest(depth, F.lit(0))).over(before), F.lit(0)),
        "next_gap": F.lead("gap").over(order), "next_tok": F.lead("tok", 2).over(order),
    }).where("tok is not null")
    name = F.rtrim(F.regexp_replace("tok", r"[ \t\r\n]*!$", ""))
    macro = F.when(F.col("tok").endswith("!") & F.col("next_tok").isin("(", "[", "{") & ~name.isin(*RESERVED) & ((name == "macro_rules") == (F.col("next_gap") != "")), F.when(name == "macro_rules", F.regexp_replace("next_gap", r"[ \t\r\n]+$", "")).otherwise(name))
    level = Window.partitionBy("file_id", "level")
    zoned = placed.withColumn("zone", F.coalesce(F.last(F.when(F.col("tok").isin("{", "}", ";"), F.col("pos") + 1), True).over(before), F.lit(0)))
    closed = zoned.withColumn("shut", F.when(F.col("tok").isin("(", "[", "{"), F.lead(F.struct("pos", "line")).over(level.orderBy("k"))))
    none = F.lit(None).cast("long")
    closed = closed.withColumn("body_of_use", F.struct("tok", "pos", none.alias("close"), none.alias("close_line")))
    ahead = level.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, -1)
    out = closed.withColumn("body", F.last(F.when(F.col("tok").isin("{", ";"), F.struct("tok", "pos", F.col("shut.pos").alias("close"), F.col("shut.line").alias("close_line"))), True).over(ahead))
    out = out.withColumn("body", F.when(F.col("tok") != "use", F.col("body")).otherwise(F.last(F.when(F.col("tok") == ";", F.col("body_of_use")), True).over(ahead))).drop("body_of_use")
    opened = out.withColumn("opened", F.last(F.when(F.col("tok").isin("(", "[", "{"), F.struct("pos", F.col("shut.pos").alias("close"))), True).over(ahead))
    return cut(opened.select("file_id", "k", "tok", "pos", "line", "level", "zone", "body", macro.alias("macro"), "opened", F.when(F.col("tok").startswith("macro_rules"), "definition").otherwise("call").alias("macro_kind")))


def read(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The blanked texts, their events and items."""
    lex = lexed(files)
    ev = events(lex)
    return lex, ev, items(lex, ev)


def macros(lex: DataFrame, ev: DataFrame) -> DataFrame:
    """Macro calls and definitions that lie in no other: ``file_id, name, kind, line, from, to, code``."""
    found = ev.where("macro is not null and opened.close is not null").select("file_id", F.col("macro").alias("name"), F.col("macro_kind").alias("kind"), "line", F.col("pos").alias("from"), (F.col("opened.close") + 1).alias("to"))
    reach = F.max("to").over(Window.partitionBy("file_id").orderBy("from").rowsBetween(Window.unboundedPreceding, -1))
    outer = found.withColumn("_r", reach).where("_r is null or `from` >= _r").drop("_r")
    return outer.join(lex, "file_id").select("file_id", "name", "kind", "line", "from", "to", F.expr("substring(code, `from` + 1, `to` - `from`)").alias("code"))


def items(lex: DataFrame, ev: DataFrame) -> DataFrame:
    """All items outside macros: ``file_id, kind, name, line, end_line, visibility, words`` (qualifiers), ``begin, pos, open, close, header, zone_text, code, body`` (``{`` or ``;``)."""
    kind = F.regexp_extract("tok", "^[a-z]+", 0)
    rows = ev.where(F.col("tok").rlike("^(fn|struct|enum|union|trait|impl|use)\\b") & F.col("macro").isNull()).where("body.tok = ';' or body.close is not null")
    rows = rows.select("file_id", kind.alias("kind"), F.regexp_replace("tok", r"^[a-z]+[ \t\r\n]*(?:r#)?", "").alias("name"), "line", "pos", "zone", F.col("body.tok").alias("body"), F.col("body.pos").alias("open"), F.coalesce("body.close", "body.pos").alias("close"), F.col("body.close_line").alias("end_line"))
    # a macro's range takes part as an event of the file: the furthest end so far tells whether a place lies within one
    spans = ev.where("macro is not null and opened.close is not null").select("file_id", "pos", (F.col("opened.close") + 1).alias("_to"))
    both = rows.withColumn("_to", F.lit(None).cast("long")).unionByName(spans, allowMissingColumns=True)
    reach = F.max("_to").over(Window.partitionBy("file_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    free = both.withColumn("_r", reach).where("kind is not null and (_r is null or pos >= _r)").drop("_r", "_to")
    gap = F.expr("substring(text, zone + 1, pos - zone)")
    words = F.trim(F.regexp_replace(gap, r"[ \t\r\n]+", " "))
    near = free.join(lex, "file_id").withColumns({"words": words, "begin": F.col("pos") - F.length(F.regexp_extract(gap, r"^[ \t\r\n]*([\s\S]*)$", 1))}).where(F.col("words").rlike(QUALIFIERS))
    lead = F.regexp_extract("words", r"^pub ?(?:\([^()]*\))?", 0)
    out = near.select(
        "file_id", "kind", F.nullif("name", F.lit("")).alias("name"), "line", F.coalesce("end_line", "line").alias("end_line"), F.when(lead == "", "private").otherwise(F.rtrim(lead)).alias("visibility"), "words", "begin", "pos", "open", "close", "body",
        F.trim(F.regexp_replace(F.expr("substring(text, pos + 1, open - pos)"), r"[ \t\r\n]+", " ")).alias("header"), F.expr("substring(code, zone + 1, pos - zone)").alias("zone_text"), F.expr("substring(code, pos + 1, close - pos + 1)").alias("code"), F.expr("substring(code, begin + 1, open - begin)").alias("signature"), F.expr("substring(code, begin + 1, close - begin + 1)").alias("full_text"),
    )
    return cut(out)


def docs(zone: str) -> Column:
    """Line and block documentation among what stands before an item, without marks; null without any."""
    said = F.transform(all_matches(F.replace(F.col(zone), F.lit(MARK), F.lit("?")), "(?d)" + _loops(DOC), (1, 2)), lambda m: F.concat(m[0], F.regexp_replace(m[1], r"(?md)^[ \t]*\*+", "")))
    return F.nullif(F.replace(F.array_join(said, "\n"), F.lit("\r"), F.lit("")), F.lit(""))


def attributes(zone: str) -> Column:
    """The attributes among what stands before an item, as written."""
    bare = F.regexp_replace(F.replace(F.col(zone), F.lit(MARK), F.lit("?")), _loops(r'("(?:[^"\\]|\\[\s\S])*")|//[^\n]*|' + _COMMENTS[1]), "$1")
    return F.transform(all_matches(bare, _loops(WRITTEN), (0,)), lambda m: m[0])


def impl_parts() -> dict[str, Column]:
    """Generics, trait, type and where clause of an impl's header."""
    plain = F.replace("header", F.lit("->"), F.lit("  "))
    generics = F.regexp_extract(plain, rf"^impl ?({_loops(_ANGLE)})", 1)
    rest = F.trim(F.expr("substring(header, 5)").substr(F.length(F.regexp_extract(plain, rf"^impl ?({_loops(_ANGLE)})?", 0)) - 3, F.length("header")))
    named, where = F.trim(F.regexp_replace(rest, r"\bwhere\b[\s\S]*$", "")), F.trim(F.regexp_extract(rest, r"\bwhere\b([\s\S]*)$", 1))
    is_for = named.rlike(r" for [^<]")
    return {"generics": generics, "trait_name": F.when(is_for, F.trim(F.regexp_extract(named, r"^([\s\S]*?) for [^<]", 1))), "for_type": F.when(is_for, F.trim(F.regexp_extract(named, r"^[\s\S]*? for ([^<][\s\S]*)$", 1))).otherwise(named), "where_clause": F.nullif(where, F.lit(""))}


def impls(found: DataFrame) -> DataFrame:
    """``file_id, line, trait_name, for_type, generics, where_clause, open, close``."""
    return found.where("kind = 'impl' and body = '{'").withColumns(impl_parts()).select("file_id", "line", "trait_name", "for_type", "generics", "where_clause", "open", "close")


def with_methods(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Adds the names of the functions that lie within a row's braces, in order."""
    own = found.where("kind = 'fn'").select("file_id", F.col("name").alias("_fn"), F.col("pos").alias("_at"))
    named = rows.select("file_id", "open", "close").join(own, "file_id").where("_at > open and _at < close").groupBy("file_id", "open").agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_fn"))), lambda x: x["_fn"]).alias("methods"))
    return rows.join(named, ["file_id", "open"], "left").withColumn("methods", F.coalesce("methods", F.array().cast("array<string>")))


def functions(found: DataFrame) -> DataFrame:
    """Functions with a body: places, signature and its parts, documentation, attributes, and the impl they belong to."""
    fns = found.where("kind = 'fn' and body = '{'")
    around = impls(found).select("file_id", F.col("open").alias("_o"), F.col("close").alias("_c"), "trait_name", "for_type")
    inner = fns.select("file_id", "pos").join(around, "file_id").where("pos > _o and pos < _c").groupBy("file_id", "pos").agg(F.max_by(F.struct("trait_name", "for_type"), "_o").alias("_impl"))
    plain = F.replace("header", F.lit("->"), F.lit("\u0001\u0001"))
    head = F.regexp_extract(plain, rf"^fn [^ (<]+ ?({_loops(_ANGLE)})?", 0)
    params = F.regexp_extract(plain.substr(F.length(head) + 1, F.length("header")), rf"^ ?({_loops(_ROUND)})", 1)
    tail = plain.substr(F.length(head) + F.length(F.regexp_extract(plain.substr(F.length(head) + 1, F.length("header")), rf"^ ?({_loops(_ROUND)})", 0)) + 1, F.length("header"))
    back = lambda c: F.nullif(F.trim(F.replace(c, F.lit("\u0001\u0001"), F.lit("->"))), F.lit(""))
    has = lambda word: F.array_contains(F.split("words", " "), word)
    return fns.join(inner, ["file_id", "pos"], "left").select(
        "file_id", F.col("line").alias("start_line"), "end_line", "name", F.regexp_replace("signature", r"[ \t\r\n]+$", "").alias("signature"), "visibility", "full_text", docs("zone_text").alias("doc_comments"), has("async").alias("is_async"), has("unsafe").alias("is_unsafe"), has("const").alias("is_const"),
        (F.col("visibility") == "pub").alias("is_pub"), back(F.regexp_extract(plain, rf"^fn [^ (<]+ ?({_loops(_ANGLE)})", 1)).alias("generics"), back(params).alias("params"), back(F.regexp_extract(tail, r"^ ?\x01\x01([\s\S]*?)(?: where [\s\S]*)?$", 1)).alias("return_type"), back(F.regexp_extract(tail, r"(?: |^)where ([\s\S]*)$", 1)).alias("where_clause"),
        F.array_join(attributes("zone_text"), "\n").alias("attributes"), F.col("_impl.trait_name").alias("trait_name"), F.col("_impl.for_type").alias("for_type"), "open", "close",
    )


def traits(found: DataFrame) -> DataFrame:
    """``file_id, line, name, visibility, super_traits, generics, associated_types, methods, doc``."""
    rows = found.where("kind = 'trait' and body = '{'")
    rest = F.regexp_replace(F.replace("header", F.lit("->"), F.lit("  ")), r"^trait (?:r#)?[A-Za-z0-9_]+ ?", "")
    generics = F.regexp_extract(rest, rf"^({_loops(_ANGLE)})", 1)
    bounds = F.regexp_extract(rest.substr(F.length(generics) + 1, F.length("header")), r"^ ?: ?([\s\S]*?)(?: where [\s\S]*)?$", 1)
    types = F.transform(all_matches(F.replace("code", F.lit(MARK), F.lit("?")), r"(?:^|[\n;{}])[ \t\r]*type[ \t]+([A-Za-z_][A-Za-z0-9_]*)"), lambda m: m[0])
    return with_methods(rows.select("file_id", "line", "name", "visibility", F.trim(bounds).alias("super_traits"), generics.alias("generics"), F.array_join(types, ", ").alias("associated_types"), docs("zone_text").alias("doc"), "open", "close"), found).drop("close")


def imports(found: DataFrame) -> DataFrame:
    """``file_id, line, raw, is_pub, path`` of use items."""
    return found.where("kind = 'use'").select("file_id", "line", F.regexp_replace("code", r"[ \t\r\n]+", " ").alias("raw"), (F.col("visibility") == "pub").alias("is_pub"), F.trim(F.expr("substring(header, 4)")).alias("path"))


def types(found: DataFrame) -> DataFrame:
    """``file_id, kind, name, line, visibility, derives, serde_attrs, attributes, code`` of structs, enums and unions."""
    rows = found.where("kind in ('struct', 'enum', 'union')").withColumn("attributes", attributes("zone_text"))
    inside = lambda name: F.transform(F.filter("attributes", lambda a: a.rlike(rf"^#[ \t\r\n]*\[[ \t\r\n]*{name}[ \t\r\n]*\(")), lambda a: F.trim(F.regexp_replace(F.regexp_extract(a, r"\(([\s\S]*)\)[ \t\r\n]*\]$", 1), r"[ \t\r\n]+", " ")))
    derives = F.filter(F.transform(F.flatten(F.transform(inside("derive"), lambda a: F.split(a, ","))), lambda d: F.trim(d)), lambda d: d != "")
    return rows.select("file_id", "kind", "name", "line", "visibility", derives.alias("derives"), inside("serde").alias("serde_attrs"), "attributes", "code")


def calls(lex: DataFrame, ev: DataFrame, found: DataFrame) -> DataFrame:
    """Calls within functions and outside macros: ``file_id, caller_name, caller_line, callee_name, qualified, call_kind, call_line, pos``."""
    parts = F.split(F.regexp_replace("text", f"({_PATH}{_loops(CALL[len(_PATH):])})", f"{MARK}$1{MARK}"), MARK, -1)
    lines = lambda x: F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))
    end = r"[A-Za-z_][A-Za-z0-9_]*[ \t\r\n]*(?:::[ \t\r\n]*" + _loops(_ANGLE) + r"[ \t\r\n]*)?\($"
    lead = lambda x: F.regexp_extract(x, rf"^([\s\S]*?)(?:r#)?{end}", 1)
    narrow = F.transform(parts, lambda x, i: F.struct(F.length(x).alias("n"), lines(x).alias("nl"), F.when(i % 2 == 1, x).alias("tok"), F.when(i % 2 == 0, x.rlike(r"(?:^|[^A-Za-z0-9_])fn[ \t\r\n]+$")).alias("is_fn")))
    each = lex.select("file_id", F.posexplode(narrow).alias("k", "p")).select("file_id", "k", "p.*")
    order = Window.partitionBy("file_id").orderBy("k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = each.withColumns({"pos": F.coalesce(F.sum("n").over(before), F.lit(0)), "line": F.coalesce(F.sum("nl").over(before), F.lit(0)) + 1, "_fn": F.lag("is_fn").over(order)}).where("tok is not null and not coalesce(_fn, false)")
    name = F.regexp_extract("tok", r"([A-Za-z_][A-Za-z0-9_]*)[ \t\r\n]*(?:::[ \t\r\n]*" + _loops(_ANGLE) + r"[ \t\r\n]*)?\($", 1)
    path = F.regexp_replace(F.regexp_replace(lead(F.col("tok")), r"[ \t\r\n]", ""), r"^\.", "")
    named = placed.withColumns({"callee_name": name, "path": path, "call_kind": F.when(F.col("tok").startswith("."), "method").when(path != "", "scoped").otherwise("direct")}).where(~F.col("callee_name").isin(*RESERVED))
    spans = ev.where("macro is not null and opened.close is not null").select("file_id", "pos", (F.col("opened.close") + 1).alias("_to"))
    both = named.withColumn("_to", F.lit(None).cast("long")).unionByName(spans, allowMissingColumns=True)
    free = both.withColumn("_r", F.max("_to").over(Window.partitionBy("file_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))).where("tok is not null and (_r is null or pos >= _r)")
    fns = found.where("kind = 'fn' and body = '{'").select("file_id", F.col("name").alias("caller_name"), F.col("line").alias("caller_line"), "open", "close")
    inside = free.join(fns, "file_id").where("pos > open and pos < close")
    return inside.select("file_id", "caller_name", "caller_line", "callee_name", F.when(F.col("path") != "", F.concat("path", "callee_name")).alias("qualified"), "call_kind", (F.col("line") + lines(lead(F.col("tok")))).alias("call_line"), "pos")


def attributed_enums(found: DataFrame, mark: str) -> DataFrame:
    """Enums with an attribute that holds ``mark``: ``file_id, name, line, attribute`` (those attributes), ``storage_type`` as their attributes name it, null if none does."""
    rows = found.where("kind = 'enum'").withColumn("_a", attributes("zone_text"))
    with_it = rows.withColumn("attribute", F.array_join(F.filter("_a", lambda a: a.contains(mark)), "\n")).where("attribute <> ''")
    named = F.regexp_extract(F.array_join("_a", "\n"), r'storage_type[ \t\r\n]*=[ \t\r\n]*"([^"]*)"', 1)
    return with_it.select("file_id", "name", "line", "attribute", F.nullif(named, F.lit("")).alias("storage_type"))
