"""Training samples as text, rendered by column expressions.

Lines whose value is missing are left out; a missing mandatory value makes the
whole text null. Lists are cut to a fixed length before they are gathered, so a
function that most calls name brings no unbounded list into a row. Groups are
checked against a size range before their texts are gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import text as T
from tessella.functions.paths import language_of
from tessella.operators import extract, graph, rust_facts, stats

REPOSITORY = "corpus"
SHOWN = 10


def lines(*parts: Column) -> Column:
    """The parts that aren't null, one per line."""
    return F.array_join(F.array_compact(F.array(*parts)), "\n")


def when_text(label: str, value: Column) -> Column:
    """``label`` and the value, null if that is null or empty."""
    return F.when(value != "", F.concat(F.lit(label), value))


def functions_once(functions: DataFrame) -> DataFrame:
    columns = ["file_id", "start_line", "name", "signature", "visibility", "full_text", "crate", "module", "file_path", "is_pub", "is_async"]
    return functions.select(*columns, F.col("impl_context.trait_name").alias("trait_name"), F.col("impl_context.for_type").alias("for_type"), F.col("impl_context").isNotNull().alias("in_impl")).distinct()


def with_context(functions: DataFrame, crates: DataFrame, repository: str = REPOSITORY) -> DataFrame:
    """Adds ``context``: repository, crate with purpose and dependencies, module, function, visibility, impl."""
    known = crates.select(F.col("name").alias("crate"), F.coalesce("purpose", F.lit("")).alias("purpose"), F.coalesce(F.array_join("local_deps", ", "), F.lit("")).alias("deps"))
    rows = functions.join(known, "crate", "left")
    impl = F.when(F.col("in_impl") & F.col("trait_name").isNotNull(), F.concat(F.lit("// IMPL: "), "trait_name", F.lit(" for "), "for_type")).when(F.col("in_impl"), F.concat(F.lit("// IMPL: "), "for_type"))
    context = lines(
        F.lit(f"// REPO: {repository}"), F.concat(F.lit("// CRATE: "), "crate"), when_text("// CRATE_PURPOSE: ", F.col("purpose")), when_text("// CRATE_DEPS: ", F.col("deps")), F.concat(F.lit("// MODULE: "), "module"), F.concat(F.lit("// FUNCTION: "), "name"),
        F.when(F.col("visibility") != "private", F.concat(F.lit("// VISIBILITY: "), "visibility")), impl,
    )
    return rows.withColumn("context", context).drop("purpose", "deps")


def clm() -> Column:
    return F.concat("context", F.lit("\n\n"), "full_text")


def fim(body: Column, strip_braces: bool = False) -> Column:
    """Fill-in-the-middle text; the body keeps its own braces unless ``strip_braces``."""
    middle = T.strip(F.regexp_replace(body, r"\A\{|\}\z", "")) if strip_braces else T.strip(body)
    return F.concat(F.lit("<fim_prefix>"), "context", F.lit("\n\n"), "signature", F.lit(" {<fim_suffix>\n}<fim_middle>"), middle, F.lit("<|endoftext|>"))


def _first(edges: DataFrame, key: list[str], order: list[str], shown: int = SHOWN) -> DataFrame:
    """``key``, the first rows of each group as an array ``first`` of structs, and ``n`` rows in all."""
    counts = edges.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    few = stats.top_k_per_group(edges, key, [F.asc(c) for c in order], shown)
    rest = [c for c in edges.columns if c not in key]
    return few.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("k", *rest))).alias("first")).join(counts, key)


def _made(edges: DataFrame) -> DataFrame:
    """The edges by the function that makes the call."""
    return edges.select(F.col("caller_file_id").alias("file_id"), F.col("caller_line").alias("start_line"), "call_line", "callee_name", "call_kind")


def _with_callers(functions: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds the first functions that call a function's name, and their number."""
    places = functions.groupBy("file_id", "start_line").agg(F.min("name").alias("caller"), F.min("file_path").alias("caller_path"))
    named = edges.select(F.col("callee_name").alias("name"), F.col("caller_file_id").alias("file_id"), F.col("caller_line").alias("start_line"), "call_line").join(places, ["file_id", "start_line"])
    into = _first(named.select("name", F.col("file_id").alias("from_file"), F.col("call_line").alias("from_line"), "caller", "caller_path"), ["name"], ["from_file", "from_line", "caller"])
    return functions.join(into.withColumnsRenamed({"first": "callers", "n": "n_callers"}), "name", "left").fillna(0, ["n_callers"])


def _with_calls(functions: DataFrame, calls: DataFrame) -> DataFrame:
    """Adds the first calls a function makes and the first functions that call its name, with both counts."""
    edges = graph.structural_calls(calls)
    out = _first(_made(edges), ["file_id", "start_line"], ["call_line", "callee_name", "call_kind"])
    return _with_callers(functions, edges).join(out.withColumnsRenamed({"first": "calls", "n": "n_calls"}), ["file_id", "start_line"], "left").fillna(0, ["n_calls"])


def graph_samples(functions: DataFrame, calls: DataFrame) -> DataFrame:
    """Function texts headed by what they call and who calls them."""
    rows = _with_calls(functions, calls)
    out = F.array_join(F.transform("calls", lambda c: F.concat(F.lit("  ├─→ "), c["callee_name"], F.lit(" (line "), c["call_line"].cast("string"), F.lit(")"))), "\n")
    into = F.array_join(F.transform("callers", lambda c: F.concat(F.lit("  ←─┤ "), c["caller"], F.lit(" ("), c["caller_path"], F.lit(":"), c["from_line"].cast("string"), F.lit(")"))), "\n")
    head = lines(F.lit("[CALL_GRAPH]"), F.concat("name", F.lit(" ("), "file_path", F.lit(":"), F.col("start_line").cast("string"), F.lit(")")), out, F.concat(F.lit("\n[CALLED_BY]\n"), into))
    return rows.withColumn("content", F.concat(head, F.lit("\n\n"), "context", F.lit("\n\n"), "full_text"))


def _branches(items: Column, total: Column, arrow: str, text, what: str) -> Column:
    drawn = F.transform(items, lambda c, i: F.concat(F.when(i == total - 1, F.lit("└─" + arrow)).otherwise(F.lit("├─" + arrow)), F.lit(" "), text(c)))
    more = F.when(total > SHOWN, F.concat(F.lit("\n    ... and "), (total - SHOWN).cast("string"), F.lit(f" more {what}"))).otherwise("")
    return F.concat(F.array_join(drawn, "\n"), more)


def call_trees(functions: DataFrame, calls: DataFrame) -> DataFrame:
    """``file_id, start_line, name, tree``: callees and callers as a drawn tree, ten of each."""
    rows = _with_calls(functions, calls)
    out = _branches(F.col("calls"), F.col("n_calls"), "→", lambda c: F.concat(c["callee_name"], F.lit(" ("), c["call_kind"], F.lit(", line "), c["call_line"].cast("string"), F.lit(")")), "calls")
    into = _branches(F.col("callers"), F.col("n_callers"), "←", lambda c: F.concat(c["caller"], F.lit(" ("), c["caller_path"], F.lit(":"), c["from_line"].cast("string"), F.lit(")")), "callers")
    return rows.select("file_id", "start_line", "name", lines(F.col("name"), F.concat(F.lit("\nCalls:\n"), out), F.concat(F.lit("\nCalled by:\n"), into)).alias("tree"))


def _some(names: Column, total: Column, shown: int) -> Column:
    more = F.when(total > shown, F.concat(F.lit(", and "), (total - shown).cast("string"), F.lit(" others"))).otherwise("")
    return F.when(total > 0, F.concat(F.array_join(F.slice(names, 1, shown), ", "), more))


def flow_sentences(functions: DataFrame, calls: DataFrame) -> DataFrame:
    """``file_id, start_line, name, sentence``: what a function is, calls (the first five direct and method calls of all, with the number of others), and is called by."""
    edges = graph.structural_calls(calls)
    by_kind = _first(_made(edges.where(F.col("call_kind").isin("direct", "method"))), ["file_id", "start_line", "call_kind"], ["call_line", "callee_name"], 5)
    of = lambda k: F.max(F.when(F.col("call_kind") == k, _some(F.transform("first", lambda c: c["callee_name"]), F.col("n"), 5)))
    made = by_kind.groupBy("file_id", "start_line").agg(of("direct").alias("direct"), of("method").alias("method"))
    rows = _with_callers(functions, edges).join(made, ["file_id", "start_line"], "left")
    kind = F.when(F.col("is_async"), F.lit("async function")).otherwise(F.lit("function"))
    where = F.when(F.col("in_impl") & F.col("trait_name").isNotNull(), F.concat(F.lit(" implementing "), "trait_name", F.lit(" for "), "for_type")).when(F.col("in_impl"), F.concat(F.lit(" defined in the implementation of "), "for_type")).otherwise("")
    does = F.nullif(F.concat_ws(" and ", F.concat(F.lit("calls "), "direct"), F.concat(F.lit("invokes methods "), "method")), F.lit(""))
    callers = _some(F.transform("callers", lambda c: c["caller"]), F.col("n_callers"), 3)
    sentence = F.concat_ws(" ", F.concat("name", F.lit(" is a "), "visibility", F.lit(" "), kind, where, F.lit(".")), F.concat(F.lit("It "), does, F.lit(".")), F.concat(F.lit("This function is called by "), callers, F.lit(".")))
    return rows.select("file_id", "start_line", "name", sentence.alias("sentence"))


def call_data(functions: DataFrame, calls: DataFrame) -> DataFrame:
    """Of each function all calls it makes, the first ten functions that call its name, both numbers, tree and sentence: ``file_id, file_path, start_line, name, calls, called_by, n_calls, n_callers, tree, sentence``."""
    key = ["file_id", "start_line", "name"]
    edges = graph.structural_calls(calls)
    made = _made(edges).groupBy("file_id", "start_line").agg(F.sort_array(F.collect_list(F.struct("call_line", "callee_name", "call_kind"))).alias("calls"))
    rows = _with_callers(functions, edges).join(made, ["file_id", "start_line"], "left")
    n_calls = F.coalesce(F.size("calls"), F.lit(0)).cast("long")
    told = rows.select(*key, "file_path", "calls", F.transform("callers", lambda c: F.struct(c["caller"].alias("name"), c["caller_path"].alias("file_path"), c["from_line"].alias("line"))).alias("called_by"), F.greatest(n_calls, F.lit(0)).alias("n_calls"), "n_callers")
    return told.distinct().join(call_trees(functions, calls).distinct(), key).join(flow_sentences(functions, calls).distinct(), key)


def _crate_lines(crates: DataFrame) -> DataFrame:
    by = graph.crate_edges(crates).groupBy(F.col("dst").alias("name")).agg(F.array_join(F.sort_array(F.collect_set("src")), ", ").alias("_by"))
    header = lines(F.concat(F.lit("// CRATE: "), "name"), when_text("// PURPOSE: ", F.col("purpose")), when_text("// DEPENDS_ON: ", F.array_join("local_deps", ", ")), F.concat(F.lit("// DEPENDED_BY: "), "_by"))
    return crates.join(by, "name", "left").select(F.col("name").alias("crate"), header.alias("header"))


def crate_headers(crates: DataFrame) -> DataFrame:
    return _crate_lines(crates)


def crate_cards(crates: DataFrame, files: DataFrame, shown: int = 20) -> DataFrame:
    """Crate headers with the first public names in order: ``crate, content``."""
    items = rust_facts.read(files)[2]
    of = files.select("file_id", "crate")

    def names(kind: str, label: str) -> DataFrame:
        once = items.where(F.col("kind") == kind).select("file_id", "name").join(of, "file_id").select("crate", "name").distinct()
        few = stats.top_k_per_group(once, ["crate"], [F.asc("name")], shown)
        return few.groupBy("crate").agg(F.concat(F.lit(f"\n{label}: "), F.array_join(F.sort_array(F.collect_list("name")), ", ")).alias(label))

    rows = _crate_lines(crates).join(names("struct", "Structs"), "crate", "left").join(names("trait", "Traits"), "crate", "left")
    return rows.select("crate", lines(F.col("header"), F.lit("\n## Public API"), F.col("Structs"), F.col("Traits")).alias("content"))


def repository_card(crates: DataFrame) -> DataFrame:
    """One row: all crates in order with purpose and dependencies. A crate list is short; this is its report."""
    deps = graph.crate_edges(crates).groupBy(F.col("src").alias("name")).agg(F.array_join(F.sort_array(F.collect_set("dst")), ", ").alias("_deps"))
    entry = F.concat("name", F.lit("/"), F.coalesce(when_text("\n  Purpose: ", F.col("purpose")), F.lit("")), F.coalesce(F.concat(F.lit("\n  Depends on: "), "_deps"), F.lit("")))
    rows = crates.join(deps, "name", "left").select("name", entry.alias("_e"))
    return rows.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("name", "_e"))), lambda x: x["_e"]), "\n\n").alias("content"), F.count(F.lit(1)).alias("n_crates"))


def module_cards(files: DataFrame, modules: int | None = 100) -> DataFrame:
    """The first modules by order that have types: names, imports and the number of functions."""
    items = rust_facts.read(files)[2]
    placed = lambda kind, *columns: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("line", *columns))))
    facts = items.groupBy("file_id").agg(placed("struct", "name").alias("structs"), placed("enum", "name").alias("enums"), placed("union", "name").alias("unions"), F.count_if(F.expr("kind = 'fn' and body = '{'")).alias("n"), F.count_if(F.expr("kind in ('struct', 'enum', 'union')")).alias("n_types"))
    raw = rust_facts.imports(items).groupBy("file_id").agg(F.sort_array(F.collect_list(F.struct("line", "raw"))).alias("imports"))
    rows = facts.where("n_types > 0").join(raw, "file_id", "left").join(files.select("file_id", "crate", "module", "seq"), "file_id")
    of = lambda kind: F.array_join(F.slice(F.transform(kind, lambda t: t["name"]), 1, 20), ", ")
    uses = F.array_join(F.transform(F.slice(F.coalesce("imports", F.array().cast("array<struct<line: bigint, raw: string>>")), 1, SHOWN), lambda i: F.concat(F.lit("// "), i["raw"])), "\n")
    content = lines(
        F.concat(F.lit("// MODULE: "), F.coalesce("module", F.lit(""))), F.concat(F.lit("// CRATE: "), F.coalesce("crate", F.lit(""))), F.concat(F.lit("\n// Structs: "), of("structs")), F.concat(F.lit("// Enums: "), of("enums")),
        F.concat(F.lit("// Functions: "), F.col("n").cast("string")), F.concat(F.lit("\n// Imports:\n"), uses),
    )
    out = rows.select("seq", "file_id", "crate", "module", content.alias("content")).orderBy("seq", "file_id")
    return out.limit(modules) if modules else out


def trait_cards(files: DataFrame) -> DataFrame:
    """Traits with their first implementors and method stubs."""
    items = rust_facts.read(files)[2]
    traits = rust_facts.traits(items).join(files.select("file_id", "crate", "module"), "file_id")
    bare = F.regexp_replace("trait_name", r"<[\s\S]*", "")
    impls = rust_facts.impls(items).where("trait_name is not null").select(F.regexp_extract(bare, r"(\w+)\z", 1).alias("name"), "file_id", "for_type").distinct()
    first = _first(impls, ["name"], ["file_id", "for_type"]).select("name", F.array_join(F.transform("first", lambda x: x["for_type"]), ", ").alias("_types"))
    rows = traits.join(first, "name", "left")
    stubs = F.array_join(F.transform("methods", lambda m: F.concat(F.lit("    fn "), m, F.lit("(...);"))), "\n")
    content = lines(
        F.concat(F.lit("// TRAIT: "), "name"), F.concat(F.lit("// CRATE: "), F.coalesce("crate", F.lit(""))), F.concat(F.lit("// MODULE: "), F.coalesce("module", F.lit(""))), when_text("// SUPER_TRAITS: ", F.array_join(F.split("super_traits", r" ?\+ ?"), ", ")), F.concat(F.lit("// IMPLEMENTATIONS: "), "_types"),
        when_text("\n", T.strip("doc")), F.concat(F.lit("\npub trait "), "name", F.lit(" {")), F.nullif(stubs, F.lit("")), F.lit("}"),
    )
    return rows.select("file_id", "line", "name", content.alias("content"))


def trait_pattern_cards(functions: DataFrame, mark: str) -> DataFrame:
    """Implementations of traits whose name holds ``mark``."""
    rows = functions.where(F.col("impl_context.trait_name").contains(mark)).select("file_id", "crate", F.col("impl_context.trait_name").alias("trait_name"), F.col("impl_context.for_type").alias("for_type")).distinct()
    content = F.concat(F.lit("// PATTERN: connector_integration\n// TRAIT: "), "trait_name", F.lit("\n// FOR_TYPE: "), "for_type", F.lit("\n// CRATE: "), "crate")
    return rows.select("file_id", "for_type", content.alias("content")).distinct()


def instruction_rows(crates: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(c, F.lit(""))
    return crates.select(F.col("name").alias("crate"), F.concat(F.lit("Describe the crate "), "name", F.lit(" and what it depends on.")).alias("instruction"), text(F.array_join("local_deps", ", ")).alias("input"), text(F.col("purpose")).alias("output"))


def tagged(header: list[Column], tag: str, body: Column, repository: str = REPOSITORY) -> Column:
    """A path header and the body in a tag."""
    return F.concat(F.lit(f"<path>\nRepository: {repository}\n"), F.concat_ws("\n", *header), F.lit(f"\n</path>\n\n<{tag}>\n"), body, F.lit(f"\n</{tag}>\n"))


def tagged_files(files: DataFrame) -> DataFrame:
    header = [F.concat(F.lit("Crate: "), "crate"), F.concat(F.lit("File: "), "file_path"), F.concat(F.lit("Size: "), F.length("code").cast("string"), F.lit(" characters"))]
    return files.select("file_id", tagged(header, "file", F.col("code")).alias("content"))


def combined_groups(files: DataFrame, by: str, least: int, most: int) -> DataFrame:
    """Groups of files whose tokens come to between ``least`` and ``most``, with all their texts: the bound holds before texts are gathered."""
    sized = files.withColumn("_t", T.token_count("code"))
    fit = sized.groupBy(by).agg(F.sum("_t").alias("n_tokens"), F.count(F.lit(1)).alias("n_files")).where(F.col("n_tokens").between(least, most))
    section = F.concat(F.lit("// File: "), "file_path", F.lit("\n\n"), "code")
    body = stats.group_concat(sized.join(fit.select(by), by, "left_semi").select(by, "seq", "file_id", section.alias("section")), by, ["seq", "file_id"], "section", "\n\n")
    header = [F.concat(F.lit(by.capitalize() + ": "), by), F.concat(F.lit("Files: "), F.col("n_files").cast("string"))]
    return fit.join(body, by).select(by, "n_files", "n_tokens", tagged(header, by, F.col("text")).alias("content"))


def header_comment(path: Column, module: Column, code: Column) -> Column:
    return F.concat(F.lit("// File: "), path, F.lit("\n// Module: "), module, F.lit("\n\n"), code)


def item_comments(files: DataFrame) -> DataFrame:
    """Items found line by line, each headed by what it is and where, with its tokens."""
    rows = extract.facts(files, "line_items").join(files.select("file_id", "file_path", "module"), "file_id")
    title = F.concat(F.lit("// "), F.initcap("kind"), F.lit(": "), "name", F.coalesce(F.concat(F.lit(" ("), "trait_name", F.lit(")")), F.lit("")))
    count = F.when(F.col("kind") == "struct", F.concat(F.lit("// Impls: "), F.col("count").cast("string"))).when(F.col("kind") == "impl", F.concat(F.lit("// Methods: "), F.col("count").cast("string")))
    text = lines(title, F.concat(F.lit("// File: "), "file_path"), F.concat(F.lit("// Module: "), F.coalesce("module", F.lit(""))), count, when_text("// Doc: ", F.col("doc")), F.concat(F.lit("\n"), "code"))
    return rows.select("file_id", "kind", "name", "line", text.alias("text")).withColumn("n_tokens", T.token_count("text"))


def documentation_tags(chunks: DataFrame, snippets: DataFrame, layout: str = "interleaved") -> DataFrame:
    """Chunks as prose, fenced code and referenced source lines, each in its tag: ``chunk_id, part, text, source``.

    ``interleaved``: one text of a chunk, prose, blocks and snippets in this order.
    ``separate``: two texts, the prose (part 0) and all code (part 1). ``pairs``: a
    text for each block or snippet, the prose before it. Chunks without prose give code
    alone, those with neither no text; null contents count as empty.
    """
    code = F.concat(F.lit('<code language="'), language_of(F.col("file_path")), F.lit('" source="'), "file_path", F.lit('">\n'), "code", F.lit("\n</code>"))
    found = snippets.where("code <> ''").select("chunk_id", "file_path", "start_line", code.alias("_x")).distinct()
    sources = found.groupBy("chunk_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("file_path", "start_line", "_x"))), lambda x: x["_x"]).alias("_s"))
    prose = F.array_compact(F.array(F.when(T.without_code_blocks("content") != "", F.concat(F.lit("<doc>\n"), T.without_code_blocks("content"), F.lit("\n</doc>")))))
    inline = F.transform(T.code_blocks("content"), lambda b: F.concat(F.lit('<code language="'), b["language"], F.lit('">\n'), b["code"], F.lit("\n</code>")))
    none = F.array().cast("array<string>")
    codes = F.concat(F.coalesce(inline, none), F.coalesce("_s", none))
    rows = chunks.join(sources, "chunk_id", "left").select("chunk_id", prose.alias("_d"), codes.alias("_c"))
    join = lambda x: F.array_join(x, "\n\n")
    texts = {"interleaved": F.array(join(F.concat("_d", "_c"))), "separate": F.array(join("_d"), join("_c")), "pairs": F.transform("_c", lambda c: join(F.concat("_d", F.array(c))))}[layout]
    each = rows.select("chunk_id", F.posexplode(texts).alias("part", "text"))
    return (each if layout == "interleaved" else each.where("text <> ''")).select("chunk_id", "part", "text", F.lit("documentation").alias("source"))


def code_tags(files: DataFrame) -> DataFrame:
    text = F.concat(F.lit('<code language="rust" source="'), "file_path", F.lit('">\n'), "code", F.lit("\n</code>"))
    return files.select("file_id", text.alias("text"), F.lit("code").alias("source"), F.col("file_path").alias("id"))

