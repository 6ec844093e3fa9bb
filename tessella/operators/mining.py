"""Pattern miners and cards: what is frequent in a code base, with examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.operators import extract, render, rust_facts, stats
from tessella.spark_util import cut

TOP = 50
EXAMPLES = 10


def derive_sets(types: DataFrame) -> DataFrame:
    """Sets of derives and serde arguments by frequency: ``kind, value, n, examples``; types without either aren't counted."""
    once = cut(types.select("file_id", "line", "name", F.array_join(F.array_sort("derives"), ", ").alias("derive_set"), "serde_attrs").distinct())
    order, example, first = F.struct("file_id", "line"), F.concat_ws(":", "file_id", "name"), F.col("file_id")
    sets = stats.top_with_examples(once.where("derive_set <> ''"), "derive_set", order, example, first, TOP, EXAMPLES).select(F.lit("derives").alias("kind"), "*")
    attrs = once.select("file_id", "line", "name", F.explode("serde_attrs").alias("attr"))
    return sets.unionByName(stats.top_with_examples(attrs, "attr", order, example, first, TOP, EXAMPLES).select(F.lit("serde").alias("kind"), "*"))


def frequent_macros(macros: DataFrame) -> DataFrame:
    """The macros called most often, with their first calls."""
    calls = cut(macros.where("kind = 'call'").select("file_id", "name", "line").distinct())
    return stats.top_with_examples(calls, "name", F.struct("file_id", "line"), F.concat_ws(":", "file_id", "line"), F.col("file_id"), TOP, EXAMPLES)


def crate_analysis(files: DataFrame) -> DataFrame:
    """Counts of all facts per crate; the files are read once."""
    lex, ev, items = rust_facts.read(files)
    facts = items.where("body = '{' or kind in ('use', 'struct')").select("file_id", F.when(F.col("kind").isin("struct", "enum", "union"), "type").otherwise(F.col("kind")).alias("kind"), (F.col("visibility") == "pub").alias("is_pub"))
    facts = facts.unionByName(rust_facts.macros(lex, ev).select("file_id", F.lit("macro").alias("kind"), F.lit(False).alias("is_pub"))).unionByName(rust_facts.calls(lex, ev, items).select("file_id", F.lit("call").alias("kind"), F.lit(False).alias("is_pub")))
    per_file = facts.groupBy("file_id").agg(*[F.count_if(F.col("kind") == k).alias(f"{k}s") for k in ("type", "trait", "impl", "use", "macro", "call")], F.count_if(F.expr("kind = 'fn'")).alias("functions"), F.count_if(F.expr("kind = 'fn' and is_pub")).alias("public_functions"))
    rust = files.where("code is not null and endswith(file_path, '.rs')").select("file_id", "crate")
    counted = [c for c in per_file.columns if c != "file_id"]
    return rust.join(per_file, "file_id", "left").groupBy("crate").agg(F.count(F.lit(1)).alias("files"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted])


def _card(kind: str, key, *parts) -> list:
    return [F.lit(kind).alias("pattern"), key.cast("string").alias("key"), F.concat_ws("\n", F.lit(f"// PATTERN: {kind}"), *parts).alias("content")]


def _said(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"// {label}: "), F.coalesce(value.cast("string"), F.lit("")))


def pattern_cards(files: DataFrame, functions: DataFrame) -> DataFrame:
    """One card per mined pattern, all kinds in one table: ``pattern, key, content``."""
    lex, ev, items = rust_facts.read(files)
    each = {"types": rust_facts.types(items), "macros": rust_facts.macros(lex, ev), "impls": rust_facts.impls(items)}.__getitem__
    sets = derive_sets(each("types"))
    once = functions.select("file_id", "start_line", "name", "crate", "signature", "return_type", "is_async", "is_pub").distinct()
    key = F.concat_ws(":", "file_id", "start_line", "name")
    low = F.lower("name")
    cards = [
        sets.where("kind = 'derives'").select(*_card("common_derive_combination", F.col("value"), _said("FREQUENCY", F.col("n")), _said("DERIVES", F.col("value")), F.concat(F.lit("\n#[derive("), "value", F.lit(")]")))),
        sets.where("kind = 'serde'").select(*_card("serde_attribute", F.col("value"), _said("ATTRIBUTE", F.col("value")), _said("FREQUENCY", F.col("n")), _said("EXAMPLES", F.col("examples")))),
        frequent_macros(each("macros")).select(*_card("macro_usage", F.col("value"), _said("MACRO", F.col("value")), _said("FREQUENCY", F.col("n")), _said("EXAMPLES", F.col("examples")))),
        extract.schema_macros(files, "table_def").select(*_card("table_schema", F.concat_ws(":", "file_id", F.md5("code")), F.col("code"))).distinct(),
        each("types").where("kind = 'enum' and size(attributes) > 0").select(*_card("attributed_enum", F.concat_ws(":", "file_id", "line", "name"), F.array_join("attributes", "\n"), F.col("code"))),
        once.where(low.rlike("validate|check")).select(*_card("validation_function", key, _said("CRATE", F.col("crate")), _said("RETURN_TYPE", F.col("return_type")), F.col("signature"))),
        once.where("is_async").select(*_card("async_function", key, _said("CRATE", F.col("crate")), F.col("signature"))),
        once.where(F.col("return_type").contains("Result")).select(*_card("error_handling", key, _said("RETURN_TYPE", F.col("return_type")), F.col("signature"))),
        each("impls").where(F.regexp_replace("trait_name", r"<[\s\S]*", "").isin("From", "Into", "TryFrom", "TryInto")).select(*_card("type_conversion", F.concat_ws(":", "file_id", "line", "for_type"), _said("TRAIT", F.col("trait_name")), _said("FOR_TYPE", F.col("for_type")))),
        stats.top_with_examples(each("impls").where("trait_name is not null").select("file_id", "line", "trait_name", "for_type").distinct(), "trait_name", F.struct("file_id", "line"), F.col("for_type"), F.col("file_id"), TOP, EXAMPLES).select(*_card("trait_implementations", F.col("value"), _said("FREQUENCY", F.col("n")), _said("TYPES", F.col("examples")))),
        once.where(F.col("is_pub") & low.contains("rout")).select(*_card("routing_function", key, _said("CRATE", F.col("crate")), F.col("signature"))),
    ]
    out = cards[0]
    for card in cards[1:]:
        out = out.unionByName(card)
    return out


def file_cards(files: DataFrame, per_crate: int = 20) -> DataFrame:
    """Whole files with what they contain: ``kind, file_id, content``.

    Files with types; with table macros or attributed enums; with conversions (named);
    and the largest files of each crate between 1 000 and 100 000 bytes.
    """
    items = rust_facts.read(files)[2]
    n = lambda kind: F.count_if(F.expr(f"kind = '{kind}' and (kind = 'struct' or body = '{{')")).cast("string")
    head = F.concat(F.lit(f"// Repository: {render.REPOSITORY}\n// Crate: "), F.coalesce("crate", F.lit("")), F.lit("\n// File: "), "file_path")
    has = F.concat(F.lit("\n// Contains: "), n("struct"), F.lit(" structs, "), n("enum"), F.lit(" enums, "), n("fn"), F.lit(" functions, "), n("impl"), F.lit(" impls"))
    typed = items.groupBy("file_id").agg(has.alias("_has"), F.count_if(F.expr("kind in ('struct', 'enum', 'union')")).alias("_n")).where("_n > 0").select(F.lit("types").alias("kind"), "file_id", "_has")
    tables = extract.schema_macros(files, "table_def").groupBy("file_id").agg(F.count(F.lit(1)).alias("_t")).join(rust_facts.types(items).where("kind = 'enum' and size(attributes) > 0").groupBy("file_id").agg(F.count(F.lit(1)).alias("_e")), "file_id", "full").fillna(0, ["_t", "_e"])
    schemas = tables.select(F.lit("tables").alias("kind"), "file_id", F.concat(F.lit("\n// Contains: "), F.col("_t").cast("string"), F.lit(" tables, "), F.col("_e").cast("string"), F.lit(" attributed enums")).alias("_has"))
    turned = rust_facts.impls(items).withColumn("_t", F.regexp_replace("trait_name", r"<[\s\S]*", "")).where(F.col("_t").isin("From", "Into", "TryFrom", "TryInto"))
    listed = turned.groupBy("file_id").agg(F.concat(F.lit("\n// Conversions: "), F.array_join(F.transform(F.slice(F.sort_array(F.collect_list(F.struct("line", F.concat_ws(" for ", "trait_name", "for_type").alias("c")))), 1, EXAMPLES), lambda x: x["c"]), ", ")).alias("_has")).select(F.lit("conversions").alias("kind"), "file_id", "_has")
    sized = files.select("file_id", "crate", F.octet_length("code").alias("n")).where("n > 1000 and n < 100000")
    largest = stats.top_k_per_group(sized, ["crate"], [F.desc("n"), F.asc("file_id")], per_crate).select(F.lit("large").alias("kind"), "file_id", F.lit("").alias("_has"))
    every = typed.unionByName(schemas).unionByName(listed).unionByName(largest)
    return files.join(every, "file_id").select("kind", "file_id", F.concat(head, "_has", F.lit("\n\n"), "code", F.lit("\n")).alias("content"))


def function_cards(functions: DataFrame, scores: DataFrame, category: Column, per_module: int = 10, shown: int = 5, per_category: int = 50) -> DataFrame:
    """Cards of functions: ``kind, key, content``.

    Of each module the ``per_module`` functions of the highest ``weighted`` score by name
    and the first ``shown`` in full; and of each ``category`` the first ``per_category``
    async functions. Modules of a null crate or module are one each; a null text counts as empty.
    """
    text = F.coalesce("full_text", F.lit(""))
    rows = render.functions_once(functions).join(scores.select("file_id", "start_line", "name", "weighted").distinct(), ["file_id", "start_line", "name"])
    best = stats.top_k_per_group(rows.select("crate", "module", "weighted", "file_id", "start_line", "name", text.alias("text")), ["crate", "module"], [F.desc("weighted"), *map(F.asc, ("file_id", "start_line", "name", "text"))], per_module)
    gathered = best.groupBy("crate", "module").agg(F.sort_array(F.collect_list(F.struct("k", "name", F.when(F.col("k") <= shown, F.col("text")).alias("text")))).alias("x"))
    head = F.concat(F.lit("// Crate: "), F.coalesce("crate", F.lit("")), F.lit("\n// Module: "), F.coalesce("module", F.lit("")), F.lit("\n// Top functions: "), F.array_join(F.transform("x", lambda x: x["name"]), ", "))
    cards = gathered.select(F.lit("functions").alias("kind"), F.concat_ws("::", "crate", "module").alias("key"), F.concat(head, F.lit("\n\n"), F.array_join(F.transform(F.slice("x", 1, shown), lambda x: x["text"]), "\n\n")).alias("content"))
    few = stats.top_k_per_group(rows.where("is_async").select(category.alias("category"), "file_id", "start_line", "name", text.alias("text")), ["category"], [F.asc("file_id"), F.asc("start_line"), F.asc("name"), F.asc("text")], per_category)
    return cards.unionByName(few.select(F.lit("async").alias("kind"), F.concat_ws(":", "file_id", "start_line", "name").alias("key"), F.concat(F.lit("// Category: "), "category", F.lit("\n\n"), "text").alias("content")))


def multi_level_cards(files: DataFrame) -> DataFrame:
    """All implementations of a type, a trait with its implementors, and the use of other crates: ``granularity, key, content``."""
    blocks = cut(extract.facts(files, "impl_blocks").join(files.select("file_id", "file_path", "seq"), "file_id"))

    def gathered(rows: DataFrame, key: str, shown: int, text) -> DataFrame:
        few = stats.top_k_per_group(rows, [key], [F.asc("seq"), F.asc("file_id"), F.asc("line")], shown)
        first = few.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("k", text.alias("t"), "name"))), lambda x: x["t"]).alias("texts"), F.array_join(F.transform(F.slice(F.sort_array(F.collect_list(F.struct("k", "name"))), 1, 10), lambda x: x["name"]), ", ").alias("names"))
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file_id").alias("n_files")).where("n >= 2")
        return first.join(counts, key)

    number = lambda label, c: F.concat(F.lit(label + ": "), F.col(c).cast("string"))
    types = gathered(blocks.withColumn("type_name", F.col("name")), "type_name", 10, F.concat(F.lit("// From: "), "file_path", F.lit("\n"), "code"))
    out = types.select(F.lit("impl_collection").alias("granularity"), F.col("type_name").alias("key"), render.tagged([F.concat(F.lit("Type: "), "type_name"), number("Implementations", "n"), number("Files", "n_files")], "impl_collection", F.array_join("texts", "\n\n")).alias("content"))
    traits = gathered(blocks.where("trait_name is not null"), "trait_name", 15, F.concat(F.lit("// "), "name", F.lit(" in "), "file_path", F.lit("\n"), "code"))
    out = out.unionByName(traits.select(F.lit("trait_ecosystem").alias("granularity"), F.col("trait_name").alias("key"), render.tagged([F.concat(F.lit("Trait: "), "trait_name"), number("Implementors", "n"), F.concat(F.lit("Types: "), "names")], "trait_ecosystem", F.array_join("texts", "\n\n")).alias("content")))
    uses = extract.imports_and_exports(files).where("kind = 'use' and name like '%::%'").join(files.select("file_id", "crate", "file_path"), "file_id").withColumn("dep", F.split("name", "::")[0]).where("dep <> crate")
    deps = uses.groupBy("crate", "dep").agg(F.count_distinct("file_id").alias("n"))
    places = stats.top_k_per_group(uses.select("crate", "dep", "file_path").distinct(), ["crate", "dep"], [F.asc("file_path")], 3).groupBy("crate", "dep").agg(F.array_join(F.sort_array(F.collect_list("file_path")), ", ").alias("paths"))
    totals = deps.groupBy("crate").agg(F.count(F.lit(1)).alias("n_deps"))
    line = F.concat(F.lit("Dependency: "), "dep", F.lit("\n  Used in "), F.col("n").cast("string"), F.lit(" files: "), "paths")
    few = stats.top_k_per_group(deps.join(places, ["crate", "dep"]), ["crate"], [F.asc("dep")], 5).withColumn("line", line)
    usage = few.groupBy("crate").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "line"))), lambda x: x["line"]), "\n").alias("lines")).join(totals, "crate")
    return out.unionByName(usage.select(F.lit("cross_crate").alias("granularity"), F.col("crate").alias("key"), render.tagged([F.concat(F.lit("Crate: "), "crate"), number("Dependencies", "n_deps")], "cross_crate_usage", F.col("lines")).alias("content")))
