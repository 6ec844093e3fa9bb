from pyspark.sql import functions as F

from tessella.operators import extract, graph, mining, render

FUNCTION = "file_id long, start_line long, name string, signature string, visibility string, full_text string, crate string, module string, file_path string, is_pub boolean, is_async boolean, impl_context struct<for_type: string, trait_name: string>"


def functions_of(spark):
    rows = [
        (1, 3, "alpha", "pub fn alpha()", "pub", "pub fn alpha() { beta() }", "c", "m", "c/a.rs", True, False, None),
        (1, 9, "beta", "async fn beta()", "private", "async fn beta() {}", "c", "m", "c/a.rs", False, True, ("T", "Show")),
        (2, 1, "gamma", "fn gamma()", "private", "fn gamma() {}", "d", None, "d/b.rs", False, False, ("T", None)),
    ]
    return spark.createDataFrame(rows, FUNCTION)


def calls_of(spark):
    rows = [(1, 3, "beta", "direct", 4), (1, 3, "push", "method", 5), (1, 3, "Ok", "direct", 6), (1, 3, "beta", "direct", 4)]
    rows += [(2, 1, f"x{k:02}", "direct", 10 + k) for k in range(12)] + [(2, 1, "beta", "scoped", 30), (2, 1, None, "direct", 31)]
    return spark.createDataFrame(rows, "caller_file_id long, caller_line long, callee_name string, call_kind string, call_line long")


def context_of(spark):
    crates = spark.createDataFrame([("c", "Counts", ["d"])], "name string, purpose string, local_deps array<string>")
    return render.with_context(render.functions_once(functions_of(spark)), crates)


def test_context_and_fim(spark):
    rows = {r.name: r for r in context_of(spark).select("*", render.clm().alias("clm"), render.fim(F.regexp_extract("full_text", r"\{.*", 0), True).alias("fim")).collect()}
    assert rows["alpha"].context == "// REPO: corpus\n// CRATE: c\n// CRATE_PURPOSE: Counts\n// CRATE_DEPS: d\n// MODULE: m\n// FUNCTION: alpha\n// VISIBILITY: pub"
    assert rows["beta"].context.endswith("// FUNCTION: beta\n// IMPL: Show for T")
    assert rows["gamma"].context == "// REPO: corpus\n// CRATE: d\n// FUNCTION: gamma\n// IMPL: T"
    assert rows["alpha"].fim.endswith("\n\npub fn alpha() {<fim_suffix>\n}<fim_middle>beta()<|endoftext|>")
    assert rows["alpha"].clm.endswith("VISIBILITY: pub\n\npub fn alpha() { beta() }")


def test_call_trees(spark):
    trees = {r.name: r.tree for r in render.call_trees(context_of(spark), calls_of(spark)).collect()}
    assert trees["alpha"] == "alpha\n\nCalls:\n├─→ beta (direct, line 4)\n└─→ push (method, line 5)"
    assert trees["beta"] == "beta\n\nCalled by:\n├─← alpha (c/a.rs:4)\n└─← gamma (d/b.rs:30)"
    assert trees["gamma"].count("├─→") == 10 and trees["gamma"].endswith("... and 3 more calls")


def test_flow_sentences(spark):
    said = {r.name: r.sentence for r in render.flow_sentences(context_of(spark), calls_of(spark)).collect()}
    assert said["alpha"] == "alpha is a pub function. It calls beta and invokes methods push."
    assert said["beta"] == "beta is a private async function implementing Show for T. This function is called by alpha, gamma."
    assert said["gamma"].startswith("gamma is a private function defined in the implementation of T. It calls x00, x01, x02, x03, x04, and 7 others.")


def test_graph_samples(spark):
    content = {r.name: r.content for r in render.graph_samples(context_of(spark), calls_of(spark)).collect()}
    assert content["beta"].startswith("[CALL_GRAPH]\nbeta (c/a.rs:9)\n\n[CALLED_BY]\n  ←─┤ alpha (c/a.rs:4)\n  ←─┤ gamma (d/b.rs:30)\n\n// REPO: corpus")
    assert "  ├─→ push (line 5)" in content["alpha"]


FILES = [
    (1, "crates/a/src/one.rs", "use other::x;\npub struct S { a: u8 }\nimpl S {\n    fn m() {}\n}\npub trait Show: Clone {\n    /// Doc.\n    fn show(&self);\n}\nimpl Show for S {\n    fn show(&self) {}\n}\n", "a", "one", 1),
    (2, "crates/b/src/two.rs", "enum E { X }\nimpl Show for E {\n    fn show(&self) { log!(1); }\n}\nimpl S {\n    fn n() {}\n}\n", "b", "two", 2),
    (3, "crates/b/src/bad.rs", None, "b", "bad", 3),
]


def files_of(spark):
    return extract.files_once(spark.createDataFrame(FILES, "file_id long, file_path string, code string, crate string, module string, seq long"))


def test_cards(spark):
    files = files_of(spark)
    traits = render.trait_cards(files).collect()
    assert [t.content for t in traits] == ["// TRAIT: Show\n// CRATE: a\n// MODULE: one\n// SUPER_TRAITS: Clone\n// IMPLEMENTATIONS: S, E\n\npub trait Show {\n    fn show(...);\n}"]
    modules = [r.content for r in render.module_cards(files).collect()]
    assert modules[0].startswith("// MODULE: one\n// CRATE: a\n\n// Structs: S\n// Enums: \n// Functions: 2\n\n// Imports:\n// use other::x;")
    cards = {(r.granularity, r.key): r.content for r in mining.multi_level_cards(files).collect()}
    assert set(cards) == {("impl_collection", "S"), ("trait_ecosystem", "Show"), ("cross_crate", "a")}
    assert "Implementations: 3\nFiles: 2" in cards["impl_collection", "S"] and "Types: S, E" in cards["trait_ecosystem", "Show"]
    assert "Dependency: other\n  Used in 1 files: crates/a/src/one.rs" in cards["cross_crate", "a"]
    kinds = {r.kind for r in mining.file_cards(files).collect()}
    assert kinds == {"types"}
    crates = {r.crate: r.impls for r in mining.crate_analysis(files).collect()}
    assert crates == {"a": 2, "b": 2}


def test_documentation_tags(spark):
    chunks = spark.sql("select 1L as chunk_id, 'prose\n```py\nx\n```' as content, array(named_struct('file_path', 'crates/a/src/one.rs', 'start_line', 1L, 'end_line', 1L), named_struct('file_path', 'none.rs', 'start_line', 1L, 'end_line', 1L)) as source_references union all select 2L, null, null")
    texts = {r.chunk_id: r.text for r in render.documentation_tags(chunks, graph.snippets(chunks, files_of(spark))).collect()}
    assert texts[1] == '<doc>\nprose\n</doc>\n\n<code language="py">\nx\n</code>\n\n<code language="rust" source="crates/a/src/one.rs">\nuse other::x;\n\n</code>'
    assert texts[2] == ""


def test_empty_tables(spark):
    files = files_of(spark).limit(0)
    assert mining.multi_level_cards(files).count() == 0 and mining.file_cards(files).count() == 0
    none = context_of(spark).limit(0)
    assert render.call_trees(none, calls_of(spark).limit(0)).count() == 0
