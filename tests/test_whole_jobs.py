"""Queries do the whole job of their operator, not a prefix or a part of it."""

from pyspark.sql import functions as F

from tessella import registry
from tessella.operators import chunk, packing, render, tokenize
from tessella.spark_util import table
from tests.compare import DATA
from tests.test_render import calls_of, context_of, functions_of


def test_token_ids_of_whole_texts(spark):
    whole = tokenize.truncated_ids(table(spark, DATA, "documents"), "doc_id", "text", 10**6).agg(F.max("n_ids"), F.sum(F.least("n_ids", F.lit(16384)))).first()
    got = registry.queries()["C12_truncate_tokenize"](spark, DATA).agg(F.max("n_ids"), F.sum("n_ids")).first()
    assert whole[0] > 256 and got[:] == (min(whole[0], 16384), whole[1])


def test_token_ids_do_not_depend_on_slices(spark):
    texts = [None, "", "fn main() {}\n" * 9, "é" * 50, "a b " * 120_000, "tail"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string").coalesce(1)
    got = {r.k: r.input_ids for r in tokenize.truncated_ids(df, "k", "t", 16384).collect()}
    want = {k: tokenize._tokenizer(tokenize.TOKENIZER).encode(t or "", add_special_tokens=False).ids[:16384] for k, t in enumerate(texts)}
    assert got == want and len(got[4]) == 16384


def test_tagged_samples_keep_what_fits_8192(spark, tmp_path):
    content = " ".join(["word"] * 1000) + "\n```rust\n" + "let a = 1;\n" * 200 + "```"
    spark.createDataFrame([(1, content, None, 1)], "chunk_id long, content string, source_references array<struct<file_path: string, start_line: long, end_line: long>>, ingested_at long").write.parquet(str(tmp_path / "doc_chunk.parquet"))
    spark.createDataFrame([], "file_path string, code string").write.parquet(str(tmp_path / "src_file.parquet"))
    texts = [r.text for r in registry.queries()["C10_tag_pack"](spark, str(tmp_path)).collect()]
    assert len(texts) == 1 and texts[0].count("word") == 1000 and texts[0].count("let a") == 200


def test_tagged_samples_cut_at_a_small_limit(spark):
    df = spark.createDataFrame([(1, " ".join(["word"] * 100) + "\n```rust\nlet a = 1;\n```", [])], "k long, content string, snippets array<struct<file_path: string, code: string, language: string>>")
    text = chunk.tagged_samples(df, "k", 152).first().text
    assert text.count("word") == 38 and "<code" not in text


def test_flow_sentences_of_all_calls(spark):
    calls = [(2, 1, f"x{k:02}", "direct", 10 + k) for k in range(12)] + [(2, 1, f"m{k}", "method", 40 + k) for k in range(6)] + [(1, 9, f"y{k}", "method", 10 + k) for k in range(5)]
    edges = spark.createDataFrame(calls, "caller_file_id long, caller_line long, callee_name string, call_kind string, call_line long")
    said = {r.name: r.sentence for r in render.flow_sentences(context_of(spark), edges).collect()}
    assert said["gamma"].endswith("It calls x00, x01, x02, x03, x04, and 7 others and invokes methods m0, m1, m2, m3, m4, and 1 others.")
    assert said["beta"].endswith("It invokes methods y0, y1, y2, y3, y4.") and said["alpha"] == "alpha is a pub function."


def test_chunks_hold_the_lines_and_calls_they_refer_to(spark, tmp_path):
    text = "# Head\n" + "prose " * 30 + "\n[c/a.rs:3-5]() [c/a.rs:100-200]() [d/b.rs:1]() [none.rs:1]()"
    spark.createDataFrame([(7, text)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    code = "// a\n\npub fn alpha() {\n    beta()\n}\n\n\n\nasync fn beta() {}\n"
    spark.createDataFrame([("c/a.rs", code), ("c/a.rs", code), ("d/b.rs", "fn gamma() {\n}\n")], "file_path string, code string").write.parquet(str(tmp_path / "src_file.parquet"))
    functions_of(spark).withColumn("end_line", F.when(F.col("name") == "alpha", F.lit(5)).when(F.col("name") == "gamma", F.lit(2)).cast("long")).write.parquet(str(tmp_path / "fn_info.parquet"))
    calls_of(spark).write.parquet(str(tmp_path / "fn_call.parquet"))
    (row,) = registry.queries()["C6_chunk_assemble"](spark, str(tmp_path)).collect()
    assert row.n_snippets == 2
    assert [(x.file_path, x.start_line, x.code) for x in row.snippets] == [("c/a.rs", 3, "pub fn alpha() {\n    beta()\n}\n"), ("d/b.rs", 1, "fn gamma() {\n")]
    (graph,) = row.call_graph_data  # gamma doesn't end in its range
    assert (graph.name, graph.n_calls, graph.n_callers, [c.callee_name for c in graph.calls]) == ("alpha", 2, 0, ["beta", "push"])
    assert graph.tree.startswith("alpha\n\nCalls:\n├─→ beta") and graph.sentence.startswith("alpha is a pub function. It calls beta")


def test_small_files_of_a_large_crate(spark):
    sizes = [(k * 37) % 23 * (k % 5) * 20 for k in range(900)]
    df = spark.createDataFrame([("c", k, k, n) for k, n in enumerate(sizes)] + [("d", 0, 0, 1999), ("d", 1, 1, 0)], "crate string, seq long, file_id long, n_tokens long")
    want, chunk_, total = {}, 0, 0
    for n, k in sorted((-n, k) for k, n in enumerate(sizes) if n < 2000):
        want[k] = chunk_
        total -= n
        if total >= 4000:
            chunk_, total = chunk_ + 1, 0
    want = {k: c for k, c in want.items() if c < chunk_ or total >= 2000}
    assert {(r.crate, r.file_id): r.chunk for r in packing.pack_small_files(df).collect()} == {("c", k): c for k, c in want.items()}


def test_chunks_of_blocks_have_their_own_numbers(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(packing.pack_in_order, "__defaults__", (100,))
    rows = [(k, "file", "c", k, "x" * 800, 1) for k in range(1000)]
    spark.createDataFrame(rows, "item_id long, granularity string, crate string, seq long, text string, ingested_at long").write.parquet(str(tmp_path / "pack_item.parquet"))
    for name, key in (("C7_pack_items", ["granularity", "crate"]), ("C11_fan_out", ["granularity", "crate", "max_tokens"])):
        chunks = registry.queries()[name](spark, str(tmp_path)).toPandas()
        assert not chunks.duplicated([*key, "chunk"]).any()
        assert all(sorted(g.chunk) == list(range(len(g))) and g.n_items.sum() == 1000 for _, g in chunks.groupby(key))
