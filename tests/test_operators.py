import itertools
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.operators import chunk, graph, mixing, packing, stats
from tessella.sources import files, payloads, sinks
from tessella.spark_util import cut, latest_per_key


def test_heading_chunks(spark):
    md = "intro\n# One\ntext\n```\n# comment\n```\n## Two\n\n#### deep\n#nospace\n### Three"
    df = spark.createDataFrame([(1, md), (2, None), (3, "")], "k long, t string")
    got = [(r.chunk_index, r.heading, r.heading_level, r.content) for r in chunk.by_heading(df, "k", "t").orderBy("chunk_index").collect()]
    assert [g[:3] for g in got] == [(0, "One", 1), (1, "comment", 1), (2, "Two", 2), (3, "Three", 3)]
    assert "\n".join(g[3] for g in got).replace("\n\n", "\n") == md[6:].replace("\n\n", "\n")
    assert chunk.by_heading(df, "k", "t", "2").count() == 1


def test_rule_chunks(spark):
    long = "x" * 100
    df = spark.createDataFrame([(1, f"{long}\n---\n{'y' * 99}\n---\n---\n  {long}y  \n")], "k long, t string")
    assert [(r.chunk_index, len(r.content)) for r in chunk.by_rule(df, "k", "t").orderBy("chunk_index").collect()] == [(0, 100), (1, 107)]  # the second of two rules in a row stays, as its line end is used up


def brute_adaptive(sections, most, overlap):
    """The rule on texts, written out."""
    out, sizes, held, before = [], [0, 0, 0], [], []
    tokens = lambda x: len(x) // 4

    def emit(text):
        out.append(text)
        sizes[0 if tokens(text) < 4000 else 1 if tokens(text) < 10000 else 2] += 1

    def prefix():
        text = ""
        for s in reversed(before):
            longer = s + (chunk.RULE + text if text else "")
            if tokens(longer) > overlap:
                break
            text = longer
        return text + chunk.RULE if text else ""

    def flush(last=False):
        nonlocal held, before
        if held:
            emit(("" if last else prefix()) + chunk.RULE.join(held))
            before, held = held[-2:], []

    for s in sections:
        n = sum(map(tokens, held))
        if tokens(s) > most:
            flush()
            part = []
            for p in s.split("\n\n"):
                if sum(map(tokens, part)) + tokens(p) > most and part:
                    emit("\n\n".join(part))
                    part = []
                part.append(p)
            emit("\n\n".join(part))
        elif n + tokens(s) > most:
            flush()
            held = [s]
        else:
            total = sum(sizes)
            target = 10000 if not total else 4000 if sizes[0] / total < 0.25 else 10000 if sizes[1] / total < 0.5 else 16000 if sizes[2] / total < 0.25 else 10000
            held.append(s)
            if n + tokens(s) >= target:
                flush()
    flush(last=True)
    return out


def test_adaptive_chunks(spark):
    sizes = [[120, 700, 50_000, 300, 39_000, 39_000, 500, 70_000, 600, 20_000, 20_000, 100], [39_999] * 12, [100] * 30, [66_000, 100, 66_000], [16_000] * 9]
    docs = []
    for k, row in enumerate(sizes):
        docs.append((k, chunk.RULE.join("".join(chr(97 + (i + j) % 26) if j % 3001 else "\n\n" for j in range(1, n + 1)).strip().ljust(n, "z") for i, n in enumerate(row))))
    df = spark.createDataFrame(docs, "k long, t string")
    got = {}
    for r in chunk.adaptive(df, "k", "t").orderBy("k", "chunk_index").collect():
        got.setdefault(r.k, []).append(r.content)
    for k, text in docs:
        assert got[k] == brute_adaptive([s.strip() for s in text.split(chunk.RULE) if len(s.strip()) >= 100], 16384, 200)


def test_tagged_samples(spark):
    df = spark.sql("select 1L as k, 'some prose here\n```rust\nlet a = 1;\n```' as content, array(named_struct('file_path', 'a.rs', 'start_line', 1L, 'code', repeat('w ', 60), 'language', 'rust')) as snippets")
    texts = [r.text for r in chunk.tagged_samples(df, "k", 8192).collect()]
    assert len(texts) == 1 and texts[0].count("<code") == 2
    assert [r.split for r in chunk.tagged_samples(df, "k", 180).collect()] == [0, 1]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=40))
def test_packing_in_order(spark, sizes):
    df = spark.createDataFrame([(1, k, n) for k, n in enumerate(sizes)] + [(2, 0, None)], "g long, k long, n long")
    got = {r.k: r.chunk for r in packing.pack_in_order(df, ["g"], ["k"], "n", 20).where("g = 1").collect()}
    want, chunk_, total, holds = {}, -1, 0, False
    for k, n in enumerate(sizes):
        if n > 20 or not holds or total + n > 20:
            chunk_, total, holds = chunk_ + 1, 0 if n > 20 else n, n <= 20
        else:
            total += n
        want[k] = chunk_
    assert got == want


def in_sequence(sizes, most):
    chunks, chunk_, total, holds = [], -1, 0, False
    for n in sizes:
        if n > most or not holds or total + n > most:
            chunk_, total, holds = chunk_ + 1, 0 if n > most else n, n <= most
        else:
            total += n
        chunks.append(chunk_)
    return chunks


@pytest.mark.parametrize("seed", range(4))
def test_blocks_give_the_sequential_result(spark, seed):
    draw = random.Random(seed)
    sizes = [draw.choice([0, 0, 1, 2, 3, 3, 7, 20, 21, 40][: draw.choice([4, 10])]) for _ in range(300)]
    order = [None] * 40 + sorted(draw.choice([5, 5, 5, k]) for k in range(259)) + [10**15]  # nulls, ties, an outlier
    rows = [(None, q, k, n) for k, (q, n) in enumerate(zip(order, sizes))] + [("h", 0, k, 3) for k in range(50)]
    df = spark.createDataFrame(rows, "g string, q long, k long, n long").repartition(5)
    got = {(r.g, r.k): (r.chunk, r.oversize) for r in packing.pack_in_order(df, ["g"], ["q", "k"], "n", 20, block=7).collect()}
    assert len(got) == 350
    assert [got[None, k] for k in range(300)] == [(c, n > 20) for c, n in zip(in_sequence(sizes, 20), sizes)]
    assert [got["h", k][0] for k in range(50)] == in_sequence([3] * 50, 20)


@pytest.mark.parametrize("per_line", [False, True])
def test_split_lines(spark, per_line):
    text = "\n".join(["a" * 30, "", "b" * 200, "c" * 10, "d" * 11])
    parts = spark.createDataFrame([(text,)], "t string").select(packing.split_lines(F.col("t"), 12, per_line).alias("p")).first().p
    assert "\n".join(p.text for p in parts) == text
    assert [p.text for p in parts if p.n_tokens > 12] == ["b" * 200]


def test_small_files(spark):
    df = spark.createDataFrame([("c", k, k, n) for k, n in enumerate([1999, 1500, 1500, 900, 500, 100])], "crate string, seq long, file_id long, n_tokens long")
    got = {r.file_id: r.chunk for r in packing.pack_small_files(df).collect()}
    assert got == {0: 0, 1: 0, 2: 0}  # 1 500 left over is dropped


def test_statistics(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", None), (None, 5)], "g string, v long")
    assert stats.upper_median(df.where("v is not null"), "g", "v").where("g = 'a'").first().upper_median == 3
    assert {r.g: r.p50 for r in stats.percentiles(df, "g", "v").collect()} == {"a": 2.0, None: 5.0}
    assert sorted((r.edge, r.n) for r in stats.histogram(df, "v", 2).collect()) == [(0, 1), (2, 1), (4, 1)]
    assert stats.percentiles(df.limit(0), "g", "v").count() == 0


def test_interleave(spark):
    df = spark.range(400).select(F.when(F.col("id") < 300, "a").otherwise("b").alias("source"), "id", F.col("id").cast("string").alias("text"))
    mixed = mixing.interleave(df, {"a": 0.5, "b": 0.5}, 42, buckets=8).toPandas().sort_values("position")
    assert (mixed.source == "b").sum() >= 99 and abs((mixed.source == "a").sum() - 100) <= 2
    runs = [len(list(g)) for _, g in itertools.groupby(mixed.source)]
    assert max(runs) <= 2
    again = mixing.interleave(df, {"a": 0.5, "b": 0.5}, 42, buckets=8).toPandas().sort_values("position")
    assert again.id.tolist() == mixed.id.tolist()
    assert mixing.interleave(df, {"a": 0.5, "c": 0.5}, 42).count() == 0
    ranked = mixing.ranks(df, "source", ["id"], 8).groupBy("source").agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).collect()
    assert sorted(r[1:] for r in ranked) == [(0, 99, 100), (0, 299, 300)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, None, "c"), (None, 9, "d")], "k long, t long, _row string")
    assert sorted(tuple(r) for r in latest_per_key(df, ["k"], ["_row"], ["t"]).collect()) == [(1, "b"), (2, "c")]


def test_imports_meet_names_by_equality(spark):
    uses = spark.createDataFrame([("c", 1, "use brindle_core::x;\nuse other::brindle;"), ("d", 2, None), ("e", 3, "use a::{dle_c, q};\nuse b;"), ("e", 3, "use b;")], "crate string, file_id long, code string")
    deps = spark.createDataFrame([("m", "brindle_core"), ("m", "brindle"), ("n", "none"), ("n", "dle_c"), ("n", "q"), ("n", None), ("n", "")], "crate string, dep string")
    found = graph.importing_files(deps, uses)
    assert sorted(tuple(r) for r in found.collect()) == [("m", "brindle", "c", 1), ("m", "brindle_core", "c", 1), ("n", "dle_c", "c", 1), ("n", "dle_c", "e", 3), ("n", "q", "e", 3)]
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert graph.importing_files(deps.limit(0), uses).count() == 0


def test_scans(spark, tmp_path):
    (tmp_path / "below").mkdir()
    (tmp_path / "a.md").write_text("# A\ntext")
    (tmp_path / "below" / "b.md").write_text("# B")
    (tmp_path / "below" / "x y.rs").write_text("fn x() {}")
    (tmp_path / "target").mkdir()
    (tmp_path / "target" / "Cargo.toml").write_text('[package]\nname = "no"')
    (tmp_path / "Cargo.toml").write_text('[package]\nname = "yes"\n[dependencies]\nb = "1"\na = { path = "x" }\n[features]\nf = ["a"]')
    assert [tuple(r) for r in files.markdown(spark, str(tmp_path)).collect()] == [("a", "# A\ntext")]
    assert [(r.path, r.byte_size) for r in files.rust_tree(spark, str(tmp_path)).collect()] == [("below/x y.rs", 9)]
    found = files.manifests(spark, str(tmp_path)).collect()
    assert [(r.path, r.name, r.dependencies, r.features) for r in found] == [("Cargo.toml", "yes", ["a", "b"], {"f": ["a"]})]


def test_longest_crate_owns(spark):
    tree = spark.createDataFrame([("crates/a/x.rs",), ("crates/a/b/y.rs",), ("z.rs",)], "path string")
    crates = spark.createDataFrame([("outer", "crates/a"), ("inner", "crates/a/b")], "name string, folder string")
    assert {r.path: r.owner for r in files.with_crate(tree, crates).collect()} == {"crates/a/x.rs": "outer", "crates/a/b/y.rs": "inner", "z.rs": None}


def test_json_lines_and_rejects(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nbroken\n{"a": 2}\n')
    rows = files.json_lines(spark, str(tmp_path), "a long", "bad").collect()
    assert sorted((r.a or 0, r.bad) for r in rows) == [(0, "broken"), (1, None), (2, None)]


def test_payload_candidates(spark):
    bodies = [(1, '{"content": "# x", "title": "t", "in": [{"content": "# x"}, {"name": "n", "content": "y"}]}'), (2, "- plain"), (3, "{broken"), (4, None), (5, "")]
    got = payloads.candidates(spark.createDataFrame(bodies, "k long, body string"), "k", "body").orderBy("k", "place").collect()
    assert [(r.k, r.name, r.content) for r in got] == [(1, "t", "# x"), (1, "n", "y"), (2, None, "- plain")]


def test_statistics_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 100), ("a", 5000), ("b", None)], "s string, t long")
    sinks.statistics_json(df, "t", "s", str(tmp_path / "s"))
    row = spark.read.json(str(tmp_path / "s")).first()
    assert (row.total_chunks, row.unique_sources, row.small, row.medium, row.p50) == (3, 2, 1, 1, 2550.0)
    sinks.histogram_json(df, "t", str(tmp_path / "h"))
    assert spark.read.json(str(tmp_path / "h")).count() == 2
    assert "| total chunks | 3 |" in sinks.report(row.asDict(), "T")


def test_named_texts(spark, tmp_path):
    sinks.named_texts(spark.createDataFrame([("A b", "x\ny"), ("a-b", "z"), ("c", None)], "n string, t string"), "n", "t", str(tmp_path / "m"))
    assert sorted((r.name, r.value) for r in spark.read.text(str(tmp_path / "m")).collect()) == [("a-b", "x"), ("a-b", "y"), ("a-b", "z")]


def test_cut_keeps_rows_and_schema(spark):
    df = spark.range(10).withColumn("x", F.lit(None).cast("string"))
    again = cut(df)
    assert again.dtypes == df.dtypes and again.count() == 10
    assert math.isclose(again.agg(F.sum("id")).first()[0], 45)
