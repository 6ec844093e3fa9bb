import pytest
from pyspark.sql import functions as F

from tessella.llm import mix, split, tokens


def docs_of(spark, counts, words=20):
    rows = [(k * 1000 + i, " ".join(["word"] * (words + i % 7)), source) for k, (source, n) in enumerate(counts.items()) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("bucket", F.lit(1)).withColumn("u", F.lit(2)).withColumn("part", F.lit(0.5))


TARGET = "source string, target_share double, max_repeat int"


def test_exact_shares_by_default(spark):
    docs = docs_of(spark, {"a": 300, " A": 20, "b": 100, "c": 10, "x": 50})
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("C", 0.1, 3), ("none", 0.1, 2)], TARGET)
    shares = {r.source: r for r in mix.mix_shares(docs, targets).collect()}
    assert set(shares) == {"a", "b", "c", "none"} and shares["none"].tokens == 0
    for name, share in (("a", 0.5), ("b", 0.3), ("c", 0.1)):
        assert shares[name].actual_share == pytest.approx(share / 0.9, abs=0.005)
    assert shares["c"].repetition == pytest.approx(3) and shares["c"].most_repeats == 3
    used = mix.mix(docs, targets).collect()
    assert len({r.doc_id for r in used}) == len(used)
    assert all(1 <= r.repeats <= {"a": 1, "b": 2, "c": 3}[r.source] for r in used)
    assert sorted((r.doc_id, r.repeats) for r in used) == sorted((r.doc_id, r.repeats) for r in mix.mix(docs, targets).collect())
    assert {r.doc_id for r in mix.mix(docs, targets, seed=8).collect()} != {r.doc_id for r in used}


def water(total, sources):
    """Clamp and share out again until nothing overflows."""
    most = {s: h * m for s, (w, h, m) in sources.items()}
    gives, free = {}, dict(sources)
    while free:
        left = min(total, sum(most.values())) - sum(gives.values())
        level = {s: left * w / sum(x[0] for x in free.values()) for s, (w, _, _) in free.items()}
        over = [s for s in free if level[s] > most[s]]
        if not over:
            return gives | level
        for s in over:
            gives[s] = most[s]
            free.pop(s)
    return gives


@pytest.mark.parametrize("total", [500, 3000, 9000, 20_000, 10**7])
def test_water_filling(spark, total):
    sized = spark.createDataFrame([("a", 5000), ("b", 1000), ("b", 1000), ("c", 100)], "source string, n_tokens long").withColumn("doc_id", F.monotonically_increasing_id())
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.4, 2), ("c", 0.1, 4), ("d", 0.1, 2)], TARGET)
    got = {r.source: r.gives for r in mix.allocation(sized, targets, total).collect()}
    want = water(total, {"a": (0.4, 5000, 1), "b": (0.4, 2000, 2), "c": (0.1, 100, 4)}) | {"d": 0}
    assert got == {s: pytest.approx(v) for s, v in want.items()}


def test_total_of_what_is_held(spark):
    docs = docs_of(spark, {"a": 300, "b": 100, "c": 10, "x": 50})
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.4, 2), ("c", 0.1, 4), ("none", 0.1, 2)], TARGET)
    shares = {r.source: r for r in mix.mix_shares(docs, targets, mix.HELD).collect()}
    held = {s: shares[s].tokens_held for s in "abc"}
    want = water(sum(held.values()), {"a": (0.4, held["a"], 1), "b": (0.4, held["b"], 2), "c": (0.1, held["c"], 4)})
    assert all(shares[s].tokens == pytest.approx(want[s], abs=15) for s in "abc") and shares["c"].repetition == 4
    rows = mix.mix(docs, targets, mix.HELD).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("n"), F.max("repeats").alias("m")).collect()
    assert {(r.source, r.n) for r in rows} == {(s, shares[s].tokens) for s in "abc"} and all(r.m <= {"a": 1, "b": 2, "c": 4}[r.source] for r in rows)


def test_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mix, "BUCKET_ROWS", 10)
    docs = docs_of(spark, {"a": 400, "b": 100})
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], TARGET)
    shares = {r.source: r for r in mix.mix_shares(docs, targets).collect()}
    assert shares["a"].actual_share == pytest.approx(0.5, abs=0.003) and shares["b"].docs_used == 100
    monkeypatch.setattr(mix, "BUCKET_ROWS", 1)
    assert mix.mix_shares(docs, targets).where("source = 'a'").first().actual_share == pytest.approx(0.5, abs=0.003)


def test_empty_tables_and_nulls(spark):
    docs = docs_of(spark, {"a": 3})
    targets = spark.createDataFrame([("a", 1.0, 1)], TARGET)
    assert mix.mix(docs.limit(0), targets).count() == 0
    assert mix.mix(docs, targets.limit(0)).count() == 0
    odd = docs.unionByName(spark.createDataFrame([(7, None, "a"), (8, "", "a"), (None, "x", "a"), (9, "x", None)], "doc_id long, text string, source string"), allowMissingColumns=True)
    assert mix.mix(odd, targets).count() == 4  # the row without an id is a document, those without text or source aren't
    none = spark.createDataFrame([("a", None, 1), ("b", 0.5, 0), (None, 0.5, 1)], TARGET)
    assert mix.mix(docs, none).count() == 0


TEXTS = ["word " * 900, "# A\n\n" + "x y z. " * 300 + "\n\n# B\n" + "line of text\n" * 200, "日本語テキスト。" * 200, "a" * 4000, "🏭🌊🔧" * 300, "'" * 900, " " * 1500, "\n\n\n  " * 400, "short", "", None, "x=1;y=2;" * 400, "\r\n".join(["some words here"] * 300), "é" * 1500, "'s't're" * 300]


@pytest.mark.parametrize(("limit", "overlap"), [(128, 16), (64, 0), (40, 30)])
def test_split_restores_and_overlaps(spark, limit, overlap):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("_text", F.lit("clash")).withColumn("cuts", F.lit("clash")).withColumn("piece", F.lit(1))
    pieces = split.split_documents(df, limit, overlap).orderBy("doc_id", "piece").collect()
    encode = tokens.byte_bpe().encoding.encode_ordinary
    by = {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
    assert set(by) == {k for k, t in enumerate(TEXTS) if t and len(encode(t)) > limit}
    for k, own in by.items():
        text = TEXTS[k]
        assert [p.piece for p in own] == list(range(own[0].n_pieces))
        assert own[0].start_char == 0 and own[-1].end_char == len(text)
        for p in own:
            assert text[p.start_char : p.end_char] == p.text and p.n_tokens <= limit and len(encode(p.text)) <= limit
        for a, b in zip(own, own[1:]):
            assert b.start_char <= a.end_char < b.end_char
            if overlap:
                common = text[b.start_char : a.end_char]
                assert len(encode(common)) >= overlap - 1


def test_natural_cuts(spark):
    text = "# One\n\n" + "word " * 50 + "\n\n# Two\n\n" + "word " * 60
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    first = split.split_documents(df, 80, 0).orderBy("piece").first()
    assert text[first.end_char :].lstrip().startswith("# Two")


def test_overlap_is_what_was_asked_for(spark):
    text = "".join(f"## Part {k}\n\nSome words about 日本語 and naïve_{k} calls(x[{k}]); it's fine.\n" for k in range(120))
    pieces = split.split_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), 100, 20).orderBy("piece").collect()
    encode = tokens.byte_bpe().encoding.encode_ordinary
    assert len(pieces) > 20 and all(encode(a.text)[-20:] == encode(b.text)[:20] and len(encode(text[b.start_char : a.end_char])) == 20 for a, b in zip(pieces, pieces[1:]))


def test_split_limits_and_empty_table(spark):
    limits = spark.createDataFrame([("document", 64, 8)], "granularity string, max_tokens long, overlap_tokens long")
    df = spark.createDataFrame([(1, "w " * 300)], "doc_id long, text string")
    assert split.split_to_limit(df, limits).agg(F.max("n_tokens")).first()[0] <= 64
    assert split.split_to_limit(df.limit(0), limits).count() == 0
    with pytest.raises(ValueError):
        split.split_to_limit(df, limits.limit(0))
    with pytest.raises(ValueError):
        split.split_documents(df, 20, 15)
