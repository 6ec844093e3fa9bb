import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.llm import spans


def brute(records, least):
    grams = {}
    for key, text in records:
        for at in range(len(text) - least + 1):
            grams.setdefault(text[at : at + least], set()).add(key)
    return {(a, b) for keys in grams.values() for a in keys for b in keys if a < b}


def covered(records, least):
    out = {}
    for key, text in records:
        seen = np.zeros(len(text), bool)
        for at in range(len(text) - least + 1):
            part = text[at : at + least]
            if any(part in other for k, other in records if k != key):
                seen[at : at + least] = True
        out[key] = int(seen.sum())
    return out


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda n: "".join(rnd.choice("abcdefghij \nXé日") for _ in range(n))
    shared = [word(n) for n in (60, 59, 75, 150, 61)] + ["=" * 90, "ab" * 50]
    out = []
    for k in range(40):
        parts = [word(rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 3)):
            parts += [rnd.choice(shared), word(rnd.randint(0, 60))]
        out.append((("doc_chunk" if k % 3 else "documents", k), "".join(parts)))
    return out


def frame(spark, records):
    rows = [(t, i, x) for (t, i), x in records]
    return spark.createDataFrame(rows, "tab string, id long, text string").withColumn("h", F.lit("clash")).withColumn("n", F.lit("clash")).withColumn("c", F.lit("clash"))


@pytest.mark.parametrize(("seed", "crowd"), [(1, 48), (2, 48), (1, 1), (3, 4)])
def test_pairs_and_parts_as_brute_force(spark, seed, crowd):
    records = corpus(seed)
    df = frame(spark, records)
    got = {((r.tab_a, r.id_a), (r.tab_b, r.id_b)) for r in spans.shared_pairs(df, 60, 20, crowd).collect()}
    assert got == brute(records, 60)
    parts = {(r.tab, r.id): r.shared_chars for r in spans.shared_parts(df, 60, 20, crowd).collect()}
    assert parts == covered(records, 60)


def test_hot_opening_makes_no_pairs(spark):
    rnd = random.Random(5)
    opening = "".join(rnd.choice("abcdef ") for _ in range(150))
    records = [(("documents", k), opening + "".join(rnd.choice("uvwxyz ") for _ in range(300))) for k in range(120)]
    records.append((("documents", 120), records[0][1]))
    df = frame(spark, records).repartition(3)
    assert [(r.id_a, r.id_b) for r in spans.shared_pairs(df).collect()] == [(0, 120)]


def test_many_copies(spark):
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(900))
    records = [(("documents", k), text) for k in range(60)] + [(("doc_chunk", 1), "x" + text[300:620]), (("doc_chunk", 2), text[300:499])]
    df = frame(spark, records)
    pairs = spans.shared_pairs(df).collect()
    assert len(pairs) == 60 * 59 // 2 + 60 and len(set(pairs)) == len(pairs)
    parts = {(r.tab, r.id): (r.shared_chars, r.n_spans) for r in spans.shared_parts(df).collect()}
    assert parts["documents", 7] == (900, 1) and parts["doc_chunk", 1] == (320, 1) and parts["doc_chunk", 2] == (0, 0)


def test_odd_records(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 199), (None, "y" * 300), (4, "z" * 500), (4, "z" * 500)], "doc_id long, text string")
    chunks = spark.createDataFrame([(4, "z" * 250), (4, "z" * 250), (5, "z" * 199)], "chunk_id long, content string")
    recs = spans.records(docs, chunks)
    assert [tuple(r) for r in spans.shared_pairs(recs).collect()] == [("doc_chunk", 4, "documents", 4)]
    parts = {(r.tab, r.id): (r.n_chars, r.shared_chars, r.share) for r in spans.shared_parts(recs).collect()}
    assert parts[("documents", 4)] == (500, 500, 1.0) and parts[("documents", 2)] == (0, 0, 0.0) and len(parts) == 5
    empty = spans.records(docs.limit(0), chunks.limit(0))
    assert spans.shared_pairs(empty).count() == 0 and spans.shared_parts(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab日", max_size=60), min_size=1, max_size=5))
def test_windows_are_the_least_of_every_run(texts):
    points = np.array([ord(c) for t in texts for c in t], np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    least, gram = 12, 4
    number, place, hashes, left, right = spans.compact_windows(points, bounds, least, gram)
    width = least - gram + 1
    found = {(int(n), int(p)): (int(a), int(b)) for n, p, a, b in zip(number, place, left, right)}
    for k, text in enumerate(texts):
        if len(text) < least:
            continue
        own = spans.gram_hashes(points[bounds[k] : bounds[k + 1]], gram) >> np.uint64(spans.PLACE_BITS)
        for s in range(len(own) - width + 1):
            p = s + int(np.argmin(own[s : s + width]))
            assert (k, p) in found
            a, b = found[k, p]
            assert p - a <= s and p + b >= s + width - 1
