import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella.llm import budget, tokens

ODD = [None, "", " ", "\n\n \n", "a", "can't we'll I'D", "x" * 500, "　　foo  bar", "\x1c.\x1c ", "日本語のテキスト" * 40, "<|endoftext|>", "🏭🌊 🔧'''''s", "\r\n\r\n\tif (a)\r\n", "á́  b", "0123 4567890.5e-3", "\x00\x01", "ﬁ ½ ⅷ"]


@pytest.fixture(scope="module")
def exact():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def encoded(texts):
    flat, bounds = tokens.encode_array(tokens.byte_bpe(), pa.array(texts, pa.string()))
    return [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_odd_texts(exact):
    assert encoded(ODD) == exact(ODD)
    assert tokens.trie_counter().counts(pa.array(ODD, pa.string())).tolist() == [len(x) for x in exact(ODD)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdrelvmt.,(){}aZ09_é日　\xa0\x85\x1c🏭"), st.characters(exclude_categories=["Cs"])), max_size=60), min_size=1, max_size=6))
def test_any_text(exact, texts):
    assert encoded(texts) == exact(texts)
    assert tokens.trie_counter().counts(pa.array(texts, pa.string())).tolist() == [len(x) for x in exact(texts)]


def test_whole_table(spark, exact):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = tokens.encode_documents(docs, "doc_id", "text").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    want = dict(zip(texts, exact(list(texts.values()))))
    assert {r.doc_id: r.ids for r in rows} == want
    counts = {r.doc_id: r.n_tokens for r in budget.count_documents(docs).collect()}
    assert counts == {k: len(v) for k, v in want.items()}


def brute_longest(word, vocabulary):
    out, at = [], 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in vocabulary:
                out.append(vocabulary[word[at:end]])
                at = end
                break
        else:
            out.append(None)
            at += 1
    return out


@settings(max_examples=300, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=12), st.binary(max_size=25).map(lambda b: bytes(x % 3 for x in b)))
def test_trie_is_longest_match(words, word):
    vocabulary = {w: k for k, w in enumerate(sorted(words))}
    assert tokens.Trie(vocabulary).match(word) == brute_longest(word, vocabulary)


def test_remembered_fragments_stay_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    memory = tokens._Memory(lambda f: len(f))
    assert [memory[bytes([k])] for k in range(10)] == [1] * 10 and len(memory) <= 3
    assert memory[b"x" * 200] == 200 and b"x" * 200 not in memory


def test_slices_keep_texts_whole():
    texts = pa.array(["a" * 10, None, "b" * 50, "c", "d"] * 3)
    parts = list(tokens.slices(texts.slice(1), 30))
    assert pa.concat_arrays(parts).equals(texts.slice(1)) and len(parts) > 2
    assert [len(x) for x in tokens.slices(pa.array([], pa.string()))] == [0]
    assert np.diff(tokens.text_bytes(texts)[1]).tolist()[:3] == [10, 0, 50]


def test_labels_and_budget(spark):
    rows = [(1, "a b", " Wiki ", "md", None), (2, None, "WIKI", "Markdown", "x"), (3, "", None, " ", "X"), (3, "c", "wiki", "rs", "x ")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic_area string").withColumn("token_count", F.lit(None).cast("long")).withColumn("t", F.lit(1)).withColumn("n_rows", F.lit(9))
    got = budget.budget(df).collect()
    pick = lambda level, col: {r[col]: (r.n_rows, r.n_tokens) for r in got if r.level == level}
    assert pick("source", "source") == {"wiki": (3, 3), "(none)": (1, 0)}
    assert pick("lang", "lang") == {"markdown": (2, 2), "(none)": (1, 0), "rust": (1, 1)}
    assert pick("topic_area", "topic_area") == {"(none)": (1, 2), "x": (3, 1)}
    assert [(r.n_rows, r.n_tokens, r.n_empty) for r in got if r.level == "total"] == [(4, 3, 2)]
    assert {r.level for r in budget.budget(df.limit(0)).collect()} <= {"total"}


def test_item_budget_counts_items_once(spark):
    rows = [(1, "File", 5, "x" * 9, 1), (1, "file", 5, "x" * 9, 2), (2, None, None, "x" * 9, 1), (None, "file", 3, "", 1)]
    df = spark.createDataFrame(rows, "item_id long, granularity string, tokens long, text string, ingested_at long").withColumn("seq", F.lit(1))
    assert {r.granularity: (r.n_rows, r.n_tokens) for r in budget.item_budget(df).collect()} == {"file": (1, 5), "(none)": (1, 2)}
