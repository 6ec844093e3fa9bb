"""Exact byte-level BPE at Spark scale: forced cuts, and counts by a trie with failure links.

Text is cut where two neighbouring bytes occur side by side inside no vocabulary
token: no merge can ever cross such a place. Of those places only the ones that
the pre-split pattern respects too are used (another character, then ASCII white
space; two ASCII letters), so the fragments encode independently and their ids,
joined, are the ids of the text. Fragments recur constantly, so each Python
worker remembers the ids of a bounded number of them.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.tiktoken"
#: How texts are split before merging; belongs to the vocabulary files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 400_000
LONG = 96


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class _Memory(dict):
    """What ``make`` gives for a fragment, remembered for at most ``REMEMBERED`` short fragments."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, fragment: bytes):
        made = self.make(fragment)
        if len(fragment) <= LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[fragment] = made
        return made


class ByteBPE:
    """A byte-level BPE vocabulary with its table of forced cuts."""

    def __init__(self, path: str) -> None:
        import tiktoken

        self.ranks = read_ranks(path)
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.token_bytes = np.zeros(max(self.ranks.values()) + 1, np.int32)
        inside = np.zeros((256, 256), bool)
        for token, rank in self.ranks.items():
            self.token_bytes[rank] = len(token)
            pair = np.frombuffer(token, np.uint8)
            inside[pair[:-1], pair[1:]] = True
        byte = np.arange(256)
        space = np.isin(byte, [9, 10, 11, 12, 13, 32])
        letter = ((byte | 32) >= 97) & ((byte | 32) <= 122)
        self.never = ~inside
        self.forced = (self.never & ((~space[:, None] & space[None, :]) | (letter[:, None] & letter[None, :]))).ravel()
        self.ids_of = _Memory(self._encode)

    def _encode(self, fragment: bytes) -> bytes:
        return np.array(self.encoding.encode_ordinary(fragment.decode()), np.int32).tobytes()

    def fragments(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Start of each fragment in ``data``: the starts of the texts and the forced cuts."""
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 1:
            cut[1:-1] = self.forced[(data[:-1].astype(np.int32) << 8) | data[1:]]
        cut[starts] = True
        return np.flatnonzero(cut[:-1])


@functools.lru_cache(maxsize=2)
def byte_bpe(folder: str = TOKENIZERS, name: str = BYTE_BPE) -> ByteBPE:
    """The vocabulary, built once in each Python worker."""
    return ByteBPE(os.path.join(folder, name))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array (nulls are empty) and the texts' bounds in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    raw = texts.cast(pa.large_binary()).fill_null(b"")
    _, bounds, data = raw.buffers()
    bounds = np.frombuffer(bounds, np.int64)[raw.offset : raw.offset + len(raw) + 1]
    first, last = int(bounds[0]), int(bounds[-1])
    data = np.frombuffer(data, np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
    return data, bounds - first


def slices(texts: pa.Array, most_bytes: int = 4_000_000) -> Iterator[pa.Array]:
    """The array in runs of about ``most_bytes``, so that what is built for a run stays small; one text is never divided."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = np.diff(text_bytes(texts)[1])
    run = np.cumsum(sizes) // most_bytes
    starts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)] if len(texts) else [0, 0]
    for a, b in zip(starts[:-1], starts[1:]):
        yield texts.slice(a, b - a)


def _per_fragment(bpe: ByteBPE, texts: pa.Array, memory: _Memory) -> tuple[list, np.ndarray]:
    """What ``memory`` gives for each fragment, and for each text how many fragments come before it."""
    data, bounds = text_bytes(texts)
    starts = bpe.fragments(data, bounds[:-1][np.diff(bounds) > 0])
    whole, ends = data.tobytes(), np.append(starts[1:], len(data)).tolist()
    values = [memory[whole[a:b]] for a, b in zip(starts.tolist(), ends)]
    return values, np.searchsorted(starts, bounds)


def encode_array(bpe: ByteBPE, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one after another, and each text's bounds among them."""
    parts, first = _per_fragment(bpe, texts, bpe.ids_of)
    sizes = np.zeros(len(parts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // 4, out=sizes[1:])
    return np.frombuffer(b"".join(parts), np.int32), sizes[first]


def encode_documents(df: DataFrame, key: str, text: str, folder: str = TOKENIZERS, name: str = BYTE_BPE, ids: str = "ids") -> DataFrame:
    """Rows ``key, ids``: the token ids of each text, without special tokens.

    Null and empty texts give an empty list and no row is lost; repeated rows are
    encoded each; strings that look like special tokens are ordinary text. A map
    over the scan without a shuffle.
    """
    source = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(folder, name)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                flat, bounds = encode_array(bpe, texts)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), lists], names=[key, ids])
                at += len(texts)

    kind = source.schema["_key"].dataType.simpleString()
    return source.mapInArrow(encode, f"`{key}` {kind}, `{ids}` array<int>")


class Trie:
    """Longest-match tokenisation in linear time: a trie with failure links and precomputed emissions.

    State = the bytes read since the last emitted token's end. Where a byte can't be
    added, the state's failure link names the next state and ``pops`` the tokens that
    are certain by then. Bytes that start no token are emitted as None.
    """

    def __init__(self, vocabulary: dict[bytes, int]) -> None:
        self.next: list[dict[int, int]] = [{}]
        token: list[int | None] = [None]
        parent: list[tuple[int, int]] = [(0, 0)]
        for word, rank in vocabulary.items():
            at = 0
            for byte in word:
                to = self.next[at].get(byte)
                if to is None:
                    to = len(self.next)
                    self.next[at][byte] = to
                    self.next.append({})
                    token.append(None)
                    parent.append((at, byte))
                at = to
            token[at] = rank
        self.fail = [0] * len(self.next)
        self.pops: list[tuple] = [()] * len(self.next)
        queue = list(self.next[0].values())
        for at in queue:
            queue.extend(self.next[at].values())
            if token[at] is not None:
                self.pops[at] = (token[at],)
                continue
            up, byte = parent[at]
            if up == 0:  # a first byte that is no token itself
                self.pops[at] = (None,)
                continue
            z, pops = self.fail[up], list(self.pops[up])
            while z and byte not in self.next[z]:
                pops += self.pops[z]
                z = self.fail[z]
            to = self.next[z].get(byte, 0)
            self.fail[at], self.pops[at] = to, tuple(pops if to else [*pops, None])

    def match(self, word: bytes) -> list:
        """Ids of the longest-match tokens of ``word``, None for each byte where no token starts."""
        out: list = []
        at, step, fail, pops = 0, self.next, self.fail, self.pops
        for byte in word:
            while at and byte not in step[at]:
                out += pops[at]
                at = fail[at]
            to = step[at].get(byte, 0)
            if not to:
                out.append(None)
            at = to
        while at:
            out += pops[at]
            at = fail[at]
        return out


class TrieCounter:
    """Token counts with the trie: exact for longest-match vocabularies, and for byte BPE by proof or repair.

    A token sequence is the BPE encoding of a word exactly if every two neighbours
    are the encoding of their own bytes. Words whose longest-match tokens pass that
    test (remembered per pair) are counted by the trie; the few others are merged.
    """

    def __init__(self, bpe: ByteBPE) -> None:
        import regex

        self.bpe = bpe
        self.trie = Trie(bpe.ranks)
        self.text_of = {rank: token for token, rank in bpe.ranks.items()}
        self.words = regex.compile(PATTERN)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.proved = self.merged = 0
        self.count_of = _Memory(self._count)

    def _fits(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= 4 * REMEMBERED:
                self.pairs.clear()
            known = self.bpe.encoding._encode_single_piece(self.text_of[a] + self.text_of[b]) == [a, b]
            self.pairs[a, b] = known
        return known

    def word(self, word: bytes) -> int:
        if word in self.bpe.ranks:
            return 1
        ids = self.trie.match(word)
        if None not in ids and all(map(self._fits, ids, ids[1:])):
            self.proved += 1
            return len(ids)
        self.merged += 1
        return len(self.bpe.encoding._encode_single_piece(word))

    def _count(self, fragment: bytes) -> int:
        return sum(self.word(w.encode()) for w in self.words.findall(fragment.decode()))

    def counts(self, texts: pa.Array) -> np.ndarray:
        parts, first = _per_fragment(self.bpe, texts, self.count_of)
        total = np.zeros(len(parts) + 1, np.int64)
        np.cumsum(np.fromiter(parts, np.int64, len(parts)), out=total[1:])
        return np.diff(total[first])


@functools.lru_cache(maxsize=2)
def trie_counter(folder: str = TOKENIZERS, name: str = BYTE_BPE) -> TrieCounter:
    return TrieCounter(byte_bpe(folder, name))


def token_count(text: str | Column, folder: str = TOKENIZERS, name: str = BYTE_BPE) -> Column:
    """Column of exact token counts (long); null and empty texts have 0."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = trie_counter(folder, name)
        for texts in batches:
            done = [counter.counts(part) for part in slices(texts)]
            yield pa.array(np.concatenate(done) if done else np.zeros(0, np.int64))

    return count((F.col(text) if isinstance(text, str) else text).cast("string"))
