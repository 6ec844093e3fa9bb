"""Splitting texts over a token limit at natural boundaries, with an overlap in tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.tokens import BYTE_BPE, TOKENIZERS, byte_bpe, encode_array, slices, text_bytes

#: A cut behind a token, strongest first: before a heading, a blank line, a line end, behind a sentence, before white space,
#: between other characters; then a place where a piece would encode otherwise, one from which the overlap back can't begin a
#: piece, and one within a character.
HEADING, PARAGRAPH, LINE, SENTENCE, WORD, CHARACTER, UNSAFE, FAR, NEVER, END = "HPLSWCyzxE"
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FLAT = np.isin(np.arange(256), [9, 11, 12, 13, 32])
STRONG = HEADING + PARAGRAPH + LINE + SENTENCE
_NO_START = np.frombuffer((UNSAFE + NEVER).encode(), np.uint8)


def boundary_letters(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each token the letter of the cut behind it, from the bytes around it.

    A cut before white space that follows something else is one no token and no
    pre-split ever crosses, so both sides encode as in the whole text; a cut behind
    white space would change how the run before it is split and counts as unsafe.
    """
    padded = np.concatenate([data, np.full(3, 0, np.uint8)])
    place = np.arange(len(padded))
    white, flat = _SPACE[padded], _FLAT[padded]
    beyond_flat = np.minimum.accumulate(np.where(flat, len(data), place)[::-1])[::-1]  # the next byte that is no blank within a line
    beyond = np.minimum.accumulate(np.where(white, len(data), place)[::-1])[::-1]
    before, after = white[ends - 1], white[ends]
    letters = np.full(len(ends), ord(CHARACTER), np.uint8)
    letters[(before & ~after) | (padded[ends] == ord("'"))] = ord(UNSAFE)
    letters[(padded[ends] & 0xC0) == 0x80] = ord(NEVER)
    gap = ~before & after
    letters[gap] = ord(WORD)
    letters[gap & np.isin(padded[ends - 1], np.frombuffer(b".!?;", np.uint8))] = ord(SENTENCE)
    line_end = beyond_flat[ends]
    line = gap & (padded[line_end] == 10)
    letters[line] = ord(LINE)
    letters[line & (padded[beyond_flat[line_end + 1]] == 10)] = ord(PARAGRAPH)
    letters[line & (padded[beyond[ends]] == 35)] = ord(HEADING)
    return letters


def token_layout(docs: DataFrame, key: str, text: str, limit: int, overlap: int, folder: str = TOKENIZERS, name: str = BYTE_BPE) -> DataFrame:
    """Rows ``_key, _text, cuts, ends`` of the texts over the limit: a letter per token, and the code points up to each token's end.

    Where the overlap back from a cut lies no place to begin a piece, the cut is taken
    only where no other is within reach.
    """
    # a token has at least one byte, so shorter texts needn't reach Python
    source = docs.where(F.octet_length(text) > limit).select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))

    def layout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(folder, name)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                data, start = text_bytes(texts)
                flat, bounds = encode_array(bpe, texts)
                long = np.flatnonzero(np.diff(bounds) > limit)
                cuts, ends = [], []
                for k in long:
                    own = data[start[k] : start[k + 1]]
                    byte_ends = np.cumsum(bpe.token_bytes[flat[bounds[k] : bounds[k + 1]]])
                    points = np.cumsum((own & 0xC0) != 0x80)
                    letters = boundary_letters(own, byte_ends)
                    if overlap:
                        no_start = np.isin(letters[:-overlap], _NO_START)
                        letters[np.append(np.ones(overlap, bool), no_start)[: len(letters)] & ~np.isin(letters, _NO_START)] = ord(FAR)
                    letters[-1] = ord(END)
                    cuts.append(letters.tobytes().decode())
                    ends.append(points[byte_ends - 1].astype(np.int32))
                rows = pa.array(long)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)).take(rows), texts.take(rows), pa.array(cuts, pa.string()), pa.array(ends, pa.list_(pa.int32()))], names=["_key", "_text", "cuts", "ends"]
                )
                at += len(texts)

    return source.mapInArrow(layout, f"_key {source.schema['_key'].dataType.simpleString()}, _text string, cuts string, ends array<int>")


def piece_pattern(most: int) -> str:
    """Alternatives in order of strength, each taking up to ``most`` tokens: the rest if it fits, a strong cut in the second
    half, any word end, any safe character, any character; a strong cut counts only from half of the limit on."""
    half = max(1, most // 2)
    strong = [rf".{{{half - 1},{most - 1}}}{x}" for x in STRONG]
    return "|".join([rf".{{0,{most - 1}}}{END}", *strong, rf".{{0,{most - 1}}}[{STRONG}{WORD}]", rf".{{0,{most - 1}}}{CHARACTER}", rf".{{0,{most - 1}}}[^{FAR}{NEVER}]", rf".{{0,{most - 1}}}{FAR}", rf".{{1,{most}}}"])


def split_documents(docs: DataFrame, limit: int, overlap: int, key: str = "doc_id", folder: str = TOKENIZERS, name: str = BYTE_BPE) -> DataFrame:
    """Pieces of every text over ``limit`` tokens: ``key, piece, n_pieces, start_char, end_char, n_tokens, text``.

    Each piece has at most ``limit`` tokens and starts ``overlap`` tokens before the
    end of the one before it, so all pieces together restore the text. Cuts are chosen
    so that a piece can begin there; only where no cut within reach allows it (a run
    of characters of several tokens, say) are there up to four tokens more. Null, empty and short texts give no rows; of equal rows each
    gives its pieces. Everything after the tokens is regular expressions and array
    functions in the JVM, a map over the scan without a shuffle.
    """
    if not 0 <= overlap < limit - 8:
        raise ValueError("the overlap must be smaller than the limit less 8")
    slack = 4 if overlap else 0
    later = limit - overlap - slack
    laid = token_layout(docs, key, "text", limit, overlap, folder, name)
    first = laid.withColumn("_a", F.regexp_extract("cuts", piece_pattern(limit), 0))
    # every match is marked and the string split, which is linear; collecting matches would copy the string for each
    marked = F.regexp_replace(F.expr("substring(cuts, length(_a) + 1)"), f"({piece_pattern(later)})", "$1|")
    rest = F.filter(F.split(marked, "[|]"), lambda p: p != "")
    parts = first.select("_key", "_text", "cuts", "ends", F.concat(F.array("_a"), rest).alias("_parts"))
    totals = F.expr("aggregate(_parts, named_struct('at', 0, 'all', cast(array() as array<int>)), (s, p) -> named_struct('at', s.at + length(p), 'all', concat(s.all, array(s.at + length(p)))), s -> s.all)")
    stops = parts.select("*", totals.alias("_stops"))
    # where a piece begins: the overlap back, then at most a few letters on to a safe cut, else to any whole character;
    # the letters before that place are taken from the piece before, where it is long enough to hold them
    back = f"_stops[i - 1] - {overlap}"
    within = f"substring(_parts[i - 1], length(_parts[i - 1]) - {overlap + 7}, 8)"
    near = f"if(length(_parts[i - 1]) >= {overlap + 8}, {within}, substring(cuts, greatest({back} - 7, 1), least(8, {back})))"
    safe, whole = (f"length({near}) - length(rtrim('{x}', {near}))" for x in (UNSAFE + NEVER, NEVER))
    begin = f"greatest({back} - if({safe} <= {slack}, {safe}, {whole}), 0)" if overlap else back
    pieces = stops.withColumn("_a", F.expr(f"transform(_stops, (x, i) -> if(i = 0, 0, {begin}))"))
    placed = pieces.select("_key", "_text", F.expr("transform(_a, x -> if(x = 0, 0, ends[x - 1]))").alias("_from"), F.expr("transform(_stops, x -> ends[x - 1])").alias("_to"), F.expr("zip_with(_stops, _a, (b, a) -> b - a)").alias("_sizes"))
    cut = F.arrow_udf(_slices, "array<struct<a int, b int, n int, text string>>")("_text", "_from", "_to", "_sizes")
    each = placed.select("_key", cut.alias("_p")).select(F.col("_key").alias(key), F.size("_p").alias("n_pieces"), F.posexplode_outer("_p").alias("piece", "_q"))
    return each.select(key, "piece", "n_pieces", F.col("_q.a").alias("start_char"), F.col("_q.b").alias("end_char"), F.col("_q.n").alias("n_tokens"), F.col("_q.text").alias("text"))


def _slices(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """The parts of each text between given places; a substring in the JVM would walk through the text from its start for each."""
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32()), ("text", pa.string())]))
    for texts, starts, stops, sizes in batches:
        rows = zip(texts, starts.to_pylist(), stops.to_pylist(), sizes.to_pylist())
        yield pa.array([[{"a": a, "b": b, "n": n, "text": t[a:b]} for a, b, n in zip(x, y, z)] for t, x, y, z in ((t.as_py(), x, y, z) for t, x, y, z in rows)], kind)


def split_to_limit(docs: DataFrame, limits: DataFrame, granularity: str = "document") -> DataFrame:
    """``split_documents`` with the limit and the overlap that ``limits`` has for the granularity."""
    row = limits.where(F.col("granularity") == granularity).agg(F.max("max_tokens").alias("limit"), F.max("overlap_tokens").alias("overlap")).first()
    if row is None or row.limit is None:
        raise ValueError(f"no limit for {granularity}")
    return split_documents(docs, int(row.limit), int(row.overlap or 0))
