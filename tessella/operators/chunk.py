"""Chunking of Markdown documents: by heading, by rule, and adaptively.

Null and empty texts give no chunks. Repeated documents give their chunks each.
Heading and rule chunks are array functions within a row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import text as T

_GAP = T.GAP
RULE = "\n---\n"
LEAST_CHARS = 100


def heading_line(levels: str) -> str:
    """Pattern of a heading line of the given levels, as ``1,3`` or ``2``."""
    return rf"^#{{{levels}}}{_GAP}+[^\n]+"


def by_heading(docs: DataFrame, key: str, text: str, levels: str = "1,3") -> DataFrame:
    """A chunk from each heading line to the next: ``key, chunk_index, heading, heading_level, content``; text before the first heading is dropped."""
    starts = T.LINES + "(?=" + heading_line(levels) + ")"
    parts = F.filter(F.split(text, starts), lambda p: p.rlike("(?d)\\A" + heading_line(levels)[1:]))
    each = docs.select(F.col(key), F.posexplode(parts).alias("chunk_index", "_part"))
    first = F.regexp_extract("_part", rf"\A(#+){_GAP}+([^\n]+)", 2)
    level = F.length(F.regexp_extract("_part", r"\A#+", 0))
    return each.select(key, "chunk_index", T.strip(first).alias("heading"), level.alias("heading_level"), T.strip("_part").alias("content"))


def by_rule(docs: DataFrame, key: str, text: str, least: int = LEAST_CHARS) -> DataFrame:
    """Stripped parts between rule lines that have ``least`` characters, numbered from 0, with their features."""
    parts = F.filter(F.transform(F.split(text, RULE), T.strip), lambda p: F.length(p) >= least)
    each = docs.select(F.col(key), F.posexplode(parts).alias("chunk_index", "content"))
    return with_features(each, F.concat(F.lit("Section "), F.col("chunk_index")))


def with_features(chunks: DataFrame, default_heading) -> DataFrame:
    """Adds heading, counts, flags and token statistics of ``content``."""
    return chunks.select(
        "*", T.heading_text("content", default_heading).alias("heading"), T.heading_level("content").alias("heading_level"), T.word_count("content").alias("word_count"), T.subsection_count("content").alias("subsection_count"),
        T.match_count("content", T.ANY_FENCE).alias("code_block_count"), F.col("content").contains("mermaid").alias("has_mermaid"), (F.col("content").contains("|") & F.col("content").contains("---")).alias("has_tables"),
        T.token_stats("content").alias("token_stats"), T.code_share("content").alias("code_token_percentage"),
    )


def overlap_start(lengths: list[int], limit: int) -> int:
    """Where the longest run of trailing sections starts that has at most ``limit`` tokens, rules between them included."""
    total, start = 0, len(lengths)
    for k in range(len(lengths) - 1, -1, -1):
        total = lengths[k] + (len(RULE) + total if start < len(lengths) else 0)
        if total // 4 > limit:
            break
        start = k
    return start


def adaptive_plan(sections: list[int], paragraphs: list[list[int]], most: int, overlap: int, mix=(0.25, 0.5)) -> list[tuple[int, int, int, int, int]]:
    """Chunks as (first, end, first overlap section, its end, -1), or (section, first paragraph, end, 0, section) of a section cut at paragraphs.

    Lengths in characters decide, a token being four of them. Sections are gathered
    until the target is reached that the sizes of the chunks so far ask for (10 000
    at first, 4 000 while small chunks are scarce, 10 000 while medium ones are, else
    16 000); what doesn't fit closes the chunk. A chunk opens with the last sections
    of the one before, as many as the overlap allows. A section over the limit is cut
    at paragraphs, without overlap; the last chunk of a document has none either.
    """
    out: list[tuple[int, int, int, int, int]] = []
    sizes = [0, 0, 0]
    held: list[int] = []
    before: list[int] = []
    tokens = 0

    def note(chars: int) -> None:
        sizes[(chars // 4 >= 4000) + (chars // 4 >= 10000)] += 1

    def joined(part: list[int]) -> int:
        return sum(sections[i] for i in part) + len(RULE) * (len(part) - 1)

    def flush(with_overlap: bool = True) -> None:
        nonlocal before, held, tokens
        if not held:
            return
        kept = before[overlap_start([sections[i] for i in before], overlap) :] if with_overlap else []
        out.append((held[0], held[-1] + 1, kept[0] if kept else 0, kept[-1] + 1 if kept else 0, -1))
        note(joined([*kept, *held]))
        before, held, tokens = held[-2:], [], 0

    def target() -> int:
        total = sum(sizes)
        if not total:
            return 10000
        if sizes[0] / total < mix[0]:
            return 4000
        if sizes[1] / total < mix[1]:
            return 10000
        return 16000 if sizes[2] / total < 1 - sum(mix) else 10000

    for i, chars in enumerate(sections):
        n = chars // 4
        if n > most:
            flush()
            first, size = 0, 0
            for k, p in enumerate(paragraphs[i]):
                if size + p // 4 > most and k > first:
                    out.append((i, first, k, 0, i))
                    note(sum(paragraphs[i][first:k]) + 2 * (k - first - 1))
                    first, size = k, 0
                size += p // 4
            out.append((i, first, len(paragraphs[i]), 0, i))
            note(sum(paragraphs[i][first:]) + 2 * (len(paragraphs[i]) - first - 1))
        elif tokens + n > most:
            flush()
            held, tokens = [i], n
        else:
            held.append(i)
            tokens += n
            if tokens >= target():
                flush()
    flush(with_overlap=False)
    return out


def adaptive(docs: DataFrame, key: str, text: str, most: int = 16384, overlap: int = 200) -> DataFrame:
    """Chunks of near target sizes: ``key, chunk_index, content, has_overlap``.

    Sections are the stripped parts between rules of at least 100 characters. The
    order within a document decides, so each document is one fold over the lengths of
    its sections; documents are independent and nothing is shuffled.
    """
    cut = F.filter(F.transform(F.split(text, RULE), T.strip), lambda p: F.length(p) >= LEAST_CHARS)
    source = docs.select(F.col(key).alias("_key"), cut.alias("_s")).where(F.size("_s") > 0)
    lengths = F.transform("_s", F.length)
    paragraphs = F.transform("_s", lambda x: F.when(F.floor(F.length(x) / 4) > most, F.transform(F.split(x, "\n\n"), F.length)).otherwise(F.array().cast("array<int>")))

    def plan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for sizes, parts in batches:
            rows = [[dict(zip("abcdp", x)) for x in adaptive_plan(n, y, most, overlap)] for n, y in zip(sizes.to_pylist(), parts.to_pylist())]
            yield pa.array(rows, pa.list_(pa.struct([(x, pa.int32()) for x in "abcdp"])))

    chosen = F.arrow_udf(plan, "array<struct<a int, b int, c int, d int, p int>>")(lengths, paragraphs)
    each = source.select("_key", "_s", F.posexplode_outer(chosen).alias("chunk_index", "_c"))
    piece = F.expr(r"array_join(slice(split(_s[_c.p], '\n\n'), _c.b + 1, _c.c - _c.b), '\n\n')")
    whole = F.expr(r"array_join(concat(slice(_s, _c.c + 1, _c.d - _c.c), slice(_s, _c.a + 1, _c.b - _c.a)), '\n---\n')")
    return each.select(F.col("_key").alias(key), "chunk_index", F.when(F.col("_c.p") >= 0, piece).otherwise(whole).alias("content"), F.expr("_c.p < 0 and _c.d > _c.c").alias("has_overlap"))


def tagged_samples(chunks: DataFrame, key: str, most: int = 8192, reserve: int = 100) -> DataFrame:
    """Training texts of a chunk within ``most`` tokens: ``key, split, text``.

    ``chunks`` has ``content`` and ``snippets`` (array of file_path, code). The prose comes
    first in a doc tag, cut at a word if it is too long; then the fenced blocks that
    still fit, the others being left out; then the snippets, each that doesn't fit
    opening a new text. Tokens are 1.3 per word, ``reserve`` of them kept free.
    """
    schema = pa.list_(pa.string())

    def words(x: str) -> float:
        return len(x.split()) * 1.3

    def tag_all(prose: str, blocks: list[dict], snippets: list[dict]) -> list[str]:
        parts: list[str] = []
        used, done = 0.0, []
        if prose:
            text = f"<doc>\n{prose}\n</doc>"
            if words(text) + reserve > most:
                fit = int((most - reserve) / 1.3) - 2
                text = f"<doc>\n{' '.join(prose.split()[: max(0, fit)])}\n</doc>"
            parts, used = [text], words(text)
        for b in blocks:
            text = f'<code language="{b["language"]}">\n{b["code"]}\n</code>'
            if used + words(text) + reserve <= most:
                parts.append(text)
                used += words(text)
        for s in snippets:
            text = f'<code language="{s["language"]}" source="{s["file_path"]}">\n{s["code"]}\n</code>'
            if used + words(text) + reserve <= most:
                parts.append(text)
                used += words(text)
            elif parts:
                done.append("\n\n".join(parts))
                parts, used = [text], words(text)
        return [*done, *(["\n\n".join(parts)] if parts else [])]

    def fold(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for prose, blocks, snippets in batches:
            yield pa.array([tag_all(p or "", b or [], s or []) for p, b, s in zip(prose.to_pylist(), blocks.to_pylist(), snippets.to_pylist())], schema)

    texts = F.arrow_udf(fold, "array<string>")(T.without_code_blocks("content"), T.code_blocks("content"), F.col("snippets"))
    return chunks.select(key, F.posexplode_outer(texts).alias("split", "text")).where("text <> ''")
