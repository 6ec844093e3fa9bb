"""Column functions on Markdown and other text.

White space is Unicode white space, a line ends only at a line feed, and a length
is in code points. All functions give null for a null text unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a character class that Java and RE2 read alike.
SPACE = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The same characters, for trimming.
SPACES = "".join(map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
NOT_SPACE = SPACE.replace("[", "[^", 1)
#: White space within a line.
GAP = SPACE.replace(r"\x{9}-\x{d}", r"\x{9}\x{b}-\x{d}")
#: Lines only: ^ and $ stop at a line feed.
LINES = "(?md)"
#: Patterns without flags; the same text serves the SQL.
TITLE = rf"^#{SPACE}+[^\n]+[\s\S]*"
HEADING = rf"^(#{{1,3}}){SPACE}+([^\n]+)$"
SUBHEADING = rf"^#{{2,6}}{SPACE}+"
FENCE = r"```([0-9A-Za-z_]*)\n([\s\S]*?)```"
ANY_FENCE = r"```[\s\S]*?```"
REFERENCE = r"\[([^\[\]:\n]+):([0-9]+)(?:-([0-9]+))?\]\(\)"
MARKDOWN_SIGNS = (rf"^{GAP}*#{{1,6}}{SPACE}+{NOT_SPACE}", rf"^{GAP}*[-*]{SPACE}+{NOT_SPACE}", rf"^{GAP}*[0-9]+\.{SPACE}+{NOT_SPACE}", r"```", r"\[[^\]]+\]\([^)]+\)", r"\n\n")
#: What tools write into the first lines of a file.
GENERATED_MARKS = ("@generated", "auto-generated", "this file is generated", "do not edit")
#: File extensions with another language name.
EXTENSION_LANGUAGES = {"rs": "rust", "toml": "toml", "py": "python", "js": "javascript", "ts": "typescript"}


def _col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: Private-use characters between what was found; texts that hold them are searched the slower way.
MARK, PART = "\ue0f1\ue0f2", "\ue0f3\ue0f4"


def match_count(x: str | Column, pattern: str) -> Column:
    """Matches of a pattern, by the growth when each is marked: replacing is linear in the text, collecting all matches isn't."""
    return (F.length(F.regexp_replace(_col(x), f"({pattern})", "$1" + MARK[0])) - F.length(_col(x))).cast("long")


def all_matches(x: str | Column, pattern: str, groups: tuple[int, ...] = (1,)) -> Column:
    """The groups of every match, an array of strings per match; groups that took no part are empty.

    ``regexp_extract_all`` copies the whole text for each match. Here one replacement
    marks all matches and two splits take them out, in time linear in the text.
    """
    x = _col(x)
    marked = F.regexp_replace(x, pattern, MARK + PART.join(f"${g}" for g in groups) + MARK)
    quick = F.transform(F.filter(F.split(marked, MARK), lambda _, k: k % 2 == 1), lambda m: F.split(m, PART))
    each = [F.regexp_extract_all(x, F.lit(pattern), F.lit(g)) for g in groups]
    slow = F.transform(each[0], lambda a, k: F.array(a, *[F.get(e, k) for e in each[1:]]))
    return F.when(x.contains(MARK[0]) | x.contains(PART[0]), slow).otherwise(quick)


def strip(x: str | Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(_col(x), F.lit(SPACES))


def strip_preamble(x: str | Column) -> Column:
    """The text from its first level-1 heading on, stripped; empty without one."""
    return strip(F.regexp_extract(_col(x), LINES + TITLE, 0))


def heading_text(x: str | Column, default: Column) -> Column:
    """The first heading of level 1 to 3, else the default."""
    return F.coalesce(F.nullif(strip(F.regexp_extract(_col(x), LINES + HEADING, 2)), F.lit("")), default)


def heading_level(x: str | Column, default: int = 2) -> Column:
    return F.coalesce(F.nullif(F.length(F.regexp_extract(_col(x), LINES + HEADING, 1)), F.lit(0)), F.lit(default))


def subsection_count(x: str | Column) -> Column:
    return match_count(x, LINES + SUBHEADING)


def code_blocks(x: str | Column) -> Column:
    """Fenced blocks as structs of language (``text`` if none) and stripped code; empty blocks are left out."""
    pairs = F.transform(all_matches(x, FENCE, (1, 2)), lambda m: F.struct(F.coalesce(F.nullif(m[0], F.lit("")), F.lit("text")).alias("language"), strip(m[1]).alias("code")))
    return F.filter(pairs, lambda p: p["code"] != "")


def without_code_blocks(x: str | Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(_col(x), ANY_FENCE, ""), r"\n{3,}", "\n\n"))


def word_count(x: str | Column) -> Column:
    return F.size(F.filter(F.split(_col(x), SPACE + "+"), lambda w: w != "")).cast("long")


def token_count(x: str | Column, mode: str = "chars4") -> Column:
    """Estimated tokens: a quarter of the characters (``chars4``) or 1.3 per word (``words13``)."""
    if mode == "chars4":
        return F.floor(F.length(_col(x)) / 4).cast("long")
    if mode == "words13":
        return F.floor(word_count(x) * 1.3).cast("long")
    raise ValueError(f"unknown mode {mode}")


def token_stats(x: str | Column) -> Column:
    """Struct of tokens, characters, characters per token and tokens per word; 0 where the divisor is 0."""
    tokens, chars = token_count(x), F.length(_col(x)).cast("long")
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    return F.struct(tokens.alias("total_tokens"), chars.alias("total_chars"), ratio(chars, tokens).alias("compression_ratio"), ratio(tokens, word_count(x)).alias("tokens_per_word"))


def code_share(x: str | Column) -> Column:
    """Percentage of a text's tokens that lie in fenced blocks."""
    inside = F.aggregate(code_blocks(x), F.lit(0).cast("long"), lambda n, b: n + token_count(b["code"]))
    return F.coalesce(F.try_divide(inside * 100.0, token_count(x)), F.lit(0.0))


def source_references(x: str | Column) -> Column:
    """References ``[path:start-end]()`` as structs; the end defaults to the start, numbers too large are null."""
    number = lambda c: c.try_cast("long")
    return F.transform(all_matches(x, REFERENCE, (1, 2, 3)), lambda m: F.struct(m[0].alias("file_path"), number(m[1]).alias("start_line"), number(F.when(m[2] == "", m[1]).otherwise(m[2])).alias("end_line")))


def looks_like_markdown(x: str | Column) -> Column:
    """Whether any of a heading, bullet, numbered item, fence, link or blank line occurs."""
    out = _col(x).rlike(LINES + MARKDOWN_SIGNS[0])
    for sign in MARKDOWN_SIGNS[1:]:
        out = out | _col(x).rlike(LINES + sign)
    return out


def is_generated(x: str | Column) -> Column:
    """Whether a tool's mark stands in the first ten lines."""
    head = F.lower(F.substring_index(_col(x), "\n", 10))
    out = F.lit(False)
    for mark in GENERATED_MARKS:
        out = out | head.contains(mark)
    return out


def is_test_file(path: str | Column, x: str | Column) -> Column:
    inside = _col(x).contains("#[cfg(test)]") | _col(x).contains("mod tests {")
    return F.concat(F.lit("/"), _col(path)).contains("/tests/") | _col(path).endswith("_test.rs") | F.coalesce(inside, F.lit(False))


def size_bucket(tokens: str | Column) -> Column:
    t = _col(tokens)
    return F.when(t < 4000, "small").when(t < 10000, "medium").when(t >= 10000, "large")


def lines_between(x: str | Column, start: Column, end: Column) -> Column:
    """Lines start to end (from 1, both included, clamped) with their line ends; null for a null text, empty outside it."""
    parts = F.split(_col(x), "\n")  # each but the last has its line end
    total = F.size(parts) - F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
    first, last = F.greatest(start, F.lit(1)).cast("int"), F.least(end, total).cast("int")
    count = F.greatest(last - first + 1, F.lit(0))
    text = F.concat(F.array_join(F.slice(parts, first, count), "\n"), F.when((count > 0) & (last < F.size(parts)), "\n").otherwise(""))
    return F.when(_col(x).isNotNull(), text)


def slug(x: str | Column) -> Column:
    """Lower case, other characters than letters, digits, dot, underscore and dash as one dash, at most 200; ``file`` if nothing is left."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(_col(x)), "[^a-z0-9._-]+", "-"), r"\A-+|-+\z", "")
    return F.coalesce(F.nullif(F.substring(plain, 1, 200), F.lit("")), F.lit("file"))


def url_file_name(url: str | Column) -> Column:
    """Slug of a URL's last path part without a web extension; ``index`` for an empty path."""
    path = F.regexp_extract(_col(url), r"\A(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    last = F.regexp_extract(path, r"([^/]+)/*\z", 1)
    return slug(F.regexp_replace(F.coalesce(F.nullif(last, F.lit("")), F.lit("index")), r"(?i)\.(?:json|txt|js|jsx|ts|tsx)\z", ""))
