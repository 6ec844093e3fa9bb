from pyspark.sql import functions as F

from tessella.functions import paths as P
from tessella.functions import text as T


def value(spark, expression, text):
    return spark.createDataFrame([(text,)], "t string").select(expression.alias("x")).first().x


def test_preamble_and_headings(spark):
    md = "junk\n# Title here\n\nbody  \n"
    assert value(spark, T.strip_preamble("t"), md) == "# Title here\n\nbody"
    assert value(spark, T.strip_preamble("t"), "no heading") == ""
    assert value(spark, T.strip_preamble("t"), None) is None
    assert value(spark, T.heading_text("t", F.lit("Section 3")), "x\n### Deep one \r\ny") == "Deep one"
    assert value(spark, T.heading_text("t", F.lit("Section 3")), "x") == "Section 3"
    assert value(spark, T.heading_level("t"), "#### too deep") == 2


def test_code_blocks(spark):
    md = "a\n```rust\nfn x() {}\n```\nb\n```\n\n```\n\n\n\nc\n```\nplain\n```"
    blocks = value(spark, T.code_blocks("t"), md)
    assert [(b.language, b.code) for b in blocks] == [("rust", "fn x() {}"), ("text", "plain")]
    assert value(spark, T.without_code_blocks("t"), md) == "a\n\nb\n\nc"


def test_references(spark):
    refs = value(spark, T.source_references("t"), "see [src/a.rs:3-9]() and [b.rs:7]() and [x](y)")
    assert [tuple(r) for r in refs] == [("src/a.rs", 3, 9), ("b.rs", 7, 7)]
    assert value(spark, T.source_references("t"), "[a:99999999999999999999]()")[0].start_line is None


def test_counts(spark):
    assert value(spark, T.word_count("t"), " a　b c \x1c d ") == 4
    assert value(spark, T.token_count("t"), "x" * 11) == 2
    assert value(spark, T.token_count("t", "words13"), "a b c d") == 5
    stats = value(spark, T.token_stats("t"), "")
    assert (stats.total_tokens, stats.compression_ratio, stats.tokens_per_word) == (0, 0.0, 0.0)
    assert value(spark, T.code_share("t"), "```\nabcdefgh\n```") == 2 * 100 / 4


def test_lines_between(spark):
    get = lambda a, b, t="1\n2\n3\n4": value(spark, T.lines_between("t", F.lit(a), F.lit(b)), t)
    assert get(2, 3) == "2\n3\n"
    assert get(0, 1) == "1\n"
    assert get(4, 99) == "4"
    assert get(9, 12) == ""
    assert get(3, 2) == ""
    assert get(1, 1, None) is None


def test_all_matches(spark):
    for text in ("a1b22", "", "no", f"a1{T.MARK}b22", f"a1{T.PART[0]}", "a1a1"):
        import re

        got = value(spark, T.all_matches("t", r"([a-z])([0-9]+)?", (1, 2, 0)), text)
        assert got == [[m[1], m[2] or "", m[0]] for m in re.finditer(r"([a-z])([0-9]+)?", text)]
        assert value(spark, T.match_count("t", "[a-z]"), text) == len(re.findall("[a-z]", text))
    assert value(spark, T.all_matches("t", "(a)"), None) is None


def test_marks(spark):
    assert value(spark, T.is_generated("t"), "a\n// DO NOT EDIT\n") is True
    assert value(spark, T.is_generated("t"), "\n" * 10 + "// do not edit") is False
    assert value(spark, T.looks_like_markdown("t"), "plain words") is False
    assert value(spark, T.looks_like_markdown("t"), "1. item") is True


def test_slugs(spark):
    assert value(spark, T.slug("t"), "A b/Ü.md") == "a-b-.md"
    assert value(spark, T.slug("t"), "///") == "file"
    assert value(spark, T.url_file_name("t"), "https://h.example/a/Page.JSON?x=1#y") == "page"
    assert value(spark, T.url_file_name("t"), "https://h.example") == "index"


def test_paths(spark):
    path = F.col("t")
    assert value(spark, P.crate_of(path), "crates/one/src/a/mod.rs") == "one"
    assert value(spark, P.crate_of(path, "root"), "main.rs") == "root"
    assert value(spark, P.module_of(path), "crates/one/src/a/mod.rs") == "a"
    assert value(spark, P.module_of(path), "crates/one/src/lib.rs") == "root"
    assert value(spark, P.module_of(path, "crate"), "crates/one/src/a/b.rs") == "one::a::b"
    assert value(spark, P.module_of(path, "source"), "crates/one/src/a/b.rs") == "one::src::a::b"
    assert value(spark, P.module_of(path, "path"), "crates/one/src/b.rs") == "crates/one/src/b"
    assert value(spark, P.language_of(path), "a/b.py") == "python"
    assert value(spark, P.language_of(path), "a/Makefile") == "text"
    assert value(spark, P.is_excluded(path), "target/x.rs") is True
    info = value(spark, P.crate_info(path), "crates/one/src/a/b.rs")
    assert (info.crate, info.module_path, info.file_name) == ("one", ["a", "b"], "b.rs")
    assert value(spark, P.crate_info(path), "src/b.rs").crate is None
