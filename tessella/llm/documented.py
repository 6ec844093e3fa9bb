"""Functions paired with their documentation."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.rust_items import RustSource

#: Words that say nothing, and first words that mark documentation still to be written.
FILLERS = "a an and as at by for from in into is it of on or that the this to with".split()
UNWRITTEN = "todo fixme tbd wip xxx".split()
LEAST_WORDS = 4

_WORD = re.compile(r"[^\W_]+")
_FENCE = re.compile(r"^\s*(`{3,}(?=[^`]*$)|~{3,})")
_HEADING = re.compile(r"^\s{0,3}#{1,6}(?:\s|$)")
_FILLING = frozenset(re.sub("s$", "", w) for w in FILLERS)
_UNWRITTEN = frozenset(re.sub("s$", "", w) for w in UNWRITTEN)

_FIELDS = [
    ("file_id", pa.int64()), ("start_line", pa.int64()), ("end_line", pa.int64()), ("name", pa.string()), ("signature", pa.string()), ("visibility", pa.string()), ("full_text", pa.string()), ("doc_comments", pa.string()),
    ("is_async", pa.bool_()), ("is_unsafe", pa.bool_()), ("is_const", pa.bool_()), ("is_pub", pa.bool_()), ("generic_params", pa.list_(pa.string())), ("where_clause", pa.string()), ("params", pa.list_(pa.string())), ("return_type", pa.string()),
    ("attributes", pa.list_(pa.string())), ("impl_context", pa.struct([("for_type", pa.string()), ("trait_name", pa.string())])),
]
SCHEMA = pa.schema(_FIELDS)
DDL = "file_id long, start_line long, end_line long, name string, signature string, visibility string, full_text string, doc_comments string, is_async boolean, is_unsafe boolean, is_const boolean, is_pub boolean, generic_params array<string>, where_clause string, params array<string>, return_type string, attributes array<string>, impl_context struct<for_type: string, trait_name: string>"


def prose(doc: str) -> list[str]:
    """The words of a documentation text outside headings and fenced code, in lower case without a final s."""
    lines, fence = [], ""
    for line in doc.split("\n"):
        mark = _FENCE.match(line)
        if fence:
            if mark and mark[1].startswith(fence) and not line.strip().strip(fence[0]):
                fence = ""
        elif mark:
            fence = mark[1]
        elif not _HEADING.match(line):
            lines.append(line)
    return [re.sub("s$", "", w.lower()) for w in _WORD.findall("\n".join(lines))]


def is_trivial(doc: str | None, name: str) -> bool:
    """Whether documentation is missing or says nothing beyond the function's name."""
    words = prose(doc or "")
    if len(words) < LEAST_WORDS or words[0] in _UNWRITTEN:
        return True
    own = {re.sub("s$", "", w.lower()) for w in _WORD.findall(name)}
    return all(w in _FILLING or w in own for w in words)


def documented_functions(files: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Functions and methods of the ``.rs`` files that have a body and documentation that isn't trivial, as FunctionInfo rows.

    ``files`` has ``file_id, file_path, code``; null, blank or unfinished code gives
    no rows, a file that occurs twice gives its functions twice. ``columns`` limits
    what is built. Documentation is every outer notation (line, block, attribute),
    in order, with its lines joined by spaces; ``start_line`` is the line of ``fn``.
    One map over the scan; files without any doc notation never reach Python.
    """
    wanted = columns or SCHEMA.names
    schema = pa.schema([SCHEMA.field(c) for c in wanted])
    light = set(wanted) <= {"file_id", "start_line"}
    may_hold = F.col("code").contains("fn") & (F.col("code").contains("///") | F.col("code").contains("/**") | F.col("code").contains("doc"))
    source = files.where(F.col("file_path").endswith(".rs") & may_hold).select(F.col("file_id").cast("long"), "code")

    def rows(file_id: int, code: str) -> Iterator[dict]:
        rust = RustSource(code)
        if not rust.docs:
            return
        for f in rust.functions():
            if is_trivial(rust._documentation(f["zone"], f["at"]), f["name"]):
                continue
            if light:
                yield {"file_id": file_id, "start_line": rust.line(f["at"])}
                continue
            row = rust.describe(f)
            row["doc_comments"] = " ".join(x.strip() for x in row["doc_comments"].split("\n")).strip()
            within = rust.enclosing_impl(f["at"])
            if within:
                trait, for_type, _ = rust.impl_parts(within["header"])
                row["impl_context"] = {"for_type": for_type, "trait_name": trait}
            yield {"file_id": file_id, "impl_context": None, **row}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for file_id, code in zip(batch.column(0).to_pylist(), batch.column(1)):
                out += rows(file_id, code.as_py())
                if len(out) >= 5000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema)

    parts = dict(re.match(r"(\w+) (.*)", x).groups() for x in re.split(r", (?=\w+ (?:long|string|boolean|array|struct))", DDL))
    return source.mapInArrow(extract, ", ".join(f"{c} {parts[c]}" for c in wanted))


def documented_pairs(files: DataFrame) -> DataFrame:
    """FunctionInfo rows with the file's path, crate and module, each function once however often its file's row is repeated."""
    once = documented_functions(files).dropDuplicates(["file_id", "start_line", "name"])
    names = files.groupBy("file_id").agg(F.max("file_path").alias("file_path"), F.max("crate").alias("crate"), F.max("module").alias("module"))
    return once.join(names, "file_id")


def found(files: DataFrame) -> DataFrame:
    """``file_id, fn_line`` of every documented function, once."""
    return documented_functions(files, ["file_id", "start_line"]).select("file_id", F.col("start_line").alias("fn_line")).distinct()
