"""Items of a Rust text by pattern and brace count: a small per-row helper.

Unlike ``rust_items`` these look neither at literals nor at comments: braces in
them count, as in the corpora these operators reproduce.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

#: The signature patterns.
FUNCTION = re.compile(r"(?:pub(?:\([^)]+\))?\s+)?(?:async\s+)?(?:unsafe\s+)?(?:const\s+)?fn\s+(\w+)(?:<[^>]+>)?\s*\([^)]*\)(?:\s*->\s*[^{]+)?\s*\{")
STRUCT = re.compile(r"(?:pub(?:\([^)]+\))?\s+)?struct\s+(\w+)(?:<[^>]+>)?(?:\s*\{[^}]*\}|;)")
IMPL = re.compile(r"impl(?:<[^>]+>)?\s+(?:(\w+)(?:<[^>]+>)?)\s*(?:for\s+(\w+)(?:<[^>]+>)?)?\s*\{")
FUNCTION_LINE = re.compile(r"^\s*(pub(?:\([^)]+\))?\s+)?(?:async\s+)?(?:unsafe\s+)?(?:const\s+)?fn\s+(\w+)(<[^>]+>)?\s*\(([^)]*)\)(?:\s*->\s*([^{;]+))?")
STRUCT_LINE = re.compile(r"^\s*(pub(?:\([^)]+\))?\s+)?struct\s+(\w+)(<[^>]+>)?")
TRAIT_LINE = re.compile(r"^\s*(pub(?:\([^)]+\))?\s+)?trait\s+(\w+)(<[^>]+>)?")
IMPL_LINE = re.compile(r"^\s*impl(?:<[^>]+>)?\s+((?:\w+(?:::\w+)*)\s+for\s+)?(\w+)")
IMPL_BLOCK = re.compile(r"impl(?:\s+<[^>]+>)?\s+(?:(\w+)\s+for\s+)?(\w+)(?:\s+where[^{]*?)?\s*\{")

_BRACE = re.compile(r"[{}]")


def block_end(code: str, start: int) -> int | None:
    """Behind the brace that closes the first block opened from ``start`` on."""
    depth = 0
    for m in _BRACE.finditer(code, start):
        depth += 1 if m[0] == "{" else -1
        if depth == 0:
            return m.end()
        if depth < 0:
            depth = 0 if m[0] == "}" else depth
    return None


def _item(kind: str, name: str | None, line: int, code: str, trait: str | None = None, public: bool | None = None, doc: str | None = None, count: int | None = None) -> dict:
    return {"kind": kind, "name": name, "line": line, "code": code, "trait_name": trait, "is_public": public, "doc": doc, "count": count}


def _blocks(code: str, pattern: re.Pattern, make: Callable[[re.Match, str, int], dict]) -> Iterator[dict]:
    for m in pattern.finditer(code):
        if end := block_end(code, m.start()):
            yield make(m, code[m.start() : end], code.count("\n", 0, m.start()) + 1)


def functions(code: str) -> list[dict]:
    """Functions whose signature the pattern knows, up to their closing brace."""
    return list(_blocks(code, FUNCTION, lambda m, text, line: _item("function", m[1], line, text)))


def structs_and_impls(code: str) -> list[dict]:
    """Structs to their first closing brace or semicolon, then impl blocks, named by the first type they mention."""
    structs = [_item("struct", m[1], code.count("\n", 0, m.start()) + 1, m[0]) for m in STRUCT.finditer(code)]
    return structs + list(_blocks(code, IMPL, lambda m, text, line: _item("impl", m[1], line, text, trait=m[1] if m[2] else None)))


def impl_blocks(code: str) -> list[dict]:
    return list(_blocks(code, IMPL_BLOCK, lambda m, text, line: _item("impl", m[2], line, text, trait=m[1])))


def doc_above(lines: list[str], at: int) -> str:
    """The ``///`` lines above line ``at``, attributes between them passed over, joined by spaces."""
    found: list[str] = []
    for line in map(str.strip, reversed(lines[:at])):
        if line.startswith("///"):
            found.append(line[3:].strip())
        elif not line.startswith("#["):
            break
    return " ".join(reversed(found))


def _end_line(lines: list[str], at: int, must_open: bool) -> int:
    depth, opened = 0, False
    if must_open and "{" not in lines[at]:
        return at
    for k in range(at, len(lines)):
        opened = opened or "{" in lines[k]
        depth += lines[k].count("{") - lines[k].count("}")
        if opened and depth == 0 and (k > at or not must_open):
            return k
    return at


def by_line(code: str) -> list[dict]:
    """Functions, structs, traits and impls whose header stands on one line, with documentation and counts."""
    lines = code.split("\n")
    found = []
    for k, line in enumerate(lines):
        if m := FUNCTION_LINE.match(line):
            found.append(_item("function", m[2], k + 1, "\n".join(lines[k : _end_line(lines, k, False) + 1]), public=bool(m[1]), doc=doc_above(lines, k)))
        if m := STRUCT_LINE.match(line):
            named = len(re.findall(rf"impl(?:<[^>]+>)?\s+(?:\w+(?:::\w+)*\s+for\s+)?{re.escape(m[2])}", code))
            found.append(_item("struct", m[2], k + 1, "\n".join(lines[k : _end_line(lines, k, True) + 1]), public=bool(m[1]), doc=doc_above(lines, k), count=named))
        if m := TRAIT_LINE.match(line):
            found.append(_item("trait", m[2], k + 1, "\n".join(lines[k : _end_line(lines, k, True) + 1]), public=bool(m[1]), doc=doc_above(lines, k)))
        if m := IMPL_LINE.match(line):
            text = "\n".join(lines[k : _end_line(lines, k, True) + 1])
            methods = text.count("\n    fn ") + text.count("\n    pub fn ")
            found.append(_item("impl", m[2], k + 1, text, trait=m[1].replace(" for ", "").strip() if m[1] else None, count=methods))
    return found
