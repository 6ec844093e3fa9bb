"""Functions of one Rust source text: a small per-row helper of ``documented``.

``RustSource`` blanks out what holds no items (comments, literals, attributes,
macro definitions and invocations), keeping every offset, so that plain patterns
and one table of brace pairs find functions in the text that is left.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import cached_property

_LITERAL = re.compile(
    r"""//[^\n]*|/\*|\b[bc]?r(?P<hashes>\#*)"|\b[bc]?"(?:[^"\\]|\\.)*(?:"|\Z)|"(?:[^"\\]|\\.)*(?:"|\Z)|\bb'(?:\\(?:u\{[^}]*\}|x[0-9a-fA-F]{2}|.)|[^\\'\n])'|'(?:\\(?:u\{[^}]*\}|x[0-9a-fA-F]{2}|.)|[^\\'\n])'""",
    re.S,
)
_COMMENT = re.compile(r"/\*|\*/")
_BRACKET = re.compile(r"[()\[\]{}]")
_NOT_NEWLINE = re.compile(r"[^\n]")
_ATTRIBUTE = re.compile(r"#\s*(!?)\s*\[")
_KEYWORDS = "as|break|const|continue|else|enum|extern|fn|for|if|impl|in|let|loop|match|mod|move|mut|pub|ref|return|static|struct|trait|type|unsafe|use|where|while|async|await|dyn|yield|box"
_BANG = re.compile(r"!\s*(?P<name>[^\W\d]\w*\s*)?[({\[]")
_DECLARED = re.compile(r"\bmacro\s+(?P<name>[^\W\d]\w*)\s*[({]")
_BODY = re.compile(r"\s*\{")
_RESERVED = frozenset(_KEYWORDS.split("|"))
_FUNCTION = re.compile(r"\bfn\s+(?:r#)?([^\W\d]\w*)")
_SIGNATURE = re.compile(r"->|=>|[()\[\]{};<>]")
_ITEM = re.compile(r"\b(impl|trait|struct|enum|union|use|mod)\b")
_QUALIFIERS = re.compile(r'(?P<vis>pub ?\([^()]*\) ?|(?:pub|crate)(?: |$))?(?:(?:default|const|async|unsafe|safe|gen|extern ?(?:" ?")?)(?: |$))*')
_DOC_ATTRIBUTE = re.compile(r'\bdoc\s*=\s*(?:r(#*)"(.*?)"\1|"((?:[^"\\]|\\.)*)")', re.S)
_ESCAPE = re.compile(r"\\(?:u\{([0-9a-fA-F_]+)\}|x([0-9a-fA-F]{2})|(\n\s*)|(.))", re.S)


def _blank(text: str) -> str:
    return " " * len(text) if "\n" not in text else _NOT_NEWLINE.sub(" ", text)


def _unescape(text: str) -> str:
    plain = {"n": "\n", "t": "\t", "r": "\r", "0": "\0"}

    def one(m: re.Match) -> str:
        if m[1] or m[2]:
            return chr(min(int((m[1] or m[2]).replace("_", ""), 16), 0x10FFFF))
        return "" if m[3] else plain.get(m[4], m[4])

    return _ESCAPE.sub(one, text)


def split_top(text: str, separator: str = ",") -> list[str]:
    """The parts of ``text`` between separators outside all brackets, stripped, empty ones left out."""
    parts, depth, at = [], 0, 0
    for m in re.finditer(r"->|=>|[()\[\]{}<>,+]", text):
        x = m[0]
        if x in "([{<":
            depth += 1
        elif x in ")]}>" and len(x) == 1:
            depth -= 1
        elif x == separator and depth == 0:
            parts.append(text[at : m.start()])
            at = m.end()
    return [p for p in (x.strip() for x in [*parts, text[at:]]) if p]


def _angle_end(text: str, at: int) -> int:
    """Behind the ``>`` that closes the ``<`` at ``at``; ``at`` if none does."""
    depth = 0
    for m in re.finditer(r"->|=>|[<>]", text[at:]):
        depth += (m[0] == "<") - (m[0] == ">")
        if depth == 0:
            return at + m.end()
    return at


def _called(text: str, low: int, end: int) -> tuple[int, str]:
    """Where the path that ends before ``end`` begins (not before ``low``), and its last word; the word is empty without one."""
    begin, word, at = end, "", end
    while True:
        while at > low and text[at - 1].isspace():
            at -= 1
        stop = at
        while at > low and (text[at - 1] == "_" or text[at - 1].isalnum()):
            at -= 1
        if at == stop:
            return begin, word
        begin, word = at, word or text[at:stop]
        while at > low and text[at - 1].isspace():
            at -= 1
        if at - 2 < low or text[at - 2 : at] != "::":
            return begin, word
        at -= 2


class RustSource:
    """One text, with ``docs`` and ``attributes`` as (start, end, text), ``macros`` as (start, end, name, kind)."""

    def __init__(self, code: str) -> None:
        self.code = code
        self.docs: list[tuple[int, int, str]] = []
        self.attributes: list[tuple[int, int, str]] = []
        self.macros: list[tuple[int, int, str, str]] = []
        self.text = self._without_macros(self._without_attributes(self._without_literals()))

    def _without_literals(self) -> str:
        code, out, at = self.code, [], 0
        while m := _LITERAL.search(code, at):
            start, end, first = m.start(), m.end(), m[0]
            out.append(code[at:start])
            if first.startswith("//"):
                if first.startswith("///") and not first.startswith("////"):
                    self.docs.append((start, end, first[3:].rstrip("\r")))
                out.append(" " * (end - start))
            elif first == "/*":
                depth, end = 1, len(code)
                for c in _COMMENT.finditer(code, m.end()):
                    depth += 1 if c[0] == "/*" else -1
                    if depth == 0:
                        end = c.end()
                        break
                whole = code[start:end]
                if whole.startswith("/**") and not whole.startswith(("/***", "/**/")) and depth == 0:
                    self.docs.append((start, end, "\n".join(re.sub(r"^\s*\*+", "", x.rstrip("\r")) for x in whole[3:-2].split("\n"))))
                out.append(_blank(whole))
            else:
                if m["hashes"] is not None:
                    close = code.find('"' + m["hashes"], end)
                    end = len(code) if close < 0 else close + 1 + len(m["hashes"])
                body = _blank(code[start:end])
                out.append('"' + body[1:-1] + '"' if len(body) > 1 else body)
            at = end
        out.append(code[at:])
        return "".join(out)

    def _without_attributes(self, text: str) -> str:
        out, at = [], 0
        while m := _ATTRIBUTE.search(text, at):
            end = self._close(text, m.end() - 1)
            whole = self.code[m.start() : end]
            out += [text[at : m.start()], _blank(whole)]
            if not m[1]:
                self.attributes.append((m.start(), end, whole))
                if "doc" in whole and re.match(r"#\s*\[\s*(doc\s*=|cfg_attr\b)", whole):
                    for d in _DOC_ATTRIBUTE.finditer(whole):
                        self.docs.append((m.start() + d.start(), end, d[2] if d[3] is None else _unescape(d[3])))
            at = end
        out.append(text[at:])
        self.docs.sort()
        return "".join(out)

    def _without_macros(self, text: str) -> str:
        out, at, looked = [], 0, 0
        declared = "macro " in text
        while True:
            m = _BANG.search(text, looked)
            d = _DECLARED.search(text, looked) if declared else None
            if d and (not m or d.start() < m.start()):
                start, end, name, kind = d.start(), self._close(text, d.end() - 1), d["name"], "definition"
                if text[d.end() - 1] == "(" and (body := _BODY.match(text, end)):  # the pattern, then the body
                    end = self._close(text, body.end() - 1)
            elif m:
                start, word = _called(text, at, m.start())
                rules = word == "macro_rules"
                if not word or word[0].isdigit() or word in _RESERVED or bool(m["name"]) != rules:
                    looked = m.start() + 1
                    continue
                end = self._close(text, m.end() - 1)
                name, kind = (m["name"].strip(), "definition") if rules else (word, "call")
            else:
                break
            self.macros.append((start, end, name, kind))
            blank = _blank(text[start:end])
            out += [text[at:start], blank[:-1] + (";" if self._at_item(text, start) else "0")]
            at = looked = end
        out.append(text[at:])
        return "".join(out)

    @staticmethod
    def _at_item(text: str, start: int) -> bool:
        while start and text[start - 1].isspace():
            start -= 1
        return not start or text[start - 1] in "{};"

    @staticmethod
    def _close(text: str, at: int) -> int:
        depth = 0
        for m in _BRACKET.finditer(text, at):
            depth += 1 if m[0] in "([{" else -1
            if depth == 0:
                return m.end()
        return len(text)

    @cached_property
    def braces(self) -> dict[int, int]:
        """For each opening brace that is closed, the place behind its closing one."""
        pairs, stack = {}, []
        for m in re.finditer(r"[{}]", self.text):
            if m[0] == "{":
                stack.append(m.start())
            elif stack:
                pairs[stack.pop()] = m.end()
        return pairs

    @cached_property
    def _line_ends(self) -> list[int]:
        return [m.start() for m in re.finditer("\n", self.code)]

    @cached_property
    def _doc_starts(self) -> list[int]:
        return [d[0] for d in self.docs]

    def line(self, at: int) -> int:
        return bisect_left(self._line_ends, at) + 1

    def _before(self, start: int) -> int:
        """Behind the last brace or semicolon before ``start``: an item's attributes, documentation and qualifiers lie after it."""
        return max(self.text.rfind(x, 0, start) for x in "{};") + 1

    def _qualified(self, zone: int, start: int) -> tuple[int, str, list[str]] | None:
        """Where an item with its qualifiers begins, its visibility and its other words; None if something else stands before it."""
        gap = self.text[zone:start]
        words = gap.split()
        if not words:
            return start, "private", []
        m = _QUALIFIERS.fullmatch(" ".join(words))
        if m is None:
            return None
        return start - len(gap.lstrip()), (m["vis"] or "").strip() or "private", words

    def _documentation(self, start: int, end: int) -> str | None:
        own = [d for _, _, d in self.docs[bisect_left(self._doc_starts, start) : bisect_left(self._doc_starts, end)]]
        return "\n".join(own) if own else None

    def _attributes(self, start: int, end: int) -> list[str]:
        return [x for a, _, x in self.attributes if start <= a < end]

    def functions(self) -> list[dict]:
        """Every function with a body, in order: offsets, name, signature, documentation and what the signature says."""
        text, found = self.text, []
        for m in _FUNCTION.finditer(text):
            start = self._before(m.start())
            q = self._qualified(start, m.start())
            body = self._body(m.end()) if q else None
            if q is None or body is None or body not in self.braces:
                continue
            found.append({"name": m[1], "at": m.start(), "begin": q[0], "body": body, "end": self.braces[body], "zone": start, "visibility": q[1], "words": q[2]})
        return found

    def _body(self, at: int) -> int | None:
        depth = angle = 0
        skip = -1
        for m in _SIGNATURE.finditer(self.text, at):
            x = m[0]
            if m.start() < skip:
                continue
            if x in "([":
                depth += 1
            elif x in ")]":
                depth -= 1
                if depth < 0:
                    return None
            elif x in "<>":
                if depth == 0:  # within brackets they may be shifts or comparisons
                    angle += 1 if x == "<" else -1
            elif x == "{":
                if depth == 0 and angle <= 0:
                    return m.start()
                skip = self.braces.get(m.start(), len(self.text))
            elif (x == ";" and depth == 0) or x == "}":
                return None
        return None

    def describe(self, f: dict) -> dict:
        """A found function's row: signature parts, attributes, documentation, lines and text."""
        head = self.text[f["at"] : f["body"]]
        signature = self.code[f["begin"] : f["body"]].strip().replace("\r\n", "\n")
        rest = head[head.index(f["name"]) + len(f["name"]) :]
        lead = len(rest) - len(rest.lstrip())
        generics = ""
        if rest[lead : lead + 1] == "<":
            stop = _angle_end(rest, lead)
            generics, rest = rest[lead + 1 : stop - 1], rest[stop:]
        open_ = rest.find("(")
        close = self._close(rest, open_) if open_ >= 0 else 0
        tail = rest[close:]
        where = re.search(r"\bwhere\b", tail)
        arrow = re.match(r"\s*->(.*)", tail[: where.start()] if where else tail, re.S)
        squeeze = lambda x: " ".join(x.split())
        return {
            "start_line": self.line(f["at"]), "end_line": self.line(f["end"] - 1), "name": f["name"], "signature": signature, "visibility": f["visibility"],
            "full_text": self.code[f["begin"] : f["end"]], "doc_comments": self._documentation(f["zone"], f["at"]), "is_async": "async" in f["words"], "is_unsafe": "unsafe" in f["words"],
            "is_const": "const" in f["words"], "is_pub": f["visibility"] == "pub", "generic_params": [squeeze(x) for x in split_top(generics)], "where_clause": squeeze(tail[where.end() :]).rstrip(",") if where else None,
            "params": [squeeze(x) for x in split_top(rest[open_ + 1 : close - 1])] if open_ >= 0 else [], "return_type": squeeze(arrow[1]) if arrow else None, "attributes": [a for a in self._attributes(f["zone"], f["at"]) if not re.match(r"#\s*\[\s*doc\b", a)],
        }

    @cached_property
    def items(self) -> list[dict]:
        """impl, trait, struct, enum, union, use and mod items: kind, name, header, offsets, visibility."""
        found = []
        for m in _ITEM.finditer(self.text):
            zone = self._before(m.start())
            q = self._qualified(zone, m.start())
            if q is None:
                continue
            end = re.compile(r";" if m[1] == "use" else r"[{;]").search(self.text, m.end())
            if not end:
                continue
            header = " ".join(self.text[m.start() : end.start()].split())
            close = self.braces.get(end.start(), end.end())
            name = re.match(r"\w+\s+(?:r#)?([^\W\d]\w*)", header)
            found.append({"kind": m[1], "name": name[1] if name and m[1] != "impl" else None, "header": header, "zone": zone, "at": m.start(), "body": end.start(), "end": close, "visibility": q[1]})
        return found

    @staticmethod
    def impl_parts(header: str) -> tuple[str | None, str, str]:
        """Trait (or None), type and generics of an impl header."""
        rest, generics = header[4:].lstrip(), ""
        if rest.startswith("<"):
            stop = _angle_end(rest, 0)
            generics, rest = rest[1 : stop - 1], rest[stop:].strip()
        rest = re.split(r"\bwhere\b", rest)[0].strip()
        depth = 0
        for m in re.finditer(r"->|[<>]|\bfor\b(?!\s*<)", rest):
            depth += (m[0] == "<") - (m[0] == ">")
            if m[0] == "for" and depth == 0:
                return rest[: m.start()].strip(), rest[m.end() :].strip(), generics
        return None, rest, generics

    def enclosing_impl(self, at: int) -> dict | None:
        around = [x for x in self.items if x["kind"] == "impl" and x["body"] < at < x["end"]]
        return max(around, key=lambda x: x["body"]) if around else None
