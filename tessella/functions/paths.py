"""Column functions on file paths: crate, module, language, layer, exclusion."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions.text import EXTENSION_LANGUAGES

#: Parts of paths that hold no source worth keeping.
EXCLUDED = ("/target/", "/generated/", ".gen.rs", "/build/")
#: Architectural layers by a part of a crate's or type's name, in order; a deployment gives its own.
CRATE_LAYERS = (("api", ("gate", "wire")), ("domain", ("core",)), ("database", ("vault",)))


def parts_of(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda p: p != "")


def crate_of(path: Column, root: str = "name") -> Column:
    """The part after ``crates``, else the first part. A file at the root gives its own name (``name``) or the word given."""
    parts = parts_of(path)
    at = F.array_position(parts, "crates").cast("int")
    first = F.get(parts, F.lit(0)) if root == "name" else F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).otherwise(F.lit(root))
    return F.when((at > 0) & (F.size(parts) > at), F.get(parts, at)).otherwise(first)


def module_of(path: Column, style: str = "plain") -> Column:
    """Module path of a Rust file, joined by ``::``.

    Styles: ``plain`` drops crates, the crate, src and the stems mod and lib (root if
    nothing is left); ``crate`` starts at the crate and drops one src; ``source`` starts
    at the crate and keeps src; ``path`` keeps the slashes of the whole path.
    """
    parts = parts_of(path)
    if style == "path":
        return F.regexp_replace(F.array_join(parts, "/"), r"\.rs\z", "")
    at = F.array_position(parts, "crates").cast("int")
    after = F.when(at > 0, F.slice(parts, at + 1, F.size(parts))).otherwise(parts)
    if style in ("crate", "source"):
        if style == "crate":
            src = F.array_position(after, "src").cast("int")
            after = F.when(src > 0, F.concat(F.slice(after, F.lit(1), src - 1), F.slice(after, src + 1, F.size(after)))).otherwise(after)
        return F.regexp_replace(F.array_join(after, "::"), r"\.rs\z", "")
    if style != "plain":
        raise ValueError(f"unknown style {style}")
    inner = F.when(at > 0, F.slice(parts, at + 2, F.size(parts))).otherwise(parts)
    inner = F.when(F.get(inner, F.lit(0)) == "src", F.slice(inner, 2, F.size(inner))).otherwise(inner)
    joined = F.regexp_replace(F.regexp_replace(F.array_join(inner, "::"), r"\.rs\z", ""), r"(?:\A|::)(?:mod|lib)\z", "")
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("root"))


def crate_info(path: Column) -> Column:
    """Struct of crate (null outside ``crates``), module path behind ``src`` as an array, and file name."""
    parts = parts_of(path)
    at, src = F.array_position(parts, "crates").cast("int"), F.array_position(parts, "src").cast("int")
    inside = (at > 0) & (F.size(parts) > at)
    stem = F.regexp_replace(F.element_at(parts, -1), r"(.)\.[^.]*\z", "$1")
    folders = F.slice(parts, src + 1, F.greatest(F.size(parts) - src - 1, F.lit(0)))
    module = F.when(stem.isin("mod", "lib"), folders).otherwise(F.concat(folders, F.array(stem)))
    none = F.array().cast("array<string>")
    return F.struct(F.when(inside, F.get(parts, at)).alias("crate"), F.when(inside & (src > 0), module).otherwise(none).alias("module_path"), F.element_at(parts, -1).alias("file_name"))


def language_of(path: Column) -> Column:
    """Language by extension; the extension itself if unknown, ``text`` without one."""
    name = F.element_at(parts_of(path), -1)
    ext = F.regexp_extract(name, r".\.([^.]+)\z", 1)
    known = F.create_map(*map(F.lit, chain(*EXTENSION_LANGUAGES.items())))
    return F.when(ext == "", "text").otherwise(F.coalesce(F.try_element_at(known, ext), ext))


def layer_of(name: Column, layers=CRATE_LAYERS, default: str = "other") -> Column:
    out = F
    for layer, marks in layers:
        test = F.lit(False)
        for mark in marks:
            test = test | name.contains(mark)
        out = out.when(test, layer)
    return out.otherwise(default)


def is_excluded(path: Column, marks=EXCLUDED) -> Column:
    """Whether the path, taken from the root, holds one of the marks."""
    whole, out = F.concat(F.lit("/"), path), F.lit(False)
    for mark in marks:
        out = out | whole.contains(mark)
    return out
