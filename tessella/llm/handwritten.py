"""Telling hand-written source from generated, minified and vendored files and blocks of data.

Giveaways (markers in the first or last comment, telling paths, code that is all
literals) only label files for training. Per kind two
linear support-vector classifiers learn from a bounded, weighted sample: one sees
the code with its giveaways masked, as hashed character n-grams and path
components, the other the words of the outer comments and all parts of the path.
They are judged on crates they have not seen. A file is of a kind if one of the
kind's classifiers says so, or if it is a copy of a file found to be vendored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.spark_util import cut

KINDS = ("generated", "minified", "vendored", "data")
#: The classifiers: a view of the file and a kind. Blocks of data carry no marks.
MODELS = (*(("code", k) for k in KINDS), *(("marks", k) for k in KINDS if k != "data"))
#: Bounds of the training sample: about as many files of each kind, and without any giveaway.
SAMPLE_PER_KIND = 1_000
SAMPLE_PLAIN = 2_500
#: Kinds that come without any giveaway as often as with one; tools and importers, in contrast, sign or place what they write.
#: What looks like the files of such a kind is taken for it where at least the share ``SIGNED`` bears the giveaway.
SILENT = ("minified",)
SIGNED = 0.4
#: A classifier is used only if it finds this share of the files with the giveaway in unseen crates; of what it finds there
#: this share must have it (but for silent kinds), and its threshold is raised until it does. Code is the weaker evidence.
LEAST_FILES = 10
LEAST_RECALL = 0.25
LEAST_SHARE = {"code": 0.98, "marks": 0.9}
GRAM = 4
BUCKETS = 1 << 13
PATH_BUCKETS = 1 << 12
WORD_BUCKETS = 1 << 16
SIZES = {"code": BUCKETS + PATH_BUCKETS, "marks": WORD_BUCKETS}
COPY_CHARS = 120

_COMMENT = r"(?://[/!]*|/\*+!?|\*+|#+!?(?!\[)|--+|;|<!--)"
#: How tools and importers mark files, at the start of a comment line.
_TOOL = re.compile(
    r"(?im)^\s*" + _COMMENT + r"\s*(?:@generated\b|<auto-?generated|this file (?:is|was) (?:auto-?|automatically )?generated|auto-?generated\b[^\n]*\bfile\b|code generated by\b|generated (?:code|file)\b|output of \S+ v?\d|"
    r"automatically (?:produced|generated) by|machine-(?:written|generated)|do not (?:modify|edit)\s*[:;,!-]|[^\n]*[;.] *do not edit\b)[^\n]*"
)
_IMPORTED = re.compile(r"(?im)^\s*" + _COMMENT + r"\s*(?:upstream:|this is (?:a )?third[- ]party (?:file|code)|taken verbatim from|local copy,? synced|(?:vendored|imported|copied) (?:from|unmodified))[^\n]*")
_HOLDER = re.compile(r"(?im)^\s*" + _COMMENT + r"\s*((?:copyright\b|\(c\)|©)[^\n]*)")
_TOOL_PATH = re.compile(r"(?:^|/)(?:generated|__generated__|build/out|target/(?:debug|release)/build/[^/]+/out|gen)/|\.(?:gen|pb|generated|g)(?=\.[a-z]+$)|_bindings(?=\.rs$)")
_MINIFIED_PATH = re.compile(r"[.-]min(?=\.(?:js|css|mjs)$)")
_VENDOR_PATH = re.compile(r"(?:^|/)(?:vendor|vendored|third_party(?:-[^/]*)?|third-party|thirdparty|3rdparty|node_modules|bower_components|external|extern_src|deps|subprojects)/[^/]+")
_LITERAL = re.compile(r'"(?:[^"\\]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'|(?<!\w)-?(?:0x[0-9a-fA-F_]+|\d[\w.]*)', re.S)
_WORD = re.compile(r"[^\W\d]\w*")
#: Words that code has and blocks of data have not.
_STATEMENTS = frozenset("fn def function return if else for while loop match class struct enum impl trait use import mod macro_rules create select update new async await lambda".split())
_DEFINITION = re.compile(r"^[ \t]*(?:pub(?:\([^)\n]*\))? |export |async |unsafe |const )*(?:fn|def|function|class|struct|enum|impl|trait)[ <]", re.M)
_COMMENT_START = re.compile(_COMMENT)


def outer_comments(code: str) -> tuple[str, str]:
    """The comment lines before and behind all code."""
    lines = code.split("\n")
    first, block = 0, False
    while first < len(lines):
        line = lines[first].strip()
        if block:
            block = "*/" not in line
        elif line.startswith("/*"):
            block = "*/" not in line
        elif line and not _COMMENT_START.match(line):
            break
        first += 1
    last = len(lines)
    while last > first and (not (line := lines[last - 1].strip()) or _COMMENT_START.match(line)):
        last -= 1
    return "\n".join(lines[:first]), "\n".join(lines[last:])


def is_data(code: str) -> bool:
    """Whether code is nothing but a block of literals or of delimited rows."""
    if _DEFINITION.search(code):
        return False
    body = "\n".join(x for x in code.split("\n") if x.strip() and not _COMMENT_START.match(x.strip()))
    rest, count = _LITERAL.subn(" ", body)
    names = set(_WORD.findall(rest))
    if len(names) <= 12 and not names & _STATEMENTS and (count >= 20 or len(body) > 400 and len(body) - len(rest) > 0.9 * len(body)):
        return True
    lines = body.split("\n")
    if len(lines) < 8 or re.search(r"[{}()\[\]=]", body):
        return False
    for mark in ";,\t|":
        counts = [x.count(mark) for x in lines]
        if counts[0] >= 2 and sum(x == counts[0] for x in counts) >= 0.95 * len(lines):
            return True
    return False


def masked(path: str, code: str) -> tuple[bytes, list[str]]:
    """Code and path components without their giveaways."""
    before, behind = outer_comments(code)
    body = code[len(before) : len(code) - len(behind)] if before or behind else code
    for pattern in (_TOOL, _IMPORTED, _HOLDER):
        before, behind = pattern.sub("", before), pattern.sub("", behind)
    code = before + body + behind
    for pattern in (_VENDOR_PATH, _TOOL_PATH, _MINIFIED_PATH):
        path = pattern.sub("/", path)
    *folders, name = [x for x in path.split("/") if x] or [""]
    return code.strip().encode("utf-8", "replace"), [*(f"d:{x}" for x in folders[2:]), f"e:{name.rpartition('.')[2]}"]


_PLAIN = np.arange(256, dtype=np.uint32)
_PLAIN[48:58] = 48


def code_features(path: str, code: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values (length 1 in all) of a file's hashed n-grams and path components, giveaways masked."""
    import xxhash

    text, components = masked(path, code)
    data = _PLAIN[np.frombuffer(text, np.uint8)]
    if len(data) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0)
    h = np.zeros(len(data) - GRAM + 1, np.uint32)
    for i in range(GRAM):
        h = h * np.uint32(16777619) ^ data[i : len(data) - GRAM + 1 + i]
    counts = np.bincount((h * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    there = np.flatnonzero(counts)
    v = np.sqrt(counts[there])
    names = np.unique([xxhash.xxh32_intdigest(x) % PATH_BUCKETS for x in components])
    return np.concatenate([there, names + BUCKETS]), np.concatenate([v / np.sqrt((v * v).sum()), np.full(len(names), 0.5 / np.sqrt(len(names)))])


_WORDS = re.compile(r"[^\W\d_]+|[@<(]")


def mark_features(path: str, code: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of how the lines of the outer comments begin (one word to five) and end (two), and of all parts of the path."""
    import xxhash

    names = set()
    for comment in outer_comments(code):
        for line in comment.lower().split("\n"):
            words = _WORDS.findall(line)
            names.update("^" + " ".join(words[:n]) for n in range(1, min(5, len(words)) + 1))
            names.update([" ".join(words[-2:]) + "$"] if len(words) > 1 else [])
    *folders, name = path.lower().split("/")
    stem, *parts = name.split(".")
    names.update(f"d:{x}" for x in folders if x)
    names.update(f"d:{x}/{y}" for x, y in zip(folders, folders[1:]))
    names.update(f"n:{x}" for x in (*parts, *re.findall(r"[_-]([a-z]+)\Z", stem)))
    at = np.unique([xxhash.xxh32_intdigest(x) % WORD_BUCKETS for x in names])
    return at.astype(np.int64), np.ones(len(at))


#: What each view sees of a file.
VIEWS = {"code": code_features, "marks": mark_features}


def giveaways(files: DataFrame) -> DataFrame:
    """Per row with code: ``file_id, crate, generated, minified, vendored, data`` by giveaway, ``holder`` and ``print`` (of the code without comments and spaces; null if short)."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            out: dict[str, list] = {x: [] for x in (*KINDS, "holder", "print")}
            for path, code in zip(batch.column(1).to_pylist(), batch.column(2)):
                path, code = path or "", code.as_py()
                before, behind = outer_comments(code)
                holder = _HOLDER.search(before)
                out["generated"].append(bool(_TOOL_PATH.search(path) or _TOOL.search(before) or _TOOL.search(behind)))
                out["minified"].append(bool(_MINIFIED_PATH.search(path)))
                out["vendored"].append(bool(_VENDOR_PATH.search(path) or _IMPORTED.search(before) or _IMPORTED.search(behind)))
                out["data"].append(is_data(code))
                out["holder"].append(re.sub(r"[\d\W_]+", " ", holder[1].lower()).strip() if holder else None)
                bare = "".join("".join(x.split()) for x in code.split("\n") if not _COMMENT_START.match(x.strip()))
                out["print"].append(xxhash.xxh64_intdigest(bare) - (1 << 63) if len(bare) >= COPY_CHARS else None)
            types = {x: pa.bool_() for x in KINDS} | {"holder": pa.string(), "print": pa.int64()}
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), *[pa.array(v, types[k]) for k, v in out.items()]], names=["file_id", "crate", *out])

    source = files.where("file_id is not null and code is not null and code rlike '\\\\S'").select(F.col("file_id").cast("long"), "file_path", "code", "crate")
    return source.mapInArrow(look, "file_id long, crate string, generated boolean, minified boolean, vendored boolean, data boolean, holder string, print long")


def with_foreign_holders(signs: DataFrame) -> DataFrame:
    """Counts files under another holder's copyright as vendored; the project's own holder is the one most files name."""
    own = signs.where("holder is not null").groupBy("holder").count().orderBy(F.desc("count"), "holder").limit(1).select("holder", F.lit(True).alias("_own"))
    joined = signs.join(F.broadcast(own), "holder", "left")
    return joined.withColumn("vendored", F.col("vendored") | (F.col("holder").isNotNull() & F.col("_own").isNull())).drop("_own", "holder")


@dataclass
class Classifiers:
    """Weights (the constant last) of the classifiers in use by view and kind; ``report`` has the judgement of all on unseen crates."""

    weights: dict[tuple[str, str], np.ndarray]
    report: dict


def _plain():
    return ~(F.col("generated") | F.col("minified") | F.col("vendored") | F.col("data"))


def _sample(files: DataFrame, signs: DataFrame) -> DataFrame:
    """A bounded sample by a stable hash, about ``SAMPLE_PER_KIND`` files of each kind's giveaways and ``SAMPLE_PLAIN`` without any, with the ``weight`` that makes it stand for all files."""
    group = F.coalesce(*[F.when(F.col(k), k) for k in reversed(KINDS)], F.lit("plain"))
    marks = cut(signs.groupBy("file_id").agg(F.max("crate").alias("crate"), *[F.bool_or(k).alias(k) for k in KINDS]).withColumn("_group", group))
    share = F.least(F.lit(1.0), F.when(F.col("_group") == "plain", F.lit(SAMPLE_PLAIN)).otherwise(SAMPLE_PER_KIND) / F.col("_n"))
    rates = marks.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).select("_group", share.alias("_rate"))
    chosen = marks.join(F.broadcast(rates), "_group").where(F.pmod(F.xxhash64("file_id", F.lit(3)), F.lit(1 << 20)) < F.col("_rate") * (1 << 20))
    code = files.where("code is not null").select(F.col("file_id").cast("long"), "file_path", "code")
    return code.join(F.broadcast(chosen.select("file_id", "crate", *KINDS, (1 / F.col("_rate")).alias("weight"))), "file_id")


def _vectors(sample: DataFrame) -> DataFrame:
    """The sample as features of both views with labels, ``weight`` and ``fold``, a fifth of the crates by hash."""
    lists = [(f"{view}_{x}", t) for view in SIZES for x, t in (("at", "int"), ("value", "float"))]

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for view, make in VIEWS.items():
                made = [make(path or "", code) for path, code in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
                columns += [pa.array([at.astype(np.int32) for at, _ in made], pa.list_(pa.int32())), pa.array([value.astype(np.float32) for _, value in made], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays([*columns, *[batch.column(2 + k) for k in range(2 + len(KINDS))]], names=[*[n for n, _ in lists], "fold", "weight", *KINDS])

    fold = F.pmod(F.xxhash64(F.coalesce("crate", F.lit(""))), F.lit(5))
    return sample.select("file_path", "code", fold.alias("fold"), "weight", *KINDS).mapInArrow(vectors, ", ".join([f"{n} array<{t}>" for n, t in lists] + ["fold long, weight double"] + [f"{k} boolean" for k in KINDS]))


class _Rows:
    """Sparse rows of features, with a constant one behind the others."""

    def __init__(self, at: list[np.ndarray], values: list[np.ndarray], size: int) -> None:
        self.size = size + 1
        self.rows = [(np.append(a, size).astype(np.int64), np.append(v, np.float32(1))) for a, v in zip(at, values)]

    def margins(self, w: np.ndarray) -> np.ndarray:
        return np.array([v @ w[a] for a, v in self.rows])


def support_vectors(x: _Rows, label: np.ndarray, cost: np.ndarray, regularisation: float, rounds: int = 40) -> np.ndarray:
    """Weights of the linear support-vector classifier, by stochastic sub-gradient steps over rows drawn by cost (a fixed seed); the mean of the later rounds' weights."""
    w, mean, scale = np.zeros(x.size), np.zeros(x.size), 1.0
    drawn = np.random.default_rng(5).choice(len(label), (rounds, len(label)), p=cost / cost.sum())
    y, t = np.where(label, 1.0, -1.0), 0
    for n, part in enumerate(drawn.tolist()):
        for i in part:
            t += 1
            rate = 1 / (regularisation * (t + len(label)))
            at, values = x.rows[i]
            wrong = y[i] * scale * (values @ w[at]) < 1
            scale *= 1 - rate * regularisation
            if wrong:
                w[at] += rate * y[i] / scale * values
        if n >= rounds // 2:
            mean += scale * w / (rounds - rounds // 2)
    return mean


def _trained(view: str, kind: str, rows: pd.DataFrame, regularisation: float) -> dict:
    """One classifier from the rows of the sample, judged on the crates of fold 0; its threshold is taken off the constant."""
    x = lambda part: _Rows(rows["at"][part].tolist(), rows["value"][part].tolist(), SIZES[view])
    fold, label, cost = rows["fold"].to_numpy(), rows["label"].to_numpy(), rows["weight"].to_numpy()
    told, learn, rest = label.copy(), fold > 0, fold == 0
    if label[learn].sum() < LEAST_FILES or not label[rest].any():
        return {"weights": None, "recall": None, "marked_share": None, "used": False}
    if view == "code" and kind in SILENT:
        for k in (0, 1):
            part, other = learn & (fold % 2 == k), learn & (fold % 2 != k)
            if label[part].any() and other.any():
                w = support_vectors(x(part), label[part], cost[part] * np.where(label[part], (1 - SIGNED) / SIGNED, 1), regularisation)
                told[other] |= rows["plain"].to_numpy()[other] & (x(other).margins(w) > 0)
    w = support_vectors(x(learn), told[learn], cost[learn], regularisation)
    margins, marked, weight = x(rest).margins(w), label[rest], cost[rest]
    threshold = 0.0
    if kind not in SILENT:
        order = np.argsort(-margins)
        shares = np.cumsum((weight * marked)[order]) / np.cumsum(weight[order])
        good = np.flatnonzero((shares >= LEAST_SHARE[view]) & (margins[order] > 0))
        threshold = max(0.0, margins[order][good[-1] : good[-1] + 2].mean()) if len(good) else np.inf
    hit = margins > threshold
    right = weight @ (hit & marked)
    recall, share = right / (weight @ marked), right / max(weight @ hit, 1e-9)
    w[-1] -= threshold if threshold < np.inf else 0.0
    return {"weights": w.astype(np.float32), "recall": round(recall, 3), "marked_share": round(share, 3), "used": bool(recall >= LEAST_RECALL)}


def train(files: DataFrame, signs: DataFrame, regularisation: float = 5e-4) -> Classifiers:
    """The linear support-vector classifiers, from about ``SAMPLE_PER_KIND`` files per kind and ``SAMPLE_PLAIN`` plain ones, weighted to stand for all files.

    Files without a giveaway count as hand-written; of a silent kind, those that a
    code classifier fitted on the other half of the crates takes for it are relabelled
    before it is fitted on all. A fifth of the crates is held out and judged by
    weight; a kind with fewer than ``LEAST_FILES`` files, or too little recall there,
    has no classifier. Each classifier is fitted in a task of its own, from the bounded sample.
    """
    sample = cut(_vectors(_sample(files, signs)))
    each = [sample.select(F.lit(v).alias("view"), F.lit(k).alias("kind"), F.col(f"{v}_at").alias("at"), F.col(f"{v}_value").alias("value"), "fold", F.col(k).alias("label"), _plain().alias("plain"), "weight") for v, k in MODELS]
    fit = lambda key, rows: pd.DataFrame([{"view": key[0], "kind": key[1], **_trained(*key, rows, regularisation)}])
    rows = functools.reduce(DataFrame.unionAll, each).groupBy("view", "kind").applyInPandas(fit, "view string, kind string, weights array<float>, recall double, marked_share double, used boolean").collect()
    return Classifiers({(r.view, r.kind): np.array(r.weights, np.float32) for r in rows if r.used}, {(r.view, r.kind): {"recall": r.recall, "marked_share_of_found": r.marked_share, "used": r.used} for r in rows})


def scores(files: DataFrame, model: Classifiers) -> DataFrame:
    """Whether each kind's classifiers take a row with code for it: ``file_id`` and a flag per kind."""
    of = {view: [(KINDS.index(k), w) for (v, k), w in model.weights.items() if v == view] for view in VIEWS}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = np.zeros((len(KINDS), batch.num_rows), bool)
            for i, (path, code) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2))):
                text = code.as_py()
                for view, make in VIEWS.items():
                    at, value = make(path or "", text)
                    for k, w in of[view]:
                        flags[k, i] |= bool(value @ w[at] + w[-1] > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, flags)], names=["file_id", *KINDS])

    source = files.where("file_id is not null and code is not null and code rlike '\\\\S'").select(F.col("file_id").cast("long"), "file_path", "code")
    return source.mapInArrow(judge, "file_id long, " + ", ".join(f"{k} boolean" for k in KINDS))


def classify(files: DataFrame) -> DataFrame:
    """One row per file with code: ``file_id``, a flag per kind, and ``handwritten``.

    Files with null or blank code, or a null id, have no row; a file in several rows
    is of every kind that one of its rows is. A file whose code (without comments
    and spaces, at least ``COPY_CHARS`` characters) equals that of a file found to be
    vendored is a copy of it; equal files without a vendored one among them are the
    project's own. Kinds with too few files to learn from go by their giveaways.
    """
    signs = cut(with_foreign_holders(cut(giveaways(files))))
    model = train(files, signs)
    told = scores(files, model)
    if few := [k for k in KINDS if not any(k == kind for _, kind in model.weights)]:
        told = told.unionByName(signs.select("file_id", *[(F.col(k) if k in few else F.lit(False)).alias(k) for k in KINDS]))
    judged = cut(told.groupBy("file_id").agg(*[F.bool_or(k).alias(k) for k in KINDS]))
    prints = signs.where("print is not null").select("file_id", "print").distinct().join(judged.select("file_id", "vendored", "generated", "data"), "file_id")
    copied = prints.where("vendored and not generated and not data").select("print").distinct()
    copies = prints.where("not vendored").join(copied, "print", "left_semi").select("file_id", F.lit(True).alias("_copy")).distinct()
    both = judged.join(copies, "file_id", "left").withColumn("vendored", F.col("vendored") | F.coalesce("_copy", F.lit(False))).drop("_copy")
    return both.withColumn("handwritten", _plain())


def found(files: DataFrame) -> DataFrame:
    """``file_id`` of the files whose code is not hand-written source of the project."""
    return classify(files).where(~F.col("handwritten")).select("file_id")
