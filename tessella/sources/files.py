"""Reading documents, source trees, manifests and JSON lines.

Every scan gives the path relative to the root as key and order; a row is a whole
file. Unreadable bytes become replacement characters; an empty folder gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _scan(spark: SparkSession, root: str, pattern: str, recursive: bool) -> DataFrame:
    read = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    base = root.rstrip("/") + "/"
    path = F.substring_index(F.concat(F.lit("/"), F.expr("url_decode(_metadata.file_path)")), base, -1)
    return read.text(root, wholetext=True).select(path.alias("path"), F.col("_metadata.file_size").alias("byte_size"), F.col("value").alias("content"))


def markdown(spark: SparkSession, folder: str) -> DataFrame:
    """``source_file, content`` of the ``*.md`` files of one folder, not of those below it."""
    return _scan(spark, folder, "*.md", False).select(F.regexp_replace("path", r"\.md\z", "").alias("source_file"), "content")


def rust_tree(spark: SparkSession, root: str) -> DataFrame:
    """``path, byte_size, content`` of all ``*.rs`` files under the root."""
    return _scan(spark, root, "*.rs", True)


def crates_and_src(files: DataFrame, path: str = "path") -> DataFrame:
    """Files under ``crates/`` or ``src/`` of the root; without a part named ``target``."""
    inside = F.col(path).startswith("crates/") | F.col(path).startswith("src/")
    return files.where(inside & ~F.array_contains(F.split(path, "/"), "target"))


def with_crate(files: DataFrame, crates: DataFrame, path: str = "path") -> DataFrame:
    """Adds ``owner``: of the crates (``name, folder``) the one whose folder is the longest prefix of the path.

    Every path is cut into its own folders, a few per file, and these are matched by
    equality; null where no crate's folder holds the file.
    """
    parts = F.split(path, "/")
    folders = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    each = files.select(path, F.explode(folders).alias("folder")).distinct()
    best = each.join(crates.select(F.col("name").alias("owner"), "folder"), "folder").groupBy(path).agg(F.max_by("owner", F.struct(F.length("folder"), "owner")).alias("owner"))
    return files.join(best, path, "left")


MANIFEST = "name string, dependencies array<string>, dev_dependencies array<string>, features map<string, array<string>>"


def parse_manifest(text):
    """Column: a struct of a package manifest's name, dependencies and features; null for text that isn't a manifest with a package."""
    kind = pa.struct([("name", pa.string()), ("dependencies", pa.list_(pa.string())), ("dev_dependencies", pa.list_(pa.string())), ("features", pa.map_(pa.string(), pa.list_(pa.string())))])

    def one(text: str | None):
        import tomllib

        try:
            found = tomllib.loads(text or "")
        except (tomllib.TOMLDecodeError, ValueError):
            return None
        package = found.get("package")
        if not isinstance(package, dict) or "name" not in package:
            return None
        table = lambda k: found.get(k) if isinstance(found.get(k), dict) else {}
        features = {k: [str(x) for x in v] for k, v in table("features").items() if isinstance(v, list)}
        return {"name": str(package["name"]), "dependencies": sorted(table("dependencies")), "dev_dependencies": sorted(table("dev-dependencies")), "features": list(features.items())}

    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([one(x) for x in texts.to_pylist()], kind)

    return F.arrow_udf(parse, f"struct<{MANIFEST}>")(text)


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """``path`` and the parsed package of every ``Cargo.toml`` outside ``target``; files without a package are left out."""
    files = _scan(spark, root, "Cargo.toml", True).where(~F.array_contains(F.split("path", "/"), "target"))
    return files.select("path", parse_manifest(F.col("content")).alias("m")).where("m is not null").select("path", "m.*")


def json_lines(spark: SparkSession, path: str, schema: StructType | str, rejected: str | None = None) -> DataFrame:
    """One JSON object per line under a fixed schema; lines that don't parse have nulls, and their text in ``rejected`` if named."""
    reader = spark.read.option("mode", "PERMISSIVE")
    if rejected:
        parsed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return reader.option("columnNameOfCorruptRecord", rejected).schema(StructType(list(parsed.fields)).add(rejected, "string")).json(path)
    return reader.schema(schema).json(path)


def table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
