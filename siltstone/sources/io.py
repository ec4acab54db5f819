"""Readers and writers of the catalog's files."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import rules as R
from siltstone.storage import write_bytes

RAW = (
    "source_id string, path string, skill_dir string, blob_sha string, content string, skill_md_sha256 string, folder_sha256 string, "
    "has_scripts boolean, license_files array<struct<path:string,sha:string>>, conformance_errors array<string>, crawled_at string, commit_sha string"
)


def read_raw(spark: SparkSession, directory: str) -> DataFrame:
    """All *.jsonl crawl files of a directory; broken and blank lines are left out (see ``broken_lines``)."""
    return _read_raw(spark, directory).where("_broken is null and source_id is not null").drop("_broken")


def _read_raw(spark: SparkSession, directory: str) -> DataFrame:
    read = spark.read.schema(RAW + ", _broken string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken")
    return read.option("pathGlobFilter", "*.jsonl").json(directory)


def broken_lines(spark: SparkSession, directory: str) -> DataFrame:
    """(file, lines) of the crawl files with lines that are no JSON object of the schema; no line is dropped unseen."""
    lines = spark.read.option("pathGlobFilter", "*.jsonl").text(directory).where("trim(value) <> ''")
    parsed = F.from_json("value", RAW + ", _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    every = lines.select(F.col("_metadata.file_name").alias("file"), parsed.alias("row"))
    return every.where("row._broken is not null").groupBy("file").agg(F.count("*").alias("lines"))


def read_keyed_jsonl(spark: SparkSession, path: str, schema: str, key: str = "id") -> DataFrame:
    """The last row of each key of JSONL files."""
    df = spark.read.schema(schema).json(path)
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("at"))
    placed = df.select(F.struct(*df.columns).alias("_row"), place.alias("_place")).where(F.col(f"_row.{key}").isNotNull())
    return placed.groupBy(F.col(f"_row.{key}").alias("_key")).agg(F.max_by("_row", "_place").alias("_row")).select("_row.*")


def read_sources(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The repositories[] of a JSON document as rows."""
    return spark.read.schema(f"repositories array<struct<{schema}>>").option("multiLine", True).json(path).select(F.inline("repositories"))


def read_files(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """(path, content, length) of files below a directory, read as bytes and decoded."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(directory)
    return files.select("path", F.decode("content", "UTF-8").alias("content"), "length")


LISTING = "repo string, mode string, type string, sha string, path string"


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """LISTING of tree listings, one text file per repository (its name, with ``/`` as ``__``): mode, type, sha, a tab, the path."""
    lines = spark.read.text(path).select(F.regexp_replace(F.regexp_replace("_metadata.file_name", r"\.[^.]*$", ""), "__", "/").alias("repo"), "value")
    part = lambda n: F.regexp_extract("value", r"^(\d{6}) (\w+) ([0-9a-f]{40,64})\t(.+)$", n)
    listed = lines.select("repo", part(1).alias("mode"), part(2).alias("type"), part(3).alias("sha"), F.regexp_replace(part(4), '^"|"$', "").alias("path"))
    return listed.where("path <> ''")


def readme(files: DataFrame) -> DataFrame:
    """(repo, content) of each repository's README: README.md before readme.md, README and README.rst."""
    order = ("README.md", "readme.md", "README", "README.rst")
    place = F.array_position(F.array(*map(F.lit, order)), F.col("path"))
    found = files.where(F.col("path").isin(*order) & F.col("content").isNotNull())
    return found.groupBy("repo").agg(F.min_by("content", F.struct(place, "content")).alias("content"))


def seeds_to_sources(seeds: DataFrame, added_at: str) -> DataFrame:
    """Seed entries as source rows: the first word of the owner type, notes joined."""
    part = lambda label, c, skip=None: F.when(
        F.coalesce(F.col(c), F.lit("")).isin("", *([skip] if skip else [])), F.lit(None)
    ).otherwise(F.concat(F.lit(f"{label}: "), F.col(c)))
    notes = F.concat_ws(" | ", part("Pattern", "pattern_notes"), part("Curated policy", "curated_policy", "allow"), part("Eligible", "curated_eligible_note"))
    return seeds.select(
        "id", "url", F.split_part(F.split_part(F.trim("owner_type"), F.lit(" "), F.lit(1)), F.lit("/"), F.lit(1)).alias("owner_type"), "tier",
        F.lit("active").alias("status"), F.lit(added_at).alias("added_at"), F.lit(None).cast("string").alias("last_crawled_commit"),
        F.lit(None).cast("string").alias("last_crawled_at"), F.lit(False).alias("verified"), F.nullif(notes, F.lit("")).alias("notes"),
    )


def to_json_lines(df: DataFrame) -> DataFrame:
    """(line): each row as one JSON object, keys sorted at every level."""

    def ordered(column, kind):
        if isinstance(kind, T.StructType):
            return F.when(column.isNotNull(), F.struct(*(ordered(column[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name))))
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType | T.ArrayType):
            return F.transform(column, lambda x: ordered(x, kind.elementType))
        return column

    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return df.select(F.to_json(F.struct(*(ordered(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields))).alias("line"))


def write_json_lines(df: DataFrame, path: str, order: str = "id") -> None:
    """Sorted JSONL; the parts of a large table follow each other by name."""
    key_order = df.orderBy(order)
    to_json_lines(key_order).write.mode("overwrite").text(path)


def write_catalog(df: DataFrame, path: str, limit: int = R.FULL_CATALOG_BYTES) -> bool:
    """The whole catalog if its JSON is within the limit, else its curated, official and community part, and a pointer; true if whole."""
    size = to_json_lines(df).agg(F.sum(F.octet_length("line") + 1)).first()[0] or 0
    whole = size <= limit
    kept = df if whole else df.where((F.col("layer") == "curated") | F.col("trust_tier").isin("official", "community"))
    write_json_lines(kept, f"{path}/records")
    if not whole:
        pointer = df.sparkSession.createDataFrame([("the full catalog is too large for this file", size, limit)], "note string, bytes long, limit long")
        write_one_json(pointer, f"{path}/pointer.json")
    return whole


def write_shards(records: DataFrame, path: str) -> None:
    """JSONL files in one directory per shard (column ``shard``), each sorted by id."""
    fields = [c for c in sorted(records.columns) if c != "shard"]
    lines = records.select("shard", "id", F.to_json(F.struct(*fields)).alias("line"))
    lines.repartition("shard").sortWithinPartitions("shard", "id").drop("id").write.mode("overwrite").partitionBy("shard").text(path)


def write_one_json(row: DataFrame, path: str) -> None:
    """A one-row table as an indented JSON document with sorted keys, written whole."""
    data = json.loads(row.select(F.to_json(F.struct("*"))).first()[0])
    text = json.dumps(data, indent=2, sort_keys=True, ensure_ascii=False) + "\n"
    write_bytes(row.sparkSession, path if "://" in path else f"file://{Path(path).resolve()}", text.encode(), keep=True)


def append_changes(changes: DataFrame, path: str) -> None:
    to_json_lines(changes).write.mode("append").text(path)
