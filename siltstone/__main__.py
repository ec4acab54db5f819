"""Command line: python -m siltstone COMMAND ... ; tables are Parquet folders, documents JSON or JSONL."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import changes, dedup, frontmatter, gates, keywords, quality, refs, search, security, stats
from siltstone.plans import catalog, ingest
from siltstone.sources import io
from siltstone.storage import materialize, ship

FIELDS = {"name": 3.0, "description": 2.0}
SOURCE = "id string, url string, owner_type string, tier int, status string, include_patterns array<string>, exclude_patterns array<string>"


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return io.read_files(spark, folder).select(F.regexp_replace("path", f"^(?:file:)?/*{Path(folder).resolve().as_posix().lstrip('/')}/", "").alias("path"), "content")


def _print(df: DataFrame) -> None:
    """A report, row by row; the rows come to the driver a partition at a time."""
    for (line,) in df.select(F.to_json(F.struct("*"))).toLocalIterator():
        print(line)


def cmd_ingest(spark, a):
    """Files of one repository's folder -> raw records."""
    files = _texts(spark, a.folder).select(F.lit(a.source).alias("source_id"), F.lit(a.commit).alias("commit_sha"), "path", "content", F.lit("100644").alias("mode"))
    ingest.raw_records(files, a.now).write.mode("append").json(a.out)


def cmd_build(spark, a):
    """Raw records and sources -> catalog, changes against the previous catalog, statistics."""
    sources = io.read_sources(spark, a.sources, SOURCE)
    empty = spark.createDataFrame([], "id string, content_hash string, first_seen string, last_changed string, license struct<spdx:string>, security struct<status:string>, status string")
    previous = spark.read.parquet(a.previous) if a.previous else empty
    gone = None
    if a.owners:  # JSONL (owner) of the owners that exist
        gone = refs.without_owner(sources, spark.read.schema("owner string").json(a.owners), a.host)
    verdicts = spark.read.schema("id string, verdict string").json(a.verdicts) if a.verdicts else None
    built = materialize(catalog.build(io.read_raw(spark, a.raw), sources, previous, a.host, a.now, gone, verdicts), "catalog")
    built.write.mode("overwrite").parquet(f"{a.out}/catalog")
    flat = lambda df: df.select("id", "content_hash", F.col("license.spdx").alias("license"), F.col("security.status").alias("security"), "status")
    io.append_changes(changes.changes(flat(previous), flat(built)).withColumn("timestamp", F.lit(a.now)), f"{a.out}/changes")
    io.write_catalog(built, f"{a.out}/json")
    io.write_one_json(_statistics(built).withColumn("repositories", F.lit(sources.count())), f"{a.out}/stats.json")
    _print(io.broken_lines(spark, a.raw))


def _statistics(built: DataFrame) -> DataFrame:
    return stats.overview(built.select("duplicate_of", "layer", F.col("license.class").alias("license_class"), F.col("fm.strict").alias("strict")))


def cmd_stats(spark, a):
    """Statistics of a catalog as Markdown, printed or put into a document."""
    row = _statistics(spark.read.parquet(a.catalog)).withColumn("repositories", F.lit(a.repositories))
    text = stats.block(row, a.now[:10]).first()[0]
    if a.readme:
        Path(a.readme).write_text(stats.replace_block(Path(a.readme).read_text(), text))
    print(text)


def cmd_lint(spark, a):
    """Frontmatter and quality of the package files in a folder."""
    files = _texts(spark, a.folder).where(F.lower("path").rlike(r"(^|/)skill\.md$")).withColumn("dir", F.regexp_replace("path", "/?[^/]*$", ""))
    parsed = frontmatter.parse(files, "content", "dir", a.lenient)
    _print(parsed.select("path", "fm.strict", "fm.lenient", "fm.errors", quality.smells(F.col("content"), F.col("fm.name"), F.col("fm.description")).alias("smells")))


def cmd_lint_quality(spark, a):
    """Quality smells of the package files in a folder; with --fail, exit 1 if there are any."""
    files = _texts(spark, a.folder).where(F.lower("path").rlike(r"(^|/)skill\.md$")).withColumn("dir", F.regexp_replace("path", "/?[^/]*$", ""))
    parsed = frontmatter.parse(files, "content", "dir", True)
    found = materialize(parsed.select("path", quality.smells(F.col("content"), F.col("fm.name"), F.col("fm.description")).alias("smells")), "smells")
    _print(found.select("path", (F.size("smells") == 0).alias("passes"), "smells"))
    if a.fail and found.where("size(smells) > 0").limit(1).count():
        raise SystemExit(1)


def cmd_check_curated_gate(spark, a):
    """Curated records that would no longer pass; unless --dry-run, a copy of the catalog with them marked for review."""
    listing = _texts(spark, a.files).select("path")
    df = gates.with_curated_files(_with_gate_columns(spark.read.parquet(a.catalog)), listing)
    _print(gates.regressions(df))
    if not a.dry_run:
        gates.marked_for_review(df).drop("curated_files").write.mode("overwrite").parquet(a.out)


def _with_gate_columns(df: DataFrame) -> DataFrame:
    for name, kind in (("curated_path", "string"), ("conformance", "struct<strict:boolean,errors:array<string>>"), ("quality", "struct<smells:array<string>>")):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def cmd_shards(spark, a):
    """Compact search records of a catalog in shards: curated and official whole, the others by size."""
    df = spark.read.parquet(a.catalog).where(keywords.eligible(F.col("id"), F.col("canonical_id"), F.col("status"), F.col("security.status")))
    records = materialize(df.join(keywords.top_keywords(df, "id", "name", "description").withColumnRenamed("keywords", "kw"), "id", "left").select(
        "id", F.col("name").alias("n"), keywords.shortened(F.col("description")).alias("d"), "kw", F.col("trust_tier").alias("tier"), F.col("license.spdx").alias("lic"),
        F.col("security.status").alias("sec"), "install", F.col("content_hash").alias("h"), F.col("layer").alias("_layer"),
    ), "compact")
    sized = records.select("id", F.col("_layer").alias("layer"), "tier", (F.octet_length(F.to_json(F.struct(*(c for c in records.columns if c != "_layer")))) + 1).cast("long").alias("bytes"))
    io.write_shards(records.drop("_layer").join(keywords.shard_names(sized, a.capacity), "id"), a.out)


def cmd_scan(spark, a):
    """Security scan of the texts in a folder."""
    docs = _texts(spark, a.folder).withColumns({"description": F.lit(None).cast("string"), "scripts": F.lit(False), "layer": F.lit("source")})
    _print(security.scan(docs, "path", "content", "description", "scripts", "layer"))


def cmd_wording(spark, a):
    _print(refs.wording(_texts(spark, a.folder).where("path like '%.md'"), "path", "content"))


def cmd_validate(spark, a):
    """Constraint violations of a table of records or sources."""
    _print(gates.violations(spark.read.parquet(a.table), "id", gates.SOURCE_RULES if a.kind == "sources" else gates.RECORD_RULES))


def cmd_gate(spark, a):
    df = spark.read.parquet(a.table)
    if a.kind == "curated":
        listing = _texts(spark, a.files).select("path") if a.files else spark.createDataFrame([], "path string")
        df = gates.with_curated_files(_with_gate_columns(df), listing)
    reasons = gates.curated_reasons() if a.kind == "curated" else gates.source_reasons()
    _print(gates.gate(df.where(F.col("id") == a.id) if a.id else df, reasons, a.kind))


def cmd_dedup(spark, a):
    """Clusters by content hash, the largest first."""
    df = spark.read.parquet(a.catalog)
    _print(dedup.duplicate_counters(df, "content_hash"))
    _print(dedup.clusters(df, "content_hash").where("n > 1").orderBy(F.desc("n"), "content_hash").limit(a.top))


def cmd_refs(spark, a):
    """External references of the texts in a folder against a JSONL table (type, reference, exists)."""
    known = spark.read.schema("type string, reference string, exists boolean").json(a.known)
    _print(refs.reference_report(_texts(spark, a.folder), "path", "content", known, a.host))


def cmd_discover(spark, a):
    """Repository links of the Markdown files in a folder that no source has."""
    known = io.read_sources(spark, a.sources, SOURCE)

    def of(folder: str, name: str) -> DataFrame:
        docs = _texts(spark, folder).where("path like '%.md'")
        links = refs.distinct_links(refs.repositories(docs, "path", "content", a.host), "path", "at")
        return refs.candidates(links, F.lit(name), known)

    lists = [of(a.folder, a.aggregator)] + ([of(a.second, a.second_aggregator)] if a.second else [])
    refs.union_of_candidates(*lists).write.mode("overwrite").json(a.out)


def cmd_import_sources(spark, a):
    seeds = spark.read.schema(
        "seeds array<struct<id:string,url:string,owner_type:string,tier:int,pattern_notes:string,curated_policy:string,curated_eligible_note:string>>"
    ).option("multiLine", True).json(a.seeds).select(F.inline("seeds"))
    io.seeds_to_sources(seeds, a.now).write.mode("overwrite").json(a.out)


def cmd_index(spark, a):
    """Search index of a catalog: postings by term, lengths, record fields."""
    df = spark.read.parquet(a.catalog).where((F.col("status") == "active") & (F.coalesce("security.status", F.lit("")) != "malicious"))
    built = search.build_index(df, "id", FIELDS, stems=True)
    built.postings.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{a.out}/postings")
    built.lengths.write.mode("overwrite").parquet(f"{a.out}/lengths")
    df.select(
        F.col("id").alias("skill_id"), "name", "description", "trust_tier", F.col("license.spdx").alias("license"), F.col("security.status").alias("security"), "canonical_id", "layer", "content_hash"
    ).write.mode("overwrite").parquet(f"{a.out}/meta")


def cmd_find(spark, a):
    index = search.Index(spark.read.parquet(f"{a.index}/postings"), spark.read.parquet(f"{a.index}/lengths"))
    _print(search.search(index, spark.read.parquet(f"{a.index}/meta"), a.query, a.k, True, a.layer, a.license == "permissive", a.min_trust))


def cmd_show(spark, a):
    _print(search.lookup(spark.read.parquet(f"{a.index}/meta"), a.id))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siltstone", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def add(name, f, *args, **options):
        c = sub.add_parser(name, help=(f.__doc__ or "").strip())
        c.set_defaults(run=f)
        for arg in args:
            c.add_argument(arg)
        for option, default in options.items():
            flag = "--" + option.replace("_", "-")
            if isinstance(default, bool):
                c.add_argument(flag, action="store_true")
            else:
                c.add_argument(flag, default=default, type=type(default) if default is not None else str)

    now, host = "1970-01-01T00:00:00+00:00", "github.com"
    add("ingest", cmd_ingest, "folder", "source", "out", commit="0" * 40, now=now)
    add("build", cmd_build, "raw", "sources", "out", previous=None, owners=None, verdicts=None, host=host, now=now)
    add("stats", cmd_stats, "catalog", readme=None, repositories=0, now=now)
    add("lint-skill", cmd_lint, "folder", lenient=False)
    add("lint-quality", cmd_lint_quality, "folder", fail=False)
    add("check-curated-gate", cmd_check_curated_gate, "catalog", "files", "out", dry_run=False)
    add("shards", cmd_shards, "catalog", "out", capacity=1 << 20)
    add("scan-security", cmd_scan, "folder")
    add("wording", cmd_wording, "folder")
    add("validate", cmd_validate, "table", kind="records")
    add("gate", cmd_gate, "kind", "table", id=None, files=None)
    add("dedup", cmd_dedup, "catalog", top=20)
    add("check-refs", cmd_refs, "folder", "known", host=host)
    add("discover", cmd_discover, "folder", "sources", "out", aggregator="aggregator", second=None, second_aggregator="aggregator 2", host=host)
    add("import-sources", cmd_import_sources, "seeds", "out", now=now)
    add("index", cmd_index, "catalog", "out")
    add("find", cmd_find, "index", "query", k=5, layer=None, license=None, min_trust=None)
    add("show", cmd_show, "index", "id")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("siltstone").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    a.run(spark, a)


if __name__ == "__main__":
    main()
