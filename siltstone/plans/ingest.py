"""Raw package records from file listings with contents; what a crawl of repositories yields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators import crawl, licenses
from siltstone.storage import materialize


def raw_records(files: DataFrame, crawled_at: str) -> DataFrame:
    """Rows of ``sources.io.RAW`` from files (source_id, commit_sha, path, content, mode), symbolic links left out."""
    tree = crawl.without_symlinks(files).withColumnRenamed("source_id", "repo")
    found = crawl.packages(tree)
    scripts = crawl.has_scripts(tree).select("repo", "skill_dir", "has_scripts")
    folders = crawl.folder_hash(tree)
    dirs = found.select("repo", F.regexp_replace("skill_dir", r"^\.$", "").alias("dir"))
    shas = tree.select("repo", F.col("path").alias("file"), F.sha1(F.coalesce("content", F.lit(""))).alias("sha")).distinct()
    above = licenses.license_files_above(tree.select("repo", "path"), dirs).join(shas, ["repo", "file"])
    ordered = F.array_sort(F.collect_list(F.struct("at_depth", "file", "sha")))  # a few a package: its ancestors' license files
    files_above = above.groupBy("repo", "dir").agg(F.transform(ordered, lambda x: F.struct(x.file.alias("path"), x.sha.alias("sha"))).alias("license_files"))
    content = tree.select("repo", "path", "content", "commit_sha").dropDuplicates(["repo", "path"])
    joined = (
        found.join(content, ["repo", "path"]).join(scripts, ["repo", "skill_dir"], "left").join(folders, ["repo", "skill_dir"], "left")
        .join(files_above.withColumn("skill_dir", F.when(F.col("dir") == "", ".").otherwise(F.col("dir"))).drop("dir"), ["repo", "skill_dir"], "left")
    )
    empty = F.array().cast("array<struct<path:string,sha:string>>")
    return joined.select(
        F.col("repo").alias("source_id"), "path", "skill_dir", F.sha1("content").alias("blob_sha"), "content", F.sha2("content", 256).alias("skill_md_sha256"),
        "folder_sha256", F.coalesce("has_scripts", F.lit(False)).alias("has_scripts"), F.coalesce("license_files", empty).alias("license_files"),
        F.when(F.col("lowercase"), F.array(F.lit("filename-lowercase"))).otherwise(F.array().cast("array<string>")).alias("conformance_errors"),
        F.lit(crawled_at).alias("crawled_at"), "commit_sha",
    )


def crawl_sources(files: DataFrame, attempts: DataFrame, state: DataFrame, sources: DataFrame, crawled_at: str, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(raw records, new state) of one crawl over all sources; to be repeated without harm.

    ``attempts`` (source_id, head_sha, crawled_at, last_error): one a source, a
    failed one without head_sha.  Sources whose head the state already has are
    skipped (unless forced); of the others' ``files`` (source_id, commit_sha,
    path, content, mode) those count that are of the attempted head and that the
    source's patterns let through.  ``state``: see ``crawl.upsert_state``.
    """
    known = state.select("source_id", F.col("head_sha").alias("_seen"))
    heads = attempts.where("head_sha is not null").join(known, "source_id", "left")
    due = heads.where(F.lit(force) | ~F.col("head_sha").eqNullSafe(F.col("_seen"))).select("source_id", F.col("head_sha").alias("commit_sha"))
    used = crawl.select_paths(files.join(due, ["source_id", "commit_sha"]), sources)
    raw = materialize(raw_records(used, crawled_at), "raw")
    found = raw.groupBy("source_id").agg(F.count("*").cast("int").alias("_n"))
    counted = attempts.join(found, "source_id", "left").select(
        "source_id", "head_sha", "crawled_at", F.when(F.col("head_sha").isNotNull(), F.coalesce("_n", F.lit(0))).alias("skills_found"), "last_error"
    )
    return raw, crawl.upsert_state(state, counted, force)
