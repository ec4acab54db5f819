"""From tree listings to raw package records: path filters, folders, licenses, crawl state."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.licenses import ancestors, directory

MAX_FILE_BYTES = 10 << 20
SYMLINK = "120000"


def braces(pattern: str) -> list[str]:
    """{a,b} written out."""
    m = re.search(r"\{([^{}]*,[^{}]*)\}", pattern)
    if not m:
        return [pattern]
    return [p for choice in m[1].split(",") for p in braces(pattern[: m.start()] + choice + pattern[m.end() :])]


def glob_regex(pattern: str) -> str:
    """A gitignore pattern as a regular expression on whole paths.

    ``*`` and ``?`` stay in a directory, ``**`` crosses them; a pattern without
    an inner slash matches at any depth; what matches a directory matches all in it.
    """
    anchored = "/" in pattern.rstrip("/")
    only_directories = pattern.endswith("/")
    out, i, body = "", 0, pattern.strip("/")
    while i < len(body):
        if body.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif body.startswith("**", i):
            out, i = out + ".*", i + 2
        elif body[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif body[i] == "?":
            out, i = out + "[^/]", i + 1
        elif body[i] == "[" and "]" in body[i + 2 :]:
            end = body.index("]", i + 2)
            out, i = out + "[" + body[i + 1 : end].replace("!", "^", 1).replace("\\", "") + "]", end + 1
        else:
            out, i = out + re.sub(r"([.^$+(){}|\[\]\\])", r"\\\1", body[i]), i + 1
    return "^" + ("" if anchored else "(?:.*/)?") + out + ("/.*" if only_directories else "(?:/.*)?") + "$"


def path_matches(path: Column, patterns: list[str]) -> Column:
    """Whether a path matches one of the patterns; later patterns with ! take away; no patterns match all."""
    if not patterns:
        return F.lit(True)
    out = F.lit(False)
    for p in patterns:
        negated = p.startswith("!")
        hit = path.rlike("|".join(glob_regex(q) for q in braces(p.lstrip("!"))))
        out = F.when(hit, not negated).otherwise(out)
    return out


def select_paths(files: DataFrame, sources: DataFrame) -> DataFrame:
    """The files (source_id, path, ...) that their source's include and exclude patterns let through.

    Patterns are few and repeat over sources, so each distinct pair of lists is
    compiled once, at plan time, and the source's rows carry its number.  The
    list of sources is a dimension table; its size is checked.
    """
    limit = 100_000
    rows = sources.select("id", "include_patterns", "exclude_patterns").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} sources")
    kinds: dict[tuple, int] = {}
    number = {r.id: kinds.setdefault((tuple(r.include_patterns or ()), tuple(r.exclude_patterns or ())), len(kinds)) for r in rows if r.id is not None}
    kind = files.sparkSession.createDataFrame(list(number.items()) or [("", -1)], "source_id string, _kind int")
    keep = F.lit(False)
    for (include, exclude), n in kinds.items():
        passes = path_matches(F.col("path"), list(include))
        if exclude:
            passes = passes & ~path_matches(F.col("path"), list(exclude))
        keep = F.when(F.col("_kind") == n, passes).otherwise(keep)
    return files.join(kind, "source_id").where(keep).drop("_kind")


def is_package_file(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1).isin("SKILL.md", "skill.md")


def without_symlinks(tree: DataFrame) -> DataFrame:
    return tree.where(F.coalesce("mode", F.lit("")) != SYMLINK)


def packages(tree: DataFrame) -> DataFrame:
    """(repo, path, skill_dir, lowercase) of each package file of a listing (repo, path)."""
    found = tree.where(is_package_file(F.col("path"))).select("repo", "path").distinct()
    skill_dir = F.when(directory(F.col("path")) == "", ".").otherwise(directory(F.col("path")))
    return found.select("repo", "path", skill_dir.alias("skill_dir"), F.col("path").endswith("skill.md").alias("lowercase"))


def package_files(tree: DataFrame) -> DataFrame:
    """(repo, skill_dir, file): the files in and below each package's directory.

    Each file is exploded to its ancestors and met by equality: linear in the
    files times their depth.
    """
    dirs = packages(tree).select("repo", F.regexp_replace("skill_dir", r"^\.$", "").alias("_dir")).distinct()
    above = tree.select("repo", F.col("path").alias("file")).distinct()
    above = above.select("repo", "file", F.explode(ancestors(directory(F.col("file")))).alias("_dir"))
    return above.join(dirs, ["repo", "_dir"]).select("repo", F.when(F.col("_dir") == "", ".").otherwise(F.col("_dir")).alias("skill_dir"), "file")


def has_scripts(tree: DataFrame) -> DataFrame:
    """(repo, skill_dir, files, has_scripts): whether a package has a scripts directory in it."""
    rel = F.when(F.col("skill_dir") == ".", F.col("file")).otherwise(F.substr("file", F.length("skill_dir") + 2))
    return package_files(tree).groupBy("repo", "skill_dir").agg(
        F.count("*").alias("files"), F.bool_or(F.array_contains(F.split(directory(rel), "/"), "scripts")).alias("has_scripts")
    )


def folder_hash(files: DataFrame) -> DataFrame:
    """(repo, skill_dir, folder_sha256) over the direct files of each package's directory.

    sha256 over the files' own digests (path and content) in the order of paths.
    Empty files and those of 10 MiB and more are left out.  A package's direct
    files are gathered as digests of 32 bytes, not as contents.
    """
    sized = files.where((F.octet_length("content") > 0) & (F.octet_length("content") < MAX_FILE_BYTES))
    dirs = packages(files).select("repo", F.regexp_replace("skill_dir", r"^\.$", "").alias("_dir")).distinct()
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    digest = F.sha2(F.concat(F.encode(name, "UTF-8"), F.encode("content", "UTF-8")), 256)
    direct = sized.select("repo", directory(F.col("path")).alias("_dir"), name.alias("_name"), digest.alias("_digest")).distinct()
    joined = direct.join(dirs, ["repo", "_dir"])
    ordered = F.array_sort(F.collect_list(F.struct("_name", "_digest")))
    return joined.groupBy("repo", "_dir").agg(F.sha2(F.unhex(F.array_join(F.transform(ordered, lambda x: x._digest), "")), 256).alias("folder_sha256")).select(
        "repo", F.when(F.col("_dir") == "", ".").otherwise(F.col("_dir")).alias("skill_dir"), "folder_sha256"
    )


def latest_state(state: DataFrame) -> DataFrame:
    """One row per source: its last successful crawl, with the error of a later failed attempt merged in."""
    ok = F.col("head_sha").isNotNull()
    last = lambda c: F.max_by(c, F.when(ok, F.struct("crawled_at", "head_sha")))
    return state.groupBy("source_id").agg(
        last("head_sha").alias("head_sha"), last("crawled_at").alias("crawled_at"), last("skills_found").alias("skills_found"),
        F.max_by("last_error", F.struct("crawled_at", F.coalesce("head_sha", F.lit("")), F.coalesce("last_error", F.lit("")))).alias("last_error"),
    )


def probed(sources: DataFrame, heads: DataFrame) -> DataFrame:
    """(id, head_sha, status) of sources by what probing their repositories gave (``heads``: source_id, head_sha, at).

    The newest answer of 40 hexadecimal digits counts; a source without one is
    missing.  Probing itself is done outside: answers are a table.
    """
    good = heads.where(F.col("head_sha").rlike("^[0-9a-f]{40}$"))
    newest = good.groupBy(F.col("source_id").alias("id")).agg(F.max_by("head_sha", F.struct("at", "head_sha")).alias("head_sha"))
    return sources.select("id").distinct().join(newest, "id", "left").withColumn("status", F.when(F.col("head_sha").isNull(), "missing").otherwise("active"))


def upsert_state(state: DataFrame, attempts: DataFrame, force: bool = False) -> DataFrame:
    """The crawl state after one attempt per source; (source_id, head_sha, crawled_at, skills_found, last_error, outcome).

    A head that was crawled before is skipped (unless forced) and its row stays;
    a failed attempt (no head_sha) leaves the previous crawl and adds its error;
    a success replaces the row and clears the error.  Sources without an attempt
    stay.  The same attempts give the same state again.
    """
    columns = ("head_sha", "crawled_at", "skills_found", "last_error")
    old = state.select("source_id", *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_known"))
    new = attempts.select("source_id", *columns, F.lit(True).alias("_tried"))
    both = old.join(new, "source_id", "full_outer")
    failed = F.col("head_sha").isNull()
    same = F.lit(not force) & F.col("head_sha").eqNullSafe(F.col("_head_sha"))
    outcome = F.when(F.col("_tried").isNull(), "untried").when(failed, "failed").when(same, "skipped").otherwise("crawled")
    keep = outcome != "crawled"
    value = lambda c: F.when(keep, F.col(f"_{c}")).otherwise(F.col(c))
    error = F.when(outcome == "failed", F.coalesce("last_error", F.lit("Failed to get HEAD SHA"))).when(keep, F.col("_last_error"))
    return both.select("source_id", *(value(c).alias(c) for c in columns[:3]), error.alias("last_error"), outcome.alias("outcome"))


def rollup(state: DataFrame) -> DataFrame:
    """One row over crawl attempts: sources, skills found, failed attempts, attempts without news."""
    before = F.lag("head_sha").over(Window.partitionBy("source_id").orderBy("crawled_at", "head_sha"))
    seen = state.distinct().withColumn("_before", before)
    return seen.agg(
        F.count_distinct("source_id").alias("sources"), F.coalesce(F.sum("skills_found"), F.lit(0)).alias("skills"),
        F.count_if(F.col("head_sha").isNull()).alias("failed"), F.count_if(F.col("head_sha") == F.col("_before")).alias("unchanged"),
    )
