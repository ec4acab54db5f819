"""External references of texts, links of pages, and wording checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import rules as R

# What counts as a reference: kind, pattern, group.
REFERENCES = (
    ("npm", r"(?i)npm\s+(?:install|i|add)\s+([a-z0-9_@./-]+)"),
    ("npm", r"(?i)npx\s+([a-z0-9_@./-]+)"),
    ("npm", r"(?i)\"(@?[a-z0-9_.-]+(?:/[a-z0-9_.-]+)?)\":\s*\""),
    ("pypi", r"(?i)pip\s+install\s+([a-z0-9_-]+)"),
    ("pypi", r"(?i)from\s+([a-z0-9_-]+)\s+import"),
    ("pypi", r"(?im)^\s*import\s+([a-z0-9_-]+)"),
)
DOMAIN = r"(?i)https?://([a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?(?:\.[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?)*)"
NOT_REPOSITORIES = ("", "compare", "issues", "pulls", "actions", "settings")
HINTS = ("skills/*/SKILL.md", "plugins/*/skills/*/SKILL.md")


def repository_link(host: str) -> str:
    """Pattern of links to owner/repo on a code host."""
    return rf"(?i)(?:https?://)?(?:www\.)?{host.replace('.', chr(92) + '.')}/([a-z0-9_.-]+)/([a-z0-9_.-]+)"


def packages(text: Column, kind: str) -> Column:
    """Distinct sorted package names of a kind that a text installs or imports."""
    found = [F.regexp_extract_all(text, F.lit(R.pattern(p)), F.lit(1)) for k, p in REFERENCES if k == kind]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*found))))


def domains(text: Column, host: str = "github.com") -> Column:
    """Distinct sorted domains of a text's addresses, but for the code host."""
    found = F.transform(F.regexp_extract_all(text, F.lit(DOMAIN), F.lit(1)), F.lower)
    return F.array_sort(F.array_distinct(F.filter(found, lambda d: (d != host) & ~d.endswith(f".{host}"))))


def repositories(docs: DataFrame, record: str, text: str, host: str) -> DataFrame:
    """(record, url, at): links to repositories in order, without .git; pseudo-repositories left out."""
    link = repository_link(host)
    both = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(link), F.lit(1)).alias("owner"), F.regexp_extract_all(text, F.lit(link), F.lit(2)).alias("repo")
    )
    found = docs.where(F.col(text).rlike(link)).select(record, F.posexplode(both).alias("at", "l"))
    repo = F.regexp_replace("l.repo", r"\.git$", "")
    return found.where(~F.lower(repo).isin(*NOT_REPOSITORIES)).select(
        record, F.concat(F.lit(f"https://{host}/"), "l.owner", F.lit("/"), repo).alias("url"), "at"
    )


def distinct_links(links: DataFrame, *order: str) -> DataFrame:
    """(url): one row per address without regard to case, in the spelling that came first in the order."""
    first = F.min_by("url", F.struct(*order))
    return links.groupBy(F.lower("url").alias("_k")).agg(first.alias("url"), F.min(F.struct(*order)).alias("first_at")).select("url", "first_at")


def candidates(links: DataFrame, aggregator: str, excluded: DataFrame) -> DataFrame:
    """(repo_url, evidence, path_hints) of links that are not among the excluded (url)."""
    left = links.join(excluded.select(F.lower("url").alias("_x")).distinct(), F.lower(links["url"]) == F.col("_x"), "left_anti")
    hinted = F.lower("url").rlike("skill|agent|plugin")
    return left.select(
        F.col("url").alias("repo_url"),
        F.concat(F.lit("Found in "), aggregator, F.lit(" README")).alias("evidence"),
        F.when(hinted, F.array(*map(F.lit, HINTS))).alias("path_hints"),
    )


def union_of_candidates(*lists: DataFrame) -> DataFrame:
    """Candidates (repo_url, evidence, path_hints) of several aggregators, one row per address, the first list's before the next."""
    every = None
    for n, found in enumerate(lists):
        numbered = found.withColumn("_list", F.lit(n))
        every = numbered if every is None else every.unionByName(numbered)
    first = F.min_by(F.struct("repo_url", "evidence", "path_hints"), F.struct("_list", "repo_url"))
    return every.groupBy(F.lower("repo_url").alias("_k")).agg(first.alias("c")).select("c.*")


def reference_report(docs: DataFrame, record: str, text: str, known: DataFrame, host: str) -> DataFrame:
    """(record, refs, dangling, has_dangling): references met with a table known (type, reference, exists).

    A reference in no row of ``known`` is taken as dangling.
    """
    repos = repositories(docs, record, text, host).select(record, F.lit("repo").alias("type"), F.lower("url").alias("reference"))
    others = [
        docs.select(record, F.lit(kind).alias("type"), F.explode(value).alias("reference"))
        for kind, value in (("npm", packages(F.col(text), "npm")), ("pypi", packages(F.col(text), "pypi")), ("domain", domains(F.col(text), host)))
    ]
    refs = repos
    for o in others:
        refs = refs.unionByName(o)
    met = refs.distinct().join(known.select("type", "reference", "exists").distinct(), ["type", "reference"], "left")
    return met.groupBy(record).agg(
        F.count("*").alias("refs"), F.count_if(~F.coalesce("exists", F.lit(False))).alias("dangling")
    ).withColumn("has_dangling", F.col("dangling") > 0)


def owner(url: Column, host: str) -> Column:
    """The owner in a repository's address on the host, in lower case; null if it isn't one."""
    return F.nullif(F.lower(F.regexp_extract(url, rf"(?i)^https?://(?:www\.)?{host}/([^/?#]+)", 1)), F.lit(""))


def without_owner(sources: DataFrame, owners: DataFrame, host: str) -> DataFrame:
    """(source_id) of the sources whose owner is in no row of the existing ``owners`` (owner); addresses elsewhere are not judged."""
    of_source = sources.select(F.col("id").alias("source_id"), owner(F.col("url"), host).alias("owner")).where("owner is not null")
    return of_source.join(owners.select(F.lower("owner").alias("owner")).distinct(), "owner", "left_anti").select("source_id").distinct()


def wording(docs: DataFrame, record: str, text: str) -> DataFrame:
    """(record, line, description, line_text) of each line with avoided wording; lines that state a goal are exempt."""
    combined = "|".join(f"(?:{R.pattern(p)})" for _, p in R.WORDING)
    lines = docs.where(F.col(text).rlike(combined)).select(record, F.posexplode(F.split(text, "\n")).alias("at", "line_text"))
    lines = lines.where(~F.col("line_text").rlike(r"(?i)^\s*goal\s*:"))
    hits = F.array_compact(F.array(*(F.when(F.col("line_text").rlike(R.pattern(p)), d) for d, p in R.WORDING)))
    found = lines.select(record, (F.col("at") + 1).alias("line"), F.explode(hits).alias("description"), "line_text")
    return found.withColumn("line_text", F.regexp_replace("line_text", r"\s+$", ""))
