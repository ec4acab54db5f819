"""Registered queries over the catalog's tables, each with the SQL that says the same.

Queries run over whole tables.  Where SQL has no say (YAML, stemming, iterative
groups, edit similarity) there is no SQL, and tests compare with brute force.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import rules as R
from siltstone.functions import text as T
from siltstone.operators import changes, crawl, dedup, frontmatter, gates, keywords, licenses, neardup, quality, refs, search, security, stats
from siltstone.plans import catalog
from siltstone.plans.samples import CURATED_FILES, GATE_RECORD, GATE_SAMPLES, LICENSE_SAMPLES, SAMPLES
from siltstone.sources import io
from siltstone.storage import spread
from siltstone.streaming.changes import event_windows

HOST = "githost.example"
_REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def add(f):
        _REGISTRY[f.__name__] = (f, sql)
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _REGISTRY.items() if sql}


TEXTS = ("documents", "repo_files")  # tables whose rows take work


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXTS else df


def _skills(spark: SparkSession, d: str) -> DataFrame:
    """The catalog records, repeated deliveries once, flat where queries need it."""
    return table(spark, d, "skills").select(
        "id", "name", "description", "layer", "trust_tier", "status", "first_seen", "last_changed", "tags", "source", "hashes",
        F.col("hashes.content_hash").alias("content_hash"), "license", "security", "dedup",
    ).distinct()


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(names) -> str:
    return ", ".join(_quote(n) for n in names)


def _case(table_: dict, key: str, default: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {_quote(k)} THEN {v if isinstance(v, float | int) else _quote(v)}" for k, v in table_.items()) + f" ELSE {default} END"


# ---------------------------------------------------------------- text and hashes

_SPACE = r"[\t\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def hash_raw(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))


@query(
    rf"""SELECT doc_id, 'sha256:' || sha256(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(regexp_replace(text, '^\x{{feff}}', '')),
    '\r\n?', chr(10), 'g'), '{_SPACE}+(\n|\z)', '\1', 'g'), '\n+\z', '') || chr(10)) AS content_hash FROM documents"""
)
def normalize_text_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", F.concat(F.lit("sha256:"), F.sha2(T.normalized(F.col("text")), 256)).alias("content_hash"))


@query(
    r"""SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS words, len(regexp_extract_all(text, '[^\s\p{Z}\x0b\x1c-\x1f\x{85}]+')) AS blank_words,
    CASE WHEN text IS NULL THEN NULL WHEN text = '' THEN 0 ELSE len(regexp_extract_all(text, '\r\n|[\n\r\x0b\f\x1c-\x1e\x{85}\x{2028}\x{2029}]'))
    + CASE WHEN regexp_matches(text, '[\n\r\x0b\f\x1c-\x1e\x{85}\x{2028}\x{2029}]\z') THEN 0 ELSE 1 END END AS lines FROM documents"""
)
def word_stats(spark, d):
    c = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", T.word_count(c).alias("words"), T.blank_separated_words(c).alias("blank_words"), T.line_count(c).alias("lines")
    )


@query(
    r"""SELECT doc_id, count(*) AS grams, count(DISTINCT gram) AS distinct_grams FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5
    THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS gram FROM
    (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL)) GROUP BY doc_id"""
)
def ngram5_counts(spark, d):
    grams = table(spark, d, "documents").select("doc_id", F.explode(T.ngrams(F.col("text"))).alias("gram"))
    return grams.groupBy("doc_id").agg(F.count("*").alias("grams"), F.count_distinct("gram").alias("distinct_grams"))


# ---------------------------------------------------------------- exact duplicates

_ISO = r"'^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?$'"
_MICROS = (
    rf"CASE WHEN regexp_matches(first_seen, {_ISO}) THEN epoch_us(TRY_CAST(replace(CASE WHEN regexp_matches(first_seen, '(Z|[+-]\d{{2}}:\d{{2}})$') "
    "THEN first_seen ELSE first_seen || 'Z' END, 'Z', '+00:00') AS TIMESTAMPTZ)) END"
)
_RECORDS = (
    f"(SELECT id, content_hash, trust_tier, {_MICROS} AS seen FROM (SELECT DISTINCT id, hashes.content_hash AS content_hash, trust_tier, first_seen FROM skills))"
)


def _dedup_input(spark, d):
    return (
        table(spark, d, "skills").select("id", F.col("hashes.content_hash").alias("content_hash"), "trust_tier", "first_seen").distinct()
        .withColumn("seen", T.iso_micros(F.col("first_seen"))).drop("first_seen")
    )


@query(f"SELECT content_hash, count(*) AS n FROM {_RECORDS} WHERE content_hash <> '' GROUP BY 1")
def exact_clusters(spark, d):
    return dedup.clusters(_dedup_input(spark, d), "content_hash")


@query(
    f"""WITH r AS (SELECT *, CASE WHEN content_hash <> '' THEN content_hash END AS k FROM {_RECORDS}), w AS (SELECT *, first_value(id) OVER (PARTITION BY k
    ORDER BY CASE WHEN trust_tier = 'official' THEN 0 ELSE 1 END, seen NULLS LAST, CASE WHEN trust_tier = 'community' THEN 0 ELSE 1 END, id) AS c,
    count(*) OVER (PARTITION BY k) AS n FROM r)
    SELECT id, CASE WHEN k IS NULL THEN id ELSE c END AS canonical_id, CASE WHEN k IS NOT NULL AND c <> id THEN c END AS duplicate_of,
    CASE WHEN k IS NULL THEN 1 ELSE n END AS cluster_size, CASE WHEN k IS NOT NULL AND c <> id AND trust_tier IN ('unreviewed', 'aggregator-copy')
    THEN 'aggregator-copy' ELSE trust_tier END AS tier_after FROM w"""
)
def exact_dedup_canonical(spark, d):
    labelled = dedup.label_duplicates(_dedup_input(spark, d), "id", "content_hash", "trust_tier", "seen")
    return labelled.select("id", "canonical_id", "duplicate_of", "cluster_size", "tier_after")


@query(
    f"""SELECT count(*) FILTER (n > 1) AS duplicate_clusters, coalesce(sum(n - 1), 0)::BIGINT AS duplicate_records, count(*) AS distinct_keys
    FROM (SELECT content_hash, count(*) AS n FROM {_RECORDS} WHERE content_hash <> '' GROUP BY 1)"""
)
def dedup_counters(spark, d):
    return dedup.duplicate_counters(_dedup_input(spark, d), "content_hash")


@query(
    """WITH m AS (SELECT DISTINCT skill_id, canonical_id FROM skill_metadata), c AS (SELECT canonical_id, count(*) AS n FROM m WHERE canonical_id IS NOT NULL GROUP BY 1)
    SELECT skill_id, coalesce(n, 1) - 1 AS alternatives FROM m LEFT JOIN c USING (canonical_id)"""
)
def alternatives_count(spark, d):
    return dedup.alternatives(table(spark, d, "skill_metadata").select("skill_id", "canonical_id").distinct(), "skill_id", "canonical_id")


@query(f"SELECT content_hash, n FROM (SELECT content_hash, count(*) AS n FROM {_RECORDS} WHERE content_hash <> '' GROUP BY 1) ORDER BY n DESC, content_hash LIMIT 20")
def dup_report_topk(spark, d):
    """A report of the 20 largest clusters."""
    return dedup.clusters(_dedup_input(spark, d), "content_hash").orderBy(F.desc("n"), "content_hash").limit(20)


# ---------------------------------------------------------------- records

_REPO_OF_URL = rf"lower(regexp_replace(regexp_replace(url, '^https?://{HOST}/', ''), '(\.git)?/*$', ''))"


@query(
    f"""SELECT DISTINCT s.id, '{HOST}/' || {_REPO_OF_URL.replace("url", "c.url")} || '/' || s.source.path AS built_id, c.owner_type, c.tier
    FROM skills s JOIN sources c ON s.source.source_id = c.id"""
)
def records_join_sources(spark, d):
    sources = table(spark, d, "sources").select(F.col("id").alias("source_id"), "url", "owner_type", "tier")
    s = table(spark, d, "skills").select("id", F.col("source.source_id").alias("source_id"), F.col("source.path").alias("path"))
    joined = s.join(sources, "source_id")
    return joined.select("id", catalog.record_id(HOST, F.col("url"), F.col("path")).alias("built_id"), "owner_type", "tier").distinct()


@query(
    """WITH s AS (SELECT DISTINCT id, source.source_id AS source_id, hashes.content_hash AS h FROM skills), n AS (SELECT h, count(DISTINCT source_id) AS n FROM s GROUP BY 1)
    SELECT s.id, CASE WHEN owner_type = 'vendor' THEN 'official' WHEN tier = 2 THEN 'community' WHEN coalesce(tier, 3) = 3 AND n > 1 THEN 'aggregator-copy' ELSE 'unreviewed' END AS trust_tier
    FROM s JOIN sources c ON s.source_id = c.id LEFT JOIN n USING (h)"""
)
def trust_tier(spark, d):
    s = table(spark, d, "skills").select("id", F.col("source.source_id").alias("source_id"), F.col("hashes.content_hash").alias("h")).distinct()
    n = s.groupBy("h").agg(F.count_distinct("source_id").alias("n"))
    joined = s.join(table(spark, d, "sources").select(F.col("id").alias("source_id"), "owner_type", "tier"), "source_id").join(n, "h", "left")
    return joined.select("id", catalog.trust_tier(F.col("owner_type"), F.col("tier"), F.col("n")).alias("trust_tier"))


@query(
    r"""SELECT DISTINCT id, CASE WHEN trim(coalesce(name, '')) = '' THEN split_part(source.path, '/', -1) ELSE name END AS name,
    left(description, 1024) AS description FROM skills WHERE trim(coalesce(description, '')) <> ''"""
)
def fallback_truncate(spark, d):
    last = F.split_part("source.path", F.lit("/"), F.lit(-1))
    s = table(spark, d, "skills").where(F.trim(F.coalesce("description", F.lit(""))) != "")
    return s.select("id", F.when(F.trim(F.coalesce("name", F.lit(""))) == "", last).otherwise(F.col("name")).alias("name"), F.left("description", F.lit(1024)).alias("description")).distinct()


def _raw(spark, d):
    """Crawl rows as the catalog build takes them, from the repositories' files."""
    files = table(spark, d, "repo_files").where(crawl.is_package_file(F.col("path"))).select("repo", "path", "content").distinct()
    scripts = crawl.has_scripts(table(spark, d, "repo_files")).select("repo", "skill_dir", "has_scripts")
    placed = files.withColumn("skill_dir", F.coalesce(F.nullif(licenses.directory(F.col("path")), F.lit("")), F.lit(".")))
    return placed.join(scripts, ["repo", "skill_dir"], "left").select(
        F.regexp_replace("repo", "/", "-").alias("source_id"), "path", "skill_dir", "content", F.lit("0" * 40).alias("commit_sha"), "has_scripts"
    )


@query()
def catalog_record(spark, d):
    """The whole build: parse, hash, license, quality, security, trust, timestamps, exact duplicates."""
    raw = _raw(spark, d)
    repos = raw.select("source_id").distinct().select(
        F.col("source_id").alias("id"), F.concat(F.lit(f"https://{HOST}/"), F.regexp_replace("source_id", "^([a-z]+-[a-z]+)-", "$1/")).alias("url"),
        F.lit("community").alias("owner_type"), F.lit(3).alias("tier"),
    )
    previous = table(spark, d, "skills").select("id", F.col("hashes.content_hash").alias("content_hash"), "first_seen", "last_changed").dropDuplicates(["id"])
    built = catalog.build(raw, repos, previous, HOST, "2026-01-01T00:00:00+00:00")
    return built.select("id", "name", "trust_tier", "content_hash", "license", "security", "smells", "canonical_id", "duplicate_of", "first_seen")


# ---------------------------------------------------------------- licenses

_ALIAS = _case(R.ALIASES, "{}", "NULL")
_BARE = r"""regexp_replace(regexp_replace(declared, '^\s+|\s+$', '', 'g'), '^["'']+|["'']+$', '', 'g')"""
_NORMAL = (
    "CASE WHEN declared <> '' THEN coalesce(CASE " + " ".join(f"WHEN contains(b, {_quote(a)}) THEN {_quote(s)}" for a, s in R.ADDRESSES) + " END, "
    + _ALIAS.format(r"regexp_replace(b, '\s+[Ll]icense$', '')") + ", " + _ALIAS.format("b") + ", b) END"
)
_DECLARED = f"(SELECT id, declared, {_NORMAL} AS normalized FROM (SELECT id, declared, {_BARE} AS b FROM (SELECT DISTINCT id, license.declared AS declared FROM skills)))"


@query(f"SELECT id, declared, normalized FROM {_DECLARED}")
def license_normalize(spark, d):
    s = table(spark, d, "skills").select("id", F.col("license.declared").alias("declared")).distinct()
    return s.withColumn("normalized", licenses.normalize(F.col("declared")))


def _class_sql(expression: str, ids: str) -> str:
    some = lambda names: f"list_has_any({ids}, [{_values(names)}])"
    unknown = f"len(list_filter({ids}, lambda x: NOT list_contains([{_values((*R.ALLOW, *R.CONDITIONAL, *R.DENY))}], x))) > 0"
    return (
        f"CASE WHEN {expression} IS NULL OR {expression} IN ('NOASSERTION', 'LicenseRef-Unrecognized', '') THEN 'unknown' WHEN starts_with({expression}, 'LicenseRef-') THEN 'deny' "
        f"WHEN {some(R.DENY)} THEN 'deny' WHEN {unknown} OR len({ids}) = 0 THEN 'unknown' WHEN {some(R.CONDITIONAL)} THEN 'conditional' ELSE 'allow' END"
    )


_IDS = r"list_filter(regexp_split_to_array({}, '\s+(AND|OR|WITH)\s+|[()\s]+'), lambda x: x <> '')"


@query(f"SELECT id, normalized, {_class_sql('normalized', _IDS.format('normalized'))} AS license_class FROM {_DECLARED}")
def license_classify(spark, d):
    return license_normalize(spark, d).select("id", "normalized", licenses.classify(F.col("normalized")).alias("license_class"))


_FINGER = "CASE " + " ".join(
    "WHEN " + " AND ".join(f"contains(lower(content), {_quote(p)})" for p in phrases) + " THEN "
    + ("CASE WHEN contains(lower(content), 'neither the name') OR contains(content, '3.') THEN 'BSD-3-Clause' ELSE 'BSD-2-Clause' END" if spdx == "BSD" else _quote(spdx))
    for spdx, phrases in R.FINGERPRINTS
) + " END"


@query(f"SELECT DISTINCT repo, path, {_FINGER} AS spdx FROM repo_files WHERE regexp_matches(path, '{licenses.LICENSE_FILE}')")
def license_fingerprint(spark, d):
    files = table(spark, d, "repo_files").where(licenses.is_license_file(F.col("path")))
    return files.select("repo", "path", licenses.fingerprint(F.col("content")).alias("spdx")).distinct()


_DIR = "regexp_replace({}, '/?[^/]*$', '')"
_ABOVE = (
    "(SELECT DISTINCT p.repo, p.dir, f.path AS file, CASE WHEN f.at = '' THEN 0 ELSE len(string_split(f.at, '/')) END AS at_depth FROM "
    f"(SELECT DISTINCT repo, {_DIR.format('path')} AS dir FROM repo_files WHERE split_part(path, '/', -1) IN ('SKILL.md', 'skill.md')) p JOIN "
    f"(SELECT DISTINCT repo, path, {_DIR.format('path')} AS at FROM repo_files WHERE upper(regexp_extract(path, '([^/.]*)[^/]*$', 1)) IN ({_values(R.LICENSE_BASES)})) f "
    "ON p.repo = f.repo AND (f.at = '' OR p.dir = f.at OR starts_with(p.dir, f.at || '/')))"
)


def _package_dirs(spark, d):
    return crawl.packages(table(spark, d, "repo_files")).select("repo", F.regexp_replace("skill_dir", r"^\.$", "").alias("dir"))


@query(f"SELECT repo, dir, file, at_depth FROM {_ABOVE}")
def license_files_above(spark, d):
    return licenses.license_files_above(table(spark, d, "repo_files").select("repo", "path"), _package_dirs(spark, d))


@query(
    f"""SELECT repo, dir, file FROM (SELECT *, row_number() OVER (PARTITION BY repo, dir ORDER BY at_depth DESC, file) AS rn FROM {_ABOVE}
    WHERE regexp_matches(file, '{licenses.LICENSE_FILE}')) WHERE rn = 1"""
)
def nearest_license(spark, d):
    return licenses.nearest_license_file(table(spark, d, "repo_files").select("repo", "path"), _package_dirs(spark, d))


_PACKAGES = (
    "(SELECT DISTINCT id, license.declared AS declared, NULL::VARCHAR AS own_text, CASE WHEN license.evidence = 'skill-file' THEN source.path || '/LICENSE' END AS own_file, NULL::VARCHAR AS near_text, "
    "CASE WHEN license.evidence = 'repo-file' THEN 'LICENSE' END AS near_file, NULL::VARCHAR AS readme FROM skills UNION ALL SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join("NULL" if x is None else _quote(x) for x in row) + ")" for row in LICENSE_SAMPLES) + "))"
)


def _bare_sql(x: str) -> str:
    return rf"""regexp_replace(regexp_replace({x}, '^\s+|\s+$', '', 'g'), '^["'']+|["'']+$', '', 'g')"""


def _spdx_sql(x: str) -> str:
    ids = _IDS.format(x)
    known = f"[{_values((*R.ALLOW, *R.CONDITIONAL, *R.DENY))}]"
    return f"coalesce(len({ids}) > 0 AND len(list_filter({ids}, lambda i: NOT list_contains({known}, i) AND NOT starts_with(i, 'LicenseRef-'))) = 0, false)"


def _text_sql(text: str, file: str) -> str:
    return f"coalesce({_FINGER.replace('content', text)}, 'LicenseRef-' || split_part({file}, '/', 1) || '-terms')"


_some_sql = lambda x, names: f"list_has_any({_IDS.format(x)}, [{_values(names)}])"
_RESOLVED = rf"""(WITH a AS (SELECT *, trim(coalesce(declared, '')) AS dec, lower(trim(coalesce(declared, ''))) AS low FROM {_PACKAGES}),
    b AS (SELECT *, ((regexp_matches(low, 'licen[sc]e|copying') AND regexp_matches(low, 'see|in|has|complete terms')) OR regexp_matches(upper(dec), '^(?:LICEN[SC]E|COPYING)(?:\.(?:TXT|MD|RST))?$'))
      AND regexp_matches(low, '(?:licen[sc]e|copying)\.(?:txt|md|rst)|^(?:licen[sc]e|copying)$|\bsee\b') AS refers, {_bare_sql('dec')} AS b, {_bare_sql('readme')} AS rb FROM a),
    c AS (SELECT *, {_NORMAL.replace("declared <> ''", "dec <> ''")} AS plain, {_NORMAL.replace("declared <> ''", "readme <> ''").replace("(b, ", "(rb, ").replace("CASE b ", "CASE rb ").replace(", b) END", ", rb) END")} AS plain_readme FROM b),
    e AS (SELECT *, CASE WHEN starts_with(dec, 'Proprietary') THEN 1 WHEN refers AND own_file IS NOT NULL THEN 2 WHEN refers THEN 3 WHEN dec <> '' AND {_spdx_sql('plain')} THEN 4 WHEN dec <> '' THEN 5
      WHEN own_file IS NOT NULL THEN 6 WHEN near_file IS NOT NULL THEN 7 WHEN {_spdx_sql('plain_readme')} THEN 8 ELSE 9 END AS k FROM c),
    f AS (SELECT *, CASE k WHEN 1 THEN 'LicenseRef-Proprietary' WHEN 2 THEN {_text_sql('own_text', 'own_file')} WHEN 3 THEN 'NOASSERTION' WHEN 4 THEN plain WHEN 5 THEN 'LicenseRef-Unrecognized' WHEN 6 THEN {_text_sql('own_text', 'own_file')}
      WHEN 7 THEN {_text_sql('near_text', 'near_file')} WHEN 8 THEN plain_readme ELSE 'NOASSERTION' END AS spdx FROM e),
    g AS (SELECT *, {_class_sql('spdx', _IDS.format('spdx'))} AS kind FROM f)
    SELECT id, spdx, CASE WHEN k IN (1, 3, 4, 5) THEN 'frontmatter' WHEN k IN (2, 6) THEN 'skill-file' WHEN k = 7 AND strpos(near_file, '/') = 0 THEN 'repo-file' WHEN k = 7 THEN 'ancestor-file' WHEN k = 8 THEN 'readme' ELSE 'none' END AS evidence,
      CASE WHEN k IN (2, 6) THEN own_file WHEN k = 7 THEN near_file END AS file, CASE WHEN k = 8 THEN 'unknown' ELSE kind END AS license_class,
      k = 8 OR CASE WHEN spdx = 'LicenseRef-Proprietary' THEN false WHEN kind = 'unknown' OR starts_with(spdx, 'LicenseRef-') THEN true WHEN kind = 'deny' THEN {_some_sql('spdx', R.CONDITIONAL)} OR {_some_sql('spdx', R.ALLOW)}
        WHEN kind = 'conditional' THEN {_some_sql('spdx', R.ALLOW)} ELSE false END AS needs_review FROM g)"""


@query(f"SELECT * FROM {_RESOLVED}")
def license_resolve(spark, d):
    """The license of each record by what its row tells, and of samples for every branch of the cascade."""
    null = F.lit(None).cast("string")
    skills = table(spark, d, "skills").select(
        "id", F.col("license.declared").alias("declared"), null.alias("own_text"), F.when(F.col("license.evidence") == "skill-file", F.concat("source.path", F.lit("/LICENSE"))).alias("own_file"),
        null.alias("near_text"), F.when(F.col("license.evidence") == "repo-file", "LICENSE").alias("near_file"), null.alias("readme"),
    ).distinct()
    samples = spark.createDataFrame(list(LICENSE_SAMPLES), "id string, declared string, own_text string, own_file string, near_text string, near_file string, readme string")
    return licenses.resolve(skills.unionByName(samples)).select("id", "spdx", "evidence", "file", "license_class", "needs_review")


@query(
    r"""SELECT repo, nullif(trim(regexp_extract(content, '(?im)^#+[ \t]*license[ \t]*\r?\n(?:[ \t]*\r?\n)*([^#\r\n][^\r\n]*)', 1)), '') AS line FROM (SELECT repo, arg_min(content, CASE path WHEN 'README.md' THEN 1
    WHEN 'readme.md' THEN 2 WHEN 'README' THEN 3 ELSE 4 END) AS content FROM repo_files WHERE path IN ('README.md', 'readme.md', 'README', 'README.rst') AND content IS NOT NULL GROUP BY repo)"""
)
def readme_licenses(spark, d):
    """The first line of the license section of each repository's README."""
    return io.readme(table(spark, d, "repo_files")).select("repo", licenses.readme_license(F.col("content")).alias("line"))


@query()
def license_cascade(spark, d):
    """Declared license, own file, nearest file above, README: the license of each package."""
    files = table(spark, d, "repo_files").select("repo", "path", "content").distinct()
    packages = frontmatter.parse(files.where(crawl.is_package_file(F.col("path"))), "content", "path")
    packages = packages.select("repo", "path", licenses.directory(F.col("path")).alias("dir"), F.col("fm.license").alias("declared"))
    near = nearest_license(spark, d)
    texts = files.where(licenses.is_license_file(F.col("path"))).select("repo", F.col("path").alias("file"), F.col("content").alias("text")).dropDuplicates(["repo", "file"])
    placed = packages.join(near.join(texts, ["repo", "file"], "left"), ["repo", "dir"], "left")
    own = licenses.directory(F.col("file")) == F.col("dir")
    readmes = io.readme(files).select("repo", licenses.readme_license(F.col("content")).alias("readme"))
    records = placed.join(readmes, "repo", "left").select(
        "repo", "path", "declared", F.when(own, F.col("text")).alias("own_text"), F.when(own, F.col("file")).alias("own_file"),
        F.when(~own, F.col("text")).alias("near_text"), F.when(~own, F.col("file")).alias("near_file"), "readme",
    )
    return licenses.resolve(records).select("repo", "path", "spdx", "evidence", "file", "license_class", "needs_review")


# ---------------------------------------------------------------- quality and security

_TEXTS = "(SELECT DISTINCT repo || '/' || path AS id, content FROM repo_files)"


def _texts(spark, d):
    return table(spark, d, "repo_files").select(F.concat("repo", F.lit("/"), "path").alias("id"), "content").distinct()


_BODY = r"CASE WHEN regexp_matches(content, '(?s)^---\n.*?\n---\n') THEN regexp_replace(content, '(?s)^---\n.*?\n---\n', '') ELSE content END"
_SMELLS = rf"""CASE WHEN content <> '' THEN list_filter([
    CASE WHEN len(regexp_extract_all({_BODY}, '[^\s\p{{Z}}\x0b\x1c-\x1f\x{{85}}]+')) > {R.MAX_WORDS} THEN 'body-too-long' END,
    CASE WHEN len(regexp_extract_all(content, '\r\n|[\n\r\x0b\f\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]')) + CASE WHEN regexp_matches(content, '[\n\r\x0b\f\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]\z') THEN 0 ELSE 1 END > {R.MAX_LINES} THEN 'file-too-many-lines' END,
    CASE WHEN length(description) > {R.MAX_DESCRIPTION} THEN 'description-too-long' WHEN length(description) > 0 AND length(description) < {R.MIN_DESCRIPTION} THEN 'description-too-short' END,
    CASE WHEN regexp_matches(description, '{R.TAG}') THEN 'description-has-xml-tags' END,
    CASE WHEN regexp_matches(content, '{R.BACKSLASH_PATH}') THEN 'backslash-paths' END,
    CASE WHEN NOT regexp_matches(content, '{R.SPEAKS_OF_USE}') THEN 'missing-when-to-use' END,
    CASE WHEN lower(name) IN ({_values(R.RESERVED_NAMES)}) THEN 'reserved-word-name' END], lambda x: x IS NOT NULL) ELSE [] END"""
_SKILL_TEXTS = "(SELECT DISTINCT id, name, description, concat_ws(chr(10), name, description) AS content FROM skills)"
_DOC_SMELLS = "(SELECT doc_id AS id, kind AS name, CASE WHEN strpos(text, chr(10)) > 0 THEN left(text, strpos(text, chr(10)) - 1) ELSE text END AS description, text AS content FROM documents)"


def _doc_texts(spark, d):
    first = F.substring_index("text", "\n", 1)
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("kind").alias("name"), first.alias("description"), F.col("text").alias("content"))


@query(f"SELECT id, array_to_string({_SMELLS}, ',') AS smells FROM {_DOC_SMELLS}")
def quality_smells(spark, d):
    found = quality.smells(F.col("content"), F.col("name"), F.col("description"))
    return _doc_texts(spark, d).select("id", F.array_join(found, ",").alias("smells"))


@query(f"SELECT smell, count(*) AS n FROM (SELECT unnest({_SMELLS}) AS smell FROM {_DOC_SMELLS}) GROUP BY smell")
def smell_histogram(spark, d):
    found = quality.smells(F.col("content"), F.col("name"), F.col("description"))
    return _doc_texts(spark, d).select(F.explode(found).alias("smell")).groupBy("smell").agg(F.count("*").alias("n"))


_RULES = " UNION ALL ".join(
    f"SELECT {_quote(n)} AS pattern_name, '{k}' AS pattern_type, '{s}' AS severity, {_quote(p)} AS pattern" for k, rules in (("code", R.IOC), ("instruction", R.INSTRUCTIONS)) for n, s, p in rules
)
# documents, and samples (with negative ids) in which the rules occur, since the documents hold none
_SCANNED = (
    "(SELECT doc_id, text, 'source' AS layer, NULL::VARCHAR AS verdict FROM documents UNION ALL SELECT * FROM (VALUES "
    + ", ".join(f"(-{n}, {_quote(text)}, {_quote(layer)}, {_quote(verdict) if verdict else 'NULL'})" for n, (layer, verdict, text) in enumerate(SAMPLES, 1)) + "))"
)
_LINES = f"(SELECT doc_id, generate_subscripts(l, 1) AS line, unnest(l) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM {_SCANNED} WHERE text IS NOT NULL))"
_IOC = " UNION ALL ".join(
    f"SELECT doc_id, {_quote(n)} AS pattern_name, '{k}' AS pattern_type, '{s}' AS severity, line::INTEGER AS line, left(unnest(regexp_extract_all(t, {_quote(p)})), 100) AS matched FROM {_LINES}"
    for k, rules in (("code", R.IOC), ("instruction", R.INSTRUCTIONS)) for n, s, p in rules
)


def _scanned(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit("source").alias("layer"), F.lit(None).cast("string").alias("verdict"))
    samples = [(-n, text, layer, verdict) for n, (layer, verdict, text) in enumerate(SAMPLES, 1)]
    return docs.unionByName(spark.createDataFrame(samples, "doc_id long, text string, layer string, verdict string"))


@query(_IOC)
def ioc_matches(spark, d):
    return security.ioc_matches(_scanned(spark, d), "doc_id", "text")


@query(
    f"""SELECT doc_id, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'medium') AS medium,
    count(*) FILTER (severity = 'low') AS low, min_by(severity, CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3 ELSE 4 END) AS max_severity FROM ({_IOC}) GROUP BY doc_id"""
)
def ioc_severity_counts(spark, d):
    return security.severity_counts(ioc_matches(spark, d), "doc_id")


@query(
    rf"""SELECT doc_id, line::INTEGER AS line, unicode(c)::INTEGER AS code_point FROM (SELECT doc_id, line, unnest(regexp_extract_all(t, '{R.INVISIBLE}')) AS c FROM {_LINES})"""
)
def invisible_unicode(spark, d):
    return security.invisible_characters(_scanned(spark, d), "doc_id", "text")


_CAPS = "list_sort(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, {_quote(p)}) THEN '{n}' END" for n, p in R.CAPABILITIES) + "], lambda x: x IS NOT NULL))"


@query(f"SELECT doc_id, array_to_string({_CAPS}, ',') AS capabilities FROM {_SCANNED} WHERE text IS NOT NULL")
def capabilities(spark, d):
    docs = _scanned(spark, d).where("text is not null")
    return docs.select("doc_id", F.array_join(security.capabilities(F.col("text")), ",").alias("capabilities"))


_FIRST_LINE = "CASE WHEN strpos(text, chr(10)) > 0 THEN left(text, strpos(text, chr(10)) - 1) ELSE text END"
_HITS = rf"""(SELECT doc_id, pattern_name, severity FROM ({_IOC}) UNION ALL SELECT doc_id, 'xml_in_description', 'medium' FROM (SELECT doc_id, unnest(regexp_extract_all({_FIRST_LINE}, '{R.TAG_IN_DESCRIPTION}')) FROM {_SCANNED})
    UNION ALL SELECT doc_id, 'invisible_unicode', 'medium' FROM (SELECT doc_id, unnest(regexp_extract_all(t, '{R.INVISIBLE}')) AS c FROM {_LINES}))"""
_RISK = f"""(WITH n AS (SELECT doc_id, count(*) AS m, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'medium') AS medium,
    count(*) FILTER (severity = 'low') AS low FROM {_HITS} GROUP BY 1),
    b AS (SELECT doc_id, layer, verdict, coalesce({_CAPS}, []) AS caps, coalesce(m, 0) AS m, coalesce(critical, 0) AS critical, coalesce(high, 0) AS high, coalesce(medium, 0) AS medium, coalesce(low, 0) AS low
    FROM {_SCANNED} LEFT JOIN n USING (doc_id))
    SELECT *, CASE WHEN critical > 0 THEN 'critical' WHEN high > 0 THEN 'high' WHEN medium > 0 THEN 'medium' WHEN low > 0 THEN 'low' ELSE 'none' END AS max_severity,
    CASE WHEN critical > 0 OR list_contains(caps, 'money') OR list_contains(caps, 'external-instructions') THEN 'high' WHEN m > 0 OR len(caps) > 0 THEN 'medium' ELSE 'low' END AS risk_level,
    CASE WHEN critical > 0 OR coalesce(lower(verdict), '') = 'malicious' THEN 'malicious' WHEN layer = 'curated' AND m > 0 THEN 'review' WHEN layer = 'curated' THEN 'pass' WHEN m > 0 OR len(caps) > 0 THEN 'warn' ELSE 'pass' END AS status FROM b)"""


def _risk(spark, d):
    docs = _scanned(spark, d).withColumns({"scripts": F.lit(False), "first_line": F.substring_index("text", "\n", 1)})
    return security.scan(docs, "doc_id", "text", "first_line", "scripts", "layer", "verdict")


@query(
    """WITH e AS (SELECT DISTINCT skill_id, security AS engine, CASE WHEN security IN ('warn', 'review', 'malicious') THEN 1 ELSE 0 END AS findings FROM skill_metadata WHERE security IS NOT NULL),
    p AS (SELECT skill_id, array_to_string(list_sort(list(DISTINCT engine)), ',') AS engines, sum(findings)::BIGINT AS findings FROM e GROUP BY 1),
    s AS (SELECT DISTINCT id, layer, security.status AS status FROM skills)
    SELECT s.id, coalesce(engines, '') AS engines, coalesce(findings, 0) AS findings, CASE WHEN layer = 'curated' AND status = 'pass' AND coalesce(findings, 0) > 0 THEN 'review' ELSE status END AS status_after
    FROM s LEFT JOIN p ON s.id = p.skill_id"""
)
def external_scans(spark, d):
    """Records with what scanners outside reported; the flat index's verdicts stand for them, each wording an engine."""
    finding = F.when(F.col("security").isin("warn", "review", "malicious"), 1).otherwise(0)
    external = table(spark, d, "skill_metadata").select(F.col("skill_id").alias("record"), F.col("security").alias("engine"), finding.alias("findings"))
    records = table(spark, d, "skills").select("id", "layer", F.col("security.status").alias("status")).distinct()
    found = security.with_external(records, "id", "layer", "status", external)
    return found.select("id", F.array_join("engines", ",").alias("engines"), "findings", "status_after")


@query(f"SELECT doc_id, risk_level, status FROM {_RISK}")
def risk_status(spark, d):
    """Of each text, its first line taken as its description: risk and status, by what is found and by the upstream verdict."""
    return _risk(spark, d).select("doc_id", "risk_level", "status")


@query(
    f"""SELECT doc_id, status, risk_level, array_to_string(caps, ',') AS capabilities, max_severity, 'ioc_scanner' AS engine, critical, high, medium, low, coalesce(p, '') AS patterns, 'none' AS takedown
    FROM {_RISK} LEFT JOIN (SELECT doc_id, string_agg(pattern_name, ',' ORDER BY pattern_name) AS p FROM {_HITS} GROUP BY 1) USING (doc_id)"""
)
def security_field(spark, d):
    """The security struct of a record, with the scan's counts and patterns, flat."""
    made = _risk(spark, d).select("doc_id", security.security_field("2026-01-01T00:00:00+00:00", F.lit("0" * 40)).alias("s"))
    one = F.col("s.scans")[0]
    return made.select(
        "doc_id", "s.status", "s.risk_level", F.array_join("s.capabilities", ",").alias("capabilities"), "s.max_severity", one.engine.alias("engine"),
        *(one.counts[c].alias(c) for c in security.SEVERITIES), F.array_join(F.array_sort(F.transform(one.ioc_patterns, lambda x: x["name"])), ",").alias("patterns"),
        F.col("s.takedown.state").alias("takedown"),
    )


# ---------------------------------------------------------------- references and wording

_URLS = "(SELECT DISTINCT skill_id, concat_ws(' ', url, install_npx) AS t FROM skill_metadata)"


def _urls(spark, d):
    return table(spark, d, "skill_metadata").select("skill_id", F.concat_ws(" ", "url", "install_npx").alias("t")).distinct()


@query(rf"SELECT domain, count(*) AS n FROM (SELECT skill_id, unnest(list_distinct(list_transform(regexp_extract_all(t, '{refs.DOMAIN}', 1), lambda x: lower(x)))) AS domain FROM {_URLS}) WHERE domain <> 'github.com' AND NOT ends_with(domain, '.github.com') GROUP BY domain")
def page_domains(spark, d):
    found = _urls(spark, d).select(F.explode(refs.domains(F.col("t"))).alias("domain"))
    return found.groupBy("domain").agg(F.count("*").alias("n"))


_NPM = " || ".join(f"regexp_extract_all(t, {_quote(p)}, 1)" for k, p in refs.REFERENCES if k == "npm")


@query(f"SELECT skill_id, array_to_string(list_sort(list_distinct({_NPM})), ',') AS npm FROM {_URLS}")
def refs_packages(spark, d):
    return _urls(spark, d).select("skill_id", F.array_join(refs.packages(F.col("t"), "npm"), ",").alias("npm"))


_LINKS = rf"""(SELECT skill_id, 'https://{HOST}/' || owner || '/' || regexp_replace(repo, '\.git$', '') AS url FROM (SELECT skill_id, unnest(regexp_extract_all(t, '{refs.repository_link(HOST)}', 1)) AS owner,
    unnest(regexp_extract_all(t, '{refs.repository_link(HOST)}', 2)) AS repo FROM {_URLS}) WHERE lower(regexp_replace(repo, '\.git$', '')) NOT IN ({_values(refs.NOT_REPOSITORIES)}))"""


@query(f"SELECT lower(url) AS url, count(*) AS n FROM {_LINKS} GROUP BY 1")
def page_links(spark, d):
    links = refs.repositories(_urls(spark, d), "skill_id", "t", HOST)
    return links.groupBy(F.lower("url").alias("url")).agg(F.count("*").alias("n"))


_DISTINCT_LINKS = f"(SELECT min_by(url, skill_id || chr(1) || url) AS url FROM {_LINKS} GROUP BY lower(url))"


@query(
    f"""SELECT url AS repo_url, 'Found in ' || 'catalog' || ' README' AS evidence, CASE WHEN regexp_matches(lower(url), 'skill|agent|plugin') THEN '{",".join(refs.HINTS)}' END AS path_hints
    FROM {_DISTINCT_LINKS} WHERE lower(url) NOT IN (SELECT lower(url) FROM sources WHERE url IS NOT NULL)"""
)
def discover_candidates(spark, d):
    links = refs.distinct_links(refs.repositories(_urls(spark, d), "skill_id", "t", HOST), "skill_id", "url")
    found = refs.candidates(links, F.lit("catalog"), table(spark, d, "sources").where("url is not null"))
    return found.withColumn("path_hints", F.array_join("path_hints", ","))


@query(
    rf"""WITH known AS (SELECT DISTINCT 'https://{HOST}/' || {_REPO_OF_URL} AS reference FROM sources), r AS (SELECT DISTINCT skill_id, 'repo' AS type, lower(url) AS reference FROM {_LINKS}
    UNION SELECT skill_id, 'npm', unnest(list_distinct({_NPM})) FROM {_URLS}
    UNION SELECT skill_id, 'domain', unnest(list_distinct(list_transform(regexp_extract_all(t, '{refs.DOMAIN}', 1), lambda x: lower(x)))) FROM {_URLS})
    SELECT skill_id, count(*) AS refs, count(*) FILTER (NOT (type = 'repo' AND reference IN (SELECT reference FROM known))) AS dangling,
    count(*) FILTER (NOT (type = 'repo' AND reference IN (SELECT reference FROM known))) > 0 AS has_dangling FROM r WHERE NOT (type = 'domain' AND reference = '{HOST}') GROUP BY skill_id"""
)
def refs_dangling(spark, d):
    repo = F.lower(F.regexp_replace(F.regexp_replace("url", rf"^https?://{HOST}/", ""), r"(\.git)?/*$", ""))
    known = table(spark, d, "sources").where("url is not null").select(F.lit("repo").alias("type"), F.concat(F.lit(f"https://{HOST}/"), repo).alias("reference"), F.lit(True).alias("exists"))
    return refs.reference_report(_urls(spark, d), "skill_id", "t", known, HOST)


_WORDING = " UNION ALL ".join(
    rf"SELECT doc_id, line::INTEGER AS line, {_quote(n)} AS description, regexp_replace(t, '\s+$', '') AS line_text FROM {_LINES} WHERE regexp_matches(t, {_quote(p)}) AND NOT regexp_matches(t, '(?i)^\s*goal\s*:')"
    for n, p in R.WORDING
)


@query(_WORDING)
def wording_lint(spark, d):
    return refs.wording(_scanned(spark, d), "doc_id", "text")


# ---------------------------------------------------------------- gates and constraints

_GATE = "list_filter([" + ", ".join(
    f"CASE WHEN {c} THEN {_quote(m)} END"
    for c, m in (
        ("status = 'dangling'", "Skill status is 'dangling' (owner or repo no longer exists)"),
        ("security.status = 'malicious'", "Security status is 'malicious'"),
        *((f"coalesce({f}, '') = ''", f"Missing required field: {f}") for f in ("id", "name", "description")),
        *((f"coalesce(hashes.{f}, '') = ''", f"Missing required hash: {f}") for f in ("skill_md_sha256", "content_hash", "folder_sha256")),
        ("coalesce(source.commit, '') = ''", "Missing source commit SHA"),
    )
) + "], lambda x: x IS NOT NULL)"


@query(f"SELECT id AS skill_id, len(r) = 0 AS passes, array_to_string(r, '; ') AS reasons FROM (SELECT DISTINCT id, {_GATE} AS r FROM skills)")
def gate_source(spark, d):
    judged = gates.gate(table(spark, d, "skills"), gates.source_reasons(), "source")
    return judged.select("skill_id", "passes", F.array_join("reasons", "; ").alias("reasons")).distinct()


# catalogue records as the gate takes them, and samples in which each of its checks fails
_BLOCKING = rf"""list_filter([CASE WHEN length(description) > {R.MAX_DESCRIPTION} THEN 'description-too-long' WHEN length(description) BETWEEN 1 AND {R.MIN_DESCRIPTION - 1} THEN 'description-too-short' END,
    CASE WHEN regexp_matches(description, '{R.TAG}') THEN 'description-has-xml-tags' END, CASE WHEN lower(name) IN ({_values(R.RESERVED_NAMES)}) THEN 'reserved-word-name' END], lambda x: x IS NOT NULL)"""
_STRICT = rf"coalesce(regexp_full_match(name, '{R.NAME}') AND length(name) BETWEEN 1 AND 64 AND length(description) BETWEEN 1 AND 1024, false)"
_DUCK_RECORD = json.dumps({
    "id": "VARCHAR", "conformance": {"strict": "BOOLEAN", "errors": ["VARCHAR"]}, "license": {"class": "VARCHAR"}, "curated_path": "VARCHAR", "trust_tier": "VARCHAR",
    "security": {"status": "VARCHAR", "scans": [{"engine": "VARCHAR", "ioc_patterns": [{"name": "VARCHAR", "severity": "VARCHAR"}]}],
                 "external_refs": [{"reference": "VARCHAR", "exists": "BOOLEAN", "critical": "BOOLEAN"}]},
    "status": "VARCHAR", "quality": {"smells": ["VARCHAR"]}, "layer": "VARCHAR",
})
_GATE_RECORDS = f"""(SELECT id, {_STRICT} AS strict, []::VARCHAR[] AS errors, license.class AS license_class, CASE WHEN layer = 'curated' THEN 'curated/' || name END AS curated_path,
    CASE WHEN license.evidence IN ('skill-file', 'repo-file') THEN ['LICENSE'] ELSE [] END AS files, trust_tier, security.status AS sec, CASE WHEN security.risk_level IS NULL THEN [] ELSE ['ioc_scanner'] END AS engines,
    []::STRUCT(name VARCHAR, severity VARCHAR)[] AS found, []::STRUCT(reference VARCHAR, "exists" BOOLEAN, critical BOOLEAN)[] AS refs, status, {_BLOCKING} AS smells, layer FROM skills
    UNION ALL SELECT r.id, coalesce(r.conformance.strict, false), coalesce(r.conformance.errors, []), r.license.class, r.curated_path,
    list_transform(list_filter([{_values(CURATED_FILES)}], lambda f: regexp_replace(f, '/[^/]*$', '') = r.curated_path), lambda f: split_part(f, '/', -1)), r.trust_tier, r.security.status,
    coalesce(list_transform(r.security.scans, lambda x: x.engine), []), coalesce(flatten(list_transform(r.security.scans, lambda x: coalesce(x.ioc_patterns, []))), []), coalesce(r.security.external_refs, []), r.status,
    coalesce(r.quality.smells, []), r.layer FROM (SELECT unnest([{", ".join(f"json_transform({_quote(json.dumps(x))}, {_quote(_DUCK_RECORD)})" for x in GATE_SAMPLES)}]) AS r))"""
_WHEN = lambda *checks: "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {_quote(m)} END" for c, m in checks) + "], lambda x: x IS NOT NULL)"
_MIRRORED = "coalesce(curated_path, '') <> ''"
_CURATED = " || ".join((
    _WHEN(("list_contains(errors, 'filename-lowercase')", "SKILL.md filename must be exact case (not skill.md)")),
    "CASE WHEN strict THEN [] ELSE ['Frontmatter does not pass strict conformance'] || list_transform(list_filter(errors, lambda e: e <> 'filename-lowercase'), lambda e: 'Conformance error: ' || e) END",
    """CASE WHEN coalesce(license_class, 'None') NOT IN ('allow', 'conditional') THEN ['License class must be ''allow'' or ''conditional'', got ''' || coalesce(license_class, 'None') || ''''] ELSE [] END""",
    _WHEN(
        (f"license_class = 'conditional' AND {_MIRRORED} AND NOT list_has_any(files, ['NOTICE', 'ATTRIBUTION.md'])", "Conditional license requires NOTICE or ATTRIBUTION file"),
        (f"{_MIRRORED} AND NOT list_contains(files, 'LICENSE')", "Missing LICENSE file in curated directory"),
        (f"NOT {_MIRRORED}", "Missing curated_path (skill not mirrored to curated/)"),
        ("trust_tier = 'aggregator-copy'", "Aggregator copies cannot be curated (must be from canonical source)"),
        ("sec = 'malicious'", "Security status is 'malicious'"), ("sec = 'error'", "Security scan failed with errors"),
    ),
    "list_transform(list_filter(found, lambda i: lower(i.severity) IN ('high', 'critical')), lambda i: 'Unresolved ' || upper(i.severity) || ' security finding: ' || coalesce(i.name, 'unknown'))",
    _WHEN(("NOT list_contains(engines, 'ioc_scanner')", "Missing IOC scanner (required)"), ("status = 'dangling'", "Skill status is 'dangling' (owner or source no longer exists)")),
    "list_transform(list_filter(refs, lambda r: NOT coalesce(r.\"exists\", false) AND coalesce(r.critical, false)), lambda r: 'Critical external reference is dangling: ' || coalesce(r.reference, 'unknown'))",
    f"list_transform(list_filter(smells, lambda x: x IN ({_values(R.BLOCKING_SMELLS)})), lambda x: 'Blocking quality smell: ' || x)",
    _WHEN(("coalesce(layer, '') <> 'curated'", "Skill layer is not 'curated' (no human approval)")),
))
_WATCHED = "coalesce(layer = 'curated', false) AND coalesce(status, '') NOT IN ('removed', 'quarantined')"


def _gate_records(spark, d):
    c = F.col
    found = F.array_compact(F.array(
        F.when(F.length("description") > R.MAX_DESCRIPTION, "description-too-long").when(F.length("description").between(1, R.MIN_DESCRIPTION - 1), "description-too-short"),
        F.when(c("description").rlike(R.pattern(R.TAG)), "description-has-xml-tags"), F.when(F.lower("name").isin(*R.RESERVED_NAMES), "reserved-word-name"),
    ))
    strict = F.coalesce(c("name").rlike(R.NAME) & F.length("name").between(1, 64) & F.length("description").between(1, 1024), F.lit(False))
    patterns, refs_ = "array<struct<name:string,severity:string>>", "array<struct<reference:string,exists:boolean,critical:boolean>>"
    scans = F.when(c("security.risk_level").isNotNull(), F.array(F.struct(F.lit("ioc_scanner").alias("engine"), F.array().cast(patterns).alias("ioc_patterns"))))
    skills = table(spark, d, "skills").select(
        "id", F.struct(strict.alias("strict"), F.array().cast("array<string>").alias("errors")).alias("conformance"), F.struct(c("license.class").alias("class")).alias("license"),
        F.when(c("layer") == "curated", F.concat(F.lit("curated/"), "name")).alias("curated_path"), "trust_tier",
        F.struct(c("security.status").alias("status"), scans.alias("scans"), F.array().cast(refs_).alias("external_refs")).alias("security"), "status",
        F.struct(found.alias("smells")).alias("quality"), "layer", F.when(c("license.evidence").isin("skill-file", "repo-file"), F.array(F.lit("LICENSE"))).alias("curated_files"),
    )
    lines = spark.createDataFrame([(json.dumps(x),) for x in GATE_SAMPLES], "line string")
    samples = gates.with_curated_files(lines.select(F.inline(F.array(F.from_json("line", GATE_RECORD)))), spark.createDataFrame([(f,) for f in CURATED_FILES], "path string"))
    return skills.unionByName(samples)


@query(f"SELECT id AS skill_id, len(r) = 0 AS passes, array_to_string(r, '; ') AS reasons FROM (SELECT DISTINCT id, {_CURATED} AS r FROM {_GATE_RECORDS})")
def gate_curated(spark, d):
    judged = gates.gate(_gate_records(spark, d), gates.curated_reasons(), "curated")
    return judged.select("skill_id", "passes", F.array_join("reasons", "; ").alias("reasons")).distinct()


@query(f"SELECT id AS skill_id, array_to_string(r, '; ') AS reasons FROM (SELECT DISTINCT id, {_CURATED} AS r FROM {_GATE_RECORDS} WHERE {_WATCHED}) WHERE len(r) > 0")
def gate_regressions(spark, d):
    """Curated records that would no longer pass."""
    return gates.regressions(_gate_records(spark, d)).select("skill_id", F.array_join("reasons", "; ").alias("reasons")).distinct()


@query(f"SELECT DISTINCT id AS skill_id, CASE WHEN {_WATCHED} AND len({_CURATED}) > 0 THEN 'review' ELSE status END AS status FROM {_GATE_RECORDS}")
def regressions_marked(spark, d):
    """The status of every record after the regression check."""
    return gates.marked_for_review(_gate_records(spark, d)).select(F.col("id").alias("skill_id"), "status").distinct()


@query(
    f"""SELECT doc_id, CASE WHEN status IN ('malicious', 'error') THEN 'Security status is ' || status ELSE array_to_string(list_filter([CASE WHEN critical > 0 THEN 'Unresolved CRITICAL findings' END,
    CASE WHEN high > 0 THEN 'Unresolved HIGH findings' END], lambda x: x IS NOT NULL), '; ') END AS reasons FROM {_RISK}"""
)
def gate_security(spark, d):
    return _risk(spark, d).select("doc_id", F.array_join(gates.security_reasons(), "; ").alias("reasons"))


def _rules_sql(rules: tuple[gates.Rule, ...], table_: str, numeric: tuple[str, ...] = ()) -> str:
    out = []
    for r in rules:
        size = r.path if r.path in numeric else f"length({r.path})"
        checks = [(f"{r.path} IS NULL", "required")] if r.required else []
        if r.values:
            checks.append((f"{r.path} NOT IN ({_values(r.values)})", "enum"))
        if r.pattern:
            checks.append((f"NOT regexp_matches({r.path}, '{r.pattern}')", "pattern"))
        if r.least is not None:
            checks.append((f"{size} < {r.least}", "minimum"))
        if r.most is not None:
            checks.append((f"{size} > {r.most}", "maximum"))
        out += [f"SELECT id AS record, '{r.path}' AS path, '{p}' AS problem FROM {table_} WHERE {c}" for c, p in checks]
    return " UNION ALL ".join(out)


@query(f"SELECT DISTINCT * FROM ({_rules_sql(gates.RECORD_RULES, 'skills')})")
def schema_violations(spark, d):
    return gates.violations(table(spark, d, "skills"), "id", gates.RECORD_RULES).distinct()


@query(f"SELECT DISTINCT * FROM ({_rules_sql(gates.SOURCE_RULES, 'sources', ('tier',))})")
def source_violations(spark, d):
    return gates.violations(table(spark, d, "sources"), "id", gates.SOURCE_RULES).distinct()


# ---------------------------------------------------------------- change capture

_PREV = "(SELECT DISTINCT skill_id AS id, content_hash, license, security FROM skill_metadata)"
_NEXT = "(SELECT DISTINCT id, hashes.content_hash AS content_hash, license.spdx AS license, security.status AS security FROM skills)"


def _snapshots(spark, d):
    prev = table(spark, d, "skill_metadata").select(F.col("skill_id").alias("id"), "content_hash", "license", "security").distinct()
    new = table(spark, d, "skills").select(
        "id", F.col("hashes.content_hash").alias("content_hash"), F.col("license.spdx").alias("license"), F.col("security.status").alias("security")
    )
    return prev, new.distinct()


@query(
    f"""SELECT * FROM (SELECT coalesce(p.id, n.id) AS id, CASE WHEN p.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN p.content_hash IS NOT DISTINCT FROM n.content_hash THEN NULL
    WHEN p.security IS DISTINCT FROM n.security THEN 'security-changed' WHEN p.license IS DISTINCT FROM n.license THEN 'license-changed' ELSE 'updated' END AS type,
    CASE WHEN p.id IS NOT NULL AND n.id IS NOT NULL THEN p.content_hash END AS old_hash, CASE WHEN p.id IS NOT NULL AND n.id IS NOT NULL THEN n.content_hash END AS new_hash
    FROM {_PREV} p FULL JOIN {_NEXT} n ON p.id = n.id) WHERE type IS NOT NULL"""
)
def snapshot_changes(spark, d):
    """From the flat index (an older snapshot) to the catalog."""
    return changes.changes(*_snapshots(spark, d))


_NOW = "2026-01-01T00:00:00+00:00"
_OLD = "(SELECT id, min(content_hash) AS content_hash, min(first_seen) AS first_seen, min(last_changed) AS last_changed FROM (SELECT id, hashes.content_hash AS content_hash, first_seen, last_changed FROM skills) GROUP BY id)"


@query(
    f"""SELECT n.id, coalesce(o.first_seen, '{_NOW}') AS first_seen, '{_NOW}' AS last_seen, CASE WHEN o.id IS NOT NULL AND o.content_hash IS NOT DISTINCT FROM n.content_hash
    THEN coalesce(o.last_changed, '{_NOW}') ELSE '{_NOW}' END AS last_changed FROM {_PREV} n LEFT JOIN {_OLD} o ON n.id = o.id"""
)
def timestamps_carry_forward(spark, d):
    old = table(spark, d, "skills").select("id", F.col("hashes.content_hash").alias("content_hash"), "first_seen", "last_changed")
    old = old.groupBy("id").agg(*(F.min(c).alias(c) for c in ("content_hash", "first_seen", "last_changed")))
    return changes.carry_forward(old, _snapshots(spark, d)[0], _NOW)


@query(
    f"""SELECT id, status, last_seen FROM (SELECT DISTINCT skill_id AS id, 'active' AS status, '{_NOW}' AS last_seen FROM skill_metadata UNION ALL
    SELECT id, 'removed', CASE WHEN status = 'removed' THEN last_seen ELSE '{_NOW}' END FROM (SELECT DISTINCT id, status, last_seen FROM skills) WHERE id NOT IN (SELECT skill_id FROM skill_metadata))"""
)
def carry_removed_union(spark, d):
    new = table(spark, d, "skill_metadata").select(F.col("skill_id").alias("id"), F.lit("active").alias("status"), F.lit(_NOW).alias("last_seen")).distinct()
    return changes.with_removed(table(spark, d, "skills").select("id", "status", "last_seen").distinct(), new, _NOW)


@query(
    """SELECT DISTINCT source.source_id AS source_id, lower(source.commit) AS head_sha FROM skills WHERE source.commit IS NOT NULL
    AND (source.source_id, lower(source.commit)) NOT IN (SELECT (source_id, head_sha) FROM crawl_state WHERE head_sha IS NOT NULL)"""
)
def incremental_skip(spark, d):
    heads = table(spark, d, "skills").select(F.col("source.source_id").alias("source_id"), F.lower("source.commit").alias("head_sha"))
    return changes.not_yet_crawled(heads.where("head_sha is not null").distinct(), table(spark, d, "crawl_state"))


@query(
    """SELECT source_id, arg_max(head_sha, (crawled_at, head_sha)) FILTER (head_sha IS NOT NULL) AS head_sha, max(crawled_at) FILTER (head_sha IS NOT NULL) AS crawled_at,
    arg_max_null(last_error, (crawled_at, coalesce(head_sha, ''), coalesce(last_error, ''))) AS last_error FROM crawl_state GROUP BY source_id"""
)
def crawl_latest(spark, d):
    return crawl.latest_state(table(spark, d, "crawl_state")).select("source_id", "head_sha", "crawled_at", "last_error")


@query(
    """SELECT count(DISTINCT source_id) AS sources, coalesce(sum(skills_found), 0)::BIGINT AS skills, count(*) FILTER (head_sha IS NULL) AS failed,
    count(*) FILTER (head_sha = b) AS unchanged FROM (SELECT *, lag(head_sha) OVER (PARTITION BY source_id ORDER BY crawled_at, head_sha NULLS FIRST) AS b FROM (SELECT DISTINCT * FROM crawl_state))"""
)
def crawl_rollup(spark, d):
    return crawl.rollup(table(spark, d, "crawl_state"))


@query(
    """SELECT id, url, split_part(split_part(trim(owner_type), ' ', 1), '/', 1) AS owner_type, tier, 'active' AS status, '2026-01-01' AS added_at, false AS verified,
    nullif(concat_ws(' | ', CASE WHEN coalesce(notes, '') <> '' THEN 'Pattern: ' || notes END, CASE WHEN coalesce(policy, '') NOT IN ('', 'allow') THEN 'Curated policy: ' || policy END), '') AS notes FROM sources"""
)
def seeds_import(spark, d):
    """Sources as seed entries, imported again."""
    seeds = table(spark, d, "sources").select(
        "id", "url", "owner_type", "tier", F.col("notes").alias("pattern_notes"), F.col("policy").alias("curated_policy"), F.lit(None).cast("string").alias("curated_eligible_note")
    )
    return io.seeds_to_sources(seeds, "2026-01-01").drop("last_crawled_commit", "last_crawled_at")


@query(
    """SELECT s.id, h.head_sha, CASE WHEN h.head_sha IS NULL THEN 'missing' ELSE 'active' END AS status FROM (SELECT DISTINCT id FROM sources) s LEFT JOIN
    (SELECT source_id, arg_max(head_sha, (crawled_at, head_sha)) AS head_sha FROM crawl_state WHERE regexp_full_match(head_sha, '[0-9a-f]{40}') GROUP BY 1) h ON s.id = h.source_id"""
)
def sources_probed(spark, d):
    """Sources whose repository answered, and its newest head; the others are missing."""
    heads = table(spark, d, "crawl_state").select("source_id", "head_sha", F.col("crawled_at").alias("at"))
    return crawl.probed(table(spark, d, "sources"), heads)


_SINCE = "2026-01-01 00:00:00"
_UPSERT = f"""WITH a AS (SELECT DISTINCT source_id, head_sha, crawled_at, skills_found, last_error FROM crawl_state),
    o AS (SELECT source_id, arg_max(head_sha, (crawled_at, head_sha)) FILTER (head_sha IS NOT NULL) AS head_sha, max(crawled_at) FILTER (head_sha IS NOT NULL) AS crawled_at,
    arg_max(skills_found, (crawled_at, head_sha)) FILTER (head_sha IS NOT NULL) AS skills_found,
    arg_max_null(last_error, (crawled_at, coalesce(head_sha, ''), coalesce(last_error, ''))) AS last_error FROM a WHERE crawled_at < TIMESTAMP '{_SINCE}' GROUP BY source_id),
    n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY crawled_at DESC, head_sha DESC NULLS LAST, last_error DESC NULLS LAST, skills_found DESC NULLS LAST) AS rn FROM a WHERE crawled_at >= TIMESTAMP '{_SINCE}') WHERE rn = 1),
    j AS (SELECT coalesce(o.source_id, n.source_id) AS source_id, o.head_sha AS oh, o.crawled_at AS oc, o.skills_found AS os, o.last_error AS oe, n.head_sha AS nh, n.crawled_at AS nc, n.skills_found AS ns, n.last_error AS ne,
    CASE WHEN n.source_id IS NULL THEN 'untried' WHEN n.head_sha IS NULL THEN 'failed' WHEN n.head_sha = o.head_sha THEN 'skipped' ELSE 'crawled' END AS outcome FROM o FULL JOIN n ON o.source_id = n.source_id)
    SELECT source_id, outcome, CASE WHEN outcome = 'crawled' THEN nh ELSE oh END AS head_sha, CASE WHEN outcome = 'crawled' THEN nc ELSE oc END AS crawled_at, CASE WHEN outcome = 'crawled' THEN ns ELSE os END AS skills_found,
    CASE outcome WHEN 'failed' THEN coalesce(ne, 'Failed to get HEAD SHA') WHEN 'crawled' THEN NULL ELSE oe END AS last_error FROM j"""


def _upserted(spark, d):
    every = table(spark, d, "crawl_state").select("source_id", "head_sha", "crawled_at", "skills_found", "last_error").distinct()
    since = F.lit(_SINCE).cast("timestamp")
    low = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    last = F.max_by(F.struct(*every.columns), F.struct("crawled_at", low("head_sha"), low("last_error"), F.coalesce("skills_found", F.lit(-1))))
    attempts = every.where(F.col("crawled_at") >= since).groupBy(F.col("source_id").alias("_s")).agg(last.alias("r")).select("r.*")
    return crawl.upsert_state(crawl.latest_state(every.where(F.col("crawled_at") < since)), attempts)


@query(_UPSERT)
def crawl_upsert(spark, d):
    """The state after the last attempt since a date on top of what was before: crawled, skipped, failed, untried."""
    return _upserted(spark, d)


@query(f"SELECT outcome, count(*) AS sources, coalesce(sum(CASE WHEN outcome = 'crawled' THEN skills_found END), 0)::BIGINT AS skills_found FROM ({_UPSERT}) GROUP BY outcome")
def crawl_outcomes(spark, d):
    """The rollup of one run over all sources."""
    found = F.coalesce(F.sum(F.when(F.col("outcome") == "crawled", F.col("skills_found"))), F.lit(0))
    return _upserted(spark, d).groupBy("outcome").agg(F.count("*").alias("sources"), found.alias("skills_found"))


_OWNER = rf"nullif(lower(regexp_extract(url, '(?i)^https?://(?:www\.)?{HOST}/([^/?#]+)', 1)), '')"


@query(
    f"""WITH s AS (SELECT id, {_OWNER} AS owner, lower(status) AS status FROM sources), gone AS (SELECT DISTINCT id FROM s WHERE owner IS NOT NULL AND owner NOT IN (SELECT owner FROM s WHERE status = 'active' AND owner IS NOT NULL))
    SELECT DISTINCT k.id, CASE WHEN g.id IS NOT NULL THEN 'dangling' ELSE k.status END AS status, CASE WHEN g.id IS NOT NULL THEN 'source_owner_deleted' END AS status_reason FROM skills k LEFT JOIN gone g ON k.source.source_id = g.id"""
)
def dangling_owners(spark, d):
    """Records of sources whose owner no longer exists; the owners of active sources are taken to exist."""
    sources = table(spark, d, "sources")
    owners = sources.where(F.lower("status") == "active").select(refs.owner(F.col("url"), HOST).alias("owner")).where("owner is not null")
    records = table(spark, d, "skills").select("id", "status", F.col("source.source_id").alias("source_id"))
    return catalog.mark_dangling(records, refs.without_owner(sources, owners, HOST)).select("id", "status", "status_reason").distinct()


@query(
    """SELECT DISTINCT s.source.source_id AS source_id, s.source.path || '/SKILL.md' AS path FROM skills s JOIN sources c ON s.source.source_id = c.id
    WHERE (len(coalesce(c.include_patterns, [])) = 0 OR regexp_matches(s.source.path || '/SKILL.md', '^skills/[^/]*/SKILL\\.md(?:/.*)?$'))
    AND NOT (len(coalesce(c.exclude_patterns, [])) > 0 AND regexp_matches(s.source.path || '/SKILL.md', '^(?:.*/)?tests/.*(?:/.*)?$'))""".replace("\\\\", "\\")
)
def path_filter(spark, d):
    """Package files that their source's patterns let through."""
    files = table(spark, d, "skills").select(F.col("source.source_id").alias("source_id"), F.concat("source.path", F.lit("/SKILL.md")).alias("path"))
    return crawl.select_paths(files, table(spark, d, "sources")).select("source_id", "path").distinct()


@query(
    f"""WITH p AS (SELECT DISTINCT repo, {_DIR.format('path')} AS dir FROM repo_files WHERE split_part(path, '/', -1) IN ('SKILL.md', 'skill.md')), f AS (SELECT DISTINCT repo, path FROM repo_files)
    SELECT p.repo, CASE WHEN p.dir = '' THEN '.' ELSE p.dir END AS skill_dir, count(*) AS files,
    bool_or(list_contains(string_split({_DIR.format("CASE WHEN p.dir = '' THEN f.path ELSE substr(f.path, length(p.dir) + 2) END")}, '/'), 'scripts')) AS has_scripts
    FROM p JOIN f ON p.repo = f.repo AND (p.dir = '' OR starts_with(f.path, p.dir || '/')) GROUP BY 1, 2"""
)
def package_scripts(spark, d):
    return crawl.has_scripts(table(spark, d, "repo_files"))


@query(
    f"""WITH p AS (SELECT DISTINCT repo, {_DIR.format('path')} AS dir FROM repo_files WHERE split_part(path, '/', -1) IN ('SKILL.md', 'skill.md')),
    f AS (SELECT DISTINCT repo, {_DIR.format('path')} AS dir, split_part(path, '/', -1) AS name, sha256(split_part(path, '/', -1) || content) AS h FROM repo_files
    WHERE strlen(content) > 0 AND strlen(content) < {crawl.MAX_FILE_BYTES})
    SELECT repo, CASE WHEN dir = '' THEN '.' ELSE dir END AS skill_dir, sha256(unhex(string_agg(h, '' ORDER BY name, h))) AS folder_sha256 FROM p JOIN f USING (repo, dir) GROUP BY repo, dir"""
)
def folder_hash(spark, d):
    return crawl.folder_hash(table(spark, d, "repo_files"))


# ---------------------------------------------------------------- statistics

_STAT = "(SELECT DISTINCT id, dedup.duplicate_of AS duplicate_of, layer, license.class AS license_class, trust_tier, security.status = 'pass' AS strict FROM skills)"


def _stat_rows(spark, d):
    return table(spark, d, "skills").select(
        "id", F.col("dedup.duplicate_of").alias("duplicate_of"), "layer", F.col("license.class").alias("license_class"), "trust_tier",
        (F.col("security.status") == "pass").alias("strict"),
    ).distinct()


_OVERVIEW = f"""SELECT count(*) AS total_skills, count(*) FILTER (duplicate_of IS NULL) AS canonical_skills, count(*) FILTER (layer = 'curated') AS curated_skills,
    count(*) FILTER (license_class IN ('allow', 'conditional', 'deny')) AS license_resolved,
    CASE WHEN count(*) > 0 THEN round(count(*) FILTER (strict) * 100.0::DOUBLE / count(*), 2) ELSE 0.0 END AS strict_valid_pct FROM {_STAT}"""


@query(_OVERVIEW)
def stats_overview(spark, d):
    return stats.overview(_stat_rows(spark, d))


@query(f"SELECT coalesce(nullif(license_class, ''), 'unknown') AS license_class, count(*) AS n FROM {_STAT} GROUP BY 1")
def by_license_class(spark, d):
    return stats.count_by(_stat_rows(spark, d), "license_class", "unknown", "license_class")


@query(f"SELECT coalesce(nullif(trust_tier, ''), 'unreviewed') AS tier, count(*) AS n FROM {_STAT} GROUP BY 1")
def by_tier(spark, d):
    return stats.count_by(_stat_rows(spark, d), "trust_tier", "unreviewed", "tier")


@query(f"SELECT license_class, trust_tier, count(*) AS n, grouping(license_class, trust_tier) AS level FROM {_STAT} GROUP BY ROLLUP (license_class, trust_tier)")
def stats_rollup(spark, d):
    """An extension: both histograms and the total in one pass."""
    return _stat_rows(spark, d).rollup("license_class", "trust_tier").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


_BLOCK = f"""SELECT '- **Total skills indexed:** [' || format('{{:,}}', total_skills) || '](index/skills.jsonl)' || chr(10)
    || CASE WHEN total_skills <> canonical_skills THEN '- **Canonical skills:** [' || format('{{:,}}', canonical_skills) || '](index/skills.jsonl) (after deduplication)' || chr(10) ELSE '' END
    || '- **Source repositories:** [' || format('{{:,}}', (SELECT count(*) FROM sources)) || '](index/sources.json)' || chr(10) || '- **Curated skills:** [' || format('{{:,}}', curated_skills) || '](curated/)' || chr(10)
    || '- **License-resolved:** ' || format('{{:.1f}}', round(license_resolved / total_skills * 100, 1)) || '% (' || format('{{:,}}', license_resolved) || ' of ' || format('{{:,}}', total_skills) || ' skills)' || chr(10)
    || '- **Last updated:** 2026-01-01' AS block FROM ({_OVERVIEW})"""


@query(_BLOCK)
def stats_block(spark, d):
    repos = table(spark, d, "sources").select(F.count("*")).scalar()
    return stats.block(stats_overview(spark, d).withColumn("repositories", repos), "2026-01-01")


_README = "'# Title' || chr(10) || '<!-- stats:start -->' || chr(10) || {} || chr(10) || '<!-- stats:end -->' || chr(10) || 'End'"
_READMES = f"""(SELECT block, unnest(['same', 'stale', 'no start', 'no end', 'wrong order', 'empty']) AS name, unnest([{_README.format("block")}, {_README.format("'- **Total skills indexed:** old'")},
    'no markers', '<!-- stats:start --> only', '<!-- stats:end -->' || block || '<!-- stats:start -->', '<!-- stats:start --><!-- stats:end -->']) AS readme FROM ({_BLOCK}))"""


@query(
    rf"""WITH r AS (SELECT name, block, readme, trim(regexp_extract(readme, '(?s)<!-- stats:start -->\s*(.*?)\s*<!-- stats:end -->', 1), ' ') AS found FROM {_READMES})
    SELECT name, CASE WHEN NOT contains(readme, '<!-- stats:start -->') THEN 'README.md missing <!-- stats:start --> marker' WHEN NOT contains(readme, '<!-- stats:end -->') THEN 'README.md missing <!-- stats:end --> marker'
    WHEN NOT regexp_matches(readme, '(?s)<!-- stats:start -->.*<!-- stats:end -->') THEN 'Failed to extract stats block from README.md'
    WHEN found <> trim(block, ' ') THEN 'README stats block does not match stats.json; Expected:' || chr(10) || trim(block, ' ') || '; Found:' || chr(10) || found ELSE '' END AS errors FROM r"""
)
def readme_consistent(spark, d):
    """Whether README texts hold the statistics' block: the right one, a stale one, and broken markers."""
    block = stats_block(spark, d).select("block")
    marked = lambda c: F.concat(F.lit("# Title\n<!-- stats:start -->\n"), c, F.lit("\n<!-- stats:end -->\nEnd"))
    cases = {
        "same": marked(F.col("block")), "stale": marked(F.lit("- **Total skills indexed:** old")), "no start": F.lit("no markers"), "no end": F.lit("<!-- stats:start --> only"),
        "wrong order": F.concat(F.lit("<!-- stats:end -->"), "block", F.lit("<!-- stats:start -->")), "empty": F.lit("<!-- stats:start --><!-- stats:end -->"),
    }
    each = block.select("block", F.inline(F.array(*(F.struct(F.lit(n).alias("name"), c.alias("readme")) for n, c in cases.items()))))
    return each.select("name", F.array_join(stats.document_errors(F.col("readme"), F.col("block")), "; ").alias("errors"))


_LENGTHS = "(SELECT list_sort(list(n_chars)) AS l, count(n_chars) AS n FROM documents WHERE n_chars IS NOT NULL)"


@query(f'SELECT l[1] AS "min", l[n // 2 + 1] AS median, l[(n * 0.95::DOUBLE)::BIGINT - CASE WHEN (n * 0.95::DOUBLE)::BIGINT > n * 0.95::DOUBLE THEN 1 ELSE 0 END + 1] AS p95, '
       f'l[(n * 0.99::DOUBLE)::BIGINT - CASE WHEN (n * 0.99::DOUBLE)::BIGINT > n * 0.99::DOUBLE THEN 1 ELSE 0 END + 1] AS p99, l[n] AS "max" FROM {_LENGTHS}')  # fmt: skip
def length_percentiles(spark, d):
    """Lengths of documents at places of the sorted list, as latencies are reported."""
    return stats.sorted_index_percentiles(table(spark, d, "documents"), "n_chars")


_AGE = f"(SELECT {_MICROS} AS seen FROM (SELECT DISTINCT id, first_seen FROM skills))"
_AT = 1_800_000_000_000_000


@query(
    f"""SELECT round(quantile_cont(a, 0.25), 4) AS p25_hours, round(quantile_cont(a, 0.5), 4) AS p50_hours, round(quantile_cont(a, 0.75), 4) AS p75_hours FROM (SELECT ({_AT} - seen) / 3600e6 AS a FROM {_AGE} WHERE seen IS NOT NULL)"""
)
def freshness_percentiles(spark, d):
    seen = table(spark, d, "skills").select("id", "first_seen").distinct().select(T.iso_micros(F.col("first_seen")).alias("seen"))
    return stats.freshness(seen, "seen", _AT)


@query(
    """WITH p AS (SELECT m.skill_id, coalesce(m.license = s.license.spdx, false) AS actual, coalesce(m.security = s.security.status, false) AS predicted FROM (SELECT DISTINCT skill_id, license, security FROM skill_metadata) m
    JOIN (SELECT DISTINCT id, license, security FROM skills) s ON m.skill_id = s.id), c AS (SELECT count(*) FILTER (actual AND predicted) AS tp, count(*) FILTER (NOT actual AND predicted) AS fp,
    count(*) FILTER (actual AND NOT predicted) AS fn, count(*) FILTER (NOT actual AND NOT predicted) AS tn FROM p) SELECT tp, fp, fn, tn,
    CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) ELSE 0.0 END AS "precision", CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) ELSE 0.0 END AS recall,
    CASE WHEN 2 * tp + fp + fn > 0 THEN round(2 * tp / (2 * tp + fp + fn), 6) ELSE 0.0 END AS f1 FROM c"""
)
def label_confusion(spark, d):
    m = table(spark, d, "skill_metadata").select("skill_id", F.col("license").alias("l"), F.col("security").alias("x")).distinct()
    s = table(spark, d, "skills").select(F.col("id").alias("skill_id"), F.col("license.spdx").alias("sl"), F.col("security.status").alias("sx"), "license", "security").distinct()
    pairs = m.join(s, "skill_id").select(F.coalesce(F.col("l") == F.col("sl"), F.lit(False)).alias("actual"), F.coalesce(F.col("x") == F.col("sx"), F.lit(False)).alias("predicted"))
    return stats.confusion(pairs, "actual", "predicted")


# ---------------------------------------------------------------- keywords and shards

_TOKENS = (
    r"list_filter(list_transform(regexp_extract_all(regexp_replace(regexp_replace(lower({}), '[#*`_\[\]()]', ' ', 'g'), 'https?://[^\s\p{{Z}}]+', ' ', 'g'), "
    r"'[\p{{L}}\p{{N}}_]+(?:-[\p{{L}}\p{{N}}_]+)*'), lambda t: t), lambda t: regexp_full_match(t, '[a-z0-9]+(-[a-z0-9]+)*') AND length(t) BETWEEN 3 AND 30 AND NOT list_contains([" + _values(T.STOPWORDS) + "], t))"
)
_KW = "(SELECT DISTINCT skill_id AS id, name, description FROM skill_metadata)"


def _kw(spark, d):
    return table(spark, d, "skill_metadata").select(F.col("skill_id").alias("id"), "name", "description").distinct()


_IDF = f"""(SELECT term, count(*) AS df, ln((SELECT count(*) FROM {_KW}) / count(*)) AS idf FROM (SELECT id, name, description, unnest(list_distinct({_TOKENS.format("concat_ws(' ', name, description)")})) AS term FROM {_KW}) GROUP BY term)"""


@query(f"SELECT term, df, round(idf, 9) AS idf FROM {_IDF}")
def idf(spark, d):
    return keywords.idf(_kw(spark, d), "id", "name", "description").withColumn("idf", F.round("idf", 9))


@query(
    f"""WITH tf AS (SELECT id, term, sum(w) AS tf FROM (SELECT id, unnest({_TOKENS.format("coalesce(name, '')")}) AS term, 3 AS w FROM {_KW} UNION ALL SELECT id, unnest({_TOKENS.format("coalesce(description, '')")}), 2 FROM {_KW}) GROUP BY 1, 2),
    s AS (SELECT id, term, round(tf * coalesce(idf, ln(1000)), 9) AS score FROM tf LEFT JOIN {_IDF} USING (term)), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, term) AS rn FROM s)
    SELECT id, string_agg(term, ',' ORDER BY rn) AS keywords FROM r WHERE rn <= 12 GROUP BY id"""
)
def keywords_top12(spark, d):
    return keywords.top_keywords(_kw(spark, d), "id", "name", "description").select("id", F.array_join("keywords", ",").alias("keywords"))


_ELIGIBLE = "coalesce(dedup.canonical_id, '') IN ('', id) AND coalesce(status = 'active', false) AND coalesce(security.status, '') <> 'malicious'"
_COMPACT = f"""(SELECT DISTINCT id, coalesce(name, '') AS n, CASE WHEN length(description) > 200 THEN left(description, 197) || '...' ELSE coalesce(description, '') END AS d,
    coalesce(trust_tier, 'unreviewed') AS tier, coalesce(license.spdx, 'NOASSERTION') AS lic, coalesce(security.status, 'pending') AS sec, coalesce(source.url, '') AS url, coalesce(hashes.content_hash, '') AS h
    FROM skills WHERE {_ELIGIBLE})"""


def _top12_sql(base: str) -> str:
    idf_ = f"""(SELECT term, ln((SELECT count(*) FROM {base}) / count(*)) AS idf FROM (SELECT unnest(list_distinct({_TOKENS.format("concat_ws(' ', name, description)")})) AS term FROM {base}) GROUP BY term)"""
    return f"""(WITH tf AS (SELECT id, term, sum(w) AS tf FROM (SELECT id, unnest({_TOKENS.format("coalesce(name, '')")}) AS term, 3 AS w FROM {base} UNION ALL SELECT id, unnest({_TOKENS.format("coalesce(description, '')")}), 2 FROM {base}) GROUP BY 1, 2),
    s AS (SELECT id, term, round(tf * coalesce(idf, ln(1000)), 9) AS score FROM tf LEFT JOIN {idf_} USING (term)), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, term) AS rn FROM s)
    SELECT id, string_agg(term, ',' ORDER BY rn) AS kw FROM r WHERE rn <= 12 GROUP BY id)"""


_KW_BASE = f"(SELECT id, min(name) AS name, min(description) AS description FROM skills WHERE {_ELIGIBLE} GROUP BY id)"


@query(f"""SELECT c.*, coalesce(kw, '') AS kw, '{{"npx":null,"gh":null,"claude_plugin":null}}' AS install FROM {_COMPACT} c LEFT JOIN {_top12_sql(_KW_BASE)} USING (id)""")
def compact_record(spark, d):
    """The short record of search shards, with keywords over all eligible records and the (unknown) install commands."""
    s = table(spark, d, "skills")
    keep = keywords.eligible(F.col("id"), F.col("dedup.canonical_id"), F.col("status"), F.col("security.status"))
    named = s.where(keep).groupBy("id").agg(F.min("name").alias("name"), F.min("description").alias("description"))
    top = keywords.top_keywords(named, "id", "name", "description").select("id", F.array_join("keywords", ",").alias("kw"))
    install = F.to_json(catalog.no_install(), {"ignoreNullFields": "false"}).alias("install")
    return _compact(spark, d).join(top, "id", "left").select("*", install).na.fill("", ["kw"])


def _compact(spark, d):
    s = table(spark, d, "skills")
    keep = keywords.eligible(F.col("id"), F.col("dedup.canonical_id"), F.col("status"), F.col("security.status"))
    or_else = lambda c, x: F.coalesce(F.col(c), F.lit(x))
    return s.where(keep).select(
        "id", or_else("name", "").alias("n"), keywords.shortened(F.col("description")).alias("d"), or_else("trust_tier", "unreviewed").alias("tier"),
        or_else("license.spdx", "NOASSERTION").alias("lic"), or_else("security.status", "pending").alias("sec"), or_else("source.url", "").alias("url"),
        or_else("hashes.content_hash", "").alias("h"),
    ).distinct()


_SHARD = 64 << 10


@query(
    f"""WITH RECURSIVE r AS (SELECT id, max(tier) AS tier, max(strlen(d) + 1) AS bytes FROM {_COMPACT} GROUP BY id), o AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY id) AS k FROM r),
    f AS (SELECT tier, id, k, 0 AS shard, bytes AS load FROM o WHERE k = 1 UNION ALL SELECT o.tier, o.id, o.k, CASE WHEN f.load + o.bytes > {_SHARD} THEN f.shard + 1 ELSE f.shard END,
    CASE WHEN f.load + o.bytes > {_SHARD} THEN o.bytes ELSE f.load + o.bytes END FROM f JOIN o ON o.tier = f.tier AND o.k = f.k + 1)
    SELECT tier, id, shard::BIGINT AS shard FROM f"""
)
def shard_assignment(spark, d):
    """Shards of at most 64 KiB of descriptions per tier, filled in the order of ids."""
    sized = _compact(spark, d).groupBy("id").agg(F.max("tier").alias("tier"), F.max(F.octet_length("d") + 1).cast("long").alias("bytes"))
    return keywords.greedy_shards(sized, "tier", "id", "bytes", _SHARD)


@query(
    r"""SELECT doc_id, CASE WHEN array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda x: starts_with(x, '#')), lambda x: x), '') IS NULL THEN '' ELSE
    array_to_string(list_filter(list_transform(list_filter(string_split(text, chr(10)), lambda x: starts_with(x, '#')), lambda x: trim(regexp_replace(x, '^#+\s*', ''))), lambda x: x <> '')[1:20], chr(10)) END AS head
    FROM documents WHERE text IS NOT NULL"""
)
def body_titles(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", keywords.head_or_titles(F.col("text"), F.lit("deny")).alias("head"))


@query(
    rf"""SELECT doc_id, array_to_string((regexp_extract_all(regexp_replace(text, '{keywords.MARKED_OFF}', '', 'g'), '[^\s\p{{Z}}\x0b\x1c-\x1f\x{{85}}]+'))[1:400], ' ') AS head
    FROM documents WHERE text IS NOT NULL"""
)
def body_head(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", keywords.head_or_titles(F.col("text"), F.lit("allow")).alias("head"))


# ---------------------------------------------------------------- search

QUERY = "compare versions"
_META = "(SELECT skill_id AS id, min(name) AS name, min(description) AS description, min(trust_tier) AS trust_tier, min(license) AS license, min(security) AS security, min(canonical_id) AS canonical_id, min(layer) AS layer FROM skill_metadata GROUP BY skill_id)"


def _meta(spark, d):
    cols = ("name", "description", "trust_tier", "license", "security", "canonical_id", "layer")
    return table(spark, d, "skill_metadata").groupBy("skill_id").agg(*(F.min(c).alias(c) for c in cols))


def _bm25_sql(source: str, fields: dict[str, float], terms: list[str]) -> str:
    words = lambda c: rf"regexp_extract_all(lower(coalesce({c}, '')), '[\p{{L}}\p{{N}}_]+')"
    tokens = " UNION ALL ".join(f"SELECT id, unnest({words(c)}) AS term, {float(w)}::DOUBLE AS w FROM {source}" for c, w in fields.items())
    size = " + ".join(f"len({words(c)})" for c in fields)
    return f"""(WITH tf AS (SELECT id, term, sum(w) AS tf FROM ({tokens}) WHERE term IN ({_values(terms)}) GROUP BY 1, 2), l AS (SELECT id, {size} AS len FROM {source}), c AS (SELECT count(*) AS docs, avg(len) AS mean FROM l),
    n AS (SELECT term, count(*) AS n FROM tf GROUP BY 1) SELECT id, round(sum(greatest(ln((docs - n + 0.5::DOUBLE) / (n + 0.5::DOUBLE)), 1e-6::DOUBLE) * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / mean)))), 9) AS score
    FROM tf JOIN n USING (term) JOIN l USING (id), c GROUP BY id HAVING count(*) = {len(set(terms))})"""


def _index(spark, d, fields, stems=False):
    return search.build_index(_meta(spark, d), "skill_id", fields, stems)


_WORDS_OF = r"regexp_extract_all(lower(coalesce({}, '')), '[\p{{L}}\p{{N}}_]+')"


@query(
    f"""SELECT id, term, sum(w) AS tf FROM (SELECT id, unnest({_WORDS_OF.format('name')}) AS term, 3.0::DOUBLE AS w FROM {_META} UNION ALL SELECT id, unnest({_WORDS_OF.format('description')}), 2.0::DOUBLE FROM {_META}) GROUP BY 1, 2"""
)
def index_postings(spark, d):
    """The postings that the search index is written from."""
    return _index(spark, d, {"name": 3.0, "description": 2.0}).postings.select(F.col("doc").alias("id"), "term", "tf")


@query(f"SELECT id, round(score, 6) AS score FROM {_bm25_sql(_META, {'description': 1.0}, QUERY.split())}")
def bm25_unstemmed(spark, d):
    found = _index(spark, d, {"description": 1.0}).matches(search.query_terms(QUERY))
    return found.select(F.col("doc").alias("id"), F.round("score", 6).alias("score"))


_TWO = {"name": 3.0, "description": 2.0}


@query(f"SELECT id, round(score, 6) AS score FROM {_bm25_sql(_META, _TWO, QUERY.split())}")
def bm25_weighted_multifield(spark, d):
    found = _index(spark, d, _TWO).matches(search.query_terms(QUERY))
    return found.select(F.col("doc").alias("id"), F.round("score", 6).alias("score"))


@query()
def bm25_porter(spark, d):
    """Stemmed words; equal to an embedded full-text index with a Porter tokenizer (see the tests)."""
    found = _index(spark, d, _TWO, stems=True).matches(search.query_terms(QUERY, stems=True))
    return found.select(F.col("doc").alias("id"), F.round("score", 6).alias("score"))


_SEARCHABLE = "status = 'active' AND coalesce(security.status, '') <> 'malicious'"
_FOUR = f"(SELECT DISTINCT id, name, description, coalesce(array_to_string(tags[1:12], ' '), '') AS tags, left(description, 400) AS head FROM skills WHERE {_SEARCHABLE})"


@query(f"SELECT id, round(score, 6) AS score FROM {_bm25_sql(_FOUR, R.FIELD_WEIGHTS, ['rubric', 'quota'])}")
def bm25_catalog_fields(spark, d):
    """All four weighted fields of the catalog's records."""
    found = search.build_index(search.search_fields(table(spark, d, "skills")), "id", R.FIELD_WEIGHTS).matches(["rubric", "quota"])
    return found.select(F.col("doc").alias("id"), F.round("score", 6).alias("score"))


@query(
    f"""SELECT DISTINCT id AS skill_id, coalesce(name, '') AS name, coalesce(description, '') AS description, coalesce(source.url, '') AS url, coalesce(hashes.content_hash, '') AS content_hash,
    coalesce(trust_tier, 'unreviewed') AS trust_tier, coalesce(license.spdx, 'NOASSERTION') AS license, coalesce(security.status, 'pending') AS security, dedup.canonical_id AS canonical_id,
    coalesce(layer, 'source') AS layer FROM skills WHERE {_SEARCHABLE}"""
)
def flat_metadata(spark, d):
    return search.flat_metadata(table(spark, d, "skills"))


@query(f"SELECT id FROM {_META} WHERE layer = 'source' AND license IN ({_values(R.ALLOW)}) AND trust_tier IN ('official', 'community')")
def search_filters(spark, d):
    return _meta(spark, d).where(search.filters("source", True, "community")).select(F.col("skill_id").alias("id"))


_ADJUSTED = (
    f"round(score * CASE WHEN regexp_matches(lower(concat_ws(' ', description, name)), '{R.OVERLY_BROAD}') THEN 0.3::DOUBLE ELSE 1.0::DOUBLE END + {_case(R.TRUST_BONUS, 'trust_tier', '0.0')}::DOUBLE + {_case(R.SECURITY_BONUS, 'security', '0.0')}::DOUBLE, 6)"
)
_RANKED = f"""(WITH top AS (SELECT h.id, name, description, trust_tier, security, canonical_id, score FROM {_META} m JOIN {_bm25_sql(_META, _TWO, QUERY.split())} h ON m.id = h.id ORDER BY score DESC, h.id LIMIT 50),
    a AS (SELECT *, {_ADJUSTED} AS final, coalesce(nullif(canonical_id, ''), id) AS g FROM top), o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY id = g DESC, final DESC, id) AS r FROM a)
    SELECT row_number() OVER (ORDER BY final DESC, id) AS rank, id, name, trust_tier, security, round(final, 2) AS score, max(final) OVER () < 0.1 AS abstain FROM o WHERE r = 1)"""


@query(f"SELECT rank, id, name, trust_tier, security, score, abstain FROM {_RANKED} WHERE rank <= 5")
def search_ranked(spark, d):
    """The flagship: BM25 with field weights, adjusted, one result per canonical group, top 5, abstention flag."""
    found = search.search(_index(spark, d, _TWO), _meta(spark, d), QUERY)
    return found.drop("why_matched")


@query(
    f"""SELECT rank, id, CASE WHEN contains(lower(name), {_quote(QUERY)}) THEN 'name,desc' ELSE 'desc' END AS fields, {_quote(",".join(QUERY.split()[:5]))} AS terms, rank AS bm25_rank FROM {_RANKED} WHERE rank <= 5"""
)
def search_why(spark, d):
    """Why each of the ranked results matched."""
    found = search.search(_index(spark, d, _TWO), _meta(spark, d), QUERY)
    why = F.col("why_matched")
    return found.select("rank", "id", F.array_join(why.fields, ",").alias("fields"), F.array_join(why.terms, ",").alias("terms"), why.bm25_rank.alias("bm25_rank"))


@query("SELECT skill_id, name, license FROM (SELECT DISTINCT skill_id, name, license FROM skill_metadata) ORDER BY skill_id LIMIT 1")
def point_lookup(spark, d):
    """One record by its key, here the smallest."""
    meta = table(spark, d, "skill_metadata")
    key = meta.agg(F.min("skill_id")).first()[0]
    return search.lookup(meta.select("skill_id", "name", "license"), key or "")


@query(
    f"""SELECT id, name, trust_tier FROM (SELECT * FROM {_META} WHERE regexp_matches(concat_ws(' ', name, description), '(?i)rubric|quota') ORDER BY id LIMIT 40)
    ORDER BY {_case(R.TRUST, 'trust_tier', '0')} DESC, CASE security WHEN 'pass' THEN 3 WHEN 'review' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END DESC, license IN ({_values(R.ALLOW)}) DESC NULLS LAST, id LIMIT 3"""
)
def grep_search(spark, d):
    meta = _meta(spark, d).withColumnRenamed("skill_id", "id")
    return search.grep(meta, "(?i)rubric|quota").select("id", "name", "trust_tier")


# ---------------------------------------------------------------- near duplicates, frontmatter, streams


def _near_docs(spark, d):
    docs = table(spark, d, "documents").where("text is not null and text <> ''")
    texts = docs.select(F.col("doc_id").alias("doc"), T.body(F.col("text")).alias("text"), F.lit("unreviewed").alias("tier"), F.lit(None).cast("long").alias("seen"))
    return texts


@query()
def near_dup_labels(spark, d):
    """Near-duplicate groups of documents with all exact copies, mirrors told from edits."""
    return neardup.label_copies(_near_docs(spark, d)).withColumnRenamed("doc", "doc_id")


@query(
    r"""SELECT doc_id, CASE WHEN regexp_matches(text, '(?s)^---[ \t]*\n(?:(.*?)\n)?---[ \t]*(?:\n|$)') THEN regexp_extract(text, '(?s)^---[ \t]*\n(?:(.*?)\n)?---[ \t]*(?:\n|$)', 1) END AS head,
    CASE WHEN trim(string_split(text, chr(10))[1]) <> '---' THEN 'Frontmatter must start with ''---''' WHEN NOT regexp_matches(text, '(?s)^---[ \t]*\n(?:(.*?)\n)?---[ \t]*(?:\n|$)') THEN 'Frontmatter closing ''---'' not found' END AS error FROM documents WHERE text IS NOT NULL"""
)
def frontmatter_split(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    head, error = frontmatter.split(F.col("text"))
    return docs.select("doc_id", head.alias("head"), error.alias("error"))


@query()
def frontmatter_parse(spark, d):
    """Frontmatter of all package files, parsed leniently and checked strictly."""
    files = table(spark, d, "repo_files").where(crawl.is_package_file(F.col("path"))).select("repo", "path", "content").distinct()
    return frontmatter.parse(files.withColumn("dir", licenses.directory(F.col("path"))), "content", "dir").select("repo", "path", "fm.*")


@query()
def content_hashes(spark, d):
    files = table(spark, d, "repo_files").where(crawl.is_package_file(F.col("path"))).select("repo", "path", "content").distinct()
    return files.select("repo", "path", frontmatter.content_hash("content").alias("content_hash"))


@query(
    "SELECT repo, arg_min(content, CASE path WHEN 'README.md' THEN 1 WHEN 'readme.md' THEN 2 WHEN 'README' THEN 3 ELSE 4 END) AS content FROM repo_files "
    "WHERE path IN ('README.md', 'readme.md', 'README', 'README.rst') AND content IS NOT NULL GROUP BY repo"
)
def readme_pick(spark, d):
    return io.readme(table(spark, d, "repo_files"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_hours(spark, d):
    """An extension: hourly windows, the same expression for a stream with a watermark."""
    return event_windows(table(spark, d, "events"), "ts", "event_type")
