"""Record checks as arrays of reasons, and schema constraints as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import rules as R


def _reasons(*checks: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for c, m in checks)))


def _empty(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def source_reasons() -> Column:
    """Why a record fails the source checks."""
    return _reasons(
        (F.col("status") == "dangling", "Skill status is 'dangling' (owner or repo no longer exists)"),
        (F.col("security.status") == "malicious", "Security status is 'malicious'"),
        *((_empty(c), f"Missing required field: {c}") for c in ("id", "name", "description")),
        *((_empty(f"hashes.{c}"), f"Missing required hash: {c}") for c in ("skill_md_sha256", "content_hash", "folder_sha256")),
        (_empty("source.commit"), "Missing source commit SHA"),
    )


CURATED_FILES = ("LICENSE", "NOTICE", "ATTRIBUTION.md")


def with_curated_files(records: DataFrame, files: DataFrame) -> DataFrame:
    """``records`` with curated_files: which of CURATED_FILES lie in their curated_path, by a listing (path)."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    found = files.where(name.isin(*CURATED_FILES)).select(F.regexp_replace("path", "/?[^/]*$", "").alias("_dir"), name.alias("_name"))
    by_dir = found.groupBy("_dir").agg(F.collect_set("_name").alias("curated_files"))  # three names at most
    return records.join(by_dir, records["curated_path"] == by_dir["_dir"], "left").drop("_dir")


def curated_reasons() -> Column:
    """Why a record fails the curated checks.

    Reads conformance (strict, errors), license.class, curated_path and
    curated_files, trust_tier, security (status, scans, external_refs), status,
    quality.smells and layer.  What is missing counts as not shown: not strict,
    no file, no scanner; lists that are null are empty.
    """
    none = F.array().cast("array<string>")
    errors, smells = F.coalesce("conformance.errors", none), F.coalesce("quality.smells", none)
    files, kind = F.coalesce("curated_files", none), F.coalesce(F.col("license.class"), F.lit("None"))
    mirrored = F.coalesce(F.col("curated_path"), F.lit("")) != ""
    has = lambda *names: F.arrays_overlap(files, F.array(*map(F.lit, names)))
    broken = F.transform(F.filter(errors, lambda e: e != "filename-lowercase"), lambda e: F.concat(F.lit("Conformance error: "), e))
    not_strict = F.concat(F.array(F.lit("Frontmatter does not pass strict conformance")), broken)
    scans = F.coalesce("security.scans", F.array())
    grave = F.transform(
        F.filter(F.flatten(F.transform(scans, lambda x: F.coalesce(x.ioc_patterns, F.slice(x.ioc_patterns, 1, 0)))), lambda i: F.lower(i.severity).isin("high", "critical")),
        lambda i: F.concat(F.lit("Unresolved "), F.upper(i.severity), F.lit(" security finding: "), F.coalesce(i["name"], F.lit("unknown"))),
    )
    dangling = F.transform(
        F.filter(F.coalesce("security.external_refs", F.array()), lambda r: ~F.coalesce(r.exists, F.lit(False)) & F.coalesce(r.critical, F.lit(False))),
        lambda r: F.concat(F.lit("Critical external reference is dangling: "), F.coalesce(r.reference, F.lit("unknown"))),
    )
    blocking = F.transform(F.filter(smells, lambda x: x.isin(*R.BLOCKING_SMELLS)), lambda x: F.concat(F.lit("Blocking quality smell: "), x))
    return F.concat(
        _reasons((F.array_contains(errors, "filename-lowercase"), "SKILL.md filename must be exact case (not skill.md)")),
        F.when(F.coalesce("conformance.strict", F.lit(False)), none).otherwise(not_strict),
        F.when(kind.isin("allow", "conditional"), none).otherwise(F.array(F.concat(F.lit("License class must be 'allow' or 'conditional', got '"), kind, F.lit("'")))),
        _reasons(
            ((kind == "conditional") & mirrored & ~has("NOTICE", "ATTRIBUTION.md"), "Conditional license requires NOTICE or ATTRIBUTION file"),
            (mirrored & ~has("LICENSE"), "Missing LICENSE file in curated directory"),
            (~mirrored, "Missing curated_path (skill not mirrored to curated/)"),
            (F.col("trust_tier") == "aggregator-copy", "Aggregator copies cannot be curated (must be from canonical source)"),
            (F.col("security.status") == "malicious", "Security status is 'malicious'"),
            (F.col("security.status") == "error", "Security scan failed with errors"),
        ),
        F.coalesce(grave, none),
        _reasons(
            (~F.coalesce(F.exists(scans, lambda x: x.engine == "ioc_scanner"), F.lit(False)), "Missing IOC scanner (required)"),
            (F.col("status") == "dangling", "Skill status is 'dangling' (owner or source no longer exists)"),
        ),
        F.coalesce(dangling, none), blocking,
        _reasons((F.coalesce(F.col("layer"), F.lit("")) != "curated", "Skill layer is not 'curated' (no human approval)")),
    )


def regressions(records: DataFrame) -> DataFrame:
    """The curated records, neither removed nor quarantined, that would no longer pass: (skill_id, gate, passes, reasons)."""
    kept = records.where((F.col("layer") == "curated") & ~F.coalesce("status", F.lit("")).isin("removed", "quarantined"))
    return gate(kept, curated_reasons(), "curated").where("not passes")


def marked_for_review(records: DataFrame) -> DataFrame:
    """``records`` with the status review where a curated record would no longer pass."""
    watched = (F.col("layer") == "curated") & ~F.coalesce("status", F.lit("")).isin("removed", "quarantined")
    return records.withColumn("status", F.when(F.coalesce(watched, F.lit(False)) & (F.size(curated_reasons()) > 0), "review").otherwise(F.col("status")))


def security_reasons(status: str = "status", critical: str = "critical", high: str = "high") -> Column:
    """Why a scanned record (status and counts by severity) fails the security checks; a bad status alone says it all."""
    bad = F.col(status).isin("malicious", "error")
    counts = _reasons((F.col(critical) > 0, "Unresolved CRITICAL findings"), (F.col(high) > 0, "Unresolved HIGH findings"))
    return F.when(bad, F.array(F.concat(F.lit("Security status is "), F.col(status)))).otherwise(counts)


def gate(records: DataFrame, reasons: Column, name: str) -> DataFrame:
    """(skill_id, gate, passes, reasons)."""
    judged = records.select(F.col("id").alias("skill_id"), F.lit(name).alias("gate"), reasons.alias("reasons"))
    return judged.select("skill_id", "gate", (F.size("reasons") == 0).alias("passes"), "reasons")


@dataclass(frozen=True)
class Rule:
    """A constraint of a field: required, one of values, a pattern, a length or a range."""

    path: str
    required: bool = False
    values: tuple[str, ...] = ()
    pattern: str = ""
    least: int | None = None
    most: int | None = None


# Constraints of catalog records and sources.
RECORD_RULES = (
    Rule("id", required=True, pattern=r"^[a-z0-9.-]+/[^/]+/[^/]+/.+$"),
    Rule("name", required=True, least=1, most=64),
    Rule("description", required=True, least=1, most=1024),
    Rule("layer", required=True, values=("source", "curated")),
    Rule("source.commit", required=True, pattern=r"^[0-9a-f]{40}$"),
    Rule("hashes.skill_md_sha256", required=True, pattern=r"^[0-9a-f]{64}$"),
    Rule("hashes.content_hash", required=True, pattern=r"^sha256:[0-9a-f]{64}$"),
    Rule("license.class", required=True, values=("allow", "conditional", "deny", "unknown")),
    Rule("trust_tier", required=True, values=("official", "community", "unreviewed", "aggregator-copy")),
    Rule("security.status", values=("pass", "warn", "review", "malicious", "error", "pending")),
    Rule("security.risk_level", values=("low", "medium", "high")),
    Rule("status", required=True, values=("active", "dangling", "disabled", "quarantined", "removed")),
)
SOURCE_RULES = (
    Rule("id", required=True, pattern=r"^[a-z0-9-]+$"),
    Rule("url", required=True, pattern=r"^https://"),
    Rule("owner_type", required=True, values=("vendor", "community", "aggregator")),
    Rule("tier", required=True, least=1, most=3),
    Rule("status", required=True, values=("active", "missing", "disabled")),
)


def violations(records: DataFrame, record: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(record, path, problem) of each constraint that a row breaks."""
    kinds = dict(_leaf_types(records))
    checks = []  # of each constraint, a struct where it is broken
    for r in rules:
        c, text = F.col(r.path), kinds.get(r.path) == "string"
        broken = [(c.isNull(), "required")] if r.required else []
        if r.values:
            broken.append((c.isNotNull() & ~c.isin(*r.values), "enum"))
        if r.pattern:
            broken.append((c.isNotNull() & ~c.rlike(r.pattern), "pattern"))
        size = F.length(c) if text else c
        if r.least is not None:
            broken.append((size < r.least, "minimum"))
        if r.most is not None:
            broken.append((size > r.most, "maximum"))
        checks += [F.when(F.coalesce(b, F.lit(False)), F.struct(F.lit(r.path).alias("path"), F.lit(p).alias("problem"))) for b, p in broken]
    return records.select(F.col(record).alias("record"), F.inline(F.array_compact(F.array(*checks))))


def _leaf_types(df: DataFrame):
    def walk(schema, prefix):
        for f in schema.fields:
            if hasattr(f.dataType, "fields"):
                yield from walk(f.dataType, f"{prefix}{f.name}.")
            else:
                yield f"{prefix}{f.name}", f.dataType.simpleString()

    return walk(df.schema, "")
