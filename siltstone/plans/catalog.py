"""The whole catalog build; what costs Python or many patterns is computed once and kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.operators import dedup, frontmatter, licenses, quality, security
from siltstone.storage import materialize


def record_id(host: str, url, skill_dir):
    """host/owner/repo/skill_dir; owner and repository in lower case."""
    repo = F.lower(F.regexp_replace(F.regexp_replace(url, rf"^https?://{host}/", ""), r"(\.git)?/*$", ""))
    return F.concat(F.lit(f"{host}/"), repo, F.lit("/"), skill_dir)


def trust_tier(owner_type, tier, sources_with_hash):
    """official for vendors, community for tier 2; a tier 3 copy of another source's content is an aggregator's."""
    return (
        F.when(owner_type == "vendor", "official")
        .when(tier == 2, "community")
        .when((F.coalesce(tier, F.lit(3)) == 3) & (sources_with_hash > 1), "aggregator-copy")
        .otherwise("unreviewed")
    )


def no_install() -> Column:
    """The install commands of a record: none is known to be right, so all are null."""
    return F.struct(*(F.lit(None).cast("string").alias(c) for c in ("npx", "gh", "claude_plugin")))


def mark_dangling(records: DataFrame, gone: DataFrame) -> DataFrame:
    """``records`` with status and status_reason; those of the sources in ``gone`` (source_id) are dangling, their owner deleted."""
    lost = gone.select(F.col("source_id").alias("_gone")).distinct()
    flagged = records.join(lost, records["source_id"] == lost["_gone"], "left")
    is_gone = F.col("_gone").isNotNull()
    return flagged.withColumns({
        "status": F.when(is_gone, "dangling").otherwise(F.col("status")), "status_reason": F.when(is_gone, "source_owner_deleted"),
    }).drop("_gone")


def build(raw: DataFrame, sources: DataFrame, previous: DataFrame, host: str, now: str, gone: DataFrame | None = None, verdicts: DataFrame | None = None) -> DataFrame:
    """Catalog records from crawl rows (source_id, skill_dir, path, content, commit_sha, has_scripts).

    Rows of unknown sources and those without a description are left out.
    ``previous`` (id, content_hash, first_seen, last_changed) is carried forward;
    ``now`` is a parameter, so a build can be repeated.  Records of sources in
    ``gone`` (source_id) are dangling; ``verdicts`` (id, verdict) are those of an
    upstream registry, one a record.
    """
    joined = raw.join(sources.select(F.col("id").alias("source_id"), "url", "owner_type", "tier"), "source_id")
    hashed = frontmatter.parse(joined, "content", "skill_dir").withColumn("content_hash", frontmatter.content_hash("content"))
    hashed = materialize(hashed.where(F.trim(F.coalesce("fm.description", F.lit(""))) != ""), "parsed")  # each file is parsed once
    copies = hashed.groupBy("content_hash").agg(F.count_distinct("source_id").alias("_sources"))
    last = F.element_at(F.split("skill_dir", "/"), -1)
    name = F.coalesce(F.nullif(F.trim("fm.name"), F.lit("")), F.when(F.col("skill_dir") == ".", "root").otherwise(last))
    spdx = licenses.normalize(F.col("fm.license"))
    spdx = F.when(F.col("fm.license").startswith("Proprietary"), "LicenseRef-Proprietary").when(spdx.isNull(), "NOASSERTION").when(
        licenses.is_spdx(spdx), spdx).otherwise("LicenseRef-Unrecognized")
    base = hashed.join(copies, "content_hash").select(
        record_id(host, F.col("url"), F.col("skill_dir")).alias("id"), name.alias("name"), F.left("fm.description", F.lit(1024)).alias("description"),
        F.lit("source").alias("layer"), "source_id", "commit_sha", "content_hash", F.sha2("content", 256).alias("skill_md_sha256"), "fm",
        F.struct(F.coalesce("fm.license", F.lit("")).alias("declared"), spdx.alias("spdx"), licenses.classify(spdx).alias("class")).alias("license"),
        trust_tier(F.col("owner_type"), F.col("tier"), F.col("_sources")).alias("trust_tier"),
        quality.smells(F.col("content"), F.col("fm.name"), F.col("fm.description")).alias("smells"),
        "content", F.coalesce("has_scripts", F.lit(False)).alias("has_scripts"),
    )
    base = base.withColumn("scan_description", F.col("fm.description"))  # uncut, as read
    if verdicts is not None:
        base = base.join(verdicts.select("id", F.col("verdict").alias("_verdict")).dropDuplicates(["id"]), "id", "left")
    else:
        base = base.withColumn("_verdict", F.lit(None).cast("string"))
    base = materialize(base, "records")
    scanned = security.scan(base.withColumn("_key", F.struct("id", "commit_sha")), "_key", "content", "scan_description", "has_scripts", "layer", "_verdict").select(
        "_key.id", security.security_field(now, F.col("_key.commit_sha")).alias("security")
    )
    p = previous.select("id", F.col("content_hash").alias("_hash"), F.col("first_seen").alias("_first"), F.col("last_changed").alias("_changed"))
    kept = base.drop("content", "scan_description", "_verdict").join(scanned, "id", "left").join(p, "id", "left")
    same = F.col("_hash").eqNullSafe(F.col("content_hash"))
    timed = kept.withColumns({
        "first_seen": F.coalesce("_first", F.lit(now)), "last_seen": F.lit(now),
        "last_changed": F.when(same, F.coalesce("_changed", F.lit(now))).otherwise(F.lit(now)), "status": F.lit("active"), "install": no_install(),
        "conformance": F.struct(F.col("fm.strict").alias("strict"), F.col("fm.errors").alias("errors")), "quality": F.struct(F.col("smells").alias("smells")),
    }).drop("_hash", "_first", "_changed").withColumn("_seen", T.iso_micros(F.col("first_seen")))
    labelled = dedup.label_duplicates(timed, "id", "content_hash", "trust_tier", "_seen").drop("_seen")
    return mark_dangling(labelled, gone) if gone is not None else labelled.withColumn("status_reason", F.lit(None).cast("string"))
