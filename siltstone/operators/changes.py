"""What changed between two snapshots of a catalog, in one full outer join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changes(prev: DataFrame, new: DataFrame) -> DataFrame:
    """(id, type, old_hash, new_hash) from snapshots (id, content_hash, license, security[, status]).

    added, removed, and for a changed hash: security-changed before
    license-changed before updated.  A record that was already removed isn't
    removed again.
    """
    p = prev.select("id", *(F.col(c).alias(f"p_{c}") for c in prev.columns if c != "id"), F.lit(True).alias("_p"))
    n = new.select("id", *(F.col(c).alias(f"n_{c}") for c in new.columns if c != "id"), F.lit(True).alias("_n"))
    both = p.join(n, "id", "full_outer")
    gone = F.col("_n").isNull() & ((F.coalesce("p_status", F.lit("")) != "removed") if "status" in prev.columns else F.lit(True))
    differs = lambda c: ~F.col(f"p_{c}").eqNullSafe(F.col(f"n_{c}"))
    kind = (
        F.when(F.col("_p").isNull(), "added")
        .when(gone, "removed")
        .when(F.col("_n").isNull() | ~differs("content_hash"), None)
        .when(differs("security"), "security-changed")
        .when(differs("license"), "license-changed")
        .otherwise("updated")
    )
    changed = F.col("type").isin("updated", "license-changed", "security-changed")
    return both.select("id", kind.alias("type"), "p_content_hash", "n_content_hash").where("type is not null").select(
        "id", "type", F.when(changed, F.col("p_content_hash")).alias("old_hash"), F.when(changed, F.col("n_content_hash")).alias("new_hash")
    )


def carry_forward(prev: DataFrame, new: DataFrame, now: str) -> DataFrame:
    """(id, first_seen, last_seen, last_changed): first_seen is kept, last_changed too while the hash stays."""
    p = prev.select("id", F.col("first_seen").alias("_first"), F.col("last_changed").alias("_changed"), F.col("content_hash").alias("_hash"), F.lit(True).alias("_known"))
    same = F.col("_known") & F.col("_hash").eqNullSafe(F.col("content_hash"))
    return new.join(p, "id", "left").select(
        "id",
        F.coalesce("_first", F.lit(now)).alias("first_seen"),
        F.lit(now).alias("last_seen"),
        F.when(same, F.coalesce("_changed", F.lit(now))).otherwise(F.lit(now)).alias("last_changed"),
    )


def with_removed(prev: DataFrame, new: DataFrame, now: str) -> DataFrame:
    """The new snapshot and the records only the previous one has, with status removed."""
    gone = prev.join(new.select("id").distinct(), "id", "left_anti")
    again = F.col("status") == "removed"
    marked = gone.withColumn("last_seen", F.when(again, F.col("last_seen")).otherwise(F.lit(now))).withColumn("status", F.lit("removed"))
    return new.unionByName(marked, allowMissingColumns=True)


def not_yet_crawled(heads: DataFrame, state: DataFrame) -> DataFrame:
    """The (source_id, head_sha) that no successful crawl has seen."""
    return heads.join(state.where("head_sha is not null").select("source_id", "head_sha").distinct(), ["source_id", "head_sha"], "left_anti")
