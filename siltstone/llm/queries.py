"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import catalog as C
from siltstone.llm.components import group_records
from siltstone.llm.history import check_in_batches
from siltstone.llm.lexicon import encode
from siltstone.llm.licenses import file_licenses
from siltstone.llm.nearpairs import near_duplicate_pairs
from siltstone.llm.packing import compare, pack, sized
from siltstone.llm.splitting import split
from siltstone.llm.sql import SQL
from siltstone.llm.survivors import Field, survivors
from siltstone.storage import spread


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spread(df) if table in ("documents", "repo_files") else df


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of skills linked by near_duplicate_of, canonical_id or cluster."""
    skills, meta = _read(spark, sf_dir, "skills"), _read(spark, sf_dir, "skill_metadata")
    own = C.skill_key(F.col("id"))
    ids, labels = (
        skills.select(own.alias("x"), y.alias("y"))
        for y in (
            F.concat(F.lit("id "), C.skill_key(F.col("dedup.near_duplicate_of"))),
            F.concat(F.lit("label "), C.cluster_key(F.col("dedup.cluster"))),
        )
    )
    canonical = meta.select(
        C.skill_key(F.col("skill_id")).alias("x"), F.concat(F.lit("id "), C.skill_key(F.col("canonical_id"))).alias("y")
    )
    links = ids.unionByName(labels).unionByName(canonical).select(F.concat(F.lit("id "), "x").alias("x"), "y")
    return group_records(skills, "id", F.concat(F.lit("id "), own), links).withColumnRenamed("record", "skill_id")


def _p2_records(spark: SparkSession, sf_dir: str, seen: DataFrame) -> DataFrame:
    meta = _read(spark, sf_dir, "skill_metadata").select(
        "skill_id", "canonical_id", "trust_tier", "description", "license", "security", "install_npx"
    )
    return meta.where("canonical_id is not null").join(seen, "skill_id", "left")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving value of each field of the skills under one canonical_id."""
    seen = (
        _read(spark, sf_dir, "skills")
        .select(F.col("id").alias("skill_id"), C.moment(F.col("first_seen")).alias("at"))
        .groupBy("skill_id")
        .agg(F.max("at").alias("at"))
    )
    found = survivors(
        _p2_records(spark, sf_dir, seen),
        C.skill_key(F.col("canonical_id")),
        F.col("skill_id"),
        C.tier_rank(F.col("trust_tier")),
        F.col("at"),
        [
            Field("description", C.NO_DESCRIPTION, drop_cut_beginnings=True),
            Field("license", C.NO_LICENSE),
            Field("security", C.NO_SCAN),
            Field("install_npx", C.STAND_INS),
        ],
    )
    return found.select(F.col("group_id").alias("canonical_id"), "field_name", F.col("record").alias("skill_id"))


def p2_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors of license and security by last change alone, all tiers alike; half of the skills tell no last change."""
    changed = _read(spark, sf_dir, "skills").select(F.col("id").alias("skill_id"), C.moment(F.col("last_changed")).alias("at"))
    seen = changed.groupBy("skill_id").agg(F.max("at").alias("at"))
    found = survivors(
        _p2_records(spark, sf_dir, seen), C.skill_key(F.col("canonical_id")), F.col("skill_id"), F.lit(0), F.col("at"),
        [Field("license", C.NO_LICENSE), Field("security", C.NO_SCAN)],
    )
    return found.withColumnsRenamed({"group_id": "canonical_id", "record": "skill_id"})


def _crawls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _read(spark, sf_dir, "crawl_state")
        .where("head_sha is not null and crawled_at is not null")
        .groupBy(F.lower("head_sha").alias("sha"))
        .agg(F.min(F.unix_micros("crawled_at")).alias("crawled"))
    )


def _p3_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    skills = _read(spark, sf_dir, "skills").select(
        F.col("id").alias("item"), F.lower("source.commit").alias("sha"), C.moment(F.col("first_seen")).alias("seen")
    )
    arrivals = skills.join(_crawls(spark, sf_dir), "sha", "left").groupBy("item").agg(F.min(F.coalesce("crawled", "seen")).alias("at"))
    meta = _read(spark, sf_dir, "skill_metadata").select(
        F.col("skill_id").alias("item"), C.digest_key(F.col("content_hash")).alias("digest"), F.col("description").alias("text")
    )
    return check_in_batches(spark, meta.join(arrivals, "item"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills that repeat the content or the description of a skill of an earlier batch."""
    checked = _p3_checked(spark, sf_dir).where("copied or covered or near")
    return checked.select(F.col("item").alias("skill_id")).distinct()


def p3_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked skills by the route that decided first: digest, shared paragraphs, band keys, or none."""
    route = F.when(F.col("copied"), "1 digest").when(F.col("covered"), "2 paragraphs").when(F.col("near"), "3 band keys").otherwise("none")
    return _p3_checked(spark, sf_dir).groupBy(route.alias("route")).agg(F.count("*").alias("n"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of skills with nearly the same description."""
    pairs = near_duplicate_pairs(_read(spark, sf_dir, "skill_metadata"), "skill_id", "description")
    return pairs.withColumnsRenamed({"item_1": "skill_id_1", "item_2": "skill_id_2"})


def p5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license of each file and repository, with evidence, class and verdict."""
    return file_licenses(_read(spark, sf_dir, "repo_files"), _read(spark, sf_dir, "license_texts"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license and verdict of each file and repository."""
    return p5_licenses(spark, sf_dir).select("repo", "path", "spdx", "verdict")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return encode(_read(spark, sf_dir, "documents"), "doc_id", "text")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in a container of 4096 tokens."""
    packed = pack(sized(_read(spark, sf_dir, "documents"), "doc_id", "text"), 4096)
    return packed.withColumnsRenamed({"bin": "container_id", "item": "doc_id", "size": "n_tokens", "load": "container_tokens"})


def p7_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of 1024 tokens for documents of 200 to 1024, without the short ones that fill any gap: best fit alone, and evolved."""
    return compare(sized(_read(spark, sf_dir, "documents"), "doc_id", "text").where("size >= 200"), 1024)


def p8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of more than 1024 tokens in pieces that share up to 128 tokens."""
    return split(_read(spark, sf_dir, "documents"), "doc_id", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
