"""Ranked search: postings, weighted BM25, filters, canonical grouping."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siltstone.functions import rules as R
from siltstone.functions import text as T
from siltstone.functions.porter import stem

K1, B = 1.2, 0.75


@F.pandas_udf(StringType())
def stemmed(terms: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in terms:
        yield s.map(stem, na_action="ignore")


@dataclass
class Index:
    """postings (doc, term, tf) with tf weighted by field; lengths (doc, len) over all fields."""

    postings: DataFrame
    lengths: DataFrame

    def matches(self, terms: list[str]) -> DataFrame:
        """(doc, score) of the documents that have all terms, by BM25.

        The idf of a term found in over half of the documents is floored, as is
        usual.  Only the query's postings are read and shuffled; the corpus
        sizes are scalars.
        """
        wanted = sorted(set(terms))
        if not wanted:
            return self.postings.select("doc", F.lit(0.0).alias("score")).where("false")
        hits = self.postings.where(F.col("term").isin(*wanted))
        docs, mean = self.lengths.select(F.count("*")).scalar(), self.lengths.select(F.avg("len")).scalar()
        n = hits.groupBy("term").agg(F.count("*").alias("n"))  # at most as many rows as query terms
        scored = hits.join(F.broadcast(n), "term").join(self.lengths, "doc")
        rarity = F.greatest(F.log((docs - F.col("n") + 0.5) / (F.col("n") + 0.5)), F.lit(1e-6))
        weight = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / mean))
        found = scored.groupBy("doc").agg(F.sum(rarity * weight).alias("score"), F.count("*").alias("_terms"))
        return found.where(F.col("_terms") == len(wanted)).select("doc", F.round("score", 9).alias("score"))


def search_fields(records: DataFrame) -> DataFrame:
    """Searchable rows of catalog records with the fields of R.FIELD_WEIGHTS.

    Active and not malicious; up to twelve tags in one field; the head is the
    beginning of the description, which so counts twice.
    """
    kept = records.where((F.col("status") == "active") & (F.coalesce("security.status", F.lit("")) != "malicious"))
    tags = F.array_join(F.slice(F.coalesce("tags", F.array().cast("array<string>")), 1, 12), " ")
    return kept.select("id", "name", "description", tags.alias("tags"), F.left("description", F.lit(400)).alias("head")).distinct()


def flat_metadata(records: DataFrame) -> DataFrame:
    """One flat row per searchable record, defaults for what is missing."""
    kept = records.where((F.col("status") == "active") & (F.coalesce("security.status", F.lit("")) != "malicious"))
    or_else = lambda c, x: F.coalesce(F.col(c), F.lit(x))
    return kept.select(
        F.col("id").alias("skill_id"), or_else("name", "").alias("name"), or_else("description", "").alias("description"), or_else("source.url", "").alias("url"),
        or_else("hashes.content_hash", "").alias("content_hash"), or_else("trust_tier", "unreviewed").alias("trust_tier"),
        or_else("license.spdx", "NOASSERTION").alias("license"), or_else("security.status", "pending").alias("security"),
        F.col("dedup.canonical_id").alias("canonical_id"), or_else("layer", "source").alias("layer"),
    ).distinct()


def build_index(docs: DataFrame, record: str, fields: dict[str, float], stems: bool = False) -> Index:
    """The index of text columns with their weights.

    Stems are made once per distinct word, not once per occurrence.
    """
    every = F.flatten(F.array(*(T.weighted(T.words(F.coalesce(F.col(c), F.lit(""))), float(w)) for c, w in fields.items())))
    tokens = docs.select(F.col(record).alias("doc"), F.inline(every))
    counted = tokens.groupBy("doc", "term").agg(F.sum("w").alias("tf"), F.count("*").alias("_n"))
    if stems:
        vocabulary = counted.select("term").distinct().withColumn("stem", stemmed("term"))
        counted = counted.join(vocabulary, "term").groupBy("doc", F.col("stem").alias("term")).agg(F.sum("tf").alias("tf"), F.sum("_n").alias("_n"))
    size = sum((F.size(T.words(F.coalesce(F.col(c), F.lit("")))) for c in fields), F.lit(0))
    return Index(counted.select("doc", "term", "tf"), docs.select(F.col(record).alias("doc"), size.alias("len")))


def query_terms(query: str, stems: bool = False) -> list[str]:
    """The words of a query; all of them must occur."""
    import regex

    found = [w for w in regex.findall(r"[\p{L}\p{N}_]+", query.lower())]
    return [stem(w) for w in found] if stems else found


def overly_broad(name: Column, description: Column) -> Column:
    return F.lower(F.concat_ws(" ", description, name)).rlike(R.OVERLY_BROAD)


def filters(layer: str | None = None, permissive: bool = False, min_trust: str | None = None) -> Column:
    """Predicate on (layer, license, trust_tier); pushed down to the scan."""
    keep = F.lit(True)
    if layer:
        keep = keep & (F.col("layer") == layer)
    if permissive:
        keep = keep & F.col("license").isin(*R.ALLOW)
    if min_trust:
        least = R.TRUST.get(min_trust, 1)
        keep = keep & F.col("trust_tier").isin(*(t for t, r in R.TRUST.items() if r >= least))
    return keep


def adjusted(score: Column, name: Column, description: Column, tier: Column, security: Column) -> Column:
    """Overly broad records rank lower; trust and security add or take a little."""
    bonus = lambda table, c: F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in table.items() for x in p)), c), F.lit(0.0))
    return score * F.when(overly_broad(name, description), R.BROAD_FACTOR).otherwise(1.0) + bonus(R.TRUST_BONUS, tier) + bonus(R.SECURITY_BONUS, security)


def rank(hits: DataFrame, k: int = 5) -> DataFrame:
    """The k best groups of hits (id, name, description, trust_tier, security, canonical_id, score).

    The 50 best hits are adjusted; of each canonical group the canonical record
    stays, else the best; ties fall to the smaller id.  ``abstain`` is true on all
    rows when even the best is below the threshold.
    """
    top = hits.orderBy(F.desc("score"), "id").limit(R.CANDIDATES)
    final = F.round(adjusted(F.col("score"), F.col("name"), F.col("description"), F.col("trust_tier"), F.col("security")), 6)
    top = top.withColumn("final", final).withColumn("_group", F.coalesce(F.nullif(F.col("canonical_id"), F.lit("")), "id"))
    in_group = Window.partitionBy("_group").orderBy((F.col("id") == F.col("_group")).desc(), F.desc("final"), "id")
    one = top.withColumn("_in", F.row_number().over(in_group)).where("_in = 1")
    over = Window.orderBy(F.desc("final"), "id")  # at most 50 rows
    ranked = one.withColumn("rank", F.row_number().over(over)).withColumn("abstain", F.max("final").over(Window.partitionBy()) < R.ABSTAIN_BELOW)
    return ranked.where(F.col("rank") <= k).select("rank", "id", "name", "trust_tier", "security", F.round("final", 2).alias("score"), "abstain")


def search(
    index: Index, meta: DataFrame, query: str, k: int = 5, stems: bool = False,
    layer: str | None = None, permissive: bool = False, min_trust: str | None = None,
) -> DataFrame:
    """Ranked results of a query over records meta (skill_id, name, ...), with why they matched."""
    found = index.matches(query_terms(query, stems)).withColumnRenamed("doc", "id")
    kept = meta.where(filters(layer, permissive, min_trust)).withColumnRenamed("skill_id", "id")
    hits = kept.join(found, "id").select("id", "name", "description", "trust_tier", "security", "canonical_id", "score")
    fields = F.when(F.lower("name").contains(query.lower()), F.array(F.lit("name"), F.lit("desc"))).otherwise(F.array(F.lit("desc")))
    why = F.struct(fields.alias("fields"), F.array(*map(F.lit, query.split()[:5])).cast("array<string>").alias("terms"), F.col("rank").alias("bm25_rank"))
    return rank(hits, k).withColumn("why_matched", why)


def grep(records: DataFrame, pattern: str, k: int = 3, first: int = 40) -> DataFrame:
    """Of the first records by id that match a pattern, the k most trusted, then safest, then freest."""
    top = records.where(F.concat_ws(" ", "name", "description").rlike(pattern)).orderBy("id").limit(first)
    trust = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in R.TRUST.items() for x in p)), F.col("trust_tier")), F.lit(0))
    safe = F.coalesce(F.array_position(F.array(*map(F.lit, ("warn", "review", "pass"))), F.col("security")), F.lit(0))
    return top.orderBy(trust.desc(), safe.desc(), F.col("license").isin(*R.ALLOW).desc_nulls_last(), "id").limit(k)


def lookup(meta: DataFrame, skill_id: str) -> DataFrame:
    return meta.where(F.col("skill_id") == skill_id).limit(1)
