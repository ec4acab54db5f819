"""Catalog statistics and their Markdown block."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.storage import materialize


def overview(records: DataFrame) -> DataFrame:
    """One row from (duplicate_of, layer, license_class, strict): totals, license-resolved, strict share in percent."""
    resolved = F.count_if(F.col("license_class").isin("allow", "conditional", "deny"))
    strict = F.count_if(F.coalesce("strict", F.lit(False)))
    return records.agg(
        F.count("*").alias("total_skills"),
        F.count_if(F.col("duplicate_of").isNull()).alias("canonical_skills"),
        F.count_if(F.col("layer") == "curated").alias("curated_skills"),
        resolved.alias("license_resolved"),
        F.when(F.count("*") > 0, F.round(strict * 100.0 / F.count("*"), 2)).otherwise(0.0).alias("strict_valid_pct"),
    )


def count_by(records: DataFrame, column: str, missing: str, name: str) -> DataFrame:
    """(name, n): rows by a column, null and empty under ``missing``."""
    value = F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(missing))
    return records.groupBy(value.alias(name)).agg(F.count("*").alias("n"))


def nth(df: DataFrame, column: str, positions: list[int]) -> dict[int, object]:
    """The values at zero-based positions of the sorted, non-null values; positions outside have none.

    Equal values are counted before they are sorted by range, and the driver
    gets one row a range; only the ranges that hold a position are looked at.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    ranged = materialize(counted.repartitionByRange("v").withColumn("_part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("_part").agg(F.sum("n").alias("n")).orderBy("_part").collect()
    out, start = {}, 0
    for part in sums:
        inside = [p for p in positions if start <= p < start + part["n"]]
        if inside:
            until = F.lit(start) + F.sum("n").over(Window.orderBy("v"))  # one range
            rows = ranged.where(F.col("_part") == part["_part"]).withColumn("until", until)
            for p in inside:
                out[p] = rows.where(F.col("until") > p).agg(F.min("v")).first()[0]
        start += part["n"]
    return out


def freshness(records: DataFrame, seen: str, now: int) -> DataFrame:
    """One row: quartiles of the age in hours (``seen``, ``now`` in microseconds), between the two nearest values; nulls without any."""
    spark, n = records.sparkSession, records.where(F.col(seen).isNotNull()).count()
    shares = {"p25_hours": 0.75, "p50_hours": 0.5, "p75_hours": 0.25}  # the older, the smaller the time
    at = {name: (n - 1) * q for name, q in shares.items()}
    found = nth(records, seen, sorted({p for x in at.values() for p in (math.floor(x), math.ceil(x))})) if n else {}
    between = lambda x: found[math.floor(x)] + (found[math.ceil(x)] - found[math.floor(x)]) * (x - math.floor(x))
    values = [round((now - between(x)) / 3600e6, 4) if n else None for x in at.values()]
    return spark.createDataFrame([values], ", ".join(f"{name} double" for name in shares))


def sorted_index_percentiles(df: DataFrame, column: str) -> DataFrame:
    """One row (min, median, p95, p99, max): of n sorted values those at 0, n/2, n*0.95, n*0.99 (rounded down) and n-1."""
    n = df.where(F.col(column).isNotNull()).count()
    at = {"min": 0, "median": n // 2, "p95": int(n * 0.95), "p99": int(n * 0.99), "max": n - 1}
    found = nth(df, column, sorted(set(at.values()))) if n else {}
    kind = df.schema[column].dataType.simpleString()
    return df.sparkSession.createDataFrame([[found.get(p) for p in at.values()]], ", ".join(f"{name} {kind}" for name in at))


def _thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def block(row: DataFrame, updated: str) -> DataFrame:
    """(block): the Markdown lines of a row (total_skills, canonical_skills, repositories, curated_skills, license_resolved)."""
    total, canonical = F.col("total_skills"), F.col("canonical_skills")
    lines = F.array_compact(
        F.array(
            F.when(total == 0, F.lit("*Early preview: the index is being seeded.*\n")),
            F.concat(F.lit("- **Total skills indexed:** ["), _thousands(total), F.lit("](index/skills.jsonl)")),
            F.when(total != canonical, F.concat(F.lit("- **Canonical skills:** ["), _thousands(canonical), F.lit("](index/skills.jsonl) (after deduplication)"))),
            F.concat(F.lit("- **Source repositories:** ["), _thousands(F.col("repositories")), F.lit("](index/sources.json)")),
            F.concat(F.lit("- **Curated skills:** ["), _thousands(F.col("curated_skills")), F.lit("](curated/)")),
            F.when(total > 0, F.concat(
                F.lit("- **License-resolved:** "), F.format_string("%.1f", F.round(F.col("license_resolved") / total * 100, 1)), F.lit("% ("),
                _thousands(F.col("license_resolved")), F.lit(" of "), _thousands(total), F.lit(" skills)"))),
            F.concat(F.lit("- **Last updated:** "), F.lit(updated)),
        )
    )
    return row.select(F.array_join(lines, "\n").alias("block"))


def replace_block(document: str, block_text: str, start: str = "<!-- stats:start -->", end: str = "<!-- stats:end -->") -> str:
    """A document with the text between two markers replaced; as it is if a marker is missing."""
    head, found, rest = document.partition(start)
    _, closed, tail = rest.partition(end)
    return f"{head}{start}\n{block_text}\n{end}{tail}" if found and closed else document


def document_errors(document: Column, block_text: Column, start: str = "<!-- stats:start -->", end: str = "<!-- stats:end -->") -> Column:
    """Why a document's statistics block isn't the expected one; empty if it is."""
    found = F.trim(F.regexp_extract(document, rf"(?s){start}\s*(.*?)\s*{end}", 1))
    expected = F.trim(block_text)
    none = F.array().cast("array<string>")
    differs = F.array(
        F.lit("README stats block does not match stats.json"), F.concat(F.lit("Expected:\n"), expected), F.concat(F.lit("Found:\n"), found)
    )
    return (
        F.when(F.coalesce(~F.contains(document, F.lit(start)), F.lit(True)), F.array(F.lit(f"README.md missing {start} marker")))
        .when(~F.contains(document, F.lit(end)), F.array(F.lit(f"README.md missing {end} marker")))
        .when(~document.rlike(rf"(?s){start}.*{end}"), F.array(F.lit("Failed to extract stats block from README.md")))
        .when(found != expected, differs)
        .otherwise(none)
    )


def confusion(pairs: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: tp, fp, fn, tn, precision, recall, f1 (0 where undefined)."""
    a, p = F.col(actual), F.col(predicted)
    c = pairs.agg(F.count_if(a & p).alias("tp"), F.count_if(~a & p).alias("fp"), F.count_if(a & ~p).alias("fn"), F.count_if(~a & ~p).alias("tn"))
    ratio = lambda x, y: F.when(y > 0, F.round(x / y, 6)).otherwise(0.0)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select("*", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))
