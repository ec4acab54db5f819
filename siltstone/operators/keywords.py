"""TF-IDF keywords, compact records and size-bounded shards."""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import rules as R
from siltstone.functions import text as T
from siltstone.storage import materialize

UNSEEN = math.log(1000)


def idf(records: DataFrame, record: str, name: str, description: str) -> DataFrame:
    """(term, df, idf): ln(records / df) over names and descriptions, all records counted."""
    tokens = F.array_distinct(T.keyword_tokens(F.concat_ws(" ", name, description)))
    df = records.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    total = records.select(F.count("*")).scalar()
    return df.select("term", "df", F.log(total / F.col("df")).alias("idf"))


def top_keywords(
    records: DataFrame, record: str, name: str, description: str, extra: str | None = None, most: int = T.KEYWORDS
) -> DataFrame:
    """(record, keywords): the terms with the highest tf * idf, ties by term.

    The name weighs three times, the description twice, further text once.
    Terms of no name or description count as rare as one in a thousand.
    """
    parts = [(F.coalesce(F.col(name), F.lit("")), 3), (F.coalesce(F.col(description), F.lit("")), 2)]
    if extra:
        parts.append((F.coalesce(F.col(extra), F.lit("")), 1))
    weighted = F.flatten(F.array(*(T.weighted(T.keyword_tokens(c), w) for c, w in parts)))
    tf = records.select(record, F.inline(weighted)).groupBy(record, "term").agg(F.sum("w").alias("tf"))
    scored = tf.join(idf(records, record, name, description), "term", "left").withColumn(
        "score", F.round(F.col("tf") * F.coalesce("idf", F.lit(UNSEEN)), 9)
    )
    best = Window.partitionBy(record).orderBy(F.desc("score"), "term")
    top = scored.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= most)
    ordered = F.array_sort(F.collect_list(F.struct("_rank", "term")))  # at most ``most`` a record
    return top.groupBy(record).agg(F.transform(ordered, lambda x: x.term).alias("keywords"))


def shortened(description: Column) -> Column:
    return F.when(F.length(description) > 200, F.concat(F.left(description, F.lit(197)), F.lit("..."))).otherwise(F.coalesce(description, F.lit("")))


def eligible(record: Column, canonical: Column, status: Column, security: Column) -> Column:
    """Canonical, active and not malicious."""
    own = canonical.isNull() | (canonical == "") | (canonical == record)
    return own & F.coalesce(status == "active", F.lit(False)) & (F.coalesce(security, F.lit("")) != "malicious")


_BLANK = r"[ \t\r\f\x0b\x1c-\x1f\x{85}\p{Z}]*"
MARKED_OFF = rf"(?ms)^{_BLANK}---{_BLANK}$(?:.*?^{_BLANK}---{_BLANK}$|.*)"  # from a line of three dashes to the next, or to the end


def head_or_titles(content: Column, license_class: Column) -> Column:
    """The first 400 words of the body if the license allows it, else up to 20 heading titles, joined by lines."""
    body = F.regexp_replace(content, f"(?d){MARKED_OFF}", "")
    w = F.regexp_extract_all(body, F.lit(r"([^\s\p{Z}\x1c-\x1f\x{85}]+)"), F.lit(1))
    titles = F.filter(F.transform(F.filter(F.split(content, "\n"), lambda x: x.startswith("#")), lambda x: F.trim(F.regexp_replace(x, r"^#+\s*", ""))), lambda x: x != "")
    return F.when(license_class.isin("allow", "conditional"), F.array_join(F.slice(w, 1, 400), " ")).otherwise(F.array_join(F.slice(titles, 1, 20), "\n"))


def _next_starts(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums before each record and after all, start of the next shard for a shard that starts at each record)."""
    before = np.concatenate([[0], np.cumsum(sizes)])
    return before, np.maximum(np.searchsorted(before, before[:-1] + capacity, side="right") - 1, np.arange(len(sizes)) + 1)


def greedy_shards(records: DataFrame, group: str, order: str, size: str, capacity: int = R.SHARD_BYTES, run: int = 256) -> DataFrame:
    """``records`` (group, order, size) with the number of their shard: in order, a shard is full when the next record would exceed it.

    The fold depends on all before it, yet is made in parallel, on the sizes
    alone.  Records are cut into runs of many shards by a distributed running
    sum.  What a run does depends only on the load that is open where it begins,
    and that only on where its first own shard begins: of each of these places
    (the records of one capacity) a task finds the load left open at the run's
    end and the number of shards.  The driver chains these through the runs, one
    row a run, and each run is then numbered from its true beginning.
    """
    # a distributed running sum: ranges of the order, their sums, then sums inside each
    sliced = records.select(group, order, size).repartitionByRange(F.col(group), F.col(order)).withColumn("_slice", F.spark_partition_id())
    sliced = materialize(sliced, "slices")
    sums = sliced.groupBy(group, "_slice").agg(F.sum(size).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    placed = sliced.join(before.select(group, "_slice", "_before"), [group, "_slice"])
    part = Window.partitionBy(group, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_until", F.col("_before") + F.coalesce(F.sum(size).over(part), F.lit(0)))
    runs = materialize(placed.select(group, order, size, F.floor(F.col("_until") / (capacity * run)).alias("_run")), "runs")
    kinds = {f.name: f.dataType.simpleString() for f in runs.schema}

    def outcomes(pdf: pd.DataFrame) -> pd.DataFrame:
        sums, following = _next_starts(pdf.sort_values(order)[size].to_numpy(), capacity)
        n = len(following)
        load, used = np.empty(n, dtype=np.int64), np.ones(n, dtype=np.int64)
        for i in range(n - 1, -1, -1):
            j = following[i]
            if j < n:
                load[i], used[i] = load[j], used[j] + 1
            else:
                load[i] = sums[n] - sums[i]
        most = min(int(np.searchsorted(sums, capacity, side="right")), n)
        return pd.DataFrame({group: pdf[group].iloc[:1], "_run": pdf["_run"].iloc[:1], "sums": [sums[: most + 1].tolist()], "total": [int(sums[n])], "load": [load[:most].tolist()], "used": [used[:most].tolist()]})

    seen = runs.groupBy(group, "_run").applyInPandas(outcomes, f"`{group}` {kinds[group]}, _run long, sums array<long>, total long, load array<long>, used array<long>")
    entries: list[tuple] = []
    at = (None, 0, -1)  # group, open load, number of the open shard
    for r in seen.orderBy(group, "_run").toLocalIterator():
        if not entries or r[group] != at[0]:
            at = (r[group], 0, -1)
        _, load, number = at
        entries.append((r[group], r["_run"], load, number))
        first = 0 if number < 0 else bisect_right(r["sums"], capacity - load) - 1
        first = max(first, 0)
        at = (r[group], load + r["total"], number) if first >= len(r["load"]) else (r[group], r["load"][first], number + r["used"][first])
    begin = records.sparkSession.createDataFrame(entries, f"`{group}` {kinds[group]}, _run long, _load long, _number long")

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, ignore_index=True)
        sums, following = _next_starts(pdf[size].to_numpy(), capacity)
        load, at = int(pdf["_load"].iloc[0]), int(pdf["_number"].iloc[0])
        i = 0 if at < 0 else max(int(np.searchsorted(sums, capacity - load, side="right")) - 1, 0)
        shard = np.full(len(pdf), at, dtype=np.int64)
        while i < len(pdf):
            at += 1
            shard[i : following[i]] = at
            i = following[i]
        return pd.DataFrame({group: pdf[group], order: pdf[order], "shard": shard})

    same = [runs[group].eqNullSafe(begin[group]), runs["_run"] == begin["_run"]]
    started = runs.join(begin, same).select(runs[group], runs[order], runs[size], runs["_run"], "_load", "_number")
    return started.groupBy(group, "_run").applyInPandas(number, f"`{group}` {kinds[group]}, `{order}` {kinds[order]}, shard long")


def shard_names(records: DataFrame, capacity: int = R.SHARD_BYTES) -> DataFrame:
    """(id, shard): curated and official records whole in one shard each, the others in community-00 and so on, by id.

    ``records``: (id, layer, tier, bytes).
    """
    curated = F.coalesce(F.col("layer") == "curated", F.lit(False))
    placed = records.select("id", "bytes", F.when(curated, "curated").when(F.col("tier") == "official", "official").otherwise("community").alias("part"))
    whole = placed.where("part <> 'community'").select("id", F.col("part").alias("shard"))
    split = greedy_shards(placed.where("part = 'community'"), "part", "id", "bytes", capacity)
    return whole.unionByName(split.select("id", F.format_string("community-%02d", "shard").alias("shard")))
