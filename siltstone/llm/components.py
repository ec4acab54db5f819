"""Connected groups of pairwise matches by hash-to-min.

Each vertex holds a cluster, at first its neighbours and itself.  In a round a
vertex sends its cluster to the smallest member and that smallest member to all
the others; what a vertex receives is its next cluster.  At the end the smallest
vertex of a component holds all of it and every other vertex holds just the
smallest.  The rounds grow with the logarithm of the longest chain.

A cluster is a set of rows (vertex, member), never one array, so a vertex with
a third of all rows is spread over tasks: its minimum is aggregated before the
shuffle and written, so that the join that sends it out has two plain sides and
adaptive execution can split the hot vertex's rows over tasks.  Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.storage import materialize

MAX_ROUNDS = 60  # chains of 2**60 links


def _state(clusters: DataFrame) -> tuple[int, int, int]:
    row = clusters.agg(
        F.count("*"),
        F.sum(F.xxhash64("v", "u").bitwiseAND(0x7FFFFFFF)),
        F.sum(F.shiftrightunsigned(F.xxhash64("u", "v"), 33)),
    ).first()
    return tuple(x or 0 for x in row)


def hash_to_min(edges: DataFrame) -> DataFrame:
    """(vertex, root) of each vertex of ``edges`` (x, y: long); root is the smallest of the component.

    Self-links make a vertex known and link nothing; a null end is no link.
    Repeated links count once.  No links give an empty result.
    """
    e = edges.select("x", "y").where("x is not null and y is not null")
    start = e.select(F.inline(F.array(*(F.struct(F.col(a).alias("v"), F.col(b).alias("u")) for a in "xy" for b in "xy"))))
    clusters = materialize(start.distinct(), "clusters")
    state = _state(clusters)
    for _ in range(MAX_ROUNDS):
        least = materialize(clusters.groupBy("v").agg(F.min("u").alias("m")), "least")
        sent = clusters.join(least, "v").select(
            F.inline(F.array(F.struct(F.col("m").alias("v"), F.col("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u"))))
        )
        clusters = materialize(sent.distinct(), "clusters")
        before, state = state, _state(clusters)
        if state == before:
            break
    else:
        raise RuntimeError("hash-to-min did not settle")
    return materialize(clusters.groupBy(F.col("v").alias("vertex")).agg(F.min("u").alias("root")), "roots")


def _seed_without_collisions(names: DataFrame) -> int:
    """A seed under which all vertex names have different 64-bit hashes."""
    for seed in range(8):
        hashed = names.select(F.xxhash64("name", F.lit(seed)).alias("h"), "name").distinct()
        row = hashed.groupBy("h").agg(F.count("*").alias("n")).agg(F.max("n")).first()
        if (row[0] or 0) <= 1:
            return seed
    raise RuntimeError("no seed without collisions")


def group_records(records: DataFrame, record_col: str, key: Column, links: DataFrame) -> DataFrame:
    """(group_id, record) of each record in a group of two or more records.

    ``links`` (x, y: string) name vertices; ``key`` is the vertex of a record.
    A vertex need not be a record (an id in no table, a cluster label).
    group_id is the smallest record of the group.  Records that no link touches
    are in no group, nor are records with a null key.  Repeated records count
    once.  Other columns are never read, so their names can't clash.
    """
    links = materialize(links.where("x is not null and y is not null and x <> y").distinct(), "links")
    seed = _seed_without_collisions(links.select(F.explode(F.array("x", "y")).alias("name")))
    vertex = lambda c: F.xxhash64(c, F.lit(seed))
    roots = hash_to_min(links.select(vertex(F.col("x")).alias("x"), vertex(F.col("y")).alias("y")))
    keyed = records.select(F.col(record_col).cast("string").alias("record"), key.alias("k")).where("k is not null and record is not null")
    known = keyed.select("record", vertex(F.col("k")).alias("vertex")).distinct().join(roots, "vertex").select("record", "root")
    known = materialize(known, "known")
    # an id in several spellings is one vertex and may be several records
    groups = known.groupBy("root").agg(F.min("record").alias("group_id"), F.max("record").alias("last"))
    groups = materialize(groups.where("group_id <> last").select("root", "group_id"), "groups")
    return known.join(groups, "root").select("group_id", "record").distinct()
