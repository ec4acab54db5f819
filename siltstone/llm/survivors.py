"""One surviving value per field of each duplicate group.

A field's survivor is taken from a record that really has a value, preferring
trust, then recency.  Where the time is missing, currency is *inferred*: the
values that timestamped records of all groups show one after the other give a
precedence between values (a before b where more groups went from a to b than
from b to a).  Restricted to the values that the untimed records of one group
offer, it is that group's partial order, and its topologically latest value is
taken: one that no other value of the group comes after (in a cycle the one
that fewest come after), of several the one that comes after the most others.
A record with a time always goes before one without, at equal trust.  Ties fall
to the smallest record id.

Size.  Every value takes part, free texts too, by a 64-bit hash of the value
without case and outer blanks; precedences are a distributed table, learned
only if some group is left open by trust and time.  A group's pairs of values
are never made: its values are looked up in the precedence table.  Groups are
never collected or sorted in one task: survivors are minima of structs,
aggregated before the shuffle, and values in order of time are sorted by range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.catalog import trimmed
from siltstone.storage import materialize

CUT = r"[\s\p{Z}]*(?:(?:\[|\(|<)(?:\.{2,}|…|truncated|cut|cut off|snip|more)(?:\]|\)|>)|\.|…)[\s\p{Z}]*$"


@dataclass(frozen=True)
class Field:
    """A field to survive: its column, and what stands for no value."""

    name: str
    stand_ins: tuple[str, ...]
    drop_cut_beginnings: bool = False


def usable(c: Column, stand_ins: tuple[str, ...]) -> Column:
    """Not null, not blank, with a letter or digit, and no stand-in (brackets and closing dots aside)."""
    plain = F.lower(F.regexp_replace(trimmed(c), r"[\s\p{Z}]+", " "))
    bare = F.regexp_replace(plain, r"^[(\[<]+|[)\]>.…]+$", "")
    return F.coalesce(plain.rlike(r"[\p{L}\p{N}]") & ~plain.isin(*stand_ins) & ~bare.isin(*stand_ins), F.lit(False))


def without_cut_marks(c: Column) -> Column:
    """Blanks run together; closing dots and marks of cutting gone."""
    plain = F.regexp_replace(trimmed(c), r"[\s\p{Z}]+", " ")
    return F.regexp_replace(plain, rf"(?:{CUT[:-1]})+$", "")


def with_next(df: DataFrame, order: list[str], carried: list[str]) -> DataFrame:
    """``df`` with ``next``: the struct of ``carried`` of the row that follows in the order of all rows, null after the last.

    Rows are sorted by range, so no key's rows need fit one task; where a range
    ends, the next one's first row follows.
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ordered")
    firsts = ranged.groupBy("_part").agg(F.min_by(F.struct(*carried), F.struct(*order)).alias("_first"))
    after = firsts.select("_part", F.lead("_first").over(Window.orderBy("_part")).alias("_after"))  # one row a range
    inside = F.lead(F.struct(*carried)).over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_inside", inside).join(after, "_part").withColumn("next", F.coalesce("_inside", "_after")).drop("_part", "_inside", "_after")


def cut_beginnings(texts: DataFrame) -> DataFrame:
    """The distinct (g, t) of ``texts`` (g, t) that begin a longer t of the same g.

    Sorted, a text is directly followed by one that it begins, if there is any.
    """
    distinct = texts.select("g", "t").where("g is not null and t <> ''").distinct()
    return with_next(distinct, ["g", "t"], ["g", "t"]).where((F.col("next.g") == F.col("g")) & F.col("next.t").startswith(F.col("t"))).select("g", "t")


def precedences(values: DataFrame) -> DataFrame:
    """(field, earlier, later) from ``values`` (g, field, value, at): more groups went from earlier to later than back.

    In each group a value counts at its last time; values of one time are in no order.
    """
    last = values.where("at is not null").groupBy("g", "field", "value").agg(F.max("at").alias("at"))
    columns = ["g", "field", "at", "value"]
    steps = with_next(last, columns, columns)
    steps = steps.where((F.col("next.g") == F.col("g")) & (F.col("next.field") == F.col("field")) & (F.col("next.at") > F.col("at")))
    low, high = F.least("value", "next.value"), F.greatest("value", "next.value")
    net = steps.groupBy("field", low.alias("low"), high.alias("high")).agg(F.sum(F.when(F.col("value") < F.col("next.value"), 1).otherwise(-1)).alias("net"))
    return net.where("net <> 0").select(
        "field", F.when(F.col("net") > 0, F.col("low")).otherwise(F.col("high")).alias("earlier"), F.when(F.col("net") > 0, F.col("high")).otherwise(F.col("low")).alias("later")
    )


def currency(offered: DataFrame, precedence: DataFrame) -> DataFrame:
    """(g, field, value, after, before): how many of the group's values come after each and before it.

    ``offered``: the distinct (g, field, value) of untimed records between which trust leaves the choice.
    """
    known = offered.select("field", "value").distinct()
    order = (
        precedence.join(known.withColumnRenamed("value", "earlier"), ["field", "earlier"], "left_semi")
        .join(known.withColumnRenamed("value", "later"), ["field", "later"], "left_semi")
    )
    from_ = offered.withColumnRenamed("value", "earlier").join(order, ["field", "earlier"])
    edges = from_.join(offered.withColumnRenamed("value", "later"), ["g", "field", "later"], "left_semi")
    ends = edges.select("g", "field", F.inline(F.array(
        F.struct(F.col("earlier").alias("value"), F.lit(1).alias("after"), F.lit(0).alias("before")),
        F.struct(F.col("later").alias("value"), F.lit(0).alias("after"), F.lit(1).alias("before")),
    )))
    return ends.groupBy("g", "field", "value").agg(F.sum("after").alias("after"), F.sum("before").alias("before"))


def survivors(df: DataFrame, group: Column, record: Column, rank: Column, at: Column, fields: list[Field]) -> DataFrame:
    """(group_id, field_name, record, inferred) of the surviving value of each field.

    A group is two or more different records with the same non-null ``group``.
    ``rank``: 0 is the most trusted; ``at``: microseconds or null.  A field
    without a usable value in the group has no row.  ``inferred`` says whether
    learned currency chose between values.  Repeated rows count once; an empty
    table gives an empty result.  Columns not named are never read.
    """
    base = df.select(group.alias("g"), record.alias("id"), rank.alias("rank"), at.alias("at"), *(F.col(f.name).cast("string").alias(f"v_{f.name}") for f in fields))
    base = base.where("g is not null and id is not null")
    several = materialize(base.groupBy("g").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("g"), "groups")
    base = base.join(several, "g", "left_semi")
    for f in fields:
        base = base.withColumn(f"v_{f.name}", F.when(usable(F.col(f"v_{f.name}"), f.stand_ins), F.col(f"v_{f.name}")))
    base = materialize(base, "members")
    for f in fields:
        if f.drop_cut_beginnings:
            stripped = without_cut_marks(F.col(f"v_{f.name}"))
            cut = cut_beginnings(base.select("g", stripped.alias("t"))).withColumn("cut", F.lit(True))
            base = base.withColumn("t", stripped).join(cut, ["g", "t"], "left")
            base = base.withColumn(f"v_{f.name}", F.when(F.col("cut").isNull(), F.col(f"v_{f.name}"))).drop("t", "cut")

    value = lambda f: F.when(F.col(f"v_{f.name}").isNotNull(), F.xxhash64(F.lower(trimmed(F.col(f"v_{f.name}")))))
    each = F.array(*(F.struct(F.lit(f.name).alias("field"), value(f).alias("value")) for f in fields))
    rows = materialize(base.select("g", "id", "rank", "at", F.inline(each)).where("value is not null"), "values")

    late = -F.coalesce("at", F.lit(-(2**62)).cast("long"))
    best = rows.groupBy("g", "field").agg(F.min(F.struct("rank", late.alias("late"))).alias("best"))
    untimed = best.where(F.col("best.late") == 2**62).select("g", "field", F.col("best.rank").alias("rank"))
    offered = rows.where("at is null").join(untimed, ["g", "field", "rank"]).select("g", "field", "value").distinct()
    open_ = offered.groupBy("g", "field").agg(F.count("*").alias("n")).where("n > 1").select("g", "field")
    offered = materialize(offered.join(open_, ["g", "field"], "left_semi"), "offered")
    if offered.limit(1).count():
        levels = materialize(currency(offered, precedences(rows)), "levels")
        rows = rows.join(levels.withColumn("inferred", F.lit(True)), ["g", "field", "value"], "left")
    else:
        rows = rows.withColumns({"after": F.lit(0), "before": F.lit(0), "inferred": F.lit(False)})
    shown = lambda c: F.when(F.col("at").isNull(), F.coalesce(c, F.lit(0))).otherwise(0)
    chosen = rows.groupBy("g", "field").agg(
        F.min(F.struct("rank", late.alias("late"), shown("after").alias("after"), (-shown("before")).alias("fewer"), "id")).alias("b"),
        F.bool_or(F.coalesce("inferred", F.lit(False))).alias("inferred"),
    )
    inferred = F.col("inferred") & (F.col("b.late") == 2**62) & ((F.col("b.fewer") < 0) | (F.col("b.after") > 0))
    return chosen.select(F.col("g").alias("group_id"), F.col("field").alias("field_name"), F.col("b.id").alias("record"), inferred.alias("inferred"))
