"""Items of varying length into containers of fixed capacity, by a grouping genetic algorithm.

An individual is a whole packing; its genes are bins, not items (Falkenauer,
1996).  Crossover injects well-filled bins of one parent into the other,
removes the bins that hold duplicates of what came in, and puts the displaced
items back by best fit.  Better is fewer bins, then fuller full bins.

Distribution.  Items are spread over islands of a few thousand by a hash; an
island is one task's worth and never more, whatever the table's size.  In an
island several demes evolve apart and pass their elite on in a ring.  Between
epochs elite bins (filled to ``SETTLED``) are settled; the items of the other
bins migrate to new, far fewer islands, so what an island leaves over is packed
with what others leave over.  Every island evolves for one migration of elites
at least, best-fit decreasing being one of its first individuals; after that it
stops as soon as it has as few bins as its items' sum allows, since none can do
with fewer.  Epochs end when one island is left, or when an epoch settles less
than half of what it was given.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import tokens as T
from siltstone.storage import materialize

ISLAND = 4000
SETTLED = 0.998
DEMES, DEME_SIZE, GENERATIONS, MIGRATE_EVERY = 3, 4, 24, 6


class Packing:
    """Bins of item numbers with their loads."""

    __slots__ = ("bins", "loads")

    def __init__(self, bins: list[list[int]], loads: list[int]):
        self.bins, self.loads = bins, loads

    def worth(self, capacity: int) -> tuple[int, float]:
        """Larger is better: fewer bins, then unevenly filled ones."""
        fill = np.array(self.loads) / capacity
        return -len(self.bins), float((fill * fill).sum())


def best_fit(packing: Packing, items: list[int], sizes: list[int], capacity: int) -> Packing:
    """Add the items, in the order given, each to the fullest bin that has room."""
    room = sorted((capacity - load, b) for b, load in enumerate(packing.loads))
    for item in items:
        at = bisect_left(room, (sizes[item], -1))
        if at == len(room):
            b = len(packing.bins)
            packing.bins.append([])
            packing.loads.append(0)
        else:
            b = room.pop(at)[1]
        packing.bins[b].append(item)
        packing.loads[b] += sizes[item]
        insort(room, (capacity - packing.loads[b], b))
    return packing


def _falling(items: list[int], sizes: list[int]) -> list[int]:
    return sorted(items, key=lambda i: -sizes[i])


def crossover(a: Packing, b: Packing, sizes: list[int], capacity: int, rng: np.random.Generator) -> Packing:
    """a with a share of b's best-filled bins injected."""
    by_load = sorted(range(len(b.bins)), key=lambda i: -b.loads[i])
    good = by_load[: max(1, len(by_load) // 2)]
    taken = [i for i, keep in zip(good, rng.random(len(good)) < rng.uniform(0.2, 0.8)) if keep] or good[:1]
    injected = {item for i in taken for item in b.bins[i]}
    child = Packing([list(b.bins[i]) for i in taken], [b.loads[i] for i in taken])
    displaced: list[int] = []
    for items, load in zip(a.bins, a.loads):
        left = [i for i in items if i not in injected]
        if len(left) == len(items):
            child.bins.append(list(items))
            child.loads.append(load)
        else:
            displaced += left
    return best_fit(child, _falling(displaced, sizes), sizes, capacity)


def mutate(p: Packing, sizes: list[int], capacity: int, rng: np.random.Generator) -> Packing:
    """Dissolve the least filled bin and a few others."""
    gone = {int(np.argmin(p.loads)), *rng.integers(0, len(p.bins), size=max(1, len(p.bins) // 50)).tolist()}
    loose = [i for b in gone for i in p.bins[b]]
    rng.shuffle(loose)
    kept = [b for b in range(len(p.bins)) if b not in gone]
    return best_fit(Packing([list(p.bins[b]) for b in kept], [p.loads[b] for b in kept]), _falling(loose, sizes), sizes, capacity)


def evolve(sizes: list[int], capacity: int, seed: int = 0, generations: int = GENERATIONS) -> Packing:
    """Pack items of 0 <= size <= capacity."""
    items = list(range(len(sizes)))
    least = -(-sum(sizes) // capacity)
    first = best_fit(Packing([], []), _falling(items, sizes), sizes, capacity)
    if len(first.bins) <= 1:
        return first
    rng = np.random.default_rng(seed)
    worth = lambda p: p.worth(capacity)

    def shaken() -> Packing:
        order = np.argsort(-np.array(sizes) * (1 + 0.3 * rng.random(len(sizes))), kind="stable")
        return best_fit(Packing([], []), order.tolist(), sizes, capacity)

    demes = [[first if d == i == 0 else shaken() for i in range(DEME_SIZE)] for d in range(DEMES)]
    for generation in range(1, generations + 1):
        for deme in demes:
            deme.sort(key=worth, reverse=True)
            children = [
                mutate(crossover(deme[i], deme[j], sizes, capacity, rng), sizes, capacity, rng)
                for i, j in (rng.choice(DEME_SIZE, 2, replace=False) for _ in range(DEME_SIZE // 2))
            ]
            deme[DEME_SIZE - len(children) :] = children
        if generation % MIGRATE_EVERY == 0:  # the elite of each deme replaces the last of the next
            elite = [max(deme, key=worth) for deme in demes]
            for d, deme in enumerate(demes):
                deme.sort(key=worth, reverse=True)
                deme[-1] = elite[d - 1]
            if max(len(p.bins) == least for deme in demes for p in deme):
                break
    return max((p for deme in demes for p in deme), key=worth)


def sized(docs: DataFrame, id_col: str, text_col: str, vocabulary: str = T.VOCABULARY) -> DataFrame:
    """(item, size): tokens of each whole text; 0 for null and empty ones."""
    path = f"{T.tokenizers_folder(docs.sparkSession)}/{vocabulary}"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = T.text_sizes(path, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["item", "size"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(measure, f"item {kind}, size bigint")


def _packer(epoch: int, last: bool, capacity: int):
    """Packs the items of one island; ``settled`` says whether a bin stays as it is."""

    def one_island(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True], ignore_index=True)
        at = int(pdf["island"].iloc[0])
        packed = evolve(pdf["size"].tolist(), capacity, seed=at)
        number = np.empty(len(pdf), dtype=np.int64)
        for b, members in enumerate(packed.bins):
            number[members] = b
        load = np.array(packed.loads)[number]
        return pd.DataFrame(
            {
                "bin": [f"e{epoch}-{at}-{b}" for b in number],
                "item": pdf["item"], "piece": pdf["piece"], "size": pdf["size"], "load": load,
                "settled": last | (load >= SETTLED * capacity),
            }
        )

    return one_island


def pack(items: DataFrame, capacity: int, island: int = ISLAND) -> DataFrame:
    """(bin, item, piece, size, load) of ``items`` (item, size).

    An item larger than the capacity is cut into full bins of its own (pieces 0,
    1, ...) and a last piece packed with the others; no other item is cut.
    Every item is in the result once (or once per piece), also those of size 0
    (null or empty texts).  Items without an id are left out; an id that comes
    twice counts once, with its largest size.  ``load`` is the sum of the bin.
    """
    distinct = items.where("item is not null").groupBy("item").agg(F.max("size").alias("size"))
    whole = F.floor(F.col("size") / capacity)
    cut = distinct.select("item", "size", F.when(F.col("size") > capacity, whole).otherwise(0).cast("int").alias("full"))
    cut = materialize(cut.select("item", "full", (F.col("size") - F.col("full") * capacity).alias("size")), "sizes")
    full = cut.where("full > 0").select("item", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("piece"))
    full = full.select(
        F.concat(F.lit("whole-"), F.col("item").cast("string"), F.lit("-"), F.col("piece").cast("string")).alias("bin"),
        "item", "piece", F.lit(capacity).cast("long").alias("size"), F.lit(capacity).cast("long").alias("load"),
    )
    left = cut.where("size > 0 or full = 0").select("item", F.col("full").alias("piece"), "size")
    kind = items.schema["item"].dataType.simpleString()
    schema = f"bin string, item {kind}, piece int, size long, load long, settled boolean"
    out, count, epoch = full, left.count(), 0
    before = 2 * count + 1
    while True:
        islands = max(1, -(-count // island))
        last = islands == 1 or 2 * count > before

        spread = left.withColumn("island", F.pmod(F.xxhash64("item", F.lit(epoch)), F.lit(islands)))
        packed = materialize(spread.groupBy("island").applyInPandas(_packer(epoch, last, capacity), schema), f"epoch{epoch}")
        out = out.unionByName(packed.where("settled").drop("settled"))
        if last:
            break
        left = packed.where("not settled").select("item", "piece", "size")
        before, count, epoch = count, left.count(), epoch + 1
    return out


def compare(items: DataFrame, capacity: int, island: int = ISLAND) -> DataFrame:
    """(island, items, least, best_fit, genetic): bins of each island of ``items`` (item, size), none larger than the capacity.

    ``least`` is the sum of sizes over the capacity, which no packing can beat;
    ``best_fit`` is best-fit decreasing alone.  Null ids are left out, an id that
    comes twice counts once, with its largest size.
    """
    distinct = materialize(items.where("item is not null").groupBy("item").agg(F.max("size").alias("size")).where(F.col("size") <= capacity), "sizes")
    islands = max(1, -(-distinct.count() // island))

    def one_island(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = sorted(pdf["size"].tolist(), reverse=True)
        at = int(pdf["island"].iloc[0])
        plain = best_fit(Packing([], []), list(range(len(sizes))), sizes, capacity)
        bins = len(plain.bins), len(evolve(sizes, capacity, seed=at).bins)
        return pd.DataFrame({"island": [at], "items": [len(sizes)], "least": [-(-sum(sizes) // capacity)], "best_fit": [bins[0]], "genetic": [bins[1]]})

    placed = distinct.withColumn("island", F.pmod(F.xxhash64("item"), F.lit(islands)))
    return placed.groupBy("island").applyInPandas(one_island, "island long, items long, least long, best_fit long, genetic long")
