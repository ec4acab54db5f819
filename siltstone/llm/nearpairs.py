"""Near-duplicate short texts by circulant MinHash.

Signature.  C-MinHash (Li and Li, 2021) needs two permutations only: one,
sigma, scatters the elements over a universe of 2**20 places; the other, pi,
is shifted circularly by k places to give the k-th signature coordinate.  Here
an element competes with ``pi[(sigma(e) - k) mod D]``: the smallest wins, so
two bags agree in a coordinate with probability equal to the multiset Jaccard
similarity that is asked for.  No statistics of the table enter: a pair meets
or doesn't whatever other texts there are, common templates included.

Bands.  ``bands`` x ``rows`` coordinates; a pair is a candidate when all rows
of some band agree, 0.9998 of those at similarity 0.7 with 20 x 3.  The rows of
one key are met where they lie, after one shuffle: each bag carries a 116-bit
parity sketch (each element flips one bit), and two bags can't differ in fewer
elements than their sketches differ in bits; nor can a pair reach the threshold
if one bag is too much longer.  Both bounds are exact and lose no pair.  What
passes is compared exactly, in integers.

Hot keys.  A template that many texts share makes band keys that many bags
have.  A key with more than ``hot`` bags is refined: its bags go to one key per
element of their *prefix* instead.  In any fixed order of elements, two bags at
similarity t or more share one of the first ``n - ceil(t * n) + 1`` elements of
each, so this too loses no pair.  The order has the frequent elements last, so a
template's words are in no prefix unless they are most of the text, and texts
that share only the template don't meet.  Keys are found hot, and the order is
taken, from a sample of bags; both decide only where a pair is met, never
whether it is.

Equal bags are one class from the start, so copies cost nothing here; pairs
are between classes, and callers expand them if they must.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm import bags as B
from siltstone.storage import materialize

UNIVERSE = 1 << 20
SEED = 20210907
SIZE_BITS = 12
NO_BOUND = (1 << SIZE_BITS) - 1  # the size of bags too large for a sketch to say anything
BAND_ROW = "key long, bag_id long, s1 long, s2 long"
HOT = 200_000  # bags of one key that one task should have to meet
MAX_HOT_KEYS = 250_000  # of which each task gets a list: 2 MB
SEEN_OF_HOT = 64  # bags of a hot key in the sample that finds it
ORDERED = 50_000  # frequent elements that come last in prefixes
ROWS_A_TASK = 150_000
CHUNK, TILE, SMALL = 200_000, 256, 32
_tables: dict[int, np.ndarray] = {}


def _pi(seed: int) -> np.ndarray:
    """The second permutation."""
    if seed not in _tables:
        _tables[seed] = np.random.default_rng(seed).permutation(UNIVERSE).astype(np.uint32)
    return _tables[seed]


def signatures(elems: np.ndarray, starts: np.ndarray, coordinates: int, seed: int = SEED) -> np.ndarray:
    """coordinates x bags: the circulant MinHash signature of each bag."""
    pi, mask = _pi(seed), UNIVERSE - 1
    place = (B.mix(elems ^ np.uint64(seed)) & np.uint64(mask)).astype(np.int32)
    out = np.empty((coordinates, len(starts)), dtype=np.uint32)
    for k in range(coordinates):
        out[k] = np.minimum.reduceat(pi[(place - k) & mask], starts)
    return out


def _band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """bands x bags: one 64-bit key per band, the band's number mixed in."""
    bits = sig.astype(np.uint64)
    keys = np.empty((bands, sig.shape[1]), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(sig.shape[1], b + 1, dtype=np.uint64)
            for r in range(rows):
                key = B.mix(key * np.uint64(0x9E3779B97F4A7C15) + bits[b * rows + r])
            keys[b] = key
    return keys


def _sketch(elems: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """116-bit parity sketch of each bag (each element flips one bit) and, in the 12 lowest bits of the second half, its size."""
    place = (elems >> np.uint64(32)) % np.uint64(128 - SIZE_BITS)
    first = np.where(place < 64, np.uint64(1) << (place & np.uint64(63)), np.uint64(0))
    second = np.where(place >= 64, np.uint64(1) << ((place + np.uint64(SIZE_BITS)) & np.uint64(63)), np.uint64(0))
    packed = np.minimum(sizes, NO_BOUND).astype(np.uint64)
    return np.bitwise_xor.reduceat(first, starts).view(np.int64), (np.bitwise_xor.reduceat(second, starts) | packed).view(np.int64)


def _non_empty(batch: pa.RecordBatch) -> bool:
    return batch.num_rows > 0


@dataclass(frozen=True)
class Refining:
    """The keys that are refined, and the elements that come last in prefixes, by their place; both bounded."""

    keys: np.ndarray  # sorted
    frequent: np.ndarray  # sorted
    place: np.ndarray  # of each frequent element: the larger, the later

    def order(self, elems: np.ndarray) -> np.ndarray:
        """Larger for elements that come later: those not listed first, by a part of their hash."""
        if not len(self.frequent):
            return (elems >> np.uint64(34)).astype(np.int64)
        at = np.minimum(np.searchsorted(self.frequent, elems), len(self.frequent) - 1)
        return np.where(self.frequent[at] == elems, self.place[at] + (1 << 31), (elems >> np.uint64(34)).astype(np.int64))

    def hot(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


def prefixes(elems: np.ndarray, starts: np.ndarray, sizes: np.ndarray, refining: Refining, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(elements, starts) of each bag's prefix: n - ceil(t * n) + 1 elements, the first in the refining's order."""
    bag = np.repeat(np.arange(len(sizes)), sizes)
    by = np.lexsort((elems, refining.order(elems), bag))
    lengths = sizes + (-sizes * t.numerator) // t.denominator + 1
    rank = np.arange(len(elems)) - starts[bag]
    return elems[by][rank < lengths[bag]], np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)


def band_rows(
    classes: DataFrame, bands: int, rows: int, refining: Refining | None = None, threshold: float = 0.7, roles: bool = False
) -> DataFrame:
    """One row per bag and band (per prefix element instead, where the key is refined): key, bag_id, sketch and size in two halves.

    With ``roles``, ``classes`` says of each bag whether it is a ``probe``; a
    row's role is 1 (to be kept), 3 (kept, and of a probe) or 2: a probe's plain
    key that is refined, to meet what was kept before it was.
    """
    t = Fraction(threshold).limit_denominator(1000)
    shared = classes.sparkSession.sparkContext.broadcast(refining) if refining is not None and len(refining.keys) else None

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(_non_empty, batches):
            elems, starts, sizes = B.elements(batch.column(1))
            keys = _band_keys(signatures(elems, starts, bands * rows), bands, rows).reshape(-1)
            bag = np.tile(np.arange(len(sizes)), bands)
            probe = batch.column(2).to_numpy(zero_copy_only=False).astype(bool) if roles else np.zeros(len(sizes), dtype=bool)
            role = np.where(probe, 3, 1).astype(np.int8)[bag]
            if shared is not None:
                hot = shared.value.hot(keys)
                if hot.any():
                    first, at = prefixes(elems, starts, sizes, shared.value, t)
                    ends = np.append(at[1:], len(first))
                    each = (ends - at)[bag[hot]]
                    inside = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                    element = first[np.repeat(at[bag[hot]], each) + inside]
                    with np.errstate(over="ignore"):
                        finer = B.mix(np.repeat(keys[hot], each) * np.uint64(0x9E3779B97F4A7C15) + element)
                    kept = ~hot | probe[bag]
                    role = np.concatenate([np.where(hot, 2, role)[kept], np.repeat(role[hot], each)]).astype(np.int8)
                    keys, bag = np.concatenate([keys[kept], finer]), np.concatenate([bag[kept], np.repeat(bag[hot], each)])
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            columns = [keys.view(np.int64), ids[bag], *(half[bag] for half in _sketch(elems, starts, sizes)), role]
            names = ["key", "bag_id", "s1", "s2", "role"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns[: 4 + roles]], names[: 4 + roles])

    if roles:
        return classes.select("bag_id", "bag", "probe").mapInArrow(sign, BAND_ROW + ", role tinyint")
    return classes.select("bag_id", "bag").mapInArrow(sign, BAND_ROW)


def hot_sample(classes: DataFrame, hot: int) -> DataFrame:
    """The part of the bags in which a key of ``hot`` bags is seen some 64 times."""
    return classes.where(F.pmod(F.col("bag_id"), F.lit(max(1, hot // SEEN_OF_HOT))) == 0)


def hot_keys(sampled_rows: DataFrame, hot: int) -> np.ndarray:
    """Sorted keys that half of ``hot`` bags or more should have, by the band rows of a sample.  At most MAX_HOT_KEYS."""
    least = max(2, min(hot, SEEN_OF_HOT) // 2)
    counted = sampled_rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    found = counted.orderBy(F.desc("n"), "key").limit(MAX_HOT_KEYS).collect()
    return np.sort(np.array([r["key"] for r in found], dtype=np.int64).view(np.uint64))


def element_order(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(frequent elements, sorted; their places): the more of the sampled bags have an element, the later its place."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(_non_empty, batches):
            elems, n = np.unique(B.elements(batch.column(0))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(elems.view(np.int64)), pa.array(n)], ["element", "n"])

    counted = sample.select("bag").mapInArrow(count, "element long, n long").groupBy("element").agg(F.sum("n").alias("n"))
    found = counted.where("n > 1").orderBy(F.desc("n"), "element").limit(ORDERED).collect()
    elems = np.array([r["element"] for r in found], dtype=np.int64).view(np.uint64)
    by = np.argsort(elems)
    return elems[by], (len(elems) - np.arange(len(elems)))[by].astype(np.int64)


def refining_of(classes: DataFrame, bands: int, rows: int, hot: int) -> Refining:
    """What is to be refined in a table of bags; nothing if no key of the sample is hot."""
    sample = hot_sample(classes, hot)
    keys = hot_keys(band_rows(sample, bands, rows), hot)
    frequent = element_order(sample) if len(keys) else (np.array([], dtype=np.uint64), np.array([], dtype=np.int64))
    return Refining(keys, *frequent)


def side(banded: DataFrame, name: str, *more: str) -> DataFrame:
    """One side of a join of band rows: all columns but the key with a suffix."""
    return banded.select("key", *(F.col(c).alias(f"{c}_{name}") for c in ("bag_id", "s1", "s2", *more)))


def sketches_allow(threshold: float) -> Column:
    """Whether the sketches of both sides of a join leave room for the threshold.

    |A xor B| <= (1 - t) / (1 + t) * (|A| + |B|) at similarity t or more.
    """
    t = Fraction(threshold).limit_denominator(1000)
    size = lambda x: F.col(f"s2_{x}").bitwiseAND(NO_BOUND)
    apart = F.bit_count(F.col("s1_a").bitwiseXOR(F.col("s1_b"))) + F.bit_count(
        F.shiftrightunsigned(F.col("s2_a").bitwiseXOR(F.col("s2_b")), SIZE_BITS)
    )
    near = apart * (t.denominator + t.numerator) <= (size("a") + size("b")) * (t.denominator - t.numerator)
    return near | (F.greatest(size("a"), size("b")) == NO_BOUND)


class _Met:
    """Rows of whole keys, sorted by key and size, that are met with each other."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, s1: np.ndarray, s2: np.ndarray, t: Fraction):
        self.ids, self.low, self.high = ids, s1.view(np.uint64), s2.view(np.uint64) >> np.uint64(SIZE_BITS)
        self.size = (s2 & NO_BOUND).astype(np.int64)
        self.t, self.found = t, []
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.starts, self.counts = new, np.diff(np.append(new, len(keys)))

    def _room(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The elements in which rows i and j may differ."""
        t, a, b = self.t, self.size[i], self.size[j]
        return np.where(np.maximum(a, b) == NO_BOUND, 128, (a + b) * (t.denominator - t.numerator) // (t.denominator + t.numerator))

    def _keep(self, i: np.ndarray, j: np.ndarray, apart: np.ndarray) -> None:
        near = apart <= self._room(i, j)
        a, b = self.ids[i[near]], self.ids[j[near]]
        self.found.append((np.minimum(a, b), np.maximum(a, b)))

    def small(self) -> None:
        """Groups of up to SMALL rows, all at once: each row with the d-th after it."""
        few = (self.counts > 1) & (self.counts <= SMALL)
        starts, counts = self.starts[few], self.counts[few]
        row = np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
        end = np.repeat(starts + counts, counts)
        for d in range(1, SMALL):
            alive = row + d < end
            row, end = row[alive], end[alive]
            if not len(row):
                break
            other = row + d
            apart = np.bitwise_count(self.low[row] ^ self.low[other]) + np.bitwise_count(self.high[row] ^ self.high[other])
            self._keep(row, other, apart)

    def large(self) -> None:
        """Larger groups in tiles, as far as the sizes allow."""
        t = self.t
        for start, count in zip(self.starts[self.counts > SMALL], self.counts[self.counts > SMALL]):
            end = start + count
            sizes = self.size[start:end]
            for at in range(start, end, TILE):
                until = min(at + TILE, end)
                most = self.size[until - 1] * t.denominator // t.numerator  # rows are sorted by size
                last = start + int(np.searchsorted(sizes, most, side="right"))
                for to in range(at, last, 4 * TILE):
                    stop = min(to + 4 * TILE, last)
                    room = int(self._room(np.array([until - 1]), np.array([stop - 1]))[0])
                    apart = np.bitwise_count(self.low[at:until, None] ^ self.low[None, to:stop])
                    apart += np.bitwise_count(self.high[at:until, None] ^ self.high[None, to:stop])
                    i, j = np.nonzero(apart <= room)
                    later = to + j > at + i
                    i, j = i[later], j[later]
                    self._keep(at + i, to + j, apart[i, j])

    def pairs(self) -> pa.RecordBatch:
        self.small()
        self.large()
        a, b = (np.concatenate([f[k] for f in self.found]) if self.found else np.array([], dtype=np.int64) for k in (0, 1))
        apart = a != b  # a bag of refined keys may meet itself
        return pa.RecordBatch.from_arrays([pa.array(a[apart]), pa.array(b[apart])], ["a", "b"])


def candidates(banded: DataFrame, threshold: float, parts: int) -> DataFrame:
    """Distinct (a, b), a < b, of bags that share a key and pass the exact bounds of sketch and size.

    One shuffle: the rows of a key come to one task, sorted by size, and are met
    there, a chunk of whole keys at a time.
    """
    t = Fraction(threshold).limit_denominator(1000)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in filter(_non_empty, batches):
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)])
            rows += batch.num_rows
            if rows < CHUNK:
                continue
            columns = [np.concatenate(x) for x in zip(*held)]
            cut = int(np.searchsorted(columns[0], columns[0][-1], side="left"))  # the last key may go on
            if cut:
                yield _Met(*(c[:cut] for c in columns), t).pairs()
            held = [[c[cut:] for c in columns]]
            rows = 0 if not cut else len(held[0][0])
        if held:
            yield _Met(*(np.concatenate(x) for x in zip(*held)), t).pairs()

    placed = banded.repartition(parts, "key").sortWithinPartitions("key", F.col("s2").bitwiseAND(NO_BOUND))
    return placed.mapInArrow(meet, "a long, b long").distinct()


def shared_counts(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(elements in common, size of left, size of right) of each pair of bags."""
    ea, _, na = B.elements(left)
    eb, _, nb = B.elements(right)
    pair = np.concatenate([np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)])
    elems = np.concatenate([ea, eb])
    order = np.lexsort((elems, pair))
    pair, elems = pair[order], elems[order]
    twice = (pair[1:] == pair[:-1]) & (elems[1:] == elems[:-1])
    return np.bincount(pair[1:][twice], minlength=len(na)), na, nb


def verified(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) whose bags reach the threshold, compared exactly."""
    t = Fraction(threshold).limit_denominator(1000)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(_non_empty, batches):
            common, na, nb = shared_counts(batch.column(2), batch.column(3))
            keep = pa.array(common * t.denominator >= (na + nb - common) * t.numerator)
            yield batch.select([0, 1]).filter(keep)

    text = classes.select("bag_id", "bag")
    both = (
        pairs.join(text.withColumnsRenamed({"bag_id": "a", "bag": "bag_a"}), "a")
        .join(text.withColumnsRenamed({"bag_id": "b", "bag": "bag_b"}), "b")
        .select("a", "b", "bag_a", "bag_b")
    )
    return both.mapInArrow(compare, "a long, b long")


class NearPairs:
    """Near-duplicate classes of a table of short texts.

    ``members``: (item, bag_id) of every text with ``min_words`` words or more.
    ``classes``: (bag_id, bag), one row per distinct bag.
    ``links``: (a, b), a < b, of the classes at ``threshold`` or above.

    Nulls: rows without id or text belong to no class.  Empty and shorter texts
    neither.  Repeated rows count once.  An empty table gives empty results.
    Other columns are never read, so their names can't clash.
    """

    def __init__(
        self, df: DataFrame, id_col: str, text_col: str, threshold: float = 0.7, min_words: int = 8, bands: int = 20, rows: int = 3, hot: int = HOT
    ):
        bagged = B.with_bag(df, id_col, text_col, min_words)
        bags = materialize(bagged.select("bag").distinct(), "bags")
        seed, n = B.seed_without_collisions(bags)
        numbered = F.xxhash64("bag", F.lit(seed)).alias("bag_id")
        self.members = bagged.select("item", numbered).distinct()
        self.classes = bags.select("bag", numbered)
        hot = max(hot, 2 * bands * n // MAX_HOT_KEYS)
        self.refining = refining_of(self.classes, bands, rows, hot) if n > hot else None
        banded = band_rows(self.classes, bands, rows, self.refining, threshold)
        parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-n * bands // ROWS_A_TASK))
        self.links = verified(candidates(banded, threshold, parts), self.classes, threshold)


def same_class_pairs(members: DataFrame, block: int = 256) -> DataFrame:
    """All (item_1, item_2), item_1 < item_2, of one class.

    A class of n members is cut into blocks of about ``block``; a task joins one
    block with the class, so no task holds or writes all pairs of a large class.
    """
    size = members.groupBy("bag_id").agg(F.count("*").alias("n")).where("n > 1")
    there = members.join(size, "bag_id").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    left = there.select(
        "bag_id", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int").alias("at"), F.col("item").alias("item_1")
    )
    right = there.select(
        "bag_id", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at"), F.col("item").alias("item_2")
    )
    return left.join(right, ["bag_id", "at"]).where("item_1 < item_2").select("item_1", "item_2")


def near_duplicate_pairs(
    df: DataFrame, id_col: str, text_col: str, threshold: float = 0.7, min_words: int = 8, **bands: int
) -> DataFrame:
    """(item_1, item_2), item_1 < item_2, of every two items whose bags reach the threshold."""
    near = NearPairs(df, id_col, text_col, threshold, min_words, **bands)
    side = near.members.withColumnRenamed("bag_id", "a")
    across = (
        near.links.join(side.withColumnRenamed("item", "x"), "a")
        .join(side.withColumnsRenamed({"a": "b", "item": "y"}), "b")
        .select(F.least("x", "y").alias("item_1"), F.greatest("x", "y").alias("item_2"))
        .where("item_1 <> item_2")
    )
    # an item with two texts can meet another item twice
    return across.unionByName(same_class_pairs(near.members)).distinct()
