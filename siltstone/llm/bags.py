"""Bags of words: the form in which near-duplicate operators compare short texts.

A bag is a text's words in lower case, sorted, joined by single blanks.  Words
are the longest runs of letters and digits; an underscore is no letter.  The
multiset overlap of two texts is the set overlap of their *elements*, where the
n-th occurrence of a word is an element of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NOT_WORD = r"[^\p{L}\p{N}]+"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: Column) -> Column:
    """The words of a text, in order; an empty array for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _NOT_WORD), "")


def with_bag(df: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(item, bag) of the texts with at least ``min_words`` words.

    Rows without an id or a text have no bag and are left out.
    """
    words = df.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words"))
    kept = words.where(F.col("item").isNotNull() & (F.size("words") >= min_words))
    return kept.select("item", F.array_join(F.sort_array("words"), " ").alias("bag"))


def seed_without_collisions(bags: DataFrame) -> tuple[int, int]:
    """(seed, rows) of a table of distinct ``bag``: a seed under which all have different 64-bit hashes."""
    for seed in range(8):
        hashed = bags.select(F.xxhash64("bag", F.lit(seed)).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
        row = hashed.agg(F.max("n"), F.sum("n")).first()
        if (row[0] or 0) <= 1:
            return seed, row[1] or 0
    raise RuntimeError("no seed without collisions")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (wraps around on purpose)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def elements(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(elements as 64-bit hashes, start of each bag, size of each bag) of non-empty bags."""
    lists = pc.split_pattern(bags, " ")
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = pc.dictionary_encode(lists.flatten())
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    starts, sizes = offsets[:-1], np.diff(offsets)
    # a bag is sorted, so repeats of a word are neighbours: count along each run
    new = np.ones(len(codes), dtype=bool)
    new[1:] = codes[1:] != codes[:-1]
    new[starts] = True
    at = np.arange(len(codes))
    occurrence = at - np.maximum.accumulate(np.where(new, at, 0))
    with np.errstate(over="ignore"):
        return mix(hashes[codes] + occurrence.astype(np.uint64) * _ODD), starts, sizes
