"""A minimal acyclic transducer from frequent words to token ids.

Words that share an ending share its states.  A transition adds to a running
sum the number of words that sort before those behind it; the sum at the end of
a word is the word's place in the sorted lexicon, and so the place of its ids.
Built incrementally from sorted words (Daciuk et al., 2000), stored as a few
flat arrays in one file that all Python workers of a machine map into memory,
and followed for all words of a batch at once, one byte a step.
"""

from __future__ import annotations

import io
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import tokens as T
from siltstone.storage import write_bytes

MAX_WORDS = 30_000  # a lexicon only saves merging, so its size changes no result
MAX_BYTES = 64
_mapped: dict[str, Lexicon] = {}


class Lexicon:
    """keys: state * 256 + byte, sorted; to, before: of each transition; final: of each state; ids of the n-th word."""

    def __init__(self, keys, to, before, final, offsets, ids):
        self.keys, self.to, self.before, self.final, self.offsets, self.ids = keys, to, before, final, offsets, ids

    @classmethod
    def build(cls, entries: dict[bytes, list[int]]) -> Lexicon:
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []  # frozen: final, ((byte, state), ...)

        def freeze(node: list) -> int:
            signature = (node[0], tuple(node[1]))
            if signature not in register:
                register[signature] = len(states)
                states.append(signature)
            return register[signature]

        ordered = sorted(w for w in entries if w)
        path, last = [[False, []]], b""  # the states along the last word, not frozen yet
        for word in ordered:
            shared = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
            while len(path) > shared + 1:
                done = freeze(path.pop())
                path[-1][1].append((last[len(path) - 1], done))
            path += [[False, []] for _ in word[shared:]]
            path[-1][0], last = True, word
        while len(path) > 1:
            done = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        root = freeze(path[0])

        behind = np.zeros(len(states), dtype=np.int64)  # words from each state on; targets are frozen first
        for s, (final, out) in enumerate(states):
            behind[s] = final + sum(behind[t] for _, t in out)
        edges = []
        for s, (final, out) in enumerate(states):
            passed = int(final)
            for byte, target in out:
                edges.append((s * 256 + byte, target, passed))
                passed += behind[target]
        table = np.array(sorted(edges), dtype=np.int64).reshape(-1, 3)
        sizes = [len(entries[w]) for w in ordered]
        return cls(
            table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32),
            np.array([f for f, _ in states] + [root], dtype=np.int32),  # the root's number comes last
            np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
            np.array([i for w in ordered for i in entries[w]], dtype=np.int32),
        )

    _PARTS = ("keys", "to", "before", "final", "offsets", "ids")

    def dump(self) -> bytes:
        """One file: sizes, then the arrays, each at a multiple of 8 bytes."""
        out = io.BytesIO()
        arrays = [np.ascontiguousarray(getattr(self, p)) for p in self._PARTS]
        out.write(np.array([len(a) for a in arrays], dtype=np.int64).tobytes())
        for a in arrays:
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
        return out.getvalue()

    @classmethod
    def map(cls, path: str) -> Lexicon:
        """The lexicon in a file, mapped into memory and kept by this process."""
        if path not in _mapped:
            raw = np.memmap(path, dtype=np.uint8, mode="r")
            sizes, at, arrays = raw[: 8 * len(cls._PARTS)].view(np.int64), 8 * len(cls._PARTS), []
            for n, kind in zip(sizes, (np.int64, np.int32, np.int32, np.int32, np.int64, np.int32)):
                width = int(n) * np.dtype(kind).itemsize
                arrays.append(raw[at : at + width].view(kind))
                at += width + -width % 8
            _mapped[path] = cls(*arrays)
        return _mapped[path]

    def places(self, found: list[bytes]) -> np.ndarray:
        """The place of each word in the lexicon, -1 if it isn't there."""
        length = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        place = np.full(len(found), -1, dtype=np.int64)
        if not len(self.keys):
            return place
        raw = np.frombuffer(b"".join(found), dtype=np.uint8)
        start = np.cumsum(length) - length
        alive = np.flatnonzero((length > 0) & (length <= MAX_BYTES))
        state = np.full(len(alive), self.final[-1], dtype=np.int64)
        total = np.zeros(len(alive), dtype=np.int64)
        step = 0
        while len(alive):
            key = state * 256 + raw[start[alive] + step]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[edge] == key
            alive, edge = alive[there], edge[there]
            state, total = self.to[edge].astype(np.int64), total[there] + self.before[edge]
            step += 1
            ends = length[alive] == step
            full = ends & (self.final[state] == 1)
            place[alive[full]] = total[full]
            alive, state, total = alive[~ends], state[~ends], total[~ends]
        return place


def frequent_words(docs: DataFrame, text_col: str, most: int = MAX_WORDS) -> list[str]:
    """The most frequent words, counted over the whole of all texts; at most ``most`` reach the driver."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(T.words(text))
            kept = [(w, n) for w, n in counts.items() if len(w) <= MAX_BYTES]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"]
            )

    counted = docs.select(text_col).mapInArrow(tally, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in counted.where("n > 1").orderBy(F.desc("n"), "word").limit(most).collect()]


def publish(spark: SparkSession, lexicon: Lexicon) -> str:
    """Write the lexicon to the shared folder and have every executor fetch it; gives its file name."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(write_bytes(spark, name, lexicon.dump()))
    return name


def encode_batch(lexicon: Lexicon, vocabulary: str, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids) of the texts: the lexicon's words by the transducer, all others merged exactly."""
    distinct, flat, lengths = T.numbered(texts)
    found = [w.encode("utf-8", "surrogatepass") for w in distinct]
    place = lexicon.places(found)
    unseen = np.flatnonzero(place < 0)
    merge = T.merger(vocabulary)
    merged = [merge(found[i]) for i in unseen]
    known = place >= 0
    size = np.zeros(len(found), dtype=np.int64)
    start = np.zeros(len(found), dtype=np.int64)
    size[known] = lexicon.offsets[place[known] + 1] - lexicon.offsets[place[known]]
    start[known] = lexicon.offsets[place[known]]
    size[unseen] = [len(m) for m in merged]
    start[unseen] = len(lexicon.ids) + np.cumsum(size[unseen]) - size[unseen]
    pool = np.concatenate([lexicon.ids, np.fromiter((i for m in merged for i in m), dtype=np.int32)])
    word_size = size[flat]
    ids = pool[T.ragged(start[flat], word_size)]
    total = np.concatenate([[0], np.cumsum(word_size)])
    return total[np.concatenate([[0], np.cumsum(lengths)])], ids


def encode(docs: DataFrame, id_col: str, text_col: str, vocabulary: str = T.VOCABULARY, most: int = MAX_WORDS) -> DataFrame:
    """(id_col, ids: array<int>) of every row, without special tokens.

    Null and empty texts have no ids: an empty list, never null.  Strings that
    look like special tokens are ordinary text.  A text is encoded whole,
    whatever its length.  Repeated rows and null ids come out as they went in;
    an empty table gives an empty result; other columns are never read.
    """
    spark = docs.sparkSession
    path = f"{T.tokenizers_folder(spark)}/{vocabulary}"
    merge = T.merger(path)
    entries = {b: merge(b) for b in (w.encode("utf-8", "surrogatepass") for w in frequent_words(docs, text_col, most)) if len(b) <= MAX_BYTES}
    name = publish(spark, Lexicon.build(entries))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon.map(SparkFiles.get(name))
        for batch in batches:
            offsets, ids = encode_batch(lexicon, path, batch.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(code, f"`{id_col}` {kind}, ids array<int>")
