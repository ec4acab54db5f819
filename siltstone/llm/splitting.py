"""Long texts into pieces under a size limit, cut where the vocabulary changes.

Lexical cohesion (TextTiling; Hearst, 1997): at each natural boundary -- the end
of a paragraph, line or sentence -- the words of the block before and the block
after are compared by cosine.  Where the similarity has a valley, the topic
changes; a valley's depth is how far it lies under the peaks on both sides.
From its start on, a piece may end anywhere in a window of sizes up to the
limit; it ends at the deepest valley in it.  The next piece starts a given
number of tokens earlier.

Sizes are exact: cuts lie between the tokenizer's words, whose tokens don't
depend on what stands around them, but for blanks at an end, which are counted
again.  A word too large for that (a long run
without spaces) is broken between characters, and the pieces that hold parts of
it are encoded again to be sure of their size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm import tokens as T

LIMIT, OVERLAP = 1024, 128
BLOCK = 30  # words on each side that are compared
WINDOW = 0.5  # a piece ends at this share of the limit or later, if it can
ENDS = ("word", "sentence", "line", "paragraph")
_PERIODS = tuple(".!?…。！？।؟")
PIECE = "piece int, start int, end int, n_tokens int, shared_tokens int, ends_at string, piece_text string"


@dataclass
class Traits:
    """What splitting needs to know of each distinct word, as arrays."""

    blank: np.ndarray
    feeds: np.ndarray  # line feeds in a blank word
    returns: np.ndarray  # carriage returns in it
    starts_blank: np.ndarray
    closes: np.ndarray  # ends a sentence if a blank follows
    closes_alone: np.ndarray  # ends a sentence whatever follows
    content: np.ndarray  # says something of the topic
    folded: np.ndarray  # number of the word without regard to case

    @classmethod
    def of(cls, distinct: list[str]) -> Traits:
        flag = lambda f: np.fromiter(map(f, distinct), dtype=bool, count=len(distinct))
        number = lambda f: np.fromiter(map(f, distinct), dtype=np.int64, count=len(distinct))
        plain = [w.strip().lower() for w in distinct]
        code = {w: i for i, w in enumerate(dict.fromkeys(plain))}
        blank = flag(str.isspace)
        closes = flag(lambda w: w.rstrip("\"')]}»”’*_").endswith(_PERIODS))
        return cls(
            blank, number(lambda w: w.count("\n")) * blank, number(lambda w: w.count("\r")) * blank, flag(lambda w: w[:1].isspace()), closes,
            closes & flag(lambda w: ord(w[-1]) > 0x3000 or w[-1] in "।؟"),
            np.array([len(w) > 2 or (w.isalpha() and not w.isascii()) for w in plain], dtype=bool), np.array([code[w] for w in plain], dtype=np.int64),
        )

    def boundaries(self, words: np.ndarray) -> np.ndarray:
        """What kind of boundary (an index of ENDS) lies before each word, and at the end.

        The pattern makes up to two words of a run of blanks, so line breaks are
        counted over both.
        """
        blank = self.blank[words]
        before = np.concatenate([[False], blank[:-1]])
        twice = np.concatenate([[False, False], blank[:-2]])[: len(words)] & before
        over = lambda x: before * np.concatenate([[0], x[:-1]]) + twice * np.concatenate([[0, 0], x[:-2]])[: len(words)]
        feeds, returns = over(self.feeds[words]), over(self.returns[words])
        breaks = np.where(feeds > 0, feeds, returns)
        last = lambda x, n: np.concatenate([np.zeros(n, dtype=bool), x[:-n]])[: len(words)]
        closes, alone = self.closes[words], self.closes_alone[words]
        sentence = (last(closes, 1) & self.starts_blank[words]) | last(alone, 1) | (before & last(closes, 2))
        kind = np.where(~blank & (breaks > 1), 3, np.where(~blank & (breaks == 1), 2, np.where(sentence, 1, 0)))
        kind[0] = 0
        return np.append(kind, 3)


def cohesion(content: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Cosine of the word counts in the blocks before and after each gap (a place in ``content``)."""
    out = np.zeros(len(gaps))
    padded = np.concatenate([np.full(BLOCK, -1), content, np.full(BLOCK, -2)])
    reach = np.arange(BLOCK)
    for i in range(0, len(gaps), 512):
        at = gaps[i : i + 512, None]
        left, right = padded[at + reach], padded[at + BLOCK + reach]
        same = lambda x, y, no: ((x[:, :, None] == y[:, None, :]) & (x[:, :, None] != no)).sum((1, 2))
        norm = np.sqrt(same(left, left, -1) * same(right, right, -2).astype(float))
        out[i : i + 512] = same(left, right, -1) / np.maximum(norm, 1)
    return out


def depths(similarity: np.ndarray) -> np.ndarray:
    """How far each place lies under the nearest peaks to its left and right."""
    left, right = similarity.copy(), similarity.copy()
    for i in range(1, len(similarity)):
        if similarity[i - 1] >= similarity[i]:
            left[i] = left[i - 1]
    for i in range(len(similarity) - 2, -1, -1):
        if similarity[i + 1] >= similarity[i]:
            right[i] = right[i + 1]
    return left + right - 2 * similarity


def _broken(words: list[str], sizes: np.ndarray, most: int, count) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words of more than ``most`` tokens broken between characters; which words are such parts."""
    if not (sizes > most).any():
        return words, sizes, np.zeros(len(words), dtype=bool)
    out, size, part = [], [], []
    for word, n in zip(words, sizes.tolist()):
        if n <= most:
            out.append(word), size.append(n), part.append(False)
            continue
        step = max(1, most // 4)  # a character has at most four bytes, so at most four tokens
        for i in range(0, len(word), step):
            out.append(word[i : i + step]), size.append(count(word[i : i + step])), part.append(True)
    return out, np.array(size), np.array(part)


def split_text(words: list[str], codes: np.ndarray, traits: Traits, sizes: np.ndarray, vocabulary: str, limit: int, overlap: int) -> list[tuple]:
    """The pieces of a text larger than the limit: rows of PIECE."""
    count = lambda text: int(T.text_sizes(vocabulary, [text])[0])
    whole = len(words)
    words, sizes, part = _broken(words, sizes, max(1, min(overlap, limit // 8)), count)
    if len(words) != whole:
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        traits, codes = Traits.of(list(number)), np.array([number[w] for w in words])
    ends = np.concatenate([[0], np.cumsum(sizes)])  # tokens before each word
    chars = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))])
    kind = traits.boundaries(codes)
    kind[1:-1][part[1:] & part[:-1]] = 0
    gaps = np.flatnonzero(kind > 0)
    content = traits.content[codes]
    before = np.concatenate([[0], np.cumsum(content)])
    depth = depths(cohesion(traits.folded[codes][content], before[gaps]))

    text, pieces, start, shared = "".join(words), [], 0, 0

    def size(a: int, b: int) -> int:
        """Tokens of words a to b taken alone."""
        if part[a:b].any():
            return count(text[chars[a] : chars[b]])
        total = int(ends[b] - ends[a])
        if b - a > 1 and words[b - 1].isspace() and words[b - 2].isspace():  # blanks at the end are one word
            total += count(words[b - 2] + words[b - 1]) - int(sizes[b - 2 : b].sum())
        return total

    while True:
        last = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
        while last > start + 1 and size(start, last) > limit:
            last -= 1
        if last < len(words):
            low = int(np.searchsorted(ends, ends[start] + limit * WINDOW))
            lo, hi = np.searchsorted(gaps, [max(low, start + 1), last + 1])
            if lo == hi:  # no natural boundary in the window: the last one before it, past what the pieces share
                behind = int(np.searchsorted(ends, ends[start] + max(shared, overlap), side="right"))
                lo = max(np.searchsorted(gaps, max(behind, start + 1)), hi - 1)
            if lo < hi:
                options = range(lo, hi)
                last = int(gaps[max(options, key=lambda g: (round(depth[g], 6), kind[gaps[g]], g))])
        pieces.append((len(pieces), int(chars[start]), int(chars[last]), size(start, last), shared, ENDS[kind[last]], text[chars[start] : chars[last]]))
        if last == len(words):
            return pieces
        back = max(int(np.searchsorted(ends, ends[last] - overlap)), start + 1)
        while back < last and size(back, last) > overlap:
            back += 1
        start, shared = back, size(back, last) if back < last else 0


def split(
    docs: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP, vocabulary: str = T.VOCABULARY
) -> DataFrame:
    """(id_col, PIECE) of each text of more than ``limit`` tokens.

    ``start`` and ``end`` count characters; the pieces of a text cover all of
    it, and consecutive ones share ``shared_tokens``: as many whole words as fit
    in ``overlap`` tokens.  Null, empty and shorter texts have no rows.  Repeated
    rows and null ids come out as they went in.  ``overlap`` must be under half
    of the limit.  Other columns are never read.
    """
    if not 0 <= overlap < limit * WINDOW or limit < 8:
        raise ValueError("the overlap must be under half of the limit, the limit at least 8")
    path = f"{T.tokenizers_folder(docs.sparkSession)}/{vocabulary}"
    names = [id_col, *(field.split()[0] for field in PIECE.split(", "))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            distinct, flat, lengths = T.numbered(texts)
            word_size, traits = T.word_sizes(path, distinct), Traits.of(distinct)
            until = np.cumsum(lengths)
            rows = []
            for row, (hi, n) in enumerate(zip(until, lengths)):
                codes = flat[hi - n : hi]
                sizes = word_size[codes]
                if sizes.sum() > limit:
                    rows += [(row, *p) for p in split_text([distinct[c] for c in codes], codes, traits, sizes, path, limit, overlap)]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns[1:], kinds))], names)

    kinds = [pa.int32()] * 5 + [pa.string()] * 2
    simple = docs.schema[id_col].dataType.simpleString()
    # a token has at least one byte, so shorter texts needn't be looked at
    long_enough = docs.select(id_col, text_col).where(F.octet_length(text_col) > limit)
    return long_enough.mapInArrow(cut, f"`{id_col}` {simple}, {PIECE}")
