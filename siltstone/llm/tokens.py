"""Byte-level BPE over whole texts, a batch of texts at a time.

A text is cut into *words* by the tokenizer's own pattern; a word's ids don't
depend on its neighbours.  So each distinct word of a batch is encoded once, and
the texts' ids are gathered from the words' ids with array operations.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable
from itertools import count

import numpy as np
import regex

# The pattern of the public tokenizer (see the README of its files), and what it comes to on ASCII text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ASCII = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"""
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"

_any_words = regex.compile(PATTERN).findall
_ascii_words = re.compile(_ASCII, re.ASCII).findall
_encoders: dict[str, object] = {}


def words(text: str) -> list[str]:
    """The pattern's words; joined they are the text."""
    return (_ascii_words if text.isascii() else _any_words)(text)


def tokenizers_folder(spark) -> str:
    """The folder of the public tokenizers: the session's ``siltstone.tokenizers``, or the usual one."""
    return spark.conf.get("siltstone.tokenizers", TOKENIZERS)


def merger(path: str):
    """bytes of a word -> its ids, by exact merging in order of rank."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        _encoders[path] = encoding._encode_single_piece
    return _encoders[path]


def numbered(texts: Iterable[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, the texts' words as numbers one after the other, words of each text)."""
    number = defaultdict(count().__next__)
    flat, lengths = array("i"), array("q")
    for text in texts:
        before = len(flat)
        if text:
            flat.extend(map(number.__getitem__, words(text)))
        lengths.append(len(flat) - before)
    return list(number), np.frombuffer(flat, dtype=np.int32), np.frombuffer(lengths, dtype=np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] places, and so on."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def word_sizes(path: str, distinct: list[str]) -> np.ndarray:
    """Tokens of each word."""
    merge = merger(path)
    return np.fromiter((len(merge(w.encode("utf-8", "surrogatepass"))) for w in distinct), dtype=np.int64, count=len(distinct))


def text_sizes(path: str, texts: Iterable[str | None]) -> np.ndarray:
    """Tokens of each text; 0 for null and empty."""
    distinct, flat, lengths = numbered(texts)
    ends = np.cumsum(lengths)
    total = np.concatenate([[0], np.cumsum(word_sizes(path, distinct)[flat])])
    return total[ends] - total[ends - lengths]
