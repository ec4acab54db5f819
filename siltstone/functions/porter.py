"""The Porter stemmer (Porter, 1980, "An algorithm for suffix stripping"), from the paper's rules."""

from __future__ import annotations

import re
from functools import lru_cache

# The suffix rules of steps 2, 3 and 4.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
)
STEP_3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """The word as c and v: y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem_: str) -> int:
    return len(re.findall("v+c+", _shape(stem_)))


def _short(word: str) -> bool:
    """Ends consonant, vowel, consonant, the last not w, x or y."""
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _replace(word: str, rules, least: int) -> str:
    for suffix, new in sorted(rules, key=lambda r: -len(r[0])):
        if word.endswith(suffix):
            base = word[: -len(suffix)]
            return base + new if _measure(base) >= least else word
    return word


@lru_cache(maxsize=65536)
def stem(word: str) -> str:
    """The stem of a lower-case word; words of one or two letters, or with other signs than a-z, stay."""
    if len(word) < 3 or not re.fullmatch("[a-z]+", word):
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        cut = next((word[: -len(s)] for s in ("ed", "ing") if word.endswith(s) and "v" in _shape(word[: -len(s)])), None)
        if cut is not None:
            word = cut
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif _double(word) and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _short(word):
                word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(word, STEP_2, 1)
    word = _replace(word, STEP_3, 1)
    for suffix in sorted(STEP_4, key=len, reverse=True):
        if word.endswith(suffix):
            base = word[: -len(suffix)]
            if _measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t"))):
                word = base
            break
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short(base)):
            word = base
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word
