"""Quality smells of a description file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import rules as R
from siltstone.functions import text as T


def has_tags(text: Column) -> Column:
    return text.rlike(R.pattern(R.TAG))


def has_backslash_paths(text: Column) -> Column:
    return text.rlike(R.BACKSLASH_PATH)


def speaks_of_use(text: Column) -> Column:
    return text.rlike(R.pattern(R.SPEAKS_OF_USE))


def smells(content: Column, name: Column, description: Column) -> Column:
    """Array of smells, in fixed order; empty for a null or empty content."""
    length = F.length(description)
    found = F.array_compact(
        F.array(
            F.when(T.blank_separated_words(T.body(content)) > R.MAX_WORDS, "body-too-long"),
            F.when(T.line_count(content) > R.MAX_LINES, "file-too-many-lines"),
            F.when(length > R.MAX_DESCRIPTION, "description-too-long").when((length > 0) & (length < R.MIN_DESCRIPTION), "description-too-short"),
            F.when(has_tags(description), "description-has-xml-tags"),
            F.when(has_backslash_paths(content), "backslash-paths"),
            F.when(~speaks_of_use(content), "missing-when-to-use"),
            F.when(F.lower(name).isin(*R.RESERVED_NAMES), "reserved-word-name"),
        )
    )
    return F.when(F.length(content) > 0, found).otherwise(F.array().cast("array<string>"))
