"""Spellings in the catalogue tables: ids, labels, digests, tiers, times, stand-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for a value that is not known, not given or not there.
STAND_INS = (
    "-", "--", "?", ".", "...", "n/a", "na", "n.a.", "nil", "none", "null", "nan", "undefined", "unknown",
    "unspecified", "tbd", "tba", "todo", "missing", "empty", "not available", "not provided", "not specified",
)
NO_CLUSTER = (*STAND_INS, "unclustered", "not clustered", "no cluster", "noise", "singleton")
NO_LICENSE = (*STAND_INS, "noassertion", "no assertion", "no license")
NO_SCAN = (*STAND_INS, "pending", "not scanned", "unscanned", "scan pending", "not run", "queued")
NO_DESCRIPTION = (
    *STAND_INS, "no description", "no description provided", "no description available", "description goes here",
    "description missing", "missing description", "add description", "tbd - add description",
    "todo: describe this skill", "todo: add description", "description", "placeholder",
)
TIERS = ("official", "community", "unreviewed", "aggregator-copy")


def trimmed(c: Column) -> Column:
    """Without blanks of any kind at either end."""
    return F.regexp_replace(c, r"^[\s\p{Z}\x{feff}]+|[\s\p{Z}\x{feff}]+$", "")


def skill_key(c: Column) -> Column:
    """A record id in its one spelling; null for null and blank.

    Blanks around it, a scheme, closing slashes and a closing /SKILL.md go; host,
    owner and repository are in lower case; the path keeps its case.
    """
    bare = F.regexp_replace(trimmed(c), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, r"(?i)(/+skill\.md)?/*$", "")
    parts = F.split(bare, "/+")
    spelled = F.concat_ws("/", F.transform(parts, lambda p, i: F.when(i < 3, F.lower(p)).otherwise(p)))
    return F.nullif(spelled, F.lit(""))


def cluster_key(c: Column) -> Column:
    """A cluster label without case and blanks; null where it stands for no cluster."""
    label = F.lower(F.regexp_replace(trimmed(c), r"\s+", " "))
    return F.when(~label.isin("", *NO_CLUSTER), label)


def digest_key(c: Column) -> Column:
    """A digest without its prefix, case and blanks; null for null and blank."""
    bare = F.regexp_replace(F.lower(trimmed(c)), r"^sha-?256\s*[:=]\s*", "")
    return F.nullif(bare, F.lit(""))


def tier_rank(c: Column) -> Column:
    """0 for the most trusted tier up to 4 for null and what is no tier."""
    plain = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z]+", "")
    rank = F.lit(len(TIERS))
    for i, tier in reversed(list(enumerate(TIERS))):
        rank = F.when(plain == tier.replace("-", ""), i).otherwise(rank)
    return rank


def moment(c: Column) -> Column:
    """Text in any of the forms in use as microseconds since 1970 UTC; null if it is no time.

    ISO 8601 with T or blank, fractions, offset or none (then UTC); the compact
    form 20250131T235959Z; a date alone; seconds since 1970.  Independent of the
    session's time zone.
    """
    text = F.btrim(c, F.lit(" \t\n\x0b\f\r\u00a0\ufeff"))
    part = lambda at, n: F.substring(text, at, n)
    compact = part(9, 1).isin("T", "t") & F.length(text).isin(15, 16)
    spelled = F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit("T"), part(10, 2), F.lit(":"), part(12, 2), F.lit(":"), part(14, 3))
    text = F.when(compact, spelled).otherwise(text)
    iso = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?\s?(Z|UTC|[+-]\d{2}(?::?\d{2})?)?$"
    zoned = F.regexp_extract(text, iso, 1) != ""
    day = F.length(text) == 10
    known = F.when(day, F.concat(text, F.lit("T00:00:00Z"))).when(zoned, text).otherwise(F.concat(text, F.lit("Z")))
    valid = F.when(day, text.rlike(r"^\d{4}-\d{2}-\d{2}$")).otherwise(text.rlike(iso))
    epoch = F.when(F.length(text).between(9, 11) & text.rlike(r"^\d{9,11}$"), text.try_cast("long") * 1000000)
    return F.coalesce(epoch, F.when(valid, F.unix_micros(known.try_cast("timestamp"))))
