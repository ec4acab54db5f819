"""License names and texts against the policy: normalise, classify, fingerprint, resolve.

Everything is column expressions; policy tables are literals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import rules as R

LICENSE_FILE = r"(?i)(?:^|/)(?:licen[sc]e|copying)(?:\.(?:txt|md|rst))?$"
_KNOWN = (*R.ALLOW, *R.CONDITIONAL, *R.DENY)


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)


def normalize(declared: Column) -> Column:
    """A declared license in its SPDX form; as it is (without quotes) if no alias fits; null for null and empty."""
    bare = F.regexp_replace(F.regexp_replace(declared, r"^\s+|\s+$", ""), r"^[\"']+|[\"']+$", "")
    short = F.regexp_replace(bare, r"\s+[Ll]icense$", "")
    by_address = reduce(lambda rest, p: F.when(bare.contains(p[0]), p[1]).otherwise(rest), reversed(R.ADDRESSES), F.lit(None))
    found = F.coalesce(by_address, _lookup(R.ALIASES, short), _lookup(R.ALIASES, bare), bare)
    return F.when(F.length(declared) > 0, found)


def symbols(expression: Column) -> Column:
    """The license ids of an expression."""
    parts = F.split(expression, r"\s+(?:AND|OR|WITH)\s+|[()\s]+")
    return F.array_remove(parts, "")


def classify(expression: Column) -> Column:
    """allow, conditional, deny or unknown: the strictest of the expression's licenses; OR counts like AND."""
    ids = symbols(expression)
    some = lambda names: F.arrays_overlap(ids, F.array(*map(F.lit, names)))
    unknown = F.size(F.array_except(ids, F.array(*map(F.lit, _KNOWN)))) > 0
    return (
        F.when(expression.isNull() | expression.isin("NOASSERTION", "LicenseRef-Unrecognized", ""), "unknown")
        .when(expression.startswith("LicenseRef-"), "deny")
        .when(some(R.DENY), "deny")
        .when(unknown | (F.size(ids) == 0), "unknown")
        .when(some(R.CONDITIONAL), "conditional")
        .otherwise("allow")
    )


def needs_review(expression: Column) -> Column:
    """Whether a person should look at the class: all but a plain allow, a plain deny and proprietary terms."""
    ids = symbols(expression)
    some = lambda names: F.arrays_overlap(ids, F.array(*map(F.lit, names)))
    kind = classify(expression)
    return (
        F.when(expression == "LicenseRef-Proprietary", False)
        .when((kind == "unknown") | expression.startswith("LicenseRef-"), True)
        .when(kind == "deny", some(R.CONDITIONAL) | some(R.ALLOW))
        .when(kind == "conditional", some(R.ALLOW))
        .otherwise(False)
    )


def fingerprint(text: Column) -> Column:
    """The license whose phrases all occur in a text; null if none does."""
    lower = F.lower(text)
    out = F.lit(None).cast("string")
    for spdx, phrases in reversed(R.FINGERPRINTS):
        hit = reduce(lambda a, b: a & b, (lower.contains(p) for p in phrases))
        value = F.when(lower.contains("neither the name") | text.contains("3."), "BSD-3-Clause").otherwise("BSD-2-Clause") if spdx == "BSD" else F.lit(spdx)
        out = F.when(hit, value).otherwise(out)
    return out


def directory(path: Column) -> Column:
    """'' for files of the root."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(directory_: Column) -> Column:
    """A directory and all above it, the root ('') last."""
    parts = F.split(directory_, "/")
    above = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.when(directory_ == "", F.array(F.lit(""))).otherwise(F.array_append(above, ""))


def depth(directory_: Column) -> Column:
    return F.when(directory_ == "", 0).otherwise(F.size(F.split(directory_, "/")))


def is_license_file(path: Column) -> Column:
    return path.rlike(LICENSE_FILE)


def license_files_above(files: DataFrame, dirs: DataFrame) -> DataFrame:
    """(repo, dir, file, at_depth) of the license and notice files in each (repo, dir) and above it.

    Directories are exploded to their ancestors (as many as they are deep) and
    met by equality; nothing is compared with everything.
    """
    base = F.upper(F.regexp_extract("path", r"([^/.]*)[^/]*$", 1))
    named = files.where(base.isin(*R.LICENSE_BASES)).select("repo", directory(F.col("path")).alias("at"), F.col("path").alias("file")).distinct()
    places = dirs.select("repo", "dir").distinct().select("repo", "dir", F.explode(ancestors(F.col("dir"))).alias("at"))
    return places.join(named, ["repo", "at"]).select("repo", "dir", "file", depth(F.col("at")).alias("at_depth"))


def nearest_license_file(files: DataFrame, dirs: DataFrame) -> DataFrame:
    """(repo, dir, file): the license file of the nearest directory, the smallest path if it has several."""
    above = license_files_above(files, dirs).where(is_license_file(F.col("file")))
    nearest = F.min(F.struct((-F.col("at_depth")).alias("up"), "file"))
    return above.groupBy("repo", "dir").agg(nearest.alias("n")).select("repo", "dir", F.col("n.file").alias("file"))


def readme_license(text: Column) -> Column:
    """The first line of a README's License section (a heading of just that word)."""
    return F.nullif(F.trim(F.regexp_extract(text, r"(?im)^#+[ \t]*license[ \t]*\r?\n(?:[ \t]*\r?\n)*([^#\r\n][^\r\n]*)", 1)), F.lit(""))


def is_spdx(expression: Column) -> Column:
    """Whether all ids of an expression are known to the policy or are references."""
    ids = symbols(expression)
    unknown = F.filter(ids, lambda i: ~i.isin(*_KNOWN) & ~i.startswith("LicenseRef-"))
    return (F.size(ids) > 0) & (F.size(unknown) == 0)


def resolve(records: DataFrame) -> DataFrame:
    """License of records (declared, has_file, own_text, own_file, near_text, near_file, readme).

    In this order: the declared license (proprietary terms, a reference to the
    record's own license file, an expression); the nearest license file (own
    directory, then those above); the README; none.  Adds spdx, evidence, file,
    license_class and needs_review.
    """
    declared = F.trim(F.coalesce("declared", F.lit("")))
    lower = F.lower(declared)
    refers = (lower.rlike(r"licen[sc]e|copying") & lower.rlike("see|in|has|complete terms")) | F.upper(declared).rlike(
        r"^(?:LICEN[SC]E|COPYING)(?:\.(?:TXT|MD|RST))?$"
    )
    refers = refers & lower.rlike(r"(?:licen[sc]e|copying)\.(?:txt|md|rst)|^(?:licen[sc]e|copying)$|\bsee\b")
    plain = normalize(declared)
    text_license = lambda text, file: F.coalesce(
        fingerprint(text), F.concat(F.lit("LicenseRef-"), F.split(file, "/")[0], F.lit("-terms"))
    )
    own = F.col("own_file").isNotNull()
    near = F.col("near_file").isNotNull()
    readme = normalize(F.col("readme"))
    cases = [
        (declared.startswith("Proprietary"), F.lit("LicenseRef-Proprietary"), F.lit("frontmatter"), F.lit(None)),
        (refers & own, text_license(F.col("own_text"), F.col("own_file")), F.lit("skill-file"), F.col("own_file")),
        (refers, F.lit("NOASSERTION"), F.lit("frontmatter"), F.lit(None)),
        ((declared != "") & is_spdx(plain), plain, F.lit("frontmatter"), F.lit(None)),
        (declared != "", F.lit("LicenseRef-Unrecognized"), F.lit("frontmatter"), F.lit(None)),
        (own, text_license(F.col("own_text"), F.col("own_file")), F.lit("skill-file"), F.col("own_file")),
        (near, text_license(F.col("near_text"), F.col("near_file")), F.when(depth(directory(F.col("near_file"))) == 0, "repo-file").otherwise("ancestor-file"), F.col("near_file")),
        (is_spdx(readme), readme, F.lit("readme"), F.lit(None)),
    ]
    pick = lambda i, none: reduce(lambda rest, c: F.when(c[0], c[i]).otherwise(rest), reversed(cases), none)
    out = records.withColumns(
        {"spdx": pick(1, F.lit("NOASSERTION")), "evidence": pick(2, F.lit("none")), "file": pick(3, F.lit(None).cast("string"))}
    )
    by_readme = F.col("evidence") == "readme"
    return out.withColumns(
        {
            "license_class": F.when(by_readme, "unknown").otherwise(classify(F.col("spdx"))),
            "needs_review": by_readme | needs_review(F.col("spdx")),
        }
    )
