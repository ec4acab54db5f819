"""Security scan of texts: indicators line by line, capabilities, risk and status.

All that is found in a text is one array of its row: no line leaves the row, and
a scan is one projection without a shuffle.  Plain searches for what a rule
needs come first, so patterns run only over lines in which they can match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import rules as R

FOUND = "array<struct<pattern_name:string,pattern_type:string,severity:string,line:int,matched:string>>"
_LINE_RULES = [(n, "code", s, p) for n, s, p in R.IOC] + [(n, "instruction", s, p) for n, s, p in R.INSTRUCTIONS]
SEVERITIES = ("critical", "high", "medium", "low")
NO_TAKEDOWN = "named_struct('state', 'none', 'reason', cast(null as string), 'date', cast(null as string))"


def folded(text: Column) -> Column:
    """In lower case, with the letters that patterns take for i, s and k."""
    return F.lower(F.translate(text, "\u017f\u0131\u0130\u212a", "siik"))


def may_match(low: Column, rule: str) -> Column:
    """Whether a folded text has what a rule needs."""
    out = F.lit(False)
    for literals in R.NEEDS[rule]:
        every = F.lit(True)
        for literal in literals:
            every = every & F.contains(low, F.lit(literal))
        out = out | every
    return out


def _none() -> Column:
    return F.array().cast(FOUND)


def _find(name: Column | str, kind: str, severity: str, line: Column, matched: Column) -> Column:
    return F.struct(
        F.lit(name).alias("pattern_name"), F.lit(kind).alias("pattern_type"), F.lit(severity).alias("severity"),
        line.cast("int").alias("line"), matched.alias("matched"),
    )


def _bound(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def indicators(content: Column) -> Column:
    """FOUND of every match of a rule, by line and rule; matched text up to 100 characters."""

    def of_rule(x: Column, rule: tuple[str, str, str, str]) -> Column:
        name, kind, severity, pattern = rule
        hits = F.regexp_extract_all(x.text, F.lit(R.pattern(pattern)), F.lit(0))
        return F.when(may_match(x.low, name), F.transform(hits, lambda m: _find(name, kind, severity, x.at, F.left(m, F.lit(100))))).otherwise(_none())

    of_line = lambda x: F.flatten(F.array(*(of_rule(x, rule) for rule in _LINE_RULES)))
    suspicious = _bound(folded(content), lambda low: F.array_contains(F.array(*(may_match(low, n) for n, *_ in _LINE_RULES)), True))
    lines = F.transform(F.split(content, "\n"), lambda t, i: F.struct(t.alias("text"), folded(t).alias("low"), (i + 1).alias("at")))
    return F.when(F.coalesce(suspicious, F.lit(False)), F.flatten(F.transform(lines, of_line))).otherwise(_none())


def tags(description: Column) -> Column:
    """FOUND of markup tags in a description; matched text up to 50 characters."""
    hits = F.regexp_extract_all(description, F.lit(R.TAG_IN_DESCRIPTION), F.lit(0))
    return F.coalesce(F.transform(hits, lambda m: _find("xml_in_description", "description", "medium", F.lit(None), F.left(m, F.lit(50)))), _none())


def invisible(content: Column) -> Column:
    """FOUND of format and control characters but tab, CR and LF, as U+ and their code point."""
    lines = F.transform(F.split(content, "\n"), lambda t, i: F.struct(t.alias("text"), (i + 1).alias("at")))
    of_line = lambda x: F.transform(
        F.regexp_extract_all(x.text, F.lit(R.INVISIBLE), F.lit(0)),
        lambda c: _find("invisible_unicode", "code", "medium", x.at, F.concat(F.lit("U+"), F.lpad(F.hex(F.ascii(c)), 4, "0"))),
    )
    return F.when(F.coalesce(content.rlike(R.INVISIBLE), F.lit(False)), F.flatten(F.transform(lines, of_line))).otherwise(_none())


def ioc_matches(docs: DataFrame, record: str, content: str) -> DataFrame:
    """(record, pattern_name, pattern_type, severity, line, matched) of every match."""
    return docs.select(record, F.inline(indicators(F.col(content))))


def invisible_characters(docs: DataFrame, record: str, content: str) -> DataFrame:
    """(record, line, code_point) of format and control characters but tab, CR and LF."""
    found = docs.select(record, F.inline(invisible(F.col(content))))
    return found.select(record, "line", F.conv(F.substring("matched", 3, 8), 16, 10).cast("int").alias("code_point"))


def capabilities(content: Column, has_scripts: Column | None = None) -> Column:
    """Sorted capabilities that a text shows."""

    def shown(low: Column) -> Column:
        out = []
        for name, p in R.CAPABILITIES:
            hit = may_match(low, name) & content.rlike(R.pattern(p))
            if name == "shell" and has_scripts is not None:
                hit = hit | F.coalesce(has_scripts, F.lit(False))
            out.append(F.when(hit, name))
        return F.array_sort(F.array_compact(F.array(*out)))

    return _bound(folded(content), shown)


def severity_counts(matches: DataFrame, record: str) -> DataFrame:
    """(record, critical, high, medium, low, max_severity) by rank, not by alphabet."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity"))
    return matches.groupBy(record).agg(
        *(F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES), F.min_by("severity", rank).alias("max_severity")
    )


def risk_level(caps: Column, critical: Column, matches: Column) -> Column:
    """high, medium or low from capabilities and the numbers of critical and of all matches."""
    grave = F.array_contains(caps, "money") | F.array_contains(caps, "external-instructions")
    return F.when((critical > 0) | grave, "high").when((matches > 0) | (F.size(caps) > 0), "medium").otherwise("low")


def status(caps: Column, critical: Column, matches: Column, layer: Column, verdict: Column | None = None) -> Column:
    """malicious, then review or pass in the curated layer, warn or pass elsewhere."""
    bad = critical > 0
    if verdict is not None:
        bad = bad | (F.lower(F.coalesce(verdict, F.lit(""))) == "malicious")
    return (
        F.when(bad, "malicious")
        .when((layer == "curated") & (matches > 0), "review")
        .when(layer == "curated", "pass")
        .when((matches > 0) | (F.size(caps) > 0), "warn")
        .otherwise("pass")
    )


def scan(docs: DataFrame, record: str, content: str, description: str, has_scripts: str, layer: str, verdict: str | None = None) -> DataFrame:
    """One row per record: capabilities, counts by severity, the highest, risk level, status, and what was found.

    ``verdict``: the column of the upstream registry's verdict; "malicious" there
    makes the record malicious whatever its text has.
    """
    found = docs.select(
        record, F.col(layer).alias("_layer"), (F.col(verdict) if verdict else F.lit(None).cast("string")).alias("_verdict"),
        capabilities(F.col(content), F.col(has_scripts)).alias("capabilities"),
        F.concat(indicators(F.col(content)), tags(F.col(description)), invisible(F.col(content))).alias("found"),
    )
    of = lambda s: F.size(F.filter("found", lambda x: x.severity == s)).cast("long").alias(s)
    counted = found.select("*", *(of(s) for s in SEVERITIES))
    highest = F.lit("none")
    for s in reversed(SEVERITIES):
        highest = F.when(F.col(s) > 0, s).otherwise(highest)
    matches = sum((F.col(s) for s in SEVERITIES), F.lit(0))
    caps = F.coalesce("capabilities", F.array().cast("array<string>"))
    return counted.select(
        record, caps.alias("capabilities"), *SEVERITIES, highest.alias("max_severity"),
        risk_level(caps, F.col("critical"), matches).alias("risk_level"),
        status(caps, F.col("critical"), matches, F.col("_layer"), F.col("_verdict")).alias("status"), "found",
    )


def security_field(ran_at: str, commit: Column) -> Column:
    """The security struct of a record from the columns of ``scan``; external references and verdicts are filled in later."""
    patterns = F.transform(
        "found",
        lambda x: F.struct(
            x.pattern_name.alias("name"), x.pattern_type.alias("type"), x.line.alias("line"), x.matched.alias("text"), x.severity.alias("severity")
        ),
    )
    engine = F.struct(
        F.lit("ioc_scanner").alias("engine"), F.lit("1.0.0").alias("version"), F.lit("default").alias("policy"), commit.alias("commit"),
        F.lit(ran_at).alias("ran_at"), F.struct(*SEVERITIES).alias("counts"), patterns.alias("ioc_patterns"),
    )
    return F.struct(
        "status", "risk_level", "capabilities", "max_severity", F.array(engine).alias("scans"),
        F.array().cast("array<struct<reference:string,exists:boolean,critical:boolean>>").alias("external_refs"),
        F.expr("cast(map() as map<string,string>)").alias("upstream_verdicts"), F.expr(NO_TAKEDOWN).alias("takedown"),
    )


def with_external(records: DataFrame, record: str, layer: str, status_column: str, external: DataFrame) -> DataFrame:
    """``records`` with engines and findings of external scanners, and the status they lead to.

    Scanners run outside; ``external`` (record, engine, findings) is what they
    reported, one row a record and engine (repeated ones count once).  A finding
    puts a curated record that passed under review; elsewhere findings only tag.
    """
    per = external.select(F.col("record").alias("_record"), "engine", "findings").where("engine is not null").distinct().groupBy("_record").agg(
        F.array_sort(F.collect_set("engine")).alias("engines"), F.coalesce(F.sum("findings"), F.lit(0)).alias("findings")  # a handful of engines
    )
    joined = records.join(per, records[record] == per["_record"], "left").drop("_record")
    found = F.coalesce("findings", F.lit(0))
    return joined.withColumns({
        "engines": F.coalesce("engines", F.array().cast("array<string>")), "findings": found.cast("long"),
        "status_after": F.when((F.col(layer) == "curated") & (F.col(status_column) == "pass") & (found > 0), "review").otherwise(F.col(status_column)),
    })
