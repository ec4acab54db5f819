"""The license of each file and repository.

Statements are read from whole files: the license field of a SKILL.md's
frontmatter, what comments and docstrings say of the file's own license, license
files, the license section of a README.  A statement names licenses (an
expression of names with OR and AND) or gives their terms.

Terms.  An inverted index of *rare* shingles -- runs of four words that few of
the known texts have -- gives candidate templates; each is then aligned with the
text word by word (the longest matching blocks, recursively).  A template is
confirmed when nearly all of it is in the text and nearly all of the text is in
it; coverage and the altered clauses are reported.

The known licenses are a small fixed table, whose size is checked before it is
sent to the executors.  Files are read where they lie; only statements, a few
bytes a file, are shuffled, and license files are met through the distinct
directories and their ancestors, never by comparing files with files.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.storage import materialize

MAX_KNOWN = 5000  # known licenses; the public lists have some hundreds
SHINGLE, RARE = 4, 3
COVERED = 0.85
TERMS_WORDS = 40  # a license file of fewer words may only refer to another place
NOASSERTION = "NOASSERTION"

# Further written forms of license names in common use.
WRITTEN = {
    "MIT": ("Expat", "Expat (MIT)", "MIT/X11", "X11 (MIT)", "MIT/Expat"),
    "MIT-0": ("MIT No Attribution", "MIT No-Attribution", "MIT Zero"),
    "0BSD": ("0-clause BSD", "BSD Zero", "Free Public License 1.0.0"),
    "BSD-2-Clause": ("BSD (two clause)", "Simplified BSD", "FreeBSD", "BSD-2"),
    "BSD-3-Clause": ("BSD (three clause)", "New BSD", "Modified BSD", "Revised BSD", "BSD-3"),
    "Apache-2.0": ("Apache 2", "ASL 2.0", "AL 2.0", "Apache Software License 2.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0"),
    "CC-BY-SA-4.0": ("CC BY SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"),
    "CC-BY-NC-4.0": ("CC BY NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"),
    "CC0-1.0": ("CC0", "CC0 1.0 Universal", "CC Zero"),
    "Unlicense": ("The Unlicense", "Unlicence"),
    "Zlib": ("zlib", "zlib/libpng"),
    "ISC": ("ISC",),
    "MPL-2.0": ("MPL 2", "Mozilla Public License 2.0"),
    "LGPL-2.1-only": ("LGPL 2.1", "GNU Lesser General Public License 2.1", "LGPLv2.1"),
    "LGPL-3.0-only": ("LGPL 3", "GNU Lesser General Public License 3"),
    "GPL-2.0-only": ("GPL 2", "GNU General Public License 2"),
    "GPL-3.0-only": ("GPL 3", "GNU General Public License 3"),
    "AGPL-3.0-only": ("AGPL 3", "GNU Affero General Public License 3"),
    "BUSL-1.1": ("BUSL 1.1", "BSL 1.1", "BSL 1.1 (Business Source)", "Business Source License 1.1"),
    "PolyForm-Noncommercial-1.0.0": ("PolyForm Noncommercial",),
    "LicenseRef-Proprietary": ("Proprietary", "Proprietary - internal use", "All rights reserved"),
}
_FILLING = frozenset(
    "the a license licence licensed gnu version ver v only international unported software public".split()
)
_NUMBERS = {"zero": "0", "one": "1", "two": "2", "three": "3"}

LICENSE_FILE = re.compile(r"(?i)(?:licen[sc]e|copying)(?:\.[^/]*)?")
README_FILE = re.compile(r"(?i)readme(?:\.[^/]*)?")
_FILE_NAMED = re.compile(r"(?i)(?<![\w-])(?:[\w./-]*/)?(?:licen[sc]e|copying)(?:\.(?:md|txt|rst|html?))?(?![\w-])")
_COPYRIGHT = re.compile(r"(?im)^[\s*#/;%.-]*(?:copyright|\(c\)|©).*$")
_BLANK = re.compile(r"[\s﻿​]*")


def name_key(name: str) -> str:
    """A license name without case, punctuation, filling words and the order of words."""
    text = name.lower().replace("licence", "license").replace("license-ref", "licenseref")
    text = re.sub(r"([a-z])[\s,]*v\.?\s?(\d)", r"\1 \2", text)
    text = re.sub(r"(?<![a-z])v\.?\s?(?=\d)", " ", text)
    found = re.findall(r"\d+(?:\.\d+)+|[a-z]+\d*(?![\w])|\d+[a-z]*|[a-z]+", text)
    words = []
    for w in found:
        w = _NUMBERS.get(w, w)
        w = re.sub(r"(?:\.0)+$", "", w) if w[0].isdigit() else w
        if w not in _FILLING:
            words.append(w)
    return " ".join(sorted(words))


def plain_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower().replace("'", "").replace("’", ""))


@dataclass(frozen=True)
class Statement:
    """What a place says: the licenses in order, or None if they aren't recognised."""

    spdx: str | None
    evidence: str
    coverage: float = 1.0
    altered: str = ""


class Known:
    """The known licenses: names, and terms under an inverted index of rare shingles."""

    def __init__(self, rows: list[tuple[str, str, list[str], str]]):
        self.names: dict[str, str] = {}
        self.terms: dict[str, list[str]] = {}
        for spdx, title, aliases, text in rows:
            if not spdx:
                continue
            for name in (spdx, title, *(aliases or ()), *WRITTEN.get(spdx, ())):
                if name and name_key(name):
                    self.names.setdefault(name_key(name), spdx)
            bare = re.sub(r"-(?:only|or-later)$", "", spdx)
            self.names.setdefault(name_key(bare), spdx)
            if text and plain_words(text):
                self.terms[spdx] = plain_words(text)
        count = Counter(s for words in self.terms.values() for s in set(self._shingles(words)))
        self.index: dict[tuple, list[str]] = {}
        self.rare: dict[str, int] = {}
        for spdx, words in self.terms.items():
            rare = max(RARE, min((count[s] for s in self._shingles(words)), default=0))  # of a family of like texts, the rarest there are
            mine = {s for s in self._shingles(words) if count[s] <= rare}
            self.rare[spdx] = len(mine)
            for s in mine:
                self.index.setdefault(s, []).append(spdx)
        self.fewest = min((COVERED * len(words) for words in self.terms.values()), default=0)  # a shorter text covers no template
        self.by_terms = lru_cache(maxsize=8192)(self._by_terms)

    @staticmethod
    def _shingles(words: list[str]) -> Iterator[tuple]:
        return zip(*(words[i:] for i in range(SHINGLE)))

    def candidates(self, words: list[str]) -> list[str]:
        """All templates of which a good part of the rare shingles is in the text, the best first."""
        hits = Counter(spdx for s in set(self._shingles(words)) for spdx in self.index.get(s, ()))
        share = {spdx: n / self.rare[spdx] for spdx, n in hits.items()}
        return sorted((s for s in share if share[s] >= 0.3), key=lambda s: (-share[s], s))

    def _by_terms(self, text: str, whole: bool) -> Statement | None:
        """The license whose terms a text gives; all of it if ``whole``, else somewhere in it."""
        words, best = text.split(), None
        for spdx in self.candidates(words):
            template = self.terms[spdx]
            match = SequenceMatcher(None, template, words, autojunk=False)
            blocks = [block for block in match.get_matching_blocks() if block.size]
            inside = [block for block in blocks if block.size >= SHINGLE] or blocks
            first, last = (0, len(words)) if whole else (inside[0].b, inside[-1].b + inside[-1].size)
            same = sum(block.size for block in blocks if first <= block.b < last)
            if min(same / len(template), same / (last - first)) < COVERED:
                continue
            rank = (2 * same - (last - first) - len(template), same)
            if best is None or rank > best[0]:
                altered = [
                    f"{' '.join(template[a:b])} -> {' '.join(words[c:d])}"
                    for op, a, b, c, d in match.get_opcodes()
                    if op != "equal" and first <= c <= last
                ]
                best = (rank, Statement(spdx, "terms", round(same / len(template), 4), "; ".join(altered)))
        return best and best[1]

    def name(self, name: str) -> str | None:
        return self.names.get(name_key(name))

    def expression(self, text: str) -> str | None:
        """The expression with each name in its SPDX form, order kept, brackets gone; None if a name isn't known."""
        text = re.sub(r"\s+", " ", text).strip(" \t.;,\"'`*_")
        if not text:
            return None
        if whole := self.name(text):
            return whole
        out = []
        for i, part in enumerate(re.split(r"(?i)[\s(]+(or|and)[\s)]+", f" {text} ")):
            if i % 2:
                out.append(part.upper())
                continue
            part = part.strip()
            while part.startswith("(") and part.count("(") > part.count(")"):
                part = part[1:].strip()
            while part.endswith(")") and part.count(")") > part.count("("):
                part = part[:-1].strip()
            if part.startswith("(") and part.endswith(")"):
                part = part[1:-1].strip()
            out.append(self.name(part))
        return None if None in out or not out else " ".join(out)


# How a comment, license file or README says under which license something stands.
_SAYS = re.compile(
    r"(?i)(?:spdx-license-identifier\s*:|@licen[sc]e\b\s*:?|^\W*licen[sc]e\s*:|\bdistributed\s+under\s*:"
    r"|\b(?:licen[sc]ed|released|distributed|published|made\s+available|available|provided)\s+under\s+(?:the\s+terms\s+of\s+)?"
    r"|\b(?:may|can|must|shall)\s+(?:only\s+)?be\s+(?:used|copied|shared|distributed|modified)\s+(?:only\s+)?under\s+"
    r"|\bunder\s+the\s+terms\s+(?:and\s+conditions\s+)?of\s+|\baccording\s+to\s+"
    r"|^\W*this\s+(?:bundle|file|project|work|repository|software|package|skill)\s+is\s+under\s+)(?P<name>.*)$"
)
_AFTER = re.compile(r"\s*(?:\((?:see|cf\.?)\b[^)]*\)|[,;]\s*(?:\(c\)|©|copyright\b|see\b).*|\*/|-->|\"\"\"|''')\s*\.?\s*$", re.I)
_REFERS = re.compile(r"(?i)\b(?:see|refer|terms|governed|complete|found|root|file|shipped|text|consult|read|in|at|the|of|this|repository|repo|project|page|license|licence|copying|under|for|along|with|by|and|is|to|details|accompanying|top|level|folder|directory|parent|above|please|has|have|full|it|use)\b|[\W\d_]+")


def _names_nothing(text: str) -> bool:
    """Only words that refer to some other place."""
    return not _REFERS.sub("", _FILE_NAMED.sub(" ", text)).strip()


def stated(known: Known, text: str, evidence: str) -> Statement | None:
    """What the written name of a license says; None if it only refers to a file."""
    text = re.sub(r"\s+", " ", text).strip()
    while (shorter := _AFTER.sub("", text)) != text:
        text = shorter
    if not text.strip(" .,;:\"'"):
        return None
    if found := known.expression(text):
        return Statement(found, evidence)
    if _names_nothing(text):
        return None
    if _FILE_NAMED.search(text):  # "Proprietary. LICENSE.txt has complete terms"
        for sentence in re.split(r"(?<=[.;,])\s+|\s+[-–(]\s*", text):
            if found := known.expression(sentence):
                return Statement(found, evidence)
        if re.search(r"(?i)\b(?:see|complete terms|terms in|refer|governed)\b", text):
            return None
    return Statement(None, evidence)


def said_in_lines(known: Known, lines: list[str], evidence: str) -> Statement | None:
    """The first statement in lines of prose; a name may run on into the next line."""
    first = None
    for i, line in enumerate(lines):
        if not (m := _SAYS.search(line)):
            continue
        own = stated(known, m["name"], evidence)
        if (own is None or own.spdx is None) and i + 1 < len(lines) and lines[i + 1].strip():
            longer = stated(known, f"{m['name']} {lines[i + 1].strip()}", evidence)
            own = longer if longer and longer.spdx else own
        if own and own.spdx:
            return own
        first = first or own
    return first


# The comment marks of languages by extension (line marks; block marks).
_C = (("//",), (("/*", "*/"),))
MARKS = {
    "py": (("#",), (('"""', '"""'), ("'''", "'''"))), "sh": (("#",), ()), "bash": (("#",), ()), "rb": (("#",), (("=begin", "=end"),)),
    "yml": (("#",), ()), "yaml": (("#",), ()), "toml": (("#",), ()), "pl": (("#",), ()), "r": (("#",), ()),
    "sql": (("--",), (("/*", "*/"),)), "lua": (("--",), (("--[[", "]]"),)), "hs": (("--",), (("{-", "-}"),)),
    "js": _C, "ts": _C, "jsx": _C, "tsx": _C, "mjs": _C, "go": _C, "rs": _C, "java": _C, "c": _C, "h": _C, "cpp": _C, "cs": _C,
    "kt": _C, "swift": _C, "php": (("//", "#"), (("/*", "*/"),)), "css": ((), (("/*", "*/"),)), "scss": _C, "less": _C,
    "html": ((), (("<!--", "-->"),)), "htm": ((), (("<!--", "-->"),)), "xml": ((), (("<!--", "-->"),)), "svg": ((), (("<!--", "-->"),)),
    "md": ((), (("<!--", "-->"),)), "vue": (("//",), (("/*", "*/"), ("<!--", "-->"))),
}
_OTHER = (("#", "//", "--", ";", "%"), (("/*", "*/"), ("<!--", "-->"), ('"""', '"""')))


def comments(path: str, content: str) -> list[list[str]]:
    """The comment blocks of a file: runs of comment lines without their marks."""
    extension = path.rsplit("/", 1)[-1].rpartition(".")[2].lower()
    line_marks, block_marks = MARKS.get(extension, _OTHER)
    blocks: list[list[str]] = []
    run: list[str] = []
    close = None
    for line in content.split("\n"):
        text = line.strip()
        if close is not None:
            at = text.find(close)
            run.append((text if at < 0 else text[:at]).lstrip("* ").rstrip())
            if at >= 0:
                close = None
                blocks.append(run)
                run = []
            continue
        opened = next(((a, b) for a, b in block_marks if text.startswith(a)), None)
        mark = next((m for m in line_marks if text.startswith(m)), None)
        if opened:
            if run:
                blocks.append(run)
            inner = text[len(opened[0]) :]
            at = inner.find(opened[1])
            if at >= 0:
                blocks.append([inner[:at].strip("* ")])
                run = []
            else:
                close, run = opened[1], [inner.strip("* ")]
        elif mark:
            run.append(text.lstrip(mark[0] + "!").strip())
        else:
            if run:
                blocks.append(run)
                run = []
            for a, b in [(m, None) for m in line_marks] + list(block_marks):  # behind code, outside quotes
                at = line.find(f" {a}")
                if at > 0 and line[:at].count('"') % 2 == 0 and line[:at].count("'") % 2 == 0:
                    blocks.append([line[at + 1 + len(a) :].split(b)[0].strip() if b else line[at + 1 + len(a) :].strip()])
                    break
    if run:
        blocks.append(run)
    return blocks


def terms_in(known: Known, text: str, whole: bool = True) -> Statement | None:
    words = plain_words(_COPYRIGHT.sub(" ", text))
    return known.by_terms(" ".join(words), whole) if len(words) >= max(known.fewest, SHINGLE) else None


def of_license_file(known: Known, content: str) -> Statement | None:
    """What a license file states; None if it is blank or only refers elsewhere."""
    if _BLANK.fullmatch(content):
        return None
    lines = [x.strip().strip("#=*- ﻿") for x in content.split("\n")]
    named = said_in_lines(known, lines, "license-file")
    heading = next((x for x in lines if x and not _COPYRIGHT.fullmatch(x)), "")
    head_name = known.expression(heading) if heading else None
    body = [x for x in lines if x is not heading] if head_name else lines
    if found := terms_in(known, "\n".join(body)) or terms_in(known, "\n".join(lines)):
        return found
    if named and named.spdx:
        return named
    if head_name:
        return Statement(head_name, "license-file")
    if len(plain_words(content)) < TERMS_WORDS and _names_nothing(_COPYRIGHT.sub(" ", content)):
        return None
    return Statement(None, "license-file")


def of_readme(known: Known, content: str) -> Statement | None:
    """What the license section of a README states."""
    lines, section, depth = content.split("\n"), None, 0
    for i, line in enumerate(lines):
        text = line.strip()
        marked = re.match(r"(#{1,6})\s*(.*?)\s*#*$", text)
        underlined = i + 1 < len(lines) and re.fullmatch(r"[=\-~^]{3,}", lines[i + 1].strip() or " ") and text
        title = marked[2] if marked else text if underlined else None
        if section is None:
            if title is not None and re.match(r"(?i)\W*licen[sc](?:e|es|ing)\b", title):
                section, depth = [], len(marked[1]) if marked else 1 if lines[i + 1].strip()[0] == "=" else 2
            continue
        if title is not None:
            break
        if not re.fullmatch(r"[=\-~^]{3,}", text or " "):
            section.append(text)
    if section is None:
        return None
    said = said_in_lines(known, section, "readme")
    if said and said.spdx:
        return said
    if found := terms_in(known, "\n".join(section), whole=False):
        return Statement(found.spdx, "readme", found.coverage, found.altered)
    for line in section:
        for part in (line, _AFTER.sub("", line), *re.split(r"[,;]\s+|\.\s+", line)):
            if part.strip() and (found := known.expression(part)):
                return Statement(found, "readme")
    rest = " ".join(x for x in section if x and not _COPYRIGHT.fullmatch(x))
    if not rest or _names_nothing(rest):
        return None
    return said or stated(known, rest, "readme")


def of_frontmatter(known: Known, content: str) -> Statement | None:
    """What the license field of a SKILL.md's frontmatter states."""
    m = re.match(r"[﻿\s]*---[ \t]*\n(.*?)\n(?:---|\.\.\.)[ \t]*(?:\n|$)", content, re.S)
    field = m and re.search(r"(?im)^licen[sc]e[ \t]*:[ \t]*(.*(?:\n[ \t]+\S.*)*)$", m[1])
    if not field:
        return None
    value = field[1].strip()
    if value and value[0] in "\"'" and (end := value.rfind(value[0])) > 0:
        value = value[1:end]
    else:
        value = re.sub(r"\s+#.*$", "", value)
        value = re.sub(r"^[>|][+-]?\s*", "", value)
    if value.strip().lower() in ("", "~", "null"):
        return None
    said = _SAYS.search(value)
    return stated(known, said["name"] if said else value, "frontmatter")


def of_file(known: Known, path: str, content: str | None) -> tuple[str, Statement | None]:
    """(kind, statement): kind is license, readme or file."""
    base = path.rsplit("/", 1)[-1]
    text = (content or "").replace("\r\n", "\n").replace("\r", "\n")
    if LICENSE_FILE.fullmatch(base):
        return "license", of_license_file(known, text)
    if README_FILE.fullmatch(base):
        return "readme", of_readme(known, text) if "/" not in path else None
    if base.lower() == "skill.md":
        return "file", of_frontmatter(known, text)
    blocks = comments(path, text.lstrip("﻿"))
    first = None
    for block in blocks:
        said = said_in_lines(known, block, "comment")
        if said and said.spdx:
            return "file", said
        first = first or said
    if first is None:
        for block in blocks:
            if found := terms_in(known, "\n".join(block), whole=False):
                return "file", Statement(found.spdx, "comment", found.coverage, found.altered)
    return "file", first


STATED = "repo string, path string, kind string, says boolean, spdx string, evidence string, coverage double, altered string, at long"


def statements(files: DataFrame, known_texts: DataFrame) -> DataFrame:
    """STATED of each (repo, path), the latest crawl if there are several contents."""
    rows = known_texts.select("spdx", "title", "aliases", "license_text").limit(MAX_KNOWN + 1).collect()
    if len(rows) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known licenses")
    plain = [tuple(r) for r in rows]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(plain)
        for batch in batches:
            repo, path, content, at = (batch.column(i).to_pylist() for i in range(4))
            found = [of_file(known, p, c) for p, c in zip(path, content)]
            says = [s for _, s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(repo, pa.string()), pa.array(path, pa.string()), pa.array([k for k, _ in found], pa.string()),
                    pa.array([s is not None for s in says]), pa.array([s and s.spdx for s in says], pa.string()),
                    pa.array([s and s.evidence for s in says], pa.string()),
                    pa.array([s and s.coverage for s in says], pa.float64()),
                    pa.array([s and s.altered for s in says], pa.string()), pa.array(at, pa.int64()),
                ],
                [f.split()[0] for f in STATED.split(", ")],
            )

    used = files.where("repo is not null and path is not null and path <> ''")
    found = used.select("repo", "path", "content", F.unix_micros(F.col("crawled_at").cast("timestamp")).alias("at")).mapInArrow(read, STATED)
    latest = F.max_by(F.struct(*(c.split()[0] for c in STATED.split(", ")[2:])), F.struct(F.coalesce("at", F.lit(-(2**62))), "spdx"))
    return found.groupBy("repo", "path").agg(latest.alias("s")).select("repo", "path", "s.*")


def directory(path: Column) -> Column:
    """The directory of a path; '' for the root."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def _disjoint(sets: Column, other: Column | None = None) -> Column:
    """Whether some set of licenses in ``sets`` shares none with ``other`` (or with another of ``sets``)."""
    if other is not None:
        return F.exists(sets, lambda a: ~F.arrays_overlap(a, other))
    return F.exists(sets, lambda a: F.exists(sets, lambda b: ~F.arrays_overlap(a, b)))


def _licenses(spdx: Column) -> Column:
    return F.split(spdx, " (OR|AND) ")


def file_licenses(files: DataFrame, known_texts: DataFrame) -> DataFrame:
    """(repo, path, spdx, evidence, license_class, coverage, altered, verdict).

    One row for each file but license files and READMEs, and one for each
    repository with path ''.  The own statement comes first; then the nearest
    directory with a license file that states something; for the repository,
    then, and for files without any, the license section of the root's README.
    NOASSERTION stands for no statement, one that isn't recognised, and license
    files of one directory that differ.  verdict is conflict, unknown or clear.

    Null or empty contents state nothing.  Rows without a repo or path are left
    out.  Of repeated rows the latest crawl counts.  No known licenses: nothing
    is recognised.  Empty tables give an empty result.  Further columns are
    never read.
    """
    found = materialize(statements(files, known_texts), "statements")
    says = found.where("says")
    per_directory = (
        says.where("kind = 'license'")
        .groupBy("repo", directory(F.col("path")).alias("dir"))
        .agg(
            F.collect_set("spdx").alias("named"),
            F.count_if(F.col("spdx").isNull()).alias("others"),
            F.max("coverage").alias("coverage"),
            F.max("altered").alias("altered"),
        )
        .withColumn("dir_spdx", F.when((F.size("named") == 1) & (F.col("others") == 0), F.col("named")[0]).otherwise(NOASSERTION))
        .withColumn("sets", F.transform("named", _licenses))
        .select("repo", "dir", "dir_spdx", "sets", F.struct("coverage", "altered").alias("detail"))
    )
    readme = materialize(
        says.where("kind = 'readme'")
        .groupBy("repo")
        .agg(F.collect_set("spdx").alias("named"), F.count_if(F.col("spdx").isNull()).alias("others"))
        .select(
            "repo",
            F.when((F.size("named") == 1) & (F.col("others") == 0), F.col("named")[0]).otherwise(NOASSERTION).alias("readme_spdx"),
            F.transform("named", _licenses).alias("readme_sets"),
        ),
        "readmes",
    )  # written, so that a large repository's files can be split as a skewed join
    # the nearest directory with a statement, for each distinct directory of files
    own = found.where("kind = 'file'").withColumn("dir", directory(F.col("path")))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    depth = F.when(F.col("at_dir") == "", 0).otherwise(F.size(F.split("at_dir", "/")))
    places = own.select("repo", "dir").distinct().select("repo", F.col("dir").alias("from_dir"), F.explode(F.array_distinct(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(above))).alias("at_dir"))
    nearest = materialize(
        places.join(per_directory.withColumnRenamed("dir", "at_dir"), ["repo", "at_dir"])
        .groupBy("repo", F.col("from_dir").alias("dir"))
        .agg(F.max_by(F.struct("dir_spdx", "sets", "detail"), depth).alias("near")),
        "nearest",
    )
    files_read = (
        own.join(nearest, ["repo", "dir"], "left").join(readme, "repo", "left")
        .select(
            "repo", "path", "says", F.col("spdx").alias("own_spdx"), F.struct("coverage", "altered").alias("own_detail"), "evidence", "near",
            "readme_spdx", F.lit(None).cast("array<array<string>>").alias("counted"),
        )
    )
    root = per_directory.where("dir = ''").select("repo", F.struct("dir_spdx", "sets", "detail").alias("near"))
    repos = (
        found.select("repo").distinct().join(root, "repo", "left").join(readme, "repo", "left")
        .select(
            "repo", F.lit("").alias("path"), F.lit(False).alias("says"), F.lit(None).cast("string").alias("own_spdx"),
            F.lit(None).cast("struct<coverage:double,altered:string>").alias("own_detail"), F.lit(None).cast("string").alias("evidence"), "near",
            "readme_spdx", F.col("readme_sets").alias("counted"),
        )
    )
    every = files_read.unionByName(repos)
    none = F.array().cast("array<array<string>>")
    sets = F.concat(
        F.coalesce("near.sets", none), F.coalesce("counted", none),
        F.when(F.col("own_spdx").isNotNull(), F.array(_licenses(F.col("own_spdx")))).otherwise(none),
    )
    spdx = (
        F.when(F.col("says"), F.coalesce("own_spdx", F.lit(NOASSERTION)))
        .when(F.col("near").isNotNull(), F.col("near.dir_spdx"))
        .otherwise(F.coalesce("readme_spdx", F.lit(NOASSERTION)))
    )
    evidence = (
        F.when(F.col("says"), F.col("evidence")).when(F.col("near").isNotNull(), "license-file").when(F.col("readme_spdx").isNotNull(), "readme").otherwise("none")
    )
    detail = F.when(F.col("says"), F.col("own_detail")).otherwise(F.col("near.detail"))
    out = every.select(
        "repo", "path", spdx.alias("spdx"), evidence.alias("evidence"), detail.getField("coverage").alias("coverage"),
        detail.getField("altered").alias("altered"),
        F.when(_disjoint(sets), "conflict").when(spdx == NOASSERTION, "unknown").otherwise("clear").alias("verdict"),
    )
    ranks = {"allow": 0, "conditional": 1, "deny": 2}
    classes = {r.spdx: ranks.get(r.license_class, 2) for r in known_texts.select("spdx", "license_class").limit(MAX_KNOWN).collect() if r.spdx}
    if not classes:
        return out.withColumn("license_class", F.lit("unknown"))
    table = F.create_map(*(F.lit(x) for pair in classes.items() for x in pair))
    strictest = F.array_max(F.transform(_licenses(F.col("spdx")), lambda s: F.try_element_at(table, s)))
    return out.withColumn("license_class", F.coalesce(F.try_element_at(F.array(*map(F.lit, ranks)), strictest + 1), F.lit("unknown")))
