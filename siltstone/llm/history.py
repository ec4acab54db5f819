"""New batches checked against all accepted history, each batch once.

The history is a folder that outlives the session: bucketed tables that only
grow, a partition per batch.

* ``digests``: normalised content digest, earliest arrival;
* ``parts``: hashes of paragraphs (lines and sentences in plain words), of all
  a text's paragraphs together, and of all but one, each with the words of the
  shortest text that has it;
* ``bags``: each distinct text as a bag of words, with its earliest arrival;
* ``keys``: the MinHash band keys under which an edited text is found again.

A batch is hashed once and shuffled to the history's buckets; the history side
of each join is read bucket by bucket and never moved, aggregated or hashed
again.  Three routes decide, each for what the ones before left open:

1. the digest was seen earlier;
2. an earlier text shares paragraphs with so many words that the two must be
   near: hashes alone decide this, no text is compared;
3. the rest, texts with edits in several paragraphs, meets by band keys (which
   need no statistics, so those of all batches compare) and is compared exactly.

Then the batch's hashes are appended.  A batch is committed by one marker, the
last file written; what an unfinished batch left is removed when the history is
next opened or asked, and a batch that is already committed gives its stored
result, so a batch can be repeated after any failure.  One writer at a time.

No side of a join goes through the driver, not even one small enough to be
broadcast: of those a check would make dozens.
"""

from __future__ import annotations

import io
import json
import uuid
from dataclasses import asdict, dataclass
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import storage
from siltstone.llm import bags as B
from siltstone.llm import nearpairs as N
from siltstone.storage import materialize

TABLES = {  # columns and the one that places a row in its bucket
    "digests": ("digest string, first bigint", "digest"),
    "parts": ("part bigint, m int, first bigint", "part"),
    "bags": ("bag_id bigint, proof bigint, bag string, first bigint", "bag_id"),
    "keys": ("key bigint, bag_id bigint, s1 bigint, s2 bigint, role tinyint", "key"),
}
RESULT = "item string, at bigint, copied boolean, coverage double, covered boolean, near boolean"
NO_TEXT = 1 << 30  # words of a text that is near nothing


def merged(df: DataFrame) -> DataFrame:
    """A side of a join that isn't broadcast, however small it is."""
    return df.hint("merge")


def paragraphs(text: Column) -> Column:
    """The words of each paragraph: lines and sentences with a word in them."""
    pieces = F.split(F.coalesce(text, F.lit("")), r"[\r\n]+|(?<=[.!?])\s+")
    return F.filter(F.transform(pieces, B.words_of), lambda w: F.size(w) > 0)


def parts(hashed: Column, every: Column, total: Column, n: Column, t: Fraction) -> Column:
    """(part, s, single) of a text of n words: each paragraph; all; all but one, if they have s >= t * n words.

    ``hashed``: distinct (h, s) of the paragraphs; ``every``: all h together; ``total``: all s.
    """
    part = lambda h, s, single: F.struct(h.alias("part"), s.alias("s"), F.lit(single).alias("single"))
    none = F.array().cast("array<struct<part:bigint,s:int,single:boolean>>")
    enough = lambda p: p.s * t.denominator >= n * t.numerator
    return F.concat(
        F.transform(hashed, lambda p: part(p.h, p.s, True)),
        F.when(F.size(hashed) > 1, F.filter(F.array(part(every, total, False)), enough)).otherwise(none),
        F.when(F.size(hashed) > 2, F.filter(F.transform(hashed, lambda p: part(every.bitwiseXOR(p.h), total - p.s, False)), enough)).otherwise(none),
    )


@dataclass
class Settings:
    threshold: float = 0.7
    min_words: int = 8
    bands: int = 26
    rows: int = 4
    buckets: int | None = None  # of the history's tables, for good; by default the session's shuffle partitions, 16 at least
    hot: int = N.HOT


class History:
    """Accepted records in a folder.  ``check`` must see batches in the order of arrival.

    An existing folder is opened with the settings it was made with.  Without a
    path the history lives in the session's shared folder and ends with the process.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, settings: Settings | None = None):
        self.spark = spark
        if path is None:
            path = f"{storage.shared_dir(spark)}/history-{uuid.uuid4().hex}"
            storage.register_path(spark, path)
        self.path, self.session_name = path.rstrip("/"), f"history_{uuid.uuid4().hex}"
        self._seen: tuple[int, list[int]] | None = None  # generation and batches that the session's tables have for certain
        if not storage.exists(spark, f"{self.path}/history.json"):
            s = settings or Settings()
            s.buckets = s.buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16)
            self._describe(s, 0)
        described = json.loads(storage.read_bytes(spark, f"{self.path}/history.json"))
        self.settings, self.generation = Settings(**described["settings"]), described["generation"]
        self._recover()

    # ------------------------------------------------------------ files

    def _describe(self, settings: Settings, generation: int) -> None:
        text = json.dumps({"settings": asdict(settings), "generation": generation})
        storage.write_bytes(self.spark, f"{self.path}/history.json", text.encode(), keep=True)

    def _folder(self, name: str) -> str:
        return f"{self.path}/gen{self.generation}/{name}"

    def _name(self, name: str) -> str:
        return f"{self.session_name}_{self.generation}_{name}"

    def _recover(self) -> None:
        """Read which batches are committed; remove what others left.  The session's tables are made again if they may differ."""
        numbers = {int(n.split(".")[0]): n for n in storage.names(self.spark, f"{self.path}/commits")}
        self.committed = {storage.read_bytes(self.spark, f"{self.path}/commits/{f}").decode(): n for n, f in sorted(numbers.items())}
        for generation in storage.names(self.spark, self.path):
            if generation.startswith("gen") and generation != f"gen{self.generation}":
                storage.remove(self.spark, f"{self.path}/{generation}")
        for name in (*TABLES, "results"):
            for folder in storage.names(self.spark, self._folder(name)):
                if folder.startswith("batch=") and folder != "batch=-1" and int(folder[6:]) not in numbers:
                    storage.remove(self.spark, f"{self._folder(name)}/{folder}")
        if self._seen != (self.generation, sorted(numbers)):
            self._make_tables()
            self._seen, self._n_bags = (self.generation, sorted(numbers)), None if numbers else 0  # None: not counted yet
        self.number = max(numbers, default=-1) + 1
        self.refining = None
        for file in sorted(storage.names(self.spark, f"{self.path}/refining"), key=lambda f: int(f.split(".")[0])):
            if int(file.split(".")[0]) in numbers:
                data = np.load(io.BytesIO(storage.read_bytes(self.spark, f"{self.path}/refining/{file}")))
                self.refining = N.Refining(data["keys"], data["frequent"], data["place"])

    def _make_tables(self) -> None:
        for name, (columns, key) in TABLES.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(name)}")
            self.spark.sql(
                f"CREATE TABLE {self._name(name)} ({columns}, batch int) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (batch) "
                f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.settings.buckets} BUCKETS LOCATION '{self._folder(name)}'"
            )
            if storage.exists(self.spark, self._folder(name)):
                self.spark.catalog.recoverPartitions(self._name(name))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.table(self._name(name))

    def _append(self, name: str, rows: DataFrame, number: int | None = None, to: str | None = None) -> None:
        key = TABLES[name][1]
        writer = rows.withColumn("batch", F.lit(self.number if number is None else number)).repartition(self.settings.buckets, key).write.mode("append")
        writer = writer.partitionBy("batch").bucketBy(self.settings.buckets, key).sortBy(key).option("compression", "zstd")
        writer.option("path", to or self._folder(name)).saveAsTable(self._name(name) + ("_next" if to else ""))

    def compact(self) -> None:
        """All batches' files into one per bucket.  The new tables count from the moment the description names them."""
        to = self.generation + 1
        storage.remove(self.spark, f"{self.path}/gen{to}")
        for name in TABLES:
            folders = [f"{self._folder(name)}/{n}" for n in storage.names(self.spark, self._folder(name))]
            if not folders:
                continue
            kept = self.spark.read.schema(TABLES[name][0]).parquet(*folders)
            self._append(name, kept.where("role <> 2") if name == "keys" else kept, -1, f"{self.path}/gen{to}/{name}")
            self.spark.sql(f"DROP TABLE {self._name(name)}_next")
        results = f"{self._folder('results')}"
        if storage.exists(self.spark, results):
            self.spark.read.schema(RESULT + ", batch int").parquet(results).write.partitionBy("batch").parquet(f"{self.path}/gen{to}/results")
        self._describe(self.settings, to)
        self.generation = to
        self._recover()

    # ------------------------------------------------------------ batches

    def check(self, batch: DataFrame, batch_id: str | None = None) -> DataFrame:
        """Check a batch (item, digest, text, at) and accept it.

        Gives (item, at, copied, coverage, covered, near) of each distinct item
        and arrival: whether something that arrived strictly earlier, in this
        batch or any before, has its digest; the share of its paragraphs that an
        earlier record has; whether shared paragraphs show an earlier text to be
        near; whether, where none of these decides, an earlier text is near its
        own (an equal text is).  A batch id that was accepted before gives the
        result of then.  Rows without an item or arrival are not checked and not
        accepted.  A null digest matches nothing; a text without paragraphs has
        coverage 0; one with fewer than ``min_words`` words is near nothing.
        Repeated rows count once; an empty batch gives an empty result.
        """
        batch_id = batch_id or uuid.uuid4().hex
        self._recover()
        if batch_id not in self.committed:
            (generation, before), self._seen = self._seen, None  # a batch that breaks off leaves the tables unknown
            found = self._checked(batch)
            found.write.option("compression", "zstd").parquet(f"{self._folder('results')}/batch={self.number}")
            self._refine()
            storage.write_bytes(self.spark, f"{self.path}/commits/{self.number}.txt", batch_id.encode(), keep=True)
            self._seen = (generation, [*before, self.number])
            self._recover()
        return self.spark.read.schema(RESULT).parquet(f"{self._folder('results')}/batch={self.committed[batch_id]}")

    def _checked(self, batch: DataFrame) -> DataFrame:
        s = self.settings
        t = Fraction(s.threshold).limit_denominator(1000)
        batch = batch.select(F.col("item").cast("string").alias("item"), "digest", "text", F.col("at").cast("long").alias("at"))
        batch = batch.where("item is not null and at is not null").distinct().withColumn("w", paragraphs(F.col("text"))).drop("text")
        hashed = F.array_distinct(F.transform("w", lambda w: F.struct(F.xxhash64(F.array_join(w, " ")).alias("h"), F.size(w).alias("s"))))
        words = F.flatten("w")
        batch = batch.select("item", "at", "digest", F.size(words).alias("n"), F.array_join(F.sort_array(words), " ").alias("bag"), hashed.alias("hashed"))
        every = F.aggregate("hashed", F.lit(0).cast("long"), lambda a, p: a.bitwiseXOR(p.h))
        total = F.aggregate("hashed", F.lit(0), lambda a, p: a + p.s)
        batch = batch.select("item", "at", "digest", "n", "bag", "hashed", every.alias("every"), total.alias("total"))
        long_enough = F.col("n") >= s.min_words
        batch = materialize(
            batch.select(
                "item", "at", "digest", "n", F.when(long_enough, F.col("bag")).alias("bag"), F.when(long_enough, F.xxhash64("bag")).alias("bag_id"),
                parts(F.col("hashed"), F.col("every"), F.col("total"), F.col("n"), t).alias("parts"),
            ),
            "batch",
        )
        copied = self._copied(batch)
        covered = self._covered(batch, t)
        keys = ["item", "at"]
        routed = (
            batch.select(*keys, "bag_id").join(merged(copied.withColumn("copied", F.lit(True))), keys, "left").join(merged(covered), keys, "left")
            .select(*keys, "bag_id", *(F.coalesce(c, F.lit(d)).alias(c) for c, d in (("copied", False), ("coverage", 0.0), ("covered", False))))
        )
        routed = materialize(routed, "routed")
        near = self._near(batch, routed).withColumn("near", F.lit(True))
        out = routed.groupBy(*keys).agg(*(F.max(c).alias(c) for c in ("copied", "coverage", "covered")))
        return out.join(merged(near), keys, "left").withColumn("near", F.coalesce("near", F.lit(False)))

    def _copied(self, batch: DataFrame) -> DataFrame:
        """Distinct (item, at) whose digest arrived earlier."""
        digests = batch.where("digest is not null").select("item", "at", "digest")
        own = digests.groupBy("digest").agg(F.min("at").alias("first"))
        known = self.table("digests").select("digest", F.col("first").alias("before"))
        own = own.join(merged(known), "digest", "left").select("digest", F.least("first", "before").alias("first"), F.col("before").isNotNull().alias("known"))
        own = materialize(own, "digests")  # a written side: a hot digest's rows can be split as a skewed join
        self._append("digests", own.where("not known").select("digest", "first"))
        return digests.join(merged(own), "digest").where("first < at").select("item", "at").distinct()

    def _covered(self, batch: DataFrame, t: Fraction) -> DataFrame:
        """(item, at, coverage, covered) of the items with paragraphs.

        Two texts of n and m words that share paragraphs with s words are near
        for certain if s >= t * (n + m - s).  Of each part the shortest and the
        earliest text are kept, so no pairs of texts are made.
        """
        each = batch.select("item", "at", "n", F.inline("parts"))
        m = F.when(F.col("n") >= self.settings.min_words, F.col("n")).otherwise(NO_TEXT).alias("m")
        own = each.select("part", m, "at").groupBy("part").agg(F.min(F.struct("m", F.col("at").alias("first"))).alias("least"), F.min("at").alias("first"))
        known = self.table("parts").select("part", F.struct("m", "first").alias("known"), F.col("first").alias("before"))
        seen = own.join(merged(known), "part", "left").groupBy("part").agg(
            F.first("least").alias("own"), F.min("known").alias("known"), F.min(F.least("first", "before")).alias("first")
        )
        seen = materialize(seen, "parts")
        better = F.col("known").isNull() | (F.col("own.m") < F.col("known.m"))
        self._append("parts", seen.where(better).select("part", "own.m", "own.first"))
        lookup = seen.select("part", "first", "own", "known")
        enough = lambda x: (
            F.col(x).isNotNull() & (F.col(f"{x}.first") < F.col("at")) & (F.col("n") >= self.settings.min_words)
            & (F.col("s").cast("long") * (t.denominator + t.numerator) >= (F.col("n") + F.col(f"{x}.m")) * F.lit(t.numerator).cast("long"))
        )
        early = F.when(F.col("single"), (F.col("first") < F.col("at")).cast("int"))
        return each.join(merged(lookup), "part").groupBy("item", "at").agg(
            F.avg(early).alias("coverage"), F.coalesce(F.bool_or(enough("own") | enough("known")), F.lit(False)).alias("covered")
        )

    def _near(self, batch: DataFrame, routed: DataFrame) -> DataFrame:
        """Distinct (item, at) left open so far that an earlier text is near."""
        s = self.settings
        left = routed.where("bag_id is not null and not copied and not covered").select("bag_id", "at").groupBy("bag_id").agg(F.min("at").alias("open"))
        own = batch.where("bag_id is not null").groupBy("bag_id").agg(
            F.first("bag").alias("bag"), F.min("at").alias("first"), F.min(F.xxhash64("bag", F.lit(1))).alias("proof"), F.max(F.xxhash64("bag", F.lit(1))).alias("other")
        )
        known = self.table("bags").select("bag_id", F.col("proof").alias("_proof"), F.col("first").alias("before"))
        own = own.join(merged(known), "bag_id", "left").join(merged(left), "bag_id", "left").select(
            "bag_id", "bag", "proof", F.least("first", "before").alias("first"), F.col("before").isNotNull().alias("known"),
            F.coalesce(F.col("open") <= F.least("first", "before"), F.lit(False)).alias("probe"),
            ((F.col("proof") != F.col("other")) | F.coalesce(F.col("proof") != F.col("_proof"), F.lit(False))).alias("clash"),
        )
        own = materialize(own, "bags")
        clash, self._new_bags = own.agg(F.max("clash"), F.count_if(~F.col("known"))).first()
        if clash:
            raise RuntimeError("two texts have one 64-bit hash")
        self._append("bags", own.where("not known").select("bag_id", "proof", "bag", "first"))
        self._append("keys", N.band_rows(own.where("probe or not known"), s.bands, s.rows, self.refining, s.threshold, roles=True))

        keys, bags = self.table("keys"), self.table("bags")
        probes = N.side(keys.where((F.col("batch") == self.number) & (F.col("role") >= 2)), "a")
        met = probes.join(merged(N.side(keys.where("role <> 2"), "b")), "key").where("bag_id_a <> bag_id_b")
        pairs = met.where(N.sketches_allow(s.threshold)).select(F.col("bag_id_a").alias("a"), F.col("bag_id_b").alias("b"))
        links = N.verified(pairs.distinct(), merged(bags), s.threshold)
        partners = links.join(merged(bags.select(F.col("bag_id").alias("b"), "first")), "b").select(F.col("a").alias("bag_id"), "first")
        earlier = own.select("bag_id", "first").unionByName(partners).groupBy("bag_id").agg(F.min("first").alias("earlier"))
        earlier = materialize(earlier, "earlier")
        open_items = routed.where("bag_id is not null and not copied and not covered").select("item", "at", "bag_id")
        return open_items.join(merged(earlier), "bag_id").where("earlier < at").select("item", "at").distinct()

    def _refine(self) -> None:
        """Band keys that have become hot are stored refined from the next batch on; the order of elements is set once."""
        s, bags = self.settings, self.table("bags")
        sample = N.hot_sample(bags, s.hot)
        n = self._n_bags = bags.count() if self._n_bags is None else self._n_bags + self._new_bags
        if n <= s.hot:
            return
        ids = merged(sample.select("bag_id"))
        keys = N.hot_keys(self.table("keys").where("role <> 2").join(ids, "bag_id", "left_semi"), max(s.hot, 2 * s.bands * n // N.MAX_HOT_KEYS))
        if self.refining is not None:
            keys = np.union1d(keys, self.refining.keys)
            order = (self.refining.frequent, self.refining.place)
        elif len(keys):
            order = N.element_order(sample)
        else:
            return
        packed = io.BytesIO()
        np.savez(packed, keys=keys, frequent=order[0], place=order[1])
        storage.write_bytes(self.spark, f"{self.path}/refining/{self.number}.npz", packed.getvalue(), keep=True)


def check_in_batches(spark: SparkSession, arrived: DataFrame, batches: int = 3, settings: Settings | None = None) -> DataFrame:
    """``check`` over all of ``arrived`` (item, digest, text, at), cut into batches in the order of arrival.

    What is copied or near doesn't depend on the number of batches: inside a
    batch, too, only what arrived strictly earlier counts.
    """
    timed = materialize(arrived.where("at is not null"), "arrived")
    share = [i / batches for i in range(1, batches)]
    found = timed.agg(F.approx_percentile("at", share, 1000)).first()[0] if share else None
    cuts = [None, *sorted(set(found or [])), None]
    history = History(spark, settings=settings)
    out = None
    for after, until in zip(cuts, cuts[1:]):
        inside = (F.col("at") > after if after is not None else F.lit(True)) & (F.col("at") <= until if until is not None else F.lit(True))
        checked = history.check(timed.where(inside))
        out = checked if out is None else out.unionByName(checked)
    return out
