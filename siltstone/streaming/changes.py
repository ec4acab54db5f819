"""Change capture and windows as streams; an extension, since the catalog's own stages are batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.changes import changes
from siltstone.storage import materialize, names


def crawl_changes(spark: SparkSession, directory: str, schema: str, checkpoint: str, sink: str, files_per_batch: int = 1, slots: int = 64) -> None:
    """Each new crawl file is compared with the state so far; changes go to ``sink``/changes, a folder per batch.

    Runs over what is there and stops.  The state, the latest row per id, lies in
    ``sink``/state: a batch writes only the slots (hashes of ids) that it
    touches, under its number, and the newest number of a slot counts.  State and
    changes outlive the process; a batch that is repeated after a failure sees
    only what came before it, so it gives the same files again.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(directory)
    state = f"{sink}/state"

    def before(number: int) -> dict[int, int]:
        """The newest batch before this one of each slot."""
        newest: dict[int, int] = {}
        for folder in names(spark, state):
            if folder.startswith("batch=") and int(folder[6:]) < number:
                for slot in names(spark, f"{state}/{folder}"):
                    if slot.startswith("slot="):
                        newest[int(slot[5:])] = max(newest.get(int(slot[5:]), -1), int(folder[6:]))
        return newest

    def step(batch: DataFrame, number: int) -> None:
        new = materialize(batch.where("id is not null").dropDuplicates(["id"]).withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(slots)).cast("int")), "batch")
        touched = [r.slot for r in new.select("slot").distinct().collect()]  # at most ``slots``
        paths = [f"{state}/batch={n}/slot={s}" for s, n in before(number).items() if s in touched]
        prev = spark.read.schema(batch.schema).parquet(*paths) if paths else batch.limit(0)
        seen = prev.join(new.select("id"), "id", "left_semi")
        changes(seen, new.drop("slot")).write.mode("overwrite").parquet(f"{sink}/changes/batch={number}")
        kept = prev.join(new.select("id"), "id", "left_anti").withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(slots)).cast("int"))
        kept.unionByName(new).write.mode("overwrite").partitionBy("slot").parquet(f"{state}/batch={number}")

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def event_windows(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window_start, kind, n) of a stream or table of events; later than ``late`` is dropped from a stream."""
    watched = events.withWatermark(time, late) if events.isStreaming else events
    counted = watched.groupBy(F.window(time, width), kind).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), kind, "n")
