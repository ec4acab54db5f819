"""Intermediate tables in the folder that all executors share.

Iterative and multi-pass operators cut their lineage by writing a table and
reading it back.  The folder is the one the session names in
``spark.checkpoint.dir``; it is read from the session and set here only where
it is unset and the session is local (as in tests).  A lost executor costs a
re-read, never a recomputation of the whole lineage.
"""

from __future__ import annotations

import atexit
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CODEC = "zstd"
_written: list[tuple[object, str]] = []
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, as a Hadoop path."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="siltstone-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", _CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    register_path(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A scan's rows over all cores, if it has fewer splits than there are cores (a small table in one file).

    Tables of many splits stay as they are: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if 0 < splits < cores else df


def register_path(spark: SparkSession, path: str) -> None:
    """Have ``path`` deleted with the other tables of this process."""
    if (spark, path) not in _written:
        _written.append((spark, path))


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def write_bytes(spark: SparkSession, name: str, data: bytes, keep: bool = False) -> str:
    """Write a file whole; gives its path.  ``name`` is a path to ``keep``, else a name in the shared folder."""
    path = name if keep else f"{shared_dir(spark)}/{name}"
    fs, unfinished = _file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(unfinished)
    stream.write(bytearray(data))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, kinds = hadoop.Path(path), getattr(hadoop, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kinds, 1)
    over[0] = kinds.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(unfinished, target, over)
    if not keep:
        register_path(spark, path)
    return path


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file, read here: no job."""
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """What is in a folder, but for unfinished and hidden files; nothing if there is none."""
    fs, target = _file_system(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    return [n for n in found if not n.endswith(".tmp") and n[:1] not in "._"]


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def ship(spark: SparkSession) -> None:
    """Have the executors fetch this package, once per application, so that nothing need be installed there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root, packed = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, f"{root.name}/{source.relative_to(root).as_posix()}")
    sc.addPyFile(write_bytes(spark, f"{root.name}-{uuid.uuid4().hex}.zip", packed.getvalue()))
    _shipped.add(sc.applicationId)


def drop_tables() -> None:
    """Delete the tables written by this process (also run at its end)."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
        except Exception:  # the session may be gone; the folder's owner cleans up then
            pass


atexit.register(drop_tables)
