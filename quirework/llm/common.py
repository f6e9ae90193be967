"""What the operators share: scratch tables in the cluster's shared folder, Arrow helpers, column hygiene."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of rows that go to Python at once.
ARROW_BYTES = 8 << 20
#: Rows that a Python function works on at once.
ARROW_ROWS = 500
#: Ids that are broadcast, 32 MB of them.
BROADCAST = 4_000_000
#: What cached() holds.
_KEPT: dict = {}
#: Paths of scratch tables that release() may delete.
_SCRATCH: list[str] = []
#: The local folder of scratch tables, once one is made.
_LOCAL = ""


def prepare(spark: SparkSession) -> None:
    """Lets Python workers import this package, and bounds the batches that they get by bytes, here and nowhere else. It
    is a setting of the session, as plans are run after their operators return; a smaller one of the user's stays."""
    given = re.fullmatch(r"(\d+)b?", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))
    if given and not 0 < int(given[1]) <= ARROW_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{ARROW_BYTES}b")
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def slices(batches: Iterable[pa.RecordBatch], rows: int = ARROW_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts of at most so many rows. Spark bounds a batch by bytes; a part is what Python objects are made of.
    At the end what is free goes back to the system, as workers live on and the next task may be another operator's."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not of all C libraries
        ctypes.CDLL(None).malloc_trim(0)


def cached(key: object, build: Callable[[], object]) -> object:
    """What build() gives, kept in a worker from task to task until something else is asked for."""
    if _KEPT.get("key") != key:
        _KEPT.clear()
        _KEPT.update(key=key, value=build())
    return _KEPT["value"]


def chosen(df: DataFrame, ids: DataFrame, name: str, how: str) -> DataFrame:
    """df with (left_semi) or without (left_anti) the rows whose long column `name` is in ids, a small table. Up to
    BROADCAST ids go to where df is; more than that are joined."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST else ids, name, how)


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it is unset: a local one of this process if all runs on
    this machine, else the warehouse."""
    global _LOCAL
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        _LOCAL = found = _LOCAL or "file://" + tempfile.mkdtemp(prefix="quirework-")
    return (found or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def table(df: DataFrame, label: str, kept: bool = False) -> DataFrame:
    """Writes df to a scratch table and reads it back: lineage ends there, and lost executors cost no recomputation.
    kept: release() leaves it."""
    spark = df.sparkSession
    path = scratch_path(spark, label, kept)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, label: str, kept: bool = False) -> str:
    path = f"{scratch_root(spark)}/quirework-{label}-{uuid.uuid4().hex}"
    if not kept:
        _SCRATCH.append(path)
    return path


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget() -> None:
    """From now on release() leaves the scratch tables made so far."""
    _SCRATCH.clear()


def release(spark: SparkSession) -> None:
    """Deletes the scratch tables made in this process since forget(). For a pipeline, between stages: what a stage gave has been
    written by then, and nothing reads its scratch tables again."""
    while _SCRATCH:
        _delete(spark, _SCRATCH.pop())
    _collect(spark)


def _collect(spark: SparkSession) -> None:
    """Lets go of plans that nothing refers to, so that Spark deletes their shuffle files now and not when memory is short."""
    gc.collect()
    spark._jvm.System.gc()


def drop_table(df: DataFrame) -> None:
    """Deletes a scratch table that no later plan reads."""
    spark = df.sparkSession
    for name in {os.path.dirname(f) for f in df.inputFiles()}:
        if "/quirework-" in name:
            _delete(spark, name)
    _collect(spark)


def bytes_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the named columns under new names, found whatever else df holds; names: new to old."""
    return df.select(*[df[f"`{old}`"].alias(new) for new, old in names.items()])


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """df less columns whose names an operator is about to add."""
    low = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in low])


def word_count(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
