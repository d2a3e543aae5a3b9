"""Pieces that the training-data operators share: staged tables, words, column checks."""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule; a word is a run of anything else.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: ASCII separators that ``str.split()`` takes and the word rule does not.
ODD_SPLIT = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
GAP = re.compile("[ \t-\r]+")

_folders: dict[str, SparkSession] = {}


def split_words(text: str) -> list[str]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    if ODD_SPLIT.search(text):
        return [w for w in GAP.split(text) if w]
    return text.split()


def words_of(text: Column) -> Column:
    """Array of the words of a text column; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: the cluster's spark.checkpoint.dir, our own only where that is unset and all run on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not named:
        named = "/tmp/checkpoints"
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def drop_folder(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _drop_all() -> None:
    for path, spark in list(_folders.items()):
        try:
            drop_folder(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone; the folder then stays for the cluster's own sweep
            pass
        _folders.pop(path, None)


atexit.register(_drop_all)


#: Setting that lets ``free_shuffles`` collect the driver's garbage at once; without it Spark's cleaner takes its own time (spark.cleaner.periodicGC.interval).
COLLECT_SETTING = "spark.contigo.collectGarbage"


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files whose plans nobody holds any more: it works by garbage collection."""
    gc.collect()
    if spark.conf.get(COLLECT_SETTING, "true") == "true":
        spark._jvm.System.gc()


def give_back() -> None:
    """Return to the machine what Arrow and the C library hold of freed memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def lean(function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of batches, after which its worker gives free memory back: workers stay for later stages, several of them to an executor."""

    @functools.wraps(function)
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


class Staging:
    """Tables written to the shared folder. They cut lineage and survive a lost executor.

    Each table is a Parquet folder; ``drop`` removes one that is no longer read, and all
    that remain go when the driver exits (results are lazy, so they may still read them).
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        _folders[self.root] = spark

    def write(self, df: DataFrame, name: str, free: bool = False, few: bool = False) -> DataFrame:
        """Write a table and return its reader. free: also let Spark delete shuffle files nobody needs any more.
        few: a table of few columns, for which two tasks and files a core, or a sixteenth of the shuffle's partitions, are enough."""
        path, schema = f"{self.root}/{name}", df.schema
        if few:
            df = df.coalesce(max(2 * self.spark.sparkContext.defaultParallelism, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 16))
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        if free:
            del df
            free_shuffles(self.spark)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            drop_folder(self.spark, f"{self.root}/{name}")


def text_docs(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and the named columns only, so that other columns can't clash."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
