"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.session import scratch_dir

# Fixed value: what counts as a word everywhere in this subpackage.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    The table outlives lost executors and is not computed again.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a document is kept for testing: crc32 of its id, as text, modulo ``folds``."""
    remainder = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
    return remainder == fold


def words(text: Column) -> Column:
    """The words of a text; none of a null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def worker_state() -> dict:
    """What a Python worker keeps between its tasks (caches only, never results)."""
    name = "_pricetide_worker"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def tidy(function):
    """A function over Arrow batches that gives its memory back when a task ends.

    Workers live on between tasks, and what their allocators keep would add up.
    """

    def run(batches):
        import ctypes

        import pyarrow

        try:
            yield from function(batches)
        finally:
            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run
