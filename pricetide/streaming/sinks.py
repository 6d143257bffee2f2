"""Sinks that write every micro-batch exactly once."""

from __future__ import annotations

import json
import threading
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from pricetide.session import path_exists, read_text


class LateRows(RuntimeError):
    """A stateful operator dropped rows that came after its watermark."""


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to; a new checkpoint has a new one."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def batch_folder(spark: SparkSession, path: str, checkpoint: str, batch_id: int) -> str:
    """Folders of one output belong to a checkpoint and a batch of it."""
    return f"{path}/run={run_id(spark, checkpoint)}/batch_id={batch_id}"


def batch_writer(path: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to a folder named after its checkpoint and number.

    A batch repeated after a failure is skipped if its folder is complete, so that
    streams reading the folder never see its rows twice, and else written anew.  A
    new checkpoint writes beside the old one's batches, not in their place.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(batch.sparkSession, path, checkpoint, batch_id)
        if not path_exists(batch.sparkSession, f"{folder}/_SUCCESS"):
            batch.write.mode("overwrite").parquet(folder)

    return write


class DroppedRows(StreamingQueryListener):
    """Counts rows dropped behind the watermark over every batch of a run.

    A query keeps the progress of its last batches only, so its own record is no account
    of a long run.
    """

    def __init__(self) -> None:
        self._dropped: Counter[str] = Counter()
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._change:
            self._dropped[str(progress.runId)] += sum(x.numRowsDroppedByWatermark for x in progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def of(self, run: str, patience: float = 60.0) -> int:
        """The count of a run, once Spark has told of its end."""
        with self._change:
            if not self._change.wait_for(lambda: run in self._ended, patience):
                raise TimeoutError(f"no end of run {run} was reported")
            return self._dropped[run]


def run_available(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    write: Callable[[DataFrame, int], None] | None = None,
    allow_late: bool = False,
) -> int:
    """Process what is there now into ``path`` and stop; the number of rows dropped as late.

    Rows behind the watermark are dropped by Spark without a trace, so any of them
    is an error unless ``allow_late``.  To keep them, let the stream go through
    :func:`pricetide.streaming.admission.admit` first.
    """
    streams = stream.sparkSession.streams
    listener = DroppedRows()
    streams.addListener(listener)
    try:
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(write or batch_writer(path, checkpoint))
            .start()
        )
        query.awaitTermination()
        dropped = listener.of(str(query.runId))
    finally:
        streams.removeListener(listener)
    if dropped and not allow_late:
        raise LateRows(f"{dropped} rows came after the watermark; see {checkpoint}")
    return dropped


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """All rows written so far, without their batch number."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_latest(spark: SparkSession, path: str, schema, keys: Sequence[str]) -> DataFrame:
    """The newest version of each key, of a stream written in update mode.

    Versions of different checkpoints cannot be put in order, so there may be only one.
    """
    rest = [c for c in schema.names if c not in keys]
    added = [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    versions = spark.read.schema(T.StructType([*schema.fields, *added])).parquet(path)
    if len(versions.select("run").distinct().limit(2).collect()) > 1:
        raise ValueError(f"{path} holds updates of more than one checkpoint")
    return (
        versions.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "batch_id").alias("_latest"))
        .select(*keys, "_latest.*")
    )
