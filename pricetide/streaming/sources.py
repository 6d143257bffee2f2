"""Streams over folders that batches are dropped into."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.session import path_exists
from pricetide.sources.readers import RAW_PRICES, accepted_prices, clean_prices, with_reject_reason
from pricetide.streaming.sinks import batch_folder, run_available

BATCH_BYTES = 256 * 1024 * 1024


def stream_table(
    spark: SparkSession, path: str, schema, batch_bytes: int = BATCH_BYTES, batch_files: int | None = None
) -> DataFrame:
    """New Parquet files of a folder; the size of a micro-batch is limited, so a
    backlog is worked off in parts and no key can fill a task with it.

    ``batch_files`` limits it by files instead, as for a folder that
    :func:`pricetide.streaming.admission.replay_in_slices` has written."""
    limit = ("maxBytesPerTrigger", batch_bytes) if batch_files is None else ("maxFilesPerTrigger", batch_files)
    return spark.readStream.schema(schema).option(*limit).parquet(path)


MALFORMED = "_malformed"


def _stream_raw_prices(spark: SparkSession, path: str, header: bool, batch_bytes: int) -> DataFrame:
    return (
        spark.readStream.schema(T.StructType([*RAW_PRICES.fields, T.StructField(MALFORMED, T.StringType())]))
        .option("header", header)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("maxBytesPerTrigger", batch_bytes)
        .csv(path)
    )


def stream_prices_csv(
    spark: SparkSession, path: str, header: bool = True, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Cleaned observations from new price files; :func:`ingest_prices` keeps the unreadable rows."""
    raw = _stream_raw_prices(spark, path, header, batch_bytes)
    return accepted_prices(clean_prices(raw.where(F.col(MALFORMED).isNull()).drop(MALFORMED)))


def ingest_prices(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    header: bool = True,
    batch_bytes: int = BATCH_BYTES,
) -> None:
    """Take in the price files that are new; every line ends up accepted or rejected.

    Accepted rows go to ``rejected=false`` of their batch's folder, others, with the texts as
    they were and a ``reason``, to ``rejected=true``.  Both are one write and appear together;
    a repeated batch is skipped.  :func:`read_ingested` reads either part.
    """
    lines = with_reject_reason(_stream_raw_prices(spark, path, header, batch_bytes), MALFORMED)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(batch.sparkSession, out, checkpoint, batch_id)
        if not path_exists(batch.sparkSession, f"{folder}/_SUCCESS"):
            batch.write.mode("overwrite").partitionBy("rejected").parquet(folder)

    run_available(lines, out, checkpoint, write=write)


def read_ingested(spark: SparkSession, out: str, rejected: bool) -> DataFrame:
    """The accepted or the rejected rows of all batches; only their files are read."""
    empty = spark.createDataFrame([], RAW_PRICES).withColumn(MALFORMED, F.lit(None).cast("string"))
    schema = with_reject_reason(empty, MALFORMED).schema
    lines = spark.read.schema(schema).parquet(out) if path_exists(spark, out) else spark.createDataFrame([], schema)
    part = lines.where(F.col("rejected") == rejected).drop("rejected", "run", "batch_id")
    return part if rejected else part.drop("reason", "price_text", "time_text", MALFORMED)


def with_event_time(rows: DataFrame, delay: str, at: str = "observed_at") -> DataFrame:
    """Make ``at`` a zoned timestamp and let rows be late by ``delay``."""
    return rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
