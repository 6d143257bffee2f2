"""Raw inputs: price and condition files, tables, run logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricetide.functions import scalars as S
from pricetide.session import path_exists

RAW_PRICES = T.StructType(
    [
        T.StructField("restaurant", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("scraped_at", T.StringType()),
        T.StructField("scrape_session_id", T.StringType()),
    ]
)

RAW_CONDITIONS = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("condition", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("is_rainy", T.BooleanType()),
        T.StructField("recorded_at", T.TimestampNTZType()),
        T.StructField("scrape_session_id", T.StringType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("last_status", T.StringType()),
        T.StructField("last_session_id", T.StringType()),
        T.StructField("last_scrape_time", T.StringType()),
        T.StructField("last_duration_minutes", T.IntegerType()),
        T.StructField("restaurants_scraped", T.IntegerType()),
        T.StructField("last_error_type", T.StringType()),
        T.StructField(
            "recent_logs",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("status", T.StringType()),
                        T.StructField("session_id", T.StringType()),
                        T.StructField("time", T.StringType()),
                        T.StructField("duration_minutes", T.IntegerType()),
                    ]
                )
            ),
        ),
    ]
)

# Fixed value: how captured files write a time.
MINUTE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}$"

# Raw column names and the names the operators use.
PRICE_NAMES: Mapping[str, str] = {
    "restaurant": "entity",
    "category": "category",
    "item_name": "item",
    "price": "price",
    "scraped_at": "observed_at",
    "scrape_session_id": "session_id",
}


def conform(frame: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns to the operators' names; others are kept."""
    return frame.withColumnsRenamed({raw: name for raw, name in names.items() if raw != name})


def read_prices_csv(spark: SparkSession, path, header: bool = True) -> DataFrame:
    """Price observations as text, exactly as captured, with their ``ordinal``.

    The ordinal says where a row stands: file name, start of the part of the file that one task
    reads, and the row's number in that task, which grows along the part.  It orders the rows as
    the files do, however they are read, with no shuffle.
    """
    raw = spark.read.schema(RAW_PRICES).option("header", header).csv(path)
    return raw.withColumn(
        "ordinal",
        F.struct(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("part"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_conditions_csv(spark: SparkSession, path, header: bool = False) -> DataFrame:
    return (
        spark.read.schema(RAW_CONDITIONS)
        .option("header", header)
        .option("timestampFormat", "yyyy-MM-dd HH:mm")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm")
        .csv(path)
        .withColumnRenamed("scrape_session_id", "session_id")
    )


def clean_prices(raw: DataFrame) -> DataFrame:
    """Typed observations with a ``rejected`` flag for unreadable prices or times.

    ``ordinal`` orders observations of an item made in the same minute, and must not change
    between runs.  Rows that have none, such as those of a stream, get a hash of the row.
    Times are read as they are written, whatever the session's zone.
    """
    named = conform(raw, PRICE_NAMES)
    if "ordinal" not in named.columns:
        named = named.withColumn("ordinal", F.xxhash64(*[c for c in PRICE_NAMES.values()]))
    return (
        named
        .withColumns(
            {
                "price": S.currency_to_int(F.col("price")),
                "observed_at": F.when(
                    F.col("observed_at").rlike(MINUTE), F.col("observed_at").try_cast("timestamp_ntz")
                ),
            }
        )
        .withColumn("rejected", F.col("price").isNull() | F.col("observed_at").isNull())
    )


def accepted_prices(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(~F.col("rejected")).drop("rejected")


def rejected_prices(cleaned: DataFrame) -> DataFrame:
    return cleaned.where("rejected").drop("rejected")


def with_reject_reason(raw: DataFrame, malformed: str) -> DataFrame:
    """Cleaned rows, all of them, with ``rejected`` and the ``reason``: malformed, price or time.

    ``price_text`` and ``time_text`` keep what was captured.
    """
    cleaned = clean_prices(
        raw.withColumns({"price_text": F.col("price"), "time_text": F.col("scraped_at")})
    )
    reason = (
        F.when(F.col(malformed).isNotNull(), "malformed")
        .when(F.col("price").isNull(), "price")
        .when(F.col("observed_at").isNull(), "time")
    )
    return cleaned.withColumn("reason", reason).withColumn("rejected", F.col("reason").isNotNull())


def run_status_files(spark: SparkSession, path: str, name: str = "([^/]+)$") -> DataFrame:
    """The state that each run-log file tells of, a row per file below ``path``.

    ``source`` is what ``name`` finds in the file's path.  ``state`` is ``ok``, ``empty`` or
    ``broken``; of files that are not ``ok`` the rest is NULL.  ``entries`` and ``successes`` count the
    recent logs, none of which may be there.  A file of white space is ``empty``; one of no
    bytes at all is not listed by Spark and has no row.
    """
    schema = T.StructType([*RUN_LOG.fields, T.StructField("_broken", T.StringType())])
    logs = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", "_broken")
        .option("recursiveFileLookup", True)
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )
    # names only: no content is read here
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    same = F.regexp_replace("path", "^file:/+", "/") == F.regexp_replace("file", "^file:/+", "/")
    state = F.when(F.col("file").isNull(), "empty").when(
        F.col("_broken").isNotNull(), "broken"
    )
    scalars = [f.name for f in RUN_LOG.fields if f.name != "recent_logs"]
    entries = F.coalesce(F.size("recent_logs"), F.lit(0))
    good = F.size(F.filter("recent_logs", lambda x: x["status"] == "success"))
    return files.join(logs, same, "left").select(
        F.regexp_extract("path", name, 1).alias("source"),
        F.coalesce(state, F.lit("ok")).alias("state"),
        *scalars,
        F.when(state.isNull(), F.greatest(entries, F.lit(0))).alias("entries"),
        F.when(state.isNull(), F.greatest(F.coalesce(good, F.lit(0)), F.lit(0))).alias("successes"),
    )


def read_run_log(spark: SparkSession, path) -> DataFrame:
    """Run logs, one row per log entry; a missing or broken file gives no rows."""
    if path_exists(spark, path):
        logs = spark.read.schema(RUN_LOG).option("multiLine", True).json(path)
    else:
        logs = spark.createDataFrame([], RUN_LOG)
    return logs.select("*", F.explode("recent_logs").alias("entry")).select(
        "restaurants_scraped", "last_error_type", "entry.*"
    )


def read_query(spark: SparkSession, sql: str, **arguments) -> DataFrame:
    """A query with named parameters over registered tables."""
    return spark.sql(sql, args=arguments or None)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    **options,
) -> DataFrame:
    """An external table, read in parallel ranges of ``partition_column``."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )


def with_missing_columns(older: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring older data to ``schema``: absent columns become NULL."""
    empty = older.sparkSession.createDataFrame([], schema)
    return empty.unionByName(older, allowMissingColumns=True)


def read_grown_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of different ages; columns that older files lack are NULL in their rows."""
    return spark.read.option("mergeSchema", True).parquet(path)
