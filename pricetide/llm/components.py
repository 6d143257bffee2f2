"""Connected components of a graph that no machine holds whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import scratch_dir
from pricetide.session import remove_path


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _lowest(pairs: DataFrame, include_self: bool) -> DataFrame:
    """Each vertex's smallest neighbour, itself included if wanted; one row per vertex."""
    low = pairs.groupBy("u").agg(F.min("v").alias("low"))
    return low.withColumn("low", F.least("u", "low")) if include_self else low


def connected(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``vertex, component`` for every vertex of the edges ``a, b``.

    A component is named after its smallest vertex.  Neighbours alternately move all
    larger ones, then all smaller ones, to the smallest they know, until every
    component is a star.  Minima are summed up before rows move, and only then joined
    back, so a vertex of very many edges is never gathered in one task.  Each round
    is written to the shared folder, which cuts the lineage.  Edges with a null
    end are ignored; no edges, no rows.
    """
    root = scratch_dir(edges.sparkSession, "components")
    spark = edges.sparkSession
    pairs = (
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    current, seen = _written(pairs, f"{root}/0"), None
    for step in range(1, most_rounds + 1):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_lowest(both, True), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .distinct()
        )
        large = _written(large, f"{root}/{step}-large")
        low = _lowest(large, False)
        small = (
            large.join(low, "u")
            .where("v <> low")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(low.select("u", F.col("low").alias("v")))
            .distinct()
        )
        following = _written(small, f"{root}/{step}")
        state = following.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        current = following
        if state == seen:
            break
        seen = state
        for old in (f"{root}/{step}-large", f"{root}/{step - 1}"):
            remove_path(spark, old)
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    )
