"""Exact top-k search by inner product through a pivot-distance index.

Vectors are keyed by their nearest pivot and their distance to it, and sorted by that
key into blocks: a block is an annulus around one pivot.  For a query q and a vector v,
with p the pivot, |q - v| is at least |d(q, p) - d(v, p)|, so

    q . v = (|q|^2 + |v|^2 - |q - v|^2) / 2  <=  (|q|^2 + |v|^2 - (d(q, p) - d(v, p))^2) / 2

bounds the score of a whole annulus.  A query first searches the block it lies in, which
gives a score it will at least reach, and then expands around every pivot just as
far as annuli can still hold such a score.  All arithmetic on scores is in whole
numbers; bounds get a little slack for their rounding, so results are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import stored, tidy


@dataclass(frozen=True)
class TopKRules:
    """``pivots`` is how many vectors, taken evenly by a hash of the id, become pivots.

    ``block`` bounds the vectors of a block, ``together`` the queries that travel together.
    """

    k: int = 20
    scale: int = 64
    every: int = 20
    pivots: int = 64
    block: int = 2048
    together: int = 256
    seed: int = 3


def whole_vectors(table: DataFrame, rules: TopKRules) -> DataFrame:
    """``vec_id, vector``: components as whole numbers; unusable vectors are left out.

    Vectors that are null, empty, or hold null or non-finite components take no
    part, nor do rows without an id.  Rows that repeat an id all count.
    """
    usable = F.expr(
        "embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null"
        " and not isnan(x) and abs(x) < double('infinity'))"
    )
    floor = F.expr(f"transform(embedding, x -> floor({rules.scale} * cast(x as double)))")
    return table.where(usable & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), floor.cast("array<long>").alias("vector")
    )


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Whole inner products, by floating point while that is exact.

    Vectors so large that a product might not fit a long are an error.
    """
    largest = max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0))
    if float(largest) ** 2 * queries.shape[1] < 2**53:
        return np.rint(queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    if float(largest) ** 2 * queries.shape[1] >= 2**63:
        raise OverflowError("inner products of these vectors may exceed 64 bits")
    return np.einsum("ik,jk->ij", queries, vectors)


def best(found: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of a row, ties to the smaller id."""
    if len(found) > 4 * k:
        least = np.partition(found, len(found) - k)[len(found) - k]
        near = np.flatnonzero(found >= least)
    else:
        near = np.arange(len(found))
    return near[np.lexsort((ids[near], -found[near]))[:k]]


def search(table: DataFrame, rules: TopKRules = TopKRules()) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k best other vectors.

    Queries are rows whose ``vec_id`` is divisible by ``every``.  Equal scores go to the
    smaller id.  Each row that repeats an id is a candidate of all others, and a query
    with ranks of its own.  Vectors of another length than a query never meet it.  An
    empty table gives no rows.
    """
    spark = table.sparkSession
    vectors = stored(whole_vectors(table, rules).withColumn("length", F.size("vector")), "vectors")
    sizes = sorted(r[0] for r in vectors.select("length").distinct().collect())
    found = [_search(vectors.where(F.col("length") == n).drop("length"), rules) for n in sizes]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    merged = found[0]
    for more in found[1:]:
        merged = merged.unionByName(more)
    return merged


def _search(vectors: DataFrame, rules: TopKRules) -> DataFrame:
    k, every, size, group = rules.k, rules.every, rules.block, rules.together
    # The pivots come to the driver: a fixed number of vectors.
    drawn = vectors.orderBy(F.xxhash64(F.lit(rules.seed), "vec_id"), "vec_id").limit(rules.pivots).collect()
    pivots = np.unique(np.array([r["vector"] for r in drawn], np.float64), axis=0)

    @tidy
    def key(batches):
        """The nearest pivot of each vector and the distance to it."""
        norms = (pivots**2).sum(axis=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(1)).astype(np.float64)
            square = (rows**2).sum(axis=1)[:, None] + norms - 2 * rows @ pivots.T
            nearest = square.argmin(axis=1)
            distance = np.sqrt(np.maximum(square[np.arange(len(rows)), nearest], 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nearest.astype(np.int32)), pa.array(distance)],
                ["vec_id", "vector", "pivot", "distance"],
            )

    blocks_schema = (
        "block long, pivot int, low double, high double, norm double, ids binary, vectors binary, "
        "query_ids array<long>, best_ids array<array<long>>, best_scores array<array<long>>"
    )
    arrow = pa.schema(
        [("block", pa.int64()), ("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]
        + [("norm", pa.float64()), ("ids", pa.binary()), ("vectors", pa.binary())]
        + [("query_ids", pa.list_(pa.int64()))]
        + [(x, pa.list_(pa.list_(pa.int64()))) for x in ("best_ids", "best_scores")]
    )

    @tidy
    def blocks(batches):
        """Consecutive vectors of one pivot as a block, with its own queries searched in it."""
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0

        def cut(ids, rows, pivot, distance):
            nonlocal made
            asking = np.flatnonzero(ids % every == 0)
            near_ids, near_scores = [], []
            if len(asking):
                for at, row in zip(asking, scores(rows[asking], rows)):
                    row[at] = np.iinfo(np.int64).min
                    top = best(row, ids, k)
                    top = top[top != at]
                    near_ids.append(ids[top].tolist())
                    near_scores.append(row[top].tolist())
            made += 1
            norm = float((rows.astype(np.float64) ** 2).sum(axis=1).max())
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "block": base + made,
                        "pivot": pivot,
                        "low": float(distance.min()),
                        "high": float(distance.max()),
                        "norm": norm,
                        "ids": ids.tobytes(),
                        "vectors": rows.tobytes(),
                        "query_ids": ids[asking].tolist(),
                        "best_ids": near_ids,
                        "best_scores": near_scores,
                    }
                ],
                arrow,
            )

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = (
                batch.column(0).to_numpy(),
                _matrix(batch.column(1)),
                batch.column(2).to_numpy(),
                batch.column(3).to_numpy(),
            )
            held = part if held is None else tuple(np.concatenate(x) for x in zip(held, part))
            while held is not None and (held[2][0] != held[2][-1] or len(held[0]) > size):
                end = min(int(np.searchsorted(held[2], held[2][0], side="right")), size)
                yield cut(held[0][:end], held[1][:end], int(held[2][0]), held[3][:end])
                held = tuple(x[end:] for x in held)
        if held is not None and len(held[0]):
            yield cut(held[0], held[1], int(held[2][0]), held[3])

    keyed = vectors.mapInArrow(key, "vec_id long, vector array<long>, pivot int, distance double")
    ordered = keyed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions(
        "pivot", "distance", "vec_id"
    )
    index = stored(ordered.mapInArrow(blocks, blocks_schema), "annuli")

    # Queries with what they have found at home, in groups that lie close together.
    asked = pa.schema(
        [("asked", pa.string()), ("home", pa.int64()), ("first", pa.int32())]
        + [(x, pa.binary()) for x in ("ids", "vectors", "reached")]
    )

    @tidy
    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                rows = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), -1)
                at = np.flatnonzero(ids % every == 0)
                lowest = np.iinfo(np.int64).min
                reached = np.array([x[k - 1] if len(x) >= k else lowest for x in row["best_scores"]], np.int64)
                for first in range(0, len(at), group):
                    some = at[first : first + group]
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "asked": f"{row['block']}/{first}",
                                "home": row["block"],
                                "first": first,
                                "ids": ids[some].tobytes(),
                                "vectors": rows[some].tobytes(),
                                "reached": reached[first : first + group].tobytes(),
                            }
                        ],
                        asked,
                    )

    groups = stored(
        index.where(F.size("query_ids") > 0)
        .select("block", "ids", "vectors", "best_scores")
        .mapInArrow(ask, "asked string, home long, first int, ids binary, vectors binary, reached binary"),
        "queries",
    )

    # How far each group has to go around each pivot: one row per group and pivot.
    norms = index.groupBy("pivot").agg(F.max("norm").alias("norm"))
    largest = {r["pivot"]: r["norm"] for r in norms.collect()}  # one row per pivot

    def bound(own, to_pivot, reached, norm):
        """Least and greatest distance from the pivot at which a score can still be reached."""
        room = own + norm - 2.0 * np.maximum(reached, -(2**52))
        reach = np.sqrt(np.maximum(room, 0)) * (1 + 1e-9) + 1e-6
        return to_pivot - reach, to_pivot + reach, room >= -1e-6

    @tidy
    def expand(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                rows = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), -1).astype(np.float64)
                reached = np.frombuffer(row["reached"], np.int64).astype(np.float64)
                own = (rows**2).sum(axis=1)
                out = []
                for pivot, norm in largest.items():
                    away = np.sqrt(((rows - pivots[pivot]) ** 2).sum(axis=1))
                    near, far, can = bound(own, away, reached, norm)
                    if can.any():
                        out.append((row["asked"], row["home"], pivot, float(near[can].min()), float(far[can].max())))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(x)) for x in zip(*out)], ["asked", "home", "pivot", "near", "far"]
                    )

    wanted = groups.mapInArrow(expand, "asked string, home long, pivot long, near double, far double")
    annuli = index.select("block", F.col("pivot").alias("around"), "low", "high")
    pairs = wanted.join(
        annuli,
        (F.col("pivot") == F.col("around"))
        & (F.col("high") >= F.col("near"))
        & (F.col("low") <= F.col("far"))
        & (F.col("block") != F.col("home")),
    ).select("asked", "block")
    met = (
        pairs.join(index.select("block", "pivot", "low", "high", "norm", F.col("ids").alias("other_ids"), F.col("vectors").alias("others")), "block")
        .join(groups, "asked")
        .select("pivot", "low", "high", "norm", "other_ids", "others", "home", "first", "ids", "vectors", "reached")
    )

    @tidy
    def score(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                ids = np.frombuffer(row["ids"], np.int64)
                rows = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), -1)
                reached = np.frombuffer(row["reached"], np.int64)
                own = (rows.astype(np.float64) ** 2).sum(axis=1)
                away = np.sqrt(((rows - pivots[row["pivot"]]) ** 2).sum(axis=1))
                near, far, can = bound(own, away, reached.astype(np.float64), row["norm"])
                live = np.flatnonzero(can & (near <= row["high"]) & (far >= row["low"]))
                if not len(live):
                    continue
                other_ids = np.frombuffer(row["other_ids"], np.int64)
                others = np.frombuffer(row["others"], np.int64).reshape(len(other_ids), -1)
                found = scores(rows[live], others)
                out = ([], [], [], [], [])
                for q, line in zip(live, found):
                    good = np.flatnonzero(line >= reached[q])
                    if len(good):
                        top = good[best(line[good], other_ids[good], k)]
                        out[0].append(np.full(len(top), ids[q]))
                        out[1].append(other_ids[top])
                        out[2].append(line[top])
                        out[3].append(np.full(len(top), row["home"]))
                        out[4].append(np.full(len(top), row["first"] + q, np.int32))
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in out], ["query_id", "vec_id", "score", "home", "place"]
                    )

    # A query is known by its block and its place among the block's queries, as ids may repeat.
    abroad = met.mapInArrow(score, "query_id long, vec_id long, score long, home long, place int")
    home = index.select(
        F.col("block").alias("home"),
        F.posexplode(F.arrays_zip("query_ids", "best_ids", "best_scores")).alias("place", "x"),
    ).select(
        "home",
        "place",
        F.col("x.query_ids").alias("query_id"),
        F.explode(F.arrays_zip("x.best_ids", "x.best_scores")).alias("y"),
    ).select(
        "query_id", F.col("y.best_ids").alias("vec_id"), F.col("y.best_scores").alias("score"), "home", "place"
    )
    order = Window.partitionBy("query_id", "home", "place").orderBy(F.desc("score"), "vec_id")
    return (
        home.unionByName(abroad)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
