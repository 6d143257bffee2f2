"""A set of queries and all rows of a table meet as cells of a grid.

Queries are dealt into groups and rows into stripes, both of bounded size and by a hash, so
equal vectors, labels or norms crowd no task.  A cell holds one group in memory and
reads one stripe past it.  A row travels once per group and a query once per stripe: with
groups and stripes of like size that is the least that a task of bounded memory allows.
Vectors meet only vectors of their own length.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import stored, tidy

#: Columns that tell the cell; each operator adds its own after them.
CELL = ("length", "group", "stripe", "kind")


@dataclass(frozen=True)
class GridRules:
    """``group_bytes`` and ``stripe_bytes`` bound the vectors of a group and of a stripe.

    ``block`` rows of a stripe are handled at a time, at most 65,535.  Small tables are cut into
    as many stripes as Spark has shuffle partitions, but into none below ``block`` rows.
    """

    group_bytes: int = 16 << 20
    stripe_bytes: int = 64 << 20
    block: int = 2048


def usable_vector(name: str = "embedding") -> Column:
    """Whether a vector is there, not empty and without null or non-finite components."""
    return F.expr(
        f"{name} is not null and size({name}) > 0 and forall({name}, x -> x is not null"
        f" and not isnan(x) and abs(x) < double('infinity'))"
    )


def numbered(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows with a number of their own in ``row``, written once so that it never changes.

    Rows that repeat an id, or everything, stay apart by it.
    """
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), purpose)


def dealt(rows: DataFrame, queries: DataFrame, rules: GridRules, *order: Column | str) -> DataFrame:
    """Both sets, cell after cell, queries first and rows in ``order``.

    Both have the same columns, ``length`` and ``row`` among them.  How many vectors there are,
    and how long, is all the driver learns.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = [F.count(F.lit(1)).alias("n"), F.sum(F.col("length").cast("long") * 8).alias("bytes")]
    there, asked = rows.agg(*size).first(), queries.agg(*size).first()
    groups = max(1, math.ceil((asked["bytes"] or 0) / rules.group_bytes))
    stripes = max(
        1, math.ceil((there["bytes"] or 0) / rules.stripe_bytes), min(parts, math.ceil(there["n"] / rules.block))
    )
    rest = [c for c in rows.columns if c != "length"]

    def placed(frame: DataFrame, kind: int, group: Column, stripe: Column) -> DataFrame:
        frame = frame.select("length", group.alias("group"), *rest)
        frame = frame.select("length", "group", stripe.alias("stripe"), *rest)
        return frame.select("length", "group", "stripe", F.lit(kind).alias("kind"), *rest)

    def of(number: int, seed: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(number)).cast("int")

    def every(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    both = placed(queries, 0, of(groups, 1), every(stripes)).unionByName(
        placed(rows, 1, every(groups), of(stripes, 2))
    )
    return both.repartition(3 * parts, *CELL[:3]).sortWithinPartitions(*CELL, *order)


def matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """A column of vectors of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind, copy=False)


def _pieces(batches, block: int) -> Iterator[tuple[tuple, int, pa.RecordBatch]]:
    """Consecutive rows of one cell and kind, ``block`` at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(len(CELL))])
        edges = [0, *(np.flatnonzero((np.diff(marks) != 0).any(axis=0)) + 1), batch.num_rows]
        for first, last in zip(edges, edges[1:]):
            for at in range(first, last, block):
                yield tuple(marks[:3, first]), int(marks[3, first]), batch.slice(at, min(block, last - at))


def met(frame: DataFrame, make: Callable, schema: str, rules: GridRules) -> DataFrame:
    """What each cell finds.

    ``make()`` gives a cell's holder: ``ask(piece)`` takes queries, ``meet(piece)`` rows, and
    ``result()`` gives batches of ``schema``.
    """
    block = rules.block

    @tidy
    def run(batches):
        holder, cell = None, None
        for key, kind, piece in _pieces(batches, block):
            if key != cell:
                if holder is not None:
                    yield from holder.result()
                holder, cell = make(), key
            (holder.meet if kind else holder.ask)(piece)
        if holder is not None:
            yield from holder.result()

    return frame.mapInArrow(run, schema)
