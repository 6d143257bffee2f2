"""Hard negatives: rows of another label that score within a window below a positive.

Anchors meet all rows as tiles of whole numbers, multiplied by Strassen's recursion: halves
of both sides, seven products of sums instead of eight, odd sides padded with a zero row or
column.  All sums are exact, and as they may wrap around without harm, so is every score that
fits a long.

Two passes over the tiles: the first keeps each anchor's best positives, the second, for each of
those, the best negatives in its window.  A cell keeps what it found as short sorted lists that
merge from block to block, and lists of different cells merge in the end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import stored
from pricetide.llm.grid import GridRules, dealt, matrix, met, numbered, usable_vector


@dataclass(frozen=True)
class NegativeRules:
    """A negative's score is from ``low`` to ``high`` hundredths of the positive's."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256
    every: int = 100
    together: int = 256
    grid: GridRules = field(default_factory=GridRules)


def strassen(a: np.ndarray, b: np.ndarray, smallest: int = 16) -> np.ndarray:
    """The product of two whole-number matrices; sides up to ``smallest`` are multiplied plainly."""
    m, k = a.shape
    n = b.shape[1]
    if min(m, k, n) <= smallest:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, smallest)[:m, :n]
    (a11, a12), (a21, a22) = (np.hsplit(x, 2) for x in np.vsplit(a, 2))
    (b11, b12), (b21, b22) = (np.hsplit(x, 2) for x in np.vsplit(b, 2))
    p1 = strassen(a11 + a22, b11 + b22, smallest)
    p2 = strassen(a21 + a22, b11, smallest)
    p3 = strassen(a11, b12 - b22, smallest)
    p4 = strassen(a22, b21 - b11, smallest)
    p5 = strassen(a11 + a12, b22, smallest)
    p6 = strassen(a21 - a11, b11 + b12, smallest)
    p7 = strassen(a12 - a22, b21 + b22, smallest)
    return np.block([[p1 + p4 - p5 + p7, p3 + p5], [p2 + p4, p1 - p2 + p3 + p6]])


class Best:
    """The rows of highest score, ties by id, of those seen; never more than ``k``."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.rows = (np.zeros(0, np.int64) for _ in range(3))

    def least(self) -> int | None:
        """What a row has to score to enter a full list."""
        return int(self.scores[-1]) if len(self.scores) == self.k else None

    def merge(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        scores, ids, rows = (
            np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.rows, rows))
        )
        top = np.lexsort((rows, ids, -scores))[: self.k]
        self.scores, self.ids, self.rows = scores[top], ids[top], rows[top]


class _Anchors:
    """Anchors of a cell against blocks of rows, tile by tile."""

    def __init__(self, rules: NegativeRules):
        self.rules, self.parts, self.anchors = rules, [], None

    def ask(self, piece: pa.RecordBatch) -> None:
        self.parts.append([piece.column(k).to_numpy() for k in (4, 5, 6)] + [matrix(piece.column(7), np.int64)])

    def open(self) -> None:
        self.rows, self.ids, self.labels, self.anchors = (np.concatenate(x) for x in zip(*self.parts))

    def meet(self, piece: pa.RecordBatch) -> None:
        if not self.parts:
            return
        if self.anchors is None:
            self.open()
        rows, ids, labels = (piece.column(k).to_numpy() for k in (4, 5, 6))
        across = np.ascontiguousarray(matrix(piece.column(7), np.int64).T)
        for at in range(0, len(self.rows), self.rules.together):
            tile = strassen(self.anchors[at : at + self.rules.together], across)
            for one, scores in enumerate(tile, at):
                self.take(one, scores, rows, ids, labels)


class _Positives(_Anchors):
    def open(self) -> None:
        super().open()
        self.found = [Best(self.rules.positives) for _ in self.rows]

    def take(self, one, scores, rows, ids, labels) -> None:
        held = self.found[one]
        fits = (labels == self.labels[one]) & (rows != self.rows[one])
        if (least := held.least()) is not None:
            fits &= scores >= least
        at = np.flatnonzero(fits)
        if len(at):
            held.merge(scores[at], ids[at], rows[at])

    def result(self):
        if self.anchors is not None:
            counts = [len(x.rows) for x in self.found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(self.rows, counts))]
                + [pa.array(np.concatenate([getattr(x, c) for x in self.found])) for c in ("ids", "rows", "scores")],
                ["anchor_row", "positive_id", "positive_row", "positive_score"],
            )


class _Windows(_Anchors):
    def __init__(self, rules: NegativeRules):
        super().__init__(rules)
        self.wanted = []

    def ask(self, piece: pa.RecordBatch) -> None:
        super().ask(piece)
        self.wanted += piece.column(8).to_pylist()

    def open(self) -> None:
        super().open()
        self.found = [[Best(self.rules.negatives) for _ in x] for x in self.wanted]
        low, high = self.rules.low, self.rules.high
        self.windows = [[(-(-low * p // 100), high * p // 100) for p in x] for x in self.wanted]

    def take(self, one, scores, rows, ids, labels) -> None:
        windows = self.windows[one]
        lowest, highest = min(x[0] for x in windows), max(x[1] for x in windows)
        at = np.flatnonzero((labels != self.labels[one]) & (scores >= lowest) & (scores <= highest))
        if not len(at):
            return
        at = at[np.lexsort((rows[at], ids[at], -scores[at]))]
        falling = -scores[at]
        for held, (low, high) in zip(self.found[one], windows):
            first = int(np.searchsorted(falling, -high, side="left"))
            last = min(int(np.searchsorted(falling, -low, side="right")), first + held.k)
            if first < last:
                held.merge(*(x[at[first:last]] for x in (scores, ids, rows)))

    def result(self):
        if self.anchors is None:
            return
        flat = [(row, place, x) for row, some in zip(self.rows, self.found) for place, x in enumerate(some)]
        counts = [len(x.rows) for _, _, x in flat]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([x[0] for x in flat], np.int64), counts))]
            + [pa.array(np.repeat(np.array([x[1] for x in flat], np.int32), counts))]
            + [pa.array(np.concatenate([getattr(x, c) for *_, x in flat])) for c in ("ids", "rows", "scores")],
            ["anchor_row", "place", "negative_id", "negative_row", "negative_score"],
        )


def labelled_vectors(table: DataFrame, rules: NegativeRules) -> DataFrame:
    """``length, row, vec_id, label, vector`` in whole numbers; every seventh id has a wrong label."""
    label = F.col("label").cast("long")
    usable = usable_vector() & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    floor = F.expr(f"transform(embedding, x -> floor({rules.scale} * cast(x as double)))")
    rows = table.where(usable).select(
        F.size("embedding").alias("length"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        floor.cast("array<long>").alias("vector"),
    )
    return numbered(rows, "vectors").select("length", "row", "vec_id", "label", "vector")


def mine(table: DataFrame, rules: NegativeRules = NegativeRules()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are rows whose ``vec_id`` is divisible by ``every``.  Rows with a null label, id or
    vector, with an empty vector, or with null or non-finite components take no part.  Equal
    scores go to the smaller id.  Rows that repeat an id, or everything, are rows of their own.
    Vectors of another length than an anchor never meet it.  Positives below zero have an empty
    window, and positives without a negative have no rows, as has an empty table.  Other
    columns are not read.
    """
    vectors = labelled_vectors(table, rules)
    anchors = vectors.where(F.col("vec_id") % rules.every == 0)
    near = met(
        dealt(vectors, anchors, rules.grid, "row"),
        lambda: _Positives(rules),
        "anchor_row long, positive_id long, positive_row long, positive_score long",
        rules.grid,
    )
    order = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    positives = stored(
        near.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < rules.positives),
        "positives",
    )
    # at most ``positives`` rows of an anchor come together here
    wanted = positives.groupBy(F.col("anchor_row").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("some")
    )
    asking = anchors.join(wanted, "row").select(
        *vectors.columns, F.transform("some", lambda x: x["positive_score"]).alias("wanted")
    )
    found = met(
        dealt(vectors.withColumn("wanted", F.lit(None).cast("array<long>")), asking, rules.grid, "row"),
        lambda: _Windows(rules),
        "anchor_row long, place int, negative_id long, negative_row long, negative_score long",
        rules.grid,
    )
    order = Window.partitionBy("anchor_row", "place").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rules.negatives)
    names = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return (
        ranked.join(positives.drop("positive_row"), ["anchor_row", "place"])
        .join(names, "anchor_row")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
