"""Approximate nearest neighbours by counting collisions in single projections.

Each of many random lines has one sorted array of the rows' projections.  A query looks at
a window around its own projection in every array; a row collides as often as windows hold
it.  A row at distance R from the query collides in a window of half-width ``w R`` with
a known chance, whatever the row, so rows with at least a threshold of collisions are
verified by their true score, and of those within R only a share of ``miss`` is not.

Windows expand from a small radius by a factor (virtual rehashing: the same arrays serve all
radii) until R reaches the distance of the k-th best row so far, beyond which nothing can
enter the result.  A cell of the grid carries that distance on from block to block, so
later blocks open their windows only as far as it.

The largest inner product becomes the smallest distance by one more dimension: with M the
greatest norm of a block, rows get ``sqrt(M^2 - |v|^2)`` and the query, drawn to norm M, gets 0;
then ``d^2 = 2 M^2 - 2 M (q . v) / |q|``.  Rows come by falling norm, so M is close to all norms of
a block, and a block whose M is too small for a query is passed over.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.grid import GridRules, dealt, matrix, met, numbered, usable_vector


@dataclass(frozen=True)
class CollisionRules:
    """``lines`` projections, at most 255; windows of half-width ``width`` times the radius.

    While a query has fewer than k rows its radius grows by ``growth``, from the widest one
    ``steps`` times narrowed.  ``miss`` is the chance to overlook a row right at the radius, and
    bounds that of nearer ones.
    """

    k: int = 20
    every: int = 20
    lines: int = 128
    width: float = 1.14
    growth: float = 1.25
    steps: int = 4
    miss: float = 0.05
    seed: int = 11
    grid: GridRules = field(default_factory=GridRules)

    @property
    def threshold(self) -> int:
        """The most collisions that a row at the radius reaches with a chance of ``1 - miss``."""
        p = math.erf(self.width / math.sqrt(2))
        below = 0.0
        for count in range(self.lines + 1):
            below += math.comb(self.lines, count) * p**count * (1 - p) ** (self.lines - count)
            if below > self.miss:
                return count
        return self.lines


class SortedLines:
    """The sorted arrays of one block: values in order, and each row's place in them."""

    def __init__(self, points: np.ndarray, lines: np.ndarray):
        projected = points @ lines.T
        order = projected.argsort(axis=0, kind="stable")
        self.values = np.take_along_axis(projected, order, axis=0).T.copy()
        self.places = np.empty(self.values.shape, np.uint16)
        for place, at in zip(self.places, order.T):
            place[at] = np.arange(len(at), dtype=np.uint16)

    def collisions(self, centres: np.ndarray, half: np.ndarray) -> np.ndarray:
        """For each query and row, in how many lines the query's window holds the row."""
        counts = np.zeros((len(centres), self.places.shape[1]), np.uint8)
        for values, place, centre in zip(self.values, self.places, centres.T):
            first = np.searchsorted(values, centre - half, side="left")
            last = np.searchsorted(values, centre + half, side="right")
            beyond = place - first.astype(np.uint16)[:, None]  # rows before the window wrap around
            counts += beyond < (last - first).astype(np.uint16)[:, None]
        return counts


class _Nearest:
    """The best rows so far of a cell's queries."""

    def __init__(self, rules: CollisionRules):
        self.rules, self.parts, self.queries = rules, [], None

    def ask(self, piece: pa.RecordBatch) -> None:
        self.parts.append((piece.column(4).to_numpy(), piece.column(5).to_numpy(), matrix(piece.column(6))))

    def _open(self) -> None:
        self.rows, self.ids, self.queries = (np.concatenate(x) for x in zip(*self.parts))
        shape = (len(self.rows), self.rules.k)
        self.norms = np.sqrt((self.queries**2).sum(axis=1))
        self.scores = np.full(shape, -np.inf)
        self.best_ids, self.best_rows = np.zeros(shape, np.int64), np.full(shape, -1)

    def meet(self, piece: pa.RecordBatch) -> None:
        if not self.parts:
            return
        if self.queries is None:
            self._open()
        rules = self.rules
        rows, ids, vectors = piece.column(4).to_numpy(), piece.column(5).to_numpy(), matrix(piece.column(6))
        squares = (vectors**2).sum(axis=1)
        most = math.sqrt(squares.max())
        lifted = np.column_stack((vectors, np.sqrt(np.maximum(most**2 - squares, 0))))
        draw = np.random.Generator(np.random.PCG64(rules.seed)).standard_normal
        lines = draw((rules.lines, lifted.shape[1]))
        index = SortedLines(lifted, lines)
        open_ = np.flatnonzero(self.scores[:, -1] <= self.norms * most * (1 + 1e-9))
        together = max(1, 65_536 // len(rows))
        for at in range(0, len(open_), together):
            some = open_[at : at + together]
            self._expand(some, index, lines[:, :-1], most, rows, ids, vectors)

    def _reach(self, some: np.ndarray, most: float) -> np.ndarray:
        """The distance of each query's k-th best row, without bound while there are fewer."""
        left = 2 * most**2 - 2 * most * self.scores[some, -1] / self.norms[some]
        return np.sqrt(np.maximum(left, 0))

    def _expand(self, some, index, lines, most, rows, ids, vectors) -> None:
        rules = self.rules
        centres = (self.queries[some] * (most / self.norms[some])[:, None]) @ lines.T
        verified = np.zeros((len(some), len(rows)), bool)
        verified[self.rows[some][:, None] == rows] = True  # a query's own row
        reach, widest = self._reach(some, most), 2 * most
        radius = np.where(np.isfinite(reach), reach, widest / rules.growth**rules.steps)
        live = np.arange(len(some))
        while len(live):
            # a little slack for the rounding of projections and distances
            half = rules.width * radius[live] + 1e-7 * most
            near = index.collisions(centres[live], half) >= rules.threshold
            last = radius[live] >= widest
            near |= (last & ~np.isfinite(self.scores[some[live], -1]))[:, None]  # few rows: all of them
            near &= ~verified[live]
            verified[live] |= near
            q, r = np.nonzero(near)
            self._verify(some[live[q]], r, rows, ids, vectors)
            reach = self._reach(some[live], most)
            going = (reach > radius[live]) & ~last
            radius[live] = np.minimum(np.minimum(radius[live] * rules.growth, reach), widest)
            live = live[going]

    def _verify(self, q, r, rows, ids, vectors) -> None:
        """True scores of pairs, which come query by query."""
        found = np.einsum("ij,ij->i", self.queries[q], vectors[r])
        good = found >= self.scores[q, -1]
        q, r, found = q[good], r[good], found[good]
        edges = [0, *(np.flatnonzero(np.diff(q)) + 1), len(q)]
        for first, last in zip(edges, edges[1:]):
            if first == last:
                continue
            one, at = q[first], r[first:last]
            scores = np.concatenate((self.scores[one], found[first:last]))
            names = np.concatenate((self.best_ids[one], ids[at]))
            numbers = np.concatenate((self.best_rows[one], rows[at]))
            top = np.lexsort((numbers, names, -scores))[: self.rules.k]
            self.scores[one], self.best_ids[one], self.best_rows[one] = scores[top], names[top], numbers[top]

    def result(self):
        if self.queries is None:
            return
        q, place = np.nonzero(self.best_rows >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (self.rows[q], self.ids[q], self.best_ids[q, place], self.best_rows[q, place])]
            + [pa.array(self.scores[q, place])],
            ["query_row", "query_id", "vec_id", "row", "score"],
        )


def nearest(table: DataFrame, rules: CollisionRules = CollisionRules()) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k rows of largest inner product found.

    Queries are rows whose ``vec_id`` is divisible by ``every``; every other row is a candidate, in
    double precision.  Equal scores go to the smaller id.  Vectors that are null, empty, zero, or
    hold null or non-finite components take no part, nor do rows without an id.  Rows that
    repeat an id, or everything, are rows of their own: each is a query and a candidate.
    Vectors of another length than a query never meet it.  Where there are no more than k
    candidates all are found.  An empty table gives no rows; other columns are not read.
    """
    usable = usable_vector() & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull()
    whole = F.col("embedding").cast("array<double>")
    vectors = numbered(
        table.where(usable).select(
            F.col("vec_id").cast("long").alias("vec_id"),
            whole.alias("vector"),
            F.size("embedding").alias("length"),
            F.aggregate(whole, F.lit(0.0), lambda total, x: total + x * x).alias("square"),
        ),
        "vectors",
    ).select("length", "row", "vec_id", "vector", "square")
    queries = vectors.where(F.col("vec_id") % rules.every == 0)
    cells = dealt(vectors, queries, rules.grid, F.desc("square"), "row")
    found = met(
        cells,
        lambda: _Nearest(rules),
        "query_row long, query_id long, vec_id long, row long, score double",
        rules.grid,
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= rules.k)
        .select("query_id", "rank", "vec_id", "score")
    )
