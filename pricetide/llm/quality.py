"""Document quality by pairwise ranking.

Every text has a vector of style figures.  Bradley and Terry's model says that a
document is preferred to another with the logistic probability of the difference of
their scores; scores being linear in the figures, it is fitted by logistic loss on
differences of vectors, over pairs of a better and a worse labelled document.  A quantile
of the training scores, the one that divides the labels best, is the threshold; scores
are carried to 0 to 1 so that it lies at ``cut``.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import held_out, stored, tidy

FIGURES = (
    "log_chars",
    "log_words",
    "mean_word",
    "spread_of_words",
    "different_words",
    "commonest_word",
    "doubled_words",
    "different_pairs",
    "short_words",
    "long_words",
    "words_with_mark",
    "capitals",
    "digits",
    "symbols",
    "commas_and_stops",
    "spaces",
    "beyond_ascii",
    "letter_entropy",
    "log_lines",
    "different_lines",
    "commonest_line",
    "words_per_stop",
)


@dataclass(frozen=True)
class QualityRules:
    """All labelled rows teach.  Rows meet in groups of about ``group_rows`` of the commoner label and
    at least ``others`` of the other, if there are so many; in a group all pairs count.  ``steps`` is the
    most Newton steps, ``closeness`` the change of weights that ends them.
    """

    group_rows: int = 2048
    others: int = 64
    steps: int = 40
    closeness: float = 1e-9
    penalty: float = 1e-4
    cut: float = 0.7
    seed: int = 5


_KINDS = np.zeros(256, np.int64)
for _low, _high, _kind in ((48, 58, 1), (65, 91, 2), (97, 123, 3), (128, 256, 4)):
    _KINDS[_low:_high] = _kind
_KINDS[[9, 10, 11, 12, 13, 32]] = 5
_KINDS[[44, 46]] = 6


def figures(text: str | None) -> np.ndarray:
    """The style figures of one whole text; all zero if it has no words."""
    out = np.zeros(len(FIGURES))
    words = (text or "").split()
    if not words:
        return out
    n = len(words)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    bytes_ = np.bincount(data, minlength=256)
    kinds = np.bincount(_KINDS, weights=bytes_, minlength=7) / len(data)
    sizes = np.fromiter(map(len, words), np.int64, n)
    seen: dict[str, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    pairs = set(zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    of_line: dict[str, int] = {}
    for line in lines:
        of_line[line] = of_line.get(line, 0) + 1
    share = bytes_[bytes_ > 0] / len(data)
    marked = sum(not x[-1].isalnum() and x[-1] not in ".,;:!?\"')" for x in words)
    out[:] = (
        math.log1p(len(text)),
        math.log1p(n),
        sizes.mean(),
        sizes.std(),
        len(seen) / n,
        max(seen.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(pairs) / max(n - 1, 1),
        (sizes <= 3).mean(),
        (sizes >= 12).mean(),
        marked / n,
        kinds[2],
        kinds[1],
        kinds[0],
        kinds[6],
        kinds[5],
        kinds[4],
        -(share * np.log(share)).sum(),
        math.log1p(len(lines)),
        len(of_line) / max(len(lines), 1),
        max(of_line.values(), default=0) / max(len(lines), 1),
        min(n / (1 + bytes_[46]), 200.0) / 200.0,
    )
    return out


def document_figures(docs: DataFrame) -> DataFrame:
    """``doc_id, figures`` for every row, of whole texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("figures", pa.list_(pa.float64()))])

    @tidy
    def measure(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [figures(x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.float64()))], schema=schema
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(measure, "doc_id long, figures array<double>")


@dataclass
class QualityModel:
    """Scores are ``weights`` on figures, scaled, with their squares; see ``apply``."""

    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float
    cut: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.middle) / self.spread, -8, 8)
        wide = np.concatenate([scaled, scaled**2 / 8], axis=1)
        return (wide * self.weights).sum(axis=1)

    def apply(self, rows: np.ndarray) -> np.ndarray:
        at = self.slope * (self.raw(rows) - self.threshold) + math.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(at, -50, 50)))


def _wide(rows: np.ndarray, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    scaled = np.clip((rows - middle) / spread, -8, 8)
    return np.concatenate([scaled, scaled**2 / 8], axis=1)


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FIGURES))


def _total(rows: DataFrame, sums: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of an array over all batches; a partial sum per core comes to the driver."""

    @tidy
    def add(batches):
        found = None
        for batch in batches:
            if batch.num_rows:
                part = sums(batch)
                found = part if found is None else found + part
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.list_(pa.float64()))], names=["sums"])

    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = rows.coalesce(cores).mapInArrow(add, "sums array<double>").toArrow().column("sums")
    return np.array(parts.to_pylist(), dtype=float).sum(axis=0)


def _groups(labelled: DataFrame, counts: tuple[int, int], rules: QualityRules) -> DataFrame:
    """``better, worse``: the figures of each group, end to end; every row is in a group.

    Rows of the rarer label are repeated where groups would be left with too few of them.
    """
    common = int(counts[1] > counts[0])
    groups = max(1, -(-counts[common] // rules.group_rows))
    kinds = min(groups, max(1, counts[1 - common] // rules.others))
    key = F.xxhash64(F.lit(rules.seed), "doc_id", "figures")
    of_common = F.array(F.pmod(key, F.lit(groups)))
    of_rare = F.sequence(F.pmod(key, F.lit(kinds)), F.lit(groups - 1).cast("long"), F.lit(kinds).cast("long"))
    placed = labelled.select(
        "quality", "figures", F.explode(F.when(F.col("quality") == common, of_common).otherwise(of_rare)).alias("at")
    )

    def members(quality: int):
        # the order is fixed, so that sums are
        return F.flatten(F.sort_array(F.collect_list(F.when(F.col("quality") == quality, F.col("figures")))))

    return placed.groupBy("at").agg(members(1).alias("better"), members(0).alias("worse"))


def _preferences(middle: np.ndarray, spread: np.ndarray, weights: np.ndarray) -> Callable:
    """Pairs, loss, slope and curvature of a batch of groups, over all their pairs."""

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        size = len(weights)
        out = np.zeros(2 + size + size * size)
        for k in range(batch.num_rows):
            better, worse = (
                _wide(np.array(batch.column(c)[k].values).reshape(-1, len(FIGURES)), middle, spread) for c in (0, 1)
            )
            apart = np.subtract.outer(better @ weights, worse @ weights)
            pull = 1 / (1 + np.exp(np.clip(apart, -500, 500)))
            bend = pull * (1 - pull)
            across = better.T @ (bend @ worse)
            curve = (better.T * bend.sum(axis=1)) @ better + (worse.T * bend.sum(axis=0)) @ worse - across - across.T
            out[0] += apart.size
            out[1] += np.logaddexp(0, -apart).sum()
            out[2 : 2 + size] += better.T @ pull.sum(axis=1) - worse.T @ pull.sum(axis=0)
            out[2 + size :] += curve.ravel()
        return out

    return sums


def _preferred(groups: DataFrame, middle: np.ndarray, spread: np.ndarray, rules: QualityRules) -> np.ndarray:
    """Weights of the least mean loss with its penalty, by Newton's method; steps that lose are halved."""
    size = 2 * len(middle)
    weights, best, step = np.zeros(size), math.inf, np.zeros(size)
    for _ in range(rules.steps):
        found = _total(groups, _preferences(middle, spread, weights + step))
        pairs = found[0]
        at = weights + step
        loss = found[1] / pairs + rules.penalty / 2 * (at @ at)
        if loss > best:
            step = step / 2
            if np.abs(step).max() < rules.closeness:
                break
            continue
        weights, best = at, loss
        slope = found[2 : 2 + size] / pairs - rules.penalty * weights
        curve = found[2 + size :].reshape(size, size) / pairs + rules.penalty * np.eye(size)
        step = np.linalg.solve(curve, slope)
        if np.abs(step).max() < rules.closeness:
            break
    return weights


def fit(labelled: DataFrame, rules: QualityRules) -> QualityModel:
    """Fit preferences of label 1 over label 0 on all rows of ``doc_id, quality, figures``.

    With labels of one kind only, or none, nothing is preferred and every score is the
    threshold's.
    """
    size = len(FIGURES)
    flat = QualityModel(np.zeros(size), np.ones(size), np.zeros(2 * size), 0.0, 1.0, rules.cut)
    known = {r["quality"]: r["count"] for r in labelled.groupBy("quality").count().collect()}
    counts = (known.get(0, 0), known.get(1, 0))
    if not min(counts):
        return flat
    narrow = labelled.select("quality", "figures")
    middle = _total(narrow, lambda b: _matrix(b.column(1)).sum(axis=0)) / sum(counts)
    variance = _total(narrow, lambda b: ((_matrix(b.column(1)) - middle) ** 2).sum(axis=0)) / sum(counts)
    spread = np.maximum(np.sqrt(variance), 1e-6)
    weights = _preferred(stored(_groups(labelled, counts, rules).drop("at"), "groups"), middle, spread, rules)
    model = QualityModel(middle, spread, weights, 0.0, 1.0, rules.cut)

    # The quantile that divides the labels best, in balanced terms.
    schema = "quality int, score double"

    @tidy
    def judge(batches):
        for batch in batches:
            if batch.num_rows:
                scores = pa.array(model.raw(_matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), scores], names=["quality", "score"])

    judged = narrow.mapInArrow(judge, schema)
    shares = [k / 1000 for k in range(1001)]
    found = np.unique(judged.agg(F.percentile_approx("score", shares, 100_000)).first()[0])
    # midway between neighbours, so that no score lies on the threshold
    tries = np.append(found[0], (found[1:] + found[:-1]) / 2)

    def below(batch: pa.RecordBatch) -> np.ndarray:
        labels, scores = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        # scores that are smaller than each of the tries, by label
        place = np.searchsorted(tries, scores, side="right")
        return np.concatenate(
            [np.bincount(place[labels == k], minlength=len(tries) + 1)[:-1].cumsum() for k in (0, 1)]
        ).astype(float)

    dropped, lost = _total(judged, below).reshape(2, -1)
    best = dropped / counts[0] - lost / counts[1]
    top = np.flatnonzero(best >= best.max() - 1e-12)
    model.threshold = float(tries[top].mean())
    slopes = np.geomspace(0.05, 20, 40)

    def losses(batch: pa.RecordBatch) -> np.ndarray:
        labels, scores = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        at = np.multiply.outer(slopes, scores - model.threshold) + math.log(rules.cut / (1 - rules.cut))
        at = np.clip(at, -50, 50)
        return np.log1p(np.exp(np.where(labels == 1, -at, at))).sum(axis=1)

    model.slope = float(slopes[int(np.argmin(_total(judged, losses)))])
    return model


def train(measured: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> QualityModel:
    """Learn from figures and the labels ``doc_id, quality`` of all rows that are not held out.

    Documents labelled both 0 and 1, or with a null, teach nothing.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("other"))
        .where((F.col("quality") == F.col("other")) & ~held_out(F.col("doc_id")))
        .drop("other")
    )
    return fit(stored(known.join(measured, "doc_id").select("doc_id", "quality", "figures"), "labelled"), rules)


def score(measured: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score, predicted`` for every row of figures."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    @tidy
    def rank(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FIGURES))
            found = model.apply(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), pa.array((found >= model.cut).astype(np.int32))],
                schema=schema,
            )

    return measured.mapInArrow(rank, "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``doc_id, text``.

    Null and empty texts have figures of zero and a score like any other.  Rows that
    repeat an id are scored each.  An empty table gives no rows.
    """
    measured = stored(document_figures(docs), "figures")
    return score(measured, train(measured, labels, rules))
