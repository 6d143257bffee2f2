"""Packing by cutting stock: column generation over the histogram of lengths.

Documents longer than a sequence are cut into whole sequences and a rest.  The rests
are grouped into length classes, and the histogram of classes, which is bounded by
the sequence length, is all that the driver sees.  A linear program over patterns
(how many pieces of each class share a sequence) is solved by column generation: a
knapsack over the dual prices finds the next pattern until none can save anything.
Patterns are used the rounded-down number of times; the few pieces left are placed by
first fit.  Ranks of pieces within their class then decide which pattern takes them.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import stored, tidy
from pricetide.llm.tokens import encoder, portions


@dataclass(frozen=True)
class PackRules:
    """``grain`` is the width of a length class: a smaller one pads less and plans longer.

    ``salts`` is how many tasks rank the pieces of one class.
    """

    tokenizer: str
    capacity: int = 2048
    end_id: int = 1
    grain: int = 8
    gap: float = 0.001
    max_columns: int = 1500
    salts: int = 128

    def __post_init__(self) -> None:
        if self.capacity % self.grain:
            raise ValueError("the grain must divide the capacity")


def knapsack(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits, by dynamic programming."""
    best = np.zeros(room + 1)
    chosen = np.full(room + 1, -1)
    order = np.argsort(sizes, kind="stable")
    sizes_up, prices_up = sizes[order], prices[order]
    fits = np.searchsorted(sizes_up, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        if fits[c]:
            values = best[c - sizes_up[: fits[c]]] + prices_up[: fits[c]]
            at = int(values.argmax())
            if values[at] > best[c] + 1e-12:
                best[c], chosen[c] = values[at], at
    pattern, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if chosen[c] < 0:
            c -= 1
        else:
            pattern[order[chosen[c]]] += 1
            c -= sizes_up[chosen[c]]
    return float(best[room]), pattern


def generate_columns(
    sizes: np.ndarray, demand: np.ndarray, room: int, gap: float, most: int
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) of a basis and how often each is used, not yet rounded.

    Revised simplex on ``min sum(x), A x = demand, x >= 0``, started with patterns of
    one size.  Prices are mixed with the best ones so far (at first, a piece's share of
    the room), without which they swing and the search takes many more rounds.  It
    ends when no pattern is worth more than one sequence, or when the bound that the
    best prices prove is within ``gap``.
    """
    m = len(sizes)
    columns = np.diag(room // sizes).astype(float)
    inverse = np.diag(1.0 / (room // sizes))
    used = inverse @ demand
    center, bound, alpha = sizes / room, 0.0, 0.9
    for _ in range(most):
        prices = inverse.sum(axis=0)
        mixed = alpha * center + (1 - alpha) * np.maximum(prices, 0)
        worth, pattern = knapsack(mixed, sizes, room)
        if (proven := mixed @ demand / worth) > bound:
            bound, center = proven, mixed
        if used.sum() <= bound * (1 + gap):
            break
        if prices @ pattern <= 1 + 1e-9:
            if not alpha:
                break
            alpha = alpha / 2 if alpha > 0.01 else 0.0
            continue
        change = inverse @ pattern
        ratio = np.full(m, np.inf)
        ahead = change > 1e-9
        ratio[ahead] = used[ahead] / change[ahead]
        out = int(ratio.argmin())
        columns[:, out] = pattern
        pivot = inverse[out] / change[out]
        inverse -= np.outer(change, pivot)
        inverse[out] = pivot
        used = np.maximum(inverse @ demand, 0)
    return columns.astype(np.int64), used


def plan(histogram: dict[int, int], room: int, gap: float = 0.001, most: int = 1500) -> list[tuple]:
    """Patterns that take every piece: ``(times, ((class, count), ...))``.

    ``histogram`` counts pieces by class, a class being a size of at most ``room``.
    """
    histogram = {k: v for k, v in sorted(histogram.items(), reverse=True) if v > 0}
    if not histogram:
        return []
    sizes = np.array(list(histogram), np.int64)
    demand = np.array(list(histogram.values()), np.int64)
    columns, used = generate_columns(sizes, demand.astype(float), room, gap, most)
    times = np.floor(used + 1e-9).astype(np.int64)
    left = demand - columns @ times
    for size in np.flatnonzero(left < 0):  # rounding in the inverse
        for at in np.flatnonzero((columns[size] > 0) & (times > 0)):
            less = min(int(times[at]), max(0, -int(left[size] // columns[size, at])))
            times[at] -= less
            left = left + less * columns[:, at]
    found = [
        (int(t), tuple((int(sizes[i]), int(columns[i, p])) for i in np.flatnonzero(columns[:, p])))
        for p, t in enumerate(times)
        if t
    ]
    spaces: list[int] = []
    held: list[dict[int, int]] = []
    for size, count in zip(sizes.tolist(), left.tolist()):
        for _ in range(count):
            at = next((k for k, space in enumerate(spaces) if space >= size), len(spaces))
            if at == len(spaces):
                spaces.append(room)
                held.append({})
            spaces[at] -= size
            held[at][size] = held[at].get(size, 0) + 1
    return found + [(1, tuple(x.items())) for x in held]


def slots(patterns: list[tuple]) -> list[tuple]:
    """Ranks of each class taken by each pattern: class, first, end, each, first sequence."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for times, pattern in patterns:
        for size, each in pattern:
            first = taken.get(size, 0)
            out.append((size, first, first + times * each, each, sequence))
            taken[size] = first + times * each
        sequence += times
    return out


def cut_documents(docs: DataFrame, rules: PackRules, keep: list[str] | None = None) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, start, length, ids_crc32, doc_tokens``.

    ``keep`` adds ``ids`` (32 bit, little-endian) if it names it.
    """
    with_ids = bool(keep and "ids" in keep)
    kinds = [(x, pa.int64()) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    kinds += [("ids", pa.binary())] * with_ids
    schema = pa.schema(kinds)
    end = np.array([rules.end_id], "<u4").tobytes()
    step = rules.capacity * 4

    @tidy
    def cut(batches):
        encode = encoder(rules.tokenizer, "<u4").encode
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for at, some in portions(texts):
                rows = []
                for k, ids in enumerate(encode(some), at):
                    ids += end
                    for start in range(0, len(ids), step):
                        piece = ids[start : start + step]
                        row = (names[k], start // 4, len(piece) // 4, zlib.crc32(piece))
                        rows.append(row + (len(ids) // 4,) + (piece,) * with_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), t) for x, t in zip(zip(*rows), schema.types)], schema=schema
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    names = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return rows.mapInArrow(cut, names + ", ids binary" * with_ids)


def pack(docs: DataFrame, rules: PackRules, keep: list[str] | None = None) -> DataFrame:
    """Pack ``doc_id, text`` into sequences: the pieces with ``sequence_id`` and ``offset``.

    Null and empty texts are one end id.  Rows that repeat a document are packed like
    any other.  An empty table gives no pieces.  Other columns are ignored.
    """
    spark = docs.sparkSession
    # Numbered once, so that pieces of rows that repeat a document can be told apart.
    cut = cut_documents(docs, rules, keep).withColumn("number", F.monotonically_increasing_id())
    pieces = stored(cut, "pieces").withColumn(
        "class", F.ceil(F.col("length") / rules.grain).cast("int")
    )
    whole = pieces.where(F.col("length") == rules.capacity).withColumn(
        "sequence_id", -1 - F.col("number")
    )
    rest = pieces.where(F.col("length") < rules.capacity)
    room = rules.capacity // rules.grain
    salt = F.pmod(F.xxhash64("number"), F.lit(rules.salts)).cast("int").alias("salt")
    rest = rest.withColumn("salt", salt)
    counts = rest.groupBy("class", "salt").count()
    before = Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        counts.select(
            "class", "salt", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead")
        ),
        "class_offsets",
    )
    # At most capacity / grain rows come to the driver.
    histogram = {r[0]: r[1] for r in offsets.groupBy("class").agg(F.sum("count")).collect()}
    taken = slots(plan(histogram, room, rules.gap, rules.max_columns))
    ranges = spark.createDataFrame(
        taken, "class int, first long, end long, each long, first_sequence long"
    )
    within = Window.partitionBy("class", "salt").orderBy("number")
    ranked = (
        rest.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets.drop("count")), ["class", "salt"])
        .withColumn("rank", F.col("place") + F.col("ahead"))
    )
    # The ranges are bounded by the square of the number of classes, whatever the input.
    placed = ranked.join(
        F.broadcast(ranges.withColumnRenamed("class", "of")),
        (F.col("class") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")),
    ).select(
        *pieces.columns,
        (
            F.col("first_sequence") + F.floor((F.col("rank") - F.col("first")) / F.col("each"))
        ).alias("sequence_id"),
    )
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "number")
    offset = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    joined = placed.withColumn("offset", offset).unionByName(whole.withColumn("offset", F.lit(0).cast("long")))
    return joined.drop("class", "number")
