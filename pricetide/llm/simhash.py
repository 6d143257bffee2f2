"""Near-duplicates by SimHash, found through an index in Gray order.

A text's fingerprint has a bit set where over half of its shingles' hashes have it set.
Texts link where few bits differ.  Links are searched with a hierarchical index:
fingerprints sorted by their rank in Gray code share many bits with their neighbours;
consecutive ones form leaves, and every node keeps the bits that all below it share.
Two nodes whose shared bits already differ too much are dropped with all below them.

To deal this out, bits are turned so that each of ``k + 1`` blocks comes first once: two
fingerprints that differ in ``k`` bits agree in one block, so they lie in one range of
the order that has this block in front.  Ranges are cut into nodes of bounded size
across tasks; nodes that hold parts of one range meet pairwise unless their shared bits
keep them apart.  Every meeting gives a forest, not all pairs, so a large group of
copies costs as many links as it has members.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import stored, tidy
from pricetide.llm.components import connected

BITS = 64


@dataclass(frozen=True)
class SimHashRules:
    """``node`` bounds the fingerprints of an index node, and so the memory of a task."""

    shingle: int = 3
    most_bits: int = 2
    node: int = 1024
    fan_out: int = 16


_OFFSETS = np.arange(8, dtype=np.uint16) * 256
_BIT_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64 bits of one text; zero if it has no words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1]
        spans = zip(starts.tolist(), ends[shingle - 1 :].tolist())
        hashes = [xxh64_intdigest(joined[a:b], 42) for a, b in spans]
    places = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8) + _OFFSETS
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BIT_OF_BYTE
    bits = (counts.ravel() * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, rules: SimHashRules = SimHashRules()) -> DataFrame:
    """``doc_id, text_hash, bits`` (signed longs) for every row; a null text counts as empty."""
    shingle = rules.shingle
    schema = pa.schema([(x, pa.int64()) for x in ("doc_id", "text_hash", "bits")])

    @tidy
    def sign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                some = part.column(2).to_pylist()
                found = np.array([fingerprint(x, shingle) for x in some], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found)], schema=schema
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").alias("text"),
    )
    return rows.mapInArrow(sign, "doc_id long, text_hash long, bits long")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each value in Gray order."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def from_gray_rank(rank: np.ndarray) -> np.ndarray:
    return rank ^ (rank >> np.uint64(1))


def shared_bits(values: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For consecutive groups, which bits all members share, and those bits."""
    every = np.bitwise_and.reduceat(values, groups)
    some = np.bitwise_or.reduceat(values, groups)
    mask = ~(every ^ some)
    return mask, every & mask


class GrayIndex:
    """Levels of nodes over fingerprints in Gray order, the topmost first."""

    def __init__(self, values: np.ndarray, fan_out: int):
        self.values, self.fan_out = values, fan_out
        self.levels = [(np.full(len(values), ~np.uint64(0)), values)]
        width = len(values)
        while width > fan_out:
            step = fan_out ** len(self.levels)
            self.levels.append(shared_bits(values, np.arange(0, len(values), step)))
            width = len(self.levels[-1][0])
        self.levels.reverse()

    def pairs(self, other: "GrayIndex", most: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of all values of the two indexes that differ in at most ``most`` bits."""
        mine, theirs = self.levels, other.levels
        i, j = (x.ravel() for x in np.mgrid[: len(mine[0][0]), : len(theirs[0][0])])
        down, across = 0, 0
        while True:
            a, b = mine[down], theirs[across]
            apart = np.bitwise_count((a[1][i] ^ b[1][j]) & a[0][i] & b[0][j])
            near = apart <= most
            if self is other:
                near &= i <= j
            i, j = i[near], j[near]
            if down + 1 == len(mine) and across + 1 == len(theirs):
                return i, j
            if down + 1 < len(mine):
                down += 1
                i, j = self._children(i, j, len(mine[down][0]))
            if across + 1 < len(theirs):
                across += 1
                j, i = self._children(j, i, len(theirs[across][0]))

    def _children(self, i: np.ndarray, j: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        below = (i[:, None] * self.fan_out + np.arange(self.fan_out)).ravel()
        inside = below < count
        return below[inside], np.repeat(j, self.fan_out)[inside]


def forest(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``count`` places the smallest one linked to it."""
    labels = np.arange(count)
    while True:
        low = np.minimum(labels[i], labels[j])
        after = labels.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == labels).all():
            return labels
        labels = after


def _turns(most_bits: int) -> list[tuple[int, int]]:
    """For each block, by how much to turn it to the front and its width."""
    edges = np.linspace(0, BITS, most_bits + 2).round().astype(int).tolist()
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def links(bits: DataFrame, rules: SimHashRules = SimHashRules()) -> DataFrame:
    """Links ``a, b`` that join all fingerprints at most ``most_bits`` apart.

    ``bits`` holds different fingerprints.  Of every group the links connect the same
    fingerprints as all pairs would, with fewer rows.
    """
    node, fan_out, most = rules.node, rules.fan_out, rules.most_bits
    turns = _turns(most)
    turned = pa.schema([("turn", pa.int32()), ("rank", pa.int64())])

    @tidy
    def turn(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for number, (by, _) in enumerate(turns):
                front = values if not by else values << np.uint64(by) | values >> np.uint64(BITS - by)
                rank = (gray_rank(front) ^ np.uint64(1 << 63)).view(np.int64)  # signed order
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rank), number, np.int32)), pa.array(rank)], schema=turned
                )

    def back(front: np.ndarray, number: int) -> np.ndarray:
        by = turns[number][0]
        return front if not by else front >> np.uint64(by) | front << np.uint64(BITS - by)

    # A node is one row: links found within it, and the parts of its first and last range.
    parts = (
        "turn int, range long, place long, shares long, pattern long, members binary, "
        "a array<long>, b array<long>"
    )

    @tidy
    def build(batches):
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 40, 0
        held: dict[int, np.ndarray] = {}

        def nodes(batches):
            """Runs of at most ``node`` consecutive fingerprints of one turn."""
            kept: tuple[int, np.ndarray] | None = None
            for batch in batches:
                numbers = batch.column(0).to_numpy()
                ranks = batch.column(1).to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
                for number in np.unique(numbers).tolist():
                    run = ranks[numbers == number]
                    if kept and kept[0] == number:
                        run = np.concatenate((kept[1], run))
                    elif kept:
                        yield kept
                    while len(run) > node:
                        yield number, run[:node]
                        run = run[node:]
                    kept = number, run
            if kept is not None and len(kept[1]):
                yield kept

        del held
        rows = []
        for number, ranks in nodes(batches):
            front = from_gray_rank(ranks)
            width = turns[number][1]
            ranges = front >> np.uint64(BITS - width)
            index = GrayIndex(front, fan_out)
            i, j = index.pairs(index, most)
            root = forest(len(front), i, j)
            linked = np.flatnonzero(root != np.arange(len(front)))
            plain = back(front, number).view(np.int64)
            ends = {int(ranges[0]), int(ranges[-1])}
            for k, one in enumerate(sorted(ends)):
                members = front[ranges == np.uint64(one)]
                mask, pattern = shared_bits(members, np.array([0]))
                rows.append(
                    {
                        "turn": number,
                        "range": one,
                        "place": base + made,
                        "shares": int(mask.view(np.int64)[0]),
                        "pattern": int(pattern.view(np.int64)[0]),
                        "members": members.tobytes(),
                        "a": plain[root[linked]].tolist() if not k else [],
                        "b": plain[linked].tolist() if not k else [],
                    }
                )
                made += 1
            if len(rows) >= 64:
                yield pa.RecordBatch.from_pylist(rows, _schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _schema)

    _schema = pa.schema(
        [("turn", pa.int32()), ("range", pa.int64()), ("place", pa.int64()), ("shares", pa.int64())]
        + [("pattern", pa.int64()), ("members", pa.binary())]
        + [("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))]
    )

    @tidy
    def meet(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            for row in batch.to_pylist():
                one, two = (np.frombuffer(row[x], np.uint64) for x in ("members", "other_members"))
                i, j = GrayIndex(one, fan_out).pairs(GrayIndex(two, fan_out), most)
                root = forest(len(one) + len(two), i, j + len(one))
                linked = np.flatnonzero(root != np.arange(len(root)))
                plain = back(np.concatenate((one, two)), row["turn"]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(plain[root[linked]]), pa.array(plain[linked])], schema=schema
                )

    ranked = bits.select("bits").mapInArrow(turn, "turn int, rank long")
    ordered = ranked.repartitionByRange("turn", "rank").sortWithinPartitions("turn", "rank")
    index = stored(ordered.mapInArrow(build, parts), "gray_index")
    within = index.select(F.explode(F.arrays_zip("a", "b")).alias("x")).select("x.a", "x.b")
    marks = index.select("turn", "range", "place", "shares", "pattern")
    others = marks.select("turn", "range", *(F.col(x).alias(f"other_{x}") for x in ("place", "shares", "pattern")))
    apart = F.col("pattern").bitwiseXOR(F.col("other_pattern")).bitwiseAND(
        F.col("shares").bitwiseAND(F.col("other_shares"))
    )
    near = marks.join(others, ["turn", "range"]).where(
        (F.col("place") < F.col("other_place")) & (F.bit_count(apart) <= most)
    )
    members = index.select("place", "members")
    met = (
        near.select("turn", "place", "other_place")
        .join(members, "place")
        .join(members.select(F.col("place").alias("other_place"), F.col("members").alias("other_members")), "other_place")
        .select("turn", "members", "other_members")
        .mapInArrow(meet, "a long, b long")
    )
    return within.unionByName(met)


def near_duplicates(docs: DataFrame, rules: SimHashRules = SimHashRules()) -> DataFrame:
    """``doc_id, text_hash, bits, component, component_id`` per row.

    ``component`` is a fingerprint that names the row's component and no other one;
    ``component_id`` is the smallest id reachable over links.  Null and empty texts have the
    fingerprint zero and link like any other.  Rows that repeat an id keep a row each, so
    several components may have one ``component_id``.  It is null only where all ids are.
    An empty table gives no rows.
    """
    signed = stored(fingerprints(docs, rules), "fingerprints")
    different = stored(signed.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "different")
    named = connected(links(different, rules).distinct())
    lowest = (
        different.join(named.withColumnRenamed("vertex", "bits"), "bits", "left")
        .withColumn("component", F.coalesce("component", "bits"))
    )
    names = lowest.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_bits = lowest.join(names, "component").select("bits", "component", "component_id")
    return signed.join(of_bits, "bits").select("doc_id", "text_hash", "bits", "component", "component_id")


def without_near_duplicates(docs: DataFrame, rules: SimHashRules = SimHashRules()) -> DataFrame:
    """The rows of ``docs``, one of each component: that with the smallest id.

    Rows without an id come last, and equal ids in the order of their texts' hashes, so one
    row of every component stays whatever its id.  Null and empty texts are one component.
    All columns stay as they are; an empty table stays empty.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("x")
    stays = near_duplicates(docs, rules).groupBy("component").agg(first).select(
        F.col("x.doc_id").alias("of"), F.col("x.text_hash").alias("of_hash")
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))
    copies = Window.partitionBy("doc_id", "text_hash").orderBy("row.text")
    kept = rows.join(stays, same).withColumn("copy", F.row_number().over(copies)).where("copy = 1")
    return kept.select("row.*")
