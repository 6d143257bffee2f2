"""Document fingerprints by a randomised edit embedding.

A walk reads a text: at each step it writes down the character it stands on and moves
on or stays by a random bit that depends on the step and the character, the same for
all texts.  Texts that differ by few edits soon walk in step again, so their written
strings differ in few places: edit distance becomes Hamming distance.

The fingerprint samples the written string.  Steps are dealt into as many groups as
there are samples, and each group gives its step of lowest hash among those the text
reaches, so texts of similar length sample the same steps.  It starts with the text's
length, which tells the steps; one hexadecimal digit per sample follows.  A walk has three
steps per character, so it reads whole texts with near certainty; the last digit says that
it had ended, and samples that both texts took after their ends tell nothing.  Bands of
samples find candidates, which comparing all samples verifies.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import stored, tidy, worker_state
from pricetide.llm.components import connected
from pricetide.llm.simhash import forest


@dataclass(frozen=True)
class WalkRules:
    """``likeness`` is the least share of equal samples of a near copy.

    ``together`` bounds the characters that walk at the same time, and so the memory;
    ``block`` is about how many fingerprints of a band's key meet as many others in one task.
    """

    samples: int = 128
    bands: int = 16
    likeness: float = 0.8
    seed: int = 1234567
    together: int = 8_000_000
    block: int = 512


#: Steps of a walk per character, and the digit of a walk that has ended.
_PACE = 3
_ENDED = 15


def _mixed(x: np.ndarray) -> np.ndarray:
    """Evenly mixed 64-bit hashes of whole numbers."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _steps_of(longest: int, rules: WalkRules) -> tuple[np.ndarray, list[np.ndarray]]:
    """Steps that any text of up to ``longest`` characters may sample, and those of each group."""
    key = ("steps", rules.samples, rules.seed)
    known = worker_state().get(key)
    if known is None or known[0] < longest:
        steps = np.arange(_PACE * longest, dtype=np.int64)
        hashes = _mixed(steps + np.int64(rules.seed))
        groups = (hashes % np.uint64(rules.samples)).astype(np.int64)
        ranks = _mixed(hashes)
        order = np.argsort(groups, kind="stable")
        ends = np.searchsorted(groups[order], np.arange(rules.samples + 1))
        lists = []
        for g in range(rules.samples):
            own = order[ends[g] : ends[g + 1]]
            lists.append(own[ranks[own] == np.minimum.accumulate(ranks[own])] if len(own) else own)
        known = worker_state()[key] = (longest, lists)
    lists = [own[: np.searchsorted(own, _PACE * longest)] for own in known[1]]
    return np.unique(np.concatenate(lists)).astype(np.int64), lists


def _places(sizes: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """For each text and group the sampled step, or -1 if the text has none."""
    out = np.full((len(sizes), len(lists)), -1, np.int64)
    for g, own in enumerate(lists):
        if len(own):
            at = np.searchsorted(own, _PACE * sizes) - 1
            out[:, g] = np.where(at >= 0, own[np.maximum(at, 0)], -1)
    return out


#: Steps whose random bits are laid out at a time.
_COINS = 256


def _kinds_of(points: np.ndarray) -> np.ndarray:
    low = points < 65536
    table = worker_state().get("kinds")
    if table is None:
        table = (_mixed(np.arange(65536)) % np.uint64(63)).astype(np.uint8)
        worker_state()["kinds"] = table
    if low.all():
        return table[points]
    return (_mixed(points.astype(np.uint64)) % np.uint64(63)).astype(np.uint8)


def walk(texts: list[np.ndarray], rules: WalkRules) -> np.ndarray:
    """The sampled digits of each text, given as code points; all texts walk together."""
    sizes = np.array([len(x) for x in texts], np.int64)
    digits = np.full((len(texts), rules.samples), _ENDED, np.uint8)
    if not len(texts) or not sizes.max():
        return digits
    order = np.argsort(-sizes, kind="stable")
    ends = np.cumsum(sizes[order] + 1)
    # Characters as one of 63 kinds; the last kind ends a text and never moves on.
    flat = np.full(int(ends[-1]), 63, np.uint8)
    starts = ends - sizes[order] - 1
    for k, at in zip(order, starts):
        flat[at : at + sizes[k]] = _kinds_of(texts[k])
    longest = int(sizes.max())
    sampled, lists = _steps_of(longest, rules)
    seen = np.full((len(sampled), len(texts)), 63, np.uint8)
    standing = starts.astype(np.int64)
    reach = _PACE * sizes[order]  # no step beyond it is sampled
    row, next_sampled = 0, int(sampled[0])
    for first in range(0, _PACE * longest, _COINS):
        steps = np.arange(first, min(first + _COINS, _PACE * longest), dtype=np.uint64)
        coins = _mixed(steps * np.uint64(3) + np.uint64(rules.seed)) & np.uint64(2**63 - 1)
        moves = np.unpackbits(coins.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        active = int(np.searchsorted(-reach, -first, side="left"))
        here = standing[:active]
        for step, move in enumerate(moves, first):
            kinds = flat.take(here)
            if step == next_sampled:
                seen[row, :active] = kinds
                row += 1
                next_sampled = int(sampled[row]) if row < len(sampled) else -1
            here += move.take(kinds)
    places = _places(sizes[order], lists)
    rows = np.searchsorted(sampled, np.maximum(places, 0))
    kinds = seen[rows, np.arange(len(order))[:, None]]
    found = (_mixed(kinds.astype(np.uint64)) % np.uint64(_ENDED)).astype(np.uint8)
    found[(places < 0) | (kinds == 63)] = _ENDED
    digits[order] = found
    return digits


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def prints(texts: list[str], rules: WalkRules) -> list[str]:
    """The fingerprint of each text: eight digits of length, then one per sample."""
    points = [_points(x) for x in texts]
    found: list[str] = []
    at = 0
    while at < len(points):
        end, held = at, 0
        while end < len(points) and (end == at or held + len(points[end]) <= rules.together):
            held += len(points[end])
            end += 1
        for k, digits in enumerate(walk(points[at:end], rules), at):
            found.append(f"{len(points[k]):08x}" + "".join(map("{:x}".format, digits.tolist())))
        at = end
    return found


def _samples(signed: list[str], rules: WalkRules) -> tuple[np.ndarray, np.ndarray]:
    """Of each fingerprint the digits, and one number per sample for its step and digit; the
    number is 0 if the walk had ended or no step was there."""
    sizes = np.array([int(x[:8], 16) for x in signed], np.int64)
    _, lists = _steps_of(int(sizes.max(initial=0)), rules)
    codes = np.frombuffer("".join(x[8:] for x in signed).encode(), np.uint8)
    digits = np.where(codes > 57, codes - 87, codes - 48).reshape(len(signed), rules.samples)
    marks = _places(sizes, lists) * 16 + digits + 1
    marks[digits == _ENDED] = 0
    return digits, marks


def _likeness(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    used = ((one > 0) | (two > 0)).sum(axis=1)
    same = ((one == two) & (one > 0)).sum(axis=1)
    return np.where(used > 0, same / np.maximum(used, 1), 1.0)


def likeness(one: list[str], two: list[str], rules: WalkRules) -> np.ndarray:
    """Share of samples that two fingerprints took at the same step with the same digit.

    Samples that neither took, or both after their ends, are left out; two empty texts are alike.
    """
    return _likeness(_samples(one, rules)[1], _samples(two, rules)[1])


def fingerprints(docs: DataFrame, rules: WalkRules = WalkRules()) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` for every row; a null text is empty."""
    names = ["doc_id", "n_chars", "fingerprint"]

    @tidy
    def sign(batches):
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(prints(texts, rules))],
                names,
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(sign, "doc_id long, n_chars long, fingerprint string")


#: Pairs compared at a time.
_PAIRS = 32_768


def _meet(band: np.ndarray, one: np.ndarray, two: np.ndarray, digits, marks, rules: WalkRules) -> np.ndarray:
    """Which of the pairs ``one, two`` are near copies that share no band before ``band``."""
    width = rules.samples // rules.bands
    weights = np.uint64(16) ** np.arange(width, dtype=np.uint64)
    values = digits.reshape(len(digits), rules.bands, width).astype(np.uint64) @ weights
    empty = np.uint64(_ENDED) * weights.sum()
    kept = []
    for at in range(0, len(one), _PAIRS):
        i, j, k = (x[at : at + _PAIRS] for x in (one, two, band))
        shared = (values[i] == values[j]) & (values[i] != empty)
        first = np.flatnonzero(shared.any(axis=1) & (shared.argmax(axis=1) == k))
        near = _likeness(marks[i[first]], marks[j[first]]) >= rules.likeness
        kept.append(at + first[near])
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def near_links(different: DataFrame, rules: WalkRules = WalkRules()) -> DataFrame:
    """``a, b, n``: links of near copies among ``vertex, fingerprint, copies``.

    Fingerprints that agree in all samples of a band are candidates, but for bands in which
    both walks had ended.  All members of a band's key meet: those of a key of many are dealt
    out in blocks, and each pair of blocks is a task's work.  A pair counts in the first band
    that it shares only, so links need not be gathered to count them once.

    Links are not listed one by one.  Rows with a null ``b`` say how many copies of other
    fingerprints one is linked to; the others are links enough to connect what is linked.
    """
    width = rules.samples // rules.bands
    if width * rules.bands != rules.samples or width > 16:
        raise ValueError("samples must be bands of at most 16")
    band = F.explode(F.sequence(F.lit(0), F.lit(rules.bands - 1))).alias("band")
    part = F.expr(f"substring(fingerprint, 9 + band * {width}, {width})")
    keyed = (
        different.select("vertex", "fingerprint", band)
        .where(part != "f" * width)
        .select("vertex", "band", F.xxhash64("band", part).alias("key"))
    )
    crowds = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # One row per pair of blocks that a fingerprint belongs to; most keys are one block.
    blocks = F.expr(f"cast(ceil(members / {rules.block}) as int)")
    met = (
        keyed.join(crowds, ["band", "key"])
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("vertex", "band", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own")
        .join(different, "vertex")
    )
    parts = int(different.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    task = ["band", "key", "low", "high"]
    ordered = met.repartition(parts, *task).sortWithinPartitions(*task, "vertex").select(
        *task, "own", "vertex", "copies", "fingerprint"
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def links_of(held: pd.DataFrame) -> pa.RecordBatch:
        """Links within each of some whole groups."""
        starts = np.flatnonzero((held[task] != held[task].shift()).any(axis=1).to_numpy())
        low, high, own, bands = (held[c].to_numpy() for c in ("low", "high", "own", "band"))
        ones, twos = [], []
        for start, end in zip(starts, [*starts[1:], len(held)]):
            if low[start] == high[start]:
                i, j = np.triu_indices(end - start, 1)
            else:
                side = own[start:end] == low[start]
                i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(side), np.flatnonzero(~side)))
            ones.append(i + start)
            twos.append(j + start)
        one, two = np.concatenate(ones), np.concatenate(twos)
        names, different_ = np.unique(held["vertex"].to_numpy(), return_inverse=True)
        digits, marks = _samples(held["fingerprint"].tolist(), rules)
        kept = _meet(bands[one], one, two, digits, marks, rules)
        one, two = one[kept], two[kept]
        copies = held["copies"].to_numpy()
        counts = np.zeros(len(names), np.int64)
        np.add.at(counts, different_[one], copies[two])
        np.add.at(counts, different_[two], copies[one])
        linked = np.flatnonzero(counts)
        low_of = forest(len(names), different_[one], different_[two])
        some = np.flatnonzero(low_of != np.arange(len(names)))
        ends = [None] * len(linked)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([names[linked], names[some]])),
                pa.array(ends + names[low_of[some]].tolist(), pa.int64()),
                pa.array(np.concatenate([counts[linked], np.zeros(len(some), np.int64)])),
            ],
            schema=schema,
        )

    @tidy
    def meet(batches):
        # A group may go on in the next batch; the rows held are those of one group and a batch.
        held = None
        for batch in batches:
            rows = batch.to_pandas()
            held = rows if held is None else pd.concat([held, rows], ignore_index=True)
            if not len(held):
                continue
            last = (held[task] == held[task].iloc[-1]).all(axis=1).to_numpy()
            whole = len(held) - int(last.sum())
            if whole:
                yield links_of(held.iloc[:whole].reset_index(drop=True))
                held = held.iloc[whole:].reset_index(drop=True)
        if held is not None and len(held):
            yield links_of(held)

    return ordered.mapInArrow(meet, "a long, b long, n long")


def near_classes(signed: DataFrame, rules: WalkRules = WalkRules()) -> DataFrame:
    """The rows of ``signed`` (``doc_id, fingerprint`` and more) with ``class_id, n_links``.

    A class is what near copies connect, named after its smallest ``doc_id`` (null if all
    of its ids are); ``n_links`` says how many other rows a row is a near copy of.  Equal
    fingerprints are near copies.  Classes are told apart by a number of their own, so rows
    that repeat an id or have none are joined by their fingerprints only.  An empty table
    gives no rows.  Links are found by bands: of pairs at a likeness of exactly 0.8, 95 in a
    hundred by the defaults, of likelier ones more.
    """
    different = stored(
        signed.groupBy("fingerprint")
        .agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("vertex", F.monotonically_increasing_id()),
        "fingerprints",
    )
    met = stored(near_links(different.select("vertex", "fingerprint", "copies"), rules), "links")
    components = connected(met.where("b is not null").select("a", "b"))
    counts = met.where("b is null").groupBy(F.col("a").alias("vertex")).agg(F.sum("n").alias("links"))
    members = (
        different.join(components, "vertex", "left")
        .join(counts, "vertex", "left")
        .withColumn("component", F.coalesce("component", "vertex"))
    )
    names = members.groupBy("component").agg(F.min("id").alias("class_id"))
    classes = members.join(names, "component").select(
        "fingerprint", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return signed.join(classes, "fingerprint").select(*signed.columns, "class_id", "n_links")


def edited(docs: DataFrame, rules: WalkRules = WalkRules()) -> DataFrame:
    """Each document beside itself with its second half taken from the next one's beginning.

    The last ``n_chars // 2`` code points give way to as many of the next document in
    ascending ``doc_id``, or all it has; the last document is followed by the first.
    Rows that repeat an id follow each other in the order of their texts.  Null ids come
    first, null texts are empty.  A single document follows itself; an empty table gives
    no rows.

    Rows are dealt out by ranges of the id.  The first row of each range is all that
    another task has to see: these rows, one per range, are found in advance.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One bound per task comes to the driver, from a sketch over all ids.
    shares = [k / parts for k in range(1, parts)] or [0.5]
    low = F.coalesce("doc_id", F.lit(-(2**63)))
    sketch = rows.agg(F.percentile_approx(low, shares, max(10_000, 20 * parts))).first()[0]
    bounds = np.array(sorted(set(sketch or [])), np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="right").astype(np.int32))

    ranged = rows.withColumn("low", low).withColumn("range", range_of(low))
    # One row per range: its smallest id, and the range before it.
    firsts = sorted(tuple(r) for r in ranged.groupBy("range").agg(F.min("low")).collect())
    if not firsts:
        return spark.createDataFrame([], _EDITED)
    starts = spark.createDataFrame(
        [(r, start, firsts[k - 1][0]) for k, (r, start) in enumerate(firsts)],
        "range int, low long, before int",
    )
    # The first row of a range also goes, as a follower, to the range before.
    guests = (
        ranged.join(F.broadcast(starts), ["range", "low"])
        .groupBy(F.col("before").alias("range"))
        .agg(F.min("text").alias("text"))
        .select("range", F.lit(True).alias("guest"), F.lit(None).cast("long").alias("doc_id"), "text")
    )
    dealt = ranged.select("range", F.lit(False).alias("guest"), "doc_id", "text").unionByName(guests)
    ordered = dealt.repartitionById(parts, "range").sortWithinPartitions("range", "guest", "doc_id", "text")
    names = [x.split()[0] for x in _EDITED.split(", ")]

    def emit(run, rules):
        """Rows of documents with their followers."""
        texts = [x for _, x, _ in run]
        mixed = [x[: len(x) - len(x) // 2] + y[: len(x) // 2] for _, x, y in run]
        # Most followers are the next document of the run, whose fingerprint is here already.
        alone = [k for k, x in enumerate(run) if k + 1 == len(run) or x[2] is not run[k + 1][1]]
        signed = prints(texts + [run[k][2] for k in alone], rules)
        own, changed = signed[: len(run)], prints(mixed, rules)
        following = own[1:] + [""]
        for k, x in zip(alone, signed[len(run) :]):
            following[k] = x
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _, _ in run], pa.int64()),
                pa.array([len(x) for x in texts], pa.int64()),
                pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in mixed]),
                pa.array(own),
                pa.array(changed),
                pa.array(likeness(own, changed, rules)),
                pa.array(likeness(own, following, rules)),
            ],
            names,
        )

    @tidy
    def pair(batches):
        held, waiting, size = [], None, 0
        for batch in batches:
            columns = [batch.column(k) for k in range(4)]
            for at in range(0, batch.num_rows, 256):
                some = (x.slice(at, 256).to_pylist() for x in columns)
                for range_, guest, doc, text in zip(*some):
                    if waiting is not None:
                        held.append((waiting[0], waiting[1], text))
                        size += len(waiting[1])
                    waiting = None if guest else (doc, text)
                if size > rules.together:
                    yield emit(held, rules)
                    held, size = [], 0
        if held:
            yield emit(held, rules)

    return ordered.mapInArrow(pair, _EDITED)


_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
