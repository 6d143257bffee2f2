"""Long repeated substrings by recompression.

A text is a sequence of words, each word a symbol.  Rounds rename it: first two equal
neighbours become a new symbol, then pairs of neighbours do whose left is of the left
and whose right is of the right half of all symbols.  A new name is a hash of what it
replaces, and halves are drawn by hash, so all machines give the same names and
equal substrings get equal symbols but for a few words at their ends.

A window of words therefore has an inner part whose symbols do not depend on what
stands around it.  The longest symbol there is the window's anchor, named by the words
around it that all its windows hold.  Neighbouring windows mostly share an anchor;
together they are a block.  Spark rounds then find, for

1. every anchor, whether documents share it: all others are settled, as equal windows
   have equal anchors;
2. every block of a shared anchor, the first document it occurs in: a block of an earlier
   document is verified as a whole, with all its windows;
3. where different blocks of different documents share an anchor, the first
   occurrences of these blocks are taken apart, and every window's first document is found.

No round needs a group in one task: each sums up first and joins back.  Whole texts are
dealt out once, and those with windows of the third kind a second time.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import stored, tidy


@dataclass(frozen=True)
class RepeatRules:
    """``window`` is the least length of a repeat in words, at least 24."""

    window: int = 50
    texts_at_once: int = 256

    def __post_init__(self) -> None:
        if self.window < 2 * _EDGE + _LONGEST:
            raise ValueError("the window is too short for its inner part to hold a symbol")


#: Words at either end of a window whose symbols depend on what stands around it: two for
#: the round of equal neighbours, two and four more for the two rounds of pairs.
_EDGE = 8
#: Words of the longest symbol: 1, then at most 2, 4 and 8.
_LONGEST = 8
_WIDTHS = (4, 8)
_PLACE_BITS = 30
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of all texts, and the number of words of each text."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    space = _IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts = edge[~space[edge]]
    if len(data) and not space[0]:
        starts = np.concatenate(([0], starts))
    ends = edge[space[edge]]
    if len(ends) < len(starts):
        ends = np.append(ends, len(data))
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    sizes = ends - starts
    # Each byte's value is weighted by its place in the word, and the word's values add up.
    within = np.flatnonzero(~space)
    place = np.arange(len(within)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    weights = _mixed(np.arange(1, int(sizes.max()) + 1, dtype=np.uint64) * _FACTORS[0]) | np.uint64(1)
    values = _BYTES[data[within]] * weights[place]
    sums = np.add.reduceat(values, np.cumsum(sizes) - sizes)
    return _mixed(sums + sizes.astype(np.uint64) * _FACTORS[1]), counts


def recompressed(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and starts of the last round's symbols; none reaches over the end of a text."""
    names, starts = words, np.arange(len(words))
    borders = np.zeros(len(words) + 1, bool)  # words that begin a text
    borders[np.cumsum(counts)[:-1]] = True
    borders[0] = True

    def merged(names, starts, join, new_names):
        """Symbols marked in ``join`` take in the next one."""
        keep = np.ones(len(names), bool)
        keep[np.flatnonzero(join) + 1] = False
        names = np.where(join, new_names, names)
        return names[keep], starts[keep]

    if len(names) < 2:
        return names, starts
    # Two equal neighbours, and no third: longer runs could not be cut alike everywhere.
    same = np.zeros(len(names) + 1, bool)
    same[1:-1] = (names[1:] == names[:-1]) & ~borders[1:-1]
    double = same[1:] & ~same[:-1]
    double[:-1] &= ~same[2:]
    names, starts = merged(names, starts, double, _mixed(names * _FACTORS[1] + np.uint64(2)))
    for step, width in enumerate(_WIDTHS):
        if len(names) < 2:
            break
        coin = _mixed(names + np.uint64((step + 1) * int(_FACTORS[0]) % 2**64)) >> np.uint64(63) == 0
        ends = np.append(starts[1:], len(words))
        join = np.zeros(len(names), bool)
        join[:-1] = coin[:-1] & ~coin[1:] & ~borders[starts[1:]] & (ends[1:] - starts[:-1] <= width)
        following = np.append(names[1:], np.uint64(0))
        renamed = _mixed(names * _FACTORS[0] + _mixed(following + np.uint64(step + 3)))
        names, starts = merged(names, starts, join, renamed)
    return names, starts


class Sequences:
    """Hashes of any substring, from prefix sums: two polynomials modulo 2^64."""

    def __init__(self, words: np.ndarray):
        self.sums, self.inverse = [], []
        for factor in _FACTORS:
            base = factor | np.uint64(1)
            back = np.uint64(pow(int(base), -1, 2**64))
            powers = np.full(len(words) + 1, base)
            powers[0] = 1
            inverse = np.full(len(words) + 1, back)
            inverse[0] = 1
            powers, inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
            self.sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers[:-1]))))
            self.inverse.append(inverse)

    def hashes(self, first: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        sums = self.sums[which]
        return _mixed((sums[end] - sums[first]) * self.inverse[which][first] + (end - first).astype(np.uint64))


def blocks(words: np.ndarray, counts: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Blocks of windows with the same anchor: text, first window, windows, anchor and hash."""
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return {"text": none, "first": none, "windows": none, "anchor": none, "block": none}
    names, starts = recompressed(words, counts)
    sizes = np.diff(np.append(starts, len(words)))
    place_mask = np.uint64((1 << _PLACE_BITS) - 1)
    # The longest symbol wins, then the highest name, then the leftmost.
    worth = np.zeros(len(words), np.uint64)
    worth[starts] = (
        sizes.astype(np.uint64) << np.uint64(60)
        | _mixed(names + _FACTORS[1]) >> np.uint64(34) << np.uint64(_PLACE_BITS)
        | place_mask - starts.astype(np.uint64)
    )
    # Symbols that start among these words of a window end in its inner part.
    choices = window - 2 * _EDGE - _LONGEST + 1
    best, width = worth, 1
    while 2 * width <= choices:
        best = np.maximum(best[: len(best) - width], best[width:])
        width *= 2
    rest = choices - width
    best = np.maximum(best[: len(best) - rest], best[rest:])
    last = len(words) - window
    best = best[_EDGE : _EDGE + last + 1]
    at = (place_mask - (best & place_mask)).astype(np.int64)
    # Windows that lie within one text.
    text_starts = np.cumsum(counts) - counts
    of_word = np.repeat(np.arange(len(counts)), counts)
    text = of_word[: last + 1]
    inside = np.flatnonzero(text == of_word[window - 1 :])
    at = at[inside]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (np.diff(inside) != 1)))) if len(at) else none
    windows = np.diff(np.append(new, len(at)))
    first, anchor_at = inside[new], at[new]
    sequences = Sequences(words)
    # All windows of an anchor hold these words around it.
    anchor = sequences.hashes(anchor_at - _EDGE, anchor_at + window - _EDGE - choices + 1, 1)
    block = _mixed(
        sequences.hashes(first, first + windows + window - 1, 0) + (anchor_at - first).astype(np.uint64) * _FACTORS[0]
    )
    return {
        "text": text[first],
        "first": first - text_starts[text[first]],
        "windows": windows,
        "anchor": anchor.view(np.int64),
        "block": block.view(np.int64),
    }


def _encoded(texts: list[str | None]) -> list[bytes]:
    return [(x or "").encode("utf-8", "surrogatepass") for x in texts]


def _sized(column, most: int, together: int = 4 << 20):
    """Consecutive texts of a column, few enough to lay out together."""
    at, held = 0, []
    size = 0
    for k in range(len(column)):
        text = column[k].as_py() or ""
        if held and (len(held) >= most or size + len(text) > together):
            yield at, held
            at, held, size = k, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield at, held


_PARSED = "doc_id long, tag int, first int, windows int, anchor long, block long"
_SETTLED, _SOURCE, _OPEN = 0, 1, 2


def _parsed(docs: DataFrame, rules: RepeatRules) -> DataFrame:
    """The blocks of ``doc_id, tag, text``."""
    window, most = rules.window, rules.texts_at_once
    fields = [("doc_id", pa.int64()), ("tag", pa.int32()), ("first", pa.int32()), ("windows", pa.int32())]
    fields += [("anchor", pa.int64()), ("block", pa.int64())]
    schema = pa.schema(fields)

    @tidy
    def parse(batches):
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, texts in _sized(batch.column(2), most):
                found = blocks(*word_hashes(_encoded(texts)), window)
                of = found["text"] + at
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[of]),
                        pa.array(tags[of]),
                        pa.array(found["first"].astype(np.int32)),
                        pa.array(found["windows"].astype(np.int32)),
                        pa.array(found["anchor"]),
                        pa.array(found["block"]),
                    ],
                    schema=schema,
                )

    return docs.select("doc_id", "tag", "text").mapInArrow(parse, _PARSED)


def shared_blocks(docs: DataFrame, rules: RepeatRules = RepeatRules()) -> DataFrame:
    """``doc_id, tag, first, windows, state`` of blocks that earlier documents may hold.

    ``first`` is a word's number, ``windows`` how many windows start from there.  The state
    says whether an earlier document holds the block (settled: its windows repeat),
    whether a later one may hold some of its windows (source), or whether, besides,
    an earlier one may (open).
    """
    parsed = _parsed(docs, rules)  # read twice: cheaper than a table of all blocks
    shared = parsed.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b")
    # As a table, so that Spark can split the blocks of an anchor that very many documents share.
    shared = stored(shared.select("anchor"), "shared_anchors")
    near = stored(parsed.join(shared, "anchor"), "shared_blocks")
    firsts = near.groupBy("anchor", "block").agg(F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest"))
    several = (
        firsts.groupBy("anchor")
        .agg(F.min("earliest").alias("lowest"), F.max("earliest").alias("highest"))
        .where("lowest < highest")
        .select("anchor", "lowest")
    )
    known = stored(
        firsts.join(several, "anchor", "left").where("latest > earliest or lowest is not null"), "known_blocks"
    )
    state = (
        F.when(F.col("earliest") < F.col("doc_id"), _SETTLED)
        .when(F.col("lowest") < F.col("doc_id"), _OPEN)
        .when(F.col("lowest").isNotNull(), _SOURCE)
    )
    return (
        near.join(known, ["anchor", "block"])
        .select("doc_id", "tag", "first", "windows", state.alias("state"))
        .where("state is not null")
    )


def _kept(text: str, ranges: list, window: int) -> tuple[int, list[bytes]]:
    """A text's number of words, and the words that no window of the ranges covers."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not ranges:
        return len(words), words
    depth = np.zeros(len(words) + 1, np.int64)
    for x in ranges:
        depth[x["first"]] += 1
        depth[x["first"] + x["windows"] + window - 1] -= 1
    stays = np.cumsum(depth[:-1]) == 0
    return len(words), [w for w, s in zip(words, stays.tolist()) if s]


_RESULT = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())]


def _result(text: str, ranges: list, window: int, keep_text: bool) -> tuple:
    n, words = _kept(text, ranges, window)
    kept = b" ".join(words)
    shown = kept.decode("utf-8", "surrogatepass") if keep_text else None
    return n, n - len(words), hashlib.sha256(kept).hexdigest(), shown


def without_repeats(docs: DataFrame, rules: RepeatRules = RepeatRules(), keep_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row, and ``kept`` if wanted.

    A word goes if a window that covers it also starts in a document with a smaller
    ``doc_id``.  Windows are judged on the input.  Texts shorter than a window keep all
    words; null texts have none.  Rows without an id keep all their words and take
    nothing from others.  Rows that repeat an id do not count as earlier than each other.
    An empty table gives no rows.
    """
    window, most = rules.window, rules.texts_at_once
    tagged = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.crc32(F.coalesce("text", F.lit("")).cast("binary")) - F.lit(1 << 31)).cast("int").alias("tag"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    listed = (
        shared_blocks(tagged.where("doc_id is not null"), rules)
        .groupBy("doc_id", "tag")
        .agg(F.collect_list(F.struct("first", "windows", "state")).alias("blocks"))
        .select(F.col("doc_id").alias("of"), F.col("tag").alias("of_tag"), "blocks")
    )
    same = (F.col("doc_id") == F.col("of")) & (F.col("tag") == F.col("of_tag"))
    # Results, texts whose open windows must be looked up, and windows, told apart by ``kind``.
    fields = [("kind", pa.int32()), ("doc_id", pa.int64()), ("tag", pa.int32()), *_RESULT, ("text", pa.string())]
    fields += [("ranges", pa.list_(pa.struct([("first", pa.int32()), ("windows", pa.int32())])))]
    fields += [("first", pa.int32()), ("one", pa.int64()), ("two", pa.int64())]
    schema = pa.schema(fields)
    declared = (
        "kind int, doc_id long, tag int, n_words long, n_removed long, kept_sha256 string, kept string, "
        "text string, ranges array<struct<first:int,windows:int>>, first int, one long, two long"
    )

    def as_batch(kind: int, columns: dict) -> pa.RecordBatch:
        n = len(columns["doc_id"])
        full = {"kind": np.full(n, kind, np.int32)} | columns
        return pa.RecordBatch.from_arrays(
            [pa.array(full[f.name], f.type) if f.name in full else pa.nulls(n, f.type) for f in schema], schema=schema
        )

    @tidy
    def settle(batches):
        for batch in batches:
            ids, tags, lists = (batch.column(k).to_pylist() for k in (0, 1, 3))
            for at, texts in _sized(batch.column(2), most):
                done, open_ = [], []
                apart = []
                for k, text in enumerate(texts, at):
                    found = lists[k] or []
                    ranges = [x for x in found if x["state"] == _SETTLED]
                    if any(x["state"] == _OPEN for x in found):
                        open_.append((ids[k], tags[k], text, ranges))
                    else:
                        done.append((ids[k], tags[k], *_result(text, ranges, window, keep_text)))
                    apart += [(k - at, x["first"], x["windows"]) for x in found if x["state"] != _SETTLED]
                names = ["doc_id", "tag", "n_words", "n_removed", "kept_sha256", "kept"]
                if done:
                    yield as_batch(0, dict(zip(names, map(list, zip(*done)))))
                if open_:
                    yield as_batch(1, dict(zip(["doc_id", "tag", "text", "ranges"], map(list, zip(*open_)))))
                if apart:
                    words, counts = word_hashes(_encoded(texts))
                    sequences, begins = Sequences(words), np.cumsum(counts) - counts
                    owner, first, n = (np.array(x, np.int64) for x in zip(*apart))
                    owners = np.repeat(owner, n)
                    firsts = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    starts = firsts + begins[owners]
                    one, two = (sequences.hashes(starts, starts + window, k).view(np.int64) for k in (0, 1))
                    of = owners + at
                    yield as_batch(
                        2,
                        {
                            "doc_id": np.array(ids, np.int64)[of] if None not in ids else [ids[k] for k in of],
                            "tag": np.array(tags, np.int32)[of],
                            "first": firsts.astype(np.int32),
                            "one": one,
                            "two": two,
                        },
                    )

    joined = tagged.join(listed, same, "left").select("doc_id", "tag", "text", "blocks")
    settled = stored(joined.mapInArrow(settle, declared), "settled")
    single = settled.where("kind = 2").select("doc_id", "tag", "first", "one", "two")
    earliest = (
        single.groupBy("one", "two")
        .agg(F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest"))
        .where("earliest < latest")
        .drop("latest")
    )
    found = (
        single.join(earliest, ["one", "two"])
        .where("earliest < doc_id")
        .groupBy("doc_id", "tag")
        .agg(F.collect_list("first").alias("more"))
        .select(F.col("doc_id").alias("of"), F.col("tag").alias("of_tag"), "more")
    )
    waiting = settled.where("kind = 1").select("doc_id", "tag", "text", "ranges").join(found, same, "left")
    results = pa.schema([("doc_id", pa.int64()), *_RESULT])

    @tidy
    def finish(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                rows = [
                    (
                        x["doc_id"],
                        *_result(
                            x["text"],
                            x["ranges"] + [{"first": f, "windows": 1} for f in x["more"] or []],
                            window,
                            keep_text,
                        ),
                    )
                    for x in batch.slice(at, most).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), f.type) for x, f in zip(zip(*rows), results)], schema=results
                )

    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    last = waiting.select("doc_id", "text", "ranges", "more").mapInArrow(
        finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
    whole = settled.where("kind = 0").select(*names).unionByName(last)
    return whole if keep_text else whole.drop("kept")
