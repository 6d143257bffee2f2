"""Language identification by error-correcting output codes.

Every language has a codeword of bits.  For each bit a binary classifier over hashed
character n-grams learns to tell the languages whose bit is one from the others.  A
text is given the language whose codeword costs least, each bit weighted by the loss
of its classifier's margin, so that uncertain bits count little; a second language
nearly as cheap marks the text as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import held_out, stored, tidy, worker_state

UNKNOWN = "und"


@dataclass(frozen=True)
class CodeRules:
    """``per_language`` bounds the training texts of a language, ``texts`` those of all: the
    sample that one task learns from.  Every language has its part; where there are very many
    each has fewer texts, but at least one.  The sample is taken by a hash of the id, evenly
    over the table.
    """

    per_language: int = 600
    texts: int = 20_000
    buckets: int = 4096
    steps: int = 150
    rate: float = 2.0
    penalty: float = 1e-5
    unclear: float = 0.6
    seed: int = 11


def codewords(count: int, seed: int) -> np.ndarray:
    """A code of +1 and -1, one row per class, with rows and columns far apart.

    Up to six classes have every split of the classes as a bit; more get about
    ``10 log2(count)`` random bits, the best of many draws.
    """
    if count <= 1:
        return np.ones((count, 1))
    if count <= 6:
        splits = np.arange(1, 2 ** (count - 1))
        bits = splits[None, :] >> np.arange(count)[:, None] & 1
        return np.where(bits == 1, 1.0, -1.0)
    rng, width = np.random.default_rng(seed), int(np.ceil(10 * np.log2(count)))
    best, best_apart = None, -1
    for _ in range(200 if count <= 512 else 1):
        code = rng.choice((-1.0, 1.0), (count, width))
        code = code[:, np.abs(code.sum(axis=0)) < count]
        if count > 512:  # so many random words of so many bits are far apart as they are
            return code
        apart = (code.shape[1] - np.einsum("ik,jk->ij", code, code)) / 2
        least = apart[~np.eye(count, dtype=bool)].min()
        if least > best_apart:
            best, best_apart = code, least
    return best


def _letter_table() -> np.ndarray:
    """For each code point below 65,536 its lower-case letter, or a space."""
    if "letters" in worker_state():
        return worker_state()["letters"]
    table = np.full(65536, 32, np.uint32)
    for point in range(65536):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()
            table[point] = ord(low) if len(low) == 1 else point
    worker_state()["letters"] = table
    return table


def ngram_counts(texts: list[str], table: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of bigram and trigram counts, and each text's number of letters."""
    out = np.zeros((len(texts), buckets), np.float32)
    letters = np.zeros(len(texts), np.int64)
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    for k, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        if not len(points):
            continue
        seen = table[np.minimum(points, 65535)]
        high = points > 65535
        if high.any():
            seen = np.where(high, [p if chr(p).isalpha() else 32 for p in points], seen).astype(np.uint32)
        letters[k] = (seen != 32).sum()
        pairs = seen[:-1] * np.uint32(0x9E3779B1) + seen[1:] * np.uint32(0x85EBCA77)
        triples = pairs[:-1] * np.uint32(0xC2B2AE3D) + seen[2:] * np.uint32(0x27D4EB2F)
        counts = np.bincount(pairs >> shift, minlength=buckets) + np.bincount(
            triples >> shift, minlength=buckets
        )
        out[k] = counts
    out = np.sqrt(out)
    out /= np.maximum(np.sqrt((out**2).sum(axis=1, keepdims=True)), 1e-9)
    return out, letters


def fit_bits(vectors: np.ndarray, targets: np.ndarray, rules: CodeRules) -> np.ndarray:
    """Logistic regressions, one column per bit, the last row holding the intercepts."""
    rows = np.hstack([vectors, np.ones((len(vectors), 1), np.float32)])
    weights = np.zeros((rows.shape[1], targets.shape[1]), np.float32)
    speed = np.zeros_like(weights)
    for _ in range(rules.steps):
        ahead = weights + 0.9 * speed
        pull = targets / (1 + np.exp(np.clip(targets * (rows @ ahead), -30, 30)))
        slope = rows.T @ pull / len(rows) - rules.penalty * ahead
        speed = 0.9 * speed + rules.rate * slope
        weights += speed
    return weights


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray


def train(docs: DataFrame, rules: CodeRules = CodeRules()) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of rows that are not held out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "doc_id", "lang", "text"
    )
    # One row per language comes to the driver.
    counts = stored(known.groupBy("lang").count(), "languages")
    languages = sorted(r["lang"] for r in counts.select("lang").collect())
    if not languages:
        return LanguageModel([], np.ones((0, 1)), np.zeros((rules.buckets + 1, 1), np.float32))
    # Ids whose hash lies below a bound: a sample of about the wanted size, without sorting.
    # Some more than wanted, so that hardly any language has too few by chance.
    most = max(1, min(rules.per_language, rules.texts // len(languages)))
    wanted = most + 6 * most**0.5 + 12
    bounds = counts.select(F.col("lang").alias("of"), (F.lit(wanted) / F.col("count")).alias("bound"))
    chance = F.pmod(F.xxhash64(F.lit(rules.seed), "doc_id"), F.lit(1 << 40)) / (1 << 40)
    drawn = known.join(bounds, (F.col("lang") == F.col("of")) & (chance < F.col("bound"))).select(
        "doc_id", "lang", "text"
    )
    first = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(rules.seed), "doc_id"), "doc_id", F.xxhash64("text"))
    numbered = drawn.withColumn("n", F.row_number().over(first)).where(F.col("n") <= most)
    code, buckets = codewords(len(languages), rules.seed), rules.buckets
    place = {x: k for k, x in enumerate(languages)}

    @tidy
    def vectors(batches):
        table = _letter_table()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found, letters = ngram_counts(part.column(1).to_pylist(), table, buckets)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.tobytes() for x in found]), pa.array(letters > 0)],
                    ["lang", "vector", "lettered"],
                )

    def learn(frames):
        rows = pd.concat(list(frames))
        rows = rows[rows.lettered].sort_values(["lang", "vector"])
        if len(rows):
            x = np.frombuffer(b"".join(rows.vector), np.float32).reshape(-1, buckets)
            y = code[[place[k] for k in rows.lang]].astype(np.float32)
            yield pd.DataFrame({"weights": [fit_bits(x, y, rules).tobytes()]})

    # One task learns: its rows are bounded by the rules, whatever the table's size.
    learned = (
        numbered.select("lang", "text")
        .mapInArrow(vectors, "lang string, vector binary, lettered boolean")
        .repartition(1)
        .mapInPandas(learn, "weights binary")
        .collect()
    )
    weights = np.zeros((buckets + 1, code.shape[1]), np.float32)
    if learned:
        weights = np.frombuffer(bytes(learned[0][0]), np.float32).reshape(buckets + 1, -1)
    return LanguageModel(languages, code, weights)


def decode(margins: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and share of the cheapest codeword; shares fall with the loss of all bits.

    A bit's logistic loss, log(1 + exp(-code * margin)), is that of code -1 less the margin
    where the code is +1, so the losses of all codewords are one product.
    """
    loss = np.logaddexp(0, margins).sum(axis=1, keepdims=True) - margins @ ((code + 1) / 2).T
    shares = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
    shares /= shares.sum(axis=1, keepdims=True)
    best = loss.argmin(axis=1)
    return best, shares[np.arange(len(best)), best]


def predict(docs: DataFrame, model: LanguageModel, rules: CodeRules = CodeRules()) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` for every row.

    Only the text is read.  A null text, a text without a letter, and every text if no
    language was learned, is ``und`` with score 0.  An empty table gives no rows.
    """
    languages, code, weights, buckets = model.languages, model.code, model.weights, rules.buckets

    @tidy
    def guess(batches):
        table = _letter_table()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [x or "" for x in part.column(1).to_pylist()]
                vectors, letters = ngram_counts(texts, table, buckets)
                if languages:
                    margins = vectors @ weights[:-1] + weights[-1]
                    best, share = decode(margins.astype(np.float64), code)
                    names = [languages[k] if n else UNKNOWN for k, n in zip(best, letters)]
                    share = np.where(letters > 0, share, 0.0)
                else:
                    names, share = [UNKNOWN] * len(texts), np.zeros(len(texts))
                unclear = (share < rules.unclear) & (np.array(names) != UNKNOWN)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(share), pa.array(unclear)],
                    ["doc_id", "lang_pred", "score", "ambiguous"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(guess, "doc_id long, lang_pred string, score double, ambiguous boolean")


def keep_known(docs: DataFrame, model: LanguageModel, rules: CodeRules = CodeRules()) -> DataFrame:
    """The rows of ``docs`` whose text has a language, without the ambiguous ones.

    All columns stay as they are.
    """
    languages, code, weights, buckets = model.languages, model.code, model.weights, rules.buckets

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        table = _letter_table()
        stays = []
        for at in range(0, len(texts), 256):
            some = [x or "" for x in texts.iloc[at : at + 256]]
            vectors, letters = ngram_counts(some, table, buckets)
            _, share = decode((vectors @ weights[:-1] + weights[-1]).astype(np.float64), code)
            stays.append((letters > 0) & (share >= rules.unclear))
        return pd.Series(np.concatenate(stays) if stays else np.zeros(0, bool))

    return docs.where(known("text")) if languages else docs.where(F.lit(False))
