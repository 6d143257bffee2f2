"""Whitening of embeddings through the exact characteristic polynomial of their scatter.

Vectors become whole numbers, so their scatter ``C = n sum(x x') - S S'`` (n^2 times the
covariance) is known exactly, and so is its characteristic polynomial: modulo many primes, a
task each, C goes to Hessenberg form and a recurrence gives the coefficients, which
Chinese remaindering joins.  All roots are real, so by Budan's theorem the sign changes of the
polynomial moved to ``a`` count the roots beyond ``a``: bisection isolates each root to any
number of digits, equal roots included.  Components come from inverse iteration on the null
space of ``C - root``, in decimal numbers of many digits.

Sums are formed per task and added by Spark; matrix and polynomial have the size of the
dimension, not of the data.
"""

from __future__ import annotations

import decimal
import json
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.llm.common import stored, tidy
from pricetide.llm.grid import matrix, usable_vector


@dataclass(frozen=True)
class WhiteningRules:
    """``digits`` is the precision, in decimal digits, of roots and of the iteration."""

    components: int = 8
    scale: int = 1024
    shift: int = 100_000
    digits: int = 60


#: Sums are added in two parts, as a part alone might pass Spark's largest decimal.
_LIMB = 1 << 80


def _exact_square(rows: np.ndarray) -> np.ndarray:
    """``rows' rows`` as Python integers, by floating point while that is exact."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * len(rows) < 2**53:
        real = rows.astype(np.float64)
        return (real.T @ real).astype(np.int64).astype(object)
    if most * most * len(rows) < 2**63:
        return (rows.T @ rows).astype(object)
    return rows.T.astype(object) @ rows.astype(object)


def moments(rows: DataFrame, rules: WhiteningRules) -> DataFrame:
    """``length, i, j, low, high``: sums of products (i <= j), of entries (i = -1) and the count (i = j = -1)."""
    number = pa.decimal128(38, 0)
    schema = pa.schema([(x, pa.int32()) for x in ("length", "i", "j")] + [("low", number), ("high", number)])
    shift = rules.shift

    @tidy
    def add(batches):
        held: dict[int, list] = {}
        for batch in batches:
            lengths = batch.column(0).to_numpy()
            for length in np.unique(lengths).tolist():
                own = batch.column(1).filter(pa.array(lengths == length))
                x = matrix(own, np.int64) - shift
                square, plain = _exact_square(x), x.astype(object).sum(axis=0)
                if length in held:
                    n, total, line = held[length]
                    held[length] = [n + len(x), total + square, line + plain]
                else:
                    held[length] = [len(x), square, plain]
        for length, (n, total, line) in held.items():
            across, down = np.triu_indices(length)
            i = np.concatenate((across, np.full(length + 1, -1)))
            j = np.concatenate((down, np.arange(length), [-1]))
            values = [int(v) for v in (*total[across, down], *line, n)]
            parts = [divmod(v, _LIMB) for v in values]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), length, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))]
                + [pa.array([Decimal(p[k]) for p in parts], number) for k in (1, 0)],
                schema=schema,
            )

    kept = "length int, i int, j int, low decimal(38,0), high decimal(38,0)"
    sums = rows.select("length", "x").mapInArrow(add, kept).groupBy("length", "i", "j")
    return sums.agg(F.sum("low").alias("low"), F.sum("high").alias("high"))


def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top``, by a sieve over ranges from the top down."""
    root = int(top**0.5) + 1
    small = [p for p in range(2, root) if all(p % q for q in range(2, int(p**0.5) + 1))]
    found: list[int] = []
    end = top
    while len(found) < count and end > 2:
        start = max(2, end - 65_536)
        left = np.ones(end - start, bool)
        for p in small:
            left[max(p * p, -(-start // p) * p) - start :: p] = False
        found += (np.flatnonzero(left)[::-1] + start).tolist()
        end = start
    return found[:count]


def characteristic_modulo(values: np.ndarray, p: int) -> list[int]:
    """Coefficients of ``det(t - values)`` modulo a prime below 2^31, the constant one first."""
    a = values % p
    size = len(a)
    for m in range(1, size - 1):
        at = np.flatnonzero(a[m:, m - 1])
        if not len(at):
            continue
        i = m + int(at[0])
        if i != m:
            a[[i, m]] = a[[m, i]]
            a[:, [i, m]] = a[:, [m, i]]
        u = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1 :] = (a[m + 1 :] - u[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * u % p).sum(axis=1)) % p
    found = np.zeros((size + 1, size + 1), np.int64)
    found[0, 0] = 1
    for k in range(1, size + 1):
        line = -(a[k - 1, k - 1] * found[k - 1] % p)
        line[1:] += found[k - 1, :-1]
        # the chain of subdiagonal entries below each earlier polynomial
        chain, factors = 1, np.zeros(k - 1, np.int64)
        for i in range(k - 1, 0, -1):
            chain = chain * int(a[i, i - 1]) % p
            factors[i - 1] = int(a[i - 1, k - 1]) * chain % p
        line -= (factors[:, None] * found[: k - 1] % p).sum(axis=0)
        found[k] = line % p
    return found[size].tolist()


def remainders_joined(residues: list[list[int]], primes: list[int]) -> list[int]:
    """Whole numbers, of either sign, from their residues."""
    joined, modulus = list(residues[0]), primes[0]
    for p, line in zip(primes[1:], residues[1:]):
        inverse = pow(modulus, -1, p)
        joined = [x + modulus * ((r - x) * inverse % p) for x, r in zip(joined, line)]
        modulus *= p
    return [x - modulus if 2 * x > modulus else x for x in joined]


class RealRoots:
    """The roots of a polynomial that has none but real ones, constant coefficient first."""

    def __init__(self, polynomial: list[int]):
        self.polynomial = polynomial

    def beyond(self, a: int, bits: int = 0) -> int:
        """How many roots, equal ones counted apart, are greater than ``a / 2^bits``."""
        degree = len(self.polynomial) - 1
        moved = [c << bits * (degree - k) for k, c in enumerate(self.polynomial)]
        for first in range(degree):
            for k in range(degree - 1, first - 1, -1):
                moved[k] += a * moved[k + 1]
        signs = [c > 0 for c in moved if c]
        return sum(x != y for x, y in zip(signs, signs[1:]))

    def value(self, a: int, bits: int) -> int:
        """A multiple of the polynomial at ``a / 2^bits``."""
        value, scale = 0, 1
        for c in reversed(self.polynomial):
            value = value * a + c * scale
            scale <<= bits
        return value

    def greatest(self, count: int, top: int, precision: int) -> list[tuple[int, int, int]]:
        """``low, bits, many`` of the ``count`` greatest positive roots, falling.

        A root is above ``low / 2^bits`` by at most a share of ``2^-precision``; ``many`` roots are
        no further apart than that.
        """
        found: list[tuple[int, int, int]] = []
        left = min(count, self.beyond(0))
        stack = [(0, top, self.beyond(0), 0)] if left else []
        taken = 0
        while stack and taken < left:
            low, high, above_low, above_high = stack.pop()
            if high - low > 1:
                middle = (low + high) // 2
                above = self.beyond(middle)
                if above_low > above:
                    stack.append((low, middle, above_low, above))
                if above > above_high:
                    stack.append((middle, high, above, above_high))
                continue
            for root in self._narrowed(low, above_low, above_high, precision):
                found.append(root)
                taken += root[2]
                if taken >= left:
                    break
        return found

    def _narrowed(self, low: int, above_low: int, above_high: int, precision: int):
        """The roots between two neighbouring whole numbers, falling."""
        stack = [(low, 0, above_low, above_high)]
        while stack:
            low, bits, above_low, above_high = stack.pop()
            many = above_low - above_high
            if low >> precision:
                yield low, bits, many
                continue
            low, bits = 2 * low, bits + 1
            middle = low + 1
            if many == 1:
                # its sign tells whether the number of greater roots is even
                value = self.value(middle, bits)
                odd = value < 0 if value else above_high % 2 == 1
                above = above_high + (odd != (above_high % 2 == 1))
            else:
                above = self.beyond(middle, bits)
            if above_low > above:
                stack.append((low, bits, above_low, above))
            if above > above_high:
                stack.append((middle, bits, above, above_high))


def null_vectors(values: list[list[int]], root: Decimal, many: int, digits: int) -> list[list[float]]:
    """``many`` orthogonal unit vectors that ``values - root`` sends to nearly nothing."""
    size = len(values)
    with decimal.localcontext() as context:
        context.prec = digits
        a = np.array([[Decimal(x) for x in line] for line in values], object)
        a[np.arange(size), np.arange(size)] -= root
        tiny = max(abs(x) for x in a.ravel()) * Decimal(10) ** -digits or Decimal(10) ** -digits
        swaps = []
        for k in range(size):
            best = max(range(k, size), key=lambda i: abs(a[i, k]))
            swaps.append(best)
            if best != k:
                a[[k, best]] = a[[best, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < size:
                a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])
        rng = np.random.Generator(np.random.PCG64(size))
        found: list[np.ndarray] = []
        for _ in range(many):
            y = np.array([Decimal(int(x)) for x in rng.integers(-999, 1000, size)], object)
            for _ in range(3):
                for k, best in enumerate(swaps):
                    y[k], y[best] = y[best], y[k]
                for k in range(1, size):
                    y[k] -= (a[k, :k] * y[:k]).sum()
                for k in range(size - 1, -1, -1):
                    if k + 1 < size:
                        y[k] -= (a[k, k + 1 :] * y[k + 1 :]).sum()
                    y[k] /= a[k, k]
                for before in found:
                    y = y - before * (before * y).sum()
                y = y / (y * y).sum().sqrt()
            found.append(y)
        return [[float(x) for x in y] for y in found]


def _prime_count(values: list[list[int]]) -> int:
    """So many primes that their product is over twice the sum of all coefficients' sizes."""
    size = len(values)
    trace = sum(values[k][k] for k in range(size))
    return ((trace // size + 2).bit_length() * size + 2) // 30 + 1


MODEL = (
    "length int, component int, n string, sums string, root double, explained double, "
    "vector array<double>, identity_error double"
)


def _solved(length: int, n: int, sums: list[int], values: list[list[int]], polynomial: list[int], rules: WhiteningRules):
    trace = sum(values[k][k] for k in range(length))
    precision = int(rules.digits * 3.4)
    roots, vectors = [], []
    for low, bits, many in RealRoots(polynomial).greatest(rules.components, trace, precision):
        with decimal.localcontext() as context:
            context.prec = 2 * rules.digits
            root = Decimal(low) / Decimal(1 << bits)
        for vector in null_vectors(values, root, many, rules.digits):
            roots.append(root)
            vectors.append(vector)
    roots, vectors = roots[: rules.components], vectors[: rules.components]
    real = [float(x) for x in roots]
    error = 0.0
    with decimal.localcontext() as context:
        context.prec = rules.digits
        exact = [np.array([Decimal(x) for x in v], object) for v in vectors]
        whole = np.array([[Decimal(x) for x in line] for line in values], object)
        for a, x in enumerate(exact):
            image = whole @ x
            for b, y in enumerate(exact):
                entry = (image * y).sum() / (Decimal(real[a]) * Decimal(real[b])).sqrt() - (a == b)
                error = max(error, abs(float(entry)))
    return pd.DataFrame(
        {
            "length": length,
            "component": range(1, len(roots) + 1),
            "n": str(n),
            "sums": json.dumps(sums),
            "root": real,
            "explained": [float(x / trace) for x in roots],
            "vector": pd.Series(vectors, dtype=object),
            "identity_error": error,
        }
    )


def fit(rows: DataFrame, rules: WhiteningRules) -> DataFrame:
    """The components of each length's vectors, one row each (``MODEL``)."""
    shift = rules.shift

    def pack(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        length = int(key[0])
        entry = {
            (i, j): int(low) + int(high) * _LIMB
            for i, j, low, high in zip(parts["i"], parts["j"], parts["low"], parts["high"])
        }
        n = entry[-1, -1]
        line = [entry[-1, j] for j in range(length)]
        values = [[n * entry[min(i, j), max(i, j)] - line[i] * line[j] for j in range(length)] for i in range(length)]
        made = {
            "length": length,
            "n": str(n),
            "sums": json.dumps([x + n * shift for x in line]),
            "scatter": json.dumps(values),
            "primes": _prime_count(values),
        }
        return pd.DataFrame([made])

    packed = stored(
        moments(rows, rules)
        .groupBy("length")
        .applyInPandas(pack, "length int, n string, sums string, scatter string, primes int"),
        "scatter",
    )

    def reduce(frames):
        primes: list[int] = []
        for frame in frames:
            for length, text, number in zip(frame["length"], frame["scatter"], frame["number"]):
                if len(primes) <= number:
                    primes = primes_below(2**31, max(number + 1, 2 * len(primes)))
                p = primes[number]
                values = np.array([[x % p for x in line] for line in json.loads(text)], np.int64)
                yield pd.DataFrame(
                    {"length": [length], "prime": [p], "residues": [characteristic_modulo(values, p)]}
                )

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    residues = (
        packed.select("length", "scatter", F.explode(F.sequence(F.lit(0), F.col("primes") - 1)).alias("number"))
        .repartition(parts, "length", "number")
        .mapInPandas(reduce, "length int, prime long, residues array<long>")
    )

    def solve(key: tuple, some: pd.DataFrame, one: pd.DataFrame) -> pd.DataFrame:
        polynomial = remainders_joined([list(map(int, x)) for x in some["residues"]], some["prime"].tolist())
        known = one.iloc[0]
        return _solved(
            int(key[0]), int(known["n"]), json.loads(known["sums"]), json.loads(known["scatter"]), polynomial, rules
        )

    return residues.groupBy("length").cogroup(packed.groupBy("length")).applyInPandas(solve, MODEL)


_WHITE = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(table: DataFrame, rules: WhiteningRules = WhiteningRules()) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per vector and component.

    Vectors that are null, empty, or hold null or non-finite entries take no part; all others are
    both fitted and whitened, repeated rows and rows without an id too.  Vectors of different
    lengths are fitted apart.  There are as many components as the scatter has positive
    eigenvalues, ``components`` at most, so a single vector, equal vectors and an empty table give no
    rows; equal eigenvalues get orthogonal components.  Entries whose whole number would pass
    2^62 count as 2^62, and a deviation beyond a long is null.  Other columns are not read.
    """
    limit = F.lit(float(2**62))
    scaled = F.transform(
        F.col("embedding").cast("array<double>"),
        lambda c: F.floor(F.greatest(F.least(c * rules.scale, limit), -limit)).cast("long") + rules.shift,
    )
    rows = table.where(usable_vector()).select(
        F.size("embedding").alias("length"), scaled.alias("x"), F.col("vec_id").cast("long").alias("vec_id")
    )
    # One model for each length of a vector comes to the driver: as large as the dimension.
    models: dict[int, list] = {}
    for row in fit(rows, rules).collect():
        models.setdefault(row["length"], []).append(row)
    for some in models.values():
        some.sort(key=lambda r: r["component"])
    schema = pa.schema(
        [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64())]
        + [(x, pa.float64()) for x in ("whitened", "explained", "identity_error")]
    )

    def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
        if n * int(np.abs(x).max(initial=0)) < 2**61:
            return x * n - np.array(sums, np.int64)
        return x.astype(object) * n - np.array(sums, object)

    def squares(z: np.ndarray) -> pa.Array:
        if z.dtype != object and int(np.abs(z).max(initial=0)) ** 2 * z.shape[1] < 2**63:
            return pa.array((z * z).sum(axis=1))
        found = (z.astype(object) ** 2).sum(axis=1)
        return pa.array([int(v) if v < 2**63 else None for v in found], pa.int64())

    @tidy
    def project(batches):
        for batch in batches:
            lengths = batch.column(0).to_numpy()
            for length in np.unique(lengths).tolist():
                if length not in models:
                    continue
                own = pa.array(lengths == length)
                some = models[length]
                n, k = int(some[0]["n"]), len(some)
                z = centred(matrix(batch.column(1).filter(own), np.int64), n, json.loads(some[0]["sums"]))
                axes = np.array([r["vector"] for r in some]).T / np.sqrt([r["root"] for r in some])
                whitened = z.astype(np.float64) @ axes
                each = np.repeat(np.arange(len(z)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(2).filter(own).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(z))),
                        pa.array(np.full(len(each), n)),
                        squares(z).take(pa.array(each)),
                        pa.array(whitened.ravel()),
                        pa.array(np.tile([r["explained"] for r in some], len(z))),
                        pa.array(np.full(len(each), some[0]["identity_error"])),
                    ],
                    schema=schema,
                )

    return rows.mapInArrow(project, _WHITE)
