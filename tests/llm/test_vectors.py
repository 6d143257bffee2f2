"""Operators on vectors against plain Python and numpy."""

import math
import random

import numpy as np
import pytest

from pricetide.llm import collisions, negatives, whitening
from pricetide.llm.grid import GridRules
from pricetide.llm.queries import QUERIES
from tests.llm.test_queries import SF_DIR

# ``row``, ``length``, ``group`` and the like are names that operators use inside.
TABLE = "vec_id long, embedding array<double>, label int, row string, length int, group string, x int, square int"
EXTRA = ("a", 1, "b", 2, 3)
SMALL = GridRules(group_bytes=6 * 8 * 5, stripe_bytes=6 * 8 * 40, block=16)


def awkward_vectors():
    """Nulls in every column, unusable vectors, ties, repeated rows and ids, other lengths."""
    rng = random.Random(5)
    rows = [(k, [rng.gauss(0.05, 0.3) for _ in range(6)], rng.randrange(4)) for k in range(300)]
    rows[40] = (40, [3 * x for x in rows[40][1]], 1)
    rows += [(1000 + k, rows[40][1], k % 3) for k in range(50)]
    rows += [(2000, None, 1), (2020, [], 1), (2100, [1.0, None] * 3, 1), (2200, [float("nan")] * 6, 1)]
    rows += [(2300, [float("-inf")] * 6, 1), (None, rows[1][1], 1), (2400, rows[2][1], None)]
    rows += [rows[20], rows[20], (100, rows[21][1], 2), (100, rows[22][1], 2)]
    rows += [(4000, [0.5, 0.5], 0), (4020, [0.1, 2.0], 0), (4100, [0.3, 0.3], 1), (4040, [0.0] * 6, 2)]
    rows += [(4200, [0.25, -0.5, 1.0], 3), (5000, [40.0] + [0.0] * 5, 1), (-100, rows[7][1], -1)]
    return rows


@pytest.fixture(scope="module")
def vectors():
    return awkward_vectors()


@pytest.fixture(scope="module")
def table(spark, vectors):
    return spark.createDataFrame([(*r, *EXTRA) for r in vectors], TABLE).repartition(5)


def usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector)


# 11: nearest neighbours


def brute_nearest(vectors, k=20):
    rows = [(i, v) for i, v, _ in vectors if i is not None and usable(v) and any(v)]
    out = []
    for number, (q, v) in enumerate(rows):
        if q % 20 == 0:
            found = sorted(
                (-float(np.einsum("j,j->", np.array(v), np.array(w))), i)
                for other, (i, w) in enumerate(rows)
                if other != number and len(w) == len(v)
            )
            out.append((q, [(i, -s) for s, i in found[:k]]))
    return out


@pytest.mark.parametrize("grid", [SMALL, GridRules()])
def test_nearest(table, vectors, grid):
    wanted = brute_nearest(vectors)
    got = collisions.nearest(table, collisions.CollisionRules(grid=grid)).collect()
    assert sorted((r.query_id, r.rank) for r in got) == sorted((q, n) for q, x in wanted for n in range(1, len(x) + 1))
    ranks = {}
    for r in got:
        ranks.setdefault((r.query_id, r.rank), []).append(round(r.score, 9))
    scores = {}
    for q, found in wanted:
        for n, (_, s) in enumerate(found, 1):
            scores.setdefault((q, n), []).append(round(s, 9))
    same = sum(sorted(ranks[x]) == sorted(scores[x]) for x in scores)
    assert same >= 0.95 * len(scores)
    # lists of no more rows than asked for are whole
    short = {(q, i) for q, found in wanted if len(found) < 20 for i, _ in found}
    assert short and short <= {(r.query_id, r.vec_id) for r in got}
    # of equal vectors the smallest ids
    copies = sorted(r.vec_id for r in got if r.query_id == 40 and abs(r.score - np.dot(vectors[40][1], vectors[40][1])) < 1e-12)
    assert len(copies) > 10 and copies == list(range(1000, 1000 + len(copies)))
    assert collisions.nearest(table.where("false")).count() == 0


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, points = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), float)
    got = QUERIES["op11_nearest_by_collisions"](spark, sf_dir).toPandas()
    hits = total = 0
    for q, found in got.groupby("query_id"):
        scores = points @ points[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len(set(found["vec_id"]) & set(ids[np.argsort(-scores)[:20]]))
        total += 20
        assert sorted(found["rank"]) == list(range(1, 21))
        assert np.allclose(found["score"], [scores[ids == i][0] for i in found["vec_id"]], rtol=0, atol=1e-12)
    assert total == 20 * (ids % 20 == 0).sum() and hits >= 0.95 * total


def test_collisions_are_those_of_plain_windows():
    rng = np.random.default_rng(3)
    points, lines = rng.normal(size=(70, 5)), rng.normal(size=(40, 5))
    points[10:20] = points[0]
    centres, half = rng.normal(size=(9, 5)) @ lines.T, rng.uniform(0, 2, 9)
    got = collisions.SortedLines(points, lines).collisions(centres, half)
    away = np.abs((points @ lines.T)[None] - centres[:, None])
    assert (got == (away <= half[:, None, None]).sum(axis=2)).all()
    rules = collisions.CollisionRules()
    chance = math.erf(rules.width / math.sqrt(2))
    above = (np.random.default_rng(0).random((4000, rules.lines)) < chance).sum(axis=1) >= rules.threshold
    assert 1 - rules.miss - 0.02 < above.mean() < 1


# 12: whitening


def test_whitening(table, vectors):
    got = whitening.whiten(table).collect()
    by_length = {}
    for i, v, _ in vectors:
        if usable(v):
            by_length.setdefault(len(v), []).append((i, [math.floor(1024 * c) + 100_000 for c in v]))
    wanted_rows = 0
    for length, rows in by_length.items():
        x = np.array([r[1] for r in rows], object)
        n, sums = len(x), x.sum(axis=0)
        z = n * x - sums
        values, axes = np.linalg.eigh((z.T @ z / n**2).astype(float) / n)
        rank = int((values > 1e-6 * max(values.max(), 1e-300)).sum()) if n > 1 else 0
        count = min(8, rank)
        wanted_rows += n * count
        for k in range(count):
            white = (z.astype(float) / n) @ axes[:, -1 - k] / math.sqrt(values[-1 - k])
            mine = [r for r in got if r.n == n and r.component == k + 1]
            assert len(mine) == n
            there = sorted((abs(w), int(s)) for w, s in zip(white, (z**2).sum(axis=1)))
            here = sorted((abs(r.whitened), r.deviation) for r in mine)
            assert np.allclose([a for a, _ in there], [a for a, _ in here], atol=1e-7)
            assert sorted(s for _, s in there) == sorted(s for _, s in here)
            assert all(abs(r.explained / (values[-1 - k] / values.sum()) - 1) < 1e-9 for r in mine)
    assert len(got) == wanted_rows and max(r.identity_error for r in got) < 1e-12
    assert whitening.whiten(table.where("false")).count() == 0
    assert whitening.whiten(table.where("vec_id = 3")).count() == 0
    assert whitening.whiten(table.where("vec_id between 1000 and 1049")).count() == 0


def test_whitening_of_the_query(spark):
    got = QUERIES["op12_whitening"](spark, SF_DIR).toPandas()
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    assert len(got) == 8 * table.count() and set(got["component"]) == set(range(1, 9))
    wide = got.pivot(index="vec_id", columns="component", values="whitened")
    assert np.abs(np.cov(wide.T, bias=True) - np.eye(8)).max() < 1e-9
    assert np.abs(wide.mean()).max() < 1e-9 and got["identity_error"].max() < 1e-12


@pytest.mark.parametrize("most", [3, 10**6, 10**14])
def test_characteristic_polynomial_and_roots(most):
    rng = random.Random(most)
    size = 6
    half = [[rng.randrange(-most, most) for _ in range(size)] for _ in range(size)]
    values = [[sum(a * b for a, b in zip(x, y)) for y in half] for x in half]
    primes = whitening.primes_below(2**31, whitening._prime_count(values))
    assert len(set(primes)) == len(primes)
    modulo = [whitening.characteristic_modulo(np.array([[v % p for v in x] for x in values], np.int64), p) for p in primes]
    polynomial = whitening.remainders_joined(modulo, primes)
    # Faddeev and LeVerrier, exact
    m, wanted = np.zeros((size, size), object), [1]
    for k in range(1, size + 1):
        m = np.array(values, object) @ m + wanted[-1] * np.eye(size, dtype=int).astype(object)
        wanted.append(-int((np.array(values, object) @ m).trace()) // k)
    assert polynomial == wanted[::-1]
    roots = whitening.RealRoots(polynomial).greatest(6, sum(values[k][k] for k in range(size)), 100)
    plain = np.linalg.eigvalsh(np.array(values, float))[::-1]
    found = [low / 2**bits for low, bits, many in roots for _ in range(many)]
    assert np.allclose(found, plain[: len(found)], rtol=1e-6, atol=1e-6 * plain[0])


def test_equal_and_whole_roots():
    values = [[2, 1, 0, 0], [1, 2, 0, 0], [0, 0, 3, 0], [0, 0, 0, 0]]  # 3, 3, 1, 0
    roots = whitening.RealRoots([0, -9, 15, -7, 1])
    assert roots.beyond(0) == 3 and roots.beyond(1) == 2 and roots.beyond(5, 1) == 2 and roots.beyond(3) == 0
    assert [(round(low / 2**bits, 9), many) for low, bits, many in roots.greatest(8, 8, 200)] == [(3, 2), (1, 1)]
    a, b = (np.array(x) for x in whitening.null_vectors(values, whitening.Decimal(3), 2, 60))
    for x in (a, b):
        assert np.allclose(np.array(values) @ x, 3 * x) and abs(x @ x - 1) < 1e-15
    assert abs(a @ b) < 1e-15


def test_sums_and_deviations_beyond_a_long(spark):
    rows = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, 1e300])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(frame).collect()
    assert len(got) == 6 and all(r.deviation is None for r in got) and got[0].identity_error < 1e-9


# 13: hard negatives


def brute_negatives(vectors):
    rows = []
    for i, v, label in vectors:
        if i is not None and label is not None and usable(v):
            flipped = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
            rows.append((i, [math.floor(256 * x) for x in v], flipped))
    out = []
    for a, (anchor, v, label) in enumerate(rows):
        if anchor % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w)), i, other)
            for b, (i, w, other) in enumerate(rows)
            if b != a and len(w) == len(v)
        ]
        for p, positive, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fit = sorted((n, i) for n, i, other in scored if other != label and -30 * p <= -100 * n <= -90 * p)
            out += [(anchor, positive, k, i, -p, -n) for k, (n, i) in enumerate(fit[:10], 1)]
    return out


@pytest.mark.parametrize("grid", [SMALL, GridRules()])
def test_hard_negatives(table, vectors, grid):
    got = [tuple(r) for r in negatives.mine(table, negatives.NegativeRules(together=3, grid=grid)).collect()]
    assert sorted(got) == sorted(brute_negatives(vectors)) and len(got) > 100
    assert negatives.mine(table.where("false")).count() == 0
    assert negatives.mine(table.where("vec_id = 100 and label is null")).count() == 0


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 3), (33, 64, 50), (16, 48, 17), (64, 6, 100)])
def test_strassen(shape):
    rng = np.random.default_rng(1)
    m, k, n = shape
    a, b = rng.integers(-(2**28), 2**28, (m, k)), rng.integers(-(2**28), 2**28, (k, n))
    for smallest in (2, 16):
        assert (negatives.strassen(a, b, smallest) == (a.astype(object) @ b.astype(object)).astype(np.int64)).all()


def test_short_lists_merge_in_any_order():
    rng = np.random.default_rng(4)
    scores, ids = rng.integers(0, 9, 60), rng.integers(0, 30, 60)
    wanted = sorted(zip((-scores).tolist(), ids.tolist(), range(60)))[:7]
    for parts in (1, 4, 60):
        held = negatives.Best(7)
        for at in np.array_split(rng.permutation(60), parts):
            held.merge(scores[at], ids[at], at)
        assert list(zip((-held.scores).tolist(), held.ids.tolist(), held.rows.tolist())) == wanted
