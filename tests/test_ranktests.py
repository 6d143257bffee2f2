import math
import random

import pytest

from pricetide.config import SkewRules
from pricetide.operators import ranktests

CUT = SkewRules(hot_rows=5, rows_per_slice=2)


def frame(spark, data):
    """Rows of (entity, price, rainy, band)."""
    return spark.createDataFrame(
        data, "entity string, price double, is_rainy boolean, temperature_band string"
    )


def mid_ranks(values):
    ordered = sorted(values)
    return [ordered.index(v) + (ordered.count(v) + 1) / 2 for v in values]


def tie_term(values):
    return sum(values.count(v) ** 3 - values.count(v) for v in set(values))


def mann_whitney(x, y):
    both, n1, n2 = x + y, len(x), len(y)
    n = n1 + n2
    u = sum(mid_ranks(both)[:n1]) - n1 * (n1 + 1) / 2
    variance = n1 * n2 / 12 * ((n + 1) - tie_term(both) / (n * (n - 1)))
    z = max(abs(u - n1 * n2 / 2) - 0.5, 0) / math.sqrt(variance)
    return u, z, math.erfc(z / math.sqrt(2))


def kruskal(groups):
    both = [v for g in groups for v in g]
    ranks, n, start, total = mid_ranks(both), len(both), 0, 0.0
    for g in groups:
        total += sum(ranks[start:start + len(g)]) ** 2 / len(g)
        start += len(g)
    h = 12 / (n * (n + 1)) * total - 3 * (n + 1)
    return h / (1 - tie_term(both) / (n**3 - n))


@pytest.fixture(scope="module")
def sample():
    chance = random.Random(3)
    return [
        (chance.choice("aaaab"), round(chance.lognormvariate(3, 1)), chance.random() < 0.4,
         chance.choice(["Cool", "Normal", "Hot", None]))
        for _ in range(300)
    ]


@pytest.mark.parametrize("rules", [SkewRules(), CUT])
def test_against_brute_force(spark, sample, rules):
    data = frame(spark, [(e, float(p), r, b) for e, p, r, b in sample])
    mw = {r["entity"]: r for r in ranktests.mann_whitney(data, rules).collect()}
    kw = {r["entity"]: r for r in ranktests.kruskal_wallis(data, rules).collect()}
    for e in "ab":
        x = [p for n, p, rainy, _ in sample if n == e and rainy]
        y = [p for n, p, rainy, _ in sample if n == e and not rainy]
        u, z, p = mann_whitney(x, y)
        assert mw[e]["u"] == u
        assert mw[e]["z"] == pytest.approx(z, abs=1e-4)
        assert mw[e]["p"] == pytest.approx(p, abs=1e-4)
        groups = [[p for n, p, _, b in sample if n == e and b == band]
                  for band in ("Cool", "Normal", "Hot")]
        h = kruskal(groups)
        assert kw[e]["h"] == pytest.approx(h, abs=1e-4)
        assert kw[e]["df"] == 2
        assert kw[e]["p"] == pytest.approx(math.exp(-h / 2), abs=1e-4)


def test_degenerate_cases(spark):
    data = frame(
        spark,
        [
            ("tied", 5.0, True, "Hot"), ("tied", 5.0, False, "Cool"),
            ("dry", 5.0, False, "Hot"), ("dry", 6.0, False, "Hot"),
            ("unknown", 5.0, None, None),
            ("two", 1.0, True, "Hot"), ("two", 2.0, False, "Cool"), ("two", 3.0, False, "Cool"),
        ],
    )
    mw = {r["entity"]: (r["u"], r["z"], r["p"]) for r in ranktests.mann_whitney(data).collect()}
    assert mw["tied"] == mw["dry"] == (None, None, None)
    assert "unknown" not in mw
    assert mw["two"][0] == 0.0
    kw = {r["entity"]: (r["h"], r["df"], r["p"]) for r in ranktests.kruskal_wallis(data).collect()}
    assert kw["tied"] == kw["dry"] == (None, None, None)
    h = kruskal([[1.0], [2.0, 3.0]])
    assert kw["two"] == (
        pytest.approx(h, abs=1e-4), 1, pytest.approx(math.erfc(math.sqrt(h / 2)), abs=1e-4)
    )


def test_report(spark, sample):
    data = frame(spark, [(e, float(p), r, b) for e, p, r, b in sample])
    report = {r["entity"]: r for r in ranktests.rank_test_report(data).collect()}
    mw = {r["entity"]: r for r in ranktests.mann_whitney(data).collect()}
    for e in "ab":
        assert report[e]["rain_p"] == mw[e]["p"]
        assert report[e]["rain_significant"] == (mw[e]["p"] < 0.05)
