"""Rank tests of price levels under different conditions.

Ranks come from a frequency table (entity, price, count per condition), not from
sorting observations: repeated prices are combined before the shuffle, and the
running count over distinct prices is taken in slices for entities with very
many of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.config import SkewRules
from pricetide.functions import scalars as S
from pricetide.operators.skew import running_total_before
from pricetide.session import materialise


# The compared groups of observations and their conditions.
RAIN_GROUPS = {"rain": "is_rainy", "dry": "NOT is_rainy"}
BAND_GROUPS = {
    "cool": "temperature_band = 'Cool'",
    "normal": "temperature_band = 'Normal'",
    "hot": "temperature_band = 'Hot'",
}


def price_frequencies(base: DataFrame, groups: dict[str, str]) -> DataFrame:
    """Per (entity, price): how many observations each group holds, written out.

    Everything after this reads the table, so the observations are read once.
    """
    counts = [
        F.expr(f"cast(count_if({condition}) AS double) AS n_{g}")
        for g, condition in groups.items()
    ]
    table = (
        base.where("price IS NOT NULL")
        .selectExpr("*", "cast(price AS double) AS _price")
        .groupBy("entity", F.col("_price").alias("price"))
        .agg(*counts)
    )
    return materialise(table, "frequencies")


def rank_sums(frequencies: DataFrame, groups, rules: SkewRules = SkewRules()) -> DataFrame:
    """Per entity: ``n_<g>`` and ``r_<g>`` (rank sum) of each group, ``n`` and the
    tie term ``ties``.  Observations in no group do not take part."""
    total = " + ".join(f"n_{g}" for g in groups)
    tied = frequencies.selectExpr(
        "entity", "price", *[f"n_{g}" for g in groups], f"{total} AS t"
    ).where("t > 0")
    ranked = running_total_before(tied, ["entity"], "price", F.col("t"), "before", rules)
    return (
        ranked.withColumn("mid_rank", F.expr("before + (t + 1) / 2"))
        .groupBy("entity")
        .agg(
            F.expr("sum(t) AS n"),
            F.expr("sum(t * t * t - t) AS ties"),
            *[F.expr(f"sum(n_{g}) AS n_{g}") for g in groups],
            *[F.expr(f"sum(n_{g} * mid_rank) AS r_{g}") for g in groups],
        )
    )


def mann_whitney(base: DataFrame, rules: SkewRules = SkewRules()) -> DataFrame:
    """Rain against dry prices per entity: U of the rain side, z and two-sided p.

    Statistics are NULL when a side is empty or all prices are tied.
    """
    return mann_whitney_of(price_frequencies(base, RAIN_GROUPS), rules)


def mann_whitney_of(frequencies: DataFrame, rules: SkewRules = SkewRules()) -> DataFrame:
    sums = rank_sums(frequencies, RAIN_GROUPS, rules)
    n, n1, n2 = F.col("n"), F.col("n_rain"), F.col("n_dry")
    both = (n1 > 0) & (n2 > 0)
    u = F.when(both, F.col("r_rain") - n1 * (n1 + 1) / 2)
    variance = n1 * n2 / 12 * ((n + 1) - F.col("ties") / F.nullif(n * (n - 1), F.lit(0.0)))
    spread = F.when(both & (variance > 0), F.sqrt(variance))
    distance = F.abs(F.col("u") - n1 * n2 / 2)
    z = F.greatest(distance - 0.5, F.lit(0.0)) / F.col("spread")
    return (
        sums.withColumns({"u": u, "spread": spread})
        .withColumn("z", z)
        .select(
            "entity",
            n1.cast("long").alias("rain_observations"),
            n2.cast("long").alias("dry_observations"),
            F.when(F.col("spread").isNotNull(), F.col("u")).alias("u"),
            S.half_up(F.col("z"), 4).alias("z"),
            S.half_up(S.normal_two_sided_p(F.col("z")), 4).alias("p"),
        )
    )


def kruskal_wallis(base: DataFrame, rules: SkewRules = SkewRules()) -> DataFrame:
    """Prices across the temperature bands per entity: H, df and p.

    Empty bands drop out; fewer than two bands or all prices tied give NULL.
    """
    return kruskal_wallis_of(price_frequencies(base, BAND_GROUPS), rules)


def kruskal_wallis_of(frequencies: DataFrame, rules: SkewRules = SkewRules()) -> DataFrame:
    bands = BAND_GROUPS
    sums = rank_sums(frequencies, bands, rules)
    n = F.col("n")
    used = sum(F.when(F.col(f"n_{g}") > 0, 1).otherwise(0) for g in bands)
    terms = sum(
        F.coalesce(
            F.col(f"r_{g}") * F.col(f"r_{g}") / F.nullif(F.col(f"n_{g}"), F.lit(0.0)), F.lit(0.0)
        )
        for g in bands
    )
    untied = 1 - F.col("ties") / F.nullif(n * n * n - n, F.lit(0.0))
    raw = F.lit(12.0) / (n * (n + 1)) * terms - 3 * (n + 1)
    h = F.when((used >= 2) & (untied > 0), F.greatest(raw / F.nullif(untied, F.lit(0.0)), F.lit(0.0)))
    p = F.when(F.col("df") == 2, F.exp(-F.col("h") / 2)).when(
        F.col("df") == 1, S.normal_two_sided_p(F.sqrt("h"))
    )
    return (
        sums.withColumns({"h": h, "df": used - 1})
        .select(
            "entity",
            *[F.col(f"n_{g}").cast("long").alias(f"{g}_observations") for g in bands],
            S.half_up(F.col("h"), 4).alias("h"),
            F.when(F.col("h").isNotNull(), F.col("df")).cast("int").alias("df"),
            S.half_up(p, 4).alias("p"),
        )
    )


def rank_test_report(
    base: DataFrame, level: float = 0.05, rules: SkewRules = SkewRules()
) -> DataFrame:
    """Both tests side by side with their pass marks."""
    frequencies = price_frequencies(base, RAIN_GROUPS | BAND_GROUPS)
    rain = mann_whitney_of(frequencies, rules).select(
        "entity", F.col("u").alias("rain_u"), F.col("p").alias("rain_p")
    )
    bands = kruskal_wallis_of(frequencies, rules).select(
        "entity", F.col("h").alias("temperature_h"), F.col("p").alias("temperature_p")
    )

    def passes(p: str) -> Column:
        return F.coalesce(F.col(p) < level, F.lit(False))

    return rain.join(bands, "entity", "full").select(
        "entity",
        "rain_u",
        "rain_p",
        passes("rain_p").alias("rain_significant"),
        "temperature_h",
        "temperature_p",
        passes("temperature_p").alias("temperature_significant"),
    )
