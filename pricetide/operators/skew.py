"""Cutting very large groups into ordered slices.

A window over a key needs all rows of the key in one task.  For a key holding a
large share of the table that task would never end, so such keys are cut along
their order column and each slice becomes a group of its own.  What a window
needs from the slices before it (the last row, or a running total) is computed
per slice with a combinable aggregate and handed on as one extra row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.config import SkewRules

SLICE = "_slice"
CARRY = "_carry"


def add_slices(
    rows: DataFrame, keys: Sequence[str], order: str, rules: SkewRules = SkewRules()
) -> DataFrame:
    """Add ``_slice``: NULL for ordinary keys, else a number rising with ``order``.

    A key with at least ``hot_rows`` rows is cut at approximate quantiles of ``order``, so
    its slices hold about equally many rows however the values are spread.  Rows with
    equal ``order`` always share a slice, rows without are in the first.  Results do not
    depend on the cutting: a table with fewer rows than ``hot_rows`` just has no
    such key, and is not looked through for one.
    """
    plain = rows.withColumn(SLICE, F.lit(None).cast("long"))
    if rows.count() < rules.hot_rows:
        return plain
    hot = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= rules.hot_rows)
        .selectExpr(*[f"{k} AS _hot_{i}" for i, k in enumerate(keys)], "_n")
    )
    most = hot.agg(F.max("_n")).first()[0]
    if most is None:
        return plain
    slices = -(-most // rules.rows_per_slice)
    shares = [k / slices for k in range(1, slices)] or [0.5]
    same_key = F.expr(" AND ".join(f"{k} <=> _hot_{i}" for i, k in enumerate(keys)))
    bounds = (
        rows.join(hot, same_key, "left_semi")
        .groupBy(*keys)
        .agg(F.percentile_approx(order, shares, max(10_000, 10 * slices)).alias("_bounds"))
        .selectExpr(
            *[f"{k} AS _hot_{i}" for i, k in enumerate(keys)],
            "coalesce(array_distinct(_bounds), array()) AS _bounds",
        )
    )
    # Joined as Spark sees fit: it splits the hot keys themselves, and sends few bounds whole.
    return rows.join(bounds, same_key, "left").selectExpr(
        *rows.columns,
        f"""CASE WHEN _bounds IS NULL THEN cast(NULL AS bigint)
                 ELSE cast(size(filter(_bounds, b -> b < {order})) AS bigint) END AS {SLICE}""",
    )


def with_last_row_of_previous_slice(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], kept: Sequence[str]
) -> DataFrame:
    """Add, to each slice of a hot key, the last row of the slice before it.

    The added rows hold ``keys``, ``order`` and ``kept`` and have ``_carry`` set.
    """
    last = F.max(F.struct(*order, *kept))
    following = F.lead(SLICE).over(Window.partitionBy(*keys).orderBy(SLICE))
    carried = (
        rows.where(F.col(SLICE).isNotNull())
        .groupBy(*keys, SLICE)
        .agg(last.alias("_last"))
        .withColumn("_following", following)
        .where(F.col("_following").isNotNull())
        .select(
            *keys,
            F.col("_following").alias(SLICE),
            *[F.col(f"_last.{c}").alias(c) for c in (*order, *kept)],
            F.lit(True).alias(CARRY),
        )
    )
    return rows.unionByName(carried, allowMissingColumns=True)


def running_total_before(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    amount: Column,
    name: str,
    rules: SkewRules = SkewRules(),
) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over the rows of the key ordered before.

    ``order`` must be unique within a key and not NULL.
    """
    sliced = add_slices(rows.withColumn("_amount", amount), keys, order, rules)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.where(F.col(SLICE).isNotNull())
        .groupBy(*keys, SLICE)
        .agg(F.sum("_amount").alias("_amount"))
        .withColumn("_amount", F.coalesce(F.sum("_amount").over(earlier), F.lit(0)))
        .withColumn(CARRY, F.lit(True))
    )
    before = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(F.col(order).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        sliced.unionByName(carried, allowMissingColumns=True)
        .withColumn(name, F.coalesce(F.sum("_amount").over(before), F.lit(0)))
        .where(F.col(CARRY).isNull())
        .drop("_amount", SLICE, CARRY)
    )


def running_max_before(
    sliced: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, name: str
) -> DataFrame:
    """Add ``name``: the greatest ``amount`` of the rows of the key ordered before, NULL if there is none.

    ``sliced`` comes from :func:`add_slices`, whose slices follow the first of ``order``, which is
    not NULL.  The slices of a hot key hand on their maximum in one row each.
    """
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.where(F.col(SLICE).isNotNull())
        .groupBy(*keys, SLICE)
        .agg(F.max(amount).alias(amount))
        .withColumn(amount, F.max(amount).over(earlier))
        .withColumn(CARRY, F.lit(True))
    )
    before = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(*[F.col(c).asc_nulls_first() for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        sliced.unionByName(carried, allowMissingColumns=True)
        .withColumn(name, F.max(amount).over(before))
        .where(F.col(CARRY).isNull())
        .drop(CARRY)
    )
