"""Mixing sources to target weights by Sainte-Laguë apportionment.

In each shard of a source the documents lie one after the other in a seeded order, and
this line of words is cut into blocks of equal length, the last one shorter.  The blocks
of the mix go to sources, and within a source to its shards, by highest quotients: the
next block goes to whoever has the largest claim divided by twice its blocks plus one,
among those that have not reached their limit.  A shard gives all its blocks as
often as its quota holds them whole, and for the rest a run of blocks from a seeded start,
going on from the first block after the last.

Everything is DataFrame operations: documents are summed up by source and shard before
anything is ranked, and a shard, never a source, is what one task orders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import n_words, stored, words


@dataclass(frozen=True)
class MixRules:
    """``weights`` repeat over the sources by name, null last; ``share`` is the size of the mix
    as a multiple of all words, ``most_copies`` how often a document may be taken.

    ``shards`` is how many shards a source has at least; there are more once the
    table holds more than ``shard_rows`` rows or ``shard_words`` words per shard.  A block has as
    many words as a shard's part of the smallest target holds ``blocks`` times, so short
    blocks count for little even in the smallest source.
    """

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most_copies: int = 2
    shards: int = 64
    shard_rows: int = 1 << 17
    shard_words: int = 1 << 27
    blocks: int = 100
    seed: str = "mix"


def targets(sizes: DataFrame, rules: MixRules) -> DataFrame:
    """``source, source_size, target`` from the words of each source.

    What exceeds a source's limit is shared again by weight until no source is above
    its limit: sources are filled in the order of limit per weight, and the rest
    is level.
    """
    everyone = Window.orderBy(F.col("source").isNull(), "source")
    places = F.pmod(F.row_number().over(everyone) - 1, F.lit(len(rules.weights)))
    weight = F.lit(rules.weights[-1])
    for k, x in reversed(list(enumerate(rules.weights[:-1]))):
        weight = F.when(places == k, x).otherwise(weight)
    weighted = sizes.select("source", "source_size", weight.cast("long").alias("weight")).withColumn(
        "limit", rules.most_copies * F.col("source_size")
    )
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = weighted.select(
        "*",
        (rules.share * F.sum("source_size").over(everything)).alias("mix"),
        F.coalesce(F.sum("limit").over(before), F.lit(0)).alias("filled"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open"),
    )
    # The level at which the mix is full if this source and those after it are not.
    level = F.greatest((F.col("mix") - F.col("filled")) / F.col("open"), F.lit(0.0))
    fits = level <= F.col("limit") / F.col("weight")
    order = F.row_number().over(by_limit)
    levelled = filled.withColumn("first_fit", F.when(fits, F.struct(order.alias("place"), level.alias("level"))))
    levelled = levelled.withColumn("level", F.min("first_fit").over(everything)["level"])
    full = F.col("limit").cast("double")
    return levelled.select(
        "source",
        "source_size",
        F.when(F.col("level").isNull(), full)
        .otherwise(F.least(full, F.col("level") * F.col("weight")))
        .alias("target"),
    )


def apportion(
    parties: DataFrame, house: str, within: list[str], name: list[str], limit: str | None = None
) -> DataFrame:
    """Sainte-Laguë: adds ``seats`` to ``parties``, whose votes are in ``votes``.

    The groups named by ``within`` are houses of their own, with ``house`` seats each.
    Rounding votes over any divisor is an apportionment for some house.  A divisor
    that surely seats too few gives the start; the seats left go to the highest of the
    next quotients, of which each party lists just those that a divisor that surely
    seats enough would give it.  Ties go to the first party by ``name``.

    No party gets more seats than its ``limit``, a whole number not below its share of the
    house; what it would have won goes to the next quotients of others.
    """
    group = Window.partitionBy(*within)
    parties = parties.withColumn("voters", F.sum("votes").over(group)).withColumn(
        "parties", F.sum(F.when(F.col("votes") > 0, 1).otherwise(0)).over(group)
    )

    def seated(seats):
        share = F.col("votes").cast("double") * seats / F.col("voters")
        return F.when(F.col("votes") > 0, F.floor(share + 0.5)).otherwise(0).cast("long")

    few = seated(F.greatest(F.col(house) - F.col("parties"), F.lit(0)))
    many = seated(F.col(house) + F.col("parties"))
    # Shares rounded up always fill the house, however many parties are at their limit.
    share = F.ceil(F.col("votes").cast("double") * F.col(house) / F.col("voters"))
    enough = F.greatest(few, many, F.when(F.col("votes") > 0, share).otherwise(0).cast("long"))
    if limit is not None:
        few, enough = F.least(few, F.col(limit)), F.least(enough, F.col(limit))
    started = parties.withColumn("start", few).withColumn("end", enough)
    left = (F.col(house) - F.sum("start").over(group)).alias("left")
    offers = (
        started.select("*", left)
        .where(F.col("end") > F.col("start"))
        .select("*", F.explode(F.sequence("start", F.col("end") - 1)).alias("seat"))
        .withColumn("quotient", F.col("votes") / (2 * F.col("seat") + 1))
    )
    best = Window.partitionBy(*within).orderBy(
        F.desc("quotient"), *(x for c in name for x in (F.col(c).isNull(), F.col(c))), "seat"
    )
    won = (
        offers.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= F.col("left"))
        .groupBy(*within, *name)
        .agg(F.count(F.lit(1)).alias("won"))
    )
    keys = list(dict.fromkeys([*within, *name]))
    same = None
    renamed = won.select("won", *(F.col(c).alias(f"won_{c}") for c in keys))
    for c in keys:
        match = F.col(c).eqNullSafe(F.col(f"won_{c}"))
        same = match if same is None else same & match
    return started.join(renamed, same, "left").withColumn(
        "seats", F.col("start") + F.coalesce("won", F.lit(0))
    ).drop("voters", "parties", "start", "end", "won", *(f"won_{c}" for c in keys))


def _drawn(*parts) -> Column:
    """A seeded number of 32 bits."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 8), 16, 10).cast("long")


def mix(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``docs``.

    ``taken`` is how many of its words the mix takes, repeats counted, at most
    ``most_copies`` times its size.  A null text has no words, a null source is one of
    its own.  Rows that repeat an id are documents of their own.  If there are no words
    at all nothing is taken; an empty table gives no rows.

    Of each source its target is taken but for the rounding to a block and the
    short blocks among those taken, at most one a shard.
    """
    name = (F.lit(rules.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
        F.md5(F.concat_ws("/", *name)).alias("mark"),
        _drawn(*name).alias("number"),
    )
    sized = stored(sized, "sizes")
    rows, total = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = max(rules.shards, -(-rows // rules.shard_rows), -(-total // rules.shard_words))
    sized = sized.withColumn("shard", F.pmod("number", F.lit(shards).cast("long")))
    by_shard = stored(sized.groupBy("source", "shard").agg(F.sum("size").alias("shard_size")), "shards")
    sizes = by_shard.groupBy("source").agg(F.sum("shard_size").alias("source_size"))
    aimed = stored(targets(sizes, rules), "targets")
    # One number: the words of a block.
    least = aimed.where(F.col("target") > 0).agg(F.min("target")).first()[0]
    block = max(1, int((least or 0) // (rules.blocks * shards)))

    of_source = F.col("source").eqNullSafe(F.col("of"))
    by_shard = by_shard.withColumn("shard_blocks", F.ceil(F.col("shard_size") / block).cast("long"))
    counted = by_shard.groupBy(F.col("source").alias("of")).agg(F.sum("shard_blocks").alias("source_blocks"))
    # A source claims the blocks that hold its target on the average of its own blocks.
    share = F.col("target") / F.greatest("source_size", F.lit(1))
    claims = aimed.join(counted, of_source).drop("of").withColumn("votes", share * F.col("source_blocks"))
    claims = claims.withColumn("blocks", F.round(F.sum("votes").over(Window.partitionBy())).cast("long"))
    claims = claims.withColumn("house", F.lit(0)).withColumn("limit", rules.most_copies * F.col("source_blocks"))
    quotas = stored(
        apportion(claims, "blocks", ["house"], ["source"], "limit").select(
            "source", "source_size", "target", F.col("seats").alias("quota")
        ),
        "quotas",
    )
    shared = by_shard.join(quotas.withColumnRenamed("source", "of"), of_source).drop("of")
    shared = shared.withColumn("votes", F.col("shard_blocks")).withColumn(
        "limit", rules.most_copies * F.col("shard_blocks")
    )
    dealt = apportion(shared, "quota", ["source"], ["shard"], "limit").select(
        F.col("source").alias("of"),
        F.col("shard").alias("of_shard"),
        "source_size",
        "target",
        F.col("seats").alias("due"),
        "shard_size",
        "shard_blocks",
    )
    # The run of blocks: from ``opens`` to ``closes`` in words, or around the end of the line.
    blocks = F.greatest("shard_blocks", F.lit(1))
    start = _drawn(
        F.lit(rules.seed), F.lit("start"), F.coalesce("of", F.lit("-")), F.col("of_shard").cast("string")
    )
    dealt = (
        dealt.withColumn("rounds", F.expr("due div greatest(shard_blocks, 1)"))
        .withColumn("rest", F.col("due") - F.col("rounds") * F.col("shard_blocks"))
        .withColumn("first", F.pmod(start, blocks))
        .withColumn("last", F.col("first") + F.col("rest"))
        .withColumn("opens", F.col("first") * block)
        .withColumn("closes", F.least(F.col("last") * block, F.col("shard_size")))
        .withColumn("again", F.greatest(F.lit(0), F.col("last") - F.col("shard_blocks")) * block)
    )
    line = Window.partitionBy("source", "shard").orderBy("mark", "doc_id", "size")
    before = F.coalesce(
        F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = sized.withColumn("ahead", before).join(
        dealt, of_source & (F.col("shard") == F.col("of_shard"))
    )

    def within(opens, closes) -> Column:
        """Words of the document between two places of the line."""
        end = F.least(F.col("ahead") + F.col("size"), closes)
        return F.greatest(F.lit(0), end - F.greatest(F.col("ahead"), opens))

    part = within(F.col("opens"), F.col("closes")) + within(F.lit(0), F.col("again"))
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("rounds") * F.col("size") + part).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken.

    A document taken in part comes cut after as many words as are taken, and one not taken
    at all is left out, unless it has no words, as it then takes nothing from
    the mix.  Other columns stay as they are.
    """
    taken = mix(docs, rules).select(
        F.col("doc_id").alias("of"), F.col("size").alias("of_size"), F.col("source").alias("of_source"), "taken"
    )
    # Rows that repeat an id, a source and a size are numbered to tell them apart.
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
    )
    own = Window.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64("row.text"))
    other = Window.partitionBy("of", "of_source", "of_size").orderBy(F.desc("taken"))
    same = (
        F.col("doc_id").eqNullSafe(F.col("of"))
        & F.col("source").eqNullSafe(F.col("of_source"))
        & (F.col("size") == F.col("of_size"))
        & (F.col("copy") == F.col("of_copy"))
    )
    joined = rows.withColumn("copy", F.row_number().over(own)).join(
        taken.withColumn("of_copy", F.row_number().over(other)), same
    )
    whole = F.floor(F.col("taken") / F.greatest("size", F.lit(1)))
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    times = F.when(F.col("size") == 0, 1).otherwise(whole + F.when(rest > 0, 1).otherwise(0)).cast("int")
    repeated = (
        joined.select("row", "size", rest.alias("rest"), times.alias("times"))
        .where("times > 0")
        .withColumn("turn", F.explode(F.sequence(F.lit(1), "times")))
    )
    partial = (F.col("size") > 0) & (F.col("turn") == F.col("times")) & (F.col("rest") > 0)
    text = F.when(partial, F.array_join(F.slice(words(F.col("row.text")), 1, F.greatest("rest", F.lit(1))), " "))
    text = text.otherwise(F.col("row.text"))
    return repeated.select(*(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
