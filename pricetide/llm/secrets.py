"""Secret scans: fixed patterns, and a battery of randomness tests.

Patterns find assignments, access keys and long hexadecimal strings.  Beside them every
long run of encoding characters is a candidate.  Its encoding (hexadecimal, base 32,
letters, base 62, base 64) is inferred from its characters, each becomes its place in
that alphabet, and three tests follow:

* chi-squared: are all characters of the alphabet equally frequent;
* runs: does the sequence change between the lower and upper half as often as chance does;
* serial correlation: does a character tell the next.

A secret must pass all three as random, and must also be unlike ordinary text.  The second
is a p-value of two parts, joined by Fisher's rule: how likely ordinary text of the same
length and encoding has so few repeated characters, and how likely it changes so often
between small letters, capitals and digits, given the character frequencies and changes of
all ordinary candidates of the table.  Encodings of one class have the first part only.  The
longer the candidate, the smaller this can be.  Candidates are judged in strata of
encoding and length, in each of which Benjamini and Hochberg's rule keeps the share of
false discoveries below ``rate``.

Only DataFrame functions are used; what is gathered is a count per character and a
histogram of p-values per stratum.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.llm.common import stored

# Patterns, the group that must have the least length, and that length.  The
# last two say the length in the pattern, which gives the same spans: within a run that
# is too short there is no longer one.
KINDS: tuple[tuple[str, str, int, int], ...] = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"(AKIA[A-Z0-9]{16,})", 1, 20),
    ("hex", r"([0-9a-f]{24,})", 1, 24),
)

#: Runs of encoding characters; ``-`` and ``_`` stand for ``+`` and ``/`` in one form of base 64.
_CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}"
_ALPHABETS: tuple[tuple[str, str, str], ...] = (
    ("hex", "^(?=.*[0-9])[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", "^(?=.*[0-9])[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", "^(?=.*[2-7])[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower", "^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base36", "^[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "^[A-Z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)


#: Places between two letters or digits, and those where their class changes.
_JOINT = "(?<=[A-Za-z0-9])(?=[A-Za-z0-9])"
_CHANGE = "(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])"


@dataclass(frozen=True)
class SecretRules:
    """``shortest`` is a candidate's least length, ``random`` the level at which the tests
    reject randomness, ``rate`` the false discovery rate.

    Ordinary text is taken to change its class at no fewer than ``changes`` of its places, and
    ``case_changes`` in encodings with both cases, as words joined by capitals do.  What a
    table's own text says counts from about ``joints`` places on.
    """

    shortest: int = 20
    random: float = 0.01
    rate: float = 0.01
    changes: float = 0.1
    case_changes: float = 0.3
    joints: int = 1000


_SPAN = "array<struct<start:int,end:int,found:string>>"


def _spans(text: Column, pattern: str) -> Column:
    """All matches as structs of start, end and the text, in code points."""
    none = F.array().cast(_SPAN)
    cut = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps")
    )

    def place(x):
        """A match starts after all gaps up to its own and all matches before it."""

        def step(so_far, k):
            start = so_far["at"] + F.length(x["gaps"][k])
            end = start + F.length(x["found"][k])
            span = F.struct(start.alias("start"), end.alias("end"), x["found"][k].alias("found"))
            return F.struct(end.alias("at"), F.concat(so_far["out"], F.array(span)).alias("out"))

        begin = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(x["found"]) - 1), begin, step, lambda x: x["out"])

    # The array of one element binds the pieces, which are then cut only once.
    return F.when(text.rlike(pattern), F.transform(F.array(cut), place)[0]).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns: kind, its place in the list, start and end."""

    def of_kind(place: int, kind: str, pattern: str, group: int, least: int) -> Column:
        long_enough = F.filter(
            _spans(text, pattern), lambda x: F.length(F.regexp_extract(x["found"], pattern, group)) >= least
        )
        return F.transform(
            long_enough,
            lambda x: F.struct(
                x["start"].alias("start"), F.lit(place).alias("place"), x["end"].alias("end"), F.lit(kind).alias("kind")
            ),
        )

    return F.array_sort(F.concat(*(of_kind(place, *kind) for place, kind in enumerate(KINDS))))


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def _normal_tail(z: Column) -> Column:
    """The chance that a normal variable lies above ``z``; Zelen and Severo's approximation."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    upper = (
        F.exp(-a * a / 2)
        / 2.5066282746310002
        * t
        * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    )
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _normal_tail(F.abs(z)))


def _alphabet(token: Column) -> tuple[Column, Column]:
    """The inferred encoding and its alphabet."""
    name, letters = F.lit(_ALPHABETS[-1][0]), F.lit(_ALPHABETS[-1][2])
    for encoding, pattern, alphabet in reversed(_ALPHABETS[:-1]):
        fits = token.rlike(pattern)
        name = F.when(fits, encoding).otherwise(name)
        letters = F.when(fits, alphabet).otherwise(letters)
    return name, letters


def candidates(docs: DataFrame, rules: SecretRules) -> DataFrame:
    """Candidates with their places: ``row, start, end, token, encoding, size, alphabet``."""
    found = docs.select("row", F.explode("candidates").alias("x")).select("row", "x.start", "x.end", F.col("x.found").alias("token"))
    plain = F.translate("token", "-_", "+/")
    encoding, letters = _alphabet(plain)
    return found.select(
        "row", "start", "end", plain.alias("token"), encoding.alias("encoding"), F.length("token").alias("n"), letters.alias("alphabet")
    )


def tested(tokens: DataFrame) -> DataFrame:
    """Adds the three tests' p-values of being random, the number of equal pairs, and of
    places between letters and digits and changes of class there."""
    numbers = F.expr("transform(filter(split(token, ''), x -> x <> ''), x -> locate(x, alphabet) - 1)")
    k = F.length("alphabet").cast("double")
    n = F.col("n").cast("double")
    placed = tokens.withColumn("numbers", numbers)
    squares = F.expr(
        "aggregate(transform(sequence(0, length(alphabet) - 1), a -> size(filter(numbers, x -> x = a))),"
        " 0.0D, (s, c) -> s + c * c)"
    )
    half = "length(alphabet) / 2"
    above = F.expr(f"size(filter(numbers, x -> x >= {half}))").cast("double")
    changes = F.expr(
        f"size(filter(sequence(1, n - 1), i -> (numbers[i] >= {half}) <> (numbers[i - 1] >= {half})))"
    ).cast("double")
    total = F.expr("aggregate(numbers, 0.0D, (s, x) -> s + x)")
    total_squares = F.expr("aggregate(numbers, 0.0D, (s, x) -> s + x * x)")
    products = F.expr("aggregate(sequence(1, n - 1), 0.0D, (s, i) -> s + numbers[i] * numbers[i - 1])")
    summed = placed.select(
        *tokens.columns,
        squares.alias("squares"),
        above.alias("above"),
        (changes + 1).alias("runs"),
        total.alias("total"),
        total_squares.alias("total_squares"),
        products.alias("products"),
        F.expr("numbers[0] * numbers[n - 1]").cast("double").alias("ends"),
        F.regexp_count("token", F.lit(_JOINT)).cast("long").alias("joints"),
        F.regexp_count("token", F.lit(_CHANGE)).cast("long").alias("changes"),
    )
    # Chi-squared by its exact first two moments: small counts make the usual table wrong.
    chi = k * F.col("squares") / n - n
    spread = F.sqrt(2 * (k - 1) * (n - 1) / n)
    p_chi = _normal_tail((chi - (k - 1)) / spread)
    below = n - F.col("above")
    expected = 2 * F.col("above") * below / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    p_runs = F.when(variance > 0, _two_sided((F.col("runs") - expected) / F.sqrt(variance))).otherwise(0.0)
    # Circular correlation of neighbours, about -1/(n-1) with variance 1/n by chance.
    centred = n * F.col("total_squares") - F.col("total") ** 2
    serial = (n * (F.col("products") + F.col("ends")) - F.col("total") ** 2) / centred
    p_serial = F.when(centred > 0, _two_sided((serial + 1 / (n - 1)) * F.sqrt(n))).otherwise(0.0)
    return summed.select(
        *tokens.columns,
        ((F.col("squares") - n) / 2).alias("equal_pairs"),
        p_chi.alias("p_chi"),
        p_runs.alias("p_runs"),
        p_serial.alias("p_serial"),
        "joints",
        "changes",
    )


def _often(changes: Column, joints: Column, rate: Column) -> Column:
    """About the chance of so many changes or more, by the root of the binomial deviance."""
    share = (changes - 0.5) / joints
    deviance = 2 * joints * (share * F.log(share / rate) + (1 - share) * F.log((1 - share) / (1 - rate)))
    return F.when((changes > 0) & (share > rate), _normal_tail(F.sqrt(F.greatest(deviance, F.lit(0.0))))).otherwise(1.0)


def discoveries(tokens: DataFrame, rules: SecretRules) -> DataFrame:
    """Candidates that pass as random and stand out from ordinary text."""
    k = F.length("alphabet")
    # Ordinary text is what the tests reject as random at any usual level.
    random = F.least("p_chi", "p_runs", "p_serial") * 3 >= rules.random
    judged = tokens.withColumn("random", random)
    # Fillings of one or two characters are no text, and would make all text look even.
    filling = F.col("equal_pairs") * 4 > F.col("n") * (F.col("n") - 1) / 2
    ordinary = judged.where(~F.col("random") & ~filling)
    counts = (
        ordinary
        .select("encoding", F.explode(F.expr("filter(split(token, ''), x -> x <> '')")).alias("letter"))
        .groupBy("encoding", "letter")
        .count()
    )
    share = Window.partitionBy("encoding")
    # At most one row per encoding.
    usual = (
        counts.withColumn("q", F.col("count") / F.sum("count").over(share))
        .groupBy("encoding")
        .agg(F.sum(F.col("q") ** 2).alias("same"), F.sum(F.col("q") ** 3).alias("thrice"))
    )
    changing = ordinary.groupBy("encoding").agg(
        F.sum("joints").alias("all_joints"), F.sum("changes").alias("all_changes")
    )
    usual = usual.join(changing, "encoding", "left")
    # Ordinary text is taken to be no more even than prose, should a table have little of it.
    same = F.greatest(F.coalesce("same", F.lit(0.0)), F.lit(0.065), 1.5 / k)
    thrice = F.greatest(F.coalesce("thrice", F.lit(0.0)), F.lit(0.0055), 3.0 / (k * k))
    n = F.col("n").cast("double")
    pairs = n * (n - 1) / 2
    mean = pairs * same
    variance = pairs * (same - same**2) + n * (n - 1) * (n - 2) * (thrice - same**2)
    z = (F.col("equal_pairs") - mean) / F.sqrt(F.greatest(variance, F.lit(1e-9)))
    few_pairs = F.greatest(_normal_tail(-F.col("z")), F.lit(1e-60))
    both_cases = F.col("encoding").isin("base62", "base64")
    least = F.when(both_cases, rules.case_changes).otherwise(rules.changes)
    known = F.coalesce("all_joints", F.lit(0))
    measured = (F.coalesce("all_changes", F.lit(0)) + rules.joints * least) / (known + rules.joints)
    often = _often(F.col("changes"), F.col("joints"), F.col("usually"))
    product = -F.log(F.col("few_pairs") * F.greatest(F.col("often"), F.lit(1e-60)))
    both = (1 + F.col("product")) * F.exp(-F.col("product"))
    p = F.when(F.col("encoding").isin("lower", "upper"), F.col("few_pairs")).otherwise(both)
    step = F.least(F.lit(600), F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-60))))).cast("int")
    stratum = F.floor(F.log2("n")).cast("int")
    # One step per column: each is used more than once by the next.
    weighed = (
        judged.join(F.broadcast(usual), "encoding", "left")
        .withColumn("z", z)
        .withColumn("usually", F.least(F.greatest(measured, least), F.lit(0.99)))
        .withColumn("few_pairs", few_pairs)
        .withColumn("often", often)
        .withColumn("product", product)
    )
    scored = weighed.select(
        "row", "start", "end", "encoding", "random", stratum.alias("stratum"), step.alias("step")
    )
    # Steps are tenths of a decade: at most 601 a stratum, whatever the input.
    histogram = scored.groupBy("encoding", "stratum", "step").agg(
        F.count(F.lit(1)).alias("all")
    )
    within = Window.partitionBy("encoding", "stratum")
    at_least = within.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    # Every p-value of a step counts as the largest the step can hold.
    found = F.sum("all").over(at_least)
    tried = F.sum("all").over(within)
    passing = F.pow(F.lit(10.0), -F.col("step") / 10) <= rules.rate * found / tried
    least_step = (
        histogram.withColumn("passing", passing)
        .where("passing")
        .groupBy("encoding", "stratum")
        .agg(F.min("step").alias("least_step"))
    )
    return (
        scored.join(F.broadcast(least_step), ["encoding", "stratum"])
        .where(F.col("random") & (F.col("step") >= F.col("least_step")))
        .select("row", "start", "end")
    )


def scan(docs: DataFrame, rules: SecretRules = SecretRules()) -> DataFrame:
    """``row, doc_id, text_hash, base, added`` for every row: arrays of spans.

    A span has ``start`` and ``end`` (code points, end exclusive), ``place`` and ``kind``.
    ``added`` holds random strings that no base span overlaps.  Null and empty texts have
    no spans; rows that repeat an id keep a row each; an empty table gives none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    first = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        base_spans(text).alias("base"),
        _spans(text, _CANDIDATE % rules.shortest).alias("candidates"),
    )
    spotted = stored(first, "spotted")
    tokens = stored(tested(candidates(spotted, rules)), "candidates")
    span = F.struct("start", F.lit(len(KINDS)).alias("place"), "end", F.lit("random").alias("kind"))
    random = (
        discoveries(tokens, rules)
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(span)).alias("added"))
    )
    joined = spotted.drop("candidates").join(random, "row", "left")
    added = F.expr(
        "filter(coalesce(added, array()), x -> not exists(base, b -> b.start < x.end and x.start < b.end))"
    )
    return joined.select("row", "doc_id", "text_hash", "base", added.alias("added"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the hash of the base spans, and all spans as text."""
    counts = [
        F.expr(f"size(filter(base, x -> x.kind = '{kind}'))").cast("long").alias(f"n_{kind}")
        for kind, _, _, _ in KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_random"),
    )


def redacted(docs: DataFrame, rules: SecretRules = SecretRules(), mark: str = "[secret]") -> DataFrame:
    """The rows of ``docs`` with every span in their texts replaced by ``mark``.

    Spans that overlap are replaced as one.  Other columns stay as they are.
    """
    found = scan(docs, rules).select(
        F.col("doc_id").alias("of"),
        F.col("text_hash").alias("of_hash"),
        F.array_sort(F.concat("base", "added")).alias("spans"),
    )
    # Rows of the same id and text have the same spans.
    known = found.where(F.size("spans") > 0).groupBy("of", "of_hash").agg(F.first("spans").alias("spans"))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))
    text = F.col("row.text")

    def step(so_far, x):
        gap = F.substring(text, so_far["at"] + 1, x["start"] - so_far["at"])
        apart = F.struct(x["end"].alias("at"), F.concat(so_far["out"], gap, F.lit(mark)).alias("out"))
        within = F.struct(F.greatest(so_far["at"], x["end"]).alias("at"), so_far["out"].alias("out"))
        return F.when(x["start"] >= so_far["at"], apart).otherwise(within)

    def end(so_far):
        return F.concat(so_far["out"], F.substring(text, so_far["at"] + 1, F.length(text)))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.when(F.col("spans").isNull(), text).otherwise(F.aggregate("spans", begin, step, end))
    return rows.join(known, same, "left").select(
        *(clean.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns)
    )
