"""One query per operator over its whole table, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricetide.llm import (
    collisions,
    editprints,
    langid,
    mixing,
    negatives,
    packing,
    quality,
    records,
    secrets,
    simhash,
    substrings,
    topk,
    whitening,
)
from pricetide.llm.common import documents, held_out, stored
from pricetide.session import scratch_dir

QUERIES: dict = {}
TWINS: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op6_packing(spark, sf_dir):
    """Every document packed into sequences of at most 2048 ids."""
    rules = packing.PackRules(vocabulary("word_bpe_49k.json"))
    return packing.pack(documents(spark, sf_dir), rules).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query
def op9_binary_records(spark, sf_dir):
    """Every document as a binary record, written and read back."""
    folder = scratch_dir(spark, "records")
    rules = records.RecordRules(vocabulary("byte_bpe_50k.json"))
    records.write_records(documents(spark, sf_dir), folder, rules)
    return records.read_records(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op7_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op5_language_id(spark, sf_dir):
    """Language of every document, learned from those not held out."""
    docs = documents(spark, sf_dir)
    model = langid.train(docs)
    return langid.predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


@query
def op3_quality(spark, sf_dir):
    """Quality of every document, learned from labels of those not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    found = quality.classify(documents(spark, sf_dir), labels)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op10_edit_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its text mixed with the next one's, and its class of near copies."""
    signed = stored(editprints.edited(documents(spark, sf_dir)), "edited")
    return editprints.near_classes(signed).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
        "class_id",
        "n_links",
    )


@query
def op8_mixing(spark, sf_dir):
    """How many words the mix takes of every document."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op1_secret_scan(spark, sf_dir):
    """Secrets in every document."""
    return secrets.digest(secrets.scan(documents(spark, sf_dir)))


@query
def op2_exact_top_k(spark, sf_dir):
    """The 20 best other vectors of every twentieth vector."""
    return topk.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


TWINS["op2_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.n, q.vec_id AS query_id, v.vec_id, list_dot_product(q.e::DOUBLE[], v.e::DOUBLE[])::BIGINT AS score
  FROM v AS q JOIN v ON q.n <> v.n
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM pairs
QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) <= 20
"""


@query
def op4_substring_dedup(spark, sf_dir):
    """Every document without the windows of 50 words that an earlier one has."""
    return substrings.without_repeats(documents(spark, sf_dir))


TWINS["op8_mixing"] = r"""
WITH counted AS (
  SELECT doc_id, source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT
           AS size,
         md5('mix/' || coalesce(doc_id::VARCHAR, '-')) AS mark,
         ('0x' || substr(md5('mix/' || coalesce(doc_id::VARCHAR, '-')), 1, 8))::BIGINT AS number
  FROM documents
), parts AS (
  SELECT greatest(64, ceil(count(*) / 131072), ceil(sum(size) / 134217728))::BIGINT AS n FROM counted
), sized AS (
  SELECT *, number % (SELECT n FROM parts) AS shard FROM counted
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, 2 * source_size AS cap,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight
  FROM sources
), filled AS (
  SELECT *, 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS mix,
         coalesce(sum(cap) OVER before, 0)::DOUBLE AS filled,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS open,
         row_number() OVER (ORDER BY cap::DOUBLE / weight, source IS NULL, source) AS place
  FROM weighted
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, source IS NULL, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT arg_min(greatest((mix - filled) / open, 0), place) AS level FROM filled
  WHERE greatest((mix - filled) / open, 0) <= cap::DOUBLE / weight
), aimed AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(level * weight, cap::DOUBLE)) AS target
  FROM filled, levels
), scale AS (
  SELECT greatest(1, floor(min(target) FILTER (target > 0) / (100 * (SELECT n FROM parts))))::BIGINT AS block FROM aimed
), shards AS (
  SELECT source, shard, sum(size)::BIGINT AS shard_size,
         ceil(sum(size)::DOUBLE / (SELECT block FROM scale))::BIGINT AS shard_blocks
  FROM sized GROUP BY source, shard
), claims AS (
  SELECT a.source, 2 * source_blocks AS most, target / greatest(source_size, 1) * source_blocks AS votes
  FROM aimed a JOIN (SELECT source, sum(shard_blocks)::BIGINT AS source_blocks FROM shards GROUP BY source) c
    ON a.source IS NOT DISTINCT FROM c.source
), quotas AS (
  SELECT source, count(*) AS quota FROM (
    SELECT source, seat, row_number() OVER (ORDER BY votes / (2 * seat + 1) DESC, source IS NULL, source, seat) AS place
    FROM (SELECT source, votes, unnest(range(0, most)) AS seat FROM claims WHERE votes > 0))
  WHERE place <= (SELECT round(sum(votes)) FROM claims) GROUP BY source
), seats AS (
  SELECT source, shard, count(*) AS seats FROM (
    SELECT source, shard, quota,
           row_number() OVER (PARTITION BY source ORDER BY shard_blocks::DOUBLE / (2 * seat + 1) DESC, shard, seat) AS place
    FROM (SELECT h.source, shard, shard_blocks, quota, unnest(range(0, 2 * shard_blocks)) AS seat
          FROM shards h JOIN quotas q ON h.source IS NOT DISTINCT FROM q.source))
  WHERE place <= quota GROUP BY source, shard
), due AS (
  SELECT h.source, h.shard, shard_size, shard_blocks,
         coalesce(seats, 0) // greatest(shard_blocks, 1) AS rounds, coalesce(seats, 0) % greatest(shard_blocks, 1) AS rest,
         ('0x' || substr(md5('mix/start/' || coalesce(h.source, '-') || '/' || h.shard), 1, 8))::BIGINT
           % greatest(shard_blocks, 1) AS start
  FROM shards h LEFT JOIN seats s ON h.source IS NOT DISTINCT FROM s.source AND h.shard = s.shard
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY mark, doc_id NULLS FIRST, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized
)
SELECT p.doc_id, p.size, a.source_size, a.target,
       (rounds * p.size
        + greatest(0, least(ahead + p.size, (start + rest) * block, shard_size) - greatest(ahead, start * block))
        + greatest(0, least(ahead + p.size, greatest(0, start + rest - shard_blocks) * block) - ahead))::BIGINT AS taken
FROM placed p
JOIN aimed a ON p.source IS NOT DISTINCT FROM a.source
JOIN due d ON p.source IS NOT DISTINCT FROM d.source AND p.shard = d.shard, scale
"""


@query
def op11_nearest_by_collisions(spark, sf_dir):
    """The 20 nearest other vectors found of every twentieth vector."""
    return collisions.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_whitening(spark, sf_dir):
    """Every vector on the eight main axes of all, at unit variance."""
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op13_hard_negatives(spark, sf_dir):
    """Hard negatives for the positives of every hundredth vector."""
    return negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


TWINS["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
         list_dot_product(a.e::DOUBLE[], v.e::DOUBLE[])::BIGINT AS score
  FROM v AS a JOIN v ON a.vec_id <> v.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT same
WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""
