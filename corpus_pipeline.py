"""A corpus pipeline: five stages, each a whole pass over what the one before kept.

``run`` writes each stage's result as Parquet to the shared folder and reads it again, so a
lost executor costs tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm import langid, mixing, packing, secrets, simhash
from pricetide.llm.common import documents, stored
from pricetide.llm.queries import vocabulary


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of texts."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; texts without letters and ambiguous ones go."""
    return langid.keep_known(docs, langid.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at 2 bits and less."""
    return simhash.without_near_duplicates(docs, simhash.SimHashRules(shingle=3, most_bits=2))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced."""
    return _recounted(secrets.redacted(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; documents come as often as they are taken."""
    return _recounted(mixing.mixed_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 token ids, a row per piece."""
    return packing.pack(docs, packing.PackRules(vocabulary("word_bpe_49k.json")))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("pack", pack),
]

#: Hashing, learning and tokenizing stages are beyond SQL; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
