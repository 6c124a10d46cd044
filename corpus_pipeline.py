"""Training-data pipeline over ``documents``.

Each stage takes the documents that its predecessor kept (read back from
Parquet) and returns documents with the same columns; the last returns the
packed pieces.

1. ``language``: documents that read as none of the languages learned from the
   ``lang`` column go (no letters, or a score well under those of the documents
   learned from, see ``langid.least_scores``).
2. ``quality``: documents that fail the base rules or the boosted trees, which
   are trained on ``labels``, go.
3. ``near_dedup``: one document of each group of near copies stays (shingles of
   five words, similarity of 0.8 or more).
4. ``suffix_dedup``: each byte of a 200-byte string that starts twice or more is
   cut out of the texts; ``n_chars`` follows.
5. ``packing``: pieces of sequences of at most 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statsheet.llm import langid, near_dedup, quality, suffix_dedup
from statsheet.llm.common import read, shared_folder
from statsheet.llm.packing import pack
from statsheet.llm.queries import vocabulary_path

#: No least score is under this; it holds alone where few rows were learned from.
LEAST_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    profiles = langid.learn(docs)
    return langid.accept(docs, profiles, langid.least_scores(docs, profiles, LEAST_SCORE))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accept(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs, near_dedup.Rule(words=5, percent=80))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(docs, length=200)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary_path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("language", language),
    ("quality", quality_rules),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("packing", packing),
]

#: Language profiles, trees, components and tokens are beyond SQL; the stages
#: are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's result written to the shared folder and read back."""
    docs = read(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
