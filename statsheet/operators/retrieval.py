"""Ranked search of many queries over a table of texts (T1..T3, L8).

An inverted index gives, for each token, the texts that hold it.  A token's weight
is an integer, ``floor(log2(texts / texts that hold it))``, so sums are exact in any order and a
token that more than half of the texts hold weighs nothing and is not looked up.  A
text's score is the sum of the weights of the query's different tokens in it.

The k best of each query are found in two rounds, and exactly:

1. The ``LEAD`` heaviest tokens of each query alone give partial scores; the k-th of
   these bounds the k-th best score from below.
2. A query's lightest tokens whose weights together stay under that bound cannot bring
   a text among the k best by themselves.  Only texts that hold one of the others are
   scored, and only those that can still reach the bound are completed with the
   light tokens.

So common words, whose lists are long, are met by few texts.  The lists are joined
by token, which the engine may split where one list is very long; each query keeps
its k best within every task before the last shuffle.

The index is written once, and so are the tables that more than one later step of
a search reads: texts are cut into tokens once, and no list is met twice for the same step.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Tokens of a query that the first round looks up.
LEAD = 3


def tokens(text: Column) -> Column:
    """Different runs of letters and digits, A-Z lower-cased."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.regexp_extract_all(low, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))


def _stored(table: DataFrame, folder: str | None) -> DataFrame:
    """``table`` written once under the folder (else ``spark.checkpoint.dir``) and read back."""
    path = f"{checkpoint_dir(table.sparkSession, folder).rstrip('/')}/statsheet-search-{uuid.uuid4().hex}"
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


@dataclass(frozen=True)
class TextIndex:
    """``postings``: (token, id), one row for each different token of a text.
    ``weights``: (token, weight), weights above 0 only."""

    postings: DataFrame
    weights: DataFrame


def index_texts(texts: DataFrame, id_col: str, text_col: str, folder: str | None = None) -> TextIndex:
    rows = texts.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    postings = _stored(rows.select("id", F.explode(tokens(F.col("text"))).alias("token")).distinct(), folder)
    total = rows.agg(F.count_distinct("id")).first()[0]  # one number
    # floor(log2(total / held)) without floating point: the length of the quotient in bits, less 1.
    quotient = F.expr(f"{total} div held")
    held = postings.groupBy("token").agg(F.count(F.lit(1)).alias("held"))
    weights = held.select("token", (F.length(F.bin(quotient)) - 1).cast("int").alias("weight")).where("weight > 0")
    return TextIndex(postings, _stored(weights, folder))


def search_texts(queries: DataFrame, index: TextIndex, query_id: str, query_text: str, k: int = 10, lead: int = LEAD, folder: str | None = None) -> DataFrame:
    """(query_id, rank, id, score, relevance) of the ``k`` best texts of each query
    with a score above 0, ties to the smaller id; relevance is the share, in percent, of the
    query's best score."""
    asked = queries.select(F.col(query_id).alias("query"), F.explode(tokens(F.col(query_text).cast("string"))).alias("token")).distinct().join(index.weights, "token")
    by_weight = Window.partitionBy("query").orderBy(F.desc("weight"), "token")
    upto = F.sum("weight").over(by_weight.rowsBetween(0, Window.unboundedFollowing))
    asked = _stored(asked.select("query", "token", "weight", F.row_number().over(by_weight).alias("place"), upto.alias("left")), folder)

    def scored(some: DataFrame) -> DataFrame:
        return some.join(index.postings, "token").groupBy("query", "id").agg(F.sum("weight").alias("score"))

    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    early = scored(asked.where(F.col("place") <= lead)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    bound = early.groupBy("query").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n")).select("query", F.when(F.col("n") >= k, F.col("low")).otherwise(0).alias("bound"))
    # ``left``: the weights of a token and all lighter ones.
    split = _stored(asked.join(bound, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(0))).withColumn("light", F.col("left") < F.col("bound")), folder)
    light = split.where("light")
    rest = split.groupBy("query").agg(F.max("bound").alias("bound"), F.coalesce(F.max(F.when(F.col("light"), F.col("left"))), F.lit(0)).alias("rest"))
    hopeful = _stored(scored(split.where("not light").select("query", "token", "weight")).join(rest, "query").where(F.col("score") + F.col("rest") >= F.col("bound")), folder)
    more = hopeful.select("query", "id").join(light.select("query", "token", "weight"), "query").join(index.postings, ["token", "id"]).select("query", "id", F.col("weight").alias("score"))
    full = hopeful.select("query", "id", "score").unionByName(more).groupBy("query", "id").agg(F.sum("score").alias("score"))
    top = full.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    # The best score of a query is that of its first row, among at most k.
    first = F.max("score").over(Window.partitionBy("query"))
    relevance = F.round(F.col("score") * 100 / first, 1)
    return top.select(F.col("query").alias("query_id"), "rank", "id", F.col("score").cast("bigint").alias("score"), relevance.alias("relevance"))
