"""Closest matches between two tables of text (T4..T6 as joins).

Both joins leave out pairs by a bound on the tokens that one string has and the other
has not, and verify the rest, all in built-in expressions.

* ``similar_pairs`` (T4, T5): sets of words or q-grams with a Jaccard similarity of at
  least ``least``; the bound counts these tokens.
* ``close_pairs`` (T6): edit similarity ``1 - edits / longer length`` of at least
  ``least``.  An edit takes away one character and ``q`` padded q-grams at most, and
  adds as many, so the bound counts both.

How the work is spread: equal strings are matched once and joined back.  A string's
tokens set bits of a few integers; a bit that is set on one side only stands for one token
or more that the other side has not.  Strings of equal size whose tokens without digits
set the same bits form a group, and a pair is first tried as (string, group), then,
with the bits of the tokens that have digits, as (string, string).  Only sizes that can
match meet, by size class; left strings are dealt out by a salt in proportion to their
number, and a group has ``GROUP_ROWS`` strings, about, at most.

Where a caller asks for the ``n`` best, they are looked for in ``ROUNDS`` rounds, each with a
lower least score.  All pairs above a round's score are found in it, so a left string that
has ``n`` of them is done, and only the others go on.

Null and empty strings match nothing.  Nothing is dropped or capped, except by the
``n`` best that a caller asks for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .retrieval import _stored

#: Left strings of one salt, about.
SALT_ROWS = 8_000
#: Strings of one group, about, at most.
GROUP_ROWS = 2_000
#: Integers that hold the bits of a string's tokens without digits; one more holds the others.
WORDS = 4
#: Rounds, each with a lower least score, and pairs of strings up to which one is enough.
ROUNDS, FEW = 6, 50_000_000


def words(text: Column) -> Column:
    """Different words, lower-cased: runs without white space."""
    return F.array_distinct(F.array_remove(F.split(F.lower(text), r"\s+"), ""))


def grams(text: Column, q: int = 3) -> Column:
    """Different q-grams of the lower-cased text with one space at either end."""
    return F.array_distinct(_cut(F.concat(F.lit(" "), F.lower(text), F.lit(" ")), q))


def _cut(text: Column, q: int) -> Column:
    """All q-grams of the text, or the text if it is shorter.  It is bound to a name first: else it
    would be made again for each q-gram."""
    return F.transform(F.array(text), lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - q + 1, F.lit(1))), lambda i: F.substring(s, i, F.lit(q))))[0]


def padded_grams(text: Column, q: int) -> Column:
    """All q-grams of the padded text, repeated ones too; its characters with ``q`` = 1."""
    pad = F.lit("\0" * (q - 1))
    return _cut(F.concat(pad, text, pad), q)


def _texts(table: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(key, text) rows, and the different texts."""
    rows = table.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text is not null and text <> ''")
    # A text is few bytes but much work, so the tasks are not joined by bytes.
    n = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows, rows.select("text").repartition(n, "text").distinct()


def _signed(texts: DataFrame, mark: str, kinds: list) -> DataFrame:
    """(mark, mark_n, mark{k}_{i}): the texts, how many tokens of the first kind each has,
    and for each kind of tokens the integers of its bits."""
    t = texts.select(F.col("text").alias(mark), *(F.sort_array(tokens(F.col("text"))).alias(f"s{k}") for k, tokens in enumerate(kinds)))
    # Equal tokens are told apart by the number of the occurrence.
    bit = "pmod(xxhash64(g, i - array_position(s{k}, g)), IF(g rlike '[0-9]', 64, {bits})) + IF(g rlike '[0-9]', {bits}, 0)"
    t = t.select(mark, F.size("s0").alias(f"{mark}_n"), *(F.expr(f"transform(s{k}, (g, i) -> {bit.format(k=k, bits=64 * WORDS)})").alias(f"b{k}") for k in range(len(kinds))))
    word = "aggregate(b{k}, 0L, (a, b) -> a | IF(b div 64 = {i}, shiftleft(1L, CAST(b % 64 AS INT)), 0L))"
    t = t.select(mark, f"{mark}_n", *(F.expr(word.format(k=k, i=i)).alias(f"{mark}{k}_{i}") for k in range(len(kinds)) for i in range(WORDS + 1)))
    # Written once, or filters would make the bits anew below the exchanges.
    return _stored(t, None).where(F.col(f"{mark}_n") > 0)


def _grouped(right: DataFrame, kinds: int) -> DataFrame:
    """The groups of the signed texts ``r``, each with ``members``: its texts with the
    bits of their tokens that have digits."""
    plain = ["r_n", *(f"r{k}_{i}" for k in range(kinds) for i in range(WORDS))]
    held = right.groupBy(*plain).agg(F.count(F.lit(1)).alias("held"))
    dealt = right.join(held, plain).withColumn("chunk", F.pmod(F.xxhash64("r"), F.ceil(F.col("held") / GROUP_ROWS)))
    member = F.struct("r", *(f"r{k}_{WORDS}" for k in range(kinds)))
    return dealt.groupBy(*plain, "chunk").agg(F.collect_list(member).alias("members")).drop("chunk")


def _candidates(left: DataFrame, groups: DataFrame, least: float, allowed: list[tuple[Column, Column]]) -> DataFrame:
    """Pairs (l, l_n, r, r_n), once each, whose sizes differ by no more than a factor of
    ``least`` and of whose tokens of each kind no more than ``allowed`` seem to be on the left, on
    the right alone."""

    def alone(a: str, b: str, k: int, i: int) -> Column:
        return F.bit_count(F.col(f"{a}{k}_{i}").bitwiseAND(F.bitwise_not(F.col(f"{b}{k}_{i}"))))

    def size_class(n: Column) -> Column:
        return F.floor(F.log(n) * 20).cast("int")

    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = max(n, -(-left.count() // SALT_ROWS))  # one number
    sizes = F.sequence(size_class(F.greatest(F.ceil(F.col("l_n") * least - 1e-9), F.lit(1))), size_class(F.floor(F.col("l_n") / least + 1e-9)))
    l = left.select("*", F.explode(sizes).alias("token"), F.pmod(F.xxhash64("l"), F.lit(deal)).cast("int").alias("salt")).repartition(4 * n, "token", "salt")  # noqa: E741
    r = groups.select("*", size_class(F.col("r_n")).alias("token"), F.explode(F.sequence(F.lit(0), F.lit(deal - 1))).alias("salt")).repartition(4 * n, "token", "salt")
    pairs = l.join(r.hint("merge"), ["token", "salt"])
    gone, come = ([sum((alone(a, b, k, i) for i in range(1, WORDS)), alone(a, b, k, 0)) for k in range(len(allowed))] for a, b in (("l", "r"), ("r", "l")))
    for k, (most_gone, most_come) in enumerate(allowed):
        pairs = pairs.where((gone[k] <= most_gone) & (come[k] <= most_come))
    kept = pairs.select("l", "l_n", "r_n", *(f"l{k}_{WORDS}" for k in range(len(allowed))), *(x.alias(f"{name}{k}") for name, xs in (("gone", gone), ("come", come)) for k, x in enumerate(xs)), F.explode("members").alias("m")).select("*", "m.*")
    for k, (most_gone, most_come) in enumerate(allowed):
        kept = kept.where((F.col(f"gone{k}") + alone("l", "r", k, WORDS) <= most_gone) & (F.col(f"come{k}") + alone("r", "l", k, WORDS) <= most_come))
    return kept.select("l", "l_n", "r", "r_n")


def _best(left: DataFrame, groups: DataFrame, least: float, n: int | None, find: Callable[[DataFrame, float], DataFrame], order: list[Column]) -> DataFrame:
    """What ``find(left, least)`` gives, of each left text the ``n`` first by ``order``, which
    begins with the score, greatest first."""
    if n is None:
        return find(left, least)
    w = Window.partitionBy("l").orderBy(*order, "r")

    def ranked(some: DataFrame, score: float) -> DataFrame:
        return find(some, score).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)

    done = []
    if left.count() * (groups.agg(F.sum(F.size("members"))).first()[0] or 0) > FEW:  # two numbers
        for k in range(1, ROUNDS):
            found = _stored(ranked(left, 1 - (1 - least) * k / ROUNDS), None)
            full = found.where(F.col("rank") == n).select("l")
            done.append(found.join(full, "l", "left_semi"))
            left = left.join(full, "l", "left_anti")
    out = ranked(left, least)
    for found in done:
        out = out.unionByName(found)
    return out


def _keyed(pairs: DataFrame, left: DataFrame, scores: list[str]) -> DataFrame:
    """Pairs of texts back to keys.  The engine takes exploded pairs to be few, so they are named for a merge join."""
    return left.join(pairs.hint("merge"), left["text"] == pairs["l"]).select("key", F.col("text").alias("left_text"), F.col("r").alias("right_text"), *scores, *(["rank"] if "rank" in pairs.columns else []))


def similar_pairs(left: DataFrame, right: DataFrame, key: str, text: str, right_text: str, least: float = 0.6, n: int | None = 1, tokens=grams) -> DataFrame:
    """T4, T5: (key, left_text, right_text, common, jaccard, edits[, rank]).

    Of each left row the ``n`` most similar different right texts (all with
    ``n=None``) with ``jaccard >= least``; ties go to fewer edits, then to the text that
    sorts first."""
    if not 0 < least <= 1:
        raise ValueError("least must be above 0, at most 1")
    l_rows, l = _texts(left, key, text)  # noqa: E741
    _, r = _texts(right, right_text, right_text)
    l, groups = _signed(l, "l", [tokens]), _stored(_grouped(_signed(r, "r", [tokens]), 1), None)  # noqa: E741
    n_l, n_r = F.col("l_n"), F.col("r_n")

    def find(some: DataFrame, score: float) -> DataFrame:
        # A little less is asked for, against rounding.
        needed = F.ceil((n_l + n_r) * (score / (1 + score)) - 1e-9)
        common = F.size(F.array_intersect(tokens(F.col("l")), tokens(F.col("r"))))
        # Exploded, or each use below would count them anew.
        pairs = _candidates(some, groups, score, [(n_l - needed, n_r - needed)]).withColumn("common", F.explode(F.array(common)))
        scored = pairs.withColumn("jaccard", F.col("common") / (n_l + n_r - F.col("common"))).where(F.col("jaccard") >= score)
        return scored.select("l", "r", "common", "jaccard", F.levenshtein(F.lower("l"), F.lower("r")).alias("edits"))

    return _keyed(_best(l, groups, least, n, find, [F.desc("jaccard"), F.col("edits")]), l_rows, ["common", "jaccard", "edits"])


def close_pairs(left: DataFrame, right: DataFrame, key: str, text: str, right_text: str, least: float = 0.6, n: int | None = 3, q: int = 2) -> DataFrame:
    """(key, left_text, right_text, edits, score[, rank]): of each left row the
    ``n`` right texts with the greatest edit similarity, ``least`` or more; ties go to the
    text that sorts first."""
    if not 1 - 1 / q < least <= 1:
        raise ValueError(f"with q={q}, least must be above {1 - 1 / q:g}, at most 1: else strings without a common q-gram may be close")
    kinds = [lambda t: padded_grams(t, 1), lambda t: padded_grams(t, q)]
    l_rows, l = _texts(left, key, text)  # noqa: E741
    _, r = _texts(right, right_text, right_text)
    l, groups = _signed(l, "l", kinds), _stored(_grouped(_signed(r, "r", kinds), 2), None)  # noqa: E741
    longer = F.greatest("l_n", "r_n")

    def find(some: DataFrame, score: float) -> DataFrame:
        most = F.floor((1 - score) * longer + 1e-9).cast("int")
        # Of d edits, |l| - |r| at least only take away, if l is the longer, and the other way round.
        allowed = [(F.col("l_n") - longer + e * most, F.col("r_n") - longer + e * most) for e in (1, q)]
        pairs = _candidates(some, groups, score, allowed).withColumn("most", most)
        scored = pairs.withColumn("edits", F.expr("levenshtein(l, r, most)")).where("edits >= 0")
        return scored.select("l", "r", "edits", (1 - F.col("edits") / longer).alias("score")).where(F.col("score") >= score)

    return _keyed(_best(l, groups, least, n, find, [F.desc("score")]), l_rows, ["edits", "score"])
