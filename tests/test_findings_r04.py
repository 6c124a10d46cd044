"""Cases of the findings of round 4."""

import random

import pytest
from pyspark.sql import functions as F

from statsheet.operators import matching
from statsheet.operators.matching import close_pairs, similar_pairs


def gram_set(t):
    s = f" {t.lower()} "
    return {s[i : i + 3] for i in range(max(1, len(s) - 2))}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def links(n, seed):
    """Links that are much alike: most q-grams of each are held by many others."""
    rng = random.Random(seed)
    right = sorted({f"http{rng.choice(['', 's'])}://{rng.choice(['', 'www.', 'm.'])}th{rng.choice(['er', 'an', 'ér', 'at'])}.example.net/{rng.choice(['en', 'fr'])}/{rng.randrange(9999)}{rng.choice(['', '.html', '#top', '?ref=2'])}" for _ in range(n)})
    left = []
    for t in right[::2]:
        at = rng.randrange(len(t))
        left += [t, t[:at] + rng.choice(["", "zq", "7", t[at : at + 1]]) + t[at + 1 :], t + "/x"][rng.randrange(3) :]
    return list(enumerate([*left, "", None, "nothing like it"])), right


@pytest.fixture(scope="module")
def tables(spark):
    rows, right = links(120, 7)
    return rows, right, spark.createDataFrame(rows, "id int, name string").repartition(3), spark.createDataFrame([(r,) for r in [*right, *right[:5], None, ""]], "entry string").repartition(2)


@pytest.mark.parametrize("few,rounds,group", [(0, 3, 2), (10**9, 3, 2_000)])
def test_close_pairs_in_rounds_equal_all_pairs(tables, monkeypatch, few, rounds, group):
    """the best are the same in several rounds, with groups cut small, and in one."""
    rows, right, left_df, right_df = tables
    for name, value in (("FEW", few), ("ROUNDS", rounds), ("GROUP_ROWS", group), ("SALT_ROWS", 50)):
        monkeypatch.setattr(matching, name, value)
    want = []
    for i, t in rows:
        found = sorted((-(1 - edits(t, r) / max(len(t), len(r))), r, edits(t, r)) for r in right) if t else []
        want += [(i, k, r, e) for k, (_, r, e) in enumerate([x for x in found if -x[0] >= 0.85][:3], 1)]
    got = close_pairs(left_df, right_df, "id", "name", "entry", least=0.85).select("key", "rank", "right_text", "edits")
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 200


@pytest.mark.parametrize("few,rounds,group", [(0, 3, 2), (10**9, 3, 2_000)])
def test_similar_pairs_in_rounds_equal_all_pairs(tables, monkeypatch, few, rounds, group):
    """as for F1."""
    rows, right, left_df, right_df = tables
    for name, value in (("FEW", few), ("ROUNDS", rounds), ("GROUP_ROWS", group), ("SALT_ROWS", 50)):
        monkeypatch.setattr(matching, name, value)
    want = []
    for i, t in rows:
        found = sorted((-len(gram_set(t) & gram_set(r)) / len(gram_set(t) | gram_set(r)), edits(t.lower(), r.lower()), r) for r in right) if t else []
        want += [(i, r, -j, e) for j, e, r in [x for x in found if -x[0] >= 0.6][:2]]
    got = similar_pairs(left_df, right_df, "id", "name", "entry", least=0.6, n=2).select("key", "right_text", "jaccard", "edits")
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 150


@pytest.mark.parametrize("of", ["close", "similar"])
def test_few_pairs_of_like_texts_are_verified(spark, monkeypatch, of):
    """the bound on tokens of one side only leaves few pairs, though nearly all share their rarest q-grams."""
    monkeypatch.setattr(matching, "FEW", 0)
    met, candidates = [], matching._candidates

    def counted(left, groups, least, allowed):
        found = candidates(left, groups, least, allowed)
        met.append(found.count())
        return found

    monkeypatch.setattr(matching, "_candidates", counted)
    left = spark.createDataFrame([(i, f"https://m.there.example.com/en/{i * 7919 % 100_000:05}.html?page=2") for i in range(600)], "id int, name string")
    right = left.select(F.col("name").alias("entry"))
    find = close_pairs if of == "close" else similar_pairs
    found = find(left, right, "id", "name", "entry", 0.85 if of == "close" else 0.7, 1).collect()
    # A left text that has its best goes into no later round.
    assert {(r["key"], r["left_text"] == r["right_text"]) for r in found} == {(i, True) for i in range(600)}
    assert 600 <= met[0] < 2_000 and sum(met[1:]) == 0
