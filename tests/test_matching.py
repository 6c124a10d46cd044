"""Joins of texts by similarity and ranked search, against all pairs in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from statsheet.operators import matching
from statsheet.operators.matching import close_pairs, similar_pairs, words
from statsheet.operators.retrieval import index_texts, search_texts


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


def typos(rng, t):
    t = list(t)
    for _ in range(rng.randint(0, 3)):
        i = rng.randrange(len(t) + 1)
        t[i : i + rng.randint(0, 1)] = rng.choice(["", "x", "ab", " "])
    return "".join(t)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    names = ["".join(rng.choice("abcde ") for _ in range(rng.randint(1, 14))) for _ in range(60)] + ["the bank of x", "the bank of y", "a", "", None, "the", "the the"]
    right = names + names[:10]
    left = [typos(rng, rng.choice(names[:60])) for _ in range(80)] + ["the bank off y", "A", "", None, "the"] + ["the"] * 30
    l_rows = list(enumerate(left))
    return l_rows, right, spark.createDataFrame(l_rows, "id int, name string").repartition(3), spark.createDataFrame([(r, 1) for r in right], "entry string, id int").repartition(3)


@pytest.mark.parametrize("least,n,salt", [(0.6, 1, 20_000), (0.3, 3, 5), (0.5, None, 2), (1.0, 2, 3)])
def test_similar_pairs_equal_all_pairs(tables, monkeypatch, least, n, salt):
    """Also where every token is hot, so that its entries are dealt out by salt."""
    monkeypatch.setattr(matching, "SALT_ROWS", salt)
    l_rows, right, left_df, right_df = tables
    want = []
    for i, t in l_rows:
        if not t:
            continue
        found = []
        for r in sorted({r for r in right if r}):
            a, b = gram_set(t), gram_set(r)
            j = len(a & b) / len(a | b)
            if j >= least:
                found.append((-j, edits(t.lower(), r.lower()), r, len(a & b)))
        found.sort()
        want += [(i, t, r, c, -j, e) for j, e, r, c in (found if n is None else found[:n])]
    got = similar_pairs(left_df, right_df, "id", "name", "entry", least, n).select("key", "left_text", "right_text", "common", "jaccard", "edits")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want


@pytest.mark.parametrize("least,n,q,salt", [(0.6, 3, 2, 20_000), (0.75, None, 3, 3), (0.9, 1, 2, 1), (0.51, 2, 2, 4)])
def test_close_pairs_equal_all_pairs(tables, monkeypatch, least, n, q, salt):
    monkeypatch.setattr(matching, "SALT_ROWS", salt)
    l_rows, right, left_df, right_df = tables
    want = []
    for i, t in l_rows:
        if not t:
            continue
        found = sorted((-(1 - edits(t, r) / max(len(t), len(r))), r) for r in {r for r in right if r})
        found = [x for x in found if -x[0] >= least]
        want += [(i, r, -s) for s, r in (found if n is None else found[:n])]
    got = close_pairs(left_df, right_df, "id", "name", "entry", least, n, q).select("key", "right_text", "score")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want


def test_words_and_arguments(spark, tables):
    *_, left_df, right_df = tables
    got = similar_pairs(spark.createDataFrame([(1, "Bank the X"), (2, "y of bank")], "id int, name string"), right_df, "id", "name", "entry", 0.5, 1, words)
    assert {(r["key"], r["right_text"]) for r in got.collect()} == {(1, "the bank of x"), (2, "the bank of y")}
    with pytest.raises(ValueError):
        close_pairs(left_df, right_df, "id", "name", "entry", 0.5, 1, 2)
    with pytest.raises(ValueError):
        similar_pairs(left_df, right_df, "id", "name", "entry", 0)
    assert similar_pairs(left_df.limit(0), right_df, "id", "name", "entry").count() == 0


def test_matching_needs_no_python_worker(tables):
    *_, left_df, right_df = tables
    for df in (similar_pairs(left_df, right_df, "id", "name", "entry"), close_pairs(left_df, right_df, "id", "name", "entry", 0.7)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def toks(t):
    out, cur = [], ""
    for c in (t or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c.isalnum():
            cur += c
        elif cur:
            out.append(cur)
            cur = ""
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("k,lead", [(3, 1), (10, 3), (1, 2), (500, 3)])
def test_search_equals_full_scores(spark, k, lead):
    rng = random.Random(k)
    vocabulary = ["the", "of"] + [f"w{i}" for i in range(60)]
    weights = [60, 30] + [60 // (i + 1) + 1 for i in range(60)]
    texts = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 25)))) for i in range(200)] + [(900, None), (901, ""), (902, "The, OF w3!")]
    queries = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 9)))) for i in range(25)] + [(50, "nothing known"), (51, None), (52, "the of"), (53, "w1 w1 W2")]
    sets = {i: set(toks(t)) for i, t in texts}
    held = {}
    for s in sets.values():
        for t in s:
            held[t] = held.get(t, 0) + 1
    weight = {t: int(math.log2(len(texts) // n)) for t, n in held.items()}
    want = []
    for q, t in queries:
        found = sorted((-sum(weight.get(x, 0) for x in set(toks(t)) & s), i) for i, s in sets.items())
        found = [(s, i) for s, i in found if s < 0][:k]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(found, 1)]
    index = index_texts(spark.createDataFrame(texts, "id long, text string").repartition(4), "id", "text")
    got = search_texts(spark.createDataFrame(queries, "q int, query string"), index, "q", "query", k, lead)
    assert sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in got.collect()) == sorted(want)


def test_search_scores_few_texts_for_common_words(spark):
    """Round two leaves out the lists of words that cannot matter."""
    texts = [(i, "common " * (i % 4 > 0) + f"rare{i % 50} other") for i in range(400)]
    index = index_texts(spark.createDataFrame(texts, "id long, text string"), "id", "text")
    assert {r["token"] for r in index.weights.collect()} == {f"rare{i}" for i in range(50)}
    found = search_texts(spark.createDataFrame([(1, "common rare7 other")], "q int, query string"), index, "q", "query", 3)
    assert [(r["id"], r["relevance"]) for r in found.orderBy("rank").collect()] == [(7, 100.0), (57, 100.0), (107, 100.0)]
    assert found.where(F.col("rank") > 3).count() == 0
