import random

import numpy as np
from brute import WORD, docs, rows  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from statsheet.llm.quality import FEATURES, accept, base_failed, fit, judge, repeated_words, statistics, train


def plain(text):
    w = WORD.findall(text or "")
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "#x", "é é", "\n", " \t\n", "a\nb"]), max_size=40))
def test_statistics_against_plain_counts(parts):
    text = " ".join(parts)
    base, features = statistics(text)
    assert base == plain(text) and len(features) == len(FEATURES)


def test_repeats_in_windows():
    assert repeated_words("a b c d e".split()) == 0
    assert repeated_words("a b c d e a b c d e".split()) == 10
    assert repeated_words(["x"] * 7) == 7
    assert statistics(None)[0] == (0, 0, 0, 0, 0) and base_failed((0, 0, 0, 0, 0))
    assert base_failed((10, 1, 0, 0, 3)) and not base_failed((10, 1, 0, 0, 2))


def walk(trees, x):
    """One row through the node arrays, node by node."""
    total = trees.base
    for t in range(len(trees.feature)):
        node = 0
        while trees.left[t, node] != node:
            node = trees.left[t, node] if x[trees.feature[t, node]] <= trees.threshold[t, node] else trees.right[t, node]
        total += trees.value[t, node]
    return 1 / (1 + np.exp(-total))


def test_trees_learn_stay_monotonic_and_score_as_a_walk_does():
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 1, (1500, 3))
    y = ((x[:, 0] < 0.5) & (x[:, 1] > 0.3)).astype(float)
    noisy = np.where(rng.uniform(size=len(y)) < 0.05, 1 - y, y)
    m = train(x, noisy, [-1, 1, 0], trees=30)
    assert ((m.score(x) > 0.5) == (y > 0)).mean() > 0.95
    assert np.allclose(m.score(x[:40]), [walk(m, r) for r in x[:40]])
    grid = np.linspace(-0.2, 1.2, 60)
    for row in rng.uniform(0, 1, (25, 3)):
        for f, sign in ((0, -1), (1, 1)):
            line = np.repeat(row[None], len(grid), axis=0)
            line[:, f] = grid
            assert (sign * np.diff(m.score(line)) >= -1e-12).all()


def test_held_out_labels(spark, root):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = fit(docs, labels.where("doc_id % 3 <> 0"))
    got = judge(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").where("not base_failed").collect()
    assert len(got) > 50 and sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in got) / len(got) > 0.95


def test_edges(spark, docs):
    rng = random.Random(2)
    good = [(i, " ".join(f"word{rng.randint(0, 500)}" for _ in range(30))) for i in range(40)]
    bad = [(100 + i, " ".join(f"{rng.choice('#*$%')}w{rng.randint(0, 500)}" for _ in range(30))) for i in range(40)]
    extra = [(200, None), (201, ""), (None, good[0][1]), (3, good[3][1])]
    df = docs(good + bad + extra)
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(999, 1, 0), (1, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = fit(df, labels)
    kept = accept(df, model)
    assert kept.columns == df.columns
    assert rows(kept, "doc_id") == sorted([(i,) for i, _ in good] + [(None,), (3,)], key=lambda r: (r[0] is not None, r[0]))
    none = fit(df, labels.limit(0))
    assert none is None and kept.count() < accept(df, none).count() == 82
    assert fit(df, labels.where("quality = 1")) is None
    assert judge(df.limit(0), model).count() == 0
    assert rows(judge(df, model).where("doc_id >= 200"), "doc_id", "n_words", "base_failed") == [(200, 0, True), (201, 0, True)]
