import random
from collections import Counter

import pytest
from brute import docs, rows  # noqa: F401
from statsheet.llm import langid
from statsheet.llm.langid import UNKNOWN, Profiles, accept, learn, ngrams, predict


def plain_ngrams(text):
    s = " " + "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text) + " "
    words = s.split()
    out = Counter()
    for w in words:
        p = f" {w} "
        out.update(w)
        out.update(p[i : i + 3] for i in range(len(p) - 2))
    # Two-letter ones: a word's end and the next word's start share one space.
    joined = " " + " ".join(words) + " " if words else ""
    out.update(joined[i : i + 2] for i in range(len(joined) - 1))
    return out


def key(gram):
    out = 0
    for c in gram:
        out = out << 21 | (1 if c == " " else ord(c) + 2)
    return out


TEXTS = ["", "   ", "a", "Hello, wörld! 12 don't", "x1y", "İstanbul ǅ ß", "日本 語", "퟿\U0001f600z"]


@pytest.mark.parametrize("piece", [1 << 20, 1, 2, 3, 7])
def test_ngrams_against_plain_counts(monkeypatch, piece):
    monkeypatch.setattr(langid, "_PIECE", piece)
    rng = random.Random(5)
    for t in TEXTS + ["".join(rng.choice("ab é.,") for _ in range(60)) for _ in range(10)]:
        keys, counts = ngrams(t)
        assert dict(zip(keys.tolist(), counts.tolist())) == {key(g): n for g, n in plain_ngrams(t).items()}, t


def test_distance_is_out_of_place():
    p = Profiles.of({"b": [5, 6, 7], "a": [6, 5, 9]}, 3)

    def plain(own, profile):
        return sum(abs(i - profile.index(k)) if k in profile else 3 for i, k in enumerate(own))

    assert p.languages == ["a", "b"] and plain([6, 8], [6, 5, 9]) == 3
    keys, counts = ngrams("ab ab b")
    own = langid.ranked(keys, counts, 4).tolist()
    q = Profiles.of({"x": own[::-1], "y": own[1:], "z": []}, 4)
    got = q.predict("ab ab b")
    dist = {n: sum(abs(i - pr.index(k)) if k in pr else 4 for i, k in enumerate(own)) for n, pr in (("x", own[::-1]), ("y", own[1:]), ("z", []))}
    best = min(sorted(dist), key=dist.get)
    assert got == (best, pytest.approx(1 - dist[best] / (4 * len(own))))


def test_held_out_accuracy(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    profiles = learn(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))
    got = predict(docs, profiles).join(docs.select("doc_id", "lang"), "doc_id").where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2").collect()
    assert len(got) > 20 and sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edges(spark, docs):
    data = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "123 !", None), (None, "the dog", None), (5, "", "de")]
    df = docs(data)
    profiles = learn(df)
    assert profiles.languages == ["de", "en"]
    got = rows(predict(df, profiles), "doc_id", "lang_pred")
    assert got == [(None, "en"), (1, "en"), (2, "de"), (2, "de"), (3, UNKNOWN), (4, UNKNOWN), (5, UNKNOWN)]
    kept = accept(df, profiles, 0.2)
    assert kept.columns == df.columns and rows(kept, "doc_id") == [(None,), (1,), (2,), (2,)]
    nothing = learn(df.where("lang is null"))
    assert nothing.languages == [] and rows(accept(df, nothing, 0.2), "doc_id") == [(None,), (1,), (2,), (2,)]
    assert predict(df.limit(0), profiles).count() == 0


def test_least_scores_by_language_and_size(spark, docs):
    rng = random.Random(8)
    long = [(i, " ".join(rng.choice(("the", "dog", "cat", "house", "and", "then")) for _ in range(40)), "en") for i in range(150)]
    rare = [(200 + i, " ".join(rng.choice(("der", "hund", "katze")) for _ in range(n)), "de") for i, n in enumerate((1, 2, 30, 40))]
    df = docs(long + rare)
    p = learn(df)
    least = langid.least_scores(df, p, 0.05)
    own = sorted(p.nearest(t)[1] for _, t, _ in long)
    bits = p.nearest(long[0][1])[2].bit_length()
    assert abs(least("en", (1 << bits) - 1) - (own[0] - langid.MARGIN)) <= 2 / langid._STEPS
    assert rows(accept(df, p, least), "doc_id") == [(i,) for i, *_ in long + rare]  # all that was learned from stays
    assert least("xx", 5) == 0.05 and langid.least_scores(docs(rare), learn(docs(rare)), 0.05)("de", 50) == 0.05
    assert langid.least_scores(df.limit(0), p, 0.2)("en", 50) == 0.2


def test_many_languages(spark, docs):
    """As many languages as there are, learned together."""
    data = [(i, f"{chr(0x4E00 + i)}{chr(0x5E00 + i)} " * 3, f"l{i:03}") for i in range(600)] + [(1000, "12 34", "numbers")]
    profiles = learn(docs(data, 4))
    assert profiles.languages == sorted({x for *_, x in data})
    for i in (0, 1, 299, 599):
        assert profiles.predict(data[i][1])[0] == f"l{i:03}"
    for i in (7, 512):
        keys, counts = ngrams(data[i][1])
        own = set(langid.ranked(keys, counts, 400).tolist())
        j = profiles.languages.index(f"l{i:03}")
        assert {k for k, r in zip(profiles.keys.tolist(), profiles.ranks[:, j]) if r < profiles.size} == own
