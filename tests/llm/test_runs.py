import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from brute import WORD, docs, rows  # noqa: F401
from statsheet.llm.queries import REGISTRY, planted
from statsheet.llm.runs import COVER, V, Extensions, _joined, dropped_words, find_runs, runs_of


def brute_runs(w, least=24, exponent=3):
    """Each stretch of equal words q apart, with the smallest q it shows at."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, exponent * q):
                found.setdefault((start, i + q - start), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    return " ".join(x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs))


def plant(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def made(rng):
    w = []
    for _ in range(rng.randint(0, 5)):
        if rng.random() < 0.5:
            w += [rng.randint(0, rng.choice([1, 3, 50])) for _ in range(rng.randint(0, 60))]
        else:
            u = [rng.randint(0, 3) for _ in range(rng.randint(1, 40))]
            w += (u * rng.randint(2, 9))[: rng.randint(1, 400)]
    return w


def test_cover_has_every_difference():
    assert {(a - b) % V for a in COVER for b in COVER} == set(range(V))


@pytest.mark.parametrize("least,exponent", [(24, 3), (2, 2), (5, 2), (1, 4)])
def test_runs_equal_brute_force(least, exponent):
    rng = random.Random(least)
    for _ in range(80):
        lists = [made(rng) for _ in range(rng.randint(1, 5))]
        got = runs_of([np.array(w, np.int64) for w in lists], least, exponent)
        for w, g in zip(lists, got):
            assert [tuple(r) for r in g.tolist()] == brute_runs(w, least, exponent)
            assert [i for i, x in enumerate(dropped_words(len(w), g)) if x] == sorted({i for s, n, q in brute_runs(w, least, exponent) for i in range(s + q, s + n)})


def test_extensions_equal_comparison():
    rng = random.Random(5)
    for _ in range(20):
        ids, _ = _joined([np.array(made(rng), np.int64) for _ in range(3)])
        e = Extensions(ids)
        i = np.array([rng.randrange(len(ids)) for _ in range(300)])
        j = np.array([rng.randrange(len(ids)) for _ in range(300)])
        i, j = i[i != j], j[i != j]
        for a, b, n in zip(i, j, e.common(i, j)):
            k = 0
            while max(a, b) + k < len(ids) and ids[a + k] == ids[b + k]:
                k += 1
            assert k == n


def test_long_texts():
    assert runs_of([np.zeros(100_000, np.int64)])[0].tolist() == [[0, 100_000, 1]]
    w = np.random.Generator(np.random.PCG64(1)).integers(0, 2000, 300_000)
    w[100_000:100_300] = np.tile(w[100_000:100_100], 3)
    assert runs_of([w])[0].tolist()[0][1:] >= [300, 100]


def test_operator(spark, docs):  # noqa: F811
    unit = "eins zwei  drei\nvier x fünf"
    data = [(1, f"a b {unit} " * 9), (1, f"a b {unit} " * 9), (2, None), (3, ""), (4, " \n\t "), (None, "z " * 24), (5, "z " * 23), (6, "kurz")]
    df = docs(data).withColumnsRenamed({"kept": "runs", "start": "period"})
    got = rows(find_runs(df))
    want = []
    for i, t in sorted(((i, t) for i, t, *_ in [(*r, None) for r in data]), key=lambda r: (r[0] is not None, r[0] or 0)):
        w = WORD.findall(t or "")
        runs = brute_runs(w)
        want.append((i, len(w), [dict(zip(("start", "length", "period"), r)) for r in runs], collapsed(w, runs)))
    assert [(a, b, [r.asDict() for r in c], d) for a, b, c, d in got] == want
    assert find_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        find_runs(df, exponent=1)


def test_planting_equals_its_rule(spark, docs):  # noqa: F811
    rng = random.Random(3)
    data = [(i, rng.choice([None, "", " ", "x"]) if i % 7 == 0 else " ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 90)))) for i in range(400)] + [(None, "a b a b")]
    got = {r["doc_id"]: r["text"] for r in planted(docs(data)).collect()}
    for i, t in data:
        assert WORD.findall(got[i] or "") == (plant(i, t) if i is not None else WORD.findall(t))


def test_query_equals_brute_force(spark, root):
    read = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in REGISTRY["op11_runs"](spark, root).collect()}
    assert len(got) == len(read)
    for doc_id, text in read:
        w = plant(doc_id, text)
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), collapsed(w, runs))]
        r = got[doc_id]
        assert [r["n_runs"], r["start"], r["length"], r["period"]] == [len(runs), *best]
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert [r["runs_sha256"], r["collapsed_sha256"]] == digest
    assert any(r["n_runs"] for r in got.values())
