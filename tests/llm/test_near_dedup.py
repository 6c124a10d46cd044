import random

import numpy as np
from brute import docs, near_components, rows, shingle_set, words  # noqa: F401
from statsheet.llm import near_dedup
from statsheet.llm.hashing import mix
from statsheet.llm.near_dedup import Rule, estimate, link_documents, links_of_block, one_of_each, shingles, signature


def check(spark, df, data, rule):
    want = near_components(data, rule.words, rule.percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in link_documents(df, rule).collect()}
    assert got == want
    return want


def test_shingles_and_pieces(monkeypatch):
    texts = ["", " \n", "One", "one TWO", "a b a b a b", "É é x", "x\x0by\x0cz w q", "tab\tand\nline " * 20, "long" * 50 + " a b c"]
    for piece in (1 << 20, 1, 5, 16):
        monkeypatch.setattr(near_dedup, "_PIECE", piece)
        for w in (1, 3, 5):
            sets = [shingles(t, w) for t in texts]
            assert [len(s) for s in sets] == [len(shingle_set(t, w)) for t in texts]
            if piece == 1 << 20:
                first = sets
            assert all((a == b).all() for a, b in zip([shingles(t, w) for t in texts], sets))
    assert (shingles("A b C", 3) == shingles("a B c", 3)).all()
    assert shingles(None, 3).size == 0


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(4)
    rule = Rule(3, 85)
    assert rule.bands[0] * rule.bands[1] == rule.registers
    starts = near_dedup._bucket_starts(rule.registers)
    for size in (40, 400, 4000):
        base = rng.integers(0, 1 << 64, size, np.uint64, endpoint=False)
        for share in (0.5, 0.85, 0.95):
            k = int(size * 2 * share / (1 + share))
            a = np.unique(base)
            b = np.unique(np.concatenate((base[:k], rng.integers(0, 1 << 64, size - k, np.uint64))))
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            e = estimate(signature(a, starts), signature(b, starts)[None], np.array([len(b)]), len(a))[0]
            assert abs(e - j) < 6 * np.sqrt(j * (1 - j) / min(rule.registers, size / 2)) + 0.01


def test_sample_table_against_all_pairs(spark, root):
    df = spark.read.parquet(f"{root}/documents.parquet")
    data = [(r["doc_id"], r["text"]) for r in df.collect()]
    for rule in (Rule(3, 85), Rule(5, 80)):
        want = check(spark, df, data, rule)
        kept = one_of_each(df, rule)
        assert kept.columns == df.columns
        assert rows(kept, "doc_id") == sorted({(c,) for _, c in want.values()})


def test_large_group_with_outliers(spark, docs):
    """One group over several blocks: mutual copies, chains, and members that
    are linked to one other member only."""
    rng = random.Random(8)
    base = words(rng, 120).split()
    data = []
    for i in range(330):
        w = list(base)
        for _ in range(rng.choice((1, 2, 4, 7))):
            w[rng.randrange(len(w))] = words(rng, 1)
        data.append((1000 - i, " ".join(w)))
    chain = list(base)
    for i in range(60):  # each is near its neighbours, the ends are far apart
        chain[2 * i] = words(rng, 1)
        data.append((2000 + i, " ".join(chain)))
    data += [(3000 + i, data[5][1]) for i in range(20)]
    df = docs(data, 4)
    want = check(spark, df, data, Rule(3, 85))
    assert len({c for _, c in want.values()}) > 5  # the data hold outliers too
    old = near_dedup.CHUNK, near_dedup.PAIR_CHUNK
    near_dedup.CHUNK, near_dedup.PAIR_CHUNK = 32, 16
    try:
        check(spark, df, data, Rule(3, 85))
    finally:
        near_dedup.CHUNK, near_dedup.PAIR_CHUNK = old


def test_small_sets(spark, docs):
    rng = random.Random(1)
    data = []
    for g in range(30):
        w = words(rng, 9).split()
        data += [(10 * g, " ".join(w)), (10 * g + 1, " ".join(w[:-1])), (10 * g + 2, " ".join(w[1:])), (10 * g + 3, " ".join(w[:4]))]
    data += [(500, "one"), (501, "ONE"), (502, "one two"), (503, "two one"), (504, "one two")]
    check(spark, docs(data), data, Rule(3, 85))
    check(spark, docs(data), data, Rule(1, 80))


def test_edges(spark, docs):
    data = [(1, None), (2, ""), (3, " \n "), (5, "a b c d"), (4, "A B C D"), (4, "A B C D"), (None, "a b c d"), (None, None), (9, "z")]
    got = rows(link_documents(docs(data), Rule(3, 85)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == [(None, 0, None, True), (None, 2, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 2, 4, True), (4, 2, 4, True), (5, 2, 4, False), (9, 1, 9, True)]
    kept = one_of_each(docs(data), Rule(3, 85))
    assert rows(kept, "doc_id") == [(None,), (None,), (1,), (2,), (3,), (4,), (9,)]
    assert link_documents(docs(data).limit(0)).count() == 0


def test_block_links_join_exactly():
    sets = [np.sort(mix(np.arange(i, i + 100, dtype=np.uint64))) for i in range(0, 30, 3)]
    found = list(links_of_block(sets, [None] * len(sets), Rule(3, 85)))
    assert len(found) == len(sets) - 1  # a spanning tree of the chain
    assert list(links_of_block(sets, [1] * len(sets), Rule(3, 85))) == []


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_built_words_are_not_linked(spark, docs):
    """Words whose polynomial sums modulo 2**64 are equal at any odd base and letter values."""
    data = []
    for n in (1024, 2048):
        data += [(10 * n, thue_morse(n)), (10 * n + 1, thue_morse(n, "b", "a")), (10 * n + 2, "x " + thue_morse(n) + " y"), (10 * n + 3, "x " + thue_morse(n, "b", "a") + " y")]
    got = {r["doc_id"]: r["component_id"] for r in link_documents(docs(data), Rule(3, 85)).collect()}
    assert got == {i: i for i, _ in data}


def test_very_long_words(monkeypatch):
    monkeypatch.setattr(near_dedup, "_PIECE", 16)
    texts = ["a b " + "x" * 500 + " c d", "y" * 501, "x" * 300 + " " + "y" * 300, "q", "a" * 90 + "\n" + "b" * 40]
    want = [len(shingles(t, 2)) for t in texts]
    monkeypatch.setattr(near_dedup, "_LONG", 64)
    assert [len(shingles(t, 2)) for t in texts] == want == [len(shingle_set(t, 2)) for t in texts]
    other = near_dedup.word_hashes("a b " + "x" * 499 + " c d")
    assert (near_dedup.word_hashes(texts[0]) == other).tolist() == [True, True, False, True, True]


def test_helper_names_in_the_input(spark, docs):
    names = ["place", "_place", "dropped", "_dropped", "doc", "own", "order", "node", "kept"]
    data = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "other words that are here alone now"), (None, "a b c d e f g h")]
    df = docs(data).drop("kept").selectExpr("*", *(f"doc_id as `{n}`" for n in names))
    got = one_of_each(df, Rule(5, 80))
    assert got.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["place"], r["_dropped"], r["doc"]) for r in got.collect() if r["doc_id"]) == [(1, 1, 1, 1), (3, 3, 3, 3)] and got.count() == 3


def test_rows_that_repeat_an_id(spark, docs):
    data = [(7, f"text number {i} of one id, words here") for i in range(40)] + [(8, "text number 3 of one id, words here")]
    got = one_of_each(docs(data), Rule(5, 80)).collect()
    assert sum(r["doc_id"] == 7 for r in got) == 1
