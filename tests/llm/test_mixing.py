from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest
from brute import WORD, docs, rows  # noqa: F401
from pyspark.sql import functions as F
from statsheet.llm import mixing
from statsheet.llm.queries import REGISTRY, SQL


def filled(sizes, weights, most, total=None):
    """Targets by clamping and sharing anew, in exact fractions."""
    total = Fraction(sum(sizes.values()) if total is None else total)
    capped, todo = {}, {s for s in sizes if weights.get(s, 0) > 0}
    while todo:
        left, w = total - sum(capped.values()), sum(weights[s] for s in todo)
        over = {s for s in todo if left * weights[s] / w > most * sizes[s]}
        if not over:
            return {s: capped[s] if s in capped else left * weights[s] / w if s in todo else Fraction(0) for s in sizes}
        capped |= {s: Fraction(most * sizes[s]) for s in over}
        todo -= over
    return {s: capped.get(s, Fraction(0)) for s in sizes}


def check(found, data, weights, most, total=None):
    sizes = defaultdict(int)
    for _, t, s in data:
        sizes[s] += len(WORD.findall(t or ""))
    targets = filled(sizes, weights, most, total)
    taken = defaultdict(int)
    assert len(found) == len(data)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(targets[r["source"]]), rel=1e-12, abs=1e-9)
        assert 0 <= r["taken"] <= most * r["size"] and r["taken"] == r["whole"] * r["size"] + r["extra"]
        taken[r["source"]] += r["taken"]
    return sizes, targets, taken


def documents(spark, data):
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string").repartition(3)
    return df.selectExpr("*", "1 as size", "2 as draw", "3 as weight", "4 as target", "5 as cut")


def test_targets_and_words_taken(spark):
    data = [(i, "w " * (1 + i % 50), f"s{i % 3}") for i in range(300)]
    data += [(1000 + i, "x y z", "tiny") for i in range(3)] + [(2000, "one " * 5000, "long"), (2001, None, "long"), (2002, "a b c", None), (2003, "", "empty")]
    df = documents(spark, data)
    weights = {s: 1 + i % 3 for i, s in enumerate([*sorted({s for *_, s in data if s}), None])}
    mix = mixing.plan(df)
    assert {r["source"]: int(r["weight"]) for r in mix.plan.collect()} == weights
    found = mixing.taken_words(mix).collect()
    sizes, targets, taken = check(found, data, weights, 3)
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 1
    assert targets["tiny"] == 27 and targets["empty"] == 0
    again = mixing.taken_words(mixing.plan(df.repartition(7))).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    other = mixing.taken_words(mixing.plan(df, seed=1)).collect()
    assert sorted(map(str, other)) != sorted(map(str, found))


def test_many_rounds_weights_and_totals(spark):
    data = [(i, "w " * (2 ** (i % 12)), f"s{i % 12:02}") for i in range(120)]
    df = documents(spark, data)
    for weights, most, total in (({f"s{i:02}": 1 + i % 2 for i in range(12)}, 2, None), ({"s03": 2, "s07": 1, "s08": 0, "gone": 5}, 3, None), ({"s01": 1}, 1, 10**9), ({}, 3, None)):
        w = spark.createDataFrame([*weights.items()], "source string, weight int")
        found = mixing.taken_words(mixing.plan(df, w, most, total=total)).collect()
        _, targets, taken = check(found, data, weights, most, total)
        for s, t in targets.items():
            assert abs(taken[s] - t) <= 1


def test_repeated_rows_share_the_cut(spark):
    data = [(7, "a b c d", "s")] * 100 + [(8, "a " * 1000, "t")]
    found = mixing.taken_words(mixing.plan(documents(spark, data))).collect()
    _, targets, taken = check(found, data, {"s": 1, "t": 2}, 3)
    assert len({r["taken"] for r in found if r["doc_id"] == 7}) == 1
    assert targets["s"] - 100 <= taken["s"] <= targets["s"] and abs(taken["t"] - targets["t"]) <= 1


def test_texts_of_the_mix(spark):
    data = [(i, f" {i}  b\tc d " * (1 + i % 4), "st"[i % 2]) for i in range(40)]
    df = documents(spark, data)
    mix = mixing.plan(df, spark.createDataFrame([("s", 1), ("t", 9)], "source string, weight int"))
    taken = {r["doc_id"]: r for r in mixing.taken_words(mix).collect()}
    texts = mixing.draw_texts(df, mix).collect()
    by_id = defaultdict(list)
    for r in texts:
        by_id[r["doc_id"]].append(r)
    for i, t, _ in data:
        w = WORD.findall(t)
        assert sum(len(WORD.findall(r["text"])) for r in by_id[i]) == taken[i]["taken"]
        for r in by_id[i]:
            assert r["text"] == t or WORD.findall(r["text"]) == w[: len(WORD.findall(r["text"]))]
        assert sorted(r["repetition"] for r in by_id[i]) == list(range(len(by_id[i])))


def test_empty_and_wordless(spark):
    empty = documents(spark, [(1, "a", "s")]).limit(0)
    assert mixing.taken_words(mixing.plan(empty)).count() == 0
    got = mixing.taken_words(mixing.plan(documents(spark, [(1, None, "s"), (2, " ", None), (None, "", "s")]))).collect()
    assert len(got) == 3 and all(r["taken"] == 0 and r["target"] == 0 for r in got)


def test_sources_weigh_in_code_point_order(spark):
    names = ["a", "B", "ä", "\U0001f600", "￿", "", "10", "9", None]
    df = spark.createDataFrame([(n,) for n in names], "source string").repartition(4)
    got = {r["source"]: r["weight"] for r in mixing.repeated_weights(df).collect()}
    assert got == {n: 1 + i % 3 for i, n in enumerate([*sorted(n for n in names if n is not None), None])}


def test_query_equals_its_sql(spark, root):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{root}/documents.parquet')")
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({SQL['op12_mixing']})").fetchall()
    got = [tuple(r[c] for c in cols) for r in REGISTRY["op12_mixing"](spark, root).collect()]
    assert Counter(got) == Counter(want) and len(got) > 100
