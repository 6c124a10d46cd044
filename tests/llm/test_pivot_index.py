import math
import random
from fractions import Fraction

import numpy as np
import pytest
from brute import rows
from statsheet.llm.pivot_index import best, packed, products, search, unit, visited_share


def brute(data, k, is_query, scale=1024):
    """Plain integers, all pairs; the least vector of a repeated query id."""
    v = [(i, x, [math.floor(scale * Fraction(c)) for c in x]) for i, x in data if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for i in sorted({i for i, *_ in v if is_query(i)}):
        q = min((x, n) for j, x, n in v if j == i)[1]
        hits = sorted((-sum(a * b for a, b in zip(q, n)), j) for j, _, n in v if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(hits)]
    return out


def check(spark, data, k=10, step=7, parts=3, kind="float", ring=512):
    df = spark.createDataFrame([(i, x, 1) for i, x in data], f"vec_id bigint, embedding array<{kind}>, score int").repartition(parts)
    if kind == "float":
        data = [(i, None if x is None else [None if c is None else float(np.float32(c)) for c in x]) for i, x in data]
    want = brute(data, k, lambda i: i % step == 0)
    assert rows(search(df, f"vec_id % {step} = 0", k, ring=ring), "query_id", "rank", "vec_id", "score") == want
    return want


def test_best_breaks_ties_by_id():
    assert best(np.array([5, 3, 9, 1]), np.array([2, 7, 2, 2]), 2).tolist() == [1, 3]


def test_random_and_clustered_vectors(spark):
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    data = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for i in range(250)]
    data += [(300 + i, [rng.gauss(0, 5) for _ in range(6)]) for i in range(60)]
    for ring in (512, 3, 1):
        check(spark, data, ring=ring)


def test_copies_ties_lengths_and_bad_vectors(spark):
    rng = random.Random(2)
    same = [0.5, -0.25, 0.125]
    data = [(i, same) for i in range(120)] + [(200 + i, [rng.choice((0.0, 0.5, -0.5)) for _ in range(3)]) for i in range(80)]
    data += [(500, None), (501, [None, 1.0, 2.0]), (502, [math.nan, 0.0, 0.0]), (503, [math.inf, 0.0, 0.0]), (None, same), (505, []), (506, [2.0]), (507, [1.0, 1.0, 1.0, 9.0]), (7, [1.0, 1.0, 1.0]), (7, same)]
    check(spark, data)
    check(spark, [(0, [0.0, 0.0])] * 3 + [(7, [0.0, 0.0]), (14, [100000.5, -99999.25])], k=4)


def test_few_and_none(spark):
    check(spark, [(0, [1.0]), (1, [2.0])])
    check(spark, [(0, [1.0])])
    check(spark, [])
    check(spark, [(1, [1.0]), (2, [3.0])])


def test_every_finite_vector_is_scored(spark):
    rng = random.Random(4)
    small = [(i, [rng.gauss(0, 1), rng.gauss(0, 1)]) for i in range(60)]
    # 3e6, 1e12 and more beside ordinary vectors: all these scores fit a long.
    want = check(spark, small + [(100, [3e6, 1.0]), (101, [-3e6, 1.0]), (102, [1e12, 0.5]), (106, [4e5, -1.0])], ring=3, kind="double")
    assert any(abs(s) > 1 << 53 for *_, s in want) and {100, 102} <= {j for _, _, j, _ in want}
    # 1e30 and 1e305 (whose thousandfold is beyond a double), where the queries have zeros.
    zero = [(i, [0.0, rng.gauss(0, 1)]) for i in range(0, 49)]
    want = check(spark, zero + [(201, [1e30, 9.0]), (202, [-1e30, 8.0]), (205, [1.7e308, 7.0])], kind="double")
    assert {201, 202, 205} <= {j for _, _, j, _ in want}
    # A score far under any long does not matter while there are better ones.
    check(spark, [(i, [1.0 + i, 0.0]) for i in range(20)] + [(21, [-1e30, 1.0])], k=1, step=100, kind="double")


@pytest.mark.parametrize("data", [[(0, [1e10]), (1, [1e10])], [(0, [1e10]), (1, [-1e10])], [(0, [1e200]), (1, [1e200]), (2, [1.0])]])
def test_a_score_beyond_a_long_raises(spark, data):
    with pytest.raises(Exception, match="beyond a long"):
        check(spark, data, kind="double")


def test_products_are_exact():
    rng = random.Random(6)
    q = [[rng.choice((0.0, rng.gauss(0, 10 ** rng.randint(0, 40)))) for _ in range(3)] for _ in range(30)]
    v = [[rng.gauss(0, 10 ** rng.randint(0, 9)) for _ in range(3)] for _ in range(40)] + [[1.7e308, 0.0, -1.7e308]]
    ints = lambda x: [math.floor(1024 * Fraction(c)) for c in x]
    seen = {}
    for places, scores in products([packed(x) for x in q], [packed(x) for x in v], 3, 1024):
        for i, s in zip(places.tolist(), scores.tolist()):
            seen[i] = [int(x) for x in s]
    assert seen == {i: [sum(a * b for a, b in zip(ints(x), ints(y))) for y in v] for i, x in enumerate(q)}
    for x in q + v:
        e, y = unit(packed(x), 3, 1024)
        for c, u in zip(ints(x), y.tolist()):
            assert abs(Fraction(u) * Fraction(2) ** e - c) <= Fraction(2) ** e * Fraction(1, 1 << 50)


def test_bounds_rule_out_far_groups_and_long_vectors(spark):
    rng = random.Random(8)
    data = [(i, [100 * math.cos(i % 5) + rng.gauss(0, 1), 100 * math.sin(i % 5) + rng.gauss(0, 1)]) for i in range(1000)]
    df = spark.createDataFrame(data + [(2001, [0.0, 1e7])], "vec_id bigint, embedding array<float>")
    assert visited_share(df, "vec_id % 50 = 0", ring=20) < 0.5
    check(spark, data + [(2001, [0.0, 1e7])], step=50, ring=20)


def test_repeated_ids_are_spread(spark):
    check(spark, [(5, [1.0, 2.0])] * 5000 + [(i, [float(i), 1.0]) for i in range(10, 40)], step=13)
