import random

from statsheet.llm.components import components


def test_components_against_plain_union(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(40)] + [(7, 7), (None, 3)]
    part = {}
    for a, b in links:
        if a is not None and a != b:
            for x in (a, b):
                part.setdefault(x, x)
            low, high = sorted((part[a], part[b]))
            part = {k: low if v == high else v for k, v in part.items()}
    got = components(spark.createDataFrame(links, "x bigint, y bigint"))
    assert {r["node"]: r["component"] for r in got.collect()} == part


def test_no_links(spark):
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0
