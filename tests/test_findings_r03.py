"""Cases of the findings of round 3."""

from pyspark.sql import functions as F

from statsheet.operators.summary import series_chunked
from statsheet.plans.api import get_data


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunks_stay_where_they_were_cut(spark, root):
    res = get_data(spark, "LINEITEM", measures=["quantity", "tax"], root=root)
    chunks = res.chunked_series(rows=50)
    # Neither the rows nor the chunks are dealt out or sorted again (F1).
    assert "hashpartitioning(part" not in plan_of(chunks) and "SortMergeJoin" not in plan_of(chunks)

    def content(df):
        flat = df.select("measure", "unit", "chunk", F.posexplode("observations").alias("at", "o")).orderBy("measure", "chunk", "at").collect()
        return [(r["measure"], r["unit"], r["o"]["period"], r["o"]["dimensions"]["orderkey"]) for r in flat], sorted((r["measure"], r["o"]["value"], *sorted(r["o"]["dimensions"].items())) for r in flat)

    # From the observations alone (a limited or latest result) the series are the same.
    alone = series_chunked(res.observations, res.spec, 50)
    assert content(chunks)[1] == content(alone)[1]
    assert [r[0::3] for r in content(chunks)[0]] == [r[0::3] for r in content(alone)[0]]
    some = get_data(spark, "LINEITEM", measures=["tax"], root=root, limit=120).chunked_series(rows=50).collect()
    assert sum(len(c["observations"]) for c in some) == 120 and sorted(c["chunk"] for c in some) == list(range(len(some)))


def test_series_stats_sort_no_rows(spark, root):
    res = get_data(spark, "LINEITEM", measures=["quantity", "tax"], root=root, fmt="series")
    found = res.series_stats()
    assert "Sort [" not in plan_of(found) and "Exchange hashpartitioning" not in plan_of(found)
    got = {r["measure"]: r for r in found.collect()}
    assert sorted(got) == ["quantity", "tax"] and {r["n_obs"] for r in got.values()} == {spark.read.parquet(f"{root}/lineitem.parquet").count()}
    assert get_data(spark, "LINEITEM", {"orderkey": "-1"}, root=root).series_stats().collect() == []


def test_matching_broadcasts_no_exploded_rows(spark):
    from statsheet.operators.matching import close_pairs, similar_pairs

    names = spark.createDataFrame([(i, f"https://host{i % 7}.example.org/page/{i}") for i in range(300)], "id int, name string")
    for find, least in ((similar_pairs, 0.7), (close_pairs, 0.85)):
        found = find(names, names.withColumnRenamed("name", "entry"), "id", "name", "entry", least, 1)
        assert {(r["key"], r["left_text"] == r["right_text"]) for r in found.collect()} == {(i, True) for i in range(300)}
        # Exploded tokens and index entries stay out of broadcasts, at any size.
        plan = plan_of(found)
        final = plan.split("== Initial Plan ==")[0]
        assert "SortMergeJoin [token" in final and not any("Generate" in "\n".join(b.split("\n")[:6]) for b in final.split("BroadcastExchange")[1:])


def test_sheet_rows_are_not_dealt_out_by_sheet(spark):
    from pathlib import Path
    import sys

    sys.path.insert(0, str(Path(__file__).parent))
    from test_sheets import SNAP, TURNED, WIDE, tables

    from statsheet.operators.sheets import observations_of_sheets

    grid, layout = tables(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(observations_of_sheets(grid, layout, [WIDE, SNAP, TURNED]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Above the join with the headers no row is dealt out.
    top = plan.split("SortMergeJoin")[0]
    assert top.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in top


def test_texts_are_cut_into_tokens_once(spark):
    from statsheet.operators.retrieval import index_texts, search_texts

    texts = spark.createDataFrame([(i, f"common word{i % 5} rare{i}") for i in range(40)], "id long, text string")
    index = index_texts(texts, "id", "text")
    found = search_texts(spark.createDataFrame([(1, "rare7 word2"), (2, "nothing")], "q int, query string"), index, "q", "query", 3)
    assert "regexp_extract_all" not in plan_of(found)  # F6
    assert [(r["query_id"], r["rank"], r["id"], r["score"]) for r in found.orderBy("rank").collect()] == [(1, 1, 7, 7), (1, 2, 2, 2), (1, 3, 12, 2)]


def test_languages_are_learned_from_every_row(spark):
    from statsheet.llm import langid

    n = 7000
    df = spark.createDataFrame([(i, chr(0x4E00 + i), "zh") for i in range(n)], "doc_id long, text string, lang string")
    p = langid.learn(df, size=50_000)
    assert {i for i in range(n)} <= {int(k) - 2 - 0x4E00 for k in p.keys if k < 1 << 21}  # each row has a letter of its own (F4)
