"""Plan shapes that the scale design relies on."""

import re

from pyspark.sql import functions as F

from statsheet import get_data, latest
from statsheet.operators.links import best_links
from statsheet.operators.ranking import latest_tail, top_n
from statsheet.plans.verification import REGISTRY


def _plan(spark, df, mode="formatted"):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_latest_pushes_newest_day_into_scan(spark, root):
    res = latest(spark, "LINEITEM", root=root)
    plan = _plan(spark, res.records)
    assert re.search(r"PushedFilters: \[[^\n]*GreaterThanOrEqual\(l_shipdate", plan)


def test_tail_is_partially_aggregated_under_skew(spark):
    # One measure holds far more than a third of the rows.
    rows = [("hot", f"2024-01-{1 + i % 28:02d}", float(i), i, 0) for i in range(3000)] + [("cold", "2024-01-02", 1.0, 1, 1)]
    obs = spark.createDataFrame(rows, "measure string, period string, value double, _o0 long, _midx int")
    from statsheet.spec import spec_from_dict

    spec = spec_from_dict({"id": "SKEW", "name": "skew", "order_by": ["o"], "columns": [{"key": "x", "source": "x", "role": "measure"}]})
    one = latest_tail(obs, spec, 1)
    assert "partial_max_by" in _plan(spark, one)
    got = {r["measure"]: (r["period"], r["_o0"]) for r in one.collect()}
    assert got == {"hot": ("2024-01-28", 2995), "cold": ("2024-01-02", 1)}
    five = latest_tail(obs, spec, 5)
    plan = _plan(spark, five)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert five.filter(F.col("measure") == "hot").count() == 5


def test_summary_is_hash_aggregated(spark, root):
    res = get_data(spark, "LINEITEM", {"returnflag": "R"}, root=root, limit=50)
    plan = _plan(spark, res.summary)
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_top_n_is_take_ordered(spark, root):
    res = get_data(spark, "ORDERS", root=root)
    plan = _plan(spark, top_n(res.observations, res.spec, 10))
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan


def test_best_link_is_partial_aggregate(spark):
    cands = spark.createDataFrame([("D", 0, 5, "a"), ("D", 1, 7, "b"), ("D", 2, 7, "c")], "dataset_id string, pos int, score long, name string")
    out = best_links(cands)
    assert "partial_max_by" in _plan(spark, out)
    assert out.first()["name"] == "b"


def test_no_registered_query_uses_nested_loop_or_cartesian_joins(spark, root):
    for name, fn in REGISTRY.items():
        plan = _plan(spark, fn(spark, root), "simple")
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, name


def test_long_value_list_has_the_plan_of_a_short_one(spark, root):
    def plan(n):
        res = get_data(spark, "LINEITEM", {"linenumber": [str(i) for i in range(n)]}, "quantity", root=root)
        return _plan(spark, res.records)

    for n in (10, 10_000):
        p = plan(n)
        assert "Join" not in p and re.search(r"PushedFilters: \[[^\n]*In\(l_linenumber", p), n


def _read_schema(spark, df):
    plan = _plan(spark, df)
    return [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")]


def test_one_measure_reads_only_that_measure(spark, root):
    res = get_data(spark, "LINEITEM", {"returnflag": "R"}, "tax", start_period="1998", root=root)
    schema = _read_schema(spark, res.records)[0]
    assert "l_tax" in schema
    assert not any(c in schema for c in ("l_quantity", "l_extendedprice", "l_discount"))


def test_summary_reads_no_id_columns(spark, root):
    res = get_data(spark, "LINEITEM", {"returnflag": "R"}, root=root, limit=50)
    schema = _read_schema(spark, res.summary)[0]
    assert not any(c in schema for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))


def test_cluster_settings_scale_with_input():
    from statsheet.session import cluster_settings

    small = cluster_settings(executors=10, cores_per_executor=4, input_tb=0.01)
    big = cluster_settings(executors=1000, cores_per_executor=8, input_tb=100)
    assert int(small["spark.sql.shuffle.partitions"]) >= 3 * 40
    # ~256 MB of input per shuffle partition.
    assert int(small["spark.sql.shuffle.partitions"]) < int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 * 4
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(big["spark.sql.autoBroadcastJoinThreshold"]) <= 64 * 1024 * 1024
