"""Long value lists and repeated joins on ids."""

from pyspark.sql import functions as F

from statsheet import get_data
from statsheet.operators.lookups import pair_entities
from statsheet.sources.tables import read_table, write_bucketed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_list_of_100_000_values(spark, root):
    lines = read_table(spark, root, "lineitem")
    wanted = [str(i) for i in range(100_000) if i % 3]
    got = get_data(spark, "LINEITEM", {"orderkey": wanted + ["7", "7"]}, "quantity", root=root).records
    assert got.count() == lines.where("(l_orderkey % 3 <> 0 or l_orderkey = 7) and l_quantity is not null").count() > 0
    assert "LeftSemi" in plan(got) and "Python" not in plan(got)
    text = get_data(spark, "ORDERS", {"priority": [f"p{i}" for i in range(2000)] + ["1-URGENT"]}, root=root).records
    assert text.count() == read_table(spark, root, "orders").where("o_orderpriority = '1-URGENT'").count() > 0
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = get_data(spark, "LINEITEM", {"orderkey": wanted}, "quantity", root=root).records
        assert "BroadcastHashJoin" not in plan(again) and again.count() == lines.where("l_orderkey % 3 <> 0 and l_quantity is not null").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_tables_join_without_an_exchange(spark, root, tmp_path):
    o, c = read_table(spark, root, "orders"), read_table(spark, root, "customer")
    want = sorted((r["o_orderkey"], r["c_name"]) for r in pair_entities(o, c, "o_custkey", "c_custkey").select("o_orderkey", "c_name").collect())
    left = write_bucketed(o, "test_orders_bucketed", "o_custkey", 4, str(tmp_path / "orders"))
    right = write_bucketed(c, "test_customer_bucketed", "c_custkey", 4, str(tmp_path / "customer"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = pair_entities(left, right, "o_custkey", "c_custkey").select("o_orderkey", "c_name")
        assert sorted((r["o_orderkey"], r["c_name"]) for r in joined.collect()) == want
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        shuffled = pair_entities(o, c, "o_custkey", "c_custkey")
        assert "Exchange" in plan(shuffled)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS test_orders_bucketed")
        spark.sql("DROP TABLE IF EXISTS test_customer_bucketed")
    assert left.select(F.lit(1)) is not None
