"""Snapshot history: latest fetch wins per key, replays are idempotent."""

import datetime as dt

from statsheet.streaming.accumulate import accumulate_stream, latest_per_key, upsert

SCHEMA = "entity string, period string, value double, fetched_at timestamp"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_latest_per_key(spark):
    t1, t2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1)
    df = _rows(spark, [("a", "2024-12-31", 1.0, t1), ("a", "2024-12-31", 2.0, t2), ("b", "2024-12-31", 3.0, t1)])
    got = sorted((r["entity"], r["value"]) for r in latest_per_key(df, ["entity", "period"], ["fetched_at"]).collect())
    assert got == [("a", 2.0), ("b", 3.0)]


def test_upsert_keeps_other_periods_and_is_idempotent(spark, tmpdir_path):
    hist = f"{tmpdir_path}/history"
    t1, t2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 4, 1)
    first = _rows(spark, [("a", "2024-12-31", 1.0, t1), ("b", "2024-12-31", 5.0, t1)])
    upsert(first, hist, ["entity", "period"], ["fetched_at"], "period")
    second = _rows(spark, [("a", "2025-03-31", 2.0, t2), ("b", "2024-12-31", 6.0, t2)])
    upsert(second, hist, ["entity", "period"], ["fetched_at"], "period")
    upsert(second, hist, ["entity", "period"], ["fetched_at"], "period")  # replay
    got = sorted((r["entity"], r["period"], r["value"]) for r in spark.read.schema(SCHEMA).parquet(hist).collect())
    assert got == [("a", "2024-12-31", 1.0), ("a", "2025-03-31", 2.0), ("b", "2024-12-31", 6.0)]


def test_stream_over_landing_folder(spark, tmpdir_path):
    landing = f"{tmpdir_path}/landing"
    hist = f"{tmpdir_path}/hist"
    t1, t2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 4, 1)
    _rows(spark, [("a", "2024-12-31", 1.0, t1)]).write.mode("append").parquet(landing)
    accumulate_stream(spark, landing, SCHEMA, hist, ["entity", "period"], ["fetched_at"], "period", f"{tmpdir_path}/ckpt")
    _rows(spark, [("a", "2024-12-31", 9.0, t2), ("c", "2025-03-31", 3.0, t2)]).write.mode("append").parquet(landing)
    accumulate_stream(spark, landing, SCHEMA, hist, ["entity", "period"], ["fetched_at"], "period", f"{tmpdir_path}/ckpt")
    got = sorted((r["entity"], r["period"], r["value"]) for r in spark.read.schema(SCHEMA).parquet(hist).collect())
    assert got == [("a", "2024-12-31", 9.0), ("c", "2025-03-31", 3.0)]


def test_observations_on_a_stream(spark, root, tmpdir_path):
    """The map-only part of the pipeline (filters, projection, Expand) runs
    unchanged on a Structured Streaming source."""
    from statsheet import get_data

    landing = f"{tmpdir_path}/orders_landing"
    spark.read.parquet(f"{root}/orders.parquet").write.parquet(landing)
    batch = spark.read.parquet(landing)
    stream = spark.readStream.schema(batch.schema).parquet(landing)
    res = get_data(spark, "ORDERS", {"status": "filled"}, start_period="1996", source=stream)
    assert res.records.isStreaming
    q = res.records.writeStream.format("memory").queryName("obs_stream_test").option(
        "checkpointLocation", f"{tmpdir_path}/obs_ckpt").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.sql("SELECT * FROM obs_stream_test")
    want = get_data(spark, "ORDERS", {"status": "filled"}, start_period="1996", source=batch).records
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
