import datetime as dt

from pyspark.sql import functions as F

from broadsheet.operators import history
from broadsheet.operators.ranking import daily_counts
from broadsheet.schemas import ARCHIVE_ITEM, RANKED_ITEM
from broadsheet.sources.registry import sources
from broadsheet.sources.store import Store
from broadsheet.streaming import landing, seen


def land(spark, path, rows):
    df = spark.createDataFrame([("antirez", "r", i, t, u, None, None, None, c) for i, (t, u, c) in enumerate(rows)], ARCHIVE_ITEM)
    df.coalesce(1).write.mode("append").parquet(path)


def test_items_land_incrementally(spark, tmp_path):
    landed, state = str(tmp_path / "landed"), str(tmp_path / "state")
    store = Store.open(spark, str(tmp_path / "store"))

    def run():
        stream = landing.landing_stream(spark, landed, ARCHIVE_ITEM)
        landing.stream_items(stream, store, sources(spark), state, lambda b: f"2026-01-{10 + b}T00:00:00Z").awaitTermination()

    land(spark, landed, [("A", "u1", ""), ("B", "u2", "b")])
    run()
    land(spark, landed, [("A", "u1", "filled"), ("C", "u3", "c")])
    run()
    run()  # nothing new
    rows = {r["url"]: (r["run_id"], r["archived_at"]) for r in store.items().collect()}
    assert rows == {"u1": ("batch-00000000", "2026-01-10T00:00:00Z"), "u2": ("batch-00000000", "2026-01-10T00:00:00Z"),
                    "u3": ("batch-00000001", "2026-01-11T00:00:00Z")}
    assert sorted(r["content"] for r in store.contents().collect()) == ["b", "c", "filled"]


def test_snapshots_land(spark, tmp_path):
    landed = str(tmp_path / "landed")
    store = Store.open(spark, str(tmp_path / "store"))
    spark.createDataFrame([("hn", "r", 0, "S", "s", None, None, 1, 1, 1, None, [], {})], RANKED_ITEM).write.parquet(landed)
    stream = landing.landing_stream(spark, landed, RANKED_ITEM, 1)
    landing.stream_snapshots(stream, store, sources(spark), str(tmp_path / "state"), lambda b: "2026-01-10T00:00:00Z").awaitTermination()
    assert [r["snapshot_date"] for r in store.snapshots().collect()] == ["2026-01-10"]


def test_a_backlog_of_runs_keeps_its_days(spark, tmp_path):
    """Three runs land at once, a fourth that is older than one of them later."""
    landed = str(tmp_path / "landed")
    store = Store.open(spark, str(tmp_path / "store"))

    def land_runs(*runs):
        rows = [(s, run, 0, f"{run} {s}", "u", None, None, 1, 1, 1, None, [], {}) for run, *of in runs for s in of]
        spark.createDataFrame(rows, RANKED_ITEM).coalesce(1).write.mode("append").parquet(landed)
        stream = landing.landing_stream(spark, landed, RANKED_ITEM)
        landing.stream_snapshots(
            stream, store, sources(spark), str(tmp_path / "state"), lambda b: "2026-02-01T00:00:00Z",
            run_time=F.to_timestamp("run_id", "yyyy-MM-dd HH"),
        ).awaitTermination()
        return {(r["source_id"], r["snapshot_date"]): r["title"][:13] for r in store.snapshots().collect()}

    first = land_runs(("2026-01-10 01", "hn", "lobsters"), ("2026-01-10 09", "hn"), ("2026-01-11 01", "hn"))
    assert first == {("hn", "2026-01-10"): "2026-01-10 09", ("lobsters", "2026-01-10"): "2026-01-10 01",
                     ("hn", "2026-01-11"): "2026-01-11 01"}
    then = land_runs(("2026-01-10 05", "hn", "lobsters"), ("2026-01-11 03", "hn"))
    assert then == {("hn", "2026-01-10"): "2026-01-10 09", ("lobsters", "2026-01-10"): "2026-01-10 05",
                    ("hn", "2026-01-11"): "2026-01-11 03"}


def test_seen_stream_equals_the_batch(spark, tmp_path):
    """Late rows, rows of one item in several batches, an item that comes back after its horizon."""
    landed, out = str(tmp_path / "sightings"), str(tmp_path / "out")
    schema = "source_id string, url string, seen_at timestamp"
    at = lambda day, hour: dt.datetime(2026, 1, day, hour)
    batches = [
        [("s", "u", at(1, 5)), ("s", "v", at(1, 6)), ("t", "u", at(1, 7)), (None, "u", at(1, 1)), ("s", "w", None)],
        [("s", "u", at(1, 2)), ("s", "u", at(1, 9)), ("s", "v", at(1, 6))],  # late, and a repeated row
        [("s", "w", at(6, 0))],  # moves the watermark beyond the horizon
        [("s", "u", at(6, 1)), ("s", "w", at(5, 20))],  # closes the others, u comes back
        [("s", "x", at(20, 0))], [("s", "x", at(20, 1))],
    ]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", seen.STATE_STORE)
    try:
        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
            stream = spark.readStream.schema(schema).parquet(landed)
            told = seen.seen_stream(stream, "1 day", 36 * 3_600_000)
            query = told.writeStream.option("checkpointLocation", str(tmp_path / "seen-state")).outputMode("update")
            query = query.trigger(availableNow=True).foreachBatch(lambda df, _: df.write.mode("append").parquet(out))
            query.start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    rows = spark.read.parquet(out)
    named = spark.read.schema(schema).parquet(landed).where("source_id is not null and seen_at is not null")
    key = lambda r: (r["source_id"], r["url"], r["first_seen"], r["last_seen"], r["times_seen"])
    assert sorted(map(key, seen.seen_table(rows).collect())) == sorted(
        map(key, history.first_last_seen(named).collect()))
    closed = {(r["source_id"], r["url"], r["times_seen"]) for r in rows.where("closed").collect()}
    assert {("s", "u", 3), ("s", "v", 2), ("t", "u", 1), ("s", "u", 1), ("s", "w", 2)} == closed


def events(spark, path):
    rows = [(k, dt.datetime(2026, 1, day, hour)) for k, day, hour in
            [("a", 1, 0), ("a", 1, 23), ("b", 1, 5), ("a", 2, 0), ("a", 9, 1)]]
    spark.createDataFrame(rows, "kind string, ts timestamp").write.parquet(path)
    return spark.read.parquet(path)


def test_daily_buckets_equal_the_batch_counts(spark, tmp_path):
    path = str(tmp_path / "events")
    batch = events(spark, path)
    stream = spark.readStream.schema(batch.schema).parquet(path)
    out = landing.daily_buckets(stream, "kind", "ts", "1 day")
    q = out.writeStream.format("memory").queryName("daily").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    key = lambda r: (r["source_id"], r["snapshot_date"], r["items"])
    assert sorted(map(key, spark.table("daily").collect())) == sorted(map(key, daily_counts(batch, "kind", "ts").collect()))


def test_first_seen_within(spark, tmp_path):
    path = str(tmp_path / "items")
    rows = [("s", "u", dt.datetime(2026, 1, 1, h)) for h in (0, 1)] + [("s", "v", dt.datetime(2026, 1, 1))]
    spark.createDataFrame(rows, "source_id string, url string, ts timestamp").coalesce(1).write.parquet(path)
    stream = spark.readStream.schema("source_id string, url string, ts timestamp").parquet(path)
    q = landing.first_seen_within(stream, "ts", "1 day").writeStream.format("memory").queryName("seen").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["url"] for r in spark.table("seen").collect()) == ["u", "v"]
