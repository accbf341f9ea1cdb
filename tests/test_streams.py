"""Streams in batches: what is written once, what a batch touches, what state is held."""

import random

import pandas as pd
from pyspark.sql import functions as F

from sheafwork.storage import folders, scratch
from sheafwork.streaming import ingest


def put(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)


def test_keys_are_written_once_however_late(spark):
    source, target, state = (scratch(spark, n) for n in ("in", "out", "state"))
    schema = "k BIGINT, v STRING"
    for part in ([(1, "a"), (2, "a"), (1, "b")], [(1, "c"), (3, "c")], [(2, "d"), (None, "d")], [(None, "e"), (3, "e"), (4, "e")], []):
        put(spark, part, schema, source)
        ingest.ingest_files(spark, source, schema, target, state, "k")
    got = ingest.ingested(spark, target, schema).collect()
    assert sorted((r["k"] or 0, r["v"]) for r in got if r["k"] != 1) == [(0, "d"), (2, "a"), (3, "c"), (4, "e")]
    assert [r["v"] for r in got if r["k"] == 1] in (["a"], ["b"])
    # no state of the stream's own is kept
    assert "state" not in folders(spark, state)


def test_repeats_within_a_delay(spark):
    source, state = scratch(spark, "in"), scratch(spark, "state")
    put(spark, [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 01:00:00"), (2, "2024-01-01 02:00:00")], "k BIGINT, t STRING", source)
    rows = ingest.once_within(spark.readStream.schema("k BIGINT, t TIMESTAMP").json(source), "k", "t", "2 days")
    rows.writeStream.format("memory").queryName("once").option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["k"] for r in spark.table("once").collect()) == [1, 2]


def test_an_upsert_rewrites_the_buckets_that_it_touches(spark):
    source, target, state = (scratch(spark, n) for n in ("in", "out", "state"))
    schema = "k BIGINT, o BIGINT, v STRING"
    run = lambda: ingest.upsert_stream(spark, source, schema, target, state, ["k"], "o")
    read = lambda: {r["k"]: (r["o"], r["v"]) for r in ingest.read_upserted(spark, target, schema).collect()}
    want = {}
    batches = [[(k, 1, "first") for k in range(200)], [(7, 5, "new")], [(7, 3, "old"), (900, 1, "more")], [(8, 1, "first"), (8, 1, "second")]]
    for n, batch in enumerate(batches):
        put(spark, batch, schema, source)
        run()
        for k, o, v in batch:
            want[k] = max(want.get(k, (0, "")), (o, v))
        assert read() == want
        if n:
            assert len(folders(spark, f"{target}/rows/version={n}")) <= 1 + len({k for k, *_ in batch})  # the buckets and a mark of success
    before = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(target).select("path", "modificationTime").collect()
    run()  # nothing new
    assert before == spark.read.format("binaryFile").option("recursiveFileLookup", True).load(target).select("path", "modificationTime").collect()
    # of the bucket that every batch rewrote, only what the last two versions name is left
    places = spark.createDataFrame([(7,)], "k long").select(F.pmod(F.xxhash64("k"), F.lit(ingest.BUCKETS))).first()[0]
    assert [n for n in range(4) if f"__bucket={places}" in folders(spark, f"{target}/rows/version={n}")] == [2]
    assert folders(spark, f"{target}/manifest") == ["version=2", "version=3"]


def test_a_batch_that_failed_before_its_commit_runs_again(spark):
    source, target, state = (scratch(spark, n) for n in ("in", "out", "state"))
    schema = "k BIGINT, o BIGINT"
    put(spark, [(1, 1), (2, 1)], schema, source)
    spark.createDataFrame([(1, 99, 0)], "k long, o long, __bucket int").write.partitionBy("__bucket").parquet(f"{target}/rows/version=0")  # half written
    ingest.upsert_stream(spark, source, schema, target, state, ["k"], "o")
    assert sorted(map(tuple, ingest.read_upserted(spark, target, schema).collect())) == [(1, 1), (2, 1)]


def test_late_requests_count_as_in_order(spark):
    source, state = scratch(spark, "quota"), scratch(spark, "quota-state")
    r = random.Random(4)
    at = pd.Timestamp("2024-01-01")
    rows = [(k, i, (at + pd.Timedelta(minutes=r.randrange(0, 6000))).to_pydatetime(), r.randrange(1, 3)) for k in range(3) for i in range(60)]
    rows.sort(key=lambda x: x[2])
    schema = "user long, request long, ts timestamp, cost long"
    batches = [[], [], [], []]
    for n, row in enumerate(rows):  # each batch overlaps the next by some hours
        batches[min(3, n // 45 + (r.random() < 0.15))].append(row)
    ends = [(k, 900 + k, (at + pd.Timedelta(days=30)).to_pydatetime(), 1) for k in range(3)]
    progress = []
    for batch in [*batches, ends, [(9, 999, (at + pd.Timedelta(days=60)).to_pydatetime(), 1)], [(9, 1000, (at + pd.Timedelta(days=61)).to_pydatetime(), 1)]]:
        spark.createDataFrame(r.sample(batch, len(batch)), schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        q = ingest.quota_stream(stream, "user", "request", "ts", "cost", 20, delay="30 hours")
        out = q.writeStream.format("parquet").option("path", f"{source}-out").option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
        out.awaitTermination()
        progress += [p["stateOperators"][0]["numRowsTotal"] for p in out.recentProgress if p["stateOperators"]]
    whole = spark.createDataFrame([*rows, *ends], schema)
    key = lambda r: (r["key"], r["request"], r["window_start"], r["used"], r["over"])
    got = [x for x in spark.read.parquet(f"{source}-out").collect() if x["key"] != "9"]
    assert sorted(map(key, got)) == sorted(map(key, ingest.quota_batch(whole, "user", "request", "ts", "cost", 20).collect()))
    assert progress[-1] <= 4  # what is over has left the state
