"""Whole orders and anchored windows: against plain loops, with keys that one task shouldn't hold, and by their plans."""

import random

import pytest
from pyspark.sql import functions as F

from sheafwork.operators import order, windows
from sheafwork.streaming import ingest


def plan(frame):
    return frame._jdf.queryExecution().toString()


def test_places_and_sums(spark):
    r = random.Random(5)
    rows = [(i, r.randrange(40), r.choice([None, 1, 2, 3])) for i in range(700)]
    frame = spark.createDataFrame(rows, "id int, k int, v long").repartition(6)
    want, total = {}, None
    for place, (i, k, v) in enumerate(sorted(rows, key=lambda x: (-x[1], x[0]))):
        total = total if v is None else (total or 0) + v
        want[i] = (place, total)
    got = order.running_sums(frame, [F.desc("k"), F.col("id")], {"total": "v"})
    assert {x["id"]: (x["place"], x["total"]) for x in got.collect()} == want
    assert {x["id"]: x["place"] for x in order.numbered(frame, [F.desc("k"), F.col("id")]).collect()} == {i: p for i, (p, _) in want.items()}
    assert order.numbered(frame.limit(0), ["k"]).collect() == [] and order.running_sums(frame.limit(0), ["k"], {"t": "v"}).collect() == []


def test_sums_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(order, "BLOCK", 4)
    frame = spark.range(150).select(F.col("id").alias("p"), (F.col("id") % 7).alias("v"))
    got = {r["p"]: r["s"] for r in order.running_at(frame, "p", {"s": F.col("v")}).collect()}
    assert got == {i: sum(j % 7 for j in range(i + 1)) for i in range(150)}


def test_no_task_takes_a_whole_order(spark):
    frame = spark.range(20_000).select("id", F.lit(1).alias("same"))
    for out in (order.numbered(frame, ["same"]), order.whole_batches(frame, ["same"], 60), order.running_sums(frame, ["same"], {"s": "id"})):
        assert "SinglePartition" not in plan(out)
    # rows that tie are spread too
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [r["count"] for r in order._ranged(frame, ["same"], {}).groupBy("__range").count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 0.6 * sum(sizes)
    assert sorted(r["place"] for r in order.numbered(frame, ["same"]).collect()) == list(range(20_000))


def test_budget_and_block_order(spark):
    rows = spark.createDataFrame([("b", "x", 5, False), ("a", "y", 9, False), ("a", "z", 1, False), ("c", "w", 1, True), ("c", "v", None, None), (None, "n", 2, False)], "block string, name string, n int, flag boolean")
    got = order.whole_block_sort(rows, "block", F.col("name") == "z", F.col("flag"), "n", "name").orderBy("sort_index").collect()
    assert [r["name"] for r in got] == ["w", "v", "z", "y", "x", "n"]
    assert [r["name"] for r in order.whole_budget(rows, [F.desc("n"), F.col("name")], "n", 16).orderBy("running", "name").collect()] == ["y", "x", "n"]


def fold(rows, hours):
    out, state = [], {}
    for k, i, t, c in sorted(rows, key=lambda r: (r[0] or "", r[2], r[1])):
        start, used = state.get(k, (None, 0))
        start, used = (t, c) if start is None or t - start >= hours * 3600 else (start, used + c)
        state[k] = start, used
        out.append((k, i, start, used))
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [2, 4096])
def test_quota_windows(spark, monkeypatch, small):
    monkeypatch.setattr(order, "SMALL", small)
    r = random.Random(small)
    rows = [(r.choice("abc"), i, r.randrange(0, 400_000, 1800), r.randrange(3)) for i in range(300)] + [("d", 900, 5, 1), ("d", 901, 5, 1), ("d", 902, 5 + 86_400, 1)]
    frame = spark.createDataFrame(rows, "u string, id long, s long, c long").withColumn("t", F.timestamp_seconds("s")).repartition(5)
    got = ingest.quota_batch(frame, "u", "id", "t", "c", 10)
    assert "Python" not in plan(got) and "Pandas" not in plan(got) and "Arrow" not in plan(got)
    assert sorted(((x["key"], x["request"], int(x["w"]), x["used"]) for x in got.withColumn("w", F.unix_timestamp("window_start")).collect()), key=repr) == fold(rows, 24)
    untimed = ingest.quota_batch(spark.createDataFrame([("a", 1, None, 1)], "u string, id long, t timestamp, c long"), "u", "id", "t", "c", 0).collect()
    assert [tuple(x) for x in untimed] == [("a", 1, None, None, None, False)]


def test_a_key_of_200_000_rows(spark):
    n = 200_000
    frame = spark.range(n).select(F.lit("one").alias("u"), "id", F.timestamp_seconds(F.col("id") * 60).alias("t"), F.lit(1).alias("c"))
    got = ingest.quota_batch(frame, "u", "id", "t", "c", 100).agg(F.count("*").alias("n"), F.count_distinct("window_start").alias("w"), F.max("used").alias("m"), F.count_if("over").alias("o"), F.count_if(F.unix_timestamp("ts") - F.unix_timestamp("window_start") != (F.col("used") - 1) * 60).alias("bad")).first()
    per = 24 * 60
    assert tuple(got) == (n, -(-n // per), per, n // per * (per - 100) + max(0, n % per - 100), 0)


@pytest.mark.parametrize("small", [2, 4096])
def test_rows_of_words(spark, monkeypatch, small):
    monkeypatch.setattr(order, "SMALL", small)
    words = [("d", 0.0, 1.0, "a"), ("d", 3.0, 0.0, "b"), ("d", 4.0, 2.0, "B"), ("d", 6.0, 0.0, "c"), ("d", 9.0, 2.0, "e"), (None, 1.0, 0.0, "f"), (None, 50.0, 0.0, "g"), ("d", None, 0.0, "lost")]
    got = windows.cluster_rows(spark.createDataFrame(words, "d string, y double, x double, w string"), ["d"], "y", "x", "w", 4.0)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("d", 0, "b a B"), ("d", 1, "c e"), (None, 0, "f"), (None, 1, "g")], key=repr)
