import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sheafwork.operators import merge, resolve, windows
from sheafwork.sources import readers
from sheafwork.storage import scratch
from sheafwork.streaming import ingest


def test_cascade_stages(spark):
    accepted = spark.createDataFrame([(1, "Acer campestre", 0), (2, "Taraxacum officinale", 1), (3, "Rosa canina", 2), (4, "Betula pendula", 3)], "key long, name string, ord int")
    candidates = spark.createDataFrame([("1", "x"), ("90", "Rosa canina"), ("91", "A b"), ("92", "C d"), ("93", "Betulus pendula"), ("94", "Taraxacum sect. Taraxacum"), ("95", "Nix da")], "source string, name string")
    search = "array<struct<key:bigint,nubKey:bigint,rank:string,taxonomicStatus:string,genus:string,species:string,canonicalName:string>>"
    rows = [
        ("91", "EXACT", 99, "SYNONYM", 50, 4, None, None, None), ("92", "FUZZY", 97, "ACCEPTED", 77, None, "Acer campestre", "Acer", None), ("93", "EXACT", 99, "ACCEPTED", 78, None, None, "Betula", None),
        ("94", "NONE", 0, None, None, None, None, None, [(5, 2, "SPECIES", "ACCEPTED", "Taraxacum", None, None)]), ("95", "FUZZY", 80, "ACCEPTED", 1, None, None, None, None),
    ]
    responses = spark.createDataFrame(rows, f"source string, matchType string, confidence int, status string, usageKey long, acceptedUsageKey long, species string, genus string, search {search}")
    for n in (1, 4):
        counts = {}
        got = {r["source"]: (r["target"], r["via"]) for r in resolve.resolve_cascade(candidates.repartition(n), accepted.repartition(n), responses, counts).collect()}
        assert counts == {"direct": 7, "name": 6, "match": 5, "match-name": 4, "genus-epithet": 3, "aggregate": 2}
        assert got == {"1": (1, "direct"), "90": (3, "name"), "91": (4, "match"), "92": (1, "match-name"), "93": (4, "genus-epithet"), "94": (2, "aggregate"), "95": (None, "none")}


def test_a_cascade_stops_when_nothing_is_left(spark):
    accepted = spark.createDataFrame([(1, "A", 0)], "key long, name string, ord int")
    responses = spark.createDataFrame([], "source string, matchType string, confidence int, status string, usageKey long, acceptedUsageKey long, species string, genus string, search array<struct<key:bigint,nubKey:bigint,rank:string,taxonomicStatus:string,genus:string,species:string,canonicalName:string>>")
    counts = {}
    got = resolve.resolve_cascade(spark.createDataFrame([("1", "x"), ("2", "A")], "source string, name string"), accepted, responses, counts)
    assert sorted(map(tuple, got.collect())) == [("1", "x", 1, "direct"), ("2", "A", 1, "name")] and counts == {"direct": 2, "name": 1}


def test_errors_are_tried_again(spark):
    path, schema = scratch(spark, "map"), "source string, target long, via string"
    keys = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "source string")
    tried = []

    def look(down):
        def run(new):
            tried.append(sorted(r["source"] for r in new.collect()))
            return new.select("source", F.lit(1).cast("long").alias("target"), F.when(F.col("source").isin(down), "error").otherwise("match").alias("via"))

        return run

    spark.createDataFrame([("z", 9, "half")], schema).write.parquet(f"{path}/generation-000000")
    (spark._jvm.java.io.File(f"{path}/generation-000000/_SUCCESS")).delete()  # a generation that was never finished
    assert {r["source"] for r in resolve.resolve_generation(keys, path, schema, look(["c"])).collect()} == {"a", "b"}
    assert {r["source"] for r in resolve.resolve_generation(keys, path, schema, look([])).collect()} == {"a", "b", "c"}
    assert resolve.resolve_generation(keys, path, schema, look([])).count() == 3
    assert tried == [["a", "b", "c"], ["c"], []]


def test_partners_by_place(spark):
    import random

    from sheafwork.operators import indicators

    r = random.Random(8)
    rows = [(r.choice(["x", "y", None]), i, r.randrange(0, 40)) for i in range(120)] + [("x", 500, None), ("z", 501, 7)]
    frame = spark.createDataFrame(rows, "g string, k int, v long").repartition(5)
    want = set()
    for g, k, v in rows:
        if v is None:
            continue
        far = sorted((abs(v2 - v), v2 < v, -k2 if v2 < v else k2, k2) for g2, k2, v2 in rows if g2 == g and v2 is not None and abs(v2 - v) >= 9)
        want |= {(g, k, n + 1, x[3], x[0]) for n, x in enumerate(far[:4])}
    got = list(map(tuple, indicators.distant_partners(frame, "g", "k", "v", F.lit(9), 4).collect()))
    assert len(got) == len(set(got)) and set(got) == want


def test_all_distant_pairs(spark, tmp_path):
    import random

    from compare import duckdb_rows, rows_of

    from sheafwork import registry
    from sheafwork.plans import catalog_queries  # noqa: F401

    r = random.Random(8)
    odd = [None, 0.0, -0.0, 5000.0, -5000.0, 1e300, -1e300, 0.1, 5000.1, float("inf"), float("-inf"), float("nan")]
    rows = [(r.choice([1, 2, None]), i, r.choice(odd) if i % 3 == 0 else round(r.uniform(-9999, 9999), 2)) for i in range(150)] + [(1, 7, 9000.0), (1, None, 0.0), (3, 500, 1.0)]
    frame = spark.createDataFrame(rows, "s_nationkey int, s_suppkey int, s_acctbal double").repartition(5)
    frame.write.parquet(f"{tmp_path}/supplier.parquet")
    far = lambda v, w: v != v or w != w or abs(v - w) >= 5000 or v == w and abs(v) == float("inf")  # noqa: E731  (NaN is the largest number to SQL)
    want = sorted((g, k, k2) for g, k, v in rows for g2, k2, v2 in rows if None not in (g, k, v, k2, v2) and g == g2 and k < k2 and far(v, v2))
    df = registry.QUERIES["pair_distance"](spark, str(tmp_path))
    assert df.columns == ["s_nationkey", "a", "b", "distance"] and sorted((x[0], x[1], x[2]) for x in df.collect()) == want and len(want) > 1000
    plain = spark.createDataFrame([x for x in rows if x[2] is None or abs(x[2]) < 1e9], frame.schema)
    plain.coalesce(1).write.parquet(f"{tmp_path}/plain/supplier.parquet")
    files = tmp_path / "sql"
    files.mkdir()
    next((tmp_path / "plain" / "supplier.parquet").glob("part-*")).rename(files / "supplier.parquet")
    assert rows_of(registry.QUERIES["pair_distance"](spark, str(files)).toPandas()) == duckdb_rows(registry.ORACLES["pair_distance"], str(files))


def test_sketches_err_by_little(spark):
    import random

    from sheafwork.operators import indicators

    r = random.Random(1)
    rows = [(g, round(r.lognormvariate(2, 2) * (-1 if g == "n" else 1), 2)) for g in "abn" for _ in range(700)] + [("e", 0.0), ("e", None), ("o", None)]
    frame = spark.createDataFrame(rows, "g string, v double")
    parts = [indicators.sketch(p, ["g"], "v", 0.01) for p in (frame.where("v < 5"), frame.where("v >= 5"))]
    merged = indicators.merge_sketches(*parts, ["g"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, indicators.sketch(frame, ["g"], "v", 0.01).collect()))
    for q in (0.0, 0.1, 0.5, 0.99, 1.0):
        got = {x["g"]: x["quantile"] for x in indicators.sketch_quantile(merged, ["g"], q, 0.01).collect()}
        assert set(got) == {"a", "b", "n", "e"} and got["e"] == 0
        for g in "abn":
            values = sorted(v for h, v in rows if h == g)
            exact = values[max(1, -int(-q * len(values) // 1)) - 1]
            assert abs(got[g] - exact) <= abs(exact) / 2 ** (indicators.BITS - 1) + 1e-9


def test_bridge_needs_consensus(spark):
    rows = spark.createDataFrame([(1, "Picea glauca", ["Abies glauca", "Pinus glauca"]), (2, "Acer rubrum", ["Acer rubra", "Acer ruber"]), (3, "Poa alba", ["Poa nigra"])], "k int, n string, s array<string>")
    values = spark.createDataFrame([("abies glauca", 1), ("pinus glauca", 2), ("acer rubra", 7), ("poa nigra", 3)], "n string, v int")
    got = {r["k"]: (r["v"], r["agreed"]) for r in resolve.bridge_values(rows, "k", "n", "s", values, "n", "v").collect()}
    assert got == {1: (None, False), 2: (7, True)}


def test_entity_merge_order_does_not_matter(spark):
    data = [(1, 5, "old", "synonym", None), (2, 5, "new", "canonical", "g"), (3, None, "a", None, None), (4, None, "b", None, None)]
    rows = spark.createDataFrame(data, "o int, e int, n string, via string, g string")
    for some in (rows, rows.orderBy(F.desc("o")).repartition(7)):
        got = sorted(map(tuple, merge.merge_entities(some, "e", "o", F.col("via") == "canonical", "n", ["g"]).select("e", "n", "g", "also").collect()), key=str)
        assert got == sorted([(5, "new", "g", ["old"]), (None, "a", None, []), (None, "b", None, [])], key=str)


def test_own_record_comes_first(spark):
    rows = spark.createDataFrame([(7, "90", ["b"], 0), (7, "7", ["a"], 1), (7, "7", ["a2"], 2), (8, "91", ["c"], 3)], "t long, s string, names array<string>, o int")
    got = {r["t"]: r["names"] for r in merge.grouped_names(rows.repartition(3), "t", "s", "names", "o").collect()}
    assert got == {7: ["a2", "a", "b"], 8: ["c"]}


def test_rows_are_anchored_at_their_first_word(spark):
    words = spark.createDataFrame([("d", 0.0, 1.0, "a"), ("d", 3.0, 0.0, "b"), ("d", 6.0, 0.0, "c"), ("d", 9.0, 2.0, "e")], "d string, y double, x double, w string")
    got = sorted((r["row"], r["text"]) for r in windows.cluster_rows(words, ["d"], "y", "x", "w", 4.0).collect())
    assert got == [(0, "b a"), (1, "c e")]


def test_tolerant_reader_and_keyed_json(spark):
    path = scratch(spark, "lines")
    spark.createDataFrame([('{"a": 1}',), ("{broken",), ("",), ('{"a": 2}',)], "value string").coalesce(1).write.text(path)
    good, bad = readers.read_ndjson_tolerant(spark, path, "a INT")
    assert sorted(r["a"] for r in good.collect()) == [1, 2] and [r["line"] for r in bad.collect()] == ["{broken"]
    keyed = scratch(spark, "keyed")
    spark.createDataFrame([(json.dumps({"version": "1", "values": {"x": 1.5, "y": 2.5}}),)], "value string").coalesce(1).write.text(keyed)
    assert {r["key"]: r["value"] for r in readers.read_keyed_json(spark, keyed, "DOUBLE", "values").collect()} == {"x": 1.5, "y": 2.5}


def test_missing_inputs_are_named(spark):
    import pytest

    with pytest.raises(FileNotFoundError, match="nowhere"):
        readers.require_inputs(spark, "/tmp/nowhere-at-all")


def test_orders(spark, sf_dir):
    import duckdb

    from sheafwork import registry
    from sheafwork.plans import catalog_queries  # noqa: F401

    con = duckdb.connect()
    for name in ("orders", "customer", "events", "part", "nation"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    orders = {"group_histogram": "n DESC, event_type", "wanted_subset": "wanted_ord"}
    for name, order in orders.items():
        got = [tuple(r) for r in registry.QUERIES[name](spark, sf_dir).collect()]
        assert got == con.execute(f"SELECT * FROM ({registry.ORACLES[name]}) ORDER BY {order}").fetchall()
    got = [r["category_rank"] for r in registry.QUERIES["category_sort"](spark, sf_dir).collect()] if "category_rank" in registry.QUERIES["category_sort"](spark, sf_dir).columns else []
    assert got == sorted(got)


def test_repeated_keys_add_no_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, n string")
    keys = spark.createDataFrame([("1", 7), ("1", 8), ("c", 9)], "s string, t long")
    assert sorted(r["resolved"] for r in resolve.translate_keys(rows, "k", keys, "s", "t", F.col("n")).collect()) == [2, 7, 9]
    values = spark.createDataFrame([("tilia cordata", 1), ("tilia cordata", 1)], "n string, v int")
    assert resolve.direct_values(spark.createDataFrame([(1, "Tilia cordata")], "k int, n string"), "k", "n", values, "n", "v").count() == 1


def test_checks(spark):
    from sheafwork.operators import audit, filters

    rows = spark.createDataFrame([(1,), (5,)], "k int")
    known = spark.createDataFrame([(1,)], "c int")
    with pytest.raises(ValueError, match="orphans: 1 rows"):
        audit.require_none(audit.orphans(rows, "k", known, "c"), "orphans")
    assert audit.require_none(audit.orphans(known.withColumnRenamed("c", "k"), "k", known, "c"), "orphans").count() == 0
    work = spark.createDataFrame([(1, None, 3), (2, None, 3), (3, None, 0), (4, "x", 3)], "k int, n string, m int")
    done = spark.createDataFrame([], "d int")
    keys = spark.createDataFrame([(1,), (3,)], "source int")
    assert [r["k"] for r in filters.open_work(work, "k", done, "d", F.col("n").isNull(), "m", keys).collect()] == [1]
    with pytest.raises(ValueError, match="lists is empty"):
        readers.require_rows(rows.limit(0), "lists")


def test_reading_and_observing(spark):
    from sheafwork.sources import sinks

    path = scratch(spark, "keys")
    spark.createDataFrame([("12",), (" 7 ",), ("x",), ("",)], "value string").write.text(path)
    assert sorted(r["key"] for r in readers.read_key_lines(spark, path).collect()) == [7, 12]
    rows, seen = sinks.observed(spark.range(10), "run", {"n": F.count("*"), "most": F.max("id")})
    none = scratch(spark, "unwritten")
    assert sinks.write_json(rows, none, write=False).count() == 10 and seen.get == {"n": 10, "most": 9}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.text(none).count()


def test_hot_keys_fold_in_order(spark):
    rows = spark.range(3000).select((F.col("id") % 3 == 0).cast("string").alias("u"), "id", (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("t"), F.lit(1).alias("c"))
    got = ingest.quota_batch(rows.repartition(7), "u", "id", "t", "c", 10).orderBy("key", "request").collect()
    want, state = [], {}
    for r in sorted(rows.collect(), key=lambda r: (r["u"], r["id"])):
        start, used = state.get(r["u"], (None, 0))
        start, used = (r["t"], 1) if start is None or (r["t"] - start).total_seconds() >= 86400 else (start, used + 1)
        state[r["u"]] = start, used
        want.append((r["u"], r["id"], start, used, used > 10))
    assert [(r["key"], r["request"], r["window_start"], r["used"], r["over"]) for r in got] == want
    assert ingest.quota_batch(rows.limit(0), "u", "id", "t", "c", 10).count() == 0
