"""Incremental jobs on Structured Streaming: resumable ingest, exactly once a key, retries, quotas, upserts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.order import anchored
from ..storage import folders, remove, written

#: Buckets of a table that a stream writes by key.
BUCKETS = 16


def once_within(rows: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """A key once as long as its repeats are no later than ``delay``; bounded state."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def ingest_files(spark: SparkSession, path: str, schema: str, target: str, checkpoint: str, key: str | None = None, files_per_trigger: int = 16, fmt: str = "json") -> None:
    """Appends what new files hold; finished files are skipped, and a key is written once however often and however late it comes.

    What is written is the only memory: a batch is held against the stored keys of the buckets that it touches, so the stream
    itself has no state that grows. A batch that runs again replaces what it wrote before. Rows without a key are one key.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)
    if not key:
        rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(target).awaitTermination()
        return

    def put(batch: DataFrame, n: int) -> None:
        # a key's first row of a batch is any of them, so it is taken once and for all
        new = written(batch.dropDuplicates([key]).withColumn("__bucket", _bucket([key], BUCKETS)), "batch")
        touched = [r["__bucket"] for r in new.select("__bucket").distinct().collect()]
        paths = [f"{target}/__batch={i}" for i in _numbers(spark, target, "__batch=") if i < n]
        if paths and touched:
            held = spark.read.option("basePath", target).schema(new.schema).parquet(*paths).where(F.col("__bucket").isin(touched)).select(F.col(key).alias("__held"))
            new = new.join(held, F.col(key).eqNullSafe(F.col("__held")), "left_anti")
        new.write.mode("overwrite").partitionBy("__bucket").parquet(f"{target}/__batch={n}")

    rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()


def ingested(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """What ``ingest_files`` has written with a key."""
    paths = [f"{target}/__batch={i}" for i in _numbers(spark, target, "__batch=")]
    none = spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", target).parquet(*paths).select(none.columns) if paths else none


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    return sorted(int(x[len(prefix) :]) for x in folders(spark, path) if x.startswith(prefix))


def retry(spark: SparkSession, queue: str, attempt: Callable[[DataFrame], DataFrame], done: str, rounds: int = 3) -> DataFrame:
    """Attempts what is in the queue (attempt adds ``ok``); successes are appended to ``done``, failures make the next round's queue."""
    rest = spark.read.parquet(queue)
    for i in range(rounds):
        tried = attempt(rest.withColumn("attempt", F.lit(i + 1)))
        path = f"{queue}-round-{i + 1}"
        tried.write.mode("overwrite").parquet(path)
        tried = spark.read.parquet(path)
        tried.where("ok").write.mode("append").parquet(done)
        rest = tried.where("NOT ok").drop("ok", "attempt")
        if rest.isEmpty():
            break
    return rest


WINDOW_OUT = "key string, request bigint, ts timestamp, window_start timestamp, used bigint, over boolean"


def _requests(rows: DataFrame, key: str, request: str, time: str, cost: str) -> DataFrame:
    return rows.select(F.col(key).cast("string").alias("key"), F.col(request).cast("long").alias("request"), F.col(time).cast("timestamp").alias("ts"), F.coalesce(F.col(cost).cast("long"), F.lit(0).cast("long")).alias("cost"))


def quota_batch(rows: DataFrame, key: str, request: str, time: str, cost: str, quota: int, hours: float = 24) -> DataFrame:
    """Requests with their window's start, what is used by then, and whether that is over the quota; windows begin at a first request.

    Where a window begins depends on the one before; see ``anchored``. Requests of one time go by their number. A request
    without a time belongs to no window: start and use are null, and it isn't over.
    """
    named = _requests(rows, key, request, time, cost)
    span = F.make_dt_interval(secs=F.lit(hours * 3600).cast("decimal(18,6)"))
    placed = anchored(named.where("ts IS NOT NULL"), ["key"], "ts", lambda t: t + span, ["request"], inclusive=False, sums={"used": F.col("cost")})
    timed = placed.select("key", "request", "ts", F.col("window_at").alias("window_start"), "used", (F.col("used") > quota).alias("over"))
    none = F.lit(None)
    return timed.unionByName(named.where("ts IS NULL").select("key", "request", "ts", none.cast("timestamp").alias("window_start"), none.cast("long").alias("used"), F.lit(False).alias("over")))


class _QuotaWindows(StatefulProcessor):
    """A key's requests wait until the watermark has passed them, then they are counted in order; a window's state ends with it."""

    def __init__(self, quota: int, hours: float):
        self.quota, self.hours = quota, hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "start timestamp, used bigint")
        self.waiting = handle.getListState("waiting", "ts timestamp, request bigint, cost bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        found = [(r.ts.to_pydatetime(), int(r.request), int(r.cost)) for frame in rows for r in frame.itertuples()]
        self.waiting.appendList(found)
        self._wake(min(r[0] for r in found))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        passed = pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms")
        rows = sorted(tuple(r) for r in self.waiting.get())
        ready, rest = [r for r in rows if pd.Timestamp(r[0]) <= passed], [r for r in rows if pd.Timestamp(r[0]) > passed]
        start, used = self.window.get() if self.window.exists() else (None, 0)
        out = []
        for ts, request, cost in ready:
            start, used = (ts, cost) if start is None or pd.Timestamp(ts) - pd.Timestamp(start) >= pd.Timedelta(hours=self.hours) else (start, used + cost)
            out.append((key[0], request, ts, start, used, used > self.quota))
        end = None if start is None else pd.Timestamp(start) + pd.Timedelta(hours=self.hours)
        if end is None or end <= passed:
            self.window.clear()
        else:
            self.window.update((start, used))
            self._wake(end)
        if rest:
            self.waiting.put(rest)
            self._wake(rest[0][0])
        else:
            self.waiting.clear()
        if out:
            yield pd.DataFrame(out, columns=["key", "request", "ts", "window_start", "used", "over"])

    def _wake(self, at: object) -> None:
        self.handle.registerTimer(-(-pd.Timestamp(at).value // 1_000_000))

    def close(self) -> None:
        pass


def quota_stream(rows: DataFrame, key: str, request: str, time: str, cost: str, quota: int, hours: float = 24, delay: str = "1 hour") -> DataFrame:
    """The same over a stream whose requests come in any order, up to ``delay`` late: each is given out once the watermark has passed it.

    A key's state is one window and the requests that still wait; it ends when the watermark has passed the window. Requests
    later than ``delay`` are beyond the watermark and Spark leaves them out, as are those without a time.
    """
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    named = _requests(rows, key, request, time, cost).where("ts IS NOT NULL").withWatermark("ts", delay)
    return named.groupBy("key").transformWithStateInPandas(_QuotaWindows(quota, hours), WINDOW_OUT, "Append", "EventTime")


def upsert_stream(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keys: list[str], ordinal: str, fmt: str = "json", buckets: int = BUCKETS) -> None:
    """Upserts new files into a table by key, the row of the largest ordinal winning whatever order files come in; see ``read_upserted``.

    The table lies in buckets by key, and a version is a manifest of which bucket stands in which folder. A batch rewrites the
    buckets that it touches and commits by its manifest, which is written last. A batch that runs again after its commit
    changes nothing; before it, it writes the same again. Readers of a version may go on while the next is written: only
    what neither of the last two versions names is removed. The number of buckets stays what it was at first.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).format(fmt).load(source)

    def merge(batch: DataFrame, n: int) -> None:
        if n in _numbers(spark, f"{target}/manifest", "version="):
            return
        known = _manifest(spark, target, n - 1)
        new = written(batch.withColumn("__bucket", _bucket(keys, buckets)), "batch")
        touched = sorted(r["__bucket"] for r in new.select("__bucket").distinct().collect())
        paths = [f"{target}/rows/version={known[b]}/__bucket={b}" for b in touched if b in known]
        both = new.unionByName(spark.read.schema(batch.schema).parquet(*paths).withColumn("__bucket", _bucket(keys, buckets))) if paths else new
        rest = F.struct(*[c for c in batch.columns if c not in keys])
        merged = both.groupBy("__bucket", *keys).agg(F.max_by(rest, F.struct(F.col(ordinal), rest)).alias("r")).select("__bucket", *keys, "r.*")
        merged.write.mode("overwrite").partitionBy("__bucket").parquet(f"{target}/rows/version={n}")
        entries = sorted({**known, **{b: n for b in touched}}.items())
        spark.createDataFrame(entries, "__bucket int, version int").coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/version={n}")
        for b, v in _manifest(spark, target, n - 2).items():
            if known.get(b) != v:
                remove(spark, f"{target}/rows/version={v}/__bucket={b}")
        remove(spark, f"{target}/manifest/version={n - 2}")

    rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge).trigger(availableNow=True).start().awaitTermination()


def _manifest(spark: SparkSession, target: str, n: int) -> dict[int, int]:
    """The folder's version of each bucket in version ``n``; at most as many rows as buckets."""
    if n not in _numbers(spark, f"{target}/manifest", "version="):
        return {}
    return {r["__bucket"]: r["version"] for r in spark.read.schema("__bucket int, version int").parquet(f"{target}/manifest/version={n}").collect()}


def read_upserted(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """The last committed version."""
    versions = _numbers(spark, f"{target}/manifest", "version=")
    paths = [f"{target}/rows/version={v}/__bucket={b}" for b, v in _manifest(spark, target, versions[-1]).items()] if versions else []
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
