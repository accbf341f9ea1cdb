"""Exact k nearest binary codes by incremental multi-index hashing.

A code's segments are indexed each by its value. A query looks up, for one segment after another, all values within a
radius that grows; every code in a bucket that it hits is verified by its whole Hamming distance. After the segments up
to j at radius a, all codes within m * a + j are known, so a query ends when its k-th distance is at most that. Equal
codes are one entry of the index with their k + 1 smallest ids, and buckets are cut into blocks, so neither copies nor
full buckets gather in a row. Segments have 16 bits, so a bucket holds a 65,536th of the codes on average; larger ones would
need too many probes for each radius.

Defined cases: rows without an id or a vector are neither found nor queries; a vector of another length than the codes'
is an error; ids repeated with equal codes count once; equal distances go to the smaller id; a query doesn't find its own
id; with fewer than k other rows all are returned, found without probing; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BITS = 64
SEGMENT = 16
#: Codes in a block of a bucket.
BLOCK = 512
#: Up to this radius all segments are looked up in one step; beyond, one after another.
TOGETHER = 2


def sign_codes(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", bits: int = BITS) -> DataFrame:
    """(id, code): bit i is set where the vector's i-th value is above 0."""
    code = F.expr(f"aggregate(sequence(0, {bits - 1}), 0L, (c, i) -> c | shiftleft(IF(`{vector_col}`[i] > 0, 1L, 0L), i))")
    whole = F.when(F.size(vector_col) == bits, code).otherwise(F.raise_error(F.lit("a vector has another length than the codes")).cast("long"))
    return rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), whole.alias("code")).distinct()


def _segment(code: Column, j: int, size: int = SEGMENT) -> Column:
    return F.shiftrightunsigned(code, j * size).bitwiseAND((1 << size) - 1).cast("int")


def build_index(codes: DataFrame, k: int, bits: int = BITS, size: int = SEGMENT) -> DataFrame:
    """(segment, value, entries): blocks of the codes with that value there, each with its k + 1 smallest ids."""
    order = Window.partitionBy("code").orderBy("id")
    entries = written(codes.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "code-entries")
    segments = F.array(*[F.struct(F.lit(j).alias("segment"), _segment(F.col("code"), j, size).alias("value")) for j in range(bits // size)])
    long = entries.select("code", "ids", F.explode(segments).alias("s")).select("s.segment", "s.value", "code", "ids")
    # of a bucket's codes about BLOCK share a block: as many blocks as its count asks for, dealt by hash; counts are a table, so
    # that the join can split a bucket of very many
    counts = written(long.groupBy("segment", "value").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "code-buckets")
    dealt = long.join(counts, ["segment", "value"]).withColumn("block", F.pmod(F.xxhash64("code"), F.col("blocks")))
    return dealt.groupBy("segment", "value", "block").agg(F.collect_list(F.struct("code", "ids")).alias("entries")).drop("block")


def nearest(codes: DataFrame, queries: DataFrame, k: int = 10, bits: int = BITS, size: int = SEGMENT) -> DataFrame:
    """(query_id, rank, id, distance) of each query's k nearest codes. ``queries``: (id, code)."""
    m = bits // size
    few = codes.select("id", "code").distinct().limit(k + 1).collect()
    if len(few) <= k:  # every row is a neighbour
        others = F.array(*[F.struct(F.lit(r["id"]).alias("id"), F.lit(r["code"]).alias("code")) for r in few]).cast("array<struct<id:bigint,code:bigint>>")
        pairs = queries.select(F.col("id").alias("query_id"), F.col("code").alias("qcode"), F.explode(others).alias("e")).where("e.id <> query_id")
        found = pairs.groupBy("query_id", F.col("e.id").alias("id")).agg(F.min(F.bit_count(F.col("e.code").bitwiseXOR(F.col("qcode")))).alias("distance"))
        return found.select("query_id", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id")).alias("rank"), "id", "distance")
    index = written(build_index(codes, k, bits, size), "code-index")
    active = written(queries.select(F.col("id").alias("q"), F.col("code").alias("qcode"), F.lit(bits + 1).alias("bound")), "code-queries")
    best = None
    steps = [(a, tuple(range(m))) for a in range(TOGETHER + 1)] + [(a, (j,)) for a in range(TOGETHER + 1, size + 1) for j in range(m)]
    for a, segments in steps:
        masks = F.array(*[F.lit(sum(1 << i for i in c)) for c in combinations(range(size), a)]) if a else F.array(F.lit(0))
        if a > 4:  # too many to write out
            masks = F.expr(f"filter(sequence(0, {(1 << size) - 1}), x -> bit_count(x) = {a})")
        probes = active.select("q", "qcode", "bound", F.explode(F.array(*[F.struct(F.lit(j).alias("segment"), _segment(F.col("qcode"), j, size).alias("own")) for j in segments])).alias("s"))
        probes = probes.select("q", "qcode", "bound", "s.segment", "s.own", F.explode(masks).alias("mask")).select("q", "qcode", "bound", "segment", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
        # a code is taken where it is met first: earlier segments are further than a, later ones than a - 1
        apart = [F.bit_count(F.shiftrightunsigned(F.col("e.code").bitwiseXOR(F.col("qcode")), j * size).bitwiseAND((1 << size) - 1)) for j in range(m)]
        first = F.lit(True)
        for i in range(m):
            first = first & ((F.lit(i) == F.col("segment")) | (apart[i] > F.when(F.lit(i) < F.col("segment"), a).otherwise(a - 1)))
        # a size estimate doesn't see the masks, and a broadcast would bring all probes to the driver
        met = probes.hint("merge").join(index, ["segment", "value"]).select("q", "qcode", "bound", "segment", F.expr("filter(entries, e -> bit_count(e.code ^ qcode) <= bound)").alias("entries"))
        found = met.where(F.size("entries") > 0).select("q", "qcode", "segment", F.explode("entries").alias("e")).where(first)
        rows = found.select("q", F.bit_count(F.col("e.code").bitwiseXOR(F.col("qcode"))).alias("distance"), F.explode("e.ids").alias("id")).where("id <> q")
        rows = rows if best is None else rows.unionByName(best)
        ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("distance", "id"))).where(F.col("rank") <= k)
        best = written(ranked.drop("rank"), "code-best")
        known = best.groupBy("q").agg(F.count("*").alias("n"), F.max("distance").alias("kth"))
        covered = m * a + max(segments)
        state = active.drop("bound").join(known, "q", "left").withColumn("bound", F.when(F.col("n") >= k, F.col("kth")).otherwise(bits + 1))
        active = written(state.where(F.col("bound") > covered).select("q", "qcode", "bound"), "code-queries")
        if active.isEmpty():
            break
    out = best.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("distance", "id")))
    return out.select(F.col("q").alias("query_id"), "rank", "id", "distance")


SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (SELECT q.vec_id AS query_id, v.vec_id, len(list_filter(range(1, 65), lambda i: q.bits[i] <> v.bits[i])) AS distance
      FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""
