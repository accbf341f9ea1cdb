"""Writers: tables, rejects, manifests, lists by group, partner documents and keyed upserts."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, mode: str = "overwrite", write: bool = True) -> DataFrame:
    """One object a line, committed as a whole; with ``write=False`` only the rows are returned."""
    if write:
        df.write.mode(mode).json(path)
    return df


def append_rows(df: DataFrame, more: DataFrame) -> DataFrame:
    """Rows of another shape below, fields by name; missing ones are null."""
    return df.unionByName(more, allowMissingColumns=True)


def split_rejects(df: DataFrame, reasons: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet no reason, and the others with the first reason they meet."""
    reason = F.coalesce(*[F.when(c, F.lit(name)) for name, c in reasons.items()])
    marked = df.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def manifest(df: DataFrame, counters: dict[str, Column], settings: dict[str, str] | None = None) -> DataFrame:
    """One row of a run's settings and counters."""
    return df.agg(*[c.alias(n) for n, c in counters.items()]).select(*[F.lit(v).alias(k) for k, v in (settings or {}).items()], *counters)


def observed(df: DataFrame, name: str, counters: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with counters that are filled by whatever action runs on it."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(n) for n, c in counters.items()]), seen


def split_review(df: DataFrame, trusted: Column) -> tuple[DataFrame, DataFrame]:
    ok = F.coalesce(trusted, F.lit(False))
    return df.where(ok), df.where(~ok)


def write_by_group(df: DataFrame, path: str, group: str, key: str, order: list[str]) -> DataFrame:
    """One folder a group, each key once there, sorted."""
    from pyspark.sql import Window

    once = df.withColumn("nth", F.row_number().over(Window.partitionBy(group, key).orderBy(*order))).where("nth = 1").drop("nth")
    once.repartition(group).sortWithinPartitions(group, *order).write.mode("overwrite").partitionBy(group).json(path)
    return once


def partner_document(df: DataFrame, rank: str, fields: list[str]) -> DataFrame:
    """Rows as JSON documents and one meta document of counts by rank: (part, document)."""
    meta = df.groupBy(rank).agg(F.count("*").alias("n")).agg(F.sum("n").alias("total"), F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce(rank, F.lit("none")), "n")))).alias("by_rank"))
    return meta.select(F.lit("meta").alias("part"), F.to_json(F.struct("total", "by_rank")).alias("document")).unionByName(df.select(F.lit("row").alias("part"), F.to_json(F.struct(*fields)).alias("document")))


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], ordinal: str | None = None) -> DataFrame:
    """The target with rows replaced or added by key; keys may be null. Of a key that repeats in ``changes`` the row of the
    largest ordinal counts (of ties, and without an ordinal, the largest row), so no key is added twice."""
    rest = F.struct(*[c for c in target.columns if c not in keys])
    rank = rest if ordinal is None else F.struct(F.col(ordinal), rest)
    once = changes.groupBy(*keys).agg(F.max_by(rest, rank).alias("__r")).select(*keys, "__r.*") if len(keys) < len(target.columns) else changes.select(*keys).distinct()
    t, c = target.alias("t"), once.alias("c")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    kept = t.join(c, functools.reduce(lambda a, b: a & b, same), "left_anti")
    return kept.unionByName(once.select(*target.columns))
