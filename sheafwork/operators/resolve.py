"""Resolving keys between sources: translation, an auditable cascade, name indexes, synonym bridges."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..storage import folders, written


def translate_keys(df: DataFrame, key: str, key_map: DataFrame, source: str, target: str, fallback: Column | None = None) -> DataFrame:
    """Adds ``resolved``: the map's target of the key, else the key; rows without a key go by ``fallback`` into the map, or out."""
    m = key_map.groupBy(F.col(source).cast("string").alias("__s")).agg(F.min(target).alias("__t"))  # a key that stands twice adds no rows
    looked = F.when(F.col(key).isNotNull(), F.col(key).cast("string"))
    if fallback is not None:
        looked = F.coalesce(looked, fallback)
    joined = df.withColumn("__k", looked).join(m, F.col("__k") == F.col("__s"), "left")
    return joined.withColumn("resolved", F.coalesce("__t", F.col(key))).where("resolved IS NOT NULL").drop("__k", "__s", "__t")


def accept_match(r: str = "r") -> Column:
    """The key that a match response gives: none for no match or an unsure fuzzy one, the accepted key for a synonym."""
    c = lambda f: F.col(f"{r}.{f}")
    no = (c("matchType") == "NONE") | ((c("matchType") == "FUZZY") & (F.coalesce(c("confidence"), F.lit(0)) < 95))
    return F.when(~F.coalesce(no, F.lit(True)), F.when(c("status") == "SYNONYM", c("acceptedUsageKey")).otherwise(c("usageKey")))


def accept_search(name: Column, search: str) -> Column:
    """The first candidate of a search that is an accepted species of the name's genus; its backbone key first."""
    fit = F.filter(search, lambda t: (t["rank"] == "SPECIES") & (t["taxonomicStatus"] == "ACCEPTED") & (t["genus"] == T.genus(name)))
    first = F.get(fit, F.lit(0))
    return F.coalesce(first["nubKey"], first["key"])


def resolve_cascade(candidates: DataFrame, accepted: DataFrame, responses: DataFrame, counts: dict[str, int] | None = None) -> DataFrame:
    """(source, name, target, via) for candidates (source, name): each stage looks at what the stages before left.

    accepted: (key, name, ord); responses: (source, matchType, confidence, status, usageKey, acceptedUsageKey, species, genus, search).
    A stage's rows are written, the next stage reads those without a target, and when none is left no stage follows; so
    responses are looked up for what neither key nor name has resolved. ``counts``, where given, gets how many rows each stage read.
    """
    keys = accepted.select(F.col("key").alias("k")).distinct()
    by_name = accepted.groupBy("name").agg(F.min_by("key", "ord").alias("nk"))
    answered = lambda df: df.join(responses.select("source", F.struct(*[c for c in responses.columns if c != "source"]).alias("r")), "source", "left")
    known = lambda df: df.join(keys.withColumnRenamed("k", "target"), F.col("at") == F.col("target"), "left")
    named = lambda df: df.join(by_name.select(F.col("name").alias("__m"), F.col("nk").alias("target")), F.col("at") == F.col("__m"), "left").drop("__m")
    epithet = T.guarded_epithet("name")
    stages = [
        ("direct", F.expr("try_cast(source AS BIGINT)"), known),
        ("name", F.col("name"), named),
        ("match", accept_match(), known),
        ("match-name", F.when(accept_match().isNotNull() | F.col("r.species").isNotNull(), F.col("r.species")), named),
        ("genus-epithet", F.when(epithet.isNotNull() & F.col("r.genus").isNotNull(), F.concat_ws(" ", F.col("r.genus"), epithet)), named),
        ("aggregate", F.when(T.has_group_mark("name"), accept_search(F.col("name"), "r.search")), known),
    ]
    rest, done = candidates.select("source", "name"), []
    for via, column, look in stages:
        if via == "match":
            rest = answered(rest)
        seen = Observation(f"{via} {uuid.uuid4().hex}")
        tried = written(look(rest.observe(seen, F.count("*").alias("n")).withColumn("at", column)).drop("at"), "cascade")
        if counts is not None:
            counts[via] = seen.get["n"]
        done.append(tried.where("target IS NOT NULL").select("source", "name", "target", F.lit(via).alias("via")))
        rest = tried.where("target IS NULL").drop("target")
        if rest.isEmpty():
            break
    done.append(rest.select("source", "name", F.lit(None).cast(accepted.schema["key"].dataType).alias("target"), F.lit("none").alias("via")))
    return functools.reduce(DataFrame.unionByName, done)


def resolve_new(candidates: DataFrame, stored: DataFrame, resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stored map with what ``resolve`` gives for candidates that it lacks."""
    return stored.unionByName(resolve(candidates.join(stored.select("source"), "source", "left_anti")))


def stored_map(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The map of all generations; none yet gives an empty one."""
    found = [f"{path}/{g}" for g in folders(spark, path) if "_SUCCESS" in folders(spark, f"{path}/{g}")]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def resolve_generation(candidates: DataFrame, path: str, schema: str, resolve: Callable[[DataFrame], DataFrame], failed: str = "error") -> DataFrame:
    """The stored map after a run: candidates (source, ...) that it lacks are resolved and written as its next generation.

    ``resolve`` sees each source once and gives rows of the schema; those whose ``via`` is ``failed`` are not stored, so the
    next run tries them again. A generation counts when it is written whole; one that was left half written is written anew.
    """
    spark = candidates.sparkSession
    known = stored_map(spark, path, schema)
    new = candidates.dropDuplicates(["source"]).join(known.select("source"), "source", "left_anti")
    done = [g for g in folders(spark, path) if "_SUCCESS" in folders(spark, f"{path}/{g}")]
    resolve(new).where(F.col("via").isNull() | (F.col("via") != failed)).select(*known.columns).write.mode("overwrite").parquet(f"{path}/generation-{len(done):06d}")
    return stored_map(spark, path, schema)


def _entry(path: int, via: str):
    return lambda n: F.struct(F.lit(path).alias("path"), F.lit(via).alias("via"), n.alias("name"))


def name_index(rows: DataFrame, key: str, ordinal: str, paths: dict[str, Column]) -> DataFrame:
    """(name, key, via): the first row's name, by whatever path, wins; ``paths`` gives a name or an array of names each."""
    entries = []
    for i, (via, c) in enumerate(paths.items()):
        is_array = rows.select(c.alias("x")).schema["x"].dataType.typeName() == "array"
        names = F.transform(c if is_array else F.array(c), lambda n: T.comparison_name(n))
        entries.append(F.transform(names, _entry(i, via)))
    long = rows.select(F.col(key).alias("key"), F.col(ordinal).alias("ord"), F.posexplode(F.concat(*[F.coalesce(e, F.array()) for e in entries])).alias("pos", "e")).where("e.name <> ''")
    return long.groupBy("e.name").agg(F.min_by(F.struct("key", "e.via"), F.struct("ord", "pos")).alias("m")).select("name", "m.key", "m.via")


def spellings(name: Column) -> Column:
    """A name as it is, without the hybrid sign, with the long rank mark, and both; for comparison."""
    plain = F.regexp_replace(name, r"\s+[x×]\s+", " ")
    ranked = lambda c: F.regexp_replace(c, r"(?<![A-Za-z0-9_])ssp\.", "subsp.")
    return F.transform(F.array(name, plain, ranked(name), ranked(plain)), lambda n: T.comparison_name(n))


def match_spellings(rows: DataFrame, row_key: str, name: str, index: DataFrame) -> DataFrame:
    """(row_key, key, via, spelling): the hit of the first spelling that has one; rows without a hit keep nulls."""
    tries = rows.select(row_key, F.posexplode(spellings(F.coalesce(F.col(name), F.lit("")))).alias("spelling", "name"))
    hits = tries.join(index, "name").groupBy(row_key).agg(F.min_by(F.struct("key", "via", "spelling"), "spelling").alias("m"))
    return rows.select(row_key).join(hits, row_key, "left").select(row_key, "m.key", "m.via", "m.spelling")


def unique_else_first(rows: DataFrame, row_key: str, first: str, second: str, catalogue: DataFrame, c_key: str, c_first: str, c_second: str, ordinal: str) -> DataFrame:
    """(row_key, key, via): by the first name if it has exactly one hit, else the first hit of the second name."""
    one = catalogue.groupBy(F.col(c_first).alias("a")).agg(F.count("*").alias("n"), F.first(c_key).alias("k1")).where("n = 1 AND a IS NOT NULL").drop("n")
    two = catalogue.groupBy(F.col(c_second).alias("b")).agg(F.min_by(c_key, ordinal).alias("k2")).where("b IS NOT NULL")
    joined = rows.join(one, F.col(first) == F.col("a"), "left").join(two, F.col(second) == F.col("b"), "left")
    return joined.select(row_key, F.coalesce("k1", "k2").alias("key"), F.when(F.col("k1").isNotNull(), "unique").when(F.col("k2").isNotNull(), "first").otherwise("none").alias("via"))


def both_ways(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(name, also): the other names of each, both ways, without itself."""
    long = pairs.select(F.col(a).alias("name"), F.col(b).alias("other")).unionByName(pairs.select(F.col(b).alias("name"), F.col(a).alias("other")))
    return long.where("name <> other").groupBy("name").agg(F.sort_array(F.collect_set("other")).alias("also"))


def direct_values(rows: DataFrame, row_key: str, name: str, values: DataFrame, value_name: str, value: str) -> DataFrame:
    """(row_key, value) by binomial, else by the folded binomial."""
    own = T.binomial(name)
    v1, v2 = (values.groupBy(F.col(value_name).alias(f"n{i}")).agg(F.min(value).alias(f"v{i}")) for i in (1, 2))
    return rows.withColumns({"b1": own, "b2": T.fold(own)}).join(v1, F.col("b1") == F.col("n1"), "left").join(v2, F.col("b2") == F.col("n2"), "left").select(row_key, F.coalesce("v1", "v2").alias(value))


def bridge_values(rows: DataFrame, row_key: str, name: str, synonyms: str, values: DataFrame, value_name: str, value: str) -> DataFrame:
    """(row_key, value, n_hits, agreed): the value that all synonyms of two words and the same epithet stem agree on."""
    values = values.select(value_name, value).distinct()  # a name that stands twice with one value is one hit
    syn = rows.select(row_key, T.epithet_stem(T.binomial(name)).alias("stem"), F.explode(synonyms).alias("s")).withColumn("b", T.binomial("s"))
    syn = syn.where((F.size(F.split(T.one_blank("s"), " ")) == 2) & (T.epithet_stem("b") == F.col("stem")))
    hits = syn.join(values.select(F.col(value_name).alias("b"), F.col(value).alias("v")), "b")
    found = hits.groupBy(row_key).agg(F.count("*").alias("n_hits"), F.count_distinct(F.to_json(F.struct("v"))).alias("n_values"), F.first("v").alias("v"))
    return found.select(row_key, F.when(F.col("n_values") == 1, F.col("v")).alias(value), "n_hits", (F.col("n_values") == 1).alias("agreed"))


def consensus(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, n): the value of a group if all its rows have the same, else null."""
    return rows.groupBy(key).agg(F.when(F.count_distinct(value) == 1, F.min(value)).alias(value), F.count("*").alias("n"))


def follow_accepted(rows: DataFrame, key: str, accepted_key: str, fields: list[str]) -> DataFrame:
    """Rows with the fields of the accepted record that they point to; the key they came with stays as ``original``."""
    target = rows.select(F.col(key).alias("__k"), *[F.col(f).alias(f"__{f}") for f in fields]).dropDuplicates(["__k"])
    return rows.select(F.col(key).alias("original"), F.coalesce(accepted_key, key).alias("resolved")).join(target, F.col("resolved") == F.col("__k"), "left").select("original", "resolved", *[F.col(f"__{f}").alias(f) for f in fields])


def wanted_subset(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str, ordinal: str, limit: int | None = None) -> DataFrame:
    """Rows of wanted keys in the list's order."""
    out = rows.join(wanted.groupBy(F.col(wanted_key).alias(key)).agg(F.min(ordinal).alias("wanted_ord")), key).orderBy("wanted_ord")
    return out.limit(limit) if limit else out
