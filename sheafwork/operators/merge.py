"""Merging sources: joins that enrich, ordered unions of names, picks and dedupes. Order is always an explicit ordinal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def grouped_names(rows: DataFrame, target: str, source: str, names: str, ordinal: str) -> DataFrame:
    """(target, names, sources): the name lists of all sources of a target in one, the target's own records first, the last of them foremost."""
    own = F.col(source) == F.col(target).cast("string")
    place = F.struct((~F.coalesce(own, F.lit(False))).alias("other"), F.when(own, -F.col(ordinal)).otherwise(F.col(ordinal)).alias("at"), F.col(names).alias("names"), F.col(source).alias("source"))
    ordered = F.sort_array(F.collect_list(place))
    return rows.groupBy(target).agg(ordered.alias("l")).select(target, F.array_distinct(F.flatten("l.names")).alias("names"), F.array_distinct("l.source").alias("sources"))


def merge_names(catalogue: DataFrame, key: str, first: DataFrame, first_names: str, second: DataFrame, second_names: str) -> DataFrame:
    """The catalogue with both name lists, the primary name and the source it is from; the first source's name wins."""
    a, b = first.select(key, F.col(first_names).alias("names_a")), second.select(key, F.col(second_names).alias("names_b"))
    joined = catalogue.join(a, key, "left").join(b, key, "left")
    head = lambda c: F.get(F.coalesce(F.col(c), F.array().cast("array<string>")), F.lit(0))
    source = F.when(head("names_a").isNotNull(), "a").when(head("names_b").isNotNull(), "b")
    return joined.withColumns({"primary": F.coalesce(head("names_a"), head("names_b")), "name_source": source})


def overlap_statistics(df: DataFrame, a: str, b: str, primary_a: str | None = None, primary_b: str | None = None) -> DataFrame:
    """One row: how many have a value from a, b, both, either, only one, and different primary values."""
    x, y = F.col(a).isNotNull(), F.col(b).isNotNull()
    count = lambda c, n: F.count_if(c).alias(n)
    return df.agg(count(x, "from_a"), count(y, "from_b"), count(x & y, "both"), count(x | y, "either"), count(x & ~y, "only_a"), count(y & ~x, "only_b"), count(x & y & (F.col(primary_a or a) != F.col(primary_b or b)), "differ"))


def star(df: DataFrame, key: str, *dimensions: tuple[DataFrame, str]) -> DataFrame:
    """Left joins of dimensions (table, its key) one after another; each is made unique on its key by whoever built it."""
    for i, (d, k) in enumerate(dimensions):
        df = df.join(d.withColumnRenamed(k, f"__{i}"), F.col(key) == F.col(f"__{i}"), "left").drop(f"__{i}")
    return df


def inherit(children: DataFrame, parent_key: str, parents: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Children with the parent's fields where their own are missing, and whether any was inherited."""
    p = parents.select(F.col(key).alias("__p"), *[F.col(f).alias(f"__{f}") for f in fields])
    joined = children.join(p, F.col(parent_key) == F.col("__p"), "left")
    missing = [F.col(f).isNull() & F.col(f"__{f}").isNotNull() for f in fields]
    any_missing = missing[0]
    for m in missing[1:]:
        any_missing = any_missing | m
    out = joined.withColumn("inherited", any_missing).withColumns({f: F.coalesce(f, f"__{f}") for f in fields})
    return out.drop("__p", *[f"__{f}" for f in fields])


def fallback_source(primary: DataFrame, secondary: DataFrame, key: str) -> DataFrame:
    """The primary rows, and secondary ones of keys that have none, each marked by its source."""
    rest = secondary.join(primary.select(key).distinct(), key, "left_anti")
    return primary.withColumn("source_of", F.lit("primary")).unionByName(rest.withColumn("source_of", F.lit("secondary")))


def beside(df: DataFrame, key: str, values: DataFrame, value_key: str, value: str, other: DataFrame, other_key: str, other_field: str) -> DataFrame:
    """Rows that have a value or an older one: each in its own field, never blended, and which of the two there are."""
    v = values.groupBy(F.col(value_key).alias("__k")).agg(F.min(value).alias("value"))
    o = other.groupBy(F.col(other_key).alias("__o")).agg(F.min(other_field).alias("older"))
    joined = df.join(v, F.col(key) == F.col("__k"), "left").join(o, F.col(key) == F.col("__o"), "left").drop("__k", "__o")
    has = F.when(F.col("value").isNotNull() & F.col("older").isNotNull(), "both").when(F.col("value").isNotNull(), "value").when(F.col("older").isNotNull(), "older")
    return joined.withColumn("has", has).where("has IS NOT NULL")


def enrich_missing(df: DataFrame, key: str, column: str, extra: DataFrame, extra_key: str, extra_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose missing column is filled from another table, and the keys that stay without."""
    e = extra.groupBy(F.col(extra_key).alias("__k")).agg(F.min(extra_column).alias("__v"))
    out = df.join(e, F.col(key) == F.col("__k"), "left").withColumn(column, F.coalesce(column, "__v")).drop("__k", "__v")
    return out, out.where(F.col(column).isNull()).select(key)


def lookup_slice(df: DataFrame, key: str, rows: DataFrame, row_key: str, order: list[Column | str], fields: list[str], n: int = 10) -> DataFrame:
    """Each row with the number of its related rows and the first ``n`` of them. Counts are partial sums, and only the first rows move."""
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy(row_key).orderBy(*order))).where(F.col("nth") <= n)
    lists = first.groupBy(F.col(row_key).alias("__k")).agg(F.sort_array(F.collect_list(F.struct("nth", *fields))).alias("related"))
    counts = rows.groupBy(F.col(row_key).alias("__c")).agg(F.count("*").alias("n_related"))
    joined = df.join(lists, F.col(key) == F.col("__k"), "left").join(counts, F.col(key) == F.col("__c"), "left").drop("__k", "__c")
    return joined.withColumn("n_related", F.coalesce("n_related", F.lit(0)))


def coverage(names: DataFrame, name: str, catalogue: DataFrame, catalogue_name: str) -> tuple[DataFrame, DataFrame]:
    """Names with whether the catalogue has them, and one row of (n, found, missing, share)."""
    known = catalogue.select(F.col(catalogue_name).alias("__n")).distinct()
    rows = names.join(known, F.col(name) == F.col("__n"), "left").withColumn("found", F.col("__n").isNotNull()).drop("__n")
    return rows, rows.agg(F.count("*").alias("n"), F.count_if("found").alias("found"), F.count_if(~F.col("found")).alias("missing"), F.round(100 * F.avg(F.col("found").cast("int")), 1).alias("share"))


# Dedupes and picks


def _filled(column: str) -> Column:
    return F.when(F.trim(F.col(column).cast("string")) != "", F.col(column))


def dedupe_fill(rows: DataFrame, key: str, ordinal: str, fields: list[str], flags: list[str] = []) -> DataFrame:  # noqa: B006
    """One row a key: each field is the first filled in order; flags hold if any row's does."""
    out = [F.min_by(_filled(f), F.when(_filled(f).isNotNull(), F.col(ordinal))).alias(f) for f in fields]
    return rows.groupBy(key).agg(F.min(ordinal).alias(ordinal), *out, *[F.bool_or(f).alias(f) for f in flags])


def first_rows(rows: DataFrame, key: Column | str, order: list[Column | str]) -> DataFrame:
    """The first row of each key, and how many rows it stood for. Counts are partial sums, and only the first rows move.

    A key that keeps what others drop tells rows apart that look alike: see ``functions.text.bracket_key``.
    """
    keyed = rows.withColumn("__key", F.col(key) if isinstance(key, str) else key)
    first = keyed.withColumn("nth", F.row_number().over(Window.partitionBy("__key").orderBy(*order))).where("nth = 1").drop("nth")
    counts = keyed.groupBy(F.col("__key").alias("__c")).agg(F.count("*").alias("n_rows"))
    return first.join(counts, F.col("__key").eqNullSafe(F.col("__c"))).drop("__key", "__c")


def merge_entities(rows: DataFrame, entity: str, ordinal: str, direct: Column, name: str, fill: list[str]) -> DataFrame:
    """One row an entity: a direct match survives, else the first; the others' names go to ``also``; rows without an entity stay."""
    marked = rows.withColumn("__o", F.struct((~F.coalesce(direct, F.lit(False))).alias("indirect"), F.col(ordinal).alias("ord")))
    merged = marked.where(F.col(entity).isNotNull()).groupBy(entity).agg(
        F.min(ordinal).alias(ordinal), F.min_by(name, "__o").alias(name), F.sort_array(F.collect_set(name)).alias("__all"),
        *[F.min_by(_filled(f), F.when(_filled(f).isNotNull(), F.col("__o"))).alias(f) for f in fill],
    )
    merged = merged.withColumn("also", F.array_except("__all", F.array(name))).drop("__all")
    alone = rows.where(F.col(entity).isNull()).select(entity, ordinal, name, *fill).withColumn("also", F.array().cast("array<string>"))
    return merged.select(alone.columns).unionByName(alone)


def group_entities(rows: DataFrame, entity: str, name: str, other: str, also: str, ordinal: str) -> DataFrame:
    """Rows of all lists by entity, or by name where there is none: distinct names in order and the union of synonyms."""
    key = F.coalesce(F.col(entity).cast("string"), F.concat(F.lit("name:"), F.lower(name)))
    lists = F.sort_array(F.collect_list(F.struct(ordinal, name, other, also)))
    return rows.groupBy(key.alias("group_key")).agg(lists.alias("l")).select("group_key", F.array_distinct(F.transform("l", lambda x: F.struct(x[name], x[other]))).alias("names"), F.sort_array(F.array_distinct(F.flatten(f"l.{also}"))).alias("also"), F.size("l").alias("n"))


def preferred_pick(rows: DataFrame, key: str, value: str, preferred: Column, ordinal: str) -> DataFrame:
    """(key, value): a preferred value, else the shortest; the first of equals."""
    return rows.groupBy(key).agg(F.min_by(value, F.struct((~F.coalesce(preferred, F.lit(False))).alias("p"), F.length(value).alias("l"), F.col(ordinal).alias("o"))).alias(value))


def suffix_pick(rows: DataFrame, key: str, value: str, suffix: str, ordinal: str) -> DataFrame:
    return preferred_pick(rows, key, value, F.col(value).endswith(suffix), ordinal)


def single_parent(rows: DataFrame, child: str, parent: str, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Children of exactly one parent that also meet a condition, and the others with the reason."""
    kids = rows.groupBy(child).agg(F.count_distinct(parent).alias("n_parents"), F.min(parent).alias(parent), F.bool_or(ok).alias("ok"))
    reason = F.when(F.col("n_parents") == 0, "no parent").when(F.col("n_parents") > 1, "several parents").when(~F.coalesce("ok", F.lit(False)), "condition")
    marked = kids.withColumn("reason", reason)
    return marked.where("reason IS NULL").select(child, parent), marked.where("reason IS NOT NULL").select(child, "n_parents", "reason")


def priority_values(rows: DataFrame, key: str, value: str, priority: str, position: str) -> DataFrame:
    """(key, values): values of all sources in order of trust, each once whatever its case, with its source's priority."""
    order = Window.partitionBy(key, F.lower(value)).orderBy(priority, position)
    once = rows.where(F.col(value).isNotNull()).withColumn("nth", F.row_number().over(order)).where("nth = 1")
    return once.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(priority, position, value))).alias("l")).select(key, F.transform("l", lambda x: F.struct(x[value].alias("value"), x[priority].alias("priority"))).alias("values"))


def ranked_union(*lists: Column) -> Column:
    """Usable names of several lists, in order, each once; the first is the primary one."""
    return F.array_distinct(F.filter(F.transform(F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in lists]), lambda n: F.trim(n)), T.usable_name))


def synonym_union(declared: Column, names: Column, canonical: Column) -> Column:
    """Declared synonyms, then source names that differ from the canonical one."""
    return F.array_distinct(F.concat(declared, F.filter(names, lambda n: T.squash(n) != T.squash(canonical))))


def append_lists(rows: DataFrame, key: str, values: str, ordinal: str) -> DataFrame:
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(ordinal, values))).alias("l")).select(key, F.flatten(f"l.{values}").alias(values))


def first_acceptable(*choices: tuple[Column, Column, str]) -> Column:
    """(value, source) of the first (value, condition, source) whose condition holds."""
    return F.coalesce(*[F.when(ok, F.struct(v.alias("value"), F.lit(s).alias("source"))) for v, ok, s in choices])


# Counts


def facet_counts(rows: DataFrame, key: str, facet: str) -> DataFrame:
    """(key, total, by_facet): counts in all and by facet."""
    n = rows.groupBy(key, F.coalesce(facet, F.lit("unknown")).alias("facet")).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.sum("n").alias("total"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("facet", "n")))).alias("by_facet"))


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def facet_matrix(rows: DataFrame, key: str, facet: str, facets: list[str]) -> DataFrame:
    """Counts by key and facet as columns, others in ``other``, with row totals and a row of column totals."""
    known = F.when(F.col(facet).isin(facets), F.col(facet)).otherwise("other")
    names = [*facets, "other"]
    wide = rows.groupBy(F.col(key).cast("string").alias(key)).agg(*[F.count_if(known == n).alias(n) for n in names], F.count("*").alias("total"))
    sums = wide.agg(*[F.sum(n).alias(n) for n in [*names, "total"]]).select(F.lit("TOTAL").alias(key), *names, "total")
    return wide.unionByName(sums)


def reconcile(rows: DataFrame, key: str, reported: DataFrame, count: str) -> DataFrame:
    """One row: distinct keys that arrived, the number reported, and the difference."""
    arrived = rows.agg(F.count_distinct(key).alias("arrived"), F.count("*").alias("n_rows")).withColumn("__j", F.lit(1))
    told = reported.agg(F.sum(count).alias("reported")).withColumn("__j", F.lit(1))
    return arrived.join(told, "__j").drop("__j").withColumn("difference", F.col("reported") - F.col("arrived")).withColumn("repeated", F.col("n_rows") - F.col("arrived"))
