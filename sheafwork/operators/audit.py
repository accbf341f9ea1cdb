"""Set operations, audits and data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def delta(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose keys ``old`` lacks."""
    return new.join(old.select(*keys).distinct(), keys, "left_anti")


def missing_required(rows: DataFrame, column: str, required: list[str]) -> DataFrame:
    """Required values that no row has."""
    wanted = rows.sparkSession.createDataFrame([(r,) for r in required], f"`{column}` string")
    return wanted.join(rows.select(column).distinct(), column, "left_anti")


def orphans(rows: DataFrame, key: str, catalogue: DataFrame, catalogue_key: str) -> DataFrame:
    """Rows whose key the catalogue lacks; rows without a key are none."""
    return rows.where(F.col(key).isNotNull()).join(catalogue.select(F.col(catalogue_key).alias(key)).distinct(), key, "left_anti")


def require_none(df: DataFrame, what: str) -> DataFrame:
    """The empty table, or an error that tells how many rows there are and one of them."""
    first = df.first()
    if first is not None:
        raise ValueError(f"{what}: {df.count()} rows, such as {first.asDict()}")
    return df


def mutual(a: DataFrame, a_key: str, b: DataFrame, b_key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of each side that have a partner on the other."""
    keys_a, keys_b = a.select(F.col(a_key).alias("__k")), b.select(F.col(b_key).alias("__k"))
    return a.join(keys_b, F.col(a_key) == F.col("__k"), "left_semi"), b.join(keys_a, F.col(b_key) == F.col("__k"), "left_semi")


def rows_of_facet(rows: DataFrame, key: str, facets: DataFrame, facet_key: str, wanted: Column) -> DataFrame:
    """Rows whose key occurs with a wanted facet."""
    return rows.join(facets.where(wanted).select(F.col(facet_key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_semi")


def missing_by(rows: DataFrame, present: Column, group: str) -> DataFrame:
    """(group, n, n_missing, share_missing)."""
    gone = ~F.coalesce(present, F.lit(False))
    return rows.groupBy(group).agg(F.count("*").alias("n"), F.count_if(gone).alias("n_missing"), F.round(100 * F.avg(gone.cast("int")), 1).alias("share_missing"))


def expected_versus_arrived(expected: DataFrame, arrived: DataFrame, key: str, excused: Column) -> tuple[DataFrame, DataFrame]:
    """Expected keys that didn't arrive with the reason, and one row of totals. ``excused`` is about the expected rows."""
    want = expected.groupBy(key).agg(F.count("*").alias("n"), F.bool_or(~F.coalesce(excused, F.lit(False))).alias("due"))
    gaps = want.join(arrived.select(key).distinct().withColumn("__a", F.lit(True)), key, "left")
    reason = F.when(F.col("__a").isNotNull(), "arrived").when(F.col("due"), "missing").otherwise("excused")
    marked = gaps.withColumn("reason", reason).drop("__a", "due")
    return marked.where("reason <> 'arrived'"), marked.groupBy("reason").agg(F.count("*").alias("n_keys"), F.sum("n").alias("n_rows"))


def largest_gaps(gaps: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The keys that miss most rows, of ``expected_versus_arrived``."""
    return gaps.where("reason = 'missing'").orderBy(F.desc("n"), key).limit(n)


def override(auto: DataFrame, manual: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Manual rows replace or add by key: the fields, and whether a row is kept, adjusted or added."""
    a, m = auto.select(key, *[F.col(f).alias(f"a_{f}") for f in fields], F.lit(True).alias("__a")), manual.select(key, *[F.col(f).alias(f"m_{f}") for f in fields], F.lit(True).alias("__m"))
    joined = a.join(m, key, "full_outer")
    state = F.when(F.col("__m").isNull(), "kept").when(F.col("__a").isNull(), "added").otherwise("adjusted")
    return joined.select(key, *[F.coalesce(f"m_{f}", f"a_{f}").alias(f) for f in fields], state.alias("state"))


def override_report(manual: DataFrame, auto: DataFrame, key: str, required: list[str]) -> DataFrame:
    """(rule, n): keys given twice, rows without a required field, keys that the catalogue lacks; rows that adjust it, keys they add, keys whose rows conflict."""
    twice = manual.groupBy(key).count().where("count > 1")
    empty = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in required])
    parts = [("repeated key", twice), ("missing field", manual.where(empty)), ("unknown key", manual.join(auto.select(key).distinct(), key, "left_anti"))]
    have = auto.groupBy(key).agg(*[F.min(f).alias(f"__{f}") for f in required])
    differ = reduce(lambda a, b: a | b, [(F.col(f) != F.col(f"__{f}")) for f in required])
    parts += [("adjusted", manual.join(have, key).where(F.coalesce(differ, F.lit(False)))), ("added", manual.where(F.col(key).isNotNull()).join(have, key, "left_anti").select(key).distinct())]
    apart = reduce(lambda a, b: a | b, [F.col(f"__n_{f}") > 1 for f in required])
    parts.append(("conflicting", manual.groupBy(key).agg(*[F.count_distinct(f).alias(f"__n_{f}") for f in required]).where(apart)))
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n") for rule, df in parts])


def combined_sources(sources: dict[str, DataFrame], allowed: dict[str, Column], url: str, columns: list[str]) -> DataFrame:
    """Rows of several sources by each one's own filter, with where they are from; an address once, from the first source that has
    it, there the smallest row."""
    rows = reduce(DataFrame.unionByName, [df.where(allowed[name]).select(*columns).withColumns({"provenance": F.lit(name), "__p": F.lit(i)}) for i, (name, df) in enumerate(sources.items())])
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(url).orderBy("__p", *columns))).where("__n = 1").drop("__n", "__p")


def rule_report(rows: DataFrame, group: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """(group, severity, rule, n) for rules that rows break; one pass over the rows."""
    counts = rows.groupBy(group).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, (_, c) in rules.items()])
    long = F.explode(F.array(*[F.struct(F.lit(severity).alias("severity"), F.lit(name).alias("rule"), F.col(name).alias("n")) for name, (severity, _) in rules.items()]))
    return counts.select(group, long.alias("r")).select(group, "r.*").where("n > 0")


def list_report(lists: DataFrame, entries: DataFrame, states: DataFrame, list_id: str, required: list[str], state_list: str, state: str, entry_list: str, name: str, label: str, key: str, ordinal: str, file: str | None = None, files: DataFrame | None = None) -> DataFrame:
    """(list, severity, rule, n): what is wrong with lists and their entries, and the share of entries with a key in percent.

    Lists: a required field that is missing, a scope of states without any, a state that isn't known, no entries at all; and where
    ``files`` (file) says which files there are, a ``file`` that isn't among them.
    Entries: no name, no label, and matched ones behind unmatched ones or either out of their names' order.
    """
    own = lists.select(F.col(list_id).alias("list"), *[F.col(c) for c in dict.fromkeys([*required, state_list]) if c != list_id])
    missing = [F.when(F.coalesce(F.trim(F.col("list" if c == list_id else c).cast("string")), F.lit("")) == "", F.struct(F.lit("error").alias("severity"), F.lit(f"no {c}").alias("rule"))) for c in required]
    empty = F.when(F.size(state_list) == 0, F.struct(F.lit("error").alias("severity"), F.lit("no states in scope").alias("rule")))
    fields = own.select("list", F.explode(F.filter(F.array(*missing, empty), lambda r: r.isNotNull())).alias("r")).select("list", "r.*")
    unknown = own.select("list", F.explode(state_list).alias("__s")).join(states.select(F.col(state).alias("__s")).distinct(), "__s", "left_anti").select("list", F.lit("warning").alias("severity"), F.lit("unknown state").alias("rule"))
    none = own.select("list").join(entries.select(F.col(entry_list).alias("list")).distinct(), "list", "left_anti").select("list", F.lit("error").alias("severity"), F.lit("no entries").alias("rule"))
    absent = []
    if file is not None and files is not None:
        there = files.select(F.col("file").alias("__f")).distinct()
        gone = lists.select(F.col(list_id).alias("list"), F.col(file).alias("__f")).join(there, "__f", "left_anti")
        absent = [gone.select("list", F.lit("error").alias("severity"), F.lit("file not found").alias("rule"))]
    counted = reduce(DataFrame.unionByName, [fields, unknown, none, *absent]).groupBy("list", "severity", "rule").agg(F.count("*").alias("n"))

    matched = F.col(key).isNotNull()
    at = Window.partitionBy(entry_list).orderBy(ordinal)
    same = Window.partitionBy(entry_list, matched).orderBy(ordinal)
    marked = entries.withColumns({"__late": matched & F.coalesce(~F.lag(matched).over(at), F.lit(False)), "__low": F.coalesce(F.col(name) < F.lag(name).over(same), F.lit(False))})
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    rules = {"no name": ("error", blank(name)), "no label": ("warning", blank(label)), "not in order": ("warning", F.col("__late") | F.col("__low"))}
    broken = rule_report(marked.withColumnRenamed(entry_list, "list"), "list", rules)
    share = entries.groupBy(F.col(entry_list).alias("list")).agg(F.round(100 * F.avg(matched.cast("int"))).cast("long").alias("n")).select("list", F.lit("info").alias("severity"), F.lit("percent matched").alias("rule"), "n")
    return reduce(DataFrame.unionByName, [counted, broken, share])


def resolution_report(rows: DataFrame, group: str, resolved: Column, path: str) -> DataFrame:
    """(group, path, n, n_resolved, share) by group and path, with totals of groups and of all."""
    out = rows.rollup(group, path).agg(F.count("*").alias("n"), F.count_if(resolved).alias("n_resolved"), F.grouping_id().alias("level"))
    return out.withColumn("share", F.round(100 * F.col("n_resolved") / F.col("n"), 1))


def unsearchable(rows: DataFrame, key: str, alias: str, terms: DataFrame, terms_key: str, term: str) -> DataFrame:
    """Aliases of which no search variant is contained in a term of their own record."""
    from ..functions.text import search_variants

    variants = rows.where(F.col(alias).isNotNull()).select(key, alias, F.explode(search_variants(alias, gaps=False)).alias("__v"))
    own = terms.select(F.col(terms_key).alias("__k"), F.col(term).alias("__t"))
    found = variants.join(own, F.col(key) == F.col("__k")).where(F.col("__t").contains(F.col("__v"))).select(key, alias).distinct()
    return variants.select(key, alias).distinct().join(found, [key, alias], "left_anti")


def before_and_after(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """One row: keys gained, lost, kept, and the net change."""
    a, b = before.select(key).distinct().withColumn("__a", F.lit(1)), after.select(key).distinct().withColumn("__b", F.lit(1))
    j = a.join(b, key, "full_outer")
    return j.agg(F.count_if(F.col("__a").isNull()).alias("gained"), F.count_if(F.col("__b").isNull()).alias("lost"), F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("kept")).withColumn("net", F.col("gained") - F.col("lost"))


def sweep(target: DataFrame, run: str, current: str, n_written: DataFrame, count: str, least: float = 0.7) -> DataFrame:
    """The target without rows of other runs, but only if this run's rows are at least a share of what it wrote."""
    mine = target.agg(F.count_if(F.col(run) == current).alias("n")).withColumn("__j", F.lit(1))
    told = n_written.agg(F.sum(count).alias("w")).withColumn("__j", F.lit(1))
    safe = mine.join(told, "__j").select(((F.col("w") > 0) & (F.col("n") >= least * F.col("w"))).alias("safe"), F.lit(1).alias("__j"))
    return target.withColumn("__j", F.lit(1)).join(F.broadcast(safe), "__j").where(~F.coalesce("safe", F.lit(False)) | (F.col(run) == current)).drop("__j", "safe")  # one row


def prune_classes(rows: DataFrame, key: str, current: DataFrame, current_key: str, renamed: DataFrame, old: str, new: str, used: DataFrame, used_key: str) -> DataFrame:
    """(key, action, moved_to) for rows that the catalogue no longer has: move if renamed, deactivate if used, else delete."""
    gone = rows.join(current.select(F.col(current_key).alias("__c")).distinct(), F.col(key) == F.col("__c"), "left_anti")
    ren = renamed.groupBy(F.col(old).alias("__o")).agg(F.min(new).alias("moved_to"))
    use = used.select(F.col(used_key).alias("__u")).distinct()
    j = gone.join(ren, F.col(key) == F.col("__o"), "left").join(use, F.col(key) == F.col("__u"), "left")
    return j.select(key, F.when(F.col("moved_to").isNotNull(), "move").when(F.col("__u").isNotNull(), "deactivate").otherwise("delete").alias("action"), "moved_to")


def category_counts(rows: DataFrame, category: str, key: str, name: str) -> DataFrame:
    """(category, n, n_blank): keys once each, and those without a name."""
    once = rows.groupBy(category, key).agg(F.max(name).alias("__n"))
    return once.groupBy(category).agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.trim("__n"), F.lit("")) == "").alias("n_blank"))
