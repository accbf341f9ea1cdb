"""Windows over groups and lines, and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import anchored


def top_per_facet(rows: DataFrame, key: str, facet: str, order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each key and facet; a missing facet is one of its own."""
    w = Window.partitionBy(key, F.coalesce(facet, F.lit("unknown"))).orderBy(*order)
    return rows.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n)


def cap_statistics(rows: DataFrame, key: str, facet: str, n: int) -> DataFrame:
    """One row of what ``top_per_facet`` would keep, from the groups' counts alone."""
    groups = rows.groupBy(key, facet).agg(F.count("*").alias("m"))
    kept = F.least("m", F.lit(n))
    return groups.agg(F.sum("m").alias("n_read"), F.sum(kept).alias("n_kept"), F.round(100 * F.sum(kept) / F.sum("m"), 1).alias("share"), F.count("*").alias("n_groups"), F.count_if(F.col("m") > n).alias("n_capped"))


def two_level_quota(rows: DataFrame, key: str, tag: str, url: str, ordinal: str, limits: DataFrame, limit_tag: str, limit: str, total: int) -> DataFrame:
    """The first rows of each tag up to its limit, then the first ``total`` of each key; an address counts once."""
    once = rows.withColumn("__u", F.row_number().over(Window.partitionBy(key, url).orderBy(ordinal))).where("__u = 1").drop("__u")
    tagged = once.join(limits.select(F.col(limit_tag).alias("__t"), F.col(limit).alias("__l")), F.col(tag) == F.col("__t"))
    within = tagged.withColumn("__n", F.row_number().over(Window.partitionBy(key, tag).orderBy(ordinal))).where("__n <= __l")
    return within.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(ordinal))).where(F.col("nth") <= total).drop("__t", "__l", "__n")


def block_sort(rows: DataFrame, group: str, block: str, head: Column, flag: Column, weight: str, name: str) -> DataFrame:
    """Adds ``sort_index`` from 0 within the group: flagged blocks first, then by their largest weight; in a block the head, then by weight and name."""
    b = Window.partitionBy(group, block)
    marked = rows.withColumns({"__f": F.max(F.coalesce(flag, F.lit(False))).over(b), "__w": F.max(F.greatest(F.coalesce(weight, F.lit(0)), F.lit(0))).over(b), "__h": F.coalesce(head, F.lit(False))})
    order = Window.partitionBy(group).orderBy(F.desc("__f"), F.desc("__w"), block, F.desc("__h"), F.desc(F.coalesce(weight, F.lit(0))), name)
    return marked.withColumn("sort_index", F.row_number().over(order) - 1).drop("__f", "__w", "__h")


def segment_records(lines: DataFrame, doc: str, line: str, text: str, starts: Column) -> DataFrame:
    """Lines from one start to the next as one record: (doc, record, text); lines before the first start are record 0."""
    w = Window.partitionBy(doc).orderBy(line)
    numbered = lines.withColumn("record", F.sum(F.when(starts, 1).otherwise(0)).over(w))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(line, text))), lambda x: x[text]), " ")
    return numbered.groupBy(doc, "record").agg(joined.alias("text"), F.count("*").alias("n_lines"))


def fill_heading(lines: DataFrame, doc: str, line: str, heading: Column, alias: str = "heading") -> DataFrame:
    """The last heading at or before each line."""
    w = Window.partitionBy(doc).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(alias, F.last(heading, ignorenulls=True).over(w))


def neighbour_records(lines: DataFrame, doc: str, line: str, text: str, marker: Column, skip: Column) -> DataFrame:
    """(doc, line, before, after) for each marker line: the text before, past lines to skip, and the text behind."""
    kept = lines.where(~F.coalesce(skip, F.lit(False)) | F.coalesce(marker, F.lit(False)))
    w = Window.partitionBy(doc).orderBy(line)
    return kept.withColumns({"__m": F.coalesce(marker, F.lit(False)), "before": F.lag(text).over(w), "after": F.lead(text).over(w)}).where("__m").select(doc, line, "before", "after")


def cluster_rows(words: DataFrame, page: list[str], y: str, x: str, word: str, tolerance: float) -> DataFrame:
    """Words of a page in rows: a word belongs to the row whose first word it is within ``tolerance`` of. (page, row, text).

    Where a row begins depends on the row before; see ``anchored``. Words without a height belong to no row.
    """
    rows = words.select(*page, F.col(y).cast("double").alias("__y"), F.col(x).cast("double").alias("__x"), F.col(word).cast("string").alias("__t")).where("__y IS NOT NULL")
    placed = anchored(rows, page, "__y", lambda c: c + F.lit(float(tolerance)), ["__x"], inclusive=True).withColumn("row", F.col("window").cast("int"))
    return placed.groupBy(*page, "row").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__x", "__t"))), lambda v: v["__t"]), " ").alias("text"))


def assign_columns(words: DataFrame, doc: list[str], order: str, x: str, edges: Column, slack: float = 3) -> DataFrame:
    """Adds ``column``: the number of the last edge at or left of a word, by the edges of the last header before it."""
    w = Window.partitionBy(*doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = words.withColumn("__e", F.last(edges, ignorenulls=True).over(w))
    return filled.withColumn("column", F.size(F.filter("__e", lambda e: e <= F.col(x) + slack)) - 1).drop("__e")


def merge_continuations(rows: DataFrame, doc: str, order: str, numbered: Column, cells: list[str]) -> DataFrame:
    """Rows without a number are joined to the one before, cell by cell; a hyphen at a cell's end takes no blank."""
    record = F.sum(F.when(numbered, 1).otherwise(0)).over(Window.partitionBy(doc).orderBy(order))
    whole = lambda c: F.regexp_replace(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), F.col(c).alias("cell")))), lambda e: e["cell"]), " "), r"(?<=\w)- ", "-")
    return rows.withColumn("record", record).groupBy(doc, "record").agg(*[whole(c).alias(c) for c in cells])


def order_breaks(rows: DataFrame, group: str, order: str, name: str, matched: Column) -> DataFrame:
    """(group, n_unsorted, n_matched_late): names that stand before a smaller one's place, matched rows behind unmatched ones."""
    w = Window.partitionBy(group).orderBy(order)
    marked = rows.withColumns({"__m": matched.cast("int")}).withColumns({"__n": F.lag(name).over(w), "__p": F.lag("__m").over(w)})
    return marked.groupBy(group).agg(F.count_if((F.col("__n") > F.col(name)) & (F.col("__p") == F.col("__m"))).alias("n_unsorted"), F.count_if((F.col("__p") == 0) & (F.col("__m") == 1)).alias("n_matched_late"))


# Orders


def top_k(rows: DataFrame, order: list[Column | str], k: int | None = None) -> DataFrame:
    out = rows.orderBy(*order)
    return out.limit(k) if k else out


def matched_first(rows: DataFrame, matched: str, name: str) -> DataFrame:
    return rows.orderBy(F.col(matched).isNull(), F.collate(name, "de"), name)


def category_order(rows: DataFrame, category: str, categories: list[str], *then: str) -> DataFrame:
    """Rows by a given order of categories; another category is an error."""
    place = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col(category))
    sure = F.when(place > 0, place).otherwise(F.raise_error(F.concat(F.lit("unknown category: "), F.coalesce(category, F.lit("null")))).cast("bigint"))
    return rows.withColumn("category_rank", sure).orderBy("category_rank", *then)


def page(rows: DataFrame, order: list[Column | str], number: int, size: int) -> DataFrame:
    return rows.orderBy(*order).offset(number * size).limit(size)


def page_statistics(rows: DataFrame, number: int, size: int) -> DataFrame:
    """One row: rows in all, pages, and the first and last row's number on this page (0 where it is empty)."""
    counted = rows.agg(F.count("*").alias("n_rows"))
    first = F.when(F.col("n_rows") > number * size, number * size + 1).otherwise(0)
    last = F.when(first > 0, F.least(F.col("n_rows"), F.lit((number + 1) * size))).otherwise(0)
    return counted.select("n_rows", F.ceil(F.col("n_rows") / size).alias("n_pages"), first.cast("long").alias("first"), last.cast("long").alias("last"))


def seeded_sample(rows: DataFrame, group: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows of each group that has as many, by a hash of the key and a seed. Only the rows that may be taken move."""
    order = Window.partitionBy(group).orderBy(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))), key)
    first = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n)
    large = first.where(F.col("nth") == n).select(F.col(group).alias("__g"))
    return first.join(large, F.col(group).eqNullSafe(F.col("__g")), "left_semi")


def batches(rows: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """Adds ``batch``: rows of a group in batches of one size."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1) / size).cast("int"))


def within_budget(rows: DataFrame, group: str, order: list[Column | str], cost: str, budget: float) -> DataFrame:
    """The first rows of each group whose costs together fit the budget."""
    running = F.sum(cost).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("running", running).where(F.col("running") <= budget)
