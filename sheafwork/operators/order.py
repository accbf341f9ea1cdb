"""Whole orders: numbers, batches, running sums and budgets over a table in one order, without a task that sees it all.

A first pass sorts by ranges and writes the rows with their place inside a range; a second adds what the ranges before hold
together, which is one row for each range. Rows that are equal in the order stand in any order among themselves; a random
last key lets ranges cut through them, so a key that many rows share doesn't end up in one task.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written

_INDEX = 33  # bits that monotonically_increasing_id keeps for a row's place in its partition
#: Rows that one window adds up, where places are known.
BLOCK = 1 << 16
#: Rows of a key that may be folded as one array.
SMALL = 4096


def _ranged(rows: DataFrame, order: list[Column | str], carried: dict[str, Column]) -> DataFrame:
    """The rows as a written table with ``__range``, ``__at`` (place inside it) and what is carried."""
    keys = [*order, F.rand(0)]
    placed = rows.withColumns(carried) if carried else rows
    placed = placed.repartitionByRange(*keys).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = placed.withColumns({"__range": F.shiftright("__at", _INDEX).cast("int"), "__at": F.col("__at").bitwiseAND((1 << _INDEX) - 1)})
    return written(placed, "ranges")


def _before(ranged: DataFrame, sums: list[str]) -> DataFrame:
    """(__range, __n, one column for each sum): what the ranges before each hold together. One row for each range comes to the driver."""
    held = ranged.groupBy("__range").agg(F.count("*").alias("__n"), *[F.sum(s).alias(s) for s in sums])
    schema, rows = held.schema, sorted(held.collect(), key=lambda r: r["__range"])
    out, total = [], [0, *[None] * len(sums)]
    for r in rows:
        out.append((r["__range"], *total))
        total = [a if b is None else b if a is None else a + b for a, b in zip(total, r[1:])]
    return ranged.sparkSession.createDataFrame(out, schema)


def numbered(rows: DataFrame, order: list[Column | str], alias: str = "place") -> DataFrame:
    """Adds each row's place, from 0, in the order of the whole table."""
    ranged = _ranged(rows, order, {})
    return ranged.join(F.broadcast(_before(ranged, [])), "__range").withColumn(alias, F.col("__n") + F.col("__at")).drop("__range", "__at", "__n")


def running_sums(rows: DataFrame, order: list[Column | str], sums: dict[str, Column | str], alias: str = "place") -> DataFrame:
    """Adds the place and, under each name of ``sums``, the sum of that column up to and with the row; null where none had a value yet."""
    carried = {f"__s{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(sums.values())}
    ranged = _ranged(rows, order, carried)
    w = Window.partitionBy("__range").orderBy("__at")
    inside = ranged.withColumns({f"__i{i}": F.sum(s).over(w) for i, s in enumerate(carried)}).drop(*carried)
    both = inside.join(F.broadcast(_before(ranged, list(carried))), "__range")
    added = {name: F.when(F.col(f"__i{i}").isNull(), F.col(s)).otherwise(F.col(f"__i{i}") + F.coalesce(F.col(s), F.lit(0))) for i, (name, s) in enumerate(zip(sums, carried))}
    return both.withColumns({alias: F.col("__n") + F.col("__at"), **added}).drop("__range", "__at", "__n", *carried, *[f"__i{i}" for i in range(len(sums))])


def running_at(rows: DataFrame, place: str, sums: dict[str, Column]) -> DataFrame:
    """Adds running sums along a known place (dense, from 0): inside blocks of places, then over the blocks before, by the same rule."""
    marked = rows.withColumns({**sums, "__b": F.floor(F.col(place) / BLOCK)})
    inside = marked.withColumns({c: F.sum(c).over(Window.partitionBy("__b").orderBy(place)) for c in sums})
    held = written(marked.groupBy(F.col("__b").alias("__p")).agg(*[F.sum(c).alias(c) for c in sums]), "blocks")
    if held.where("__p > 0").isEmpty():
        return inside.drop("__b")
    before = running_at(held, "__p", {c: F.col(c) for c in sums}).select((F.col("__p") + 1).alias("__b"), *[F.col(c).alias(f"__s_{c}") for c in sums])
    both = inside.join(before, "__b", "left")
    return both.withColumns({c: F.col(c) + F.coalesce(f"__s_{c}", F.lit(0)) for c in sums}).drop("__b", *[f"__s_{c}" for c in sums])


def count_before(events: DataFrame, probes: DataFrame, key: list[str], at: str, inclusive: bool) -> DataFrame:
    """The probes with ``before``: how many events stand before each in the order of key and ``at``, those of smaller keys too.

    Events at a probe's own value count if ``inclusive``. Both sides are sorted together and counted by prefix sums, so no
    range join meets all events of a key.
    """
    kinds = (0, 1) if inclusive else (1, 0)
    e = events.select(*key, at, F.lit(kinds[0]).alias("__kind"))
    p = probes.withColumn("__kind", F.lit(kinds[1]))
    both = e.unionByName(p, allowMissingColumns=True)
    counted = running_sums(both, [*map(F.col, key), F.col(at), F.col("__kind")], {"before": (F.col("__kind") == kinds[0]).cast("long")}, "__place")
    return counted.where(F.col("__kind") == kinds[1]).drop("__kind", "__place")


def anchored(rows: DataFrame, key: list[str], at: str, reach: Callable[[Column], Column], ties: list[str], inclusive: bool, sums: dict[str, Column] | None = None) -> DataFrame:
    """Windows that begin at a first row: the first of a key begins one, and so does the first behind the reach of the one before.

    Adds ``window`` (from 0 in its key), ``window_at`` (``at`` of its first row) and running sums inside the window, in the order
    of ``at`` and ties. A row at the very end of a reach still belongs to the window if ``inclusive``. ``at`` has no nulls; a
    null key is a key of its own.

    Keys of up to ``SMALL`` rows are folded as arrays. Those of more have their windows found by doubling: no task holds them.
    """
    sums = sums or {}
    placed = rows.withColumns({f"__v{i}": c for i, c in enumerate(sums.values())})
    counts = written(placed.groupBy(*[F.col(c).alias(f"__{c}") for c in key]).agg(F.count("*").alias("__n")).where(F.col("__n") > SMALL), "large-keys")
    if counts.isEmpty():
        return _folded(placed, key, at, reach, ties, inclusive, sums)
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key])
    small = _folded(placed.join(counts, same, "left_anti"), key, at, reach, ties, inclusive, sums)
    large = _doubled(placed.join(counts, same, "left_semi"), key, at, reach, ties, inclusive, sums)
    return small.unionByName(large)


def _folded(rows: DataFrame, key: list[str], at: str, reach: Callable[[Column], Column], ties: list[str], inclusive: bool, sums: dict[str, Column]) -> DataFrame:
    names = [at, *[c for c in ties if c != at]]
    names += [c for c in rows.columns if c not in [*names, *key]]
    grouped = rows.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(*names))).alias("__rows"))
    behind = (lambda x, last: x > reach(last)) if inclusive else (lambda x, last: x >= reach(last))
    none = F.array().cast(f"array<{rows.schema[at].dataType.simpleString()}>")
    begins = F.aggregate("__rows", none, lambda acc, r: F.when((F.size(acc) == 0) | behind(r[at], F.try_element_at(acc, F.lit(-1))), F.concat(acc, F.array(r[at]))).otherwise(acc))
    long = grouped.select(*key, begins.alias("__begins"), F.explode("__rows").alias("__r")).select(*key, "__begins", "__r.*")
    long = long.withColumn("window", (F.size(F.filter("__begins", lambda b: b <= F.col(at))) - 1).cast("long")).withColumn("window_at", F.get("__begins", F.col("window").cast("int"))).drop("__begins")
    w = Window.partitionBy(*key, "window").orderBy(at, *ties).rowsBetween(Window.unboundedPreceding, 0)
    return long.withColumns({c: F.sum(f"__v{i}").over(w) for i, c in enumerate(sums)}).drop(*[f"__v{i}" for i in range(len(sums))])


def _doubled(rows: DataFrame, key: list[str], at: str, reach: Callable[[Column], Column], ties: list[str], inclusive: bool, sums: dict[str, Column]) -> DataFrame:
    """Each row gets the next row behind its own reach, and from the first rows of all keys these links are followed by
    doubling: after n rounds the first 2^n windows of each key are known. Only rows that a link leads to stay in the next
    round's links. A link over a key's end leads to the next key's first row, which begins a window anyway."""
    ordered = numbered(rows, [*map(F.col, key), F.col(at), *map(F.col, ties)], "__place")
    probes = ordered.select(*key, reach(F.col(at)).alias(at), F.col("__place").alias("from"))
    n = ordered.count()
    links = written(count_before(ordered.select(*key, at), probes, key, at, inclusive).select("from", F.col("before").alias("to")).where(F.col("to") < n), "links")
    found = written(ordered.groupBy(*key).agg(F.min("__place").alias("at")).select("at"), "anchors")
    while True:
        reached = written(found.join(links, F.col("at") == F.col("from")).select(F.col("to").alias("at")).distinct().join(found, "at", "left_anti"), "anchors")
        if reached.isEmpty():
            break
        found = written(found.unionByName(reached), "anchors")
        met = written(links.select(F.col("to").alias("from")).distinct().join(links, "from").select(F.col("from").alias("to"), F.col("to").alias("far")), "links")
        twice = links.join(met, "to").select("from", F.col("far").alias("to"))
        held = met.select(F.col("to").alias("from")).unionByName(found.select(F.col("at").alias("from"))).distinct()
        links = written(twice.join(held, "from", "left_semi"), "links")
    marked = ordered.join(found.select(F.col("at").alias("__place"), F.lit(1).cast("long").alias("__starts")), "__place", "left").withColumn("__starts", F.coalesce("__starts", F.lit(0).cast("long")))
    marks = {"__w": F.col("__starts"), **{f"__s{i}": F.coalesce(F.col(f"__v{i}"), F.lit(0)) for i in range(len(sums))}}
    summed = written(running_at(marked, "__place", marks), "rows")
    starts = summed.where("__starts = 1").select("__w", *key, F.col(at).alias("window_at"), *[(F.col(f"__s{i}") - F.coalesce(F.col(f"__v{i}"), F.lit(0))).alias(f"__b{i}") for i in range(len(sums))])
    starts = written(starts, "starts")
    firsts = starts.groupBy(*key).agg(F.min("__w").alias("__f"))
    same = functools.reduce(lambda a, b: a & b, [starts[c].eqNullSafe(firsts[c]) for c in key])
    starts = written(starts.join(firsts, same).select("__w", "window_at", (F.col("__w") - F.col("__f")).alias("window"), *[f"__b{i}" for i in range(len(sums))]), "starts")
    both = summed.join(starts, "__w").withColumns({c: F.col(f"__s{i}") - F.col(f"__b{i}") for i, c in enumerate(sums)})
    return both.drop("__w", "__place", "__starts", *[f"{p}{i}" for i in range(len(sums)) for p in ("__s", "__b", "__v")])


def whole_batches(rows: DataFrame, order: list[Column | str], size: int) -> DataFrame:
    """Adds ``batch``: rows of the whole table in batches of one size, in the order."""
    return numbered(rows, order, "__place").withColumn("batch", F.floor(F.col("__place") / size)).drop("__place")


def whole_budget(rows: DataFrame, order: list[Column | str], cost: str, budget: float) -> DataFrame:
    """The first rows of the whole table whose costs together fit the budget, with ``running``; a missing cost is none."""
    cost_of = F.coalesce(F.col(cost), F.lit(0).cast(rows.schema[cost].dataType))
    return running_sums(rows, order, {"running": cost_of}, "__place").where(F.col("running") <= budget).drop("__place")


def whole_block_sort(rows: DataFrame, block: str, head: Column, flag: Column, weight: str, name: str) -> DataFrame:
    """Adds ``sort_index`` from 0 over the whole table: flagged blocks first, then by their largest weight; in a block the head, then by weight and name.

    A block's flag and weight come from one aggregate, which is written, so that a large block can be split in the join.
    """
    w = F.greatest(F.coalesce(F.col(weight), F.lit(0)), F.lit(0))
    of_block = written(rows.groupBy(F.col(block).alias("__b")).agg(F.max(F.coalesce(flag, F.lit(False))).alias("__f"), F.max(w).alias("__w")), "blocks")
    marked = rows.join(of_block, F.col(block).eqNullSafe(F.col("__b"))).withColumns({"__h": F.coalesce(head, F.lit(False)), "__o": F.coalesce(F.col(weight), F.lit(0))})
    order = [F.desc("__f"), F.desc("__w"), F.col(block), F.desc("__h"), F.desc("__o"), F.col(name)]
    return numbered(marked, order, "sort_index").drop("__b", "__f", "__w", "__h", "__o")
