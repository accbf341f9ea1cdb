"""Indicator values: zones, bands, pairs, correlations, support; bit masks and enums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written
from .order import count_before, numbered


def zone(value: str, low: Column, high: Column, labels: tuple[str, str, str]) -> Column:
    """The label of a value below, between or above two cut points."""
    return F.when(F.col(value) < low, labels[0]).when(F.col(value) <= high, labels[1]).when(F.col(value) > high, labels[2])


def classify_zones(rows: DataFrame, factor: str, value: str, cuts: DataFrame, labels: tuple[str, str, str]) -> DataFrame:
    """Rows (long form) with their zone by a table (factor, low, high)."""
    return rows.join(cuts, factor).withColumn("zone", zone(value, F.col("low"), F.col("high"), labels)).drop("low", "high")


def band_overlap(p1: Column, w1: Column, p2: Column, w2: Column, top: float = 10) -> Column:
    """Jaccard of two bands around their positions, cut to 0..top."""
    ends = lambda p, w: (F.greatest(p - w / 2, F.lit(0.0)), F.least(p + w / 2, F.lit(float(top))))
    (a, b), (c, d) = ends(p1, w1), ends(p2, w2)
    both = F.greatest(F.least(b, d) - F.greatest(a, c), F.lit(0.0))
    either = (b - a) + (d - c) - both
    return F.when(either > 0, both / either).otherwise(0.0)


def bands_apart(p1: Column, w1: Column, p2: Column, w2: Column) -> Column:
    """Whether two bands around their positions have no point in common."""
    return F.abs(p1 - p2) > (w1 + w2) / 2


def apart_neighbours(rows: DataFrame, group: str, key: str, position: str, width: str) -> DataFrame:
    """(group, key, n_apart): with how many others of its list a row's band has no point in common, as ``bands_apart`` says.

    Bands that end before this one begins, and bands that begin behind its end, are counted by places in whole orders; no
    pairs are made but of bands whose ends are as close as rounding, which ``bands_apart`` decides. Widths are finite and not
    negative. Rows without a list, key, position or width have no neighbours and are none; rows of one key are no neighbours,
    and what they count is added up. A position that is no finite number is apart from all others.
    """
    r = rows.select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(position).alias("p"), F.col(width).alias("w"))
    whole = F.col("g").isNotNull() & F.col("k").isNotNull() & F.col("p").isNotNull() & F.col("w").isNotNull()
    known = written(r.where(whole), "bands")
    several = written(known.groupBy("g", "k").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "bands-of-a-key")
    counted = r.where(~whole).select("g", "k", F.lit(0).cast("long").alias("n")).unionByName(_apart(known, ["g"]))
    if not several.isEmpty():
        counted = counted.unionByName(_apart(written(known.join(several, ["g", "k"]), "bands"), ["g", "k"]).withColumn("n", -F.col("n")))
    return counted.groupBy(F.col("g").alias(group), F.col("k").alias(key)).agg(F.sum("n").alias("n_apart"))


def _apart(known: DataFrame, by: list[str]) -> DataFrame:
    """(g, k, n): for each row of the table (g, k, p, w) how many others of the same ``by`` are apart from it."""
    finite = F.abs("p") < float("inf")
    reach = known.where(finite).agg(F.max(F.abs("p").cast("double") + F.abs("w").cast("double"))).first()[0] or 1.0
    near = reach * 2.0**-49  # more than all roundings of ends and distances together
    p, half = F.col("p").cast("double"), F.col("w").cast("double") / 2
    ends = known.where(finite).withColumns({"a": p - half, "b": p + half})
    totals = written(known.groupBy(*by).agg(F.count_if(finite).alias("n_finite"), F.count_if(~finite).alias("n_loose")), "bands-by-list")
    loose = known.where(~finite).join(totals, by).select("g", "k", (F.col("n_finite") + F.col("n_loose") - 1).alias("n"))
    # places count the lists before, too; as many ends as beginnings stand there
    ended = count_before(ends.select(*by, F.col("b").alias("x")), ends.select("g", "k", "b", (F.col("a") - near).alias("x")), by, "x", inclusive=False)
    ended = ended.select("g", "k", (F.col("b") + near).alias("x"), F.col("before").alias("ended"))
    both = count_before(ends.select(*by, F.col("a").alias("x")), ended, by, "x", inclusive=True)
    clear = both.join(totals, by).select("g", "k", (F.col("n_finite") + F.col("n_loose") + F.col("ended") - F.col("before")).alias("n"))
    values = written(ends.groupBy(*by, "p", "w", "a", "b").agg(F.count("*").alias("n")), "bands-once")
    cell = lambda x: F.floor(x / (2 * near))
    close = None
    for end, begin, side in (("b", "a", F.col("p2") > F.col("p")), ("a", "b", F.col("p2") < F.col("p"))):
        low, high = F.col(end) - near, F.col(end) + near
        others = values.select(*by, F.col("p").alias("p2"), F.col("w").alias("w2"), F.col(begin).alias("x"), "n", cell(F.col(begin)).alias("cell"))
        met = values.drop("n").withColumn("cell", F.explode(F.sequence(cell(low), cell(high)))).join(others, [*by, "cell"])
        met = met.where(F.col("x").between(low, high) & side & bands_apart(F.col("p"), F.col("w"), F.col("p2"), F.col("w2"))).select(*by, "p", "w", "n")
        close = met if close is None else close.unionByName(met)
    close = written(close.groupBy(*by, "p", "w").agg(F.sum("n").alias("n")), "bands-close")
    return clear.unionByName(loose).unionByName(known.join(close, [*by, "p", "w"]).select("g", "k", "n"))


def zone_pairs(rows: DataFrame, group: str, zone: str) -> DataFrame:
    """(group, zone_a, zone_b, n): of a list's pairs, how many lie in two given zones, from the zones' counts; zone_a before zone_b, or the same."""
    n = rows.where(F.col(zone).isNotNull()).groupBy(F.col(group).alias("g"), F.col(zone).alias("z")).agg(F.count("*").alias("n"))
    a, b = (n.select(F.col("g").alias(f"g{i}"), F.col("z").alias(f"zone_{i}"), F.col("n").alias(f"n{i}")) for i in "ab")
    pairs = a.join(b, (F.col("ga") == F.col("gb")) & (F.col("zone_a") <= F.col("zone_b")))
    count = F.when(F.col("zone_a") == F.col("zone_b"), F.col("na") * (F.col("na") - 1) / 2).otherwise(F.col("na") * F.col("nb")).cast("long")
    return pairs.select(F.col("ga").alias(group), "zone_a", "zone_b", count.alias("n"))


#: Bands to a threshold in ``distant_pairs``; the more, the more tasks a list can be dealt over.
PARTS = 8


def distant_pairs(rows: DataFrame, group: str, key: str, value: str, least: float) -> DataFrame:
    """(group, a, b, distance): all pairs of a list whose values are at least so far apart, a below b by key.

    Values are cut into bands, ``PARTS`` to the positive ``least``, and a row is copied into the bands of its list that can hold
    partners above it. All but the two nearest of these give a pair or more for each copy, so copies grow with rows and pairs;
    the rows of a list meet by band, not in one task. Of two rows that differ in nothing but the key the larger key counts as above.
    """
    r = rows.select(group, F.col(key).alias("k"), F.col(value).alias("v")).withColumn("band", F.rint(F.col("v").cast("double") * PARTS / least))
    levels = r.select(group, F.col("band").alias("above")).distinct()
    lifted = r.join(levels, group).where(F.col("above") >= F.col("band") + (PARTS - 1))  # one band more than the threshold, for what rounding does
    x = lifted.select(group, F.col("above").alias("band"), F.col("k").alias("k1"), F.col("v").alias("v1"))
    higher = (F.col("v") > F.col("v1")) | (F.col("v") == F.col("v1")) & (F.col("k") > F.col("k1"))
    pairs = x.join(r, [group, "band"]).withColumn("distance", F.abs(F.col("v") - F.col("v1"))).where((F.col("distance") >= least) & (F.col("k") != F.col("k1")) & higher)
    return pairs.select(group, F.least("k", "k1").alias("a"), F.greatest("k", "k1").alias("b"), "distance")


def distant_partners(rows: DataFrame, group: str, key: str, value: str, least: Column | float, k: int) -> DataFrame:
    """(group, key, nth, partner, distance): of the rows of a list that are at least so far apart, the ``k`` nearest of each.

    Of one distance the partner above comes first, then the smaller key above or the larger below. ``least`` is positive.
    Rows without a value have no partners. No pairs are made: in the whole order of list, value and key, the first partner
    above and below stands where the value plus or minus ``least`` would, which is a count of rows before; the ``k`` places
    from there are looked up by number.
    """
    r = rows.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(value).alias("v"))
    placed = written(numbered(r, [F.col("g"), F.col("v"), F.col("k")]), "placed")
    events = placed.select("g", "v")
    ahead = count_before(events, placed.select("g", "k", (F.col("v") + least).cast(r.schema["v"].dataType).alias("v"), F.col("v").alias("own")), ["g"], "v", inclusive=False)
    behind = count_before(events, placed.select("g", "k", (F.col("v") - least).cast(r.schema["v"].dataType).alias("v"), F.col("v").alias("own")), ["g"], "v", inclusive=True)
    places = lambda first, step: F.explode(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: first + i * step)).alias("place")
    wanted = ahead.select("g", "k", "own", places(F.col("before"), 1), F.lit(0).alias("side")).unionByName(behind.select("g", "k", "own", places(F.col("before") - 1, -1), F.lit(1).alias("side")))
    other = placed.select("place", F.col("g").alias("g2"), F.col("k").alias("partner"), F.col("v").alias("v2"))
    met = wanted.join(other, "place").where(F.col("g").eqNullSafe(F.col("g2"))).withColumn("distance", F.abs(F.col("v2") - F.col("own")))
    order = Window.partitionBy("g", "k", "own").orderBy("distance", "side", F.when(F.col("side") == 0, F.col("place")).otherwise(-F.col("place")))
    return met.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).select(F.col("g").alias(group), F.col("k").alias(key), "nth", "partner", "distance")


def correlation_matrix(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(x, y, r, n) for each two columns, over rows that have both; one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    wide = rows.agg(*[F.corr(F.when(both(a, b), F.col(a)), F.when(both(a, b), F.col(b))).alias(f"r_{a}_{b}") for a, b in pairs], *[F.count_if(both(a, b)).alias(f"n_{a}_{b}") for a, b in pairs])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r_{a}_{b}").alias("r"), F.col(f"n_{a}_{b}").alias("n")) for a, b in pairs])).alias("p")).select("p.*")


def support_shares(rows: DataFrame, group: str, support: str, width: str, least: int, edges: list[int]) -> DataFrame:
    """(group, bucket, n, share_supported, median_width): by buckets of support; medians hold a group's values, see ``support_sketches``."""
    bucket = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= F.col(support)))
    return rows.groupBy(group, bucket.alias("bucket")).agg(F.count("*").alias("n"), F.avg((F.col(support) >= least).cast("double")).alias("share_supported"), F.percentile(width, 0.5).alias("median_width"))


#: Leading bits of a value that its slot in a sketch keeps: a slot's values differ by less than 1 / 2^(BITS - 1) of themselves.
BITS = 8


def slot(value: Column, unit: float, bits: int = BITS) -> Column:
    """The least magnitude of a value's slot in units: its leading bits, the others 0, with its sign. Small values are exact."""
    n = F.round(value / unit).cast("long")
    size = F.abs(n)
    drop = F.greatest(F.length(F.bin(size)) - bits, F.lit(0))
    return F.signum(n).cast("long") * F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)


def sketch(rows: DataFrame, keys: list[str], value: str, unit: float, bits: int = BITS) -> DataFrame:
    """(keys, slot, n): how many values of a group lie in each slot; null values in none. Sketches merge by addition."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys, slot(F.col(value), unit, bits).alias("slot")).agg(F.count("*").alias("n"))


def merge_sketches(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """The sketch of both tables together."""
    return a.unionByName(b).groupBy(*keys, "slot").agg(F.sum("n").alias("n"))


def sketch_quantile(sketches: DataFrame, keys: list[str], q: float, unit: float) -> DataFrame:
    """(keys, quantile): the slot of the value at rank ceil(q n), at least 1. That slot holds the exact value at this rank, so
    the answer is below it in magnitude by less than 1 / 2^(BITS - 1) of it. A group has at most some thousand slots."""
    w = Window.partitionBy(*keys)
    upto = F.sum("n").over(w.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))
    ranked = sketches.withColumns({"__upto": upto, "__rank": F.greatest(F.ceil(F.lit(q) * F.sum("n").over(w)), F.lit(1))})
    return ranked.where(F.col("__upto") >= F.col("__rank")).groupBy(*keys).agg((F.min("slot") * unit).alias("quantile"))


def support_sketches(rows: DataFrame, group: str, support: str, width: str, edges: list[int], unit: float) -> DataFrame:
    """(group, bucket, slot, n): widths by buckets of support, as sketches, for medians over tables of any size."""
    bucket = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= F.col(support)))
    return sketch(rows.withColumn("bucket", bucket), [group, "bucket"], width, unit)


def decode_mask(rows: DataFrame, mask: str, codes: DataFrame, bit: str, label: str, key: str) -> DataFrame:
    """(key, labels): the labels of the bits that a mask has set."""
    joined = rows.select(key, F.col(mask).alias("__m")).join(F.broadcast(codes), F.col("__m").bitwiseAND(F.col(bit)) != 0, "left")  # a code table has a row for each bit of an int
    return joined.groupBy(key).agg(F.sort_array(F.collect_list(label)).alias("labels"))


def decode_enum(value: str, labels: dict[int, str], none: int | None = None) -> Column:
    c = F.col(value)
    out = F.when(c == none, None) if none is not None else None
    for k, v in labels.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


def as_indicator(value: Column) -> Column:
    """A variant that is a number or the sign "x" for indifferent: (value, indifferent)."""
    number, sign = F.try_variant_get(value, "$", "double"), F.try_variant_get(value, "$", "string")
    return F.struct(number.alias("value"), F.coalesce(sign == "x", F.lit(False)).alias("indifferent"))
