"""Prefix trie of conversations: an Euler tour of its nodes, ranked as a list, gives sums over subtrees by prefix sums.

A prefix is named by its length and by the exclusive or of 128 hashed bits of each of its turns with their places. So each
turn adds to its prefix alone, prefixes of a conversation come from sums in blocks, and no task holds a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order import numbered
from .common import written

#: Turns of a conversation, or arcs of the tour, that one window adds up.
BLOCK = 4096
#: An arc in so many is a ruler; the arcs between two rulers are jumped over in few rounds.
RULERS = 16
#: Rulers that the driver may rank: a bound of a few megabytes.
RANKED = 1 << 17
#: Identifiers of a text that is hashed, joined at a time.
JOINED = 4096
#: Conversations of a hundred share the beginning of the first, up to so many turns less one.
SHARED, TURNS = 100, 6


def shared_turns(conv_id: Column | str) -> Column:
    """How many turns a conversation takes from the first of its hundred."""
    c = F.col(conv_id) if isinstance(conv_id, str) else conv_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(TURNS)).cast("long")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos, x, y, size) of the rebuilt conversations, and the conversations (conv_id, n).

    x and y are the hashed turn with its place, size the code points of the text.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    plain = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("text"))
    placed = numbered(plain, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")])
    hashed = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    part = lambda i: F.conv(F.substring(hashed, i, 15), 16, 10).cast("long")
    turns = written(placed.select("conv_id", "place", part(1).alias("a"), part(16).alias("b"), F.length("text").alias("size")), "turns")
    convs = written(turns.groupBy("conv_id").agg(F.count("*").alias("own"), F.min("place").alias("first")).withColumns({"h": shared_turns("conv_id"), "base": F.col("conv_id") - F.col("conv_id") % SHARED}), "convs")
    based = convs.alias("c").join(convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own")), "base", "left")
    based = written(based.withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0)))).drop("base_own"), "convs")
    mine = turns.join(based, "conv_id").withColumn("nth", F.col("place") - F.col("first") + 1)
    own = mine.where("nth > h").select("conv_id", (F.col("nth") - F.col("h") + F.col("taken")).alias("pos"), "a", "b", "size")
    heads = mine.where(f"base = conv_id AND nth < {TURNS}").select("base", "nth", "a", "b", "size")
    given = based.where("taken > 0").select("base", "conv_id", "taken").join(heads, "base").where("nth <= taken").select("conv_id", F.col("nth").alias("pos"), "a", "b", "size")
    whole = own.unionByName(given).select("conv_id", "pos", F.xxhash64("pos", "a", "b").alias("x"), F.xxhash64("b", "pos", "a").alias("y"), "size")
    sizes = based.select("conv_id", (F.greatest(F.col("own") - F.col("h"), F.lit(0)) + F.col("taken")).alias("n"))
    return whole, sizes


def _running(rows: DataFrame, key: list[str], pos: str, names: list[str], add: str, name: str) -> DataFrame:
    """Running sums of columns along a dense place from 0 within a key, in blocks: sums inside a block, then what the blocks before hold, by the same rule."""
    agg = {"sum": F.sum, "xor": F.bit_xor}[add]
    both = (lambda a, b: a + b) if add == "sum" else (lambda a, b: a.bitwiseXOR(b))
    marked = rows.withColumn("__k", F.floor(F.col(pos) / BLOCK))
    w = Window.partitionBy(*key, "__k").orderBy(pos)
    inside = marked.withColumns({c: agg(c).over(w) for c in names})
    held = written(marked.groupBy(*key, F.col("__k").alias("__p")).agg(*[agg(c).alias(c) for c in names]), name)
    if held.where("__p > 0").isEmpty():
        return inside.drop("__k")
    before = _running(held, key, "__p", names, add, name).select(*key, (F.col("__p") + 1).alias("__k"), *[F.col(c).alias(f"__{c}") for c in names])
    joined = inside.join(before, [*key, "__k"], "left")
    return joined.withColumns({c: both(F.col(c), F.coalesce(f"__{c}", F.lit(0))) for c in names}).drop("__k", *[f"__{c}" for c in names])


def list_ranks(arcs: DataFrame, end: int) -> DataFrame:
    """(arc, left): how many arcs follow each arc (arc, next) of one list that ``end`` ends.

    Arcs by hash, and the end, are rulers. Every arc jumps by doubling until it meets the next ruler; the rulers, which then
    make a shorter list with lengths, are ranked by the same rule, and the last few by the driver; the others add up.
    """
    return _ranked(arcs.select("arc", F.col("next").alias("to"), F.lit(1).cast("long").alias("d")), end, 0)


def _ranked(arcs: DataFrame, end: int, level: int) -> DataFrame:
    ruler = lambda c: (F.pmod(F.xxhash64(F.col(c), F.lit(level)), F.lit(RULERS)) == 0) | (F.col(c) == end)
    now = written(arcs, "jumps")
    while not now.where(~ruler("to")).isEmpty():
        open_ = now.where(~ruler("to"))
        far = now.select(F.col("arc").alias("to"), F.col("to").alias("to2"), F.col("d").alias("d2"))
        moved = open_.join(far, "to").select("arc", F.col("to2").alias("to"), (F.col("d") + F.col("d2")).alias("d"))
        now = written(now.where(ruler("to")).unionByName(moved), "jumps")
    rulers = now.where(ruler("arc"))
    spark = arcs.sparkSession
    if rulers.count() > RANKED:
        left = _ranked(rulers, end, level + 1)
    else:
        # from the end backwards: each ruler has one before it
        before = {r["to"]: (r["arc"], r["d"]) for r in rulers.collect()}
        found, at, far_ = [(end, 0)], end, 0
        while at in before:
            at, d = before[at]
            far_ += d
            found.append((at, far_))
        left = spark.createDataFrame(found, "arc long, left long")
    left = written(left, "ranks")
    others = now.where(~ruler("arc")).join(left.withColumnRenamed("arc", "to"), "to").select("arc", (F.col("left") + F.col("d")).alias("left"))
    return written(left.unionByName(others), "ranks")


def _digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the identifiers of each node, ascending, joined by commas.

    Identifiers are joined in blocks where they are; a digest that has more than one is hashed block by block as these stream by.
    """
    placed = numbered(ends, [F.col("node"), F.col("conv_id")])
    blocks = placed.withColumn("block", F.floor(F.col("place") / JOINED)).groupBy("node", "block").agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    blocks = written(blocks, "ends")
    many = written(blocks.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node"), "ends")
    one = blocks.join(many, "node", "left_anti").select("node", F.sha2("ids", 256).alias("ends_sha256"))

    def stream(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, h = None, None
        for frame in frames:
            nodes, shas = [], []
            for key, ids in zip(frame["node"].to_pylist(), frame["ids"].to_pylist()):
                if key != node:
                    if h:
                        nodes.append(node)
                        shas.append(h.hexdigest())
                    node, h = key, hashlib.sha256(ids.encode())
                else:
                    h.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(shas, pa.string())], ["node", "ends_sha256"])
        if h:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([h.hexdigest()])], ["node", "ends_sha256"])

    parts = blocks.join(many, "node", "left_semi").repartition("node").sortWithinPartitions("node", "block")
    return one.unionByName(parts.mapInArrow(stream, "node long, ends_sha256 string"))


def prefix_trie(rows: DataFrame) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations, the root first: see the columns below.

    ``rows`` has conv_id, turn, role and text; other columns are ignored. Turns of a conversation go by turn (null first),
    then role and text; rows repeated with all of these are turns of their own. Null roles and texts are empty; rows without
    a conv_id belong to no conversation and are left out. A table without conversations has no node.

    conv_id: the smallest member; depth; parent_conv_id: the parent's (root: null); n_convs: members; n_children; n_leaves:
    childless nodes in its subtree; saved_tokens: over its subtree, members less one times code points of the last text;
    ends_sha256: of the members that end here.
    """
    turns, convs = rebuilt(rows)
    turns = written(turns, "turns")
    prefixes = _running(turns.withColumn("__i", F.col("pos") - 1).withColumns({"px": F.col("x"), "py": F.col("y")}), ["conv_id"], "__i", ["px", "py"], "xor", "prefixes").drop("__i")
    prefixes = written(prefixes, "prefixes")
    parent = {"qx": F.col("px").bitwiseXOR(F.col("x")), "qy": F.col("py").bitwiseXOR(F.col("y"))}
    inner = prefixes.withColumns(parent).groupBy(F.col("pos").alias("depth"), "px", "py").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").cast("long").alias("size"), F.min("qx").alias("qx"), F.min("qy").alias("qy"))
    # children of one parent get numbers that follow each other
    key = ["depth", "qx", "qy"]
    nodes = written(numbered(inner, [*map(F.col, key), F.col("px"), F.col("py")]).withColumn("node", F.col("place") + 1).drop("place"), "nodes")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("px"), zero.alias("py"), "conv_id", "n_convs", zero.alias("size"), F.lit(None).cast("long").alias("qx"), F.lit(None).cast("long").alias("qy"), zero.alias("node"))
    nodes = written(nodes.unionByName(root), "nodes")
    families = nodes.where("node > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("qx").alias("px"), F.col("qy").alias("py")).agg(F.min("node").alias("eldest"), F.max("node").alias("youngest"))
    nodes = written(nodes.join(families, ["depth", "px", "py"], "left"), "nodes")
    above = nodes.where("eldest IS NOT NULL").select((F.col("depth") + 1).alias("depth"), F.col("px").alias("qx"), F.col("py").alias("qy"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("youngest").alias("last"))
    nodes = written(nodes.join(above, key, "left"), "nodes")

    # the tour: arc 2n enters node n, arc 2n + 1 leaves it
    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    down = nodes.select(enter.alias("arc"), F.coalesce(F.col("eldest") * 2, leave).alias("next"))
    up = nodes.where("node > 0").select(leave.alias("arc"), F.when(F.col("node") == F.col("last"), F.col("parent") * 2 + 1).otherwise(enter + 2).alias("next"))
    ranks = list_ranks(down.unionByName(up), end=1)
    own = nodes.select(enter.alias("arc"), F.col("eldest").isNull().cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    # places from the end, so that sums run from an exit to its entrance
    tour = ranks.join(own, "arc", "left").select("arc", "left", F.coalesce("leaves", F.lit(0)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"))
    summed = _running(tour, [], "left", ["leaves", "saved"], "sum", "tour")
    at = lambda c, side: F.max(F.when(F.col("arc") % 2 == side, F.col(c)))
    trees = summed.groupBy(F.floor(F.col("arc") / 2).alias("node")).agg(*[(at(c, 0) - at(c, 1)).alias(c) for c in ("leaves", "saved")])

    ended = convs.join(prefixes.select("conv_id", F.col("pos").alias("n"), "px", "py"), ["conv_id", "n"], "left").select("conv_id", F.col("n").alias("depth"), F.coalesce("px", F.lit(0)).alias("px"), F.coalesce("py", F.lit(0)).alias("py"))
    digests = _digests(ended.join(nodes.select("depth", "px", "py", "node"), ["depth", "px", "py"]).select("node", "conv_id"))
    out = nodes.join(trees, "node").join(digests, "node", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce(F.col("youngest") - F.col("eldest") + 1, F.lit(0)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )


#: crc32 of a decimal text, bit by bit.
_CRC = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split({}, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"

#: A prefix is named by the digests of its turns in a row, 64 signs each.
SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS nth FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % {SHARED} AS base, {_CRC.format("conv_id::VARCHAR")} % {TURNS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS side, nth, role, text FROM c JOIN t ON t.conv_id = c.base AND nth <= h
  UNION ALL SELECT c.conv_id, 1, nth, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND nth > h),
p AS (SELECT conv_id, row_number() OVER w AS d, length(text) AS size, string_agg(md5(role) || md5(text), '') OVER w AS key FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY side, nth ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size, substr(key, 1, 64 * (d - 1)) AS above FROM p GROUP BY d, key),
k AS (SELECT above AS key, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY above, d),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (key, d)),
s AS (SELECT substr(key, 1, 64 * up) AS key, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens FROM (SELECT *, unnest(range(d + 1)) AS up FROM m) GROUP BY 1),
e AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM (SELECT conv_id, max_by(key, d) AS key FROM p GROUP BY conv_id) GROUP BY key)
SELECT m.conv_id, m.d::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM m JOIN s USING (key) LEFT JOIN e USING (key) LEFT JOIN n u ON m.d > 0 AND u.key = m.above AND u.d = m.d - 1
"""
