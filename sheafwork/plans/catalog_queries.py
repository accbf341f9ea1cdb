"""The library's own operators over the given tables, each with the DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit, filters, indicators, layout, lists, merge, order, resolve, search, tree, windows
from ..registry import query, table
from ..sources import readers, sinks
from ..storage import folders, scratch, written
from ..streaming import ingest

# Best rows by facet, counts, pivots


@query("best_per_facet", """
SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, nth, n_allowed FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS nth,
         count(*) OVER (PARTITION BY l_suppkey) AS n_allowed
  FROM lineitem WHERE lower(trim(l_linestatus)) IN ('f')) WHERE nth <= 3
""")
def best_per_facet(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where(filters.allowed_licence("l_linestatus", ["f"])).select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    top = windows.top_per_facet(rows, "l_suppkey", "l_returnflag", [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 3)
    counts = merge.facet_counts(rows, "l_suppkey", "l_returnflag").select("l_suppkey", F.col("total").alias("n_allowed"))
    return top.join(counts, "l_suppkey").select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "nth", "n_allowed")


@query("facet_count_map", "SELECT l_suppkey, l_returnflag AS facet, count(*) AS n, sum(count(*)) OVER (PARTITION BY l_suppkey)::BIGINT AS total FROM lineitem GROUP BY 1, 2")
def facet_count_map(spark: SparkSession, d: str) -> DataFrame:
    counts = merge.facet_counts(table(spark, d, "lineitem"), "l_suppkey", "l_returnflag")
    return counts.select("l_suppkey", "total", F.explode("by_facet").alias("facet", "n"))


@query("group_histogram", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def group_histogram(spark: SparkSession, d: str) -> DataFrame:
    return merge.histogram(table(spark, d, "events"), "event_type")


@query("facet_pivot_total", """
WITH w AS (SELECT user_id::VARCHAR AS user_id, count(*) FILTER (event_type = 'view') AS "view", count(*) FILTER (event_type = 'click') AS click,
  count(*) FILTER (event_type NOT IN ('view', 'click') OR event_type IS NULL) AS other, count(*) AS total FROM events GROUP BY 1)
SELECT * FROM w UNION ALL SELECT 'TOTAL', sum("view")::BIGINT, sum(click)::BIGINT, sum(other)::BIGINT, sum(total)::BIGINT FROM w
""")
def facet_pivot_total(spark: SparkSession, d: str) -> DataFrame:
    return merge.facet_matrix(table(spark, d, "events"), "user_id", "event_type", ["view", "click"])


@query("cap_stats", """
WITH g AS (SELECT l_suppkey, l_returnflag, count(*) AS m FROM lineitem GROUP BY 1, 2)
SELECT sum(m)::BIGINT AS n_read, sum(least(m, 120))::BIGINT AS n_kept, round(100 * sum(least(m, 120)) / sum(m), 1) AS share, count(*) AS n_groups, count(*) FILTER (m > 120) AS n_capped FROM g
""")
def cap_stats(spark: SparkSession, d: str) -> DataFrame:
    return windows.cap_statistics(table(spark, d, "lineitem"), "l_suppkey", "l_returnflag", 120)


@query("two_level_quota", """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id, props ORDER BY event_id) AS u FROM events),
w AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM o WHERE u = 1),
l AS (SELECT event_type, length(event_type) % 3 + 1 AS lim FROM events GROUP BY 1),
k AS (SELECT w.* FROM w JOIN l USING (event_type) WHERE n <= lim)
SELECT user_id, event_id, nth FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM k) WHERE nth <= 6
""")
def two_level_quota(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    limits = events.select("event_type").distinct().withColumn("lim", F.length("event_type") % 3 + 1)
    return windows.two_level_quota(events, "user_id", "event_type", "props", "event_id", limits, "event_type", "lim", 6).select("user_id", "event_id", "nth")


# Gates and filters


@query("allow_list_gate", """
SELECT o_orderkey, n FROM (SELECT o_orderkey, o_custkey FROM orders) JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY 1) ON o_orderkey = l_orderkey
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
""")
def allow_list_gate(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.array("c_name")).alias("names"))
    images = table(spark, d, "lineitem").where(filters.allowed_licence("l_returnflag", ["a", "n"])).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    joined = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(named, "o_custkey").join(images, "o_orderkey")
    return filters.selection_gate(joined, ["names"], "n").select("o_orderkey", "n")


@query("denied_and_photo", r"""
SELECT page_id FROM pages WHERE trim(url) <> '' AND NOT regexp_matches(url, '(?i)(^|[^A-Za-z0-9_])(nc|nd|nonfree|non-free|fair use)($|[^A-Za-z0-9_])')
  AND NOT regexp_matches(url, '(?i)(^|[^A-Za-z0-9_])(map|flag|plate|page[_ ][0-9]+)($|[^A-Za-z0-9_])')
""")
def denied_and_photo(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").where(filters.not_denied("url") & filters.is_photo("url")).select("page_id")


@query("composed_filters", "SELECT p_partkey, upper(p_name) AS label FROM part WHERE p_type = 'PROMO' AND p_size > 10 AND p_name LIKE '%widget%'")
def composed_filters(spark: SparkSession, d: str) -> DataFrame:
    rows = filters.without_marked(table(spark, d, "part"), "p_name", r"ring$").withColumn("names", F.array("p_name"))
    kept, _ = filters.filter_map(rows, filters.all_of(F.col("p_type") == "PROMO", F.col("p_size") > 10, filters.has_filled("names"), filters.matches("p_name", "widget")), ["p_partkey", F.upper("p_name").alias("label")])
    return kept


@query("filter_counts", "SELECT count(*) AS seen, count(*) FILTER (c_acctbal > 0) AS kept FROM customer")
def filter_counts(spark: SparkSession, d: str) -> DataFrame:
    return filters.filter_map(table(spark, d, "customer"), F.col("c_acctbal") > 0, ["c_custkey"])[1]


@query("reshape_fields", "SELECT s_suppkey AS key, s_name AS name, s_nationkey AS area FROM supplier")
def reshape_fields(spark: SparkSession, d: str) -> DataFrame:
    return filters.reshape(table(spark, d, "supplier"), ["s_acctbal"], {"s_suppkey": "key", "s_name": "name", "s_nationkey": "area"})


@query("free_text_filter", "SELECT p_partkey FROM part WHERE contains(lower(p_name), 'red') OR contains(lower(p_brand), 'red') OR contains(p_partkey::VARCHAR, 'red')")
def free_text_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").where(filters.contains_text(" RED ", "p_name", "p_brand", "p_partkey")).select("p_partkey")


@query("field_predicates", "SELECT o_orderkey FROM orders WHERE lower(o_orderpriority) LIKE '1-%' AND o_orderstatus IN ('F', 'O') AND o_custkey IS NOT NULL")
def field_predicates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where(filters.matches("o_orderpriority", "1-", "prefix") & F.col("o_orderstatus").isin("F", "O") & F.col("o_custkey").isNotNull()).select("o_orderkey")


@query("open_work", "SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def open_work(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "orders").where("o_orderstatus = 'F'")
    return filters.open_work(table(spark, d, "customer"), "c_custkey", done, "o_custkey", F.col("c_mktsegment") != "BUILDING", "c_acctbal").select("c_custkey")


# Keys


@query("key_translation", """
WITH m AS (SELECT c_custkey AS s, c_custkey + 1000000000 AS t FROM customer WHERE c_custkey % 3 = 0), n AS (SELECT c_custkey AS s, c_custkey + 2000000000 AS t FROM customer WHERE c_custkey % 5 = 0)
SELECT o_orderkey, coalesce(m.t, o_custkey) AS resolved FROM orders LEFT JOIN m ON o_custkey = s WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, n.t FROM orders JOIN n ON o_custkey = s WHERE o_orderstatus = 'F'
""")
def key_translation(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    named = keys.where("k % 5 = 0").select(F.concat(F.lit("name:"), F.col("k").cast("string")).alias("s"), (F.col("k") + 2_000_000_000).alias("t"))
    key_map = keys.where("k % 3 = 0").select(F.col("k").cast("string").alias("s"), (F.col("k") + 1_000_000_000).alias("t")).unionByName(named)
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("key"), F.concat(F.lit("name:"), F.col("o_custkey").cast("string")).alias("name"))
    return resolve.translate_keys(rows, "key", key_map, "s", "t", F.col("name")).select("o_orderkey", "resolved")


@query("key_cascade", """
WITH a AS (SELECT c_custkey AS key, c_name AS name FROM customer WHERE c_custkey % 2 = 0),
c AS (SELECT DISTINCT o_custkey FROM orders UNION SELECT DISTINCT user_id FROM events),
r AS (SELECT o_custkey, x.key AS direct, y.key AS named,
        CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 5 = 1 THEN (CASE WHEN o_custkey % 10 >= 5 THEN o_custkey + 1 END) WHEN o_custkey % 5 = 2 THEN o_custkey + 1 ELSE o_custkey END AS m
      FROM c LEFT JOIN a x ON x.key = o_custkey LEFT JOIN a y ON y.name = CASE WHEN o_custkey % 7 = 1 THEN 'Customer#' || lpad((o_custkey + 1)::VARCHAR, 9, '0') END)
SELECT o_custkey AS source, coalesce(direct, named, z.key) AS target, CASE WHEN direct IS NOT NULL THEN 'direct' WHEN named IS NOT NULL THEN 'name' WHEN z.key IS NOT NULL THEN 'match' ELSE 'none' END AS via
FROM r LEFT JOIN a z ON z.key = r.m
""")
def key_cascade(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "orders").select(F.col("o_custkey").alias("k")).union(table(spark, d, "events").select("user_id")).distinct()
    accepted = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_custkey").alias("ord"))
    candidates = keys.select(F.col("k").cast("string").alias("source"), F.when(F.col("k") % 7 == 1, F.concat(F.lit("Customer#"), F.lpad((F.col("k") + 1).cast("string"), 9, "0"))).otherwise("").alias("name"))
    kind = F.col("k") % 5
    responses = keys.select(
        F.col("k").cast("string").alias("source"), F.when(kind == 0, "NONE").when(kind == 1, "FUZZY").otherwise("EXACT").alias("matchType"),
        F.when(F.col("k") % 10 >= 5, 96).otherwise(80).alias("confidence"), F.when(kind.isin(1, 2), "SYNONYM").otherwise("ACCEPTED").alias("status"),
        F.col("k").alias("usageKey"), (F.col("k") + 1).alias("acceptedUsageKey"), F.lit(None).cast("string").alias("species"), F.lit(None).cast("string").alias("genus"),
        F.array().cast("array<struct<key:bigint,nubKey:bigint,rank:string,taxonomicStatus:string,genus:string,species:string,canonicalName:string>>").alias("search"),
    )
    return resolve.resolve_cascade(candidates, accepted, responses).select(F.col("source").cast("bigint").alias("source"), "target", "via")


@query("cached_resolution", """
WITH k AS (SELECT DISTINCT o_custkey FROM orders), c AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
SELECT o_custkey AS source, c_custkey AS target, CASE WHEN o_custkey % 2 = 0 THEN 'first' WHEN c_custkey IS NULL THEN 'none' ELSE 'second' END AS via
FROM k LEFT JOIN c ON c_custkey = o_custkey WHERE o_custkey % 2 = 1 OR c_custkey IS NOT NULL OR o_custkey % 4 = 0
""")
def cached_resolution(spark: SparkSession, d: str) -> DataFrame:
    """A first run over half of the keys stores what it finds and part of what it doesn't; errors are left out of both."""
    path, schema = scratch(spark, "map"), "source BIGINT, target BIGINT, via STRING"
    keys = table(spark, d, "orders").select(F.col("o_custkey").alias("source"))
    known = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("target"))

    def look(via: str, missing: Column):
        return lambda new: new.join(known, F.col("source") == F.col("target"), "left").withColumn("via", F.when(F.col("target").isNotNull(), via).otherwise(missing))

    resolve.resolve_generation(keys.where("source % 2 = 0"), path, schema, look("first", F.when(F.col("source") % 4 == 0, "first").otherwise("error")))
    return resolve.resolve_generation(keys, path, schema, look("second", F.when(F.col("source") % 2 == 1, "none").otherwise("error")))


@query("first_wins_index", r"""
WITH e AS (SELECT p_partkey, 0 AS pos, 'name' AS via, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS name FROM part
  UNION ALL SELECT p_partkey, 1, 'type', trim(regexp_replace(lower(p_type || ' ' || p_name), '[^a-z0-9]+', ' ', 'g')) FROM part
  UNION ALL SELECT p_partkey, 2, 'type', trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g')) FROM part)
SELECT name, p_partkey AS key, via FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY p_partkey, pos) AS n FROM e WHERE name <> '') WHERE n = 1
""")
def first_wins_index(spark: SparkSession, d: str) -> DataFrame:
    return resolve.name_index(table(spark, d, "part"), "p_partkey", "p_partkey", {"name": F.col("p_name"), "type": F.array(F.concat_ws(" ", "p_type", "p_name"), F.col("p_brand"))})


@query("multi_spelling_match", r"""
WITH i AS (SELECT trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) || ' subsp' AS name, min(p_partkey) AS key FROM part WHERE p_size % 2 = 0 GROUP BY 1
  UNION ALL SELECT trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), min(p_partkey) FROM part WHERE p_size % 2 = 1 GROUP BY 1),
r AS (SELECT p_partkey, p_partkey % 5 AS k, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS n FROM part),
h AS (SELECT r.*, key FROM r LEFT JOIN i ON i.name = CASE WHEN k IN (3, 4) THEN n || ' subsp' ELSE n END AND k <> 2)
SELECT p_partkey, key, CASE WHEN key IS NOT NULL THEN CASE k WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 3 THEN 2 ELSE 3 END END AS spelling FROM h
""")
def multi_spelling_match(spark: SparkSession, d: str) -> DataFrame:
    """Names with a hybrid sign, in capitals, with a word too many, with a short rank mark, and with both sign and mark."""
    part = table(spark, d, "part")
    name = F.when(F.col("p_size") % 2 == 0, F.concat("p_name", F.lit(" subsp."))).otherwise(F.col("p_name"))
    index = resolve.name_index(part, "p_partkey", "p_partkey", {"name": name})
    k, hybrid = F.col("p_partkey") % 5, F.replace("p_name", F.lit(" "), F.lit(" x "))
    n = F.when(k == 0, hybrid).when(k == 1, F.upper("p_name")).when(k == 2, F.concat("p_name", F.lit(" extra"))).when(k == 3, F.concat("p_name", F.lit(" ssp."))).otherwise(F.concat(hybrid, F.lit(" ssp.")))
    return resolve.match_spellings(part.select("p_partkey", n.alias("n")), "p_partkey", "n", index).select("p_partkey", "key", "spelling")


@query("unique_else_first", """
WITH u AS (SELECT p_name, min(p_partkey) AS k FROM part WHERE p_size > 40 GROUP BY 1 HAVING count(*) = 1), f AS (SELECT p_brand, min(p_partkey) AS k FROM part WHERE p_size > 40 GROUP BY 1)
SELECT p_partkey, coalesce(u.k, f.k) AS key, CASE WHEN u.k IS NOT NULL THEN 'unique' WHEN f.k IS NOT NULL THEN 'first' ELSE 'none' END AS via FROM part LEFT JOIN u USING (p_name) LEFT JOIN f USING (p_brand)
""")
def unique_else_first(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    return resolve.unique_else_first(part, "p_partkey", "p_name", "p_brand", part.where("p_size > 40"), "p_partkey", "p_name", "p_brand", "p_partkey")


@query("both_ways_names", """
WITH p AS (SELECT DISTINCT p_brand AS a, p_type AS b FROM part), l AS (SELECT a AS name, b AS o FROM p UNION SELECT b, a FROM p)
SELECT name, string_agg(o, '|' ORDER BY o) AS also FROM l WHERE name <> o GROUP BY 1
""")
def both_ways_names(spark: SparkSession, d: str) -> DataFrame:
    return resolve.both_ways(table(spark, d, "part").select("p_brand", "p_type").distinct(), "p_brand", "p_type").select("name", F.array_join("also", "|").alias("also"))


@query("direct_indicator", """
WITH v AS (SELECT p_name AS n, max(p_retailprice) AS v FROM part GROUP BY 1) SELECT p_partkey, v AS value FROM part LEFT JOIN v ON n = p_name
""")
def direct_indicator(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    rows = part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.translate("p_name", "aeo", "áèö")).otherwise(F.col("p_name")).alias("p_name"))
    return resolve.direct_values(rows, "p_partkey", "p_name", part.groupBy(F.col("p_name").alias("n")).agg(F.max("p_retailprice").alias("value")), "n", "value")


@query("synonym_bridge", r"""
WITH v AS (SELECT p_name AS n, max(p_size) AS v FROM part GROUP BY 1),
s AS (SELECT a.p_brand, b.p_name AS syn, a.head FROM (SELECT p_brand, min(p_name) AS head FROM part GROUP BY 1) a JOIN (SELECT DISTINCT p_brand, p_name FROM part) b USING (p_brand)),
h AS (SELECT p_brand, v FROM s JOIN v ON n = syn WHERE regexp_replace(split_part(syn, ' ', 2), '(us|um|a|is|e|os)$', '') = regexp_replace(split_part(head, ' ', 2), '(us|um|a|is|e|os)$', ''))
SELECT p_brand, CASE WHEN count(DISTINCT v) = 1 THEN max(v) END AS value, count(*) AS n_hits, count(DISTINCT v) = 1 AS agreed FROM h GROUP BY 1
""")
def synonym_bridge(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    values = part.groupBy(F.col("p_name").alias("n")).agg(F.max("p_size").alias("value"))
    rows = part.groupBy("p_brand").agg(F.min("p_name").alias("head"), F.collect_set("p_name").alias("syn"))
    return resolve.bridge_values(rows, "p_brand", "head", "syn", values, "n", "value")


@query("consensus_value", "SELECT o_custkey, CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN min(o_orderpriority) END AS o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def consensus_value(spark: SparkSession, d: str) -> DataFrame:
    return resolve.consensus(table(spark, d, "orders"), "o_custkey", "o_orderpriority")


@query("follow_accepted", """
WITH r AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 1 THEN p_partkey - 1 END AS a, p_name FROM part)
SELECT r.k AS original, coalesce(r.a, r.k) AS resolved, t.p_name FROM r LEFT JOIN r t ON t.k = coalesce(r.a, r.k)
""")
def follow_accepted(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").withColumn("a", F.when(F.col("p_partkey") % 4 == 1, F.col("p_partkey") - 1))
    return resolve.follow_accepted(rows, "p_partkey", "a", ["p_name"])


@query("wanted_subset", "SELECT c_custkey, min(o_orderkey) AS wanted_ord FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'P' GROUP BY 1")
def wanted_subset(spark: SparkSession, d: str) -> DataFrame:
    return resolve.wanted_subset(table(spark, d, "customer"), "c_custkey", table(spark, d, "orders").where("o_orderstatus = 'P'"), "o_custkey", "o_orderkey").select("c_custkey", "wanted_ord")


# Merging


@query("merge_sources", """
WITH a AS (SELECT c_nationkey AS k, string_agg(c_name, '|' ORDER BY c_custkey) AS l, min_by(c_name, c_custkey) AS f FROM customer GROUP BY 1),
b AS (SELECT s_nationkey AS k, string_agg(s_name, '|' ORDER BY s_suppkey) AS l, min_by(s_name, s_suppkey) AS f FROM supplier GROUP BY 1)
SELECT n_nationkey, a.l AS names_a, b.l AS names_b, coalesce(a.f, b.f) AS "primary", CASE WHEN a.f IS NOT NULL THEN 'a' WHEN b.f IS NOT NULL THEN 'b' END AS name_source
FROM nation LEFT JOIN a ON a.k = n_nationkey LEFT JOIN b ON b.k = n_nationkey
""")
def merge_sources(spark: SparkSession, d: str) -> DataFrame:
    names = lambda name, key, at, label: merge.append_lists(table(spark, d, name).select(F.col(key).alias("n_nationkey"), F.col(at).alias("o"), F.array(label).alias("names")), "n_nationkey", "names", "o")
    customers = table(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_custkey").cast("string").alias("src"), F.array("c_name").alias("names"), F.col("c_custkey").alias("o"))
    first = merge.grouped_names(customers.withColumn("src", F.concat(F.lit("c"), "src")), "n_nationkey", "src", "names", "o")
    out = merge.merge_names(table(spark, d, "nation"), "n_nationkey", first, "names", names("supplier", "s_nationkey", "s_suppkey", "s_name"), "names")
    return out.select("n_nationkey", F.array_join("names_a", "|").alias("names_a"), F.array_join("names_b", "|").alias("names_b"), "primary", "name_source")


@query("overlap_stats", """
WITH j AS (SELECT o.c AS c, a, b FROM (SELECT DISTINCT c_custkey AS c FROM customer) o
  LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS a FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) x ON x.o_custkey = c LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS b FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) y ON y.o_custkey = c)
SELECT count(a) AS from_a, count(b) AS from_b, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS both, count(*) FILTER (a IS NOT NULL OR b IS NOT NULL) AS either,
  count(*) FILTER (a IS NOT NULL AND b IS NULL) AS only_a, count(*) FILTER (b IS NOT NULL AND a IS NULL) AS only_b, count(*) FILTER (a <> b) AS differ FROM j
""")
def overlap_stats(spark: SparkSession, d: str) -> DataFrame:
    best = lambda status, name: table(spark, d, "orders").where(F.col("o_orderstatus") == status).groupBy("o_custkey").agg(F.min("o_orderpriority").alias(name))
    rows = merge.star(table(spark, d, "customer").select("c_custkey"), "c_custkey", (best("F", "a"), "o_custkey"), (best("O", "b"), "o_custkey"))
    return merge.overlap_statistics(rows, "a", "b")


@query("star_enrichment", """
SELECT l_orderkey, l_linenumber, p_name, s_name, n_name, r_name FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
""")
def star_enrichment(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    suppliers = merge.star(merge.star(t("supplier").select("s_suppkey", "s_name", "s_nationkey"), "s_nationkey", (t("nation"), "n_nationkey")), "n_regionkey", (t("region"), "r_regionkey"))
    rows = merge.star(t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_partkey", (t("part").select("p_partkey", "p_name"), "p_partkey"))
    return merge.star(rows, "l_suppkey", (suppliers, "s_suppkey")).select("l_orderkey", "l_linenumber", "p_name", "s_name", "n_name", "r_name")


@query("semi_join_selected", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def semi_join_selected(spark: SparkSession, d: str) -> DataFrame:
    return audit.rows_of_facet(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", table(spark, d, "orders"), "o_orderkey", F.col("o_orderstatus") == "P")


@query("inherit_parent", """
WITH c AS (SELECT p_partkey AS k, p_partkey - p_partkey % 10 AS parent, CASE WHEN p_partkey % 10 = 0 OR p_partkey % 3 = 0 THEN p_brand END AS brand FROM part)
SELECT c.k, coalesce(c.brand, q.brand) AS brand, c.brand IS NULL AND q.brand IS NOT NULL AS inherited FROM c LEFT JOIN c q ON q.k = c.parent
""")
def inherit_parent(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select(k.alias("k"), (k - k % 10).alias("parent"), F.when((k % 10 == 0) | (k % 3 == 0), F.col("p_brand")).alias("brand"))
    return merge.inherit(rows, "parent", rows, "k", ["brand"]).select("k", "brand", "inherited")


@query("fallback_source", """
SELECT o_custkey AS k, o_orderkey AS v, 'primary' AS source_of FROM orders WHERE o_orderstatus = 'F' UNION ALL
SELECT o_custkey, o_orderkey, 'secondary' FROM orders WHERE o_orderstatus = 'O' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
""")
def fallback_source(spark: SparkSession, d: str) -> DataFrame:
    of = lambda s: table(spark, d, "orders").where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    return merge.fallback_source(of("F"), of("O"), "k")


@query("enrich_missing", """
WITH p AS (SELECT o_custkey, min(o_orderpriority) AS p FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1),
r AS (SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, p) AS segment FROM customer LEFT JOIN p ON o_custkey = c_custkey)
SELECT c_custkey, segment, false AS still_missing FROM r UNION ALL SELECT c_custkey, NULL, true FROM r WHERE segment IS NULL
""")
def enrich_missing(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("segment"))
    filled, missing = merge.enrich_missing(rows, "c_custkey", "segment", table(spark, d, "orders").where("o_custkey % 3 <> 0"), "o_custkey", "o_orderpriority")
    return filled.withColumn("still_missing", F.lit(False)).unionByName(missing.select("c_custkey", F.lit(None).cast("string").alias("segment"), F.lit(True).alias("still_missing")))


@query("lookup_slice", """
SELECT c_custkey, coalesce(n, 0) AS n_related, l AS related FROM customer LEFT JOIN (SELECT o_custkey, max(n) AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY r) FILTER (r <= 10) AS l
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) GROUP BY 1) ON o_custkey = c_custkey
""")
def lookup_slice(spark: SparkSession, d: str) -> DataFrame:
    out = merge.lookup_slice(table(spark, d, "customer").select("c_custkey"), "c_custkey", table(spark, d, "orders"), "o_custkey", [F.desc("o_totalprice"), "o_orderkey"], ["o_orderkey"])
    return out.select("c_custkey", "n_related", F.array_join(F.transform("related", lambda x: x["o_orderkey"].cast("string")), ",").alias("related"))


@query("coverage_join", "SELECT count(*) AS n, count(*) FILTER (f) AS found, count(*) FILTER (NOT f) AS missing, round(100 * avg(f::INT), 1) AS share FROM (SELECT c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS f FROM customer)")
def coverage_join(spark: SparkSession, d: str) -> DataFrame:
    return merge.coverage(table(spark, d, "customer"), "c_custkey", table(spark, d, "orders").where("o_orderstatus = 'P'"), "o_custkey")[1]


@query("match_counts", "SELECT n_nationkey, count(*) AS n, count(o) AS matched, count(*) FILTER (o IS NOT NULL AND c_acctbal > 0) AS matched_named FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders) ON o = c_custkey GROUP BY 1")
def match_counts(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = merge.coverage(table(spark, d, "customer"), "c_custkey", table(spark, d, "orders"), "o_custkey")
    return rows.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"), F.count_if("found").alias("matched"), F.count_if(F.col("found") & (F.col("c_acctbal") > 0)).alias("matched_named"))


@query("dedupe_fill", """
WITH d AS (SELECT md5(text) AS k, doc_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS lang, source, doc_id % 3 = 0 AS flag FROM documents)
SELECT k, min(doc_id) AS doc_id, min_by(lang, doc_id) FILTER (lang IS NOT NULL) AS lang, min_by(source, doc_id) AS source, bool_or(flag) AS flag FROM d GROUP BY 1
""")
def dedupe_fill(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.md5("text").alias("k"), "doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("lang"), "source", (F.col("doc_id") % 3 == 0).alias("flag"))
    return merge.dedupe_fill(rows, "k", "doc_id", ["lang", "source"], ["flag"])


@query("exact_dedupe", "SELECT p_name, min(p_partkey) AS p_partkey, count(*) AS n_rows FROM part GROUP BY 1")
def exact_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return merge.first_rows(table(spark, d, "part"), "p_name", ["p_partkey"]).select("p_name", "p_partkey", "n_rows")


@query("entity_merge", """
WITH r AS (SELECT CASE WHEN p_size > 5 THEN p_size END AS e, p_partkey AS o, p_name AS n, p_type = 'PROMO' AS direct, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS b FROM part),
m AS (SELECT e, min(o) AS o, min_by(n, (CASE WHEN direct THEN 0 ELSE 1000000000 END) + o) AS n, list_sort(list(DISTINCT n)) AS a, min_by(b, (CASE WHEN direct THEN 0 ELSE 1000000000 END) + o) FILTER (b IS NOT NULL) AS b FROM r WHERE e IS NOT NULL GROUP BY 1)
SELECT e, o, n, b, array_to_string(list_filter(a, lambda x: x <> n), '|') AS also FROM m UNION ALL SELECT e, o, n, b, '' FROM r WHERE e IS NULL
""")
def entity_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.when(F.col("p_size") > 5, F.col("p_size")).alias("e"), F.col("p_partkey").alias("o"), F.col("p_name").alias("n"), "p_type", F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("b"))
    return merge.merge_entities(rows, "e", "o", F.col("p_type") == "PROMO", "n", ["b"]).withColumn("also", F.array_join("also", "|"))


@query("entity_groups", """
SELECT coalesce(CASE WHEN p_size > 5 THEN p_size::VARCHAR END, 'name:' || lower(p_name)) AS group_key, count(DISTINCT p_name || '/' || p_brand) AS n_names, array_to_string(list_sort(list(DISTINCT p_type)), '|') AS also, count(*) AS n FROM part GROUP BY 1
""")
def entity_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.when(F.col("p_size") > 5, F.col("p_size")).alias("e"), "p_name", "p_brand", F.array("p_type").alias("also"), "p_partkey")
    return merge.group_entities(rows, "e", "p_name", "p_brand", "also", "p_partkey").select("group_key", F.size("names").cast("bigint").alias("n_names"), F.array_join("also", "|").alias("also"), F.col("n").cast("bigint").alias("n"))


@query("preferred_pick", "SELECT p_brand, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_type <> 'PROMO', length(p_name), p_partkey) AS n FROM part) WHERE n = 1")
def preferred_pick(spark: SparkSession, d: str) -> DataFrame:
    return merge.preferred_pick(table(spark, d, "part"), "p_brand", "p_name", F.col("p_type") == "PROMO", "p_partkey")


@query("suffix_pick", "SELECT p_brand, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY NOT suffix(p_name, 'widget'), length(p_name), p_partkey) AS n FROM part) WHERE n = 1")
def suffix_pick(spark: SparkSession, d: str) -> DataFrame:
    return merge.suffix_pick(table(spark, d, "part"), "p_brand", "p_name", "widget", "p_partkey")


@query("distinct_dimension", "SELECT c_nationkey, min_by(c_mktsegment, c_custkey) AS c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1")
def distinct_dimension(spark: SparkSession, d: str) -> DataFrame:
    return merge.dedupe_fill(table(spark, d, "customer"), "c_nationkey", "c_custkey", ["c_mktsegment"]).select("c_nationkey", "c_mktsegment")


@query("single_parent", """
WITH k AS (SELECT l_partkey AS c, count(DISTINCT l_suppkey) AS n, bool_or(l_quantity > 45) AS ok FROM lineitem WHERE l_quantity > 40 GROUP BY 1)
SELECT c, n AS n_parents, CASE WHEN n > 1 THEN 'several parents' ELSE 'condition' END AS reason FROM k WHERE n > 1 OR NOT ok
""")
def single_parent(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_partkey").alias("c"), "l_suppkey", "l_quantity")
    return merge.single_parent(rows, "c", "l_suppkey", F.col("l_quantity") > 45)[1]


@query("priority_values", """
WITH v AS (SELECT p_brand, p_name AS v, p_size % 3 AS pr, p_partkey AS pos FROM part), o AS (SELECT *, row_number() OVER (PARTITION BY p_brand, lower(v) ORDER BY pr, pos) AS n FROM v)
SELECT p_brand, string_agg(v || ':' || pr, '|' ORDER BY pr, pos) AS "values" FROM o WHERE n = 1 GROUP BY 1
""")
def priority_values(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_brand", F.col("p_name").alias("v"), (F.col("p_size") % 3).alias("pr"), F.col("p_partkey").alias("pos"))
    return merge.priority_values(rows, "p_brand", "v", "pr", "pos").select("p_brand", F.array_join(F.transform("values", lambda x: F.concat_ws(":", x["value"], x["priority"].cast("string"))), "|").alias("values"))


@query("ranked_name_union", """
SELECT p_partkey, array_to_string(list_filter([a, b, c], lambda x: NOT regexp_matches(x, '[0-9]')), '|') AS names FROM (
  SELECT p_partkey, p_name AS a, CASE WHEN p_type = p_name THEN 'x1' ELSE p_type END AS b, p_brand AS c FROM part)
""")
def ranked_name_union(spark: SparkSession, d: str) -> DataFrame:
    names = merge.ranked_union(F.array("p_name"), F.array("p_type", "p_name"), F.array("p_brand"))
    return table(spark, d, "part").select("p_partkey", F.array_join(names, "|").alias("names"))


@query("first_acceptable", "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name WHEN p_retailprice > 950 THEN p_brand END AS value, CASE WHEN p_size > 25 THEN 'name' WHEN p_retailprice > 950 THEN 'brand' END AS source FROM part")
def first_acceptable(spark: SparkSession, d: str) -> DataFrame:
    pick = merge.first_acceptable((F.col("p_name"), F.col("p_size") > 25, "name"), (F.col("p_brand"), F.col("p_retailprice") > 950, "brand"))
    return table(spark, d, "part").select("p_partkey", pick.alias("x")).select("p_partkey", "x.value", "x.source")


@query("reconciliation", "SELECT (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS arrived, (SELECT count(*) FROM lineitem) AS n_rows, count(*) AS reported, count(*) - (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS difference, (SELECT count(*) - count(DISTINCT l_orderkey) FROM lineitem) AS repeated FROM orders")
def reconciliation(spark: SparkSession, d: str) -> DataFrame:
    return merge.reconcile(table(spark, d, "lineitem"), "l_orderkey", table(spark, d, "orders").withColumn("one", F.lit(1)), "one")


# Blocks, lines, orders


@query("block_sort", """
WITH r AS (SELECT c_nationkey AS g, o_custkey AS b, o_orderkey, o_totalprice AS w, o_orderstatus = 'P' AS f, o_orderpriority = '1-URGENT' AS h FROM orders JOIN customer ON c_custkey = o_custkey),
m AS (SELECT *, max(f) OVER p AS bf, max(w) OVER p AS bw FROM r WINDOW p AS (PARTITION BY g, b))
SELECT g, o_orderkey, row_number() OVER (PARTITION BY g ORDER BY bf DESC, bw DESC, b, h DESC, w DESC, o_orderkey) - 1 AS sort_index FROM m
""")
def block_sort(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_nationkey").alias("g"), F.col("o_custkey").alias("b"), "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return windows.block_sort(rows, "g", "b", F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus") == "P", "o_totalprice", "o_orderkey").select("g", "o_orderkey", "sort_index")


_LINES = "SELECT doc_id, u.i AS line, u.t AS t FROM (SELECT doc_id, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {'i': i - 1, 't': x})) AS u FROM documents)"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))


@query("record_segmentation", f"""
WITH l AS ({_LINES}), s AS (SELECT *, sum((length(t) > 60)::INT) OVER (PARTITION BY doc_id ORDER BY line)::BIGINT AS record FROM l)
SELECT doc_id, record, md5(string_agg(t, ' ' ORDER BY line)) AS h, count(*) AS n_lines FROM s GROUP BY 1, 2
""")
def record_segmentation(spark: SparkSession, d: str) -> DataFrame:
    return windows.segment_records(_lines(spark, d), "doc_id", "line", "t", F.length("t") > 60).select("doc_id", "record", F.md5("text").alias("h"), "n_lines")


@query("heading_fill", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS heading FROM conversations")
def heading_fill(spark: SparkSession, d: str) -> DataFrame:
    return windows.fill_heading(table(spark, d, "conversations"), "conv_id", "turn", F.when(F.col("role") == "user", F.col("turn"))).select("conv_id", "turn", "heading")


@query("neighbour_lines", f"""
WITH l AS ({_LINES}), k AS (SELECT * FROM l WHERE trim(t) <> '' OR length(t) > 60), w AS (SELECT *, lag(t) OVER p AS b, lead(t) OVER p AS a FROM k WINDOW p AS (PARTITION BY doc_id ORDER BY line))
SELECT doc_id, line, md5(b) AS before, md5(a) AS after FROM w WHERE length(t) > 60
""")
def neighbour_lines(spark: SparkSession, d: str) -> DataFrame:
    return windows.neighbour_records(_lines(spark, d), "doc_id", "line", "t", F.length("t") > 60, F.trim("t") == "").select("doc_id", "line", F.md5("before").alias("before"), F.md5("after").alias("after"))


@query("row_clusters", """
WITH RECURSIVE e AS (SELECT l_orderkey, l_quantity::DOUBLE AS y, l_extendedprice::DOUBLE AS x, l_linenumber::VARCHAR AS w, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_extendedprice) AS i FROM lineitem),
f AS (SELECT l_orderkey, i, x, w, y AS at, 0 AS "row" FROM e WHERE i = 1
  UNION ALL SELECT e.l_orderkey, e.i, e.x, e.w, CASE WHEN e.y - f.at > 4 THEN e.y ELSE f.at END, CASE WHEN e.y - f.at > 4 THEN f."row" + 1 ELSE f."row" END FROM f JOIN e ON e.l_orderkey = f.l_orderkey AND e.i = f.i + 1)
SELECT l_orderkey, "row", string_agg(w, ' ' ORDER BY x, w) AS text FROM f GROUP BY 1, 2
""")
def row_clusters(spark: SparkSession, d: str) -> DataFrame:
    return windows.cluster_rows(table(spark, d, "lineitem"), ["l_orderkey"], "l_quantity", "l_extendedprice", "l_linenumber", 4.0)


@query("column_edges", """
WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_orderkey * 8 + l_linenumber AS pos, max(l_quantity) AS x, max(l_returnflag) AS flag FROM lineitem GROUP BY 1, 2, 3),
h AS (SELECT l_suppkey, pos, [0, l_orderkey % 20, l_orderkey % 20 + l_linenumber * 3] AS e FROM r WHERE flag = 'R')
SELECT r.l_suppkey, r.l_orderkey, r.l_linenumber, len(list_filter(e, lambda v: v <= r.x + 3)) - 1 AS "column" FROM r ASOF JOIN h ON r.l_suppkey = h.l_suppkey AND r.pos >= h.pos
""")
def column_edges(spark: SparkSession, d: str) -> DataFrame:
    """Headers of varying edges; words before the first header of their document are left out."""
    rows = table(spark, d, "lineitem").groupBy("l_suppkey", "l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("x"), F.max("l_returnflag").alias("flag")).withColumn("pos", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    edges = F.when(F.col("flag") == "R", F.array(F.lit(0).cast("double"), (F.col("l_orderkey") % 20).cast("double"), (F.col("l_orderkey") % 20 + F.col("l_linenumber") * 3).cast("double")))
    first = rows.groupBy("l_suppkey").agg(F.min(F.when(F.col("flag") == "R", F.col("pos"))).alias("first"))
    placed = windows.assign_columns(rows.join(first, "l_suppkey").where("pos >= first"), ["l_suppkey"], "pos", "x", edges)
    return placed.select("l_suppkey", "l_orderkey", "l_linenumber", "column")


@query("continuations", """
WITH r AS (SELECT *, l_linestatus || CASE WHEN l_quantity > 25 THEN '-' ELSE '' END AS cell, sum((l_returnflag <> 'N')::INT) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)::BIGINT AS record FROM lineitem)
SELECT l_orderkey, record, replace(string_agg(cell, ' ' ORDER BY l_linenumber, cell), '- ', '-') AS l_linestatus FROM r GROUP BY 1, 2
""")
def continuations(spark: SparkSession, d: str) -> DataFrame:
    """Cells of which some end in a hyphen, where the next one follows without a blank."""
    rows = table(spark, d, "lineitem").withColumn("l_linestatus", F.concat("l_linestatus", F.when(F.col("l_quantity") > 25, "-").otherwise("")))
    return windows.merge_continuations(rows, "l_orderkey", "l_linenumber", F.col("l_returnflag") != "N", ["l_linestatus"])


@query("order_check", """
WITH w AS (SELECT o_custkey, o_orderpriority AS n, (o_orderstatus = 'F')::INT AS m, lag(o_orderpriority) OVER p AS pn, lag((o_orderstatus = 'F')::INT) OVER p AS pm FROM orders WINDOW p AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey, count(*) FILTER (pn > n AND pm = m) AS n_unsorted, count(*) FILTER (pm = 0 AND m = 1) AS n_matched_late FROM w GROUP BY 1
""")
def order_check(spark: SparkSession, d: str) -> DataFrame:
    return windows.order_breaks(table(spark, d, "orders"), "o_custkey", "o_orderkey", "o_orderpriority", F.col("o_orderstatus") == "F")


@query("top_by_measure", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_by_measure(spark: SparkSession, d: str) -> DataFrame:
    return windows.top_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 25)


@query("matched_first_sort", "SELECT n_nationkey, n_name, s FROM nation LEFT JOIN (SELECT s_nationkey, min(s_suppkey) AS s FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey")
def matched_first_sort(spark: SparkSession, d: str) -> DataFrame:
    first = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("s"))
    return windows.matched_first(merge.star(table(spark, d, "nation"), "n_nationkey", (first, "s_nationkey")), "s", "n_name").select("n_nationkey", "n_name", "s")


@query("category_sort", "SELECT p_partkey, list_position(['PROMO', 'SMALL', 'MEDIUM', 'LARGE', 'STANDARD', 'ECONOMY'], p_type)::BIGINT AS category_rank FROM part")
def category_sort(spark: SparkSession, d: str) -> DataFrame:
    return windows.category_order(table(spark, d, "part"), "p_type", ["PROMO", "SMALL", "MEDIUM", "LARGE", "STANDARD", "ECONOMY"], "p_partkey").select("p_partkey", F.col("category_rank").cast("bigint").alias("category_rank"))


@query("offset_page", "SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 40")
def offset_page(spark: SparkSession, d: str) -> DataFrame:
    return windows.page(table(spark, d, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"], 2, 20).select("doc_id")


@query("seeded_sample", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY md5(o_orderkey || '|7'), o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE n <= 4 AND m >= 4")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return windows.seeded_sample(table(spark, d, "orders"), "o_custkey", "o_orderkey", 4, 7).select("o_custkey", "o_orderkey")


@query("batch_ids", "SELECT o_orderkey, ((row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 12)::INT AS batch FROM orders")
def batch_ids(spark: SparkSession, d: str) -> DataFrame:
    return windows.batches(table(spark, d, "orders"), "o_orderpriority", "o_orderkey", 12).select("o_orderkey", "batch")


@query("budget_worklist", "SELECT l_orderkey, l_linenumber FROM (SELECT *, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber ROWS UNBOUNDED PRECEDING) AS r FROM lineitem) WHERE r <= 60")
def budget_worklist(spark: SparkSession, d: str) -> DataFrame:
    return windows.within_budget(table(spark, d, "lineitem"), "l_orderkey", [F.desc("l_extendedprice"), "l_linenumber"], "l_quantity", 60).select("l_orderkey", "l_linenumber")


# Over a whole table in one order


@query("whole_block_sort", """
WITH m AS (SELECT *, max(l_returnflag = 'R') OVER p AS bf, max(l_extendedprice) OVER p AS bw FROM lineitem WINDOW p AS (PARTITION BY l_partkey))
SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY bf DESC, bw DESC, l_partkey, (l_linenumber = 1) DESC, l_extendedprice DESC, l_orderkey * 8 + l_linenumber) - 1 AS sort_index FROM m
""")
def whole_block_sort(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("name"))
    return order.whole_block_sort(rows, "l_partkey", F.col("l_linenumber") == 1, F.col("l_returnflag") == "R", "l_extendedprice", "name").select("l_orderkey", "l_linenumber", "sort_index")


@query("whole_batches", "SELECT l_orderkey, l_linenumber, (row_number() OVER (ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) - 1) // 60 AS batch FROM lineitem")
def whole_batches(spark: SparkSession, d: str) -> DataFrame:
    return order.whole_batches(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), [F.desc("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber")], 60).select("l_orderkey", "l_linenumber", "batch")


@query("whole_budget", """
SELECT l_orderkey, l_linenumber, r::DOUBLE AS running FROM (SELECT *, sum(l_quantity) OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING) AS r FROM lineitem)
WHERE r <= (SELECT sum(l_quantity) / 2 FROM lineitem)
""")
def whole_budget(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    half = rows.agg(F.sum("l_quantity") / 2).first()[0]
    return order.whole_budget(rows, [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], "l_quantity", half).select("l_orderkey", "l_linenumber", "running")


# Sets and audits


@query("delta_keys", "SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= '1998-01-01' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < '1998-01-01')")
def delta_keys(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return audit.delta(orders.where("o_orderdate >= '1998-01-01'").select("o_custkey").distinct(), orders.where("o_orderdate < '1998-01-01'"), ["o_custkey"])


@query("heterogeneous_union", "SELECT s_suppkey AS key, s_name AS name, NULL AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def heterogeneous_union(spark: SparkSession, d: str) -> DataFrame:
    return sinks.append_rows(table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")))


@query("required_members", "SELECT * FROM (VALUES ('PROMO'), ('GIANT'), ('SMALL'), ('TINY')) v(p_type) WHERE p_type NOT IN (SELECT p_type FROM part)")
def required_members(spark: SparkSession, d: str) -> DataFrame:
    return audit.missing_required(table(spark, d, "part"), "p_type", ["PROMO", "GIANT", "SMALL", "TINY"])


@query("orphan_check", "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders)")
def orphan_check(spark: SparkSession, d: str) -> DataFrame:
    return audit.orphans(table(spark, d, "events"), "user_id", table(spark, d, "orders"), "o_custkey").select("user_id").distinct()


@query("referential_cleanup", """
SELECT 'customer' AS side, c_custkey AS key FROM customer WHERE c_acctbal > 0 AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 'order', o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def referential_cleanup(spark: SparkSession, d: str) -> DataFrame:
    a, b = audit.mutual(table(spark, d, "customer").where("c_acctbal > 0"), "c_custkey", table(spark, d, "orders").where("o_orderstatus = 'F'"), "o_custkey")
    return a.select(F.lit("customer").alias("side"), F.col("c_custkey").alias("key")).unionByName(b.select(F.lit("order").alias("side"), F.col("o_orderkey").alias("key")))


@query("missing_subset", "SELECT source, count(*) AS n, count(*) FILTER (q IS NULL) AS n_missing, round(100 * avg((q IS NULL)::INT), 1) AS share_missing FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY 1) USING (doc_id) GROUP BY 1")
def missing_subset(spark: SparkSession, d: str) -> DataFrame:
    quality = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    return audit.missing_by(table(spark, d, "documents").select("doc_id", "source").join(quality, "doc_id", "left"), F.col("q").isNotNull(), "source")


@query("expected_vs_arrived", """
WITH e AS (SELECT p_partkey AS k, p_size < 10 AS x FROM part), a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 45)
SELECT k, count(*) AS n, CASE WHEN bool_or(NOT x) THEN 'missing' ELSE 'excused' END AS reason FROM e WHERE k NOT IN (SELECT k FROM a) GROUP BY 1
""")
def expected_vs_arrived(spark: SparkSession, d: str) -> DataFrame:
    expected = table(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_size")
    arrived = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("k"))
    return audit.expected_versus_arrived(expected, arrived, "k", F.col("p_size") < 10)[0]


@query("override_merge", """
WITH a AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 4 <> 0), m AS (SELECT c_custkey AS k, 'MANUAL' AS v FROM customer WHERE c_custkey % 6 = 0)
SELECT coalesce(a.k, m.k) AS k, coalesce(m.v, a.v) AS v, CASE WHEN m.k IS NULL THEN 'kept' WHEN a.k IS NULL THEN 'added' ELSE 'adjusted' END AS state FROM a FULL JOIN m ON a.k = m.k
""")
def override_merge(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    return audit.override(c.where("k % 4 <> 0"), c.where("k % 6 = 0").withColumn("v", F.lit("MANUAL")), "k", ["v"])


@query("override_report", """
WITH c AS (SELECT c_custkey AS k, c_acctbal AS v FROM customer), m AS (SELECT user_id AS k, value AS v FROM events)
SELECT 'repeated key' AS rule, count(*) AS n FROM (SELECT k FROM m GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'missing field', count(*) FROM m WHERE v IS NULL UNION ALL SELECT 'unknown key', count(*) FROM m WHERE k NOT IN (SELECT k FROM c)
UNION ALL SELECT 'adjusted', count(*) FROM m JOIN c USING (k) WHERE m.v <> c.v UNION ALL SELECT 'added', count(DISTINCT k) FROM m WHERE k NOT IN (SELECT k FROM c) UNION ALL SELECT 'conflicting', count(*) FROM (SELECT k FROM m GROUP BY 1 HAVING count(DISTINCT v) > 1)
""")
def override_report(spark: SparkSession, d: str) -> DataFrame:
    return audit.override_report(table(spark, d, "events"), table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value")), "user_id", ["value"])


@query("combined_sources", """
WITH u AS (SELECT o_custkey AS k, o_orderkey AS v, 'first' AS provenance, 0 AS p FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT c_custkey, c_nationkey, 'second', 1 FROM customer WHERE c_acctbal > 0)
SELECT k, provenance FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p) AS n FROM u) WHERE n = 1
""")
def combined_sources(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").withColumn("k", F.col("o_custkey"))
    b = table(spark, d, "customer").withColumn("k", F.col("c_custkey"))
    return audit.combined_sources({"first": a, "second": b}, {"first": F.col("o_orderstatus") == "F", "second": F.col("c_acctbal") > 0}, "k", ["k"])


@query("rule_report", """
WITH r AS (SELECT o_orderpriority AS g, 'error' AS severity, 'no customer' AS rule, count(*) FILTER (o_custkey IS NULL) AS n FROM orders GROUP BY 1 UNION ALL SELECT o_orderpriority, 'warning', 'dear', count(*) FILTER (o_totalprice > 400000) FROM orders GROUP BY 1) SELECT * FROM r WHERE n > 0
""")
def rule_report(spark: SparkSession, d: str) -> DataFrame:
    return audit.rule_report(table(spark, d, "orders").withColumnRenamed("o_orderpriority", "g"), "g", {"no customer": ("error", F.col("o_custkey").isNull()), "dear": ("warning", F.col("o_totalprice") > 400000)})


@query("resolution_report", """
SELECT c_mktsegment AS g, via AS path, count(*) AS n, count(*) FILTER (o IS NOT NULL) AS n_resolved, grouping(c_mktsegment, via)::BIGINT AS level, round(100 * count(*) FILTER (o IS NOT NULL) / count(*), 1) AS share
FROM (SELECT c_mktsegment, o, CASE WHEN o IS NULL THEN 'none' ELSE 'direct' END AS via FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS o FROM orders) ON o = c_custkey) GROUP BY ROLLUP (c_mktsegment, via)
""")
def resolution_report(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("o")).distinct()
    rows = table(spark, d, "customer").join(orders, F.col("o") == F.col("c_custkey"), "left").withColumns({"g": F.col("c_mktsegment"), "path": F.when(F.col("o").isNull(), "none").otherwise("direct")})
    return audit.resolution_report(rows, "g", F.col("o").isNotNull(), "path")


@query("alias_audit", "SELECT p_partkey, p_type FROM part WHERE NOT contains(regexp_replace(lower(p_name || p_brand), '[^a-z0-9]', '', 'g'), regexp_replace(lower(p_type), '[^a-z0-9]', '', 'g'))")
def alias_audit(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    terms = part.select(F.col("p_partkey").alias("k"), T.squash(F.concat("p_name", "p_brand")).alias("term"))
    return audit.unsearchable(part, "p_partkey", "p_type", terms, "k", "term")


@query("before_and_after", """
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < '1998-01-01'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= '1998-01-01')
SELECT count(*) FILTER (a.k IS NULL) AS gained, count(*) FILTER (b.k IS NULL) AS lost, count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS kept, count(*) FILTER (a.k IS NULL) - count(*) FILTER (b.k IS NULL) AS net FROM a FULL JOIN b ON a.k = b.k
""")
def before_and_after(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return audit.before_and_after(o.where("o_orderdate < '1998-01-01'"), o.where("o_orderdate >= '1998-01-01'"), "o_custkey")


@query("mark_and_sweep", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' OR (SELECT count(*) FILTER (o_orderstatus = 'F') < 0.7 * count(*) FILTER (o_orderstatus IN ('F', 'O')) FROM orders)")
def mark_and_sweep(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return audit.sweep(o, "o_orderstatus", "F", o.where("o_orderstatus IN ('F', 'O')").withColumn("one", F.lit(1)), "one").select("o_orderkey")


@query("prune_classes", """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN 'move' WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'deactivate' ELSE 'delete' END AS action, CASE WHEN c_custkey % 10 = 3 THEN c_custkey - 3 END AS moved_to FROM customer WHERE c_acctbal <= 0
""")
def prune_classes(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    renamed = c.where("c_custkey % 10 = 3").select(F.col("c_custkey").alias("old"), (F.col("c_custkey") - 3).alias("new"))
    return audit.prune_classes(c, "c_custkey", c.where("c_acctbal > 0"), "c_custkey", renamed, "old", "new", table(spark, d, "orders"), "o_custkey")


@query("category_counts", """
WITH g AS (SELECT p_type, p_name, max(CASE WHEN p_size % 4 = 0 THEN '  ' ELSE p_brand END) AS b FROM part GROUP BY 1, 2) SELECT p_type, count(*) AS n, count(*) FILTER (trim(b) = '') AS n_blank FROM g GROUP BY 1
""")
def category_counts(spark: SparkSession, d: str) -> DataFrame:
    return audit.category_counts(table(spark, d, "part").withColumn("b", F.when(F.col("p_size") % 4 == 0, F.lit("  ")).otherwise(F.col("p_brand"))), "p_type", "p_name", "b")


# Indicators


@query("zone_classify", "SELECT s_suppkey, CASE WHEN s_acctbal < 1000 THEN 'low' WHEN s_acctbal <= 6000 THEN 'middle' ELSE 'high' END AS zone FROM supplier")
def zone_classify(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").withColumn("factor", F.lit("balance"))
    cuts = s.groupBy("factor").agg(F.lit(1000.0).alias("low"), F.lit(6000.0).alias("high"))
    return indicators.classify_zones(s, "factor", "s_acctbal", cuts, ("low", "middle", "high")).select("s_suppkey", "zone")


@query("band_overlap", """
WITH b AS (SELECT p_partkey, greatest(p_size / 5.0 - 1.52, 0) AS a, least(p_size / 5.0 + 1.52, 10) AS b, greatest(p_retailprice % 10 - 1, 0) AS c, least(p_retailprice % 10 + 1, 10) AS d FROM part)
SELECT p_partkey, round(greatest(least(b, d) - greatest(a, c), 0) / ((b - a) + (d - c) - greatest(least(b, d) - greatest(a, c), 0)), 4) AS overlap FROM b
""")
def band_overlap(spark: SparkSession, d: str) -> DataFrame:
    o = indicators.band_overlap(F.col("p_size") / 5.0, F.lit(3.04), F.col("p_retailprice") % 10, F.lit(2.0))
    return table(spark, d, "part").select("p_partkey", F.round(o, 4).alias("overlap"))


@query("pair_distance", "SELECT a.s_nationkey, least(a.s_suppkey, b.s_suppkey) AS a, greatest(a.s_suppkey, b.s_suppkey) AS b, round(abs(a.s_acctbal - b.s_acctbal), 2) AS distance FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey WHERE abs(a.s_acctbal - b.s_acctbal) >= 5000")
def pair_distance(spark: SparkSession, d: str) -> DataFrame:
    return indicators.distant_pairs(table(spark, d, "supplier"), "s_nationkey", "s_suppkey", "s_acctbal", 5000).withColumn("distance", F.round("distance", 2))


@query("order_gaps", """
WITH r AS (SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) // 86400000000 AS day FROM orders),
p AS (SELECT a.o_custkey, a.o_orderkey, b.o_orderkey AS partner, abs(a.day - b.day) AS d,
  row_number() OVER (PARTITION BY a.o_custkey, a.o_orderkey ORDER BY abs(a.day - b.day), b.day < a.day, CASE WHEN b.day < a.day THEN -b.o_orderkey ELSE b.o_orderkey END) AS nth
  FROM r a JOIN r b ON a.o_custkey = b.o_custkey AND abs(a.day - b.day) >= 30)
SELECT o_custkey, o_orderkey, nth::INT AS nth, partner, d AS distance FROM p WHERE nth <= 2
""")
def order_gaps(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").withColumn("day", F.floor(F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 86_400_000_000).cast("long"))
    return indicators.distant_partners(rows, "o_custkey", "o_orderkey", "day", F.lit(30), 2)


@query("corr_matrix", """
SELECT 'l_quantity' AS x, 'l_extendedprice' AS y, round(corr(l_quantity, l_extendedprice), 6) AS r, count(*) AS n FROM lineitem UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6), count(*) FROM lineitem
UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6), count(*) FROM lineitem
""")
def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    return indicators.correlation_matrix(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]).withColumn("r", F.round("r", 6))


@query("support_share", "SELECT p_type, (p_size >= 10)::INT + (p_size >= 30)::INT AS bucket, count(*) AS n, round(avg((p_size >= 20)::INT), 6) AS share_supported, round(median(p_retailprice), 3) AS median_width FROM part GROUP BY 1, 2")
def support_share(spark: SparkSession, d: str) -> DataFrame:
    out = indicators.support_shares(table(spark, d, "part"), "p_type", "p_size", "p_retailprice", 20, [10, 30])
    return out.withColumns({"share_supported": F.round("share_supported", 6), "median_width": F.round("median_width", 3)})


@query("support_medians", """
WITH r AS (SELECT l_returnflag, (l_quantity >= 10)::INT + (l_quantity >= 30)::INT AS bucket, round(l_extendedprice / 0.01)::BIGINT AS v FROM lineitem),
m AS (SELECT l_returnflag, bucket, count(*) AS n, quantile_disc(v, 0.5) AS v, quantile_disc(v, 0.9) AS top FROM r GROUP BY 1, 2)
SELECT l_returnflag, bucket, n, round(((v >> greatest(length(bin(v)) - 8, 0)) << greatest(length(bin(v)) - 8, 0)) * 0.01::DOUBLE, 2) AS median,
  round(((top >> greatest(length(bin(top)) - 8, 0)) << greatest(length(bin(top)) - 8, 0)) * 0.01::DOUBLE, 2) AS ninth FROM m
""")
def support_medians(spark: SparkSession, d: str) -> DataFrame:
    rows, keys = table(spark, d, "lineitem"), ["l_returnflag", "bucket"]
    some = lambda n: indicators.support_sketches(rows.where(F.col("l_linenumber") % 2 == n), "l_returnflag", "l_quantity", "l_extendedprice", [10, 30], 0.01)
    both = written(indicators.merge_sketches(some(0), some(1), keys), "sketches")
    medians, ninths = (indicators.sketch_quantile(both, keys, q, 0.01).withColumn("quantile", F.round("quantile", 2)).withColumnRenamed("quantile", name) for q, name in ((0.5, "median"), (0.9, "ninth")))
    return both.groupBy(*keys).agg(F.sum("n").alias("n")).join(medians, keys).join(ninths, keys)


_CODES = "(VALUES (1, 'one'), (2, 'two'), (4, 'four'), (8, 'eight'), (16, 'sixteen'), (32, 'thirtytwo'))"


@query("bitmask_decode", f"SELECT p_partkey, coalesce(string_agg(l, '|' ORDER BY l), '') AS labels FROM part LEFT JOIN {_CODES} c(b, l) ON (p_size & b) <> 0 GROUP BY 1")
def bitmask_decode(spark: SparkSession, d: str) -> DataFrame:
    codes = spark.sql(f"SELECT * FROM VALUES {_CODES[8:-1]} AS c(b, l)")
    return indicators.decode_mask(table(spark, d, "part"), "p_size", codes, "b", "l", "p_partkey").withColumn("labels", F.array_join("labels", "|"))


@query("enum_decode", "SELECT user_id, value, CASE (event_id % 4) WHEN 0 THEN 'none' WHEN 1 THEN 'some' WHEN 2 THEN 'many' END AS label FROM events")
def enum_decode(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("e", F.col("event_id") % 4).select("user_id", "value", indicators.decode_enum("e", {0: "none", 1: "some", 2: "many"}, none=3).alias("label"))


# Texts and search

_SQUASH = r"trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
_UMLAUT = "replace(replace(replace(replace(replace(replace(replace({}, 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'Ä', 'Ae'), 'Ö', 'Oe'), 'Ü', 'Ue'), 'ß', 'ss')"
_HYBRID = r"regexp_replace({}, '(^|\s)[x×](\s)', ' \2', 'g')"


@query("search_index", f"""
WITH h AS (SELECT doc_id, {_HYBRID.format('text')} AS s FROM documents),
v AS (SELECT doc_id, {_SQUASH.format('strip_accents(' + _UMLAUT.format('s') + ')')} AS a, {_SQUASH.format("strip_accents(replace(s, 'ß', 'ss'))")} AS b FROM h)
SELECT doc_id, md5(array_to_string(list_filter(CASE WHEN a = b THEN [a] ELSE [a, b] END, lambda x: x <> ''), '|')) AS terms FROM v
""")
def search_index(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(F.array_join(T.search_index(F.array("text")), "|")).alias("terms"))


@query("search_rank", """
WITH c AS (SELECT p_partkey AS key, p_retailprice AS w, CASE WHEN n = 'ring' THEN 0 WHEN list_contains(ws, 'ring') THEN 1 WHEN len(list_filter(ws, lambda x: suffix(x, 'ring'))) > 0 THEN 2 WHEN len(list_filter(ws, lambda x: prefix(x, 'ring'))) > 0 THEN 3 WHEN contains(n, 'ring') THEN 4 END AS class
  FROM (SELECT *, lower(p_name) AS n, string_split(lower(p_name), ' ') AS ws FROM part))
SELECT key, class, w FROM c WHERE class IS NOT NULL
""")
def search_rank(spark: SparkSession, d: str) -> DataFrame:
    index = table(spark, d, "part").select(F.col("p_partkey").alias("key"), T.search_index(F.array("p_name")).alias("names"), F.col("p_retailprice").alias("w"))
    return lists.ranked_search(index, "key", "names", "w", "Ring")


@query("substring_search", "SELECT p_partkey FROM part WHERE contains(replace(lower(p_name), ' ', ''), 'ewid')")
def substring_search(spark: SparkSession, d: str) -> DataFrame:
    terms = table(spark, d, "part").select("p_partkey", F.explode(T.glued(T.search_index(F.array("p_name")))).alias("t"))
    index = search.substring_index(terms, "p_partkey", F.col("t"))
    asked = spark.range(1).select(F.lit(1).alias("query"), F.explode(T.search_variants(F.lit("E Wid"), gaps=False)).alias("part"))
    return search.search_substrings(index, asked).select(F.col("key").alias("p_partkey"))


_GLUED = "replace(lower(p_name), ' ', '')"


@query("substring_index", f"""
WITH t AS (SELECT p_partkey, {_GLUED} AS t FROM part), q AS (SELECT p_partkey AS query, substr(t, 1 + p_partkey % 7, 1 + p_partkey // 50 % 6) AS part FROM t WHERE p_partkey % 50 = 0)
SELECT query, p_partkey AS key FROM q JOIN t ON contains(t, part) WHERE part <> ''
""")
def substring_index(spark: SparkSession, d: str) -> DataFrame:
    terms = table(spark, d, "part").select("p_partkey", F.expr(_GLUED).alias("t"))
    asked = terms.where("p_partkey % 50 = 0").select(F.col("p_partkey").alias("query"), F.expr("substr(t, 1 + p_partkey % 7, 1 + p_partkey div 50 % 6)").alias("part"))
    return search.search_substrings(search.substring_index(terms, "p_partkey", F.col("t")), asked)


@query("fulltext_weighted", """
SELECT p_partkey AS key, score FROM (SELECT p_partkey, 10.0 * len(list_filter(string_split(lower(p_name), ' '), lambda w: w IN ('red', 'promo'))) + 5.0 * len(list_filter(string_split(lower(p_type), ' '), lambda w: w IN ('red', 'promo'))) AS score FROM part) WHERE score > 0
""")
def fulltext_weighted(spark: SparkSession, d: str) -> DataFrame:
    asked = spark.range(1).select(F.lit(1).alias("query"), F.lit("red promo").alias("text"))
    return search.search_words(search.word_index(table(spark, d, "part"), "p_partkey", {"p_name": 10, "p_type": 5, "p_brand": 1}), asked).select("key", "score")


@query("fulltext_index", """
WITH w AS (SELECT p_partkey AS key, unnest(list_transform(string_split(lower(p_name), ' '), lambda x: {'w': x, 'n': 10.0})) AS f FROM part UNION ALL SELECT p_partkey, {'w': lower(p_type), 'n': 5.0} FROM part),
q AS (SELECT DISTINCT p_partkey AS query, unnest([lower(split_part(p_name, ' ', 1)), lower(p_type)]) AS w FROM part WHERE p_partkey % 20 = 0)
SELECT query, key, sum(f.n)::DOUBLE AS score FROM q JOIN w ON w.f.w = q.w GROUP BY 1, 2
""")
def fulltext_index(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    asked = part.where("p_partkey % 20 = 0").select(F.col("p_partkey").alias("query"), F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(1)), "p_type").alias("text"))
    return search.search_words(search.word_index(part, "p_partkey", {"p_name": 10, "p_type": 5}), asked)


@query("html_text", r"SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '[\s\x{A0}\x{0B}\x{1C}-\x{1F}\x{85}]+', ' ', 'g'))) AS text FROM pages")
def html_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.md5(T.plain_text("html")).alias("text"))


@query("url_facets", r"""
SELECT page_id, try_cast(nullif(regexp_extract(url, '/en/([0-9]+)(?:[/?#]|$)', 1), '') AS BIGINT) AS key, coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), nullif(regexp_extract(url, '/([^/?#]+)/?(?:[?#].*)?$', 1), '')) AS part FROM pages
""")
def url_facets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", readers.key_from_url("url", "en").alias("key"), T.query_parameter("url", "page").alias("part"))


@query("hashed_paths", r"SELECT p_partkey, 'base/' || md5(replace(p_name, ' ', '_'))[1:1] || '/' || md5(replace(p_name, ' ', '_'))[1:2] || '/' || replace(p_name, ' ', '_') AS path FROM part")
def hashed_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", T.hashed_path("p_name", "base").alias("path"))


_LICENCES = {
    "https://creativecommons.org/licenses/by-sa/4.0/": "cc-by-sa", "http://CreativeCommons.org/licenses/by-nc/4.0/legalcode": "cc-by-nc", "https://creativecommons.org/licenses/zero/1.0": "cc-zero", "CC BY-SA 2.0": "cc-by-sa",
    "CC BY SA 4.0": "cc-by-sa", "cc by": "cc-by", "cc-by-4.0": "cc-by-4.0", "CC-BY": "cc-by", "CC0 1.0": "CC0 1.0", "https://creativecommons.org/publicdomain/zero/1.0/": "cc-0", "Public domain": "Public domain",
}


@query("licence_names", "SELECT o_orderkey, CASE o_orderkey % 13 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(_LICENCES.values())) + " WHEN 11 THEN NULL ELSE o_orderpriority END AS licence FROM orders")
def licence_names(spark: SparkSession, d: str) -> DataFrame:
    raw = F.get(F.array(*map(F.lit, _LICENCES), F.lit("")), (F.col("o_orderkey") % 13).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", T.normal_licence(F.coalesce(raw, "o_orderpriority")).alias("licence"))


@query("sort_keys", "SELECT doc_id, md5(lower(strip_accents(replace(text, 'ß', 'ss')))) AS key FROM documents")
def sort_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(T.german_sort_key("text")).alias("key"))


@query("parent_completion", """
WITH r AS (SELECT p_partkey AS o, p_brand AS g, p_name AS w, p_type AS kind, p_size > 25 AS f FROM part), k AS (SELECT g, w, min(o) AS o, min_by(kind, o) AS kind, bool_or(f) AS f FROM r GROUP BY 1, 2)
SELECT g, o, w || ' ''Sort' || o || '''' AS name, w AS parent, f, false AS added FROM r UNION ALL SELECT g, o, w, NULL, f, true FROM k
""")
def parent_completion(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("o"), F.col("p_brand").alias("g"), F.concat("p_name", F.lit(" 'Sort"), F.col("p_partkey").cast("string"), F.lit("'")).alias("name"), F.col("p_type").alias("kind"), (F.col("p_size") > 25).alias("f"))
    return lists.complete_parents(rows, "g", "name", "o", "f", ["kind"]).select("g", "o", "name", "parent", "f", "added")


@query("row_rules", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' ''Gold''' ELSE p_name END AS name, CASE p_partkey % 3 WHEN 0 THEN 'cultivar' ELSE 'species' END AS rank, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS parent FROM part")
def row_rules(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    rows = table(spark, d, "part").withColumn("n", F.when(k == 0, F.concat("p_name", F.lit(" 'Gold'"))).when(k == 1, F.concat("p_name", F.lit("  'Sorte'"))).otherwise(F.col("p_name")))
    return rows.select("p_partkey", lists.expand_row("n").alias("x")).select("p_partkey", "x.name", "x.rank", "x.parent")


@query("rank_and_strip", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'subspecies' WHEN 1 THEN 'hybrid' END AS rank, CASE p_partkey % 3 WHEN 0 THEN p_name || ' subsp. alba' WHEN 1 THEN p_name || ' × minor' ELSE p_name END AS stripped FROM part")
def rank_and_strip(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    name = F.concat("p_name", F.when(k == 0, " subsp. alba (L.) Mill.").when(k == 1, " × minor Ehrh.").otherwise(" Schleich. ex DC."))
    return table(spark, d, "part").select("p_partkey", T.rank_of(name).alias("rank"), T.strip_authorship(name).alias("stripped"))


@query("organ_of_file", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'leaf' END AS organ, CASE p_partkey % 4 WHEN 0 THEN 'clear' WHEN 1 THEN 'circumstance' WHEN 2 THEN 'no organ' ELSE 'ambiguous' END AS reason FROM part")
def organ_of_file(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    rows = table(spark, d, "part").withColumn("taxon", F.concat(F.lit("Plantago "), F.col("p_brand"))).withColumn("file", F.concat("taxon", F.when(k == 0, " - feuilles.JPG").when(k == 1, " leaf in snow.jpg").when(k == 2, " 01.png").otherwise(" leaf and flower.jpg")))
    return lists.organ_of_file(rows, "p_partkey", "file", "taxon")


# Readers, writers and streams


@query("json_flatten", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def json_flatten(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "events-json")
    sinks.write_json(table(spark, d, "events").select("event_id", F.from_json("props", "k BIGINT").alias("props")), path)
    return readers.read_ndjson(spark, path, "event_id BIGINT, props STRUCT<k: BIGINT>").select("event_id", "props.k")


@query("tolerant_read", "SELECT event_id % 10 = 0 AS bad, CASE WHEN event_id % 10 <> 0 THEN event_id END AS event_id, CASE WHEN event_id % 10 = 0 THEN '{broken ' || event_id END AS line FROM events")
def tolerant_read(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "events-lines")
    line = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{broken "), F.col("event_id").cast("string"))).otherwise(F.to_json(F.struct("event_id")))
    table(spark, d, "events").select(line.alias("value")).write.text(path)
    good, bad = readers.read_ndjson_tolerant(spark, path, "event_id BIGINT")
    return good.select(F.lit(False).alias("bad"), "event_id", F.lit(None).cast("string").alias("line")).unionByName(bad.select(F.lit(True).alias("bad"), F.lit(None).cast("bigint").alias("event_id"), "line"))


@query("nested_entries", "SELECT o_orderkey, l_linenumber, (l_extendedprice * 100)::BIGINT AS cents FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def nested_entries(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))).alias("entries"))
    orders = table(spark, d, "orders").select("o_orderkey").join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(F.array(F.struct("o_orderkey", "entries")).alias("groups"))
    return readers.explode_entries(orders, "groups", "entries").select("o_orderkey", "l_linenumber", "cents")


@query("lists_by_folder", "SELECT p_type AS list, count(DISTINCT p_name) AS n, min(p_partkey) AS first FROM part GROUP BY 1")
def lists_by_folder(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "lists")
    sinks.write_by_group(table(spark, d, "part").select("p_partkey", "p_name", "p_type"), path, "p_type", "p_name", ["p_partkey"])
    rows = readers.read_dir_lists(spark, path, "p_partkey BIGINT, p_name STRING", "*.json", folder="p_type")
    return rows.groupBy("list").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first"))


@query("failure_lines", "SELECT o_orderkey AS key, o_orderpriority AS name, o_orderstatus AS error FROM orders WHERE o_orderkey % 3 <> 0")
def failure_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "failures")
    key = F.when(F.col("o_orderkey") % 3 == 0, "none").otherwise(F.col("o_orderkey").cast("string"))
    table(spark, d, "orders").select(F.concat_ws("\t", key, "o_orderpriority", "o_orderstatus").alias("value")).write.text(path)
    readers.require_inputs(spark, path)
    return readers.read_failures(spark, path)


@query("image_groups", "SELECT user_id, event_type AS organ, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS n FROM events) WHERE n <= 2")
def image_groups(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.sort_array(F.collect_list(F.struct("event_id", F.col("value").alias("votes")))).alias("l"))
    pages = e.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "l"))).alias("images"))
    return readers.flatten_image_groups(pages, "user_id", "images", 2).select("user_id", "organ", "event_id")


@query("fold_bindings", "SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS priorities, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus, bool_or(o_totalprice > 300000) AS flag FROM orders GROUP BY 1")
def fold_bindings(spark: SparkSession, d: str) -> DataFrame:
    out = readers.fold_bindings(table(spark, d, "orders"), "o_custkey", ["o_orderpriority"], ["o_orderstatus"], "o_orderkey", F.col("o_totalprice") > 300000)
    return out.select("o_custkey", F.array_join("o_orderpriority", "|").alias("priorities"), "o_orderstatus", "flag")


@query("language_pages", """
WITH b AS (SELECT p_brand, p_type, min_by(p_name, p_partkey) AS n, min(p_partkey) AS f, count(*) AS c FROM part GROUP BY 1, 2)
SELECT p_brand, string_agg(p_type || '=' || n, '|' ORDER BY p_type) AS names, min(f) AS first_page, sum(c - 1)::BIGINT AS n_again FROM b GROUP BY 1
""")
def language_pages(spark: SparkSession, d: str) -> DataFrame:
    out = readers.upsert_language_pages(table(spark, d, "part"), ["p_brand"], "p_type", "p_name", "p_partkey")
    text = F.array_join(F.transform(F.map_entries("names_by_language"), lambda e: F.concat_ws("=", e["key"], e["value"])), "|")
    return out.select("p_brand", text.alias("names"), "first_page", "n_again")


@query("page_images", r"""
SELECT page_id, CASE WHEN page_id % 7 = 1 THEN 'CC BY' ELSE 'CC BY-SA' END AS licence, nullif(trim(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '[\s\x{A0}\x{0B}\x{1C}-\x{1F}\x{85}]+', ' ', 'g')), '') AS text
FROM pages WHERE page_id % 6 NOT IN (4, 5) AND page_id % 7 IN (1, 2)
""")
def page_images(spark: SparkSession, d: str) -> DataFrame:
    some = lambda values: F.get(F.array(*map(F.lit, values)), (F.col("page_id") % len(values)).cast("int"))
    names, licences = [".jpg", ".JPEG", ".png", ".webp", ".gif", ".jpg.pdf"], ["", "<b>CC BY</b> ", "CC\nBY-SA", "Non-free logo", "CC BY-NC", "CC BY-ND 4.0", "<i> </i>"]
    rows = table(spark, d, "pages").select("page_id", F.concat("url", some(names)).alias("title"), "html", some(licences).alias("licence"))
    return readers.flatten_pages(rows, "title", {"text": "html"}, "licence", filters.DENIED_LICENCE).select("page_id", "licence", "text")


@query("reject_split", "SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'dear' ELSE 'pending' END AS reason FROM orders WHERE o_totalprice > 400000 OR o_orderstatus = 'P'")
def reject_split(spark: SparkSession, d: str) -> DataFrame:
    return sinks.split_rejects(table(spark, d, "orders"), {"dear": F.col("o_totalprice") > 400000, "pending": F.col("o_orderstatus") == "P"})[1].select("o_orderkey", "reason")


@query("run_manifest", "SELECT 'nightly' AS run, count(*) AS n, count(DISTINCT l_suppkey) AS n_keys, round(avg(l_quantity), 4) AS mean FROM lineitem")
def run_manifest(spark: SparkSession, d: str) -> DataFrame:
    return sinks.manifest(table(spark, d, "lineitem"), {"n": F.count("*"), "n_keys": F.count_distinct("l_suppkey"), "mean": F.round(F.avg("l_quantity"), 4)}, {"run": "nightly"})


@query("partner_export", """
SELECT 'row' AS part, s_suppkey AS key, s_name AS name, NULL AS by_rank FROM supplier
UNION ALL SELECT 'meta', count(*), NULL, concat_ws('|', 'none=' || nullif(count(*) FILTER (s_acctbal <= 0), 0), 'solvent=' || nullif(count(*) FILTER (s_acctbal > 0), 0)) FROM supplier
""")
def partner_export(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").withColumn("rank", F.when(F.col("s_acctbal") > 0, "solvent"))
    read = sinks.partner_document(rows, "rank", ["s_suppkey", "s_name"]).withColumn("r", F.from_json("document", "s_suppkey BIGINT, s_name STRING, total BIGINT, by_rank MAP<STRING, BIGINT>"))
    ranks = F.array_join(F.transform(F.array_sort(F.map_entries("r.by_rank")), lambda e: F.concat_ws("=", e["key"], e["value"])), "|")
    return read.select("part", F.coalesce("r.s_suppkey", "r.total").alias("key"), F.col("r.s_name").alias("name"), F.when(F.col("part") == "meta", ranks).alias("by_rank"))


@query("keyed_upsert", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def keyed_upsert(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    new = c.where("c_custkey % 5 = 0").select("c_custkey", F.explode(F.array(F.struct(F.lit(1).alias("at"), F.lit("OLD").alias("c_mktsegment")), F.struct(F.lit(2).alias("at"), F.lit("NEW").alias("c_mktsegment")))).alias("v")).select("c_custkey", "v.*")
    return sinks.upsert(c.where("c_custkey % 10 <> 0"), new, ["c_custkey"], "at")


@query("tree_slices", """
WITH n AS (SELECT n_nationkey, n_name, n_regionkey, count(c_custkey) AS m FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL), r AS (SELECT r_name, r_regionkey, sum(m) AS m FROM region JOIN n ON n_regionkey = r_regionkey GROUP BY ALL),
t AS (SELECT sum(m) AS m, sum(m) // 6 AS lim FROM r)
SELECT r_name AS node, r.m::BIGINT AS n, 'slice' AS kind FROM r, t WHERE r.m <= lim UNION ALL
SELECT n_name, n.m, 'slice' FROM n JOIN r ON r_regionkey = n_regionkey, t WHERE r.m > lim AND n.m <= lim
""")
def tree_slices(spark: SparkSession, d: str) -> DataFrame:
    nation, region, customer = (table(spark, d, n) for n in ("nation", "region", "customer"))
    per = nation.join(customer.groupBy("c_nationkey").agg(F.count("*").alias("n")), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("n_name", "n_regionkey", F.coalesce("n", F.lit(0)).alias("n"))
    regions = per.join(region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.sum("n").alias("n"))
    counts = written(per.select(F.col("n_name").alias("node"), "n").unionByName(regions.withColumnRenamed("r_name", "node")).unionByName(regions.agg(F.sum("n").alias("n")).select(F.lit("WORLD").alias("node"), "n")), "counts")
    edges = region.select(F.lit("WORLD").alias("parent"), F.col("r_name").alias("child")).unionByName(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("parent"), F.col("n_name").alias("child")))
    leaves = edges.where("false").select(F.col("child").alias("node"))
    most = counts.where("node = 'WORLD'").first()["n"] // 6
    return tree.slices(edges, counts, leaves, "WORLD", most)


@query("quota_window", """
WITH RECURSIVE e AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
f AS (SELECT user_id, event_id, ts, i, ts AS ws, 1 AS used FROM e WHERE i = 1
  UNION ALL SELECT e.user_id, e.event_id, e.ts, e.i, CASE WHEN e.ts - f.ws >= INTERVAL 24 HOUR THEN e.ts ELSE f.ws END, CASE WHEN e.ts - f.ws >= INTERVAL 24 HOUR THEN 1 ELSE f.used + 1 END FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)
SELECT user_id::VARCHAR AS key, event_id AS request, used::BIGINT AS used, used > 3 AS over FROM f
""")
def quota_window(spark: SparkSession, d: str) -> DataFrame:
    return ingest.quota_batch(table(spark, d, "events").withColumn("cost", F.lit(1)), "user_id", "event_id", "ts", "cost", 3).select("key", "request", "used", "over")


@query("stream_ingest", "SELECT event_id, user_id FROM events")
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    source, target, checkpoint = (scratch(spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    e.unionByName(e.where("event_id % 7 = 0")).repartition(4).write.json(source)  # a seventh comes twice
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest_files(spark, source, "event_id BIGINT, user_id BIGINT, ts TIMESTAMP", target, checkpoint, "event_id", files_per_trigger=2)
    return ingest.ingested(spark, target, "event_id BIGINT, user_id BIGINT")


@query("stream_upsert", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    source, target, checkpoint = (scratch(spark, n) for n in ("upsert-in", "upsert-out", "upsert-state"))
    table(spark, d, "events").select("event_id", "user_id").repartitionByRange(3, "event_id").sortWithinPartitions("event_id").write.json(source)
    ingest.upsert_stream(spark, source, "event_id BIGINT, user_id BIGINT", target, checkpoint, ["user_id"], "event_id")
    return ingest.read_upserted(spark, target, "event_id BIGINT, user_id BIGINT")


@query("retry_queue", "SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 3")
def retry_queue(spark: SparkSession, d: str) -> DataFrame:
    queue, done = scratch(spark, "queue"), scratch(spark, "done")
    table(spark, d, "orders").select("o_orderkey").write.parquet(queue)
    return ingest.retry(spark, queue, lambda rows: rows.withColumn("ok", F.col("o_orderkey") % 4 < F.col("attempt")), done)


@query("keyed_json", "SELECT p_brand AS key, round(max(p_retailprice), 2) AS value FROM part GROUP BY 1")
def keyed_json(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "keyed")
    best = table(spark, d, "part").groupBy("p_brand").agg(F.round(F.max("p_retailprice"), 2).alias("v"))
    entries = F.map_from_entries(F.collect_list(F.struct("p_brand", "v")))
    best.agg(F.to_json(F.struct(F.lit("1").alias("version"), entries.alias("values"))).alias("value")).write.text(path)
    return readers.read_keyed_json(spark, path, "DOUBLE", "values")


@query("quoted_csv", "SELECT p_name || ' \"' || p_brand || '\", ' || p_type AS name, p_partkey::VARCHAR AS key FROM part")
def quoted_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "csv")
    rows = table(spark, d, "part").select(F.concat("p_name", F.lit(' "'), "p_brand", F.lit('", '), "p_type").alias("name"), F.col("p_partkey").cast("string").alias("key"))
    rows.withColumnRenamed("name", "﻿name").write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return readers.read_quoted_csv(spark, path, ["name", "key"])


@query("multi_store", "SELECT 'nations' AS store, n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT 'regions', r_regionkey, r_name FROM region")
def multi_store(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "stores")
    nations = table(spark, d, "nation").agg(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))).alias("nations")).withColumn("j", F.lit(1))
    regions = table(spark, d, "region").agg(F.collect_list(F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))).alias("regions")).withColumn("j", F.lit(1))
    nations.join(regions, "j").drop("j").write.json(path)
    stores = readers.read_multi_store(spark, path, {"nations": "id INT, name STRING", "regions": "id INT, name STRING"})
    return stores["nations"].select(F.lit("nations").alias("store"), "*").unionByName(stores["regions"].select(F.lit("regions").alias("store"), "*"))


@query("tree_flatten", "SELECT r_name AS area, n_name AS domain, s_name AS name FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey")
def tree_flatten(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.collect_list(F.struct(F.col("s_name").alias("name"))).alias("lists"))
    n = table(spark, d, "nation").join(s, F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy("n_regionkey").agg(F.collect_list(F.struct(F.col("n_name").alias("name"), "lists")).alias("domains"))
    r = table(spark, d, "region").join(n, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.array(F.struct(F.col("r_name").alias("name"), "domains")).alias("areas"))
    return readers.flatten_tree(r, [("areas", "area"), ("domains", "domain"), ("lists", "leaf")]).select("area", "domain", F.col("leaf").alias("name"))


@query("usage_names", """
WITH v AS (SELECT o_custkey AS k, o_orderkey AS pos, trim(o_orderpriority) AS name, CASE WHEN o_orderstatus = 'F' THEN 'de' WHEN o_orderstatus = 'O' THEN 'en' ELSE 'xx' END AS l FROM orders),
o AS (SELECT *, row_number() OVER (PARTITION BY k, l, lower(name) ORDER BY pos) AS n FROM v WHERE l IN ('de', 'en'))
SELECT k, string_agg(l || ':' || name, '|' ORDER BY pos) AS names FROM o WHERE n = 1 GROUP BY 1
""")
def usage_names(spark: SparkSession, d: str) -> DataFrame:
    lang = F.when(F.col("o_orderstatus") == "F", "de").when(F.col("o_orderstatus") == "O", "en").otherwise("xx")
    entries = F.sort_array(F.collect_list(F.struct("o_orderkey", F.concat(F.lit(" "), "o_orderpriority").alias("vernacularName"), lang.alias("language"))))
    usages = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(entries.alias("vernacularNames"))
    out = readers.flatten_usages(usages, ["de", "en"])
    return out.select("k", F.array_join(F.transform("vernacularNames", lambda v: F.concat_ws(":", v["language"], v["name"])), "|").alias("names")).where("names <> ''")


@query("occurrence_media", """
WITH m AS (SELECT user_id, event_id AS pos, event_type AS url, value > 5 AS ext FROM events), o AS (SELECT *, row_number() OVER (PARTITION BY user_id, url ORDER BY NOT ext, pos) AS n FROM m)
SELECT user_id, url, CASE WHEN ext THEN 'ext' || pos ELSE 'med' || pos END AS creator FROM o WHERE n = 1
""")
def occurrence_media(spark: SparkSession, d: str) -> DataFrame:
    pos = F.col("event_id").cast("string")

    def pick(cond, creator, holder):
        entries = F.sort_array(F.collect_list(F.when(cond, F.struct("event_id", F.col("event_type").alias("u"), creator.alias("c"), holder.alias("h")))))
        return F.transform(entries, lambda x: F.create_map(F.lit("identifier"), x["u"], F.lit("creator"), x["c"], F.lit("rightsHolder"), x["h"]))

    large = F.col("value") > 5
    rows = table(spark, d, "events").groupBy("user_id").agg(
        pick(large, F.concat(F.lit("ext"), pos), F.lit("")).alias("extensions"), pick(~large, F.lit(" "), F.concat(F.lit("med"), pos)).alias("media")
    )
    return readers.flatten_media(rows, "user_id", "extensions", "media", {"url": ["identifier"], "creator": ["creator", "rightsHolder"]}, "url").select("user_id", "url", "creator")


@query("facet_keys", "SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderstatus <> 'P'")
def facet_keys(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("o_orderstatus") == "P", "none").otherwise(F.col("o_custkey").cast("string"))
    pages = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.collect_list(F.struct(name.alias("name"), F.lit(1).alias("count"))).alias("counts"))
    return readers.flatten_facets(pages, "counts")


@query("detail_traits", 'SELECT p_partkey AS "taxonKey", \'de\' AS lang, \'2024-01-02\' AS at, CASE WHEN p_size > 10 THEN p_type || \', \' || p_brand END AS growth, p_name AS name FROM part')
def detail_traits(spark: SparkSession, d: str) -> DataFrame:
    value = lambda c: F.struct(F.col(c).alias("key"))
    traits = F.array(F.struct(F.when(F.col("p_size") > 10, "growth_form").otherwise("other").alias("key"), F.array(value("p_type"), value("p_brand")).alias("values")))
    details = table(spark, d, "part").select("p_partkey", traits.alias("traits"), F.col("p_name").alias("images"), F.col("p_name").alias("name"))
    added = {"taxonKey": F.col("p_partkey"), "lang": F.lit("de"), "at": F.lit("2024-01-02"), "name": F.lit("not taken")}
    return readers.flatten_detail(details, "images", "growth_form", "growth", added).select("taxonKey", "lang", "at", "growth", "name")


@query("synonym_lists", "SELECT p_partkey, CASE WHEN p_brand = p_type THEN p_brand ELSE p_brand || '|' || p_type END AS synonyms FROM part")
def synonym_lists(spark: SparkSession, d: str) -> DataFrame:
    names = merge.synonym_union(F.array("p_brand"), F.array(F.upper("p_name"), F.col("p_type")), F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", F.array_join(names, "|").alias("synonyms"))


@query("composed_names", "SELECT p_partkey, CASE WHEN p_size > 25 THEN upper(p_brand) || ' Kraut' WHEN p_size > 10 THEN p_brand || ' ''Gold''' ELSE 'Acer minus ''Gold''' END AS name, CASE WHEN p_size > 25 THEN 'own' WHEN p_size > 10 THEN 'composed' ELSE 'botanical' END AS source FROM part")
def composed_names(spark: SparkSession, d: str) -> DataFrame:
    common = F.when(F.col("p_size") > 25, F.concat(F.upper("p_brand"), F.lit(" Kraut"))).otherwise("Acer minus")
    made = T.composed_name(common, F.when(F.col("p_size") > 10, F.col("p_brand")), F.lit("Acer minus 'Gold'"))
    return table(spark, d, "part").select("p_partkey", made.alias("x")).select("p_partkey", "x.name", "x.source")


@query("repaired_names", """
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_name || ' ''Cox''s Gold''' WHEN 1 THEN p_name || ' ''Cox''' ELSE p_name END AS name, CASE p_size % 4 WHEN 1 THEN 'Rose ''Cox''' WHEN 2 THEN 'Rose ''Other''' ELSE 'Rose ''Cox''s Gold''' END AS common FROM part
""")
def repaired_names(spark: SparkSession, d: str) -> DataFrame:
    k, n = F.col("p_size") % 4, F.col("p_name")
    canonical = F.when(k == 0, F.concat(n, F.lit(" ‘Cox"))).when(k == 1, F.concat(n, F.lit(" ʽCox’"))).otherwise(n)
    scientific = F.when(k == 1, F.concat(n, F.lit(" ‘Cox’"))).otherwise(F.concat(n, F.lit(" ‘Cox’s Gold’")))
    common = F.when(k == 2, "Rose ʽOther’").when(k == 3, "Rose 'Cox’s Gold'").otherwise("Rose ʽCox’")
    return table(spark, d, "part").select("p_partkey", T.completed_name(canonical, scientific).alias("name"), T.completed_common_name(common, canonical, scientific).alias("common"))


@query("clean_cells", "SELECT p_partkey, p_name || ' ''' || p_brand || ''', Gras-Lilie , ' || p_type AS cell, lower(p_name) AS key FROM part")
def clean_cells(spark: SparkSession, d: str) -> DataFrame:
    """Every form of quote and dash around the same words, by turns."""
    some = lambda signs, step: F.get(F.array(*map(F.lit, signs)), ((F.col("p_partkey") / step).cast("int") % len(signs)).cast("int"))
    begin, end, dash = some("‘’ʽʼ`´'", 1), some("’‘´`'", 7), some("-‐‑‒–—―−", 1)
    cell = F.concat(F.lit("\f"), "p_name", F.lit("  (syn. a) "), begin, "p_brand", end, F.lit(",Grás"), dash, F.lit("Lílie (alt) ,"), "p_type", F.lit("  in  sorten z.B."))
    return table(spark, d, "part").select("p_partkey", T.clean_list_text(cell).alias("cell"), T.small_key(F.replace("p_name", F.lit(" "), F.lit(" - "))).alias("key"))


@query("markup_attributes", r"""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS v FROM pages) SELECT DISTINCT page_id, trim(v || ' (b)') AS name, 'link' AS category FROM a WHERE NOT contains(v, '#')
""")
def markup_attributes(spark: SparkSession, d: str) -> DataFrame:
    html = F.regexp_replace("html", 'href="([^"]+)"', 'title="$1 (b) (link)" title="$1 (b) (again)" title="$1"')
    return readers.titled_entries(table(spark, d, "pages").select("page_id", html.alias("html")), "page_id", "html", skip="#")


@query("foreign_categories", "SELECT p_partkey, p_partkey % 3 = 0 AS foreign_one FROM part")
def foreign_categories(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    category = F.when(k == 0, F.concat("p_name", F.lit(" in gardens"))).when(k == 1, F.concat("p_name", F.lit(" gold"))).otherwise("Weeping tree")
    return table(spark, d, "part").select("p_partkey", T.of_another(F.concat("p_name", F.lit(" 'Gold'")), category).alias("foreign_one"))


@query("genuine_names", "SELECT p_partkey, p_partkey % 4 = 0 AS genuine, p_partkey % 2 = 1 AS botanical FROM part")
def genuine_names(spark: SparkSession, d: str) -> DataFrame:
    k, words = F.col("p_partkey") % 4, F.split("p_name", " ")
    genus = F.initcap(words[0])
    scientific = F.concat(genus, F.lit(" "), words[1])
    name = F.when(k == 0, F.concat(F.lit("Echte "), genus)).when(k == 1, scientific).when(k == 2, genus).otherwise(F.concat(genus, F.lit(" subsp. "), words[1]))
    return table(spark, d, "part").select("p_partkey", T.genuine_common_name(name, scientific).alias("genuine"), T.looks_botanical(name).alias("botanical"))


# Lists set as text, species rows, catalogue index, addresses, parents, list reports


@query("layout_records", r"""
WITH l AS (SELECT o_custkey AS doc, o_orderkey AS line, floor(o_totalprice)::BIGINT % 52 AS q, CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'A' ELSE 'N' END AS f, o_orderkey::VARCHAR AS n FROM orders),
k AS (SELECT *, CASE WHEN q < 4 THEN 'section' WHEN q < 7 THEN 'number' WHEN q < 19 THEN 'dash' WHEN q < 28 THEN 'free' WHEN q < 32 THEN 'filler' WHEN q < 38 THEN 'indent' ELSE 'other' END AS c FROM l WHERE q < 48),
t AS (SELECT *, CASE c WHEN 'section' THEN 'Teil ' || n WHEN 'dash' THEN 'Rosa nr' || n || CASE WHEN f = 'R' THEN ' (syn.' ELSE '' END WHEN 'free' THEN 'Malus silvestris ' || n || CASE WHEN f = 'A' THEN ' (alt' ELSE '' END
   WHEN 'filler' THEN 'Garten bzw. mehr' || n WHEN 'indent' THEN 'grandis, Tanne' || n ELSE 'weiter' || n || CASE WHEN f = 'N' THEN ') Text' ELSE ' Text' END END AS body,
   CASE WHEN c = 'dash' AND f = 'R' OR c = 'free' AND f = 'A' THEN 1 WHEN c = 'other' AND f = 'N' THEN -1 ELSE 0 END AS d FROM k),
p AS (SELECT *, sum((c IN ('section', 'number'))::INT) OVER w AS part FROM t WINDOW w AS (PARTITION BY doc ORDER BY line)),
o AS (SELECT *, coalesce(bool_or(c IN ('dash', 'free', 'filler')) OVER (PARTITION BY doc, part ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS opened, sum((c = 'dash')::INT) OVER (PARTITION BY doc, part ORDER BY line) AS run FROM p),
u AS (SELECT *, sum(CASE WHEN opened OR c IN ('dash', 'free', 'filler') THEN d ELSE 0 END) OVER (PARTITION BY doc, part, run ORDER BY line) AS upto FROM o),
i AS (SELECT *, coalesce(lag(upto) OVER w, 0) - least(0, coalesce(min(upto) OVER (PARTITION BY doc, part, run ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) > 0 AS inside FROM u WINDOW w AS (PARTITION BY doc, part, run ORDER BY line)),
s AS (SELECT *, c = 'dash' OR c IN ('free', 'filler') AND NOT opened OR c = 'free' AND NOT inside OR c = 'indent' AND opened AND NOT inside AS starts FROM i),
r AS (SELECT *, sum(starts::INT) OVER (PARTITION BY doc, part ORDER BY line) AS record FROM s)
SELECT doc, min(line) AS line, 'entry' AS kind, min_by(CASE WHEN c = 'dash' AND f <> 'N' THEN 'ZP' ELSE '' END, line) AS marks, min_by(CASE WHEN c = 'dash' AND f = 'A' THEN 2 ELSE 1 END, line) AS level, string_agg(body, ' ' ORDER BY line) AS text
FROM r WHERE c NOT IN ('section', 'number') AND record > 0 GROUP BY doc, part, record
UNION ALL SELECT doc, line, 'section', '', 0, body FROM r WHERE c = 'section'
""")
def layout_records(spark: SparkSession, d: str) -> DataFrame:
    q, n = F.floor("o_totalprice") % 52, F.col("o_orderkey").cast("string")
    f = F.when(F.col("o_orderstatus") == "F", "R").when(F.col("o_orderstatus") == "O", "A").otherwise("N")
    bracket = lambda flag, sign: F.when(f == flag, F.lit(sign)).otherwise("")
    dashes = F.when(f == "R", F.lit(" ZP - ")).when(f == "A", F.lit("ZP -  - ")).otherwise("  -")
    text = (
        F.when(q < 4, F.concat(F.lit("Teil "), n)).when(q < 7, F.lit("2.2 Kleine Sorten")).when(q < 19, F.concat(dashes, F.lit("Rosa nr"), n, bracket("R", " (syn.")))
        .when(q < 28, F.concat(F.lit("Malus silvestris "), n, bracket("A", " (alt"))).when(q < 32, F.concat(F.lit("Garten bzw. mehr"), n)).when(q < 38, F.concat(F.lit("   grandis, Tanne"), n))
        .when(q < 48, F.concat(F.lit("weiter"), n, F.when(f == "N", ") Text").otherwise(" Text"))).when(f == "N", F.lit("  ")).otherwise("Seite 7")
    )
    lines = table(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("line"), text.alias("t"))
    section = F.when(F.col("t").startswith("Teil "), F.col("t"))
    return layout.list_records(lines, "doc", "line", "t", section, F.lit(None).cast("string"), F.col("t").startswith("Seite "), F.lit(False))


@query("grammar_lines", """
SELECT p_partkey, p_name AS label, p_brand AS family, CASE WHEN p_size % 10 < 5 THEN '' ELSE lower(p_type) END AS name, CASE WHEN p_size % 10 < 5 THEN 'no name' WHEN p_size % 10 = 5 THEN 'dropped' END AS reason FROM part WHERE p_size % 10 < 8
""")
def grammar_lines(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_size") % 10
    shown = F.when(k < 5, F.lit("(keine)")).otherwise(F.concat(F.lower("p_type"), F.lit(" (alt)"), F.when(k == 6, " in Sorten").otherwise("")))
    line = F.when(k < 8, F.concat(F.lit("  "), F.col("p_name"), F.lit("   "), F.col("p_brand"), F.lit("\t  "), shown)).otherwise(F.concat_ws(" ", "p_name", "p_brand"))
    rows = table(spark, d, "part").select("p_partkey", line.alias("line"), (k == 5).alias("drop"))
    good, bad = layout.grammar_lines(rows, "line", r"^\s{2,}(\S.*?)\s{2,}(\S+)\s{2,}(.+)$", ["label", "family", "name"], ["name"], ["name"], F.col("drop"))
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad).select("p_partkey", "label", "family", "name", "reason")


@query("assembled_names", """
WITH c AS (SELECT p_partkey, p_size % 8 AS k, p_brand AS b, string_split(p_name, ' ')[1] AS g, string_split(p_name, ' ')[2] AS s FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN g || ' ' || s WHEN 1 THEN g || ' ' || s || ' ''' || b || '''' WHEN 2 THEN g || ' ' || s || ' subsp. alba' WHEN 3 THEN g || ' sect. ' || b WHEN 4 THEN g || ' (' || b || ')' WHEN 5 THEN g || ' ' || s || ' ''' || b || '''' WHEN 6 THEN g ELSE g || ' ' || s END AS name,
  CASE WHEN k IN (1, 5) THEN 'cultivar' WHEN k IN (4, 6) THEN 'genus' ELSE 'species' END AS rank FROM c
""")
def assembled_names(spark: SparkSession, d: str) -> DataFrame:
    k, words, brand = F.col("p_size") % 8, F.split("p_name", " "), F.col("p_brand")
    species = F.when(k == 3, F.lit("sect.")).when(k.isin(4, 6), F.lit(" 'Sorte' ")).otherwise(words[1])
    quoted = F.concat(F.lit("'"), brand, F.lit("'"))
    cultivar = F.when(k == 0, F.lit("Sorte")).when(k == 1, quoted).when(k == 2, F.lit("subsp.  alba")).when(k.isin(3, 4, 5), brand).when(k == 6, F.lit("")).otherwise(F.lit(None).cast("string"))
    return table(spark, d, "part").select("p_partkey", layout.assembled_name(words[0], species, cultivar).alias("n")).select("p_partkey", "n.name", "n.rank")


_TEXT_FIELDS = ["scientificName", "canonicalName", "authorship", "rank", "kingdom", "phylum", "class", "order", "family", "genus", "constituentKey"]
_KEY_FIELDS = ["kingdomKey", "phylumKey", "classKey", "orderKey", "familyKey", "genusKey", "numDescendants"]


@query("species_rows", "SELECT o_orderkey AS \"taxonKey\", o_orderstatus AS status, o_totalprice > 200000 AS extinct, " + ", ".join(
    [f"CASE WHEN o_orderkey % 12 <> {i} THEN '{n} ' || o_orderpriority END AS \"{n}\"" for i, n in enumerate(_TEXT_FIELDS)] + [f"o_custkey + {i} AS \"{n}\"" for i, n in enumerate(_KEY_FIELDS) if n != "genusKey"]
) + """, NULL::VARCHAR AS "genusKey", CASE o_orderkey % 3 WHEN 0 THEN 'de:Baum,de:Linde,en:tree' WHEN 1 THEN 'de:Baum' ELSE '' END AS names FROM orders""")
def species_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every field of a usage, empty texts by turns, one key that the payload lacks; vernacular names with blanks, repeats and another language."""
    k = F.col("o_orderkey")
    name = lambda text, lang: F.struct(F.lit(text).alias("vernacularName"), F.lit(lang).alias("language"))
    long = F.array(name(" Baum", "de"), name("Linde", "de"), name("baum ", "de"), name("arbre", "fr"), name("tree", "en"), name("TREE", "en"))
    names = F.when(k % 3 == 0, long).when(k % 3 == 1, F.array(name("Baum", "de"), name("arbre", "fr"))).otherwise(F.array().cast("array<struct<vernacularName:string,language:string>>"))
    texts = [F.when(k % 12 == i, F.lit("")).otherwise(F.concat(F.lit(f"{n} "), "o_orderpriority")).alias(n) for i, n in enumerate(_TEXT_FIELDS)]
    keys = [(F.col("o_custkey") + i).alias(n) for i, n in enumerate(_KEY_FIELDS) if n != "genusKey"]
    usages = table(spark, d, "orders").select(k.alias("key"), F.col("o_orderstatus").alias("taxonomicStatus"), (F.col("o_totalprice") > 200000).alias("extinct"), *texts, *keys, names.alias("vernacularNames"))
    out = readers.species_rows(usages, ["de", "en"])
    return out.withColumn("names", F.array_join(F.transform("vernacularNames", lambda v: F.concat(v["language"], F.lit(":"), v["name"])), ",")).drop("vernacularNames")


@query("catalogue_index", """
WITH p AS (SELECT p_partkey, lower(p_name) AS a, regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g') AS b, lower(string_split(p_type, ' ')[1]) AS t FROM part)
SELECT p_partkey, a || '|' || b || '|' || t AS names, 2 AS n_local, replace(a || '|' || b || '|' || t, ' ', '') AS terms FROM p
""")
def catalogue_index(spark: SparkSession, d: str) -> DataFrame:
    botanical = F.array(F.concat(F.element_at(F.split(F.initcap("p_type"), " "), 1), F.lit(" (Ser.) Mill.")), F.col("p_name"), F.lit(None).cast("string"))
    rows = table(spark, d, "part").select("p_partkey", T.catalogue_index(F.array("p_name", F.lit(None).cast("string"), "p_brand"), botanical).alias("i"))
    return rows.select("p_partkey", F.array_join("i.names", "|").alias("names"), "i.n_local", F.array_join("i.terms", "|").alias("terms"))


@query("file_addresses", """
WITH n AS (SELECT p_partkey, replace(p_name, ' ', '_') AS n FROM part), h AS (SELECT *, md5(n) AS h FROM n)
SELECT p_partkey, 'base/thumb/' || h[1:1] || '/' || h[1:2] || '/' || n || '/250px-' || n AS thumb, 'api/image/cache/occurrence/' || p_partkey || '/media/' || h AS cached, 'api/image/cache/fit-in/400x0/occurrence/' || p_partkey || '/media/' || h AS fitted, 'img/m/' || p_partkey AS sized FROM h
""")
def file_addresses(spark: SparkSession, d: str) -> DataFrame:
    cached = T.cache_path(F.translate("p_name", " ", "_"), "p_partkey", "api/image/cache/occurrence")
    return table(spark, d, "part").select("p_partkey", T.thumb_path("p_name", "base", 250).alias("thumb"), cached.alias("cached"), T.with_width(cached, 400).alias("fitted"), T.sized_path("p_partkey", "img", "m").alias("sized"))


@query("parent_keys", """
WITH i AS (SELECT p_name AS name, min(p_partkey) AS key FROM part WHERE p_size > 20 GROUP BY 1) SELECT p_partkey, i.key AS parent_key FROM part LEFT JOIN i ON i.name = p_name
""")
def parent_keys(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    index = resolve.name_index(part.where("p_size > 20"), "p_partkey", "p_partkey", {"name": F.col("p_name")})
    rows = part.select("p_partkey", lists.expand_row(F.concat("p_name", F.lit(" 'Gold'"))).alias("x"))
    return lists.parent_keys(rows.select("p_partkey", "x.parent"), "parent", index).select("p_partkey", "parent_key")


@query("value_beside_older", """
WITH v AS (SELECT o_custkey AS k, min(o_orderpriority) AS value FROM orders WHERE o_orderstatus = 'P' GROUP BY 1), o AS (SELECT o_custkey AS k, min(o_orderpriority) AS older FROM orders WHERE o_totalprice < 50000 GROUP BY 1)
SELECT c_custkey, value, older, CASE WHEN value IS NOT NULL AND older IS NOT NULL THEN 'both' WHEN value IS NOT NULL THEN 'value' ELSE 'older' END AS has FROM customer LEFT JOIN v ON v.k = c_custkey LEFT JOIN o ON o.k = c_custkey WHERE value IS NOT NULL OR older IS NOT NULL
""")
def value_beside_older(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return merge.beside(table(spark, d, "customer").select("c_custkey"), "c_custkey", orders.where("o_orderstatus = 'P'"), "o_custkey", "o_orderpriority", orders.where("o_totalprice < 50000"), "o_custkey", "o_orderpriority")


@query("bracket_dedupe", "SELECT p_name || ' (' || p_brand || ')' AS name, min(p_partkey) AS p_partkey, count(*) AS n_rows FROM part GROUP BY p_name, p_brand")
def bracket_dedupe(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")).alias("name"))
    return merge.first_rows(rows, T.bracket_key("name"), ["p_partkey"]).select("name", "p_partkey", "n_rows")


@query("list_report", """
WITH e AS (SELECT o_custkey AS list, o_orderkey AS i, o_orderpriority AS name, CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS k FROM orders),
w AS (SELECT *, lag(k IS NOT NULL) OVER (PARTITION BY list ORDER BY i) AS m, lag(name) OVER (PARTITION BY list, k IS NOT NULL ORDER BY i) AS b FROM e)
SELECT c_custkey AS list, 'error' AS severity, 'no c_mktsegment' AS rule, 1 AS n FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey, 'error', 'no states in scope', 1 FROM customer WHERE c_nationkey = 0
UNION ALL SELECT c_custkey, 'error', 'file not found', 1 FROM customer WHERE c_nationkey % 4 = 3
UNION ALL SELECT c_custkey, 'warning', 'unknown state', 1 FROM customer WHERE c_nationkey > 20 UNION ALL SELECT c_custkey, 'error', 'no entries', 1 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT list, 'warning', 'not in order', count(*) FROM w WHERE k IS NOT NULL AND NOT m OR name < b GROUP BY 1
UNION ALL SELECT list, 'info', 'percent matched', round(100.0 * count(k) / count(*))::BIGINT FROM e GROUP BY 1
""")
def list_report(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment"), F.when(F.col("c_nationkey") == 0, F.array().cast("array<int>")).otherwise(F.array(F.col("c_nationkey").cast("int"))).alias("states"), F.concat(F.lit("list-"), F.col("c_nationkey").cast("string")).alias("file"))
    entries = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("k"))
    states = table(spark, d, "nation").where("n_nationkey <= 20").select(F.col("n_nationkey").cast("int").alias("n"))
    files = table(spark, d, "nation").where("n_nationkey % 4 <> 3").select(F.concat(F.lit("list-"), F.col("n_nationkey").cast("string")).alias("file"))
    return audit.list_report(own, entries, states, "c_custkey", ["c_custkey", "c_mktsegment"], "states", "n", "o_custkey", "o_orderpriority", "o_orderpriority", "k", "o_orderkey", "file", files)


@query("bands_apart", """
SELECT a.s_nationkey, a.s_suppkey, count(b.s_suppkey) AS n_apart FROM supplier a LEFT JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey AND abs(a.s_acctbal - b.s_acctbal) > 2000 GROUP BY 1, 2
""")
def bands_apart(spark: SparkSession, d: str) -> DataFrame:
    return indicators.apart_neighbours(table(spark, d, "supplier").withColumn("width", F.lit(2000.0)), "s_nationkey", "s_suppkey", "s_acctbal", "width")


@query("zone_pairs", """
WITH z AS (SELECT s_nationkey AS g, s_suppkey AS k, CASE WHEN s_acctbal < 1000 THEN 'a' WHEN s_acctbal <= 6000 THEN 'b' ELSE 'c' END AS z FROM supplier),
j AS (SELECT i.g, least(i.z, j.z) AS za, greatest(i.z, j.z) AS zb, count(*) AS n FROM z i JOIN z j ON i.g = j.g AND i.k < j.k GROUP BY 1, 2, 3), n AS (SELECT DISTINCT g, z FROM z)
SELECT x.g AS s_nationkey, x.z AS zone_a, y.z AS zone_b, coalesce(j.n, 0) AS n FROM n x JOIN n y ON x.g = y.g AND x.z <= y.z LEFT JOIN j ON j.g = x.g AND j.za = x.z AND j.zb = y.z
""")
def zone_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").withColumn("zone", indicators.zone("s_acctbal", F.lit(1000), F.lit(6000), ("a", "b", "c")))
    return indicators.zone_pairs(rows, "s_nationkey", "zone")


@query("page_statistics", "SELECT count(*) AS n_rows, ceil(count(*) / 50.0)::BIGINT AS n_pages, CASE WHEN count(*) > 100 THEN 101 ELSE 0 END AS first, CASE WHEN count(*) > 100 THEN least(count(*), 150) ELSE 0 END AS last FROM documents")
def page_statistics(spark: SparkSession, d: str) -> DataFrame:
    return windows.page_statistics(table(spark, d, "documents"), 2, 50)


@query("skipped_blocks", """
WITH l AS (SELECT conv_id, turn, last_value(CASE WHEN length(text) % 5 = 0 THEN 'H' || (length(text) % 2) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS h FROM conversations)
SELECT conv_id, turn FROM l WHERE h IS NULL OR h <> 'H0'
""")
def skipped_blocks(spark: SparkSession, d: str) -> DataFrame:
    heading = F.when(F.length("text") % 5 == 0, F.concat(F.lit("H"), (F.length("text") % 2).cast("string")))
    return filters.without_blocks(table(spark, d, "conversations"), "conv_id", "turn", heading, ["h0"]).select("conv_id", "turn")


@query("largest_gaps", """
WITH s AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_shipdate >= '1996-01-01') SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT k FROM s) GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10
""")
def largest_gaps(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem")
    gaps, _ = audit.expected_versus_arrived(rows, rows.where("l_shipdate >= '1996-01-01'"), "l_partkey", F.lit(False))
    return audit.largest_gaps(gaps, "l_partkey").select("l_partkey", "n")


@query("list_ranks", """
SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'genus' WHEN 1 THEN 'cultivar' WHEN 2 THEN 'variety' WHEN 3 THEN 'cultivar' WHEN 4 THEN 'subspecies' ELSE 'species' END AS rank, p_size % 4 = 0 AS is_aggregate FROM part
""")
def list_ranks(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_size") % 6
    name = F.when(k == 1, F.concat("p_name", F.lit(" 'Gold'"))).when(k == 2, F.concat("p_name", F.lit(" var. alba"))).when(k == 4, F.concat("p_name", F.lit(" ssp. minor"))).otherwise(F.col("p_name"))
    given = F.when(k == 0, "gattung").when(k.isin(2, 3), "sorte")
    synonyms = F.array("p_brand", F.when(F.col("p_size") % 4 == 0, F.concat("p_name", F.lit(" agg."))))
    return table(spark, d, "part").select("p_partkey", T.list_rank(name, given).alias("rank"), T.is_aggregate(synonyms).alias("is_aggregate"))


@query("review_split", "SELECT c_custkey, CASE WHEN c_acctbal > 0 AND c_mktsegment <> 'BUILDING' THEN 'trusted' ELSE 'review' END AS part FROM customer")
def review_split(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("b"))
    ok, rest = sinks.split_review(rows, F.col("b") > 0)
    return ok.select("c_custkey", F.lit("trusted").alias("part")).unionByName(rest.select("c_custkey", F.lit("review").alias("part")))


@query("plan_check", """
WITH n AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) SELECT sum(n) FILTER (k % 3 <> 0)::BIGINT AS planned, sum(n)::BIGINT AS at_root, sum(n) FILTER (k % 3 = 0)::BIGINT AS difference FROM n
""")
def plan_check(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "customer").groupBy(F.col("c_nationkey").cast("string").alias("node")).agg(F.count("*").alias("n"))
    counts = per.unionByName(per.agg(F.sum("n").alias("n")).select(F.lit("ROOT").alias("node"), "n"))
    return tree.plan_check(per.where("CAST(node AS INT) % 3 <> 0"), counts, "ROOT")


@query("indicator_variants", """
SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_retailprice END AS value, p_size % 3 = 0 AND p_size % 2 = 0 AS indifferent FROM part
""")
def indicator_variants(spark: SparkSession, d: str) -> DataFrame:
    sign = F.when(F.col("p_size") % 2 == 0, F.lit('"x"')).otherwise(F.lit('"none"'))
    raw = F.parse_json(F.when(F.col("p_size") % 3 == 0, sign).otherwise(F.col("p_retailprice").cast("string")))
    return table(spark, d, "part").select("p_partkey", indicators.as_indicator(raw).alias("i")).select("p_partkey", "i.*")


# Rules of names, by cases that the rows take by turns


@query("genuine_labels", """
SELECT p_partkey, p_size % 6 NOT IN (0, 1, 3, 5) AS genuine FROM part
""")
def genuine_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels: the botanical name, the English one with another apostrophe, an own one, a quoted name of the genus, an own quoted one, none."""
    k, n = F.col("p_size") % 6, F.initcap("p_name")
    english = F.concat(F.lit("Smith's "), n)
    label = F.when(k == 0, n).when(k == 1, F.concat(F.lit("Smith’s "), n)).when(k == 2, F.concat(F.lit("Echte "), n)).when(k == 3, F.concat(n, F.lit(" ‘Gold’"))).when(k == 4, F.lit("Rose ‘Gold’"))
    return table(spark, d, "part").select("p_partkey", T.genuine_label(label, n, english).alias("genuine"))


@query("name_parts", """
WITH r AS (SELECT p_partkey, p_size % 5 AS k, upper(left(p_name, 1)) || substr(split_part(p_name, ' ', 1), 2) AS g, split_part(p_name, ' ', 2) AS e FROM part)
SELECT p_partkey, g AS genus, k = 1 AS marked, CASE WHEN k IN (0, 2) THEN e END AS epithet FROM r
""")
def name_parts(spark: SparkSession, d: str) -> DataFrame:
    """Names of two words, with a group's mark, of a hybrid genus, of a hybrid, and with an author."""
    k, g, e = F.col("p_size") % 5, F.split_part(F.initcap("p_name"), F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    name = F.when(k == 1, F.concat(g, F.lit(" sect. "), g)).when(k == 2, F.concat(F.lit("×"), g, F.lit(" "), e)).when(k == 3, F.concat(g, F.lit(" × "), e)).when(k == 4, F.concat(g, F.lit(" "), e, F.lit(" L."))).otherwise(F.concat(g, F.lit("  "), e))
    return table(spark, d, "part").select("p_partkey", T.genus(name).alias("genus"), T.has_group_mark(name).alias("marked"), T.guarded_epithet(name).alias("epithet"))


@query("title_suffix", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' (a) b' ELSE p_name || ' (a)' END AS title FROM part")
def title_suffix(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_size") % 3
    title = F.concat("p_name", F.when(k == 0, F.concat(F.lit(" ("), "p_brand", F.lit(") "))).when(k == 1, F.lit(" (a) b")).otherwise(F.lit(" (a) (b)")))
    return table(spark, d, "part").select("p_partkey", T.without_suffix(title).alias("title"))


@query("unwritten_rows", "SELECT o_orderkey, o_orderstatus, 0 AS n_files FROM orders")
def unwritten_rows(spark: SparkSession, d: str) -> DataFrame:
    """A trial run gives its rows and leaves no file."""
    path = scratch(spark, "trial")
    rows = sinks.write_json(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), path, write=False)
    return rows.withColumn("n_files", F.lit(len(folders(spark, path))))
