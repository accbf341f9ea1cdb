"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

Everything is DataFrame and SQL functions. Measures of each text are whole numbers; a sketch counts them by bucket, exact
below 64 and with six leading bits above, so it errs by 1/32 at most, and sketches of parts merge by adding counts.
Quantiles of a group's sketch give its fences: beyond the 0.9 quantile by ``REACH`` times its distance from the median
(or the measure's least spread) a document is rejected. Groups of fewer than ``SUPPORT`` documents use their language's
sketch, small languages that of all.

Defined cases: a null text counts as having no words; languages and sources that are null are groups of their own;
repeated rows are each counted and judged; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

REACH = 3
SUPPORT = 50
#: Groups of language and source up to which their fences (under 200 bytes each) are sent to all tasks; beyond, Spark joins them as any table.
GROUPS = 50_000
#: Least spread of each measure: hundredths of a character, then thousandths.
SPREAD = {"mean_length": 50, "symbols": 30, "dup_lines": 100, "repeats": 100}
#: Up to so many different repeated windows, a text is searched for each; beyond, its windows are sorted with places.
FEW = 12

_BREAK = r"'[\\x20\\x09-\\x0D]+'"


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts of each text: words, their characters, symbols, lines, repeated lines, words in repeated windows of three."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    split = rows.withColumns({
        "words": F.expr(f"filter(split(t, {_BREAK}), w -> w <> '')"),
        "lines": F.expr(r"filter(split(t, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"),
        "n_symbols": F.expr("CAST(regexp_count(t, '[#*$%&|<>]') AS BIGINT)"),
    }).drop("t")
    hashed = split.select(
        "doc_id", "lang", "source", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("transform(words, w -> xxhash64(w))").alias("word_hashes"),
    )
    windows = hashed.withColumn("h", F.expr("slice(transform(word_hashes, (x, i) -> xxhash64(x, get(word_hashes, i + 1), get(word_hashes, i + 2))), 1, greatest(size(word_hashes) - 2, 0))")).drop("word_hashes")
    ordered = windows.withColumn("s", F.sort_array("h"))
    found = ordered.withColumn("again", F.expr("array_distinct(filter(s, (x, i) -> x = get(s, i - 1)))")).drop("s")
    listed = found.withColumns({
        "few": F.expr(f"CASE WHEN size(again) BETWEEN 1 AND {FEW} THEN filter(transform(h, (x, i) -> IF(array_contains(again, x), i, NULL)), i -> i IS NOT NULL) END"),
        "many": F.expr(f"CASE WHEN size(again) > {FEW} THEN sort_array(transform(h, (x, i) -> struct(x, i))) END"),
    }).drop("h", "again")
    at = F.expr("coalesce(few, transform(filter(many, (e, j) -> e.x <=> get(many, j - 1).x OR e.x <=> get(many, j + 1).x), e -> e.i))")
    listed = listed.withColumn("at", at).drop("few", "many")
    covered = F.expr("CAST(CASE WHEN at IS NULL THEN 0 ELSE size(array_distinct(flatten(transform(at, i -> array(i, i + 1, i + 2))))) END AS BIGINT)")
    return listed.withColumn("n_repeat_words", covered).drop("at")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _key(*columns: str) -> Column:
    return F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), F.regexp_replace(c, "/", "//")), F.lit("null")) for c in columns])


def bucket(value: Column) -> Column:
    """A value's bucket in a sketch: itself below 64, else its six leading bits."""
    return F.when(value < 64, value).otherwise(F.floor(value / F.pow(F.lit(2), F.length(F.bin(value)) - 6)) * F.pow(F.lit(2), F.length(F.bin(value)) - 6)).cast("long")


def measures_of(counts: DataFrame) -> DataFrame:
    """The whole-number measures that rules are about; null where a text has none."""
    return counts.withColumns({
        "mean_length": F.expr("CASE WHEN n_words > 0 THEN 100 * word_chars DIV n_words END"),
        "symbols": F.expr("CASE WHEN n_words > 0 THEN 1000 * n_symbols DIV n_words END"),
        "dup_lines": F.expr("CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines DIV n_lines END"),
        "repeats": F.expr("CASE WHEN n_words > 0 THEN 1000 * n_repeat_words DIV n_words END"),
        "own_key": _key("lang", "source"),
        "lang_key": _key("lang"),
    })


def sketch(rows: DataFrame) -> DataFrame:
    """Sketches of the measures by group: (own_key, lang_key, measure, bucket, n)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in SPREAD])).alias("m")
    return rows.select("own_key", "lang_key", pairs).select("own_key", "lang_key", "m.*").groupBy("own_key", "lang_key", "measure", "bucket").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, *keys: str) -> DataFrame:
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, key: str) -> DataFrame:
    """For each key, its number of documents and each measure's bounds, from the sketches' quantiles."""
    order = Window.partitionBy(key, "measure").orderBy("bucket")
    total = F.sum("n").over(Window.partitionBy(key, "measure"))
    upto = sketches.select(key, "measure", "bucket", F.sum("n").over(order).alias("upto"), total.alias("total"))
    at = lambda q: F.min(F.when(100 * F.col("upto") >= q * F.col("total"), F.col("bucket")))
    q = upto.groupBy(key, "measure").agg(F.max("total").alias("total"), at(10).alias("q10"), at(50).alias("q50"), at(90).alias("q90"))
    least = F.create_map(*[x for m, s in SPREAD.items() for x in (F.lit(m), F.lit(s))])[F.col("measure")]
    bounds = q.select(key, "measure", "total", (F.col("q90") + REACH * F.greatest(F.col("q90") - F.col("q50"), least)).alias("upper"), (F.col("q10") - REACH * F.greatest(F.col("q50") - F.col("q10"), least)).alias("lower"))
    pick = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c)))
    return bounds.groupBy(key).agg(F.max("total").alias("total"), *[pick(m, "upper").alias(f"{m}_upper") for m in SPREAD], pick("mean_length", "lower").alias("mean_length_lower"))


def judge(docs: DataFrame) -> DataFrame:
    """Counts of each document, whether it fails the base rules, and whether it is kept."""
    rows = measures_of(written(measure(docs), "measures")).withColumn("base_failed", base_failed())
    sketches = written(sketch(rows.where(~F.col("base_failed"))), "sketches")
    own = fences(merge(sketches, "own_key", "lang_key"), "own_key")
    by_lang = fences(merge(sketches, "lang_key"), "lang_key")
    whole = F.substring("own_key", 1, 0)  # equal in all groups, but no constant: the one row of all is joined by a key like the others
    of_all = fences(merge(sketches.withColumn("all_key", whole), "all_key"), "all_key")
    names = [c for c in own.columns if c not in ("own_key", "total")]
    pack = lambda d, key, name: d.select(key, F.when(F.col("total") >= SUPPORT, F.struct(*names)).alias(name))
    groups = sketches.select("own_key", "lang_key").distinct()
    chosen = (
        groups.join(pack(own, "own_key", "f0"), "own_key", "left")
        .join(pack(by_lang, "lang_key", "f1"), "lang_key", "left")
        .withColumn("all_key", whole)
        .join(of_all.select("all_key", F.struct(*names).alias("f2")), "all_key", "left")
        .select("own_key", F.coalesce("f0", "f1", "f2").alias("fence"))
    )
    chosen = written(chosen, "fences")
    judged = rows.join(F.broadcast(chosen) if chosen.count() <= GROUPS else chosen, "own_key", "left")
    over = [F.col(m) > F.col(f"fence.{m}_upper") for m in SPREAD]
    rejected = over[0] | over[1] | over[2] | over[3] | (F.col("mean_length") < F.col("fence.mean_length_lower"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~F.coalesce(rejected, F.lit(False))).alias("kept"))


#: The same rows in DuckDB SQL.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
u AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM u),
c AS (SELECT r, count(DISTINCT i + o) AS n_repeat_words FROM g, range(3) x(o) WHERE n > 1 GROUP BY r),
m AS (
  SELECT d.r, doc_id, coalesce('=' || replace(lang, '/', '//'), 'null') AS lang_key,
         coalesce('=' || replace(lang, '/', '//'), 'null') || '/' || coalesce('=' || replace(source, '/', '//'), 'null') AS own_key,
         len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             CASE WHEN n_words > 0 THEN 100 * word_chars // n_words END AS mean_length,
             CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words END AS symbols,
             CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines END AS dup_lines,
             CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words END AS repeats FROM m),
long AS (SELECT own_key, lang_key, measure, v FROM (SELECT * FROM b WHERE NOT base_failed) UNPIVOT (v FOR measure IN (mean_length, symbols, dup_lines, repeats))),
k AS (SELECT own_key, lang_key, measure, CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END AS bucket, count(*) AS n FROM long GROUP BY ALL),
lv AS (SELECT 0 AS level, own_key AS key, measure, bucket, sum(n) AS n FROM k GROUP BY ALL
       UNION ALL SELECT 1, lang_key, measure, bucket, sum(n) FROM k GROUP BY ALL
       UNION ALL SELECT 2, 'all', measure, bucket, sum(n) FROM k GROUP BY ALL),
cum AS (SELECT level, key, measure, bucket, sum(n) OVER (PARTITION BY level, key, measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY level, key, measure) AS total FROM lv),
q AS (SELECT level, key, measure, max(total) AS total, min(bucket) FILTER (100 * upto >= 10 * total) AS q10,
             min(bucket) FILTER (100 * upto >= 50 * total) AS q50, min(bucket) FILTER (100 * upto >= 90 * total) AS q90 FROM cum GROUP BY ALL),
f AS (SELECT *, CASE measure WHEN 'mean_length' THEN 50 WHEN 'symbols' THEN 30 ELSE 100 END AS least FROM q),
fence AS (SELECT level, key, max(total) AS total,
            max(q90 + 3 * greatest(q90 - q50, least)) FILTER (measure = 'mean_length') AS mean_length_upper,
            max(q10 - 3 * greatest(q50 - q10, least)) FILTER (measure = 'mean_length') AS mean_length_lower,
            max(q90 + 3 * greatest(q90 - q50, least)) FILTER (measure = 'symbols') AS symbols_upper,
            max(q90 + 3 * greatest(q90 - q50, least)) FILTER (measure = 'dup_lines') AS dup_lines_upper,
            max(q90 + 3 * greatest(q90 - q50, least)) FILTER (measure = 'repeats') AS repeats_upper FROM f GROUP BY ALL),
pick AS (SELECT own_key, CASE WHEN a.total >= 50 THEN a WHEN l.total >= 50 THEN l ELSE o END AS x
         FROM (SELECT DISTINCT own_key, lang_key FROM k) g
         LEFT JOIN fence a ON a.level = 0 AND a.key = g.own_key LEFT JOIN fence l ON l.level = 1 AND l.key = g.lang_key LEFT JOIN fence o ON o.level = 2)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(mean_length > x.mean_length_upper OR mean_length < x.mean_length_lower OR symbols > x.symbols_upper
         OR dup_lines > x.dup_lines_upper OR repeats > x.repeats_upper, false) AS kept
FROM b LEFT JOIN pick USING (own_key)
"""
