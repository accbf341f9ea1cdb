"""Spelling variants by PartEnum signatures over letter multisets, for words one edit apart.

A word's letters, counted, are a binary vector with one place for each letter and copy. One edit moves at most two places, so
of three parts of the places one at least is the same in both words: each word has a signature for each part, and signatures
meet in an equi-join. Words made of the same letters in another order would all meet, so a signature also holds what one edit
leaves of the word's order: of three stretches of the shorter word two stay whole, the one before and the one behind the edit.
Pairs that meet are verified by their edit distance. All of it is columns; no Python runs over rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Letters of words, and the fewest of a word that is looked at.
LETTERS, LEAST = r"A-Za-zÀ-ÿ", 7
#: A run whose hash this divides loses a letter.
EVERY = 31
#: A form occurs so many times as often as its variant.
TIMES = 10
#: Differing places at most of two words one edit apart; one part more keeps one part whole. Stretches of a word, by the same rule for one edit.
HAMMING, STRETCHES = 2, 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALPHABET = _LOWER + "".join(map(chr, range(0xC0, 0x100)))


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(word, n): words of at least ``least`` letters that occur twice or more in all texts, after the deletions by hash.

    A null text has no words; a null id counts as an empty one in the hash.
    """
    # a maximal run that is shorter can't give a word
    runs = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{least},}}"), 0)).alias("run")
    lowered = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), runs).withColumn("run", F.translate("run", _UPPER, _LOWER))
    h, size = F.crc32(F.concat_ws(":", "id", "run").cast("binary")), F.length("run")
    cut = F.pmod(F.col("h"), F.col("size")).cast("int")
    left = F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.col("size")))
    found = lowered.withColumns({"h": h, "size": size}).select(F.when(F.pmod("h", F.lit(EVERY)) == 0, left).otherwise(F.col("run")).alias("word"))
    return found.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")


def signatures(rows: DataFrame) -> DataFrame:
    """(sig, word, n, longer): the signatures of each word, as one of a pair of its own length or the shorter one, and as the longer one."""
    parts = HAMMING + 1
    ordered = F.array_join(F.array_sort(F.split("word", "")), "")
    letters = [F.translate(ordered, "".join(c for c in _ALPHABET if ord(c) % parts != p), "") for p in range(parts)]
    held = rows.select("word", "n", F.length("word").alias("size"), *[x.alias(f"p{p}") for p, x in enumerate(letters)])
    at = lambda m, j: F.floor(m * j / STRETCHES).cast("int")
    out = []
    for longer in (False, True):
        m = F.col("size") - 1 if longer else F.col("size")
        for j in range(STRETCHES):
            behind = m - at(m, j + 1)
            kept = [F.substring("word", F.lit(1), at(m, j)), F.substring("word", F.col("size") - behind + 1, behind)]
            out += [F.struct(F.xxhash64(m, F.lit(parts * j + p), *kept, F.col(f"p{p}")).alias("sig"), F.lit(longer).alias("longer")) for p in range(parts)]
    return held.select("word", "n", F.inline(F.array(*out)))


def near_pairs(rows: DataFrame) -> DataFrame:
    """(word, other, n, other_n): pairs of different words one edit apart, once each."""
    sigs = signatures(rows)
    a = sigs.where("NOT longer").select("sig", "word", "n")
    b = sigs.select("sig", F.col("word").alias("other"), F.col("n").alias("other_n"), "longer")
    met = a.join(b, "sig").where((F.col("longer") | (F.col("word") < F.col("other"))) & (F.levenshtein("word", "other", 1) == 1))
    return met.groupBy("word", "other").agg(F.first("n").alias("n"), F.first("other_n").alias("other_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the steps from word to form end, by doubling; forms only grow in frequency, so steps are few and end."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.join(now.select(F.col("word").alias("root"), F.col("root").alias("next")), "root")
        if further.isEmpty():
            return now
        now = written(now.join(now.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of all texts that occurs twice or more.

    Words are runs of letters, lower-cased from A to Z, of which some lose a letter by a hash of document and run. Near words
    are one edit apart; the form of a word is its most frequent near word (of ties the smallest) that occurs at least
    ``TIMES`` times as often, the root the last of the forms in a row. Null texts have no words, null ids count as empty,
    repeated rows count again, an empty table gives no rows; other columns are ignored.
    """
    known = written(words(docs, doc_id, text), "words")
    pairs = written(near_pairs(known), "near")
    both = pairs.select("word", "n", "other", "other_n").unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.first("n").alias("own"), F.min(F.struct((-F.col("other_n")).alias("k"), "other")).alias("top"))
    enough = -F.col("top.k") >= TIMES * F.col("own")
    near = written(best.select("word", "n_near", F.when(enough, F.col("top.other")).alias("form"), F.when(enough, -F.col("top.k")).alias("form_n")), "near")
    last = roots(near.where("form IS NOT NULL"))
    joined = known.join(near, "word", "left").join(last, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


_BYTES = "list_transform(range(octet_length(encode(x)) ::BIGINT), lambda i: ('0x' || substr(hex(encode(x)), 2 * i + 1, 2))::BIGINT)"
_CRC = f"xor(list_reduce(list_prepend(4294967295, {_BYTES}), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"

#: Pairs meet where one is the other less a letter, or both are the same less the one at a place; the levels of forms are walked one by one.
SQL = f"""
WITH RECURSIVE r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents),
u AS (SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS x, count(*) AS k FROM r WHERE length(run) >= {LEAST} GROUP BY ALL),
h AS (SELECT run, k, {_CRC} AS h FROM u),
w AS (SELECT CASE WHEN h % {EVERY} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(k)::BIGINT AS n FROM h GROUP BY 1),
v AS (SELECT word, n FROM w WHERE length(word) >= {LEAST} AND n >= 2),
d AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS less FROM (SELECT *, unnest(range(length(word))) AS i FROM v)),
i AS (SELECT DISTINCT d.word, d.n, v.word AS other, v.n AS other_n FROM d JOIN v ON v.word = d.less),
p AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM d a JOIN d b USING (less, i) WHERE a.word <> b.word
  UNION ALL FROM i UNION ALL SELECT other, other_n, word, n FROM i),
b AS (SELECT word, n, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM p GROUP BY word, n),
f AS (SELECT word, n_near, CASE WHEN other_n >= {TIMES} * n THEN other END AS form, CASE WHEN other_n >= {TIMES} * n THEN other_n END AS form_n FROM b),
s AS (SELECT word, form AS place, 1 AS step FROM f WHERE form IS NOT NULL UNION ALL SELECT s.word, f.form, step + 1 FROM s JOIN f ON f.word = s.place WHERE f.form IS NOT NULL),
l AS (SELECT word, max_by(place, step) AS root FROM s GROUP BY word)
SELECT v.word, form, coalesce(root, v.word) AS root, v.n, coalesce(n_near, 0) AS n_near, form_n FROM v LEFT JOIN f USING (word) LEFT JOIN l USING (word)
"""
