"""Spelling variants against a plain search, on words of the given documents and on cases of their own."""

import collections
import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from sheafwork.llm import queries, spelling
from sheafwork.llm.common import table

SCHEMA = "doc_id long, text string, word string, sig int"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return len(b) - len(a) < 2 and a != b and (a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :])


def letter(c):
    return c.isascii() and c.isalpha() or "À" <= c <= "ÿ"


def plain(rows):
    count = collections.Counter()
    for doc_id, text in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for run in ("".join(g) for own, g in itertools.groupby(low, letter) if own):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: k for w, k in count.items() if len(w) >= 7 and k >= 2}
    near = collections.defaultdict(list)
    for a, b in itertools.combinations(n, 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items()}
    form = {w: b for w, b in best.items() if n[b] >= 10 * n[w]}
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def got(frame):
    rows = [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_all_words_of_the_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert got(queries.QUERIES["op11_partenum_spelling"](spark, sf_dir)) == plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_chains_ties_edges_and_nulls(spark):
    texts = ["Garland " * 400 + "garlond " * 20 + "garlonds " * 2, "anemone anemone anemune anemune " + "anemane " * 30 + "anemine " * 30, "Äpfelbaum Äpfelbaum äpfelbaum äpfelbaum x×÷ßÿẞ", "kurz kurz abcdefg abcdefgh abcdefg abcdefgh abcdef abcdef", None, "", "a" * 7 + " " + "a" * 7, "zyxwvut\tzyxwvut-zyxwvu zyxwvu"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "Garland garlond"), (1, texts[1])]
    found = got(spelling.spelling_variants(spark.createDataFrame([(*r, "w", 1) for r in rows], SCHEMA)))
    assert found == plain(rows)
    by = {r[0]: r for r in found}
    assert by["garlond"][1] == "garland" and by["garlonds"][1:3] == ("garlond", "garland")
    assert by["anemune"][1] == "anemane"  # of two as frequent the smaller


def test_no_rows(spark):
    assert got(spelling.spelling_variants(spark.createDataFrame([], SCHEMA))) == set()


@pytest.mark.parametrize("edit", ["", "x"])
def test_every_place_of_an_edit_shares_a_signature(spark, edit):
    words = ["abcdefghij", "ññññçççàé", "aaaaaaaaaaaaaaaa", "mississippi"]
    pairs = [(w, w[:i] + edit + w[i + k :]) for w in words for k in (0, 1) for i in range(len(w) + 1 - k) if w[:i] + edit + w[i + k :] != w]
    one = spark.createDataFrame([(x, 2) for x in sorted({x for p in pairs for x in p})], "word string, n long")
    found = {tuple(sorted(r)) for r in spelling.near_pairs(one).select("word", "other").collect()}
    assert {tuple(sorted(p)) for p in pairs} <= found


def test_signatures_are_fewer_than_pairs(spark, sf_dir):
    known = spelling.words(table(spark, sf_dir, "documents"))
    rows = spelling.signatures(known)
    assert rows.count() == known.count() * 2 * spelling.STRETCHES * (spelling.HAMMING + 1)
    met = rows.where("NOT longer").groupBy("sig").count().agg(F.sum(F.col("count") * (F.col("count") - 1))).first()[0]
    assert met < 20 * known.count()
