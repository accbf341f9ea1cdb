import random

import numpy as np
from brute import jaccard_components as plain

from sheafwork.llm import shingle_join as S


def family(rng, n, size, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n string").repartition(3)
    got = sorted(map(tuple, S.jaccard_components(df, **kw).collect()), key=str)
    want = plain(rows)
    assert got == sorted(((r[0], *want[r]) for r in rows), key=str)


def test_same_as_brute_force(spark):
    rng = random.Random(3)
    texts = [t for size, edits in ((30, 2), (80, 4), (200, 9), (12, 1)) for t in family(rng, 12, size, edits)] + [" ".join(f"w{rng.randrange(30)}" for _ in range(40)) for _ in range(40)]
    check(spark, list(enumerate(texts)))


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (5, "ONE  two"), (None, "one two"), (6, "one"), (7, "É a b c d e"), (8, "é a b c d e"), (9, "a " * 5000), (10, "a " * 7)]
    check(spark, rows)


def test_empty_table(spark):
    assert S.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 400)
    monkeypatch.setattr(S.verified_links, "__defaults__", (400,))
    rng = random.Random(5)
    check(spark, list(enumerate(family(rng, 40, 60, 5) + family(rng, 10, 66, 3))))
    base = family(rng, 1, 60, 0)[0].split()
    far = [" ".join(base[: 60 - 3 * i] + [f"z{i}q{k}" for k in range(3 * i)]) for i in range(5)]  # each links to the next only
    near = [" ".join(base[:k] + ["other"] + base[k + 1 :]) for k in (0, 1, 58, 59)] + [" ".join([*base, f"end{k}"]) for k in range(30)]
    check(spark, list(enumerate(near + far)))


def test_long_lists(spark, monkeypatch):
    monkeypatch.setattr(S, "PAIRED", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    rng = random.Random(9)
    try:
        check(spark, list(enumerate([t for size, edits in ((30, 2), (80, 5), (12, 1)) for t in family(rng, 14, size, edits)])))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_chance_pairs_make_no_groups(spark):
    rng = random.Random(11)
    other = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    passages = [other(20) for _ in range(101)]  # each text shares one with the next, so that chance ties many texts into groups
    texts = [" ".join(passages[i] + other(85) + passages[i + 1] + other(75)) for i in range(100)]
    texts += [" ".join([*texts[0].split()[:-1], "end"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frequent = S.frequent_words(docs)
    nodes = S.signatures(docs, np.empty(0, np.uint64), 85, 4, frequent).withColumnRenamed("doc_id", "node")
    assert {(r["a"], r["b"]) for r in S.candidate_edges(nodes, 85).collect()} == {(100, 0)}
    check(spark, list(enumerate(texts)))


def test_bitmaps_rule_out_no_link():
    rng = np.random.default_rng(13)
    for n in (1, 7, 64, 90, 700, 3000):
        one = rng.choice(1 << 50, n, replace=False).astype(np.uint64)
        for gone in range(0, n // 5 + 1, max(1, n // 20)):
            for new in (0, gone):
                two = np.concatenate((one[gone:], rng.choice(1 << 50, new, replace=False).astype(np.uint64)))
                both = len(np.intersect1d(one, two))
                if 100 * both >= 85 * (len(one) + len(two) - both):
                    assert S.may_link(len(one), S.parity(one), len(two), S.parity(two), 85)
    a, b = (rng.choice(1 << 50, 500, replace=False).astype(np.uint64) for _ in "ab")
    assert not S.may_link(500, S.parity(a), 500, S.parity(b), 80)


def test_divide_skip_is_exact():
    rng = random.Random(7)
    for _ in range(30):
        sets = [np.array(sorted(rng.sample(range(60), rng.randrange(20, 45))), np.uint64) for _ in range(25)]
        sets += [np.array(sorted(set(s.tolist()) - {int(s[0])}), np.uint64) for s in sets[:8]]
        links = S.divide_skip(sets, list(range(len(sets))), 85)
        real = {(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(a := set(sets[i].tolist()) & set(sets[j].tolist())) >= 85 * (len(sets[i]) + len(sets[j]) - len(a))}

        def groups(pairs, n=len(sets)):
            up = list(range(n))

            def root(i):
                while up[i] != i:
                    i = up[i]
                return i

            for a, b in pairs:
                up[root(a)] = root(b)
            return sorted(sorted(k for k in range(n) if root(k) == r) for r in {root(k) for k in range(n)})

        assert groups(links) == groups(real)
