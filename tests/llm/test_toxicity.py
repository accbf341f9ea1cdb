import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from sheafwork.llm import toxicity as T
from sheafwork.llm.common import held_out


def plain_kernel(a, b):
    def features(w):
        out = {}
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i < T.SPAN:
                key = tuple(T._char_class(w[x]) for x in (i, j, k))
                out[key] = out.get(key, 0) + T.DECAY ** (k - i + 1)
        return out

    fa, fb = features(a), features(b)
    norm = lambda f: sum(v * v for v in f.values()) ** 0.5
    return sum(v * fb.get(k, 0) for k, v in fa.items()) / (norm(fa) * norm(fb))


def test_kernel_is_the_subsequence_kernel():
    words = ["idiot", "idiiot", "id-iot", "loser", "losers", "stupid", "stupidity"]
    marks = ["idiot", "loser", "stupid"]
    got = T.Landmarks(marks).kernel(words)
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            k = plain_kernel(w, m)
            wide = k**T.STEEP * (1 + T.MIDDLE**T.STEEP) / (k**T.STEEP + T.MIDDLE**T.STEEP)
            assert abs(got[i, j] - (wide if wide >= T.NOTHING else 0)) < 1e-4 and abs(got[i, j + 3] - (T.NARROW * k**T.SHARP if wide >= T.NOTHING else 0)) < 1e-4


def test_long_words_have_the_same_kernel(monkeypatch):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("idotxy"), n)) for n in (24, 25, 26, 60, 300)] + ["x" * 40 + "idiot", "idiotidiotidiotidiotidiot"]
    marks = T.Landmarks(["idiot", "toxid", "idiotidiotidiotidiotidioxt"[:24]])
    for stretch in (1 << 16, 7):
        monkeypatch.setattr(T, "_STRETCH", stretch)
        at, values = marks.similar(words)
        got = dict(zip(at.tolist(), values))
        for i, w in enumerate(words):
            for j, m in enumerate(marks.words):
                k = plain_kernel(w, m)
                assert abs((got[i][j] if i in got else 0) - (k if k >= T.LEAST else 0)) < 1e-4


def test_bound_loses_no_word():
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abeilno"), n)) for n in rng.integers(3, 14, 3000)]
    marks = T.Landmarks(["banane", "linie", "bell", "ebene"])
    found = set(marks.similar(words)[0].tolist())
    for i in rng.integers(0, 3000, 400).tolist():
        k = max(plain_kernel(words[i], m) for m in marks.words)
        assert (i in found) == (k >= T.LEAST) or abs(k - T.LEAST) < 1e-5


#: Insults of the documents, to alter.
INSULTS = ["stupid", "trash", "loser", "worthless", "idiot", "scum", "pathetic", "disgusting", "moron", "clown"]


def tolerated(rows, machine):
    """Documents that are caught as they stand are caught with each insult altered, in most cases."""
    rng = random.Random(7)
    insult = re.compile(r"\b(" + "|".join(INSULTS) + r")\b", re.I)
    at = lambda w: rng.randrange(1, len(w) - 1)
    alter = {
        "letter put in": lambda w: w[: (i := at(w))] + rng.choice("abcdefghijklmnopqrstuvwxyz") + w[i:],
        "sign put in": lambda w: w[: (i := at(w))] + rng.choice("*_-$.") + w[i:],
        "letter left out": lambda w: w[: (i := at(w))] + w[i + 1 :],
        "dashes": lambda w: "-".join(w),
        "blanks": lambda w: " ".join(w),
    }
    caught = [r.text for r in rows if r.score >= 0.5 and insult.search(r.text)]
    assert len(caught) > 40
    for kind, change in alter.items():
        share = np.mean(np.array(T.Scorer(machine).scores([insult.sub(lambda m: change(m[0]), x) for x in caught])) >= 0.5)
        assert share >= 0.8, (kind, share)


def test_held_out_documents_of_all_languages(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    machine = T.learn_toxicity(docs, labels, ~held_out("doc_id"))
    found = T.score_toxicity(docs.where(held_out("doc_id")), machine, keep=["doc_id", "lang"]).join(labels, "doc_id")
    counts = [F.count_if(F.expr(c)).alias(n) for n, c in (("hit", "toxic = 1 AND score >= 0.5"), ("toxic", "toxic = 1"), ("false", "toxic = 0 AND score >= 0.5"), ("clean", "toxic = 0"))]
    by_lang = {r["lang"]: r for r in found.groupBy("lang").agg(*counts).collect()}
    assert len(by_lang) == 4
    assert sum(r["hit"] for r in by_lang.values()) / sum(r["toxic"] for r in by_lang.values()) > 0.85
    for r in by_lang.values():
        assert r["hit"] / r["toxic"] > 0.75 and r["false"] / r["clean"] < 0.03
    tolerated(found.where("toxic = 1").join(docs.select("doc_id", "text"), "doc_id").select("text", "score").collect(), machine)
    gapped = spark.createDataFrame([(1, "you l o s e r you"), (2, "what an idiiot"), (3, "the house on the hill"), (4, None), (5, ""), (5, "")], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in T.score_toxicity(gapped, machine).collect()}
    assert score[1] > score[3] and score[2] > score[3] and score[4] == score[5] <= 0.5


def plain_decision(machine, text):
    """Tries all runs of the text's different sentences."""
    rows = []
    for chunks in T.cut(text or ""):
        rows.append((sum(machine.word_weights([w])[0] for w in T.words_of(chunks)), len(chunks)))
    return max([0.0] + [sum(v - T.COST * n for v, n in rows[a:b]) for a in range(len(rows)) for b in range(a + 1, len(rows) + 1)])


def test_scores_are_those_of_the_worst_run(spark):
    machine = T.Machine(T.Landmarks(["idiot", "stupid", "house"]), np.array([1.0, 0.7, -0.4, 0.2, 0.1, 0.0]), 0.5, 4.0)
    texts = ["You idiot. Go home. What a stupid house! Such idiocy.", "A house.\nA house.", "idiot " * 3 + "word " * 9_000 + "stupid", "One two. " * 50 + "stupid. idiot.", "", None, "l o s e r. i d i o t", "You idiot. You idiot. You idiot."]
    want = [machine.probability(plain_decision(machine, x)) for x in texts]
    assert np.allclose(T.Scorer(machine).scores(texts), want)
    rows = spark.createDataFrame([(i, x, 0.25, "a") for i, x in enumerate(texts)] + [(None, "idiot", None, None)] * 2, "`my id` long, text string, score double, `a b` string")
    found = T.score_toxicity(rows, machine, id_col="my id", keep=rows.columns, out="score_").collect()
    assert len(found) == len(texts) + 2 and all(abs(r["score_"] - want[r["my id"]]) < 1e-9 and r["score"] == 0.25 for r in found if r["my id"] is not None)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    machine = T.learn_toxicity(docs, labels, ~held_out("doc_id"))
    assert [r["score"] for r in T.score_toxicity(docs, machine).collect()] == [0.0]
    assert T.score_toxicity(docs.limit(0), machine).count() == 0


def test_stops_inside_words():
    marks = T.Landmarks(["idiot", "stupid"])
    machine = T.Machine(marks, np.ones(4) / 2, 0.4, 4.0)
    texts = ["id!ot", "i.d.i.o.t", "idiot.Go", "you st.upid man", "you idiot.Go home", "l o s e r. You idiot!) Go.", "i d i o t. Go", "You i d i o t!"]
    together = T.Scorer(machine)
    together.scores(["idiot stupid", "Go home."])
    clean = T.Scorer(machine).scores(["the house"])[0]
    for text in texts:
        fresh = T.Scorer(machine).scores([text])[0]
        assert fresh > 0.5 > clean
        assert abs(fresh - machine.probability(plain_decision(machine, text))) < 1e-6 and abs(together.scores([text])[0] - fresh) < 1e-9
    assert T.cut('One two three. "Four five!" Six.seven\neight\neight') == [("One", "two", "three."), ('"Four', 'five!"'), ("Six.seven",), ("eight",)]
    assert T.words_of(("Six.seven", "six", "of")) == ["six.seven", "sixseven", "six", "seven"] and T.words_of(("l", "o", "s", "e", "r.")) == ["loser"]
    assert T.words_of(("i-d-i-o-t", "well_known")) == ["i-d-i-o-t", "idiot", "well_known", "wellknown", "well", "known"] and T.words_of(("l", "o", "l", "x")) == ["lolx"] and T.words_of(("a", "b")) == []
