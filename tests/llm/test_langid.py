import collections
import random
import re
import zlib

from pyspark.sql import functions as F

from sheafwork.llm import langid
from sheafwork.llm.common import held_out


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.predict_language(docs, langid.learn_profiles(docs, ~held_out("doc_id"))).join(docs, "doc_id").where(held_out("doc_id"))
    right, n = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right / n > 0.97


def test_fold(spark):
    ids = [0, 1, 2, 17, 12345, -4]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").select(held_out("doc_id")).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 5 == 0 for i in ids]


def test_edge_cases(spark):
    docs = spark.createDataFrame([(i, "the cat and the dog " * 4, "en", "a") for i in range(20)] + [(i, "der hund und die katze " * 4, "de", "a") for i in range(20, 40)] + [(50, None, None, "a"), (51, "", "en", "a"), (52, "12 !?", "en", "a"), (None, "the dog", None, "a"), (53, "x" * 200_000, None, "a")], "doc_id long, text string, lang string, score string")
    profiles = langid.learn_profiles(docs, ~held_out("doc_id"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict_language(docs, profiles).collect()}
    assert got[50] == got[51] == got[52] == ("und", 0.0) and got[None][0] == "en" and got[30][0] == "de" and 0 <= got[53][1] <= 1
    assert {r["lang_pred"] for r in langid.predict_language(docs, {}).collect()} == {"und"}
    assert langid.learn_profiles(docs.limit(0), ~held_out("doc_id")) == {}


def plain_profile(text, size):
    """N-grams of one to three letters, words between blanks; by falling count, equal counts by the last letter that differs."""
    line = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    line = re.sub(" +", " ", line)
    counts = collections.Counter([c for c in line if c != " "] + [line[i : i + 2] for i in range(len(line) - 1)] + [line[i : i + 3] for i in range(len(line) - 2) if line[i + 1] != " "])
    return sorted(counts, key=lambda g: (-counts[g], [ord(c) for c in (g + "\0\0")[:3][::-1]]))[:size]


def plain_predict(profiles, text, size):
    own = plain_profile(text, size)
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    apart = {lang: sum(abs(i - p.index(g)) if g in p else size for i, g in enumerate(own)) for lang, p in profiles.items()}
    first = min(sorted(apart), key=apart.get)
    others = [v for k, v in apart.items() if k != first]
    near, other = apart[first], min(others) if others else size * len(own)
    return first, other / (near + other) if near + other else 0.5


def test_predictions_are_those_of_the_plain_distance():
    rng = random.Random(8)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randrange(1, 9)))
    text = lambda letters, n: " ".join(word(letters) + rng.choice(["", "", ",", ". 1"]) for _ in range(n))
    kinds = {"a": "abcdeéß", "b": "defghiü", "c": "xyzabc"}
    for size in (5, 40, 300):
        sources = {k: text(v, 300) for k, v in kinds.items()}
        codes = {k: langid.top(*langid.grams(v), size).tolist() for k, v in sources.items()}
        profiles = {k: plain_profile(v, size) for k, v in sources.items()}
        ranker = langid.Ranker(codes, size)
        for t in [text(rng.choice(list(kinds.values())), rng.randrange(1, 60)) for _ in range(60)] + ["", "12 ?", "q", sources["a"]]:
            lang, score = ranker.predict(t)
            want = plain_predict(profiles, t, size)
            assert lang == want[0] and abs(score - want[1]) < 1e-12
