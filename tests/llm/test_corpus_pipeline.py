import random

import corpus_pipeline as C
import pytest
from brute import jaccard_components
from pyspark.sql import functions as F

from sheafwork.llm import langid, toxicity
from sheafwork.llm.common import held_out

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, kept_id string, `__score` string, `my col` struct<`a b`:int>"
WORDS = {"en": "the cat house goes over hill and river with many old friends today".split(), "de": "der hund und die katze laufen gern durch den wald nach hause".split()}


OWN = ["".join(f"Own {word} the hill {i} river {k} friend. " for i, k in zip(range(9), "abcdefghi")) for word in ("house", "cat")]


def sentence(rng, lang, n=9):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "en"]) for _ in range(n)) + "."


def table():
    rng = random.Random(6)
    texts = [(i, " ".join(sentence(rng, "en" if i % 3 else "de") for _ in range(6)), "en" if i % 3 else "de") for i in range(120)]
    toxic = set(range(0, 120, 4))
    texts = [(i, x.replace(".", " you idiot and moron.", 2) if i in toxic else x, lang) for i, x, lang in texts]
    passage = " ".join(sentence(rng, "en", 14) for _ in range(6))
    near = " ".join(sentence(rng, "en", 12) for _ in range(12))
    texts += [(200, near, "en"), (201, near + " Extra.", "en"), (202, OWN[0] + passage, "en"), (203, OWN[1] + passage, "en"), (204, near, "en")]
    texts += [(210, None, "en"), (211, "", "en"), (212, "123 456", None), (213, sentence(rng, "de", 80), "en"), (214, "the cat " * 30_000, "en"), (215, None, None), (200, near, "en"), (200, sentence(rng, "en", 50), "en"), (None, sentence(rng, "en", 40), None), (None, sentence(rng, "de", 40), "de")]
    rows = [(i, x, lang, "s", None if x is None else len(x), 0.5, "xx", "k", "z", (1,)) for i, x, lang in texts]
    return rows, [(i, 0, int(i in toxic)) for i in range(120)]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    rows, labels = table()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return str(base), spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")


def ids(rows):
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=str)


def test_toxicity_rejects_by_the_machine(spark, made):
    base, docs, labels = made
    out = C.toxicity(spark, docs, base)
    assert out.columns == docs.columns
    scorer = toxicity.Scorer(toxicity.learn_toxicity(docs, labels, ~held_out("doc_id")))
    rows = docs.collect()
    assert ids(out.collect()) == ids([r for r, s in zip(rows, scorer.scores([r["text"] for r in rows])) if s < 0.5])
    left = {r["doc_id"] for r in out.collect()}
    assert not left & set(range(0, 120, 4)) and set(range(1, 120, 4)) <= left


def test_language_rejects_no_letters_and_contradictions(spark, made):
    base, docs, _ = made
    out = C.language_id(spark, docs, base)
    assert out.columns == docs.columns
    ranker = langid.Ranker(langid.learn_profiles(docs, ~held_out("doc_id")))
    found = [(r, *ranker.predict(r["text"])) for r in docs.collect()]
    assert ids(out.collect()) == ids([r for r, lang, score in found if lang != "und" and not (r["lang"] is not None and lang != r["lang"] and score >= C.CONTRADICTION)])
    gone = set(ids(docs.collect())) - set(ids(out.collect()))
    assert {210, 211, 212, 215} <= {i for i, _ in gone} and not any(x for i, x in gone if i is None)


def test_near_duplicates_keep_one_of_each_group(spark, made):
    base, docs, _ = made
    out = C.near_duplicates(spark, docs, base)
    assert out.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]
    once = sorted(set(rows), key=str)
    groups = jaccard_components([(i, x) for i, (_, x) in enumerate(once)], percent=80, words=5)
    least = {}
    for k, (i, x) in enumerate(once):
        least[groups[k, x][1]] = min(least.get(groups[k, x][1], i), i)
    kept = {i for k, (i, x) in enumerate(once) if least[groups[k, x][1]] == i}
    want = [r for r in once if r[0] in kept] + [(None, r["text"]) for r in docs.where("doc_id IS NULL").collect()]
    assert ids(out.collect()) == sorted(want, key=str)
    assert {i for i, _ in want} >= {200, 202, 203} and not {i for i, _ in want} & {201, 204}


def test_spans_and_packing_work_on_what_is_kept(spark, made):
    base, docs, _ = made
    out = C.substring_dedup(spark, docs, base)
    assert out.columns == docs.columns and out.count() == docs.count()
    by_id = {r["doc_id"]: r for r in out.collect()}
    assert by_id[203]["text"] == OWN[1] and by_id[203]["n_chars"] == len(OWN[1]) and by_id[202]["text"].startswith(OWN[0]) and len(by_id[202]["text"]) > len(OWN[0]) + 300 and by_id[210]["text"] is None
    pieces = C.packing(spark, out, base)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}


def test_whole_run(spark, made):
    base, docs, _ = made
    now = docs
    for i, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, now, base)
        now = spark.createDataFrame(out.collect(), out.schema)
        assert i == len(C.STAGES) - 1 or now.columns == docs.columns
    got = C.run(spark, base)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = lambda df: df.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n"))
    assert set(key) <= set(got.columns) and sorted(map(tuple, whole(got).collect()), key=str) == sorted(map(tuple, whole(now).collect()), key=str)


def test_empty_tables(spark, tmp_path, made):
    _, docs, labels = made
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def replaced(n, *places):
    return " ".join("other" if i in places else f"w{i}" for i in range(n))


def test_near_duplicates_between_the_thresholds(spark, sf_dir):
    # one word of 50: 0.804 on five words, 0.843 on four; one word of 40: 0.756 on five
    rows = [(1, replaced(50)), (2, replaced(50, 25)), (3, "a " + replaced(40).replace("w", "v")), (4, "a " + replaced(40, 20).replace("w", "v")), (None, replaced(50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r["doc_id"] for r in C.near_duplicates(spark, docs, sf_dir).collect()), key=str) == [1, 3, 4, None]


def test_texts_that_neither_go_nor_repeat_do_not_move(spark):
    rng = random.Random(8)
    text = lambda: " ".join(f"{rng.randrange(1 << 40):x}" for _ in range(2000))
    rows = [(i, text()) for i in range(200)]
    rows += [(300, rows[0][1]), (1, rows[1][1]), (2, text()), (None, text())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    store, tracker = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext.statusTracker()
    out = C.near_duplicates(spark, docs, "")
    spark.sparkContext.setJobGroup("near-duplicates", "")
    try:
        got = out.collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    moved = sum(store.lastStageAttempt(s).shuffleWriteBytes() for j in tracker.getJobIdsForGroup("near-duplicates") for s in tracker.getJobInfo(j).stageIds)
    assert ids(got) == ids([{"doc_id": i, "text": x} for i, x in set(rows) if i != 300])
    assert moved < sum(len(x) for _, x in rows) / 10
