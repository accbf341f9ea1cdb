import re

import pytest
from compare import duckdb_rows, rows_of
from pyspark.sql import functions as F

from sheafwork.llm import code_search, quality, queries, token_counts
from sheafwork.llm.common import written
from sheafwork.storage import folders, scratch


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert rows_of(queries.QUERIES[name](spark, sf_dir).toPandas()) == duckdb_rows(queries.ORACLES[name], sf_dir)


def test_counts_of_texts(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "a b c a b c", "en", "a"), (4, "x\nx\n \nx", "en", None), (5, "#a $b <c>", "en", "a"), (5, "#a $b <c>", "en", "a"), (6, "w " * 5000, "de", "b"), (7, " ".join(f"k{i % 40}" for i in range(400)), "de", "b"), (None, "é ß\x0bz", "en", "a")]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, lang string, source string, n_words int")

    def plain(text):
        import re

        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in (i, i + 1, i + 2)} if len(words) < 1000 else set(range(len(words)))
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = quality.judge(docs).select("doc_id", *names, "base_failed", "kept").collect()
    want = [(r[0], *plain(r[1])) for r in rows]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["kept"] and r["base_failed"]) for r in got)
    assert quality.judge(docs.limit(0)).count() == 0


def test_sketches_merge(spark):
    rows = spark.range(3000).select(F.lit("k").alias("own_key"), F.lit("k").alias("lang_key"), *[((F.col("id") * 7919) % 5000).alias(m) for m in quality.SPREAD])
    whole = {tuple(r) for r in quality.merge(quality.sketch(rows), "own_key").collect()}
    parts = quality.sketch(rows.where("mean_length < 2000")).unionByName(quality.sketch(rows.where("mean_length >= 2000")))
    assert whole == {tuple(r) for r in quality.merge(parts, "own_key").collect()}
    fence = quality.fences(quality.merge(quality.sketch(rows), "own_key"), "own_key").first()
    exact = sorted((i * 7919) % 5000 for i in range(3000))
    q50, q90 = exact[1499], exact[2699]
    assert abs(fence["symbols_upper"] - (q90 + 3 * (q90 - q50))) <= (q90 + 3 * (q90 + q50)) / 16


def test_batches_are_idempotent(spark):
    kind = "kind string, source string, lang string, tokenizer_version string, n_tokens long, old_version string, old_tokens long, n_docs string"
    first = spark.createDataFrame([("insert", "a", "en", "v1", 5, None, None, "x"), ("insert", "a", None, "v1", 7, None, None, "x"), ("insert", "a", "en", "v1", None, None, None, "x")], kind)
    second = spark.createDataFrame([("revise", "a", "en", "v2", 9, "v1", 5, "x"), ("delete", "a", None, "v1", 7, None, None, "x")], kind)
    store = token_counts.Rollup(spark, scratch(spark, "rollup"))
    assert store.totals().count() == 0
    store.compact()
    for _ in range(3):
        store.commit("1", first)
        store.commit("2", second)
        store.commit("3", first.limit(0))
    want = {("a", "en", "v2", 1, 9), ("a", "en", "v1", 1, 0)}
    assert {tuple(r) for r in store.totals().collect()} == want
    for _ in range(2):
        store.compact()
        assert store.commit("1", first) is False
        assert {tuple(r) for r in store.totals().collect()} == want
    assert store.commit("5", first) and not store.commit("5", first)
    want = {("a", "en", "v2", 1, 9), ("a", "en", "v1", 3, 5), ("a", None, "v1", 1, 7)}
    assert {tuple(r) for r in store.totals().collect()} == want
    store.compact()
    assert not store.commit("5", first) and {tuple(r) for r in token_counts.Rollup(spark, store.path).totals().collect()} == want
    assert not {"batch=1", "batch=2", "batch=5"} & set(re.findall(r"batch=\w+", store.totals()._jdf.queryExecution().toString()))  # parts that the base holds aren't read
    store.prune()
    assert folders(spark, f"{store.path}/deltas") == [] and {tuple(r) for r in store.totals().collect()} == want
    assert not store.commit("5", first) and not store.commit("1", first)
    with pytest.raises(Exception, match="no such change"):
        store.commit("4", spark.createDataFrame([("other", "a", "en", "v1", 1, None, None, "x")], kind))
    assert {tuple(r) for r in store.totals().collect()} == want and store.commit("4", first.limit(1))


def test_token_counts(spark):
    import public_tokenizers as P

    versions = {v: P.path(f"{v}.tiktoken") for v in ("byte_bpe_50k", "byte_bpe_multi_50k")}
    rows = spark.createDataFrame([(1, None, 5), (2, "", 5), (2, "", 5), (3, "word " * 40_000, None), (None, "é", 1)], "doc_id long, text string, n_tokens long")
    got = token_counts.count_tokens(rows, versions, P.PATTERN, keep=["doc_id", "n_tokens"]).collect()
    assert len(got) == 5 and all(r[v] == 0 for r in got for v in versions if r["doc_id"] in (1, 2))
    assert all(40_000 <= r[v] <= 40_002 for r in got for v in versions if r["doc_id"] == 3) and {r["n_tokens"] for r in got} == {5, None, 1}
    assert token_counts.count_tokens(rows.limit(0), versions, P.PATTERN).collect() == []


def test_totals_of_documents(spark, sf_dir):
    import collections

    import public_tokenizers as P
    import tiktoken

    from sheafwork.llm.bpe import read_ranks

    encode = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={}).encode_ordinary
    want, seen = collections.defaultdict(lambda: [0, 0]), set()
    for r in sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        if r["text"] not in seen:
            seen.add(r["text"])
            total = want[r["source"], r["lang"], "byte_bpe_multi_50k"]
            total[0] += 1
            total[1] += len(encode(r["text"] or ""))
    got = {tuple(r)[:3]: list(r)[3:] for r in queries.QUERIES["op8_token_rollup"](spark, sf_dir).collect()}
    assert got == want


def test_nearest_codes(spark):
    import random

    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(4)]
    code = {i: (centres[i % 4] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) if i % 3 else centres[0]) for i in range(160)}
    rows = [(i, [1.0 if c >> b & 1 else -1.0 for b in range(64)], "x") for i, c in code.items()] + [(7, [1.0 if code[7] >> b & 1 else -1.0 for b in range(64)], "x"), (500, None, "x"), (None, [1.0] * 64, "x")]
    codes = written(code_search.sign_codes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, code string")), "codes")
    got = {(r["query_id"], r["rank"], r["id"], r["distance"]) for r in code_search.nearest(codes, codes.where("id % 40 = 0"), k=5).collect()}
    want = set()
    for q in range(0, 160, 40):
        near = sorted((bin(code[q] ^ c).count("1"), i) for i, c in code.items() if i != q)[:5]
        want |= {(q, n + 1, i, d) for n, (d, i) in enumerate(near)}
    assert got == want
    few = codes.where("id < 3")
    assert code_search.nearest(few, few, k=5).count() == 6
    assert code_search.nearest(codes.where("false"), codes.where("false"), k=5).count() == 0


def test_probes_are_never_broadcast(spark, monkeypatch):
    plans = []

    def noted(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, name)

    monkeypatch.setattr(code_search, "written", noted)
    codes = written(spark.range(600).selectExpr("id", "xxhash64(id DIV 3) AS code"), "codes")
    assert code_search.nearest(codes, codes.where("id % 50 = 0"), k=5).count() == 60
    steps = [plan for name, plan in plans if name == "code-best"]
    assert steps and all("SortMergeJoin [segment" in plan and "BroadcastHashJoin [segment" not in plan for plan in steps)
