import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from sheafwork.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = bpe.read_ranks(PATH)
    return bpe.Encoder(PATH, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = ["", " ", "\t  b", "a  b\n\n c   d\t \n", "a\x1cb !\x1c x", "I'll don't 'S 1234 ²³ Ⅷ", "日本語 テスト \U0001f600\U0001f600 é ", "x" * 300, "ab" * 200, "\x85a   b", "aaaaaaa bbbbbb", " x 　y"]


def test_same_ids_as_tiktoken(both):
    encoder, reference = both
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("aAbB eé.,'\n\t 1²ß日 ") for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    for text, (ids, raw) in zip(texts, encoder.encode(texts)):
        assert ids == ",".join(map(str, reference.encode_ordinary(text))) and raw == text.encode()


def test_long_words(both):
    encoder, reference = both
    rng = random.Random(7)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000)), "e" * 5_000, "nmmn" * 700, "日本語" * 900, "-=" * 400 + "_" * 3_000]
    for text, (ids, raw) in zip(texts, encoder.encode(texts)):
        assert ids == ",".join(map(str, reference.encode_ordinary(text))) and raw == text.encode()


def test_many_words_of_middling_length(both):
    encoder, reference = both  # the states of all these words at once are beyond the memory of a query
    rng = random.Random(5)
    parts = ["the", "ing", "ation", "er", "on", "queezz", "ß", "日本", "語", "a", "b", "x", "qu", "un"]
    texts = [""] * 4_000
    for i in range(len(texts)):
        while len(texts[i].encode()) < 232:
            texts[i] += rng.choice(parts)
    for text, (ids, raw) in zip(texts, encoder.encode(texts), strict=True):
        assert ids == ",".join(map(str, reference.encode_ordinary(text))) and raw == text.encode()


def test_frequent_units_are_kept(both, monkeypatch):
    reference = both[1]
    encoder = bpe.Encoder(PATH, P.PATTERN)
    monkeypatch.setattr(bpe, "CACHE_UNITS", 3)
    monkeypatch.setattr(bpe, "SLICE", 50, raising=False)
    monkeypatch.setattr(bpe, "BATCH", 4)
    rare = " ".join(f"rare{c}word" for c in "abcdefghij")
    for texts in ([f"{rare} often", None, "and often and often and", ""], ["often", " often and quite-new", rare, None, ""], [], [None]):
        got = list(encoder.encode(texts))
        assert [ids for ids, _ in got] == [",".join(map(str, reference.encode_ordinary(t or ""))) for t in texts]
        assert [raw for _, raw in got] == [(t or "").encode() for t in texts]
        assert len(encoder.units) == 3 and {" often", " and"} <= set(encoder.units)


def test_cuts_are_where_no_token_reaches_across(both):
    encoder, _ = both
    rng = random.Random(3)
    for _ in range(50):
        word = "".join(rng.choice("qxzjkwvyaeo") for _ in range(60)).encode()
        ends = {0}
        for i in range(1, len(word)):
            if not any(word[a:b] in encoder.ranks for a in range(i) for b in range(i + 1, len(word) + 1)):
                ends.add(i)
        parts = encoder.independent(word)
        assert b"".join(parts) == word and {sum(map(len, parts[:n])) for n in range(len(parts))} == ends


def test_documents(spark, sf_dir, both):
    rows = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (None, "Über 12 words", "z"), (2, "", "z")], "doc_id long, text string, n_tokens string")
    got = {(r[0], r[1], r[2], r[3]) for r in bpe.encode_documents(rows, PATH, P.PATTERN).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    ids = both[1].encode_ordinary("Über 12 words")
    assert got == {(1, 0, empty, empty), (2, 0, empty, empty), (None, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256("Über 12 words".encode()).hexdigest())}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r["ids_sha256"] for r in bpe.encode_documents(docs, PATH, P.PATTERN).collect()}
    for r in docs.collect():
        assert got[r["doc_id"]] == hashlib.sha256(",".join(map(str, both[1].encode_ordinary(r["text"]))).encode()).hexdigest()
    assert bpe.encode_documents(rows.limit(0), PATH, P.PATTERN).count() == 0
