import collections
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from sheafwork.llm import packing

PATH = P.path("word_bpe_49k.json")


def test_level_keeps_sum_of_squares_least():
    rng = np.random.default_rng(2)
    for _ in range(200):
        packer = packing.Packer(16)
        packer.levels[1:16] = rng.integers(0, 3, 15)
        size = int(rng.integers(1, 16))

        def squares(level, packer=packer, size=size):
            n = packer.levels.copy()
            if level:
                n[level] -= 1
            if level + size < 16:
                n[level + size] += 1
            return int((n[1:16] ** 2).sum())

        options = [0] + [h for h in range(1, 17 - size) if packer.levels[h]]
        assert squares(packer.level_for(size)) == min(map(squares, options))


def test_every_id_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "don't IT'S x'll ,. 12.5 É́COLE 日本 ß İ <|endoftext|>"), (-6, "a<|endoftext|>B <|STARTOFTEXT|> <|startoftext|><|endoftext|> <|endoftext"), (-4, "a\x1cb " * 3000), (-5, "é,, Ä!! x&&& ÷ ×")], "doc_id long, text string")
    docs = docs.unionByName(odd)
    tokenizer = Tokenizer.from_file(PATH)
    ids = {r["doc_id"]: np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4") for r in docs.collect()}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.pack_documents(docs, PATH).collect():
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, own in ids.items():
        at = 0
        for start, length in sorted(pieces[doc]):
            assert start == at
            at += length
        assert at == len(own)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and (at == 4096 or at & (at - 1) == 0)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, None), (2, "word " * 9000), (2, "word " * 9000)]
    got = packing.pack_documents(spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, length int").repartition(2), PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = collections.Counter()
    for i, text in rows:
        want[i] += len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    have = collections.Counter()
    for r in got:
        have[r["doc_id"]] += r["length"]
    assert have == want and sum(r["start"] == 0 for r in got) == len(rows)
    filled = collections.Counter()
    for r in got:
        filled[r["sequence_id"]] += r["length"]
    assert all(n == 4096 or n & (n - 1) == 0 for n in filled.values())


def test_workers_keep_no_chunks():
    tokenizer = packing.ChunkTokenizer(PATH)
    texts = ["some words, and some words again", None, ""]
    first = list(tokenizer.encode(texts))
    assert tokenizer.chunks and tokenizer.words
    tokenizer.forget()
    assert not tokenizer.chunks and not tokenizer.words and list(tokenizer.encode(texts)) == first


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string, start string"), PATH).count() == 0
