"""Substring dedup by sliding spans of sentences.

From each sentence of each text runs a span, and to each runs one: the fewest sentences from there on, or up to there, that
are ``SENTENCES`` or more with ``WORDS`` words, or fewer with ``MANY_WORDS``; so both ends of a repeated passage lie in spans
of it. Which of the two a span is depends on its sentences alone, so it is taken once. Spans are hashed (128 bits) and joined globally; every sentence that lies
in a span which occurs before, in a smaller document or earlier in the same, is removed. Sentences end behind full stops,
exclamation and question marks and line ends; case and the white space between words don't matter.

Defined cases: a null text stays null and has no sentences; a text under one span's words is left alone; the first place
of a span is that of the smallest (id, hash of the text, sentence), where a missing id comes first; rows repeated with
the same id and text are one document's and all come out alike; an empty table gives no rows; other columns, whatever
their names, are carried along by ``remove_repeats``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .common import written

SENTENCES, WORDS, MANY_WORDS = 3, 20, 40
#: Cuts a text into sentences whose concatenation is the text.
SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*\s*|[.!?\n]+\s*")


def spans(text: str) -> Iterator[tuple[int, int, bytes]]:
    """First and last sentence of each span, once, and its hash."""
    words = [s.lower().split() for s in SENTENCE.findall(text)]
    joined = [" ".join(w).encode() for w in words]
    upto = [0, *accumulate(map(len, words))]
    enough = lambda first, last: (n := upto[last + 1] - upto[first]) >= MANY_WORDS or n >= WORDS and last - first + 1 >= SENTENCES
    start = 0
    for last in range(len(words)):
        known = start
        while start <= last and enough(start, last):
            start += 1
        # spans from known on end here; where there are none, the shortest that ends here starts before
        for first in range(max(0, min(known, start - 1)), start):
            yield first, last, xxhash.xxh3_128_digest(b"\n".join(joined[first : last + 1]))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("v"), F.col(text_col).alias("text"))


def span_rows(keyed: DataFrame) -> DataFrame:
    """(h1, h2, id, v, first, last): all spans of all texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, firsts, lasts, marks = [], [], [], []

            def block() -> pa.RecordBatch:
                h = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
                at = pa.array(of, pa.int64())
                out = pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column(0).take(at), batch.column(1).take(at), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())], names=["h1", "h2", "id", "v", "first", "last"])
                for x in (of, firsts, lasts, marks):
                    x.clear()
                return out

            for i, text in enumerate(batch.column(2)):
                for first, last, mark in spans(text.as_py() or ""):
                    of.append(i)
                    firsts.append(first)
                    lasts.append(last)
                    marks.append(mark)
                if len(of) > 100_000:
                    yield block()
            if of:
                yield block()

    return keyed.mapInArrow(run, "h1 bigint, h2 bigint, id bigint, v bigint, first int, last int")


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(id, v, cuts): the spans of each document that occur before, as (first, last) sentences.

    Only the number and the smallest id of each span are aggregated, in parts before they move. The rows of repeated spans
    are joined to that written table, so that a span with very many rows can be split; those of a larger id need no more,
    and those of the smallest id are few.
    """
    rows = rows.withColumn("at", F.coalesce("id", F.lit(-(1 << 63))))
    often = written(rows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("at").alias("least")).where("n > 1").drop("n"), "span-counts")
    again = written(rows.join(often, ["h1", "h2"]), "repeated-spans")
    place = F.struct("v", "first")
    ties = again.where("at = least")
    origin = written(ties.groupBy("h1", "h2").agg(F.min(place).alias("origin")), "span-origins")
    later = again.where("at > least").select("id", "v", "first", "last").unionByName(ties.join(origin, ["h1", "h2"]).where(place != F.col("origin")).select("id", "v", "first", "last"))
    return later.groupBy("id", "v").agg(F.collect_set(F.struct("first", "last")).alias("cuts"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with repeated spans taken out of the texts; ``counts`` adds n_sentences and n_removed."""
    cuts = repeated_spans(written(span_rows(_keyed(docs, id_col, text_col)), "spans"))
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own = F.col(f"c{names.index(text_col)}")
    # the text goes beside the others, once
    rows = plain.select(F.struct(F.lit(True).alias("kept"), *[c for i, c in enumerate(plain.columns) if names[i] != text_col]).alias("row"), F.col(f"c{names.index(id_col)}").cast("long").alias("id"), F.xxhash64(own).alias("v"), own.alias("text"))
    found = cuts.withColumnsRenamed({"id": "cut_id", "v": "cut_v"})
    joined = rows.join(found, F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("v") == F.col("cut_v")), "left").select("row", "cuts", "text")
    added = [] if not counts else ["n_sentences", "n_removed"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, removed = [], [], []
            for cut, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if cut is None and not counts or text is None:
                    texts.append(text)
                    sizes.append(0)
                    removed.append(0)
                    continue
                sentences = SENTENCE.findall(text)
                gone = {i for c in cut or () for i in range(c["first"], c["last"] + 1)}
                texts.append("".join([s for i, s in enumerate(sentences) if i not in gone]) if gone else text)
                sizes.append(len(sentences))
                removed.append(len(gone))
            more = [pa.array(sizes, pa.int32()), pa.array(removed, pa.int32())] if counts else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), *more], names=["row", "text", *added])

    schema = StructType([rows.schema["row"], StructField("text", StringType()), *[StructField(a, IntegerType()) for a in added]])
    out = joined.mapInArrow(run, schema)
    return out.select(*[(F.col("text") if c == text_col else F.col(f"row.c{i}")).alias(c) for i, c in enumerate(names)], *added)
