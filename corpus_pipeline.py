"""A corpus pipeline of five operators: each stage's rows are written as Parquet and read again by the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm.common import free_name, held_out, shared_dir, written

#: Score from which another language than the stated one counts as a contradiction.
CONTRADICTION = 0.6
#: Words of a shingle, and percent of shingles that near duplicates have in common.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Words of 64 bits of the bitmap that tells which ids may go or repeat.
TOUCHED_WORDS = 1 << 17


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.5 or more; the machine is trained on labels outside the held-out fold."""
    from sheafwork.llm.toxicity import learn_toxicity, score_toxicity

    machine = learn_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out("doc_id"))
    score = free_name(docs.columns, "score")
    return score_toxicity(docs, machine, keep=docs.columns, out=score).where(F.col(score) < 0.5).drop(score)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language (no letters) and those whose stated language the text contradicts clearly."""
    from sheafwork.llm.langid import learn_profiles, predict_language

    lang, score = free_name(docs.columns, "lang_pred"), free_name(docs.columns, "score")
    found = predict_language(docs, learn_profiles(docs, ~held_out("doc_id")), keep=docs.columns, out=(lang, score))
    other = (F.col(lang) != F.col("lang")) & (F.col(score) >= CONTRADICTION)
    return found.where((F.col(lang) != "und") & ~F.coalesce(other, F.lit(False))).drop(lang, score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of links, and all documents without an id. Rows of one id stay
    or go together: an id goes if all its texts belong to groups of smaller ids; rows repeated with id and text stay once.
    A bitmap tells most rows whose id neither goes nor repeats, so their texts don't move; the rest is joined by id."""
    from sheafwork.llm.shingle_join import jaccard_components

    found = jaccard_components(docs, percent=NEAR_PERCENT, words=NEAR_WORDS).where("doc_id IS NOT NULL")
    mine, word, bits = (free_name(docs.columns, x) for x in ("touched_id", "touched_word", "touched_bits"))
    by_id = found.groupBy(F.col("doc_id").alias(mine)).agg(F.count("*").alias("n"), F.bool_or(F.col("doc_id") == F.col("component_id")).alias("stays"))
    touched = written(by_id.where("n > 1 OR NOT stays"), "touched-ids")
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(64 * TOUCHED_WORDS))
    at = touched.select(F.shiftright(place(mine), 6).alias(word), F.call_function("shiftleft", F.lit(1).cast("long"), place(mine).bitwiseAND(63).cast("int")).alias(bits))
    marks = at.groupBy(word).agg(F.bit_or(bits).alias(bits))
    known = docs.where("doc_id IS NOT NULL")
    marked = known.join(F.broadcast(marks), F.shiftright(place("doc_id"), 6) == F.col(word), "left")  # TOUCHED_WORDS rows at most
    hit = F.coalesce(F.getbit(F.col(bits), place("doc_id").bitwiseAND(63).cast("int")) == 1, F.lit(False))
    met = marked.where(hit).drop(word, bits).join(touched.where("NOT stays").select(mine), F.col("doc_id") == F.col(mine), "left_anti")
    return marked.where(~hit).drop(word, bits).unionByName(met.dropDuplicates(["doc_id", "text"])).unionByName(docs.where("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated runs of sentences out of the texts."""
    from sheafwork.llm.spans import remove_repeats

    return remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into windows of 4,096 tokens."""
    import public_tokenizers

    from sheafwork.llm.packing import pack_documents

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: Learnt models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{name}")
    return docs
