"""One query for each operator of this package, over its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import code_search, conversations, quality, spelling
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def put(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op6_sum_of_squares_packing")
def op6_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_language_profiles")
def op9_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import held_out
    from .langid import learn_profiles, predict_language

    docs = table(spark, sf_dir, "documents")
    found = predict_language(docs, learn_profiles(docs, ~held_out("doc_id")))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


_OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN d.payload_bytes >= 100 AND d.page_id IS DISTINCT FROM f.first AND f.first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.payload_bytes >= 100 AND d.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM d JOIN f USING (payload_digest)
"""


@query("op7_warc_bundles", _OP7_SQL)
def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import written
    from .warc import plan_records, read_bundles, write_bundles

    return read_bundles(written(write_bundles(plan_records(table(spark, sf_dir, "pages"))), "bundles"))


@query("op5_string_kernel_toxicity")
def op5_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .common import held_out
    from .toxicity import learn_toxicity, score_toxicity

    docs = table(spark, sf_dir, "documents")
    machine = learn_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out("doc_id"))
    return score_toxicity(docs, machine).select("doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query("op4_adaptive_quality", quality.SQL)
def op4_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op10_shingle_join")
def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .shingle_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op1_sentence_spans")
def op1_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spans import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


@query("op3_multi_index_hashing", code_search.SQL)
def op3_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import written

    codes = written(code_search.sign_codes(table(spark, sf_dir, "embeddings")), "codes")
    return code_search.nearest(codes, codes.where("id % 50 = 0")).withColumnRenamed("id", "vec_id")


@query("op8_token_rollup")
def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in under one tokenizer, are revised to another, and repeated texts are deleted; each batch is sent again, before and after the store is compacted."""
    import public_tokenizers
    from pyspark.sql import functions as F

    from ..storage import scratch
    from .common import written
    from .token_counts import Rollup, count_tokens

    versions = {v: public_tokenizers.path(f"{v}.tiktoken") for v in ("byte_bpe_50k", "byte_bpe_multi_50k")}
    old, new = versions
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text").withColumns({"h1": F.xxhash64("text"), "h2": F.coalesce(F.md5("text"), F.lit("none")), "at": F.coalesce("doc_id", F.lit(-(1 << 63)))})
    counted = written(count_tokens(docs, versions, public_tokenizers.PATTERN, keep=["source", "lang", "h1", "h2", "at"]), "token-counts")
    none = F.lit(None)
    change = lambda rows, kind, version, old_version=none.cast("string"), n=none.cast("long"): rows.select(F.lit(kind).alias("kind"), "source", "lang", F.lit(version).alias("tokenizer_version"), F.col(version).alias("n_tokens"), old_version.alias("old_version"), n.alias("old_tokens"))
    first = written(counted.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "first-copies")
    copies = counted.join(first, ["h1", "h2"]).where("at <> first")
    rollup = Rollup(spark, scratch(spark, "rollup"))
    batches = {
        "0001": change(counted, "insert", old),
        "0002": change(counted, "revise", new, F.lit(old), F.col(old)),
        "0003": change(copies, "delete", new),
    }
    for _ in range(2):
        for batch_id, changes in batches.items():
            rollup.commit(batch_id, changes)
        rollup.compact()
    return rollup.totals()


@query("op11_partenum_spelling", spelling.SQL)
def op11_partenum_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_conversation_trie", conversations.SQL)
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_block_labeller")
def op13_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .page_text import learn_labeller, main_text

    pages = table(spark, sf_dir, "pages")
    return main_text(pages, learn_labeller(pages), keep=["page_id", "url"])
