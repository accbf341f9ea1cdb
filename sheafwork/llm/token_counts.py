"""Token totals by source, language and tokenizer version, kept by signed deltas.

Changes come in batches: an insert adds a document and its tokens, a delete takes them back, a revision takes back the
old count under the old version and adds the new one. A batch's signed sums are its delta: a part of the store named by
the batch, committed by Spark. A batch that is there already is not applied again, so sending it twice, or after a
failure, makes no difference; one that failed half-way leaves nothing that is read. ``compact`` folds all parts into base
totals of a new generation, which lists the batches that it holds: parts of those are no longer read and may be
removed (``prune``), and a batch sent again after it is known as well. Totals are the base plus the deltas since.

Defined cases: null sources, languages and versions are groups of their own; a null count counts as 0; an empty batch
commits an empty delta; changes repeated within a batch count as often as they stand there; a group whose documents and
tokens have both come down to 0 is left out; a kind that is none of the three is an error, and its batch is not
committed; without any batch there are no totals; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..storage import folders, remove
from .common import carry

KEYS = ["source", "lang", "tokenizer_version"]
DELTA = "source string, lang string, tokenizer_version string, n_docs bigint, n_tokens bigint"


def signed(changes: DataFrame) -> DataFrame:
    """Signed rows of changes (kind, source, lang, tokenizer_version, n_tokens, old_version, old_tokens)."""
    kind, n, old = F.col("kind"), F.coalesce(F.col("n_tokens"), F.lit(0)), F.coalesce(F.col("old_tokens"), F.lit(0))
    part = lambda version, docs, tokens: F.struct(version.cast("string").alias("tokenizer_version"), F.lit(docs).cast("long").alias("n_docs"), tokens.cast("long").alias("n_tokens"))
    add, take = part(F.col("tokenizer_version"), 1, n), part(F.col("tokenizer_version"), -1, -n)
    parts = (
        F.when(kind == "insert", F.array(add))
        .when(kind == "delete", F.array(take))
        .when(kind == "revise", F.array(part(F.col("old_version"), -1, -old), add))
        .otherwise(F.raise_error(F.concat(F.lit("no such change: "), F.coalesce(kind, F.lit("null")))).cast("array<struct<tokenizer_version:string,n_docs:bigint,n_tokens:bigint>>"))
    )
    return changes.select("source", "lang", F.explode(parts).alias("p")).select("source", "lang", "p.*")


def delta(changes: DataFrame) -> DataFrame:
    return _sums(signed(changes))


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class Rollup:
    """The store at ``path``, which must be one that all executors share. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _is_there(self, part: str) -> bool:
        """Whether Spark has committed this part."""
        return "_SUCCESS" in folders(self.spark, f"{self.path}/{part}")

    def generation(self) -> int:
        """Of the newest base; 0 without one. A base counts from when its list of batches is committed, after its totals."""
        found = sorted((int(g.removeprefix("generation=")) for g in folders(self.spark, f"{self.path}/held") if g.startswith("generation=")), reverse=True)
        return next((g for g in found if self._is_there(f"held/generation={g}")), 0)

    def _held(self, generation: int) -> DataFrame:
        """(batch): the batches whose changes the base holds."""
        if not generation:
            return self.spark.createDataFrame([], "batch string")
        return self.spark.read.schema("batch string").parquet(f"{self.path}/held/generation={generation}")

    def _new(self, generation: int) -> list[str]:
        """Batches with a committed part that the base doesn't hold."""
        there = [(p.removeprefix("batch="),) for p in folders(self.spark, f"{self.path}/deltas") if p.startswith("batch=")]
        if not there:
            return []
        rows = self.spark.createDataFrame(there, "batch string").join(self._held(generation), "batch", "left_anti")
        return sorted(r["batch"] for r in rows.collect() if self._is_there(f"deltas/batch={r['batch']}"))

    def _parts(self, generation: int) -> DataFrame | None:
        """Deltas that the base doesn't hold; no others are read."""
        new = self._new(generation)
        return self.spark.read.schema(DELTA).parquet(*[f"{self.path}/deltas/batch={b}" for b in new]) if new else None

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Applies a batch, unless it is there already; returns whether it was applied."""
        if self._is_there(f"deltas/batch={batch_id}") or not self._held(self.generation()).where(F.col("batch") == batch_id).isEmpty():
            return False
        delta(changes).write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch_id}")
        return True

    def totals(self) -> DataFrame:
        generation = self.generation()
        parts = self._parts(generation)
        rows = [] if parts is None else [parts]
        if generation:
            rows.append(self.spark.read.schema(DELTA).parquet(f"{self.path}/totals/generation={generation}"))
        if not rows:
            return self.spark.createDataFrame([], DELTA)
        return _sums(rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])).where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> None:
        """Folds the deltas into a base of the next generation; a failure before the end changes nothing. Their parts stay until ``prune``."""
        generation = self.generation()
        new = self._new(generation)
        if not new:
            return
        names = self.spark.createDataFrame([(b,) for b in new], "batch string")
        self.totals().write.mode("overwrite").parquet(f"{self.path}/totals/generation={generation + 1}")
        names.unionByName(self._held(generation)).write.mode("overwrite").parquet(f"{self.path}/held/generation={generation + 1}")

    def prune(self) -> None:
        """Removes what no reader of the newest base needs: parts that it holds and bases before it."""
        generation = self.generation()
        kept = set(self._new(generation))
        for part in folders(self.spark, f"{self.path}/deltas"):
            if part.startswith("batch=") and part.removeprefix("batch=") not in kept:
                remove(self.spark, f"{self.path}/deltas/{part}")
        for name in ("totals", "held"):
            for part in folders(self.spark, f"{self.path}/{name}"):
                if part.startswith("generation=") and int(part.removeprefix("generation=")) < generation:
                    remove(self.spark, f"{self.path}/{name}/{part}")


@lru_cache(maxsize=8)
def _tokenizer(path: str, pattern: str):
    """Encodes by a rank file; one in each Python worker."""
    import tiktoken

    from .bpe import read_ranks

    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


def count_tokens(docs: DataFrame, tokenizers: dict[str, str], pattern: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and, for each version, the number of a text's tokens by that rank file; a null text has none."""
    carried, kept, at = carry(docs, keep or [], text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            counts = [pa.array([len(_tokenizer(path, pattern).encode_ordinary(t or "")) for t in texts], pa.int64()) for path in tokenizers.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *counts], names=[*kept.names, *tokenizers])

    return carried.mapInArrow(run, StructType([*kept.fields, *[StructField(v, LongType()) for v in tokenizers]]))
