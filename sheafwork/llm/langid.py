"""Language identification by rank-order profiles of character n-grams.

A profile lists a text's most frequent 1-, 2- and 3-grams by rank. A language's profile comes from labelled documents; a
document gets the language whose profile has the least out-of-place distance to its own: for each of its n-grams the
difference of ranks, or the profile's size where the language lacks it.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without any labelled document everything is
``und``; equal distances go to the language first in the alphabet; rows with a null or repeated id are each scored;
rows without an id or language are not learnt from; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import carry

#: N-grams in a profile.
PROFILE = 300
#: Labelled documents of a language that its profile is made from, about; chosen by a hash of the id.
SAMPLE = 3000

SCHEMA = "doc_id bigint, lang_pred string, score double"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams as codes of 21 bits a character, ascending, and their counts. Words are padded with a blank."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    known = _letters()[points]
    if not known.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    points = np.concatenate(([32], np.where(known, points, 32), [32]))
    gap = points == 32
    keep = ~(gap & np.roll(gap, 1))
    keep[0] = True
    points, gap = points[keep], gap[keep]
    two = points[:-1] | points[1:] << 21
    three = (two[:-1] | points[2:] << 42)[~gap[1:-1]]
    return np.unique(np.concatenate((points[~gap], two, three)), return_counts=True)


def top(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Codes by falling count, equal counts by code."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(docs: DataFrame, labelled: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = PROFILE, sample: int = SAMPLE) -> dict[str, list[int]]:
    """Profiles by language, from about ``sample`` documents of each that are ``labelled``."""
    rows = docs.where(labelled & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    if not sizes:
        return {}
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, sample / n)))])
    chosen = rows.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("profile")), F.lit(1 << 30)) < share[F.col(lang_col)] * (1 << 30))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, []).append(grams(text))
            for lang, parts in found.items():
                codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], names=["lang", "gram", "n"])

    totals = chosen.select(lang_col, text_col).mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = totals.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("place") <= size)
    out: dict[str, list[int]] = {k: [] for k in sorted(sizes)}
    for r in best.orderBy("lang", "place").collect():
        out[r["lang"]].append(r["gram"])
    return {k: v for k, v in out.items() if v}


class Ranker:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.langs, self.size = sorted(profiles), size
        self.codes = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        self.places = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.places[np.searchsorted(self.codes, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = top(*grams(text), self.size)
        if not len(own) or not self.langs:
            return "und", 0.0
        at = np.searchsorted(self.codes, own)
        at[self.codes[np.minimum(at, len(self.codes) - 1)] != own] = len(self.codes)
        places = self.places[at]
        apart = np.where(places < 0, self.size, np.abs(places - np.arange(len(own))[:, None])).sum(0)
        first = int(apart.argmin())
        others = np.delete(apart, first)
        near, next_near = float(apart[first]), float(others.min()) if len(others) else float(self.size * len(own))
        return self.langs[first], next_near / (near + next_near) if near + next_near else 0.5


def predict_language(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, size: int = PROFILE, out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Language and score of each row; ``keep`` names columns to carry along instead of the id alone."""
    carried, kept, at = carry(docs, keep or [id_col], text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(profiles, size)
        for batch in batches:
            found = [ranker.predict(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=[*kept.names, *out])

    return carried.mapInArrow(run, StructType([*kept.fields, StructField(out[0], StringType()), StructField(out[1], DoubleType())]))
