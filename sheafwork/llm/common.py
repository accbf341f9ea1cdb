"""What the operators of this package share: table access and small column helpers."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..storage import shared_dir, written  # noqa: F401

#: The white space of the word definition: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, folds: int = 5) -> Column:
    """crc32 of the id as text modulo ``folds``; null ids fall into no fold."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(folds))


def held_out(doc_id: Column | str) -> Column:
    """Fold 0 is held out; rows without an id are never learnt from, so they count as held out too."""
    return F.coalesce(fold(doc_id) == 0, F.lit(True))


def carry(docs: DataFrame, keep: list[str], text_col: str) -> tuple[DataFrame, StructType, int]:
    """What a Python step over texts reads: the columns to keep and, if it isn't one, the text; then the kept ones' schema and the text's place."""
    names = [*keep, *([] if text_col in keep else [text_col])]
    rows = docs.select(*[docs[_quoted(c)] for c in names])
    return rows, StructType(rows.schema.fields[: len(keep)]), names.index(text_col)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(names: list[str], wish: str) -> str:
    """A column name that isn't taken."""
    taken = {c.lower() for c in names}
    while wish.lower() in taken:
        wish += "_"
    return wish


def release_memory() -> None:
    """Gives freed memory back to the system at the end of a large step; Python workers live on for later stages."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
