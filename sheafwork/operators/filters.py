"""Filters and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words of licences that forbid use, and of files that show no photograph.
DENIED_LICENCE = r"(?i)(?<![A-Za-z0-9_])(NC|ND|nonfree|non-free|fair use)(?![A-Za-z0-9_])"
NO_PHOTO = r"(?i)(?<![A-Za-z0-9_])(coat[_ ]of[_ ]arms|wappen|blason|escudo|stemma|flag|flagge|drapeau|catalogue|catalog|katalog|plate|tafel|herbarium|specimen|illustration|abbildung|drawing|engraving|zeichnung|gravure|lithograph|woodcut|range[_ ]map|map|karte|mapa|distribution|diagram|schema|logo|stamp|briefmarke|banknote|coin|BHL[0-9]+|page[_ ][0-9]+)(?![A-Za-z0-9_])"  # noqa: E501


def allowed_licence(licence: str, allowed: list[str]) -> Column:
    """Whether a licence is on the list; unknown and missing ones are not."""
    return F.coalesce(F.lower(F.trim(licence)).isin(allowed), F.lit(False))


def not_denied(licence: str) -> Column:
    return F.coalesce((F.trim(licence) != "") & ~F.col(licence).rlike(DENIED_LICENCE), F.lit(False))


def is_photo(name: str) -> Column:
    return ~F.coalesce(F.col(name), F.lit("")).rlike(NO_PHOTO)


def selection_gate(df: DataFrame, names: list[str], images: str) -> DataFrame:
    """Rows that have a name from any source and an allowed image."""
    named = reduce(lambda a, b: a | b, [F.coalesce(F.size(n) > 0, F.lit(False)) for n in names])
    return df.where(named & (F.coalesce(images, F.lit(0)) > 0))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def has_filled(array: str, field: str | None = None) -> Column:
    """Whether an array has an element, or an element's field, that isn't blank."""
    return F.coalesce(F.exists(array, lambda x: F.trim(x[field] if field else x) != ""), F.lit(False))


def filter_map(df: DataFrame, condition: Column, columns: list[Column | str]) -> tuple[DataFrame, DataFrame]:
    """Kept rows in their new shape, and one row of (seen, kept)."""
    kept = F.coalesce(condition, F.lit(False))
    return df.where(kept).select(*columns), df.agg(F.count("*").alias("seen"), F.count_if(kept).alias("kept"))


def reshape(df: DataFrame, drop: list[str], rename: dict[str, str]) -> DataFrame:
    return df.drop(*drop).withColumnsRenamed(rename)


def contains_text(query: str, *columns: str) -> Column:
    """Whether any column contains the text, whatever its case; an empty text is in all."""
    if not query.strip():
        return F.lit(True)
    q = query.strip().lower()
    return reduce(lambda a, b: a | b, [F.coalesce(F.lower(F.col(c).cast("string")).contains(q), F.lit(False)) for c in columns])


def matches(column: str, text: str, how: str = "contains") -> Column:
    """Equal, prefix or contains, whatever the case."""
    low, t = F.lower(column), text.lower()
    return {"equal": low == t, "prefix": low.startswith(t), "contains": low.contains(t)}[how]


def open_work(df: DataFrame, key: str, done: DataFrame, done_key: str, unnamed: Column, measure: str, key_map: DataFrame | None = None, source: str = "source") -> DataFrame:
    """Rows without a name and with something to do that aren't done yet; with a map, only those whose key it resolves."""
    if key_map is not None:
        df = df.join(key_map.select(F.col(source).alias(key)).distinct(), key, "left_semi")
    return df.where(unnamed & (F.col(measure) > 0) & F.col(key).isNotNull()).join(done.select(F.col(done_key).alias(key)).distinct(), key, "left_anti")


def without_marked(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose column doesn't match; missing values stay."""
    return df.where(~F.coalesce(F.col(column).rlike(pattern), F.lit(False)))


def without_blocks(lines: DataFrame, doc: str, order: str, heading: Column, skip: list[str]) -> DataFrame:
    """Lines without those below a heading to skip, up to the next heading; ``heading`` is a heading's text or null."""
    under = F.last(heading, ignorenulls=True).over(Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("__h", F.lower(F.trim(under))).where(~F.coalesce(F.col("__h").isin([s.lower() for s in skip]), F.lit(False))).drop("__h")
