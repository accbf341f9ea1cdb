"""Readers of JSON lines, keyed JSON, nested lists, CSV, lists in folders, and work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object a line; blank lines are skipped, a bad line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_ndjson_tolerant(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines that don't parse. Lines are read as text, so both sides come from one plan shape."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    rows = lines.select("value", F.from_json("value", f"{schema}, _corrupt_record STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    bad = F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()
    return rows.where(~bad).select("r.*").drop("_corrupt_record"), rows.where(bad).select(F.col("value").alias("line"))


def read_keyed_json(spark: SparkSession, path: str, value_type: str, values_field: str | None = None) -> DataFrame:
    """A whole-file object as rows (key, value); ``values_field`` names the object within a wrapper."""
    if values_field:
        rows = spark.read.schema(f"`{values_field}` MAP<STRING, {value_type}>").option("multiLine", True).json(path).select(F.col(values_field).alias("m"))
    else:
        rows = spark.read.text(path, wholetext=True).select(F.from_json("value", f"MAP<STRING, {value_type}>").alias("m"))
    return rows.select(F.explode("m"))


def explode_entries(df: DataFrame, groups: str, entries: str) -> DataFrame:
    """Nested groups of entries as rows, with the group's other fields and both ordinals."""
    g = df.select(F.posexplode(groups).alias("group_ord", "g"))
    fields = [f.name for f in g.schema["g"].dataType.fields if f.name != entries]
    return g.select("group_ord", *[F.col(f"g.{f}").alias(f) for f in fields], F.posexplode(f"g.{entries}").alias("entry_ord", "e")).select("group_ord", *fields, "entry_ord", "e.*")


def read_quoted_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Quoted fields below a header; a byte order mark goes, as do rows with fewer than two fields."""
    rows = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    named = rows.toDF(*[c.replace("﻿", "").strip('"') for c in rows.columns])
    return named.select(*columns).where(F.col(columns[0]).isNotNull() & F.col(columns[1]).isNotNull())


def read_multi_store(spark: SparkSession, path: str, stores: dict[str, str]) -> dict[str, DataFrame]:
    """Several record stores of one JSON file, each as a table, from one read."""
    ddl = ", ".join(f"`{name}` ARRAY<STRUCT<{fields}>>" for name, fields in stores.items())
    whole = spark.read.schema(ddl).option("multiLine", True).json(path)
    return {name: whole.select(F.inline(name)) for name in stores}


def flatten_tree(df: DataFrame, levels: list[tuple[str, str]]) -> DataFrame:
    """A nested tree as one row for each leaf: ``levels`` are (array field, name of its label column); labels are kept, missing levels too."""
    out, at = df, ""
    kept: list[str] = []
    for field, label in levels:
        out = out.select(*kept, F.explode_outer(f"{at}{field}").alias("n")) if kept or at else out.select(F.explode_outer(field).alias("n"))
        names = [f.name for f in out.schema["n"].dataType.fields]
        out = out.withColumn(label, F.col("n.name" if "name" in names else "n.id"))
        kept.append(label)
        at = "n."
    return out.select(*kept, "n.*") if "name" not in kept else out.select(*kept)


def read_dir_lists(spark: SparkSession, path: str, schema: str, pattern: str = "*.ndjson", folder: str | None = None) -> DataFrame:
    """All lists below a folder, each row with its file's name, or with what its folder ``folder=...`` says."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(path)
    name = rf"/{folder}=([^/]+)/" if folder else r"([^/]+)\.[^./]+$"
    return rows.withColumn("list", F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), name, 1)))


def read_key_lines(spark: SparkSession, path: str) -> DataFrame:
    """A list of numeric keys, one a line; other lines are dropped."""
    return spark.read.text(path).select(F.expr("try_cast(trim(value) AS BIGINT)").alias("key")).where("key IS NOT NULL")


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """Lines of key, name and error between tabs; lines without a numeric key are dropped."""
    rows = spark.read.schema("k STRING, name STRING, error STRING").option("sep", "\t").csv(path)
    return rows.select(F.expr("try_cast(k AS BIGINT)").alias("key"), "name", "error").where("key IS NOT NULL")


def require_inputs(spark: SparkSession, *paths: str) -> None:
    """Fails before a job starts if an input can't be listed."""
    missing = []
    for path in paths:
        try:
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").limit(1).collect()
        except Exception as e:  # noqa: BLE001  (Spark's own error classes differ by store)
            if "PATH_NOT_FOUND" not in str(e):
                raise
            missing.append(path)
    if missing:
        raise FileNotFoundError(f"missing inputs: {', '.join(missing)}")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


# Payloads of services, as rows


#: The fields of a species row, and those that a usage calls otherwise.
USAGE_FIELDS = [
    "taxonKey", "scientificName", "canonicalName", "authorship", "rank", "status", "extinct", "kingdom", "kingdomKey", "phylum", "phylumKey", "class", "classKey", "order", "orderKey",
    "family", "familyKey", "genus", "genusKey", "numDescendants", "constituentKey",
]
USAGE_SOURCE = {"taxonKey": "key", "status": "taxonomicStatus"}


def flatten_usages(usages: DataFrame, languages: list[str]) -> DataFrame:
    """Vernacular names trimmed, of the given languages, each once by language and lower-case name; the first stays."""
    names = F.filter(
        F.transform("vernacularNames", lambda v: F.struct(F.trim(v["vernacularName"]).alias("name"), v["language"].alias("language"))),
        lambda v: v["language"].isin(languages) & (v["name"] != ""),
    )
    placed = F.transform(names, lambda v, i: F.struct(F.concat(v["language"], F.lit("|"), F.lower(v["name"])).alias("key"), i.alias("i"), v.alias("v")))
    once = usages.withColumn("__s", F.sort_array(placed))  # by key, then place
    first = F.filter("__s", lambda x, i: (i == 0) | (x["key"] != F.get("__s", i - 1)["key"]))
    kept = F.transform(F.sort_array(F.transform(first, lambda x: F.struct(x["i"].alias("i"), x["v"].alias("v")))), lambda x: x["v"])
    return once.withColumn("vernacularNames", kept).drop("__s")


def species_rows(usages: DataFrame, languages: list[str]) -> DataFrame:
    """Usages as species rows: all USAGE_FIELDS, null where the payload lacks one or has an empty text, and the vernacular names."""
    have = {f.name: f.dataType.typeName() for f in usages.schema.fields}

    def field(name: str):
        source = USAGE_SOURCE.get(name, name)
        if source not in have:
            return F.lit(None).cast("string").alias(name)
        c = F.col(f"`{source}`")
        return (F.nullif(c, F.lit("")) if have[source] == "string" else c).alias(name)

    return flatten_usages(usages, languages).select(*[field(n) for n in USAGE_FIELDS], "vernacularNames")


def flatten_image_groups(pages: DataFrame, key: str, images: str, top: int | None = None) -> DataFrame:
    """A map from organ to images as rows; ``top`` keeps the best by votes of each organ."""
    from pyspark.sql import Window

    rows = pages.select(key, F.explode(images).alias("organ", "list")).select(key, "organ", F.posexplode("list").alias("pos", "image")).select(key, "organ", "pos", "image.*")
    if top is None:
        return rows
    order = Window.partitionBy(key, "organ").orderBy(F.desc("votes"), "pos")
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top).drop("nth")


def flatten_media(occurrences: DataFrame, key: str, first: str, then: str, fields: dict[str, list[str]], url: str) -> DataFrame:
    """Two arrays of maps as rows, the first array's before the other's; a field is the first filled of its candidate keys; one row for each address."""
    from pyspark.sql import Window

    both = F.concat(F.coalesce(F.col(first), F.array()), F.coalesce(F.col(then), F.array()))
    rows = occurrences.select(key, F.posexplode(both).alias("pos", "m"))
    picked = rows.select(key, "pos", *[F.coalesce(*[F.nullif(F.trim(F.col("m")[c]), F.lit("")) for c in candidates]).alias(name) for name, candidates in fields.items()])
    order = Window.partitionBy(key, url).orderBy("pos")
    return picked.where(F.col(url).isNotNull()).withColumn("nth", F.row_number().over(order)).where("nth = 1").drop("nth", "pos")


def flatten_facets(pages: DataFrame, counts: str) -> DataFrame:
    """Distinct numeric keys of facet pages, ascending."""
    return pages.select(F.explode(counts).alias("c")).select(F.expr("try_cast(c.name AS BIGINT)").alias("key")).where("key IS NOT NULL").distinct().orderBy("key")


def fold_bindings(rows: DataFrame, subject: str, sets: list[str], scalars: list[str], ordinal: str, flag: Column | None = None) -> DataFrame:
    """Rows of value combinations as one record a subject: sets of values, last scalars, and whether the flag ever held."""
    out = [F.sort_array(F.collect_set(c)).alias(c) for c in sets] + [F.max_by(c, ordinal).alias(c) for c in scalars]
    return rows.groupBy(subject).agg(*out, *([F.bool_or(flag).alias("flag")] if flag is not None else []))


# Files that are images.
IMAGES = r"(?i)\.(jpe?g|png|tiff?|webp)$"


def flatten_pages(pages: DataFrame, title: str, html: dict[str, str], licence: str, denied: str, images: str = IMAGES) -> DataFrame:
    """Image pages: markup taken out of the licence and of the ``html`` fields (null if nothing is left), denied or missing licences and other files dropped."""
    from ..functions.text import plain_text

    rows = pages.withColumn(licence, plain_text(licence)).where(F.col(title).rlike(images) & (F.col(licence) != "") & ~F.col(licence).rlike(denied))
    return rows.withColumns({name: F.nullif(plain_text(column), F.lit("")) for name, column in html.items()})


def upsert_language_pages(pages: DataFrame, keys: list[str], language: str, names: str, ordinal: str) -> DataFrame:
    """Pages of several languages as one record a key: the first page's number, names by language, pages that came again."""
    by_lang = pages.groupBy(*keys, language).agg(F.min_by(names, ordinal).alias("names"), F.min(ordinal).alias("first"), F.count("*").alias("n"))
    entries = F.sort_array(F.collect_list(F.struct(language, "names")))
    return by_lang.groupBy(*keys).agg(F.map_from_entries(entries).alias("names_by_language"), F.min("first").alias("first_page"), F.sum(F.col("n") - 1).alias("n_again"))


def key_from_url(url: Column | str, segment: str) -> Column:
    """The number behind a path segment."""
    c = F.col(url) if isinstance(url, str) else url
    return F.regexp_extract(c, rf"/{segment}/([0-9]+)(?:[/?#]|$)", 1).try_cast("bigint")


def flatten_detail(details: DataFrame, bulky: str, trait: str, alias: str, added: dict[str, Column] | None = None) -> DataFrame:
    """Drops a bulky field and takes a trait's values out of the list of traits. ``added`` (key, language, time of retrieval)
    comes first; a field that the detail has itself keeps its own value."""
    values = F.transform(F.flatten(F.transform(F.filter("traits", lambda t: t["key"] == trait), lambda t: t["values"])), lambda v: v["key"])
    own = details.drop(bulky).withColumn(alias, F.nullif(F.array_join(values, ", "), F.lit("")))
    return own.select(*[c.alias(name) for name, c in (added or {}).items() if name not in own.columns], "*")


def titled_entries(pages: DataFrame, key: str, markup: str, attribute: str = "title", skip: str | None = None) -> DataFrame:
    """(key, name, category): attributes "name (category)" of a page's markup, cut at the last bracket, each name's first in order.
    Attributes without a bracket, and names that fit ``skip``, are left out."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(markup, F.lit(f'{attribute}="([^"]+)"'), F.lit(1))).alias("at", "raw")).where(F.col("raw").contains(" ("))
    parts = found.select(key, "at", F.trim(F.regexp_extract("raw", r"^(.*) \(", 1)).alias("name"), F.trim(F.regexp_extract("raw", r"^.* \((.*?)\)?$", 1)).alias("category"))
    if skip:
        parts = parts.where(~F.col("name").rlike(skip))
    return parts.groupBy(key, "name").agg(F.min_by("category", "at").alias("category"))
