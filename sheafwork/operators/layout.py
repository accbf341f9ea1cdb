"""Lists set as text: records from lines with dashes, headings and indents; lines of a fixed grammar; names from cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Marks before an entry, words of running text, rank marks of names and of cells.
MARKS = r"^\s*(?:ZP|Zp|\+|\s)*"
FILLERS = ["des", "der", "die", "das", "dem", "den", "von", "vom", "mit", "und", "oder", "bzw", "zur", "zum", "im", "in", "für", "als", "aus", "bei", "auf", "ist", "sind", "wie", "zu", "am"]
NAME_RANKS = ["var.", "subsp.", "ssp.", "f.", "cv.", "sect."]
CELL_RANK = r"(?i)^(subsp\.|ssp\.|var\.|f\.|sect\.|convar\.)$"
CELL_BEGINS_WITH_RANK = r"(?i)^(subsp\.|ssp\.|var\.|f\.|sect\.|convar\.)\s"
_BORDER = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"  # of words of plain letters
_DASHES = rf"^\s*((?:ZP|Zp|\+|[A-Z]{_BORDER}|\s)*)((?:-\s*)+)(\S.*)$"
_NUMBERED = MARKS + r"\d+(\.\d+)*\.?\s+\S"
_FREE = MARKS + rf"([A-ZÄÖÜ][A-Za-zäöüß-]{{2,}})\s+(['‘’][^'‘’]|x{_BORDER}|×|[a-zäöüß][a-zäöüß-]*(?:{_BORDER}|$))"
_INDENTED = MARKS + r"((?:[a-zäöüß][a-zäöüß-]+|['‘’][^'‘’]+['‘’])[^,]{0,40}),\s*\S"


def list_records(lines: DataFrame, doc: str, line: str, text: str, section: Column, group: Column, noise: Column, ends: Column) -> DataFrame:
    """(doc, line, kind, marks, level, text): the records of each document in the order of the lines that they begin with.

    ``section`` and ``group`` give a heading's value or null. A section, a group and any numbered heading close the open
    record. An entry begins with dashes, whose number is its level; with a name of two words that stands free; or, while an
    entry is open, with an indented epithet or quoted name before a comma. The last two don't begin inside an open bracket, and
    a second word that is an abbreviation or a filler continues an open entry. Other lines continue it, or go where none
    is open. Blank lines and noise are skipped; from a line on that ``ends`` fits, once an entry has begun, nothing counts.
    White space inside a record of one line stays; of several it becomes one blank.

    Whether a bracket is open counts from the entry's own beginning. A line may begin an entry only where no more brackets are
    open than there were, so that number falls from entry to entry: it is the least at all lines before that might begin one.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    flag = lambda c: F.coalesce(c, F.lit(False))
    rows = lines.select(doc, line, t.alias("t"), section.alias("s"), group.alias("g"), flag(ends).alias("e"), flag(noise).alias("x")).where((F.trim(F.regexp_replace("t", r"\s", " ")) != "") & ~F.col("x"))
    first = F.element_at(F.split("t", r"\s+"), 1)
    closes = F.col("s").isNotNull() | (F.col("t").rlike(_NUMBERED) & ~first.contains("-")) | F.col("g").isNotNull()
    second = F.coalesce(F.get(F.split(T.one_blank("t"), " "), F.lit(1)), F.lit(""))
    filler = F.lower(F.regexp_replace(second, "[.,]+$", "")).isin(FILLERS) | (second.endswith(".") & ~F.lower(second).isin(NAME_RANKS))
    rows = rows.withColumns({"closes": closes, "dashes": ~closes & F.col("t").rlike(_DASHES)})
    rows = rows.withColumns({"free": ~F.col("closes") & ~F.col("dashes") & F.col("t").rlike(_FREE), "filler": filler, "indented": ~F.col("closes") & ~F.col("dashes") & F.col("t").rlike(_INDENTED)})

    by_doc = Window.partitionBy(doc).orderBy(line)
    rows = rows.withColumn("part", F.sum(F.col("closes").cast("int")).over(by_doc))
    by_part = Window.partitionBy(doc, "part").orderBy(line)
    before = (Window.unboundedPreceding, -1)
    rows = rows.withColumn("opened", flag(F.bool_or(F.col("dashes") | F.col("free")).over(by_part.rowsBetween(*before))))
    count = lambda c: F.length("t") - F.length(F.replace("t", F.lit(c), F.lit("")))
    counts = F.when(F.col("opened") | F.col("dashes") | F.col("free"), count("(") - count(")")).otherwise(0)
    rows = rows.withColumns({"run": F.sum(F.col("dashes").cast("int")).over(by_part), "depth": counts})
    by_run = Window.partitionBy(doc, "part", "run").orderBy(line)
    rows = rows.withColumn("behind", F.coalesce(F.sum("depth").over(by_run.rowsBetween(*before)), F.lit(0)))
    may_start = (F.col("free") & ~F.col("filler")) | (~F.col("free") & F.col("indented"))
    lowest = F.least(F.lit(0), F.coalesce(F.min(F.when(F.col("opened") & may_start, F.col("behind"))).over(by_run.rowsBetween(*before)), F.lit(0)))
    rows = rows.withColumn("inside", F.col("behind") - lowest > 0)
    starts = F.col("dashes") | (F.col("free") & (~F.col("opened") | (~F.col("filler") & ~F.col("inside")))) | (~F.col("free") & F.col("indented") & F.col("opened") & ~F.col("inside"))
    rows = rows.withColumn("starts", starts)
    begun = flag(F.bool_or("starts").over(by_doc.rowsBetween(*before)))
    rows = rows.withColumn("over", F.max((F.col("e") & begun).cast("int")).over(by_doc)).where("over = 0")

    dash = lambda i: F.regexp_extract("t", _DASHES, i)
    marked = F.when(F.col("dashes"), F.trim(dash(1))).when(F.when(F.col("free"), F.regexp_extract("t", MARKS, 0)).otherwise(F.col("t")).rlike("ZP|Zp"), "ZP").otherwise("")
    level = F.when(F.col("dashes"), F.length(F.regexp_replace(dash(2), "[^-]", ""))).when(~F.col("free") & F.ltrim(F.regexp_replace("t", MARKS, "")).rlike("^['‘’]"), 2).otherwise(1)
    body = F.when(F.col("dashes"), dash(3)).when(F.col("starts"), F.regexp_replace("t", MARKS, "")).otherwise(F.col("t"))
    rows = rows.withColumns({"record": F.sum(F.col("starts").cast("int")).over(by_part), "marks": marked, "level": level, "body": body})
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(line).alias("at"), F.col("body").alias("b")))), lambda v: v["b"]), " ")
    entries = rows.where("NOT closes AND record > 0").groupBy(doc, "part", "record").agg(F.min(line).alias(line), F.min_by("marks", line).alias("marks"), F.min_by("level", line).alias("level"), F.when(F.count("*") == 1, T.text(joined)).otherwise(T.one_blank(joined)).alias("text"))
    heads = rows.where("s IS NOT NULL OR g IS NOT NULL").select(doc, line, F.when(F.col("s").isNotNull(), "section").otherwise("group").alias("kind"), F.lit("").alias("marks"), F.lit(0).alias("level"), F.coalesce("s", "g").alias("text"))
    return entries.select(doc, line, F.lit("entry").alias("kind"), "marks", "level", "text").unionByName(heads)


def grammar_lines(lines: DataFrame, text: str, pattern: str, fields: Sequence[str], clean: Sequence[str], required: Sequence[str], dropped: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines that fit a pattern with its groups as fields, and those rejected with a reason: a required field is empty after
    cleaning, or ``dropped`` (a condition on the fields) holds. Other lines are neither."""
    found = lines.where(F.col(text).rlike(pattern))
    raw = {f: F.regexp_extract(text, pattern, i + 1) for i, f in enumerate(fields)}
    rows = found.withColumns({f: T.clean_list_text(c) if f in clean else c for f, c in raw.items()})
    reasons = [F.when(F.trim(f) == "", F.lit(f"no {f}")) for f in required] + ([F.when(dropped, F.lit("dropped"))] if dropped is not None else [])
    marked = rows.withColumn("reason", F.coalesce(*reasons, F.lit(None).cast("string")))
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def assembled_name(genus: Column, species: Column, cultivar: Column, placeholder: str = "sorte") -> Column:
    """(name, rank) from a table's cells. A placeholder counts as empty; what begins with a rank, or stands behind one,
    belongs to the name; a quoted cultivar stays quoted and a bare one is quoted; without a species it is a class, in brackets."""
    any_one = rf"(?i)^'?{placeholder}'?$"
    cell = lambda c: F.trim(F.coalesce(c, F.lit("")))
    s, c = (F.when(cell(x).rlike(any_one), F.lit("")).otherwise(cell(x)) for x in (species, cultivar))
    ranked = c.rlike(CELL_BEGINS_WITH_RANK) | F.element_at(F.split(s, r"\s+"), -1).rlike(CELL_RANK)
    kind = F.when(c == "", "none").when(ranked, "rank").when(c.rlike("^'.*'$"), "quoted").when(s == "", "class").otherwise("bare")
    tail = F.when(kind == "rank", c).when(kind == "quoted", c).when(kind == "class", F.concat(F.lit("("), c, F.lit(")"))).when(kind == "bare", F.concat(F.lit("'"), c, F.lit("'")))
    name = T.one_blank(F.concat_ws(" ", cell(genus), s, tail))
    return F.struct(name.alias("name"), F.when(kind.isin("quoted", "bare"), "cultivar").when((kind == "class") | (s == ""), "genus").otherwise("species").alias("rank"))
