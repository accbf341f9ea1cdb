"""Lists matched against a catalogue: row rules, parent completion, organ words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Words for parts of plants in file names, by language; words that tell a circumstance; noise.
ORGAN_WORDS = {
    "flower": ["flower", "flowers", "bloom", "blossom", "blossoms", "inflorescence", "blüte", "blüten", "bluete", "blueten", "fleur", "fleurs", "floraison", "flor", "flores", "fiore", "fiori", "kwiat", "kwiaty", "virág"],
    "leaf": ["leaf", "leaves", "foliage", "blatt", "blätter", "blaetter", "laub", "laubblatt", "feuille", "feuilles", "feuillage", "hoja", "hojas", "foglia", "foglie", "liść", "liście", "liscie", "levél"],
    "fruit": ["fruit", "fruits", "seed", "seeds", "cone", "cones", "berry", "berries", "capsule", "frucht", "früchte", "fruechte", "zapfen", "samen", "beere", "beeren", "fruchtstand", "fruto", "frutos", "frutto", "frutti", "owoc", "owoce", "termés"],
    "bark": ["bark", "trunk", "écorce", "ecorce", "tronc", "rinde", "borke", "stamm", "corteza", "corteccia", "kora", "pień"],
    "habit": ["habit", "habitus", "tree", "shrub", "baum", "strauch", "arbre", "arbuste", "árbol", "arbol", "albero", "drzewo", "krzew", "ganzer", "whole"],
}
CIRCUMSTANCE = r"(?i)(?<![A-Za-z0-9_])(snow|ice|icicle|icicles|frost|freezing|rain|storm|wind|damage|damaged|covered|glaze|schnee|eis|regen|sturm|neige|along|near|street|road|avenue|park|garden|arboretum|cemetery|friedhof|jardin|ogród|strasse|straße)(?![A-Za-z0-9_])"  # noqa: E501
NOISE = r"(?i)^([0-9]+|[a-z]{1,3}[0-9]{1,3}|dsc|img|p[0-9]+|by|von|de|the|a|an|and|und|in|at|on|of|mit|with|zz|kz)$"


def expand_row(name: str) -> Column:
    """(name, rank, parent): a species; a placeholder stands for its parent; a cultivar knows its parent."""
    shown = T.one_blank(name)
    epithet, parent = T.own_epithet(shown), T.one_blank(T.parent_name(shown))
    as_struct = lambda n, r, p: F.struct(n.alias("name"), r.alias("rank"), p.cast("string").alias("parent"))
    none = F.lit(None)
    return (
        F.when(epithet.isNull(), as_struct(shown, F.lit("species"), none))
        .when(T.is_placeholder(epithet), as_struct(parent, F.when(T.is_binomial(parent), "species").otherwise("genus"), none))
        .otherwise(as_struct(shown, F.lit("cultivar"), F.nullif(parent, F.lit(""))))
    )


def complete_parents(rows: DataFrame, group: str, name: str, ordinal: str, flag: str, inherited: list[str]) -> DataFrame:
    """Rows with their parent's name, and below them each missing parent species once, marked ``added``.

    A parent has the fields of its first child and the flag if any child has it; a row that was there is never changed.
    """
    epithet = T.own_epithet(name)
    parent = T.one_blank(T.strip_authorship(T.parent_name(name)))
    child = epithet.isNotNull() & ~T.is_placeholder(epithet) & (parent != "")
    once = F.explode(F.array(F.when(child, parent))).alias("parent")  # a row of one, so that the fold isn't evaluated again wherever it is used
    known = rows.select("*", once).withColumn("added", F.lit(False))
    fit = known.where(F.col("parent").contains(" ") & T.is_binomial("parent")).withColumn("__k", T.comparison_name("parent"))
    first = lambda c: F.min_by(c, ordinal).alias(c)
    made = fit.groupBy(group, "__k").agg(F.min_by("parent", ordinal).alias(name), F.min(ordinal).alias(ordinal), F.bool_or(F.coalesce(flag, F.lit(False))).alias(flag), *[first(c) for c in inherited])
    have = rows.select(group, T.comparison_name(name).alias("__k")).distinct()
    new = made.join(have, [group, "__k"], "left_anti").drop("__k").withColumns({"parent": F.lit(None).cast("string"), "added": F.lit(True)})
    return known.unionByName(new, allowMissingColumns=True)


def parent_keys(rows: DataFrame, parent: str, index: DataFrame, alias: str = "parent_key") -> DataFrame:
    """Rows with the key that a name index (name, key) has for their parent's name itself; null without parent or hit."""
    keys = index.select(F.col("name").alias("__n"), F.col("key").alias(alias))
    return rows.join(keys, T.comparison_name(parent) == F.col("__n"), "left").drop("__n")


def organ_of_file(rows: DataFrame, key: str, file: str, taxon: str, most_free: int = 4) -> DataFrame:
    """(key, organ, reason): the part of a plant that a file's name tells, if it is a label and no story."""
    from .filters import NO_PHOTO

    stem = F.regexp_replace(F.coalesce(file, F.lit("")), r"(?i)\.(jpe?g|png|tiff?|gif|webp|svg)$", "")
    tokens = F.filter(F.transform(F.split(F.translate(F.coalesce(taxon, F.lit("")), "'‘’ʽ", "    "), r"\s+"), lambda w: F.lower(w)), lambda w: F.length(w) > 3)
    lexicon = F.create_map(*[F.lit(x) for organ, words in ORGAN_WORDS.items() for w in words for x in (w, organ)])
    r = rows.select(key, stem.alias("s"), tokens.alias("taxon")).withColumn("w", F.regexp_extract_all(F.lower("s"), F.lit(r"[\wÀ-ÿ]+"), F.lit(0)))
    r = r.withColumns({"organs": F.array_distinct(F.filter(F.transform("w", lambda w: lexicon[w]), lambda o: o.isNotNull())), "named": F.exists("taxon", lambda t: F.contains(F.lower("s"), t))})
    free = F.filter("w", lambda w: lexicon[w].isNull() & ~w.rlike(NOISE) & ~F.exists("taxon", lambda t: F.contains(w, t) | F.contains(t, w)))
    reason = (
        F.when(F.col("s").rlike(NO_PHOTO), "no photo").when(F.col("s").rlike(CIRCUMSTANCE), "circumstance").when(~F.col("named"), "taxon not named")
        .when(F.size("organs") == 0, "no organ").when(F.size("organs") > 1, "ambiguous").when(F.size(free) > most_free, "story").otherwise("clear")
    )
    return r.withColumn("reason", reason).select(key, F.when(F.col("reason") == "clear", F.get("organs", F.lit(0))).alias("organ"), "reason")


def ranked_search(index: DataFrame, key: str, names: str, weight: str, query: str) -> DataFrame:
    """(key, class, weight): records that a query meets, the better class first, then by weight."""
    variants = T.search_variants(F.lit(query))
    best = F.array_min(F.flatten(F.transform(names, lambda n: F.filter(F.transform(variants, lambda q: T.hit_class(n, q)), lambda c: c.isNotNull()))))
    return index.select(key, best.alias("class"), weight).where("class IS NOT NULL").orderBy("class", F.desc(weight), key)
