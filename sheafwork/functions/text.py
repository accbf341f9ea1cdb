"""Name and text expressions as native Columns; each is used inside a table job of ``operators``."""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# The quotation signs that enclose a cultivar's name in different sources, and the marks of ranks.
QUOTES = "'‘’ʽʼ`´"
CULTIVAR_QUOTES = "'‘’ʽʼ"
RANK_MARKS = r"(subsp|ssp|var|f|sect|agg|cv|ser|subg)\."

_S = r"(?U)\s"  # white space with no-break blanks, as other engines mean it
_WHITE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))  # the same, for trimming


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


@lru_cache(maxsize=1)
def _diacritics() -> tuple[str, str]:
    """Latin letters with marks and their bases, by decomposition."""
    pairs = [(chr(i), unicodedata.normalize("NFD", chr(i))) for i in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))]
    pairs = [(a, b[0]) for a, b in pairs if len(b) > 1 and b[0].isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def text(x: ColumnLike) -> Column:
    """The text without outer white space; null becomes empty."""
    return F.btrim(F.coalesce(_c(x).cast("string"), F.lit("")), F.lit(_WHITE))


def one_blank(x: ColumnLike) -> Column:
    return text(F.regexp_replace(text(x), rf"{_S}+", " "))


def fold(x: ColumnLike) -> Column:
    """Without diacritics."""
    return F.regexp_replace(F.translate(_c(x), *_diacritics()), "[̀-ͯ]", "")


def expand_umlauts(x: ColumnLike) -> Column:
    spelled = {"ä": "ae", "ö": "oe", "ü": "ue", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue", "ß": "ss"}
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), spelled.items(), _c(x))


def drop_hybrid_mark(x: ColumnLike) -> Column:
    return F.regexp_replace(_c(x), rf"(?U)(^|\s)[x×](?=\s)", " ")


def squash(x: ColumnLike) -> Column:
    """Letters and digits only."""
    return F.regexp_replace(F.lower(drop_hybrid_mark(x)), "[^a-z0-9]", "")


def squash_words(x: ColumnLike) -> Column:
    """As ``squash``, with one blank between words."""
    return F.trim(F.regexp_replace(F.lower(drop_hybrid_mark(x)), "[^a-z0-9]+", " "))


def search_variants(x: ColumnLike, gaps: bool = True) -> Column:
    """A name with umlauts spelled out and, where that differs, folded; with or without gaps between words.

    Both are made from one cleaned form that still has its umlauts, so that the patterns run once over a text.
    """
    marked, bases = _diacritics()
    kept = [(a, b) for a, b in zip(marked, bases) if a not in "äöüÄÖÜ"]
    plain = F.translate(F.replace(text(x), F.lit("ß"), F.lit("ss")), "".join(a for a, _ in kept), "".join(b for _, b in kept))
    low = F.lower(drop_hybrid_mark(F.regexp_replace(plain, "[̀-ͯ]", "")))
    form = F.trim(F.regexp_replace(low, "[^a-z0-9äöü]+", " ")) if gaps else F.regexp_replace(low, "[^a-z0-9äöü]", "")
    spelled = lambda v: reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), {"ä": "ae", "ö": "oe", "ü": "ue"}.items(), v)
    both = F.flatten(F.transform(F.array(form), lambda v: F.array(spelled(v), F.translate(v, "äöü", "aou"))))  # a row of one, so that the form isn't made twice
    return F.array_distinct(F.filter(both, lambda v: v != ""))


def search_index(names: ColumnLike, gaps: bool = True) -> Column:
    """All variants of an array of names, in order, each once."""
    return F.array_distinct(F.flatten(F.transform(_c(names), lambda n: search_variants(n, gaps))))


def glued(terms: ColumnLike) -> Column:
    return F.array_distinct(F.transform(_c(terms), lambda t: F.replace(t, F.lit(" "), F.lit(""))))


def catalogue_index(local: ColumnLike, botanical: ColumnLike) -> Column:
    """(names, n_local, terms): search names of the local names first, then of the botanical ones that those lack; how many are
    local, so that a word's end counts as a hit in them only; and all names without gaps, each once."""
    own = search_index(F.filter(_c(local), lambda n: n.isNotNull()))
    rest = F.array_except(search_index(F.transform(F.filter(_c(botanical), lambda n: n.isNotNull()), strip_authorship)), own)
    names = F.concat(own, rest)
    return F.struct(names.alias("names"), F.size(own).alias("n_local"), glued(names).alias("terms"))


def hit_class(name: ColumnLike, query: ColumnLike) -> Column:
    """How a query meets a search name: 0 the name, 1 a word, 2 a word's end, 3 a word's start, 4 inside a word; null: not."""
    n, q = _c(name), _c(query)
    words = F.split(n, " ")
    return (
        F.when(n == q, 0).when(F.array_contains(words, q), 1)
        .when(F.exists(words, lambda w: w.endswith(q)), 2).when(F.exists(words, lambda w: w.startswith(q)), 3)
        .when(F.exists(words, lambda w: w.contains(q)), 4)
    )


def strip_authorship(x: ColumnLike) -> Column:
    """A botanical name without its authors: words are kept up to the first that is neither epithet, rank nor sign."""
    words = F.split(one_blank(x), " ")
    start = F.struct(F.slice(words, 1, 1).alias("kept"), F.lit(False).alias("ranked"), F.lit(False).alias("ended"))

    def step(s: Column, w: Column) -> Column:
        sign = w.isin("×", "x")
        opened, closed = w.rlike(f"^[{QUOTES}]"), w.rlike(f"[{QUOTES}]$")
        quoted = opened | closed
        rank = w.rlike(f"^{RANK_MARKS}$")
        bare = F.regexp_replace(w, "^[×x]", "")
        taken = sign | quoted | s["ranked"] | rank | ((F.length(bare) > 0) & (bare == F.lower(bare)))
        left_open = ~closed | (F.length(w) == 1)
        ranked = F.when(sign, s["ranked"]).when(quoted, s["ranked"] & ~left_open).when(s["ranked"], False).otherwise(rank)
        go_on = ~s["ended"] & taken
        return F.struct(
            F.when(go_on, F.concat(s["kept"], F.array(w))).otherwise(s["kept"]).alias("kept"),
            F.when(go_on, ranked).otherwise(s["ranked"]).alias("ranked"),
            (s["ended"] | ~taken).alias("ended"),
        )

    return F.aggregate(F.slice(words, 2, F.size(words)), start, step, lambda s: F.array_join(s["kept"], " "))


# Signs that no usable name has.
UNUSABLE = (r"[0-9]", r'[<>{}\[\]|@€$;"]', r"!!|\.\.\.")


def usable_name(x: ColumnLike) -> Column:
    """A name of 1 to 60 characters without digits, markup, quotes or signs of a sentence."""
    n = text(x)
    return reduce(lambda a, b: a & ~n.rlike(b), UNUSABLE, F.length(n).between(1, 60))


def own_epithet(x: ColumnLike) -> Column:
    """The quoted part, else the word behind a rank; null if neither."""
    c = _c(x)
    quoted = F.regexp_extract(c, f"[{CULTIVAR_QUOTES}]([^{CULTIVAR_QUOTES}]+)[{CULTIVAR_QUOTES}]", 1)
    ranked = F.regexp_extract(c, r"(?<![A-Za-z0-9_])(?:subsp|ssp|var|f)\.\s+(\S+)", 1)
    return F.coalesce(F.nullif(quoted, F.lit("")), F.nullif(ranked, F.lit("")))


def parent_name(x: ColumnLike) -> Column:
    """What stands before the rank or the quoted part."""
    return text(F.element_at(F.split(F.coalesce(_c(x), F.lit("")), rf"\s*(?:(?<![A-Za-z0-9_])(?:subsp|ssp|var|f)\.|[{CULTIVAR_QUOTES}])", -1), 1))


def comparison_name(x: ColumnLike) -> Column:
    """A name for comparison: no brackets or trade marks, folded, lower case, words of letters and digits."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"\([^)]*\)", " "), "[®™Ⓐ-ⓩ]", "")
    return F.trim(F.regexp_replace(F.lower(F.translate(fold(bare), "×", "x")), "[^a-z0-9]+", " "))


def bracket_key(x: ColumnLike) -> Column:
    """As ``comparison_name``, but what stands in brackets counts, where it alone tells names apart."""
    return comparison_name(F.translate(F.coalesce(_c(x), F.lit("")), "()", "  "))


def is_binomial(x: ColumnLike) -> Column:
    return F.size(F.split(comparison_name(x), " ")) >= 2


def is_placeholder(x: ColumnLike, word: str = "sorte") -> Column:
    return F.lower(text(x)) == word


# The signs and marks by which a name shows its rank.
def rank_of(x: ColumnLike) -> Column:
    """The rank that a name shows; the more special one first."""
    c = _c(x)
    return (
        F.when(c.rlike("['‘’ʽ][^'‘’ʽ]+['‘’ʽ]"), "cultivar").when(c.rlike(r"(?<![A-Za-z0-9_])(subsp|ssp)\."), "subspecies")
        .when(c.rlike(r"(?<![A-Za-z0-9_])var\."), "variety").when(c.rlike(r"(?<![A-Za-z0-9_])f\.\s+[a-z]"), "form")
        .when(c.rlike(r"(?<![A-Za-z0-9_])(sect|agg)\."), "aggregate").when(c.contains("×"), "hybrid")
    )


def genus(x: ColumnLike) -> Column:
    return F.nullif(F.element_at(F.split(F.regexp_replace(text(x), r"^[×x]\s*", ""), rf"{_S}+"), 1), F.lit(""))


def has_group_mark(x: ColumnLike) -> Column:
    """Whether a name carries a rank above species."""
    return F.coalesce(_c(x), F.lit("")).rlike(r"(?i)(?<![A-Za-z0-9_])(sect|agg|ser|subg|subsect)\.?(\s|$)")


def guarded_epithet(x: ColumnLike) -> Column:
    """The second of exactly two words, if it is a plain epithet."""
    words = F.split(text(x), rf"{_S}+")
    plain = (F.size(words) == 2) & ~F.exists(words, lambda w: w.isin("×", "x")) & F.get(words, F.lit(1)).rlike("^[a-z-]+$")
    return F.when(plain, F.get(words, F.lit(1)))


def binomial(x: ColumnLike) -> Column:
    return F.array_join(F.slice(F.split(F.lower(one_blank(x)), " "), 1, 2), " ")


def epithet_stem(x: ColumnLike) -> Column:
    """The second word without a Latin gender ending."""
    return F.regexp_replace(F.coalesce(F.get(F.split(_c(x), " "), F.lit(1)), F.lit("")), "(us|um|a|is|e|os)$", "")


def same_apostrophe(x: ColumnLike) -> Column:
    return F.trim(F.translate(_c(x), "‘’ʽʼ`´", "''''''"))


# Marks of a rank, the shape of a genus with its epithet, letters of a common name.
BOTANICAL_RANK, BOTANICAL_PAIR, COMMON_LETTERS = r"(?<![A-Za-z0-9_])(subsp|ssp|var|f|sect|agg|cv)\.\s", r"^[A-Z][a-z]+\s+[×x]?[a-z-]{3,}(\s|$)", "[a-zäöüß]"


def looks_botanical(x: ColumnLike) -> Column:
    """A rank mark, genus with epithet, or no lower-case letter: no common name."""
    n = text(x)
    return (n == "") | n.rlike(BOTANICAL_RANK) | n.rlike(BOTANICAL_PAIR) | ~n.rlike(COMMON_LETTERS)


# Shapes of what is given as a common name and is none: a binomial, an author, a rank, an author in brackets or a year.
NO_COMMON_NAME = (r"^[A-Z][a-zë-]+\s+[a-zë-]+(\s|$)", r"\s[A-Z][a-z]{0,6}\.$", r"(?<![A-Za-z0-9_])(subsp|var|f|cv|sect|ser|nothosubsp)\.\s", r"\(\s*[A-Z][a-z]*\.?\s*\)|(?<![A-Za-z0-9_])[0-9]{4}(?![A-Za-z0-9_])")
VOWELS = "(?i)[aeiouäöü]"


def genuine_common_name(name: ColumnLike, scientific: ColumnLike) -> Column:
    """3 to 60 characters that are neither the scientific name, its genus, a binomial, an author nor a rank."""
    n, sci = text(name), F.coalesce(_c(scientific), F.lit(""))
    bare = lambda c: F.regexp_replace(F.lower(c), "[^a-zäöüß]", "")
    first = F.element_at(F.split(sci, rf"{_S}+"), 1)
    bad = [bare(n) == bare(sci), (first != "") & (bare(n) == bare(first)), *[n.rlike(p) for p in NO_COMMON_NAME], ~n.rlike(VOWELS)]
    return F.length(n).between(3, 60) & ~reduce(lambda a, b: a | b, bad)


# The shape of a genus with a quoted name.
QUOTED_OF_GENUS = "^[A-Z][a-z]+ .*'"


def genuine_label(label: ColumnLike, botanical: ColumnLike, english: ColumnLike) -> Column:
    """A label that differs from the botanical and the English one and isn't a quoted name of the genus."""
    n = same_apostrophe(label)
    quoted = n.rlike(QUOTED_OF_GENUS) & (F.element_at(F.split(n, " "), 1) == F.element_at(F.split(_c(botanical), " "), 1))
    return F.coalesce((n != "") & (n != same_apostrophe(botanical)) & F.coalesce(n != same_apostrophe(english), F.lit(True)) & ~quoted, F.lit(False))


def of_another(scientific: ColumnLike, category: ColumnLike) -> Column:
    """Whether a category belongs to another taxon: it omits the own epithet and begins with the parent's name."""
    k, epithet = comparison_name(category), own_epithet(scientific)
    return F.coalesce((F.coalesce(_c(category), F.lit("")) != "") & epithet.isNotNull() & ~k.contains(comparison_name(epithet)) & k.startswith(comparison_name(parent_name(scientific))), F.lit(False))


def composed_name(common: ColumnLike, parent_common: ColumnLike, scientific: ColumnLike) -> Column:
    """(name, source): the common name unless botanical, else the parent's with the own epithet or rank, else the stripped name."""
    sci, parent = _c(scientific), _c(parent_common)
    quoted = F.nullif(F.regexp_extract(sci, f"[{CULTIVAR_QUOTES}]([^{CULTIVAR_QUOTES}]+)[{CULTIVAR_QUOTES}]", 1), F.lit(""))
    ranked = F.nullif(F.regexp_extract(sci, r"(?<![A-Za-z0-9_])((?:subsp|ssp|var|f)\.\s+\S+)", 1), F.lit(""))
    made = F.coalesce(F.concat(parent, F.lit(" '"), quoted, F.lit("'")), F.concat(parent, F.lit(" "), ranked))
    own = F.when(~looks_botanical(common), _c(common))
    source = F.when(own.isNotNull(), "own").when(made.isNotNull(), "composed").otherwise("botanical")
    return F.struct(F.coalesce(own, made, strip_authorship(sci)).alias("name"), source.alias("source"))


# Signs that open a sort's name, and signs that close it.
OPENING, CLOSING = "ʽ‘'´`", "’'´`"


def sort_part(x: ColumnLike) -> Column:
    """What stands between a name's first opening sign and a closing one at its end; null where the name ends before that.

    Signs aren't counted: a genitive inside a sort's name has one of its own.
    """
    return F.nullif(F.regexp_extract(F.coalesce(_c(x), F.lit("")), rf"[{OPENING}](.+)[{CLOSING}]\s*$", 1), F.lit(""))


def is_cut_off(x: ColumnLike) -> Column:
    """Whether a name opens a sort's name and never closes it."""
    return F.coalesce(_c(x).rlike(f"[{OPENING}]") & sort_part(x).isNull(), F.lit(False))


def completed_name(canonical: ColumnLike, scientific: ColumnLike) -> Column:
    """The scientific name where the canonical one is cut off in its sort's name and the scientific one goes on from there, with straight apostrophes."""
    goes_on = is_cut_off(canonical) & F.coalesce(_c(scientific).startswith(_c(canonical)), F.lit(False)) & sort_part(scientific).isNotNull()
    return same_apostrophe(F.when(goes_on, _c(scientific)).otherwise(_c(canonical)))


def completed_common_name(common: ColumnLike, canonical: ColumnLike, scientific: ColumnLike) -> Column:
    """A common name whose sort was cut at a genitive, with the whole sort of the botanical name if that begins with it; straight apostrophes."""
    whole, short = F.coalesce(sort_part(scientific), sort_part(canonical)), sort_part(common)
    parts = rf"^([^{OPENING}]*[{OPENING}])(.+)([{CLOSING}])\s*$"
    made = F.concat(F.regexp_extract(_c(common), parts, 1), whole, F.regexp_extract(_c(common), parts, 3))
    return same_apostrophe(F.when(F.coalesce((short != whole) & whole.startswith(short), F.lit(False)), made).otherwise(_c(common)))


def normal_licence(x: ColumnLike) -> Column:
    """A licence's short name: a short form in lower case, a text "CC BY ..." joined by hyphens without its version, the kind in an
    address of a licence, cc-0 for the public domain's; other texts stay, empty ones are null."""
    low = F.lower(_c(x))
    joined = F.regexp_replace(F.regexp_replace(low, r"\s+", "-"), r"^(.*?)-?[0-9]+\.[0-9]+", "$1")
    kind = F.regexp_extract(low, r"licenses/([a-z-]+)", 1)
    return (
        F.when(_c(x) == "", F.lit(None)).when(low.startswith("cc-"), low).when(low.rlike(r"^cc\s+by"), F.regexp_replace(joined, "-+$", ""))
        .when(low.contains("creativecommons.org/licenses/") & (kind != ""), F.concat(F.lit("cc-"), kind)).when(low.contains("publicdomain/zero"), F.lit("cc-0")).otherwise(_c(x))
    )


def plain_text(x: ColumnLike) -> Column:
    """Without tags, white space as one blank; what tags part stays together."""
    return one_blank(F.regexp_replace(_c(x), "<[^>]*>", ""))


def without_suffix(x: ColumnLike) -> Column:
    """A title without a trailing bracket."""
    return text(F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"\s*\([^)]*\)\s*$", ""))


def query_parameter(url: ColumnLike, *names: str) -> Column:
    """The first named parameter of an address, else its last path segment."""
    found = [F.nullif(F.regexp_extract(_c(url), rf"[?&]{n}=([^&#]*)", 1), F.lit("")) for n in names]
    return F.coalesce(*found, F.nullif(F.regexp_extract(_c(url), r"/([^/?#]+)/?(?:[?#].*)?$", 1), F.lit("")))


def percent_encoded(x: ColumnLike) -> Column:
    """Form encoding with a blank as %20 and the signs that addresses leave alone."""
    kept = {"+": "%20", "%21": "!", "%27": "'", "%28": "(", "%29": ")", "%7E": "~"}
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), kept.items(), F.url_encode(_c(x)))


def hashed_path(name: ColumnLike, base: str) -> Column:
    """A file's address below folders named by its hash."""
    n = F.translate(_c(name), " ", "_")
    h = F.md5(n)
    return F.concat(F.lit(base.rstrip("/") + "/"), F.substring(h, 1, 1), F.lit("/"), F.substring(h, 1, 2), F.lit("/"), percent_encoded(n))


#: The widths that a hashed store has of a file.
WIDTHS = (120, 250, 500, 1280)


def thumb_path(name: ColumnLike, base: str, width: int) -> Column:
    """The address of a smaller copy, of one of the WIDTHS."""
    if width not in WIDTHS:
        raise ValueError(f"no copies of width {width}, only {WIDTHS}")
    n = F.translate(_c(name), " ", "_")
    h, e = F.md5(n), percent_encoded(n)
    return F.concat(F.lit(base.rstrip("/") + "/thumb/"), F.substring(h, 1, 1), F.lit("/"), F.substring(h, 1, 2), F.lit("/"), e, F.lit(f"/{width}px-"), e)


def cache_path(original: ColumnLike, key: ColumnLike, base: str) -> Column:
    """The address of an original's cached copy: its record's key and the hash of where it is from."""
    return F.concat(F.lit(base.rstrip("/") + "/"), _c(key).cast("string"), F.lit("/media/"), F.md5(_c(original)))


def sized_path(identifier: ColumnLike, base: str, size: str) -> Column:
    """The address of an image in one of the sizes o, m and s."""
    if size not in ("o", "m", "s"):
        raise ValueError(f"no such size: {size}")
    return F.concat(F.lit(f"{base.rstrip('/')}/{size}/"), _c(identifier).cast("string"))


def with_width(address: ColumnLike, width: int, marker: str = "/image/cache/occurrence/") -> Column:
    """A cached copy's address asking for a width; 0 leaves it."""
    fitted = marker.replace("/cache/", f"/cache/fit-in/{width}x0/")
    return F.replace(_c(address), F.lit(marker), F.lit(fitted)) if width else _c(address)


def drop_stress(x: ColumnLike) -> Column:
    """Without acute and grave, which lists set as reading aids; other diacritics stay."""
    return F.translate(F.regexp_replace(_c(x), "[\u0300\u0301]", ""), "áàéèíìóòúùýỳÁÀÉÈÍÌÓÒÚÙÝỲćńǹŕśźĺẁẃĆŃǸŔŚŹĹẀẂ", "aaeeiioouuyyAAEEIIOOUUYYcnnrszlwwCNNRSZLWW")


# Forms of the quote and of the dash in lists.
LIST_QUOTES, LIST_DASHES = "‘’ʽʼ`´", "\u2010\u2011\u2012\u2013\u2014\u2015\u2212"


def clean_list_text(x: ColumnLike) -> Column:
    """A list's cell: no stress marks, quotes and dashes alike, no form feeds, brackets or what follows "in sorts"; one blank before a quote and behind commas."""
    alike = F.translate(drop_stress(F.coalesce(_c(x), F.lit(""))), LIST_QUOTES + LIST_DASHES + "\f", "'" * len(LIST_QUOTES) + "-" * len(LIST_DASHES))
    bare = F.regexp_replace(F.regexp_replace(alike, r"\([^)]*\)", " "), r"(?i)\s+in\s+Sorten(?![A-Za-z0-9_]).*$", "")
    return one_blank(F.regexp_replace(bare, r",(?=\S)", ", "))


def list_rank(name: ColumnLike, given: ColumnLike) -> Column:
    """A list row's rank: a given genus, else what the name shows, else a given sort, else species."""
    n, g = F.coalesce(_c(name), F.lit("")), _c(given)
    return (
        F.when(g == "gattung", "genus").when(n.rlike(f"[{CULTIVAR_QUOTES}]"), "cultivar").when(n.contains(" var. "), "variety").when(n.rlike(r" (subsp|ssp)\. "), "subspecies")
        .when(n.contains(" f. "), "form").when(g == "sorte", "cultivar").otherwise("species")
    )


def is_aggregate(synonyms: ColumnLike) -> Column:
    """Whether a synonym names a section or an aggregate; the accepted name alone doesn't show it."""
    return F.coalesce(F.exists(_c(synonyms), lambda n: F.coalesce(n.rlike(r"(?i)(?<![A-Za-z0-9_])(sect|agg)\.?(\s|$)"), F.lit(False))), F.lit(False))


def german_sort_key(x: ColumnLike) -> Column:
    """The key of DIN 5007-1: umlauts as their bases, sharp s as ss, lower case."""
    return F.lower(fold(F.replace(_c(x), F.lit("ß"), F.lit("ss"))))


def small_key(x: ColumnLike) -> Column:
    return F.trim(F.regexp_replace(F.lower(text(x)), r"[\s-]+", " "))


def alnum_key(x: ColumnLike) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(_c(x), F.lit(""))), "[^a-z0-9äöüß]", "")
