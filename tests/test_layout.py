"""Records of lists against a plain reader that goes line by line, and cells with every quote and dash."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sheafwork.functions import text as T
from sheafwork.operators import filters, layout

LEAD = re.compile(r"\s*(?:ZP|Zp|\+|\s)*")


def begins_freely(rest):
    """A capitalised word, then a small word, a hybrid sign or a quoted name."""
    m = re.match(r"[A-ZÄÖÜ][A-Za-zäöüß-]{2,}\s+", rest)
    if not m:
        return False
    for cut in range(m.end(), 0, -1):  # the white space may give back
        if not rest[cut - 1].isspace():
            break
        tail = rest[cut:]
        if tail.startswith("×") or re.match(r"['‘’][^'‘’]", tail) or re.match(r"x\b", tail, re.A):
            return True
        word = re.match(r"[a-zäöüß][a-zäöüß-]*", tail)
        if word and (word.end() == len(tail) or any(bool(re.match(r"\w", tail[i - 1], re.A)) != bool(re.match(r"\w", tail[i], re.A)) for i in range(1, word.end() + 1))):
            return True
    return False


def read(lines):
    """[(line, marks, level, text)] of one document, headings "Teil"."""
    out, now = [], None

    def start(n, marks, level, text):
        nonlocal now
        now = [n, marks, level, [text]]
        out.append(now)

    for n, t in lines:
        if not t.strip():
            continue
        if t.startswith("Teil ") or (re.match(r"\s*(?:ZP|Zp|\+|\s)*\d+(\.\d+)*\.?\s+\S", t) and "-" not in re.split(r"\s+", t)[0]):
            now = None
            continue
        m = re.match(r"\s*((?:ZP|Zp|\+|[A-Z]\b|\s)*)((?:-\s*)+)(\S.*)$", t, re.A)
        if m:
            start(n, m[1].strip(), m[2].count("-"), m[3].strip())
            continue
        lead = LEAD.match(t)[0]
        rest, whole = t[len(lead) :], "" if now is None else " ".join(now[3])
        inside = whole.count("(") > whole.count(")")
        free = not inside and begins_freely(rest)
        second = (t.split() + ["", ""])[1]
        text_word = second.lower().rstrip(".,") in layout.FILLERS or (second.endswith(".") and second.lower() not in layout.NAME_RANKS)
        if free and not (text_word and now):
            start(n, "ZP" if re.search("ZP|Zp", lead) else "", 1, rest.strip())
        elif not free and now and not inside and (i := re.match(r"((?:[a-zäöüß][a-zäöüß-]+|['‘’][^'‘’]+['‘’])[^,]{0,40}),\s*\S", rest)):
            start(n, "ZP" if re.search("ZP|Zp", t) else "", 2 if i[1][0] in "'‘’" else 1, rest.strip())
        elif now:
            now[3].append(t.strip())
    return [(n, marks, level, parts[0] if len(parts) == 1 else " ".join(" ".join(parts).split())) for n, marks, level, parts in out]


PIECES = [
    "- ", "-  - ", "ZP - ", "  + ", "   ", "ZP ", "Rosa ", "Malus ", "Garten ", "silvestris", "goldRot", "gold ", "bzw. ", "der ", "Blumen", "cv. ", "ssp. ", "convar. ", "x ", "× ", "‘Alba’", "'Globosum', ", ", Apfel", "(syn. ", ") ", "(", "2.2 ", "Teil ", "grandis, Tanne",
    "auch ", "ö", "für ", "Zp ", "A ", "  ",
]


def test_records_of_random_lines(spark):
    r = random.Random(11)
    docs = {d: ["".join(r.choice(PIECES) for _ in range(r.randrange(1, 6))) for _ in range(40)] for d in range(120)}
    rows = [(d, i, t) for d, ts in docs.items() for i, t in enumerate(ts)]
    frame = spark.createDataFrame(rows, "doc int, line int, t string").repartition(5)
    section = F.when(F.col("t").startswith("Teil "), F.col("t"))
    got = layout.list_records(frame, "doc", "line", "t", section, F.lit(None).cast("string"), F.lit(False), F.lit(False)).where("kind = 'entry'").collect()
    want = {(d, *e) for d, ts in docs.items() for e in read(list(enumerate(ts)))}
    assert {(x["doc"], x["line"], x["marks"], x["level"], x["text"]) for x in got} == want and len(want) > 600


@pytest.mark.parametrize(
    ("lines", "want"),
    [
        (["- Rosa", "Garten der Blumen"], ["Rosa Garten der Blumen"]),
        (["- Rosa", "Rosa cv. Alba"], ["Rosa", "Rosa cv. Alba"]),
        (["- Rosa", "Malus goldRot"], ["Rosa Malus goldRot"]),
        (["- Rosa )", "Malus silvestris (", "grandis, Tanne"], ["Rosa )", "Malus silvestris ( grandis, Tanne"]),
        (["- Rosa (syn.", "Azalea mollis), Azalee", "Malus silvestris"], ["Rosa (syn. Azalea mollis), Azalee", "Malus silvestris"]),
    ],
)
def test_records_of_known_lines(spark, lines, want):
    frame = spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "doc int, line int, t string")
    none = F.lit(None).cast("string")
    assert [x["text"] for x in layout.list_records(frame, "doc", "line", "t", none, none, F.lit(False), F.lit(False)).orderBy("line").collect()] == want
    assert [e[3] for e in read(list(enumerate(lines)))] == want


def each(spark, values, column):
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    width = len(rows[0]) - 1
    frame = spark.createDataFrame(rows, "i int, " + ", ".join(f"c{k} string" for k in range(width)))
    return [x["out"] for x in frame.withColumn("out", column).orderBy("i").collect()]


def test_cells(spark):
    assert each(spark, ["Acer ‘Globosum’, Gras–Lilie", "\fBirne", "Bírnbaum (syn. A) in Sorten z.B.", "a,b , c", "A  'x'", "ü–ä—ö−ß", None, "in Sortenliste", "A`b´c"], T.clean_list_text("c0")) == [
        "Acer 'Globosum', Gras-Lilie", "Birne", "Birnbaum", "a, b , c", "A 'x'", "ü-ä-ö-ß", "", "in Sortenliste", "A'b'c",
    ]


def test_names_that_break_off(spark):
    rows = [("Quercus robur", "Quercus robur L."), ("Malus 'Cox", "Malus 'Cox's Orange'"), ("Malus ʽCox", "Malus ʽCox’s Orange"), ("Malus 'Cox's", "Pyrus 'Cox's Orange'"), ("Malus 'Cox'", "Malus 'Cox's Orange'"), (None, "x"), ("A 'b", None)]
    assert each(spark, rows, T.completed_name("c0", "c1")) == ["Quercus robur", "Malus 'Cox's Orange'", "Malus 'Cox", "Malus 'Cox's", "Malus 'Cox'", None, "A 'b"]
    common = [("Felsen Storchschnabel ʽIngwersen’", "G. m. ʽIngwersen", "G. m. ʽIngwersen's Variety’"), ("Rose 'Andere'", None, "R. 'Cox's'"), ("Rose", None, "R. 'Cox'"), ("Rose 'Cox'", "R. 'Cox's Gold'", None), (None, "a", "b")]
    assert each(spark, common, T.completed_common_name("c0", "c1", "c2")) == ["Felsen Storchschnabel 'Ingwersen's Variety'", "Rose 'Andere'", "Rose", "Rose 'Cox's Gold'", None]


def test_licences(spark):
    forms = ["CC0 1.0", "cc-by-4.0", "https://creativecommons.org/licenses/zero/1.0", "CC BY SA 4.0", "CC BY", "CC BY-NC-ND 2.5 DE", "", "http://x/publicdomain/zero", "©"]
    assert each(spark, forms, T.normal_licence("c0")) == ["CC0 1.0", "cc-by-4.0", "cc-zero", "cc-by-sa", "cc-by", "cc-by-nc-nd-de", None, "cc-0", "©"]
    assert each(spark, ["CC BY", "Non-free", "CC BY-NC", "cc by nd", "Fair use", "nonfree logo", "", None, "candid"], filters.not_denied("c0")) == [True, False, False, False, False, False, False, False, True]
