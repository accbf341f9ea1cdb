import pytest
from pyspark.sql import functions as F

from sheafwork.functions import text as T
from sheafwork.operators import lists


def each(spark, cases, expression):
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, " + ", ".join(f"c{k} string" for k in range(len(cases[0]))))
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


AUTHORS = [
    ("Salvia nemorosa Crantz f. ex Koch", "Salvia nemorosa"), ("Tilia tomentosa (Vent.) Brot. ex Link", "Tilia tomentosa"), ("Carpinus orientalis Mill.", "Carpinus orientalis"),
    ("Spiraea × cinerea Zabel", "Spiraea × cinerea"), ("Viola ×wittrockiana Gams", "Viola ×wittrockiana"), ("Pinus nigra subsp. laricio", "Pinus nigra subsp. laricio"),
    ("Tilia", "Tilia"), ("", ""), ("Phlox paniculata var. Orange", "Phlox paniculata var. Orange"), ("Tilia cordata ʽGreenspire’", "Tilia cordata ʽGreenspire’"),
]


def test_strip_authorship(spark):
    assert each(spark, [(a,) for a, _ in AUTHORS], T.strip_authorship("c0")) == [b for _, b in AUTHORS]


def test_stripping_removes_glued_hits(spark):
    names = [("Sedum album Schlinden. Ex Vent.",), ("Carex lingua Alinde Koch",)]
    assert all("linde" in x for x in each(spark, names, T.squash("c0")))
    assert not any("linde" in x for x in each(spark, names, T.squash(T.strip_authorship("c0"))))


@pytest.mark.parametrize(
    ("name", "ok"),
    [("Hainbuche", True), ("Schöne Kugel-Linde", True), ("€9;x", False), ("Linde <b>rot</b>", False), ("Linde !!", False), ("y" * 61, False), ("", False), ("Linde 12", False)],
)
def test_usable_name(spark, name, ok):
    assert each(spark, [(name,)], T.usable_name("c0")) == [ok]


def test_search_variants(spark):
    cases = {"Silber-Linde": ["silber linde"], "Kälberkropf": ["kaelberkropf", "kalberkropf"], "Süßkirsche": ["suesskirsche", "susskirsche"], "Salvia   nemorosa": ["salvia nemorosa"], "": [], "Spiraea x cinerea": ["spiraea cinerea"], "Spiraea ×cinerea": ["spiraea cinerea"]}
    assert each(spark, [(c,) for c in cases], T.search_variants("c0")) == list(cases.values())


def test_hit_classes(spark):
    cases = [("Linde", "linde", 0), ("Silber Linde", "linde", 1), ("Silberlinde", "linde", 2), ("Lindenblättriger Ahorn", "linde", 3), ("Gelindes Kraut", "linde", 4), ("Hainbuche", "linde", None), ("Tilia cordata", "tilia cordata", 0)]
    got = each(spark, [(a, b) for a, b, _ in cases], T.hit_class(F.get(T.search_variants("c0"), F.lit(0)), "c1"))
    assert got == [c for *_, c in cases]


def test_glued_terms_are_derived(spark):
    names = F.split("c0", r"\|")
    both = each(spark, [("Silber-Linde|Silberlinde|Kälberkropf|Tilia cordata",)], F.struct(T.glued(T.search_index(names)).alias("a"), T.search_index(names, gaps=False).alias("b")))[0]
    assert both["a"] == both["b"]


def test_catalogue_index(spark):
    rows = spark.createDataFrame([(["Süßkirsche", None, "Vogel-Kirsche"], ["Prunus avium L.", "Vogelkirsche", "Cerasus avium (L.) Moench", None]), ([], ["Tilia"])], "a array<string>, b array<string>")
    got = [r[0] for r in rows.select(T.catalogue_index("a", "b").alias("i")).collect()]
    assert got[0]["names"] == ["suesskirsche", "susskirsche", "vogel kirsche", "prunus avium", "vogelkirsche", "cerasus avium"] and got[0]["n_local"] == 3
    assert got[0]["terms"] == ["suesskirsche", "susskirsche", "vogelkirsche", "prunusavium", "cerasusavium"] and tuple(got[1]) == (["tilia"], 0, ["tilia"])


def test_comparison_name(spark):
    cases = {
        "Salvia nemorosa 'Caradonna'": "salvia nemorosa caradonna", "Salvia nemorosa ʽCaradonna’": "salvia nemorosa caradonna", "Phlox 'Miss Mary´s Joy'": "phlox miss mary s joy",
        "Spiraea × cinerea": "spiraea x cinerea", "Dahlia 'Gerry' (Zwerg-Gruppe)": "dahlia gerry", "Erica carnea 'WintersonneⓈ'": "erica carnea wintersonne", "Prunus avium  'Sorte'": "prunus avium sorte",
    }
    assert each(spark, [(c,) for c in cases], T.comparison_name("c0")) == list(cases.values())
    assert each(spark, [("Dahlia (Zwerg)",), ("Dahlia (Riesen)",)], T.bracket_key("c0")) == ["dahlia zwerg", "dahlia riesen"]


def test_ranks_epithets_and_genera(spark):
    assert each(spark, [("Abelia ×grandiflora 'Kaleidoscope'",), ("Pinus x subsp. y",), ("Viola × odora",), ("Rubus sect. Corylifolii",), ("Tilia",)], T.rank_of("c0")) == ["cultivar", "subspecies", "hybrid", "aggregate", None]
    assert each(spark, [("Tilia cordata 'Rancho'",), ("Pinus nigra subsp. laricio",), ("Tilia",)], T.own_epithet("c0")) == ["Rancho", "laricio", None]
    assert each(spark, [("Sorbus × latifolia",), ("Tilia cordata",), ("Tilia cordata subsp. x",), ("Tilia",)], T.guarded_epithet("c0")) == [None, "cordata", None, None]
    assert each(spark, [("× Fatshedera lizei",), ("Viola odorata",), ("",)], T.genus("c0")) == ["Fatshedera", "Viola", None]
    assert each(spark, [("Rubus sect. Corylifolii",), ("Ranunculus auricomus agg.",), ("Tilia subsp. x",)], T.has_group_mark("c0")) == [True, True, False]


def test_common_names(spark):
    cases = [("Hainbuche", "Carpinus betulus", True), ("Carex lingva", "Carex lingua", False), ("Tilia", "Tilia cordata", False), ("Viola odorata L.", "Viola x", False), ("Echter Salbei", "Salvia officinalis", True), ("ab", "x y", False)]
    assert each(spark, [(a, b) for a, b, _ in cases], T.genuine_common_name("c0", "c1")) == [c for *_, c in cases]


ORGANS = [
    ('Tilia tomentosa "Brabant" - feuilles.JPG', "Tilia tomentosa 'Brabant'", "leaf", "clear"), ("Schöne Blüte Salvia nemorosa.JPG", "Salvia nemorosa 'Caradonna'", "flower", "clear"),
    ("Rancho Linden Tree.jpg", "Tilia cordata 'Rancho'", "habit", "clear"), ("2019-03-02 Old leaves of Rancho after frost.jpg", "Tilia cordata 'Rancho'", None, "circumstance"),
    ("Catalogue of roses, seeds (1912).jpg", "Tilia cordata", None, "no photo"), ("Nice tree in Bratislava.jpg", "Tilia cordata 'Rancho'", None, "taxon not named"),
    ("Tilia cordata 'Rancho' fruit and bark detail.jpg", "Tilia cordata 'Rancho'", None, "ambiguous"), ("Tilia cordata 'Rancho'.jpg", "Tilia cordata 'Rancho'", None, "no organ"),
]


def test_organ_of_file(spark):
    rows = spark.createDataFrame([(i, f, t) for i, (f, t, *_) in enumerate(ORGANS)], "i int, f string, t string")
    got = {r["i"]: (r["organ"], r["reason"]) for r in lists.organ_of_file(rows, "i", "f", "t").collect()}
    assert [got[i] for i in range(len(ORGANS))] == [o[2:] for o in ORGANS]


def test_parent_completion(spark):
    rows = spark.createDataFrame(
        [(0, "L", "Tilia cordata 'Rancho'", True, "k1"), (1, "L", "Tilia cordata 'Erecta'", False, "k2"), (2, "L", "Salvia nemorosa", False, "k"), (3, "L", "Salvia nemorosa 'Caradonna'", True, "k"), (4, "L", "Dahlia 'Gerry'", False, "k"), (5, "L", "Prunus avium 'Sorte'", False, "k"), (6, "L", "Phlox Hybride 'Joy'", False, "k")],
        "o int, g string, n string, f boolean, k string",
    )
    got = {(r["n"], r["parent"], r["f"], r["added"]) for r in lists.complete_parents(rows, "g", "n", "o", "f", ["k"]).repartition(5).collect()}
    assert ("Tilia cordata", None, True, True) in got and ("Dahlia 'Gerry'", "Dahlia", False, False) in got and ("Salvia nemorosa", None, False, False) in got
    assert [x for x in got if x[3]] == [("Tilia cordata", None, True, True)]


def test_addresses(spark):
    import hashlib

    h = hashlib.md5(b"A_b_(c).jpg").hexdigest()
    got = each(spark, [("A b (c).jpg",)], F.array(T.hashed_path("c0", "x/"), T.thumb_path("c0", "x", 120), T.with_width(T.cache_path("c0", F.lit(7), "y/image/cache/occurrence"), 0)))[0]
    assert got == [f"x/{h[0]}/{h[:2]}/A_b_(c).jpg", f"x/thumb/{h[0]}/{h[:2]}/A_b_(c).jpg/120px-A_b_(c).jpg", f"y/image/cache/occurrence/7/media/{hashlib.md5(b'A b (c).jpg').hexdigest()}"]
    with pytest.raises(ValueError, match="width"):
        T.thumb_path("c0", "x", 300)


def test_records_of_a_set_list(spark):
    from sheafwork.operators import layout

    lines = [
        "weiter ohne Anfang", "Laubgehölze", "Tilia", "- cordata, Winter-Linde", "  in Sorten (syn.", "  Tilia parvifolia), Steinlinde", "ZP - - 'Rancho', Kugel-Linde", "12", "2.1 Kleine Sorten", "verloren",
        "Tilia tomentosa 'Brabant'", "Silber-Linde bzw. Ungarische", "Garten bzw. Linde", "    platyphyllos, Sommer-Linde", "Güte", "- fest",
    ]
    rows = spark.createDataFrame([("d", i, x) for i, x in enumerate(lines)] + [("e", 1, "- eins"), ("e", 0, None)], "doc string, line int, t string")
    got = layout.list_records(rows, "doc", "line", "t", F.when(F.col("t") == "Laubgehölze", "Laub"), F.when(F.col("t") == "Tilia", F.col("t")), F.col("t").rlike("^\\d+$"), F.col("t") == "Güte")
    assert [tuple(r) for r in got.orderBy("doc", "line").collect()] == [
        ("d", 1, "section", "", 0, "Laub"), ("d", 2, "group", "", 0, "Tilia"), ("d", 3, "entry", "", 1, "cordata, Winter-Linde in Sorten (syn. Tilia parvifolia), Steinlinde"), ("d", 6, "entry", "ZP", 2, "'Rancho', Kugel-Linde"),
        ("d", 10, "entry", "", 1, "Tilia tomentosa 'Brabant' Silber-Linde bzw. Ungarische Garten bzw. Linde"), ("d", 13, "entry", "", 1, "platyphyllos, Sommer-Linde"), ("e", 1, "entry", "", 1, "eins"),
    ]
    assert layout.list_records(rows.limit(0), "doc", "line", "t", F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(False), F.lit(False)).count() == 0


def test_names_from_cells(spark):
    from sheafwork.operators import layout

    cases = [("Tilia", "cordata", "'Sorte'"), ("Tilia", "cordata", "'Rancho'"), ("Dahlia", "Sorte", "Riesen"), ("Pinus", "nigra", "subsp. laricio"), ("Rubus", "sect.", "Corylifolii"), ("Phlox", "", ""), ("Salvia", "nemorosa", "Joy"), (None, None, None)]
    want = [("Tilia cordata", "species"), ("Tilia cordata 'Rancho'", "cultivar"), ("Dahlia (Riesen)", "genus"), ("Pinus nigra subsp. laricio", "species"), ("Rubus sect. Corylifolii", "species"), ("Phlox", "genus"), ("Salvia nemorosa 'Joy'", "cultivar"), ("", "genus")]
    assert [tuple(x) for x in each(spark, cases, layout.assembled_name(F.col("c0"), F.col("c1"), F.col("c2")))] == want


def test_usages(spark):
    from sheafwork.sources import readers

    names = [("Linde ", "de"), ("linde", "de"), ("Lime", "en"), ("Linde", "en"), (" ", "de"), ("Tilleul", "fr")]
    rows = spark.createDataFrame([(7, "", names), (8, "Tilia", None)], "key long, scientificName string, vernacularNames array<struct<vernacularName:string,language:string>>")
    got = readers.species_rows(rows, ["de", "en"]).orderBy("taxonKey").collect()
    assert [tuple(n) for n in got[0]["vernacularNames"]] == [("Linde", "de"), ("Lime", "en"), ("Linde", "en")] and got[0]["scientificName"] is None and got[1]["scientificName"] == "Tilia" and got[1]["vernacularNames"] is None and got[0]["familyKey"] is None


def test_rows_of_constant_queries(spark):
    cases = {"Tilia cordata": ("Linde", True), "Tilia 'Rancho'": ("Tilia 'Rancho'", False), "Salvia": ("Salvia", False)}
    rows = [(label, botanical, None) for botanical, (label, _) in cases.items()]
    assert each(spark, rows, T.genuine_label("c0", "c1", "c2")) == [ok for _, ok in cases.values()]
    assert each(spark, [("Tilia cordata 'Rancho'", "Tilia cordata"), ("Tilia cordata 'Rancho'", "Tilia cordata 'Rancho'"), ("Tilia cordata 'Rancho'", None), ("Tilia", "Tilia cordata")], T.of_another("c0", "c1")) == [True, False, False, False]
    assert each(spark, [("http://creativecommons.org/licenses/by-nc/4.0/",), ("CC BY-SA 2.0",), ("https://creativecommons.org/publicdomain/zero/1.0/",), ("©",), (None,)], T.normal_licence("c0")) == ["cc-by-nc", "cc-by-sa", "cc-0", "©", None]
    assert each(spark, [("Datei (alt)",), ("(x)",), (None,)], T.without_suffix("c0")) == ["Datei", "", ""]
    assert each(spark, [("A-b C1",), (None,)], T.alnum_key("c0")) == ["abc1", ""]
