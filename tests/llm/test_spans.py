import random

from sheafwork.llm import spans as S

PASSAGE = " ".join(f"passage word {i} goes on here and there again." for i in range(9))


def plain_sentences(text):
    """A sentence is characters that are no stops, then stops and line ends, then white space; letter by letter."""
    out, now, state = [], "", "text"
    for c in text:
        kind = "stop" if c in ".!?\n" else "blank" if c.isspace() else "other"
        ends = state == "stop" and kind == "other" or state == "gap" and kind != "blank"
        if state == "gap" and c == "\n":  # white space behind a stop, a line end among it
            ends = False
        if ends:
            out.append(now)
            now, state = "", "text"
        now += c
        if kind == "stop" and state != "gap":
            state = "stop"
        elif kind == "blank" and state == "stop":
            state = "gap"
    return out + [now] if now else out


def plain_spans(sentences):
    """All (first, last) that are enough and would not be without their first or their last sentence."""
    size = [len(s.split()) for s in sentences]
    enough = lambda a, b: sum(size[a : b + 1]) >= S.MANY_WORDS or sum(size[a : b + 1]) >= S.WORDS and b - a + 1 >= S.SENTENCES
    n = range(len(size))
    return [(a, b) for a in n for b in n[a:] if enough(a, b) and (not enough(a, b - 1) or not enough(a + 1, b))]


def plain(rows):
    key = lambda r: (r[0] is not None, r[0] or 0)
    distinct = sorted({(r[0], r[1]) for r in rows if r[1]}, key=key)
    assert len({k for k, _ in distinct}) == len(distinct)  # one text an id, so that hashes of texts don't order anything
    seen, out = set(), {}
    for r in distinct:
        sentences, gone = plain_sentences(r[1]), set()
        for a, b in plain_spans(sentences):
            h = "\n".join(" ".join(s.lower().split()) for s in sentences[a : b + 1])
            gone |= set(range(a, b + 1)) if h in seen else set()
            seen.add(h)
        out[r] = "".join(s for i, s in enumerate(sentences) if i not in gone)
    return {r: out.get(r, r[1]) for r in {(x[0], x[1]) for x in rows}}


def test_same_as_brute_force(spark):
    rows = [(i, f"Own start of text {i} with some words. {PASSAGE} Own end {i}. More of it {i}!", "x") for i in range(30)]
    rows += [(100, None, "x"), (101, "", "x"), (102, "Short one.", "x"), (103, "Short one.", "x"), (104, PASSAGE + "\n" + PASSAGE, "x"), (105, "no stop " * 3000, "x"), (106, "no stop " * 3000, "x"), (None, PASSAGE + " tail.", "x"), (3, rows[3][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, first string").repartition(4)
    got = S.remove_repeats(docs)
    assert got.columns == docs.columns
    want = plain(rows)
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(((r[0], want[(r[0], r[1])]) for r in rows), key=str)
    left = [r["text"] for r in got.collect() if r["text"]]
    assert sum("passage word 4 goes" in t for t in left) == 1  # the row without an id comes first
    assert S.remove_repeats(docs.limit(0)).count() == 0


def test_sentences_make_the_text_again():
    for text in ("a. b! c?\n\nd", "...", "\n", "", "one", " x .y"):
        assert "".join(S.SENTENCE.findall(text)) == text
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice("ab.!?\n  \t") for _ in range(rng.randrange(30)))
        assert S.SENTENCE.findall(text) == plain_sentences(text), repr(text)


def test_names_of_other_columns(spark):
    docs = spark.createDataFrame([(1, PASSAGE, 1, (2, "x")), (2, PASSAGE, None, None)], "`doc id` long, `a text` string, `my col` int, s struct<`b c`:int,`row`:string>")
    got = S.remove_repeats(docs, id_col="doc id", text_col="a text", counts=True)
    assert got.columns == [*docs.columns, "n_sentences", "n_removed"]
    assert {r["doc id"]: (r["a text"], r["my col"], r["n_removed"]) for r in got.collect()} == {1: (PASSAGE, 1, 0), 2: ("", None, 9)}


def sized(sizes, word):
    return " ".join(" ".join(f"{word}{i}x{k}" for k in range(n)) + "." for i, n in enumerate(sizes))


def test_spans_are_the_shortest_from_and_to_each_sentence():
    rng = random.Random(11)
    for _ in range(200):
        sizes = [rng.choice((1, 3, 8, 14, 20, 38, 41, 58)) for _ in range(rng.randrange(12))]
        enough = lambda a, b: sum(sizes[a : b + 1]) >= S.MANY_WORDS or sum(sizes[a : b + 1]) >= S.WORDS and b - a + 1 >= S.SENTENCES  # noqa: B023, E731
        n = range(len(sizes))
        want = {(a, b) for a in n for b in n if a <= b and enough(a, b) and (not enough(a, b - 1) or not enough(a + 1, b))}
        got = [(a, b) for a, b, _ in S.spans(sized(sizes, "w"))]
        assert sorted(got) == sorted(want)


def test_ends_of_a_repeated_passage(spark):
    rows = []
    for i, sizes in enumerate(([41, 38], [18, 14, 58, 9, 17])):
        passage = sized(sizes, f"p{i}q")
        rows += [(2 * i, f"Own start. {passage} Own end {i}."), (2 * i + 1, f"Another start. {passage} Another end {i}.")]
    got = {r["doc_id"]: r["text"].split() for r in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: len(v) for k, v in got.items()} == {0: 84, 1: 5, 2: 121, 3: 5}
