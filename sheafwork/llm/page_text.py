"""Main text of pages by a recurrent labeller: a bidirectional LSTM in numpy reads the blocks of a page in order and says of each whether it is of the article.

A block is the text between two tags that aren't inline, and what the labeller reads of it is the tag path (names, classes,
ids and roles, hashed), its words (hashed and counted) and a few measures. Pages carry no labels, so the labeller learns from
layouts: the blocks of a bounded sample of pages as they stand, where a page marks its article, and set anew in other
layouts, whose containers are drawn from the usual names of articles and of what stands around them.
"""

from __future__ import annotations

import functools
import html as entities
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import carry, free_name, release_memory

#: Bounds of training: pages in the sample, blocks of each (half from its start, half from its end), layouts that are learnt, passes over them.
PAGES, WINDOW, LAYOUTS, PASSES = 256, 240, 1024, 8
#: Hashed places of path elements and of words, units of the LSTM in each direction.
PATHS, WORDS, UNITS = 1024, 64, 16
#: Blocks that are labelled at a time, and characters of pages that are read at a time.
STEP, CHARS = 1 << 15, 1 << 22

INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in "script style template noscript iframe textarea title svg math object select".split()}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}}
SCOPES = set("html body ul ol dl table article section main aside nav header footer div form blockquote td th".split())
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+)>""")
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_PIECES = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Layouts to learn from: containers of articles, and of what isn't part of them.
ARTICLES = ["article", "main", "main article", "div.content", "div#main-content", "div.post", "section.entry-content", "div.article-body", "div.story", "div.page-content", "div.text", "div#main div.content", "section.main", "div.post-body", "div.entry", ""]
AROUND = [
    "nav ul li", "nav", "header", "header div", "footer", "footer p", "footer ul li", "aside", "aside p", "aside ul li", "div.menu ul li", "div#menu", "ul.nav li", "ul.navigation li", "div.sidebar", "div.sidebar ul li", "div#sidebar p",
    "div.cookie-notice", "div.cookies p", "div.notice", "div.banner p", "div.consent", "div.alert", "div.message-notice p", "div.ad", "div.ads p", "div.advert", "div.advertisement p", "div.sponsored", "div.promo p", "section.sponsor", "form", "form p", "form div", "form.search",
    "div.newsletter form p", "div.subscribe p", "div.comments div.comment p", "section.comments p", "section#comments article.comment p", "ol.comment-list li", "div.comment", "div.replies p", "div.related ul li", "div.recommended", "div.share ul li", "div.social", "div.breadcrumbs", "ul.breadcrumb li",
    "div.footer p", "div#footer", "div.header", "div#header p", "div.copyright", "div.disclaimer", "div.legal", "ul.pagination li", "div.login form", "div.popup p", "div.modal p", "div.widget ul li", "div.tags li", "button", "fieldset", "div.toolbar", "div.top-bar",
]
INSIDE = ["p", "p", "p", "p", "p", "p", "h2", "h3", "ul li", "ol li", "blockquote", "blockquote p", "pre", "table tr td", "dl dd", "figure figcaption", "div", "section p", "section h2"]
WRAPPERS = ["", "", "div.wrapper", "div.page", "div#container", "div.site div.row", "div.layout"]
_MARKED = {"article", "main"}
_OTHERS = {"nav", "header", "footer", "aside", "form", "ad", "ads", "advert", "advertisement", "sponsored", "promo", "menu", "sidebar", "cookie", "cookies", "notice", "banner", "comment", "comments", "button", "related", "share", "breadcrumb"}


def page_blocks(html: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters in links) of each block with text, in page order. A path has the open elements that aren't inline, with their names.

    Scripts, styles, comments and other markup give no text; an unclosed one goes to the end of the page. Elements that a
    new one ends (list items, cells, paragraphs) are closed; ends without a beginning are ignored. A break is white space.
    """
    out: list[tuple[tuple[str, ...], str, int]] = []
    open_: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links, in_link, at, size = 0, 0, 0, len(html)

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((tuple(x for _, names in open_ for x in names), text, min(links, len(text))))
            parts.clear()
        links = 0

    def put(text: str) -> None:
        nonlocal links
        text = entities.unescape(text) if "&" in text else text
        parts.append(text)
        links += len(text) if in_link else 0

    while at < size:
        start = html.find("<", at)
        if start != at:
            put(html[at:] if start < 0 else html[at:start])
            if start < 0:
                break
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if html[start + 1 : start + 2] in ("!", "?") or (html.startswith("</", start) and not html[start + 2 : start + 3].isalpha()):
            end = html.find(">", start)
            at = size if end < 0 else end + 1
            continue
        if not html[start + 1 : start + 2].isalpha() and html[start + 1 : start + 2] != "/":
            put("<")
            at = start + 1
            continue
        m = _TAG.match(html, start)
        if not m:  # it never ends
            break
        at, name = m.end(), m[2].lower()
        if name == "br":
            parts.append(" ")
        elif name in INLINE:
            if name == "a":
                in_link = 0 if m[1] else 1
        elif m[1]:
            flush()
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    del open_[i:]
                    break
        elif name in RAW:
            end = RAW[name].search(html, at)
            at = size if end is None else end.start()
        elif name in ("img", "wbr"):
            pass
        else:
            flush()
            if name in VOID:
                continue
            closes = SIBLINGS.get(name, {"p"})
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] in closes:
                    del open_[i:]
                    break
                if open_[i][0] in SCOPES:
                    break
            names = [x.lower() for g in _NAMES.findall(m[3]) for x in _PIECES.findall(" ".join(g))] if "=" in m[3] else []
            open_.append((name, (f"<{name}", *names)))
    flush()
    return out


@functools.lru_cache(1 << 16)
def _place(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % size


def _measures(text: str, n: int, links: int, k: int, of: int) -> tuple[float, ...]:
    size = len(text)
    return (1.0, np.log1p(size) / 6, np.log1p(n) / 5, links / size, (text[-1:] in ".!?…:;\"'”»") * 1.0, (text.count(",") + text.count(".")) / max(n, 1), sum(map(str.isdigit, text[:64])) / 64, k / max(of, 1))


MEASURES = 8


def _readings(blocks: list[tuple[tuple[str, ...], str, int]]) -> tuple[list[tuple[str, ...]], np.ndarray, np.ndarray]:
    """Paths, word counts (roots of shares) and measures of a page's blocks."""
    words, rows, measures = [], [], []
    for k, (_, text, links) in enumerate(blocks):
        own = text.split()
        words += [_place(w, WORDS) for w in own]
        rows += [k] * len(own)
        measures.append(_measures(text, len(own), links, k, len(blocks)))
    n = len(blocks)
    counts = np.bincount(np.array(rows, np.int64) * WORDS + np.array(words, np.int64), minlength=n * WORDS).reshape(n, WORDS).astype(np.float32)
    return [b[0] for b in blocks], np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)), np.array(measures, np.float32).reshape(n, MEASURES)


def _path_places(path: tuple[str, ...]) -> list[int]:
    """Each element by itself, and the innermost one again under its place."""
    last = max((i for i, x in enumerate(path) if x[0] == "<"), default=0)
    return sorted({_place(x, PATHS) for x in path} | {_place(f"last {x}", PATHS) for x in path[last:]})


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _forward(gates: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, list]:
    """States of one direction for gate inputs (pages, steps, 4 units)."""
    b, steps, wide = gates.shape
    units = wide // 4
    h, c = np.zeros((b, units), gates.dtype), np.zeros((b, units), gates.dtype)
    out, kept = np.empty((b, steps, units), gates.dtype), []
    for t in range(steps):
        z = gates[:, t] + h @ u
        s, g = _sigmoid(z[:, : 3 * units]), np.tanh(z[:, 3 * units :])
        c_before, h_before = c, h
        c = s[:, units : 2 * units] * c + s[:, :units] * g
        tc = np.tanh(c)
        h = s[:, 2 * units :] * tc
        out[:, t] = h
        kept.append((s, g, c_before, h_before, tc))
    return out, kept


def _backward(dout: np.ndarray, kept: list, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    b, steps, units = dout.shape
    dgates, du = np.empty((b, steps, 4 * units), dout.dtype), np.zeros_like(u)
    dh, dc = np.zeros((b, units), dout.dtype), np.zeros((b, units), dout.dtype)
    for t in range(steps - 1, -1, -1):
        s, g, c_before, h_before, tc = kept[t]
        i, f, o = s[:, :units], s[:, units : 2 * units], s[:, 2 * units :]
        dh = dh + dout[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        dgates[:, t] = dz
        du += h_before.T @ dz
        dh, dc = dz @ u.T, dc * f
    return dgates, du


def _turned(sizes: np.ndarray, steps: int) -> np.ndarray:
    """For each page the steps back to front, its padding in place."""
    t = np.arange(steps)
    return np.where(t < sizes[:, None], sizes[:, None] - 1 - t, t)


class Labeller:
    """The bidirectional LSTM; its parameters are plain arrays, so that it travels with a task."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        put = lambda *shape: (r.normal(size=shape) * 0.1).astype(np.float32)
        self.p = {"path": put(PATHS, 8 * UNITS), "words": put(WORDS, 8 * UNITS), "measures": put(MEASURES, 8 * UNITS), "u0": put(UNITS, 4 * UNITS), "u1": put(UNITS, 4 * UNITS), "out": put(2 * UNITS + 1)}
        self.seen: dict[tuple[str, ...], np.ndarray] = {}

    def __getstate__(self) -> dict:
        return {"p": self.p, "seen": {}}

    def _path(self, path: tuple[str, ...]) -> np.ndarray:
        found = self.seen.get(path)
        if found is None:
            if len(self.seen) > 4096:
                self.seen.clear()
            found = self.seen[path] = self.p["path"][_path_places(path)].sum(0)
        return found

    def _run(self, gates: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list]:
        """Scores (pages, steps) before the sigmoid, and what a backward pass needs."""
        turned = _turned(sizes, gates.shape[1])[:, :, None]
        wide = 4 * UNITS
        ahead, kept0 = _forward(gates[:, :, :wide], self.p["u0"])
        back, kept1 = _forward(np.take_along_axis(gates[:, :, wide:], turned, 1), self.p["u1"])
        states = np.concatenate([ahead, np.take_along_axis(back, turned, 1), np.ones((*gates.shape[:2], 1), gates.dtype)], 2)
        return states @ self.p["out"], [states, kept0, kept1, turned]

    def labels(self, pages: list[list[tuple[tuple[str, ...], str, int]]]) -> list[np.ndarray]:
        """For each page which of its blocks are of the article."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        group: list[int] = []

        def done() -> None:
            sizes = np.array([len(pages[i]) for i in group])
            gates = np.zeros((len(group), sizes.max(), 8 * UNITS), np.float32)
            for j, i in enumerate(group):
                paths, words, measures = _readings(pages[i])
                gates[j, : sizes[j]] = np.stack([self._path(x) for x in paths]) + words @ self.p["words"] + measures @ self.p["measures"]
            scores = self._run(gates, sizes)[0]
            for j, i in enumerate(group):
                out[i] = scores[j, : sizes[j]] >= 0
            group.clear()

        for i in sorted((i for i, x in enumerate(pages) if x), key=lambda i: len(pages[i])):
            if group and (len(group) + 1) * len(pages[i]) > STEP:
                done()
            group.append(i)
        if group:
            done()
        return out

    def learn(self, layouts: list[tuple[list[tuple[tuple[str, ...], str, int]], list[bool]]], passes: int = PASSES, size: int = 32, rate: float = 0.01, seed: int = 0) -> None:
        """Fits to blocks with labels by Adam; path elements are left out now and then, so that no single one decides."""
        r = np.random.default_rng(seed)
        read = [(*_readings(blocks), np.array(y, np.float32)) for blocks, y in layouts if blocks]
        read = [([np.array(_path_places(x)) for x in paths], w, m, y) for paths, w, m, y in read]
        first, second, step = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        # layouts of like length go together
        order = sorted(range(len(read)), key=lambda i: len(read[i][3]))
        groups = [order[i : i + size] for i in range(0, len(order), size)]
        for n in range(passes):
            for g in r.permutation(len(groups)):
                batch = [read[i] for i in groups[g]]
                sizes = np.array([len(y) for *_, y in batch])
                steps = sizes.max()
                at = np.concatenate([j * steps + np.arange(k) for j, k in enumerate(sizes)])
                kept = [x[r.random(len(x)) > 0.1] for paths, *_ in batch for x in paths]
                rows = np.repeat(np.arange(len(kept)), [len(x) for x in kept])
                ids = np.concatenate(kept).astype(np.int64)
                words, measures, y = (np.concatenate([b[k] for b in batch]) for k in (1, 2, 3))
                flat = words @ self.p["words"] + measures @ self.p["measures"]
                np.add.at(flat, rows, self.p["path"][ids])
                gates = np.zeros((len(batch) * steps, 8 * UNITS), np.float32)
                gates[at] = flat
                scores, (states, kept0, kept1, turned) = self._run(gates.reshape(len(batch), steps, -1), sizes)
                error = np.zeros(len(batch) * steps, np.float32)
                error[at] = (_sigmoid(scores.reshape(-1)[at]) - y) / len(at)
                error = error.reshape(len(batch), steps)
                grads = {"out": np.einsum("bt,btk->k", error, states)}
                dstates = error[:, :, None] * self.p["out"]
                d0, grads["u0"] = _backward(dstates[:, :, :UNITS], kept0, self.p["u0"])
                d1, grads["u1"] = _backward(np.take_along_axis(dstates[:, :, UNITS : 2 * UNITS], turned, 1), kept1, self.p["u1"])
                d = np.concatenate([d0, np.take_along_axis(d1, turned, 1)], 2).reshape(-1, 8 * UNITS)[at]
                grads["words"], grads["measures"], grads["path"] = words.T @ d, measures.T @ d, np.zeros_like(self.p["path"])
                np.add.at(grads["path"], ids, d[rows])
                step += 1
                pace = rate * (1 - n / passes)
                for k, v in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.999 * second[k] + 0.001 * v * v
                    self.p[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        self.seen.clear()


def _path(spec: str) -> tuple[str, ...]:
    """The path elements of a short form such as ``div.post p``."""
    out: list[str] = []
    for part in spec.split():
        name, *names = re.split(r"[.#]", part)
        out += [f"<{name}", *(x for y in names for x in re.split(r"[^a-z]", y))]
    return tuple(out)


def _marked(path: tuple[str, ...]) -> bool:
    names = {x.lstrip("<") for x in path}
    return bool(names & _MARKED) and not names & _OTHERS


def layouts(sample: list[list[tuple[tuple[str, ...], str, int]]], count: int = LAYOUTS, seed: int = 0) -> list[tuple[list[tuple[tuple[str, ...], str, int]], list[bool]]]:
    """Blocks with labels: pages of the sample that mark their article, as they are, and blocks of the sample set in other layouts."""
    r = np.random.default_rng(seed)
    pages = [(x, [_marked(p) for p, *_ in x]) for x in sample if x]
    if not pages:
        return []
    texts = [b for x, y in pages for b, own in zip(x, y) if own] or [b for x, _ in pages for b in x]
    rest = [b for x, y in pages for b, own in zip(x, y) if not own] or texts
    pick = lambda xs: xs[r.integers(len(xs))]
    out = []
    for i in range(count):
        blocks, y = pages[i % len(pages)]
        if i % 4 == 0 and any(y):
            out.append((blocks, y))
            continue
        base = _path("html body " + pick(WRAPPERS))
        holder = _path(pick(ARTICLES))

        def around(inside: tuple[str, ...] = ()) -> list:
            spec = _path(pick(AROUND))
            n = r.integers(1, 7) if spec[-1] in ("<li", "<p") else 1
            found = [pick(texts if r.random() < 0.4 else rest) for _ in range(n)]
            link = r.random() < (0.7 if spec[-1] == "<li" else 0.2)
            return [((base + inside + spec), t, len(t) if link else 0, False) for _, t, _ in found]

        rows = [b for _ in range(r.integers(0, 4)) for b in around()]
        if r.random() < 0.7:
            rows.append((base + holder + ("<h1",), pick(rest if r.random() < 0.5 else texts)[1][:80].strip() or "-", 0, True))
        for _ in range(r.integers(0, 16)):
            rows.append((base + holder + _path(pick(INSIDE)), pick(rest if r.random() < 0.15 else texts)[1], 0, True))
            if r.random() < 0.06:
                rows += around(holder)
        rows += [b for _ in range(r.integers(0, 4)) for b in around()]
        if rows:
            out.append(([x[:3] for x in rows], [x[3] for x in rows]))
    return out


def learn_labeller(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """A labeller from ``PAGES`` pages, chosen by a hash of their ids, and at most ``WINDOW`` blocks of each."""
    ids = pages.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct().orderBy(F.xxhash64("id"), "id").limit(PAGES)
    chosen = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).join(F.broadcast(ids), "id").groupBy("id").agg(F.min("html").alias("html"))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for html in batch.column(1):
                blocks = page_blocks(html.as_py() or "")
                found.append(blocks if len(blocks) <= WINDOW else blocks[: WINDOW // 2] + blocks[-WINDOW // 2 :])
            kind = pa.list_(pa.struct([("path", pa.list_(pa.string())), ("text", pa.string()), ("links", pa.int64())]))
            rows = [[{"path": list(p), "text": t[:2000], "links": min(n, 2000)} for p, t, n in x] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["id", "blocks"])

    schema = StructType([chosen.schema["id"]])
    rows = chosen.mapInArrow(read, f"{schema.simpleString()[7:-1].replace(':', ' ')}, blocks array<struct<path: array<string>, text: string, links: bigint>>").collect()
    sample = [[(tuple(b["path"]), b["text"], b["links"]) for b in r["blocks"]] for r in sorted(rows, key=lambda r: r["id"])]
    out = Labeller()
    found = layouts(sample)
    if found:
        out.learn(found)
    return out


def main_text(pages: DataFrame, labeller: Labeller, html_col: str = "html", keep: list[str] | None = None, out: tuple[str, str] = ("text", "n_chars")) -> DataFrame:
    """The kept columns of each page with its main text and the number of its code points.

    White space inside a block is one blank, blocks are joined by an empty line. A null or empty page, and one without an
    article, has an empty text; rows repeated stay; pages are read whole. No page meets another, so no row moves.
    """
    keep = keep or [c for c in pages.columns if c != html_col]
    carried, kept, at = carry(pages, keep, html_col)
    names = [free_name(keep, c) for c in out]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            group: list[list] = []
            size = 0

            def done() -> None:
                for blocks, own in zip(group, labeller.labels(group)):
                    texts.append("\n\n".join(t for (_, t, _), yes in zip(blocks, own) if yes))
                group.clear()

            for html in batch.column(at):
                page = html.as_py() or ""
                group.append(page_blocks(page))
                size += len(page)
                if size > CHARS:
                    done()
                    size = 0
            done()
            counts = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string()), counts], names=[*kept.names, *names])
        release_memory()

    return carried.mapInArrow(run, StructType([*kept.fields, StructField(names[0], StringType()), StructField(names[1], LongType())]))
