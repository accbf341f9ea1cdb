"""Toxicity by a subsequence string kernel and a support vector machine over Nyström landmarks.

Words are compared by their shared subsequences of three characters, which may have gaps; each counts with a weight that
falls slowly with the length it spans. An insult with a character put in, left out or an ending added has a similarity of
0.6 to 0.8 with the plain one, other words mostly under 0.4. The machine has the sum of two kernels: a wide one takes a
similarity by a curve that rises between (``MIDDLE``, ``STEEP``), so that altered insults count nearly as plain ones; a
narrow one (``SHARP``) counts the word itself, for insults that innocent words are like, and which of the two a landmark
goes by is learnt. Words of one or two characters have no such subsequence and are similar to nothing. A chunk with signs inside ('id!ot', 'i-d-i-o-t', 'idiot.Go') counts as it stands,
without the signs, and by the parts between them. A sentence is compared to a landmark word by the sum over its words of
the kernel; projecting on the landmarks' kernel matrix (Nyström) gives the features of a linear machine. It
is trained on sentences: of a toxic document the run of sentences that the machine itself finds worst counts as toxic; of
other documents that run and the worst single sentence count as clean. A document scores as its worst run of different
sentences does, where each word costs a little (``COST``), and at least as a document without words.

Landmarks are words that, by themselves or by how they begin, stand in toxic documents far more often than chance among
so many words allows, however rare their language is, and clean words that are like them and frequent. After a first fit,
landmarks of a beginning without which the sample is told apart as well are given up, and the machine is fitted again.

The fit uses a bounded sample of labelled documents (``SAMPLE`` of each class, chosen by a hash of the id, and of each the
``ROWS`` sentences most like the landmarks). Executors count its words and compare its sentences; the driver gets marks,
landmarks and sentence vectors, never texts. Scoring reads every text whole. As the decision is linear in the landmarks,
each distinct word has one weight; the fit's decisions are sums of the same weights.

Defined cases: null and empty texts score as a document without words; without labels of both classes every score is 0;
rows without an id or label are not learnt from; repeated rows are each scored; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t

from .common import carry, release_memory, written

#: Labelled documents of the toxic and of the clean class in the fit, about.
SAMPLE = (1200, 3600)
#: Sentences of a sampled document that the fit uses at most.
ROWS = 16
#: Landmarks of toxic and of clean words at most; words for each beginning that marks toxic documents.
LANDMARKS, FOR_EACH = (128, 40), 12
#: What a word takes from a run's decision, so that runs end where insults become rare.
COST = 0.004
#: Lengths of words' beginnings that are looked at.
BEGINNINGS = (4, 5, 6)
#: Marks that the driver looks at, the strongest ones.
MARKS = 4096
#: The subsequences: weight of each character spanned, longest span.
DECAY, SPAN = 0.8, 7
#: The wide kernel's curve: the similarity that counts half, its steepness, and values that count as 0, which those of other
#: words are; and the narrow kernel's power and share, under 1 so that landmarks go by the wide one where both tell as much.
MIDDLE, STEEP, NOTHING, SHARP, NARROW = 0.56, 14, 0.02, 16, 0.35
#: The similarity where the curve reaches ``NOTHING``.
LEAST = MIDDLE * (NOTHING / (1 + MIDDLE**STEEP - NOTHING)) ** (1 / STEEP)
#: What giving up a beginning's landmarks may add to the sample's error.
GIVEN_UP = 0.004
#: Bundles of landmarks that have a bound each.
BUNDLES = 16
#: Words up to so many characters are compared together, by length; longer ones one by one, by the same kernel.
LONGEST = 24
#: Texts that are split into words at once, and chunks without weight that a worker remembers.
SLICE, REMEMBERED = 200, 200_000
_CLASSES = 64
_SIGNS = ".,;:!?\"'()[]{}|<>*_-…«»„“”#&%$~^+=/\\@`"
_INNER = re.compile(r"[\W_]+")
#: What a chunk that ends a sentence ends with.
_END, _ENDS = re.compile(r"[.!?][\"')\]}»”“]*$"), frozenset(".!?\"')]}»”“")
#: Digits and signs that stand for letters.
_LOOKALIKE = dict(zip("013457@$!", "oieastasi"))


def _char_class(c: str) -> int:
    c = _LOOKALIKE.get(c, c)
    return ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % (_CLASSES - 27)


def clean(chunk: str) -> str:
    """A chunk without signs at its ends, lower case; empty if no subsequence of three is left."""
    word = chunk.lower().strip(_SIGNS)
    return word if len(word) > 2 else ""


def kernels(similarity: np.ndarray) -> np.ndarray:
    """The wide and, in as many columns behind, the narrow kernel's values of similarities; both 1 for 1, and 0 where the wide one is under ``NOTHING``."""
    x = similarity**STEEP
    wide = x * (1 + MIDDLE**STEEP) / (x + MIDDLE**STEEP)
    return np.where(np.hstack([wide, wide]) >= NOTHING, np.hstack([wide, NARROW * similarity**SHARP]), 0.0)


def readings(chunk: str) -> list[str]:
    """The words that a chunk counts as: itself and, with signs inside, what they leave when taken out and the parts between them."""
    word = clean(chunk)
    if word.isalnum() or not word:
        return [word] if word else []
    parts = _INNER.split(word)
    return [word] if len(parts) == 1 else [w for w in dict.fromkeys([word, "".join(parts), *map(clean, parts)]) if len(w) > 2]


def spelled(chunks: list[str]) -> list[str]:
    """Words whose letters stand one by one, three or more."""
    if list(map(len, chunks)).count(1) < 2:
        return []
    found, run = [], []
    for c in [*chunks, ""]:
        letter = c if len(c) == 1 else c.strip(_SIGNS) if len(c) < 8 else ""
        if len(letter) == 1 and letter.isalnum():
            run.append(letter)
            continue
        if len(run) > 2:
            found.append("".join(run).lower())
        run = []
    return found


def cut(text: str) -> list[tuple[str, ...]]:
    """The text's different sentences as chunks; a sentence ends at stops before white space and at line ends."""
    found = []
    for line in text.split("\n"):
        chunks, start = line.split(), 0
        for i, c in enumerate(chunks, 1):
            if c[-1] in _ENDS and _END.search(c):
                found.append(tuple(chunks[start:i]))
                start = i
        if start < len(chunks):
            found.append(tuple(chunks[start:]))
    return list(dict.fromkeys(found))


def words_of(chunks: Iterable[str]) -> list[str]:
    """A sentence's different words."""
    return list(dict.fromkeys([w for c in chunks for w in readings(c)] + spelled(list(chunks))))


class _Classes(dict):
    def __missing__(self, c: str) -> int:
        self[c] = found = _char_class(c)
        return found


_CLASS = _Classes()


def _by_size(words: list[str], longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the words of one length and their characters' classes, a column for each place."""
    sizes: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        sizes.setdefault(len(w), []).append(i)
    get = _CLASS.__getitem__
    for size, at in sizes.items():
        if 2 < size <= longest:
            chars = np.fromiter(map(get, "".join([words[i] for i in at])), np.int32, size * len(at))
            yield np.array(at), chars.reshape(len(at), size).T.copy()


#: Characters of a long word whose subsequences are counted at once.
_STRETCH = 1 << 16


def _long(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and weights of a long word's subsequences, in stretches, so that memory doesn't grow with the word."""
    codes, weights = np.empty(0, np.int64), np.empty(0)
    for first in range(0, len(word) - 2, _STRETCH):
        part = word[first : first + _STRETCH + SPAN - 1]
        c = np.fromiter(map(_CLASS.__getitem__, part), np.int64, len(part))
        for k in range(2, SPAN):
            n = min(len(c) - k, _STRETCH)  # subsequences that begin in this stretch
            if n <= 0:
                break
            for j in range(1, k):
                new = (c[:n] * _CLASSES + c[j : j + n]) * _CLASSES + c[k : k + n]
                codes, weights = np.append(codes, new), np.append(weights, np.full(n, DECAY ** (k + 1)))
        codes, back = np.unique(codes, return_inverse=True)
        weights = np.bincount(back, weights, len(codes))
    return codes, weights


@lru_cache(maxsize=None)
def _triples(size: int) -> list[tuple[int, int, int]]:
    return [(i, j, k) for i in range(size - 2) for k in range(i + 2, min(size, i + SPAN)) for j in range(i + 1, k)]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, subsequence code, weight), summed over a word's equal subsequences; by word number."""
    rows, codes, weights = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    for at, chars in _by_size(words):
        for i, j, k in _triples(len(chars)):
            rows.append(at)
            codes.append((chars[i] * _CLASSES + chars[j]) * _CLASSES + chars[k])
            weights.append(np.full(len(at), DECAY ** (k - i + 1)))
    for i, w in enumerate(words):
        if len(w) > LONGEST:
            found, held = _long(w)
            rows.append(np.full(len(found), i))
            codes.append(found)
            weights.append(held)
    row, code, weight = np.concatenate(rows), np.concatenate(codes), np.concatenate(weights)
    key, back = np.unique(row * _CLASSES**3 + code, return_inverse=True)
    return key // _CLASSES**3, key % _CLASSES**3, np.bincount(back, weight, len(key))


@dataclass
class Landmarks:
    """Landmark words as a table from subsequence to their normalised weights."""

    words: list[str]
    row_of: np.ndarray = field(init=False, repr=False)
    table: np.ndarray = field(init=False, repr=False)
    most: np.ndarray = field(init=False, repr=False)

    def __post_init__(self) -> None:
        row, code, weight = subsequences(self.words)
        norm = np.sqrt(np.bincount(row, weight**2, len(self.words)))
        codes, at = np.unique(code, return_inverse=True)
        self.row_of = np.zeros(_CLASSES**3, np.int32)
        self.row_of[codes] = np.arange(1, len(codes) + 1)
        self.table = np.zeros((len(codes) + 1, len(self.words)), np.float32)
        self.table[at + 1, row] = weight / norm[row]
        # landmarks of one beginning are neighbours by the alphabet, so few of a bundle's bounds are far above its members
        bundles = [b for b in np.array_split(np.argsort(self.words), BUNDLES) if len(b)]
        self.most = np.stack([self.table[:, b].max(1) for b in bundles], 1)[self.row_of]

    def _near(self, words: list[str]) -> np.ndarray:
        """Words that may be similar to a landmark. The bound is safe: to a landmark of a bundle, a subsequence adds at most its
        weight times the most that any of the bundle gives it, and a word's norm is least when its subsequences all differ."""
        found = [np.array([i for i, w in enumerate(words) if len(w) > LONGEST], np.int64)]
        for at, chars in _by_size(words):
            bound, own = np.zeros((len(at), self.most.shape[1]), np.float32), 0.0
            first = second = -1
            for i, j, k in _triples(len(chars)):
                if (i, j) != (first, second):
                    pair, first, second = (chars[i] * _CLASSES + chars[j]) * _CLASSES, i, j
                weight = DECAY ** (k - i + 1)
                own += weight * weight
                bound += np.float32(weight) * self.most[pair + chars[k]]
            found.append(at[bound.max(1) >= (LEAST - 1e-4) * math.sqrt(own)])
        return np.sort(np.concatenate(found))

    def similar(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that are similar to a landmark, and their similarities to all; 0 where it is under LEAST."""
        near = self._near(words)
        found, values = [np.empty(0, np.int64)], [np.empty((0, len(self.words)))]
        for first in range(0, len(near), 2_000):
            some = near[first : first + 2_000]
            row, code, weight = subsequences([words[i] for i in some])
            norm = np.sqrt(np.bincount(row, weight**2, len(some)))
            hit = self.row_of[code]
            row, weight, hit = row[hit > 0], weight[hit > 0], hit[hit > 0]
            if not len(row):
                continue
            at, starts = np.unique(row, return_index=True)  # row ascends
            out = np.add.reduceat(self.table[hit] * weight[:, None].astype(np.float32), starts) / norm[at, None]
            kept = (out >= LEAST).any(1)
            found.append(some[at[kept]])
            values.append(np.where(out[kept] >= LEAST, out[kept], 0.0))
        return np.concatenate(found), np.concatenate(values)

    def kernel(self, words: list[str]) -> np.ndarray:
        """Both kernels of the words with each landmark."""
        out = np.zeros((len(words), 2 * len(self.words)))
        at, values = self.similar(words)
        out[at] = kernels(values)
        return out


@dataclass
class Machine:
    """What scoring needs: landmarks, their weights, and the scale of the decision."""

    landmarks: Landmarks | None = None
    weights: np.ndarray | None = None
    middle: float = 0.0
    slope: float = 1.0

    def word_weights(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words))
        for first in range(0, len(words), 10_000):
            at, values = self.landmarks.similar(words[first : first + 10_000])
            out[first + at] = kernels(values) @ self.weights
        return out

    def probability(self, decision: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * (decision - self.middle)))))


def _squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, offset: np.ndarray, ridge: float = 3e-3) -> np.ndarray:
    """A linear machine with squared hinge loss by Newton steps on the rows inside the margin; the last column is constant.
    ``offset`` is added to each row's decision."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        inside = y * (x @ w + offset) < 1
        xs = x[inside] * cost[inside, None]
        new = np.linalg.solve(x[inside].T @ xs + ridge * len(y) * np.eye(len(w)), xs.T @ (y - offset)[inside])
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w


def worst_run(values: Iterable[float], words: Iterable[int], before: Iterable[int]) -> tuple[float, int, int]:
    """The largest sum over consecutive sentences, less ``COST`` for each of their words, and those sentences; 0 and none where
    all sums are under 0. ``before`` are words of sentences between that have no value."""
    best, first, last, now, start = 0.0, 0, 0, 0.0, 0
    for i, (v, n, gap) in enumerate(zip(values, words, before)):
        now -= COST * gap
        if now <= 0:
            now, start = 0.0, i
        now += v - COST * n
        if now > best:
            best, first, last = now, start, i + 1
    return best, first, last


def _product(x: np.ndarray, weights: np.ndarray, step: int = 4096) -> np.ndarray:
    """x @ weights in double precision, without a copy of all of x in it."""
    return np.concatenate([np.zeros(0), *[x[i : i + step].astype(float) @ weights for i in range(0, len(x), step)]])


def fit(marks: Landmarks, n_toxic: int, owner: np.ndarray, x: np.ndarray, words: np.ndarray, before: np.ndarray, labels: np.ndarray) -> Machine:
    """A machine from sentence rows ``x`` with their numbers of words, each of a document in ``owner`` (ascending; each has a row, 0 for no words),
    and the documents' labels. The first ``n_toxic`` landmarks are those of toxic words."""
    project = np.zeros((2 * len(marks.words), 0))
    for k, own in enumerate(np.split(marks.kernel(marks.words), 2, axis=1)):
        values, vectors = np.linalg.eigh((own + own.T) / 2)
        kept = values > 1e-6 * values.max()
        part = np.zeros((2 * len(marks.words), int(kept.sum())))
        part[k * len(marks.words) : (k + 1) * len(marks.words)] = vectors[:, kept] / np.sqrt(values[kept])
        project = np.hstack([project, part])
    starts = np.searchsorted(owner, np.arange(len(labels)))
    ends = np.append(starts[1:], len(x))
    upto, upto_before = (np.concatenate(([0], np.cumsum(v))) for v in (words, before))
    clean_docs = np.nonzero(labels == 0)[0]
    weights = np.tile(np.arange(len(marks.words)) < n_toxic, 2) / 2

    def row(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of runs of rows, and what their words cost."""
        inner = np.where(b > a, upto_before[b] - upto_before[np.minimum(a + 1, len(before))], 0)
        sums = np.array([x[i:j].sum(0, dtype=float) for i, j in zip(a, b)])
        return np.hstack([sums @ project, np.ones((len(a), 1))]), -COST * (upto[b] - upto[a] + inner)

    for _ in range(5):
        value = _product(x, weights)
        at = np.array([worst_run(value[a:b].tolist(), words[a:b].tolist(), before[a:b].tolist())[1:] for a, b in zip(starts, ends)]) + starts[:, None]
        single = np.array([starts[i] + value[starts[i] : ends[i]].argmax() for i in clean_docs])
        z, offset = row(np.append(at[:, 0], single), np.append(at[:, 1], single + 1))
        y = np.append(np.where(labels == 1, 1.0, -1.0), -np.ones(len(single)))
        share = np.append(np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.3 / len(clean_docs)), np.full(len(single), 0.2 / len(clean_docs)))
        weights = project @ _squared_hinge(z, y, share * len(y), offset)[:-1]
    value = _product(x, weights)
    decision = np.array([worst_run(value[a:b].tolist(), words[a:b].tolist(), before[a:b].tolist())[0] for a, b in zip(starts, ends)])
    a, b = np.sort(decision[labels == 1]), np.sort(decision[labels == 0])
    cuts = np.unique(decision)
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts + 1
    wrong = np.searchsorted(a, cuts) / len(a) + 3 * (1 - np.searchsorted(b, cuts) / len(b))  # a clean document rejected weighs more
    best = np.nonzero(wrong <= wrong.min() + 1e-12)[0]
    middle = float(cuts[best[len(best) // 2]])
    return Machine(marks, weights, middle, 4 / max(1e-6, float(np.median(a)) - middle))


def needed(machine: Machine, n_toxic: int, owner: np.ndarray, x: np.ndarray, words: np.ndarray, before: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Which landmarks stay. Landmarks of one beginning go together, the lightest first, where without them no more of the sample's
    documents are on the wrong side of the machine's best threshold; those of clean words stay where a toxic one is like them."""
    names, weights = machine.landmarks.words, machine.weights.copy()
    starts = np.searchsorted(owner, np.arange(len(labels)))
    ends = np.append(starts[1:], len(x))

    def wrong(w: np.ndarray) -> float:
        value = _product(x, w)
        decision = np.array([worst_run(value[a:b].tolist(), words[a:b].tolist(), before[a:b].tolist())[0] for a, b in zip(starts, ends)])
        a, b = np.sort(decision[labels == 1]), np.sort(decision[labels == 0])
        cuts = np.append(np.unique(decision), np.inf)
        return float((np.searchsorted(a, cuts) / len(a) + 3 * (1 - np.searchsorted(b, cuts) / len(b))).min())

    stems: dict[str, list[int]] = {}
    for i in range(n_toxic):
        stems.setdefault(names[i][: BEGINNINGS[0]], []).append(i)
    kept, least = np.ones(len(names), bool), wrong(weights)
    for mine in sorted(stems.values(), key=lambda g: float((weights[g] + weights[[i + len(names) for i in g]]).max())):
        tried = weights.copy()
        tried[mine] = tried[[i + len(names) for i in mine]] = 0
        now = wrong(tried)
        if now <= least + GIVEN_UP and kept[:n_toxic].sum() > len(mine):
            weights, kept[mine] = tried, False
            least = min(least, now)
    if kept[:n_toxic].any():
        near = Landmarks([names[i] for i in np.nonzero(kept[:n_toxic])[0]])
        alike = set(near.similar([names[i] for i in range(n_toxic, len(names))])[0].tolist())
        for i in range(n_toxic, len(names)):
            kept[i] = i - n_toxic in alike
    return kept


def _sampled(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str, text_col: str, label_col: str, sample: tuple[int, int]) -> DataFrame | None:
    """(y, h, text) of about ``sample`` different labelled texts of the toxic and of the clean class."""
    marks = labels.where(allowed & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("y"))
    sizes = {r[0]: r[1] for r in marks.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col("y") == 1, min(1.0, sample[0] / sizes[1])).otherwise(min(1.0, sample[1] / sizes[0]))
    chosen = marks.where(F.pmod(F.xxhash64(F.col("__id"), F.lit("toxic")), F.lit(1 << 30)) < share * (1 << 30))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "__id").where(F.col("text").isNotNull())
    return rows.select("y", F.xxhash64("text").alias("h"), "text").dropDuplicates(["y", "h"])  # copies are no further evidence


def _mark_counts(sample: DataFrame) -> DataFrame:
    """(mark, toxic, clean): in how many documents of each class a word stands, or one that begins so (``^`` and the beginning)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = Counter(), Counter()

        def block() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([counts[y][m] for m in names], pa.int64()) for y in (1, 0)]], names=["mark", "toxic", "clean"])
            counts[0].clear()
            counts[1].clear()
            return out

        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = {w for s in cut(text.as_py()) for w in words_of(s) if len(w) <= LONGEST}  # longer ones make no landmarks
                counts[y].update(words)
                counts[y].update({"^" + w[:k] for w in words for k in BEGINNINGS if len(w) >= k})
                if len(counts[0]) + len(counts[1]) > 150_000:
                    yield block()
        yield block()
        release_memory()

    found = sample.select("y", "text").mapInArrow(run, "mark string, toxic bigint, clean bigint")
    return found.groupBy("mark").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _pick_landmarks(counts: DataFrame, n_toxic: int, n_clean: int) -> tuple[list[str], int]:
    """Landmarks, and how many of them are toxic. ``strength`` is the likelihood ratio of a mark's share in toxic documents."""
    base = n_toxic / (n_toxic + n_clean)
    a, b = F.col("toxic"), F.col("clean")
    n = a + b
    strength = a * F.log(a / (n * base)) + F.when(b > 0, b * F.log(b / (n * (1 - base)))).otherwise(0.0)
    strong = counts.where((a > 0) & (a > n * base)).select("mark", strength.alias("g"), F.length("mark").alias("size")).where("g > 0")
    rows = strong.orderBy(F.desc("g"), F.desc("size"), "mark").limit(MARKS).collect()
    if not rows:
        return [], 0
    least = min(math.log(max(2, counts.count())), rows[0]["g"] / 2)  # fewer than one mark by chance
    stems: list[str] = []
    words: list[str] = []
    for r in rows:
        mark = r["mark"].removeprefix("^")
        if r["g"] >= least and len(mark) > 2 and not any(mark.startswith(s) or s.startswith(mark) for s in stems) and len(stems) < LANDMARKS[0]:
            stems.append(mark)
            words.append(mark)
    keyed = [counts.where(~F.startswith("mark", F.lit("^")) & (F.col("toxic") > F.col("clean"))).select("mark", "toxic", F.substring("mark", 1, k).alias("stem")).where(F.col("stem").isin([s for s in stems if len(s) == k] or [""])) for k in BEGINNINGS]
    order = Window.partitionBy("stem").orderBy(F.desc("toxic"), "mark")
    likely = keyed[0].unionByName(keyed[1]).unionByName(keyed[2]).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= 3 * FOR_EACH)
    by_stem: dict[str, list[str]] = {}
    for r in likely.orderBy("stem", "nth").collect():
        by_stem.setdefault(r["stem"], []).append(r["mark"])
    for s in stems:
        mine = [s]
        for w in by_stem.get(s, []):
            if len(mine) <= FOR_EACH and Landmarks(mine).similar([w])[1].max(initial=0) < 0.8:
                mine.append(w)
        words += mine[1:]
    words = list(dict.fromkeys(words))[: LANDMARKS[0]]
    marks = Landmarks(words)

    def alike(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, often = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            at, values = marks.similar(found)
            near = values.max(1, initial=0) ** 2 * np.log1p(often[at])
            yield pa.RecordBatch.from_arrays([pa.array([found[i] for i in at], pa.string()), pa.array(near)], names=["word", "near"])

    harmless = counts.where(~F.startswith("mark", F.lit("^")) & (b > 0) & (a <= n * base)).select("mark", "clean").mapInArrow(alike, "word string, near double")
    return words + [r["word"] for r in harmless.orderBy(F.desc("near"), "word").limit(LANDMARKS[1]).collect()], len(words)


def _sentence_rows(sample: DataFrame, marks: Landmarks) -> DataFrame:
    """(y, h, at, values, sizes, words, before): of each document the sentences that are like a landmark, ROWS at most, as the columns
    that aren't 0, their values, and how many each sentence has; the first sentence is that of no words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            out: tuple[list, ...] = [], [], [], [], []
            documents = [cut(text.as_py()) for text in batch.column(2)]
            words = list({w for chunks in documents for s in chunks for w in words_of(s)})
            row_of: dict[str, np.ndarray] = {}
            for first in range(0, len(words), 5_000):
                at, values = marks.similar(words[first : first + 5_000])
                row_of.update({words[first + i]: v for i, v in zip(at, kernels(values).astype(np.float32))})
            for chunks in documents:
                found = [(i, [row_of[w] for w in words_of(s) if w in row_of]) for i, s in enumerate(chunks)]
                rows = [(i, np.sum(some, 0)) for i, some in found if some]
                rows = sorted(sorted(rows, key=lambda r: -float(r[1].sum()))[: ROWS - 1], key=lambda r: r[0])
                upto = [0, *accumulate(map(len, chunks))]
                places = [i for i, _ in rows]
                found_at = [np.nonzero(v)[0] for _, v in rows]
                out[0].append(b"".join([at.astype(np.uint16).tobytes() for at in found_at]))
                out[1].append(b"".join([v[at].astype(np.float32).tobytes() for (_, v), at in zip(rows, found_at)]))
                out[2].append([0, *map(len, found_at)])
                out[3].append([0, *[len(chunks[i]) for i in places]])
                out[4].append([0, *[upto[i] - (upto[last + 1] if last >= 0 else 0) for last, i in zip([-1, *places], places)]])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(o, pa.binary()) for o in out[:2]], *[pa.array(o, pa.list_(pa.int64())) for o in out[2:]]], names=["y", "h", "at", "values", "sizes", "words", "before"])
        release_memory()

    return sample.mapInArrow(run, "y int, h bigint, at binary, values binary, sizes array<bigint>, words array<bigint>, before array<bigint>")


def learn_toxicity(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: tuple[int, int] = SAMPLE) -> Machine:
    """Fits on about ``sample`` toxic and clean documents among those ``allowed`` by a condition on the id."""
    found = _sampled(docs, labels, allowed, id_col, text_col, label_col, sample)
    if found is None:
        return Machine()
    rows = written(found, "toxic-sample")
    sizes = {r[0]: r[1] for r in rows.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return Machine()
    words, n_toxic = _pick_landmarks(written(_mark_counts(rows), "toxic-marks"), sizes[1], sizes[0])
    if not words:
        return Machine()
    marks = Landmarks(words)
    held = sorted(_sentence_rows(rows, marks).collect(), key=lambda r: (r["h"], r["y"]))
    owner = np.repeat(np.arange(len(held)), [len(r["sizes"]) for r in held])
    sizes, gaps = (np.array([n for r in held for n in r[c]], np.int64) for c in ("words", "before"))
    labelled = np.array([r["y"] for r in held])
    row = np.repeat(np.arange(len(owner)), [n for r in held for n in r["sizes"]])
    column = np.concatenate([np.frombuffer(r["at"], np.uint16) for r in held]).astype(np.int64)
    value = np.concatenate([np.frombuffer(r["values"], np.float32) for r in held])
    del held

    def dense(kept: np.ndarray) -> np.ndarray:
        """The sentences' vectors over the kept columns."""
        place, own = np.cumsum(kept) - 1, kept[column]
        x = np.zeros((len(owner), int(kept.sum())), np.float32)
        x[row[own], place[column[own]]] = value[own]
        return x

    x = dense(np.ones(2 * len(words), bool))
    machine = fit(marks, n_toxic, owner, x, sizes, gaps, labelled)
    kept = needed(machine, n_toxic, owner, x, sizes, gaps, labelled)
    del x
    if not kept.all():
        marks = Landmarks([w for w, k in zip(words, kept) if k])
        machine = fit(marks, int(kept[:n_toxic].sum()), owner, dense(np.tile(kept, 2)), sizes, gaps, labelled)
    release_memory()
    return machine


class Scorer:
    """Scores texts in one task; keeps the chunks that weigh something and a bounded set of those that don't."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.weights: dict[str, dict[str, float]] = {}  # of a chunk's words
        self.bad: set[str] = set()
        self.nothing: set[str] = set()

    def scores(self, texts: list[str | None]) -> list[float]:
        if self.machine.weights is None:
            return [0.0] * len(texts)
        split = [(x or "").split() for x in texts]
        if len(self.nothing) > REMEMBERED:
            self.nothing.clear()
        new = {c: readings(c) for c in set().union(*split).difference(self.nothing, self.weights)}
        unknown = sorted({w for ws in new.values() for w in ws})
        g = self.machine.word_weights(unknown)
        known = {unknown[i]: float(g[i]) for i in np.nonzero(g)[0]}
        for c, ws in new.items():
            if found := {w: known[w] for w in ws if w in known}:
                self.weights[c] = found
                if max(found.values()) > 0:
                    self.bad.add(c)
            else:
                self.nothing.add(c)
        # without a bad chunk or letters one by one, no sentence weighs more than one without words
        return [self.machine.probability(0.0 if self.bad.isdisjoint(cs) and list(map(len, cs)).count(1) < 2 else self.decide(x or "")) for x, cs in zip(texts, split)]

    def decide(self, text: str) -> float:
        """The worst run's decision; all chunks of the text are known."""
        values, words, before, gap = [], [], [], 0
        get = self.weights.get
        for chunks in cut(text):
            found: dict[str, float] = {}
            for c in chunks:
                if (some := get(c)) is not None:
                    found.update(some)
            if letters := spelled(chunks):
                found.update((w, float(g)) for w, g in zip(letters, self.machine.word_weights(letters)) if g)
            if found:
                values.append(sum(found.values()))
                words.append(len(chunks))
                before.append(gap)
                gap = 0
            else:
                gap += len(chunks)
        return worst_run(values, words, before)[0]


def score_toxicity(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """Adds ``out``, from 0 to 1; ``keep`` names columns to carry along instead of the id alone, none of them called ``out``."""
    carried, kept, at = carry(docs, keep or [id_col], text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(machine)
        for batch in batches:
            found = [x for i in range(0, batch.num_rows, SLICE) for x in scorer.scores(batch.column(at).slice(i, SLICE).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(found, pa.float64())], names=[*kept.names, out])
        del scorer  # a worker lives on for later stages, which need its memory
        release_memory()

    return carried.mapInArrow(run, t.StructType([*kept.fields, t.StructField(out, t.DoubleType())]))
