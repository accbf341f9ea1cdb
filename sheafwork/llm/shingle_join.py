"""Exact Jaccard join of word shingles by T-occurrence search (DivideSkip), in bounded groups.

Two sets of sizes a <= b link only if b's overlap with a reaches T. So a link's sets share one of their first few
shingles in any common order: that gives candidate pairs without comparing texts. Of these only pairs stay whose parity
bitmaps differ in no more bits than linked sets could differ in shingles, else chance pairs, which grow with the square of
the input, would tie most sets into few groups. What stays makes candidate groups. Within a group each set is searched
among the smaller ones over inverted lists: the T - 1 longest lists are set aside, a heap merges the short ones into
candidates (lists of thousands of postings are merged in blocks), and candidates are probed in the long lists by binary search. Sets that
already belong together aren't compared again, so a group of copies costs a spanning tree, not its pairs.

Shingles are ordered by how common they are, then by hash: rare words make rare shingles, and shingles that partitions
see repeatedly come last. The order only saves work and never changes a result, as any order that all sets share will do;
so the bounds on the lists that all tasks hold (``FREQUENT`` words, ``COMMON`` shingles) lose nothing.

Equal sets are one node from the start. In groups over ``BLOCK`` shingles all sets are first compared with a few pivots of
the group, which costs a pass over it: what pivots connect is one part, of which blocks need to meet only the sets outside.
Where much is left outside, the group is dealt by size class and, where a class is still larger, into blocks of which each
two meet in a task.

Defined cases: texts that are null or have no word have no shingles and link to nothing; rows that share an id count as
one document's; rows without an id are not linked and have no component; equal texts always link; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import release_memory, written
from .components import components

#: Words and shingles that all tasks are told are frequent, at most.
FREQUENT, COMMON = 1 << 14, 1 << 18
#: Occurrences of a shingle in a partition and overall that make it common.
SEEN_HERE, SEEN = 2, 4
#: Shingles of the sets that a task compares at once, about; a single set may be larger.
BLOCK = 4_000_000
#: Sets of a large group that all its sets are compared with first.
PIVOTS = 4
#: Sets that share a first shingle, up to which they are paired; more are joined to one of them.
PAIRED = 64
#: Bits of the largest parity bitmap.
PARITY = 1 << 15
#: Bits of the bitmap's size that tells which documents have candidates.
MARKS = 20
_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class _Hashes(dict):
    """Hashes of words with their commonness, 0 to 15, in the last four bits; forgets all when full."""

    def __init__(self, commonness: dict[bytes, int]):
        super().__init__()
        self.commonness = commonness

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word) & ~15 | self.commonness.get(word, 0)
        return found


class Shingler:
    def __init__(self, words: int = 4, commonness: dict[bytes, int] | None = None):
        self.words = words
        self.hashes = _Hashes(commonness or {})

    def shingles(self, text: str | None) -> np.ndarray:
        """Distinct shingles of the text, ascending: the mean commonness of their words in 4 bits, then 60 bits of hash.

        Words end at ASCII white space; A-Z are lowered; a text of fewer words than a shingle's is one shingle.
        """
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        n, k = max(1, len(h) - self.words + 1), min(len(h), self.words)
        out, common = np.full(n, k, np.uint64), np.zeros(n, np.uint64)
        for i in range(k):
            out = (out ^ h[i : i + n]) * _PRIMES[i % 3]
            out ^= out >> np.uint64(29)
            common += h[i : i + n] & np.uint64(15)
        out = np.sort(out >> np.uint64(4) | common // np.uint64(k) << np.uint64(60))
        return out[np.concatenate(([True], out[1:] != out[:-1]))]


def frequent_words(docs: DataFrame) -> dict[bytes, int]:
    """Commonness of the most frequent words of all texts: 15 for the first few, less by one as their number doubles."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update((text.as_py() or "").encode().lower().split())
                if len(seen) > 200_000:  # what is left out is rare here
                    yield _words(seen)
                    seen.clear()
        if seen:
            yield _words(seen)
        del seen
        release_memory()

    totals = docs.select("text").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    rows = totals.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    return {bytes(r["word"]): max(1, 15 - (i + 1).bit_length() + 1) for i, r in enumerate(rows)}


def _words(seen: Counter) -> pa.RecordBatch:
    words, n = zip(*seen.most_common(FREQUENT))
    return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64())], names=["word", "n"])


def probe_length(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """First shingles of which a set shares one with any smaller or equal set that it links to."""
    return n - -(-percent * n // 100) + 1


def index_length(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """First shingles of which a set shares one with any larger or equal set that it links to."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


def in_order(shingles: np.ndarray, common: np.ndarray, size: int) -> np.ndarray:
    """The first ``size`` shingles, rare ones before common ones."""
    if not len(common):
        return shingles[:size]
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    often = common[at] == shingles
    return np.concatenate((shingles[~often], shingles[often]))[:size]


def parity(shingles: np.ndarray) -> bytes:
    """A bit for each place that an odd number of the shingles falls on; about as many places as shingles, a power of two."""
    size = min(PARITY, max(64, 1 << int(len(shingles) * 3 // 4).bit_length()))
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def may_link(n1: int, bits1: bytes, n2: int, bits2: bytes, percent: int) -> bool:
    """False only where the parity bitmaps differ in more bits than sets of these sizes that link can differ in shingles."""
    a, b = int.from_bytes(bits1, "little"), int.from_bytes(bits2, "little")
    size1, size2 = 8 * len(bits1), 8 * len(bits2)
    while size1 > size2:  # of half as many places each is two of these together
        size1 //= 2
        a = a >> size1 ^ a & (1 << size1) - 1
    while size2 > size1:
        size2 //= 2
        b = b >> size2 ^ b & (1 << size2) - 1
    both = -(-percent * (n1 + n2) // (100 + percent))
    return (a ^ b).bit_count() <= n1 + n2 - 2 * both


def common_shingles(docs: DataFrame, percent: int, words: int, frequent: dict[bytes, int]) -> np.ndarray:
    """Shingles that many documents share, from all texts; at most COMMON, ascending."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words, frequent)
        parts: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[n >= SEEN_HERE].view(np.int64)), pa.array(n[n >= SEEN_HERE])], names=["shingle", "n"])

        for batch in batches:
            for text in batch.column(0):
                s = shingler.shingles(text.as_py())
                parts.append(s[: 2 * probe_length(len(s), percent)] if len(s) else s)
                held += len(parts[-1])
                if held > 4_000_000:
                    yield block()
                    held = 0
        if parts:
            yield block()
        del shingler
        release_memory()

    seen = docs.select("text").mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= SEEN)
    rows = seen.orderBy(F.desc("n"), "shingle").limit(COMMON).toPandas()
    return np.sort(rows["shingle"].to_numpy(np.int64).view(np.uint64))


def signatures(docs: DataFrame, common: np.ndarray, percent: int, words: int, frequent: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, signature of the whole set, its first shingles as bytes, its parity bitmap)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words, frequent)
        for batch in batches:
            sizes, marks, firsts, bits = [], [], [], []
            for text in batch.column(1):
                s = shingler.shingles(text.as_py())
                sizes.append(len(s))
                marks.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                firsts.append(in_order(s, common, probe_length(len(s), percent)).tobytes() if len(s) else None)
                bits.append(parity(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), *(pa.array(x, pa.binary()) for x in (marks, firsts, bits))], names=["doc_id", "n", "mark", "firsts", "bits"])
        del shingler
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, mark binary, firsts binary, bits binary")


def candidate_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, sure) for nodes with a first shingle and sizes in common. Where up to PAIRED share it, all such pairs; where more
    do, each is joined to one of them: such edges are ``sure``, as they stand for pairs that aren't listed."""

    def lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            firsts = [np.frombuffer(x.as_py(), np.int64) for x in batch.column(2)]
            sizes = np.array([len(f) for f in firsts])
            if not len(sizes):
                continue
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            token, node, n = np.concatenate(firsts), np.repeat(at, sizes), np.repeat(n, sizes)
            index = place < index_length(n, percent)
            for k in range(0, len(token), 200_000):
                s = slice(k, k + 200_000)
                # a set's size and whether it is indexed by this shingle, in one number that sorts by size
                yield pa.RecordBatch.from_arrays([pa.array(token[s]), pa.array((n[s] * 2 + index[s]).astype(np.int32)), pa.array(node[s])], names=["token", "size", "node"])

    def edges(a: np.ndarray, b: np.ndarray, sure: bool) -> Iterator[pa.RecordBatch]:
        pairs = np.stack((np.maximum(a, b), np.minimum(a, b)))[:, a != b]
        if pairs.shape[1]:
            pairs = np.unique(pairs, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.array(np.full(pairs.shape[1], sure))], names=["a", "b", "sure"])

    def star(token: np.ndarray, n: np.ndarray, index: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Edges of whole lists, and what the last is so far: its token, largest indexed size and head."""
        fresh = np.concatenate(([True], token[1:] != token[:-1]))
        # largest indexed size up to each row of its list: sizes ascend, so it is that of the last indexed row
        base = np.cumsum(fresh) << 40
        upto = np.maximum.accumulate(np.where(index, base + n, base)) - base
        joined = ~fresh & (np.concatenate(([0], upto[:-1])) * 100 >= percent * n)
        head = np.maximum.accumulate(np.where(joined, 0, np.arange(len(n))))
        return node[head[joined]], node[joined], (token[-1], upto[-1], upto[-1] > 0, node[head[-1]])

    def paired(n: np.ndarray, index: np.ndarray, node: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of lists; ``left`` says how many rows of its list stand behind each."""
        a, b, at, d = [], [], np.nonzero(index & (left > 0))[0], 1
        while len(at):
            meet = at[n[at] * 100 >= percent * n[at + d]]
            a.append(node[meet])
            b.append(node[meet + d])
            d += 1
            at = at[left[at] >= d]
        none = np.empty(0, np.int64)
        return np.concatenate((none, *a)), np.concatenate((none, *b))

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)]  # the open list
        running = False  # it is long, and what is held is what star() told of it
        for batch in chain(batches, [None]):  # the end closes the last list
            if batch is not None:
                token, size, node = (batch.column(i).to_numpy() for i in range(3))
                n, index = size.astype(np.int64) >> 1, (size & 1).astype(bool)
                held = [np.concatenate(x) for x in zip(held, (token, n, index, node))]
            token, n, index, node = held
            if not len(token):
                continue
            starts = np.concatenate(([0], np.nonzero(token[1:] != token[:-1])[0] + 1))
            lengths = np.diff(np.concatenate((starts, [len(token)])))
            long = lengths > PAIRED
            long[0] |= running
            open_at = len(token) if batch is None or long[-1] else starts[-1]
            rows_long, left = np.repeat(long, lengths), np.repeat(starts + lengths, lengths) - np.arange(len(token)) - 1
            rows_long, done = rows_long[:open_at], slice(0, open_at)
            short = ~rows_long
            yield from edges(*paired(n[done][short], index[done][short], node[done][short], left[done][short]), False)
            held, running = [x[open_at:] for x in held], False
            if rows_long.any():
                a, b, last = star(*(x[done][rows_long] for x in (token, n, index, node)))
                yield from edges(a, b, True)
                if long[-1]:
                    held, running = [np.array([x]) for x in last], True

    rows = nodes.select("node", "n", "firsts").mapInArrow(lists, "token bigint, size int, node bigint")
    dealt = rows.repartition("token").sortWithinPartitions("token", "size", "node")
    return dealt.mapInArrow(join, "a bigint, b bigint, sure boolean")


def candidate_edges(nodes: DataFrame, percent: int) -> DataFrame:
    """Edges between nodes that may link: pairs that bitmaps don't rule out, and those that stand for long lists.
    ``nodes``: (node, n, firsts, bits)."""

    def test(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [may_link(*x, percent) for x in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = written(candidate_pairs(nodes, percent).groupBy("a", "b").agg(F.bool_or("sure").alias("sure")), "shingle-pairs")
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    both = pairs.where("NOT sure").select("a", "b").join(side("a"), "a").join(side("b"), "b")
    tested = both.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(test, "a bigint, b bigint")
    return pairs.where("sure").select("a", "b").unionByName(tested)


class _Sets:
    """Disjoint sets of a task's nodes."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i


def divide_skip(sets: list[np.ndarray], names: list[int], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets: 100 * intersection >= percent * union. Sets of one name belong together."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), names[i]))
    sets, names = [sets[i] for i in order], [names[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    token = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    by = np.argsort(token, kind="stable").astype(np.int32)
    posting, token = owner[by], token[by]
    del owner
    fresh = np.concatenate(([True], token[1:] != token[:-1])) if len(token) else np.empty(0, bool)
    del token
    number = np.empty(len(by), np.int32)
    number[by] = np.cumsum(fresh, dtype=np.int32) - 1  # of each set's shingles, the list they are in
    starts = np.concatenate((np.nonzero(fresh)[0], [len(by)]))
    place = number[by] * np.int64(len(sets)) + posting  # ascends over all lists: one binary search finds a set in any of them
    del by, fresh
    lengths = np.diff(starts)
    own = np.concatenate(([0], np.cumsum(sizes)))
    same, first_of, links = _Sets(len(sets)), {}, []
    for i, name in enumerate(names):
        same.up[i] = first_of.setdefault(name, i)
    for q in range(1, len(sets)):
        lo = int(np.searchsorted(sizes, -(-percent * sizes[q] // 100)))
        if lo >= q:
            continue
        mine = number[own[q] : own[q + 1]]
        mine = mine[lengths[mine] > 1]
        least = -(-percent * (int(sizes[q]) + int(sizes[lo])) // (100 + percent))
        if len(mine) < least:
            continue
        mine = mine[np.argsort(lengths[mine], kind="stable")]
        short, long = mine[: len(mine) - least + 1], mine[len(mine) - least + 1 :]
        found = _merge([posting[starts[k] : starts[k + 1]] for k in short], lo, q)
        if not found:
            continue
        # candidates of other components, by their count in the short lists so far
        here = same.root(q)
        rest = sorted(((j, n) for j, n in found.items() if same.root(j) != here), key=lambda x: -x[1])
        if not rest:
            continue
        probes = long * np.int64(len(sets))
        for j, n in rest:
            if same.root(j) == here:
                continue
            need = -(-percent * (int(sizes[q]) + int(sizes[j])) // (100 + percent))
            if n + len(probes) < need:
                continue
            at = np.searchsorted(place, probes + j)
            n += int((place[np.minimum(at, len(place) - 1)] == probes + j).sum())
            if n >= need:
                links.append((names[q], names[j]))
                same.up[here] = root = same.root(j)
                here = root
    return links


def _merge(lists: list[np.ndarray], lo: int, hi: int) -> dict[int, int]:
    """How often each of lo..hi-1 occurs in the short lists: merged by a heap, in blocks where they are long."""
    cut = [x[bisect_left(x, lo) : bisect_left(x, hi)] for x in lists]
    cut = [x for x in cut if len(x)]
    if sum(map(len, cut)) > 2000:
        found, n = np.unique(np.concatenate(cut), return_counts=True)
        return dict(zip(found.tolist(), n.tolist()))
    out: dict[int, int] = {}
    for j in heapq.merge(*[x.tolist() for x in cut]):
        out[j] = out.get(j, 0) + 1
    return out


def _places(ids: np.ndarray) -> np.ndarray:
    return (ids.view(np.uint64) * _PRIMES[0] >> np.uint64(64 - MARKS)).astype(np.int64)


def _likely(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows (node, text) whose node may be among ``nodes``, by a bitmap of 2 ** MARKS marks; spares shuffling the others."""

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_places(batch.column(0).to_numpy())))], names=["place"])

    places = nodes.select("node").mapInArrow(mark, "place bigint").distinct().toPandas()["place"].to_numpy(np.int64)
    bits = np.zeros(1 << MARKS, bool)
    bits[places] = True
    packed = np.packbits(bits)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(packed).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(marked[_places(batch.column(0).to_numpy())]))

    return rows.where("node IS NOT NULL").mapInArrow(keep, "node bigint, text string")


def _with_sets(docs: DataFrame, rows: DataFrame, words: int, frequent: dict[bytes, int]) -> DataFrame:
    """``rows`` (node, rest) with the shingles of their nodes' texts as bytes."""

    def arrays(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words, frequent)
        for batch in batches:
            out = [shingler.shingles(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.binary())], names=["node", "rest", "shingles"])

    texts = _likely(docs.select(F.col("doc_id").alias("node"), "text"), rows).join(rows, "node").select("node", "text", "rest")
    return texts.mapInArrow(arrays, StructType([texts.schema["node"], texts.schema["rest"], StructField("shingles", BinaryType())]))


def pivot_links(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of each group's sets with up to PIVOTS of them, each drawn from those that no pivot links to so far.
    ``members``: (node, component, shingles). The pivots are a written table, so a group of very many sets can be split."""

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for mine, own in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(mine.as_py(), np.uint64), np.frombuffer(own.as_py(), np.uint64)
                both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found, rest = None, members
    for _ in range(PIVOTS):
        drawn = rest.groupBy("component").agg(F.min_by(F.struct("node", "shingles"), F.xxhash64("node")).alias("p"))
        pivots = written(drawn.select("component", F.col("p.node").alias("pivot"), F.col("p.shingles").alias("own")), "pivots")
        near = written(members.join(pivots, "component").select("node", "pivot", "shingles", "own").mapInArrow(linked, "a bigint, b bigint"), "pivot-links")
        found = near if found is None else found.unionByName(near)
        rest = rest.join(near.select(F.col("a").alias("node")), "node", "left_anti")
    return found


def verified_links(docs: DataFrame, clusters: DataFrame, percent: int, words: int, frequent: dict[bytes, int], block: int = BLOCK) -> DataFrame:
    """Links (a, b) that span what belongs together in each candidate group. ``clusters``: (node, n, component)."""
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) * (1 - 1e-12)).cast("int")
    rows = clusters.withColumn("class", step)
    counts = rows.groupBy("component", "class").agg(F.sum("n").alias("m"))
    whole = counts.groupBy("component").agg(F.sum("m").alias("all"))
    large = written(whole.where(F.col("all") > block), "large-groups")
    known, stars = None, None
    if not large.isEmpty():
        of_large = clusters.join(large.select("component"), "component").select("node", F.struct("component", "n").alias("rest"))
        members = written(_with_sets(docs, of_large, words, frequent).select("node", "rest.component", "rest.n", "shingles").dropDuplicates(["node"]), "large-sets")
        known = pivot_links(members, percent)
        # sets that pivots connect are one: of each group the largest of these meets only what is outside of it
        subs = components(known)
        named = members.select("node", "component", "n").join(subs.select("node", F.col("component").alias("sub")), "node", "left").withColumn("sub", F.coalesce("sub", "node"))
        subs = written(named, "connected-sets")
        most = subs.groupBy("component", "sub").agg(F.sum("n").alias("m")).groupBy("component").agg(F.max_by("sub", "m").alias("main"), F.max("m").alias("m_main"), F.sum("m").alias("m_all"))
        stars = written(most.where(F.col("m_all") - F.col("m_main") <= block / 2).select("component", "main", F.ceil(F.col("m_main") * 2 / block).cast("int").alias("k_main")), "stars")
        rows = rows.join(subs.select("node", "sub"), "node", "left").join(stars, "component", "left")
    else:
        rows = rows.withColumns({"sub": F.lit(None).cast("long"), "main": F.lit(None).cast("long"), "k_main": F.lit(None).cast("int")})
    rows = rows.withColumn("sub", F.coalesce("sub", "node"))
    above = counts.select("component", (F.col("class") - 1).alias("class"), F.col("m").alias("m_above"))
    below = counts.select("component", (F.col("class") + 1).alias("class"), F.col("m").alias("m_below"))
    parts = counts.join(above, ["component", "class"], "left").join(below, ["component", "class"], "left").join(whole, "component")
    cuts = lambda c: F.greatest(F.lit(1), F.ceil(F.coalesce(F.col(c), F.lit(0)) * 2 / block)).cast("int")
    parts = parts.select("component", "class", "all", cuts("m").alias("k"), cuts("m_above").alias("k_above"), cuts("m_below").alias("k_below"), F.coalesce("m_above", F.lit(0)).alias("m_above"), F.coalesce("m_below", F.lit(0)).alias("m_below"))
    placed = rows.join(parts, ["component", "class"]).withColumn("i", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    single = lambda kind, i: F.array(F.struct(F.lit(kind).alias("class"), i.cast("int").alias("i"), F.lit(0).alias("j")))
    # a small group is one task's; of a star, blocks of the largest part meet all else; else blocks of a class meet each
    # other, and those of the next class
    groups = (
        F.when(F.col("all") <= block, single(-1, F.lit(0)))
        .when(F.col("sub") == F.col("main"), single(-2, F.pmod(F.xxhash64("node"), F.col("k_main"))))
        .when(F.col("main").isNotNull(), F.expr("transform(sequence(0, k_main - 1), x -> struct(-2 AS class, x AS i, 0 AS j))"))
        .otherwise(
            F.concat(
                # a class in one block meets itself where it meets a neighbour
                F.expr("IF(k > 1 OR m_above + m_below = 0, transform(sequence(0, k - 1), j -> struct(class * 2 AS class, least(i, j) AS i, greatest(i, j) AS j)), array())"),
                F.expr("IF(m_above > 0, transform(sequence(0, k_above - 1), j -> struct(class * 2 + 1 AS class, i AS i, j AS j)), array())"),
                F.expr("IF(m_below > 0, transform(sequence(0, k_below - 1), j -> struct(class * 2 - 1 AS class, j AS i, i AS j)), array())"),
            )
        )
    )
    placed = placed.select("node", "component", "sub", F.explode(groups).alias("part"))
    by_node = placed.groupBy("node").agg(F.collect_list(F.struct("component", "part", "sub")).alias("rest"))
    dealt = _with_sets(docs, by_node, words, frequent).select("node", "shingles", F.explode("rest").alias("g")).select("node", "shingles", "g.component", "g.part", "g.sub")

    def search(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["node", "shingles"])
        links = divide_skip([np.frombuffer(x, np.uint64) for x in group["shingles"]], group["sub"].tolist(), percent)
        if group["shingles"].map(len).sum() > 1 << 22:
            del group
            release_memory()
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    links = dealt.groupBy("component", "part").applyInPandas(search, "a bigint, b bigint")
    return links if known is None else links.unionByName(known)


def jaccard_components(docs: DataFrame, percent: int = 85, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest id that links of at least ``percent`` lead to."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    frequent = frequent_words(rows)
    common = common_shingles(rows, percent, words, frequent)
    marks = written(signatures(rows, common, percent, words, frequent), "shingle-sets")
    linked = marks.where("doc_id IS NOT NULL AND n > 0")
    sets = written(linked.groupBy("mark").agg(F.min(F.struct("doc_id", "n", "firsts", "bits")).alias("s")).select("mark", F.col("s.doc_id").alias("node"), "s.n", "s.firsts", "s.bits"), "shingle-nodes")
    edges = candidate_edges(sets, percent)
    groups = components(edges)
    clusters = written(sets.select("node", "n").join(groups, "node").distinct(), "shingle-groups")
    links = components(verified_links(rows, clusters, percent, words, frequent))
    of = sets.select("mark", "node").join(links, "node", "left").select("mark", F.coalesce("component", "node").alias("found"))
    named = marks.select("doc_id", "n", "mark").join(of, "mark", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"))
