"""Byte-level BPE encoding and decoding by DuckDB recursive queries inside each Spark partition.

A task cuts its texts into units (white space and the chunk behind it), encodes each unit it has not met yet and
joins the units' results per document. Encoding is one recursive query over the new words: a row is a word with the list
of its tokens and the list of its pairs' ranks, and a round contracts the leftmost pair of least rank in each word, until
no pair merges. Decoding is an ordered aggregation over the ids' bytes.

Defined cases: a null text counts as empty and has no tokens; the digests of empty texts are those of an empty string;
repeated rows and null ids each give their own row; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Unicode White_Space, as the pattern's ``\s`` means it.
_WS = r"\t-\r \x85\xa0  -     　"
_UNITS = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
#: Units that a Python worker keeps for later batches and tasks: the most frequent of the first batches.
CACHE_UNITS = 250_000
#: Characters of texts whose units are held at once.
SLICE = 4_000_000

#: Bytes of a piece that shares a query with others: up to BATCH of them, and up to SQUARES as the sum of their squared
#: lengths, as a query keeps a word's state of each round.
SHORT, BATCH, SQUARES = 256, 20_000, 16_000_000

#: The rank of what is no pair.
NONE = 65535

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

#: A row is a word: its tokens and its pairs' ranks, with NONE where a pair doesn't merge and at both ends, so that token p
#: stands between rank p and rank p + 1. A contraction replaces two tokens by one and three ranks by two.
_ENCODE = f"""
WITH RECURSIVE step AS (
    SELECT w, toks, ranks, list_min(ranks) AS least FROM start
  UNION ALL
    (WITH found AS (
        SELECT *, list_position(ranks, least) - 1 AS p FROM step WHERE least < {NONE}),
     moved AS (
        SELECT f.w, f.toks[1:f.p - 1] || [f.least] || f.toks[f.p + 2:] AS toks,
               f.ranks[1:f.p - 1] || [coalesce(a.merged, {NONE}::USMALLINT), coalesce(b.merged, {NONE}::USMALLINT)] || f.ranks[f.p + 3:] AS ranks
        FROM found f LEFT JOIN merges a ON a.pair = f.toks[f.p - 1]::UINTEGER * 65536 + f.least
        LEFT JOIN merges b ON b.pair = f.least::UINTEGER * 65536 + f.toks[f.p + 2])
     SELECT w, toks, ranks, list_min(ranks) FROM moved)
), ended AS (
    SELECT w, toks FROM step WHERE least = {NONE}
), tokens AS (
    SELECT w, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM ended
), bytes AS (
    SELECT w, from_hex(string_agg(v.hex, '' ORDER BY t.i)) AS decoded FROM tokens t JOIN vocabulary v ON v.tok = t.tok GROUP BY w)
SELECT w, array_to_string(toks, ',') AS ids, decoded FROM ended JOIN bytes USING (w)
"""


#: The same for a long piece, by a row for each token; the recursion keeps the present state alone (USING KEY): a row links to
#: its neighbours, and a round gives the rows that change. All pairs of the least rank are contracted up to the first whose
#: token makes a pair of lower rank with a neighbour.
_ENCODE_LONG = """
WITH RECURSIVE step(k, tok, prv, nxt, rank) USING KEY (k) AS (
    SELECT s.k, s.tok, s.prv, s.next_k, m.merged FROM start s LEFT JOIN merges m ON m.pair = s.tok::UINTEGER * 65536 + s.next_tok
  UNION
    (WITH found AS (
        SELECT k, prv, nxt, rank, prv IS DISTINCT FROM lag(k) OVER (ORDER BY k) AS fresh
        FROM recurring.step WHERE rank = (SELECT min(rank) FROM recurring.step)),
     runs AS (SELECT *, sum(fresh::INT) OVER (ORDER BY k) AS run FROM found),
     turns AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY k) AS turn FROM runs),
     apart AS (
        SELECT t.k AS spot, t.prv, t.nxt AS gone, t.rank AS merged, g.nxt AS after, t.turn > 1 AS behind, b.tok AS tok_before, a.tok AS tok_after
        FROM turns t JOIN recurring.step g ON g.k = t.nxt LEFT JOIN recurring.step b ON b.k = t.prv LEFT JOIN recurring.step a ON a.k = g.nxt
        WHERE t.turn % 2 = 1),
     checked AS (
        SELECT p.*, least(x.merged, y.merged) < p.merged AS risky
        FROM apart p LEFT JOIN merges x ON x.pair = CASE WHEN p.behind THEN p.merged ELSE p.tok_before END::UINTEGER * 65536 + p.merged
        LEFT JOIN merges y ON y.pair = p.merged::UINTEGER * 65536 + p.tok_after),
     chosen AS (SELECT * FROM checked WHERE spot <= coalesce((SELECT min(spot) FROM checked WHERE risky), spot)),
     changed AS (
        SELECT s.k, coalesce(x.merged, s.tok) AS tok, s.prv, CASE WHEN x.spot IS NULL THEN s.nxt ELSE x.after END AS nxt, s.rank, x.spot IS NOT NULL AS fresh
        FROM recurring.step s LEFT JOIN chosen x ON x.spot = s.k
        SEMI JOIN (SELECT spot AS k FROM chosen UNION ALL SELECT prv FROM chosen UNION ALL SELECT after FROM chosen) near ON near.k = s.k)
     SELECT c.k, c.tok, coalesce(l.spot, c.prv), c.nxt, CASE WHEN c.fresh OR coalesce(n.fresh, false) THEN m.merged ELSE c.rank END
     FROM changed c ANTI JOIN chosen g ON g.gone = c.k LEFT JOIN chosen l ON l.after = c.k LEFT JOIN changed n ON n.k = c.nxt
     LEFT JOIN merges m ON m.pair = c.tok::UINTEGER * 65536 + n.tok
     UNION ALL SELECT gone, NULL, NULL, NULL, NULL FROM chosen)
), sorted AS (
    SELECT s.tok, v.hex FROM step s JOIN vocabulary v ON v.tok = s.tok ORDER BY s.k)
SELECT 0 AS w, string_agg(tok::VARCHAR, ',') AS ids, string_agg(hex, '') AS decoded FROM sorted
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Encoder:
    """Encodes words by ranks; one in each Python worker. Ids must be under 65,536."""

    def __init__(self, path: str, pattern: str, memory_mb: int = 160):
        import duckdb
        import regex

        self.ranks = read_ranks(path)
        if max(self.ranks.values()) >= NONE:
            raise ValueError("a pair's key holds ids of 16 bits, of which the last is none")
        self.longest = max(map(len, self.ranks))
        self.words = regex.compile(pattern)
        self.units: dict[str, int] = {}
        self.results = (pa.array([], pa.large_string()), pa.array([], pa.large_binary()))  # ids and decoded bytes of units, by number
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": f"{memory_mb}MB", "preserve_insertion_order": False, "temp_directory": ""})
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs.append(left * 65536 + right)
                    merged.append(rank)
        merges = pa.table({"pair": pa.array(pairs, pa.uint32()), "merged": pa.array(merged, pa.uint16())})  # noqa: F841
        vocabulary = pa.table({"tok": pa.array(list(self.ranks.values()), pa.uint16()), "hex": [t.hex() for t in self.ranks]})  # noqa: F841
        for name in ("merges", "vocabulary"):
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}")
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.uint16)
        self.pairs = np.array([[self.ranks.get(bytes([a, b]), NONE) for b in range(256)] for a in range(256)], np.uint16)

    def encode_words(self, words: list[bytes]) -> list[pa.Array]:
        """Ids (decimal, joined by commas) and decoded bytes of each distinct word."""
        whole, short, long = [], [], []
        for i, w in enumerate(words):
            (whole if w in self.ranks else short if len(w) <= SHORT else long).append(i)
        order, found = [*whole], [self._contract([words[i] for i in whole], whole=True)]
        short.sort(key=lambda i: len(words[i]))  # those of a query end together
        squares = np.cumsum(np.array([len(words[i]) ** 2 for i in short], np.int64))
        at = 0
        while at < len(short):
            upto = int(np.searchsorted(squares, (squares[at - 1] if at else 0) + SQUARES, side="right"))
            some = short[at : max(at + 1, min(upto, at + BATCH))]
            found.append(self._contract([words[i] for i in some]))
            order += some
            at += len(some)
        if long:
            parts = [self.independent(words[i]) for i in long]
            pieces = list({p for ps in parts for p in ps if len(p) <= SHORT})
            known = dict(zip(pieces, zip(*(x.to_pylist() for x in self.encode_words(pieces)))))
            known.update((p, self._contract_long(p)) for p in {p for ps in parts for p in ps if len(p) > SHORT})
            found.append((pa.array([",".join([known[p][0] for p in ps]) for ps in parts], pa.large_string()), pa.array([b"".join([known[p][1] for p in ps]) for ps in parts], pa.large_binary())))
            order += long
        place = pa.array(np.argsort(np.array(order, np.int64)))
        ids, raw = (pa.concat_arrays(x).take(place) for x in zip(*found))
        if not raw.equals(pa.array(words, pa.large_binary())):
            raise ValueError("decoding does not give the words back")
        return [ids, raw]

    def independent(self, word: bytes) -> list[bytes]:
        """The word cut wherever no token of the vocabulary that stands in it reaches across, so that no pair ever can."""
        cuts, reach = [0], 1
        for i in range(len(word)):
            if i >= reach:
                cuts.append(i)
            for size in range(min(self.longest, len(word) - i), max(1, reach - i), -1):
                if word[i : i + size] in self.ranks:
                    reach = i + size
                    break
            reach = max(reach, i + 1)
        return [word[a:b] for a, b in zip(cuts, [*cuts[1:], len(word)])]

    def _contract(self, words: list[bytes], whole: bool = False) -> tuple[pa.Array, pa.Array]:
        """One recursive query over the words; those that are ``whole`` a token start as that one."""
        start = self._start(words, whole)  # noqa: F841
        found = self.db.sql(_ENCODE).to_arrow_table().combine_chunks()
        place = pa.array(np.argsort(found["w"].to_numpy()))
        return tuple(found[c].cast(kind).combine_chunks().take(place) for c, kind in (("ids", pa.large_string()), ("decoded", pa.large_binary())))

    def _start(self, words: list[bytes], whole: bool) -> pa.Table:
        """The words as they begin: a token for each byte, or one."""
        n = len(words)
        sizes = np.ones(n, np.int64) if whole else np.fromiter(map(len, words), np.int64, n)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ranks = np.full(ends[-1] + n, NONE, np.uint16)
        if whole:
            toks = np.array([self.ranks[w] for w in words], np.uint16)
        else:
            raw = np.frombuffer(b"".join(words), np.uint8)
            toks = self.single[raw]
            place = np.arange(len(raw)) + np.repeat(np.arange(n), sizes)
            inner = np.ones(len(raw), bool)
            inner[ends[:-1]] = False
            ranks[place[inner]] = self.pairs[raw[:-1], raw[1:]][inner[1:]]
        lists = lambda e, v: pa.ListArray.from_arrays(pa.array(e, pa.int32()), pa.array(v))
        return pa.table({"w": pa.array(np.arange(n), pa.int32()), "toks": lists(ends, toks), "ranks": lists(ends + np.arange(n + 1), ranks)})

    def _contract_long(self, word: bytes) -> tuple[str, bytes]:
        tok, key = self.single[np.frombuffer(word, np.uint8)], np.arange(len(word), dtype=np.int32)
        start = pa.table({"k": key, "tok": tok, "next_tok": pa.array(np.roll(tok, -1), mask=key == len(word) - 1), "next_k": pa.array(key + 1, mask=key == len(word) - 1), "prv": pa.array(key - 1, mask=key == 0)})
        self.db.register("start", start)
        ((_, ids, decoded),) = self.db.execute(_ENCODE_LONG).fetchall()
        self.db.unregister("start")
        return ids, bytes.fromhex(decoded)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[str, bytes]]:
        """Ids (decimal, joined by commas) and decoded bytes of each text. Distinct units are numbered; results are joined by number."""
        new: dict[str, int] = {}
        coded = []
        at = size = 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= SLICE or i + 1 == len(texts):
                coded.append(self._numbers(texts[at : i + 1], new))
                at, size = i + 1, 0
        fresh = self._units(list(new))
        results = [pa.concat_arrays(x) for x in zip(self.results, fresh)]
        known, room = len(self.units), CACHE_UNITS - len(self.units)
        if room > 0 and new:
            counts = np.zeros(known + len(new), np.int64)
            for _, numbers in coded:
                counts += np.bincount(numbers, minlength=len(counts))
            kept = np.argsort(-counts[known:], kind="stable")[:room]
            units = list(new)
            self.units.update((units[i], known + n) for n, i in enumerate(kept.tolist()))
            self.results = tuple(pa.concat_arrays([a, b.take(pa.array(kept))]) for a, b in zip(self.results, fresh))
        for ends, numbers in coded:
            yield from zip(*(x.to_pylist() for x in _joined(results, ends, numbers)))

    def _numbers(self, texts: list[str | None], new: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's units begin, and their numbers; units that are not known are added to ``new``."""
        units: list[str] = []
        ends = [0]
        for t in texts:
            units += _UNITS.findall(t or "")
            ends.append(len(units))
        distinct = pa.array(units, pa.large_string()).dictionary_encode()
        known, first = self.units.get, len(self.units)
        numbers = [n if (n := known(u)) is not None else new.setdefault(u, first + len(new)) for u in distinct.dictionary.to_pylist()]
        return np.array(ends), np.array(numbers, np.int64)[distinct.indices.to_numpy()]

    def _units(self, units: list[str]) -> list[pa.Array]:
        """Ids and decoded bytes of distinct units."""
        words: list[str] = []
        ends = [0]
        for u in units:
            words += self.words.findall(u)
            ends.append(len(words))
        distinct = pa.array(words, pa.large_string()).dictionary_encode()
        return _joined(self.encode_words(distinct.dictionary.cast(pa.large_binary()).to_pylist()), np.array(ends), distinct.indices.to_numpy())


def _joined(results: Iterable[pa.Array], ends: np.ndarray, numbers: np.ndarray) -> list[pa.Array]:
    """Ids and decoded bytes of rows whose parts are given by number."""
    return [pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), x.take(pa.array(numbers))), pa.scalar(between, x.type)) for x, between in zip(results, (",", b""))]


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: number of tokens and digests of its ids and of the bytes they decode to."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            rows = [(ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()) for ids, raw in encoder.encode(batch.column(1).to_pylist())]
            n, a, b = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(id_col, text_col).mapInArrow(run, SCHEMA)
