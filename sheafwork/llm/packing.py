"""Packing documents into windows by sum of squares.

Every document goes, as it comes, to the partly filled window whose fill level keeps the sum of squared counts of
windows by level least; a level array holds the counts. A task packs its own partition, so no row moves. Documents longer
than a window fill whole windows first. When a task ends, the emptiest windows are cut up to fill the fullest, and the
last one is cut into powers of two, which need no padding.

Defined cases: a null text counts as empty and holds the end token alone; repeated rows and null ids are packed row by
row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections import defaultdict, deque
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import release_memory

WINDOW = 4096
END = 2
#: Chunks, and words, that a task keeps for later batches.
CACHE_CHUNKS = 350_000

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
#: Letters of Latin-1, then signs: the tokenizer cuts between the two, whatever the signs are.
_PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)")


def _byte_signs() -> dict[int, int]:
    """The sign that byte-level vocabularies have for each byte: itself where it is printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


_BYTES = _byte_signs()


class _Known(dict):
    """Results by key, made by ``make`` when first asked for; the first ``size`` are kept, and so the common ones."""

    def __init__(self, make: Callable[[bytes], bytes], size: int):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key: bytes) -> bytes:
        found = self.make(key)
        if len(self) < self.size:
            self[key] = found
        return found


class ChunkTokenizer:
    """Ids of whole texts as little-endian bytes, by chunks between ASCII white space.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its chunks in turn; ASCII
    letters are lowered beforehand, as it would, but for its added tokens, which it takes as they stand; a word's ids don't depend on signs behind it, and a word of letters is
    one word of the tokenizer's, so its model takes it as it is.
    """

    def __init__(self, path: str):
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are kept as little-endian words of 32 bits")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # texts are cut at these tokens; what is left has none
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.added_ids = {c: array("I", [i]).tobytes() for c, i in added.items()}
        self.chunks = _Known(self._chunk, CACHE_CHUNKS)
        self.words = _Known(self._word, CACHE_CHUNKS)
        self.signs = _Known(self._whole, 10_000)
        self.signs[b""] = b""
        self.tokenize = self.tokenizer.model.tokenize

    def _whole(self, chunk: bytes) -> bytes:
        return array("I", self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids).tobytes()

    def _word(self, word: bytes) -> bytes:
        own = word if word.isascii() else word.decode().lower().encode()
        return array("I", [t.id for t in self.tokenize(own.decode("latin-1").translate(_BYTES))]).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        if m := _PLAIN.fullmatch(chunk):
            word, signs = m.groups()
            return self.words[word] + self.signs[signs]
        return self._whole(chunk)

    def forget(self) -> None:
        """Lets the kept chunks go, but for the signs."""
        self.chunks.clear()
        self.words.clear()

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        get = self.chunks.__getitem__
        for text in texts:
            parts = self.added.split(text) if text and self.added else [text or ""]  # the tokenizer finds its added tokens first, as they are written
            yield b"".join([self.added_ids.get(part) or b"".join(map(get, part.encode().lower().split())) for part in parts])


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


class Packer:
    """Windows of one task. A piece is (doc_id, start, ids as bytes, tokens of its document)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = defaultdict(list)

    def level_for(self, size: int) -> int:
        """The fill level, 0 for a new window, from which a piece of ``size`` keeps the sum of squares least; the highest of equals."""
        n = self.levels
        most = self.window - size
        change = 2 * (n[size : self.window + 1] - n[: most + 1]) + 2
        change[-1] = 1 - 2 * n[most]  # a full window leaves the sum
        change[0] = 2 * n[size] + 1
        change[1:][n[1 : most + 1] == 0] = np.iinfo(np.int64).max
        return int(most - change[::-1].argmin())

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[list]:
        """The windows that this document fills."""
        total = len(ids) // 4
        whole = total - total % self.window
        for start in range(0, whole, self.window):
            yield [(doc_id, start, ids[4 * start : 4 * (start + self.window)], total)]
        if size := total - whole:
            level = self.level_for(size)
            window = []
            if level:
                window = self.open[level].pop()
                self.levels[level] -= 1
            window.append((doc_id, whole, ids[4 * whole :], total))
            if level + size == self.window:
                yield window
            else:
                self.levels[level + size] += 1
                self.open[level + size].append(window)

    def close(self) -> Iterator[list]:
        """The rest: the emptiest windows fill the fullest, the last is cut into powers of two."""
        rest = deque(w for level in sorted(self.open, reverse=True) for w in self.open[level])
        loose: list = []
        while rest:
            window = rest.popleft()
            gap = self.window - sum(len(p[2]) // 4 for p in window)
            while gap and (loose or rest):
                loose = loose or rest.pop()
                taken, kept = _cut(loose.pop(), gap)
                window.append(taken)
                gap -= len(taken[2]) // 4
                if kept:
                    loose.append(kept)
            if gap:
                loose = window
            else:
                yield window
        while loose:
            size = min(self.window, 1 << (sum(len(p[2]) // 4 for p in loose).bit_length() - 1))
            window = []
            while size:
                taken, kept = _cut(loose.pop(), size)
                window.append(taken)
                size -= len(taken[2]) // 4
                if kept:
                    loose.append(kept)
            yield window


def _cut(piece: tuple, size: int) -> tuple[tuple, tuple | None]:
    doc_id, start, ids, total = piece
    if len(ids) // 4 <= size:
        return piece, None
    return (doc_id, start, ids[: 4 * size], total), (doc_id, start + size, ids[4 * size :], total)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece: its document, place there, checksum of its ids, sequence and place in that."""
    last = end.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = _tokenizer(tokenizer_path), Packer(window)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def place(full: list) -> None:
            nonlocal sequence
            offset = 0
            for doc_id, start, ids, total in full:
                n = len(ids) // 4
                rows.append((doc_id, start, n, zlib.crc32(ids), total, sequence, offset))
                offset += n
            sequence += 1

        def block() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=_NAMES)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokenizer.encode(batch.column(1).to_pylist())):
                for full in packer.add(doc_id, ids + last):
                    place(full)
            if rows:
                yield block()
        for full in packer.close():
            place(full)
        if rows:
            yield block()
        tokenizer.forget()  # a worker lives on for other stages, which need its memory
        release_memory()

    return docs.select(id_col, text_col).mapInArrow(run, SCHEMA)
