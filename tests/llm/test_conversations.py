"""The trie against plain dictionaries, its list ranks and running sums against loops."""

import collections
import hashlib
import random
import zlib

import pytest

from sheafwork.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, node string, arc int"


def plain(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode(), role or "", text or ""))
    for v in own.values():
        v.sort()
    own = {c: [x[3:] for x in v] for c, v in own.items()}
    members, ends, kids = collections.defaultdict(list), collections.defaultdict(list), collections.defaultdict(set)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
            if d:
                kids[whole[: d - 1]].add(whole[:d])
        ends[whole].append(c)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()
    )


def got(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, frame.select(*names).collect()), key=lambda r: (r[0], r[1], repr(r)))


def same(spark, rows):
    frame = spark.createDataFrame([(*r, "n", 0) for r in rows], SCHEMA)
    assert got(conversations.prefix_trie(frame)) == sorted(plain(rows), key=lambda r: (r[0], r[1], repr(r)))


@pytest.fixture
def small_blocks(monkeypatch):
    """So few rows in a block that sums go over many blocks and two levels."""
    monkeypatch.setattr(conversations, "BLOCK", 4)
    monkeypatch.setattr(conversations, "JOINED", 3)
    monkeypatch.setattr(conversations, "RULERS", 3)
    monkeypatch.setattr(conversations, "RANKED", 8)


def test_trees_of_many_shapes(spark, small_blocks):
    r = random.Random(3)
    rows = [(c, t, r.choice("ab"), r.choice(["x", "yy", "", "é"])) for c in [*range(0, 40), *range(100, 130), 205, 207, -105, -100] for t in range(r.randrange(1, 7))]
    rows += [(300, t, "a", "long") for t in range(40)]  # one conversation over many blocks
    rows += [(c, 0, "u", "same") for c in range(400, 460)]  # many equal ones
    same(spark, rows)


def test_nulls_ties_repeats_and_turnless(spark):
    same(spark, [(1, None, None, None), (1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, None, "b"), (2, 5, "u", None), (100, 1, "u", "z" * 50_000), (101, 1, "v", ""), (101, 2, "v", ""), (None, 1, "u", "lost"), (7, None, "u", "x"), (7, None, "u", "w")])


def test_no_rows(spark):
    assert conversations.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_list_ranks(spark, small_blocks):
    order = list(range(500))
    random.Random(1).shuffle(order)
    order.remove(1)
    order.append(1)
    arcs = spark.createDataFrame(list(zip(order, order[1:])), "arc long, next long")
    found = {r["arc"]: r["left"] for r in conversations.list_ranks(arcs, 1).collect()}
    assert found == {a: len(order) - 1 - i for i, a in enumerate(order)}
