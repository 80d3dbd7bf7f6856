"""Conversation prefix trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from hearthgrid.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            own[conv_id].append(((turn is not None, turn or 0), hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(head, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, ids in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(ids) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), children[p], leaves[p], saved[p], hashlib.sha256(",".join(str(c) for c in sorted(ids) if built[c] == p).encode()).hexdigest())
        for p, ids in members.items()
    )


def result(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert all(t == "bigint" for c, t in df.dtypes if c != "ends_sha256")
    return sorted(tuple(r) for r in df.collect())


ODD = [
    (0, 0, "user", "a"), (0, 1, "bot", "b"), (0, 2, "user", "c"), (0, 3, None, "d"), (0, 4, "bot", None), (0, 5, "user", "é😀"),
    (1, 1, "x", "y"), (1, 1, "x", "y"), (1, 1, "w", "y"), (1, None, "first", "z"), (2, None, None, None), (3, 7, "", ""),
    (None, 0, "user", "lost"), (-5, 0, "user", "a"), (-105, 0, "user", "a"), (100, 0, "u", "k"), (-100, 0, "n", "q"),
    *((c, t, "user", f"t{t}") for c in range(101, 140) for t in range(c % 8)),
    *((7000 + c, 0, "user", "alone") for c in range(40)), *((9000 + c, t, "user", "same") for c in range(30) for t in range(6)),
    (250, 0, "u", "x" * 100_000),
]


@pytest.mark.parametrize("last", [1, 1 << 12])
def test_trie(spark, monkeypatch, last):
    monkeypatch.setattr(trie, "PIECE", 3)
    assert result(trie.prefix_trie(spark.createDataFrame(ODD, SCHEMA), last)) == plain(ODD)


def test_long_conversation_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "SPAN", 8)
    draw = random.Random(3)
    rows = [(5, t, "user", f"t{t % 7}") for t in range(300)] + [(6, t, "user", f"t{t % 7}") for t in range(250)]
    rows += [(c, t, "user", draw.choice("ab")) for c in range(200, 240) for t in range(draw.randrange(12))]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'other' AS node", "1 AS k1", "2 AS depth").repartition(3)
    assert result(trie.digest(df, 16)) == plain(rows)


def test_no_rows_and_no_conversation(spark):
    assert result(trie.digest(spark.createDataFrame([], SCHEMA))) == []
    assert result(trie.digest(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))) == []


def test_list_ranking_of_shuffled_arcs(spark):
    order = list(range(500))
    random.Random(1).shuffle(order)
    rows = [(a, b, 1) for a, b in zip(order, [*order[1:], None])]
    df = spark.createDataFrame(rows, "arc long, next long, w long").repartition(5)
    places = {r["arc"]: r["place"] for r in trie.ranked(df, last=5).collect()}
    assert [places[a] for a in order] == list(range(500))
