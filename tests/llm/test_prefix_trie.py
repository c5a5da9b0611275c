"""The conversation trie against a trie of Python dictionaries."""

import hashlib
import random
import zlib

import pytest

from bibliospark.llm import prefix_trie
from bibliospark.llm.prefix_trie import numbered_turns

from .helpers import rows

TURNS = "conv_id long, turn long, role string, text string"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(table):
    own: dict = {}
    for c, turn, role, text in table:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + ts[h:])
    members: dict = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    kids: dict = {p: 0 for p in members}
    leaves, saved = dict(kids), dict(kids)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        gain = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += gain
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), up, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def check(spark, table):
    assert rows(prefix_trie.prefix_trie(spark.createDataFrame(table, TURNS)), *NAMES) == brute(table)


def talk(c, texts, role="user"):
    return [(c, i, role, t) for i, t in enumerate(texts)]


def test_random_conversations(spark):
    rng = random.Random(7)
    table = []
    for c in rng.sample(range(400), 120):
        table += talk(c, [rng.choice(["a", "bb", "", "ccc"]) for _ in range(rng.choice([0, 1, 3, 7, 15, 16, 17, 33]))])
    rng.shuffle(table)
    check(spark, table)


def test_long_shared_conversations(spark):
    rng = random.Random(8)
    trunk = [f"t{rng.randrange(3)}" for _ in range(150)]
    table = []
    for c in range(1, 40):
        cut = rng.choice([5, 16, 31, 32, 48, 64, 100, 128, 150])
        table += talk(c, trunk[:cut] + [f"own{rng.randrange(4)}" for _ in range(rng.randrange(20))])
    check(spark, table)


@pytest.mark.parametrize("piece", [3, 4096])
def test_copies_ends_and_small_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    same = [row for c in range(100, 160) for row in talk(c, ["hello", "hi", "bye", "x", "y", "z", "end"])]
    check(spark, same + talk(100_000, ["hello"] * 40) + talk(7, ["hello", "hi"]))


def test_nulls_ties_repeats_and_clashing_names(spark):
    table = [
        (1, 2, "user", "b"), (1, None, None, "first"), (1, 2, "user", "b"), (1, 2, "assistant", None), (1, 2, "user", "a"),
        (None, 0, "user", "lost"), (300, 0, "u", "x:y"), (301, 0, "u:", "xy"), (302, 0, None, None), (303, 0, "", ""),
        (2, 5, "user", "İé👩"), (9, 0, "u", "only"),
    ]
    check(spark, table)
    df = spark.createDataFrame(table, TURNS).selectExpr("*", "text as name", "turn as depth", "turn as n_convs", "conv_id as pos", "1 as d")
    assert rows(prefix_trie.prefix_trie(df), *NAMES) == brute(table)


def test_turnless_and_empty(spark):
    assert rows(prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)), *NAMES) == []
    assert rows(prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)), *NAMES) == []
    turnless = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6)
    check(spark, [(turnless, 0, "user", "gone")])


def test_one_conversation_over_many_ranges(spark):
    table = talk(5, [f"w{i % 7}" for i in range(3000)]) + talk(6, ["w0", "w1"])
    got = rows(numbered_turns(spark.createDataFrame(table, TURNS).repartition(16)), "conv_id", "pos")
    assert got == [(5, i) for i in range(1, 3001)] + [(6, 1), (6, 2)]
    check(spark, talk(5, [f"w{i % 7}" for i in range(700)]) + talk(6, ["w0", "w1"]))
