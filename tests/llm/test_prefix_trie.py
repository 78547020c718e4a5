"""The prefix trie against a trie built conversation by conversation."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinship.llm import prefix_trie

CHAT = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Counter of (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            said[c].append((turn is not None, turn or 0, tie, (role, text)))
    said = {c: [turn[-1] for turn in sorted(turns)] for c, turns in said.items()}
    members = defaultdict(list)
    whole = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(said.get(base, [])[:h] + own[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(convs) - 1) * words
    out = []
    for path, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def chat(seed, n=120, most=9):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b c", "", None, "d  e\tf", "é 漢"]))
        for c in [*range(n), *range(-30, 0), *range(5000, 5010)]
        for t in range(rng.randint(1, most))
    ]


def got(spark, rows, **options):
    return Counter(map(tuple, prefix_trie.trie(spark.createDataFrame(rows, CHAT), **options).collect()))


@pytest.mark.parametrize("height", [None, 1, 3, 20])
def test_trie_equals_brute_force(spark, height):
    rows = chat(1, most=6 if height == 1 else 9)
    assert got(spark, rows, height=height) == brute(rows)


def test_long_conversations_by_blocks(spark, monkeypatch):
    """Blocks of few depths, spans of few ids and no hot parent: the same trie."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    monkeypatch.setattr(prefix_trie, "SPAN", 3)
    monkeypatch.setattr(prefix_trie, "HOT", 0)
    rows = chat(2, n=40) + [(7000, t, "user", f"t{t % 5}") for t in range(90)] + [(7001, t, "user", f"t{t % 5}") for t in range(88)]
    assert got(spark, rows) == brute(rows)


def test_a_key_with_a_third_of_all_rows(spark):
    rows = chat(3, n=30) + [(c, t, "user", "the same") for c in range(100, 400) for t in range(3)]
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no id"), (None, None, None, None), (1, None, None, None), (1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"),
        (2, 0, "user", "x" * 100_000), (3, 0, "u", "ser"), (23, 0, "us", "er"), (41, 5, "user", "only"),
    ]
    assert got(spark, rows) == brute(rows)
    # Conversations that lose all their turns end at the root.
    short = [(c, 0, "user", "x") for c in range(20_001, 20_020)]
    assert got(spark, short) == brute(short)


def test_clashing_columns_and_nothing(spark):
    rows = spark.createDataFrame(chat(5, n=10), CHAT)
    clashing = rows.select("*", *(F.lit("x").alias(n) for n in ("depth", "x", "y", "up", "place", "words", "said", "row", "task", "from")))
    assert Counter(map(tuple, prefix_trie.trie(clashing).collect())) == brute(chat(5, n=10))
    assert prefix_trie.trie(rows.limit(0)).count() == 0
    assert prefix_trie.trie(rows.where("conv_id is null")).columns[:3] == ["conv_id", "depth", "parent_conv_id"]
