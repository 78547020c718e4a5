"""Ranked search against a score of every document by itself."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinship.llm import block_search
from kinship.llm.common import written

ITEM = "item_id long, text string"


def said(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    """Rows (item_id, rank, doc_id, score) from the definition, document by document."""
    counted = [(doc_id, Counter(said(text))) for doc_id, text in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    rows = []
    for item_id, text in items:
        scores = []
        for place, ((doc_id, c), n) in enumerate(zip(counted, lengths)):
            m = 25 + (75 * n * n_docs) // max(1, n_terms)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in said(text)
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, place))
        rows += [(item_id, r, d if known else None, -s) for r, (s, known, d, _) in enumerate(sorted(scores)[:k], 1)]
    return Counter(rows)


def corpus(n, seed, vocabulary=400):
    """Documents of Zipf-like words; some passages are in several of them."""
    rng = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"Wé{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    docs = [(i, " ".join(rng.choices(words, weights, k=int(rng.paretovariate(0.7)) % 500))) for i in range(n)]
    for i in range(0, n, 17):
        docs[i] = (docs[i][0], docs[3][1] + "-" + docs[i][1])
    return docs, [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(25)]


def searched(spark, docs, items, **size):
    table = spark.createDataFrame(docs, "doc_id long, text string")
    index = written(block_search.build_index(table, **size), "test-index")
    return Counter(map(tuple, block_search.search(index, spark.createDataFrame(items, ITEM), query_terms=size and 60 or 50_000).collect()))


@pytest.mark.parametrize("size", [{}, {"shard_docs": 40}, {"shard_docs": 7, "shard_bytes": 500}])
def test_search_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(block_search, "STRETCH", 64)
    docs, items = corpus(600, 1)
    assert searched(spark, docs, items, **size) == brute(docs, items)


def test_search_of_odd_rows(spark):
    """Nulls, repeated ids and rows, ties, long texts, repeated queries and queries without terms."""
    docs = [(None, "alpha beta"), (None, "alpha beta"), (5, "alpha beta"), (5, "alpha beta"), (2, "Alpha, BETA"), (7, None), (8, ""), (9, "--")]
    docs += [(10 + i, "alpha beta") for i in range(12)] + [(40, "gamma " * 200_000 + "delta"), (41, "K K ß SS")]
    items = [(1, "alpha"), (1, "alpha"), (None, "beta beta"), (2, None), (3, ""), (4, "nowhere"), (5, "delta gamma K")]
    got = searched(spark, docs, items)
    want = brute(docs, items)
    assert {k: v for k, v in got.items()} == {k: v for k, v in want.items()}


def test_search_with_clashing_columns_and_of_nothing(spark, documents, no_documents):
    items = spark.createDataFrame([(1, "the quick fox"), (2, "x")], ITEM)
    clashing = items.select("*", *(F.lit("x").alias(n) for n in ("query", "term", "rank", "score", "number", "shard")))
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = Counter(map(tuple, block_search.ranked_search(documents, clashing).collect()))
    assert got == brute(rows, [(1, "the quick fox"), (2, "x")])
    assert block_search.ranked_search(no_documents, items).count() == 0
    assert block_search.ranked_search(documents, items.where("item_id > 9")).count() == 0


def lists_of(seed):
    rng = np.random.default_rng(seed)
    shard = block_search.Shard()
    words = [b"t%d" % i for i in range(30)]
    chances = 1 / np.arange(1, 31)
    for i in range(3000):
        shard.add(i, " ".join(w.decode() for w in rng.choice(words, rng.integers(0, 40), p=chances / chances.sum())))
    rows = [r for batch in shard.rows(0) for r in batch.to_pylist()]
    total = (3000, rows[0]["n_tokens"])
    norms = block_search.norm(np.frombuffer(rows[0]["lengths"], "<u4").astype(np.int64), total)
    return rows, total, norms


def test_candidates_go_before_their_blocks_are_decompressed(monkeypatch):
    """With a threshold, the same best documents from fewer blocks."""
    rows, total, norms = lists_of(2)
    read = []
    gains = block_search.impact
    monkeypatch.setattr(block_search, "impact", lambda tf, norms: (read.append(len(tf)), gains(tf, norms))[1])
    rows = sorted(rows[1:], key=lambda r: r["n_docs"])
    rows = rows[:2] + rows[-6:]

    def run(least):
        weights = [math.floor(1000 * math.log((2 * total[0] + 2) / (2 * r["n_docs"] + 1))) for r in rows]
        lists = [(w, block_search.Postings(r, total, norms)) for w, r in zip(weights, rows)]
        read.clear()
        places, scores = block_search.search_shard(lists, 3000, least)
        return dict(zip(places.tolist(), scores.tolist())), sum(read)

    every, most_read = run(1)
    tenth = sorted(every.values(), reverse=True)[9]
    got, few_read = run(tenth)
    assert all(every[p] == s for p, s in got.items() if s >= tenth)
    assert {p for p, s in got.items() if s >= tenth} == {p for p, s in every.items() if s >= tenth}
    assert most_read == sum(r["n_docs"] for r in rows) and few_read < 0.8 * most_read


def test_some_blocks_are_the_same_part_of_the_whole():
    rows, total, norms = lists_of(3)
    for r in rows[1:4]:
        p = block_search.Postings(r, total, norms)
        n = len(p.last)
        blocks = np.array([b for b in range(0, n, 5)])
        places, gains = p.some(blocks)
        all_places, all_gains = block_search.Postings(r, total, norms).all()
        chosen = np.isin(np.arange(len(all_places)) // block_search.BLOCK, blocks)
        assert (places == all_places[chosen]).all() and (gains == all_gains[chosen]).all()
        assert all(all_gains[i] <= p.most[i // block_search.BLOCK] for i in range(len(all_gains)))
