"""Token counts against the public library."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

from kinship.llm import queries, token_counts

PATH = queries.tokenizer_file(queries.BYTE_BPE)
BITS = [
    "'s", "'", "re", "'ve", "ll", "l", " ", "  ", "\n", "\t", " \n", "a", "the", "1", "23", "é", "漢字", "。", "<|endoftext|>", "<|endof",
    "|>", "<", "|", "　", "'t", "'re ", "!", "...", "==", "ß", "٣", "𝔘", "😀", "\x1c", "\x85", "aaaa", "    ", "'ll'", "d'", "\x00", "۞",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def machine():
    with open(PATH, encoding="utf-8") as file:
        return token_counts.Transducer(file.read())


def mixed_texts(n, most):
    rng = random.Random(3)
    return ["".join(rng.choices(BITS, k=rng.randint(0, most))) for _ in range(n)]


def test_the_machine_counts_as_the_library(machine, library):
    texts = mixed_texts(10_000, 14)
    want = library(texts)
    assert [machine.run(t) for t in texts] == want and [machine.count(t) for t in texts] == want


def test_transitions_add_up_after_every_character(machine, library):
    for text in mixed_texts(30, 20):
        prefixes = [text[:i] for i in range(len(text) + 1)]
        assert [machine.run(p) for p in prefixes] == library(prefixes)


def test_every_code_point(machine, library):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for pattern in ("a{}", " {}{}'s"):
        texts = [pattern.format(c, c) for c in chars]
        assert [machine.run(t) for t in texts] == library(texts)


def test_maps_compose_in_any_grouping(machine, library):
    rng = random.Random(4)
    for text in [*mixed_texts(60, 60), "x" * 300, " " * 50 + "|" * 40, "a|b<|endoftext|>c|d" * 9]:
        cuts = sorted(rng.randint(0, len(text)) for _ in range(rng.randint(0, 12)))
        maps = [machine.map_of(text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)])]
        while len(maps) > 1:
            i = rng.randrange(len(maps) - 1)
            maps[i : i + 2] = [machine.compose(maps[i], maps[i + 1])]
        assert machine.total(maps[0]) == library([text])[0]


def test_states_may_be_forgotten(machine, library, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_STATES", 20)
    monkeypatch.setattr(token_counts, "KEPT_PIECES", 20)
    texts = mixed_texts(200, 30)
    assert [machine.count(t) for t in texts] == library(texts)


@pytest.mark.parametrize("sizes", [(50_000, 20_000), (40, 7)])
def test_counts_of_rows(spark, small, documents, library, sizes, monkeypatch):
    """Whole tables, also where nearly every text is dealt in stretches and composed in several rounds."""
    monkeypatch.setattr(token_counts, "FAN", 3)
    docs = small("documents").select("doc_id", "text") if sizes[1] > 7 else small("documents").select("doc_id", "text").limit(20)
    odd = documents.select("doc_id", "text", "row", "rank")
    for table in (docs, odd):
        rows = [(r["doc_id"], r["text"] or "") for r in table.collect()]
        want = Counter((i, len(t.encode()), n, n > 1024) for (i, t), n in zip(rows, library([t for _, t in rows])))
        assert Counter(map(tuple, token_counts.limits(token_counts.token_counts(table, PATH, *sizes)).collect())) == want


def test_counts_of_nothing(no_documents):
    got = token_counts.limits(token_counts.token_counts(no_documents, PATH))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and got.count() == 0
