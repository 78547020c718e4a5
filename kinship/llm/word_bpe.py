"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word is a row of symbols. The leaf ``i`` of the tree holds the rank of the
pair that begins at symbol ``i`` (or infinity), an inner node the smaller of
its two children by (rank, place), so the root is the leftmost pair of lowest
rank. A merge changes three leaves at most: the merged pair's own, its left
neighbour's and the leaf of the symbol that is gone. A word of n symbols is
therefore encoded in O(n log n), also one of a hundred thousand symbols. The
words that an Arrow batch brings for the first time are merged together, a
step of every word at once, in numpy.

The model file (JSON: normaliser, split pattern, byte alphabet, merges, word
end suffix) is read by the driver from a given path and broadcast; it is a
fixed public vocabulary of a few MB. Each Python worker keeps the encodings of
chunks it has met, at most about ``KEPT_CHUNKS`` of them.

Defined results: a null text counts as empty; an empty text has no tokens and
decodes to an empty text; a special token's string in a text is encoded as
that token, as the public library does by default; every row gives a row, also
repeated ones; an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Chunks of text whose encodings a worker keeps; with more, it starts anew.
KEPT_CHUNKS = 150_000

# Words of more bytes than LONG are merged one by one.
LONG = 64

# Symbols of the words that are merged together.
CELLS = 400_000

NEVER = 1 << 62

# What Python splits at and Unicode does not count as white space.
NO_SPACE = regex.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\p{White_Space}+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others, in order, for
    the characters from U+0100.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


# Ranges of letters and numbers that Unicode got after version
# 16, the version of the public library. There they are neither.
LATER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)


# Capitals that the public library lower-cases and Python does not know yet, with their small letters.
CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
CAPITALS |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
NEW_CAPITAL = regex.compile("[" + "".join(map(chr, CAPITALS)) + "]")


def without_later(pattern: str) -> str:
    """``pattern`` with its letter and number classes less the characters of ``LATER``."""
    less = "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER)
    for name in (r"\p{L}", r"\p{N}"):
        pattern = pattern.replace(name, f"[{name}--[{less}]]")
    return pattern


class PairTree:
    """Segment tree of one word: the smallest of a row of keys, with point updates."""

    def __init__(self, keys: list[int]):
        self.width = width = 1 << max(0, len(keys) - 1).bit_length()
        self.node = node = [NEVER] * (2 * width)
        node[width : width + len(keys)] = keys
        for i in range(width - 1, 0, -1):
            node[i] = min(node[2 * i], node[2 * i + 1])

    def update(self, place: int, key: int) -> None:
        node, i = self.node, self.width + place
        node[i] = key
        while i > 1:
            low = min(node[i], node[i ^ 1])
            i >>= 1
            if node[i] == low:
                return
            node[i] = low


class PairTrees:
    """Segment trees of many words of up to ``width`` pairs, one row of nodes a word.

    Node 1 is the root, nodes 2k and 2k + 1 are the children of node k, and
    the leaves begin at ``width``. All words take a step at once.
    """

    def __init__(self, keys: np.ndarray):
        self.rows, self.width = keys.shape
        self.node = np.full((self.rows, 2 * self.width), NEVER, np.int64)
        self.node[:, self.width :] = keys
        at = self.width
        while at > 1:
            self.node[:, at // 2 : at] = np.minimum(self.node[:, at : 2 * at : 2], self.node[:, at + 1 : 2 * at : 2])
            at //= 2

    def roots(self) -> np.ndarray:
        return self.node[:, 1]

    def update(self, rows: np.ndarray, places: np.ndarray, keys: np.ndarray) -> None:
        """Sets leaves, then the nodes above them, level by level."""
        at = places + self.width
        self.node[rows, at] = keys
        while at.size and at[0] > 1:
            at = at >> 1
            self.node[rows, at] = np.minimum(self.node[rows, 2 * at], self.node[rows, 2 * at + 1])


class WordBpe:
    """Encoder and decoder of one vocabulary file, given as its JSON text."""

    def __init__(self, model_json: str):
        spec = json.loads(model_json)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.base = 1 + max(self.token)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        codes = np.array([self.vocab[a] * self.base + self.vocab[b] for a, b in pairs], np.int64)
        self.by_code = np.argsort(codes, kind="stable")
        self.codes = codes[self.by_code]
        self.pairs = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.ascii_words = regex.compile(split["pattern"]["Regex"])
        self.words = regex.compile(without_later(split["pattern"]["Regex"]), regex.V1)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        alphabet = byte_alphabet()
        self.byte = [self.vocab[c] for c in alphabet]
        self.last_byte = [self.vocab[c + self.suffix] for c in alphabet]
        self.kept: dict[str, bytes] = {}

    def normalise(self, text: str) -> str:
        """Composed and lower-cased one character at a time: a capital sigma at a word's end is an ordinary sigma."""
        if text.isascii():
            return text.lower()
        if NEW_CAPITAL.search(text):
            text = text.translate(CAPITALS)
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def symbols(self, word: bytes) -> list[int]:
        return [*map(self.byte.__getitem__, word[:-1]), self.last_byte[word[-1]]]

    def keys(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, span: int) -> np.ndarray:
        """rank * span + place of each pair of symbols; infinity for pairs that never merge."""
        code = left * self.base + right
        i = np.minimum(np.searchsorted(self.codes, code), self.codes.size - 1)
        known = (self.codes[i] == code) & (left >= 0) & (right >= 0)
        return np.where(known, self.by_code[i] * span + place, NEVER)

    def merge(self, ids: np.ndarray) -> np.ndarray:
        """Rows of symbols, padded with -1 at the end -> the same after all merges, -1 where one is gone.

        The leftmost pair of lowest rank merges first, in every row by itself.
        """
        rows, n = ids.shape
        width = 1 << max(0, n - 2).bit_length()
        place = np.arange(n - 1)
        keys = np.full((rows, width), NEVER, np.int64)
        keys[:, : n - 1] = self.keys(ids[:, :-1], ids[:, 1:], place, n)
        trees = PairTrees(keys)
        # One more column each, so that a missing neighbour needs no case of its own.
        symbol = np.concatenate([ids, np.full((rows, 1), -1, np.int64)], axis=1)
        after = np.tile(np.arange(1, n + 2), (rows, 1))
        after[:, n] = n
        before = np.tile(np.arange(-1, n), (rows, 1))
        while True:
            roots = trees.roots()
            row = np.flatnonzero(roots < NEVER)
            if not row.size:
                return symbol[:, :n]
            rank, i = np.divmod(roots[row], n)
            gone = after[row, i]
            j = after[row, gone]
            symbol[row, i], symbol[row, gone] = self.made[rank], -1
            after[row, i] = j
            before[row, j] = i
            h = before[row, i]
            left, right = symbol[row, np.maximum(h, 0)], symbol[row, i]
            h_key = np.where(h >= 0, self.keys(left, right, h, n), NEVER)
            i_key = self.keys(right, symbol[row, j], i, n)
            # The last symbol has no leaf, and the first no left neighbour: those update the leaf i once more.
            has_leaf, has_left = gone < n - 1, h >= 0
            trees.update(
                np.concatenate([row, row, row]),
                np.concatenate([np.where(has_leaf, gone, i), np.where(has_left, h, i), i]),
                np.concatenate([np.where(has_leaf, NEVER, i_key), np.where(has_left, h_key, i_key), i_key]),
            )

    def merge_one(self, ids: list[int]) -> list[int]:
        """The same as :meth:`merge` for one long row."""
        n = len(ids)
        found = [self.pairs.get(pair) for pair in zip(ids, ids[1:])]
        tree = PairTree([NEVER if f is None else f[0] * n + i for i, f in enumerate(found)])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def renew(i: int) -> None:
            j = after[i]
            f = self.pairs.get((ids[i], ids[j])) if j < n else None
            tree.update(i, NEVER if f is None else f[0] * n + i)

        while (key := tree.node[1]) < NEVER:
            rank, i = divmod(key, n)
            gone = after[i]
            ids[i], ids[gone] = int(self.made[rank]), -1
            after[i] = j = after[gone]
            if j < n:
                before[j] = i
            if gone < n - 1:
                tree.update(gone, NEVER)
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word. Words of like length are merged together."""
        out: list[bytes] = [b""] * len(words)
        raw = [w.encode("utf-8") for w in words]
        classes: dict[int, list[int]] = {}
        for k, r in enumerate(raw):
            classes.setdefault(max(0, len(r) - 2).bit_length(), []).append(k)
        for members in classes.values():
            longest = max(len(raw[k]) for k in members)
            if longest > LONG:
                for k in members:
                    out[k] = np.array(self.merge_one(self.symbols(raw[k])), "<u4").tobytes()
                continue
            block = max(1, CELLS // longest)
            for start in range(0, len(members), block):
                part = members[start : start + block]
                ids = np.full((len(part), max(2, longest)), -1, np.int64)
                for row, k in enumerate(part):
                    r = raw[k]
                    ids[row, : len(r)] = self.symbols(r)
                merged = self.merge(ids)
                alive = merged >= 0
                flat = merged[alive].astype("<u4").tobytes()
                ends = 4 * np.cumsum(alive.sum(axis=1))
                at = 0
                for k, end in zip(part, ends.tolist()):
                    out[k] = flat[at:end]
                    at = end
        return out

    def learn(self, chunks: set[str]) -> None:
        """Keeps the packed ids of each chunk of text without white space."""
        words_of = {c: (self.ascii_words if c.isascii() else self.words).findall(c) for c in chunks}
        words = list({w for found in words_of.values() for w in found})
        ids = dict(zip(words, self.encode_words(words)))
        for c, found in words_of.items():
            self.kept[c] = b"".join([ids[w] for w in found])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids (little-endian unsigned 32-bit) of each text.

        Texts are cut at special tokens, then at white space, which is part
        of no token; each different chunk is merged once.
        """
        rows: list[list[str]] = []
        for text in texts:
            chunks: list[str] = []
            for piece in self.specials.split(text) if self.specials and "<" in text else (text,):
                if piece in self.special:
                    chunks.append(piece)
                else:
                    body = self.normalise(piece)
                    chunks += SPACE.split(body) if NO_SPACE.search(body) else body.split()
            rows.append(chunks)
        if len(self.kept) > KEPT_CHUNKS:
            self.kept.clear()
        if not self.kept:
            # Only the exact string is a special token; normalised text never holds it, as it is cut out before.
            self.kept.update({t: np.array([i], "<u4").tobytes() for t, i in self.special.items()})
        self.learn(set().union(*rows) - self.kept.keys())
        return [b"".join(map(self.kept.__getitem__, chunks)) for chunks in rows]

    def decode(self, ids: bytes) -> str:
        """Tokens joined by spaces: the file names no decoder, and the public library then joins so."""
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


# One coder for each vocabulary in this Python worker.
_CODERS: dict[int, WordBpe] = {}


def _coder(model_json: str) -> WordBpe:
    key = hash(model_json)
    if key not in _CODERS:
        _CODERS[key] = WordBpe(model_json)
    return _CODERS[key]


def encode_decode(docs: DataFrame, model_path: str, batch_rows: int = 500) -> DataFrame:
    """One row per document row: doc_id, ids (binary: little-endian unsigned 32-bit), decoded (text).

    A map over the documents without a shuffle; results leave a worker
    ``batch_rows`` rows at a time.
    """
    with open(model_path, encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model.value)
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                packed = coder.encode(part.column("text").to_pylist())
                decoded = [coder.decode(ids) for ids in packed]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(packed, pa.binary()), pa.array(decoded, pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def digest(coded: DataFrame) -> DataFrame:
    """Columns of the registered query, from what :func:`encode_decode` returns."""
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
