"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of its labelled text
recognises every substring of that text. A document is parsed against each
automaton: a phrase goes on as long as the sample holds it, then the next
begins. The fewer phrases a language needs, each weighed by the bits that
name a place in its sample, the closer the text; the language with the lowest
number of bits a letter wins (ties: the smaller name).

Texts are lower-cased and reduced to letters with one space between words.
A text is parsed whole, in blocks of ``BLOCK`` letters that each begin a new
phrase, so all blocks of a batch advance together, one letter a step; this
adds at most one phrase a block, the same for every language. Every letter of
the samples is a symbol of its own; a letter that a language's sample lacks
ends a phrase there.

Bounds of the fit (parameters): the ``languages`` values of lang with the most
labelled rows (ties: the smaller name); ``sample_rows`` documents of each, the
smallest by a hash of their id, rows of one id by their text; a longer one
than ``sample_chars`` characters, or than a language's share of
``sample_letters``, lends a window of that size, at a place by the same hash
(from its first letter on where that window has none); ``sample_letters``
letters over all languages, shared evenly, whole short texts first. So of
those languages every one with a letter in its labelled texts is learned, and
the broadcast samples and the automata are bounded whatever lang holds. A
worker builds the automata once.

Defined results: a null text, a text without a letter, or no language learned:
``und`` with score 0; with one language learned, its score is 1. Rows without
lang or text teach nothing; a null doc_id counts as empty text for the fold.
Every row gives a row; an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.llm.common import first_by_hash, key_fold

LANGUAGES = 400
SAMPLE_ROWS = 24
SAMPLE_CHARS = 6_000
SAMPLE_LETTERS = 120_000

# Letters of a block; blocks that advance together.
BLOCK = 512
LANES = 4096

# Entries of the table of steps for each step; places tried for a state before it gets a row of its own.
ROOM, TRIES = 4, 100


class SuffixAutomaton:
    """The automaton of all substrings of a row of small integers."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def extend(self, symbol: int) -> None:
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[self.last] + 1)
        self.link.append(0)
        p = self.last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][symbol]
            if self.length[p] + 1 < self.length[q]:
                # Shorter occurrences of q's text continue in other ways: they get a state of their own.
                short = len(self.next)
                self.next.append(dict(self.next[q]))
                self.length.append(self.length[p] + 1)
                self.link.append(self.link[q])
                while p >= 0 and self.next[p].get(symbol) == q:
                    self.next[p][symbol] = short
                    p = self.link[p]
                self.link[q] = short
                q = short
            self.link[new] = q
        self.last = new


class Steps:
    """The steps of many states in one sparse table.

    A state is named by the place where its row begins, and rows of different
    states lie between each other: the step by a symbol is the entry at state
    + symbol, if that entry names the state. Rows with the most steps are
    placed first.
    """

    def __init__(self, states: list[dict[int, int]], width: int):
        size = ROOM * sum(map(len, states)) + len(states) + 1
        taken, begun = bytearray(size + width), bytearray(size)
        draw = random.Random(0).random
        place = np.zeros(len(states), np.int64)
        for s in sorted(range(len(states)), key=lambda s: -len(states[s])):
            for _ in range(TRIES):
                at = int(draw() * size)
                if not begun[at] and not any(taken[at + c] for c in states[s]):
                    begun[at] = 1
                    break
            else:
                at = len(taken)
                taken += bytes(width)
            for c in states[s]:
                taken[at + c] = 1
            place[s] = at
        # An entry holds the state that it belongs to and the state that it leads to.
        self.place, self.entries = place, np.full(len(taken), -1, np.int64)
        count = np.fromiter(map(len, states), np.int64, len(states))
        symbols = np.fromiter((c for row in states for c in row), np.int64, int(count.sum()))
        to = np.fromiter((t for row in states for t in row.values()), np.int64, int(count.sum()))
        owner = np.repeat(place, count)
        self.entries[owner + symbols] = (owner << 32) | place[to]


class Parser:
    """Parses texts against the samples of several languages at once."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        texts = {lang: [t.lower() for t in samples[lang]] for lang in self.languages}
        own = sorted({c for found in texts.values() for t in found for c in t if c.isalpha()})
        # Symbol of every code point: 0 for what is no letter, the last one for letters that no sample has.
        self.width = len(own) + 2
        self.kind = np.zeros(0x110000, np.int32)
        self.kind[[i for i in range(0x110000) if chr(i).isalpha()]] = self.width - 1
        self.kind[[ord(c) for c in own]] = np.arange(1, len(own) + 1)
        states: list[dict[int, int]] = []
        roots, self.bits = [], []
        for lang in self.languages:
            automaton, letters = SuffixAutomaton(), 0
            for text in texts[lang]:
                symbols, _ = self.symbols([text])
                # A symbol that no text has keeps phrases from running over into the next document.
                for s in (*symbols.tolist(), self.width):
                    automaton.extend(s)
                letters += len(symbols)
            roots.append(len(states))
            self.bits.append(np.log2(letters + 2))
            first = len(states)
            states += [{s: first + to for s, to in found.items() if s < self.width} for found in automaton.next]
        steps = Steps(states, self.width)
        self.entries = steps.entries
        self.roots = steps.place[roots][:, None]
        # Where a new phrase that begins with a symbol goes on.
        self.begin = np.repeat(self.roots, self.width, axis=1)
        for row, root in zip(self.begin, roots):
            for s, to in states[root].items():
                row[s] = steps.place[to]

    def symbols(self, lowered: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all texts in a row, one 0 between words, and the count of each text."""
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kind[points]
        text = np.repeat(np.arange(len(lowered)), [len(t) for t in lowered])
        kept = kinds > 0
        # The first of a run of other characters stands for the space, unless it begins the text.
        kept[1:] |= (kinds[:-1] > 0) & (text[1:] == text[:-1])
        return kinds[kept], np.bincount(text[kept], minlength=len(lowered))

    def phrases(self, lowered: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases of each text in each language, symbols of each text)."""
        symbols, counts = self.symbols(lowered)
        starts = np.cumsum(counts) - counts
        n_blocks = -(-counts // BLOCK)
        text = np.repeat(np.arange(len(lowered)), n_blocks)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        begin = starts[text] + nth * BLOCK
        size = np.minimum(BLOCK, counts[text] - nth * BLOCK)
        order = np.argsort(-size, kind="stable")
        out = np.zeros((len(self.languages), len(lowered)))
        padded = np.concatenate([symbols, np.zeros(BLOCK, symbols.dtype)])
        for at in range(0, len(order), LANES):
            lanes = order[at : at + LANES]
            sizes = size[lanes]
            letters = np.ascontiguousarray(padded[begin[lanes][:, None] + np.arange(sizes[0])].T)
            state = np.repeat(self.roots, len(lanes), axis=1)
            ended = np.zeros(state.shape, np.int32)
            # Blocks are sorted by size, so those that go on come first.
            going = len(lanes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), side="right")
            for step, m in enumerate(going.tolist()):
                now, letter = state[:, :m], letters[step, :m]
                entry = self.entries.take(now + letter)
                missing = (entry >> 32) != now
                ended[:, :m] += missing
                state[:, :m] = np.where(missing, self.begin.take(letter, axis=1), entry & 0xFFFFFFFF)
            ended += state != self.roots
            for row, e in enumerate(ended):
                out[row] += np.bincount(text[lanes], weights=e, minlength=len(lowered))
        return out, counts

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        lowered = [t.lower() for t in texts]
        phrases, counts = self.phrases(lowered)
        bits = phrases * np.array(self.bits)[:, None] / np.maximum(counts, 1)
        best = bits.argmin(axis=0)
        least = bits.min(axis=0)
        if len(self.languages) > 1:
            second = np.partition(bits, 1, axis=0)[1]
            score = second / np.maximum(least + second, 1e-300)
        else:
            score = np.ones(len(texts))
        known = counts > 0
        return (
            [self.languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())],
            [s if k else 0.0 for s, k in zip(score.tolist(), known.tolist())],
        )


# One parser for each set of samples in this Python worker.
_PARSERS: dict[int, Parser] = {}


def learn(
    labelled: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    sample_chars: int = SAMPLE_CHARS,
    sample_letters: int = SAMPLE_LETTERS,
    languages: int = LANGUAGES,
) -> dict[str, list[str]]:
    """Sampled texts of each language of (doc_id, text, lang)."""
    letter = F.lit(r"\p{L}")
    usable = labelled.where(F.col("lang").isNotNull() & F.rlike("text", letter))
    often = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    found: dict[str, list[str]] = {lang: [] for lang in sorted(r["lang"] for r in often.collect())}
    if not found:
        return found
    share = max(1, sample_letters // len(found))
    size = min(sample_chars, share)
    # Cut before the sample is taken, so no whole long text moves.
    length = F.char_length("text")
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(length - size + 1, F.lit(1))).cast("int")
    window = F.substring(F.col("text"), place + 1, F.lit(size))
    cut = (
        F.when(length <= size, F.col("text"))
        .when(F.rlike(window, letter), window)
        .otherwise(F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{size - 1}}}", 0))
    )
    known = usable.where(F.col("lang").isin(list(found))).select("doc_id", cut.alias("text"), "lang")
    rows = first_by_hash(known, "doc_id", sample_rows, ["lang"], ["text"]).collect()
    for r in sorted(rows, key=lambda r: (r["lang"], len(r["text"]), r["doc_id"] is None, r["doc_id"], r["text"])):
        if sum(map(len, found[r["lang"]])) + len(r["text"]) <= share:
            found[r["lang"]].append(r["text"])
    return found


def identify(docs: DataFrame, samples: dict[str, list[str]], batch_rows: int = 1000) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score. A map without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(str(shared.value))
        if key not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[key] = Parser(shared.value)
        parser = _PARSERS[key]
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                texts = part.column("text").to_pylist()
                lang, score = parser.predict(texts) if parser.languages else (["und"] * len(texts), [0.0] * len(texts))
                columns = [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def held_out_languages(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Learns from all folds but one and identifies every document: doc_id, held_out, lang_pred, score."""
    held = key_fold(F.col("doc_id"), folds) == fold
    samples = learn(docs.where(~held))
    return identify(docs, samples).select("doc_id", held.alias("held_out"), "lang_pred", "score")
