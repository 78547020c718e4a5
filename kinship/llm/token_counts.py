"""Token counts by a tokenizer compiled to a deterministic transducer.

The byte-level BPE of a vocabulary file, with its split of the text into
words, becomes one machine over characters. Each transition carries a number,
and the numbers along a text add up to its tokens: after every character the
sum is the count for the text so far. A transition may carry a negative
number, where a byte turns several tokens into one. States and transitions
are determinised when a text first needs them and then kept.

* A word's state holds, for each suffix that some longer token may begin
  with, its place in the trie of tokens, the token before it, and how many
  tokens less the text before it has. Tokens of a prefix are unique: the last
  one is the only token that may stand after the token before it, and two
  tokens may stand together when no merge crosses the border between them.
  So a byte needs only these few suffixes, never the word from its beginning.
* The split's look-ahead (the last white space before a word joins the word,
  contractions, special tokens) becomes states that remember what the count
  was some characters ago.

A text is cut where a letter or digit meets white space or a mark that no
special token has inside: there a word ends and the next character begins one
whatever came before, so the machine is in its first state again. The state
map of a stretch of text is therefore (head, count, tail): what stands before
its first cut, the tokens between its first and last cut, and what stands
behind. Maps compose in any grouping. Texts of more than ``long_bytes``
bytes are dealt over the tasks in stretches of ``slice_chars``, whose
maps are composed by a tree of ``FAN`` neighbours a round, so a very long
text is no task of its own.

Defined results: a null text counts as empty, and an empty text has no
tokens; every row gives a row, also repeated ones; an empty table gives none;
further columns are ignored. The vocabulary file is read by the driver and
broadcast; it is a fixed public file of a few MB.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.llm.common import written
from kinship.llm.word_bpe import byte_alphabet, without_later

LONG_BYTES = 50_000
SLICE_CHARS = 20_000
FAN = 32

# What a worker keeps: counts of pieces of text of up to PIECE characters, and
# states of the machine; with more, it starts anew.
PIECE = 48
KEPT_PIECES = 400_000
KEPT_STATES = 200_000

# Letters and digits before a cut (blocks without anything else), and white space and marks after it.
BEFORE = "0-9A-Za-zÀ-ÖØ-öø-ɏЀ-ҁぁ-ゖ一-龥가-힣"
AFTER = "\t-\r !-/:-@\\[-`{}~‐-‧　-。"

# Modes of the split.
FRESH, LETTERS, NUMBERS, OTHERS, WHITE, APOSTROPHE, CONTRACTION = range(7)


class Merges:
    """The vocabulary's merges: bytes are tokens 0 to 255, the merge of rank r makes token 256 + r."""

    def __init__(self, spec: dict):
        alphabet = byte_alphabet()
        token = {c: b for b, c in enumerate(alphabet)}
        self.parts: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.pair: dict[tuple[int, int], int] = {}
        # The trie of tokens: node * 256 + byte -> node; what token ends at a node.
        self.child: dict[int, int] = {}
        self.ends: list[int] = [-1]
        self.inner: set[int] = {0}
        byte = {c: b for b, c in enumerate(alphabet)}
        for c in alphabet:
            self._grow((byte[c],), token[c])
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            made = token[a + b] = 256 + rank
            self.parts.append((token[a], token[b]))
            self.pair[token[a], token[b]] = made
            self._grow([byte[c] for c in a + b], made)
        self._meet: dict[tuple[int, int], bool] = {}

    def _grow(self, path, token: int) -> None:
        node = 0
        for b in path:
            key = node * 256 + b
            if key not in self.child:
                self.inner.add(node)
                self.child[key] = len(self.ends)
                self.ends.append(-1)
            node = self.child[key]
        self.ends[node] = token

    def meet(self, left: int, right: int) -> bool:
        """Whether the two tokens may stand side by side: no merge ever crosses their border.

        The two derivations are undone from their last merge on. Between two
        steps a pair stands at the border; it would have merged if its rank
        came before the step undone last. Of merges of the same rank the left
        one comes first.
        """
        key = (left, right)
        known = self._meet.get(key)
        if known is None:
            if len(self._meet) > KEPT_PIECES:
                self._meet.clear()
            until = len(self.parts) + 1
            while True:
                known = self.pair.get((left, right), until) >= until
                if not known or (left < 256 and right < 256):
                    break
                if left > right:
                    left, until = self.parts[left][1], left
                else:
                    right, until = self.parts[right][0], right + 1
            self._meet[key] = known
        return known


class Transducer:
    """The machine over characters, compiled as texts need it."""

    def __init__(self, model_json: str):
        spec = json.loads(model_json)
        self.merges = Merges(spec)
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(x in y for x in self.special for y in self.special if x is not y):
            raise ValueError("special tokens inside one another are not supported")
        # A special token is met character by character, so one that begins anew inside itself is refused.
        if any(t[0] in t[1:] for t in self.special):
            raise ValueError("a special token that repeats its first character is not supported")
        self.cut = re.compile(f"(?<=[{BEFORE}])(?=[{AFTER}])")
        if any(self.cut.search(t) for t in self.special):
            raise ValueError("a special token has a place at which texts are cut")
        self.kinds = [
            (regex.compile(without_later(r"\p{L}"), regex.V1), LETTERS),
            (regex.compile(without_later(r"\p{N}"), regex.V1), NUMBERS),
            (regex.compile(r"\p{White_Space}"), WHITE),
        ]
        self.kind: dict[str, int] = {}
        self.counts: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        # Word states: an id for each tuple of live suffixes; transitions by id * 256 + byte.
        self.words: dict[tuple, int] = {}
        self.live: list[tuple] = []
        self.word_step: dict[int, tuple[int, int]] = {}
        self.empty = self._word(((0, -1, 0),))
        # States of the whole machine, with a dictionary of transitions each.
        self.states: dict[tuple, int] = {}
        self.known: list[tuple] = []
        self.step: list[dict[str, tuple[int, int]]] = []
        self.first = self._state((FRESH, self.empty, (), ()))

    def _word(self, live: tuple) -> int:
        if live not in self.words:
            self.words[live] = len(self.live)
            self.live.append(live)
        return self.words[live]

    def _state(self, state: tuple) -> int:
        if state not in self.states:
            self.states[state] = len(self.known)
            self.known.append(state)
            self.step.append({})
        return self.states[state]

    def _byte(self, word: int, b: int) -> tuple[int, int]:
        """The word's state after one more byte, and the tokens gained."""
        key = word * 256 + b
        found = self.word_step.get(key)
        if found is None:
            m = self.merges
            grown = [(m.child.get(node * 256 + b, 0), before, less) for node, before, less in self.live[word]]
            grown = [suffix for suffix in grown if suffix[0]]
            last, gain = next(
                (m.ends[node], less + 1)
                for node, before, less in grown
                if m.ends[node] >= 0 and (before < 0 or m.meet(before, m.ends[node]))
            )
            live = [(node, before, less - gain) for node, before, less in grown if node in m.inner]
            found = self.word_step[key] = (self._word((*live, (0, last, 0))), gain)
        return found

    def _char(self, word: int, char: str) -> tuple[int, int]:
        gained = 0
        for b in char.encode("utf-8", "surrogatepass"):
            word, gain = self._byte(word, b)
            gained += gain
        return word, gained

    def _kind(self, char: str) -> int:
        if char not in self.kind:
            self.kind[char] = next((kind for pattern, kind in self.kinds if pattern.match(char)), OTHERS)
        return self.kind[char]

    def _begin(self, char: str) -> tuple[int, int, tuple, int]:
        """(mode, word, memory, tokens) of a word that begins with ``char``."""
        kind = self._kind(char)
        word, gain = self._char(self.empty, char)
        if kind == WHITE:
            return WHITE, word, (-gain, char == " ", gain), gain
        return (APOSTROPHE if char == "'" else kind), word, (), gain

    def _split(self, mode: int, word: int, memory: tuple, char: str) -> tuple[int, int, tuple, int]:
        """The split and the word after one more character: (mode, word, memory, tokens gained)."""
        kind = self._kind(char)
        if mode == WHITE:
            less, is_space, alone = memory
            if kind == WHITE:
                word, gain = self._char(word, char)
                return WHITE, word, (-gain, char == " ", self._char(self.empty, char)[1]), gain
            # The last white space leaves the run: a space joins the word, another one stands alone.
            if is_space:
                space, one = self._char(self.empty, " ")
                word, gain = self._char(space, char)
                return kind, word, (), less + one + gain
            mode, word, memory, gain = self._begin(char)
            return mode, word, memory, less + alone + gain
        if mode == APOSTROPHE:
            if char in "stmd":
                return FRESH, self.empty, (), self._char(word, char)[1]
            if char in "rvl":
                _, word, _, gain = self._begin(char)
                return CONTRACTION, word, (char, -gain), gain
            mode = OTHERS
        if mode == CONTRACTION:
            first, less = memory
            if first + char in ("re", "ve", "ll"):
                begun, _ = self._char(self.empty, "'")
                begun, one = self._char(begun, first)
                return FRESH, self.empty, (), less + one + self._char(begun, char)[1]
            mode = LETTERS
        if mode == kind:
            word, gain = self._char(word, char)
            return mode, word, (), gain
        return self._begin(char)

    def _follow(self, state: int, char: str) -> tuple[int, int]:
        mode, word, memory, partial = self.known[state]
        mode, word, memory, gain = self._split(mode, word, memory, char)
        # Special tokens that the text may be inside: which, how far, and how many tokens less before it.
        ahead = []
        for which, at, less in (*partial, *((i, 0, 0) for i in range(len(self.special)))):
            if self.special[which][at] == char:
                if at + 1 == len(self.special[which]):
                    return self.first, less + 1
                ahead.append((which, at + 1, less - gain))
        return self._state((mode, word, memory, tuple(ahead))), gain

    def run(self, text: str) -> int:
        """Tokens of a text, by the machine from its first state."""
        if len(self.known) > KEPT_STATES or len(self.live) > KEPT_STATES:
            self._forget()
        state, total, step = self.first, 0, self.step
        for char in text:
            found = step[state].get(char)
            if found is None:
                found = step[state][char] = self._follow(state, char)
            state = found[0]
            total += found[1]
        return total

    def count(self, text: str) -> int:
        """Tokens of a text; pieces between two cuts count by themselves."""
        return self._sum(self.cut.split(text))

    def _sum(self, pieces: list[str]) -> int:
        counts, total = self.counts, 0
        if len(counts) > KEPT_PIECES:
            counts.clear()
        for piece in pieces:
            n = counts.get(piece)
            if n is None:
                n = self.run(piece)
                if len(piece) <= PIECE:
                    counts[piece] = n
            total += n
        return total

    def map_of(self, text: str) -> StateMap:
        pieces = self.cut.split(text)
        if len(pieces) == 1:
            return StateMap(text, 0, None)
        return StateMap(pieces[0], self._sum(pieces[1:-1]), pieces[-1])

    def compose(self, one: StateMap, two: StateMap) -> StateMap:
        """The map of two stretches in a row. Cuts at their border, or near it, are found when they are joined."""
        if one.tail is None and two.tail is None:
            return self.map_of(one.head + two.head)
        if one.tail is None:
            front = self.map_of(one.head + two.head)
            if front.tail is None:
                return StateMap(front.head, two.count, two.tail)
            return StateMap(front.head, front.count + self.count(front.tail) + two.count, two.tail)
        if two.tail is None:
            back = self.map_of(one.tail + two.head)
            if back.tail is None:
                return StateMap(one.head, one.count, back.head)
            return StateMap(one.head, one.count + self.count(back.head) + back.count, back.tail)
        return StateMap(one.head, one.count + self.count(one.tail + two.head) + two.count, two.tail)

    def total(self, whole: StateMap) -> int:
        return self.count(whole.head) + whole.count + (0 if whole.tail is None else self.count(whole.tail))


@dataclass(frozen=True)
class StateMap:
    """What a stretch of text does to the machine; without a tail it has no cut and is all head."""

    head: str
    count: int
    tail: str | None


# One machine for each vocabulary in this Python worker.
_MACHINES: dict[int, Transducer] = {}


def machine(model_json: str) -> Transducer:
    key = hash(model_json)
    if key not in _MACHINES:
        _MACHINES[key] = Transducer(model_json)
    return _MACHINES[key]


def _sliced(rows: DataFrame, slice_chars: int) -> DataFrame:
    """(row, doc_id, n_bytes, slice, text): the stretches of each text, ``n_bytes`` in the first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                one = batch.slice(i, 1)
                n_bytes = one.column("n_bytes")[0].as_py()
                starts = range(0, len(text), slice_chars)
                # A few stretches at a time, so that a long text is not held twice.
                for at in range(0, len(starts), FAN):
                    part = starts[at : at + FAN]
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(one.column("row")[0], n),
                            pa.repeat(one.column("doc_id")[0], n),
                            pa.array([n_bytes if start == 0 else 0 for start in part], pa.int64()),
                            pa.array([start // slice_chars for start in part], pa.int64()),
                            pa.array([text[start : start + slice_chars] for start in part], pa.string()),
                        ],
                        names=["row", "doc_id", "n_bytes", "slice", "text"],
                    )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, doc_id {kind}, n_bytes long, slice long, text string")


MAP = "head string, count long, tail string"


def _mapped(slices: DataFrame, model) -> DataFrame:
    """The state map of each stretch: row, doc_id, n_bytes, slice, head, count, tail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [machine(model.value).map_of(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("row", "doc_id", "n_bytes", "slice")),
                    pa.array([m.head for m in maps], pa.string()),
                    pa.array([m.count for m in maps], pa.int64()),
                    pa.array([m.tail for m in maps], pa.string()),
                ],
                names=["row", "doc_id", "n_bytes", "slice", "head", "count", "tail"],
            )

    kind = slices.schema["doc_id"].dataType.simpleString()
    return slices.mapInArrow(run, f"row long, doc_id {kind}, n_bytes long, slice long, {MAP}")


def _composed(maps: DataFrame, model) -> DataFrame:
    """One round: ``FAN`` neighbouring maps of a text become one."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("slice")
        parts = [StateMap(r["head"], r["count"], r["tail"]) for r in group.select(["head", "count", "tail"]).to_pylist()]
        whole = parts[0]
        for part in parts[1:]:
            whole = machine(model.value).compose(whole, part)
        return pa.table(
            {
                "row": group["row"][:1],
                "doc_id": group["doc_id"][:1],
                "n_bytes": pa.array([sum(group["n_bytes"].to_pylist())], pa.int64()),
                "slice": pa.array([group["slice"][0].as_py() // FAN], pa.int64()),
                "head": pa.array([whole.head], pa.string()),
                "count": pa.array([whole.count], pa.int64()),
                "tail": pa.array([whole.tail], pa.string()),
            }
        )

    return maps.groupBy("row", F.floor(F.col("slice") / FAN)).applyInArrow(run, maps.schema)


def token_counts(
    docs: DataFrame, model_path: str, long_bytes: int = LONG_BYTES, slice_chars: int = SLICE_CHARS
) -> DataFrame:
    """One row per document row: doc_id, n_bytes (UTF-8), n_tokens.

    Most texts are counted where they are read. The maps of long ones are
    written once and composed in as many rounds as the longest needs.
    """
    with open(model_path, encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long"

    def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coder = machine(model.value)
            n = [coder.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [StateMap(r["head"], r["count"], r["tail"]) for r in batch.select(["head", "count", "tail"]).to_pylist()]
            n = [machine(model.value).total(m) for m in maps]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    is_long = F.col("n_bytes") > long_bytes
    slices = _sliced(rows.where(is_long).withColumn("row", F.monotonically_increasing_id()), slice_chars)
    maps = written(_mapped(slices.repartition("row", "slice"), model), "token-maps")
    most = maps.agg(F.max("slice")).first()[0] or 0
    while most:
        maps, most = _composed(maps, model), most // FAN
    return rows.where(~is_long).mapInArrow(direct, schema).unionByName(maps.mapInArrow(ended, schema))


def limits(counted: DataFrame, most: int = 1024) -> DataFrame:
    """Adds whether a document has more than ``most`` tokens."""
    return counted.withColumn("over_limit", F.col("n_tokens") > most)
