"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

Index. Documents are gathered in shards of at most ``SHARD_DOCS`` documents
and about ``SHARD_BYTES`` of text, and numbered inside a shard by length. A
shard has one row with its documents and one row for each of its terms: gaps
between document numbers, term frequencies, and for each block of ``BLOCK``
postings its last number, its greatest frequency and its shortest document.
Since a score grows with the frequency and falls with the length, these two
bound every score in the block. No statistic of the corpus is in the index,
so shards may be added to it; the table is written once, in parts.

Search. The number of documents, their terms and the document frequencies of
the asked terms are aggregates of the index. The postings of asked terms (a
semi-join of the index) go to their shard's task, in the order of shards. A
task ranks every query over its shards, with a heap of ``k`` results a query
that goes on from shard to shard. In a shard a query's lists are ordered by
the bounds of whole lists: lists whose bounds together cannot reach
the k-th best score so far are non-essential, and only documents of the
essential ones are candidates. The block maxima of non-essential lists are
added to a candidate's score; where that stays below the k-th best, the
candidate goes before any block of theirs is decompressed. The heaps of all
tasks are merged by a top-k a query.

Queries are taken in blocks of about ``QUERY_TERMS`` terms, whose term numbers
are broadcast: that bounds the broadcast by a parameter (and the longest
query), however many queries there are. The score is in whole numbers, so it
does not depend on the order of additions.

Defined results: a null text has no terms and matches nothing, and a query
without terms, or whose terms no document holds, has no results. Rows that
repeat a document are documents of their own; of equal scores the smaller id
comes first (null before all), then the row that was read first. Query rows
that repeat an id are ranked each by itself, so their results repeat. An empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinship.llm.common import numbered, written

SHARD_DOCS = 4096
SHARD_BYTES = 8 << 20
STRETCH = 1 << 20
BLOCK = 128
QUERY_TERMS = 50_000

# Bytes that separate terms become spaces, A-Z becomes a-z; bytes of letters beyond ASCII stay.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    """The terms of a text, with repeats."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    return F.filter(F.split(low, SEPARATORS), lambda t: t != "")


# The index.

INDEX = (
    "shard long, term binary, n_docs long, n_tokens long, ids array<long>, order binary, lengths binary, "
    "last binary, top_tf binary, least_n binary, gaps binary, tfs binary"
)
NAMES = [field.split()[0] for field in INDEX.split(", ")]
# Rows of one Arrow batch of postings.
ROWS = 20_000


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary value of each run of ``values``; the runs end at ``ends``."""
    offsets = np.concatenate([[0], ends * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]
    )


class Numbers(dict):
    """Numbers of terms, in the order in which they are first met."""

    def __missing__(self, term: bytes) -> int:
        n = self[term] = len(self)
        return n


class Shard:
    """The documents that one shard gathers."""

    def __init__(self):
        self.number = Numbers()
        self.ids: list[int | None] = []
        self.said: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: str) -> None:
        raw = text.encode("utf-8", "surrogatepass").translate(_LETTERS)
        number, found, at = self.number, [], 0
        while at < len(raw):
            # Stretches end at a space, so that a long text is not held as separate words at once.
            end = len(raw) if len(raw) - at <= STRETCH else raw.find(b" ", at + STRETCH)
            end = len(raw) if end < 0 else end
            words = raw[at:end].split()
            found.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            at = end
        self.ids.append(doc_id)
        self.said.append(np.concatenate(found) if found else np.zeros(0, np.int32))
        self.size += len(raw)

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        """A row with the documents, then one for each term."""
        lengths = np.array([len(words) for words in self.said], np.int64)
        order = np.argsort(lengths, kind="stable")
        lengths = lengths[order]
        size = len(order)
        flat = np.concatenate([self.said[i] for i in order.tolist()]).astype(np.int64)
        codes, tf = np.unique(flat * size + np.repeat(np.arange(size), lengths), return_counts=True)
        term, place = np.divmod(codes, size)
        n_terms = len(self.number)
        begins = np.searchsorted(term, np.arange(n_terms))
        ends = np.append(begins[1:], term.size) if n_terms else begins
        gaps = np.diff(place, prepend=0)
        gaps[begins] = place[begins]
        # Blocks of every BLOCK postings of a term; documents stand in the order of their lengths.
        heads = np.flatnonzero((np.arange(term.size) - np.repeat(begins, ends - begins)) % BLOCK == 0)
        tails = np.append(heads[1:], term.size) - 1 if heads.size else heads
        last, least = place[tails], lengths[place[heads]]
        top = np.maximum.reduceat(tf, heads) if heads.size else heads
        block_ends = np.cumsum((ends - begins + BLOCK - 1) // BLOCK)
        whole = {
            "shard": pa.array([shard], pa.int64()),
            "term": pa.array([b""], pa.binary()),
            "n_docs": pa.array([int((lengths > 0).sum())], pa.int64()),
            "n_tokens": pa.array([int(lengths.sum())], pa.int64()),
            "ids": pa.array([[self.ids[i] for i in order.tolist()]], pa.list_(pa.int64())),
            "order": pa.array([order.astype("<u2").tobytes()], pa.binary()),
            "lengths": pa.array([lengths.astype("<u4").tobytes()], pa.binary()),
        }
        yield pa.RecordBatch.from_arrays([whole.get(name, pa.nulls(1, pa.binary())) for name in NAMES], names=NAMES)
        words = list(self.number)
        for start in range(0, n_terms, ROWS):
            stop = min(start + ROWS, n_terms)
            p, q = int(begins[start]), int(ends[stop - 1])
            b, c = int(block_ends[start - 1]) if start else 0, int(block_ends[stop - 1])
            some = {
                "shard": pa.array(np.full(stop - start, shard, np.int64)),
                "term": pa.array(words[start:stop], pa.binary()),
                "n_docs": pa.array((ends - begins)[start:stop]),
                "n_tokens": pa.nulls(stop - start, pa.int64()),
                "ids": pa.nulls(stop - start, pa.list_(pa.int64())),
                "last": _packed(last[b:c].astype("<u2"), block_ends[start:stop] - b),
                "top_tf": _packed(top[b:c].astype("<u4"), block_ends[start:stop] - b),
                "least_n": _packed(least[b:c].astype("<u4"), block_ends[start:stop] - b),
                "gaps": _packed(gaps[p:q].astype("<u2"), ends[start:stop] - p),
                "tfs": _packed(tf[p:q].astype("<u4"), ends[start:stop] - p),
            }
            empty = pa.nulls(stop - start, pa.binary())
            yield pa.RecordBatch.from_arrays([some.get(name, empty) for name in NAMES], names=NAMES)


def build_index(docs: DataFrame, shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The rows of all shards. A shard is numbered by its task and its place in it."""
    if not 0 < shard_docs <= 1 << 16:
        raise ValueError("a shard holds 1 to 65,536 documents")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, at, shard = TaskContext.get().partitionId() << 32, 0, Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                shard.add(doc_id, text.as_py())
                if len(shard.ids) >= shard_docs or shard.size >= shard_bytes:
                    yield from shard.rows(first + at)
                    at, shard = at + 1, Shard()
        if shard.ids:
            yield from shard.rows(first + at)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, INDEX)


# The search.


class Postings:
    """One term's list in one shard."""

    def __init__(self, row: dict, corpus: tuple[int, int], shard_norms: np.ndarray):
        self.norms = shard_norms
        self.last = np.frombuffer(row["last"], "<u2").astype(np.int64)
        top = np.frombuffer(row["top_tf"], "<u4").astype(np.int64)
        least = np.frombuffer(row["least_n"], "<u4").astype(np.int64)
        # What a block adds at most, for weight 1; a last zero for documents behind the list.
        self.most = np.append(impact(top, norm(least, corpus)), 0)
        self.bound = int(self.most.max())
        self.gaps, self.tfs = np.frombuffer(row["gaps"], "<u2"), np.frombuffer(row["tfs"], "<u4")
        self.whole: tuple[np.ndarray, np.ndarray] | None = None

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and impacts of the whole list, decompressed once a shard."""
        if self.whole is None:
            places = np.cumsum(self.gaps, dtype=np.int64)
            self.whole = places, impact(self.tfs.astype(np.int64), self.norms[places])
        return self.whole

    def some(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and impacts of some blocks, in order; only they are decompressed."""
        if self.whole is not None or len(blocks) * 2 > len(self.last):
            return self.all()
        at = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        at = at[at < len(self.gaps)]
        block = at // BLOCK
        run = np.cumsum(self.gaps[at], dtype=np.int64)
        starts = np.flatnonzero(at % BLOCK == 0)
        # The sum up to a block's beginning gives way to the last place of the block before it.
        before = np.where(starts > 0, run[starts - 1], 0)
        base = np.where(blocks > 0, self.last[blocks - 1], 0)
        places = run + np.repeat(base - before, np.diff(np.append(starts, len(at))))
        return places, impact(self.tfs[at].astype(np.int64), self.norms[places])


def norm(lengths: np.ndarray, corpus: tuple[int, int]) -> np.ndarray:
    """8 * m of documents of these lengths."""
    n_docs, n_terms = corpus
    return 8 * (25 + 75 * lengths * n_docs // max(1, n_terms))


def impact(tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + norms)


class Heap:
    """The k best of one query so far: rows (score, no id, id, shard, place read), best first."""

    def __init__(self, k: int):
        self.k = k
        self.rows = np.zeros((0, 5), np.int64)

    @property
    def least(self) -> int:
        """The score that a document has to reach."""
        return int(self.rows[-1, 0]) if len(self.rows) == self.k else 1

    def merge(self, rows: np.ndarray) -> None:
        rows = np.concatenate([self.rows, rows])
        order = np.lexsort((rows[:, 4], rows[:, 3], rows[:, 2], rows[:, 1], -rows[:, 0]))
        self.rows = rows[order[: self.k]]


def search_shard(lists: list[tuple[int, Postings]], size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the documents of a shard that reach ``least``, and maybe others below it.

    ``lists`` are (weight, postings) of the query's terms.
    """
    lists = sorted(lists, key=lambda x: x[0] * x[1].bound)
    reach = np.cumsum([weight * p.bound for weight, p in lists])
    # Documents of the first lists alone stay below ``least``.
    essential = int(np.searchsorted(reach, least))
    score = np.zeros(size, np.int64)
    for weight, p in lists[essential:]:
        places, gain = p.all()
        score[places] += weight * gain
    found = np.flatnonzero(score)
    if not essential or not found.size:
        return found, score[found]
    found = found[score[found] + int(reach[essential - 1]) >= least]
    other = lists[:essential][::-1]
    blocks = [np.searchsorted(p.last, found) for _, p in other]
    most = [weight * p.most[b] for (weight, p), b in zip(other, blocks)]
    rest = np.sum(most, axis=0)
    sure = score[found]
    for i, (weight, p) in enumerate(other):
        alive = sure + rest >= least
        if not alive.all():
            found, sure, rest = found[alive], sure[alive], rest[alive]
            blocks[i:] = [b[alive] for b in blocks[i:]]
            most[i:] = [m[alive] for m in most[i:]]
        if not found.size:
            break
        rest = rest - most[i]
        here = np.unique(blocks[i])
        here = here[here < len(p.last)]
        if here.size:
            places, gain = p.some(here)
            at = np.minimum(np.searchsorted(places, found), len(places) - 1)
            sure = sure + np.where(places[at] == found, weight * gain[at], 0)
    return found, sure


def _searched(postings: DataFrame, queries, corpus: tuple[int, int], k: int) -> DataFrame:
    """Each task's best ``k`` of each query over the shards it has, sorted by shard."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield {name: column[i] for name, column in zip(batch.schema.names, batch.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[tuple[int, list[tuple[int, int]]]] = queries.value
        heaps = {row: Heap(k) for row, _ in asked}
        rows = ({name: value.as_py() for name, value in row.items()} for row in shards(batches))
        for shard, group in groupby(rows, key=lambda row: row["shard"]):
            documents = next(group)
            norms = norm(np.frombuffer(documents["lengths"], "<u4").astype(np.int64), corpus)
            read = np.frombuffer(documents["order"], "<u2").astype(np.int64)
            missing = np.array([i is None for i in documents["ids"]])
            ids = np.array([i or 0 for i in documents["ids"]], np.int64)
            lists = {row["number"]: Postings(row, corpus, norms) for row in group}
            for query, wanted in asked:
                heap = heaps[query]
                here = [(weight, lists[number]) for number, weight in wanted if number in lists and weight > 0]
                if not here:
                    continue
                places, scores = search_shard(here, len(ids), heap.least)
                if places.size > k:
                    least = max(heap.least, int(np.partition(scores, -k)[-k]))
                    places, scores = places[scores >= least], scores[scores >= least]
                columns = (scores, ~missing[places], ids[places], np.full(places.size, shard), read[places])
                heap.merge(np.stack(columns, axis=1).astype(np.int64))
        found = [(query, *row) for query, heap in heaps.items() for row in heap.rows.tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([f[3] if f[2] else None for f in found], pa.int64()),
                pa.array([f[1] for f in found], pa.int64()),
                pa.array([f[4] for f in found], pa.int64()),
                pa.array([f[5] for f in found], pa.int64()),
            ],
            names=["query", "doc_id", "score", "shard", "place"],
        )

    return postings.mapInArrow(run, "query long, doc_id long, score long, shard long, place long")


def search(index: DataFrame, items: DataFrame, k: int = 10, query_terms: int = QUERY_TERMS) -> DataFrame:
    """The ``k`` best documents of each row of ``items`` (item_id, text): item_id, rank, doc_id, score.

    ``index`` is a written :func:`build_index`.
    """
    spark = index.sparkSession
    asked = written(numbered(items.select("item_id", "text"), "query"), "search-queries")
    said = asked.select("query", F.explode(terms(F.col("text"))).alias("word"))
    wanted = written(said.groupBy("query", F.encode("word", "UTF-8").alias("term")).agg(F.count(F.lit(1)).alias("times")), "search-terms")
    shards = index.where(F.col("term") == F.lit(b""))
    corpus = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    n_docs, n_terms = int(corpus[0]), int(corpus[1])
    parts = max(1, math.ceil(wanted.count() / query_terms))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))
    found = None
    for part in range(parts):
        mine = wanted.where(F.pmod(F.xxhash64("query"), F.lit(parts)) == part)
        # The document frequencies of the terms that the index has, and a number for each.
        known = index.join(mine.select("term").distinct(), "term").groupBy("term").agg(F.sum("n_docs").alias("df"))
        known = written(numbered(known.select("term", weight.cast("long").alias("weight")), "number"), "search-known")
        rows = mine.join(known, "term").groupBy("query").agg(
            F.collect_list(F.struct("number", (F.col("weight") * F.col("times")).alias("weight"))).alias("wanted")
        )
        # About ``query_terms`` terms in all.
        block = [(r["query"], [(w["number"], w["weight"]) for w in r["wanted"]]) for r in rows.collect()]
        queries = spark.sparkContext.broadcast(block)
        postings = index.join(known.select("term", "number"), "term").select(*NAMES, "number")
        both = postings.unionByName(shards.withColumn("number", F.lit(-1).cast("long")))
        # A task has whole shards, one after the other, each with its documents first.
        dealt = both.repartition("shard").sortWithinPartitions("shard", "number")
        best = _searched(dealt, queries, (n_docs, n_terms), k)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "shard", "place")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Indexes all of ``docs`` and ranks it for every row of ``items``."""
    return search(written(build_index(docs), "search-index"), items, k)
