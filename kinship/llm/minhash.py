"""MinHash near duplicates with sequential Bayesian verification.

1. Every text becomes its set of word shingles; rows with equal sets (exact
   copies, by a 128-bit digest of the set) form a class, and one member stands
   for it from here on.
2. The signatures of the classes are cut into bands; classes that share a
   band's values share a bucket.
3. Shingles that only one class of all buckets holds can be in no
   intersection. Of n shingles with u such ones, at most n - u can be shared,
   which bounds the similarity of a pair from above; classes and pairs that
   can't reach the threshold are left out. Near copies with different edits
   are told apart by this before they are compared.
4. In each bucket every member is compared with one pivot (that with the
   smallest share of own shingles, the likeliest original), so a bucket of m
   members makes m - 1 pairs, and the verified links join most of it.
5. Buckets in which members of different components are left are compared
   member by member; members of one component are never compared again. Large
   ones are cut into blocks, and two blocks are compared in one task, up to
   the verification of step 6, so only links leave it.
6. A pair is compared batch by batch of the signature. After each batch, with
   a uniform prior, the similarity has a beta posterior; the pair is dropped
   when the posterior chance that it reaches the threshold is below ``miss``.
   Survivors are verified on the full shingle sets, by integers.

A link at the threshold itself is missed by the bands with a chance of
(1 - t**rows)**bands; bands and rows follow from the threshold so that this is
about 1e-5 (24 bands of 6 for 0.85, 29 of 5 for 0.8).

Defined results: null or empty texts, and texts without a word, have no
shingles and are linked with nothing; texts of fewer words than a shingle have
one, the whole sequence; rows that repeat a doc_id are the same document, so
all that they link to is joined; a row without a doc_id can be linked, but
lends no id; where a component has no id at all, component_id is null and its
rows are kept. Further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinship.llm.common import numbered, written
from kinship.llm.components import components
from kinship.llm.hashing import WORDS, mixed

# Chance that no band catches a link at the threshold, and values of a signature at most.
BAND_MISS, VALUES = 1.2e-5, 160

# Signature values that are compared before each look at the posterior.
BATCH = 24

# Buckets left over with more members are compared by blocks of about BLOCK.
LARGE_BUCKET = 64
BLOCK = 256

# Shingles hashed at a time, which bounds the memory of a very long text.
CHUNK = 2048


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text.

    ASCII letters are lower-cased; words are split at ASCII white space.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(WORDS.__getitem__, found), np.uint64, len(found))
    width = min(words, len(found))
    out = np.full(len(found) - width + 1, width, np.uint64)
    for i in range(width):
        out = mixed(out + h[i : len(h) - width + 1 + i])
    return np.unique(out)


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    top = np.iinfo(np.uint64).max
    xors = rng.integers(0, top, count, np.uint64)
    odd = rng.integers(0, top, count, np.uint64) | np.uint64(1)
    return xors[:, None], odd[:, None]


def signature(hashes: np.ndarray, xors: np.ndarray, odd: np.ndarray) -> np.ndarray:
    low = None
    for at in range(0, hashes.size, CHUNK):
        part = ((hashes[None, at : at + CHUNK] ^ xors) * odd).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return (low >> np.uint64(32)).astype("<u4")


def sketch(docs: DataFrame, words: int, values: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, digest (of the set), signature; the last two null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xors, odd = _functions(values)
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, words) if text else np.empty(0, np.uint64)
                sizes.append(found.size)
                digests.append(hashlib.md5(found.tobytes()).digest() if found.size else None)
                signatures.append(signature(found, xors, odd).tobytes() if found.size else None)
            columns = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(signatures, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "digest", "signature"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_shingles long, digest binary, signature binary")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """digest and packed sorted shingle hashes of each row of ``docs`` that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, words) for t in batch.column("text").to_pylist() if t]
            packed = [f.tobytes() for f in found if f.size]
            columns = [pa.array([hashlib.md5(p).digest() for p in packed], pa.binary()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "shingles"])

    return docs.select("text").mapInArrow(run, "digest binary, shingles binary")


def banding(threshold: float) -> tuple[int, int]:
    """(bands, rows): the longest bands that miss a link at the threshold with a chance of BAND_MISS at most."""
    for rows in range(VALUES, 0, -1):
        bands = math.ceil(math.log(BAND_MISS) / math.log1p(-(threshold**rows))) if threshold < 1 else 1
        if bands * rows <= VALUES:
            return bands, rows
    return VALUES, 1


def needed_matches(values: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """(compared, matches): with fewer matches the chance of reaching the threshold is below ``miss``.

    With a uniform prior and m matches of n, the similarity is Beta(m + 1,
    n - m + 1), which exceeds t with the chance that a binomial of n + 1
    trials with chance t gives m at most.
    """
    out = []
    for n in range(batch, values + 1, batch):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _surviving(looks: list[tuple[int, int]], left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (left[i], right[j]) of signatures no look excludes."""
    alive, matches, done = np.arange(i.size), np.zeros(i.size, int), 0
    for compared, least in looks:
        same = left[i[alive], done:compared] == right[j[alive], done:compared]
        matches = matches + same.sum(axis=1)
        some = matches >= least
        alive, matches, done = alive[some], matches[some], compared
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(len(column), -1)


def _bayes(looks: list[tuple[int, int]]):
    """Keeps the pairs that no look at their signatures excludes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = _signatures(batch.column("signature_a")), _signatures(batch.column("signature_b"))
                each = np.arange(batch.num_rows)
                yield batch.select(["a", "b"]).take(pa.array(_surviving(looks, left, right, each, each)))

    return run


def _blocks(looks: list[tuple[int, int]], share: tuple[int, int], band_rows: int):
    """Compares two blocks of a bucket (or one with itself); returns the links.

    A pair that shares several buckets is verified in that of its first band.
    """
    of, whole = share

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        node, label, n, own, block = (
            rows.column(c).to_numpy() for c in ("node", "label", "n_shingles", "own", "block")
        )
        i, j = np.flatnonzero(block == key[1].as_py()), np.flatnonzero(block == key[2].as_py())
        common = n - own
        low = np.minimum(common[i][:, None], common[j])
        high = np.maximum(common[i][:, None], common[j]) + own[i][:, None] + own[j]
        possible = (label[i][:, None] != label[j]) & (whole * low >= of * high)
        if key[1].as_py() == key[2].as_py():
            possible &= np.arange(i.size)[:, None] < np.arange(j.size)
        left, right = np.nonzero(possible)
        left, right = i[left], j[right]
        signatures = _signatures(rows.column("signature"))
        alive = _surviving(looks, signatures, signatures, left, right)
        left, right = left[alive], right[alive]
        if left.size:
            same = (signatures[left] == signatures[right]).reshape(left.size, -1, band_rows).all(axis=2)
            here = same.argmax(axis=1) == rows.column("band")[0].as_py()
            left, right = left[here], right[here]
        packed = rows.column("shingles").to_pylist()
        keep = np.array([_linked(share, packed[x], packed[y]) for x, y in zip(left.tolist(), right.tolist())], bool)
        x, y = node[left[keep]], node[right[keep]]
        return pa.table({"u": np.minimum(x, y), "v": np.maximum(x, y)})

    return run


def _linked(share: tuple[int, int], x: bytes, y: bytes) -> bool:
    """Whether two packed sets reach the threshold, in integers."""
    left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = np.intersect1d(left, right, assume_unique=True).size
    return share[1] * both >= share[0] * (left.size + right.size - both)


def _exact(share: tuple[int, int]):
    """Keeps the pairs whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (batch.column(c).to_pylist() for c in ("shingles_a", "shingles_b"))
            keep = [_linked(share, x, y) for x, y in zip(*sides, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _both(pairs: DataFrame, of: DataFrame, *names: str) -> DataFrame:
    """``pairs`` (a, b) with columns of both sides.

    The many-sided key b is joined first: the rows are then wide where a
    pivot's many pairs meet, and Spark's skew splitting sees them by size.
    """
    out = pairs
    for side in ("b", "a"):
        out = out.join(of.select(F.col("node").alias(side), *(F.col(n).alias(f"{n}_{side}") for n in names)), side)
    return out


def _own_shingles(sets: DataFrame) -> DataFrame:
    """(node, own): how many shingles of each class no other class has; classes without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                packed = part.column("shingles").to_pylist()
                hashes = np.frombuffer(b"".join(packed), np.int64)
                node = np.repeat(part.column("node").to_numpy(), [len(p) // 8 for p in packed])
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(node)], names=["shingle", "node"])

    return (
        sets.mapInArrow(run, "shingle long, node long")
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("classes"), F.min("node").alias("node"))
        .where(F.col("classes") == 1)
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("own"))
    )


def _reachable(share: tuple[int, int], n_a: Column, own_a: Column, n_b: Column, own_b: Column) -> Column:
    """Whether a pair can reach the threshold: what both may share, over that and the own shingles of both."""
    of, whole = share
    common_a, common_b = n_a - own_a, n_b - own_b
    return whole * F.least(common_a, common_b) >= of * (F.greatest(common_a, common_b) + own_a + own_b)


def _band_keys(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, band, node) of every band of every class."""
    width = 4 * rows
    keys = F.array(
        *(F.xxhash64(F.lit(i), F.substring("signature", 1 + i * width, width)) for i in range(bands))
    )
    return classes.select("node", F.posexplode(keys).alias("band", "key"))


def _survivors(pairs: DataFrame, classes: DataFrame, looks: list[tuple[int, int]]) -> DataFrame:
    wide = _both(pairs, classes, "signature")
    return wide.select("a", "b", "signature_a", "signature_b").mapInArrow(_bayes(looks), "a long, b long")


def _verified(survivors: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(u, v) of the pairs whose full sets reach the threshold."""
    wide = _both(survivors, sets, "shingles").select("a", "b", "shingles_a", "shingles_b")
    links = wide.mapInArrow(_exact(share), "a long, b long")
    return links.select(F.col("a").alias("u"), F.col("b").alias("v"))


def _rest(
    members: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, looks: list, share: tuple[int, int], rows: int
) -> DataFrame:
    """Links (u, v) of members of a bucket that are in different components."""
    now = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = (
        now.groupBy("key")
        .agg(F.min("label").alias("first"), F.max("label").alias("last"), F.count(F.lit(1)).alias("size"))
        .where(F.col("first") != F.col("last"))
        .select("key", "size")
    )
    left = written(now.join(mixed, "key"), "minhash-rest")
    small = left.where(F.col("size") <= LARGE_BUCKET)
    x, y = small.alias("x"), small.alias("y")
    met = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.label") != F.col("y.label"))
        & _reachable(share, F.col("x.n_shingles"), F.col("x.own"), F.col("y.n_shingles"), F.col("y.own"))
    )
    pairs = x.join(y, met).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    # Every row of a large bucket goes to each pair of blocks that holds its own.
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    large = (
        left.where(F.col("size") > LARGE_BUCKET)
        .join(classes.select("node", "signature"), "node")
        .join(sets, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), n_blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        .withColumn("first", F.least("block", "other"))
        .withColumn("second", F.greatest("block", "other"))
        .select("key", "first", "second", "band", "node", "label", "n_shingles", "own", "block", "signature", "shingles")
    )
    in_blocks = large.groupBy("key", "first", "second").applyInArrow(_blocks(looks, share, rows), "u long, v long")
    survivors = written(_survivors(pairs, classes, looks), "minhash-survivors")
    return _verified(survivors, sets, share).unionByName(in_blocks).distinct()


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    share: tuple[int, int] = (80, 100),
    miss: float = 1e-6,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when ``share[1] * intersection >= share[0] *
    union`` of their shingle sets of ``words`` words; component_id is the
    smallest doc_id that a document reaches, and the document of that id is
    kept.
    """
    bands, rows = banding(share[0] / share[1])
    looks = needed_matches(bands * rows, BATCH, share[0] / share[1], miss)
    sketches = written(numbered(sketch(docs, words, bands * rows), "row"), "minhash-sketch")
    by_set = sketches.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("low")
    )
    classes = written(
        by_set.join(sketches.select(F.col("row").alias("node"), "n_shingles", "signature"), "node"), "minhash-classes"
    )
    keys = _band_keys(classes, bands, rows)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1).select("key")
    met = written(keys.join(shared, "key"), "minhash-buckets")

    # The sets of all classes that meet another: from the text of one member of each, found by its id.
    wanted = classes.join(met.select("node").distinct(), "node").select("node", "digest", "low")
    ids = wanted.select(F.col("low").alias("_id")).distinct()
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sets = wanted.select("node", "digest").join(shingle_sets(texts, words).dropDuplicates(["digest"]), "digest")
    sets = written(sets.select("node", "shingles"), "minhash-sets")

    own = F.coalesce("own", F.lit(0))
    counted = classes.select("node", "n_shingles").join(_own_shingles(sets), "node", "left")
    possible = written(
        counted.withColumn("own", own).where(share[1] * (F.col("n_shingles") - F.col("own")) >= share[0] * F.col("n_shingles")),
        "minhash-possible",
    )
    members = written(met.join(possible, "node"), "minhash-members")
    likeliest = F.min(F.struct((F.col("own") / F.col("n_shingles")).alias("share"), "node", "n_shingles", "own"))
    pivots = members.groupBy("key").agg(likeliest.alias("pivot"))
    pivot = F.col("pivot")
    stars = (
        members.join(pivots, "key")
        .where(F.col("node") != pivot["node"])
        .where(_reachable(share, F.col("n_shingles"), F.col("own"), pivot["n_shingles"], pivot["own"]))
        .select(pivot["node"].alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    # Classes that share a repeated doc_id hold the same document.
    of_row = sketches.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull()).join(
        classes.select("digest", "node"), "digest"
    )
    per_id = of_row.groupBy("doc_id").agg(F.min("node").alias("u"), F.max("node").alias("last"))
    repeated = per_id.where(F.col("u") != F.col("last")).select("doc_id", "u")
    same_id = of_row.join(repeated, "doc_id").where(F.col("node") != F.col("u")).select("u", F.col("node").alias("v"))
    survivors = written(_survivors(stars, classes, looks), "minhash-survivors")
    first = written(components(_verified(survivors, sets, share).unionByName(same_id)), "minhash-labels")

    rest = written(_rest(members, first, classes, sets, looks, share, rows), "minhash-links")
    # Components of components: what the first round joined is one edge a node now.
    joined = first.where(F.col("node") != F.col("label")).select(F.col("label").alias("u"), F.col("node").alias("v"))
    labels = written(components(joined.unionByName(rest)), "minhash-labels")
    lows = (
        classes.select("node", "low")
        .join(labels, "node")
        .groupBy("label")
        .agg(F.min("low").alias("component_low"))
    )
    of_class = (
        classes.select("digest", "node", "low")
        .join(labels.join(lows, "label"), "node", "left")
        .select("digest", F.coalesce("component_low", "low").alias("component"))
    )
    return (
        sketches.select("doc_id", "n_shingles", "digest")
        .join(of_class, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
