"""Quality rules: base counts, and a calibrated n-gram classifier beside them.

The classifier is a logistic regression over hashed n-grams of the whole
text: words and pairs of words in one half of the buckets, runs of four
characters in the other, each half as shares of its total. It is fitted by Spark's
distributed solver on a bounded sample of labelled rows; its margin is then
turned into a probability by a logistic curve that is fitted on the part of
the sample that the classifier has not seen, weighted by how often each label
occurs among all labels. Scoring goes over Arrow batches;
the verdict compares the probability with a fixed threshold.

Bounds of the fit (parameters): at most ``sample_rows`` rows of each label,
the smallest by a hash of their id; one in ``CALIBRATION`` of them calibrates.

Defined results: a null text has no words; ids labelled twice count with the
smaller label; where one of the labels is missing the probability is 1, so the
base rules alone decide. Every row gives a row; an empty table gives none;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.llm.common import one_label, written
from kinship.llm.hashing import WORDS, character_runs, mixed

SAMPLE_ROWS = 2000
CALIBRATION = 5
PENALTY = 1e-3

# Buckets of each half: words and pairs, runs of characters.
HALF = 2048

# A document is kept with at least this probability of a good label.
KEEP_FROM = 0.5

# Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    # Bytes that continue a code point are not counted.
    packed = b"".join(words)
    chars = int((np.frombuffer(packed, np.uint8) & 0xC0 != 0x80).sum())
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated = 0
    if len(words) > WINDOW:
        h = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
        n = len(words) - WINDOW + 1
        window = np.zeros(n, np.uint64)
        for i in range(WINDOW):
            window = mixed(window + h[i : i + n])
        _, which, times = np.unique(window, return_inverse=True, return_counts=True)
        again = np.flatnonzero(times[which] > 1)
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, again, 1)
        np.add.at(edge, again + WINDOW, -1)
        repeated = int((np.cumsum(edge) > 0).sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def buckets(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a whole text: (words and pairs, runs of characters)."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    h = mixed(np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words)))
    pairs = mixed(h[:-1] + mixed(h[1:])) if h.size > 1 else h[:0]
    of_words = (np.concatenate([h, pairs]) & np.uint64(HALF - 1)).astype(np.int64)
    return of_words, character_runs(text, HALF)


def shares(text: str) -> np.ndarray:
    """The features: each half's bucket counts as shares of its total."""
    halves = []
    for found in buckets(text):
        counts = np.bincount(found, minlength=HALF).astype(np.float32)
        halves.append(counts / max(1, found.size))
    return np.concatenate(halves)


@dataclass
class Classifier:
    """Weights of the buckets and the calibrating curve."""

    weights: list[float]
    intercept: float
    slope: float
    shift: float

    def margins(self, texts: list[str]) -> np.ndarray:
        w = np.array(self.weights)
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            of_words, of_runs = buckets(text)
            out[i] = self.intercept
            if of_words.size:
                out[i] += w[of_words].mean()
            if of_runs.size:
                out[i] += w[HALF + of_runs].mean()
        return out

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier | None:
    """The classifier of the documents that ``labels`` marks, or None where a label is missing."""
    known = one_label(labels, "quality").where(F.col("quality").isin(0, 1))
    ids = None
    for quality in (1, 0):
        side = known.where(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
        ids = side if ids is None else ids.unionByName(side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                rows = [shares(t or "") for t in part.column("text").to_pylist()]
                columns = [part.column("doc_id"), pa.array(rows, pa.list_(pa.float32())), part.column("label")]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "f", "label"])

    # At most twice ``sample_rows`` ids, so the documents are read without moving them.
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
    rows = sample.select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sample = written(rows.mapInArrow(run, f"doc_id {kind}, f array<float>, label double").repartition(6), "ngram-sample")
    later = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(CALIBRATION)) == 0
    vector = array_to_vector(F.col("f").cast("array<double>")).alias("features")
    train = sample.where(~later).select(vector, "label")
    if train.select("label").distinct().count() < 2:
        return None
    model = LogisticRegression(standardization=True, regParam=PENALTY, maxIter=60).fit(train)
    weights, intercept = model.coefficients.toArray().tolist(), float(model.intercept)
    shared = docs.sparkSession.sparkContext.broadcast(np.array(weights))

    def margin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("f").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                columns = [pa.array(x @ shared.value + intercept), batch.column("label")]
                yield pa.RecordBatch.from_arrays(columns, names=["margin", "label"])

    seen = sample.where(later).select("f", "label").mapInArrow(margin, "margin double, label double")
    seen = written(seen.coalesce(2), "ngram-calibration")
    drawn = {r["label"]: r["n"] for r in seen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(drawn) < 2:
        return Classifier(weights, intercept, 1.0, 0.0)
    # The sample holds as many rows of either label; the curve is to know how often each occurs.
    whole = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(whole.values())
    of_label = {label: whole[int(label)] / total * sum(drawn.values()) / n for label, n in drawn.items()}
    weight = F.when(F.col("label") == 1, of_label[1.0]).otherwise(of_label[0.0])
    curve = LogisticRegression(standardization=True, regParam=PENALTY, maxIter=60, weightCol="weight").fit(
        seen.select(array_to_vector(F.array("margin")).alias("features"), "label", weight.alias("weight"))
    )
    return Classifier(weights, intercept, float(curve.coefficients[0]), float(curve.intercept))


def judge(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, probability, kept."""
    classifier = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample_rows))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts = np.array([base_counts(t) for t in texts], np.int64).reshape(len(texts), len(names))
            model = classifier.value
            good = np.ones(len(texts)) if model is None else model.probabilities(texts)
            columns = [batch.column("doc_id"), *(pa.array(c) for c in counts.T), pa.array(good)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names, "probability"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {kind}, {', '.join(f'{n} long' for n in names)}, probability double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("probability") >= keep_from)
    )
