"""Quality by Bradley-Terry pairwise ranking.

Documents labelled good and documents labelled bad make preference pairs; the
chance that one is preferred to the other is the logistic function of the
difference of their scores, and a score is a weighted sum of features of the
text: its shape, and hashed n-grams of words and of characters, each half as
square roots of shares of its total. The weights are fitted by logistic loss
on feature differences (with Spark's distributed solver, every second pair the
other way round, no intercept). A document passes when its score reaches a
quantile of the scores of all labelled documents: the share of bad labels
among them.

Bounds of the fit (parameters): at most ``sample_rows`` documents of each
label, the smallest by a hash of their id, and ``strides`` pairs for each good
one. The threshold is taken from all labelled documents.

Defined results: a null text counts as empty and is scored like any other;
ids labelled twice count with the smaller label, and of the texts of a
repeated id the smallest is learned; labels without a document,
and documents without a label, teach nothing; where one of the two labels is
missing, every score is 0.5 and every document passes. Every row gives a row;
an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kinship.llm.common import key_fold, one_label, written
from kinship.llm.hashing import WORDS, character_runs, mixed

SAMPLE_ROWS = 3000
STRIDES = 4
PENALTY = 1e-3

# Texts that are scored together where rejected ones go.
BATCH_ROWS = 1000

# Half the width, in shares of the labelled documents, of the step whose middle is the threshold.
STEP = 0.005

# Classes of bytes whose shares of a text are features.
CLASSES = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b"|",
    b"!",
    b"#*$%&<>",
    b".",
    b",",
    b" \t\r\n",
    b"?;:'\"()-_/@=",
)
# Buckets of each half of the n-grams: words and pairs of words, runs of four characters.
HALF = 256
N_SHAPE = len(CLASSES) + 6
N_FEATURES = N_SHAPE + 2 * HALF


def shape(text: str) -> list[float]:
    """Shape of a whole text: shares of character classes, lengths, repetition."""
    raw = text.encode("utf-8", "surrogatepass")
    size, words = max(1, len(raw)), raw.split()
    n = max(1, len(words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    shares = [(len(raw) - len(raw.translate(None, c))) / size for c in CLASSES]
    return [
        *np.sqrt(shares).tolist(),
        float(np.log1p(len(words))),
        float(np.log1p(size / n)),
        len(set(words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(len(lines))),
        sum(a == b for a, b in zip(words, words[1:])) / n,
    ]


def features(text: str) -> np.ndarray:
    """All features of a whole text: its shape, then its n-grams."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    h = mixed(np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words)))
    grams = np.concatenate([h, mixed(h[:-1] + mixed(h[1:]))])
    halves = ((grams & np.uint64(HALF - 1)).astype(np.int64), character_runs(text, HALF))
    shares = [np.bincount(found, minlength=HALF) / max(1, found.size) for found in halves]
    return np.concatenate([shape(text), *map(np.sqrt, shares)])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def text_features(texts: pd.Series) -> pd.Series:
    return pd.Series([features(t or "") for t in texts], dtype=object)


@dataclass
class Ranker:
    """Weights of the features and the score that a document has to reach."""

    weights: list[float]
    threshold: float

    def score(self, utility: Column) -> Column:
        """The chance that a document beats one that just passes; 0.5 without a fit."""
        margin = utility - F.lit(self.threshold)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-500.0), margin)))


def utility(text: Column, weights: list[float]) -> Column:
    """The document's score on the scale of the fit."""

    @F.pandas_udf(T.DoubleType())
    def weighed(texts: pd.Series) -> pd.Series:
        w = np.array(weights)
        return pd.Series([float(np.dot(w, features(t or ""))) for t in texts], dtype="float64")

    return weighed(text)


def preference_pairs(docs: DataFrame, labelled: DataFrame, sample_rows: int, strides: int) -> DataFrame:
    """(difference, turned): good minus bad features; every good document meets ``strides`` bad ones,
    and every second pair is to be learned the other way round."""
    sides = []
    for quality in (1, 0):
        chosen = (
            labelled.where(F.col("quality") == quality)
            .select("doc_id")
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(sample_rows)
        )
        # At most ``sample_rows`` ids, so the documents are read without moving them.
        rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
        side = rows.select("doc_id", text_features("text").alias("f"))
        place = F.row_number().over(Window.orderBy(F.xxhash64("doc_id"), "doc_id")) - 1
        sides.append(written(side.withColumn("place", place).coalesce(2), "ranking-side"))
    good, bad = sides
    n_bad = bad.count()
    if not n_bad:
        return good.select(F.col("f").alias("difference"), F.lit(False).alias("turned")).limit(0)
    met = F.explode(F.sequence(F.lit(0), F.lit(min(strides, n_bad) - 1)))
    partners = good.select("f", "place", met.alias("stride")).select(
        F.col("f").alias("good"),
        ((F.col("place") + F.col("stride")) % 2 == 1).alias("turned"),
        ((F.col("place") * strides + F.col("stride")) % n_bad).cast("int").alias("place"),
    )
    return partners.join(bad.select("place", F.col("f").alias("bad")), "place").select(
        F.zip_with("good", "bad", lambda g, b: g - b).alias("difference"), "turned"
    )


def fit_weights(docs: DataFrame, labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, strides: int = STRIDES) -> list[float] | None:
    """The features' weights, or None where a label is missing."""
    pairs = preference_pairs(docs.select("doc_id", "text"), labelled, sample_rows, strides)
    pairs = written(pairs.coalesce(4), "ranking-pairs")
    if pairs.isEmpty():
        return None
    # The loss of a pair is the same either way round; both labels are to occur.
    turned = F.col("turned")
    both = pairs.select(
        F.when(turned, F.transform("difference", lambda d: -d)).otherwise(F.col("difference")).alias("difference"),
        F.when(turned, 0.0).otherwise(1.0).alias("label"),
    )
    solver = LogisticRegression(fitIntercept=False, standardization=True, regParam=PENALTY, maxIter=100)
    model = solver.fit(both.select(array_to_vector("difference").alias("features"), "label"))
    return model.coefficients.toArray().tolist()


def ranked(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> tuple[DataFrame, Ranker]:
    """(doc_id, utility) of every row, and the fitted ranker.

    ``learn`` is a condition on doc_id: labels are taken only from where it holds.
    """
    known = one_label(labels, "quality").where(F.col("quality").isin(0, 1))
    if learn is not None:
        known = known.where(learn)
    known = written(known, "ranking-labels")
    weights = fit_weights(docs, known)
    if weights is None:
        return docs.select("doc_id", F.lit(0.0).alias("utility")), Ranker([0.0] * N_FEATURES, 0.0)
    scored = written(docs.select("doc_id", utility(F.col("text"), weights).alias("utility")), "ranking-scores")
    return scored, Ranker(weights, passing(scored.join(known, "doc_id")))


def passing(of_known: DataFrame) -> float:
    """The utility that a document has to reach, from (utility, quality) of the labelled ones."""
    bad = of_known.agg(F.avg((F.col("quality") == 0).cast("double"))).first()[0]
    low, high = max(0.0, bad - STEP), min(1.0, bad + STEP)
    around = of_known.agg(F.percentile_approx("utility", [low, high], 10_000)).first()[0]
    return sum(around) / 2 if around else 0.0


def quality(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """Learns from all folds but one and scores every document: doc_id, held_out, score, predicted."""
    held = key_fold(F.col("doc_id"), folds) == fold
    scored, ranker = ranked(docs, labels, ~held)
    return scored.select("doc_id", held.alias("held_out"), ranker.score(F.col("utility")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns; learns from all labels.

    Only labelled documents are scored for the threshold; then every document
    is scored once, where it is read, and rejected ones go no further.
    """
    known = written(one_label(labels, "quality").where(F.col("quality").isin(0, 1)), "ranking-labels")
    weights = fit_weights(docs, known)
    if weights is None:
        return docs
    of_known = docs.select("doc_id", "text").join(known, "doc_id").select(utility(F.col("text"), weights).alias("utility"), "quality")
    least = passing(written(of_known, "ranking-scores"))
    w = np.array(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                scores = [float(np.dot(w, features(t or ""))) for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array([s >= least for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
