"""Mixing to target weights with soft membership.

1. A classifier learns domains from a labelled table and gives every document
   a posterior over the domains, so a document belongs to several in part.
2. With n_i tokens and posterior p_ik, a rate r_i for each document makes
   sum_i r_i n_i p_ik expected tokens of domain k. Projected gradient finds
   nonnegative rates whose totals match the targets, by least squares.

The classifier is Spark's multinomial logistic regression over the presence of
words, beginnings of words and runs of punctuation, the ``VOCABULARY`` ones
whose shares of documents differ most between the domains. It learns from at
most ``sample_rows`` labelled documents of each domain that the table holds
(the smallest by a hash of their id), weighted so that the domains count as
often as among all its labelled documents.

Each step of the descent is one aggregate over the documents' posteriors,
which gives as many sums as there are domains. A document's rate follows from
its own posterior and the residuals of the earlier steps, so it is computed
again from those few numbers in each step and never stored: no state is
shuffled, and a lost executor loses nothing. The gradient is taken in the
metric that weighs documents by their tokens and residuals by the domains'
totals; there the step 1 is stable for any posterior, as its matrix has rows
that sum to 1.

Defined results: a null or empty text has no tokens and takes the rate of its
posterior; a domain that no document belongs to is left out of the target;
where fewer than two domains are labelled, every document belongs to the only
one (or to the first named domain). Rows without label teach nothing. Every row gives a row; an
empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinship.llm.common import numbered, spread, written

SAMPLE_ROWS = 2000
VOCABULARY = 2000
LEAST_DOCUMENTS = 5
BEGINNING = 5
PENALTY = 1e-2
STEPS = 200
CLOSE = 1e-4

# The part of a domain's tokens by which its target may be missed when the steps run out.
MISSED = 0.02

# Texts that are scored together.
BATCH_ROWS = 1000


WORD = re.compile(r"[^\W_]+|(?:[^\w\s]|_)+")


def tokens(text: str | None) -> list[str]:
    """Lower-case words and runs of punctuation of a whole text."""
    return WORD.findall((text or "").lower())


def marks(words: list[str]) -> set[str]:
    """The distinct tokens, and the beginnings of the longer ones."""
    found = set(words)
    return found | {"^" + w[:BEGINNING] for w in found if len(w) > BEGINNING}


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(domain, label, text) -> (domain, label, _kn_marks)."""
    for batch in batches:
        found = [sorted(marks(tokens(t))) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("domain"), batch.column("label"), pa.array(found, pa.list_(pa.string()))], names=["domain", "label", "_kn_marks"]
        )


def telling_marks(sample: DataFrame, drawn: dict[str, int], size: int) -> list[str]:
    """The marks whose share of documents differs most between one domain and the rest,
    measured in standard errors; ties by the mark itself."""
    whole = sum(drawn.values())
    here = {d: F.col(f"n{i}") for i, d in enumerate(drawn)}
    each = sample.select("domain", F.explode("_kn_marks").alias("mark")).groupBy("mark")
    counts = each.agg(*(F.count_if(F.col("domain") == d).alias(f"n{i}") for i, d in enumerate(drawn)))
    total = reduce(lambda x, y: x + y, here.values())
    spread_of = F.col("total") / whole * (1 - F.col("total") / whole) + 1e-9
    scores = [
        F.abs(n / drawn[d] - (F.col("total") - n) / (whole - drawn[d]))
        / F.sqrt(spread_of * (1 / drawn[d] + 1 / (whole - drawn[d])))
        for d, n in here.items()
    ]
    top = counts.withColumn("total", total).where(F.col("total") >= LEAST_DOCUMENTS)
    score = F.greatest(*scores)
    return [r["mark"] for r in top.orderBy(score.desc(), "mark").limit(size).select("mark").collect()]


def _sampled(docs: DataFrame, labelled: DataFrame, domains: list[str], sample_rows: int) -> tuple[DataFrame, dict[str, int]]:
    """(domain, label, text) of at most ``sample_rows`` labelled documents of each domain, the
    smallest by a hash of their id, and how many labelled documents each domain has in ``docs``."""
    known = labelled.where(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    # Labels of documents that are not there teach nothing and take up no place in the sample.
    known = written(known.join(docs.select("doc_id"), "doc_id", "left_semi"), "mixing-labels")
    counts = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    # A domain's ids by one top-n over all tasks each; the ids in all are bounded, so the documents are not moved.
    drawn = [known.where(F.col("domain") == d).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows) for d in domains if d in counts]
    if not drawn:
        return docs.select(F.lit("").alias("domain"), F.lit(0.0).alias("label"), "text").limit(0), counts
    ids = written(reduce(DataFrame.unionByName, drawn), "mixing-ids")
    number = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    # Of the texts of a repeated id the smallest counts.
    one = rows.groupBy("doc_id", "domain").agg(F.min("text").alias("text"))
    return one.select("domain", number.cast("double").alias("label"), "text"), counts


@dataclass
class Posteriors:
    """A fitted classifier: the weight of each mark for each domain; 0 classes where there is nothing to tell apart."""

    domains: list[str]
    only: int
    intercept: list[float]
    weights: dict[str, list[float]]

    def score(self, texts: list[str | None]) -> tuple[list[int], np.ndarray]:
        """Tokens and posterior of each text."""
        n, out = [], np.zeros((len(texts), len(self.domains)))
        for row, text in zip(out, texts):
            words = tokens(text)
            n.append(len(words))
            if not self.intercept:
                row[self.only] = 1.0
                continue
            margin = np.array(self.intercept)
            # In a fixed order, so that a text's score never depends on its worker.
            here = [self.weights[m] for m in sorted(marks(words) & self.weights.keys())]
            if here:
                margin = margin + np.sum(here, axis=0)
            chance = np.exp(margin - margin.max())
            row[: len(chance)] = chance / chance.sum()
        return n, out

    def added_to(self, table: DataFrame, n_tokens: str = "n_tokens", posterior: str = "posterior") -> DataFrame:
        """``table``, which has a text, with its tokens and its posterior."""
        fitted = table.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, BATCH_ROWS):
                    batch = whole.slice(start, BATCH_ROWS)
                    n, p = fitted.value.score(batch.column("text").to_pylist())
                    offsets = pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32())
                    made = [pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(p.ravel()))]
                    yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, n_tokens, posterior])

        more = [T.StructField(n_tokens, T.LongType()), T.StructField(posterior, T.ArrayType(T.DoubleType()))]
        return table.mapInArrow(run, T.StructType([*table.schema.fields, *more]))


def domain_posteriors(
    docs: DataFrame, labelled: DataFrame, domains: list[str], sample_rows: int = SAMPLE_ROWS
) -> Posteriors:
    """Learns from ``labelled`` (doc_id, domain) and the texts of ``docs``."""
    texts, counts = _sampled(docs, labelled, domains, sample_rows)
    sample = texts.repartition(6).mapInArrow(_marked, "domain string, label double, _kn_marks array<string>")
    sample = written(sample, "mixing-sample")
    drawn = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = [d for d in domains if d in drawn]
    if len(found) < 2:
        return Posteriors(domains, domains.index(found[0]) if found else 0, [], {})
    each = F.create_map(*(F.lit(x) for d in found for x in (d, counts[d] / drawn[d])))
    vocabulary = telling_marks(sample, {d: drawn[d] for d in found}, VOCABULARY) or ["^"]
    present = CountVectorizerModel.from_vocabulary(vocabulary, "_kn_marks", "_kn_present", binary=True)
    solver = LogisticRegression(
        featuresCol="_kn_present",
        family="multinomial",
        regParam=PENALTY,
        maxIter=60,
        weightCol="weight",
        predictionCol="_kn_class",
    )
    fitted = solver.fit(present.transform(sample.withColumn("weight", each[F.col("domain")])))
    # A domain after the last labelled one is no class of the model.
    weights = fitted.coefficientMatrix.toArray().T
    return Posteriors(domains, 0, fitted.interceptVector.toArray().tolist(), dict(zip(vocabulary, weights.tolist())))


def _replay(posterior: np.ndarray, history: list[tuple[float, list[float]]], max_rate: float) -> np.ndarray:
    """Rates of documents after the steps of (momentum, weighted residuals)."""
    rate = before = np.ones(len(posterior))
    for momentum, residuals in history:
        ahead = rate + momentum * (rate - before)
        before, rate = rate, np.clip(ahead - posterior @ np.array(residuals), 0.0, max_rate)
    return rate


def _posteriors(batch: pa.RecordBatch, size: int, name: str = "posterior") -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)


def with_rates(
    table: DataFrame, history: list, max_rate: float, size: int, posterior: str = "posterior", name: str = "rate"
) -> DataFrame:
    """``table``, which has a posterior, with each row's rate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = _replay(_posteriors(batch, size, posterior), history, max_rate)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], names=[*batch.schema.names, name])

    return table.mapInArrow(run, T.StructType([*table.schema.fields, T.StructField(name, T.DoubleType())]))


def totals(weighed: DataFrame, history: list, max_rate: float, size: int) -> list[float]:
    """Expected tokens of each domain after the given steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            p = _posteriors(batch, size)
            total += (batch.column("n_tokens").to_numpy() * _replay(p, history, max_rate)) @ p
        yield pa.RecordBatch.from_arrays([pa.array([t]) for t in total], names=[f"t{i}" for i in range(size)])

    parts = weighed.select("n_tokens", "posterior").mapInArrow(run, ", ".join(f"t{i} double" for i in range(size)))
    row = parts.agg(*(F.coalesce(F.sum(f"t{i}"), F.lit(0.0)).alias(f"t{i}") for i in range(size))).first()
    return [row[f"t{i}"] for i in range(size)]


def fit_rates(
    weighed: DataFrame,
    shares: list[float],
    budget: float | None = None,
    anchor: int | None = None,
    max_rate: float = float("inf"),
    steps: int = STEPS,
) -> tuple[list[tuple[float, list[float]]], list[float], list[float]]:
    """The steps of the descent, the targets, and the totals reached.

    ``shares`` are the domains' target weights. The tokens in all are
    ``budget``, by default those of the table; with ``anchor``, they are such
    that the target of that domain is what the table holds of it. The descent
    has momentum, which begins anew where the totals move away from the
    targets. It ends when the targets are met or the totals stand still (then
    bounded rates allow no better); when the steps run out before that, with
    a target missed by more than ``MISSED`` of its domain's tokens, it fails.
    """
    size = len(shares)
    held = totals(weighed, [], max_rate, size)
    whole = [s if m > 0 else 0.0 for s, m in zip(shares, held)]
    whole = [s / sum(whole) if sum(whole) else 0.0 for s in whole]
    if anchor is not None and whole[anchor] > 0:
        budget = held[anchor] / whole[anchor]
    elif budget is None:
        budget = sum(held)
    targets = np.array([budget * s for s in whole])
    scale = np.array([1 / m if m > 0 else 0.0 for m in held])
    history: list[tuple[float, list[float]]] = []
    reached = before = np.array(held)
    pace = 1.0

    def missed(at: np.ndarray) -> float:
        return float(np.abs((at - targets) * scale).max(initial=0.0))

    while missed(reached) >= CLOSE:
        if len(history) >= steps:
            if missed(reached) > MISSED and np.abs((reached - before) * scale).max(initial=0.0) >= CLOSE:
                raise RuntimeError(f"after {steps} steps a target is missed by {missed(reached):.3f} of its domain's tokens")
            break
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        momentum, pace = (pace - 1) / faster, faster
        ahead = reached + momentum * (reached - before)
        history.append((momentum, ((ahead - targets) * scale).tolist()))
        before, reached = reached, np.array(totals(weighed, history, max_rate, size))
        if missed(reached) > missed(before):
            pace = 1.0
        if len(history) > 1 and np.abs((reached - before) * scale).max(initial=0.0) < CLOSE / 10:
            break
    return history, targets.tolist(), reached.tolist()


def shortfall(targets: list[float], reached: list[float]) -> list[float]:
    """By what part of its target each domain misses it; 0 where there is none."""
    return [(r - t) / t if t else 0.0 for t, r in zip(targets, reached)]


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    shares: dict[str, float],
    budget: float | None = None,
    anchor: str | None = None,
    max_rate: float = float("inf"),
    seed: int = 0,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, posterior, rate, copies, missed.

    ``copies`` is the rate rounded down or up, up with the chance of its
    fraction, by a hash of the id (of the row, where there is no id).
    ``missed`` is the largest part of a target by which a domain misses it.
    """
    domains = list(shares)
    scored = domain_posteriors(docs, labelled, domains).added_to(docs.select("doc_id", "text"))
    weighed = written(numbered(scored.select("doc_id", "n_tokens", "posterior"), "row"), "mixing-posteriors")
    at = domains.index(anchor) if anchor is not None else None
    history, targets, reached = fit_rates(weighed, list(shares.values()), budget, at, max_rate)
    up = _draw(F.col("doc_id"), F.col("row"), seed) < F.col("rate") - F.floor("rate")
    rated = with_rates(weighed, history, max_rate, len(domains))
    missed = max(map(abs, shortfall(targets, reached)), default=0.0)
    copies = (F.floor("rate") + up.cast("long")).cast("long")
    return rated.select("doc_id", "n_tokens", "posterior", "rate", copies.alias("copies"), F.lit(missed).alias("missed"))


def _draw(doc_id, row, seed: int):
    """A draw by the id; rows without an id draw for themselves."""
    return F.when(doc_id.isNull(), spread(row, F.lit(seed))).otherwise(spread(doc_id, F.lit(seed)))


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from the table of labels: toxic, else poor, else good."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain")).where(F.col("domain").isNotNull())


def mixed(docs: DataFrame, labelled: DataFrame, shares: dict[str, float], anchor: str) -> DataFrame:
    """The rows of ``docs`` that the mixture takes, with their columns, each at most once.

    Rates are bounded by 1 and the target of ``anchor`` is all that is there
    of it, so the other domains shrink to their weights and nothing repeats.
    Rows that share an id share its draw, each with its own rate; rows without
    an id draw for themselves. The rows are written once with their posteriors,
    so they need no join to find their rates.
    """
    domains = list(shares)
    made = {name: f"_kn_{name}" for name in ("n_tokens", "posterior", "row", "rate")}
    scored = domain_posteriors(docs, labelled, domains).added_to(docs, made["n_tokens"], made["posterior"])
    weighed = written(numbered(scored, made["row"]), "mixing-posteriors")
    narrow = weighed.select(F.col(made["n_tokens"]).alias("n_tokens"), F.col(made["posterior"]).alias("posterior"))
    history, _, _ = fit_rates(narrow, list(shares.values()), None, domains.index(anchor), 1.0)
    rated = with_rates(weighed, history, 1.0, len(domains), made["posterior"], made["rate"])
    taken = _draw(F.col("doc_id"), F.col(made["row"]), 0) < F.col(made["rate"])
    return rated.where(taken).select(*docs.columns)
