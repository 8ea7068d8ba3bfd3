"""Toxicity by weak supervision: voters, a generative label model, a linear
classifier on its posterior labels.

* Features of a text: 64-bit hashes of its words and of their prefixes of 4 to
  7 bytes (present or not).
* Voters: of a bounded sample of labelled rows (``SAMPLE`` at most, outside the
  held-out fold, by hash order) the features most telling of toxic rows (by the
  log-likelihood ratio, counted in Spark) become
  lexicon voters (words) and pattern voters (prefixes) that vote toxic where
  they are present; the features most telling of clean rows vote clean.
* Label model: one latent class; a voter fires with its own rate in either
  class, and abstains where it does not fire (a lexicon of one language says
  nothing about texts of another).  The rates are estimated by expectation maximization from the votes,
  started at the labelled rates.  Voters that fire together beyond what the
  class explains (correlation of their residuals) share a block, and a block
  counts as one voter's evidence, so copies of a voter do not add up.
* Classifier: logistic regression over the features that occur often enough,
  trained on the posterior labels (labels of the sample enter as two more
  votes of known accuracy).

Scores come from the text alone.  A null or empty text has no features and
gets the score of the bias.  Repeated rows get equal scores; a null doc_id
counts as the empty text in the fold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tideline.llm.common import U64, WordHasher, fold, letter_words, slices, staged

SAMPLE = 10_000  # labelled rows that are fitted on
PREFIXES = (4, 5, 6, 7)  # bytes
VOTERS = 120  # of each polarity
FEATURES = 800  # of the linear classifier, the most significant ones
SIGNIFICANT = 12.0  # least log-likelihood ratio of a feature against the label
MIN_ROWS = 4  # rows of the sample that have a feature
ROUNDS = 30
RIDGE = 0.3
LABEL_TRUST = 0.97  # accuracy of a given label, as a vote


def _features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher(letter_words(), PREFIXES)
    for part in slices(parts):
        rows = [np.unique(hasher.features(t)).view(np.int64) for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(rows, pa.list_(pa.int64()))], names=["toxic", "features"])


def sample(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, rows: int = SAMPLE) -> DataFrame:
    """(toxic, features) of at most ``rows`` labelled rows outside the fold,
    the first by a hash of doc_id."""
    own = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    own = own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    first = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(first), "doc_id")
    return texts.select("toxic", "text").mapInArrow(_features, "toxic int, features array<long>")


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float
    voters: int = 0
    blocks: int = 0

    def scores(self, texts: list[str | None]) -> np.ndarray:
        hasher = WordHasher(letter_words(), PREFIXES)
        out = np.full(len(texts), self.bias)
        if len(self.features):
            for i, t in enumerate(texts):
                h = hasher.features(t)
                if len(h):
                    at = np.minimum(np.searchsorted(self.features, h), len(self.features) - 1)
                    out[i] += self.weights[np.unique(at[self.features[at] == h])].sum()
        return 1.0 / (1.0 + np.exp(-np.clip(out, -30, 30)))


def _label_model(votes: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, int]:
    """Posterior of the toxic class for each row of the 0/1 votes, and the
    number of blocks of correlated voters."""
    rows, m = votes.shape
    prior = min(max(toxic.mean(), 1e-3), 1 - 1e-3)
    post = np.where(toxic == 1, LABEL_TRUST, 1 - LABEL_TRUST)
    share = np.ones(m)
    blocks = m
    for turn in range(ROUNDS):
        w1, w0 = post.sum(), (1 - post).sum()
        fires1 = (votes.T @ post + 0.5) / (w1 + 1)
        fires0 = (votes.T @ (1 - post) + 0.5) / (w0 + 1)
        if turn == 1:  # correlations that are left once the class is known
            left = votes - np.outer(post, fires1) - np.outer(1 - post, fires0)
            spread = np.sqrt((left**2).mean(axis=0)) + 1e-9
            corr = (left.T @ left) / rows / np.outer(spread, spread)
            near = corr > 0.5
            share = 1.0 / near.sum(axis=1)
            blocks = int(round(share.sum()))
        on = np.log(fires1 / fires0) * share
        label = np.where(toxic == 1, 1.0, -1.0) * np.log(LABEL_TRUST / (1 - LABEL_TRUST))
        logit = np.log(prior / (1 - prior)) + votes @ on + label
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - post).max() < 1e-4 and turn > 2:
            post = new
            break
        post, prior = new, min(max(new.mean(), 1e-3), 1 - 1e-3)
    return post, blocks


def _logistic(x: np.ndarray, target: np.ndarray, turns: int = 25) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column of ``x`` is
    the constant and goes unpenalized."""
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        grad = x.T @ (p - target) + ridge * weights
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None].astype(x.dtype)).T @ x
        step = np.linalg.solve(curve.astype(np.float64) + np.diag(ridge), grad)
        weights -= step
        if np.abs(step).max() < 1e-3:
            break
    return weights


def fit(features: np.ndarray, ratio: np.ndarray, more: np.ndarray, rows: list[tuple[int, np.ndarray]]) -> Model:
    """``features``: sorted hashes, with their log-likelihood ratios and
    whether they speak for toxic; ``rows``: (toxic, places of the features that
    a row has), the bounded sample."""
    if not rows or not len(features):
        return Model(np.zeros(0, U64), np.zeros(0), -2.0)
    toxic = np.array([r[0] for r in rows], dtype=float)
    x = np.zeros((len(rows), len(features) + 1), dtype=np.float32)
    for i, (_, at) in enumerate(rows):
        x[i, at] = 1
    x[:, -1] = 1
    order = np.argsort(-ratio, kind="stable")
    voters = np.sort(np.concatenate([order[more[order]][:VOTERS], order[~more[order]][:VOTERS]]))
    post, blocks = _label_model(x[:, voters].astype(np.float64), toxic)
    weights = _logistic(x, post)
    return Model(features, weights[:-1], float(weights[-1]), len(voters), blocks)


def _present(known: np.ndarray):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            rows = []
            for own in part.column("features"):
                h = own.values.to_numpy().view(U64) if own.is_valid else np.zeros(0, U64)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                rows.append(at[known[at] == h].astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(rows, pa.list_(pa.int32()))], names=["toxic", "at"])

    return run


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, rows: int = SAMPLE) -> Model:
    own = staged(sample(docs, labels, folds, held_out, rows), "toxic-sample")
    n, n1 = own.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counts = own.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(F.count("*").alias("held"), F.sum("toxic").alias("in1")).filter(F.col("held") >= MIN_ROWS)
    in1, in0 = F.col("in1"), F.col("held") - F.col("in1")
    cells = ((in1, n1, F.col("held")), (in0, n - n1, F.col("held")), (n1 - in1, n1, n - F.col("held")), (n - n1 - in0, n - n1, n - F.col("held")))
    ratio = sum((2 * seen * F.log(F.greatest(seen, F.lit(1e-9)) / F.greatest(every * (total / max(1, n)), F.lit(1e-9))) for seen, total, every in cells), F.lit(0.0))
    told = counts.withColumn("ratio", ratio).filter(F.col("ratio") >= SIGNIFICANT).withColumn("more", in1 * max(1, n - n1) > in0 * max(1, n1))
    top = told.orderBy(F.desc("ratio"), "feature").limit(FEATURES).toPandas()
    hashes = top["feature"].to_numpy(dtype=np.int64).view(U64)
    order = np.argsort(hashes)
    if not len(order):
        return fit(hashes, np.zeros(0), np.zeros(0, bool), [])
    got = own.mapInArrow(_present(hashes[order]), "toxic int, at array<int>").toArrow()  # at most ``rows`` short rows
    data = list(zip(got.column("toxic").to_pylist(), got.column("at").to_pylist()))
    return fit(hashes[order], top["ratio"].to_numpy()[order], top["more"].to_numpy(dtype=bool)[order], data)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``__tl_score``."""
    names = [*docs.columns, "__tl_score"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            scores = model.scores(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("__tl_score", DoubleType())]))
