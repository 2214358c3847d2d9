"""A quality classifier learnt from trusted positives and unlabelled text.

Each text becomes a short vector of shares and lengths (letters, marks, repeats, lines), each
cut into bands, so that a linear score can bend. It is fitted by minimising the non-negative
unbiased risk of positive-unlabelled learning,

    prior * mean_P loss(g) + max(0, mean_U loss(-g) - prior * mean_P loss(-g)),

where the prior, the share of positives among the unlabelled, is estimated first. The fit uses
bounded samples of rows, taken by a hash of id and text; scores are computed for every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from grantlens.llm.common import byte_values, small_batches

#: At most so many trusted positives and unlabelled texts are used to fit.
MOST_POSITIVE, MOST_UNLABELLED = 10_000, 20_000
#: Each feature is cut at these quantiles of the unlabelled sample.
CUTS = (0.005, 0.02, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98, 0.995)
ROUNDS, RATE, DECAY = 400, 0.05, 3e-3
#: Prior and threshold are set on rows that the weights were not fitted on, in so many turns.
TURNS = 3
#: The share of trusted positives that the threshold turns away.
MISSED = 0.005
THRESHOLD = 0.7
#: Rows whose id has this remainder are held out: their labels are never used.
FOLDS, HELD_OUT = 4, 2
#: Parts of 2**20 by which samples are taken from a hash of the id.
PARTS = 1 << 20

MARKS = np.frombuffer(b".,;:!?|#%&$*@/\\_=+-<>(){}[]\"'^~`", np.uint8)
SENTENCE_ENDS = (b".", b"!", b"?")


def features(text: bytes) -> list[float]:
    """Shares and lengths that say how a text is written, not what about."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, w, k = max(len(text), 1), max(len(words), 1), max(len(lines), 1)
    upper, lower, kinds = int(counts[65:91].sum()), int(counts[97:123].sum()), len(set(words))
    return [
        np.log1p(len(words)),
        kinds / w,
        np.log1p(kinds) / np.log1p(w),
        sum(map(eq, words, words[1:])) / w,
        sum(map(eq, words, words[2:])) / w,
        len(set(lines)) / k,
        np.log1p(len(words) / k),
        sum(line.endswith(SENTENCE_ENDS) for line in lines) / k,
        sum(word.endswith(SENTENCE_ENDS) for word in words) / w,
        len(words) / n,
        np.log1p(max(map(len, words), default=0)),
        upper / n,
        upper / max(upper + lower, 1),
        int(counts[48:58].sum()) / n,
        int(counts[128:].sum()) / n,
        *(counts[MARKS] / n).tolist(),
    ]


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


def descend(gradient, size: int) -> np.ndarray:
    """Adam from zero over the whole sample; the same sample always gives the same weights."""
    weights, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, ROUNDS + 1):
        slope = gradient(weights) + DECAY * weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope * slope
        weights -= RATE * (1 - (step - 1) / ROUNDS) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights


def in_turns(positive: np.ndarray, unlabelled: np.ndarray, fitted) -> tuple[np.ndarray, np.ndarray]:
    """Linear scores of both samples, each row by weights fitted on the other turns' rows."""
    ours, theirs = np.zeros(len(positive)), np.zeros(len(unlabelled))
    for turn in range(TURNS):
        p, u = np.arange(len(positive)) % TURNS == turn, np.arange(len(unlabelled)) % TURNS == turn
        if p.all() or u.all():  # too few rows to leave any out
            p, u = ~p, ~u
        weights = fitted(positive[~p], unlabelled[~u])
        ours[p], theirs[u] = positive[p] @ weights, unlabelled[u] @ weights
    return ours, theirs


def tell_apart(positive: np.ndarray, unlabelled: np.ndarray) -> np.ndarray:
    """Weights of a logistic score of the first sample against the second."""

    def gradient(weights: np.ndarray) -> np.ndarray:
        missed, taken = sigmoid(-positive @ weights), sigmoid(unlabelled @ weights)
        return unlabelled.T @ taken / len(unlabelled) - positive.T @ missed / len(positive)

    return descend(gradient, positive.shape[1])


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives in the unlabelled sample.

    A score that tells the two samples apart ranks the texts. Above any value of it the
    unlabelled share is at least the prior times the positive one, and about equal where
    only positives are left, so the least ratio is taken.
    """
    ours, theirs = in_turns(positive, unlabelled, tell_apart)
    ratios = [(theirs >= t).mean() / (ours >= t).mean() for t in np.quantile(ours, np.linspace(0.02, 0.6, 30))]
    return float(np.clip(min(ratios), 0.01, 0.99))


def fit_weights(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights that minimise the non-negative risk with logistic loss.

    Where the negative part of the risk falls below zero it counts as zero, so that only the
    positive part is followed.
    """

    def gradient(weights: np.ndarray) -> np.ndarray:
        ours, theirs = positive @ weights, unlabelled @ weights
        risk = np.logaddexp(0, theirs).mean() - prior * np.logaddexp(0, ours).mean()
        negative = unlabelled.T @ sigmoid(theirs) / len(unlabelled) - prior * (positive.T @ sigmoid(ours)) / len(positive)
        missed = prior * (positive.T @ sigmoid(-ours)) / len(positive)
        return -missed if risk < 0 else negative - missed

    return descend(gradient, positive.shape[1])


def threshold_shift(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """What to add to the constant so that ``MISSED`` of the trusted positives fall below ``THRESHOLD``."""
    ours, _ = in_turns(positive, unlabelled, lambda p, u: fit_weights(p, u, prior))
    return float(np.log(THRESHOLD / (1 - THRESHOLD)) - np.quantile(ours, MISSED))


@dataclass
class Model:
    """Cuts of each feature, one weight per cut and a constant; ``prior`` as estimated."""

    cuts: list[np.ndarray]
    weights: np.ndarray
    prior: float

    def bands(self, rows: np.ndarray) -> np.ndarray:
        columns = [np.ones((len(rows), 1))]
        for k, cuts in enumerate(self.cuts):
            columns += [rows[:, k : k + 1] > cuts, rows[:, k : k + 1] >= cuts[:1]]
        return np.hstack(columns).astype(np.float64)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.bands(rows) @ self.weights)


def held_out(doc_id: str) -> Column:
    """Whether crc32 of the id as text leaves the held-out remainder; a NULL id is not held out."""
    remainder = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def sampled(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """At most about ``most`` of the rows, by a hash of some of their columns."""
    count = rows.count()
    mixed = F.xxhash64(*by, F.lit("sample"))
    return rows.where(F.pmod(mixed, F.lit(PARTS)) < int(PARTS * min(1.0, 1.2 * most / count))) if count > most else rows


def sample_rows(texts: DataFrame, most: int) -> np.ndarray:
    """Features of the rows (``id``, ``text``); of more than ``most``, those first by a hash of both."""
    width = len(features(b""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = np.array([features(value) for value in byte_values(batch.column(1))], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(rows), pa.list_(pa.float64()))], ["mixed", "row"])

    mixed = F.xxhash64("id", "text", F.lit("sample"))
    picked = texts.select(mixed.alias("mixed"), "text").mapInArrow(run, "mixed long, row array<double>")
    # rows are counted, not ids: an id may have many
    found = (picked.orderBy("mixed").limit(most) if texts.count() > most else picked).toArrow()
    return found["row"].combine_chunks().flatten().to_numpy().reshape(-1, width) if found.num_rows else np.zeros((0, width))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    """Fit on rows that are not held out; None where there is no positive or no text.

    At most ``MOST_POSITIVE`` rows labelled 1 are the trusted positives, at most
    ``MOST_UNLABELLED`` rows of ``docs`` the unlabelled ones. Labels of 0 are not used.
    """
    positive = labels.where((F.col(label) == 1) & ~held_out(doc_id)).select(F.col(doc_id).alias("id")).where("id is not null").distinct()
    texts = docs.where(~held_out(doc_id)).select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("id is not null")
    chosen = sampled(positive, MOST_POSITIVE, "id").orderBy(F.xxhash64("id", F.lit("sample"))).limit(MOST_POSITIVE)
    ours = sample_rows(texts.join(F.broadcast(chosen), "id").select("id", "text"), MOST_POSITIVE)
    theirs = sample_rows(sampled(texts, MOST_UNLABELLED, "id", "text"), MOST_UNLABELLED)
    if not len(ours) or not len(theirs):
        return None
    model = Model([np.unique(np.quantile(theirs[:, k], CUTS)) for k in range(theirs.shape[1])], np.zeros(0), 0.0)
    ours, theirs = model.bands(ours), model.bands(theirs)
    model.prior = class_prior(ours, theirs)
    model.weights = fit_weights(ours, theirs, model.prior)
    model.weights[0] += threshold_shift(ours, theirs, model.prior)
    return model


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row of ``docs`` with ``held_out``, ``score`` (0 to 1) and ``predicted`` (0 or 1).

    The score depends on the whole text alone; a NULL text is empty and scored like any
    other. Without a model every score is 0.5. Columns named like those added are replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")
    place, names = docs.columns.index(text), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            if model is None:
                scores = np.full(batch.num_rows, 0.5)
            else:
                scores = model.score(np.array([features(value) for value in byte_values(batch.column(place))], np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*names, "score"])

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    scored = docs.mapInArrow(run, schema)
    return scored.withColumns(
        {"held_out": held_out(doc_id), "predicted": F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)}
    )
