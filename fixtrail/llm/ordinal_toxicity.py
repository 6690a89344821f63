"""Toxicity (8): severity grades by cumulative-link ordinal regression on sparse text features.

P(grade ≤ k) = logistic(threshold_k − w·x): one weight per hashed feature, shared by all grades, and ordered thresholds. x
marks which words, and which first letters of words, a text has. The result is the expected severity, the sum of P(grade ≥ k) over the grades above 0.

The labels tell toxic from clean only, so the grades above 0 are made from them: markers are the features that far more
toxic than clean documents of the sample have, and toxic documents with more distinct markers than the toxic ones' median are
grade 2, the others grade 1.

``fit`` draws a bounded sample of labelled documents by a hash of the id, evenly from both labels, weighted back to the
labels' share. Its weights (one number per bucket) travel with the scoring function; nothing is shuffled but the sample.

Defined results: a null or empty text has no words and the severity that the thresholds alone give, and is never rejected; without
labels of both kinds every severity is 0; repeated rows give repeated results; extra columns are ignored by ``grade`` and
kept by ``drop_toxic``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_sliced, whole_text, id_and_text
from .quality_neighbours import draw
from .text_features import PrefixHasher

BUCKETS = 1 << 18
MOST_FEATURES = 4000
LEAST_SIGNIFICANCE = 4.0
MOST_PER_LABEL = 3000
REJECT_FROM = 0.3
SCHEMA = "doc_id bigint, severity double, p_toxic double, p_severe double, grade int, rejected boolean"


def marks(texts: list[str], hasher: PrefixHasher) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, offsets): the distinct buckets of each text, one text after another."""
    rows = [hasher(text) for text in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    return (np.concatenate(rows) if rows else np.zeros(0, np.int32)), offsets


def _row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """P(grade ≥ k) for k = 1, 2, …; one row per text."""
        pull = _row_sums(self.weights[buckets], offsets)
        return _logistic(pull[:, None] - self.thresholds[None, :])


def grades_of(toxic: np.ndarray, buckets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Grades 0, 1 and 2 from the labels and how many distinct markers a toxic text has."""
    owner = np.repeat(np.arange(len(toxic)), np.diff(offsets))
    bad = np.bincount(buckets[toxic[owner] == 1], minlength=BUCKETS)
    good = np.bincount(buckets[toxic[owner] == 0], minlength=BUCKETS)
    rate = ((bad + 0.5) / (1 + (toxic == 1).sum())) / ((good + 0.5) / (1 + (toxic == 0).sum()))
    marker = (rate > 8) & (bad >= 5)
    number = _row_sums(marker[buckets].astype(np.float64), offsets)
    middle = np.median(number[toxic == 1])
    return np.where(toxic == 0, 0, np.where(number > middle, 2, 1))


def telling(toxic: np.ndarray, buckets: np.ndarray, offsets: np.ndarray, most: int = MOST_FEATURES,
            least: float = LEAST_SIGNIFICANCE) -> tuple[np.ndarray, np.ndarray]:
    """Only the features whose share among toxic texts differs significantly from that among clean ones.

    A weight for the others would only fit the sample.
    """
    owner = np.repeat(np.arange(len(toxic)), np.diff(offsets))
    bad, good = (np.bincount(buckets[toxic[owner] == v], minlength=BUCKETS) for v in (1, 0))
    n_bad, n_good = (toxic == 1).sum(), (toxic == 0).sum()
    share = (bad + good + 1) / (n_bad + n_good + 2)
    score = np.abs(bad / n_bad - good / n_good) / np.sqrt(share * (1 - share) * (1 / n_bad + 1 / n_good))
    chosen = np.argsort(-score, kind="stable")[:most]
    wanted = np.zeros(BUCKETS, bool)
    wanted[chosen[score[chosen] >= least]] = True
    keep = wanted[buckets]
    counts = np.bincount(owner[keep], minlength=len(toxic))
    return buckets[keep], np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def fit_ordinal(buckets: np.ndarray, offsets: np.ndarray, grades: np.ndarray, sample_weights: np.ndarray,
                rounds: int = 300, rate: float = 0.05, penalty: float = 1e-4) -> OrdinalModel:
    """Maximum likelihood with a quadratic penalty, by gradient steps of adapted size over the whole sample."""
    used, local = np.unique(buckets, return_inverse=True)
    owner = np.repeat(np.arange(len(grades)), np.diff(offsets))
    weight = np.zeros(len(used))
    start, gap = 1.0, 0.0  # thresholds: start, start + exp(gap)
    share = sample_weights / sample_weights.sum()
    first, second = np.zeros(len(used) + 2), np.zeros(len(used) + 2)
    for step in range(1, rounds + 1):
        thresholds = np.array([start, start + np.exp(gap)])
        pull = _row_sums(weight[local], offsets)
        above = _logistic(pull[:, None] - thresholds[None, :])
        slope = above * (1 - above)
        # Probability of the own grade and its derivative by each threshold's distance.
        one, two = above[:, 0], above[:, 1]
        own = np.maximum(np.where(grades == 0, 1 - one, np.where(grades == 1, one - two, two)), 1e-9)
        by_one = np.where(grades == 0, -slope[:, 0], np.where(grades == 1, slope[:, 0], 0.0)) / own * share
        by_two = np.where(grades == 1, -slope[:, 1], np.where(grades == 2, slope[:, 1], 0.0)) / own * share
        pulls = by_one + by_two
        gradient = np.concatenate([
            penalty * weight - np.bincount(local, pulls[owner], minlength=len(used)),
            [pulls.sum(), by_two.sum() * np.exp(gap)]])
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient ** 2
        move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        weight, start, gap = weight - move[:-2], start - move[-2], gap - move[-1]
    full = np.zeros(BUCKETS)
    full[used] = weight
    return OrdinalModel(full, np.array([start, start + np.exp(gap)]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_per_label: int = MOST_PER_LABEL) -> OrdinalModel:
    """Model from the labelled rows in ``labels (doc_id, <label>)``; texts are taken whole."""
    rows, sizes = draw(docs, labels, label, most_per_label, "toxicity")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PrefixHasher(BUCKETS)
        for batch in byte_sliced(batches, "text", 4 << 20):
            found, offsets = marks(batch.column("text").to_pylist(), hasher)
            lists = [found[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lists, pa.binary()),
                                              batch.column("_label")], ["doc_id", "marks", "label"])

    # The sample's marks; its number of rows is bounded.
    sample = sorted(rows.mapInArrow(marked, "doc_id bigint, marks binary, label int").collect())
    toxic = np.array([r.label for r in sample], np.int64)
    if not (toxic == 0).any() or not (toxic == 1).any():
        return OrdinalModel(np.zeros(BUCKETS), np.array([40.0, 40.0]))
    lists = [np.frombuffer(r.marks, np.int32) for r in sample]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    buckets = np.concatenate(lists).astype(np.int64)
    buckets, offsets = telling(toxic, buckets, offsets)
    back = np.array([sizes[v] / (toxic == v).sum() for v in (0, 1)])
    return fit_ordinal(buckets, offsets, grades_of(toxic, buckets, offsets), back[toxic])


def grade(docs: DataFrame, model: OrdinalModel, reject_from: float = REJECT_FROM) -> DataFrame:
    """``doc_id, severity, p_toxic, p_severe, grade, rejected`` of every row.

    ``severity`` is the expected grade; ``rejected`` holds from ``reject_from`` on.
    """
    def graded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PrefixHasher(BUCKETS)
        for batch in byte_sliced(batches, "text", 4 << 20):
            above, severity, rejected = _decide(batch.column("text").to_pylist(), hasher, model, reject_from)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(severity), pa.array(above[:, 0]), pa.array(above[:, -1]),
                pa.array((above >= 0.5).sum(axis=1).astype(np.int32)), pa.array(rejected)],
                [part.split()[0] for part in SCHEMA.split(", ")])

    return id_and_text(docs).mapInArrow(graded, SCHEMA)


def _decide(texts: list[str], hasher: PrefixHasher, model: OrdinalModel, reject_from: float) -> tuple:
    buckets, offsets = marks(texts, hasher)
    above = model.above(buckets, offsets)
    severity = above.sum(axis=1)
    return above, severity, (severity >= reject_from) & (np.diff(offsets) > 0)


def drop_toxic(docs: DataFrame, model: OrdinalModel, reject_from: float = REJECT_FROM) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns; decided in the row, without a join."""
    @F.arrow_udf("boolean")
    def rejected(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = PrefixHasher(BUCKETS)
        for texts in parts:
            found = [_decide(texts.slice(at, 500).to_pylist(), hasher, model, reject_from)[2]
                     for at in range(0, len(texts), 500)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0, bool))
        # The worker lives on and serves other stages.
        pa.default_memory_pool().release_unused()

    return docs.where(~rejected(whole_text()))
