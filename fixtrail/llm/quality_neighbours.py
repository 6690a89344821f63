"""Quality classifier (10): nearest-neighbour voting in a latent-semantic space.

``fit`` draws a bounded sample of labelled documents, weighs hashed words and word shapes by their rarity in it, and
finds the latent directions of the sample. Its vectors and labels are the voters. They are a few hundred
kB and travel with the scoring function. ``score`` computes, block by block, the cosine of every document with every
voter; the nearest vote with their similarity as weight. Nothing is shuffled but the ids of the sample.

The sample is drawn by a hash of the id, evenly from both labels, and voters are weighted back to the labels' share among
all training labels.

Defined results: a null, empty or blank text has no features and gets the share of label 1; without labels every score is
0.5; repeated rows give repeated results; ties among neighbours count all; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_sliced, id_and_text
from .text_features import Shapes, WordHasher, lower_words

BUCKETS = 1536
SHAPE_BUCKETS = 512
MOST_PER_LABEL = 1500
DIRECTIONS = 48
NEIGHBOURS = 15
SCHEMA = "doc_id bigint, score double, predicted int"


class Vectorizer:
    """Texts → rows of dampened counts, words first, then shapes."""

    def __init__(self):
        self.words, self.shapes, self.of = WordHasher(BUCKETS), WordHasher(SHAPE_BUCKETS, seed=1), Shapes()

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), BUCKETS + SHAPE_BUCKETS), np.float32)
        for row, text in zip(out, texts):
            row[:BUCKETS] = np.bincount(self.words(lower_words(text)), minlength=BUCKETS)
            row[BUCKETS:] = np.bincount(self.shapes(self.of(text)), minlength=SHAPE_BUCKETS)
        np.log1p(out, out)
        return out


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


@dataclass
class Model:
    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray
    weights: np.ndarray
    prior: float
    neighbours: int

    def latent(self, counts: np.ndarray) -> np.ndarray:
        # Words and shapes weigh the same.
        weighed = counts * self.rarity
        return unit(np.hstack([unit(weighed[:, :BUCKETS]), unit(weighed[:, BUCKETS:])]) @ self.directions)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the neighbours, each weighted by its cosine; in blocks of documents."""
        out = np.full(len(counts), self.prior)
        if not len(self.votes):
            return out
        for start in range(0, len(counts), 256):
            block = self.latent(counts[start:start + 256])
            near = block @ self.vectors.T
            k = min(self.neighbours, near.shape[1])
            least = np.partition(near, near.shape[1] - k, axis=1)[:, -k][:, None]
            # Fourth powers set near voters further apart; a negative cosine has no vote.
            weight = np.where(near >= least, np.maximum(near, 0.0) ** 4, 0.0) * self.weights
            total = weight.sum(axis=1)
            share = np.divide(weight @ self.votes, total, out=np.full(len(total), self.prior), where=total > 0)
            out[start:start + 256] = np.where(block.any(axis=1), share, self.prior)
        return np.clip(out, 0.0, 1.0)


def draw(docs: DataFrame, labels: DataFrame, label: str, most: int, seed: str) -> tuple[list, dict[int, int]]:
    """(texts with labels of the sample, number of rows of each label).

    At most ``most`` rows of each label, those with the least hash of id; their number bounds what is broadcast and
    what comes to the driver. Of a repeated id the greatest label counts and the least text.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col(label).cast("int").alias("_label")) \
        .where("_id IS NOT NULL AND _label IN (0, 1)").groupBy("_id").agg(F.max("_label").alias("_label"))
    sizes = {int(k): n for k, n in known.groupBy("_label").count().collect()}
    order = F.md5(F.concat(F.lit(seed), F.col("_id").cast("string")))
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("_label") == value).orderBy(order, "_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (
        id_and_text(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("_label").alias("_label"))
    )
    return rows, sizes


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_per_label: int = MOST_PER_LABEL,
        directions: int = DIRECTIONS, neighbours: int = NEIGHBOURS) -> Model:
    """Model from the labelled rows in ``labels (doc_id, <label>)``; texts are taken whole."""
    rows, sizes = draw(docs, labels, label, most_per_label, "quality")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectorizer = Vectorizer()
        for batch in byte_sliced(batches, "text", 4 << 20):
            counts = vectorizer(batch.column("text").to_pylist()).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.tobytes() for x in counts]),
                                              batch.column("_label")], ["doc_id", "counts", "label"])

    # The sample's counts: at most twice the bound of rows of 4 kB each.
    sample = sorted(rows.mapInArrow(counted, "doc_id bigint, counts binary, label int").collect())
    width = BUCKETS + SHAPE_BUCKETS
    counts = np.array([np.frombuffer(r.counts, np.float16) for r in sample], np.float32).reshape(-1, width)
    votes = np.array([r.label for r in sample], np.float64)
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / total if total else 0.5
    rarity = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    weighed = counts * rarity
    rows_of = np.hstack([unit(weighed[:, :BUCKETS]), unit(weighed[:, BUCKETS:])])
    # Directions: leading eigenvectors of the features' products, the right singular vectors of the sample.
    values, vectors = np.linalg.eigh(rows_of.T @ rows_of) if len(rows_of) else (np.ones(width), np.eye(width))
    found = vectors[:, np.argsort(values)[::-1][:directions]].astype(np.float32)
    drawn = [(votes == v).sum() for v in (0, 1)]
    back = np.array([sizes.get(v, 0) / max(1, drawn[v]) for v in (0, 1)])
    model = Model(rarity, found, np.zeros((0, directions), np.float32), votes, back[votes.astype(int)], prior, neighbours)
    model.vectors = model.latent(counts) if len(counts) else model.vectors
    return model


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` of every row."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectorizer = Vectorizer()
        for batch in byte_sliced(batches, "text", 2 << 20):
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                score = model.score(vectorizer(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    ["doc_id", "score", "predicted"])

    return id_and_text(docs).mapInArrow(scored, SCHEMA)
