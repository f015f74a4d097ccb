"""Quality by nearest-neighbour voting among labelled documents in a latent-semantic space."""

from __future__ import annotations

import itertools
import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import map_batches, slices, whole_text
from signalloom.llm.toxicity import held_out, labelled_sample
from signalloom.operators.staging import staged


@dataclass(frozen=True)
class QualityParams:
    """Bounds and weights of the model; the bounds hold for what is learned, never for what is scored."""

    #: Most labelled documents to learn from (those of the smallest hashes).
    max_labelled: int = 8192
    #: Byte trigrams are hashed to this many features.
    features: int = 8192
    #: Latent dimensions.
    rank: int = 48
    neighbours: int = 31
    #: Neighbours vote with their cosine to this power.
    sharpness: float = 8.0


def trigram_counts(text: str, features: int) -> np.ndarray:
    """How often each hashed trigram of bytes is in the text (padded, so that one byte has trigrams too)."""
    raw = np.frombuffer(b"\n" + text.encode("utf-8", "surrogatepass") + b"\n", np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(features)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - features.bit_length() + 1), minlength=features)


def document_frequencies(documents: DataFrame, features: int) -> tuple[int, np.ndarray]:
    """Number of documents, and in how many each feature is: over all documents, summed within tasks first."""

    def run(batches):
        df, n = np.zeros(features, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                df += trigram_counts(text, features) > 0
            n += batch.num_rows
        yield pa.record_batch({"i": np.arange(-1, features), "n": np.insert(df, 0, n)})

    sums = documents.select(whole_text().alias("text")).mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    found = {r["i"]: r["n"] for r in sums.collect()}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(features)])


#: Weight of the two repetition features next to a unit vector of trigrams.
REPETITION = 1.5


def repetition(text: str) -> list[float]:
    """Share of words that repeat the word before them, and of lines that repeat an earlier line."""
    own = text.split()
    lines = [x for x in text.split("\n") if x]
    again = sum(map(operator.eq, own, itertools.islice(own, 1, None)))
    return [again / max(1, len(own)), 1 - len(set(lines)) / max(1, len(lines))]


@dataclass
class LatentSpace:
    idf: np.ndarray
    #: (features + 2) x rank; float32 halves what is broadcast.
    axes: np.ndarray | None = None
    vectors: np.ndarray | None = None
    y: np.ndarray | None = None
    base_rate: float = 0.5

    def weigh(self, text: str) -> np.ndarray:
        x = np.log1p(trigram_counts(text, len(self.idf))) * self.idf
        norm = np.sqrt(x @ x)
        x = np.append(x / norm if norm > 0 else x, REPETITION * np.array(repetition(text)))
        norm = np.sqrt(x @ x)
        return (x / norm if norm > 0 else x).astype(np.float32)

    def place(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.axes
        norm = np.sqrt((z * z).sum(axis=1, keepdims=True))
        return np.divide(z, norm, out=np.zeros_like(z), where=norm > 1e-6)

    def fit(self, x: np.ndarray, y: np.ndarray, rank: int) -> LatentSpace:
        """Axes by a randomised singular value decomposition of the weighed sample (seeded, power iterations)."""
        if len(x):
            rank = min(rank, *x.shape)
            q = np.random.default_rng(11).standard_normal((x.shape[1], min(rank + 16, min(x.shape)))).astype(np.float32)
            for _ in range(4):
                q, _ = np.linalg.qr(x.T @ (x @ q))
            _, _, v = np.linalg.svd(x @ q, full_matrices=False)
            self.axes = (q @ v.T[:, :rank]).astype(np.float32)
            self.vectors = self.place(x).astype(np.float32)
        self.y, self.base_rate = y.astype(np.float32), float((y.sum() + 1) / (len(y) + 2))
        return self

    def votes(self, x: np.ndarray, params: QualityParams) -> np.ndarray:
        """Scores of weighed texts, from exact cosines with every labelled vector."""
        if self.vectors is None:
            return np.full(len(x), self.base_rate)
        cosine = self.place(x) @ self.vectors.T
        k = min(params.neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(cosine, near, axis=1), 0) ** params.sharpness
        total = w.sum(axis=1)
        score = ((w * self.y[near]).sum(axis=1) + self.base_rate * 0.5) / (total + 0.5)
        return score.astype(np.float64)


def learned(documents: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> LatentSpace:
    """Space and labelled vectors from a bounded sample outside the held-out fold; idf from all documents."""
    params = params or QualityParams()
    sample = staged(labelled_sample(documents, labels, "quality", 3, 1, params.max_labelled), "labelled")
    n, df = document_frequencies(documents, params.features)
    space = LatentSpace(np.log((1 + n) / (1 + df)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [space.weigh(t) for t in batch.column("text").to_pylist()]
        at = [np.flatnonzero(r).astype(np.int16) for r in rows]
        return pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "y": batch.column("y"),
                "at": pa.array([a.tobytes() for a in at], pa.binary()),
                "w": pa.array([r[a].tobytes() for r, a in zip(rows, at)], pa.binary()),
            }
        )

    rows = sorted(map_batches(sample, run, "doc_id long, y int, at binary, w binary").collect())
    x = np.zeros((len(rows), params.features + 2), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["at"], np.int16)] = np.frombuffer(r["w"], np.float32)
    return space.fit(x, np.array([r["y"] for r in rows]), params.rank)


def quality(documents: DataFrame, labels: DataFrame, params: QualityParams | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``documents``, from its whole text.

    The labelled vectors and axes that are broadcast have ``max_labelled`` x ``rank`` and ``features`` x
    ``rank`` numbers at most. Documents are compared with all of them in blocks. Neighbours' labels are
    weighted by cosine to the power ``sharpness``; half a vote of the base rate is added, which is the score
    of a text without features, an empty or null one included. Without labels every score is one half.
    Repeated rows score alike, no rows give no rows.
    """
    params = params or QualityParams()
    shared = documents.sparkSession.sparkContext.broadcast(learned(documents, labels, params))

    def run(batches):
        space = shared.value
        for batch in slices(batches, most=1 << 20):
            texts = batch.column("text").to_pylist()
            scores = [
                space.votes(np.stack([space.weigh(t) if t else np.zeros(params.features + 2, np.float32) for t in texts[a : a + 256]]), params)
                for a in range(0, len(texts), 256)
            ]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": np.clip(np.concatenate(scores), 0, 1)})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return docs.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
