"""Quality classification by nearest-neighbour voting among labelled latent-semantic vectors.

A text's features are hashed byte trigrams and hashed runs of five character classes, counted over the whole text and
damped by logarithm; inverse document frequencies and a truncated singular value decomposition, both from the labelled
sample, turn them into a short vector. The labelled vectors are broadcast; each block of documents is multiplied with
all of them, and the labels of the nearest NEIGHBOURS vote, weighted by a power of their cosine.

The labelled sample is bounded: about SAMPLE rows, chosen by a hash of doc_id at a rate that a count over all labelled
rows gives. Its vectors take SAMPLE * RANK * 4 bytes (half a MB) whatever the input's size.

Defined results: a text with no features (null, empty or shorter than three bytes) scores the labels' mean; where
nothing could be learned the score is 0.5. Of repeated labels of one document any is learned, of documents that
share a doc_id the least text; repeated rows each have a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import flat, in_arrow, slices

SAMPLE = 4000
RANK = 32
BINS = 1024
NEIGHBOURS = 25
POWER = 4.0

#: Classes: lower letters and all bytes from 128 on, capitals, digits, white space; other characters stand for themselves.
CLASS = np.arange(256, dtype=np.uint32)
CLASS[97:123] = CLASS[128:] = 1
CLASS[65:91] = 2
CLASS[48:58] = 3
CLASS[[9, 11, 12, 13, 32]] = 4


def features(data: np.ndarray, offsets: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Damped counts of each text data[offsets]: bins of byte trigrams, then bins of class 5-grams."""
    out = np.zeros((len(offsets) - 1, 2 * bins), np.float32)
    shift = np.uint32(32 - (bins - 1).bit_length())
    d = data.astype(np.uint32)
    c = CLASS[data]
    tri = ((d[:-2] * np.uint32(65599) + d[1:-1]) * np.uint32(65599) + d[2:]) * np.uint32(2654435769) >> shift if len(d) > 2 else d[:0]
    five = c[: len(c) - 4] if len(c) > 4 else c[:0]
    for k in range(1, 5 if len(c) > 4 else 1):
        five = five * np.uint32(69069) + c[k : len(c) - 4 + k]
    five = five * np.uint32(2654435769) >> shift
    for n, (a, z) in enumerate(zip(offsets, offsets[1:], strict=False)):
        if z - a > 2:
            out[n, :bins] = np.bincount(tri[a : z - 2], minlength=bins)
        if z - a > 4:
            out[n, bins:] = np.bincount(five[a : z - 4], minlength=bins)
    return np.log1p(out, out=out)


class Model:
    def __init__(self, x: np.ndarray, y: np.ndarray, rank: int = RANK, seed: int = 6):
        """x: features of the labelled texts, y: their labels, 0 or 1."""
        self.idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
        x = self.normal(x)
        rng = np.random.default_rng(seed)
        rank = max(1, min(rank, *x.shape))
        q = x.T @ (x @ rng.normal(size=(x.shape[1], rank + 8)).astype(np.float32))
        for _ in range(4):
            q = x.T @ (x @ np.linalg.qr(q)[0])
        q = np.linalg.qr(q)[0]
        _, s, v = np.linalg.svd(x @ q, full_matrices=False)
        self.basis = np.ascontiguousarray((q @ v.T[:, :rank]) / np.sqrt(np.maximum(s[:rank], 1e-6)), np.float32)
        self.vectors = np.ascontiguousarray(self.latent(x).T)
        self.labels = y.astype(np.float32)
        self.mean = float(y.mean())

    def normal(self, x: np.ndarray) -> np.ndarray:
        x = x * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def latent(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def scores(self, x: np.ndarray, block: int = 256) -> np.ndarray:
        out = np.full(len(x), self.mean)
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(x), block):
            some = x[at : at + block]
            cosine = self.latent(self.normal(some)) @ self.vectors
            near = np.argpartition(cosine, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0) ** POWER + 1e-6
            vote = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
            known = some.any(axis=1)
            out[at : at + block][known] = np.clip(vote[known], 0, 1)
        return out


def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        x = features(*flat(b.column("text")))
        yield pa.RecordBatch.from_arrays(
            [b.column("quality"), pa.array([v.astype(np.float16).tobytes() for v in x], pa.binary())], ["quality", "x"]
        )


def fit(docs: DataFrame, labels: DataFrame, use: Column, sample: int = SAMPLE) -> Model | None:
    """Learn quality from the labelled documents that `use` selects; None if there is none.

    The sample has about `sample` rows, so both the broadcast side of the join and what is collected are bounded.
    """
    rows = labels.where(use & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    n = rows.count()
    if not n:
        return None
    chosen = rows.where(
        F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < min(1.0, sample / n) * (1 << 30)
    ).dropDuplicates(["doc_id"])
    both = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("quality", "text")).alias("one")
    )
    got = both.select("one.quality", "one.text").transform(in_arrow, vectors, "quality int, x binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r.quality, bytes(r.x)))
    return Model(np.stack([np.frombuffer(r.x, np.float16) for r in got]).astype(np.float32), np.array([r.quality for r in got]))


def scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in slices(batches):
            x = features(*flat(b.column("text")))
            s = m.scores(x) if m is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(s, pa.float64())], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """A row per document: doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").transform(in_arrow, scored(shared), "doc_id long, score double")
