"""Language ID by a bidirectional gated recurrent network over bytes.

Texts are cut into blocks of `STEPS` bytes. In each block one gated recurrence runs from the left and one from the
right; their states label every byte position with probabilities of the languages, and a document's probabilities are
the mean over all its positions. The weights are trained here, in numpy, by backpropagation through time.

Training uses a bounded sample of rows, whole texts: about SAMPLE documents of each language, or as many as have
SAMPLE_BYTES bytes if these are fewer (chosen by a hash at a rate that a count over all labelled rows gives). Prediction
reads every byte of every text. Blocks begin afresh, so that all blocks of a slice advance together; a state carried
through a text would make each byte wait for the one before.

Defined results: the prediction is `und` with score 0 for null texts and texts without a letter; null with score 0 for
other texts where nothing could be learned; otherwise a learned language and its pooled probability. Repeated rows each have a row; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import flat, in_arrow, slices

STEPS = 64
HIDDEN = 8
SAMPLE = 200
SAMPLE_BYTES = 4 << 20
#: Passes over the sample, and updates that a small sample gets at least.
EPOCHS = 2
UPDATES = 190
UNDETERMINED = "und"


class Direction:
    """One gated recurrence: h += f * (c - h), with f = clip(z / 4 + 1/2, 0, 1) and c = tanh(z')."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.inputs = rng.normal(0, 0.3, (2, 256, hidden)).astype(np.float32)
        self.state = rng.normal(0, 0.3, (2, hidden, hidden)).astype(np.float32)

    def run(self, x: np.ndarray, mask: np.ndarray, partial: int, keep: bool = False):
        """States after each step for bytes x (steps, blocks); the first `partial` blocks have a mask."""
        steps, n = x.shape
        k = self.state.shape[1]
        h = np.zeros((n, k), np.float32)
        out = np.empty((steps, n, k), np.float32)
        z = np.empty((n, k), np.float32)
        f, c = np.empty_like(z), np.empty_like(z)
        kept = []
        # the scaling of the gate is done once on its weights
        gate_in, gate_state = self.inputs[0] * np.float32(0.25) + np.float32(0.5), self.state[0] * np.float32(0.25)
        for t in range(steps):
            if keep:
                f, c = np.empty_like(z), np.empty_like(z)
            np.take(gate_in, x[t], axis=0, out=f)
            f += np.matmul(h, gate_state, out=z)
            np.maximum(f, 0, out=f)
            np.minimum(f, 1, out=f)
            np.take(self.inputs[1], x[t], axis=0, out=c)
            c += np.matmul(h, self.state[1], out=z)
            np.tanh(c, out=c)
            if keep:
                kept.append((h, f, c))
            nxt = np.subtract(c, h, out=out[t])
            nxt *= f
            nxt += h
            if partial:
                nxt[:partial] *= mask[t, :partial, None]
            h = nxt
        return (out, kept) if keep else out

    def back(self, x: np.ndarray, kept: list, dout: np.ndarray) -> list[np.ndarray]:
        """Gradients of inputs and state by backpropagation through time."""
        steps, n, k = dout.shape
        dz = np.empty((2, steps, n, k), np.float32)
        dstate = np.zeros_like(self.state)
        dh = np.zeros((n, k), np.float32)
        for t in range(steps - 1, -1, -1):
            h, f, c = kept[t]
            dh = dh + dout[t]
            dz[0, t] = dh * (c - h) * 0.25 * ((f > 0) & (f < 1))
            dz[1, t] = dh * f * (1 - c * c)
            for g in (0, 1):
                dstate[g] += h.T @ dz[g, t]
            dh = dh * (1 - f) + dz[0, t] @ self.state[0].T + dz[1, t] @ self.state[1].T
        flat_x = x.ravel()
        dinputs = np.stack([np.stack([np.bincount(flat_x, d[:, j], 256) for j in range(k)], axis=1) for d in dz.reshape(2, -1, k)])
        return [dinputs.astype(np.float32), dstate]


class Network:
    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 4):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.forth, self.back = Direction(rng, hidden), Direction(rng, hidden)
        self.out = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def probabilities(self, x: np.ndarray, mask: np.ndarray, partial: int) -> np.ndarray:
        """Of the languages, at every position: (steps, blocks, languages)."""
        k = self.out.shape[0] // 2
        z = self.forth.run(x, mask, partial).reshape(-1, k) @ self.out[:k]
        z += self.back.run(x[::-1], mask[::-1], partial)[::-1].reshape(-1, k) @ self.out[k:]
        z += self.bias
        return softmax(z).reshape(*x.shape, -1)

    def train(
        self, windows: np.ndarray, sizes: np.ndarray, labels: np.ndarray, epochs: int = 0, batch: int = 256, rate: float = 0.02,
        seed: int = 5
    ) -> None:
        """windows (n, STEPS) bytes of which sizes are valid, labels by index of language; Adam on the mean position loss."""
        epochs = epochs or max(EPOCHS, -(-UPDATES * batch // len(windows)))
        rng = np.random.default_rng(seed)
        params = [self.forth.inputs, self.forth.state, self.back.inputs, self.back.state, self.out, self.bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        done, total = 0, epochs * -(-len(windows) // batch)
        k = self.out.shape[0] // 2
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                x = np.ascontiguousarray(windows[some].T)
                mask = (np.arange(x.shape[0])[:, None] < sizes[some]).astype(np.float32)
                hf, kf = self.forth.run(x, mask, len(some), keep=True)
                hb, kb = self.back.run(x[::-1], mask[::-1], len(some), keep=True)
                hb = hb[::-1]
                p = softmax(hf.reshape(-1, k) @ self.out[:k] + hb.reshape(-1, k) @ self.out[k:] + self.bias).reshape(*x.shape, -1)
                p[:, np.arange(len(some)), labels[some]] -= 1
                p *= (mask / mask.sum())[:, :, None]
                d = p.reshape(-1, p.shape[2])
                dout = np.concatenate([hf.reshape(-1, k).T @ d, hb.reshape(-1, k).T @ d])
                df = (d @ self.out[:k].T).reshape(hf.shape)
                db = (d @ self.out[k:].T).reshape(hf.shape)[::-1]
                grads = [*self.forth.back(x, kf, df), *self.back.back(x[::-1], kb, db), dout, d.sum(axis=0)]
                done += 1
                lr = rate * (1 - done / (total + 1)) * np.sqrt(1 - 0.99**done) / (1 - 0.9**done)
                for p_, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p_ -= (lr * m / (np.sqrt(v) + 1e-8)).astype(np.float32)

    def pooled(self, data: np.ndarray, offsets: np.ndarray, at_once: int = 2048) -> np.ndarray:
        """Mean probabilities of each text data[offsets]; texts without bytes get zeros."""
        lengths = np.diff(offsets)
        sums = np.zeros((len(lengths), len(self.languages)))
        # the last, partial blocks of the texts come first
        rest = lengths % STEPS
        partial = np.flatnonzero(rest)
        whole = lengths // STEPS
        text = np.r_[partial, np.repeat(np.arange(len(lengths)), whole)]
        start = np.r_[
            offsets[partial] + whole[partial] * STEPS,
            np.repeat(offsets[:-1], whole) + STEPS * (np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole))
        ]
        size = np.r_[rest[partial], np.full(whole.sum(), STEPS)]
        for at in range(0, len(text), at_once):
            s, n = start[at : at + at_once], size[at : at + at_once]
            x = data[np.minimum(s + np.arange(STEPS)[:, None], len(data) - 1)]
            cut = int((n < STEPS).sum())
            mask = (np.arange(STEPS)[:, None] < n).astype(np.float32)
            p = self.probabilities(x, mask, cut)
            if cut:
                p *= mask[:, :, None]
            by_block = p.sum(axis=0)
            for j in range(len(self.languages)):
                sums[:, j] += np.bincount(text[at : at + at_once], by_block[:, j], len(lengths))
        return sums / np.maximum(lengths, 1)[:, None]


def softmax(z: np.ndarray) -> np.ndarray:
    """Over the last axis of n x languages, in place."""
    if z.size and max(z.max(), -z.min()) > 60:
        z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= (z @ np.ones(z.shape[1], z.dtype))[:, None]
    return z


def blocks_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All blocks of the texts: bytes (n, STEPS), how many of them are valid, and the text of each block."""
    cut = [(n, t[a : a + STEPS]) for n, t in enumerate(texts) for a in range(0, len(t), STEPS)]
    sizes = np.array([len(x) for _, x in cut])
    data = np.frombuffer(b"".join([x.ljust(STEPS, b"\0") for _, x in cut]), np.uint8).reshape(-1, STEPS)
    return data, sizes, np.array([n for n, _ in cut])


def fit(docs: DataFrame, use: Column, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network | None:
    """Learn from text and lang of the rows that `use` selects; None if there is no such row.

    What is collected is about `sample` rows a language, or rows of about `sample_bytes` bytes, whatever the input.
    """
    rows = docs.where(use & F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "lang", "text")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).collect()
    if not counts:
        return None
    rates = [F.lit(x) for r in counts for x in (r.lang, min(1.0, sample / r.n, sample_bytes / r.size))]
    rate = F.element_at(F.create_map(*rates), F.col("lang"))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(1 << 20)) < rate * (1 << 20))
    got = sorted((r.lang, r.text.encode()) for r in chosen.select("lang", "text").collect())
    if not got:
        return None
    languages = sorted({lang for lang, _ in got})
    windows, sizes, text = blocks_of([t for _, t in got])
    net = Network(languages)
    net.train(windows, sizes, np.array([languages.index(lang) for lang, _ in got])[text])
    return net


def labels(net: Network | None, column: pa.Array) -> tuple[list[str | None], np.ndarray]:
    """The language and score of each text."""
    lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in column.to_pylist()], bool)
    if net is None or not lettered.any():
        return [None if ok else UNDETERMINED for ok in lettered], np.zeros(len(lettered))
    p = net.pooled(*flat(column))
    best = p.argmax(axis=1)
    scores = np.where(lettered, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
    return [net.languages[k] if ok else UNDETERMINED for k, ok in zip(best, lettered, strict=True)], scores


def labelled(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=1 << 20):
            names, scores = labels(net, b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"]
            )

    return run


def determined(net: Network | None):
    """The rows whose text is not undetermined, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=1 << 20):
            yield b.filter(pa.array([name != UNDETERMINED for name in labels(net, b.column("text"))[0]], pa.bool_()))

    return run


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """A row per document: doc_id, lang_pred, score."""
    return docs.select("doc_id", "text").transform(in_arrow, labelled(net), "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id", modulus: int = 4, rest: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == rest, F.lit(False))
