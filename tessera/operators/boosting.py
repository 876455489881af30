"""Gradient-boosted trees by histograms, all rows in each tree, grown by the tasks of one barrier stage.

The learner is that of Spark's GBTClassifier (log loss, trees on residuals, leaves their weighted means, the first tree on
the labels themselves, at most 32 bins a feature), with its rows held as bytes in one stage instead of six jobs a tree.
Each task keeps its rows; the first task adds up the histograms of all, chooses the splits and tells them to the others.
"""

from __future__ import annotations

import json
import socket
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame

DEPTH, BINS, STEP, ROWS_SHARE, FEATURES_SHARE = 5, 32, 0.1, 0.8, 0.8
#: Cells of a histogram of several features at once, and rows that are worked on at once.
CELLS, CHUNK = 1 << 12, 1 << 16


def codes_of(values: np.ndarray, is_length: bool) -> np.ndarray:
    """A feature as bytes, in its order: shares by 240ths, upwards; lengths as they are up to 128, then by twelfths of an octave."""
    if is_length:
        return np.where(values <= 128, values, np.minimum(255, 128 + np.ceil(12 * np.log2(np.maximum(values, 1) / 128)))).astype(np.uint8)
    return np.ceil(values * 240 - 1e-9).astype(np.uint8)


@dataclass
class Forest:
    """Complete binary trees: of each inner node feature and cut (larger codes go right), of each leaf what it adds."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margins(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(codes.shape[1])
        for k in range(0, codes.shape[1], CHUNK):
            part = np.ascontiguousarray(codes[:, k : k + CHUNK])
            for feature, cut, leaf in zip(self.feature.tolist(), self.cut.tolist(), self.leaf):
                below = np.arange(1 << DEPTH, dtype=np.uint8)  # leaf numbers, or arrays of them, from the lowest nodes up
                level: list = list(below)
                for d in range(DEPTH - 1, -1, -1):
                    nodes = range((1 << d) - 1, (2 << d) - 1)
                    level = [chosen(x, y, None if feature[j] < 0 else part[feature[j]] > cut[j]) for j, x, y in zip(nodes, level[::2], level[1::2])]
                out[k : k + CHUNK] += leaf[level[0]]
        return out

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-2 * self.margins(codes)))

    def text(self) -> str:
        return json.dumps([self.feature.tolist(), self.cut.tolist(), self.leaf.tolist()])


def read_forest(text: str) -> Forest:
    feature, cut, leaf = json.loads(text)
    return Forest(np.array(feature), np.array(cut), np.array(leaf))


def chosen(x, y, right):
    """x, or y where right."""
    return x if right is None else x ^ ((x ^ y) & -right.view(np.uint8))


class Team:
    """The tasks of a barrier stage, each of which is connected to the first."""

    def __init__(self, context: BarrierTaskContext) -> None:
        self.rank, n = context.partitionId(), len(infos := context.getTaskInfos())
        host = infos[0].address.rsplit(":", 1)[0]
        server, token = None, b""
        if not self.rank:
            import secrets

            token, server = secrets.token_bytes(16), socket.create_server((host, 0))
        said = context.allGather(f"{server.getsockname()[1]} {token.hex()}" if server else "")[0].split()
        self.peers: list[socket.socket] = []
        if server:
            found: dict[int, socket.socket] = {}
            while len(found) < n - 1:
                peer, _ = server.accept()
                hello = self.read(peer, 20)
                if hello[:16] == token:
                    found[struct.unpack("<i", hello[16:])[0]] = peer
            self.peers = [found[k] for k in sorted(found)]
            server.close()
        else:
            self.peers = [socket.create_connection((host, int(said[0])))]
            self.peers[0].sendall(bytes.fromhex(said[1]) + struct.pack("<i", self.rank))
        for peer in self.peers:
            peer.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)

    @staticmethod
    def read(peer: socket.socket, n: int) -> bytes:
        out = bytearray(n)
        view = memoryview(out)
        while n:
            got = peer.recv_into(view[-n:], n)
            if not got:
                raise ConnectionError("a task of the training stage has ended")
            n -= got
        return bytes(out)

    def sum(self, values: np.ndarray) -> np.ndarray:
        """At the first task the sum over all tasks, in their order."""
        if self.rank:
            self.peers[0].sendall(values.tobytes())
            return values
        for peer in self.peers:
            values = values + np.frombuffer(self.read(peer, values.nbytes), values.dtype).reshape(values.shape)
        return values

    def told(self, values: np.ndarray | None, like: tuple[tuple[int, ...], type]) -> np.ndarray:
        """What the first task says."""
        shape, kind = like
        if self.rank:
            return np.frombuffer(self.read(self.peers[0], int(np.prod(shape)) * np.dtype(kind).itemsize), kind).reshape(shape)
        values = np.ascontiguousarray(values, kind)
        for peer in self.peers:
            peer.sendall(values.tobytes())
        return values

    def close(self) -> None:
        for peer in self.peers:
            peer.close()


def bins_of(counts: np.ndarray) -> np.ndarray:
    """The bin of every code, from the rows by class and code: a code a bin if these are few, else equal shares of both classes' mass."""
    used = counts.sum(axis=0) > 0
    if used.sum() <= BINS:
        return np.maximum(np.cumsum(used) - 1, 0).astype(np.uint8)
    mass = (counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).sum(axis=0)
    mass /= mass.sum()
    at = np.minimum(np.floor((np.cumsum(mass) - mass / 2) * BINS), BINS - 1).astype(int)
    return np.unique(at, return_inverse=True)[1].astype(np.uint8)


def together(sizes: list[int]) -> list[list[int]]:
    """Features in groups of at most CELLS joint bins; those of one bin are left out."""
    out: list[list[int]] = []
    for f in sorted((f for f, n in enumerate(sizes) if n > 1), key=lambda f: -sizes[f]):
        fits = [g for g in out if np.prod([sizes[x] for x in g]) * sizes[f] <= CELLS]
        if fits:
            max(fits, key=lambda g: np.prod([sizes[x] for x in g])).append(f)
        else:
            out.append([f])
    return out


def grow(codes: np.ndarray, positive: np.ndarray, weight: float, rounds: int, seed: int, team: Team) -> Forest | None:
    """The forest at the first task. codes: a row a feature; weight: of positive rows."""
    n_features, n = codes.shape
    counts = np.array([[np.bincount(c[positive == k], minlength=256) for c in codes] for k in (False, True)], float)
    total = team.sum(counts)
    bins = team.told(None if team.rank else np.array([bins_of(total[:, f]) for f in range(n_features)]), ((n_features, 256), np.uint8))
    sizes = (bins.max(axis=1) + 1).tolist()
    last = np.array([[np.flatnonzero(b <= k).max() for k in range(BINS)] for b in bins])  # largest code up to each bin
    groups, keys = together(sizes), []
    for g in groups:
        key = np.zeros(n, np.uint16)
        for f in g:
            key *= np.uint16(sizes[f])
            key += bins[f][codes[f]]
        keys.append(key)
    sign = np.where(positive, np.float32(1), np.float32(-1))
    worth = np.where(positive, np.float32(weight), np.float32(1))
    margin, w, wr = np.zeros(n, np.float32), np.zeros(n, np.float32), np.zeros(n, np.float32)
    random, choose = np.random.default_rng([seed, team.rank]), np.random.default_rng(seed)
    wanted = int(np.ceil(FEATURES_SHARE * n_features))

    def histograms(rows: np.ndarray | None, slot: np.ndarray | None, slots: int) -> np.ndarray:
        """Sums of weights and of residuals by slot, feature and bin, of all rows or of some."""
        out = np.zeros((slots, 2, n_features, BINS))
        joint = [np.zeros((2, slots * int(np.prod([sizes[f] for f in g])))) for g in groups]
        size = n if rows is None else len(rows)
        for k in range(0, size, CHUNK * 4):
            at = slice(k, k + CHUNK * 4) if rows is None else rows[k : k + CHUNK * 4]
            weights = w[at].astype(float), wr[at].astype(float)
            for key, sums in zip(keys, joint):
                place = key[at].astype(np.int64)
                if slot is not None:
                    place += slot[k : k + CHUNK * 4] * (sums.shape[1] // slots)
                for x, y in zip(sums, weights):
                    x += np.bincount(place, y, sums.shape[1])
        for g, sums in zip(groups, joint):
            cube = sums.reshape(2, slots, *[sizes[f] for f in g])
            for i, f in enumerate(g):
                out[:, :, f, : sizes[f]] = cube.sum(axis=tuple(j + 2 for j in range(len(g)) if j != i)).swapaxes(0, 1)
        return out

    def best(sums: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each node its feature (or -1) and bin, and weight and residuals on the left."""
        left = np.cumsum(sums, axis=3)[..., :-1]
        right = total[:, :, None, None] - left
        least = 0.5 * min(1.0, weight)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[:, 1] ** 2 / left[:, 0] + right[:, 1] ** 2 / right[:, 0] - (total[:, 1] ** 2 / total[:, 0])[:, None, None]
            gain = np.where((left[:, 0] > least) & (right[:, 0] > least), gain, -1.0)
        out = np.argsort(choose.random(gain.shape[:2]), axis=1)[:, wanted:]
        np.put_along_axis(gain, out[:, :, None], -1.0, axis=1)
        flat = gain.reshape(len(gain), -1)
        at = flat.argmax(axis=1)
        node = np.arange(len(gain))
        feature, cell = at // (BINS - 1), at % (BINS - 1)
        split = flat[node, at] > 1e-9 * np.maximum(1, total[:, 0])
        return np.where(split, feature, -1), cell, left[node, :, feature, cell], split

    trees = []
    for t in range(rounds):
        for k in range(0, n, CHUNK):
            at = slice(k, k + CHUNK)
            s = sign[at]
            residual = s if not t else 4 * s / (1 + np.exp(np.minimum(2 * s * margin[at], 80)))
            np.multiply(worth[at], random.random(len(s), np.float32) < ROWS_SHARE, out=w[at])
            np.multiply(w[at], residual, out=wr[at])
        sums = team.sum(histograms(None, None, 1))
        # Of a feature that has one bin the histogram is empty, so the total is that of all rows.
        totals = team.sum(np.array([[w.sum(dtype=float), wr.sum(dtype=float)]]))
        node = np.zeros(n, np.uint8)
        features, cuts = np.full((1 << DEPTH) - 1, -1), np.full((1 << DEPTH) - 1, 255)
        values = np.zeros(1)
        for d in range(DEPTH):
            count = 1 << d
            plan = None
            if not team.rank:
                with np.errstate(divide="ignore", invalid="ignore"):
                    values = np.where(totals[:, 0] > 0.5 * min(1.0, weight), totals[:, 1] / totals[:, 0], values)
                feature, cell, left, split = best(sums, totals)
                left = np.where(split[:, None], left, totals)
                small = np.where(split, np.where(2 * left[:, 0] <= totals[:, 0], 0, 1), -1)
                plan = np.stack([feature, np.where(split, last[feature, cell], 255), small])
                totals = np.stack([left, totals - left], axis=1).reshape(-1, 2)
                values = np.repeat(values, 2)
            feature, cut, small = plan = team.told(plan, ((3, count), np.int64))
            features[count - 1 : 2 * count - 1], cuts[count - 1 : 2 * count - 1] = feature, cut
            jobs = np.flatnonzero(small >= 0)
            slot_of = np.full(2 * count, 255, np.uint8)
            slot_of[2 * jobs + small[jobs]] = np.arange(len(jobs))
            rows, slots = [], []
            for k in range(0, n, CHUNK):
                part = node[k : k + CHUNK]
                right = np.zeros(len(part), bool)
                for j in jobs.tolist():
                    right |= (part == j) & (codes[feature[j], k : k + CHUNK] > cut[j])
                np.left_shift(part, 1, out=part)
                part |= right.view(np.uint8)
                if d < DEPTH - 1 and len(jobs):
                    slot = slot_of[part]
                    some = np.flatnonzero((slot != 255) & (w[k : k + CHUNK] > 0))
                    rows.append(some + k)
                    slots.append(slot[some])
            if d < DEPTH - 1:
                made = np.zeros((0, 2, n_features, BINS))
                if len(jobs):
                    none = [np.zeros(0, np.int64)]
                    made = team.sum(histograms(np.concatenate(rows or none), np.concatenate(slots or none).astype(np.int64), len(jobs)))
                if not team.rank:
                    after = np.zeros((2 * count, 2, n_features, BINS))
                    after[2 * jobs + small[jobs]] = made
                    after[2 * jobs + 1 - small[jobs]] = sums[jobs] - made
                    sums = after  # a node without a split has no bins, so nothing below it is split
        if not team.rank:
            with np.errstate(divide="ignore", invalid="ignore"):
                values = np.where(totals[:, 0] > 0.5 * min(1.0, weight), totals[:, 1] / totals[:, 0], values) * (STEP if t else 1.0)
        values = team.told(values, ((1 << DEPTH,), np.float64))
        for k in range(0, n, CHUNK):
            margin[k : k + CHUNK] += values[node[k : k + CHUNK]].astype(np.float32)
        trees.append((features, cuts, values))
    return None if team.rank else Forest(*(np.array(x) for x in zip(*trees)))


PACKED = "held boolean, n long, positives long, pairs binary, labels binary, codes binary"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def pressed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec="zstd", asbytes=True)


def unpressed(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=n, codec="zstd", asbytes=True), np.uint8)


def dealt(packed: DataFrame) -> DataFrame:
    """packed, persisted in as many partitions as the session has cores, which is what one barrier stage can hold."""
    spark = packed.sparkSession
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(4 << 20))
    return packed.repartition(max(1, spark.sparkContext.defaultParallelism)).persist()


def fit(rows: DataFrame, n_features: int, weight: float, rounds: int, seed: int) -> Forest:
    """A forest from rows as `dealt` gives them, without those held out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, labels = [np.zeros((n_features, 0), np.uint8)], [np.zeros(0, bool)]
        for batch in batches:
            for n, some, data in zip(*(batch.column(c).to_pylist() for c in ("n", "labels", "codes"))):
                labels.append(unpressed(some, n).astype(bool))
                codes.append(unpressed(data, n * n_features).reshape(n_features, n))
        team = Team(BarrierTaskContext.get())
        try:
            forest = grow(np.concatenate(codes, axis=1), np.concatenate(labels), weight, rounds, seed, team)
        finally:
            team.close()
        if forest is not None:
            yield pa.RecordBatch.from_pydict({"forest": [forest.text()]})

    used = rows.where("not held").select("n", "labels", "codes")
    return read_forest(used.mapInArrow(run, "forest string", barrier=True).collect()[0].forest)
