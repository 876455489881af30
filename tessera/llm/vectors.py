"""Embedding near-dedup by spherical-cap filters.

Directions are products of random codes: a vector, turned by a fixed random rotation, is cut into parts, each with
random unit directions (codes) of its own, and a filter is one choice of a direction in every part. List decoding finds
all filters whose direction exceeds the threshold, extending partial choices best first and dropping those that cannot
reach it any more. A vector also keeps its LEAST best filters, so that none is without any. Vectors of one label meet in
their common filters, and each pair there is verified by its cosine in double precision.

What goes through the first exchanges is (label, filter, id) alone; filters with one vector end there, and only then
does a vector travel, to the filters that it shares. A pair counts in the least filter that the two share, so links are
counted without listing them; of the links in a filter only a spanning star of each component goes on. Filters with more
than `piece` vectors are dealt out as pairs of pieces. Equal vectors of one label are one node with a multiplicity.

Parts and codes follow from the largest label, so that the number of filters grows with its vectors and a filter meets
about as many unrelated ones at every size; see `settings`.

The filters are probabilistic, so TABLES independent rotations and sets of codes are used, and short vectors get fewer
codes, whose caps are wider. tests/llm measures the share of pairs at the threshold that meet, at each of the settings.
No pair below the threshold links.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and vectors without a label,
link with nothing; vectors of different lengths don't link; a repeated row is another vector at cosine 1, and each of its
copies is kept if their vec_id is the component's; vectors that share a vec_id share their links; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, discard, flat, in_arrow, local_labels, runs, scratch
from .simhash import pairs_of

THRESHOLD = 0.93
#: Independent rotations; a pair is lost only if it shares no filter in any of them.
TABLES = 4
LEAST = 12
PIECE = 256


def settings(n: int) -> tuple[int, int, int]:
    """Parts, codes a part, and filters a table of a random vector on the average (which sets the cap's threshold), for
    labels of up to n vectors: at least 64 filters a vector, up to a billion vectors in a label."""
    for blocks, codes, mean in ((2, 512, 10), (2, 1024, 12), (2, 2048, 12), (2, 4096, 12), (2, 8192, 14), (2, 16384, 16), (3, 2048, 100)):
        if n * 64 <= codes**blocks:
            return blocks, codes, mean
    return 3, 4096, 160


class Filters:
    def __init__(self, dim: int, blocks: int, codes: int, mean: int, seed: int = 3):
        rng = np.random.default_rng((seed, dim))
        self.blocks, self.codes, self.dim = blocks, codes, dim
        self.width = -(-dim // blocks)
        self.turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.code = rng.normal(size=(blocks, codes, self.width))
        self.code /= np.linalg.norm(self.code, axis=2, keepdims=True) * np.sqrt(blocks)
        self.code = self.code.astype(np.float32)  # single precision is enough to choose filters; links are verified in double
        probe = rng.normal(size=(64, dim))
        dots = self.dots(probe / np.linalg.norm(probe, axis=1, keepdims=True))
        total = np.zeros((len(probe), 1))
        for d in dots:  # only the best can matter
            total = (total[:, :, None] + best(d, 256)[:, None, :]).reshape(len(probe), -1)
            total = best(total, 1 << 12)
        total = total.ravel()
        k = min(mean * len(probe), len(total)) - 1
        self.threshold = -np.partition(-total, k)[k]

    def dots(self, unit: np.ndarray) -> list[np.ndarray]:
        turned = np.zeros((len(unit), self.width * self.blocks), np.float32)
        turned[:, : self.dim] = unit @ self.turn
        return [turned[:, b * self.width : (b + 1) * self.width] @ self.code[b].T for b in range(self.blocks)]

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The filters of the unit vectors: (vector, filter) in order of the vectors."""
        dots = self.dots(unit)
        top = np.zeros((len(unit), 1), np.float32)
        for d in dots:
            top = best((top[:, :, None] + best(d, LEAST)[:, None, :]).reshape(len(unit), -1), LEAST)
        need = np.minimum(self.threshold, top.min(axis=1)) - np.float32(1e-6)
        most = np.stack([d.max(axis=1) for d in dots])
        others = most.sum(axis=0) - most  # what the other parts can add at most
        vector, score, name = np.arange(len(unit)), np.zeros(len(unit), np.float32), np.zeros(len(unit), np.int64)
        for b, d in enumerate(dots):
            # codes that can be part of a filter, a row for each vector
            row, code = np.nonzero(d >= (need - others[b])[:, None])
            place = np.arange(len(row)) - np.searchsorted(row, np.arange(len(unit)))[row]
            scores = np.full((len(unit), place.max() + 1), -np.inf, np.float32)
            codes = np.zeros(scores.shape, np.int64)
            scores[row, place], codes[row, place] = d[row, code], code
            rest = need - most[b + 1 :].sum(axis=0)
            step, parts = max(1, (1 << 22) // scores.shape[1]), []
            for at in range(0, len(vector), step):
                v = vector[at : at + step]
                choice, k = np.nonzero(score[at : at + step, None] + scores[v] >= rest[v][:, None])
                v, choice = v[choice], choice + at
                parts.append((v, score[choice] + scores[v, k], name[choice] * self.codes + codes[v, k]))
            vector, score, name = (np.concatenate(x) for x in zip(*parts, strict=True))
        return vector, name


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k best of each row, in no order."""
    return scores if scores.shape[1] <= k else -np.partition(-scores, k - 1, axis=1)[:, :k]


class Tables:
    """Filters of several rotations, numbered on from one to the next."""

    def __init__(self, dim: int, blocks: int, codes: int, mean: int, tables: int = TABLES):
        codes = min(codes, max(8, dim * dim // 2))
        self.step = codes**blocks
        self.tables = [Filters(dim, blocks, codes, mean, 3 + n) for n in range(tables)]

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, filter) of all tables."""
        found = [t.decode(unit) for t in self.tables]
        return np.concatenate([v for v, _ in found]), np.concatenate([f + n * self.step for n, (_, f) in enumerate(found)])


@lru_cache(maxsize=16)
def filters(dim: int, blocks: int, codes: int, mean: int) -> Tables:
    return Tables(dim, blocks, codes, mean)


def prepared(single: bool):
    """vec_id, label, and the components as little-endian floats; null where the vector links with nothing."""
    kind = "<f4" if single else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, label = b.column("embedding"), b.column("label").is_valid().to_pylist()
            values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), kind) + np.zeros(1, kind)  # null is NaN; -0 is 0
            stops = np.cumsum(lists.value_lengths().fill_null(0).to_numpy())
            raw: list[bytes | None] = []
            for ok, a, z in zip(label, np.r_[0, stops[:-1]].tolist(), stops.tolist(), strict=True):
                x = values[a:z]
                norm = np.linalg.norm(x.astype(np.float64)) if ok and z > a else 0.0
                raw.append(x.tobytes() if 0 < norm < np.inf else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(raw, pa.binary())], ["vec_id", "label", "raw"]
            )

    return run


def unit_rows(raw: bytes, n: int, kind: str) -> np.ndarray:
    x = np.frombuffer(raw, kind).astype(np.float64).reshape(n, -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def met(how: tuple, kind: str):
    """A row for each vector and filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(16, min(512, (1 << 20) // how[1]))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                b = batch.slice(at, step)
                raw = b.column("raw").to_pylist()
                for size in sorted({len(r) for r in raw}):
                    rows = [n for n, r in enumerate(raw) if len(r) == size]
                    dim = size // np.dtype(kind).itemsize
                    vector, name = filters(dim, *how).decode(unit_rows(b"".join([raw[n] for n in rows]), len(rows), kind))
                    pick = pa.array(np.array(rows)[vector])
                    yield pa.RecordBatch.from_arrays(
                        [
                            b.column("label").take(pick), pa.array(np.full(len(name), dim, np.int32)), pa.array(name),
                            b.column("rep").take(pick)
                        ],
                        ["label", "dim", "filter", "rep"]
                    )

    return run


def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors with the filters that they share to a row for each filter and pair of pieces, with the lesser filters."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            b = batch.slice(at, 256)
            rows, filt, bi, bj, own, less = [], [], [], [], [], []
            for n, (raw, met_) in enumerate(zip(b.column("raw").to_pylist(), b.column("met").to_pylist(), strict=True)):
                shared = sorted({(m["filter"], m["pieces"]) for m in met_})
                names = np.array([f for f, _ in shared], "<i8").tobytes()
                for k, (f, pieces) in enumerate(shared):
                    mine = xxhash.xxh3_64_intdigest(raw) % pieces
                    for other in range(pieces):
                        rows.append(n)
                        filt.append(f)
                        bi.append(min(mine, other))
                        bj.append(max(mine, other))
                        own.append(mine)
                        less.append(names[: 8 * k])
            pick = pa.array(rows, pa.int64())
            taken = [b.column(c).take(pick) for c in ("label", "dim", "rep", "many", "raw")]
            yield pa.RecordBatch.from_arrays(
                [*taken, pa.array(filt, pa.int64()), *[pa.array(x, pa.int32()) for x in (bi, bj, own)], pa.array(less, pa.binary())],
                ["label", "dim", "rep", "many", "raw", "filter", "bi", "bj", "own", "less"]
            )


class Lesser:
    """For each row the filters of its vector that are less than the one where it is."""

    def __init__(self, column: pa.Array):
        data, offsets = flat(column)
        self.names, self.cut = np.frombuffer(data.tobytes(), "<i8"), offsets // 8

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All names of these rows, one row after the other, and which row each is of."""
        size = self.cut[rows + 1] - self.cut[rows]
        at = np.arange(size.sum()) + np.repeat(self.cut[rows] - np.cumsum(size) + size, size)
        return self.names[at], np.repeat(np.arange(len(rows)), size)

    def shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the rows of each pair i-j have a filter in common."""
        out = np.zeros(len(i), bool)
        if not len(i):
            return out
        used, both = np.unique(np.r_[i, j], return_inverse=True)
        i, j = both[: len(i)], both[len(i) :]
        names, row = self.of(used)
        size = np.bincount(row, minlength=len(used))
        most = max(1, int(size.max()))
        padded = np.full((len(used), most), -1, np.int64)
        padded[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = names
        step = max(1, (1 << 19) // most)
        for at in range(0, len(i), step):
            live = np.arange(at, min(len(i), at + step))
            for k in range(0, most, 8):  # a few names at a time, as most pairs that share some share many
                a = padded[i[live], k : k + 8]
                hit = ((a[:, :, None] == padded[j[live], None, :]) & (a >= 0)[:, :, None]).any(axis=(1, 2))
                out[live[hit]] = True
                live = live[~hit]
        return out


def verified(threshold: float, kind: str):
    """Rows sorted by (label, dim, filter, bi, bj): for each linked vector its links here and its component's least."""

    def small(unit, lesser, starts, sizes, own):
        """Links of many small groups, pair by pair."""
        cut = np.cumsum(sizes * (sizes - 1) // 2) // (1 << 16)
        for part in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(cut)) + 1):
            i, j = pairs_of(starts[part], sizes[part])
            across = (own[i] < 0) | (own[i] != own[j])
            i, j = i[across], j[across]
            near = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            i, j = i[near], j[near]
            new = ~lesser.shared(i, j)
            yield np.stack([i[new], j[new]])

    def large(unit, lesser, start, n, own):
        """Links of one group by blocked products; first the pairs go that share one of the commonest lesser filters."""
        rows = np.arange(start, start + n)
        names, owner = lesser.of(rows)
        _, inverse, count = np.unique(names, return_inverse=True, return_counts=True)
        common = np.argsort(-count)[:24]
        has = np.zeros((len(common), n), bool)
        for k, c in enumerate(common.tolist()):
            has[k, owner[inverse == c]] = True
        for at in range(0, n, 256):
            new = np.arange(at, min(n, at + 256))[:, None] < np.arange(n)
            if own[start] >= 0:
                new &= own[rows[at : at + 256], None] != own[rows]
            for h in has:
                if not new.any():
                    break
                new &= ~(h[at : at + 256, None] & h)
            if new.any():
                new &= unit[rows[at : at + 256]] @ unit[rows].T >= threshold
                i, j = np.nonzero(new)
                i, j = rows[i + at], rows[j]
                left = ~lesser.shared(i, j)
                yield np.stack([i[left], j[left]])

    def links(b: pa.RecordBatch, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        unit = unit_rows(b"".join(b.column("raw").to_pylist()), b.num_rows, kind)
        lesser = Lesser(b.column("less"))
        bi, own = b.column("bi").to_numpy(), b.column("own").to_numpy()
        own = np.where(bi != b.column("bj").to_numpy(), own, -1)  # between two pieces only pairs across them
        few = sizes <= 32
        found = [np.zeros((2, 0), np.int64), *small(unit, lesser, starts[few], sizes[few], own)]
        for a, m in zip(starts[~few].tolist(), sizes[~few].tolist(), strict=True):
            found += large(unit, lesser, a, m, own)
        return np.concatenate(found, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["label", "dim", "filter", "bi", "bj"]
        for whole in runs(batches, keys):
            for dim in np.unique(whole.column("dim").to_numpy()).tolist():
                b = whole.filter(pa.array(whole.column("dim").to_numpy() == dim))
                cols = [b.column(c).to_numpy() for c in keys]
                starts = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in cols], axis=0)])
                sizes = np.diff(np.r_[starts, b.num_rows])
                i, j = links(b, starts, sizes)
                if not len(i):
                    continue
                rep, many, n = b.column("rep").to_numpy(), b.column("many").to_numpy(), b.num_rows
                total = np.bincount(i, many[j], n) + np.bincount(j, many[i], n)
                label = local_labels(n, i, j)
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[some]), pa.array(total[some].astype(np.int64)), pa.array(rep[label[some]])], ["u", "links", "v"]
                )

    return run


def vector_near_dedup(
    vectors: DataFrame, threshold: float = THRESHOLD, how: tuple[int, int, int] | None = None, piece: int = PIECE
) -> DataFrame:
    """A row per vector (vec_id, embedding, label): vec_id, n_links, component_id, kept. how: see `settings`."""
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    kind = "<f4" if single else "<f8"
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{'float' if single else 'double'}>"),
        F.col("label").cast("long").alias("label")
    )
    rows = scratch(rows.transform(in_arrow, prepared(single), "vec_id long, label long, raw binary"), "vectors")
    nodes = rows.where("raw is not null").groupBy("label", "raw").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many"))
    nodes = scratch(nodes, "nodes")
    if how is None:
        how = settings(nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0)
    keys = ["label", "dim", "filter"]
    light = scratch(
        nodes.select("label", "raw", "rep").transform(in_arrow, met(how, kind), "label long, dim int, filter long, rep long"), "met"
    )
    counts = light.groupBy(*keys).count().where(F.col("count") > 1)
    counts = scratch(counts.select(*keys, F.ceil(F.col("count") / piece).cast("int").alias("pieces")), "shared")
    shared = light.join(counts, keys).groupBy("label", "rep", "dim").agg(F.collect_list(F.struct("filter", "pieces")).alias("met"))
    size = (F.octet_length("raw") / np.dtype(kind).itemsize).cast("int").alias("dim")
    pairs = nodes.select("label", "rep", "many", "raw", size).join(shared, ["label", "rep", "dim"])
    keys += ["bi", "bj"]
    pairs = pairs.transform(
        in_arrow, dealt, "label long, dim int, rep long, many long, raw binary, filter long, bi int, bj int, own int, less binary"
    )
    found = pairs.repartition(*keys).sortWithinPartitions(*keys).transform(
        in_arrow, verified(threshold, kind), "u long, links long, v long"
    )
    found = scratch(found, "links")
    discard(light, counts)
    member = scratch(components(found.select("u", "v")), "member").select(F.col("node").alias("rep"), F.col("root"))
    total = found.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    classes = nodes.join(total, "rep", "left").join(member, "rep", "left")
    classes = scratch(
        classes.select(
            "label", "raw", F.coalesce("links", F.lit(0)) + F.col("many") - 1, F.coalesce("root", "rep")
        ).toDF("c_label", "c_raw", "links", "root"),
        "classes"
    )
    out = rows.join(classes, (F.col("label") == F.col("c_label")) & (F.col("raw") == F.col("c_raw")), "left")
    component = F.coalesce("root", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept")
    )
