"""SimHash near-dedup with pivot distance tables.

A fingerprint bit is 1 if it is set in over half of the 64-bit hashes of a text's word shingles (repeats count). Pairs at
`radius` or fewer differing bits link. Once for every fingerprint the Hamming distances to the references are computed.
By the triangle inequality |d(x, p) - d(y, p)| <= d(x, y) for every reference p, so a pair whose distances to some
reference differ by more than the radius is discarded, and survivors are verified bit by bit.

The references are zero, 32 fingerprints of two bits each (pairs of neighbours), and all unions of these. Of the last
no distances are stored: d(x, 0) - d(x, pair) gives how many of the pair's bits x has, so 33 distances make a table of
32 counts, and the maximum difference over all unions is the sum of the counts' differences. Counts are written as one
bit for one and two bits for two, so that this sum is the number of differing bits of two such words.

The tables also choose the pairs. A table differs in at most `radius` counts between two fingerprints that link, so of
`groups` groups of counts groups - radius agree: fingerprints meet by every such choice of their table's groups. Random
references can't do that: one discards about half of the pairs, and of the ranges of distances to m of them a
fingerprint would have to look at 1.9 ** m, of which there are some 2.4 ** m (see the README).

Equal fingerprints are one node, so copies never meet each other.

Defined results: null and empty texts have fingerprint zero and link like any other; an empty table gives an empty
result; repeated rows share a fingerprint; a null doc_id takes part, and is a component's smallest id only if no other
id is in it; other columns are ignored. A text is worked on whole, in some twelve times its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, components, discard, in_arrow, local_labels, runs, scratch, slices

SEED = 42
SHINGLE = 3
RADIUS = 3
#: Groups of a table's counts; two fingerprints meet by each choice of GROUPS - RADIUS of them.
GROUPS = 7
#: Fingerprints of one key that meet in one piece of work; more are dealt out as pairs of such pieces.
PIECE = 1024
#: Zero, and 32 fingerprints of two neighbouring bits.
REFERENCES = np.array([0, *[3 << k for k in range(0, 64, 2)]], np.uint64)


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    words = text.lower().split()  # bytes: lower-cases A-Z only and splits at \x20 \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    stops = np.cumsum(lengths) - 1
    starts = stops - lengths + 1
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts[: 1 - size].tolist(), stops[size - 1 :].tolist(), strict=True)], np.uint64
    )


def simhash(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as an unsigned integer."""
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        prints = np.array([simhash(shingle_hashes(x)) for x in as_bytes(b.column("text"))], np.uint64)
        yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(prints.view(np.int64))], ["doc_id", "fp"])


def tables(fp: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints to all references, as counts of each pair's bits in one word a fingerprint.

    The word has two bits for each count: none set for zero, the lower for one, both for two.
    """
    out = np.zeros(len(fp), np.uint64)
    for at in range(0, len(fp), 1 << 14):
        distance = np.bitwise_count(fp[at : at + (1 << 14), None] ^ REFERENCES).astype(np.int8)
        count = (distance[:, :1] - distance[:, 1:] + 2) >> 1
        bits = np.stack([count > 0, count > 1], axis=2).reshape(len(count), 64)
        out[at : at + (1 << 14)] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def key_masks(groups: int, radius: int) -> list[int]:
    """Every choice of groups - radius groups of counts, as the bits that these have in a table's word."""
    cuts = [2 * round(i * 32 / groups) for i in range(groups + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(parts, groups - radius)]


def keys(masks: list[int]):
    wide = np.array(masks, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp, table = (b.column(c).to_numpy().view(np.uint64) for c in ("fp", "distances"))
            masked = (table[:, None] & wide).ravel()
            k = len(masks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(k, dtype=np.int32), len(fp))),
                    *[pa.array(x.view(np.int64)) for x in (masked, np.repeat(fp, k), np.repeat(table, k))]
                ],
                ["mask", "key", "fp", "distances"]
            )

    return run


def with_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column("fp")
        yield pa.RecordBatch.from_arrays(
            [fp, b.column("rep"), pa.array(tables(fp.to_numpy().view(np.uint64)).view(np.int64))], ["fp", "rep", "distances"]
        )


def pairs_of(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) within each of many small groups."""
    left = np.repeat(
        np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes),
        np.repeat(sizes, sizes) - 1 - (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    )
    first = np.flatnonzero(np.r_[True, left[1:] != left[:-1]]) if len(left) else np.zeros(0, int)
    within = np.arange(len(left)) - np.repeat(first, np.diff(np.r_[first, len(left)]))
    return left, left + 1 + within


def verified(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int) -> np.ndarray:
    """Of the pairs i-j those that link: by the largest difference of distances first, then bit by bit."""
    near = np.bitwise_count(table[i] ^ table[j]) <= radius
    i, j = i[near], j[near]
    near = np.bitwise_count(fp[i] ^ fp[j]) <= radius
    return np.stack([i[near], j[near]])


def linked(radius: int, at_once: int = 1 << 18):
    """Rows sorted by (mask, key, bi, bj) to links; of a group's links only a spanning star of each component goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs(batches, ["mask", "key", "bi", "bj"]):
            fp, table = (b.column(c).to_numpy().view(np.uint64) for c in ("fp", "distances"))
            cols = [b.column(c).to_numpy() for c in ("mask", "key", "bi", "bj")]
            starts = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in cols], axis=0)])
            sizes = np.diff(np.r_[starts, len(fp)])
            found = []
            small = sizes <= 64
            s, n = starts[small], sizes[small]
            cut = np.cumsum(n * (n - 1) // 2) // at_once
            for part in np.split(np.arange(len(s)), np.flatnonzero(np.diff(cut)) + 1) if len(s) else []:
                found.append(verified(fp, table, *pairs_of(s[part], n[part]), radius))
            for a, m in zip(starts[~small], sizes[~small], strict=True):
                step = max(1, at_once // m)
                for x in range(a, a + m, step):
                    i, j = np.meshgrid(np.arange(x, min(x + step, a + m)), np.arange(a, a + m), indexing="ij")
                    upper = i < j
                    found.append(verified(fp, table, i[upper], j[upper], radius))
            links = np.concatenate(found, axis=1) if found else np.zeros((2, 0), int)
            label = local_labels(len(fp), links[0], links[1])
            star = np.flatnonzero(label != np.arange(len(fp)))
            if len(star):
                yield pa.RecordBatch.from_arrays([pa.array(fp[star].view(np.int64)), pa.array(fp[label[star]].view(np.int64))], ["u", "v"])

    return run


def links(nodes: DataFrame, radius: int = RADIUS, groups: int = GROUPS, piece: int = PIECE) -> DataFrame:
    """Distinct fingerprints (fp, distances) to links (u, v) with the same connected components as all linked pairs."""
    met = nodes.select("fp", "distances").transform(
        in_arrow, keys(key_masks(groups, radius)), "mask int, key long, fp long, distances long"
    )
    met = every = scratch(met, "keys")
    counts = met.groupBy("mask", "key").count().where(F.col("count") > 1)
    met = met.join(counts, ["mask", "key"]).withColumn("n", F.ceil(F.col("count") / F.lit(piece)).cast("int"))
    met = met.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    met = met.select("mask", "key", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "fp", "distances")
    found = met.repartition("mask", "key", "bi", "bj").sortWithinPartitions("mask", "key", "bi", "bj").transform(
        in_arrow, linked(radius), "u long, v long"
    )
    found = scratch(found.distinct(), "found")
    discard(every)
    return found


def simhash_near_dedup(docs: DataFrame, radius: int = RADIUS, groups: int = GROUPS) -> DataFrame:
    """A row per document: doc_id, fp long, component_id (the smallest doc_id reachable by links, itself included)."""
    prints = scratch(docs.select("doc_id", "text").transform(in_arrow, fingerprints, "doc_id long, fp long"), "prints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("rep")).transform(in_arrow, with_tables, "fp long, rep long, distances long")
    nodes = scratch(nodes, "nodes")
    member = scratch(components(links(nodes, radius, groups)), "member")
    least = member.join(nodes, member.node == nodes.fp).groupBy("root").agg(F.min("rep").alias("component_id"))
    named = scratch(member.join(least, "root").select(F.col("node").alias("fp"), "component_id"), "named")
    owners = scratch(nodes.join(named, "fp", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id")), "owners")
    discard(nodes, member, named)
    return prints.join(owners, "fp").select("doc_id", "fp", "component_id")
