"""Exact dedup: Patricia-trie owners within length-and-content-hash partitions.

Texts are equal when identical after lower-casing A-Z only; a null text counts as empty. Rows are dealt out by (length,
content hash) and sorted by text within a partition; each task inserts all full byte strings of its partition into one
compressed radix trie, whose terminal nodes hold the owner and the members. As strings come in order, a subtree is
finished as soon as a string branches off above it: it is spilled, that is emitted and freed, so a task holds the path
to the latest string and its members.

A key that is more frequent than `piece` rows is dealt out in as many pieces as the square root of its rows; the pieces'
owners meet in a second trie. The list of such keys is broadcast and bounded: `piece` grows until the list has at most
HOT_KEYS entries of 20 bytes.

Defined results: an empty table gives an empty result; repeated rows are members of one group, each counted and, if
their doc_id owns the group, each kept; a null doc_id is a member but owns a group only if all its members are null;
other columns are ignored. A task holds its longest text some four times.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, in_arrow, scratch, slices

HOT_KEYS = 100_000
#: Rows of one key that a task takes; a task holds that many ids at most.
PIECE = 256


class Node:
    """An edge label, where it ends in the string, and for terminals what is stored there."""

    __slots__ = ("label", "end", "stored")

    def __init__(self, label: bytes, end: int):
        self.label, self.end, self.stored = label, end, None


class PatriciaTrie:
    """A compressed radix trie of strings that come in order; what is finished is handed out and freed."""

    def __init__(self) -> None:
        self.path = [Node(b"", 0)]
        self.last = b""

    def insert(self, key: bytes) -> tuple[Node, list[Node]]:
        """The terminal of this string, and the finished terminals."""
        path, finished = self.path, []
        same = common_prefix(self.last, key)
        while path[-1].end > same:
            node = path.pop()
            if node.stored is not None:
                finished.append(node)
            if node.end - len(node.label) < same:  # the strings part within this edge
                path.append(Node(node.label[: same - node.end], same))
        if len(key) > same:
            path.append(Node(key[same:], len(key)))
        self.last = key
        return path[-1], finished

    def spill(self) -> list[Node]:
        """All terminals that are left; the trie is empty afterwards."""
        left = [n for n in reversed(self.path) if n.stored is not None]
        self.path, self.last = [Node(b"", 0)], b""
        return left


def common_prefix(a: bytes, b: bytes) -> int:
    """How many bytes agree, by steps that double and then halve."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, step = 0, 16
    while a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    high = min(low + step, most)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def owner_of(a: int | None, b: int | None, largest: bool) -> int | None:
    if a is None or b is None:
        return b if a is None else a
    return max(a, b) if largest else min(a, b)


def content_hash(x: bytes) -> int:
    return struct.unpack("<q", xxhash.xxh3_64_digest(x))[0]


KEY = "n_bytes long, h long"


def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        texts = [x.lower() for x in as_bytes(b.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(x) for x in texts], pa.int64()), pa.array([content_hash(x) for x in texts], pa.int64())],
            ["n_bytes", "h"]
        )


def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Normalised texts with their keys; `place` says to which piece a row of a frequent key goes."""
    seen = 0
    for b in slices(batches):
        texts = [x.lower() for x in as_bytes(b.column("text"))]
        ids = b.column("doc_id").to_pylist()
        places = [seen + n if i is None else content_hash(str(i).encode()) for n, i in enumerate(ids)]
        seen += len(ids)
        cols = [[len(x) for x in texts], [content_hash(x) for x in texts], places, ids]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in cols], pa.array(texts, pa.binary())], ["n_bytes", "h", "place", "doc_id", "text"]
        )


OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("owner", pa.int64()), ("members", pa.int64()), ("text_sha256", pa.string()),
        ("n_bytes", pa.int64()), ("h", pa.int64()), ("pieces", pa.int32()), ("text", pa.binary())
    ]
)
NONE = -(1 << 63)


class Group:
    """What a terminal stores: the members of one piece and their owner."""

    __slots__ = ("text", "salt", "key", "ids", "owner")

    def __init__(self, text: bytes, salt: int, key: tuple[int, int, int]):
        self.text, self.salt, self.key, self.ids, self.owner = text, salt, key, array("q"), None

    def rows(self) -> Iterator[tuple]:
        sha = hashlib.sha256(self.text).hexdigest()
        for n, i in enumerate(self.ids):
            yield None if i == NONE else i, self.owner, len(self.ids), sha, *self.key, self.text if self.key[2] > 1 and n == 0 else None


def tries(largest: bool):
    """Rows sorted by (text, salt) to a row per member; the first of a piece of a frequent key carries the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, out = PatriciaTrie(), []
        for b in slices(batches):
            columns = [b.column(c).to_pylist() for c in ("n_bytes", "h", "pieces", "salt", "doc_id", "text")]
            for n, h, pieces, salt, i, text in zip(*columns, strict=True):
                node, finished = trie.insert(text)
                for done in finished:
                    out.extend(done.stored.rows())
                if node.stored is not None and node.stored.salt != salt:
                    out.extend(node.stored.rows())
                    node.stored = None
                if node.stored is None:
                    node.stored = Group(text, salt, (n, h, pieces))
                node.stored.ids.append(NONE if i is None else i)
                node.stored.owner = owner_of(node.stored.owner, i, largest)
                if len(out) >= 4096:
                    yield rows(out, OUT)
                    out = []
        for done in trie.spill():
            out.extend(done.stored.rows())
        if out:
            yield rows(out, OUT)

    return run


def rows(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema.names)


MERGED = pa.schema(
    [
        ("n_bytes", pa.int64()), ("h", pa.int64()), ("piece_owner", pa.int64()), ("piece_sha", pa.string()), ("keep", pa.int64()),
        ("total", pa.int64())
    ]
)


def merge(largest: bool):
    """Pieces sorted by text: a trie over their texts gives owner and size of each whole group."""

    def whole(stored: list) -> Iterator[tuple]:
        key, sha, owner, pieces = stored
        total = sum(pieces.values())
        return ((*key, o, sha, owner, total) for o in pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, out = PatriciaTrie(), []
        for b in slices(batches):
            for n, h, owner, members, sha, text in zip(
                *(b.column(c).to_pylist() for c in ("n_bytes", "h", "owner", "members", "text_sha256", "text")), strict=True
            ):
                node, finished = trie.insert(text)
                for done in finished:
                    out.extend(whole(done.stored))
                if node.stored is None:
                    node.stored = [(n, h), sha, None, {}]
                node.stored[2] = owner_of(node.stored[2], owner, largest)
                node.stored[3][owner] = node.stored[3].get(owner, 0) + members
        for done in trie.spill():
            out.extend(whole(done.stored))
        if out:
            yield rows(out, MERGED)

    return run


def hot_keys(docs: DataFrame, piece: int, most: int = HOT_KEYS) -> DataFrame:
    """Keys with more than `piece` rows and the number of pieces of each; piece doubles until the list is short."""
    counts = scratch(
        docs.select("text").transform(in_arrow, keyed, KEY).groupBy("n_bytes", "h").count().where(F.col("count") > piece), "hot"
    )
    while counts.where(F.col("count") > piece).count() > most:
        piece *= 2
    return counts.where(F.col("count") > piece).select("n_bytes", "h", F.ceil(F.sqrt("count")).cast("int").alias("pieces"))


def exact_dedup(docs: DataFrame, keep: str = "smallest", piece: int = PIECE) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text), n_bytes."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep: smallest or largest")
    largest = keep == "largest"
    one = docs.select(F.col("doc_id").cast("long"), "text").transform(in_arrow, dealt, f"{KEY}, place long, doc_id long, text binary")
    one = one.join(F.broadcast(hot_keys(docs, piece)), ["n_bytes", "h"], "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    one = one.withColumn("salt", F.pmod("place", "pieces").cast("int")).drop("place")
    one = one.repartition("n_bytes", "h", "salt").sortWithinPartitions("text", "salt")
    one = scratch(
        one.transform(
            in_arrow, tries(largest),
            "doc_id long, owner long, members long, text_sha256 string, n_bytes long, h long, pieces int, text binary"
        ),
        "members"
    )
    pieces = one.where(F.col("text").isNotNull()).drop("doc_id", "pieces")
    merged = pieces.repartition("n_bytes", "h").sortWithinPartitions("text").transform(
        in_arrow, merge(largest), "n_bytes long, h long, piece_owner long, piece_sha string, keep long, total long"
    )
    merged = scratch(merged, "owners").withColumnsRenamed({"n_bytes": "m_bytes", "h": "m_h"})
    hot = one.where("pieces > 1").join(
        merged,
        (F.col("n_bytes") == F.col("m_bytes")) & (F.col("h") == F.col("m_h")) & F.col("owner").eqNullSafe(F.col("piece_owner")) & (
            F.col("text_sha256") == F.col("piece_sha")
        )
    )
    columns = ["doc_id", "keep", "total", "text_sha256", "n_bytes"]
    both = one.where("pieces = 1").withColumnsRenamed(
        {"owner": "keep", "members": "total"}
    ).select(columns).unionByName(hot.select(columns))
    return both.select(
        "doc_id", F.col("keep").alias("keep_id"), F.col("total").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep")).alias("kept"), "text_sha256", "n_bytes"
    )
