"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches are cut so that about this many bytes of text are worked on at once.
SLICE_BYTES = 4 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_arrow(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow(run, schema) with bounded memory, for use as df.transform(in_arrow, run, schema).

    The bytes of a batch sent to Python are bounded, which 10,000 rows of long texts make large otherwise (a session that
    has the setting keeps it), and a worker that is done with a partition returns free memory before it idles.
    """
    if df.sparkSession.conf.get(ARROW_BYTES, None) is None:
        df.sparkSession.conf.set(ARROW_BYTES, str(SLICE_BYTES))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        return_memory()

    return df.mapInArrow(bounded, schema)


def return_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; one of our own only on a local master without one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def scratch(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df to the shared folder and read it back: the lineage is cut, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tessera-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.tessera_path = path
    for tables in _open:
        tables.append(out)
    return out


_open: list[list[DataFrame]] = []


@contextmanager
def written() -> Iterator[list[DataFrame]]:
    """The tables that `scratch` writes in the meantime, for whoever knows when they are done with."""
    tables: list[DataFrame] = []
    _open.append(tables)
    try:
        yield tables
    finally:
        _open.pop()


def discard(*tables: DataFrame) -> None:
    """Delete tables of `scratch` that no table still to be written reads; some may be gone already."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.tessera_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, taken: list[str]) -> str:
    """A column name like `name` that is not taken, whatever the case."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches by the bytes in one string column; a row longer than `most` comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = ends(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def ends(arr: pa.Array) -> np.ndarray:
    """The offsets of a string or binary array, with its slice taken into account."""
    width = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    return np.frombuffer(arr.buffers()[1], dtype=width)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)


def flat(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array end to end, and where each row starts (one more entry than rows); null is empty."""
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    offsets = ends(arr)
    data = arr.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def as_bytes(arr: pa.Array) -> list[bytes]:
    """The rows of a string array as UTF-8; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(arr.type) else pa.binary()
    return [x or b"" for x in arr.cast(kind).to_pylist()]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Regroup batches of a sorted partition so that rows with equal keys never straddle two batches.

    Memory holds one batch and the group that is still open; callers bound the size of a group before.
    """
    held: list[pa.RecordBatch] = []

    def changes(b: pa.RecordBatch) -> np.ndarray:
        differ = np.zeros(b.num_rows - 1, bool)
        for k in keys:
            v = b.column(k).to_numpy(zero_copy_only=False)
            differ |= v[1:] != v[:-1]
        return np.flatnonzero(differ) + 1

    for b in batches:
        if not b.num_rows:
            continue
        if held:
            same = all(held[-1].column(k)[held[-1].num_rows - 1].as_py() == b.column(k)[0].as_py() for k in keys)
            cuts = changes(b)
            if not same:
                yield join(held)
                held = []
            elif not len(cuts):
                held.append(b)
                continue
            else:
                yield join([*held, b.slice(0, int(cuts[0]))])
                held, b = [], b.slice(int(cuts[0]))
        cuts = changes(b)
        if len(cuts):
            yield b.slice(0, int(cuts[-1]))
            b = b.slice(int(cuts[-1]))
        held = [b]
    if held:
        yield join(held)


def join(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches(max_chunksize=1 << 40)[0]


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest reachable index of each of n nodes, by hooking and pointer jumping over links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label = nxt
        live = label[a] != label[b]
        a, b = a[live], b[live]
        if not len(a) or (before == label).all():
            break
    return label


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Connected components of the links (u long, v long): rows (node, root), root the smallest node reachable.

    Alternating large-star and small-star rounds, each written to the shared folder, until every node points at its
    root. Nothing is collected but two counts a round. Minima are pre-aggregated; the joins have a plain exchange on
    either side, so AQE can split a hot node.
    """
    u, v = F.col("u"), F.col("v")
    stars = scratch(edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "links")
    for _ in range(rounds):
        roles = stars.select(u.alias("n"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
            stars.select(v.alias("n"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
        odd = roles.groupBy("n").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).where(
            (F.col("child") > 1) | ((F.col("child") > 0) & (F.col("parent") > 0)))
        if odd.limit(1).count() == 0:
            break
        both = stars.unionByName(stars.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where((v > u) & (v != F.col("m"))).select(v.alias("u"), F.col("m").alias("v")).distinct()
        large = scratch(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        before, stars = stars, scratch(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        discard(before, large)
    else:
        raise RuntimeError("components did not settle")
    roots = stars.select(v.alias("node")).distinct().select("node", F.col("node").alias("root"))
    return stars.select(u.alias("node"), v.alias("root")).unionByName(roots)
