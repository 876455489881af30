"""Packing by power-of-two decomposition.

A document's ids (with the closing id) are cut into pieces of the longest length and, for the rest, of the lengths of
its binary digits, longest first. A piece is a sequence of its own and pieces of equal length share a bucket, so a
batch drawn from one bucket needs no padding and no sequence crosses documents.

Ids are those of the tokenizers library for the given file; the codec of the encoding operator makes them.

Defined results: null and empty texts give the closing id alone; repeated rows are packed like any other; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import codec_of, encoder
from .common import in_arrow, slices

MAX_LENGTH = 2048
CLOSING_ID = 1


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in range(longest.bit_length(), -1, -1) if rest >> b & 1]


def pieces(codec, closing: int, longest: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(codec.value)
        for b in slices(batches, most=3 << 20):
            texts = [t or "" for t in b.column("text").to_pylist()]
            docs, starts, lengths, totals, payload = [], [], [], [], []
            for i, ids in zip(b.column("doc_id").to_pylist(), enc.encode(texts), strict=True):
                ids = np.append(ids, np.uint32(closing)).astype("<u4")
                start = 0
                for n in piece_lengths(len(ids), longest):
                    docs.append(i)
                    starts.append(start)
                    lengths.append(n)
                    totals.append(len(ids))
                    part = ids[start : start + n]
                    payload.append(zlib.crc32(part.tobytes()) if digest else part)
                    start += n
            last = pa.array(payload, pa.int64()) if digest else pa.array(payload, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                    pa.array(totals, pa.int64()), last
                ],
                ["doc_id", "start", "length", "doc_tokens", "ids_crc32" if digest else "ids"]
            )

    return run


def pack(docs: DataFrame, tokenizer_path: str, longest: int = MAX_LENGTH, closing: int = CLOSING_ID, digest: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, doc_tokens, ids (or their CRC-32), sequence_id, offset, bucket.

    bucket is the exponent of the length; sequence_id numbers the sequences; offset is 0, as a piece fills its sequence.
    The tokenizer file is read by the driver and broadcast; it is a few MB whatever the input's size.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    codec = codec_of(docs.sparkSession, tokenizer_path)
    last = "ids_crc32 long" if digest else "ids array<long>"
    out = docs.select(F.col("doc_id").cast("long"), "text").transform(
        in_arrow, pieces(codec, closing, longest, digest), f"doc_id long, start long, length long, doc_tokens long, {last}"
    )
    return out.withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "bucket": F.log2("length").cast("int")}
    )
