"""Suffix-array dedup: removal of every byte that a repeated string of `width` bytes covers.

Strings that begin at two places must meet in one shard. Each window of `width` bytes has a designated gram, the one
with the least hash of its grams; neighbouring windows with the same gram form a unit, so every window lies in one
unit, and equal windows lie in units of the same gram. Grams met once end there; units equal as a whole (128 bits: the
gram's hash and a digest) are repeated as a whole. Of the rest, one of each distinct unit goes to the shard of its gram.

A shard builds the suffix array of its units by Larsson-Sadakane refinement: positions are sorted by eight bytes, then
only groups that are not yet single are refined by the rank h bytes on, with h doubling. Kasai's common prefixes of
neighbours come from the text order: along a run of positions whose neighbours advance together the prefix shrinks by
one a step, so only the heads of such runs are compared byte by byte. Windows with a common prefix of `width` or more
are repeated.

A gram with more than `piece` distinct units is dealt out over several shards. Each writes its distinct windows as runs
sorted by digest and cut at the same splitters; for each cut the runs are merged by binary search.

Passages are runs of repeated strings of PASSAGE bytes, which any fifty words have, that hold PASSAGE_WORDS words or
WIDTH bytes. One search finds strings of two widths: a unit reaches to the end of its last window's longer string, and
one more refinement of the groups of shorter strings gives those of the longer ones.

Defined results: null texts are empty; texts shorter than `width` lose nothing; a repeated row is repeated as a whole;
an empty table gives an empty result; other columns, whatever their names, are kept by `without_repeats` and ignored by
`repeat_report`. A text is worked on whole: a worker holds some twenty times the bytes of its longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, discard, flat, fresh, in_arrow, join, runs, scratch, slices

WIDTH = 400
#: Repeated strings of so many bytes make a passage of so many words; shorter grams, as windows are shorter.
PASSAGE, PASSAGE_WORDS = 200, 50
#: Bytes of a gram, of strings of WIDTH bytes; of shorter ones as many less in proportion.
GRAM = 64
#: Distinct units of one gram that one shard takes.
PIECE = 256
#: A unit with so many places is common; the list of common units is broadcast, COMMON_UNITS * 16 bytes at most.
COMMON = 256
COMMON_UNITS = 10_000
#: Bytes of units in one suffix array.
SHARD_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of each gram of the bytes, by prefix sums modulo 2^64."""
    n = len(data)
    power = np.full(n, BASE, np.uint64)
    power[0] = 1
    inverse = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    np.multiply.accumulate(power, out=power)
    np.multiply.accumulate(inverse, out=inverse)
    power *= data
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(power, out=sums[1:])
    del power
    h = sums[gram:] - sums[:-gram]
    h *= inverse[: n - gram + 1]
    del sums, inverse
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_least(key: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours."""
    n = len(key)
    rows = np.full(-(-n // w) * w, np.iinfo(key.dtype).max, key.dtype)
    rows[:n] = key
    rows = rows.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def units_of(data: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of texts data[offsets]: for each unit its text, first and last window (in data), and its gram's hash."""
    if len(data) < width:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    h = gram_hashes(data, gram)
    at = np.arange(len(h), dtype=np.uint64)
    least = sliding_least((h >> np.uint64(32) << np.uint64(32)) | at, width - gram + 1)
    where = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of equals the leftmost
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    windows = np.flatnonzero(text[: len(where)] == text[width - 1 :])
    if not len(windows):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    begins = np.flatnonzero(np.r_[True, (where[windows][1:] != where[windows][:-1]) | (np.diff(windows) != 1)])
    first = windows[begins]
    last = windows[np.r_[begins[1:], len(windows)] - 1]
    return text[first], first, last, h[where[first]]


#: A text's key, the unit's first window, how many windows follow, and its bytes.
UNIT = "doc_id long, dig long, lo int, more int, size int, gram long, d long"
KEY = ["doc_id", "dig"]


def emit_units(width: int, far: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=1 << 20):
            data, offsets = flat(b.column("text"))
            text, first, last, h = units_of(data, offsets, width, gram)
            whole, digest = data.tobytes(), xxhash.xxh3_64_intdigest
            stop = np.minimum(last + far, offsets[text + 1])
            d = np.array([digest(whole[a:z]) for a, z in zip(first.tolist(), stop.tolist(), strict=True)], np.uint64)
            pick = pa.array(text)
            ints = [pa.array(x.astype(np.int32)) for x in (first - offsets[text], last - first, stop - first)]
            cols = [*ints, pa.array(h.view(np.int64)), pa.array(d.view(np.int64))]
            yield pa.RecordBatch.from_arrays([*[b.column(k).take(pick) for k in KEY], *cols], [*KEY, "lo", "more", "size", "gram", "d"])

    return run


def suffix_order(data: np.ndarray, left: np.ndarray, width: int, far: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that share `width` bytes with another one, sorted by these bytes; and those that share `far` bytes."""
    h = 8
    padded = np.r_[data, np.zeros(8, np.uint8)]
    key = np.zeros(len(data), np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k : k + len(data)]
    rank = np.zeros(len(data), np.int64)
    active = np.flatnonzero(left >= h)
    order = np.argsort(key[active])
    active, sorted_key = active[order], key[active[order]]
    start = np.flatnonzero(np.r_[True, sorted_key[1:] != sorted_key[:-1]][: len(order)])
    sizes = np.diff(np.r_[start, len(order)])
    rank[active] = np.repeat(start, sizes)
    active = active[np.repeat(sizes > 1, sizes)]

    def refined(active: np.ndarray, step: int) -> np.ndarray:
        """One refinement by the rank `step` bytes on; the positions whose groups still have others, in order."""
        one, two = rank[active], rank[active + step]
        if len(data) <= 1 << 21:  # both ranks and the position fit into one word, and a sort of words is fast
            word = np.sort(one << 42 | two << 21 | active)
            one, two, active = word >> 42, word >> 21 & 0x1FFFFF, word & 0x1FFFFF
        else:
            order = np.lexsort((active, two, one))
            one, two, active = one[order], two[order], active[order]
        outer = np.r_[True, one[1:] != one[:-1]][: len(one)]
        inner = outer | np.r_[True, two[1:] != two[:-1]][: len(one)]
        outer_at, inner_at = np.flatnonzero(outer), np.flatnonzero(inner)
        sizes = np.diff(np.r_[inner_at, len(one)])
        fresh = one[inner_at] + inner_at - np.repeat(outer_at, np.diff(np.r_[outer_at, len(one)]))[inner_at]
        rank[active] = np.repeat(fresh, sizes)
        return active[np.repeat(sizes > 1, sizes)]

    while 2 * h <= width:
        active = refined(active[left[active] >= 2 * h], h)
        h *= 2
    if h < width:
        active = refined(active[left[active] >= width], width - h)
    if far == width:
        return active, active
    return active, refined(active[left[active] >= far], far - width)


def common_prefixes(data: np.ndarray, left: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Bytes that positions p (ascending) and q have in common: heads of runs compared, the rest one less a step."""
    head = np.flatnonzero(np.r_[True, (np.diff(p) != 1) | (np.diff(q) != 1)])
    a, b = p[head], q[head]
    most = np.minimum(left[a], left[b])
    same = np.zeros(len(head), np.int64)
    live = np.arange(len(head))
    padded = np.r_[data, np.zeros(32, np.uint8)]
    span = np.arange(32)
    while len(live):
        equal = padded[(a[live] + same[live])[:, None] + span] == padded[(b[live] + same[live])[:, None] + span]
        n = np.where(equal.all(axis=1), 32, equal.argmin(axis=1))
        same[live] += n
        live = live[(n == 32) & (same[live] < most[live])]
    same = np.minimum(same, most)
    run = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(p)]))
    return same[run] - (p - a[run])


def repeated_windows(
    data: np.ndarray, starts: np.ndarray, stops: np.ndarray, windows: np.ndarray, width: int, far: int
) -> list[tuple[np.ndarray, ...]]:
    """For units data[starts:stops], each with so many windows: for both widths a triple of flags by position, whether a
    window of the unit begins there, whether it is repeated, and whether it is the first of its equals."""
    left, own = np.zeros(len(data), np.int64), np.zeros(len(data), bool)
    sizes = stops - starts
    at = ranges(starts, sizes)
    left[at] = np.repeat(stops, sizes) - at
    own[ranges(starts, windows)] = True
    out = []
    orders = suffix_order(data, left, width, far)
    for order, w in zip(orders, (width, far), strict=True):
        begins = own & (left >= w)
        flags, firsts = np.zeros(len(data), bool), np.zeros(len(data), bool)
        order = order[begins[order]]  # the tail of a unit is where the next unit's windows are
        if len(order) > 1:
            before = np.full(len(data), -1, np.int64)
            before[order[1:]] = order[:-1]
            p = np.flatnonzero(before >= 0)
            long = common_prefixes(data, left, p, before[p]) >= w
            flags[p[long]] = flags[before[p[long]]] = True
            firsts[before[p[long]]] = True
            firsts[p[long]] = False
        out.append((begins, flags, firsts))
        if far == width:
            break
    return out


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def spans_from(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.r_[0, flags.view(np.int8), 0])
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


SPAN = "doc_id long, dig long, s int, e int, wide int"
FOUND = SPAN + ", gram long, cut int, run binary"
NAMES = ["doc_id", "dig", "s", "e", "wide", "gram", "cut", "run"]
RECORD = np.dtype([("d1", "<u8"), ("d2", "<u8"), ("doc_id", "<i8"), ("dig", "<i8"), ("s", "<i4")])


def shard(width: int, far: int, most: int = SHARD_BYTES):
    """Rows sorted by (gram, salt) with the units' bytes to repeated spans, and to sorted runs of windows of split grams."""

    def solve(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = flat(b.column("unit"))
        lo, pieces = b.column("lo").to_numpy(), b.column("pieces").to_numpy()
        found = repeated_windows(data, offsets[:-1], offsets[1:], b.column("more").to_numpy() + 1, width, far)
        for (begins, flags, firsts), wide in zip(found, (width, far), strict=False):
            s, e = spans_from(flags)
            # runs of flags never cross units, as no window begins in the last bytes of a unit
            unit = np.searchsorted(offsets, s, side="right") - 1
            pick, n = pa.array(unit), len(s)
            if n:
                places = [pa.array((x - offsets[unit] + lo[unit]).astype(np.int32)) for x in (s, e - 1 + wide)]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").take(pick), b.column("dig").take(pick), *places, pa.array(np.full(n, wide, np.int32)),
                        pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())
                    ],
                    NAMES
                )
            if (pieces > 1).any():
                yield from apart(b, data, offsets, begins & (~flags | firsts), wide)

    def apart(b: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, distinct: np.ndarray, wide: int) -> Iterator[pa.RecordBatch]:
        """Sorted runs of the distinct windows of each group whose gram is dealt out over several shards."""
        gram, salt, pieces, whole = b.column("gram").to_numpy(), b.column("salt").to_numpy(), b.column("pieces").to_numpy(), data.tobytes()
        ids, digs, lo = (b.column(c).to_numpy() for c in ("doc_id", "dig", "lo"))
        groups = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (salt[1:] != salt[:-1])])
        for a, z in zip(groups, np.r_[groups[1:], len(gram)], strict=True):
            if pieces[a] < 2:
                continue
            at = offsets[a] + np.flatnonzero(distinct[offsets[a] : offsets[z]])
            rec = np.zeros(len(at), RECORD)
            digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(whole[x : x + wide]) for x in at.tolist()]), "<u8").reshape(-1, 2)
            own = np.searchsorted(offsets, at, side="right") - 1
            rec["d1"], rec["d2"], rec["doc_id"], rec["dig"], rec["s"] = digests[:, 0], digests[:, 1], ids[own], digs[own], at - offsets[own] + lo[own]
            rec = rec[np.lexsort((rec["d2"], rec["d1"]))]
            m = int(pieces[a])
            splitters = np.array([(k << 64) // m for k in range(1, m)], np.uint64)
            cuts = [0, *np.searchsorted(rec["d1"], splitters).tolist(), len(rec)]
            some = [k for k in range(m) if cuts[k + 1] > cuts[k]]
            k = len(some)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()),
                    pa.array(np.full(k, wide, np.int32)), pa.array(np.full(k, gram[a])), pa.array(some, pa.int32()),
                    pa.array([rec[cuts[c] : cuts[c + 1]].tobytes() for c in some], pa.binary())
                ],
                NAMES
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in runs(slices(batches, "unit", most), ["gram", "salt"]):
            if held and size + b.nbytes > most:
                yield from solve(join(held))
                held, size = [], 0
            held.append(b)
            size += b.nbytes
        if held:
            yield from solve(join(held))

    return run


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs of one gram, width and cut to the windows that two or more of them hold, by binary search."""
    for b in runs(batches, ["gram", "wide", "cut"]):
        keys = [b.column(c).to_numpy() for c in ("gram", "wide", "cut")]
        groups = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        for a, z in zip(groups.tolist(), [*groups[1:].tolist(), b.num_rows], strict=True):
            all_ = np.frombuffer(b"".join(b.column("run").slice(a, z - a).to_pylist()), RECORD)
            both = np.sort(all_[["d1", "d2"]], order=("d1", "d2"))
            low = np.searchsorted(both["d1"], all_["d1"], side="left")
            high = np.searchsorted(both["d1"], all_["d1"], side="right")
            hit = high - low > 1
            for n in np.flatnonzero(high - low > 1).tolist():  # first halves agree: the second halves decide
                hit[n] = (both["d2"][low[n] : high[n]] == all_["d2"][n]).sum() > 1
            got, wide = all_[hit], keys[1][a]
            if len(got):
                ends = (got["s"] + wide).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(got["doc_id"].copy()), pa.array(got["dig"].copy()), pa.array(got["s"].copy()), pa.array(ends),
                        pa.array(np.full(len(got), wide, np.int32))
                    ],
                    ["doc_id", "dig", "s", "e", "wide"]
                )


FETCHED = "doc_id long, dig long, lo int, more int, gram long, salt int, pieces int, unit binary"


def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their requests to a row per requested unit with its bytes."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    for b in slices(batches, most=1 << 20):
        out = []
        for i, dig, text, wanted in zip(
            *(b.column(k).to_pylist() for k in KEY), as_bytes(b.column("text")), b.column("wanted").to_pylist(), strict=True
        ):
            out += [(i, dig, w["lo"], w["more"], w["gram"], w["salt"], w["pieces"], text[w["lo"] : w["lo"] + w["size"]]) for w in wanted]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                ["doc_id", "dig", "lo", "more", "gram", "salt", "pieces", "unit"]
            )


def keyed(docs: DataFrame) -> DataFrame:
    """Documents as texts. doc_id and a digest are the key, and repeated rows share it with reason."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.xxhash64("text").alias("dig"),
        F.coalesce("text", F.lit("")).alias("text")
    )


def gram_for(width: int) -> int:
    return max(8, GRAM * width // WIDTH)


def repeated_spans(
    docs: DataFrame, width: int = WIDTH, far: int | None = None, gram: int | None = None, piece: int = PIECE, common: int = COMMON
) -> DataFrame:
    """A row per key that loses bytes: doc_id (null as 0), dig, spans array<struct<s, e, wide>>, not merged.

    wide is the width of the strings that the span is made of, `width` or, where it is given, `far`.
    """
    far, gram = far or width, gram or gram_for(width)
    if not 8 <= gram < width <= far <= 2 * width or width < 16:
        raise ValueError("grams of at least 8 bytes, strings of more than a gram and at least 16 bytes, at most twice as long ones")
    texts = keyed(docs)
    units = scratch(texts.transform(in_arrow, emit_units(width, far, gram), UNIT), "units")
    grams = units.groupBy("gram").agg(F.count("*").alias("n"), F.min("d").alias("a"), F.max("d").alias("z"))
    grams = scratch(grams.where("n > 1").select("gram", (F.col("a") == F.col("z")).alias("alike")), "grams")
    met = scratch(units.join(grams, "gram"), "met")
    discard(units, grams)
    mixed = met.where("not alike").drop("alike")
    key = ["gram", "d"]
    distinct = mixed.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "lo", "more", "size")).alias("at"))
    distinct = scratch(distinct.select(*key, "n", "at.*"), "distinct")
    several = distinct.where("n > 1").select(*key, "n")
    often = F.broadcast(most_common(several, common).select(key))
    rare = mixed.join(often, key, "left_anti").join(several.drop("n"), key, "left_semi")
    whole = met.where("alike").drop("alike").unionByName(mixed.join(often, key, "left_semi")).unionByName(rare)
    s = F.col("lo").alias("s")
    near = F.struct(s, (F.col("lo") + F.col("more") + width).alias("e"), F.lit(width).alias("wide"))
    long = F.struct(s, (F.col("lo") + F.col("size")).alias("e"), F.lit(far).alias("wide"))
    whole = whole.select(
        *KEY,
        F.explode(F.when((F.col("size") >= far) & F.lit(far > width), F.array(near, long)).otherwise(F.array(near))).alias("x")
    ).select(*KEY, "x.*")
    hot = distinct.groupBy("gram").count().where(F.col("count") > piece)
    hot = scratch(hot.select("gram", F.ceil(F.col("count") / piece).cast("int").alias("pieces")), "hot")
    wanted = distinct.join(hot, "gram", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    wanted = wanted.withColumn("salt", F.pmod(F.xxhash64("d"), F.col("pieces")).cast("int"))
    wanted = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("lo", "more", "size", "gram", "salt", "pieces")).alias("wanted"))
    fetched = texts.join(wanted, KEY).transform(in_arrow, fetch, FETCHED)
    # repeated rows fetch a unit twice, and a unit must not meet itself
    fetched = fetched.repartition("gram", "salt").sortWithinPartitions("gram", "salt", "doc_id", "dig", "lo")
    solve = shard(width, far)
    found = scratch(fetched.transform(in_arrow, lambda batches: solve(once(batches)), FOUND), "found")
    keys = ["gram", "wide", "cut"]
    apart = found.where("run is not null").select(*keys, "run").repartition(*keys).sortWithinPartitions(*keys).transform(in_arrow, merged, SPAN)
    within = found.where("run is null").select(*KEY, "s", "e", "wide")
    spans = whole.unionByName(within).unionByName(apart)
    return spans.groupBy(*KEY).agg(F.collect_set(F.struct("s", "e", "wide")).alias("spans"))


def most_common(several: DataFrame, least: int, most: int = COMMON_UNITS) -> DataFrame:
    """Units with at least `least` places, which joins must not deal by unit; least doubles until `most` units are left."""
    while several.where(F.col("n") >= least).count() > most:
        least *= 2
    return several.where(F.col("n") >= least)


def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop rows that equal the row before in (gram, doc_id, dig, lo)."""
    last = None
    for b in batches:
        cols = list(zip(*(b.column(c).to_pylist() for c in ("gram", "doc_id", "dig", "lo")), strict=True))
        keep = [x != y for x, y in zip(cols, [last, *cols], strict=False)]
        last = cols[-1] if cols else last
        yield b.filter(pa.array(keep, pa.bool_()))


def span_lists(column: pa.Array) -> Iterator[list[tuple[int, int, int]]]:
    """The spans (s, e, wide) of each row; null has none."""
    fields = [x.tolist() for x in (column.flatten().field(k).to_numpy() for k in range(3))]
    stops = np.cumsum(column.value_lengths().fill_null(0).to_numpy()).tolist()
    spans = list(zip(*fields, strict=True))
    for a, z in zip([0, *stops], stops, strict=False):
        yield spans[a:z]


def maximal(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that overlap or touch merged."""
    out: list[tuple[int, int]] = []
    for s, e, _ in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    if not spans:
        return text
    starts = [0, *(e for _, e in spans)]
    return b"".join([text[a:b] for a, b in zip(starts, [*(s for s, _ in spans), len(text)], strict=True)])


def passages(text: bytes, spans: list[tuple[int, int]], words: int, least: int = WIDTH) -> list[tuple[int, int]]:
    """Of maximal spans those that hold so many words or bytes."""
    return [(s, e) for s, e in spans if e - s >= least or len(text[s:e].split()) >= words]


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs and, with names that docs lack, the columns of spans but its key."""
    names = {c: fresh(c, docs.columns) for c in spans.columns}
    spans = spans.withColumnsRenamed(names)
    on = (F.coalesce(docs["doc_id"].cast("long"), F.lit(0)) == spans[names["doc_id"]]) & (F.xxhash64(docs["text"]) == spans[names["dig"]])
    return docs.join(spans, on, "left").drop(names["doc_id"], names["dig"])


def report(width: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, most=1 << 20):
            out = []
            for i, text, spans in zip(
                b.column("doc_id").to_pylist(), as_bytes(b.column("text")), span_lists(b.column("spans")), strict=True
            ):
                m = maximal([x for x in spans if x[2] == width])
                found = passages(text, maximal(spans), words)
                out.append(
                    (
                        i, len(text), sum(e - s for s, e in m), len(m), hashlib.sha256(kept_bytes(text, m)).hexdigest(), len(found),
                        sum(e - s for s, e in found)
                    )
                )
            kinds = [*[pa.int64()] * 4, pa.string(), *[pa.int64()] * 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "passage_bytes"]
            )

    return run


def repeat_report(docs: DataFrame, width: int = WIDTH, passage: int = PASSAGE, words: int = PASSAGE_WORDS, **options) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256.

    n_passages and passage_bytes are the repeated passages of the document, found by strings of `passage` bytes.
    """
    docs = docs.select("doc_id", "text")
    rows = with_spans(docs, repeated_spans(docs, passage, width, **options))
    return rows.transform(
        in_arrow, report(width, words),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, passage_bytes long"
    )


def without_repeats(docs: DataFrame, width: int = WIDTH, words: int = 0, **options) -> DataFrame:
    """docs with the repeated bytes cut out of text; a character that a cut splits becomes U+FFFD. Null stays null.

    words: only runs of so many words, or of WIDTH bytes, are cut.
    """
    found = repeated_spans(docs, width, **options)
    name = fresh("spans", docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = []
            for text, raw, spans in zip(b.column("text").to_pylist(), as_bytes(b.column("text")), span_lists(b.column(name)), strict=True):
                cut = passages(raw, maximal(spans), words)
                texts.append(kept_bytes(raw, cut).decode("utf-8", "replace") if cut else text)
            b = b.drop_columns([name])
            yield b.set_column(b.schema.get_field_index("text"), "text", pa.array(texts, b.schema.field("text").type))

    return with_spans(docs, found).transform(in_arrow, run, docs.schema)
