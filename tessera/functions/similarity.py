"""Pair similarities: set overlaps with built-in functions, LCS-based ratios in one Arrow UDF."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import char_ngrams, tokens


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without repeats; two empty ones are equal."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both.cast("double"), (F.size(a) + F.size(b) - both).cast("double")), F.lit(1.0))


def token_jaccard(a: Column, b: Column) -> Column:
    return jaccard(tokens(a), tokens(b))


def character_jaccard(a: Column, b: Column) -> Column:
    return jaccard(char_ngrams(a, (3,)), char_ngrams(b, (3,)))


def words(text: Column) -> Column:
    """All words, repeats included."""
    return F.filter(F.split(text, " "), lambda x: x != "")


def times(ws: Column, t: Column) -> Column:
    return F.size(F.filter(ws, lambda x: x == t)).cast("double")


def total(ts: Column, f) -> Column:
    return F.aggregate(F.transform(ts, f), F.lit(0.0), lambda acc, x: acc + x)


def norm(text: Column) -> Column:
    """The length of the vector of word counts: each word counts as often as it occurs."""
    ws = words(text)
    return F.sqrt(total(ws, lambda t: times(ws, t)))


def cosine(wa: Column, wb: Column, na: Column, nb: Column) -> Column:
    """Of the word counts, from all words and the norms of both sides."""
    dot = total(F.array_intersect(wa, wb), lambda t: times(wa, t) * times(wb, t))
    return F.when((F.size(wa) == 0) & (F.size(wb) == 0), 1.0).when((F.size(wa) == 0) | (F.size(wb) == 0), 0.0).otherwise(dot / (na * nb))


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of an integer."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(b):
        where[c] = where.get(c, 0) | 1 << i
    mask = full = (1 << len(b)) - 1
    for c in a:
        u = mask & where.get(c, 0)
        mask = (mask + u | mask - u) & full
    return len(b) - mask.bit_count()


def indel_ratio(a: str, b: str) -> float:
    return 2.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter with any window of the longer, windows clipped at the ends included."""
    if not a or not b:
        return float(a == b)
    if len(a) > len(b):
        a, b = b, a
    if a in b:
        return 1.0

    def best(short: str, long: str) -> float:
        m, n = len(short), len(long)
        top = 0.0
        for i in range(1 - m, n):
            window = long[max(0, i) : i + m]
            if 2 * len(window) > top * (m + len(window)):
                top = max(top, 2.0 * lcs(window, short) / (m + len(window)))
        return top

    return max(best(a, b), best(b, a)) if len(a) == len(b) else best(a, b)


def token_sorted(s: str) -> str:
    return " ".join(sorted(set(s.split())))


RATIOS = [
    "name_token_sort_ratio", "name_partial_ratio", "name_levenshtein_similarity", "address_partial_ratio",
    "address_levenshtein_similarity"
]


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A column of character codes a text, filled up with the largest code, and the lengths; codes are of the least width."""
    sizes = np.array([len(s) for s in texts])
    flat = "".join(texts)
    try:
        codes = np.frombuffer(flat.encode("latin-1"), np.uint8)
        fits = not len(codes) or codes.max() < 254
    except UnicodeEncodeError:
        fits = False
    if not fits:
        found, codes = np.unique(np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), "<u4"), return_inverse=True)
        codes = codes.astype(np.uint8 if len(found) < 254 else np.uint16 if len(found) < 65_534 else np.uint32)
    out = np.full((len(texts), sizes.max()), np.iinfo(codes.dtype).max, codes.dtype)
    out[np.arange(out.shape[1]) < sizes[:, None]] = codes
    return np.ascontiguousarray(out.T), sizes


def strands(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For every place of `long` where its strand began, counted from 1, or 0 if at the left, by combing all pairs at once.

    The semi-local LCS: a pair is a column; two strands cross at a match, or if they have not crossed before. The LCS of
    the whole short text and of long[l:r] is r - l less the strands that begin at l or later and end before r. What
    fills up texts matches nothing, and so changes nothing before it.
    """
    m, n, pairs = len(short), len(long), short.shape[1]
    kind = np.uint8 if n < 255 else np.uint16 if n < 65_535 else np.uint32
    across = np.zeros((m, pairs), kind)
    down = np.repeat(np.arange(n, 0, -1, dtype=kind)[:, None], pairs, axis=1)  # last place first
    turned = np.ascontiguousarray(long[::-1])
    apart, room = np.empty((m, pairs), bool), np.empty((m, pairs), kind)
    for d in range(m + n - 1):
        low, high = max(0, d - n + 1), min(m, d + 1)
        rows, places = slice(low, high), slice(n - 1 - d + low, n - 1 - d + high)
        h, v = across[rows], down[places]
        unequal, top = apart[: high - low], room[: high - low]
        np.not_equal(short[rows], turned[places], out=unequal)
        np.multiply(v, unequal.view(np.uint8), out=top)
        np.maximum(h, top, out=top)
        np.bitwise_xor(h, v, out=h)
        np.bitwise_xor(h, top, out=h)
        v[...] = top
    return down[::-1]


def combed(short: np.ndarray, m: np.ndarray, long: np.ndarray, n: np.ndarray, partial: bool) -> tuple[np.ndarray, np.ndarray]:
    """indel_ratio and partial_ratio of pairs in columns, the shorter text first; every text has characters."""
    began = strands(short, long)
    width, pairs = began.shape
    place = np.arange(width)[:, None]
    began[place >= n] = 0
    whole = 2.0 * (n - np.count_nonzero(began, axis=0)) / (m + n)
    if not partial:
        return whole, whole
    column = np.arange(pairs)
    first = np.maximum(place - m + 1, 0)
    counted = began > first  # strands that lie in some window, from `first` to before where they began
    at = lambda x: np.bincount((x * pairs + column)[counted], minlength=(width + 1) * pairs).reshape(width + 1, pairs)
    inner = np.cumsum(at(first) - at(began.astype(np.int64)), axis=0)[:width]
    inside = np.minimum(m, n - place)
    best = np.where(inside > 0, 2.0 * (inside - inner) / (m + np.maximum(inside, 0)), 0.0).max(axis=0)
    # Windows clipped at the left: the first 1 to m - 1 characters.
    size = place + 1
    clipped = 2.0 * (size - np.cumsum(began > 0, axis=0)) / (m + size)
    return whole, np.maximum(best, np.where(size < m, clipped, 0.0).max(axis=0))


#: Characters of all pairs that are combed together.
AT_ONCE = 1 << 16


def ratios(left: list[str], right: list[str], partial: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """indel_ratio and partial_ratio of each pair of texts; equal pairs are computed once."""
    number: dict[str, int] = {}
    a = np.array([number.setdefault(s, len(number)) for s in left])
    b = np.array([number.setdefault(s, len(number)) for s in right])
    return ratios_of(list(number), a, b, partial)


def ratios_of(texts: list[str], a: np.ndarray, b: np.ndarray, partial: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """ratios of pairs that are given as places in a list of different texts."""
    if not len(a):
        return np.zeros(0), np.zeros(0)
    distinct, pick = np.unique(a * len(texts) + b, return_inverse=True)
    a, b = distinct // len(texts), distinct % len(texts)
    size = np.array([len(s) for s in texts])
    whole = (a == b).astype(float)
    best = whole.copy()
    job = np.flatnonzero((a != b) & (size[a] > 0) & (size[b] > 0))
    x, y = a[job], b[job]
    turn = size[x] > size[y]
    x, y = np.where(turn, y, x), np.where(turn, x, y)
    if partial:  # of texts of one length each may be the shorter
        even = size[x] == size[y]
        job, x, y = np.concatenate([job, job[even]]), np.concatenate([x, y[even]]), np.concatenate([y, x[even]])
    order = np.lexsort((size[y], size[x]))
    job, x, y = job[order], x[order], y[order]
    k = 0
    while k < len(job):
        # Chunks of like sizes; a chunk's matrices are as wide as its longest texts.
        cells = np.maximum.accumulate(size[x[k : k + AT_ONCE]] + size[y[k : k + AT_ONCE]]) * np.arange(1, min(AT_ONCE, len(job) - k) + 1)
        end = k + max(1, int(np.searchsorted(cells, AT_ONCE)))
        i, j, at = x[k:end], y[k:end], job[k:end]
        used, spot = np.unique(np.concatenate([i, j]), return_inverse=True)
        codes, _ = coded([texts[t] for t in used])
        short, long = codes[: size[i].max(), spot[: len(i)]], codes[: size[j].max(), spot[len(i) :]]
        short = np.where(np.arange(len(short))[:, None] < size[i], short, np.iinfo(codes.dtype).max - 1)
        one, two = combed(short, size[i], long, size[j], partial)
        whole[at] = one
        np.maximum.at(best, at, two)
        k = end
    return whole[pick], best[pick]


#: Of each ratio the text and whether it is of sorted words, of all windows, or plain.
KINDS = {
    "name_token_sort_ratio": ("name", "sorted"), "name_partial_ratio": ("name", "partial"), "name_levenshtein_similarity": ("name", "plain"),
    "address_partial_ratio": ("address", "partial"), "address_levenshtein_similarity": ("address", "plain")
}


def compared(wanted: list[str] | tuple[str, ...]) -> list[str]:
    """The texts that some ratios need, in order."""
    return list(dict.fromkeys(KINDS[c][0] for c in wanted))


def sequence_ratios(wanted: tuple[str, ...] = tuple(RATIOS)):
    """A UDF of the left and right text of each of compared(wanted) that gives the ratios `wanted` in one pass.

    Equal pairs of texts within a batch are computed once.
    """
    def made(*columns: pd.Series) -> pd.DataFrame:
        sides = {k: (list(columns[2 * i]), list(columns[2 * i + 1])) for i, k in enumerate(compared(wanted))}
        done: dict[tuple[str, bool], tuple[np.ndarray, np.ndarray]] = {}
        out = {}
        for c in wanted:
            text, kind = KINDS[c]
            if kind == "sorted":
                by = {s: token_sorted(s) for side in sides[text] for s in set(side)}
                out[c] = ratios(*([by[s] for s in side] for side in sides[text]), partial=False)[0]
                continue
            if text not in done:
                done[text] = ratios(*sides[text], partial=any(KINDS[w] == (text, "partial") for w in wanted))
            out[c] = done[text][kind == "partial"]
        return pd.DataFrame(out)

    return F.pandas_udf(made, T.StructType([T.StructField(c, T.DoubleType()) for c in wanted]), F.PandasUDFType.SCALAR)
