"""The eighteen features of queries and their lists of candidates, by arrays: what a query has is looked up for all its candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .similarity import ratios_of, token_sorted

#: Pairs that are compared together.
AT_ONCE = 1 << 17


class Bags:
    """Of every text the different items and how often it has each, one after the other."""

    def __init__(self, owner: np.ndarray, item: np.ndarray, n: int, width: int) -> None:
        keys, times = np.unique(owner * width + item, return_counts=True)
        self.items, self.times, self.width = keys % width, times.astype(float), width
        self.at = np.searchsorted(keys, np.arange(n + 1) * width)
        self.size = np.diff(self.at)
        squares = np.concatenate([[0.0], np.cumsum(self.times**2)])
        self.norm = np.sqrt(squares[self.at[1:]] - squares[self.at[:-1]])

    def met(self, left: np.ndarray, right: np.ndarray, starts: np.ndarray, dots: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Items in common of the pairs (left[k], each right from starts[k] on), and the products of their counts."""
        common, dot = np.zeros(len(right)), np.zeros(len(right)) if dots else None
        have, often = np.zeros(self.width), np.zeros(self.width)
        for k, q in enumerate(left.tolist()):
            low, high = starts[k], starts[k + 1]
            if low == high or not self.size[q]:
                continue
            mine = slice(self.at[q], self.at[q + 1])
            have[self.items[mine]], often[self.items[mine]] = 1.0, self.times[mine]
            other, pick = right[low:high], None
            sizes = self.size[other]
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1]) + np.repeat(self.at[other] - (ends - sizes), sizes)
            items = self.items[places]
            edges = np.concatenate([[0], ends])
            sums = np.concatenate([[0.0], np.cumsum(have[items])])
            common[low:high] = sums[edges[1:]] - sums[edges[:-1]]
            if dots:
                sums = np.concatenate([[0.0], np.cumsum(often[items] * self.times[places])])
                dot[low:high] = sums[edges[1:]] - sums[edges[:-1]]
            have[self.items[mine]] = often[self.items[mine]] = 0.0
        return common, dot


def bags(lists: list[list[str]]) -> Bags:
    number: dict[str, int] = {}
    item = np.array([number.setdefault(w, len(number)) for ws in lists for w in ws], np.int64)
    return Bags(np.repeat(np.arange(len(lists)), [len(ws) for ws in lists]), item, len(lists), max(1, len(number)))


def gram_bags(texts: list[str]) -> Bags:
    """Grams of three characters of the texts with two spaces on either side."""
    flat = np.frombuffer("".join(f"  {t}  " for t in texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    sizes = np.array([len(t) + 4 for t in texts])
    grams = flat[:-2] << 42 | flat[1:-1] << 21 | flat[2:]
    last = np.zeros(len(flat), bool)
    ends = np.cumsum(sizes)
    last[ends - 1] = last[ends - 2] = True  # grams that go on in the next text
    found, item = np.unique(grams[~last[:-2]], return_inverse=True)
    return Bags(np.repeat(np.arange(len(texts)), sizes - 2), item, len(texts), len(found))


class Column:
    """The values of both sides, each different one once."""

    def __init__(self, left: list, right: list) -> None:
        number: dict = {}
        self.left = np.array([number.setdefault(v, len(number)) for v in left], np.int64)
        self.right = np.array([number.setdefault(v, len(number)) for v in right], np.int64)
        self.values = list(number)


def share(common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    union = a + b - common
    return np.where(union > 0, common / np.maximum(union, 1), 1.0)


#: What each feature compares.
NEEDS = {
    "name_token_jaccard": ("name",), "name_token_sort_ratio": ("name",), "name_partial_ratio": ("name",), "name_levenshtein_similarity": ("name",),
    "name_character_similarity": ("name",), "name_tfidf_cosine": ("name",), "name_length_difference": ("name",), "address_token_jaccard": ("address",),
    "address_partial_ratio": ("address",), "address_levenshtein_similarity": ("address",), "address_character_similarity": ("address",),
    "address_tfidf_cosine": ("address",), "address_length_difference": ("address",), "country_match": ("country",), "exact_number_match": ("house",),
    "postal_code_match": ("postal",), "numeric_token_overlap": ("numbers",), "combined_tfidf_cosine": ("name", "address")
}


def features(
    left: dict[str, list], right: dict[str, list], starts: np.ndarray, rows: np.ndarray, wanted: list[str] | None = None
) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """(first query, last query, features by name) of runs of queries; query k has the right rows rows[starts[k]:starts[k + 1]].

    left and right have name, address, country, house, postal and numbers (a list each), or what `wanted` features need of them.
    """
    asked = set(NEEDS if wanted is None else wanted)
    some = lambda *names: bool(asked & set(names))
    column: dict[str, Column] = {}
    for c in {n for w in asked for n in NEEDS[w]}:
        values = [[tuple(sorted(set(x or ()))) for x in side[c]] if c == "numbers" else side[c] for side in (left, right)]
        column[c] = Column(*values)
    if some("combined_tfidf_cosine"):
        column["both"] = Column(*([f"{n} {a}" for n, a in zip(side["name"], side["address"])] for side in (left, right)))
    words, grams = {}, {}
    for what, cosine in (("name", "name_tfidf_cosine"), ("address", "address_tfidf_cosine"), ("both", "combined_tfidf_cosine")):
        if some(cosine, f"{what}_token_jaccard"):
            words[what] = bags([[w for w in t.split(" ") if w] for t in column[what].values])
        if some(f"{what}_character_similarity"):
            grams[what] = gram_bags(column[what].values)
    digits = bags([list(x) for x in column["numbers"].values]) if "numbers" in column else None
    ordered = Column([token_sorted(t) for t in column["name"].values], []) if some("name_token_sort_ratio") else None
    k = 0
    while k < len(starts) - 1:
        end = max(k + 1, int(np.searchsorted(starts, starts[k] + AT_ONCE, "right")) - 1)
        at, other, counts = starts[k : end + 1] - starts[k], rows[starts[k] : starts[end]], np.diff(starts[k : end + 1])
        out: dict[str, np.ndarray] = {}
        sides = lambda c: (np.repeat(c.left[k:end], counts), c.right[other])
        for what, bag in words.items():
            x, y = sides(column[what])
            cosine = "combined_tfidf_cosine" if what == "both" else f"{what}_tfidf_cosine"
            common, dot = bag.met(column[what].left[k:end], y, at, cosine in asked)
            nx, ny = bag.size[x], bag.size[y]
            if cosine in asked:
                with np.errstate(invalid="ignore", divide="ignore"):
                    out[cosine] = np.where((nx == 0) & (ny == 0), 1.0, np.where((nx == 0) | (ny == 0), 0.0, dot / (bag.norm[x] * bag.norm[y])))
            out[f"{what}_token_jaccard"] = share(common, nx, ny)
        for what, gram in grams.items():
            x, y = sides(column[what])
            out[f"{what}_character_similarity"] = share(gram.met(column[what].left[k:end], y, at, False)[0], gram.size[x], gram.size[y])
        for what in ("name", "address"):
            plain, partial, gap = (f"{what}_{f}" for f in ("levenshtein_similarity", "partial_ratio", "length_difference"))
            if some(plain, partial):
                out[plain], out[partial] = ratios_of(column[what].values, *sides(column[what]), partial=partial in asked)
            if gap in asked:
                length = np.array([len(t) for t in column[what].values])
                x, y = sides(column[what])
                out[gap] = np.abs(length[x] - length[y]).astype(float)
        if ordered is not None:
            x, y = sides(column["name"])
            out["name_token_sort_ratio"] = ratios_of(ordered.values, ordered.left[x], ordered.left[y], partial=False)[0]
        if digits is not None:
            x, y = sides(column["numbers"])
            out["numeric_token_overlap"] = share(digits.met(column["numbers"].left[k:end], y, at, False)[0], digits.size[x], digits.size[y])
        if "country" in column:
            x, y = sides(column["country"])
            out["country_match"] = (x == y).astype(float)
        for feature, c in (("exact_number_match", "house"), ("postal_code_match", "postal")):
            if c in column:
                x, y = sides(column[c])
                empty = column[c].values.index("") if "" in column[c].values else -1
                out[feature] = ((x == y) & (x != empty)).astype(float)
        yield k, end, {f: v for f, v in out.items() if f in asked}
        k = end
