"""BPE encoding and decoding by speculation and verification.

Greedy longest match over a trie proposes tokens for all distinct words of a batch at once. A proposal is the BPE result
if every token encodes to itself and every adjacent pair is compatible, that is, if merging the pair's bytes from the
start gives the same two tokens; the pair check undoes merges from both sides of the seam, for all pairs at once. Only
words with a failing pair go through exact merging by rank.

Works for tokenizer files (JSON) of the tokenizers library with byte-level BPE whose pre-tokenizer is one of the two that
are known here, with or without a word-end suffix; any other file is an error.
Cutting a text into words is the library's own pre-tokenizer, or the same pattern here for texts of plain Latin
characters; strings of special tokens inside a text get the special ids, as in the library.

Defined results: null and empty texts have no tokens and decode to the empty text; an empty table gives an empty
result; repeated rows each have a row; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, slices

#: Longer words are proposed one by one, so that one of them doesn't hold up a batch; they are verified like all others.
LONG_WORD = 128
#: Printable ASCII, the Latin letters and signs for which Python and the library agree on case, classes and composition.
PLAIN = re.compile("[\\t\\n\\r -~¡-¬®-±´-¸º»¿-įı-ž–—‘-„…€]*")
BYTE_LEVEL_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
LOWER_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
BYTE_LEVEL, LOWER = "byte_level", "lower"
# The normalizers and pre-tokenizers, as files of the library have them, that the two patterns stand for.
KNOWN = {
    BYTE_LEVEL: (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}),
    LOWER: (
        {
            "type": "Sequence",
            "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
        },
        {"type": "Sequence", "pretokenizers": [
            {
                "type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed", "invert": True
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ]},
    ),
}


def kind_of(spec: dict) -> str:
    """Which of the known kinds a tokenizer file is; an error if none."""
    model = spec["model"]
    odd = [k for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += [t["content"] for t in spec.get("added_tokens", []) if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
    if model.get("type", "BPE") != "BPE" or odd:
        raise ValueError(f"not a byte-level BPE that is known here: {model.get('type')} {odd}")
    for kind, parts in KNOWN.items():
        if parts == (spec.get("normalizer"), spec.get("pre_tokenizer")):
            return kind
    raise ValueError("the file's normalizer and pre-tokenizer are not known here")


def byte_chars() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in own}
    for n, b in enumerate(b for b in range(256) if b not in chars):
        chars[b] = chr(256 + n)
    return [chars[b] for b in range(256)]


class IntMap:
    """Non-negative int64 keys to int32 values by open addressing; lookups take whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(8, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        slot, todo = self.slots(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[slot[todo]] < 0
            self.keys[slot[todo[free]]] = keys[todo[free]]
            put = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[put]]] = values[todo[put]]
            todo = todo[~put]
            slot[todo] = (slot[todo] + 1) & self.mask

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where a key is missing."""
        slot = self.slots(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], np.int32(-1))
        todo = np.flatnonzero((there != keys) & (there >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            there = self.keys[slot[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (there >= 0)]
        return out


#: Byte classes of texts whose bytes from 128 on all belong to letters: separator, letter, digit, sign, white space.
SEPARATOR, LETTER, DIGIT, SIGN, SPACE = range(5)
CLASSES = np.full(256, SIGN, np.int8)
CLASSES[0] = SEPARATOR
CLASSES[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
CLASSES[48:58] = DIGIT
CLASSES[[9, 10, 13, 32]] = SPACE
#: Characters of PLAIN above ASCII that are no letters.
SIGNS = re.compile("[¡-©«¬®-±´¶-¹»¿×÷–-€]")


def word_starts(data: np.ndarray, lower: bool) -> np.ndarray:
    """Where the patterns above begin a match, for bytes of the classes above with zero bytes between the texts.

    lower: of the two patterns the one that leaves out white space; its runs begin here too, to end the word before.
    """
    kind = CLASSES[data]
    start = np.ones(len(kind), bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    quote = np.flatnonzero(data == 39)
    quote = quote[start[quote]]
    if lower:
        start |= kind == DIGIT
    else:
        at = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != SEPARATOR))
        start[at] = True  # the last white space of a run goes by itself, or
        at = at[data[at] == 32]
        start[at + 1] = False  # if a space, with what follows it
        quote = quote[start[quote]]
    nxt, third = (data[np.minimum(quote + k, len(data) - 1)] for k in (1, 2))
    nxt[quote + 1 >= len(data)] = third[quote + 2 >= len(data)] = 0
    two = (nxt == 115) | (nxt == 116) | (nxt == 109) | (nxt == 100)  # 's 't 'm 'd
    three = ((nxt == 114) | (nxt == 118)) & (third == 101) | (nxt == 108) & (third == 108)  # 're 've 'll
    for which, length in ((two, 2), (three, 3)):
        at = quote[which]
        start[at + 1] = False
        end = at + length
        start[end[end < len(data)]] = True
    return start & (kind != SEPARATOR)


class Codec:
    """Vocabulary and merges of a tokenizer file, in an order of its own: base symbols, then merges by rank."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        model = j["model"]
        vocab: dict[str, int] = model["vocab"]
        self.spec = spec
        self.suffix = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
        self.kind = kind_of(j)
        chars = byte_chars()
        names = [*chars, *([c + self.suffix for c in chars] if self.suffix else [])]
        spelled = [bytes([b]) for b in range(256)] * (2 if self.suffix else 1)
        base = self.base = len(names)
        number = {n: i for i, n in enumerate(names)}
        left, right = list(range(base)), list(range(base))
        symbols: list[tuple[int, ...]] = [(i,) for i in range(base)]
        self.unique = True
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            self.unique &= a + b not in number
            number.setdefault(a + b, len(names))
            x, y = number[a], number[b]
            names.append(a + b)
            left.append(x)
            right.append(y)
            symbols.append(symbols[x] + symbols[y])
            spelled.append(spelled[x] + spelled[y])
        self.left, self.right = np.array(left, np.int64), np.array(right, np.int64)
        self.ids = np.array([vocab[n] for n in names], np.uint32)
        self.size = 1 << len(names).bit_length()
        self.merges = {(a, b): base + i for i, (a, b) in enumerate(zip(left[base:], right[base:], strict=True))}
        self.pairs = IntMap(self.left[base:] * self.size + self.right[base:], np.arange(base, len(names), dtype=np.int32))
        by_id = {int(i): s for i, s in zip(self.ids, spelled, strict=True)} | {i: s.encode() for s, i in self.specials.items()}
        self.spelled = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        edges: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for t, s in enumerate(symbols):
            node = 0
            for x in s:
                node = edges.setdefault((node, x), len(edges) + 1)
            ends.setdefault(node, t)
        at = np.array(list(edges), np.int64).reshape(-1, 2)
        self.edges = IntMap(at[:, 0] * base + at[:, 1], np.fromiter(edges.values(), np.int32, len(edges)))
        self.ends = np.full(len(edges) + 1, -1, np.int64)
        self.ends[list(ends)] = list(ends.values())
        self.walk: dict[int, int] | None = None
        self.safe = np.array([t < base or self.merged(list(s)) == [t] for t, s in enumerate(symbols)])

    def merged(self, word: list[int]) -> list[int]:
        """Exact BPE of base symbols: always the merge of lowest rank, the leftmost first."""
        merges = self.merges
        if len(word) <= 40:
            while len(word) > 1:
                ranks = [merges.get(p, 1 << 60) for p in zip(word, word[1:], strict=False)]
                best = min(ranks)
                if best == 1 << 60:
                    break
                i, out, n = 0, [], len(word)
                while i < n:
                    if i < n - 1 and ranks[i] == best:
                        out.append(best)
                        i += 2
                    else:
                        out.append(word[i])
                        i += 1
                word = out
            return word
        n = len(word)
        word, after, before = list(word), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[p], i) for i, p in enumerate(zip(word, word[1:], strict=False)) if p in merges]
        heapq.heapify(heap)
        while heap:
            t, i = heapq.heappop(heap)
            j = after[i]
            if word[i] < 0 or j >= n or merges.get((word[i], word[j])) != t:
                continue
            word[i], word[j] = t, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := merges.get((t, word[k]))) is not None:
                    heapq.heappush(heap, (p, i))
            if (h := before[i]) >= 0 and (p := merges.get((word[h], t))) is not None:
                heapq.heappush(heap, (p, h))
        return [t for t in word if t >= 0]

    def merged_all(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact BPE of many words at once: each round does the merge of lowest rank of every word, the leftmost first."""
        none = np.int64(1 << 40)
        tokens, done_word, done_token = symbols, [], []
        rank = self.ranks(tokens, word, none)
        while len(tokens):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(word)])
            over = np.repeat(best == none, sizes)
            if over.any():
                done_word.append(word[over])
                done_token.append(tokens[over])
                tokens, word, rank, best, sizes = tokens[~over], word[~over], rank[~over], best[best != none], sizes[best != none]
                if not len(tokens):
                    break
            hit = rank == np.repeat(best, sizes)
            hit[1:] &= ~hit[:-1]  # of hits in a row the first; the others have another round
            tokens = np.where(hit, rank, tokens)
            keep = np.r_[True, ~hit[:-1]]
            changed = hit | np.r_[hit[1:], False] | np.r_[False, False, hit[:-2]]
            tokens, word, rank, changed = tokens[keep], word[keep], rank[keep], changed[keep]
            at = np.flatnonzero(changed)
            nxt = np.minimum(at + 1, len(tokens) - 1)
            fresh = self.pairs.get(tokens[at] * self.size + tokens[nxt]).astype(np.int64)
            fresh[(fresh < 0) | (word[nxt] != word[at]) | (nxt == at)] = none
            rank[at] = fresh
        words, tokens = np.concatenate(done_word), np.concatenate(done_token)
        order = np.argsort(words, kind="stable")
        return words[order], tokens[order]

    def ranks(self, tokens: np.ndarray, word: np.ndarray, none: np.int64) -> np.ndarray:
        """The merge that each token has with the next one of its word."""
        rank = np.full(len(tokens), none)
        got = self.pairs.get(tokens[:-1] * self.size + tokens[1:]).astype(np.int64)
        got[(got < 0) | (word[1:] != word[:-1])] = none
        rank[:-1] = got
        return rank

    def proposed(self, symbols: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words at once: (word number, token) in order."""
        word, p, node = np.arange(len(starts)), starts.copy(), np.zeros(len(starts), np.int64)
        best, best_end, stops = np.full(len(starts), -1, np.int64), starts.copy(), stops
        out_word, out_token = [], []
        while len(word):
            more = p < stops
            nxt = np.full(len(word), -1, np.int64)
            nxt[more] = self.edges.get(node[more] * self.base + symbols[p[more]])
            on = nxt >= 0
            node = np.where(on, nxt, 0)
            p = p + on
            end = np.where(on, self.ends[node], -1)
            hit = end >= 0
            best, best_end = np.where(hit, end, best), np.where(hit, p, best_end)
            off = np.flatnonzero(~on)
            if len(off):
                out_word.append(word[off])
                out_token.append(best[off])
                p[off] = best_end[off]
                if (done := best_end[off] >= stops[off]).any():
                    live = np.ones(len(word), bool)
                    live[off[done]] = False
                    word, p, node, best, best_end, stops = word[live], p[live], node[live], best[live], best_end[live], stops[live]
        words, tokens = np.concatenate(out_word), np.concatenate(out_token)
        order = np.argsort(words, kind="stable")
        return words[order], tokens[order]

    def proposed_one(self, symbols: list[int]) -> list[int]:
        """Greedy longest match of one long word."""
        if self.walk is None:
            some = self.edges.keys >= 0
            self.walk = dict(zip(self.edges.keys[some].tolist(), self.edges.values[some].tolist(), strict=True))
        walk, ends, base, n = self.walk, self.ends, self.base, len(symbols)
        out, p = [], 0
        while p < n:
            node, at, best, best_at = 0, p, -1, p
            while at < n and (node := walk.get(node * base + symbols[at], -1)) >= 0:
                at += 1
                if (token := ends[node]) >= 0:
                    best, best_at = token, at
            out.append(best)
            p = best_at
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether BPE of their joined symbols gives back the two.

        Merges are undone from the seam outwards, the later of the two first. If at some stage the pieces next to the
        seam have a merge of a lower rank than what was undone, BPE would have merged across the seam.
        """
        good = np.ones(len(a), bool)
        at, x, y, limit = np.arange(len(a)), a.copy(), b.copy(), np.full(len(a), 1 << 40)
        while len(at):
            across = self.pairs.get(x * self.size + y)
            bad = (across >= 0) & (across < limit)
            good[at[bad]] = False
            part_x, part_y = self.right[x], self.left[y]
            can_x, can_y = part_x != x, part_y != y
            undo_x = can_x & ((x > y) | ~can_y)
            undo_y = can_y & ~undo_x
            limit = np.where(undo_x, x, y + 1)
            x, y = np.where(undo_x, part_x, x), np.where(undo_y, part_y, y)
            live = ~bad & (can_x | can_y)
            at, x, y, limit = at[live], x[live], y[live], limit[live]
        return good

    def encode_flat(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words data[starts:stops], none empty: (word number, id) of all tokens in order."""
        symbols = data.astype(np.int64)
        if self.suffix:
            symbols[stops - 1] += 256
        long = stops - starts > LONG_WORD
        short = np.flatnonzero(~long)
        word, token = self.proposed(symbols, starts[short], stops[short]) if len(short) else (np.zeros(0, np.int64),) * 2
        word = short[word]
        if long.any():
            words, tokens = [word], [token]
            for n in np.flatnonzero(long).tolist():
                tokens.append(np.array(self.proposed_one(symbols[starts[n] : stops[n]].tolist()), np.int64))
                words.append(np.full(len(tokens[-1]), n))
            word, token = np.concatenate(words), np.concatenate(tokens)
            order = np.argsort(word, kind="stable")
            word, token = word[order], token[order]
        fails = ~self.safe[token] | (not self.unique)
        seam = np.flatnonzero(word[1:] == word[:-1])
        fails[seam] |= ~self.compatible(token[seam], token[seam + 1])
        failing = np.zeros(len(starts), bool)
        failing[word[fails]] = True
        words, tokens = [word[~failing[word]]], [token[~failing[word]]]
        if len(again := np.flatnonzero(failing & ~long)):
            sizes = stops[again] - starts[again]
            at = np.arange(sizes.sum()) + np.repeat(starts[again] - np.cumsum(sizes) + sizes, sizes)
            word, token = self.merged_all(symbols[at], np.repeat(again, sizes))
            words.append(word)
            tokens.append(token)
        for n in np.flatnonzero(failing & long).tolist():
            one = self.merged(symbols[starts[n] : stops[n]].tolist())
            words.append(np.full(len(one), n))
            tokens.append(np.array(one, np.int64))
        word, token = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(word, kind="stable")
        return word[order], self.ids[token[order]]

    def decode(self, ids: list[int]) -> str:
        """The text; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")


#: Random values of each byte at each place of a word; a word's hash is their sum.
TABULATED = np.random.default_rng(1).integers(0, 1 << 63, LONG_WORD * 256, dtype=np.int64)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


class Encoder:
    """Whole texts to ids, a batch at a time: cut into words, the distinct words encoded, their ids dealt out again."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.library = None
        self.special = re.compile("|".join(map(re.escape, sorted(codec.specials, key=len, reverse=True)))) if codec.specials else None
        self.begins = {t[0] for t in codec.specials}

    def words(self, text: str) -> list[bytes]:
        """The words of a text that the byte classes don't fit."""
        if PLAIN.fullmatch(text):
            lower = self.codec.kind == LOWER
            return [w.encode() for w in (LOWER_WORD if lower else BYTE_LEVEL_WORD).findall(text.lower() if lower else text)]
        if self.library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.codec.spec)
            self.bytes_of = {c: b for b, c in enumerate(byte_chars())}
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        return [bytes(map(self.bytes_of.__getitem__, w)) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def with_specials(self, text: str) -> np.ndarray:
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*self.encode([text[at : m.start()]]), np.array([self.codec.specials[m[0]]], "<u4")]
            at = m.end()
        return np.concatenate([*out, *self.encode([text[at:]])])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        usual, odd, odd_words = [], [], []
        for n, t in enumerate(texts):
            if any(c in t for c in self.begins) and self.special.search(t):
                out[n] = self.with_specials(t)
            elif t.isascii() and PLAIN.fullmatch(t) or PLAIN.fullmatch(t) and not SIGNS.search(t):
                usual.append(n)
            else:
                own = self.words(t)
                odd_words += own
                odd += [n] * len(own)
        lower = self.codec.kind == LOWER
        data = np.frombuffer("\0".join([texts[n].lower() if lower else texts[n] for n in usual]).encode(), np.uint8)
        starts = np.flatnonzero(word_starts(data, lower)) if len(data) else np.zeros(0, np.int64)
        gaps = np.flatnonzero(data == 0)
        which = np.searchsorted(gaps, starts)
        stops = np.minimum(np.r_[starts[1:], len(data)], np.r_[gaps, len(data)][which]) if len(starts) else starts
        if lower:
            keep = CLASSES[data[starts]] != SPACE
            starts, stops, which = starts[keep], stops[keep], which[keep]
        doc = np.array(usual, np.int64)[which] if usual else which
        if odd_words:
            sizes = np.array([len(w) for w in odd_words], np.int64)
            ends = np.cumsum(sizes) + len(data)
            data = np.concatenate([data, np.frombuffer(b"".join(odd_words), np.uint8)])
            starts, stops, doc = np.r_[starts, ends - sizes], np.r_[stops, ends], np.r_[doc, odd]
        for n, ids in self.dealt(data, starts, stops, doc):
            out[n] = ids
        return out

    @staticmethod
    def hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A hash of each word of up to LONG_WORD bytes, and its first eight bytes as an integer."""
        begin = starts[0]
        spans = np.diff(np.r_[starts, len(data)]).astype(np.int32)
        place = np.arange(len(data) - begin, dtype=np.int32) - np.repeat((starts - begin).astype(np.int32), spans)
        outside = place >= np.repeat(sizes.astype(np.int32), spans)
        np.minimum(place, LONG_WORD - 1, out=place)
        place <<= 8
        place += data[begin:]
        values = TABULATED[place]
        values[outside] = 0
        packed = np.zeros(len(starts), np.uint64)
        for k in range(8):
            inside = sizes > k
            packed[inside] |= data[starts[inside] + k].astype(np.uint64) << np.uint64(8 * k)
        return np.add.reduceat(values, starts - begin), packed

    def dealt(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(document, its ids) for words data[starts:stops] of documents in some order, each document's words in order."""
        if not len(starts):
            return
        sizes = stops - starts
        long = sizes > LONG_WORD
        first, which = np.arange(len(starts)), np.arange(len(starts))
        short = np.flatnonzero(~long)
        if len(short):
            one, two = self.hashes(data, starts, sizes)
            _, index, inverse = np.unique(one[short], return_index=True, return_inverse=True)
            index = short[index]
            if (two[index][inverse] == two[short]).all() and (sizes[index][inverse] == sizes[short]).all():
                first = np.r_[index, np.flatnonzero(long)]
                which[short] = inverse
                which[long] = len(index) + np.arange(long.sum())
        size = sizes[first]
        end = np.cumsum(size)
        word, ids = self.codec.encode_flat(data[ranges(starts[first], size)], end - size, end)
        cut = np.searchsorted(word, np.arange(len(first) + 1))
        count = np.diff(cut)[which]
        tokens = ids[ranges(cut[which], count)].astype("<u4")
        begins = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        ends = np.cumsum(np.add.reduceat(count, begins))
        for n, a, b in zip(doc[begins].tolist(), [0, *ends.tolist()], ends.tolist(), strict=False):
            yield n, tokens[a:b]


_encoders: dict[int, Encoder] = {}


def encoder(codec: Codec) -> Encoder:
    """One encoder for each worker process and tokenizer file."""
    key = hash(codec.spec)
    if key not in _encoders:
        _encoders[key] = Encoder(codec)
    return _encoders[key]


def codec_of(spark, path: str):
    """The codec of a tokenizer file, read by the driver and broadcast; some MB whatever the input's size."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(Codec(f.read()))


def encoded(codec, decode: bool, digest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(codec.value)
        for b in slices(batches, most=3 << 20):
            texts = [t or "" for t in b.column("text").to_pylist()]
            ids = enc.encode(texts)
            cols = [b.column("doc_id"), pa.array([len(i) for i in ids], pa.int64())]
            names = ["doc_id", "n_tokens"]
            back = [enc.codec.decode(i.tolist()) for i in ids] if decode else None
            if digest:
                for name, values in digest(ids, back).items():
                    names.append(name)
                    cols.append(pa.array(values, pa.string()))
            else:
                names.append("ids")
                cols.append(pa.array(ids, pa.list_(pa.int64())))
                if decode:
                    names.append("decoded")
                    cols.append(pa.array(back, pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


def bpe_encode(docs: DataFrame, tokenizer_path: str, decode: bool = False, digest=None, digest_columns: tuple[str, ...] = ()) -> DataFrame:
    """A row per document: doc_id, n_tokens, ids array<long>, and decoded if asked for.

    digest: a function of (ids, decoded texts) to lists of strings by column; it takes the place of ids and decoded, so
    that only digests leave the worker.
    """
    codec = codec_of(docs.sparkSession, tokenizer_path)
    more = "".join(f", {c} string" for c in digest_columns) if digest else ", ids array<long>" + ", decoded string" * decode
    return docs.select(F.col("doc_id").cast("long"), "text").transform(
        in_arrow, encoded(codec, decode, digest), f"doc_id long, n_tokens long{more}"
    )


def bpe_decode(rows: DataFrame, tokenizer_path: str, ids: str = "ids") -> DataFrame:
    """rows with a column `decoded`, the text of the ids; null ids give the empty text."""
    codec = codec_of(rows.sparkSession, tokenizer_path)
    kind = rows.drop("decoded").select("*", F.lit("").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [codec.value.decode(i or []) for i in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "decoded"])

    return rows.drop("decoded").transform(in_arrow, run, kind)
