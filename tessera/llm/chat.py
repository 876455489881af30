r"""Chat formatting into windows of a token budget.

A conversation's rows, by turn, become windows of whole turns. Prefix sums of turn tokens choose the span of each
window, by a search for the last turn that the budget allows and one for the first turn that the history's share allows.
Every window after the first begins with the system turn, if the conversation begins with one, and with that history.
Repeated turns are never under the loss mask, so each assistant text is a target once. A turn longer than the budget
has a window of its own.

Template: `<s>role\ntext</s>` for the assistant, `[INST]role\ntext[/INST]` for all others. Control strings inside texts
and roles are escaped with a backslash (which itself is doubled), reversibly.

Work is a stream over rows sorted by (conv_id, turn): a task holds the turns and prefix sums of one window, its history
and one turn more, however long a conversation is; one conversation is one task's. A turn takes some ten times its bytes.

Defined results: null texts and roles are empty; rows with equal turns are ordered by role and text; null turns come
first; rows with a null conv_id are one conversation; an empty table gives no windows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import codec_of, encoder
from .common import in_arrow

BUDGET = 2048
#: Of the budget, what repeated turns may take besides the system turn.
HISTORY = 512

OPENING, CLOSING = ("<s>", "[INST]"), ("</s>", "[/INST]")
CONTROL = re.compile(r"\\|</?s>|\[/?INST\]")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
#: Runs are possessive, so that a match keeps no state for each character.
TURN = re.compile(r"(?:<s>|\[INST\])((?:[^\\\n]++|\\.)*+)\n((?:[^\\<\[]++|\\.|<(?!/s>)|\[(?!/INST\]))*+)(?:</s>|\[/INST\])", re.DOTALL)


def escape(text: str) -> str:
    r"""Backslashes doubled, and a backslash put after the first character of each control string."""
    return CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def formatted(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and where its text is."""
    opening, closing = ("<s>", "</s>") if role == "assistant" else ("[INST]", "[/INST]")
    head = opening + escape(role).replace("\n", "\\\n") + "\n"
    body = escape(text)
    return head + body + closing, len(head), len(head) + len(body)


def parse(window: str) -> list[tuple[str, str]]:
    """(role, text) of all turns of a window."""
    out, at = [], 0
    while at < len(window):
        m = TURN.match(window, at)
        if m is None:
            raise ValueError(f"not a turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


class Turn:
    __slots__ = ("written", "begin", "end", "target", "tokens")

    def __init__(self, role: str, text: str, tokens: int):
        self.written, self.begin, self.end = formatted(role, text)
        self.target, self.tokens = role == "assistant", tokens


def row_of(repeated: list[Turn], new: list[Turn]) -> tuple[str, list[dict], int, int, int]:
    at, spans, turns = 0, [], repeated + new
    for n, t in enumerate(turns):
        if n >= len(repeated) and t.target:
            spans.append({"start": at + t.begin, "stop": at + t.end})
        at += len(t.written)
    return "".join(t.written for t in turns), spans, len(repeated), len(new), sum(t.tokens for t in turns)


def windows(turns: Iterator[tuple[str, str, int]], budget: int, history: int) -> Iterator[tuple]:
    """Windows of one conversation given as (role, text, tokens)."""
    system: Turn | None = None
    held: list[Turn] = []  # turns from the history on
    sums = [0]  # tokens before each of them, and after the last
    start, first = 0, True  # where the next window's new turns begin

    def more() -> bool:
        nonlocal system
        one = next(turns, None)
        if one is not None:
            held.append(Turn(*one))
            sums.append(sums[-1] + one[2])
            if first and len(held) == 1 and one[0] == "system":
                system = held[0]
        return one is not None

    while True:
        while sums[-1] - sums[start] <= budget and more():
            pass
        if start == len(held):
            return
        repeated: list[Turn] = []
        room = budget - held[start].tokens
        if not first and (system is None or system.tokens <= room):  # the history goes first, the system turn last
            repeated = [system] if system else []
            room -= sum(t.tokens for t in repeated)
            if room >= 0:
                oldest = bisect_left(sums, sums[start] - min(history, room), 0, start)
                repeated += held[oldest:start]
        free = budget - sum(t.tokens for t in repeated)
        stop = max(start + 1, bisect_right(sums, sums[start] + free, start + 1) - 1)
        yield row_of(repeated, held[start:stop])
        keep = bisect_left(sums, sums[stop] - history, 1 if first and system else 0, stop)
        del held[:keep], sums[:keep]
        start, first = stop - keep, False


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
OUT = "conv_id long, window long, text string, loss array<struct<start:long,stop:long>>, n_repeated long, n_turns long, n_tokens long"
KINDS = pa.schema(
    [
        ("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()), ("loss", SPANS), ("n_repeated", pa.int64()),
        ("n_turns", pa.int64()), ("n_tokens", pa.int64())
    ]
)


def framed(codec, budget: int, history: int):
    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        enc = encoder(codec.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                roles = [r or "" for r in b.column("role").to_pylist()]
                texts = [t or "" for t in b.column("text").to_pylist()]
                written = [formatted(r, t)[0] for r, t in zip(roles, texts, strict=True)]
                for conv, role, text, ids in zip(b.column("conv_id").to_pylist(), roles, texts, enc.encode(written), strict=True):
                    yield conv, role, text, len(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = turns(batches)
        ahead = next(stream, None)
        out: list[tuple] = []
        while ahead is not None:
            conv = ahead[0]

            def of_one():
                nonlocal ahead
                while ahead is not None and ahead[0] == conv:
                    this, ahead = ahead, next(stream, None)
                    yield this[1:]

            for n, row in enumerate(windows(of_one(), budget, history)):
                out.append((conv, n, *row))
                if len(out) >= 256:
                    yield batch(out)
                    out = []
        if out:
            yield batch(out)

    return run


def batch(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), KINDS, strict=True)], schema=KINDS)


def chat_windows(conversations: DataFrame, tokenizer_path: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """A row per window: conv_id, window, text, loss (spans of characters), n_repeated and n_turns new turns, n_tokens.

    Rows of one conversation come in order within a partition.
    """
    if not 0 <= history < budget:
        raise ValueError("the history's share must be less than the budget")
    codec = codec_of(conversations.sparkSession, tokenizer_path)
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    return rows.transform(in_arrow, framed(codec, budget, history), OUT)
