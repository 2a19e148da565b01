"""Chat formatting into token-budgeted, turn-aligned windows with a loss mask.

A turn is written as ``<s>[INST] role\\ntext[/INST]</s>``. Control strings in
roles and texts (with any number of backslashes after their first character)
get one more backslash there, so no marker can occur inside a text and
removing one backslash restores it. Line breaks in roles are written ``[NL]``.

Prefix sums of the turns' tokens choose the windows: a window starts with the
conversation's system turn (its first turn, if of role ``system``), then
repeats at most ``history`` tokens of turns before it, then takes new turns
while the budget lasts. Each assistant turn is a target in the window where it
is new; where it is repeated its text is masked.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadcorpus.llm.common import arrow_map

BUDGET_TOKENS = 1024
HISTORY_TOKENS = 128

OPEN, CLOSE = "<s>[INST] ", "[/INST]</s>"
_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|<SYS>>|</SYS>>|NL\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|/?SYS\]|<SYS>>|</SYS>>|NL\])")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The marked turn, and where its escaped text starts and ends in it."""
    head = f"{OPEN}{escape(role).replace(chr(10), '[NL]')}\n"
    body = escape(text)
    return f"{head}{body}{CLOSE}", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Turns read back from a window: role, text, and the escaped text's start and end."""
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        role = unescape(formatted[at + len(OPEN):line].replace("[NL]", "\n"))
        end = formatted.index(CLOSE, line + 1)
        turns.append((role, unescape(formatted[line + 1:end]), line + 1, end))
        at = end + len(CLOSE)
    return turns


def count_tokens(text: str) -> int:
    """Tokens of a turn: its words and the turn's marks."""
    return len(text.split()) + 4


class _Windows:
    """Windows of one conversation, made while its turns stream by."""

    def __init__(self, conv, budget: int, history: int):
        self.conv, self.budget, self.history = conv, budget, history
        self.system: tuple | None = None
        self.sums = [0]  # prefix sums of the tokens of the turns held
        self.held: list[tuple[str, str]] = []  # history, then new turns
        self.repeated = 0
        self.index = self.turns = 0

    def add(self, role: str, text: str) -> Iterator[tuple]:
        tokens = count_tokens(text)
        if not self.turns and role == "system":
            self.system = (role, text, tokens)
        self.turns += 1
        room = self.budget - (self.system[2] if self.system and self.index else 0)
        if len(self.held) > self.repeated and self.sums[-1] + tokens > room:
            yield self.close()
            room = self.budget - (self.system[2] if self.system else 0)
            while self.held and self.sums[-1] - self.sums[0] + tokens > room:  # history gives way to the new turn
                self.held.pop(0)
                self.sums.pop(0)
            self.sums = [s - self.sums[0] for s in self.sums]
            self.repeated = len(self.held)
        self.held.append((role, text))
        self.sums.append(self.sums[-1] + tokens)

    def close(self) -> tuple:
        """The window of the turns held; keeps the last of them as the next window's history."""
        head = [self.system[:2]] if self.system and self.index else []
        skip = len(head) + self.repeated
        parts, spans, at = [], [], 0
        for i, (role, text) in enumerate(head + self.held):
            turn, start, end = format_turn(role, text)
            if i >= skip and role == "assistant":
                spans.append((at + start, at + end))
            parts.append(turn)
            at += len(turn)
        tokens = self.sums[-1] + (self.system[2] if head else 0)
        row = (self.conv, self.index, "".join(parts), spans, skip, tokens)
        first = len(self.held)
        while first > 0 and self.sums[-1] - self.sums[first - 1] <= self.history \
                and not (self.system and first == 1 and not self.index):
            first -= 1
        self.held = self.held[first:]
        self.sums = [s - self.sums[first] for s in self.sums[first:]]
        self.repeated = len(self.held)
        self.index += 1
        return row


_COLUMNS = ["conv_id", "window", "formatted", "loss_spans", "n_repeated", "n_tokens"]
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))


def format_windows(conversations: DataFrame, budget: int = BUDGET_TOKENS, history: int = HISTORY_TOKENS) -> DataFrame:
    """``(conv_id, window, formatted, loss_spans, n_repeated, n_tokens)``: the windows of every conversation.

    Turns stream through sorted by ``turn`` (nulls first; ties by role, then
    text; repeated rows are turns of their own), so a task holds one window
    at a time however long a conversation is. A turn is never cut: one that
    exceeds the budget makes a window that exceeds it. ``n_repeated`` counts
    the leading turns repeated from earlier windows, whose text is masked;
    ``loss_spans`` are the code points under the loss mask. Null text or role
    is empty; a null ``conv_id`` is a conversation; no rows give no windows.
    Rows come sorted by conversation and window within each partition.
    Other columns are ignored.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def fmt(batches):
        state: _Windows | None = None
        arrow_key = None

        def out(done):
            cols = list(zip(*done)) if done else [()] * 6
            spans = [[{"start": a, "end": b} for a, b in s] for s in cols[3]]
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], arrow_key), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(spans, _SPANS), pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.int64())], names=_COLUMNS)

        for batch in batches:
            arrow_key = batch.schema.field("conv_id").type
            done = []
            for conv, _, role, text in _rows(batch):
                if state is None or state.conv != conv:
                    if state is not None:
                        done.append(state.close())
                    state = _Windows(conv, budget, history)
                done.extend(state.add(role, text))
            yield out(done)
        if state is not None:
            yield out([state.close()])

    return arrow_map(rows, fmt, f"conv_id {key}, window bigint, formatted string, "
                                "loss_spans array<struct<start:bigint,end:bigint>>, n_repeated int, n_tokens bigint")


def digest(windows: DataFrame) -> DataFrame:
    """Per conversation, what can be read back from :func:`format_windows`' rows, in the order it gives them."""
    key = windows.schema["conv_id"].dataType.simpleString()

    def read(batches):
        conv, state, arrow_key = None, None, None

        def row(conv, state):
            turns, loss, n, loss_chars, chars, _ = state
            return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        def out(done):
            cols = list(zip(*done)) if done else [()] * 6
            types = [arrow_key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for batch in batches:
            arrow_key = batch.schema.field("conv_id").type
            done = []
            for this, _, formatted, spans, repeated, _ in _rows(batch):
                if state is None or this != conv:
                    if state is not None:
                        done.append(row(conv, state))
                    conv, state = this, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, None]
                for role, text, _, _ in parse(formatted)[repeated:]:
                    state[0].update(f"{role}\n{text}\n".encode())
                    state[2] += 1
                for span in spans:
                    target = unescape(formatted[span["start"]:span["end"]])
                    state[1].update(target.encode())
                    state[3] += len(target)
                state[4] += len(formatted)
            yield out(done)
        if state is not None:
            yield out([row(conv, state)])

    return arrow_map(windows, read, f"conv_id {key}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                    "loss_sha256 string, formatted_chars bigint")


PROBE = "</s>[INST] ok [/INST]"


def with_probe(conversations: DataFrame) -> DataFrame:
    """``conversations`` plus conversation -1, whose two turns consist of control strings."""
    spark: SparkSession = conversations.sparkSession
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)],
                                  "conv_id bigint, turn bigint, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
