"""Chat formatting in budgeted windows (operator 5).

A conversation becomes training windows of at most ``budget`` tokens. Prefix sums of the turns' tokens choose how many
whole turns fit; every window begins with the conversation's system turns and repeats at most ``history`` tokens of the
turns before it. The first window holds the system turns whole; where they are longer than ``system`` tokens, later
windows repeat their beginning, up to that bound. Assistant texts are targets once: in the window where they are new. Where they are repeated as history
they lie outside the loss mask.

Rows are sorted by conversation and turn inside the partitions and read as a stream, so a task holds one window's turns,
however long a conversation is.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. A control string begins with ``<|``; in a text one backslash is put
behind the ``<`` of every ``<``, backslashes, ``|``, and taken away again when read, so any text comes back as it was.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM, TARGET = "system", "assistant"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TOKEN = re.compile(r"\w+|[^\w\s]")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


@dataclass(frozen=True)
class Windows:
    """``budget`` tokens a window, ``history`` of them at most for repeated turns and ``system`` for the repeated system
    turns; each turn costs ``overhead`` more.

    A turn that is longer than the room left beside the system turns gets a window of its own and is not cut.
    """

    budget: int = 1024
    history: int = 256
    system: int = 512
    overhead: int = 4


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.S))


def count_tokens(text: str) -> int:
    """Words and single signs: a tokenizer-free measure of a turn."""
    return sum(1 for _ in _TOKEN.finditer(text))


@dataclass
class Window:
    formatted: str
    loss: list[dict[str, int]]
    n_repeated: int


class Conversation:
    """Takes turns in order and gives windows as soon as they are full."""

    def __init__(self, cfg: Windows):
        self.cfg = cfg
        self.system: list[tuple[str, str, int]] = []
        self.before: list[tuple[str, str, int]] = []  # the last turns of earlier windows
        self.turns: list[tuple[str, str, int]] = []  # not in a window yet
        self.prefix = [0]
        self.begun = False
        self.repeated_system: list[tuple[str, str, int]] = []  # the system turns of all windows but the first

    def add(self, role: str, text: str) -> Iterator[Window]:
        turn = role, text, count_tokens(text) + self.cfg.overhead
        if role == SYSTEM and not self.begun and not self.turns:
            self.system.append(turn)
            return
        self.turns.append(turn)
        self.prefix.append(self.prefix[-1] + turn[2])
        while len(self.turns) > 1 and self.prefix[-1] > self._room():
            yield self._cut()

    def finish(self) -> Iterator[Window]:
        while self.turns or (self.system and not self.begun):
            yield self._cut()

    def _history(self) -> list[tuple[str, str, int]]:
        kept, total = [], 0
        for turn in reversed(self.before):
            total += turn[2]
            if total > self.cfg.history:
                break
            kept.append(turn)
        return kept[::-1]

    def _retained(self) -> list[tuple[str, str, int]]:
        """The system turns as the next window shows them."""
        return self.repeated_system if self.begun else self.system

    def _room(self) -> int:
        fixed = sum(t[2] for t in self._retained()) + sum(t[2] for t in self._history())
        return self.cfg.budget - fixed

    def _cut(self) -> Window:
        history, room = self._history(), self._room()
        if history and self.turns and self.turns[0][2] > room:
            history, room = [], room + sum(t[2] for t in history)  # rather no history than a longer window
        # The last place whose prefix sum stays inside the room, and one turn at least.
        n = max(1, bisect_right(self.prefix, self.prefix[0] + room) - 1) if self.turns else 0
        new = self.turns[:n]
        repeated = self.repeated_system + history
        fresh = self.system + new  # empty once they have been shown
        out = format_turns(repeated, fresh)
        self.before = [*self.before, *new]
        total = 0
        for i in range(len(self.before) - 1, -1, -1):  # no more than the history can use
            total += self.before[i][2]
            if total > self.cfg.history:
                self.before = self.before[i + 1 :]
                break
        self.turns, base = self.turns[n:], self.prefix[n]
        self.prefix = [p - base for p in self.prefix[n:]]
        if not self.begun:
            self.begun, self.repeated_system = True, beginning(self.system, self.cfg)
            self.system = []
        return out


def beginning(turns: list[tuple[str, str, int]], cfg: Windows) -> list[tuple[str, str, int]]:
    """As many of the first turns as ``cfg.system`` tokens hold; the one that does not fit is cut behind its last token."""
    out, room = [], cfg.system
    for role, text, size in turns:
        if size > room:
            fits = [m.end() for m in islice(_TOKEN.finditer(text), max(0, room - cfg.overhead))]
            return [*out, (role, text[: fits[-1]], room)] if fits else out
        out.append((role, text, size))
        room -= size
    return out


def format_turns(repeated: list[tuple[str, str, int]], fresh: list[tuple[str, str, int]]) -> Window:
    parts, loss, place = [], [], 0
    for i, (role, text, _) in enumerate([*repeated, *fresh]):
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == TARGET and i >= len(repeated) and body:
            loss.append({"start": place + len(head), "end": place + len(head) + len(body)})
        parts += [head, body, END, "\n"]
        place += len(head) + len(body) + len(END) + 1
    return Window("".join(parts), loss, len(repeated))


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted window."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(formatted)]


WINDOW = "conv_id long, window int, formatted string, loss array<struct<start:int,end:int>>, n_repeated int"


def format_conversations(
    rows: DataFrame, cfg: Windows = Windows(), conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, window, formatted, loss, n_repeated): the windows of every conversation, numbered from 0.

    loss has the spans of target text in formatted, in code points; the first n_repeated turns are repeats. Turns go by
    turn, then role, then text, so ties and repeated rows have one order and are all kept; null turns come first. A null
    text or role is empty. Rows with a null conv_id are one conversation with that id. Other columns are ignored.
    """
    names = {"c": conv_id, "n": turn, "r": role, "t": text}
    kinds = {"c": "long", "n": "long", "r": "string", "t": "string"}
    ordered = rows.select(*[F.col(f"`{v}`").cast(kinds[k]).alias(k) for k, v in names.items()])
    ordered = ordered.repartition("c").sortWithinPartitions("c", "n", "r", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, number, out, size = None, None, 0, [], 0
        for batch in batches:
            for conv, who, what in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if held is None or conv != current:
                    done = list(held.finish()) if held else []
                    out += [(current, number + i, w) for i, w in enumerate(done)]
                    held, current, number = Conversation(cfg), conv, 0
                for window in held.add(who or "", what or ""):
                    out.append((current, number, window))
                    size += len(window.formatted)
                    number += 1
                if len(out) > 1000 or size > 1 << 22:
                    yield _batch(out)
                    out, size = [], 0
        if held:
            out += [(current, number + i, w) for i, w in enumerate(held.finish())]
        if out:
            yield _batch(out)

    return ordered.mapInArrow(run, WINDOW)


def _batch(out: list[tuple[int | None, int, Window]]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2].formatted for o in out], pa.string()),
         pa.array([o[2].loss for o in out], span), pa.array([o[2].n_repeated for o in out], pa.int32())],
        names=["conv_id", "window", "formatted", "loss", "n_repeated"],
    )


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest_windows(windows: DataFrame) -> DataFrame:
    """What a conversation's windows hold, read back from ``formatted`` and ``loss``, as counts and digests."""
    ordered = windows.select("conv_id", "window", "formatted", "loss", "n_repeated").repartition("conv_id").sortWithinPartitions("conv_id", "window")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current, out = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != current:
                    if state:
                        out.append((current, *_closed(state)))
                    state, current = {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0}, row["conv_id"]
                formatted = row["formatted"]
                for who, what in read_turns(formatted)[row["n_repeated"] :]:
                    state["n"] += 1
                    state["turns"].update(f"{who}\n{what}\n".encode())
                for span in row["loss"]:
                    target = unescape(formatted[span["start"] : span["end"]])
                    state["chars"] += len(target)
                    state["loss"].update(target.encode())
                state["formatted"] += len(formatted)
            if len(out) > 1000:
                yield _digests(out)
                out = []
        if state:
            out.append((current, *_closed(state)))
        if out:
            yield _digests(out)

    return ordered.mapInArrow(run, DIGEST)


def _closed(state: dict) -> tuple:
    return state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["formatted"]


def _digests(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
