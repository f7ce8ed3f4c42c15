"""Chat formatting in budgeted windows.

A conversation becomes training texts of at most ``budget`` tokens. Prefix sums
of the turns' token counts choose spans of whole turns: a window starts with
the conversation's system turn, repeats the last turns before its own span, as
many as fit in ``history`` tokens, and goes on with new turns while the budget
holds. Each turn is new in exactly one window, and only new assistant turns are
under the loss mask, so repeated targets are masked and every assistant text is
a target once. A turn that does not fit into any window is never cut: it gets a
window of its own behind the system turn, marked ``over_budget``.

The template is ``<|turn|>role<|text|>text<|end|>`` for each turn. Control
strings inside a role or text, its own and the usual ones of other templates,
are made harmless with the word joiner U+2060: it is put behind the first
character of a control string, and one that is already in the text is doubled.
``unescape`` takes that back exactly.

Rows come sorted by conversation and turn and are worked on as a stream: what is
held is the system turn, the recent turns and the open window, never a whole
conversation, so one with any share of the rows needs no more memory than others.

Defined results: null text and role are empty; a null conversation id is one
conversation; turns with equal numbers are ordered by role and text, and equal
rows are turns of their own; null turn numbers come first; the system turn is
the first turn if its role is `system`; a turn's tokens are those between white
space plus the template's; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Control strings of this and of other templates.
CONTROLS = (
    TURN, TEXT, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|eot_id|>", "<|start_header_id|>",
    "<|end_header_id|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>",
    "<</SYS>>",
)
JOINER = "⁠"
BUDGET, HISTORY = 1024, 256
TURN_TOKENS = 4
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"

_ESCAPE = re.compile(JOINER + "|" + "|".join(map(re.escape, sorted(CONTROLS, key=len, reverse=True))))
_UNESCAPE = re.compile(f"{JOINER}({JOINER}?)")

WINDOW_SCHEMA = (
    "conv_id long, window long, n_repeated int, has_system boolean, tokens long, over_budget boolean, "
    "text string, loss array<struct<start:int,end:int>>"
)
_WINDOW_TYPE = pa.schema(
    [
        ("conv_id", pa.int64()), ("window", pa.int64()), ("n_repeated", pa.int32()), ("has_system", pa.bool_()),
        ("tokens", pa.int64()), ("over_budget", pa.bool_()), ("text", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)
#: Characters of formatted text in a batch that goes back to Spark.
SLICE_CHARS = 4 << 20


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: JOINER * 2 if m[0] == JOINER else m[0][0] + JOINER + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def turn_tokens(role: str, text: str) -> int:
    return TURN_TOKENS + len(role.split()) + len(text.split())


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns of a formatted window; the places are those of the escaped text."""
    at = 0
    while at < len(text):
        middle = text.index(TEXT, at)
        end = text.index(END, middle)
        if not text.startswith(TURN, at):
            raise ValueError("a turn does not begin with its mark")
        start = middle + len(TEXT)
        yield unescape(text[at + len(TURN) : middle]), unescape(text[start:end]), start, end
        at = end + len(END)


class Conversation:
    """Windows of one conversation, from its turns in order."""

    def __init__(self, conv_id: int | None, budget: int, history: int, count: Callable[[str, str], int]):
        self.conv_id, self.budget, self.history, self.count = conv_id, budget, history, count
        self.system: tuple[str, str, int] | None = None
        self.recent: deque[tuple[str, str, int]] = deque()  # the last turns, within the history's tokens
        self.kept = 0  # their tokens
        self.repeated: list[tuple[str, str, int]] = []
        self.new: list[tuple[str, str, int]] = []
        self.before = self.upto = 0  # prefix sums: where the open span starts, and where it ends
        self.fixed = 0  # tokens of the system turn and the repeated turns of the open window
        self.turns = self.windows = 0

    def add(self, role: str, text: str) -> dict | None:
        """Takes a turn; a window that is full comes back."""
        turn = (role, text, self.count(role, text))
        self.turns += 1
        if self.turns == 1 and role == SYSTEM_ROLE:
            self.system = turn
            self.new.append(turn)
            self.upto += turn[2]
            return None
        done = None
        if self.new and self.fixed + self.upto + turn[2] - self.before > self.budget:
            done = self.close()
            self._open(turn[2])
        self.new.append(turn)
        self.upto += turn[2]
        return done

    def _open(self, first: int) -> None:
        """A new window: history goes as far as the first new turn leaves room."""
        self.before = self.upto
        self.fixed = self.system[2] if self.system else 0
        self.repeated = []
        for turn in reversed(self.recent):
            if self.fixed + turn[2] + first > self.budget:
                break
            self.repeated.insert(0, turn)
            self.fixed += turn[2]

    def close(self) -> dict | None:
        """The open window, if it has a turn."""
        if not self.new:
            return None
        parts, loss, at = [], [], 0
        head = [self.system] if self.system and self.windows else []
        for i, (role, text, _) in enumerate([*head, *self.repeated, *self.new]):
            shown = escape(text)
            lead = f"{TURN}{escape(role)}{TEXT}"
            if role == TARGET_ROLE and i >= len(head) + len(self.repeated):
                loss.append({"start": at + len(lead), "end": at + len(lead) + len(shown)})
            parts += [lead, shown, END]
            at += len(lead) + len(shown) + len(END)
        tokens = self.fixed + self.upto - self.before
        row = {
            "conv_id": self.conv_id, "window": self.windows, "n_repeated": len(self.repeated),
            "has_system": bool(head), "tokens": tokens, "over_budget": tokens > self.budget,
            "text": "".join(parts), "loss": loss,
        }
        for turn in self.new:
            if turn is not self.system:
                self.recent.append(turn)
                self.kept += turn[2]
        while self.recent and self.kept > self.history:
            self.kept -= self.recent.popleft()[2]
        self.windows += 1
        self.new, self.repeated = [], []
        return row


def _windows(budget: int, history: int, count: Callable[[str, str], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: Conversation | None = None
        rows: list[dict] = []
        size = 0
        for batch in batches:
            ids = batch.column("conv_id").to_pylist()
            roles, texts = batch.column("role"), batch.column("text")
            for i, conv_id in enumerate(ids):
                done = None
                if current is None or current.conv_id != conv_id:
                    done = current.close() if current else None
                    if done:
                        rows.append(done)
                        size += len(done["text"])
                    current = Conversation(conv_id, budget, history, count)
                done = current.add(roles[i].as_py() or "", texts[i].as_py() or "")
                if done:
                    rows.append(done)
                    size += len(done["text"])
                if size >= SLICE_CHARS:
                    yield pa.RecordBatch.from_pylist(rows, schema=_WINDOW_TYPE)
                    rows, size = [], 0
        if current and (done := current.close()):
            rows.append(done)
        yield pa.RecordBatch.from_pylist(rows, schema=_WINDOW_TYPE)

    return run


def format_conversations(
    turns: DataFrame,
    *,
    budget: int = BUDGET,
    history: int = HISTORY,
    count: Callable[[str, str], int] = turn_tokens,
) -> DataFrame:
    """Windows of all conversations; a conversation's windows are together, in order, in one partition.

    ``turns``: conv_id, turn, role, text. ``n_repeated`` turns follow the system
    turn (if ``has_system``) in a window before the new ones; ``loss`` holds the
    places in ``text`` that are targets.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_windows(budget, history, count), WINDOW_SCHEMA)


DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_windows long"
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in DIGEST_SCHEMA.split(", ")]
    done: list[list] = []
    current: list = []
    turns = loss = None

    def closed() -> list:
        return [current[0], current[1], turns.hexdigest(), current[2], loss.hexdigest(), current[3], current[4]]

    def table() -> pa.RecordBatch:
        types = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
        columns = zip(*done, strict=True) if done else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names
        )

    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in ("conv_id", "n_repeated", "has_system", "text", "loss")}
            if turns is None or current[0] != row["conv_id"]:
                if turns is not None:
                    done.append(closed())
                current, turns, loss = [row["conv_id"], 0, 0, 0, 0], hashlib.sha256(), hashlib.sha256()
            for k, (role, text, _, _) in enumerate(parse(row["text"])):
                if k >= row["n_repeated"] + row["has_system"]:
                    current[1] += 1
                    turns.update(f"{role}\n{text}\n".encode())
            for place in row["loss"]:
                target = unescape(row["text"][place["start"] : place["end"]])
                current[2] += len(target)
                loss.update(target.encode())
            current[3] += len(row["text"])
            current[4] += 1
        yield table()
        done.clear()
    if turns is not None:
        done.append(closed())
        yield table()


def digest_windows(windows: DataFrame) -> DataFrame:
    """Per conversation what its formatted windows hold, read from their text and
    loss mask alone; takes the windows as ``format_conversations`` leaves them."""
    return windows.mapInArrow(_digests, DIGEST_SCHEMA)
