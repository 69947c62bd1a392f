"""Chat formatting in windows of a token budget.

The turns of a conversation are cut into spans where the prefix sums of their tokens reach the budget, so a span holds
whole turns. A window is the system turn, as much of the turns before the span as a smaller budget allows, and
the span. Only assistant turns of the span are under the loss mask: what a window repeats is masked.

The format is `<s>[ROLE] role` line feed, text `[/ROLE]</s>` for every turn. Control strings inside roles and texts get a backslash
after their first character, and one more where backslashes stand there already, so a control string
that is there in the output is always the template's, and removing one backslash gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUDGET = 1024
HISTORY = 256

OPEN, CLOSE = "<s>[ROLE]", "[/ROLE]</s>"
# Strings with a meaning to this template or to common others.
CONTROLS = ("<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")

_PLAIN = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROLS))
_ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROLS))
_TOKEN = re.compile(r"\w+|[^\w\s]")
_TURN = re.compile(r"<s>\[ROLE\] ((?:[^\n\\]|\\.)*)\n(.*?)\[/ROLE\]</s>", re.S)

WINDOW = T.StructType(
    [
        T.StructField("window", T.LongType()),
        T.StructField("first_turn", T.LongType()),
        T.StructField("last_turn", T.LongType()),
        T.StructField("n_repeated", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("loss", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
)


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def tokens(text: str) -> int:
    """Words and single signs."""
    return sum(1 for _ in _TOKEN.finditer(text))


@dataclass(slots=True)
class _Turn:
    place: int
    role: str
    text: str
    size: int


class _Conversation:
    """Windows of one conversation, fed turn by turn; holds one span, the history behind it and the system turn."""

    def __init__(self, budget: int, history: int):
        self.budget, self.most = budget, history
        self.system: _Turn | None = None
        self.history: deque[_Turn] = deque()
        self.kept = 0
        self.span: list[_Turn] = []
        self.sum = 0
        self.turns = 0
        self.windows = 0

    def add(self, role: str, text: str) -> dict | None:
        turn = _Turn(self.turns, role, text, tokens(text))
        self.turns += 1
        done = self.close() if self.span and self.sum + turn.size > self.budget else None
        self.span.append(turn)
        self.sum += turn.size
        return done

    def close(self) -> dict | None:
        """The window of the span so far; the span becomes history."""
        if not self.span:
            return None
        repeated = [t for t in self.history if t is not self.system]
        if self.system is not None:
            repeated.insert(0, self.system)
        out, loss, at = [], [], 0
        for k, turn in enumerate([*repeated, *self.span]):
            head = f"{OPEN} {_role_out(turn.role)}\n"
            body = escape(turn.text)
            if k >= len(repeated) and turn.role == "assistant":
                loss.append([at + len(head), at + len(head) + len(body)])
            out += [head, body, CLOSE]
            at += len(head) + len(body) + len(CLOSE)
        window = {
            "window": self.windows,
            "first_turn": self.span[0].place,
            "last_turn": self.span[-1].place,
            "n_repeated": len(repeated),
            "n_tokens": sum(t.size for t in repeated) + self.sum,
            "text": "".join(out),
            "loss": loss,
        }
        self.windows += 1
        for turn in self.span:
            if turn.place == 0 and turn.role == "system":
                self.system = turn
            self.history.append(turn)
            self.kept += turn.size
            while self.kept > self.most:
                self.kept -= self.history.popleft().size
        self.span, self.sum = [], 0
        return window


def format_chats(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
) -> DataFrame:
    """The windows of all conversations: the conversation's id and the columns of WINDOW.

    first_turn and last_turn count the turns of the conversation from 0; n_repeated turns stand before them in the
    window. loss lists [start, end) of code points in `text`: the assistant texts of the span, escaped. n_tokens counts
    the tokens of all texts of the window.

    - A null text is empty, and so is a null role. Rows with a null id are one conversation.
    - Turns are ordered by number (null first), role and text; repeated rows are turns of their own.
    - A turn over the budget is a span of its own: windows hold whole turns, and no turn is dropped.
    - Only a first turn of the role `system` is retained; later ones are turns as others.
    - No rows give no windows. Other columns are not read.

    Turns are sorted by conversation and streamed, so a task holds a window and a batch, however long a conversation.
    """
    plain = turns.select(
        F.col(conversation).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    kind = plain.schema["conv"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, chat = None, None

        def rows(found):
            frame = pd.DataFrame([{"conv": c, **w} for c, w in found], columns=["conv", *WINDOW.names])
            return frame.astype({"conv": object})

        for frame in frames:
            found = []
            # Null ids arrive as None or NaN, according to the column's type.
            ids = frame["conv"].astype(object).where(frame["conv"].notna(), None)
            for conv, role_, text_ in zip(ids, frame["role"], frame["text"]):
                if chat is None or conv != now:
                    if chat is not None and (done := chat.close()):
                        found.append((now, done))
                    now, chat = conv, _Conversation(budget, history)
                if done := chat.add(role_, text_):
                    found.append((now, done))
            if found:
                yield rows(found)
        if chat is not None and (done := chat.close()):
            yield rows([(now, done)])

    ordered = plain.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    out = ordered.mapInPandas(run, T.StructType([T.StructField("conv", kind.dataType), *WINDOW.fields]))
    return out.withColumnRenamed("conv", conversation)


def read_window(text: str) -> list[tuple[str, str]]:
    """The turns in a window's text."""
    return [(_role_in(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


def digests(windows: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """What the windows say, read back: turns and texts under the loss mask, by conversation.

    Every turn counts once, repeated ones do not. n_turns, turns_sha256 (role, line feed, text, line feed of each turn),
    loss_chars and loss_sha256 (of the unescaped texts under the mask, in order), formatted_chars, n_windows.
    """
    columns = [F.col(conversation).alias("conv"), "window", "n_repeated", "text", "loss"]
    plain = windows.select(*columns).repartition("conv").sortWithinPartitions("conv", "window")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None

        def row():
            n, turns_, chars, loss, size, count = state
            values = [now, n, turns_.hexdigest(), chars, loss.hexdigest(), size, count]
            return pd.DataFrame([values], columns=names).astype({"conv": object})

        names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
        for frame in frames:
            ready = []
            ids = frame["conv"].astype(object).where(frame["conv"].notna(), None)
            for conv, repeated, text, loss in zip(ids, frame["n_repeated"], frame["text"], frame["loss"]):
                if state is None or conv != now:
                    if state is not None:
                        ready.append(row())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, body in read_window(text)[repeated:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                for start, end in loss:
                    body = unescape(text[start:end])
                    state[2] += len(body)
                    state[3].update(body.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
                state[5] += 1
            if ready:
                yield pd.concat(ready)
        if state is not None:
            yield row()

    schema = T.StructType(
        [
            T.StructField("conv", plain.schema["conv"].dataType),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
            T.StructField("n_windows", T.LongType()),
        ]
    )
    return plain.mapInPandas(run, schema).withColumnRenamed("conv", conversation)
