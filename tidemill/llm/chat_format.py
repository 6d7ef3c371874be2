"""Chat formatting by incremental black-box rendering.

A template is any function from turns to a string. It is rendered on successive prefixes of a conversation, and
each output is compared with the one before: what was added is the turn's span. If the earlier output is
no prefix of the later one, the template rewrites history and the turn is marked so. A second rendering, with a
probe in place of the turn's text, tells where the text lies inside its span. Nothing of
the template's own marks needs to be known.

Control strings inside texts are escaped before rendering and unescaped on reading back, so no text can
open or close a turn.

Prefixes are true prefixes of the conversation, so the first message, turn numbers and late rewrites count at any
length; one conversation is then held by its task and rendered once more per turn. A template declared
``local`` (a turn's piece depends on that turn alone) has true prefixes for ``PROVEN`` turns; beyond, successive prefixes are rendered
over a window of the last turns, and whole ones only at twice as many turns each time and at the end, where
the pieces so far must be the output, else the declaration is wrong and an error. So a long conversation costs a few times
what it holds; its turns are held, at any size, so the declaration is never just trusted. Conversations are streamed turn by turn in order; one conversation stays in one
task, because its digests are sequential.

Defined results: null role and null text count as empty. Rows of a conversation go by turn, null turns first,
equal turns by role and text. Rows with null ``conv_id`` form one conversation.
Repeated rows are turns of their own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm.common import stored, table, text_of

Turn = tuple[str, str]
#: Turns of a window; turns of a local template that are rendered as true prefixes.
WINDOW, PROVEN = 16, 64
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
CONTROL = re.compile(r"\\|###|</turn>")
ROLE_CONTROL = re.compile(r"\\|###|</turn>|: ")
ESCAPED = re.compile(r"\\(\\|###|</turn>|: )")
#: Stands for a text when its place in the output is looked for; made longer where a role holds it.
PROBE = "\ue000probe\ue001"
PIECES = (
    "turn long, place long, piece string, start long, end long, loss_start long, loss_end long, rewrites boolean, verbatim boolean"
)


def escape(text: str, control: re.Pattern = CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


def marked_turns(turns: list[Turn]) -> str:
    """The template: ``### role: text</turn>`` and a line end per turn, with roles and texts already escaped."""
    return "".join(f"{OPEN}{role}{COLON}{text}{CLOSE}" for role, text in turns)


marked_turns.local = True


def read_turn(piece: str) -> Turn:
    """Role and text of one turn as ``marked_turns`` wrote it."""
    body = piece.removeprefix(OPEN).removesuffix(CLOSE)
    at = next(m for m in re.finditer(r"\\(?:\\|###|</turn>|: )|: ", body) if m[0] == COLON)
    return unescape(body[: at.start()]), unescape(body[at.end() :])


class Incremental:
    """Renders a conversation turn by turn and tells where each turn and its text came to lie."""

    def __init__(self, render: Callable[[list[Turn]], str], window: int | None = None, proven: int = 0):
        self.render, self.window, self.proven = render, window, proven
        self.recent: list[Turn] = []
        self.before = render([])
        self.base = len(self.before)
        self.turns: list[Turn] = []
        self.n_turns, self.output = 0, hashlib.sha256(self.before.encode("utf-8", "surrogatepass"))

    def add(self, role: str, text: str) -> tuple[str, int, int, int, bool, bool]:
        """Piece, start in the output, place of the text in the piece, its length, rewritten, verbatim."""
        if self.window and self.n_turns >= self.proven and len(self.recent) >= self.window:
            self.recent = self.recent[-(self.window // 2) :]
            self.before = self.render(self.recent)
        added = self._add(role, text)
        if self.window:
            self._note(role, text, added[0])
        return added

    def _note(self, role: str, text: str, piece: str) -> None:
        """Keep what the whole output must be, and look at it when the turns have doubled."""
        self.n_turns += 1
        self.output.update(piece.encode("utf-8", "surrogatepass"))
        self.turns.append((role, text))
        if self.n_turns & (self.n_turns - 1) == 0:
            self.prove()

    def prove(self) -> None:
        """The whole conversation, rendered at once, is what the pieces say."""
        if self.window and self.n_turns > self.proven:
            whole = self.render(self.turns)
            if len(whole) != self.base or hashlib.sha256(whole.encode("utf-8", "surrogatepass")).digest() != self.output.digest():
                raise ValueError(f"the template is declared local, but {self.n_turns} turns are not rendered as their pieces")

    def _add(self, role: str, text: str) -> tuple[str, int, int, int, bool, bool]:
        now = self.render([*self.recent, (role, text)])
        rewrites = not now.startswith(self.before)
        cut = _common(self.before, now) if rewrites else len(self.before)
        piece = now[cut:]
        sign = PROBE
        while sign in role:
            sign += PROBE
        probe = self.render([*self.recent, (role, sign)])[cut:]
        head = probe.find(sign)
        size = len(piece) - (len(probe) - len(sign))
        verbatim = head >= 0 and piece[head : head + size] == text
        start = self.base - (len(self.before) - cut)
        self.recent.append((role, text))
        self.before, self.base = now, start + len(piece)
        return piece, start, head, size, rewrites, verbatim


def _common(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def format_chats(
    conversations: DataFrame,
    render: Callable[[list[Turn]], str] = marked_turns,
    learn_role: str = "assistant",
    window: int | None = None,
) -> DataFrame:
    """A row per turn: its piece of the formatted conversation, span, the loss span inside the piece, and flags.

    ``start`` and ``end`` are code points of the conversation's output; the pieces of a conversation, in
    the order of ``place``, are the output. ``loss_start`` and ``loss_end`` are set for turns of ``learn_role``.
    ``window`` is for templates that look at no more than a turn; without it those declared ``local`` have ``WINDOW`` after ``PROVEN`` turns.
    """
    proven = 0
    if window is None and getattr(render, "local", False):
        window, proven = WINDOW, PROVEN

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, place = None, None, 0
        for batch in batches:
            out = []
            for conv, absent, turn, role, text in zip(
                batch["conv"].tolist(), batch["absent"].tolist(), batch["turn"].astype("Int64"), batch["role"], batch["text"], strict=True
            ):
                if state is None or current != (conv, absent):
                    if state:
                        state.prove()
                    current, state, place = (conv, absent), Incremental(render, window, proven), 0
                piece, start, head, size, rewrites, verbatim = state.add(escape(role, ROLE_CONTROL), escape(text))
                learn = role == learn_role and verbatim
                out.append(
                    (None if absent else conv, turn, place, piece, start, start + len(piece))
                    + ((head, head + size) if learn else (None, None))
                    + (rewrites, verbatim)
                )
                place += 1
            names = ["conv_id", *(c.split()[0] for c in PIECES.split(", "))]
            longs = dict.fromkeys(["conv_id", "turn", "loss_start", "loss_end"], "Int64")
            yield pd.DataFrame(out, columns=names).astype(longs)
        if state:
            state.prove()

    turns = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("conv_id").isNull().alias("absent"),
        F.col("turn").cast("long").alias("turn"),
        text_of("role").alias("role"),
        text_of("text").alias("text"),
    )
    ordered = turns.repartition("conv", "absent").sortWithinPartitions(
        "conv", "absent", F.col("turn").asc_nulls_first(), "role", "text"
    )
    return ordered.mapInPandas(pieces, f"conv_id long, {PIECES}")


def digest_chats(formatted: DataFrame) -> DataFrame:
    """What a reader of the output finds, per conversation; the pieces are unescaped and streamed in order."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars rewrites verbatim".split()
        current, row = object(), None

        def ended() -> list:
            return [] if row is None else [(*row[:2], row[2].hexdigest(), row[3], row[4].hexdigest(), *row[5:])]

        for batch in batches:
            out = []
            for conv, absent, piece, a, b, rewrites, verbatim in zip(
                batch["conv"].tolist(), batch["absent"].tolist(), batch["piece"],
                batch["loss_start"].tolist(), batch["loss_end"].tolist(), batch["rewrites"], batch["verbatim"], strict=True,
            ):
                if current != (conv, absent):
                    out += ended()
                    current = (conv, absent)
                    row = [None if absent else conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, False, True]
                role, text = read_turn(piece)
                row[1] += 1
                row[2].update(f"{role}\n{text}\n".encode())
                if a >= 0:
                    learnt = unescape(piece[int(a) : int(b)])
                    row[3] += len(learnt)
                    row[4].update(learnt.encode())
                row[5] += len(piece)
                row[6] |= bool(rewrites)
                row[7] &= bool(verbatim)
            yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
        yield pd.DataFrame(ended(), columns=names).astype({"conv_id": "Int64"})

    ordered = (
        formatted.select(
            F.coalesce("conv_id", F.lit(0)).alias("conv"),
            F.col("conv_id").isNull().alias("absent"),
            "place",
            "piece",
            F.coalesce("loss_start", F.lit(-1)).alias("loss_start"),
            F.coalesce("loss_end", F.lit(-1)).alias("loss_end"),
            "rewrites",
            "verbatim",
        )
        .repartition("conv", "absent")
        .sortWithinPartitions("conv", "absent", "place")
    )
    return ordered.mapInPandas(
        digests,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long, rewrites boolean, verbatim boolean",
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return digest_chats(stored(spark, format_chats(rows), "chats")).drop("verbatim")


QUERIES = {"op3_chat_format": op3_chat_format}
ORACLES: dict[str, str] = {}
