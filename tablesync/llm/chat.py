"""Chat formatting by incremental rendering of a black-box template.

A template is a function from a list of turns to a string. The successive
prefixes of a conversation are rendered; what a prefix adds to the one before
it is the new turn's span. A template that changes what it had already
rendered rewrites history: from there on no span can be trusted.

A template may declare its ``context``: how many turns before a turn can bear on
how that turn is rendered. Prefixes are then rendered within windows of
``WINDOW`` turns that overlap by the context, so long conversations cost time
in proportion to their length and memory for one window. Without it the whole
history is rendered again for every turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import map_rows

WINDOW = 32
START, END = "<|im_start|>", "<|im_end|>"
Turn = tuple[str, str]


@dataclass(frozen=True)
class Template:
    """How turns become text, and how many earlier turns bear on a turn (None: all)."""

    render: Callable[[list[Turn]], str]
    context: int | None = None


def escape(text: str) -> str:
    """``text`` without control strings: every ``<|`` gets a backslash inside, one more if it has some."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    """What :func:`escape` was given."""
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line, without control strings."""
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def unescape_role(role: str) -> str:
    """What :func:`escape_role` was given."""
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def render_marked(turns: list[Turn]) -> str:
    """Each turn between marks, its role on the first line, control strings escaped."""
    return "".join(f"{START}{escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns)


MARKED = Template(render_marked, context=0)


def read_turn(part: str) -> tuple[str, str, int, int]:
    """Role and text of one rendered turn, unescaped, and where its text lies in ``part``."""
    if not part.startswith(START) or not part.endswith(f"{END}\n"):
        raise ValueError("not one marked turn")
    line = part.index("\n")
    begin, end = line + 1, len(part) - len(END) - 1
    return unescape_role(part[len(START) : line]), unescape(part[begin:end]), begin, end


class Spans:
    """Feeds turns to a template and gives what each added, holding one window."""

    def __init__(self, template: Template):
        self.template = template
        self.turns: list[Turn] = []
        self.output = ""
        self.rewrites = False

    def add(self, turn: Turn) -> str | None:
        """What this turn added; None if the template rewrote what came before."""
        context = self.template.context
        if context is not None and len(self.turns) >= WINDOW + context:
            self.turns = self.turns[len(self.turns) - context :] if context else []
            self.output = self.template.render(self.turns) if self.turns else ""
        self.turns.append(turn)
        now = self.template.render(self.turns)
        before, self.output = self.output, now
        if not now.startswith(before):
            self.rewrites = True
            return None
        return now[len(before) :]


def format_conversations(turns: DataFrame, template: Template = MARKED) -> DataFrame:
    """Each turn's rendered part and span: a row a turn, of every conversation.

    Columns: ``conv_id, turn, part, start, end, text_start, text_end, loss, rewrites``
    (code points; ``loss`` marks assistant turns). Rows of one conversation are
    streamed in order of turn, then role and text; a null role or text is empty;
    null conversation ids are one conversation; a null turn comes first. After a
    rewrite, parts and spans are null. Other columns are not read.
    """

    def rows(batches):
        for _, added in walk(batches, template):
            yield from added

    return map_rows(
        ordered(turns),
        "conv_id long, turn long, part string, start long, end long, text_start long, text_end long, "
        "loss boolean, rewrites boolean",
        rows,
    )


def ordered(turns: DataFrame) -> DataFrame:
    """Turns with those of a conversation together and in order."""
    picked = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return picked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def walk(batches: Iterator[list], template: Template) -> Iterator[tuple[int | None, list[tuple]]]:
    """Conversation id and located turns, a turn at a time."""
    spans, current, at = None, None, 0
    for columns in batches:
        for conv, turn, role, text in zip(*columns):
            if spans is None or conv != current:
                spans, current, at = Spans(template), conv, 0
            part = spans.add((role, text))
            if part is None or spans.rewrites:
                yield conv, [(conv, turn, None, None, None, None, None, role == "assistant", True)]
                continue
            try:
                _, _, begin, end = read_turn(part)
                place = (at + begin, at + end)
            except ValueError:  # another template's own marks
                place = (None, None)
            yield conv, [(conv, turn, part, at, at + len(part), *place, role == "assistant", False)]
            at += len(part)


def digest_conversations(turns: DataFrame, template: Template = MARKED) -> DataFrame:
    """One row a conversation, read back from the formatted parts.

    Columns: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, rewrites``. Digests are taken turn by turn, so a
    conversation of any length needs the memory of one window.
    """

    def rows(batches):
        state, current = None, None
        for conv, located in walk(batches, template):
            if state is None or conv != current:
                if state is not None:
                    yield state.row(current)
                state, current = _Digest(), conv
            for row in located:
                state.add(row)
        if state is not None:
            yield state.row(current)

    return map_rows(
        ordered(turns),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, rewrites boolean",
        rows,
    )


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.rewrites = False

    def add(self, row: tuple) -> None:
        _, _, part, _, _, _, _, _, rewrites = row
        self.n += 1
        self.rewrites |= rewrites
        if part is None:
            return
        role, text, begin, end = read_turn(part)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.chars += len(part)
        if role == "assistant":
            self.loss_chars += len(text)
            self.loss.update(unescape(part[begin:end]).encode())

    def row(self, conv: int | None) -> tuple:
        return conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.rewrites
