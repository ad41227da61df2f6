"""Chat formatting: turns of a conversation as one marked text with segments to learn from.

A :class:`Template` states, as plain values, the marks around the turns of each role, whose text
is learnt, and the moves of a finite-state machine over roles. The machine runs over the ordered
roles of a conversation; ``valid`` says that it never got stuck, ``end_state`` where it stopped.
Conversations out of order are formatted all the same and can be left out by ``valid``.

Texts cannot forge marks: inside a text the escape mark becomes ``\\b``, and every control string
gets ``\\e`` behind its first character. :func:`read_back` undoes both.

Rows are ordered by turn (null first), then role, then escaped text, so repeated turns have one
order. A null text counts as empty, a null role as the empty name, and rows with a null conv_id
form one conversation. Roles unknown to the template carry their name in the text; the machine
gets stuck at them. An empty table gives no rows; columns other than the four named are ignored.

Only functions of Spark's own are used. A conversation is put together in one row, as its
digest and its training text are one value each; it may be as long as one value can be (2 GB).
Escaping happens on the scan, before rows meet.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"
STUCK = "stuck"


@dataclass(frozen=True)
class Role:
    """The marks around a role's turns, and whether a model learns to write their text."""

    name: str
    before: str
    after: str
    learnt: bool = False


@dataclass(frozen=True)
class Template:
    """begin: what a formatted conversation starts with.
    roles: the known roles; their ``after`` marks tell them apart.
    other: marks before the name, between name and text, and after the text of any other role.
    moves: (state, role, next state) of the machine, which starts in ``start``.
    ends: states in which a conversation is complete.
    """

    begin: str
    roles: tuple[Role, ...]
    other: tuple[str, str, str]
    moves: tuple[tuple[str, str, str], ...]
    start: str
    ends: tuple[str, ...]

    @property
    def closers(self) -> list[str]:
        return [*[r.after.strip() for r in self.roles], self.other[2].strip()]

    @property
    def controls(self) -> list[str]:
        marks = [self.begin, *self.other, *[m for r in self.roles for m in (r.before, r.after)]]
        return list(dict.fromkeys(m.strip() for m in marks if m.strip()))

    def __post_init__(self) -> None:
        if len(set(self.closers)) < len(self.closers) or "" in self.closers:
            raise ValueError("every role needs a mark of its own after its turns")
        firsts = {c[0] for c in self.controls}
        for control in self.controls:
            # So no text can complete a mark that it stands next to, and escaping breaks each.
            if len(control) < 2 or firsts & set(control[1:]) or ESCAPE in control:
                raise ValueError(f"a control string must not resume inside another: {control}")
            if any(c != control and c.startswith(control) for c in self.controls):
                raise ValueError(f"one control string begins another: {control}")


INSTRUCT = Template(
    begin="<s>",
    roles=(
        Role("system", "[SYS] ", " [/SYS]"),
        Role("user", "[INST] ", " [/INST]"),
        Role("assistant", " ", "</s>", learnt=True),
    ),
    other=("[ROLE] ", "[TEXT] ", " [/ROLE]"),
    moves=(
        ("start", "system", "briefed"),
        ("start", "user", "asked"),
        ("briefed", "user", "asked"),
        ("asked", "assistant", "answered"),
        ("answered", "user", "asked"),
    ),
    start="start",
    ends=("answered",),
)


def escape(text: Column, template: Template = INSTRUCT) -> Column:
    """``text`` without any control string of the template."""
    broken = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template.controls)
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "b"))
    return F.regexp_replace(doubled, broken, r"$0\\e")


def unescape(text: Column) -> Column:
    bare = F.replace(text, F.lit(ESCAPE + "e"), F.lit(""))
    return F.replace(bare, F.lit(ESCAPE + "b"), F.lit(ESCAPE))


def _cases(template: Template, test, known, other: Column) -> Column:
    """``known(role)`` of the first role that ``test`` holds for, else ``other``."""
    found = None
    for role in template.roles:
        value = known(role)
        found = F.when(test(role), value) if found is None else found.when(test(role), value)
    return found.otherwise(other)


def _segments(turn: Column, template: Template) -> Column:
    """The three segments of a turn: mark, text, mark."""
    is_role = lambda role: turn["role"] == role.name
    name, between, after = template.other
    named = F.concat(F.lit(name), escape(turn["role"], template), F.lit(between))
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.array(
        part(_cases(template, is_role, lambda r: F.lit(r.before), named), F.lit(False)),
        part(turn["text"], _cases(template, is_role, lambda r: F.lit(r.learnt), F.lit(False))),
        part(_cases(template, is_role, lambda r: F.lit(r.after), F.lit(after)), F.lit(False)),
    )


def _end_state(roles: Column, template: Template) -> Column:
    """The state the machine is in after these roles."""
    pair = lambda state, role: F.concat(state, F.lit("\n"), role)
    moves = F.create_map(
        *[x for s, r, t in template.moves for x in (F.lit(f"{s}\n{r}"), F.lit(t))]
    )
    step = lambda state, role: F.coalesce(
        F.try_element_at(moves, pair(state, role)), F.lit(STUCK)
    )
    return F.aggregate(roles, F.lit(template.start), step)


def format_chats(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (text and whether it is learnt),
    ``formatted`` (the segments joined), ``valid``, ``complete`` and ``end_state``."""
    turns = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        escape(F.coalesce("text", F.lit("")), template).alias("text"),
    )
    chats = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss")))
    parts = F.flatten(F.transform("turns", lambda t: _segments(t, template)))
    state = _end_state(F.col("turns.role"), template)
    return chats.select(
        "conv_id", F.concat(begin, parts).alias("segments"), state.alias("end_state")
    ).select(
        "conv_id",
        "segments",
        F.array_join("segments.text", "").alias("formatted"),
        (F.col("end_state") != STUCK).alias("valid"),
        F.col("end_state").isin(*template.ends).alias("complete"),
        "end_state",
    )


def _turn_of(piece: Column, template: Template) -> Column:
    """Role and text of one formatted turn."""
    inside = lambda before, after: F.substring(
        piece, F.lit(len(before) + 1), F.char_length(piece) - len(before) - len(after)
    )
    name, between, after = template.other
    body = inside(name, after)
    role = F.substring_index(body, between.strip(), 1)
    start = F.char_length(role) + len(between) + 1
    turn = lambda role, text: F.struct(
        role.alias("role"), unescape(text).alias("text")
    )
    return _cases(
        template,
        lambda r: F.endswith(piece, F.lit(r.after)),
        lambda r: turn(F.lit(r.name), inside(r.before, r.after)),
        turn(unescape(role), F.substring(body, start, F.char_length(body))),
    )


def read_back(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (role and text) that a formatted conversation was made of."""
    closers = "|".join(re.escape(c) for c in template.closers)
    turns = F.substring(formatted, F.lit(len(template.begin) + 1), F.char_length(formatted))
    pieces = F.regexp_extract_all(turns, F.lit(f"(?s).*?(?:{closers})"), F.lit(0))
    return F.transform(pieces, lambda piece: _turn_of(piece, template))


def learnt_text(segments: Column) -> Column:
    """All text under the loss mask as it was before escaping."""
    learnt = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learnt, lambda s: unescape(s["text"])), "")
