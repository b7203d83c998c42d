"""Chat formatting from a declarative template.

A finite-state machine over the roles validates the turn order. A conversation
becomes a list of text segments, each with a loss flag; their concatenation is
the formatted text. Control strings inside a role or a text are escaped by one
more escape character after their first character, so a marker found in the
output is always a real one and ``read_back`` recovers the turns exactly.

Edge cases: a null text or role is the empty string; turns are ordered by turn
number (nulls first), ties by role and text; repeated rows stay as turns of
their own; rows of a null conversation form one conversation; extra columns are
ignored; an empty table gives no rows. One conversation is one output row, so
its turns meet in one task by definition.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """What a turn looks like, who is trained on, and which orders are valid."""

    opening: str = "<|im_start|>"
    between: str = "<|im_sep|>"
    closing: str = "<|im_end|>"
    escape: str = "\\"
    #: Further control strings that must not appear raw inside a text.
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state; a missing entry is an error.
    transitions: dict = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })
    accepting: tuple[str, ...] = ("user", "assistant")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.opening, self.between, self.closing, *self.reserved)

    def __post_init__(self) -> None:
        for c in self.controls:
            if len(c) < 2 or self.escape in c or len(self.escape) != 1:
                raise ValueError(f"control string {c!r} cannot be escaped")


DEFAULT = Template()


def _places(t: Template) -> list[tuple[str, str]]:
    """Per first character of the control strings: a lookbehind for it, and the
    pattern of what may follow (escape characters and the rest of a string)."""
    rests: dict[str, list[str]] = {}
    for c in t.controls:
        rests.setdefault(c[0], []).append(re.escape(c[1:]))
    esc = re.escape(t.escape)
    return [(f"(?<={re.escape(first)})", f"{esc}*(?:{'|'.join(rs)})") for first, rs in rests.items()]


def escape(text: Column, t: Template = DEFAULT) -> Column:
    """One more escape character after the first character of each control string."""
    pattern = "|".join(f"{behind}(?={follows})" for behind, follows in _places(t))
    return F.regexp_replace(text, pattern, "\\" + t.escape)


def unescape(text: Column, t: Template = DEFAULT) -> Column:
    """The inverse of ``escape``."""
    esc = re.escape(t.escape)
    pattern = "|".join(f"{behind}{esc}(?={follows})" for behind, follows in _places(t))
    return F.regexp_replace(text, pattern, "")


def order_state(roles: Column, t: Template = DEFAULT) -> Column:
    """Final state of the machine over an array of roles; ``error`` once it is stuck."""
    steps = [F.lit(x) for s, nexts in t.transitions.items() for r, n in nexts.items()
             for x in (f"{s}>{r}", n)]
    table = F.create_map(*steps)
    return F.aggregate(roles, F.lit("start"), lambda state, role: F.coalesce(
        F.element_at(table, F.concat(state, F.lit(">"), role)), F.lit("error")))


def format_conversations(rows: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """``conv_id, segments array<struct<text, loss>>, formatted, valid`` per conversation."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def seg(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    segments = F.flatten(F.transform("turns", lambda x: F.array(
        seg(F.concat(F.lit(t.opening), escape(x["role"], t), F.lit(t.between)), no),
        seg(escape(x["text"], t), x["role"].isin(*t.loss_roles)),
        seg(F.lit(t.closing), no),
    )))
    state = order_state(F.transform("turns", lambda x: x["role"]), t)
    made = convs.select("conv_id", segments.alias("segments"), state.isin(*t.accepting).alias("valid"))
    return made.select(
        "conv_id", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "valid",
    )


def read_back(formatted: Column, t: Template = DEFAULT) -> Column:
    """The turns of a formatted text: array<struct<role, text>>."""
    pattern = F.lit(f"(?s){re.escape(t.opening)}(.*?){re.escape(t.between)}(.*?){re.escape(t.closing)}")
    return F.zip_with(
        F.regexp_extract_all(formatted, pattern, F.lit(1)),
        F.regexp_extract_all(formatted, pattern, F.lit(2)),
        lambda r, x: F.struct(unescape(r, t).alias("role"), unescape(x, t).alias("text")),
    )


def loss_text(segments: Column, t: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped, nothing between the segments."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"], t)), "")
