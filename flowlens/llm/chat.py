"""Chat formatting: a state machine over roles, a declarative template, text segments with loss flags.

Native: DataFrame functions only.  One grouping by conversation, everything else is computed inside the row.

A template says, per role, which marker opens a turn and which closes it, and which roles are trained on.
Control strings inside a text (or an unlisted role's name) are broken by a backslash after their first
character; backslashes are doubled.  ``unescape`` undoes both, so a formatted conversation can be read back.

Edge cases: null text or role counts as empty; turns are ordered by (turn, role, text), null turns first, so
repeated turn numbers have a defined order and repeated rows are kept; an empty table gives an empty result;
other columns are ignored; a null ``conv_id`` is a conversation of its own.  A conversation is one value,
like one text: it must fit into a task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, REJECTED = "start", "rejected"


@dataclass(frozen=True)
class Template:
    """Markers per role, the roles under the loss mask, and the allowed role order.

    ``follows[state]`` lists the roles that may come next; the state is the last role.
    """

    open: dict[str, str] = field(default_factory=lambda: {
        "system": "<s>[SYS]", "user": "<s>[INST]", "assistant": "<s>[/INST]"})
    close: str = "</s>"
    other_open: tuple[str, str] = ("<s>[ROLE]", "[/ROLE]")
    trained: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    accepting: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> list[str]:
        """Every string that must not occur inside a text."""
        found = {self.close}
        for marker in [*self.open.values(), *self.other_open]:
            found.update(re.findall(r"<[^<>\[\]]*>|\[[^<>\[\]]*\]", marker))
        return sorted(found)


def escape(text: Column, template: Template) -> Column:
    """``text`` without any control string, reversibly."""
    groups = "|".join(f"({re.escape(c[0])})({re.escape(c[1:])})" for c in template.controls)
    n = len(template.controls)
    firsts = "".join(f"${2 * i + 1}" for i in range(n))
    rests = "".join(f"${2 * i + 2}" for i in range(n))
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, F.lit(groups), F.lit(firsts + "\\\\" + rests))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def _opener(role: Column, template: Template) -> Column:
    head, tail = template.other_open
    marker = F.concat(F.lit(head), escape(role, template), F.lit(tail))
    for name, text in template.open.items():
        marker = F.when(role == name, F.lit(text)).otherwise(marker)
    return marker


def _run_machine(turns: Column, template: Template) -> Column:
    """struct(state, at, bad_turn): where the machine stands after all turns, and the first turn it refuses."""
    moves = F.create_map(*[F.lit(x) for state, roles in template.follows.items()
                           for role in roles for x in (f"{state}\n{role}", role)])

    def step(now: Column, turn: Column) -> Column:
        allowed = F.try_element_at(moves, F.concat(now.state, F.lit("\n"), turn.role))
        return F.struct(
            F.coalesce(allowed, F.lit(REJECTED)).alias("state"), (now.at + 1).alias("at"),
            F.when(now.bad_turn.isNull() & allowed.isNull(), now.at).otherwise(now.bad_turn).alias("bad_turn"))

    begin = F.struct(F.lit(START).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad_turn"))
    return F.aggregate(turns, begin, step)


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, valid, bad_turn, segments (text, loss), formatted."""
    ordered = turns.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(_opener(t.role, template).alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(t.text, template).alias("text"), t.role.isin(*template.trained).alias("loss")),
        F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")))))
    return (
        ordered.withColumn("_end", _run_machine(F.col("turns"), template)).withColumn("segments", segments)
        .select(
            "conv_id",
            (F.col("_end.bad_turn").isNull() & F.col("_end.state").isin(*template.accepting)).alias("valid"),
            F.col("_end.bad_turn").alias("bad_turn"), "segments",
            F.array_join(F.transform("segments", lambda s: s.text), "").alias("formatted")))


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """array(struct(role, text)) recovered from a formatted conversation."""
    head, tail = template.other_open
    pieces = F.split(formatted, re.escape(template.close), -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def parse(piece: Column) -> Column:
        named = F.substring_index(piece, tail, 1)
        role = unescape(F.substr(named, F.lit(len(head) + 1)))
        text = F.substr(piece, F.length(named) + len(tail) + 1)
        for name, marker in template.open.items():
            known = F.startswith(piece, F.lit(marker))
            role = F.when(known, F.lit(name)).otherwise(role)
            text = F.when(known, F.substr(piece, F.lit(len(marker) + 1))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, parse)


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s.loss), lambda s: unescape(s.text)), "")
