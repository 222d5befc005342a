"""Chat formatting: a role machine checks the order of turns, a template marks them and flags what is trained on.

Input rows (conv_id, turn, role, text); other columns are ignored.  Turns are
ordered by turn, then role, then text, nulls first, so ties have one order; a
repeated row is a turn of its own.  A null role or text is empty.  A role that
the template doesn't name is formatted, breaks the order and isn't trained on.
An empty table gives no rows.  A conversation is one row of output and so has
to fit into a task, as its text has to be one string.

Everything is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks around a turn, roles that are trained on, and the role machine: state -> roles that may follow.

    A state is the role of the last turn; "" is the start.
    """

    open: str = "<|im_start|>"
    close: str = "<|im_end|>"
    control: str = "<|"
    trained: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    accepts: tuple[str, ...] = ("assistant",)


CHATML = Template()

# Escapes: no code letter is a backslash, so undoing them in reverse order is exact.
_SLASH, _CONTROL, _LINE = ("\\", "\\s"), "\\c", ("\n", "\\n")


def _replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def escape(c: Column, t: Template, one_line: bool = False) -> Column:
    c = _replace(_replace(c, *_SLASH), t.control, _CONTROL)
    return _replace(c, *_LINE) if one_line else c


def unescape(c: Column, t: Template, one_line: bool = False) -> Column:
    if one_line:
        c = _replace(c, _LINE[1], _LINE[0])
    return _replace(_replace(c, _CONTROL, t.control), _SLASH[1], _SLASH[0])


def _segments(turn: Column, t: Template) -> Column:
    def part(kind: str, text: Column, loss: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"), loss.alias("loss"))

    header = F.concat(F.lit(t.open), escape(turn["role"], t, one_line=True), F.lit("\n"))
    return F.array(
        part("header", header, F.lit(False)),
        part("body", escape(turn["text"], t), turn["role"].isin(*t.trained)),
        part("end", F.lit(t.close + "\n"), F.lit(False)),
    )


def _broken_at(turns: Column, t: Template) -> Column:
    """Position of the first turn that may not follow, counted from 1; 0 if none."""
    allowed = F.array(*[F.lit(f"{a}\n{b}") for a, roles in t.follows.items() for b in roles])
    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("n"), F.lit(0).alias("broken"))

    def step(acc: Column, turn: Column) -> Column:
        n = acc["n"] + 1
        fine = F.array_contains(allowed, F.concat(acc["state"], F.lit("\n"), turn["role"]))
        return F.struct(
            turn["role"].alias("state"),
            n.alias("n"),
            F.when((acc["broken"] == 0) & ~fine, n).otherwise(acc["broken"]).alias("broken"),
        )

    return F.aggregate(turns, start, step)


def format_chats(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row a conversation: conv_id, n_turns, valid, broken_at, segments (kind, text, loss) and formatted.

    ``broken_at`` is the first turn that may not follow the one before it (0: none); ``valid`` also asks
    that the conversation ends in an accepting state.  Invalid conversations are formatted like others.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    state = _broken_at(F.col("turns"), template)
    segments = F.flatten(F.transform("turns", lambda x: _segments(x, template)))
    return (
        chats.select("conv_id", F.size("turns").alias("n_turns"), state.alias("machine"), segments.alias("segments"))
        .select(
            "conv_id",
            "n_turns",
            ((F.col("machine.broken") == 0) & F.col("machine.state").isin(*template.accepts)).alias("valid"),
            F.col("machine.broken").alias("broken_at"),
            "segments",
        )
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    )


def read_back(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (role, text) of a formatted conversation."""

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        at = F.length(head) + 2
        body = F.substring(piece, at, F.length(piece) - at + 1 - F.lit(len(template.close) + 1))
        return F.struct(unescape(head, template, one_line=True).alias("role"), unescape(body, template).alias("text"))

    mark = "\\Q" + template.open + "\\E"
    return F.transform(F.slice(F.split(formatted, mark), 2, 1 << 30), turn)


def trained_text(segments: Column, template: Template = CHATML) -> Column:
    """The text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
