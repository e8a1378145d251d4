"""Chat formatting from a declarative template, with a loss flag per segment.

A conversation is ordered by turn (ties by role, then text) and becomes one text. Every turn gives
three segments: its opening with the role, its text, its closing. Only texts of the roles in
``loss_roles`` carry loss. A finite-state machine over the roles tells whether the order is valid;
conversations out of order are formatted all the same and marked.

Control strings inside roles and texts are guarded by a backslash after their first character, and
backslashes are doubled, so the text can be read back exactly.

Null roles and texts count as empty, null turns come first, rows without conv_id form one
conversation, repeated rows are turns of their own. An empty table gives no rows. Extra columns are
ignored. A conversation is one training text and so one row, however many turns it has.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    opening: str = "<|turn|>"
    between: str = "<|text|>"
    closing: str = "<|end|>"
    # No text may hold these unguarded; they cover the three marks above.
    guarded: tuple[str, ...] = ("<|", "</s>", "<s>", "[INST]", "[/INST]")
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    final: tuple[str, ...] = ("assistant",)
    # From a state, the roles that may follow; a role is the state after its turn.
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )


CHAT = Template()


def guard(text: Column, template: Template = CHAT) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in template.guarded:
        text = F.replace(text, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return text


def unguard(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def state_after(turns: Column, template: Template = CHAT) -> Column:
    """The state the roles lead to, or ``invalid``."""
    moves = [F.lit(x) for state, roles in template.follows.items() for role in roles for x in (f"{state}>{role}", role)]
    table = F.create_map(*moves)
    step = lambda state, turn: F.coalesce(F.element_at(table, F.concat_ws(">", state, turn["role"])), F.lit("invalid"))
    return F.aggregate(turns, F.lit(template.start), step)


def format_conversations(messages: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, formatted, segments (text, loss) and whether the order of turns is valid."""
    empty = F.lit("")
    turns = messages.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce(F.col("role").cast("string"), empty).alias("role"),
            F.coalesce(F.col("text").cast("string"), empty).alias("text"),
        ).alias("message"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("message")).alias("turns"))

    def part(text: Column, loss: Column | bool) -> Column:
        return F.struct(text.alias("text"), (loss if isinstance(loss, Column) else F.lit(loss)).alias("loss"))

    def of_turn(turn: Column) -> Column:
        return F.array(
            part(F.concat(F.lit(template.opening), guard(turn["role"], template), F.lit(template.between)), False),
            part(guard(turn["text"], template), turn["role"].isin(*template.loss_roles)),
            part(F.lit(template.closing), False),
        )

    segments = F.flatten(F.transform("turns", of_turn))
    shaped = grouped.select("conv_id", segments.alias("segments"), state_after(F.col("turns"), template).alias("state"))
    return shaped.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        F.col("state").isin(*template.final).alias("valid"),
    )


def read_back(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, turns (role, text) parsed from the formatted text, and the text under the loss flags."""
    closing = "".join(f"\\{c}" if not c.isalnum() else c for c in template.closing)
    between = "".join(f"\\{c}" if not c.isalnum() else c for c in template.between)
    pieces = F.split("formatted", closing)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.split(F.substring(piece, F.lit(len(template.opening) + 1), F.length(piece)), between)
        return F.struct(unguard(body[0]).alias("role"), unguard(body[1]).alias("text"))

    under_loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unguard(s["text"]))
    return formatted.select(
        "conv_id",
        "formatted",
        "valid",
        F.transform(pieces, turn).alias("turns"),
        F.array_join(under_loss, "").alias("loss_text"),
    )
