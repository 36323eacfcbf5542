"""Chat formatting by a finite-state machine and a declarative template.

A template names the control strings, the machine (which role may follow which
state, and where a conversation may end) and, per role, a list of segments:
literal strings, the role's name or the text, each with a loss flag. A
conversation becomes the list of its segments; their concatenation is the
formatted text, and the flags are its loss mask. DataFrame functions only.

Control strings inside texts are escaped reversibly: in ``<``, any number of
backslashes, ``|`` one more backslash is put in, so ``<|`` cannot occur, and
taking one backslash out of every such run that has one gives the text back. In
role names backslashes and line feeds are escaped first, as they end the name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLE, TEXT = object(), object()  # placeholders of a segment list


@dataclass(frozen=True)
class Template:
    """Segments are ``(literal or ROLE or TEXT, loss)``. ``turns`` maps a role
    to its list; other roles use ``other``. ``moves`` maps (state, role) to the
    next state; a pair that is not there is an error. Literals other than the
    line feed after the name must hold ``opens`` or ``closes``."""

    opens: str = "<|im_start|>"
    closes: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict = field(default_factory=lambda: {
        ("start", "system"): "briefed", ("start", "user"): "asked", ("briefed", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked"})
    ends: tuple[str, ...] = ("answered",)

    def segments(self, loss: bool) -> list[tuple[object, bool]]:
        return [(self.opens, False), (ROLE, False), ("\n", False), (TEXT, loss), (self.closes, False)]


CHATML = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    plain = F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))
    return escape(plain)


def unescape_role(role: Column) -> Column:
    plain = unescape(role)
    return F.replace(F.replace(plain, F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def run_machine(roles: Column, template: Template) -> Column:
    """``struct(state, at, bad)`` after the roles: the last state (empty from
    the first error on), their number, and the 0-based turn of the first error
    (-1 without one)."""
    def move(acc: Column, role: Column) -> Column:
        to = F.lit("")
        for (state, name), then in template.moves.items():
            to = F.when((acc["state"] == state) & (role == name), F.lit(then)).otherwise(to)
        first = (acc["bad"] < 0) & (to == "")
        return F.struct(to.alias("state"), (acc["at"] + 1).alias("at"),
                        F.when(first, acc["at"]).otherwise(acc["bad"]).alias("bad"))

    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("bad"))
    return F.aggregate(roles, begin, move)


def format_chat(turns: DataFrame, template: Template = CHATML, id_col: str = "conv_id", order_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(id, segments, formatted, valid, bad_turn)``, one row per conversation.

    ``segments`` is ``array<struct<text, loss>>`` and ``formatted`` their
    concatenation. ``valid`` says that the machine took every role and ended
    where it may; ``bad_turn`` is the 0-based position of the first role it did
    not take. Invalid conversations are formatted all the same.

    Turns are ordered by ``turn``, null first; turns of equal number by role,
    then text. A null text or role counts as empty; an unknown role is an error
    of the machine and is formatted without loss. Rows of a null id form one
    conversation, repeated rows are turns of their own, other columns are
    ignored, and an empty table gives no rows. A conversation is one row, so it
    has to fit into a value (2 GB) and a task's memory; conversations are dealt
    by id and no task holds more than one key's turns at a time.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    learned = role.isin(*template.learned)
    pieces = []
    for plain, loud in zip(template.segments(False), template.segments(True)):
        body = escape_role(role) if plain[0] is ROLE else escape(text) if plain[0] is TEXT else F.lit(plain[0])
        pieces.append(F.struct(body.alias("text"), F.when(learned, F.lit(loud[1])).otherwise(F.lit(plain[1])).alias("loss")))
    one = turns.select(F.col(id_col).alias("_id"), F.struct(
        F.col(order_col).alias("at"), role.alias("role"), text.alias("_text"), F.array(*pieces).alias("segments")).alias("turn"))
    whole = one.groupBy("_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    end = run_machine(F.transform("turns", lambda t: t["role"]), template)
    return (whole.select("_id", F.flatten(F.transform("turns", lambda t: t["segments"])).alias("segments"), end.alias("end"))
            .select(F.col("_id").alias(id_col), "segments",
                    F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                    F.col("end.state").isin(*template.ends).alias("valid"),
                    F.when(F.col("end.bad") >= 0, F.col("end.bad")).alias("bad_turn")))


def parse_chat(formatted: Column, template: Template = CHATML) -> Column:
    """Turns of a formatted text: ``array<struct<role, text>>``, unescaped."""
    def turn(piece: Column) -> Column:
        cut = F.instr(piece, F.lit("\n"))
        skip = len(template.opens)
        return F.struct(unescape_role(F.substring(piece, F.lit(skip + 1), cut - F.lit(skip + 1))).alias("role"),
                        unescape(F.substring(piece, cut + 1, F.length(piece))).alias("text"))

    pieces = F.split(formatted, r"\Q" + template.closes + r"\E", -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
