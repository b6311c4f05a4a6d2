"""Chat formatting: a finite-state machine checks the order of roles, and a declarative template turns each
conversation into text segments, each with a flag that says whether it counts for the training loss.

Control strings of the template all begin with ``<|``. Inside texts every ``<``, backslashes, ``|`` run gets
one backslash more, so no control string can occur there, and taking one away again gives the text back.
Roles lie between control strings on one line, so ``%``, ``<`` and line feeds in them are percent-encoded.

DataFrame functions only: one grouping by conversation, then array functions of the conversation's own row,
all linear in its length. A conversation is one value of the result, so it is the unit of a task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Segments of a turn in order: a literal control string, or ``ROLE`` or ``TEXT``; the roles whose text
    is learned; and the machine that says which role may come next (``""``: the start) and last."""

    parts: tuple[str, ...] = ("<|im_start|>", "ROLE", "\n", "TEXT", "<|im_end|>\n")
    learned: tuple[str, ...] = ("assistant",)
    steps: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    last: tuple[str, ...] = ("assistant",)

    @property
    def begin(self) -> str:
        return self.parts[0]

    @property
    def end(self) -> str:
        return self.parts[-1]


CHAT = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def quoted(text: str) -> str:
    """``text`` as a literal of a regular expression."""
    return r"\Q" + text + r"\E"


def turn_segments(turn: Column, template: Template) -> Column:
    """The segments of one turn, a struct with ``role`` and ``text``."""
    none = F.lit(False)
    made = {"ROLE": (escape_role(turn["role"]), none), "TEXT": (escape(turn["text"]), turn["role"].isin(list(template.learned)))}
    return F.array(*[F.struct(text.alias("text"), loss.alias("loss")) for text, loss in (made.get(p, (F.lit(p), none)) for p in template.parts)])


def final_state(turns: Column, template: Template) -> Column:
    """The machine's state after all turns: the last role, or null once a role came that may not follow."""
    steps = [f"{a}>{b}" for a, bs in template.steps.items() for b in bs]
    return F.aggregate(turns, F.lit(""), lambda state, t: F.when(F.concat(state, F.lit(">"), t["role"]).isin(steps), t["role"]))


def format_conversations(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` -> one row per conversation: ``conv_id``, ``segments``
    (array of ``text``, ``loss``) and ``valid``.

    Turns come in order of (turn, role, text); null turns first; rows that repeat a turn are turns of their
    own. A null role or text is empty. Conversations of null ``conv_id`` are one conversation. An order of
    roles that the machine refuses, or that ends too early, makes ``valid`` false; the conversation is
    formatted all the same. Other columns are ignored; an empty table has no conversations."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return convs.select(
        "conv_id",
        F.flatten(F.transform("turns", lambda t: turn_segments(t, template))).alias("segments"),
        F.coalesce(final_state(F.col("turns"), template).isin(list(template.last)), F.lit(False)).alias("valid"))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(text: Column, template: Template = CHAT) -> Column:
    """Formatted text -> array of ``role``, ``text``: cut at the mark of a turn's begin, which no text holds."""
    pieces = F.split(text, quoted(template.begin), -1)
    pattern = rf"(?s)^([^\n]*)\n(.*){quoted(template.end)}$"
    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: F.struct(
        unescape_role(F.regexp_extract(p, pattern, 1)).alias("role"), unescape(F.regexp_extract(p, pattern, 2)).alias("text")))


def read_loss(segments: Column) -> Column:
    """The text under the loss mask, unescaped segment by segment."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def read_back(convs: DataFrame, template: Template = CHAT) -> DataFrame:
    """Digests of each conversation, read back from its segments alone."""
    convs = convs.withColumn("__formatted", formatted(F.col("segments"))).withColumn("__loss", read_loss(F.col("segments")))
    convs = convs.withColumn("__turns", read_turns(F.col("__formatted"), template))
    spoken = F.array_join(F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return convs.select("conv_id", F.size("__turns").cast("long").alias("n_turns"), F.sha2(spoken.cast("binary"), 256).alias("turns_sha256"),
                        F.length("__loss").cast("long").alias("loss_chars"), F.sha2(F.col("__loss").cast("binary"), 256).alias("loss_sha256"),
                        F.length("__formatted").cast("long").alias("formatted_chars"), "valid")
