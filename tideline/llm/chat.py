"""Chat formatting from a declarative template; DataFrame functions only.

A finite-state machine runs over the roles of a conversation, in turn order: every turn takes it to a state, which
emits three segments (mark, text, end mark) with their loss flags. The flag of a text is that of the state, by default
the role's, so a role may be learned in one place and not in another. The last state says whether the turns are
valid; from a turn the machine has no step for, it is lost, and the turns go by their roles. Control strings inside texts are escaped: they lose their first character to
`ESCAPE` and a letter, and `ESCAPE` itself is doubled by a letter of its own, so a formatted
conversation can be read back turn by turn. No control string has its first character
elsewhere in it, so none can arise where a text meets a mark.

One conversation becomes one row: the longest one must fit in a task, as it must in a sequence. Its rows
are shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "␛"


class Marks(NamedTuple):
    """What stands before and after a role's text, and whether the text is learned. `end` is a control string of the role alone."""

    begin: str
    end: str
    loss: bool = False


class Template(NamedTuple):
    roles: Mapping[str, Marks]
    #: Allowed steps (state, role, next state), the first state and the states a conversation may end in.
    steps: tuple[tuple[str, str, str], ...]
    first: str
    last: tuple[str, ...]
    #: States whose texts are learned or not other than their role says.
    loss_in: Mapping[str, bool] = {}
    #: Any other role: its name stands between `other` and `named`.
    other: str = "[TURN]"
    named: str = "[TEXT]"
    other_end: str = "[/TURN]"
    controls: tuple[str, ...] = ("[INST]", "[/INST]", "[SYS]", "[/SYS]", "</s>", "[TURN]", "[TEXT]", "[/TURN]")

    def check(self) -> Template:
        codes = {c[0]: chr(ord("a") + i) for i, c in enumerate(dict.fromkeys(x[0] for x in self.controls))}
        for control in self.controls:
            if any(first in control[1:] for first in codes):
                raise ValueError(f"{control!r} has the first character of a control string inside it")
        ends = [m.end.strip() for m in self.roles.values()]
        if len({*ends, self.other_end}) <= len(ends) or not {*ends, self.other_end, self.other, self.named} <= {*self.controls}:
            raise ValueError("each role needs an end mark of its own, and marks must be control strings")
        return self

    @property
    def codes(self) -> dict[str, str]:
        """The letter that stands for the first character of a control string."""
        return {first: chr(ord("a") + i) for i, first in enumerate(dict.fromkeys(c[0] for c in self.controls))}


INST = Template(
    roles={
        "system": Marks("[SYS] ", " [/SYS]"),
        "user": Marks("[INST] ", " [/INST]"),
        "assistant": Marks(" ", " </s>", loss=True),
    },
    steps=(
        ("start", "system", "system"),
        ("start", "user", "user"),
        ("system", "user", "user"),
        ("user", "assistant", "assistant"),
        ("assistant", "user", "user"),
    ),
    first="start",
    last=("user", "assistant"),
).check()


def escaped(text: Column, template: Template) -> Column:
    out = F.replace(text, F.lit(ESCAPE), F.lit(f"{ESCAPE}z"))
    for control in template.controls:
        out = F.replace(out, F.lit(control), F.lit(ESCAPE + template.codes[control[0]] + control[1:]))
    return out


def unescaped(text: Column, template: Template) -> Column:
    out = text
    for first, code in template.codes.items():
        out = F.replace(out, F.lit(ESCAPE + code), F.lit(first))
    return F.replace(out, F.lit(f"{ESCAPE}z"), F.lit(ESCAPE))


LOST = "~"


def states_of(roles: Column, template: Template) -> Column:
    """The state the machine is in after each role, as an array. States travel as one character each while it runs."""
    names = list(dict.fromkeys([template.first, *[x for state, _, after in template.steps for x in (state, after)]]))
    code = {name: chr(ord("A") + i) for i, name in enumerate(names)}
    steps = F.create_map(*[F.lit(x) for state, role, after in template.steps for x in (f"{code[state]}>{role}", code[after])])

    def step(path: Column, role: Column) -> Column:
        return F.concat(path, F.coalesce(F.try_element_at(steps, F.concat(F.right(path, F.lit(1)), F.lit(">"), role)), F.lit(LOST)))

    path = F.aggregate(roles, F.lit(code[template.first]), step)
    named = F.create_map(*[F.lit(x) for name, c in code.items() for x in (c, name)])
    codes = F.split(F.substring(path, 2, 2**31 - 1), "")
    return F.when(F.size(roles) == 0, F.array().cast("array<string>")).otherwise(F.transform(codes, lambda c: F.coalesce(F.try_element_at(named, c), F.lit(LOST))))


def segments_of(role: Column, text: Column, state: Column, template: Template) -> Column:
    """The three segments (text, loss) that a turn's state emits."""
    role_of = {after: role for _, role, after in template.steps}
    flags = {after: template.loss_in.get(after, template.roles[role].loss) for after, role in role_of.items()}
    learned_in = F.create_map(*[F.lit(x) for state, flag in flags.items() for x in (state, flag)])

    def segment(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    never, body = F.lit(False), escaped(text, template)
    head = F.concat(F.lit(template.other), escaped(role, template), F.lit(template.named))
    out = F.array(segment(head, never), segment(body, never), segment(F.lit(template.other_end), never))
    for name, marks in template.roles.items():
        loss = F.coalesce(F.try_element_at(learned_in, state), F.lit(marks.loss))
        known = F.array(segment(F.lit(marks.begin), never), segment(body, loss), segment(F.lit(marks.end), never))
        out = F.when(role == name, known).otherwise(out)
    return out


def format_conversations(turns: DataFrame, template: Template = INST) -> DataFrame:
    """(conv_id, valid, n_turns, segments, formatted): one row a conversation.

    Turns are ordered by turn, ties by role and text, null turns first. A null role is an empty
    name, a null text an empty text. Rows without a conv_id are one conversation. Repeated rows are turns like
    others. A conversation the machine refuses is formatted too, with valid = false.
    """
    blank = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")}
    rows = turns.select("conv_id", F.struct("turn", blank["role"].alias("role"), blank["text"].alias("text")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    whole = whole.withColumn("states", states_of(F.transform("turns", lambda t: t["role"]), template))
    segments = F.flatten(F.zip_with("turns", "states", lambda t, s: segments_of(t["role"], t["text"], s, template)))
    made = whole.select(
        "conv_id",
        F.element_at("states", -1).isin(*template.last).alias("valid"),
        F.size("turns").cast("bigint").alias("n_turns"),
        segments.alias("segments"),
    )
    return made.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column, template: Template = INST) -> Column:
    """The turns (role, text) in a formatted conversation."""

    def quoted(text: str) -> str:
        return rf"\Q{text}\E"

    ends = {marks.end.strip(): (name, marks) for name, marks in template.roles.items()}
    pattern = "(?s)(.*?)(" + "|".join(quoted(e) for e in [*ends, template.other_end]) + ")"
    turns = F.arrays_zip(
        F.regexp_extract_all(formatted, F.lit(pattern), F.lit(1)).alias("body"),
        F.regexp_extract_all(formatted, F.lit(pattern), F.lit(2)).alias("end"),
    )

    def turn(found: Column) -> Column:
        body, end = found["body"], found["end"]
        name = F.substring_index(F.substring(body, len(template.other) + 1, 2**31 - 1), template.named, 1)
        text = F.substring(body, F.char_length(name) + len(template.other + template.named) + 1, F.char_length(body))
        out = F.struct(unescaped(name, template).alias("role"), unescaped(text, template).alias("text"))
        for mark, (role, marks) in ends.items():
            # What the end mark has before its control string belongs to the mark, not the text.
            gap = len(marks.begin) + len(marks.end) - len(marks.end.lstrip())
            own = F.substring(body, len(marks.begin) + 1, F.char_length(body) - gap)
            out = F.when(end == mark, F.struct(F.lit(role).alias("role"), unescaped(own, template).alias("text"))).otherwise(out)
        return out

    return F.transform(turns, turn)


def learned(segments: Column, template: Template = INST) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), "")


def digests(formatted: DataFrame, template: Template = INST) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid, all read back from the output."""
    back = formatted.select("*", read_back(F.col("formatted"), template).alias("back"), learned(F.col("segments"), template).alias("loss_text"))
    text = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("back").cast("bigint").alias("n_turns"),
        F.sha2(text.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
    )
