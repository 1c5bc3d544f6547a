"""Chat formatting: role order checked by a state machine, text segments with loss flags (DataFrame functions only).

A template is data: how a turn is opened and closed, which roles bear loss, and
the transitions of the role automaton. Control characters inside roles and texts
are escaped reversibly (an escape character followed by one letter), so an
unescaped marker can only come from the template and the formatted text can be
cut back into turns by a plain pattern.

Edge cases: null text and null role count as empty; a null turn number sorts
first; turns with equal numbers are ordered by role, then text; repeated rows are
turns of their own; a null conv_id is one conversation; an empty table gives an
empty result. A conversation is one output row, so its turns are brought together;
everything else (escaping, segments) is done row by row before that.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, ERROR = "start", "error"


@dataclass(frozen=True)
class Template:
    """Declarative chat template.

    ``escapes`` maps each control character to the letter that follows the
    escape character in its place; the markers must be made of control
    characters and fixed text, and ``role_end`` must start with one of them.
    """

    open: str = "### "
    role_end: str = ": "
    close: str = "</turn>\n"
    labels: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss_roles: tuple = ("assistant",)
    escape: str = "\\"
    escapes: dict = field(default_factory=lambda: {"\\": "b", "#": "h", "<": "l", ":": "c"})
    transitions: dict = field(default_factory=lambda: {
        (START, "system"): "system",
        (START, "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    })
    final: tuple = ("assistant",)


def escaped(text: Column, template: Template, keep: str = "") -> Column:
    """Escape control characters (but those in ``keep``); the escape character itself goes first."""
    for char, letter in template.escapes.items():
        if char not in keep:
            text = F.replace(text, F.lit(char), F.lit(template.escape + letter))
    return text


def unescaped(text: Column, template: Template) -> Column:
    """Inverse of :func:`escaped`; the escape character itself goes last."""
    for char, letter in reversed(template.escapes.items()):
        text = F.replace(text, F.lit(template.escape + letter), F.lit(char))
    return text


def _label(role: Column, template: Template) -> Column:
    """What the header shows: the declared label, else the role itself behind an escape character (its escape
    letter ``r`` tells it from a label)."""
    shown = F.concat(F.lit(template.escape + "r"), escaped(role, template))
    for name, label in template.labels.items():
        shown = F.when(role == name, F.lit(label)).otherwise(shown)
    return shown


def _role(label: Column, template: Template) -> Column:
    mark = template.escape + "r"
    role = F.when(F.startswith(label, F.lit(mark)), unescaped(F.substring(label, F.lit(len(mark) + 1), F.length(label)), template))
    for name, shown in template.labels.items():
        role = F.when(label == shown, F.lit(name)).otherwise(role)
    return role


def run_roles(roles: Column, template: Template) -> Column:
    """Run the automaton over an array of roles: struct<state (the last one; ``error`` is absorbing), bad (0-based first turn that
    is not accepted, or null)>. Only these two are carried from turn to turn."""
    sep = "\x1f"
    table = F.create_map(*[F.lit(x) for (state, role), to in template.transitions.items() for x in (state + sep + role, to)])
    start = F.struct(F.lit(START).alias("state"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("bad"))

    def step(acc: Column, role: Column) -> Column:
        state = F.coalesce(F.try_element_at(table, F.concat(acc["state"], F.lit(sep), role)), F.lit(ERROR))
        bad = F.coalesce(acc["bad"], F.when(state == ERROR, acc["n"]))
        return F.struct(state.alias("state"), (acc["n"] + 1).alias("n"), bad.alias("bad"))

    return F.aggregate(roles, start, step, lambda acc: F.struct(acc["state"].alias("state"), acc["bad"].alias("bad")))


def format_chats(turns: DataFrame, template: Template | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``segments`` array<struct<text, loss, kind>>, ``formatted`` (their
    concatenation), ``valid`` (the role order is accepted), ``error_turn`` (0-based first turn that is not,
    or the number of turns when the last state is not final)."""
    t = template or Template()
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    # a text keeps ':' as it is: after the header it cannot be taken for the end of a role
    rows = turns.select(F.col(conv_col), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("_t"))
    chats = rows.groupBy(conv_col).agg(F.sort_array(F.collect_list("_t")).alias("_turns"))
    segment = lambda s, loss, kind: F.struct(s.alias("text"), loss.alias("loss"), F.lit(kind).alias("kind"))
    of_turn = lambda x: F.array(
        segment(F.concat(F.lit(t.open), _label(x["role"], t), F.lit(t.role_end)), F.lit(False), "open"),
        segment(escaped(x["text"], t, keep=":"), x["role"].isin(*t.loss_roles), "text"),
        segment(F.lit(t.close), F.lit(False), "close"))
    chats = chats.withColumn("segments", F.flatten(F.transform("_turns", of_turn)))
    chats = chats.withColumn("_run", run_roles(F.transform("_turns", lambda x: x["role"]), t))
    ends = F.col("_run.state").isin(*t.final)
    chats = chats.withColumn("error_turn", F.when(F.col("_run.bad").isNotNull(), F.col("_run.bad")).when(~ends, F.size("_turns").cast("long")))
    return chats.select(conv_col, "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                        F.col("error_turn").isNull().alias("valid"), "error_turn")


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """Cut a formatted text back into array<struct<role, text, loss>>: only the template's markers are looked at."""
    t = template or Template()
    stop = t.role_end[0]
    pattern = (f"{_quoted(t.open)}([^{_quoted(stop)}]*){_quoted(t.role_end)}([^{_quoted(t.close[0])}]*){_quoted(t.close)}")
    whole = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0))
    label = lambda s: F.regexp_extract(s, pattern, 1)
    body = lambda s: F.regexp_extract(s, pattern, 2)
    parts = F.transform(whole, lambda s: F.struct(_role(label(s), t).alias("role"), unescaped(body(s), t).alias("text")))
    return F.transform(parts, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"),
                                                 x["role"].isin(*t.loss_roles).alias("loss")))


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in " \n" else "\\" + c for c in text)
