"""Chat formatting, in DataFrame functions only.

A declarative template marks every turn; control strings inside roles and texts are escaped
so that the output can be read back exactly. A finite-state machine over the roles says
whether the order of turns is valid; conversations with another order are formatted too and
flagged. Each conversation becomes a list of text segments with a loss flag each.

Turns are ordered by turn, then role and text, so that ties have one order; a null turn
comes first. A null role or text is an empty one, a null id is an id of its own. A repeated
row is a turn of its own. An empty table gives an empty result. The turns of one conversation
meet in one row, as its formatted text is one value; work on texts is done before that.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``open`` role ``head`` text ``close``, and what may follow what."""

    open: str = "<|im_start|>"
    head: str = "\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    start: str = "start"
    steps: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "briefed", ("start", "user"): "asked", ("briefed", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked",
    })
    final: tuple[str, ...] = ("answered",)


def escape(text: Column, template: Template = Template()) -> Column:
    """A backslash before every backslash, and after the first character of every control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in template.controls:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescape(text: Column) -> Column:
    """Every backslash gives way to the character after it."""
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\(.)", "$1")).otherwise(text)


def order_is_valid(roles: Column, template: Template = Template()) -> Column:
    """Whether the machine ends in a final state; a role without a step leads to a state that nothing leaves."""
    steps = [F.lit(x) for (state, role), after in template.steps.items() for x in (f"{state}\n{role}", after)]
    table = F.create_map(*steps)
    last = F.aggregate(
        roles, F.lit(template.start),
        lambda state, role: F.coalesce(F.try_element_at(table, F.concat(state, F.lit("\n"), role)), F.lit("refused")),
    )
    return last.isin(list(template.final))


def render(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, valid, segments (text, loss), formatted."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # A line break would end the role.
    safe_role = F.replace(escape(role, template), F.lit("\n"), F.lit("\\\n"))
    turn = F.struct(
        F.col("turn").alias("turn"), role.alias("role"), text.alias("text"),
        F.concat(F.lit(template.open), safe_role, F.lit(template.head)).alias("head"),
        escape(text, template).alias("body"), role.isin(list(template.loss_roles)).alias("loss"),
    )
    grouped = conversations.select("conv_id", turn.alias("turn")).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    segment = lambda value, loss: F.struct(value.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        segment(t["head"], F.lit(False)), segment(t["body"], t["loss"]), segment(F.lit(template.close), F.lit(False)),
    )))
    roles = F.transform("turns", lambda t: t["role"])
    shown = grouped.select("conv_id", order_is_valid(roles, template).alias("valid"), segments.alias("segments"))
    return shown.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(rendered: DataFrame, template: Template = Template(), keep: tuple[str, ...] = ()) -> DataFrame:
    """conv_id, turns (role, text) parsed from the formatted text, the text under the loss mask, and what else to keep."""
    quote = lambda s: r"\Q" + s + r"\E"
    pattern = rf"(?s){quote(template.open)}((?:[^\\\n]|\\.)*+){quote(template.head)}(.*?){quote(template.close)}"
    parts = lambda group: F.regexp_extract_all("formatted", F.lit(pattern), F.lit(group))
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    turns = F.zip_with(parts(1), parts(2), lambda r, t: F.struct(unescape(r).alias("role"), unescape(t).alias("text")))
    return rendered.select("conv_id", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"), *keep)
