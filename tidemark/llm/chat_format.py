"""Chat formatting with a role state machine and a declarative template.

The template gives each role a prefix, a suffix and whether a model trains on
the role's text (the loss flag); the state machine is the set of allowed
(role, next role) steps. Everything is built-in column expressions.

Control strings inside texts are escaped so that the output can be read back:
a backslash is doubled, then a backslash is put behind the first character of
every control string. A control string in the output is therefore always the
template's own.

Defined results: turns are ordered by turn, then role, then text (nulls first);
a null text is empty and a null role is the empty role; a role that the template
lacks is written by the template's ``other`` form and never passes the state
machine; rows with a null conv_id form one conversation; repeated rows are
turns of their own; a conversation of any length, and any text, is one row of
output; other columns of the input, whatever their names, are not read; an empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Form:
    prefix: str
    suffix: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``other`` writes roles without a form: prefix, role, ``separator``, text, suffix."""

    forms: dict[str, Form] = field(
        default_factory=lambda: {
            "system": Form("<<SYS>>\n", "\n<</SYS>>\n\n"),
            "user": Form("[INST] ", " [/INST]"),
            "assistant": Form("<s>", "</s>", loss=True),
        }
    )
    other: Form = Form("[ROLE]", "[/ROLE]")
    separator: str = "[SEP]"
    #: Control strings; each begins with a character that stands in none but as its first.
    control: tuple[str, ...] = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[SEP]")
    #: Steps of the state machine; "" is the start.
    steps: frozenset[tuple[str, str]] = frozenset(
        {("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
    )


DEFAULT = Template()


def _escaped(c: str) -> str:
    return f"{c[0]}\\{c[1:]}"


def escape(text: Column, template: Template = DEFAULT) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(_escaped(c))), template.control, doubled)


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    plain = reduce(lambda t, c: F.replace(t, F.lit(_escaped(c)), F.lit(c)), template.control, text)
    return F.replace(plain, F.lit("\\\\"), F.lit("\\"))


def _by_role(role: Column, template: Template, known, other: Column) -> Column:
    out = other
    for name, form in template.forms.items():
        out = F.when(role == name, F.lit(known(form))).otherwise(out)
    return out


def format_conversations(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments, valid, first_bad.

    ``segments`` has, per turn in order, role, the start and length of the
    escaped text in ``formatted`` (code points from 0) and its loss flag.
    ``first_bad`` is the index of the first turn that the state machine refuses.
    """
    rows = turns.select(
        "conv_id",
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    role = F.col("role")
    lead = F.concat(F.lit(template.other.prefix), escape(role, template), F.lit(template.separator))
    rows = rows.select(
        "*",
        _by_role(role, template, lambda f: f.prefix, lead).alias("prefix"),
        _by_role(role, template, lambda f: f.suffix, F.lit(template.other.suffix)).alias("suffix"),
        _by_role(role, template, lambda f: f.loss, F.lit(template.other.loss)).alias("loss"),
        escape(F.col("text"), template).alias("body"),
    ).withColumn("piece", F.concat("prefix", "body", "suffix"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    step = F.struct(F.coalesce(F.lag("role").over(order), F.lit("")), F.col("role"))
    allowed = reduce(lambda a, b: a | b, [(step["col1"] == a) & (step["role"] == b) for a, b in sorted(template.steps)])
    # The empty role is no start: only the first turn may follow "".
    first = F.row_number().over(order) == 1
    rows = rows.select(
        "conv_id",
        F.row_number().over(order).alias("at"),
        "piece",
        F.struct(
            "role",
            (F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("piece") + F.length("prefix")).alias("start"),
            F.length("body").alias("length"),
            "loss",
        ).alias("segment"),
        (allowed & (first | (F.lag("role").over(order) != ""))).alias("ok"),
    )
    grouped = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "piece", "segment"))).alias("turns"),
        F.every("ok").alias("valid"),
        F.min(F.when(~F.col("ok"), F.col("at") - 1)).alias("first_bad"),
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("turns", lambda t: t["segment"]).alias("segments"),
        "valid",
        "first_bad",
    )


def _quoted(s: str) -> str:
    return "".join(f"\\{c}" if c in r"\[](){}.*+?^$|/<>" else c for c in s)


def read_back(formatted: Column, template: Template = DEFAULT) -> Column:
    """array<struct<role, text>> of a formatted conversation, texts unescaped."""
    heads = [_quoted(f.prefix) for f in template.forms.values()]
    heads.append(f"{_quoted(template.other.prefix)}.*?{_quoted(template.separator)}")
    tails = [_quoted(f.suffix) for f in (*template.forms.values(), template.other)]
    pattern = F.lit(f"(?s)({'|'.join(heads)})(.*?)({'|'.join(tails)})")
    named = len(template.other.prefix) + 1

    def turn(head: Column, text: Column) -> Column:
        role = F.substring(head, F.lit(named), F.length(head) - len(template.other.prefix) - len(template.separator))
        role = unescape(role, template)
        for name, form in template.forms.items():
            role = F.when(head == form.prefix, F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescape(text, template).alias("text"))

    return F.zip_with(F.regexp_extract_all(formatted, pattern, F.lit(1)), F.regexp_extract_all(formatted, pattern, F.lit(2)), turn)
