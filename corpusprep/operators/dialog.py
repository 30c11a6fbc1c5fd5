"""Dialog building for supervised fine-tuning, as row-local array expressions.

A conversation is one row (an array of ``{from, value}`` messages); validation,
pairing and prompt rendering are higher-order functions on that array, so the
whole step is a projection: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_, let, py_strip
from ..sources.readers import CONVERSATION_TYPE
from .templates import DEFAULT_TEMPLATE, Template, get_template

ROLES = ("human", "assistant")


def instruction_to_conversation(instruction: str | Column = "instruction", input_: str | Column = "input",
                                output: str | Column = "output") -> Column:
    """human = strip(instruction + "\\n\\n" + input), assistant = strip(output).

    A null ``input`` counts as empty (the surveyed code would print "None").
    """
    human = py_strip(F.concat(F.coalesce(col_(instruction), F.lit("")), F.lit("\n\n"),
                              F.coalesce(col_(input_), F.lit(""))))
    return F.array(F.struct(F.lit("human").alias("from"), human.alias("value")),
                   F.struct(F.lit("assistant").alias("from"), py_strip(col_(output)).alias("value")))


def parse_conversation_json(c: str | Column) -> Column:
    """JSON text -> array<struct<from, value>>; malformed text gives null."""
    return F.from_json(col_(c), CONVERSATION_TYPE, {"mode": "PERMISSIVE"})


def conversations_column(df: DataFrame, col: str = "conversations") -> Column:
    """The conversation array, parsing it first when the column holds JSON text."""
    if dict(df.dtypes)[col] == "string":
        return parse_conversation_json(col)
    return F.col(col)


def normalize_dialog(conversations: str | Column) -> Column:
    """Validated (query, response) pairs, or null when the conversation is dropped.

    (a) fewer than 2 messages: drop; (b) the first message is removed when it is
    not from ``human``; (c) fewer than 2 left: drop; (d) reading stops at the
    first unknown role; (e) position j is kept only if its role is
    ``roles[j % 2]``; (f) fewer than 2 kept, or an odd number: drop.
    Output: array<struct<turn:int, query:string, response:string>>.
    """

    def after_first(m):
        first_ok = F.element_at(m, 1)["from"] == F.lit(ROLES[0])
        return F.when(F.coalesce(first_ok, F.lit(False)), m).otherwise(F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0))))

    def known_prefix(m):
        known = F.transform(m, lambda x: F.coalesce(x["from"].isin(*ROLES), F.lit(False)))
        stop = F.array_position(known, F.lit(False))
        return F.when(stop > 0, F.slice(m, 1, (stop - 1).cast("int"))).otherwise(m)

    def kept_values(m):
        kept = F.filter(m, lambda x, j: x["from"] == F.when(j % 2 == 0, F.lit(ROLES[0])).otherwise(F.lit(ROLES[1])))
        return F.transform(kept, lambda x: x["value"])

    def pairs(v):
        n = F.size(v)
        return F.when((n < 2) | (n % 2 != 0), F.lit(None)).otherwise(
            F.transform(F.sequence(F.lit(0), (n / 2 - 1).cast("int")),
                        lambda k: F.struct(k.cast("int").alias("turn"),
                                           F.element_at(v, (2 * k + 1).cast("int")).alias("query"),
                                           F.element_at(v, (2 * k + 2).cast("int")).alias("response"))))

    def body(m):
        trimmed = let(after_first(m), lambda t: F.when(F.size(t) < 2, F.lit(None)).otherwise(
            let(kept_values(known_prefix(t)), pairs)))
        return F.when(F.coalesce(F.size(m), F.lit(0)) < 2, F.lit(None)).otherwise(trimmed)

    return let(col_(conversations), body)


def render_dialog(pairs: str | Column, template: str | Template = DEFAULT_TEMPLATE,
                  system_prompt: str | None = None) -> Column:
    """array<struct<turn, source, target>>: the template applied to every (query, response).

    First source: system prompt + sep (when the system prompt is non-empty) +
    prompt; later sources: sep + prompt; targets verbatim. The prompt is cut at
    ``{query}`` and concatenated, so ``%`` or braces in the text are inert.
    """
    t = get_template(template) if isinstance(template, str) else template
    sp = system_prompt or t.system_prompt
    first_prefix = (sp + t.sep) if sp else ""
    before, after = t.prompt_parts
    return F.transform(col_(pairs), lambda p, i: F.struct(
        p["turn"].alias("turn"),
        F.concat(F.when(i == 0, F.lit(first_prefix)).otherwise(F.lit(t.sep)), F.lit(before),
                 p["query"], F.lit(after)).alias("source"),
        p["response"].alias("target")))


def render_prompt(rendered: str | Column) -> Column:
    """All rendered pieces of a dialog joined into one string."""
    return F.array_join(F.flatten(F.transform(col_(rendered), lambda x: F.array(x["source"], x["target"]))), "")


def append_message(pairs: str | Column, query: str | Column, response: str | Column) -> Column:
    """Add one (query, response) at the end of a validated dialog."""
    p = col_(pairs)
    return F.array_append(p, F.struct(F.size(p).cast("int").alias("turn"), col_(query).alias("query"),
                                      col_(response).alias("response")))


def build_dialogs(df: DataFrame, conv_col: str = "conversations", template: str | Template = DEFAULT_TEMPLATE,
                  system_prompt: str | None = None) -> DataFrame:
    """Records -> rendered dialogs (rows whose conversation is dropped disappear).

    Instruction records (``instruction``/``input``/``output``) are converted first.
    """
    if "input" in df.columns and "output" in df.columns:
        conv = instruction_to_conversation()
    else:
        conv = conversations_column(df, conv_col)
    out = df.withColumn("_pairs", normalize_dialog(conv)).where(F.col("_pairs").isNotNull())
    return out.withColumn("dialog", render_dialog("_pairs", template, system_prompt)).drop("_pairs")
