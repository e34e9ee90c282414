"""Chat formatting with a grammar round trip.

Grammar of the output (one string per conversation)::

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>\\n"

A turn is first rendered as it stands and reparsed.  If the parser gives back
exactly that one turn it stays as it is: ``<|endoftext|>`` or a role ``a%b`` are
no conflict.  Else role and text are escaped: ``<``, any number of backslashes
and ``|`` get one backslash more, and reading takes one away; in a role ``%``
and line feeds are written ``%25`` and ``%0A``, because the first line feed
ends it.  Escaped content holds neither mark and reads back identical, so one
step is enough; ``round_trip`` tells whether the whole conversation does, and
the query makes a false value an error.

Everything is DataFrame functions.  Defined results: null role or text counts
as empty; a null turn sorts first; equal turn numbers sort by role, then text;
repeated rows are turns of their own; rows with a null conversation id form
one conversation; an empty table gives no rows; columns other than the four
named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlake.llm.common import text_or_empty

START, END = "<|im_start|>", "<|im_end|>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def _role_out(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(c: Column) -> Column:
    return F.replace(F.replace(unescape(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _turn(part: Column) -> Column:
    head = F.substring_index(part, "\n", 1)
    rest = F.substring(part, F.length(head) + 2, F.length(part))
    return F.struct(
        _role_in(head).alias("role"),
        unescape(F.substring_index(rest, END, 1)).alias("text"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, ``array<struct<role, text>>``."""
    parts = F.split(formatted, r"<\|im_start\|>", -1)
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), _turn)


def format_chat(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``loss_spans``, ``round_trip``.

    ``loss_spans`` lists (start, length) in code points of ``formatted``, one
    span per turn whose role is in ``trained``, covering its text only.
    Escaping happens before the one shuffle (by conversation); a conversation
    becomes one value, so it is gathered in one task by nature.
    """
    rows = conversations.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        text_or_empty(role).alias("role"),
        text_or_empty(text).alias("text"),
    )

    def rendered(r: Column, t: Column) -> Column:
        return F.concat(F.lit(START), r, F.lit("\n"), t, F.lit(END + "\n"))

    source = F.struct(F.col("role").alias("role"), F.col("text").alias("text"))
    reads_back = parse(rendered(F.col("role"), F.col("text"))) == F.array(source)
    rows = rows.withColumn("plain", reads_back)
    rows = rows.select(
        "conv",
        "turn",
        "role",
        "text",
        F.when(F.col("plain"), F.col("role")).otherwise(_role_out(F.col("role"))).alias("role_out"),
        F.when(F.col("plain"), F.col("text")).otherwise(escape(F.col("text"))).alias("text_out"),
    )
    in_order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    head = F.length("role_out") + len(START) + 1
    whole = head + F.length("text_out") + len(END) + 1
    rows = rows.select(
        "conv",
        F.struct(
            F.row_number().over(in_order).alias("at"),
            rendered(F.col("role_out"), F.col("text_out")).alias("piece"),
            F.col("role").isin(*trained).alias("trained"),
            (F.coalesce(F.sum(whole).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + head).alias("start"),
            F.length("text_out").cast("long").alias("length"),
            source.alias("source"),
        ).alias("turn"),
    )
    grouped = rows.groupBy("conv").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda x: x["piece"]), "")
    spans = F.transform(
        F.filter("turns", lambda x: x["trained"]),
        lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")),
    )
    out = grouped.select("conv", formatted.alias("formatted"), spans.alias("loss_spans"), "turns")
    return out.select(
        F.col("conv").alias(conv),
        "formatted",
        "loss_spans",
        (parse(F.col("formatted")) == F.transform("turns", lambda x: x["source"])).alias("round_trip"),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, spans joined with nothing between."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ),
        "",
    )
