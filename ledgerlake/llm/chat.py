"""Chat formatting of typed content parts (operator 4), in DataFrame functions only.

A turn is a role and an array of parts (kind, text, uri, width, height,
seconds, pages).  ``visit`` flattens one part: text is escaped; an image, an
audio or a document (any other kind counts as a document) becomes a numbered
placeholder, and is recorded as an attachment with its reference and the number of
tokens the placeholder stands for.  Placeholders are numbered in order over the
whole conversation.

Template: each turn is ``<|turn|>`` role ``\\n`` content ``<|end|>\\n``.  Inside
roles and texts ``~`` becomes ``~0`` and ``<`` becomes ``~1`` (in roles also the
line feed ``~2``), so no control string or placeholder can come from a text, and
undoing the replacements in reverse order gives the text back.

The loss mask is a list of spans (start, length in code points) over the
formatted string: the contents of assistant turns.

Nulls, ties and odd input: a null role, text or part list is empty; a null part
is an empty text; a null conv_id is one conversation.  Turns are ordered by turn
number (null first), then role, then parts, so repeated rows stay as repeated turns.
Sizes that are null or not positive count as 1 unit.  An empty table gives no
rows.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

START, END = "<|turn|>", "<|end|>\n"
ASSISTANT = "assistant"
PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"

#: What one placeholder stands for: tokens of an image patch of 28 x 28 points, of a second of audio, of a page.
PATCH, AUDIO_TOKENS, PAGE_TOKENS = 28, 25, 256


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("~"), F.lit("~0")), F.lit("<"), F.lit("~1"))
    return F.replace(out, F.lit("\n"), F.lit("~2")) if role else out


def unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("~2"), F.lit("\n")), F.lit("~1"), F.lit("<"))
    return F.replace(out, F.lit("~0"), F.lit("~"))


def text_part(text: Column) -> Column:
    """A part list that holds one text."""
    null = {"uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), *[F.lit(None).cast(t).alias(c) for c, t in null.items()]))


def _is_text(part: Column) -> Column:
    return part.isNull() | part["kind"].isNull() | (part["kind"] == "text")


def _units(value: Column, step: int = 1) -> Column:
    return F.greatest(F.ceil(F.coalesce(value.cast("double"), F.lit(1.0)) / step), F.lit(1))


def visit(part: Column, ordinal: Column) -> Column:
    """What a part gives: rendered text, and for an attachment its ordinal,
    placeholder, kind, reference and expanded tokens (null for a text)."""
    kind = F.when(part["kind"].isin("image", "audio"), part["kind"]).otherwise(F.lit("document"))
    tokens = (F.when(kind == "image", _units(part["width"], PATCH) * _units(part["height"], PATCH))
              .when(kind == "audio", F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(1.0)), F.lit(1 / AUDIO_TOKENS)) * AUDIO_TOKENS))
              .otherwise(_units(part["pages"]) * PAGE_TOKENS)).cast("long")
    placeholder = F.concat(F.lit("<|"), kind, F.lit("_"), ordinal.cast("string"), F.lit("|>"))
    attachment = F.struct(ordinal.cast("long").alias("ordinal"), placeholder.alias("placeholder"), kind.alias("kind"), part["uri"].alias("uri"), tokens.alias("tokens"))
    return F.struct(F.when(_is_text(part), escape(part["text"])).otherwise(placeholder).alias("text"), F.when(~_is_text(part), attachment).alias("attachment"))


def format_chat(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, mask (array of start, length), attachments (array of
    ordinal, placeholder, kind, uri, tokens) and attachment_tokens of each
    conversation of ``turns`` (conv_id, turn, role, parts)."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("parts", F.array().cast(f"array<{PART}>")).alias("parts"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "parts")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    attached = F.size(F.filter("parts", lambda p: ~_is_text(p)))
    rows = rows.withColumns({"place": F.row_number().over(order), "earlier": F.coalesce(F.sum(attached).over(before), F.lit(0))})

    def number(i: Column) -> Column:
        return F.col("earlier") + F.size(F.filter(F.slice("parts", F.lit(1), i), lambda p: ~_is_text(p)))

    rows = rows.withColumn("visited", F.transform("parts", lambda p, i: visit(p, number(i))))
    rows = rows.withColumns({"head": F.concat(F.lit(START), escape(F.col("role"), role=True), F.lit("\n")), "content": F.array_join(F.transform("visited", lambda v: v["text"]), "")})
    rows = rows.withColumn("rendered", F.concat("head", "content", F.lit(END)))
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("rendered")).over(before), F.lit(0)) + F.length("head"))
    span = F.when(F.col("role") == ASSISTANT, F.struct(F.col("start").cast("long").alias("start"), F.length("content").cast("long").alias("length")))
    found = F.filter(F.transform("visited", lambda v: v["attachment"]), lambda a: a.isNotNull())
    turn = F.struct("place", "rendered", span.alias("span"), found.alias("attachments"))
    out = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return out.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("mask"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    ).withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, read back: array of role and text
    (placeholders stay as they are)."""
    cut = F.split(formatted, r"<\|turn\|>")
    return F.transform(F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0))), lambda t: F.struct(
        unescape(F.substring_index(t, "\n", 1)).alias("role"),
        unescape(F.substr(t, F.locate("\n", t) + 1, F.length(t) - F.locate("\n", t) - len(END))).alias("text")))


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between the spans."""
    return unescape(F.array_join(F.transform(mask, lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))), ""))


def with_control_case(spark: SparkSession, conversations: DataFrame, text: str) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) and conversation -1: a user,
    then an assistant row, both saying ``text``."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    # two rows made by Spark itself: literals beside a range
    own = spark.range(2).select(F.lit(-1).cast(rows.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(text).alias("text"))
    return rows.unionByName(own)
