"""Chat formatting with typed content parts.

Every part of a turn is visited in order: text becomes escaped text, an image, audio clip or document becomes a
numbered placeholder. The placeholders' numbers, token counts and places are recorded beside the text, so a loader can
put the attachments' tokens where the placeholders stand. DataFrame functions only.

Layout of a turn: ``<|turn|>`` role ``<|text|>`` content ``<|end|>``. The role and runs of text parts are escaped: a backslash
is doubled, and one is put after the first character of every control string, so no text can end a turn or start a
placeholder and unescaping gives back every character.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"
#: Beginnings of control strings: this template's own, and those of other templates in common use.
CONTROLS = ("<|", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>")

#: Turns of this role are under the loss mask.
LEARNED = "assistant"
TEXT, IMAGE, AUDIO, DOCUMENT = "text", "image", "audio", "document"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


@dataclass(frozen=True)
class Expansion:
    """How many tokens a placeholder stands for."""

    patch: int = 14
    audio_tokens_per_second: int = 25
    tokens_per_page: int = 256

    def tokens(self, part: Column) -> Column:
        """At least one; sizes that are null count as zero."""
        side = lambda name: F.ceil(F.coalesce(part[name], F.lit(0)) / self.patch)
        seconds, pages = F.coalesce(part["seconds"], F.lit(0.0)), F.coalesce(part["pages"], F.lit(0))
        count = (
            F.when(part["kind"] == IMAGE, side("width") * side("height"))
            .when(part["kind"] == AUDIO, F.ceil(seconds * self.audio_tokens_per_second))
            .otherwise(pages * self.tokens_per_page)
        )
        return F.greatest(count, F.lit(1)).cast("bigint")


def escape(text: Column) -> Column:
    """``text`` without a control string in it; null counts as empty. ``unescape`` reverses it."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A turn's content that is one text."""
    rest = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    nulls = [F.lit(None).cast(kind).alias(name) for name, kind in rest.items()]
    return F.array(F.struct(F.lit(TEXT).alias("kind"), text.alias("text"), *nulls)).cast(f"array<{PART}>")


def format_chats(turns: DataFrame, expansion: Expansion | None = None) -> DataFrame:
    """One row per conversation of ``turns(conv_id, turn, role, parts)``, where ``parts`` is ``array<PART>``.

    Result: ``conv_id``, ``formatted``, ``loss_spans`` (start and length in code points of every assistant content, in
    order), ``attachments`` (number, kind, ref, tokens, place of the placeholder in code points), ``n_turns``,
    ``expanded_tokens`` (sum over the attachments).

    Turns are taken in order of ``turn``; nulls first, and of equal ones by role and content. Repeated rows are turns of
    their own. A null conv_id is one conversation. A null role is empty, null parts are no content, a null text is
    empty, a null ref is kept. A part of unknown kind, or none, is a document. Other columns are ignored.

    One shuffle, by conversation. A conversation is one string, so its turns meet in one task, as they must; no
    other group does.
    """
    expansion = expansion or Expansion()
    other = lambda part: ~part["kind"].eqNullSafe(TEXT)
    kind = lambda part: F.when(part["kind"].isin(IMAGE, AUDIO), part["kind"]).otherwise(DOCUMENT)
    mark = lambda part, number: F.concat(F.lit("<|"), kind(part), F.lit(":"), number.cast("string"), F.lit("|>"))

    def visit(part: Column, i: Column) -> Column:
        number = F.col("before") + F.size(F.filter(F.slice("parts", F.lit(1), i), other)) + 1
        # Texts that follow each other are escaped as one, or a control string could be dealt over two of them.
        rest = F.slice("parts", i + 1, F.size("parts"))
        stop = F.array_position(F.transform(rest, other), True).cast("int") - 1
        run = F.slice(rest, F.lit(1), F.when(stop < 0, F.size(rest)).otherwise(stop))
        text = F.array_join(F.transform(run, lambda p: F.coalesce(p["text"], F.lit(""))), "")
        again = (i > 0) & ~other(F.get("parts", i - 1))
        return F.when(other(part), mark(part, number)).when(again, F.lit("")).otherwise(escape(text))

    def attachment(part: Column, i: Column) -> Column:
        number = F.col("before") + i + 1
        place = F.col("start") + F.position(mark(part, number), F.col("content")) - 1
        return F.struct(
            number.alias("number"), kind(part).alias("kind"), part["ref"].alias("ref"), expansion.tokens(part).alias("tokens"), place.alias("place")
        )

    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("parts", F.array().cast(f"array<{PART}>")).alias("parts")
    )
    rows = rows.withColumn("others", F.filter("parts", other)).withColumn("loss", F.col("role") == LEARNED)
    rows = rows.withColumns(
        {"at": F.row_number().over(ordered), "before": F.coalesce(F.sum(F.size("others")).over(earlier), F.lit(0))}
    )
    rows = rows.withColumn("content", F.array_join(F.transform("parts", visit), ""))
    rows = rows.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY)))
    rows = rows.withColumn("whole", F.concat("head", "content", F.lit(END)))
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("whole")).over(earlier), F.lit(0)) + F.length("head"))
    span = F.when(F.col("loss"), F.struct("start", F.length("content").cast("bigint").alias("length")))
    rows = rows.select("conv_id", F.struct("at", "whole", span.alias("span"), F.transform("others", attachment).alias("attachments")).alias("row"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return grouped.select(
        "conv_id",
        F.array_join("rows.whole", "").alias("formatted"),
        F.filter("rows.span", lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten("rows.attachments").alias("attachments"),
        F.size("rows").cast("bigint").alias("n_turns"),
        F.aggregate(F.flatten("rows.attachments"), F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as ``array<struct<role, text>>``, unescaped; placeholders stay as marks."""
    return F.transform(
        F.filter(F.split(formatted, r"<\|end\|>"), lambda t: t != ""),
        lambda t: F.struct(
            unescape(F.substring_index(F.replace(t, F.lit(TURN), F.lit("")), BODY, 1)).alias("role"),
            unescape(F.substring_index(t, BODY, -1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
