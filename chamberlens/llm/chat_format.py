"""Chat transcripts from an event log: fold the events into messages, render, read back.

A conversation's log holds, for each message, the opening event, streamed deltas, edits
and regenerations. A message is the text from its last opening, edit or regeneration
onwards. Folding is grouped by message, not by conversation, so a crowded conversation
is spread; only its finished text meets in one row, because it is one output value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from chamberlens.llm.common import free_names

OPEN, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"


@dataclass(frozen=True)
class Template:
    """Control strings around a turn; each must begin with ``<`` or ``[``.

    In texts and roles a backslash is doubled and one is put after every ``<`` and ``[``.
    So no control string, of this template or another in that style, can occur in an
    escaped text, and reading left to right restores the original.
    """

    start: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    learned_role: str = "assistant"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\|(\\)\\", "$1$2")


def fold_events(events: DataFrame, message: list[str], conv: str = "conv_id") -> DataFrame:
    """One row per message: ``conv``, the ``message`` columns, ``role`` and ``text``.

    ``events`` has ``conv``, the columns that name a message, ``seq``, ``event``, ``role``
    and ``text``; other columns are ignored. An opening, edit or regeneration replaces
    the text so far, a delta appends; any other kind counts as a delta. The role is the
    last one given. A null text adds nothing; a null ``seq`` comes before all others;
    at equal ``seq`` a replacement comes before a delta, then texts in order. Events
    repeated as a whole count once. Null conversation or message names are names too.
    """
    names = [conv, *message]
    replaces = F.coalesce(F.col("event").isin(OPEN, EDIT, REGENERATE), F.lit(False))
    place = F.struct(F.col("seq"), (~replaces).alias("adds"), F.coalesce("text", F.lit("")).alias("text"), F.col("role"))
    placed = events.select(*names, place.alias("_place"), replaces.alias("_replaces"))
    whole = Window.partitionBy(*names)
    last = F.max(F.when(F.col("_replaces"), F.col("_place"))).over(whole)
    told = F.max_by("_place.role", F.when(F.col("_place.role").isNotNull(), F.col("_place"))).over(whole)
    live = placed.withColumns({"_last": last, "_role": told}).where(F.col("_last").isNull() | (F.col("_place") >= F.col("_last")))
    parts = F.array_sort(F.array_distinct(F.collect_list("_place")))
    folded = live.groupBy(*names).agg(parts.alias("_parts"), F.first("_role").alias("role"))
    return folded.select(*names, "role", F.array_join(F.transform("_parts", lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame, order: list[str], conv: str = "conv_id", template: Template = Template()) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted`` and ``loss_spans``.

    Turns follow the ``order`` columns, then role and text. ``loss_spans`` lists the
    spans to learn from as (turn, start, length): code points within the turn's piece of
    ``formatted``, which ends after the template's end string. Null role or text is empty.
    """
    turn = F.struct(*order, *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    listed = messages.groupBy(conv).agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
    pieces = F.transform(
        "_turns",
        lambda t: F.struct(
            F.concat(F.lit(template.start), escaped(t["role"]), F.lit(template.middle)).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == template.learned_role).alias("learn"),
        ),
    )
    spans = F.transform(
        "_pieces",
        lambda p, i: F.struct(
            i.alias("turn"), F.char_length(p["head"]).alias("start"), F.char_length(p["body"]).alias("length"), p["learn"].alias("learn")
        ),
    )
    learned = F.transform(
        F.filter(spans, lambda s: s["learn"]), lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["length"].alias("length"))
    )
    whole = F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit(template.end))), "")
    return listed.select(conv, pieces.alias("_pieces")).select(conv, whole.alias("formatted"), learned.alias("loss_spans"))


def read_back(rendered: DataFrame, conv: str = "conv_id", template: Template = Template()) -> DataFrame:
    """Parse :func:`render`'s output: adds ``turns`` (role, text) and ``loss_text``.

    Both are read from ``formatted`` and ``loss_spans`` alone and unescaped.
    """
    (pieces,) = free_names(rendered, "_pieces")
    quoted_end = r"\Q" + template.end + r"\E"
    split = rendered.withColumn(pieces, F.split("formatted", quoted_end, -1))
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(template.start) + 1), F.char_length(piece))
        role = F.substring_index(inner, template.middle, 1)
        body = F.substring(inner, F.char_length(role) + len(template.middle) + 1, F.char_length(inner))
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    loss = F.transform("loss_spans", lambda s: F.substring(F.get(F.col(pieces), s["turn"]), s["start"] + 1, s["length"]))
    return split.withColumns({"turns": F.transform(whole, turn), "loss_text": unescaped(F.array_join(loss, ""))}).drop(pieces)
