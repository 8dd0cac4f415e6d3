"""Chat formatting: typed content parts flattened to one marked text per conversation.

A conversation is ``<|begin|>`` and its turns, each ``<|role|>`` + newline + content + ``<|end|>``.
Texts and roles are escaped so that no ``<`` of theirs remains, hence no control string
inside a text can be taken for one of the template; unescaping gives them back exactly.
Parts are visited in order: text is escaped, an image, audio or document part becomes a
numbered placeholder, and its reference, place and expanded number of tokens are recorded.
Everything is built of column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<|begin|>", "<|end|>"

# Content parts as a column type; units are tiles of an image, seconds of audio, pages of a document.
PARTS = "array<struct<type: string, text: string, ref: string, units: bigint>>"

# Tokens a placeholder expands to for each unit.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}


def escaped(text: Column) -> Column:
    """``&`` and ``<`` as entities, ``&`` first."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    angles = F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))
    return F.replace(angles, F.lit("&amp;"), F.lit("&"))


def _name(text: Column) -> Column:
    """A role or a kind of part inside ``<|`` and ``|>``."""
    return F.replace(escaped(text), F.lit(">"), F.lit("&gt;"))


def text_part(text: Column) -> Column:
    """A text as the only content part; a null text is empty."""
    part = F.struct(
        F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units"),
    )
    return F.array(part).cast(PARTS)


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def _visited(part: Column, place: Column) -> Column:
    """The string a part becomes; attachments are numbered by their place in the turn."""
    mark = F.concat(F.lit("<|"), _name(part["type"]), F.lit(":"), place.cast("string"), F.lit("|>"))
    return F.when(_is_text(part), escaped(F.coalesce(part["text"], F.lit("")))).otherwise(mark)


def _attachment(turn: Column, part: Column, place: Column, tokens: dict[str, int]) -> Column:
    cost = F.lit(1).cast("bigint")
    for kind, per_unit in tokens.items():
        units = F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1))
        cost = F.when(part["type"] == kind, units * per_unit).otherwise(cost)
    return F.struct(
        turn.alias("turn"), place.alias("place"), part["type"].alias("type"), part["ref"].alias("ref"),
        cost.cast("bigint").alias("expanded_tokens"),
    )


def format_chat(
    rows: DataFrame,
    trained_role: str = "assistant",
    tokens: dict[str, int] = TOKENS_PER_UNIT,
) -> DataFrame:
    """conv_id, formatted, loss_mask, attachments, n_turns, expanded_tokens of each conversation.

    ``rows`` has conv_id, turn, role and parts (see ``PARTS``). Turns are ordered by turn, nulls
    first, equal turns by role and content, so repeated rows are repeated turns next to each
    other. A null role or parts is empty; a null conv_id is a conversation. ``loss_mask`` holds, for each turn
    of ``trained_role``, its position and the code points [begin, end) of its content in
    the turn's segment (``formatted`` cut behind each ``<|end|>``). A part of unknown type costs
    one token. A conversation is one output row, so its turns do meet in one task. Other columns of ``rows``, whatever
    their names, do not matter; texts may be as long as a row can hold; no row gives no conversation.
    """
    own = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce(F.col("parts").cast(PARTS), F.array().cast(PARTS)).alias("parts"),
    )
    content = F.concat_ws("", F.transform("parts", _visited))
    attachments = F.filter(
        F.transform("parts", lambda part, place: F.when(
            ~_is_text(part), _attachment(F.lit(0).cast("bigint"), part, place.cast("bigint"), tokens))),
        lambda x: x.isNotNull(),
    )
    head = F.concat(F.lit("<|"), _name(F.col("role")), F.lit("|>\n"))
    turns = own.select(
        "conv_id", "turn",
        F.when(F.col("role") == trained_role, F.length(head)).alias("begin"),
        F.concat(head, content, F.lit(END)).alias("segment"),
        attachments.alias("attached"),
    )
    ordered = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "segment", "begin", "attached"))).alias("turns")
    )
    masked = F.filter(
        F.transform("turns", lambda t, i: F.when(t["begin"].isNotNull(), F.struct(
            i.cast("bigint").alias("position"), t["begin"].alias("begin"),
            (F.length(t["segment"]) - len(END)).alias("end")))),
        lambda x: x.isNotNull(),
    )
    recorded = F.flatten(F.transform("turns", lambda t, i: F.transform(
        t["attached"], lambda a: a.withField("turn", i.cast("bigint")))))
    return ordered.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join(F.transform("turns", lambda t: t["segment"]), "")).alias("formatted"),
        masked.alias("loss_mask"),
        recorded.alias("attachments"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.aggregate(recorded, F.lit(0).cast("bigint"), lambda n, a: n + a["expanded_tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The formatted conversations with turns (role, text) and loss_text, taken from ``formatted``."""
    body = F.expr(f"substring(formatted, {len(BEGIN) + 1})")
    cut = F.split(body, r"<\|end\|>", -1)
    with_segments = formatted.withColumn("segments", F.slice(cut, 1, F.size(cut) - 1))
    turns = F.expr(
        "transform(segments, s -> struct("
        "substring(s, 3, instr(s, '|>\\n') - 3) AS role, substring(s, instr(s, '|>\\n') + 3) AS text))"
    )
    turns = F.transform(turns, lambda t: F.struct(unescaped(t["role"]).alias("role"), unescaped(t["text"]).alias("text")))
    spoken = F.transform("loss_mask", lambda m: unescaped(F.substr(
        F.element_at(F.col("segments"), (m["position"] + 1).cast("int")), m["begin"] + 1, m["end"] - m["begin"])))
    return with_segments.select(
        *formatted.columns, turns.alias("turns"), F.array_join(spoken, "").alias("loss_text")
    )
