"""Chat formatting: logs of conversations folded into final messages and rendered with a loss mask.

A log row is an event ``(conv_id, seq, turn, role, kind, text)``. Within a conversation, ordered by ``seq``:

* ``delta`` appends its text to the message of its turn (a streamed piece, or a whole message at once);
* ``edit`` replaces what the turn said so far;
* ``regenerate`` does so too and discards what later turns had said up to then.

A message keeps the role of its last event that has one. Null texts and roles count as empty, a null kind as
``delta``; rows with equal ``seq`` are taken in the order of turn, kind, text. Null conversation ids form one
conversation. A turn whose every event was discarded is gone; no events give no conversations.

Each turn is rendered as ``<s>[role]text</s>``. Inside roles and texts ``& < [ ]`` become character references,
so none of the template's marks can occur there and the text can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>[", "</s>"
#: The ampersand first: undone in the other direction.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"), ("]", "&#93;"))


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, turn, role, text)`` of a log."""
    reset = F.col("kind").isin("edit", "regenerate")
    cut = F.when(F.col("kind") == "regenerate", F.col("at"))
    order = Window.partitionBy("conv_id").orderBy("seq", "turn", "kind", "text")
    by_turn = Window.partitionBy("conv_id").orderBy("turn")
    earlier = by_turn.rangeBetween(Window.unboundedPreceding, -1)
    own_turn = Window.partitionBy("conv_id", "turn")
    rows = events.select(
        "conv_id", "seq", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), "role",
        F.coalesce("kind", F.lit("delta")).alias("kind"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("at", F.row_number().over(order))
    last_reset = F.coalesce(F.max(F.when(reset, F.col("at"))).over(own_turn), F.lit(0))
    last_cut = F.coalesce(F.max(cut).over(earlier), F.lit(0))
    live = rows.withColumns({"_reset": last_reset, "_cut": last_cut}).where("at >= _reset AND at > _cut")
    pieces = F.array_sort(F.collect_list(F.struct("at", "text")))
    return live.groupBy("conv_id", "turn").agg(
        F.coalesce(F.max_by("role", F.when(F.col("role").isNotNull(), F.col("at"))), F.lit("")).alias("role"),
        F.concat_ws("", F.transform(pieces, lambda piece: piece["text"])).alias("text"),
    )


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Per conversation ``formatted`` and ``turns``: for each turn its start and the span under the loss mask.

    Offsets count characters of ``formatted``. A turn without loss has an empty span at its end.
    """
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit("]"))
    rows = messages.select(
        "conv_id", "turn", F.col("role").isin(*loss_roles).alias("loss"), F.char_length(head).alias("head_chars"),
        F.concat(head, escape(F.col("text")), F.lit(CLOSE)).alias("rendered"),
    ).withColumn("chars", F.char_length("rendered").cast("long"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.coalesce(F.sum("chars").over(before), F.lit(0)))
    end = F.col("start") + F.col("chars") - len(CLOSE)
    parts = placed.select(
        "conv_id",
        F.struct("turn", "rendered", "start", F.when(F.col("loss"), F.col("start") + F.col("head_chars")).otherwise(end).alias("loss_start"), end.alias("loss_end")).alias("part"),
    )
    sorted_parts = F.col("parts")
    return parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts")).select(
        "conv_id",
        F.concat_ws("", F.transform(sorted_parts, lambda p: p["rendered"])).alias("formatted"),
        F.transform(sorted_parts, lambda p: F.struct(p["start"], p["loss_start"], p["loss_end"])).alias("turns"),
    )


def parse(formatted: DataFrame) -> DataFrame:
    """Read back: ``messages`` (role, text) and ``loss_texts``, the text under each non-empty span of the mask."""
    pieces = F.split("formatted", CLOSE)
    with_pieces = formatted.withColumn("_pieces", F.slice(pieces, 1, F.size(pieces) - 1))
    closing = lambda p: F.instr(p, "]")
    message = lambda p: F.struct(
        unescape(F.substring(p, F.lit(len(OPEN) + 1), closing(p) - len(OPEN) - 1)).alias("role"),
        unescape(F.substring(p, closing(p) + 1, F.char_length(p))).alias("text"),
    )

    def masked(piece: Column, mark: Column) -> Column:
        first = (mark["loss_start"] - mark["start"] + 1).cast("int")
        return unescape(F.substring(piece, first, (mark["loss_end"] - mark["loss_start"]).cast("int")))

    return with_pieces.select(
        "conv_id", "formatted", "turns",
        F.transform("_pieces", message).alias("messages"),
        F.zip_with("_pieces", "turns", masked).alias("loss_texts"),
    )


def table_events(conversations: DataFrame) -> DataFrame:
    """One event a row of a finished table; rows of one turn stay messages of their own, by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    at = F.row_number().over(order)
    return conversations.select("conv_id", at.alias("seq"), at.alias("turn"), "role", F.lit("delta").alias("kind"), "text")


def digest(parsed: DataFrame) -> DataFrame:
    """The digest columns of what was read back."""
    said = F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n")))
    loss = F.concat_ws("", "loss_texts")
    return parsed.select(
        "conv_id", F.size("messages").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", said).cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
