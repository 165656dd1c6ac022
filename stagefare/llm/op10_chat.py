r"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log holds events ``(conv_id, seq, message, role, kind, text)``. Events are partitioned by
conversation and message and folded in order of ``seq``: a ``delta`` adds its text, an
``edit`` replaces what the message held with its text, a ``regenerate`` drops it and starts
anew with its text. The final messages are rendered as

    ### role: text </turn>

one after the other, each ended by a line feed. Inside roles and texts the control strings
are escaped reversibly, and so is the escape character: ``\`` becomes ``\b``, ``###`` becomes
``\h``, ``</turn>`` becomes ``\t`` and, in roles, ``:`` becomes ``\c``. Undoing them in reverse
order, ``\b`` last, restores the text, as an escape never holds another's first character.

Defined results: null text and null role count as empty, unknown kinds as deltas; a null
``seq`` comes first; events equal in ``seq`` are ordered by kind, role and text; the role is
that of the last event that counts; null ``conv_id`` is a conversation of its own; no rows
give no rows. One conversation ends up in one row, as its text is one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template and its escapes, in the order in which they are applied.
OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def _escape(text: Column, escapes=ESCAPES) -> Column:
    for plain, sign in escapes:
        text = F.replace(text, F.lit(plain), F.lit(sign))
    return text


def _unescape(text: Column, escapes=ESCAPES) -> Column:
    for plain, sign in reversed(escapes):
        text = F.replace(text, F.lit(sign), F.lit(plain))
    return text


def _or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def events_of(conversations: DataFrame) -> DataFrame:
    """Each row of ``(conv_id, turn, role, text)`` as the single event of a message.

    Messages follow ``turn``; rows of the same turn stay apart, ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(order).cast("long")
    return conversations.select("conv_id", "turn", _or_empty("role").alias("role"), _or_empty("text").alias("text")).select(
        "conv_id",
        place.alias("seq"),
        place.alias("message"),
        "role",
        F.lit("delta").alias("kind"),
        "text",
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, message, role, text)`` of a log."""
    kind = F.coalesce("kind", F.lit("delta"))
    # "edit" and "regenerate" sort after "delta": at one seq the reset comes last and wins.
    rank = F.when(kind == "edit", 1).when(kind == "regenerate", 2).otherwise(0)
    event = F.struct("seq", rank.alias("rank"), _or_empty("role").alias("role"), _or_empty("text").alias("text"))
    ordered = events.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list(event)).alias("log"))
    last_reset = F.array_max(
        F.transform("log", lambda e, i: F.when(e["rank"] > 0, i + 1).otherwise(1))
    )
    counted = F.slice("log", last_reset, F.size("log"))
    return ordered.select("conv_id", "message", counted.alias("log")).select(
        "conv_id",
        "message",
        F.element_at("log", -1)["role"].alias("role"),
        F.array_join(F.transform("log", lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted``, and by message the spans of its loss mask.

    ``loss_spans`` has a ``(start, end)`` of code points in ``formatted`` for a message of the
    assistant, null for any other.
    """
    head = F.concat(F.lit(OPEN), _escape(_or_empty("role"), ROLE_ESCAPES), F.lit(MIDDLE))
    body = _escape(_or_empty("text"))
    turns = messages.select(
        "conv_id",
        "message",
        (_or_empty("role") == "assistant").alias("loss"),
        F.char_length(head).cast("long").alias("before"),
        F.char_length(body).cast("long").alias("inside"),
        F.concat(head, body, F.lit(CLOSE)).alias("rendered"),
    )
    until = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn(
        "start", F.coalesce(F.sum(F.char_length("rendered")).over(until), F.lit(0)) + F.col("before")
    )
    span = F.when(F.col("loss"), F.struct("start", (F.col("start") + F.col("inside")).alias("end")))
    turn = F.struct("message", "rendered", span.alias("span"))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"),
        F.transform("turns", lambda t: t["span"]).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, formatted_chars, turns)`` parsed from rendered conversations.

    ``turns`` are ``(role, text, learned)``, unescaped. ``learned`` is what the loss mask covers of a turn, cut out of the
    rendered text at the span's own places and null without a span, so a span that starts or ends elsewhere shows. Each turn's piece is
    cut by itself, which keeps the work in proportion to the text.
    """
    pieces = F.split("formatted", f"\\Q{CLOSE}\\E")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    rows = formatted.select(
        "conv_id",
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.posexplode(F.arrays_zip(pieces.alias("piece"), F.col("loss_spans").alias("span"))).alias("place", "turn"),
    )
    piece, span = F.coalesce("turn.piece", F.lit("")), F.col("turn.span")
    before = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.char_length(piece) + len(CLOSE)).over(before), F.lit(0))
    # Places of the span in its piece, from 1 on; what lies outside the piece is not there.
    first, after = F.greatest(span["start"] - begin + 1, F.lit(1)), span["end"] - begin + 1
    masked = F.substr(piece, first.cast("int"), F.greatest(after - first, F.lit(0)).cast("int"))
    turn = F.struct(
        "place",
        _unescape(F.substring_index(F.substr(piece, F.lit(len(OPEN) + 1)), MIDDLE, 1), ROLE_ESCAPES).alias("role"),
        _unescape(F.substr(piece, F.instr(piece, F.lit(MIDDLE)) + len(MIDDLE))).alias("text"),
        F.when(span.isNotNull(), _unescape(masked)).alias("learned"),
    )
    parsed = rows.select("conv_id", "formatted_chars", turn.alias("turn"))
    return parsed.groupBy("conv_id").agg(
        F.first("formatted_chars").alias("formatted_chars"), F.array_sort(F.collect_list("turn")).alias("turns")
    )


def digests(parsed: DataFrame) -> DataFrame:
    """What the check asks of each conversation, from what was read back."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join(F.transform("turns", lambda t: F.coalesce(t["learned"], F.lit(""))), "")
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """Rendered conversations of a table of turns."""
    return render(fold(events_of(conversations)))
