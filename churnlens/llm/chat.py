"""Chat formatting: conversations rebuilt from an event log and rendered (operator 1).

Log events are ``conv_id, seq, op, msg, role, text``; ``msg`` is the message's
place in its conversation. ``delta`` appends text to the message, ``edit`` puts
the text in the place of what the message held, ``regenerate`` empties the
message and withdraws every later message opened so far. A message's role is
that of its last event with a role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of

TURN_END = "</turn>\n"
#: Escapes, applied in this order and undone in the reverse order.
ESCAPES = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"), ("\n", "\\n")]


def escape(text: Column, header: bool = False) -> Column:
    """Control strings cannot occur in the result: it has no ``#`` and no ``<``."""
    for raw, safe in ESCAPES if header else ESCAPES[:3]:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column, header: bool = False) -> Column:
    for raw, safe in reversed(ESCAPES if header else ESCAPES[:3]):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def fold_messages(events: DataFrame) -> DataFrame:
    """``conv_id, msg, role, text``: the messages that are left when every event has been applied.

    One shuffle, by conversation. A message ends at its last ``edit`` or at the
    last ``regenerate`` that struck it (a running maximum over the messages of
    the conversation), and only the events after that count; no per-event loop
    runs. Events that tie in ``seq`` are taken in the order of (op, text, role).
    Null texts are empty, a null op is a ``delta``; null ids, places and
    sequence numbers are values like others and come first. Repeated events
    apply repeatedly. Further columns are ignored.
    """
    rows = events.select("conv_id", "msg", F.struct(
        F.col("seq").alias("seq"), F.coalesce("op", F.lit("delta")).alias("op"),
        text_of("text").alias("text"), F.col("role").alias("role")).alias("e"))
    rows = rows.repartition("conv_id")
    kind = F.col("e.op")
    grouped = rows.groupBy("conv_id", "msg").agg(
        F.sort_array(F.collect_list("e")).alias("es"),
        F.max(F.when(kind == "regenerate", F.col("e.seq"))).alias("redo"))
    here = Window.partitionBy("conv_id").orderBy("msg")
    # A regenerate of an earlier message strikes this one; its own empties it.
    struck = grouped.withColumn("cut", F.max("redo").over(here))
    live = F.filter("es", lambda e: F.col("cut").isNull() | (e["seq"] > F.col("cut")))
    done = struck.withColumn("live", F.filter(live, lambda e: e["op"] != "regenerate"))
    done = done.filter((F.size("live") > 0) | (F.col("redo") == F.col("cut")))
    last_edit = F.array_max(F.transform("live", lambda e, i: F.when(e["op"] == "edit", i).otherwise(F.lit(-1))))
    # From its last edit on; with none, from its first event.
    done = done.withColumn("at", F.greatest(F.coalesce(last_edit, F.lit(0)), F.lit(0)))
    done = done.withColumn("text", F.array_join(F.transform(
        F.slice("live", F.col("at") + 1, F.greatest(F.size("live"), F.lit(1))), lambda e: e["text"]), ""))
    roles = F.filter(F.transform("es", lambda e: e["role"]), lambda r: r.isNotNull())
    role = F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit(""))
    return done.select("conv_id", "msg", role.alias("role"), "text")


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, turns``: one row per conversation.

    A turn is ``### role: text</turn>`` and a line feed. ``turns`` gives each
    turn's code point offsets in ``formatted``: where it begins, where its text
    begins and ends, and whether the text lies under the loss mask (assistant
    turns). A conversation is one string, so its rendered text has to fit one
    (2 GB); its turns meet in one task for that string, whatever the table.
    """
    head = F.concat(F.lit("### "), escape(F.col("role"), True), F.lit(": "))
    parts = messages.select("conv_id", "msg", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    parts = parts.select("conv_id", "msg", (F.col("role") == "assistant").alias("loss"),
                         F.concat("head", "body", F.lit(TURN_END)).alias("piece"),
                         F.length("head").cast("long").alias("h"), F.length("body").cast("long").alias("b"))
    order = Window.partitionBy("conv_id").orderBy("msg")
    start = F.coalesce(F.sum(F.col("h") + F.col("b") + F.lit(len(TURN_END))).over(
        order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumn("start", start)
    one = F.struct("start", (F.col("start") + F.col("h")).alias("text_start"),
                   (F.col("start") + F.col("h") + F.col("b")).alias("text_end"), "loss", "piece")
    return (parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("all"))
            .select("conv_id", F.array_join(F.col("all.piece"), "").alias("formatted"),
                    F.transform("all", lambda t: F.struct(
                        t["start"].alias("start"), t["text_start"].alias("text_start"),
                        t["text_end"].alias("text_end"), t["loss"].alias("loss"))).alias("turns")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and masked texts parsed from ``formatted`` again, unescaped: ``messages``, ``loss_text``."""
    pieces = F.split("formatted", "</turn>\n")
    cut = formatted.withColumn("pieces", F.slice(pieces, 1, F.size(pieces) - 1))
    zipped = F.zip_with("pieces", "turns", lambda p, t: F.struct(
        unescape(F.substring_index(p.substr(F.lit(5), F.length(p)), ": ", 1), True).alias("role"),
        unescape(p.substr(F.instr(p, ": ") + 2, F.length(p))).alias("text"),
        unescape(p.substr((t["text_start"] - t["start"] + 1).cast("int"),
                          (t["text_end"] - t["text_start"]).cast("int"))).alias("masked"),
        t["loss"].alias("loss")))
    cut = cut.withColumn("messages", zipped)
    loss = F.array_join(F.transform(F.filter("messages", lambda m: m["loss"]), lambda m: m["masked"]), "")
    return cut.select("conv_id", "formatted", "turns", "messages", loss.alias("loss_text"))


def conversation_log(conversations: DataFrame) -> DataFrame:
    """Events of a table of whole turns: each row is one delta that opens a message of its own.

    Rows come by turn; rows that tie come by role and text, nulls first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
    return rows.select("conv_id", F.row_number().over(order).alias("seq"), F.lit("delta").alias("op"),
                       F.row_number().over(order).alias("msg"), "role", "text")


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, the counts and digests of what ``read_back`` finds."""
    back = read_back(formatted)
    turns = F.array_join(F.transform("messages", lambda m: F.concat(
        m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("messages").cast("long").alias("n_turns"),
                       F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
