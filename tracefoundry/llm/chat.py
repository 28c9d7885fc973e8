r"""Chat formatting: conversations rebuilt from their event logs, then rendered.

A log has events (conv_id, seq, message, kind, role, text).  ``message``
opens a message, ``delta`` appends to it, ``edit`` replaces its text,
``regenerate`` empties it for the deltas that follow, ``delete`` removes it.
Events are partitioned by conversation once; there a message is folded over
its own events in order of seq, and a conversation is its messages in order
of their first seq.

Every turn is rendered as ``[ROLE]role[/ROLE]text</s>``.  In roles and texts
the control strings are escaped, so they cannot end or begin a turn: ``\``
becomes ``\e``, the ``[`` of ``[ROLE]``, ``[/ROLE]``, ``[INST]``,
``[/INST]`` becomes ``\b`` and the ``<`` of ``<s>``, ``</s>`` becomes
``\a``.  :func:`unescape` restores the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "[ROLE]", "[/ROLE]", "</s>"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\e"))
    out = F.regexp_replace(out, r"\[(?=/?(?:ROLE|INST)\])", r"\\b")
    return F.regexp_replace(out, r"<(?=/?s>)", r"\\a")


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\b"), F.lit("["))
    out = F.replace(out, F.lit("\\a"), F.lit("<"))
    return F.replace(out, F.lit("\\e"), F.lit("\\"))


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as the events of a log; a null role or text counts as empty.

    An assistant's row is a message that opens empty and two streamed deltas;
    another row is a draft, a delta that is wrong, a regeneration and an edit
    that says the text.  A row without a turn is a message alone.  Each row is
    a message of its own, also one that agrees with others in all columns.
    """
    text, role = (F.coalesce(c, F.lit("")) for c in ("text", "role"))
    at = F.col("turn").cast("decimal(20,0)")
    rows = conversations.select("conv_id", (at * 4).cast("decimal(22,0)").alias("at"), role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("message"))

    def event(step: int, kind: str, said: Column) -> Column:
        return F.struct((F.col("at") + step).cast("decimal(22,0)").alias("seq"), F.lit(kind).alias("kind"), said.alias("text"))

    head, tail = F.expr("substring(text, 1, cast(floor(char_length(text) / 2) as int))"), F.expr("substring(text, cast(floor(char_length(text) / 2) as int) + 1)")
    streamed = F.array(event(0, "message", F.lit("")), event(1, "delta", head), event(2, "delta", tail))
    edited = F.array(event(0, "message", head), event(1, "delta", F.lit("?")), event(2, "regenerate", F.lit("")), event(3, "edit", F.col("text")))
    alone = F.array(event(0, "message", F.col("text")))
    events = F.when(F.col("at").isNull(), alone).when(F.col("role") == "assistant", streamed).otherwise(edited)
    return rows.select("conv_id", "message", "role", F.inline(events))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, place, message, role, text) of an event log.

    Events of a message apply in order of (seq, kind, text), null seq last.
    Events are dealt by conversation, and so are messages and what is made of
    them: there is no other shuffle.  A message without a ``message`` event has the first role among its events;
    one that ends deleted is left out.  Unknown kinds change nothing.
    """
    step = F.struct(F.col("seq").isNull().alias("late"), "seq", "kind", "text", "role")
    grouped = events.repartition("conv_id").groupBy("conv_id", "message").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("gone"))

    def apply(state: Column, event: Column) -> Column:
        kind, text = event["kind"], F.coalesce(event["text"], F.lit(""))
        return F.struct(
            F.when(kind.isin("message", "edit"), text).when(kind == "delta", F.concat(state["text"], text)).when(kind == "regenerate", F.lit("")).otherwise(state["text"]).alias("text"),
            F.when(kind == "delete", F.lit(True)).when(kind.isin("message", "edit", "delta", "regenerate"), F.lit(False)).otherwise(state["gone"]).alias("gone"),
        )

    done = grouped.select("conv_id", "message", F.element_at("steps", 1).alias("first"), F.coalesce(F.get(F.filter("steps", lambda e: e["kind"] == "message"), F.lit(0))["role"], F.get(F.filter("steps", lambda e: e["role"].isNotNull()), F.lit(0))["role"], F.lit("")).alias("role"), F.aggregate("steps", start, apply).alias("end"))
    return done.where("not end.gone").select("conv_id", F.struct("first.late", "first.seq").alias("place"), "message", "role", F.col("end.text").alias("text"))


def format_chats(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_turns.

    ``formatted`` is the rendered text; ``loss_turns`` says for each turn, in
    order, whether its text counts in the loss (the markers never do).
    Turns are rendered before they meet, so a conversation's group holds its
    output and nothing else.  A null conv_id is a conversation; a
    conversation whose messages are all deleted, and an empty log, give no row.
    """
    turn = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(CLOSE), escape(F.col("text")), F.lit(END))
    tie = F.xxhash64("role", "text")
    slim = fold(events).select("conv_id", F.struct("place", tie.alias("tie"), "message", turn.alias("turn"), (F.col("role") == loss_role).alias("loss")).alias("m"))
    met = slim.groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    return met.select("conv_id", F.array_join(F.col("ms.turn"), "").alias("formatted"), F.col("ms.loss").alias("loss_turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The digest of :func:`format_chats`: turns parsed out of the text, loss text taken by the mask.

    Fails if the text does not parse into as many turns as the mask has.
    """
    pieces = F.split("formatted", r"</s>")
    turns = F.slice(pieces, 1, F.size(pieces) - 1)
    parts = F.transform(turns, lambda t: F.split(F.substring(t, len(OPEN) + 1, 2**31 - 1), r"\[/ROLE\]"))
    parsed = formatted.select("conv_id", "formatted", "loss_turns", F.transform(parts, lambda p: F.struct(unescape(F.get(p, F.lit(0))).alias("role"), unescape(F.get(p, F.lit(1))).alias("text"))).alias("turns"))
    whole = (F.size("turns") == F.size("loss_turns")) & F.forall(parts, lambda p: F.size(p) == 2)
    parsed = parsed.withColumn("turns", F.when(whole, F.col("turns")).otherwise(F.raise_error(F.lit("the text does not hold the turns of its mask"))))
    all_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.transform(F.filter(F.arrays_zip("turns", "loss_turns"), lambda z: z["loss_turns"]), lambda z: z["turns"]["text"])
    loss = F.array_join(under, "")
    parsed = parsed.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(all_text, 256).alias("turns_sha256"), loss.alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    return parsed.select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, 17 + length(role) + length(text)
    + length(regexp_replace(role || text, '[^\\]', '', 'g'))
    + length(regexp_extract_all(role, '\[/?(ROLE|INST)\]|</?s>'))
    + length(regexp_extract_all(text, '\[/?(ROLE|INST)\]|</?s>')) AS chars
  FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
