"""Chat formatting from an event log (DataFrame operations only).

A conversation log is a set of events.  ``reconstruct`` partitions them by
conversation and message, sorts by sequence and folds streamed deltas, edits
and regenerations into the final messages; ``render`` writes a conversation in
one template; ``read_back`` parses a rendered text into its turns again and
``masked_text`` cuts out what the loss mask covers.  ``turn_events`` makes the
event log that a table of finished turns would have come from.

Template of a turn: ``<|im_start|>role LF text <|im_end|> LF``.  Inside a text
or role, ``<`` + n backslashes + ``|`` is written with n + 1 backslashes, so no
``<|`` of a text survives and the step is undone exactly.  A line feed in a
role is written ``%0A`` and ``%`` is written ``%25``.

Defined cases: null text or role is empty; a null conversation id is a
conversation of its own; a null sequence number sorts first; events with equal
sequence sort by operation, role and text; repeated rows without message id
are turns of their own; an empty log gives no rows; further columns, whatever
their names, are ignored; very long texts are cut, written and read back whole.
One conversation must fit in one string of the engine (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def _escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def _unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", r"<$1|")


def _escape_role(c: Column) -> Column:
    return _escape(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(c: Column) -> Column:
    return F.replace(F.replace(_unescape(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def turn_events(turns: DataFrame) -> DataFrame:
    """The log of a table of turns (conv_id, turn, role, text): conv_id, seq, message_id, op, role, text.

    By a hash, a turn is logged in one of four ways: as one message; streamed as
    deltas; written wrongly first and edited after the next turn has begun; or
    written wrongly, regenerated and streamed anew.  Sequence numbers are
    (turn, number among equal turns, step); the events of a turn come in no order.
    """
    place = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("nth", F.row_number().over(place).cast("long"))
    rows = rows.withColumn("step", F.greatest(F.lit(16), F.ceil(F.length("text") / 6)).cast("int"))
    event = "named_struct('late', {late}L, 'step', {step}, 'op', '{op}', 'text', {text})"
    start = lambda text: event.format(late=0, step="0L", op="message", text=text)
    wrong = event.format(late=0, step="1L", op="delta", text="concat('<|', step, text)")
    deltas = (
        "transform(sequence(0, greatest(0, CAST(ceil(length(text) / step) AS int) - 1)), k -> "
        + event.format(late=0, step="k + 3L", op="delta", text="substr(text, k * step + 1, step)")
        + ")"
    )
    ways = (
        f"CASE pmod(xxhash64(conv_id, turn, nth), 4) WHEN 0 THEN array({start('text')})"
        f" WHEN 1 THEN concat(array({start(repr(''))}), {deltas})"
        f" WHEN 2 THEN array({start('reverse(text)')}, {wrong}, {event.format(late=1, step='2L', op='edit', text='text')})"
        f" ELSE concat(array({start('reverse(text)')}, {wrong}, {event.format(late=0, step='2L', op='regenerate', text=repr(''))}), {deltas}) END"
    )
    shuffled = F.array_sort(
        F.transform(F.expr(ways), lambda e: F.struct(F.xxhash64(e["step"], "turn").alias("place"), e.alias("e")))
    )
    return rows.select("conv_id", "turn", "nth", "role", F.explode(shuffled).alias("x")).select(
        "conv_id",
        F.struct((F.col("turn") + F.col("x.e.late")).alias("turn"), "nth", F.col("x.e.step").alias("step")).alias("seq"),
        F.concat_ws(":", "turn", "nth").alias("message_id"),
        F.col("x.e.op").alias("op"),
        F.when(F.col("x.e.op") == "message", F.col("role")).alias("role"),
        F.col("x.e.text").alias("text"),
    )


def reconstruct(events: DataFrame) -> DataFrame:
    """Fold events into the final messages of each conversation.

    ``events``: conv_id, seq, message_id, op, role, text.  Operations:
    ``message`` starts a message, ``delta`` adds to it, ``edit`` replaces what
    it says, ``regenerate`` discards it and starts anew (with the text given,
    if any).  A null message_id is a message of a single event.  A message
    stands where its first event does and keeps its first role that is not null.

    Returns conv_id and messages: array of (seq, message_id, role, text).
    The first shuffle is by conversation *and* message, so a conversation with
    very many events is folded by many tasks.
    """
    event = F.struct(
        F.col("seq").alias("seq"),
        F.coalesce("op", F.lit("message")).alias("op"),
        F.col("role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    alone = F.col("message_id").isNull()
    grouped = (
        events.select("conv_id", "message_id", F.when(alone, F.col("seq")).alias("own_seq"), event.alias("event"))
        .groupBy("conv_id", "message_id", "own_seq")
        .agg(F.array_sort(F.collect_list("event")).alias("events"))
    )
    last_start = F.expr(
        "array_max(transform(events, (e, i) -> IF(e.op IN ('message', 'edit', 'regenerate'), i + 1, 1)))"
    )
    folded = F.struct(
        F.expr("events[0].seq").alias("seq"),
        F.col("message_id").cast("string").alias("message_id"),
        F.expr("coalesce(get(filter(events, e -> e.role IS NOT NULL), 0).role, '')").alias("role"),
        F.array_join(F.expr("transform(slice(events, last_start, size(events)), e -> e.text)"), "").alias("text"),
    )
    single = F.expr(
        "transform(events, e -> named_struct('seq', e.seq, 'message_id', CAST(NULL AS STRING),"
        " 'role', coalesce(e.role, ''), 'text', e.text))"
    )
    return (
        grouped.withColumn("last_start", last_start)
        .select("conv_id", F.when(alone, single).otherwise(F.array(folded)).alias("some"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.flatten(F.collect_list("some"))).alias("messages"))
    )


def render(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Write each conversation in the template.

    Returns conv_id, formatted (text) and loss_runs: the loss mask as runs
    (length in code points, in_loss) that cover ``formatted`` in order.
    """
    turns = F.transform(
        "messages",
        lambda m: F.struct(
            F.concat(F.lit(START), _escape_role(m["role"]), F.lit("\n")).alias("head"),
            _escape(m["text"]).alias("body"),
            (m["role"] == loss_role).alias("learn"),
        ),
    )
    tail = END + "\n"
    written = conversations.select("conv_id", turns.alias("turns"))
    return written.select(
        "conv_id",
        F.array_join(
            F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), ""
        ).alias("formatted"),
        F.flatten(
            F.transform(
                "turns",
                lambda t: F.array(
                    F.struct(F.length(t["head"]).alias("length"), F.lit(False).alias("in_loss")),
                    F.struct(F.length(t["body"]).alias("length"), t["learn"].alias("in_loss")),
                    F.struct(F.lit(len(tail)).alias("length"), F.lit(False).alias("in_loss")),
                ),
            )
        ).alias("loss_runs"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Parse ``formatted`` into turns: array of (role, text), unescaped."""
    parts = F.split("formatted", r"<\|im_end\|>\n", -1)
    cut = rendered.withColumn("parts", parts).withColumn("parts", F.expr("slice(parts, 1, size(parts) - 1)"))
    turn = lambda p: F.struct(
        _unescape_role(F.substring_index(p, "\n", 1).substr(F.lit(len(START) + 1), F.length(p))).alias("role"),
        _unescape(p.substr(F.instr(p, "\n") + 1, F.length(p))).alias("text"),
    )
    return cut.withColumn("turns", F.transform("parts", turn)).drop("parts")


def masked_text(rendered: DataFrame) -> DataFrame:
    """Adds loss_text: all of ``formatted`` that ``loss_runs`` puts under the loss, unescaped, run by run.

    A turn ends with its control string, and runs come by threes, so both are cut
    turn by turn in one pass; runs that don't cover the text raise.
    """
    turns = F.expr(f"transform(slice(parts, 1, size(parts) - 1), p -> concat(p, '{END}\n'))")
    cut = rendered.withColumn("parts", F.split("formatted", r"<\|im_end\|>\n", -1)).withColumn("parts", turns)
    run = lambda t, runs, k: F.when(
        runs[k]["in_loss"],
        _unescape(t.substr(sum((runs[j]["length"] for j in range(k)), F.lit(1)), runs[k]["length"])),
    ).otherwise("")
    said = F.transform(
        F.arrays_zip(
            F.col("parts").alias("t"),
            F.expr("transform(sequence(1, size(parts)), i -> slice(loss_runs, 3 * i - 2, 3))").alias("runs"),
        ),
        lambda x: F.when(
            F.aggregate(x["runs"], F.lit(0), lambda a, r: a + r["length"]) == F.length(x["t"]),
            F.concat(*[run(x["t"], x["runs"], k) for k in range(3)]),
        ).otherwise(F.raise_error(F.lit("the loss mask doesn't cover the text"))),
    )
    whole = F.size("loss_runs") == 3 * F.size("parts")
    error = F.raise_error(F.lit("the loss mask doesn't have three runs a turn"))
    text = F.when(F.size("parts") == 0, "").when(whole, F.array_join(said, "")).otherwise(error)
    return cut.withColumn("loss_text", text).drop("parts")


def format_chats(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Reconstruct and render: conv_id, formatted, loss_runs."""
    return render(reconstruct(events), loss_role)
