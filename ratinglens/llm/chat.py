"""Chat formatting from event logs.

A log holds, per conversation, numbered events: whole messages, streamed
deltas, edits and regenerations of a turn. Folding gives the final messages:

* a turn's text starts at its last ``message``, ``edit`` or ``regenerate``
  event and grows by the ``delta`` events after it;
* regenerating a turn also voids what later turns had said before.

Rendering is one row per message, so a conversation of any length is rendered
in parallel; reading back streams the rows in order, a batch at a time.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Strings that have a meaning in a formatted text, here or in
# common chat formats; inside texts they are escaped.
CONTROLS = (
    "<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
)
_ANY = "|".join(re.escape(c).replace(r"\-", "-") for c in CONTROLS)
_PIECE = re.compile(r"<s>\[ROLE\](.*)\n\[/ROLE\](.*)\n</s>\n", re.DOTALL)
_ESCAPED = re.compile(rf"\\(\\*(?:{_ANY}))")



def escape(text: Column) -> Column:
    """Puts a backslash before each control string and the backslashes that
    lead up to it; ``unescape`` takes it away."""
    return F.regexp_replace(text, rf"(\\*(?:{_ANY}))", r"\\$1")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def events_of_turns(conversations: DataFrame) -> DataFrame:
    """A log of whole messages from rows (conv_id, turn, role, text): one
    ``message`` event per row. Rows of one turn follow each other by role and
    text; a null turn comes first."""
    tied = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    place = F.struct(F.col("turn").cast("long").alias("turn"), F.row_number().over(tied).alias("tie"))
    placed = conversations.select("conv_id", place.alias("seq"), "role", "text")
    # The kind is named above the window, where it stays a constant: fold's part
    # for regenerations, another pass over all rows, is then known to be empty.
    return placed.select("conv_id", "seq", F.col("seq").alias("turn"), F.lit("message").alias("kind"), "role", "text")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, role, text) of a log (conv_id, seq, turn,
    kind, role, text), one row per turn that has an event left.

    ``seq`` orders the events of a conversation (any orderable type); equal
    seq: by kind, role and text. A null text is empty; the role is the one
    named last, empty if none is; events of unknown kind are ignored; repeated
    rows count each (a repeated delta adds its text twice). A null conv_id is
    a conversation of its own; a null turn is the first turn and a null seq the
    first place of its conversation, but regenerating a null turn voids nothing
    of the other turns. Other columns are ignored; an empty log gives an empty
    table. A turn's events meet in one group: a message is one value.
    """
    e = events.select(
        "conv_id",
        "seq",
        "turn",
        F.when(F.col("kind").isin("message", "edit", "regenerate", "delta"), F.col("kind")).alias("kind"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    ).where("kind is not null")
    # Voided: a regeneration of an earlier turn comes later in the log. Of a
    # conversation's regenerations only the steps of the running minimum
    # matter (at most one per turn).
    regenerated = e.where("kind = 'regenerate' and turn is not null").select(
        "conv_id", F.col("seq").alias("at"), F.col("turn").alias("cut")
    )
    after = Window.partitionBy("conv_id").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        regenerated.withColumn("low", F.min("cut").over(after))
        .groupBy("conv_id", "low")
        .agg(F.max("at").alias("until"))
        .groupBy("conv_id")
        .agg(F.collect_list(F.struct("low", "until")).alias("cuts"))
    )

    def later(at: Column) -> Column:
        return F.coalesce(at > F.col("seq"), at.isNotNull() & F.col("seq").isNull())

    live = (
        e.join(cuts.withColumnRenamed("conv_id", "_cut_conv"), F.col("conv_id").eqNullSafe(F.col("_cut_conv")), "left")
        .where(
            F.col("cuts").isNull()
            | ~F.exists("cuts", lambda c: F.coalesce(c["low"] < F.col("turn"), F.lit(False)) & later(c["until"]))
        )
        .drop("cuts", "_cut_conv")
    )
    starts = F.max(F.when(F.col("kind") != "delta", F.col("seq")))
    told = F.array_sort(F.collect_list(F.struct("seq", "kind", F.coalesce("role", F.lit("")).alias("role"), "text")))
    folded = live.groupBy("conv_id", "turn").agg(starts.alias("start"), told.alias("told"))
    used = F.filter("told", lambda x: F.col("start").isNull() | (x["seq"] >= F.col("start")))
    roles = F.filter("told", lambda x: x["role"] != "")
    return folded.select(
        "conv_id",
        "turn",
        F.coalesce(F.try_element_at(roles, F.lit(-1))["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(used, lambda x: x["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """Formatted text as one piece per message: (conv_id, turn, piece,
    loss_start, loss_end). The pieces of a conversation in order of turn are
    its formatted text; ``loss_start`` and ``loss_end`` are the code points of
    the piece under the loss mask (an assistant's text), else null.

    Null role or text: empty. Repeated rows and other columns: one piece per
    row, other columns ignored. An empty table gives an empty table."""
    head = F.concat(F.lit("<s>[ROLE]"), escape(F.coalesce("role", F.lit(""))), F.lit("\n[/ROLE]"))
    body = escape(F.coalesce("text", F.lit("")))
    loss = F.col("role") == "assistant"
    return messages.select("conv_id", "turn", head.alias("h"), body.alias("b"), loss.alias("l")).select(
        "conv_id",
        "turn",
        F.concat("h", "b", F.lit("\n</s>\n")).alias("piece"),
        F.when(F.col("l"), F.length("h")).alias("loss_start"),
        F.when(F.col("l"), F.length("h") + F.length("b")).alias("loss_end"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation what its formatted text says: conv_id, n_turns,
    turns_sha256 (role, newline, text, newline per turn), loss_chars,
    loss_sha256 (the text under the loss mask) and formatted_chars.

    A digest is sequential, so one task reads a conversation through, holding
    one batch of pieces whatever its length."""
    id_type = dict(rendered.dtypes)["conv_id"]

    def digest(batches):
        ids, rows = [], []
        current, state = object(), None

        def close():
            if state:
                ids.append(state["id"])
                rows.append(
                    (state["n"], state["turns"].hexdigest(), state["loss"], state["text"].hexdigest(), state["chars"])
                )

        def flush():
            cols = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            out = pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )
            ids.clear()
            rows.clear()
            return out

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, piece, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != current:
                    close()
                    current = conv
                    state = {"id": conv, "n": 0, "turns": hashlib.sha256(), "text": hashlib.sha256(), "loss": 0, "chars": 0}
                role, text = (unescape(x) for x in _PIECE.fullmatch(piece).groups())
                state["n"] += 1
                state["turns"].update(f"{role}\n{text}\n".encode())
                state["chars"] += len(piece)
                if start is not None:
                    masked = unescape(piece[start:end])
                    state["loss"] += len(masked)
                    state["text"].update(masked.encode())
            yield flush()
        close()
        if ids:
            yield flush()

    n = int(rendered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rendered.repartition(n, "conv_id")
        .sortWithinPartitions("conv_id", "turn", "piece")
        .select("conv_id", "piece", "loss_start", "loss_end")
        .mapInArrow(
            digest,
            f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        )
    )
