"""Conversations: history pairs, current question, request checks.

Messages are rows ``conv_id, turn, role, text``; ``turn`` orders the messages of a conversation and may have gaps
(:func:`dense_turns` numbers them anew). No window runs over all messages of a conversation, so one
that holds much of the table spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestrata.functions.text import is_blank
from lodestrata.operators.ordering import best_per_group

# Replies to requests that cannot be served.
NO_MESSAGES = "Messages list cannot be empty"
EMPTY_MESSAGE = "I received an empty message. Could you please rephrase your question?"


TURN_SPAN = 4096  # turns per slice when numbering


def dense_turns(messages: DataFrame) -> DataFrame:
    """Renumber ``turn`` from 0 without gaps, in the order of the old numbers."""
    return numbered(messages).withColumn("turn", F.col("_place")).select(messages.columns)


def numbered(messages: DataFrame) -> DataFrame:
    """The messages with ``_place``: their number in the conversation, from 0 without gaps.

    A conversation is cut into slices of ``TURN_SPAN`` old numbers. Rows are counted within slices,
    and only the slice sizes are added up along a conversation.
    """
    sliced = messages.withColumn("_slice", F.floor(F.col("turn") / TURN_SPAN))
    sizes = sliced.groupBy("conv_id", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("conv_id").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("conv_id", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("conv_id", "_slice").orderBy("turn")
    return (
        sliced.withColumn("_at", F.row_number().over(inside) - 1)
        .join(offsets, ["conv_id", "_slice"])
        .withColumn("_place", F.col("_offset") + F.col("_at"))
        .select(*messages.columns, "_place")
    )


def history_pairs(messages: DataFrame, enabled: bool = True) -> DataFrame:
    """``conv_id, turn, question, response``: a non-empty user turn directly followed by a non-empty
    assistant turn, neither of them the last message. ``turn`` is the question's own number.

    Turns may have gaps, so "directly followed" means the next message that there is. A conversation is cut into
    slices of ``TURN_SPAN`` numbers, and a window over a slice sees the next two messages of all rows but its last two; for
    these a second window runs along the first and last two rows of each slice only. A conversation that holds much of the
    table is thus spread over tasks. Messages without conv_id or turn are left out.
    """
    placed = messages.select("conv_id", "turn", "role", "text").where("conv_id IS NOT NULL AND turn IS NOT NULL")
    placed = placed.withColumn("_slice", F.floor(F.col("turn") / TURN_SPAN))
    inside = W.partitionBy("conv_id", "_slice").orderBy("turn")
    along = W.partitionBy("conv_id").orderBy("turn")
    reply = F.struct("role", "text")
    seen = placed.withColumns({"_reply": F.lead(reply).over(inside), "_after": F.lead("turn", 2).over(inside), "_at": F.row_number().over(inside)})
    edges = seen.where("_at <= 2 OR _after IS NULL").withColumn("_open", F.col("_after").isNull())
    edges = edges.withColumns({"_reply": F.lead(reply).over(along), "_after": F.lead("turn", 2).over(along)}).where("_open")
    columns = ["conv_id", "turn", "role", "text", "_reply", "_after"]
    both = seen.select(columns).unionByName(edges.select(columns)).where("_after IS NOT NULL")
    pairs = both.where("role = 'user' AND text <> '' AND _reply.role = 'assistant' AND _reply.text <> ''")
    return pairs.filter(F.lit(enabled)).select("conv_id", "turn", F.col("text").alias("question"), F.col("_reply.text").alias("response"))


def recent_history(pairs: DataFrame, max_pairs: int | None) -> DataFrame:
    """The last ``max_pairs`` pairs per conversation; None or a number below 1 keeps all."""
    if max_pairs is None or max_pairs <= 0:
        return pairs
    return best_per_group(pairs, ["conv_id"], [F.desc("turn")], max_pairs, into="_back").drop("_back")


def nested_history(messages: DataFrame, max_pairs: int, enabled: bool = True) -> DataFrame:
    """``conv_id, history``: one row per conversation with its last ``max_pairs`` pairs in order, maybe none.

    A row holds them all, so the caller sets the bound; :func:`history_pairs` gives all pairs as rows.
    """
    if max_pairs is None or max_pairs <= 0:
        raise ValueError("set max_pairs to at least 1, or use history_pairs for all pairs")
    recent = recent_history(history_pairs(messages, enabled), max_pairs)
    nested = recent.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "question", "response"))).alias("history")
    )
    empty = F.array().cast("array<struct<question:string,response:string>>")
    pairs = F.transform("history", lambda p: F.struct(p["question"].alias("question"), p["response"].alias("response")))
    return (
        messages.select("conv_id")
        .distinct()
        .join(nested, "conv_id", "left")
        .select("conv_id", F.coalesce(pairs, empty).alias("history"))
    )


def history_text(nested: DataFrame) -> DataFrame:
    """``conv_id, history`` with the pairs as one text, oldest first."""
    lines = F.transform("history", lambda p: F.concat(F.lit("Q: "), p["question"], F.lit("\nA: "), p["response"]))
    return nested.select("conv_id", F.array_join(lines, "\n").alias("history"))


def current_question(messages: DataFrame) -> DataFrame:
    """``conv_id, question``: text of the last message, whatever its role."""
    return messages.groupBy("conv_id").agg(F.max_by("text", "turn").alias("question"))


def as_conversations(questions: DataFrame, key: str, text: str) -> DataFrame:
    """Plain question texts as conversations of one user turn."""
    return questions.select(
        F.col(key).alias("conv_id"),
        F.lit(0).cast("bigint").alias("turn"),
        F.lit("user").alias("role"),
        F.col(text).cast("string").alias("text"),
    )


def validate_requests(requests: DataFrame, messages: DataFrame) -> DataFrame:
    """``conv_id, n_messages, status, reply`` for every request: ``no_messages``, ``empty`` or ``ok``."""
    last = messages.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("text", "turn").alias("question")
    )
    blank = is_blank(F.col("question"))
    return (
        requests.select("conv_id")
        .join(last, "conv_id", "left")
        .select(
            "conv_id",
            F.coalesce("n", F.lit(0)).alias("n_messages"),
            F.when(F.col("n").isNull(), "no_messages").when(blank, "empty").otherwise("ok").alias("status"),
            F.when(F.col("n").isNull(), NO_MESSAGES).when(blank, EMPTY_MESSAGE).alias("reply"),
        )
    )
