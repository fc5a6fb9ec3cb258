"""Collapse logs that were saved after every turn, then render the conversations that remain.

Each turn has a 128-bit digest of its position, role and text. The running sum of these digests names
a prefix: two conversations share their first n turns exactly when the sums at position n agree. A
conversation whose whole is a shorter prefix of another one is a snapshot and goes; of equal
conversations the smallest id stays. Running sums split conversations of any length
(``millrace.operators.running``), and prefixes are counted before they are joined, so a first turn
that all conversations share is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.running import Running, find_hot_keys, running

PART_TURNS = 256
LANES = ["l0", "l1", "l2", "l3"]


def _lanes(digest: Column) -> list[Column]:
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def turn_prefixes(turns: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Turns in order with ``pos`` (from 1) and the prefix digest ``l0 .. l3`` up to and with that turn.

    Order is turn number (null last), role, text. Null roles read ``unknown``, null texts are empty.
    Turns without a conversation id form one conversation of their own.
    """
    base = turns.select("conv_id", F.col("turn").isNull().alias("unnumbered"), "turn",
                        F.coalesce("role", F.lit("unknown")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    hot = find_hot_keys(base, ["conv_id"], hot_rows)
    placed = running(base, ["conv_id"], ["unnumbered", "turn", "role", "text"],
                     [Running("pos", "sum", F.lit(1).cast("long"))], hot)
    digest = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.length("role").cast("string"), F.lit(":"),
                            "role", F.lit(":"), "text"))
    summed = running(placed.withColumn("digest", digest), ["conv_id"], ["pos"],
                     [Running(n, "sum", c) for n, c in zip(LANES, _lanes(F.col("digest")))], hot)
    return summed.select("conv_id", "pos", "role", "text", *LANES)


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """conv_id, turns and copies of each conversation that is no prefix of a longer one."""
    whole = prefixes.groupBy("conv_id").agg(F.max("pos").alias("pos"), *[F.max(c).alias(c) for c in LANES])
    whole = whole.groupBy("pos", *LANES).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    seen = prefixes.groupBy("pos", *LANES).agg(F.count(F.lit(1)).alias("n"))
    longer = seen.join(whole.select("pos", *LANES, "copies"), ["pos", *LANES]).where(F.col("n") > F.col("copies"))
    kept = whole.join(longer, ["pos", *LANES], "left_anti")
    return kept.select("conv_id", F.col("pos").alias("turns"), "copies")


def render_chats(turns: DataFrame, part_turns: int = PART_TURNS, hot_rows: int | None = None) -> DataFrame:
    """Rendered text of the conversations of ``turns(conv_id, turn, role, text)`` that are no snapshots.

    Rows: conv_id, part, turns (of the conversation), copies, rendered. A conversation longer than
    ``part_turns`` turns comes in parts, in order, so no task ever gathers an unbounded one.
    Repeated turns (same number, role and text) are kept, as they were logged. Other columns are not
    read. An empty table gives no rows.
    """
    prefixes = turn_prefixes(turns, hot_rows)
    kept = maximal_conversations(prefixes)
    said = prefixes.select(F.col("conv_id").alias("of"), "pos", F.concat(
        F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>\n")).alias("turn"))
    parts = said.join(kept, F.col("of").eqNullSafe(F.col("conv_id"))).groupBy(
        "conv_id", ((F.col("pos") - 1) / part_turns).cast("long").alias("part"), "turns", "copies").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "turn"))), lambda t: t["turn"]), "")
        .alias("rendered"))
    return parts
