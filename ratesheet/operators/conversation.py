"""Chat memory: the turns before each turn, as one text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_TURNS = 64


def conversation_context(turns: DataFrame, history: int | None = None) -> DataFrame:
    """For each turn all earlier turns of its conversation, oldest first, joined by lines.

    ``history`` keeps the last so many turns only (turns, whatever their numbers). A turn
    delivered twice counts once; lines of one turn number are not each other's context.

    A conversation is cut into blocks of consecutive turn numbers, so one endless conversation
    spreads over many tasks. The text of a block is made once and handed to the later blocks of
    the conversation; each turn adds what its own block holds before it. Only block numbers and
    counts of a conversation meet in one place, never its texts.
    """
    line = F.concat("role", F.lit(": "), "text")
    said = turns.select("conv_id", "turn", "role", "text", line.alias("line")).distinct()
    placed = said.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    own = Window.partitionBy("conv_id", "block").orderBy("turn").rangeBetween(
        Window.unboundedPreceding, -1
    )
    placed = placed.withColumn("own", F.collect_list(F.struct("turn", "line")).over(own))
    before = _earlier_blocks(said, history)
    joined = placed.join(before, ["conv_id", "block"], "left")
    earlier = F.concat(
        F.coalesce("blocks", F.array().cast("array<struct<turn:bigint,line:string>>")),
        F.array_sort("own").cast("array<struct<turn:bigint,line:string>>"),
    )
    if history is not None:
        earlier = _last_turns(earlier, history)
    return joined.withColumn("earlier", earlier).select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.size("earlier").alias("n_context_turns"),
        F.array_join(F.transform("earlier", lambda x: x["line"]), "\n").alias("context"),
    )


def _earlier_blocks(said: DataFrame, history: int | None) -> DataFrame:
    """(conv_id, block, blocks): the lines of the earlier blocks of a block's conversation.

    With ``history`` only blocks that can still hold one of the last turns are joined.
    """
    lines = F.array_sort(F.collect_list(F.struct(F.col("turn").cast("bigint").alias("turn"), "line")))
    numbered = said.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    blocks = numbered.groupBy("conv_id", "block").agg(
        lines.alias("lines"), F.count_distinct("turn").alias("n_turns")
    )
    upto = Window.partitionBy("conv_id").orderBy("block")
    counts = blocks.select("conv_id", "block", F.sum("n_turns").over(upto).alias("turns"), "n_turns")
    wanted = counts.select("conv_id", "block", (F.col("turns") - F.col("n_turns")).alias("before"))
    given = counts.select("conv_id", F.col("block").alias("from_block"), F.col("turns").alias("through"))
    pairs = wanted.join(given, "conv_id").where("from_block < block")
    if history is not None:
        pairs = pairs.where(F.col("before") - F.col("through") < history)
    texts = blocks.select("conv_id", F.col("block").alias("from_block"), "lines")
    met = pairs.join(texts, ["conv_id", "from_block"])
    ordered = F.array_sort(F.collect_list(F.struct("from_block", "lines")))
    return met.groupBy("conv_id", "block").agg(
        F.flatten(F.transform(ordered, lambda b: b["lines"])).alias("blocks")
    )


def _last_turns(earlier: Column, history: int) -> Column:
    """The entries of the last ``history`` turn numbers of a list in order."""
    numbers = F.array_sort(F.array_distinct(F.transform(earlier, lambda x: x["turn"])))
    kept = F.slice(numbers, F.greatest(F.lit(1), F.size(numbers) - history + 1), history)
    return F.filter(earlier, lambda x: x["turn"] >= F.array_min(kept)) if history else F.slice(earlier, 1, 0)
