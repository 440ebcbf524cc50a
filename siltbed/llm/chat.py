"""Chat formatting of logged conversations, of which only maximal ones are rendered.

Logs often hold a conversation again and again as it grows. A rolling hash over its turns names each prefix of a conversation; one whose
whole name is a proper prefix of a longer one is a snapshot of it, and an anti join takes it out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The layout of a rendered turn.
TURN = "<|im_start|>{role}\n{text}<|im_end|>\n"


def prefixes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Each turn with its place in the conversation and the name (two hashes) of the prefix that it ends.

    Turns are taken by turn number (nulls first), then role and text. A turn's hashes depend on its place, and a prefix's
    name folds those of its turns, so equal prefixes have equal names whatever follows. A null role or text is not an empty one.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    within = Window.partitionBy("conv_id").orderBy(*order)
    rolling = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    ).where("conv_id is not null")
    content = F.concat_ws("\u0001", F.coalesce(F.md5("role"), F.lit("-")), F.coalesce(F.md5("text"), F.lit("-")))
    placed = told.withColumn("place", F.row_number().over(within)).withColumn("content", content)
    names = {name: F.xxhash64("place", "content", F.lit(seed)) for name, seed in (("h1", 1), ("h2", 2))}
    return placed.withColumns(names).select(
        "conv_id", "place", "role", "text", *(F.bit_xor(name).over(rolling).alias(name) for name in names)
    )


def collapse(named: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns``, ``n_copies`` of the conversations that are a proper prefix of no other; copies count as one."""
    last = Window.partitionBy("conv_id")
    ends = named.select("conv_id", "place", "h1", "h2", F.max("place").over(last).alias("n"))
    inner = ends.where("place < n").select("place", "h1", "h2").distinct()
    whole = ends.where("place = n").groupBy("place", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    kept = whole.join(inner, ["place", "h1", "h2"], "left_anti")
    return kept.select("conv_id", F.col("place").cast("long").alias("n_turns"), "n_copies")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id``, ``n_turns``, ``n_copies``, ``rendered``: the maximal conversations, one of each, as text.

    Of equal conversations the smallest id stays. Rows without a conversation id are left out; a null role renders as
    ``user``, a null text as an empty one; repeated rows are turns of their own. One conversation is rendered in one place, so it has to
    fit a task; any number of them may be equal or start alike.
    """
    named = prefixes(turns, conv_col, turn_col, role_col, text_col)
    before, after = TURN.split("{role}")
    middle, after = after.split("{text}")
    shown = F.concat(
        F.lit(before), F.coalesce("role", F.lit("user")), F.lit(middle), F.coalesce("text", F.lit("")), F.lit(after)
    )
    kept = collapse(named).withColumnRenamed("conv_id", "kept_id")
    joined = named.join(kept, named.conv_id == kept.kept_id)
    turns_in_order = F.array_sort(F.collect_list(F.struct("place", shown.alias("shown"))))
    rendered = F.array_join(F.transform(turns_in_order, lambda t: t["shown"]), "")
    return joined.groupBy("conv_id").agg(F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"), rendered.alias("rendered"))
