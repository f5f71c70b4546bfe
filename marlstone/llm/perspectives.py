"""Chat formatting by perspective rotation, in DataFrame functions only.

For every participant of a conversation (every role or speaker but ``system``) the dialogue is
rendered with that speaker as the assistant and all others as named users. Each message of
each rendering is a row with its rendered string, the span it takes up in the rendering, the
span of its content, and the loss mask: 1 for the assistant's content, 0 otherwise. Rows in
turn order, joined end to end, are the training text; a dialogue of any length is never
gathered into one value.

Spans need the lengths of earlier messages. They are summed within blocks of ``BLOCK`` turns
and then over blocks. Messages meet their conversation's participants block by block, so a very
long conversation is dealt over many tasks.

Cases: a null text is an empty message. A null speaker is rendered as ``unknown`` and is a
participant. Rows without a conversation id form one conversation. Null turns are a block of
their own and come first, before negative ones; rows that share a turn are ordered by speaker
and text, and exact repeats all stay. Texts of any length are rendered whole. A conversation of
system messages alone has no participant and gives no rows. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 1024

# The markers of a message.
OPEN, BREAK, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """conv_id, perspective, turn, seq, role, name, rendered, start, content_start, content_end, end, loss_mask."""
    said = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(speaker).cast("string"), F.lit("unknown")).alias("name"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content"),
    ).withColumn("part", F.floor(F.col("turn") / BLOCK))
    who = said.where(F.col("name") != "system").select(F.col("conv_id").alias("w"), F.col("name").alias("perspective")).distinct()
    blocks = said.select(F.col("conv_id").alias("c"), F.col("part").alias("b")).distinct()
    grid = blocks.join(who, F.col("c").eqNullSafe(F.col("w"))).drop("w")
    # Names and texts are rendered once for each perspective.
    seen = said.join(grid, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("part").eqNullSafe(F.col("b"))).drop("c", "b")
    own = F.col("name") == F.col("perspective")
    role = F.when(F.col("name") == "system", "system").when(own, "assistant").otherwise("user")
    head = F.concat(F.lit(OPEN), F.col("role"), F.when(F.col("role") == "user", F.concat(F.lit(" name="), F.col("name"))).otherwise(F.lit("")), F.lit(BREAK))
    seen = seen.withColumn("role", role).withColumn("head", head)
    seen = seen.withColumn("rendered", F.concat("head", "content", F.lit(CLOSE))).withColumn("n", F.char_length("rendered").cast("long"))
    sums = seen.groupBy("conv_id", "perspective", "part").agg(F.sum("n").alias("chars"), F.count("*").alias("rows"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("part").alias("b"), F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows"))
    seen = seen.join(sums, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & F.col("part").eqNullSafe(F.col("b")))
    within = Window.partitionBy("conv_id", "perspective", "part").orderBy("turn", "name", "content")
    end = F.col("chars") + F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0))
    seen = seen.withColumn("end", end).withColumn("seq", F.col("rows") + F.row_number().over(within) - 1).withColumn("start", F.col("end") - F.col("n"))
    content_start = F.col("start") + F.char_length("head")
    return seen.select(
        "conv_id",
        "perspective",
        "turn",
        "seq",
        "role",
        "name",
        "rendered",
        "start",
        content_start.alias("content_start"),
        (content_start + F.char_length("content")).alias("content_end"),
        "end",
        own.cast("int").alias("loss_mask"),
    )
