"""Conversations that are logged again and again while they grow: keep the last snapshot, then render. Spark functions only.

Every turn gets a fingerprint of all turns up to it: the exclusive or of two 64-bit hashes of (turn, role,
text), which does not depend on how the turns are split over tasks. A conversation whose whole
fingerprint is a proper prefix of another's is a snapshot of it; of equal conversations the smallest id
stays. An anti-join keeps the maximal ones, which are rendered.

Turns are taken in the order of their number, role and text; a turn logged twice in one conversation counts
once, null values are values of their own, and turns without a conversation id form one conversation.
Turns are compared by the numbers they are logged with. Long conversations are worked on in blocks of BLOCK
turn numbers and rendered in parts of BLOCK turns, so that no task holds a whole one. A null or empty text is
rendered as an empty turn, and a null role as "".
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslake.llm.texts import stage

BLOCK = 1000
NONE = -1
TURN = ["turn", "role", "text"]


def distinct_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, block, turn, role, text, h1, h2) without turns that are logged twice."""
    rows = conversations.select(
        F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    filled = [F.col("turn"), F.col("turn").isNull(), F.col("role"), F.col("role").isNull(), F.col("text"), F.col("text").isNull()]
    hashed = rows.withColumns({"h1": F.xxhash64(F.lit(1), *filled), "h2": F.xxhash64(F.lit(2), *filled)})
    # the hashes stand for role and text in the grouping, so that it folds without sorting texts
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(NONE)).cast("long")
    return hashed.withColumn("block", block).dropDuplicates(["conv", "turn", "h1", "h2"])


def prefixes(turns: DataFrame) -> DataFrame:
    """Turns with ``n``, ``f1`` and ``f2``: length and fingerprint of the conversation up to and with each."""
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    own = turns.withColumns({"n": F.count(F.lit(1)).over(inside), "f1": F.bit_xor("h1").over(inside), "f2": F.bit_xor("h2").over(inside)})
    blocks = turns.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("bn"), F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = blocks.select(
        F.col("conv").alias("_conv"), F.col("block").alias("_block"),
        *[F.coalesce(f.over(earlier), zero).alias(c) for f, c in ((F.sum("bn"), "cn"), (F.bit_xor("b1"), "c1"), (F.bit_xor("b2"), "c2"))],
    )
    joined = own.join(carried, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
    return joined.select(
        "conv", "block", *TURN, (F.col("n") + F.col("cn")).alias("n"),
        F.col("f1").bitwiseXOR(F.col("c1")).alias("f1"), F.col("f2").bitwiseXOR(F.col("c2")).alias("f2"),
    )


def maximal_conversations(marked: DataFrame) -> DataFrame:
    """(conv, n) of conversations that are no prefix of a longer one and the first of their equals.

    Prefixes shared by many conversations fold before they are shuffled.
    """
    lengths = marked.groupBy("conv").agg(F.max("n").alias("n"))
    ends = marked.alias("m").join(
        lengths.alias("l"), F.col("m.conv").eqNullSafe(F.col("l.conv")) & (F.col("m.n") == F.col("l.n"))
    ).select("m.conv", "m.n", "f1", "f2")
    whole = ends.groupBy("n", "f1", "f2").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("copies"))
    inner = marked.alias("m").join(
        lengths.alias("l"), F.col("m.conv").eqNullSafe(F.col("l.conv")) & (F.col("m.n") < F.col("l.n"))
    ).select("m.n", "f1", "f2").distinct()
    return whole.join(inner, ["n", "f1", "f2"], "left_anti").select("conv", "n", "copies")


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def format_conversations(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, part, n_parts, n_turns, rendered): maximal conversations as chat text; n_turns is the part's.

    A conversation of more than BLOCK distinct turns comes in n_parts rows of BLOCK turns each, whatever their numbers.
    """
    marked = stage(prefixes(distinct_turns(conversations, conv_id, turn, role, text)), "chat-prefixes")
    kept = maximal_conversations(marked)
    ends = kept.select(F.col("conv").alias("_conv"), F.ceil(F.col("n") / BLOCK).alias("n_parts"))
    turns = marked.join(ends, F.col("conv").eqNullSafe(F.col("_conv"))).withColumn("part", F.floor((F.col("n") - 1) / BLOCK))
    ordered = F.array_sort(F.collect_list(F.struct("n", render_turn(F.col("role"), F.col("text")).alias("x"))))
    parts = turns.groupBy("conv", "part", "n_parts").agg(ordered.alias("turns"))
    return parts.select(
        F.col("conv").alias("conv_id"), "part", "n_parts", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.col("turns.x"), "").alias("rendered"),
    )
