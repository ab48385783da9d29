"""Chat formatting with cumulative-snapshot collapse.

A logger that writes a conversation again after every turn leaves conversations that are the beginnings
of longer ones. Every turn gets a rolling hash of the turns so far: the running sum of hashes of (place,
role, text), two sums of 64-bit terms each, so it is a window sum and adds up over blocks of turns. A
conversation whose whole hash is another's hash before its end goes (an anti-join), of equal ones the
least conv_id stays, and those left are rendered.

Turns are numbered, summed and rendered in blocks of neighbouring turns: SEGMENT turn numbers, or, where those have
more than CROWDED turns, the turns of one number, role and beginning of the text. A conversation's blocks
are put together at the end, so only its finished text is ever in one place, as one row, which Spark
limits to 2 GB; joins by conversation deal out long ones.

Defined cases: turns are ordered by turn (null first), then role, then text (by bytes); a null role or text
is empty; rows that are equal in all of these are one; rows without conv_id are left out; a very long
text is a turn like others; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_counted, materialize

SEGMENT, CROWDED, BEGINNING = 1024, 4096, 8
#: The marks of the rendered form.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def distinct_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, block, turn, role, text: each turn once; blocks are ordered as their turns are."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.col("turn").cast("long")
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", F.floor(turn / SEGMENT).alias("part"), turn.alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("part", F.coalesce("part", F.lit(-(2**53)))).distinct()
    rows = materialize(rows)
    crowded = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED)
    rows = join_counted(rows, materialize(crowded), ["conv_id", "part"], "left")
    fine = lambda c: F.when(F.col("n").isNotNull(), c)
    block = F.struct("part", fine(F.col("turn")).alias("turn"), fine(F.col("role")).alias("role"), fine(F.left("text", F.lit(BEGINNING))).alias("beginning"))
    return rows.select("conv_id", block.alias("block"), "turn", "role", "text")


def rolling_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, k, n, s1, s2: the hash of the first k of n turns."""
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    whole, before = Window.partitionBy("conv_id"), Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("conv_id", "block").agg(F.count("*").alias("size"))
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"), F.sum("size").over(whole).alias("n"))
    own = turns.select("conv_id", "block", F.row_number().over(inside).alias("r"), F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", "role", F.lit(1)).alias("h2"), F.length("role").alias("role"))
    placed = own.join(blocks, ["conv_id", "block"]).withColumn("k", F.col("before") + F.col("r"))
    term = lambda *c: F.xxhash64(*c).cast("decimal(20,0)")
    placed = placed.withColumn("t1", term("k", "role", "h1", "h2")).withColumn("t2", term("h2", "k", "h1", F.lit(2)))
    # the blocks' own sums are added up apart, so a long conversation's turns needn't meet
    sums = placed.groupBy("conv_id", "block").agg(F.sum("t1").alias("b1"), F.sum("t2").alias("b2"))
    zero = F.lit(0).cast("decimal(38,0)")
    sums = sums.select("conv_id", "block", *[F.coalesce(F.sum(b).over(before).cast("decimal(38,0)"), zero).alias(f"before_{b}") for b in ("b1", "b2")])
    upto = Window.partitionBy("conv_id", "block").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("conv_id", "block", "k", "n", F.sum("t1").over(upto).alias("l1"), F.sum("t2").over(upto).alias("l2"))
    total = lambda b, l: (F.col(b) + F.col(l)).cast("string")
    return local.join(sums, ["conv_id", "block"]).select("conv_id", "k", "n", total("before_b1", "l1").alias("s1"), total("before_b2", "l2").alias("s2"))


def maximal(hashes: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that no longer one begins with."""
    whole = hashes.where("k = n").groupBy("n", "s1", "s2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    proper = hashes.where("k < n").select(F.col("k").alias("n"), "s1", "s2").distinct()
    return whole.join(proper, ["n", "s1", "s2"], "left_anti").select("conv_id", F.col("n").alias("n_turns"), "n_copies")


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, text of the conversations that stay, a row each."""
    turns = materialize(distinct_turns(conversations))
    kept = materialize(maximal(materialize(rolling_hashes(turns))).withColumn("n", F.col("n_turns")))
    rows = join_counted(turns, kept, ["conv_id"]).groupBy("conv_id", "block", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    text = F.array_join(F.transform("turns", lambda x: F.concat(F.lit(OPEN), x["role"], F.lit("\n"), x["text"], F.lit(CLOSE))), "")
    blocks = rows.select("conv_id", "n_turns", "n_copies", "block", text.alias("text"))
    whole = blocks.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("blocks"))
    return whole.select("conv_id", "n_turns", "n_copies", F.array_join(F.col("blocks.text"), "").alias("text"))
