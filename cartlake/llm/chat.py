"""Chat formatting: cumulative snapshots collapse, what remains is rendered.

A conversation that was logged again after each turn appears as several rows of growing
length, each a prefix of the next. Every turn gets the hash of its conversation up to there:
the exclusive-or of 128-bit hashes of (place, role, text), so a prefix hash needs no more than
the one before. Whole conversations with equal hashes collapse to the smallest conv_id; those
whose hash is a prefix hash of a longer one go by an anti join. Turns are hashed in blocks of
`BLOCK` places and block totals are carried over, so neither a long conversation nor one that
half the log repeats is gathered anywhere; only digests are shuffled until the turns that stay
are rendered. All steps are built-in functions.

Results for odd input: turns are ordered by turn (null first), role and text; repeated turns
count as often as they occur. Null and empty texts or roles differ in comparison and render
alike. Turns without conv_id form one conversation. Conversations beyond `BLOCK` turns are
rendered in several consecutive chunks. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartlake.llm.common import land

BLOCK = 1024


def _words(*parts: Column) -> list[Column]:
    """Two 64-bit words of a SHA-256 over the parts."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("null")) for p in parts])
    digest = F.sha2(text, 256)
    word = lambda a: F.conv(F.substring(digest, a, 15), 16, 10).cast("long")
    return [word(1).alias("h1"), word(16).alias("h2")]


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, n, p1, p2): each turn's place from 1 and the hash of all turns up to it."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.sha2(F.coalesce(F.concat(F.lit("="), F.col("text").cast("string")), F.lit("null")), 256).alias("text"),
    ).withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / BLOCK))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    rows = rows.withColumn("_i", F.row_number().over(inside))
    totals = rows.groupBy("conv_id", "block").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select("conv_id", "block", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.block") == F.col("b.block"))
    rows = rows.alias("a").join(places.alias("b"), same).select("a.*", (F.col("_i") + F.col("_before")).alias("n"))
    rows = rows.select("conv_id", "turn", "role", "block", "n", *_words(F.col("n"), F.col("role"), F.col("text")))
    so_far = Window.partitionBy("conv_id", "block").orderBy("n")
    rows = rows.withColumn("_x1", F.bit_xor("h1").over(so_far)).withColumn("_x2", F.bit_xor("h2").over(so_far))
    totals = rows.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("_t1"), F.bit_xor("h2").alias("_t2"))
    carried = totals.select(
        "conv_id",
        "block",
        F.coalesce(F.bit_xor("_t1").over(earlier), F.lit(0)).alias("_c1"),
        F.coalesce(F.bit_xor("_t2").over(earlier), F.lit(0)).alias("_c2"),
    )
    rows = rows.alias("a").join(carried.alias("b"), same)
    return rows.select(
        "a.conv_id", "turn", "role", "n", F.col("_x1").bitwiseXOR(F.col("_c1")).alias("p1"), F.col("_x2").bitwiseXOR(F.col("_c2")).alias("p2")
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): the conversations that stay and how many equal ones they stand for."""
    hashed = land(prefixes(turns), "prefixes")
    last = hashed.groupBy("conv_id").agg(F.max(F.struct("n", "p1", "p2")).alias("l"))
    whole = last.select("conv_id", "l.n", "l.p1", "l.p2")
    key = F.struct(F.col("conv_id").isNull().alias("none"), "conv_id")
    unique = whole.groupBy("n", "p1", "p2").agg(F.min(key).alias("k"), F.count("*").alias("copies"))
    unique = unique.select("n", "p1", "p2", F.col("k.conv_id").alias("conv_id"), "copies")
    # Prefixes of the conversations that are left, their own ends excepted.
    inner = hashed.groupBy("n", "p1", "p2").agg(F.count("*").alias("rows"))
    ends = whole.groupBy("n", "p1", "p2").agg(F.count("*").alias("ends"))
    inner = inner.join(ends, ["n", "p1", "p2"], "left").where(F.col("rows") > F.coalesce("ends", F.lit(0)))
    kept = unique.join(inner, ["n", "p1", "p2"], "left_anti")
    return kept.select("conv_id", F.col("n").alias("n_turns"), "copies")


def render(turns: DataFrame, kept: DataFrame) -> DataFrame:
    """(conv_id, chunk, n_turns, text): the conversations of `kept` in the chat format, a row per chunk of BLOCK turns."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("body"),
        F.concat(F.lit("<|"), blank("role"), F.lit("|>\n"), blank("text"), F.lit("<|end|>\n")).alias("said"),
    ).withColumn("chunk", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / BLOCK))
    stay = kept.select(F.col("conv_id").alias("_stay"))
    rows = rows.join(stay, rows["conv_id"].eqNullSafe(stay["_stay"]), "left_semi")
    # Turns of equal number, role and digest are equal, so their order does not show.
    order = F.struct("turn", "role", F.sha2(F.coalesce(F.concat(F.lit("="), F.col("body")), F.lit("null")), 256).alias("d"), "said")
    parts = rows.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list(order)).alias("p"))
    return parts.select(
        "conv_id", "chunk", F.size("p").cast("long").alias("n_turns"), F.concat_ws("", F.col("p.said")).alias("text")
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """The maximal conversations, rendered."""
    return render(turns, land(maximal(turns), "maximal"))
