"""Merkle manifest of a dataset: a tree per group of rows, and a tree over the groups.

Nodes are rows (group, place, count of nodes at this level, digest). Every level joins the nodes
with themselves on the computed index of a sibling: place XOR 1 for trees of two, a shifted slot
for wider ones. Each node thus gets the digests left and right of it in its run, and the rows
in slot zero emit the parents of the next level. Levels are written tables, so that a lost
executor costs one level and lineage stays short; a level has half the rows of the one below. Proofs
are handed down from the top: a node's path is its own siblings and its parent's path, so
the joins shrink by half per level too, instead of looking up every level for every leaf.

Places come from a range partitioning by group and order columns: a row's place in its sorted
partition, less the group's first one there, plus the group's rows in earlier partitions. Only
one row per (partition, group) is summed, so no group is gathered in one task.

Results for odd input: null fields are written as `-`. Null group values form the first group,
null order values come first. Rows that tie on the order columns are placed by digest; equal rows
are leaves side by side, one each. Rows without doc_id are never tampered with. Extra columns
are ignored. A table without rows has no leaves and no root: no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cartlake.llm.common import bounded, land

FANOUT = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:binary,right:binary>>"
PART_ROWS = 1 << 16  # nodes of a level per task and file; upper levels are small whatever the session's partitions
_PLACE = (1 << 33) - 1  # the low bits of an increasing id number the rows of a partition


def digest(hex_text: Column) -> Column:
    return F.unhex(F.sha2(hex_text, 256))


def as_hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def field(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return digest(F.concat(*[field(c) for c in columns]))


def placed(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with `_part` and `_at`, starts) of landed rows, to number them within their group.

    starts has one row per (part, group): `_first` is the group's first `_at` there, `_before` how
    many rows it has in earlier parts and `n` how many it has in all. Row ids break ties, so a
    value that a third of the rows share is spread over partitions too.
    """
    keys = [group, *order, "_row"]
    ranged = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    numbered = land(ranged.withColumn("_id", at).drop("_row"), "placed")
    numbered = numbered.select(
        "*", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit(_PLACE)).alias("_at")
    ).drop("_id")
    held = numbered.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count("*").alias("c"))
    # One row per part and group: a group's window holds at most as many rows as there are parts.
    own = Window.partitionBy(group)
    before = F.sum("c").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c")
    starts = held.select("_part", group, "_first", before.alias("_before"), F.sum("c").over(own).alias("n"))
    return numbered, land(starts, "starts")


def with_siblings(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """nodes(g, place, n, digest) with `left` and `right`: digests of the other nodes of the run, joined."""
    place, slot = F.col("place"), F.pmod(F.col("place"), F.lit(fanout))
    other = nodes.select(F.col("g").alias("_g"), F.col("place").alias("_p"), F.col("digest").alias("_d"))
    found, left, right = nodes, [], []
    for shift in range(1, fanout):
        # Slots wrap around: a shift that passes the end of the run meets the slots before this one.
        sibling = place.bitwiseXOR(F.lit(1)) if fanout == 2 else place - slot + F.pmod(slot + shift, F.lit(fanout))
        own = other.select("_g", "_p", F.col("_d").alias(f"_d{shift}"))
        found = found.join(own, (F.col("g") == own["_g"]) & (sibling == own["_p"]), "left").drop("_g", "_p")
        there = F.coalesce(F.col(f"_d{shift}"), F.lit(b""))
        wraps = slot + shift >= fanout
        left.append(F.when(wraps, there).otherwise(F.lit(b"")))
        right.append(F.when(wraps, F.lit(b"")).otherwise(there))
    return found.select(
        "g", "place", "n", "digest",
        (F.concat(*left) if left else F.lit(b"")).alias("left"),
        (F.concat(*right) if right else F.lit(b"")).alias("right"),
    )


def parents(level: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Nodes of the next level, made by the rows in slot zero; a group's last node has no parent."""
    heads = level.where((F.col("n") > 1) & (F.pmod("place", F.lit(fanout)) == 0))
    return heads.select(
        "g",
        F.floor(F.col("place") / fanout).cast("long").alias("place"),
        F.ceil(F.col("n") / fanout).cast("long").alias("n"),
        digest(as_hex(F.concat("digest", "right"))).alias("digest"),
    )


@dataclass
class Level:
    """A landed level and the most rows it can have."""

    nodes: DataFrame
    rows: int

    def dealt(self, df: DataFrame) -> DataFrame:
        return df.coalesce(-(-self.rows // PART_ROWS))


def levels(leaves: DataFrame, most: int, total: int, groups: int, fanout: int = FANOUT) -> list[Level]:
    """Landed levels from the leaves up; `most` is the largest of the groups, total that of all leaves."""
    found, nodes, rows = [], leaves, total
    while True:
        level = Level(with_siblings(nodes, fanout), rows)
        level.nodes = land(level.dealt(level.nodes), "level")
        found.append(level)
        if most <= 1:
            return found
        nodes, most = parents(level.nodes, fanout), -(-most // fanout)
        rows = min(rows, rows // fanout + groups)  # each group rounds up once


def roots(tree: list[Level]) -> DataFrame:
    """(g, root) of each group."""
    ends = [level.nodes.where("n = 1").select("g", F.col("digest").alias("root")) for level in tree]
    return reduce(DataFrame.unionByName, ends)


def paths(tree: list[Level], fanout: int = FANOUT) -> DataFrame:
    """(g, place, path) of the leaves: (left, right) digests, level by level up to the group's root."""
    upper = None
    for level in reversed(tree):
        own = F.struct("left", "right")
        if upper is None:
            upper = level.nodes.select("g", "place", F.array().cast(PATH).alias("path"))
            continue
        above = upper.select(F.col("g").alias("_g"), F.col("place").alias("_p"), F.col("path").alias("_path"))
        up = F.floor(F.col("place") / fanout).cast("long")
        joined = level.nodes.join(above, (F.col("g") == F.col("_g")) & (up == F.col("_p")) & (F.col("n") > 1), "left")
        path = F.when(F.col("n") > 1, F.concat(F.array(own), F.col("_path")))
        upper = level.dealt(joined.select("g", "place", F.coalesce(path, F.array().cast(PATH)).alias("path")))
    return upper


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path give."""
    return F.aggregate(
        path, leaf, lambda own, step: digest(as_hex(F.concat(step["left"], own, step["right"])))
    )


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    altered: dict[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """One row per row of docs: `order`, leaf, subroot, root, path, other_leaf (digests as bytes).

    A leaf is the digest of its fields. altered maps fields to the values to check in their place;
    other_leaf is the digest with these, to be folded along the path of the given rows.
    """
    altered = altered or {}
    given = [F.col(f) for f in fields]
    rows = docs.select(
        F.col(group).cast("string").alias("_group"),
        F.col(order).alias("_order"),
        leaf_digest(given).alias("digest"),
        (leaf_digest([altered.get(f, F.col(f)) for f in fields]) if altered else F.lit(None).cast("binary")).alias("_other"),
    )
    numbered, starts = placed(land(rows, "leaves"), "_group", ["_order", "digest"])

    # Groups are numbered in the same way: their number is their place in the upper tree.
    groups = land(starts.groupBy("_group").agg(F.max("n").alias("n")).withColumn("_all", F.lit(0)), "groups")
    listed, first = placed(groups, "_all", ["_group"])
    first = first.select("_part", "_first", "_before", F.col("n").alias("total"))
    listed = listed.join(bounded(first), "_part")
    listed = land(listed.select("_group", "n", (F.col("_at") - F.col("_first") + F.col("_before")).alias("g"), "total"), "groups")
    sizes = listed.agg(F.max("n").alias("most"), F.sum("n").alias("rows"), F.max("total").alias("groups")).first()
    if sizes.most is None:
        digests = T.StructType([T.StructField(c, T.BinaryType()) for c in ("leaf", "subroot", "root", "other_leaf")])
        nothing = T.StructType([docs.schema[order], *digests.fields, T.StructField("path", T._parse_datatype_string(PATH))])
        return docs.sparkSession.createDataFrame([], nothing)

    same = starts["_group"].eqNullSafe(listed["_group"])
    starts = starts.join(bounded(listed.select("_group", "g")), same).select("_part", starts["_group"], "_first", "_before", "n", "g")
    starts = land(starts, "starts").withColumnRenamed("_group", "_own").withColumnRenamed("_part", "_p")
    where = (F.col("_part") == F.col("_p")) & F.col("_group").eqNullSafe(F.col("_own"))
    leaves = numbered.join(bounded(starts), where).select(
        "g", (F.col("_at") - F.col("_first") + F.col("_before")).alias("place"), "n", "digest", "_order", "_other"
    )
    leaves = land(leaves, "numbered")
    tree = levels(leaves.select("g", "place", "n", "digest"), sizes.most, sizes.rows, sizes.groups, fanout)

    tops = roots(tree).join(listed.select("g", "total"), "g")
    tops = tops.select(
        F.lit(0).cast("long").alias("g"), F.col("g").alias("place"), F.col("total").alias("n"), F.col("root").alias("digest")
    )
    tops = land(Level(tops, sizes.groups).dealt(tops), "subroots")
    upper = levels(tops, sizes.groups, sizes.groups, 1, fanout)
    over = paths(upper, fanout).join(roots(upper), "g")  # the upper tree has one group, so one root
    over = over.select(F.col("place").alias("g"), F.col("path").alias("_over"), "root")
    over = land(over.join(tops.select(F.col("place").alias("g"), F.col("digest").alias("subroot")), "g"), "upper-paths")

    found = leaves.join(paths(tree, fanout), ["g", "place"]).join(bounded(over), "g")
    return found.select(
        F.col("_order").alias(order), F.col("digest").alias("leaf"), "subroot", "root",
        F.col("_other").alias("other_leaf"), F.concat("path", "_over").alias("path"),
    )
