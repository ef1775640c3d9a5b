"""Relational building blocks shared by the models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order.

    The rank filter sits right on the window, so Spark plans a group limit before
    the shuffle: each map task sends one row per key, and a hot key costs no more
    than any other.
    """
    rank = "_rank"
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) == 1).drop(rank)


def left_join_per_order(left: DataFrame, per_order: DataFrame, key: str) -> DataFrame:
    """Left join to a side that holds one row per key.

    A second key derived from the first makes Spark plan a fresh exchange under
    both inputs, although the right one comes out of an aggregation on `key`.
    Adaptive skew handling only splits join inputs that are plain exchanges; with
    it, the rows of a hot key spread over tasks while its single right-hand row
    is copied to each.
    """
    slot = "_slot"
    derive = F.hash(F.col(key))
    joined = left.withColumn(slot, derive).join(
        per_order.withColumn(slot, derive), [key, slot], "left"
    )
    return joined.drop(slot)
