"""Choosing one row per key, and looking rows up by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _rest(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key, ties broken by the remaining columns.

    An aggregate rather than a ranking window: each task reduces its rows to one per key
    before the shuffle, so a key holding a third of the table costs no more than any other.
    """
    ranked = [*order, *[c for c in _rest(df, keys) if c not in order]]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in ranked]).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` per key: a later duplicate replaces an earlier one."""
    ranked = [*order, *[c for c in _rest(df, keys) if c not in order]]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in ranked]).select(*df.columns)


def same_key(left: Column, right: Column) -> Column:
    """Equality for a join that may meet a hot key: on the key and, redundantly, its hash.

    AQE splits a hot partition only where both sides of the join come straight from a shuffle.
    A side that an earlier join or aggregate left partitioned by the key would not be shuffled
    again and so stay whole; it is never partitioned by this pair, so it is.
    """
    return (left == right) & (F.xxhash64(left) == F.xxhash64(right))


def look_up(facts: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Left join against a table with one row per key.

    Whether ``dim`` is broadcast is decided by its size (``session.SETTINGS``); otherwise the
    join shuffles and AQE splits the partition of a hot or NULL key on the facts' side.
    """
    return facts.join(dim, same_key(facts[key], dim[dim_key]), "left")


def only_keys(table: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of a table whose key is among those of a micro-batch; AQE broadcasts the keys if they
    turn out small."""
    return table.join(keys, on, "left_semi")
