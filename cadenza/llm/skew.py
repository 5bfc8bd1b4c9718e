"""Joins in which a few keys may hold a large part of the rows.

A key is heavy if it has at least ``HEAVY_ROWS`` rows and at least one in ``HEAVY_KEYS`` of
all.  So there are at most ``HEAVY_KEYS`` heavy keys, whatever the data: they are joined by
broadcast, and no task gets a key's rows.  All other keys are joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_ROWS, HEAVY_KEYS = 10_000, 200_000


def least_heavy(total: int) -> int:
    """Rows from which on a key is heavy, of ``total`` rows."""
    return max(HEAVY_ROWS, total // HEAVY_KEYS)


def kept_in(left: DataFrame, right: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Rows of ``left`` whose keys are in ``right`` (a row for each key; ``n`` of the ``total`` rows of ``left`` have it)."""
    least = least_heavy(total)
    heavy = F.broadcast(right.filter(F.col("n") >= least).select(*keys))  # at most HEAVY_KEYS, as n adds up to the total at most
    rest = left.join(heavy, keys, "left_anti").join(right.filter(F.col("n") < least).select(*keys), keys, "left_semi")
    return left.join(heavy, keys, "left_semi").unionByName(rest)


def looked_up(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """``left`` joined with ``right`` (a row for each key) on ``key``; ``total``: rows of ``left``."""
    heavy = F.broadcast(left.groupBy(key).count().filter(F.col("count") >= least_heavy(total)).select(key))
    hot = left.join(F.broadcast(right.join(heavy, key, "left_semi")), key)  # at most HEAVY_KEYS rows
    return hot.unionByName(left.join(heavy, key, "left_anti").join(right, key))
