"""Keyed writes on plain Parquet, which has no merge statement. No broadcast is forced here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_if_absent(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target plus the rows whose key it lacks. ``rows`` must be unique by key."""
    new = rows.join(target.select(*key), list(key), "left_anti").select(*rows.columns)
    return target.unionByName(new, allowMissingColumns=True)


def upsert(target: DataFrame, rows: DataFrame, key: Sequence[str], stored: bool = True) -> DataFrame:
    """Target with every row replaced whose key is in ``rows``, and the new keys added.

    Both sides must be unique by key. Rows that are stored, normally a small delta, are read
    twice: their keys take rows out of the target by an anti join, which the planner turns into
    a broadcast when their measured size allows, so the target is not shuffled. Rows that would
    have to be computed twice are better met once in a full outer join, ``stored=False``.
    """
    if stored:
        kept = target.join(rows.select(*key), list(key), "left_anti").select(*target.columns)
        return kept.unionByName(rows, allowMissingColumns=True)
    wide = target.limit(0).unionByName(rows.limit(0), allowMissingColumns=True).schema

    def packed(df: DataFrame) -> Column:
        have = set(df.columns)
        return F.struct(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in wide])

    old = target.select(*key, packed(target).alias("_old"))
    new = rows.select(*key, packed(rows).alias("_new"))
    met = old.join(new, list(key), "full_outer").select(F.coalesce("_new", "_old").alias("_row"))
    return met.select("_row.*")
