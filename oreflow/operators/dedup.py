"""Row choice within groups.

Every operator here ranks and keeps the first few rows of a group. Spark turns
``row_number() <= n`` into a group limit that also runs before the shuffle, so of a key that
holds a third of all rows each map task sends at most ``n`` rows on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"
#: Spark's own default for its limit below the shuffle.
_MAP_SIDE_LIMIT, _PARTS = 1000, 64


def first_per_group(df: DataFrame, group: Sequence[str | Column], order: Sequence[Column], n: int = 1, rank: str | None = None, spread: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows of each group in the given total order, optionally with their rank.

    Spark limits groups before the shuffle up to a certain ``n``. For a larger one groups are first
    cut in parts, by a hash of the columns ``spread``, all by default, so that no task ranks a whole hot group.
    """
    name = rank or _RANK
    if n > _MAP_SIDE_LIMIT:
        part = Window.partitionBy(*group, F.pmod(F.hash(*(spread or df.columns)), F.lit(_PARTS))).orderBy(*order)
        df = df.withColumn(name, F.row_number().over(part)).where(F.col(name) <= n).drop(name)
    by = Window.partitionBy(*group).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(by)).where(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in the order of the named columns."""
    return first_per_group(df, list(key), [F.desc_nulls_last(c) for c in order])


def top_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows of the whole frame, for previews."""
    return df.orderBy(*order).limit(n)


def distinct_days(df: DataFrame, column: str = "date") -> DataFrame:
    return df.select(column).distinct().orderBy(column)
