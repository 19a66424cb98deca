"""Dimensions and the fact."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.contracts import Field
from oreflow.functions.hashing import row_hash
from oreflow.operators.shape import drop_technical
from oreflow.operators.upsert import upsert

# The end of open versions, the fields whose change opens one, the columns of a history.
HIGH_DATE = "9999-12-31"
TRACKED = ("city", "country", "email")
HISTORY_COLUMNS = ("_eff_start", "_eff_end", "_current", "_row_hash")


def scd1(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: Sequence[str],
    updated_at: str,
    mode: str = "upsert",
) -> DataFrame:
    """Latest state per key. ``replace`` keeps only what came in, ``upsert`` the rest as well."""
    if mode not in ("upsert", "replace"):
        raise ValueError(f"mode must be 'upsert' or 'replace', got {mode!r}")
    rows = drop_technical(incoming).withColumn("_updated_at", F.lit(updated_at))
    return rows if existing is None or mode == "replace" else upsert(existing, rows, key)


def scd2_open(incoming: DataFrame, tracked: Sequence[str], effective_date: str) -> DataFrame:
    """Every incoming row as the open version of its key."""
    rows = drop_technical(incoming)
    return rows.withColumns(
        {
            "_eff_start": F.lit(effective_date),
            "_eff_end": F.lit(HIGH_DATE),
            "_current": F.lit(True),
            "_row_hash": row_hash(tracked, rows.columns),
        }
    )


def scd2_merge(
    current: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    effective_date: str,
) -> DataFrame:
    """Open rows of the dimension merged with a snapshot of the source.

    ``current`` holds the open rows only: history never enters the join, so its cost follows
    the number of keys and not the age of the dimension. Both sides are unique by key. One
    full outer join settles all cases and each pair yields one or two rows:

    ====================  =================================================
    only in dimension     stays open
    only in snapshot      opens
    equal hash            old row stays, untracked changes are not taken
    different hash        old row closes on ``effective_date``, new row opens
    ====================  =================================================

    ``effective_date`` must not lie before the start of a row that it closes: merges follow the order of
    time. A row that would end before it starts is closed on its own start, an interval of no length.
    """
    opened = scd2_open(incoming, tracked, effective_date)
    types = {f.name: f.dataType for f in opened.schema.fields} | {f.name: f.dataType for f in current.schema.fields}
    names = [*[c for c in types if c not in HISTORY_COLUMNS], *HISTORY_COLUMNS]

    def packed(df: DataFrame) -> Column:
        have = set(df.columns)
        return F.struct(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(types[c]).alias(c) for c in names])

    closing = {"_eff_end": F.greatest(F.lit(effective_date), F.col("_old._eff_start").cast("string")), "_current": F.lit(False)}
    old = current.select(*key, packed(current).alias("_old"))
    new = opened.select(*key, packed(opened).alias("_new"))
    pair = old.join(new, list(key), "full_outer")

    closed = F.struct(*[closing[c].alias(c) if c in closing else F.col(f"_old.`{c}`") for c in names])
    versions = (
        F.when(F.col("_new").isNull(), F.array("_old"))
        .when(F.col("_old").isNull(), F.array("_new"))
        .when(F.col("_old._row_hash") != F.col("_new._row_hash"), F.array(closed, F.col("_new")))
        .otherwise(F.array("_old"))
    )
    return pair.select(F.inline(versions))


def scd2_changes(current: DataFrame, opened: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys for which a version opens: those that ``current`` lacks or has with another hash.

    Keys and hashes alone meet; no other column is read from stored sides. A null key is a key like others.
    """
    columns = [*key, "_row_hash"]
    return opened.select(*columns).join(_as_marks(current, columns), _meets(columns), "left_anti").select(*key)


def scd2_apply(current: DataFrame, opened: DataFrame, changes: DataFrame, key: Sequence[str], effective_date: str) -> DataFrame:
    """The open rows of :func:`scd2_merge`, given the keys for which a version opens.

    ``changes`` should be stored: when it is small the planner makes it a broadcast, and no row of a side moves.
    """
    marks = _as_marks(changes, key)
    met = F.col("_met").isNotNull()
    closing = {
        "_eff_end": F.when(met, F.greatest(F.lit(effective_date), F.col("_eff_start").cast("string"))).otherwise(F.col("_eff_end")),
        "_current": ~met & F.col("_current"),
    }
    kept = current.join(marks.withColumn("_met", F.lit(True)), _meets(key), "left").withColumns(closing).select(*[f"`{c}`" for c in current.columns])
    types = {f.name: f.dataType for f in current.schema.fields}
    fresh = opened.join(marks, _meets(key), "left_semi")
    fresh = fresh.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in opened.columns])
    rows = kept.unionByName(fresh, allowMissingColumns=True)
    return rows.select(*[f"`{c}`" for c in rows.columns if c not in HISTORY_COLUMNS], *HISTORY_COLUMNS)


def _as_marks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"_mark_{n}") for n, c in enumerate(columns)])


def _meets(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.col(f"_mark_{n}")) for n, c in enumerate(columns)])


def fact_orders(silver: DataFrame) -> DataFrame:
    """Order lines with a timestamp and the line total; a missing price gives a null total."""
    rows = drop_technical(silver)
    day = Field("order_date", "date").parsed(rows.schema["order_date"].dataType)
    return rows.withColumns(
        {
            "order_date": day.cast("timestamp"),
            "total_amount": F.col("quantity") * F.col("unit_price"),
        }
    )
