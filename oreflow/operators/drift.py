"""Schema drift, decided from column names alone (no job)."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame

from oreflow.errors import SchemaError

log = logging.getLogger(__name__)


def drift(actual: Iterable[str], expected: Iterable[str]) -> tuple[list[str], list[str]]:
    """Columns that came on top and columns that are missing, both sorted."""
    have, want = set(actual), set(expected)
    return sorted(have - want), sorted(want - have)


def require_columns(df: DataFrame, expected: Iterable[str], source: str) -> list[str]:
    """Extra columns are reported and kept; a missing one ends the stage."""
    added, missing = drift(df.columns, expected)
    if added:
        log.warning("schema drift in %s: extra columns %s are carried along", source, added)
    if missing:
        raise SchemaError(f"schema drift in {source}: required columns missing {missing}")
    return added


def widen(narrow: DataFrame, wide: DataFrame) -> DataFrame:
    """Both frames under the wider column list, absent columns null."""
    return narrow.unionByName(wide, allowMissingColumns=True)
