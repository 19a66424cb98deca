"""Hash expressions: change detection and reproducible selection.

Selection never uses ``rand``: its value depends on how the rows are partitioned, whereas a
hash of the row's own key gives the same pick on one core and on a thousand executors.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAWS = 1 << 32
_SLOT_DIGITS = 8


def row_hash(tracked: Iterable[str], present: Iterable[str]) -> Column:
    """md5 over the tracked columns in alphabetical order.

    A column the frame lacks counts as ``""`` and a null as ``None``, so that no two
    different rows collapse to one text because of a skipped null.
    """
    have = set(present)
    parts = [
        F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("None")) if name in have else F.lit("")
        for name in sorted(tracked)
    ]
    return F.md5(F.concat_ws("|", *parts))


def draw(keys: Sequence[Column], seed: int, slot: int = 0) -> Column:
    """Uniform integer in [0, 2**32) from the row's key; slots 0 to 3 are independent."""
    text = F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    digits = F.substring(F.md5(text), 1 + slot * _SLOT_DIGITS, _SLOT_DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def chosen(keys: Sequence[Column], seed: int, rate: float, slot: int = 0) -> Column:
    """True for a share ``rate`` of the rows, however small."""
    return draw(keys, seed, slot) < F.lit(round(rate * DRAWS))


def pick(values: Sequence[str], number: Column) -> Column:
    """One of ``values`` by a number from :func:`draw`."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (number % len(values) + 1).cast("int"))
