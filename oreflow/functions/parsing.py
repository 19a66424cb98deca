"""Text to typed value, returning null instead of raising.

ANSI mode makes a plain cast of dirty text fail the job, and ``try_cast`` alone is too
generous: it reads ``2d`` as a double and ``2025`` as a date. Each parser therefore guards
the cast with a pattern. Ordinary text is let through by a few character tests first, because
the pattern costs several times what the cast does and validation runs it for every row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text a CSV reader treats as missing.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

NUMBER_PATTERN = (
    r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
)
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]00:00:00(\.0+)?)?$"

# Doubles at or beyond this magnitude do not fit a long.
LONG_LIMIT = 9.2e18


def blank_missing(value: Column) -> Column:
    """Null for every token that means "missing" in a CSV file."""
    return F.when(value.isin(*MISSING_TOKENS), F.lit(None)).otherwise(value)


def _is_digit(text: Column, position: int) -> Column:
    return F.substring(text, position, 1).between("0", "9")


def to_double(text: Column) -> Column:
    """Number written as text, or null when it is not one."""
    # Of what the cast reads beyond the pattern, hexadecimals have an x and suffixed numbers no
    # digit at the end. Text that the cast can't read must not reach it: it makes and drops an error for each.
    begins = _is_digit(text, 1) | F.substring(text, 1, 1).isin("-", "+", ".")
    plain = begins & _is_digit(text, -1) & ~text.contains("x") & ~text.contains("X")
    return F.when(plain | text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def whole(number: Column) -> Column:
    """Double with an integral value as a long; null for fractions, NaN and infinities."""
    fits = (F.rint(number) == number) & (F.abs(number) < F.lit(LONG_LIMIT))
    return F.when(fits, number.try_cast("long"))


def to_long(text: Column) -> Column:
    """Integer written as text; ``2`` and ``2.0`` are integers, ``2.5`` is not."""
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), text.try_cast("long")).otherwise(whole(to_double(text)))


def to_date(text: Column) -> Column:
    """ISO date (a midnight time part is allowed), or null."""
    # With both dashes in place and a digit at the end the cast admits no other form.
    dashes = (F.instr(text, "-") == 5) & (F.locate("-", text, 6) == 8)
    real = F.substring(text, 6, 2).between("01", "12") & F.substring(text, 9, 2).between("01", "31")
    plain = (F.length(text) == 10) & dashes & _is_digit(text, 10) & real
    return F.when(plain, text.try_cast("date")).when(real & text.rlike(DATE_PATTERN), F.substring(text, 1, 10).try_cast("date"))


def is_iso_date(text: Column) -> Column:
    """True for text that is exactly ``YYYY-MM-DD`` and names a real day."""
    return F.coalesce(
        text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull(),
        F.lit(False),
    )
