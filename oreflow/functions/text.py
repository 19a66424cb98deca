"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreflow.functions.parsing import is_iso_date

ISO_DAY = r"\d{4}-\d{2}-\d{2}"


def email_domain(email: Column) -> Column:
    """What follows the last ``@``; ``invalid`` when there is none, null for null."""
    return F.when(email.contains("@"), F.element_at(F.split(email, "@"), -1)).when(
        email.isNotNull(), F.lit("invalid")
    )


def folder_regex(pattern: str) -> str:
    """Regular expression for folder names such as ``dt={date}``; group 1 is the day."""
    before, _, after = pattern.partition("{date}")
    return f"^{re.escape(before)}({ISO_DAY}){re.escape(after)}$"


def folder_date(name: Column, pattern: str = "dt={date}") -> Column:
    """Day held in a partition folder name; null unless the whole name fits."""
    day = F.regexp_extract(name, folder_regex(pattern), 1)
    return F.when(is_iso_date(day), day)
