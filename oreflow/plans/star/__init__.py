"""The operators on the star-schema test tables, each with the SQL that must agree with it.

The tables have their own columns, so each query first gives an operator the columns it works
on and then runs that operator, unchanged, over the whole table.
"""

from oreflow.plans.star import cleaning, days, dimensions, faults, flow, reports, storage  # noqa: F401
from oreflow.plans.star.registry import REGISTRY

__all__ = ["REGISTRY"]
