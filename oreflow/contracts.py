"""Row contracts as data.

A contract names the columns a source must have, how each is parsed and what the parsed value
must satisfy. Nothing here runs a job: a contract only yields column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions import parsing

Check = Callable[[Column], Column]

#: Text of a row that did not fit its header, null for others.
MALFORMED = "_malformed"
MISFIT = "row: more or fewer fields than the header"

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)
_KIND_LABEL = {"long": "not an integer", "double": "not a number", "date": "not an ISO date"}


@dataclass(frozen=True)
class Rule:
    """``holds`` gets the parsed, non-null value and says whether it is acceptable."""

    message: str
    holds: Check


@dataclass(frozen=True)
class RowRule:
    """A rule over several parsed columns, given by name; a null outcome passes."""

    message: str
    holds: Callable[[Mapping[str, Column]], Column]


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "string"  # string, long, double or date
    nullable: bool = False
    rules: tuple[Rule, ...] = ()
    normal: Check | None = None

    def parsed(self, source: T.DataType) -> Column:
        """The value as this field's kind; null when it cannot be read as one."""
        raw = F.col(f"`{self.name}`")
        text = raw if isinstance(source, T.StringType) else raw.cast("string")
        if self.kind == "long":
            if isinstance(source, _WHOLE):
                return raw.cast("long")
            return parsing.whole(raw.cast("double")) if isinstance(source, _NUMERIC) else parsing.to_long(text)
        if self.kind == "double":
            return raw.cast("double") if isinstance(source, _NUMERIC) else parsing.to_double(text)
        if self.kind == "date":
            return raw.cast("date") if isinstance(source, _TEMPORAL) else parsing.to_date(text)
        return text

    def error(self, value: Column) -> Column:
        """First thing wrong with the parsed value as text, null when it is fine."""
        raw = F.col(f"`{self.name}`")
        case = F.when(raw.isNull(), F.lit(None if self.nullable else f"{self.name}: missing").cast("string"))
        if self.kind in _KIND_LABEL:
            case = case.when(value.isNull(), f"{self.name}: {_KIND_LABEL[self.kind]}")
        for rule in self.rules:
            case = case.when(~rule.holds(value), f"{self.name}: {rule.message}")
        return case

    @property
    def messages(self) -> list[str]:
        """All that :meth:`error` can say."""
        kind = [f"{self.name}: {_KIND_LABEL[self.kind]}"] if self.kind in _KIND_LABEL else []
        missing = [] if self.nullable else [f"{self.name}: missing"]
        return [*missing, *kind, *[f"{self.name}: {r.message}" for r in self.rules]]


@dataclass(frozen=True)
class Contract:
    name: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]
    row_rules: tuple[RowRule, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def values(self, df: DataFrame) -> dict[str, Column]:
        """What each field's value is."""
        types = {f.name: f.dataType for f in df.schema.fields}
        return {f.name: f.parsed(types[f.name]) for f in self.fields}

    def errors(self, df: DataFrame, values: Mapping[str, Column] | None = None) -> list[Column]:
        """One expression per field and row rule: the message of what is wrong, or null.

        ``values`` are the parsed fields; without them the expressions parse, each for itself.
        """
        values = values or self.values(df)
        found = [f.error(values[f.name]) for f in self.fields]
        if MALFORMED in df.columns:
            found.insert(0, F.when(F.col(MALFORMED).isNotNull(), MISFIT))
        return found + [F.when(~rule.holds(values), F.lit(rule.message)) for rule in self.row_rules]

    @property
    def messages(self) -> list[str]:
        """All that can be wrong with a row."""
        return [MISFIT, *[m for f in self.fields for m in f.messages], *[r.message for r in self.row_rules]]

    def typed(self, df: DataFrame, values: Mapping[str, Column] | None = None) -> DataFrame:
        """Numbers as numbers. Text and dates stay as they came, extra columns too."""
        values = values or self.values(df)
        numbers = {f.name for f in self.fields if f.kind in ("long", "double")}
        return df.select(*[values[c].alias(c) if c in numbers else F.col(f"`{c}`") for c in df.columns])

    def normalize(self, df: DataFrame) -> DataFrame:
        """The values the contract itself would return: lower case, defaults filled in."""
        changed = {f.name: f.normal(F.col(f"`{f.name}`")) for f in self.fields if f.normal}
        return df.withColumns(changed) if changed else df

    def with_amount_bounds(self, low: float, high: float, amount: Callable[[Mapping[str, Column]], Column]) -> Contract:
        """The same contract, also refusing rows whose amount lies outside ``[low, high]``."""
        rule = RowRule(f"amount: not in [{low}, {high}]", lambda v: amount(v).between(low, high))
        return replace(self, row_rules=(*self.row_rules, rule))


def at_least_zero() -> Rule:
    return Rule("must be >= 0", lambda v: v >= 0)


def positive() -> Rule:
    return Rule("must be > 0", lambda v: v > 0)


def one_of(values: tuple[str, ...], ignore_case: bool = True) -> Rule:
    listed = ", ".join(values)
    # Most values are as listed; only others are put in lower case, which costs more than the comparison.
    return Rule(f"not one of {listed}", lambda v: v.isin(*values) | F.lower(v).isin(*values) if ignore_case else v.isin(*values))


def contains(piece: str) -> Rule:
    return Rule(f"has no {piece}", lambda v: v.contains(piece))


# Order states.
ORDER_STATES = ("pending", "shipped", "delivered", "cancelled", "returned")
EXPORT_STATES = ("shipped", "pending", "delivered", "cancelled")
DEFAULT_TIER = "standard"

# Columns and rules of the three sources.
ORDERS = Contract(
    "orders",
    ("order_id",),
    (
        Field("order_id"),
        Field("customer_id"),
        Field("product_id"),
        Field("order_date", "date"),
        Field("quantity", "long", rules=(positive(),)),
        Field("unit_price", "double", nullable=True, rules=(at_least_zero(),)),
        Field("status", rules=(one_of(ORDER_STATES),), normal=F.lower),
    ),
)

CUSTOMERS = Contract(
    "customers",
    ("customer_id",),
    (
        Field("customer_id"),
        Field("first_name"),
        Field("last_name"),
        Field("email", rules=(contains("@"),), normal=F.lower),
        Field("city"),
        Field("country"),
        Field("signup_date", "date"),
        Field("tier", nullable=True, normal=lambda v: F.coalesce(v, F.lit(DEFAULT_TIER))),
    ),
)

PRODUCTS = Contract(
    "products",
    ("product_id",),
    (
        Field("product_id"),
        Field("name"),
        Field("category"),
        Field("unit_cost", "double", nullable=True, rules=(at_least_zero(),)),
        Field("supplier_id"),
        Field("updated_at"),
    ),
)


@dataclass(frozen=True)
class ExportShape:
    """Column lists of the text exports the quality reports read."""

    name: str
    columns: tuple[str, ...]
    optional: tuple[str, ...] = ()
    nested: Mapping[str, str] = field(default_factory=dict)


# Columns of the exports.
EXPORT_ORDERS = ExportShape(
    "orders",
    ("order_id", "customer_id", "product_id", "order_date", "amount", "currency", "status", "quantity"),
    optional=("promotion_code",),
)
EXPORT_CUSTOMERS = ExportShape(
    "customers",
    ("customer_id", "name", "email", "signup_date", "address", "phones"),
    nested={
        "address": "struct<street:string,city:string,state:string,zip:string>",
        "phones": "array<string>",
    },
)
EXPORT_PRODUCTS = ExportShape("products", ("product_id", "name", "category", "price", "updated_at"))
