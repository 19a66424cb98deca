"""Split rows by a contract.

Each field is read once and all that is wrong with a row becomes one list. Both stand behind a step that the
optimizer can't fold into the filters and columns that use them, so nothing is read a second time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from oreflow.contracts import EXPORT_STATES, Contract
from oreflow.functions import parsing

REASON = "_quarantine_reason"
#: The same as a list, for counting: a message may hold the text's separator.
REASONS = "_quarantine_reasons"
QUARANTINED_AT = "_quarantined_at"
#: Begins the names of the columns that hold what the fields mean, while rows are judged.
VALUE = "_value_"
GOOD = "_good"


def judged(df: DataFrame, contract: Contract) -> DataFrame:
    """The rows with a column ``_value_<field>`` for each parsed field, and ``_quarantine_reasons``, empty for a good row."""
    values = F.struct(*[v.alias(VALUE + name) for name, v in contract.values(df).items()])
    # Expressions are not merged across a generator, here of one row: each is computed once.
    read = df.select("*", F.inline(F.array(values)))
    return read.select("*", F.explode(F.array(_said(contract.errors(df, values_of(contract))))).alias(REASONS))


def _said(errors: list[Column]) -> Column:
    """The errors that aren't null, as a list.

    ``array_compact`` is a function with a lambda, so Spark doesn't compile it, nor anything it is made of. Joined lists of one or
    none are compiled, and need no set of what was met as the difference of arrays does.
    """
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(e.isNull(), none).otherwise(F.array(e)) for e in errors])


def values_of(contract: Contract) -> dict[str, Column]:
    """The parsed fields of judged rows."""
    return {f.name: F.col(f"`{VALUE}{f.name}`") for f in contract.fields}


def _plain(rows: DataFrame, *more: str) -> DataFrame:
    return rows.drop(*[c for c in rows.columns if c.startswith(VALUE)], *more)


def _good(rows: DataFrame, contract: Contract, typed: bool = True) -> DataFrame:
    return _plain(contract.typed(rows, values_of(contract)) if typed else rows, REASONS)


def _bad(rows: DataFrame, quarantined_at: str | None) -> DataFrame:
    bad = _plain(rows).withColumn(REASON, F.array_join(REASONS, "; "))
    bad = bad.select(*[F.col(f"`{c}`") for c in bad.columns if c != REASONS], REASONS)
    return bad if quarantined_at is None else bad.withColumn(QUARANTINED_AT, F.lit(quarantined_at))


def good_rows(df: DataFrame, contract: Contract, typed: bool = True) -> DataFrame:
    """Rows that meet the contract, otherwise unchanged (numbers typed unless told not to)."""
    return _good(judged(df, contract).where(F.size(REASONS) == 0), contract, typed)


def bad_rows(df: DataFrame, contract: Contract, quarantined_at: str | None = None) -> DataFrame:
    """Rows that break the contract, as they came, with every reason."""
    return _bad(judged(df, contract).where(F.size(REASONS) > 0), quarantined_at)


@dataclass(frozen=True)
class Split:
    """Rows split by a contract: the good ones, the bad ones, and how many there are of each and of each reason."""

    good: DataFrame
    bad: DataFrame
    rows: int
    refused: int
    reasons: dict[str, int]


def split(
    df: DataFrame, contract: Contract, path: str | None = None, quarantined_at: str | None = None, store: Callable[[DataFrame], DataFrame | None] | None = None
) -> Split:
    """Judge the rows in one pass and one write to ``path``, which both sides and the counts are read from.

    The outcome is a column and no folder: rows written by folder are sorted first, and a task with many rows spills. Counts come
    from the stored outcomes and reasons alone, a row for each list of reasons; observed metrics aren't compiled and cost more than the judging.

    Rows that are stored already are not written a second time: with ``store``, which keeps the bad rows and returns them as stored, or None
    if there are none, each side judges the rows for itself, which costs less than that write and its readers.
    """
    if store is not None:
        kept = store(bad_rows(df, contract, quarantined_at))
        outcomes = [] if kept is None else _outcomes(kept)
        return Split(good_rows(df, contract), bad_rows(df, contract, quarantined_at), df.count(), sum(r["n"] for r in outcomes), _listed(outcomes, contract))
    rows = judged(df, contract).withColumn(GOOD, F.size(REASONS) == 0)
    rows = rows.drop(*[VALUE + f.name for f in contract.fields if f.kind not in ("long", "double")])
    rows.write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.schema(rows.schema).parquet(path)
    outcomes = _outcomes(stored)
    sides = [stored.where(F.col(GOOD) == side).drop(GOOD) for side in (True, False)]
    total, refused = sum(r["n"] for r in outcomes), sum(r["n"] for r in outcomes if r[REASONS])
    return Split(_good(sides[0], contract), _bad(sides[1], quarantined_at), total, refused, _listed(outcomes, contract))


def _outcomes(rows: DataFrame) -> list[Row]:
    return rows.groupBy(REASONS).agg(F.count("*").alias("n")).collect()  # lists of reasons, however many rows


def _listed(outcomes: list[Row], contract: Contract) -> dict[str, int]:
    counts = {m: sum(r["n"] for r in outcomes if m in r[REASONS]) for m in contract.messages}
    return {m: n for m, n in counts.items() if n}


def reason_counts(bad: DataFrame) -> DataFrame:
    """How often each single reason occurs, most frequent first.

    Rows are counted by their whole list of reasons first: there are only as many lists as there
    are combinations of broken rules.
    """
    combined = bad.groupBy(REASONS).agg(F.count("*").alias("n"))
    single = combined.select(F.explode(REASONS).alias("reason"), "n")
    return single.groupBy("reason").agg(F.sum("n").alias("rows")).orderBy(F.desc("rows"), "reason")


def exported_order_class(amount: str = "amount", status: str = "status", quantity: str = "quantity"):
    """First defect of an exported order, ``ok`` for none.

    Amounts are text here. One that cannot be read is skipped by this classification, though
    :func:`exported_order_is_bad` counts it.
    """
    value = parsing.to_double(F.col(amount).cast("string"))
    return (
        F.when(F.coalesce(value < 0, F.lit(False)), "negative_amount")
        .when(~F.coalesce(F.col(status).isin(*EXPORT_STATES), F.lit(False)), "unknown_status")
        .when(F.coalesce(F.col(quantity).cast("string") == "0", F.lit(False)), "zero_quantity")
        .otherwise("ok")
    )


def exported_order_is_bad(amount: str = "amount", status: str = "status", quantity: str = "quantity"):
    """Amount unreadable or negative, state unknown (case counts), or quantity ``0``."""
    value = parsing.to_double(F.col(amount).cast("string"))
    return (
        value.isNull()
        | F.coalesce(value < 0, F.lit(False))
        | ~F.coalesce(F.col(status).isin(*EXPORT_STATES), F.lit(False))
        | F.coalesce(F.col(quantity).cast("string") == "0", F.lit(False))
    )


def exported_customer_is_bad(name: str = "name", email: str = "email"):
    """No name, or an e-mail without ``@`` or with one at either end."""
    address = F.coalesce(F.col(email), F.lit(""))
    return (
        F.col(name).isNull()
        | ~address.contains("@")
        | address.startswith("@")
        | address.endswith("@")
    )
