"""Fault injection on exported orders and customers.

Each fault is a set of column expressions. Rows are selected by a hash of their own key, so a
run is reproducible and does not depend on partitioning, and no row-level Python is involved.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.functions.hashing import chosen, draw, pick
from oreflow.operators.dedup import first_per_group
from oreflow.operators.shape import nested_to_json

Patch = Callable[[Column, Mapping[str, object]], Mapping[str, Column]]

# Texts a corrupted row receives.
UNKNOWN_STATES = ("warped", "unknown", "in_transit_maybe", "??")
ORGANIC_STATES = ("warped", "unknown", "??")
INVALID_EMAILS = ("not-an-email", "missing@", "@nodomain")
FUTURE_DAYS = 365
PROMOTION_CODES = ("SPRING", "LOYAL5", "FIRSTBUY", "")


@dataclass(frozen=True)
class Template:
    """One kind of fault. ``changes`` maps a random number and the settings to new columns."""

    template_id: str
    kind: str  # order or customer
    description: str
    changes: Patch
    duplicate: bool = False


def _negative_amount(column: str = "amount") -> Column:
    """The amount with a minus sign; what is no finite number stays as it is."""
    text = F.trim(F.col(column).cast("string"))
    number = F.abs(text.try_cast("double")) < float("inf")
    return F.when(number, F.concat(F.lit("-"), F.regexp_replace(text, "^[+-]", ""))).otherwise(F.col(column).cast("string"))


def _set(column: str, value: object) -> Patch:
    return lambda number, settings: {column: F.lit(value)}


def _future_signup(number: Column, settings: Mapping[str, object]) -> dict[str, Column]:
    """A year after the first day of the run, or after the day of the fault if that is not set."""
    start = F.lit(settings["start_date"]) if "start_date" in settings else F.col("date")
    return {"signup_date": F.date_add(start.cast("date"), FUTURE_DAYS).cast("string")}


# Template ids and descriptions.
TEMPLATES = {
    t.template_id: t
    for t in (
        Template("ORD_NEG_AMOUNT", "order", "Negative amount", lambda n, s: {"amount": _negative_amount()}),
        Template("ORD_ZERO_QTY", "order", "Zero quantity", _set("quantity", "0")),
        Template("ORD_BAD_STATUS", "order", "Unrecognised status", lambda n, s: {"status": pick(UNKNOWN_STATES, n)}),
        Template("ORD_EMPTY_ID", "order", "Empty order_id", _set("order_id", "")),
        Template("ORD_NO_CURRENCY", "order", "Missing currency", _set("currency", "")),
        Template("ORD_NULL_PRODUCT", "order", "Null product_id", _set("product_id", "")),
        Template("ORD_DUPLICATE", "order", "Duplicate order", lambda n, s: {}, duplicate=True),
        Template("CUST_BAD_EMAIL", "customer", "Invalid email", lambda n, s: {"email": pick(INVALID_EMAILS, n)}),
        Template("CUST_MISSING_NAME", "customer", "Missing name", _set("name", None)),
        Template("CUST_EMPTY_ADDR", "customer", "Empty address", _set("address", None)),
        Template("CUST_FUTURE_SIGNUP", "customer", "Future signup_date", _future_signup),
        Template("CUST_DUPLICATE", "customer", "Duplicate customer", lambda n, s: {}, duplicate=True),
    )
}

# Templates of the round-robin plan.
FIXED_TEMPLATES = ("ORD_NEG_AMOUNT", "ORD_ZERO_QTY", "ORD_BAD_STATUS", "CUST_BAD_EMAIL", "CUST_MISSING_NAME")


def corrupt_orders(df: DataFrame, key: Sequence[str], rate: float, seed: int = 42) -> DataFrame:
    """A share of the orders gets one of three faults: amount, state or quantity."""
    keys = [F.col(k) for k in key]
    hit, fault = chosen(keys, seed, rate), draw(keys, seed, 1) % 3
    return df.withColumns(
        {
            "amount": F.when(hit & (fault == 0), _negative_amount()).otherwise(F.col("amount")),
            "status": F.when(hit & (fault == 1), pick(ORGANIC_STATES, draw(keys, seed, 2))).otherwise(F.col("status")),
            "quantity": F.when(hit & (fault == 2), F.lit("0")).otherwise(F.col("quantity")),
        }
    )


def corrupt_customers(df: DataFrame, key: Sequence[str], rate: float, seed: int = 42) -> DataFrame:
    """A share of the customers gets an invalid e-mail or loses the name."""
    keys = [F.col(k) for k in key]
    hit, fault = chosen(keys, seed, rate), draw(keys, seed, 1) % 2
    return df.withColumns(
        {
            "email": F.when(hit & (fault == 0), pick(INVALID_EMAILS, draw(keys, seed, 2))).otherwise(F.col("email")),
            "name": F.when(hit & (fault == 1), F.lit(None)).otherwise(F.col("name")),
        }
    )


def widen_from(
    df: DataFrame, key: Sequence[str], day: str, start: str, after: int, column: str = "promotion_code", values: Sequence[str] = PROMOTION_CODES, seed: int = 42
) -> DataFrame:
    """An optional column that rows carry from the ``after``-th day of the run on (counted from 0)."""
    begun = F.datediff(F.col(day).cast("date"), F.lit(start).cast("date")) >= after
    return df.withColumn(column, F.when(begun, pick(values, draw([F.col(k) for k in key], seed))))


def _template_kind(template_id: Column) -> Column:
    return F.when(template_id.startswith("ORD_"), "order").otherwise("customer")


def _as_plan(df: DataFrame) -> DataFrame:
    return df.select("date", F.col("seq").cast("int").alias("seq"), "template_id", _template_kind(F.col("template_id")).alias("type"))


def plan_fixed(days: DataFrame, templates: Sequence[str] = FIXED_TEMPLATES) -> DataFrame:
    """Templates dealt out over the days in turn.

    ``days`` comes from :func:`oreflow.operators.days.day_range`. With ``n`` days template
    ``j`` goes to day ``j mod n``; each day picks its own from the constant list.
    """
    listed = F.posexplode(F.array(*[F.lit(t) for t in templates])).alias("j", "template_id")
    dealt = days.select("date", "day_index", "n_days", listed)
    turn = F.floor(F.col("j") / F.col("n_days")) + 1
    return _as_plan(dealt.where(F.col("j") % F.col("n_days") == F.col("day_index")).withColumn("seq", turn))


def plan_random(days: DataFrame, low: int, high: int, seed: int = 42, templates: Sequence[str] = tuple(TEMPLATES)) -> DataFrame:
    """Between ``low`` and ``high`` templates per day, drawn with replacement."""
    count = F.lit(low) + draw([F.col("date")], seed) % (high - low + 1)
    slots = days.select("date", count.alias("n")).where("n > 0").select("date", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("seq"))
    return _as_plan(slots.withColumn("template_id", pick(templates, draw([F.col("date"), F.col("seq")], seed, 1))))


def plan_schedule(days: DataFrame, schedule: Mapping[str, Sequence[str]]) -> DataFrame:
    """The templates a schedule names for each of the days."""
    case = F.lit(None).cast("array<string>")
    for day, listed in schedule.items():
        case = F.when(F.col("date") == day, F.array(*[F.lit(t) for t in listed])).otherwise(case)
    return _as_plan(days.select("date", F.posexplode(case).alias("pos", "template_id")).withColumn("seq", F.col("pos") + 1))


def fault_plan(
    days: DataFrame,
    mode: str,
    low: int = 1,
    high: int = 2,
    seed: int = 42,
    templates: Sequence[str] | None = None,
    schedule: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """A plan by mode. ``templates`` replaces the list of the first two, ``schedule`` is what ``per_day`` follows."""
    if mode == "fixed":
        return plan_fixed(days, templates or FIXED_TEMPLATES)
    if mode == "random":
        return plan_random(days, low, high, seed, templates or tuple(TEMPLATES))
    if mode == "per_day":
        if schedule is None:
            raise ValueError("mode 'per_day' needs a schedule")
        return plan_schedule(days, schedule)
    raise ValueError(f"mode must be 'fixed', 'random' or 'per_day', got {mode!r}")


def _in_turn(base: DataFrame, most: int, group: list[str]) -> DataFrame:
    """Base rows, numbered in ``_nth``, for each place of a plan they serve: their own and every later one in turn."""
    sized = base.withColumn("_size", F.count("*").over(Window.partitionBy(*group)).cast("int"))
    return sized.withColumn("_place", F.explode(F.sequence(F.col("_nth"), F.lit(most), F.col("_size"))))


def inject(
    rows: DataFrame,
    plan: DataFrame,
    kind: str,
    key: str,
    day: str,
    seed: int = 42,
    settings: Mapping[str, object] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Add one faulty row per planned entry; returns all rows and the log of what was added.

    The base row of an entry is taken from the same day, or from any day where its own has no
    rows; the added row then gets the entry's day. Only without any row at all is nothing added, and
    the log says so by an entry without payload.

    Of a day only as many rows, those of smallest hash, can be needed as the longest day of the plan
    has entries. That number comes from the plan, and rows are cut to it before the shuffle. Each
    of them then offers itself for its own place in the plan and, on a day with fewer rows than
    entries, for every later place in turn; rows and entries meet by (day, place) alone.
    Added rows have a new key unless the template repeats a row. Columns that begin with ``_`` are
    left out of the log.
    """
    settings = settings or {}
    wanted = plan.where(F.col("type") == kind)
    by_day = Window.partitionBy("date").orderBy("seq", "template_id")
    placed = wanted.withColumn("_place", F.row_number().over(by_day))
    # The longest day of a plan: settings decide it, never the data.
    most = placed.agg(F.max("_place")).first()[0] or 1
    hashed = rows.withColumn("_h", draw([F.col(key)], seed, 3))
    base = first_per_group(hashed, [day], [F.col("_h"), F.col(key)], most, rank="_nth", spread=["_h"])
    base = _in_turn(base, most, [day])
    base = base.withColumn("date", F.col(day).cast("string")) if day != "date" else base
    spare = hashed.orderBy("_h", key).limit(most).withColumn("_nth", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_h", key)))
    spare = _in_turn(spare, most, [F.lit(0)]).drop("date") if day != "date" else _in_turn(spare, most, [F.lit(0)]).drop(day)
    own = placed.join(base, ["date", "_place"])
    bare = placed.join(rows.select(F.col(day).cast("string").alias("date")).distinct(), "date", "left_anti")
    lent = bare.join(spare, "_place").withColumn(day, F.col("date").cast(rows.schema[day].dataType))
    unmet = bare.join(spare.select("_place"), "_place", "left_anti")
    met = own.select(lent.columns).unionByName(lent)

    number = draw([F.col("date"), F.col("seq")], seed, 2)
    mine = [t for t in TEMPLATES.values() if t.kind == kind]
    fresh = ~F.col("template_id").isin(*[t.template_id for t in mine if t.duplicate])
    changed: dict[str, Column] = {
        key: F.when(fresh, F.concat(F.col(key).cast("string"), F.lit("-"), F.col("seq").cast("string"))).otherwise(F.col(key).cast("string"))
    }
    text: Column = F.lit(None).cast("string")
    for template in mine:
        this = F.col("template_id") == template.template_id
        text = F.when(this, template.description).otherwise(text)
        for column, value in template.changes(number, settings).items():
            if column in rows.columns:
                kept = changed.get(column, F.col(column))
                changed[column] = F.when(this, value.cast(rows.schema[column].dataType)).otherwise(kept)
    patched = met.withColumns({**changed, "_text": text})
    added = patched.select(*rows.columns)
    payload = F.to_json(F.struct(*[c for c in rows.columns if not c.startswith("_")]))

    def entries(df: DataFrame, described: Column, shown: Column) -> DataFrame:
        return df.select(
            F.col("date").cast("string").alias("date"),
            F.lit("template").alias("source"),
            "template_id",
            F.lit(kind).alias("type"),
            described.alias("description"),
            shown.alias("payload"),
        )

    log = entries(patched, F.col("_text"), payload).unionByName(entries(unmet, text, F.lit(None).cast("string")))
    return rows.unionByName(added), log


def replay_log(rows: DataFrame, kind: str, day: str) -> DataFrame:
    """Log entries of replayed rows, in the layout of :func:`inject`."""
    nested = nested_to_json(rows)
    return nested.select(
        F.col(day).cast("string").alias("date"),
        F.lit("parquet").alias("source"),
        F.lit(None).cast("string").alias("template_id"),
        F.lit(kind).alias("type"),
        F.lit(None).cast("string").alias("description"),
        F.to_json(F.struct(*nested.columns)).alias("payload"),
    )
