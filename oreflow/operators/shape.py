"""Projections: flatten, lineage, rename, conform, serialise."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame, parent: str, children: Sequence[str]) -> DataFrame:
    """Children of a struct as top-level text columns in place of the struct.

    A missing parent or child gives ``""``. The parent may also be JSON text, which is what
    schema inference yields when some records hold something other than an object.
    """
    if parent not in df.columns:
        return df.withColumns({c: F.lit("") for c in children})
    kind = df.schema[parent].dataType
    if isinstance(kind, T.StructType):
        known = set(kind.fieldNames())
        values = {c: F.col(f"{parent}.{c}").cast("string") if c in known else F.lit(None) for c in children}
    else:
        values = {c: F.get_json_object(F.col(parent).cast("string"), f"$.{c}") for c in children}
    return df.withColumns({c: F.coalesce(v, F.lit("")) for c, v in values.items()}).drop(parent)


def with_lineage(
    df: DataFrame, ingested_at: str, source_file: Column | None = None, partition_date: str | None = None
) -> DataFrame:
    """Where a row came from. ``ingested_at`` is one literal for the whole run."""
    added = {}
    if source_file is not None:
        added["_source_file"] = source_file
    added["_ingested_at"] = F.lit(ingested_at)
    if partition_date is not None:
        added["_partition_date"] = F.lit(partition_date)
    return df.withColumns(added)


def drop_technical(df: DataFrame) -> DataFrame:
    """Without the columns whose name starts with ``_``."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith("_")])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names)) if names else df


def conform(df: DataFrame, expected: Sequence[str], nested: Mapping[str, str] | None = None) -> DataFrame:
    """Exactly the expected columns, in order, as text; missing values and columns are ``""``.

    ``nested`` names columns to rebuild from JSON text instead, with their Spark type;
    text that does not parse becomes an empty object or list.
    """
    nested = nested or {}
    have = {f.name: f.dataType for f in df.schema.fields}

    def as_text(name: str) -> Column:
        if name not in have:
            return F.lit("")
        text = F.col(f"`{name}`").cast("string")
        if isinstance(have[name], (T.DoubleType, T.FloatType)):
            return F.when(F.isnan(f"`{name}`") | text.isNull(), "").otherwise(text)
        return F.when(text.isNull() | (text == "nan"), "").otherwise(text)

    def as_nested(name: str, spec: str) -> Column:
        target = T._parse_datatype_string(spec)
        empty = F.from_json(F.lit("[]" if isinstance(target, T.ArrayType) else "{}"), target)
        if name not in have:
            return empty
        value = F.col(f"`{name}`")
        if not isinstance(have[name], T.StringType):
            return F.coalesce(value.cast(target), empty)
        return F.coalesce(F.from_json(value, target), empty)

    return df.select(
        *[(as_nested(c, nested[c]) if c in nested else as_text(c)).alias(c) for c in expected]
    )


def stamp_date(df: DataFrame, column: str, day: Column) -> DataFrame:
    """Overwrite a date column with the day the row is replayed into."""
    return df.withColumn(column, day)


def nested_to_json(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Struct, array and map columns as JSON text, scalars untouched."""
    kinds = (T.StructType, T.ArrayType, T.MapType)
    chosen = set(columns) if columns is not None else set(df.columns)
    return df.select(
        *[
            F.to_json(f"`{f.name}`").alias(f.name)
            if f.name in chosen and isinstance(f.dataType, kinds)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
