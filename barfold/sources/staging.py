"""Bringing a source into the shape of its target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold.schema import TableSpec


def conform(source: DataFrame, target: T.StructType | TableSpec) -> DataFrame:
    """The target's fields from ``source``, in its order and types.

    Other source columns are ignored; a field the source lacks is an error.
    """
    schema = target.schema if isinstance(target, TableSpec) else target
    missing = [f.name for f in schema.fields if f.name not in source.columns]
    if missing:
        raise ValueError(f"source lacks the fields {missing}")
    return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stage(source: DataFrame, spec: TableSpec) -> DataFrame:
    """``source`` in the types of ``spec``; types are native, so nothing turns into text."""
    return conform(source, spec)


def iso_text(frame: DataFrame, fraction_digits: int = 0) -> DataFrame:
    """``frame`` with dates and timestamps as ISO text, for sinks that hold only text."""
    fraction = "." + "S" * fraction_digits if fraction_digits else ""
    patterns = {
        T.DateType: "yyyy-MM-dd",
        T.TimestampType: f"yyyy-MM-dd HH:mm:ss{fraction}",
        T.TimestampNTZType: f"yyyy-MM-dd HH:mm:ss{fraction}",
    }
    text = {
        f.name: F.date_format(f.name, patterns[type(f.dataType)])
        for f in frame.schema.fields if type(f.dataType) in patterns
    }
    return frame.withColumns(text) if text else frame


def key_values(source: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """The distinct values of each key; a key that is not a column is skipped."""
    return {k: source.select(k).distinct() for k in keys if k in source.columns}
