"""Keyed changes of whole tables, as DataFrame expressions.

Each operator returns the new table. None needs a shuffle of the target while the
source is small enough for Spark to broadcast its keys; beyond that the joins are
sort-merge joins on the key, whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold.sources.scratch import materialise
from barfold.sources.staging import conform

# Rows of one key that one task may order; longer keys are cut into spans.
ROWS_PER_SPAN = 1_000_000


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def has_key(key: Sequence[str]) -> Column:
    return _all([F.col(k).isNotNull() for k in key])


def delete_matching(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` without the rows whose ``keys`` occur in ``source``.

    A null key matches nothing. With no keys at all every row goes if ``source``
    has any row.
    """
    if not keys:
        return target.join(source.limit(1).select(), F.lit(True), "left_anti")
    listed = source.select(*keys).where(has_key(keys)).distinct()
    return target.join(listed, list(keys), "left_anti").select(*target.columns)


def _new_rows(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct source rows in the target's shape that have a key; two different rows
    with one key raise.

    Grouping by the key alone drops repeated rows before the shuffle and leaves the
    result partitioned the way the joins on the key need it.
    """
    if not key:
        raise ValueError("the target has no primary key")
    rest = [c for c in target.columns if c not in key]
    keyed = conform(source, target.schema).where(has_key(key))
    if not rest:
        return keyed.distinct()
    # Column by column, so that Spark can hash: a struct would have to be sorted.
    rows = keyed.groupBy(*key).agg(F.count("*").alias("_rows"), *[
        f(c).alias(f"_{n}_{c}") for c in rest
        for n, f in (("low", F.min), ("high", F.max), ("known", F.count))
    ])
    agree = _all([
        F.col(f"_low_{c}").eqNullSafe(F.col(f"_high_{c}")) & F.col(f"_known_{c}").isin(0, F.col("_rows"))
        for c in rest
    ])
    clash = F.raise_error(F.concat(F.lit("different source rows share the key "),
                                   F.to_json(F.struct(*key))))
    return rows.where(F.when(agree, True).otherwise(clash)).select(
        *[F.col(c) if c in key else F.col(f"_low_{c}").alias(c) for c in target.columns]
    )


def one_per_key(rows: DataFrame, key: Sequence[str], run: Sequence[str]) -> DataFrame:
    """The distinct rows that have a key; two different rows with one key raise.

    Rows are told apart by the one before them in the order of the key within ``run``, the columns of the key
    whose rows one task may order; rows that are already dealt out by them are not shuffled.
    """
    ordered = Window.partitionBy(*run).orderBy(*([k for k in key if k not in run] or key))
    rows = rows.where(has_key(key)).withColumn("_previous", F.lag(F.struct(*rows.columns)).over(ordered))

    def repeats(columns: Sequence[str]) -> Column:
        return _all([F.col(c).eqNullSafe(F.col(f"_previous.{c}")) for c in columns])

    first = F.col("_previous").isNull() | ~repeats(key)
    clash = F.raise_error(F.concat(F.lit("different source rows share the key "),
                                   F.to_json(F.struct(*key))))
    kept = F.when(first, True).when(repeats(rows.columns[:-1]), False).otherwise(clash)
    return rows.where(kept).drop("_previous")


def insert_absent(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """``target`` plus the distinct source rows whose non-null key it does not hold."""
    rows = _new_rows(target, source, key)
    # Narrowing the target to the source's keys first keeps a large target in place.
    wanted = source.select(*key).where(has_key(key)).distinct()
    held = target.select(*key).join(wanted, list(key), "left_semi")
    added = rows.join(held, list(key), "left_anti")
    return target.unionByName(added)


def replace_by(target: DataFrame, source: DataFrame, by: Sequence[str] | str,
               key: Sequence[str]) -> DataFrame:
    """Delete the target rows whose ``by`` values occur in the source, then insert.

    ``by`` is one column or several; the insert still goes by the primary key.
    """
    by = [by] if isinstance(by, str) else list(by)
    kept = delete_matching(target, source, by)
    if by and set(by) <= set(key):
        # A kept row cannot hold a source row's key: it would have been deleted.
        return kept.unionByName(_new_rows(target, source, key))
    return insert_absent(kept, source, key)


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Replace whole rows by primary key and add the new ones."""
    return replace_by(target, source, list(key), key)


def _same(column: T.StructField) -> Column:
    here, previous = F.col(column.name), F.col(f"_previous.{column.name}")
    if not column.nullable:
        return here == previous
    if isinstance(column.dataType, T.StringType):
        return F.coalesce(here, F.lit("")) == F.coalesce(previous, F.lit(""))
    return here.eqNullSafe(previous)


def _in_spans(rows: DataFrame, ordinal: str, keys: Sequence[str], limit: int) -> DataFrame:
    """``rows`` with the number of their ``_span``, null for keys of up to ``limit`` rows.

    Longer keys are range partitioned by key and ordinal, so spans hold about as many rows each
    however the ordinals lie, and follow each other in the order of the ordinal. They are written
    once, so that every later step sees the same ranges.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    long_keys = materialise(counted.select(*keys))
    if long_keys.isEmpty():
        return rows.withColumn("_span", F.lit(None).cast("long"))
    ranged = materialise(
        rows.join(long_keys, list(keys), "left_semi")
        .repartitionByRange(*keys, ordinal)
        .withColumn("_span", F.spark_partition_id().cast("long"))
    )
    short = rows.join(long_keys, list(keys), "left_anti")
    return ranged.unionByName(short.withColumn("_span", F.lit(None).cast("long")))


def drop_unchanged(table: DataFrame, ordinal: str, keys: Sequence[str],
                   check: Sequence[str] | None = None, schema: T.StructType | None = None,
                   rows_per_span: int = ROWS_PER_SPAN) -> DataFrame:
    """``table`` without the rows that repeat the one before them.

    Rows of one key are ordered by ``ordinal``; a row goes when all ``check`` columns
    (default: all but the ordinal) equal those of the row directly before it. Null
    and empty text are equal; a null number equals only null. ``schema`` tells which
    columns cannot be null. A row with a null key or ordinal has no predecessor and
    is none. The ordinal must be unique within a key.

    The rows per key are counted first. Keys with more than ``rows_per_span`` are cut
    into spans of the ordinal, and the last row of each span is carried to the next,
    so no task orders a long key alone.
    """
    fields = {f.name: f for f in (schema or table.schema).fields}
    check = list(check) if check is not None else [c for c in table.columns if c != ordinal]
    compared = [fields[c] for c in check if c not in keys]
    loose = [c for c in [*keys, ordinal] if fields[c].nullable]
    rows = table.where(has_key(loose)) if loose else table
    run = list(keys)
    if not run:
        run, rows = ["_table"], rows.withColumn("_table", F.lit(0))

    rows = _in_spans(rows, ordinal, run, rows_per_span)
    cut = [*run, "_span"]
    seen = F.struct(ordinal, *[f.name for f in compared])
    closing = (
        rows.where(F.col("_span").isNotNull())
        .groupBy(*cut).agg(F.max_by(seen, ordinal).alias("_closing"))
    )
    series = Window.partitionBy(*run).orderBy("_span")
    carried = closing.select(*cut, F.lag("_closing").over(series).alias("_carried"))
    previous = F.coalesce(F.lag(seen).over(Window.partitionBy(*cut).orderBy(ordinal)), "_carried")
    rows = rows.join(carried, cut, "left").withColumn("_previous", previous)

    tie = F.raise_error(F.lit(f"{ordinal} is not unique within {', '.join(keys) or 'the table'}"))
    repeats = (
        F.when(F.col("_previous").isNull(), False)
        .when(F.col(f"_previous.{ordinal}") == F.col(ordinal), tie)
        .otherwise(_all([_same(f) for f in compared]))
    )
    kept = rows.where(~F.coalesce(repeats, F.lit(False))).select(*table.columns)
    return kept.unionByName(table.where(~has_key(loose))) if loose else kept
