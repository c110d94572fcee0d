"""Dictionary tables: stable integer ids for the values of a column."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold.schema import ENUM_PREFIX, is_dictionary
from barfold.sources.scratch import materialise

log = logging.getLogger(__name__)

# monotonically_increasing_id keeps the row number in the low 33 bits.
_ROW_BITS = 33


def extend_enum(enum: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """The dictionary plus the new non-null values of ``column``.

    New values get ``max(id) + 1, + 2, ...`` in ascending order. They are range
    partitioned and sorted, so each is numbered by its place in its partition plus
    the rows of the partitions before; only those counts, one per partition, meet in
    one task. The numbering must not be computed twice on different range bounds,
    hence the checkpoint between the two steps.
    """
    value_type = enum.schema["value"].dataType
    known = enum.select("value")
    fresh = (
        source.select(F.col(column).cast(value_type).alias("value"))
        .where(F.col("value").isNotNull())
        .distinct()
        .join(known, "value", "left_anti")
        .repartitionByRange("value")
        .sortWithinPartitions("value")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    fresh = materialise(fresh).select(
        "value",
        F.shiftright("_place", _ROW_BITS).alias("_part"),
        F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fresh.groupBy("_part").agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    top = F.coalesce(enum.agg(F.max("id")).scalar(), F.lit(0))
    added = fresh.join(F.broadcast(offsets), "_part").select(
        (top + F.col("_offset") + F.col("_row") + 1).cast("long").alias("id"), "value"
    )
    return enum.select("id", "value").unionByName(added)


def enums_of(tables: Mapping[str, DataFrame], frame: DataFrame) -> dict[str, str]:
    """Columns of ``frame`` that have a dictionary, with its table name, in name order."""
    found = {n[len(ENUM_PREFIX):]: n for n in sorted(tables)
             if is_dictionary(n, tables[n].columns)}
    return {c: n for c, n in found.items() if c in frame.columns}


def extend_enums(tables: Mapping[str, DataFrame], source: DataFrame) -> dict[str, DataFrame]:
    """:func:`extend_enum` for every dictionary whose column ``source`` has.

    A dictionary that fails is reported and left out of the result; the others go on.
    """
    extended = {}
    for column, name in enums_of(tables, source).items():
        try:
            extended[name] = extend_enum(tables[name], source, column)
        except Exception:  # noqa: BLE001 - one bad dictionary must not stop the rest
            log.exception("dictionary %s was not extended", name)
    return extended


def encode_enums(frame: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``frame`` with every column that has a dictionary replaced by its id.

    A value the dictionary does not hold, and null, become null; a value held more
    than once gets its lowest id. Spark broadcasts a dictionary while its size
    allows and else joins by a shuffle on the value.
    """
    for column, name in enums_of(tables, frame).items():
        ids = (
            tables[name].where(F.col("value").isNotNull())
            .groupBy(F.col("value").alias(column)).agg(F.min("id").alias("_id"))
        )
        order = frame.columns
        frame = (
            frame.join(ids, column, "left")
            .drop(column).withColumnRenamed("_id", column)
            .select(*order)
        )
    return frame


def _unpivoted(frame: DataFrame, kinds: Mapping[str, T.DataType], keep: list[str] | None = None) -> DataFrame:
    """``column`` and its value of each row and column of ``kinds``, one ``_<type>`` column per type of value, others null."""
    types = sorted({k.simpleString() for k in kinds.values()})
    values = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[
            (F.col(c) if kind.simpleString() == t else F.lit(None)).cast(t).alias(f"_{n}") for n, t in enumerate(types)])
        for c, kind in kinds.items()]))
    places = [f"_{n}" for n in range(len(types))]
    held = reduce(or_, [F.col(p).isNotNull() for p in places])
    return frame.select(*(keep or []), values.alias("v")).select(*(keep or []), "v.*").where(held)


def _known(tables: Mapping[str, DataFrame], names: Mapping[str, str]) -> tuple[DataFrame, dict[str, T.DataType]]:
    """All dictionaries in the form of :func:`_unpivoted`, with ``id``; and the type of each one's values."""
    kinds = {c: tables[n].schema["value"].dataType for c, n in names.items()}
    types = sorted({k.simpleString() for k in kinds.values()})
    rows = [
        tables[n].where(F.col("value").isNotNull()).select(
            F.lit(c).alias("column"),
            *[(F.col("value") if kinds[c].simpleString() == t else F.lit(None)).cast(t).alias(f"_{k}") for k, t in enumerate(types)],
            "id")
        for c, n in names.items()
    ]
    return reduce(DataFrame.unionAll, rows), kinds


def extend_enums_at_once(tables: Mapping[str, DataFrame], source: DataFrame) -> dict[str, DataFrame]:
    """:func:`extend_enum` for every dictionary whose column ``source`` has, in one pass over it.

    The columns are stacked to rows of column and value, so that there is one scan, one range exchange and one
    numbering for any number of columns. A value's id is its place among its column's new values.
    """
    names = enums_of(tables, source)
    if not names:
        return {}
    known, kinds = _known(tables, names)
    places = [c for c in known.columns if c.startswith("_")]
    found = _unpivoted(source.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()]), kinds).distinct()
    same = [F.col(f"f.{p}").eqNullSafe(F.col(f"k.{p}")) for p in ["column", *places]]
    fresh = materialise(
        found.alias("f").join(known.alias("k"), reduce(and_, same), "left_anti")
        .repartitionByRange("column", *places).sortWithinPartitions("column", *places)
        .withColumn("_place", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_place", _ROW_BITS))
    before = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per column and partition.
    offsets = (
        fresh.groupBy("column", "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
        .select("column", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    tops = known.groupBy("column").agg(F.max("id").alias("_top"))
    # Ids of null values count as well, as they do one by one.
    highest = reduce(DataFrame.unionAll, [
        tables[n].agg(F.max("id").alias("_top")).select(F.lit(c).alias("column"), "_top") for c, n in names.items()])
    tops = tops.unionByName(highest).groupBy("column").agg(F.coalesce(F.max("_top"), F.lit(0)).alias("_top"))
    numbered = materialise(
        fresh.join(offsets, ["column", "_part"]).join(tops, "column").select(
            "column", *places, (F.col("_top") + F.col("_offset") + F.col("_place") - F.col("_first") + 1).cast("long").alias("id")))
    types = sorted({k.simpleString() for k in kinds.values()})
    return {
        name: tables[name].select("id", "value").unionByName(
            numbered.where(F.col("column") == c).select(
                "id", F.col(f"_{types.index(kinds[c].simpleString())}").alias("value")))
        for c, name in names.items()
    }


def encode_enums_at_once(frame: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """:func:`encode_enums` for any number of columns with the same exchanges, for dictionaries too large to broadcast.

    Rows are numbered and stacked to column and value; each value meets its id in one join, and one aggregate
    per row number puts the row together again. Values that many rows hold are split by the adaptive skew join.
    """
    names = enums_of(tables, frame)
    if not names:
        return frame
    known, kinds = _known(tables, names)
    places = [c for c in known.columns if c.startswith("_")]
    ids = materialise(known.groupBy("column", *places).agg(F.min("id").alias("_id")))
    rows = materialise(frame.withColumn("_row", F.monotonically_increasing_id()))
    cast = rows.select("_row", *[F.col(c).cast(k).alias(c) for c, k in kinds.items()])
    stacked = _unpivoted(cast, kinds, ["_row"])
    same = [F.col(f"s.{p}").eqNullSafe(F.col(f"k.{p}")) for p in ["column", *places]]
    met = stacked.alias("s").join(ids.alias("k"), reduce(and_, same)).select("s._row", "s.column", "k._id")
    encoded = met.groupBy("_row").agg(*[
        F.max(F.when(F.col("column") == c, F.col("_id"))).alias(f"_id_{n}") for n, c in enumerate(names)])
    place = {c: f"_id_{n}" for n, c in enumerate(names)}
    return rows.join(encoded, "_row", "left").select(
        *[F.col(place[c]).alias(c) if c in place else F.col(c) for c in frame.columns])
