"""Joins by order: the last row before another, and aggregates of all rows before it.

No pair is formed. Both sides are put in one order by range partitions, so a key of any size is spread
over tasks; each partition is passed over once, and what its rows leave for the next
partition, one row per key, is carried on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barfold.operators.maintain import has_key
from barfold.sources.scratch import materialise

_AT, _SIDE, _SPAN = "_at", "_side", "_span"

# How partial results of an aggregate add up.
_MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def _spans(rows: DataFrame, keys: list[str], falling: bool) -> tuple[DataFrame, Window, Window]:
    """``rows`` with the number of their span, the window up to a row in its span, and that over earlier spans.

    Rows of one place and side are in one span. They are written once, so all later steps see the same ranges.
    """
    at = F.col(_AT).desc() if falling else F.col(_AT)
    ranged = materialise(
        rows.repartitionByRange(*keys, at, _SIDE).withColumn(_SPAN, F.spark_partition_id()))
    before = Window.partitionBy(_SPAN, *keys).orderBy(at, _SIDE)
    earlier = Window.partitionBy(*keys).orderBy(_SPAN).rowsBetween(Window.unboundedPreceding, -1)
    return ranged, before, earlier


def asof(left: DataFrame, right: DataFrame, on: tuple[str, str], by: Mapping[str, str] | Sequence[str] = (),
         columns: Sequence[str] | None = None, direction: str = "previous", strict: bool = False) -> DataFrame:
    """``left`` with ``columns`` of the nearest row of ``right`` at or before it, null where there is none.

    ``on`` names the ordinal of the left and the right side, ``by`` the equal columns (left to right, or
    those of one name). ``'next'`` looks at or after; ``strict`` leaves equal ordinals out. A null key or
    ordinal matches nothing. Two right rows of one key and ordinal raise. Repeated left rows all stay.
    """
    if direction not in ("previous", "next"):
        raise ValueError(f"direction must be previous or next, not {direction!r}")
    by = dict(by) if isinstance(by, Mapping) else {k: k for k in by}
    columns = list(columns) if columns is not None else [c for c in right.columns if c not in by.values()]
    clash = set(columns) & set(left.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are on both sides")
    keys = [f"_key_{n}" for n in range(len(by))]

    def side(rows: DataFrame, names: Sequence[str], ordinal: str, place: int, held: dict[str, Column]) -> DataFrame:
        named = [F.col(c).alias(k) for c, k in zip(names, keys, strict=True)]
        return rows.where(has_key([*names, ordinal])).select(
            *named, F.col(ordinal).alias(_AT), F.lit(place).alias(_SIDE), *[v.alias(n) for n, v in held.items()])

    first, second = (0, 1) if strict else (1, 0)
    row, value = F.struct(*left.columns), F.struct(*columns)
    rows = side(left, list(by), on[0], first, {"_row": row}).unionByName(
        side(right, list(by.values()), on[1], second, {"_value": value}), allowMissingColumns=True)
    spans, before, earlier = _spans(rows, keys, direction == "next")
    tie = F.raise_error(F.lit(f"{on[1]} is not unique within {', '.join(by.values()) or 'the table'}"))
    twice = (F.lag(_SIDE).over(before) == F.col(_SIDE)) & (F.lag(_AT).over(before) == F.col(_AT))
    # The test is part of what is carried, so that it is run.
    once = F.when(F.col("_twice") & F.col("_row").isNull(), tie).otherwise(F.col("_value"))
    found = spans.withColumn("_twice", F.coalesce(twice, F.lit(False))).select(
        _SPAN, *keys, "_row", F.last(once, True).over(before.rowsBetween(Window.unboundedPreceding, 0)).alias("_near"))
    last = F.max_by if direction == "previous" else F.min_by
    closing = spans.groupBy(_SPAN, *keys).agg(
        last("_value", F.when(F.col("_value").isNotNull(), F.col(_AT))).alias("_closing"))
    carried = closing.select(_SPAN, *keys, F.last("_closing", True).over(earlier).alias("_carried"))
    near = F.coalesce("_near", "_carried")
    matched = found.join(carried, [_SPAN, *keys]).where("_row is not null").select(
        "_row.*", *[near[c].alias(c) for c in columns])
    return matched.unionByName(left.where(~has_key([*by, on[0]])), allowMissingColumns=True)


def aggregate_up_to(table: DataFrame, params: DataFrame, on: tuple[str, str], agg: Mapping[str, tuple[str, str]],
                    equal: Mapping[str, str] | None = None, falling: bool = False, strict: bool = False) -> DataFrame:
    """``params`` with aggregates of the table rows on one side of a bound, one row per parameter row.

    ``on`` names the table's column and the parameter's bound; counted are rows at or below the bound, at or above it
    if ``falling``, without those at it if ``strict``. ``agg`` maps a name to (``count``, ``sum``, ``min`` or ``max``,
    column); ``equal`` maps table to parameter columns. A null bound or key matches nothing. Table rows
    are combined per place before any shuffle.
    """
    unknown = {kind for kind, _ in agg.values()} - _MERGES.keys()
    if unknown:
        raise ValueError(f"no running aggregate {sorted(unknown)}")
    equal = dict(equal or {})
    keys = [f"_key_{n}" for n in range(len(equal))]
    partials = {f"_agg_{n}": kind for n, (kind, _) in enumerate(agg.values())}
    named = [F.col(c).alias(k) for c, k in zip(equal, keys, strict=True)]
    places = table.where(has_key([*equal, on[0]])).groupBy(*named, F.col(on[0]).alias(_AT)).agg(
        *[getattr(F, kind)(F.col(c)).alias(n) for n, (kind, c) in zip(partials, agg.values(), strict=True)])
    asked = params.where(has_key([*equal.values(), on[1]])).select(
        *[F.col(c).alias(k) for c, k in zip(equal.values(), keys, strict=True)],
        F.col(on[1]).cast(table.schema[on[0]].dataType).alias(_AT), F.struct(*params.columns).alias("_row"))
    first, second = (0, 1) if strict else (1, 0)
    rows = asked.withColumn(_SIDE, F.lit(first)).unionByName(
        places.withColumn(_SIDE, F.lit(second)), allowMissingColumns=True)
    spans, before, earlier = _spans(rows, keys, falling)
    before = before.rowsBetween(Window.unboundedPreceding, 0)
    here = spans.select(_SPAN, *keys, "_row", *[_MERGES[kind](n).over(before).alias(n) for n, kind in partials.items()])
    totals = spans.groupBy(_SPAN, *keys).agg(*[_MERGES[kind](n).alias(n) for n, kind in partials.items()])
    carried = totals.select(_SPAN, *keys, *[
        _MERGES[kind](n).over(earlier).alias(f"_before{n}") for n, kind in partials.items()])

    def both(name: str, kind: str) -> Column:
        one, two = F.col(name), F.col(f"_before{name}")
        if kind in ("min", "max"):
            return (F.least if kind == "min" else F.greatest)(one, two)
        return F.coalesce(one + two, one, two)

    def whole(kind: str, value: Column) -> Column:
        return F.coalesce(value, F.lit(0)).cast("long") if kind == "count" else value

    answered = here.where("_row is not null").join(carried, [_SPAN, *keys]).select(
        "_row.*", *[whole(kind, both(n, kind)).alias(name) for (n, kind), name in zip(partials.items(), agg, strict=True)])
    open_ = params.where(~has_key([*equal.values(), on[1]])).withColumns(
        {name: F.lit(0).cast("long") for name, (kind, _) in agg.items() if kind == "count"})
    return answered.unionByName(open_, allowMissingColumns=True)


def drop_unchanged_append(stored: DataFrame, batch: DataFrame, ordinal: str, keys: Sequence[str],
                          check: Sequence[str] | None = None) -> DataFrame:
    """``drop_unchanged`` of ``stored`` and ``batch`` together, where ``stored`` alone holds no repeated row.

    Only the stored rows directly before and after each new one are looked up and compared; so late rows, and stored
    rows that now repeat a new one, are found too, while other rows and keys are only read. Ordinals must be
    unique within a key, over both. Other rules are those of ``drop_unchanged``.
    """
    keys = list(keys)
    check = list(check) if check is not None else [c for c in stored.columns if c != ordinal]
    compared = [c for c in check if c not in keys]
    loose = [*keys, ordinal]
    new = materialise(batch.select(*stored.columns))
    touched = stored.where(has_key(loose)).join(new.select(*keys).distinct(), keys, "left_semi") if keys else stored
    # Every stored row with a new row between it and the next or the previous stored one.
    marks = new.where(has_key(loose)).select(*keys, F.col(ordinal).alias("_new"))
    value = F.struct(*stored.columns)
    near = touched.select(*[F.col(k).alias(f"_by_{k}") for k in keys], F.col(ordinal).alias("_held"), value.alias("_whole"))
    by = {k: f"_by_{k}" for k in keys}
    sides = [asof(marks, near, ("_new", "_held"), by, ["_whole"], direction) for direction in ("previous", "next")]
    around = reduce(DataFrame.unionByName, sides).where("_whole is not null").select("_whole.*").distinct()
    rows = materialise(
        around.withColumn("_fresh", F.lit(False)).unionByName(new.where(has_key(loose)).withColumn("_fresh", F.lit(True))))
    earlier = rows.select(*[F.col(k).alias(f"_by_{k}") for k in keys], F.col(ordinal).alias("_held"),
                          F.struct("_fresh", *compared).alias("_previous"))
    rows = asof(rows, earlier, (ordinal, "_held"), by, ["_previous"], strict=True)
    kinds = {f.name: f.dataType.simpleString() for f in stored.schema.fields}

    def same(c: str) -> Column:
        here, there = F.col(c), F.col(f"_previous.{c}")
        if kinds[c] == "string":
            return F.coalesce(here, F.lit("")) == F.coalesce(there, F.lit(""))
        return here.eqNullSafe(there)

    # Two stored rows side by side here need not be neighbours, so at least one of a pair is new.
    repeats = (
        F.when(F.col("_previous").isNull(), False)
        .when(~(F.col("_fresh") | F.col("_previous._fresh")), False)
        .otherwise(~reduce(or_, [~same(c) for c in compared], F.lit(False)))
    )
    judged = materialise(rows.withColumn("_gone", repeats).select(*stored.columns, "_fresh", "_gone"))
    gone = judged.where("_gone and not _fresh").select(*keys, ordinal)
    added = judged.where("_fresh and not _gone").select(*stored.columns)
    kept = stored.join(gone, [*keys, ordinal], "left_anti").select(*stored.columns)
    return kept.unionByName(added).unionByName(new.where(~has_key(loose)))
