"""Reads that steer an incremental run, and parameterised reads."""

from __future__ import annotations

import math
from collections.abc import Mapping
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold.functions.series import not_nan
from barfold.functions.spans import position
from barfold.operators.ordered import aggregate_up_to
from barfold.schema import EARLIEST, KEY, LATEST, ON, VOLUME
from barfold.sources.scratch import materialise


def get_return(returns: DataFrame, start: date = EARLIEST, end: date = LATEST) -> DataFrame:
    """Rows with ``start <= Date <= end``."""
    return returns.where(F.col(ON).between(F.lit(start), F.lit(end)))


def _volume_filter(name: str) -> Column:
    change = F.col(VOLUME)
    filters = {"nonzero": change != 0, "positive": change > 0, "notnull": change.isNotNull()}
    if name not in filters:
        raise ValueError(f"volume_filter must be one of {sorted(filters)}, not {name!r}")
    return filters[name]


def max_date(stocks: DataFrame, returns: DataFrame, before: date | None = EARLIEST,
             volume_filter: str = "nonzero", default: date | None = EARLIEST) -> DataFrame:
    """Per security, the date an incremental fetch resumes from.

    That is its latest date strictly before ``before`` (any date if None) whose
    volume change passes ``volume_filter``, or ``default``. The volume of a return
    row is a change, so ``'positive'`` skips the days on which volume fell.
    """
    moved = returns.where(_volume_filter(volume_filter))
    if before is not None:
        moved = moved.where(F.col(ON) < F.lit(before))
    latest = moved.groupBy(KEY).agg(F.max(ON).alias("_latest"))
    found = F.col("_latest") if default is None else F.coalesce("_latest", F.lit(default))
    return (
        stocks.select(KEY, "id_yahoo")
        .join(latest, KEY, "left")
        .select(KEY, "id_yahoo", found.alias(ON))
    )


def last_date(stocks: DataFrame, returns: DataFrame, prices: DataFrame,
              last_prices: DataFrame, with_symbol: bool = False) -> DataFrame:
    """Last return date, last price date and last close of the securities with a last price."""
    last_return = returns.groupBy(KEY).agg(F.max(ON).alias("_return"))
    last_level = prices.groupBy(KEY).agg(
        F.max(ON).alias("_price"), F.max_by("close", ON).alias("_close")
    )
    return (
        stocks.select(KEY, *(["id_yahoo"] if with_symbol else []))
        .join(last_prices.select(KEY), KEY, "left_semi")
        .join(last_return, KEY, "left")
        .join(last_level, KEY, "left")
        .select(
            KEY, *(["id_yahoo"] if with_symbol else []),
            F.coalesce("_return", F.lit(EARLIEST)).alias("last_return_date"),
            F.coalesce("_price", F.lit(EARLIEST)).alias("last_price_date"),
            F.coalesce("_close", F.lit(0.0)).alias("last_close"),
        )
    )


# Bounds of a range condition: the parameter columns of its lower and upper end, None for no end.
Ends = tuple[str | None, str | None]


def param_query(table: DataFrame, params: DataFrame | None,
                equal: Mapping[str, str] | None = None,
                between: Mapping[str, Ends] | None = None,
                within: Mapping[str, Ends] | None = None,
                agg: Mapping[str, Column | tuple[str, str]] | None = None,
                pieces: int | None = None) -> DataFrame:
    """The rows of ``table`` that match each parameter row, with all its parameters.

    ``equal`` maps table columns to parameter columns. ``between`` maps table columns to a pair
    of parameter columns with both bounds included, ``within`` with both left out; None
    in place of a column leaves that side open. A table row comes back once per matching
    parameter row; without parameters the table is returned as it is. ``agg`` names aggregates of
    table columns: then there is one row per parameter row, repeated ones too, with what the aggregates are
    over no rows where nothing matches. An aggregate is a column, or a pair of ``count``, ``sum``, ``min`` or ``max`` and
    a table column. If all are pairs and the one range is open on a side, no pair of rows is
    formed: :func:`~barfold.operators.ordered.aggregate_up_to` passes over both tables once.

    Otherwise every condition set becomes an equi-join. Where there are only ranges, the first one's column
    is cut into ``pieces`` (default: the session's shuffle partitions) at its quantiles, so pieces hold about
    as many rows each; a parameter row stands for the pieces its range meets, and each table row falls into
    exactly one piece, so no pair is met twice. That takes a number, date or time.
    """
    if params is None:
        return table
    equal, between, within = dict(equal or {}), dict(between or {}), dict(within or {})
    if not equal and not between and not within:
        raise ValueError("param_query needs a condition in equal, between or within")
    clash = set(table.columns) & set(params.columns)
    if clash:
        raise ValueError(f"parameter columns {sorted(clash)} also name table columns")

    ends = [*between.items(), *within.items()]
    if agg and len(ends) == 1 and None in ends[0][1] and all(isinstance(a, tuple) for a in agg.values()):
        column, (lo, hi) = ends[0]
        return aggregate_up_to(table, params, (column, hi or lo), agg, equal, falling=hi is None, strict=bool(within))
    names = params.columns
    if agg is not None:
        params = materialise(params.withColumn("_no", F.monotonically_increasing_id()))
    left, right = table, params
    keys = [F.col(c) == F.col(p) for c, p in equal.items()]
    ranges = [F.col(c) >= F.col(lo) for c, (lo, _) in between.items() if lo]
    ranges += [F.col(c) <= F.col(hi) for c, (_, hi) in between.items() if hi]
    ranges += [F.col(c) > F.col(lo) for c, (lo, _) in within.items() if lo]
    ranges += [F.col(c) < F.col(hi) for c, (_, hi) in within.items() if hi]
    if not equal:
        column, (lo, hi) = next(iter((between | within).items()))
        left, right = _in_pieces(table, params, column, lo, hi, pieces)
        keys = [F.col("_piece") == F.col("_match")]
    found = right.join(left, reduce(and_, keys + ranges)).select(*params.columns, *table.columns)
    if agg is None:
        return found
    values = {n: getattr(F, a[0])(F.col(a[1])) if isinstance(a, tuple) else a for n, a in agg.items()}
    grouped = found.groupBy("_no").agg(F.lit(True).alias("_any"), *[v.alias(n) for n, v in values.items()])
    nothing = table.limit(0).agg(*[v.alias(n) for n, v in values.items()]).first()
    kinds = {f.name: f.dataType for f in grouped.schema.fields}
    return params.join(grouped, "_no", "left").select(*names, *[
        F.when(F.col("_any"), F.col(n)).otherwise(F.lit(nothing[n]).cast(kinds[n])).alias(n) for n in values])


def _in_pieces(table: DataFrame, params: DataFrame, column: str, lo: str | None, hi: str | None,
               pieces: int | None) -> tuple[DataFrame, DataFrame]:
    """``table`` with its ``_piece``, and ``params`` once per piece to ``_match``."""
    data_type = table.schema[column].dataType

    def place(value: Column) -> Column:
        value = value.cast(data_type)
        if isinstance(data_type, T.FractionalType):
            return not_nan(value.cast("double"))
        found = position(value, data_type)
        if found is None:
            raise TypeError(f"{column}: a range alone needs a number, date or time")
        return found

    pieces = pieces or int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [n / pieces for n in range(1, pieces)] or [0.5]
    cuts = table.agg(F.percentile_approx(place(F.col(column)), shares).alias("cuts")).first()["cuts"]
    bounds = sorted(set(cuts or []))
    step = max(1, math.isqrt(len(bounds)))

    def piece(at: Column) -> Column:
        """The number of bounds that are not above: first among every ``step``-th, then among those after it."""
        if not bounds:
            return F.lit(0)
        every = F.array(*map(F.lit, bounds))
        passed = F.size(F.filter(F.array(*map(F.lit, bounds[::step])), lambda b: b <= at))
        near = F.slice(every, (passed - 1) * step + 1, F.lit(step))
        return F.when(passed > 0, (passed - 1) * step + F.size(F.filter(near, lambda b: b <= at))).otherwise(0)

    ends = [F.lit(0) if lo is None else piece(place(F.col(lo))),
            F.lit(len(bounds)) if hi is None else piece(place(F.col(hi)))]
    present = reduce(and_, [F.col(c).isNotNull() for c in (lo, hi) if c], F.lit(True))
    asked = (
        params.where(present).withColumns({"_from": ends[0], "_to": ends[1]})
        .where(F.col("_from") <= F.col("_to"))
        .withColumn("_match", F.explode(F.sequence("_from", "_to")))
    )
    return table.where(F.col(column).isNotNull()).withColumn("_piece", piece(place(F.col(column)))), asked
