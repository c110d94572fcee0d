"""Percentage changes of daily bars, and the last known levels.

Bars have one row per ``(sec_id, Date)``, which the plans check. A series can thus
hold at most one row per day, 73,000 in 200 years, and one task can order any of
them, however the rows spread over securities. So changes are one shuffle by
``sec_id`` and one sort. ``span_days`` cuts the series further, at the price of a
second pass: no task then orders more than that many rows of a security.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barfold.functions.series import last_before, nonzero, pct_step, positive
from barfold.functions.spans import date_span
from barfold.operators.maintain import has_key, one_per_key
from barfold.schema import BUCKETS, FIRST_DATE, KEY, LEVELS, ON, PRICES, VOLUME
from barfold.sources.scratch import materialise
from barfold.sources.staging import conform


def usable_levels() -> dict[str, Column]:
    """Per level column, the value a change is measured on.

    Volume changes run over the days that traded, so a day without volume is
    skipped the same way a zero price is.
    """
    return {c: F.when(positive(c), F.col(c)) if c == VOLUME else nonzero(c) for c in LEVELS}


def by_security(rows: DataFrame) -> DataFrame:
    """``rows`` shuffled by security, as they are and before anything is added to them.

    The partitions are a multiple of the buckets of series tables and dealt by the same hash. So each falls into
    one bucket, and what is built on them in plans by security is written without another shuffle.
    """
    asked = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(BUCKETS * -(-asked // BUCKETS), KEY)


def series_key(span_days: int | None) -> list[str]:
    """The columns that make up one ordered run of rows."""
    return [KEY] if span_days is None else [KEY, "_span"]


def with_span(rows: DataFrame, span_days: int | None) -> DataFrame:
    return rows if span_days is None else rows.withColumn("_span", date_span(ON, span_days))


def with_changes(bars: DataFrame, values: Mapping[str, Column],
                 span_days: int | None = None) -> DataFrame:
    """``bars`` plus a ``<c>_chg`` column for every entry of ``values``, and ``_span`` if cut.

    The base of a change is the last non-null value of the series before the row.
    """
    run = series_key(span_days)
    used = {c: f"_{c}" for c in values}
    keyed = with_span(bars.withColumns({used[c]: v for c, v in values.items()}), span_days)

    ordered = Window.partitionBy(*run).orderBy(ON)
    rows = keyed.withColumns(
        {f"{u}_base": last_before(u, ordered) for u in used.values()}
        | {"_twice": F.lag(ON).over(ordered) == F.col(ON)}
    )
    if span_days is not None:
        rows = _with_carried_base(rows, keyed, list(used.values()))

    changes = {f"{c}_chg": pct_step(F.col(u), F.col(f"{u}_base")) for c, u in used.items()}
    repeated = F.raise_error(F.lit("more than one bar for a sec_id and Date"))
    unique = F.when(F.col("_twice"), repeated).otherwise(F.col(ON))
    return rows.withColumns(changes | {ON: unique}).select(
        *bars.columns, *[c for c in run if c not in bars.columns], *changes
    )


def _with_carried_base(rows: DataFrame, keyed: DataFrame, used: list[str]) -> DataFrame:
    """Fill bases that lie in an earlier span: last usable value per span, carried on."""
    closing = keyed.groupBy(KEY, "_span").agg(
        *[F.max_by(u, F.when(F.col(u).isNotNull(), F.col(ON))).alias(u) for u in used]
    )
    earlier = Window.partitionBy(KEY).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    opening = closing.select(
        KEY, "_span", *[F.last(u, ignorenulls=True).over(earlier).alias(f"{u}_from") for u in used]
    )
    return rows.join(opening, [KEY, "_span"], "left").withColumns(
        {f"{u}_base": F.coalesce(f"{u}_base", f"{u}_from") for u in used}
    )


def price_returns(bars: DataFrame, span_days: int | None = None) -> DataFrame:
    """Price levels with their changes, for every bar."""
    usable = usable_levels()
    values = {c: usable[c] for c in PRICES}
    return with_changes(bars.select(KEY, ON, *PRICES), values, span_days).drop("_span")


def volume_returns(bars: DataFrame, span_days: int | None = None) -> DataFrame:
    """Volume with its change, for the bars that traded."""
    traded = bars.select(KEY, ON, VOLUME).where(positive(VOLUME))
    return with_changes(traded, {VOLUME: nonzero(VOLUME)}, span_days).drop("_span")


def returns(bars: DataFrame, span_days: int | None = None) -> DataFrame:
    """The return table: changes of all columns, for bars whose close has a change."""
    rows = with_changes(bars.select(KEY, ON, *LEVELS), usable_levels(), span_days)
    return rows.where(F.col("close_chg").isNotNull()).select(
        KEY, ON, *[F.col(f"{c}_chg").alias(c) for c in LEVELS]
    )


def returns_revised(bars: DataFrame, stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The return table after ``batch``, new, late or corrected bars, replaced or joined those of ``bars``.

    ``stored`` are the returns of ``bars``. A changed bar moves its own changes, and per column that of the next bar
    usable there, whose base it was, is or lies after; nothing else. Only these rows are built and
    replaced. Of a touched security's bars before its first changed one, just the last usable value of each
    column is looked up, by an aggregate; bars of other securities are not read beyond their key.

    Bars from the first changed one on and the batch are shuffled by security once, and stay so until they meet the stored rows of
    touched securities, which returns are dealt out by as well; those of other securities stay in place.
    """
    usable = usable_levels()
    dated = bars.select(KEY, ON, *LEVELS)
    changed = materialise(conform(batch, dated.schema).where(has_key([KEY, ON])))
    # One row per security; stored, so that Spark knows its size and leaves the bars in place if it is small.
    first = materialise(changed.groupBy(KEY).agg(F.min(ON).alias("_first")))
    dated = dated.join(first, KEY)
    bases = dated.where(F.col(ON) < F.col("_first")).groupBy(KEY).agg(*[
        F.max_by(v, F.when(v.isNotNull(), F.col(ON))).alias(f"_base_{c}") for c, v in usable.items()])
    later = dated.where(F.col(ON) >= F.col("_first")).drop("_first").repartition(KEY)
    rows = _overlaid(later, one_per_key(changed.repartition(KEY), [KEY, ON], [KEY]))
    rows = rows.withColumns({f"_{c}": v for c, v in usable.items()})
    ordered = Window.partitionBy(KEY).orderBy(ON)
    rows = rows.withColumns(
        {f"_was_{c}": last_before(f"_{c}", ordered) for c in usable}
        | {f"_since_{c}": last_before(F.when(F.col(f"_{c}").isNotNull(), F.col(ON)), ordered) for c in usable}
        | {"_touch": last_before(F.when(F.col("_fresh"), F.col(ON)), ordered)}
    )
    moved = [
        F.col(f"_{c}").isNotNull() & (F.col("_touch") >= F.coalesce(f"_since_{c}", F.lit(FIRST_DATE).cast("date")))
        for c in usable
    ]
    rows = rows.where(F.coalesce(F.col("_fresh") | reduce(or_, moved), F.lit(False)))
    built = rows.join(bases, KEY, "left").select(
        KEY, ON, *[pct_step(F.col(f"_{c}"), F.coalesce(f"_was_{c}", f"_base_{c}")).alias(c) for c in usable])
    stored = stored.select(KEY, ON, *LEVELS)
    touched = _overlaid(stored.join(first, KEY, "left_semi"), built)
    return stored.join(first, KEY, "left_anti").unionByName(touched.where(~F.col("_fresh") | F.col("close").isNotNull()).drop("_fresh"))


def _overlaid(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` and those rows of ``old`` whose security and day it does not hold, told apart by ``_fresh``.

    In one order of rows instead of a join by day, so that sides dealt out by security are not shuffled.
    """
    rows = old.withColumn("_fresh", F.lit(False)).unionByName(new.withColumn("_fresh", F.lit(True)))
    newer = Window.partitionBy(KEY).orderBy(ON, F.desc("_fresh")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_latest", F.max(F.when(F.col("_fresh"), F.col(ON))).over(newer))
    return rows.where(F.col("_fresh") | F.coalesce(F.col("_latest") != F.col(ON), F.lit(True))).drop("_latest")


# Rows of one day are told apart by this many bits of a row number's hash.
_TELL = 1 << 41


def _last_row(bars: DataFrame, traded_on: str, columns: tuple[str, ...]) -> DataFrame:
    """The latest qualifying bar per security; two bars on that day raise.

    The largest and the smallest row mark of the latest day come from the same combined aggregate
    as the values: with one bar they are the same.
    """
    mark = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(_TELL))
    dated = bars.where(positive(traded_on)).withColumn("_mark", mark)
    day = F.unix_date(ON).cast("long") * _TELL
    latest = (
        dated.groupBy(KEY)
        .agg(F.max(ON).alias("_date"), *[F.max_by(c, ON).alias(c) for c in columns],
             F.max(day + F.col("_mark")).alias("_high"), F.max(day + _TELL - 1 - F.col("_mark")).alias("_low"))
    )
    several = F.pmod("_high", F.lit(_TELL)) + F.pmod("_low", F.lit(_TELL)) != _TELL - 1
    repeated = F.raise_error(F.lit("more than one bar for a sec_id and Date"))
    return latest.where(F.when(several, repeated).otherwise(True)).select(KEY, F.col("_date").alias(ON), *columns)


def last_price(bars: DataFrame) -> DataFrame:
    """Per security, the prices of the latest bar with a positive close."""
    return _last_row(bars, "close", PRICES)


def last_volume(bars: DataFrame) -> DataFrame:
    """Per security, the volume of the latest bar with a positive volume."""
    return _last_row(bars, VOLUME, (VOLUME,))
