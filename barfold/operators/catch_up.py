"""Bringing a stored price table up to date without rebuilding all of it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barfold.functions.series import growth_factor
from barfold.operators.levels import reconstruct
from barfold.operators.maintain import delete_matching, one_per_key
from barfold.operators.returns import by_security
from barfold.schema import FIRST_DATE, KEY, LEVELS, ON, PRICES, VOLUME
from barfold.sources.scratch import materialise


def _stale(stocks: DataFrame, returns: DataFrame, prices: DataFrame,
           last_prices: DataFrame) -> DataFrame:
    """Securities whose last price is older than their last return, and its date, ``_from``;
    null if none was ever stored.

    One row per security, from two columns of each table; worth computing once.
    """
    last_return = returns.groupBy(KEY).agg(F.max(ON).alias("_to"))
    last_level = prices.groupBy(KEY).agg(F.max(ON).alias("_from"))
    return materialise(
        stocks.select(KEY)
        .join(last_prices.select(KEY), KEY, "left_semi")
        .join(last_return, KEY)
        .join(last_level, KEY, "left")
        .where(F.col("_from").isNull() | (F.col("_from") < F.col("_to")))
        .drop("_to")
    )


def price_catch_up(stocks: DataFrame, returns: DataFrame, prices: DataFrame,
                   last_prices: DataFrame, last_volumes: DataFrame,
                   compare: Sequence[str] = LEVELS, tolerance: float = 1e-12,
                   span_days: int | None = None) -> DataFrame:
    """The price rows that are missing or no longer right.

    Only securities whose last price is older than their last return take part.
    They are rebuilt from their last price date on, which needs just the returns
    since that date; one that was never stored needs all. Where the stored row of that date is
    not the rebuilt one (in ``compare``, both rounded, but for a relative ``tolerance`` that covers the
    error of doubles), the security is rebuilt as a whole.
    """
    stale = _stale(stocks, returns, prices, last_prices)
    # The earliest date in question lets the scans skip files before any join.
    never_stored = F.col("_from").isNull()
    any_never = F.coalesce(F.max(never_stored), F.lit(False))
    since = stale.agg(F.when(any_never, F.lit(FIRST_DATE).cast("date")).otherwise(F.min("_from"))).scalar()
    since_stored = stale.agg(F.min("_from")).scalar()
    stored = (
        prices.where(F.col(ON) >= since_stored)
        .join(stale.withColumnRenamed("_from", ON), [KEY, ON])
        .select(KEY, *[F.col(c).alias(f"_stored_{c}") for c in LEVELS])
    )
    open_returns = (
        returns.where(F.col(ON) >= since)
        .join(stale, KEY)
        .where(never_stored | (F.col(ON) >= F.col("_from")))
    )
    # Read twice below, by the drifted securities and by the appended rows.
    def series(rows: DataFrame) -> DataFrame:
        # Shuffled before the factors are added, which would double what moves.
        return rows.select(KEY, ON, *LEVELS).repartition(KEY) if span_days is None else rows

    recent = (
        materialise(reconstruct(series(open_returns), last_prices, last_volumes, span_days))
        .join(stale, KEY)
        .join(stored, KEY, "left")
    )

    def same(c: str) -> Column:
        stored, rebuilt = F.col(f"_stored_{c}"), F.col(c)
        near = F.abs(stored - rebuilt) <= tolerance * F.abs(stored)
        return F.coalesce(near, stored.isNull() & rebuilt.isNull())

    confirmed = F.when(F.col(ON) == F.col("_from"), reduce(and_, [same(c) for c in compare]))
    recent = recent.withColumn(
        "_right",
        never_stored | F.coalesce(F.max(confirmed).over(Window.partitionBy(KEY)), F.lit(False)),
    )
    # At most one id per security; joined by order all returns would be shuffled to meet them.
    drifted = F.broadcast(recent.where(~F.col("_right")).select(KEY).distinct())
    whole = reconstruct(series(returns.join(drifted, KEY, "left_semi")), last_prices, last_volumes,
                        span_days)
    appended = recent.where(F.col("_right") & (never_stored | (F.col(ON) > F.col("_from"))))
    return appended.select(KEY, ON, *LEVELS).unionByName(whole)


def refresh_prices(stocks: DataFrame, returns: DataFrame, prices: DataFrame,
                   last_prices: DataFrame, last_volumes: DataFrame, **options) -> DataFrame:
    """The price table after :func:`price_catch_up`, whose rows are written once as the
    merge reads them twice."""
    rows = price_catch_up(stocks, returns, prices, last_prices, last_volumes, **options)
    rows, key = materialise(rows), [KEY, ON]
    return delete_matching(prices, rows, key).unionByName(one_per_key(rows, key, [KEY]).select(*prices.columns))


def price_changes(fresh: DataFrame, returns: DataFrame, prices: DataFrame, volumes: DataFrame,
                  old_returns: DataFrame, old_prices: DataFrame, old_volumes: DataFrame,
                  stored: DataFrame | None = None, tolerance: float = 1e-11) -> DataFrame:
    """The price rows a rebuild of everything would change after ``fresh`` was merged.

    ``fresh`` are the return rows of this run; the other tables are the return, last
    price and last volume tables after the merge and before it.

    As long as the stored returns stand, new rows and new anchors move all older levels
    of a security by one factor per column. Where every factor is 1, which is the
    normal day, only the rows after its last return date are built. A security is
    rebuilt as a whole if it is new, if a stored return was revised, if an anchor came or
    went or moved back, if prices were not anchored on the last return, if a
    factor is not 1 within ``tolerance``, or if its prices in ``stored``, the price table before this
    run, do not end with its returns, as after a run that did not finish.
    """
    ends = old_returns.groupBy(KEY).agg(F.max(ON).alias("_end"))
    if stored is not None:
        priced = stored.groupBy(KEY).agg(F.max(ON).alias("_priced"))
        ends = materialise(ends.join(priced, KEY, "left").select(
            KEY, "_end", (~F.col("_priced").eqNullSafe(F.col("_end"))).alias("_behind")))
    else:
        ends = ends.withColumn("_behind", F.lit(False))
    dated = fresh.select(KEY, ON, *LEVELS).join(ends, KEY, "left")
    added = dated.where(F.col("_end").isNull() | (F.col(ON) > F.col("_end")))

    first = fresh.agg(F.min(ON)).scalar()
    # Stored, so that Spark knows how few they are: the other securities' rows need not move.
    met = materialise(fresh.select(KEY).distinct())
    held_returns = old_returns.where(F.col(ON) >= first).join(met, KEY, "left_semi").select(
        *[F.col(c).alias(f"_was_{c}") for c in (KEY, ON, *LEVELS)]
    )
    unchanged = reduce(and_, [F.col(c) == F.col(f"_was_{c}") for c in (KEY, ON)]
                       + [F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in LEVELS])
    revised = (
        dated.where(F.col(ON) <= F.col("_end"))
        .join(held_returns, unchanged, "left_anti")
        .select(KEY).distinct().withColumn("_revised", F.lit(True))
    )
    steps = added.groupBy(KEY).agg(
        *[F.product(growth_factor(c)).alias(f"_{c}_step") for c in LEVELS]
    )

    # The four anchors of each security this run touched, and whether their dates are rows.
    touched = fresh.select(KEY).unionByName(prices.subtract(old_prices).select(KEY))
    touched = touched.unionByName(volumes.subtract(old_volumes).select(KEY))
    touched = touched.unionByName(ends.where("_behind").select(KEY)).distinct()
    named = {"price": prices, "old_price": old_prices, "volume": volumes, "old_volume": old_volumes}
    anchors = materialise(reduce(
        lambda rows, name: rows.join(
            named[name].select(KEY, *[F.col(c).alias(f"{name}_{c}")
                                      for c in named[name].columns if c != KEY]), KEY, "left"),
        named, touched,
    ))
    dates = {name: F.col(f"{name}_{ON}") for name in named}
    first_anchor = anchors.agg(F.least(*[F.min(d) for d in dates.values()])).scalar()

    def on_rows(rows: DataFrame, names: Sequence[str], suffix: str) -> DataFrame:
        dated_rows = rows.select(KEY, ON).join(anchors.select(KEY, *[dates[n] for n in names]), KEY)
        return dated_rows.groupBy(KEY).agg(
            *[F.max(F.col(ON) == dates[n]).alias(f"{n}_{suffix}") for n in names]
        )

    held = on_rows(old_returns.where(F.col(ON) >= first_anchor), list(named), "held")
    arrived = on_rows(fresh, ["price", "volume"], "arrived")
    state = reduce(lambda rows, part: rows.join(part, KEY, "left"),
                   [ends, revised, steps, held, arrived], anchors)

    def date_of(name: str) -> Column:
        counts = F.coalesce(f"{name}_held", F.lit(False))
        if name in ("price", "volume"):
            counts = counts | F.coalesce(f"{name}_arrived", F.lit(False))
        return F.when(counts, dates[name])

    def scaled(c: str, anchor: str) -> Column:
        old = F.col(f"old_{anchor}_{c}")
        new = F.col(f"{anchor}_{c}") * F.coalesce(f"_{c}_step", F.lit(1.0))
        return F.coalesce(F.abs(new - old) <= tolerance * F.abs(old), old.isNull() & new.isNull())

    end = F.col("_end")
    same_prices = reduce(and_, [scaled(c, "price") for c in PRICES],
                         (date_of("old_price") == end) & (date_of("price") >= end))
    no_volume = date_of("volume").isNull() & date_of("old_volume").isNull()
    same_volume = (date_of("volume") >= date_of("old_volume")) & scaled(VOLUME, "volume")
    stands = F.coalesce(
        F.col("_revised").isNull() & ~F.col("_behind") & same_prices & (no_volume | same_volume), F.lit(False)
    )
    # Where a security stands, its rows after ``_after`` are this run's; of others all are needed.
    state = materialise(state.select(KEY, F.when(stands, end).alias("_after")))
    since = state.agg(F.when(F.max(F.col("_after").isNull()), F.lit(FIRST_DATE).cast("date")).otherwise(F.min("_after")))
    rows = (
        returns.where(F.col(ON) >= since.scalar())
        .join(state, KEY)
        .where(F.col("_after").isNull() | (F.col(ON) > F.col("_after")))
    )
    return reconstruct(by_security(rows.select(KEY, ON, *LEVELS)), prices, volumes)
