"""Rebuilding absolute levels from changes and the last known levels.

An anchor (last price, last volume) counts only if its date is among the rows of its
security; it reaches that date and older ones. A row without a change has no level.
For ``span_days`` see :mod:`barfold.operators.returns`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barfold.functions.series import finite, growth_factor, lag_cum_chg, not_nan, positive
from barfold.functions.spans import date_span
from barfold.operators.returns import (
    last_price,
    last_volume,
    returns,
    series_key,
    usable_levels,
    with_changes,
    with_span,
)
from barfold.schema import KEY, LEVELS, ON, PRICES, VOLUME
from barfold.sources.scratch import materialise

# Where each anchor's date is kept, by level column.
_ANCHOR_ON = {c: "_volume_on" if c == VOLUME else "_price_on" for c in LEVELS}


def _with_newer(rows: DataFrame, span_days: int | None) -> DataFrame:
    """Per level column the product of the factors of all newer rows of the run."""
    newest_first = Window.partitionBy(*series_key(span_days)).orderBy(F.desc(ON))
    return rows.withColumns({f"_{c}_newer": lag_cum_chg(c, newest_first) for c in LEVELS})


def _levels(rows: DataFrame) -> list[Column]:
    """Levels as ``<c>_level``, from changes, newer products and anchors."""
    def level(c: str) -> Column:
        reached = not_nan(c).isNotNull() & (F.col(ON) <= F.col(_ANCHOR_ON[c]))
        return F.when(reached, finite(F.col(f"_{c}_last") * F.col(f"_{c}_newer")))

    return [level(c).alias(f"{c}_level") for c in LEVELS]


def _with_bar_anchors(rows: DataFrame, kept: Column) -> DataFrame:
    """Anchors of bars and changes that still are in one frame.

    One more pass over the rows as they are already partitioned. ``kept`` tells
    whether a row stays: an anchor on a dropped row does not count.
    """
    series = Window.partitionBy(KEY)
    dated = {
        "_price_on": F.when(positive("close_bar"), F.col(ON)),
        "_volume_on": F.when(positive(f"{VOLUME}_bar"), F.col(ON)),
    }
    rows = rows.withColumns(
        {d: F.max(on).over(series) for d, on in dated.items()}
        | {f"{d}_kept": F.max_by(kept, on).over(series) for d, on in dated.items()}
        | {f"_{c}_last": F.max_by(f"{c}_bar", dated[_ANCHOR_ON[c]]).over(series) for c in LEVELS}
    )
    return rows.withColumns({d: F.when(F.col(f"{d}_kept"), F.col(d)) for d in dated})


def _anchor_tables(prices: DataFrame, volumes: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        prices.select(KEY, F.col(ON).alias("_price_on"),
                      *[F.col(c).alias(f"_{c}_last") for c in PRICES]),
        volumes.select(KEY, F.col(ON).alias("_volume_on"), F.col(VOLUME).alias(f"_{VOLUME}_last")),
    )


def _rebuild(rows: DataFrame, prices: DataFrame, volumes: DataFrame) -> DataFrame:
    """Levels of whole series: one shuffle of the changes, one sort."""
    for anchors in _anchor_tables(prices, volumes):
        rows = rows.join(anchors, KEY, "left")
    series = Window.partitionBy(KEY)
    return rows.withColumns({
        d: F.when(F.max(F.col(ON) == F.col(d)).over(series), F.col(d))
        for d in ("_price_on", "_volume_on")
    })


def _rebuild_spans(rows: DataFrame, prices: DataFrame, volumes: DataFrame,
                   span_days: int) -> DataFrame:
    """Levels of cut series: each span's product and anchors are carried to older spans."""
    marked = rows.select(KEY, ON, "_span", *LEVELS)
    for anchors in _anchor_tables(prices, volumes):
        on = next(c for c in anchors.columns if c.endswith("_on"))
        marked = marked.join(anchors.withColumn("_span", date_span(on, span_days)),
                             [KEY, "_span"], "left")

    def on_anchor(value: str, column: str) -> Column:
        return F.max(F.when(F.col(ON) == F.col(_ANCHOR_ON[column]), F.col(value))).alias(value)

    spans = marked.groupBy(KEY, "_span").agg(
        *[F.product(growth_factor(c)).alias(f"_{c}_step") for c in LEVELS],
        *[on_anchor(f"_{c}_last", c) for c in LEVELS],
        on_anchor("_price_on", "close"), on_anchor("_volume_on", VOLUME),
    )
    series = Window.partitionBy(KEY)
    newer = series.orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select(
        KEY, "_span",
        *[F.coalesce(F.product(f"_{c}_step").over(newer), F.lit(1.0)).alias(f"_{c}_carried")
          for c in LEVELS],
        *[F.max(a).over(series).alias(a)
          for a in ("_price_on", "_volume_on", *[f"_{c}_last" for c in LEVELS])],
    )
    return rows.join(carried, [KEY, "_span"], "left").withColumns(
        {f"_{c}_newer": F.col(f"_{c}_newer") * F.col(f"_{c}_carried") for c in LEVELS}
    )


def _rounded(rows: DataFrame, digits: int | None) -> DataFrame:
    levels = rows.select(KEY, ON, *_levels(rows))
    return levels.select(KEY, ON, *[
        (F.col(f"{c}_level") if digits is None else F.round(f"{c}_level", digits)).alias(c)
        for c in LEVELS
    ])


def reconstruct(returns: DataFrame, prices: DataFrame, volumes: DataFrame,
                span_days: int | None = None, digits: int | None = 6) -> DataFrame:
    """Absolute levels of a return table, from the last price and last volume tables.

    A change of -1 has no finite inverse: the levels before it come out null.
    """
    rows = with_span(returns.select(KEY, ON, *LEVELS), span_days)
    if span_days is None:
        return _rounded(_rebuild(_with_newer(rows, None), prices, volumes), digits)
    # Shuffled before the factors are added, which would double what moves.
    rows = _with_newer(rows.repartition(*series_key(span_days)), span_days)
    return _rounded(_rebuild_spans(rows, prices, volumes, span_days), digits)


def _changes_beside_bars(bars: DataFrame) -> DataFrame:
    """Changes under the level names, the levels as ``<c>_bar``."""
    rows = with_changes(bars.select(KEY, ON, *LEVELS), usable_levels())
    return rows.select(
        KEY, ON, *[F.col(f"{c}_chg").alias(c) for c in LEVELS],
        *[F.col(c).alias(f"{c}_bar") for c in LEVELS],
    )


def price_history(bars: DataFrame, span_days: int | None = None,
                  digits: int | None = 6) -> DataFrame:
    """Changes, last levels and reconstruction of ``bars`` in one plan.

    Uncut, everything happens on a single shuffle of the bars by ``sec_id``.
    """
    if span_days is not None:
        # Read three times, so computed once.
        bars = materialise(bars.select(KEY, ON, *LEVELS))
        return reconstruct(returns(bars, span_days), last_price(bars), last_volume(bars),
                           span_days, digits)
    kept = F.col("close").isNotNull()
    rows = _with_bar_anchors(_changes_beside_bars(bars), kept).where(kept)
    return _rounded(_with_newer(rows, None), digits)


def roundtrip_diff(bars: DataFrame) -> DataFrame:
    """Original levels and ``<c>_diff``, original minus unrounded rebuilt level.

    Here rows without a close change stay in, so every step is kept. The levels
    travel with their rows, which saves joining the result back to the bars.
    """
    rows = _with_newer(_with_bar_anchors(_changes_beside_bars(bars), F.lit(True)), None)
    original = {
        c: F.when(positive(f"{c}_bar"), F.col(f"{c}_bar")) if c == VOLUME else F.col(f"{c}_bar")
        for c in LEVELS
    }
    return rows.select(
        KEY, ON, *[v.alias(c) for c, v in original.items()], *_levels(rows)
    ).select(
        KEY, ON, *LEVELS, *[(F.col(c) - F.col(f"{c}_level")).alias(f"{c}_diff") for c in LEVELS]
    )
