"""The daily update: new bars in, all market tables brought up to date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from barfold.operators.catch_up import price_catch_up, price_changes
from barfold.operators.levels import reconstruct
from barfold.operators.lookups import max_date
from barfold.operators.returns import by_security, last_price, last_volume, returns
from barfold.schema import EARLIEST, LATEST, MARKET_TABLES, ON
from barfold.sources.market import normalise_bars, select_bars
from barfold.sources.store import Store

REBUILDS = ("needed", "all")


def update_all(store: Store, securities: DataFrame, bars: DataFrame,
               start: date = EARLIEST, end: date | None = None,
               rebuild: str = "needed") -> None:
    """Merge a security master and new bars into the tables of ``store``.

    Each security's bars count from its resume date: its last date before ``start``
    with a volume change, or all dates. All tables change in one step or not at all.
    ``'needed'`` builds the price rows that change, and those of securities whose stored prices do
    not end where their returns do; ``'all'`` builds those of every security and date. Missing tables are created; create
    them beforehand to choose another partitioning.
    """
    if rebuild not in REBUILDS:
        raise ValueError(f"rebuild must be one of {REBUILDS}, not {rebuild!r}")
    store.create(*MARKET_TABLES)
    with store.change() as change:
        change.upsert({"stocks": securities})
        stocks, tables = change.read("stocks"), ("stock_return", "last_price", "last_volume")
        before = [change.read(name) for name in tables]
        resume = max_date(stocks, before[0], before=start, default=None)
        fetched = normalise_bars(select_bars(bars, resume, end), stocks)
        with store.staged(fetched) as fresh:
            change.upsert({
                "last_price": last_price(fresh),
                "last_volume": last_volume(fresh),
                "stock_return": returns(by_security(fresh)),
            })
            changes, current = change.added("stock_return"), [change.read(name) for name in tables]
            if rebuild == "all":
                rows = reconstruct(by_security(current[0]), *current[1:])
            else:
                rows = price_changes(changes, *current, *before, stored=change.read("stock_price"))
            change.upsert({"stock_price": rows})


def refresh_stored(store: Store, **options) -> None:
    """Catch the stored price table up with the stored returns and last levels.

    The rows :func:`barfold.operators.catch_up.price_catch_up` finds missing or wrong are merged into the
    partitions they fall into; no other partition is read for the merge or written.
    """
    with store.change() as change:
        tables = [change.read(n) for n in ("stocks", "stock_return", "stock_price", "last_price", "last_volume")]
        change.upsert({"stock_price": price_catch_up(*tables, **options)})


def stored_return(store: Store, start: date = EARLIEST, end: date = LATEST) -> DataFrame:
    """Stored returns with ``start <= Date <= end``, opening only the years between."""
    return store.read("stock_return", between={ON: (start, end)})
