"""Column expressions."""

from barfold.functions.series import (
    finite,
    growth_factor,
    lag_cum_chg,
    lag_cum_chg_na,
    nonzero,
    pct_chg,
    pct_step,
    positive,
)
from barfold.functions.spans import date_span

__all__ = [
    "date_span",
    "finite",
    "growth_factor",
    "lag_cum_chg",
    "lag_cum_chg_na",
    "nonzero",
    "pct_chg",
    "pct_step",
    "positive",
]
