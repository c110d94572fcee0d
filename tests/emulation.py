"""Brute-force versions of the series operators, row by row on Python lists."""

import math
from datetime import date, timedelta

from barfold.schema import LEVELS, PRICES

DAY0 = date(2020, 1, 1)


def changes(values):
    """Change of each value from the last usable one before it; 0 is not usable."""
    out, base = [], None
    for v in values:
        v = None if v is None or v == 0 or math.isnan(v) else v
        out.append(None if v is None or base is None else (v - base) / abs(base))
        base = base if v is None else v
    return out


def return_rows(bars):
    """``{sec: {day: {column: change}}}`` of ``{sec: {day: {column: level}}}``."""
    out = {}
    for sec, days in bars.items():
        table = {d: dict.fromkeys(LEVELS) for d in days}
        for c in PRICES:
            for d, r in zip(sorted(days), changes([days[d][c] for d in sorted(days)])):
                table[d][c] = r
        traded = [d for d in sorted(days) if (days[d]["volume"] or 0) > 0]
        for d, r in zip(traded, changes([days[d]["volume"] for d in traded])):
            table[d]["volume"] = r
        out[sec] = {d: r for d, r in table.items() if r["close"] is not None}
    return out


def last_days(bars, column):
    found = {s: [d for d, b in days.items() if (b[column] or 0) > 0] for s, days in bars.items()}
    return {s: max(days) for s, days in found.items() if days}


def rebuilt(returns, bars):
    """Levels: fill the last values down from the newest row, times the lagged product."""
    price_day, volume_day = last_days(bars, "close"), last_days(bars, "volume")
    out = {}
    for sec, days in returns.items():
        for c in LEVELS:
            anchor = (volume_day if c == "volume" else price_day).get(sec)
            carried, factor = None, 1.0
            for d in sorted(days, reverse=True):
                if d == anchor and bars[sec][d][c] is not None:
                    carried = bars[sec][d][c]
                r = days[d][c]
                known = r is not None and carried is not None
                out.setdefault((sec, d), {})[c] = round(carried * factor, 6) if known else None
                factor *= 1 / (1 + (r or 0.0))
    return out


def frame(spark, bars):
    rows = [
        (s, DAY0 + timedelta(days=d), *[b[c] for c in LEVELS])
        for s, days in bars.items() for d, b in days.items()
    ]
    schema = "sec_id long, Date date, " + ", ".join(f"{c} double" for c in LEVELS)
    return spark.createDataFrame(rows, schema)


def keyed(df):
    """``{(sec, day): {column: value}}`` of a series table."""
    return {(r["sec_id"], (r["Date"] - DAY0).days): {c: r[c] for c in LEVELS} for r in df.collect()}


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        for c, v in values.items():
            got = found[key][c]
            if v is None:
                assert got is None, (key, c, got)
            else:
                assert got is not None and math.isclose(got, v, rel_tol=1e-9, abs_tol=2e-6), (key, c, got, v)
