"""Changes, last levels and reconstruction against hand tables and brute force."""

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barfold import operators as op
from barfold.schema import LEVELS, PRICES
from tests import emulation as em

# day -> (close, volume); the other prices follow the close.
HAND = {
    1: {1: (10, 100), 2: (12, 200), 3: (0, 300)},
    2: {1: (10, 100), 2: (0, 0), 3: (15, 50), 4: (12, 0)},
    3: {1: (5, 5)},
    4: {1: (8, 10), 2: (None, 20), 3: (16, 40), 4: (4, 80)},
}
HAND_LEVELS = {
    (1, 2): (12, None),
    (2, 3): (15, 50), (2, 4): (12, None),
    (4, 3): (16, 40), (4, 4): (4, 80),
}


def bar(close, volume):
    close = None if close is None else float(close)
    return {c: close for c in PRICES} | {"volume": None if volume is None else float(volume)}


def hand_bars():
    return {s: {d: bar(*v) for d, v in days.items()} for s, days in HAND.items()}


@pytest.mark.parametrize("span", [None, 2])
def test_hand_table(spark, span):
    bars = em.frame(spark, hand_bars())
    tables = op.reconstruct(op.returns(bars, span), op.last_price(bars), op.last_volume(bars), span)
    for rebuilt in (tables, op.price_history(bars, span)):
        found = {k: (v["close"], v["volume"]) for k, v in em.keyed(rebuilt).items()}
        assert found == HAND_LEVELS


def test_last_rows_keep_what_the_row_holds(spark):
    bars = hand_bars()
    bars[2][4] |= {"open": None, "high": 0.0}
    last = {r["sec_id"]: r for r in op.last_price(em.frame(spark, bars)).collect()}
    assert (last[2]["open"], last[2]["high"], last[2]["close"]) == (None, 0.0, 12.0)
    assert (last[1]["Date"] - em.DAY0).days == 2
    volumes = {r["sec_id"]: r["volume"] for r in op.last_volume(em.frame(spark, bars)).collect()}
    assert volumes == {1: 300.0, 2: 50.0, 3: 5.0, 4: 80.0}


def test_volume_returns_hold_traded_days_only(spark):
    rows = op.volume_returns(em.frame(spark, hand_bars())).where("sec_id = 2").orderBy("Date")
    assert [(r["volume"], r["volume_chg"]) for r in rows.collect()] == [(100.0, None), (50.0, -0.5)]


def test_price_returns_keep_every_bar(spark):
    rows = op.price_returns(em.frame(spark, hand_bars())).where("sec_id = 2").orderBy("Date")
    assert [(r["close"], r["close_chg"]) for r in rows.collect()] == [
        (10.0, None), (0.0, None), (15.0, 0.5), (12.0, -0.2)
    ]


@pytest.mark.parametrize("span", [None, 30])
def test_repeated_bars_raise(spark, span):
    bars = em.frame(spark, hand_bars())
    with pytest.raises(Exception, match="more than one bar"):
        op.returns(bars.unionAll(bars), span).collect()


def test_minus_one_change_gives_null_levels_before_it(spark):
    schema = "sec_id long, Date date, " + ", ".join(f"{c} double" for c in LEVELS)
    day = [em.DAY0.replace(day=d) for d in (1, 2, 3)]
    rows = [(1, day[0], *[0.5] * 6), (1, day[1], *[-1.0] * 6), (1, day[2], *[1.0] * 6)]
    changes = spark.createDataFrame(rows, schema)
    prices = spark.createDataFrame([(1, day[2], *[8.0] * 5)],
                                   "sec_id long, Date date, " + ", ".join(f"{c} double" for c in PRICES))
    volumes = spark.createDataFrame([(1, day[2], 8.0)], "sec_id long, Date date, volume double")
    for span in (None, 1):
        out = op.reconstruct(changes, prices, volumes, span).orderBy("Date").collect()
        assert [r["close"] for r in out] == [None, 4.0, 8.0]


price = st.one_of(st.none(), st.just(0.0), st.integers(1, 60).map(lambda n: n / 4))
volume = st.one_of(st.none(), st.integers(0, 5).map(float))
row = st.fixed_dictionaries({c: price for c in PRICES} | {"volume": volume})
series = st.dictionaries(st.integers(1, 3), st.dictionaries(st.integers(0, 12), row, min_size=1),
                         min_size=1)


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(bars=series)
def test_any_bars_match_brute_force(spark, bars):
    df = em.frame(spark, bars)
    returns = em.return_rows(bars)
    levels = em.rebuilt(returns, bars)
    flat = {(s, d): r for s, days in returns.items() for d, r in days.items()}
    for span in (None, 4):
        changed = op.returns(df, span)
        em.assert_same(em.keyed(changed), flat)
        em.assert_same(em.keyed(op.price_history(df, span)), levels)
        rebuilt = op.reconstruct(changed, op.last_price(df), op.last_volume(df), span)
        em.assert_same(em.keyed(rebuilt), levels)


def test_round_trip_is_exact_where_whole_days_are_missing(spark):
    bars = {s: {d: bar(0, 0) if (d * s) % 5 == 3 else bar(10 + (d * 7 * s) % 13, 1 + (d * s) % 4)
                for d in range(40)} for s in (1, 2, 3)}
    out = op.roundtrip_diff(em.frame(spark, bars)).collect()
    assert len(out) == 120
    diffs = [r[f"{c}_diff"] for r in out for c in LEVELS if r[f"{c}_diff"] is not None]
    assert len(diffs) > 500 and max(abs(d) for d in diffs) < 1e-9


@pytest.mark.parametrize("last", [op.last_price, op.last_volume])
def test_two_bars_on_the_last_day_raise(spark, last):
    columns = "sec_id long, Date date, open double, high double, low double, close double, volume double, adj_close double"
    one = (1, date(1960, 1, 2), 1.0, 1.0, 1.0, 1.0, 5.0, 1.0)
    older = (1, date(1960, 1, 1), 2.0, 2.0, 2.0, 2.0, 6.0, 2.0)
    assert last(spark.createDataFrame([one, older, older], columns)).count() == 1
    for other in (one, (1, date(1960, 1, 2), 3.0, 3.0, 3.0, 3.0, 7.0, 3.0)):
        with pytest.raises(Exception, match="more than one bar"):
            last(spark.createDataFrame([one, other, older], columns)).collect()


@pytest.mark.parametrize("seed", range(3))
def test_revised_returns_are_the_full_rebuild(spark, seed):
    import random

    draw = random.Random(seed)

    def any_bar():
        return {c: draw.choice([None, 0.0, 5.0, 8.0, 10.0]) for c in LEVELS}

    old = {s: {d: any_bar() for d in draw.sample(range(20), 12)} for s in range(1, 6)}
    new = {s: {d: any_bar() for d in draw.sample(range(24), draw.randint(1, 4))} for s in (1, 2, 5, 9)}
    bars, batch = em.frame(spark, old), em.frame(spark, new)
    merged = em.frame(spark, {s: old.get(s, {}) | new.get(s, {}) for s in old | new})
    stored = op.returns(bars)
    em.assert_same(em.keyed(op.returns_revised(bars, stored, batch)), em.keyed(op.returns(merged)))
    nothing = op.returns_revised(bars, stored, batch.limit(0))
    em.assert_same(em.keyed(nothing), em.keyed(stored))


def test_revised_returns_of_rows_without_a_key_and_rows_that_repeat(spark):
    old = {1: {1: bar(10, 1), 2: bar(20, 1), 4: bar(30, 1)}, 2: {1: bar(1, 1), 2: bar(2, 1)}}
    bars = em.frame(spark, old)
    batch = em.frame(spark, {1: {2: bar(40, 1), 3: bar(20, 1)}})
    stored = op.returns(bars)
    # Stored rows without a key, and those of other securities, stay as often as they are there.
    odd = stored.where("sec_id = 2").unionByName(stored.where("sec_id = 2")).unionByName(
        stored.where("sec_id = 2").selectExpr("cast(null as bigint) sec_id", "Date", *LEVELS)).unionByName(
        stored.where("sec_id = 2").selectExpr("cast(1 as bigint) sec_id", "cast(null as date) Date", *LEVELS))
    twice = batch.unionByName(batch).unionByName(batch.selectExpr("cast(null as bigint) sec_id", "Date", *LEVELS))
    found = op.returns_revised(bars, stored.where("sec_id = 1").unionByName(odd), twice)
    got = sorted((str(r["sec_id"]), str(r["Date"]), r["close"]) for r in found.collect())
    rebuilt = op.returns(em.frame(spark, {1: old[1] | {2: bar(40, 1), 3: bar(20, 1)}}))
    wanted = [(str(r["sec_id"]), str(r["Date"]), r["close"]) for r in rebuilt.unionByName(odd).collect()]
    assert got == sorted(wanted)
    with pytest.raises(Exception, match="different source rows share the key"):
        op.returns_revised(bars, stored, batch.unionByName(em.frame(spark, {1: {2: bar(50, 1)}}))).collect()
