"""The daily update and the catch-up against a rebuild from scratch."""

from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barfold import operators as op
from barfold.plans import refresh_stored, update_all
from barfold.schema import KEY, ON, PRICES
from barfold.sources import materialise
from barfold.sources.store import Store
from tests import emulation as em
from tests.test_market import bar, price, volume

BARS = {
    s: {d: bar(0, 0) if (d + s) % 6 == 0 else bar(20 + (d * 7 + s * 3) % 11, (d + s) % 4 * 10)
        for d in range(30)}
    for s in (1, 2, 3, 400)
}


def quotes(spark, bars):
    return em.frame(spark, bars).select(
        F.concat(F.lit("S"), "sec_id").alias("symbol"), F.col("Date").alias("date"),
        "open", "high", "low", "close", "volume", F.col("adj_close").alias("adjusted"),
    )


def master(spark, ids=(1, 2, 3, 400)):
    return spark.createDataFrame([(i, f"n{i}", "HKD", "HK", f"S{i}") for i in ids],
                                 "sec_id long, name string, ccy string, exch_yahoo string, id_yahoo string")


@pytest.mark.parametrize("rebuild", ["needed", "all"])
def test_updates_in_steps_end_where_one_update_ends(spark, tmp_path, rebuild):
    store = Store(spark, str(tmp_path / "store"))
    first, second = em.DAY0 + timedelta(days=12), em.DAY0 + timedelta(days=21)
    update_all(store, master(spark, (1, 2, 3)), quotes(spark, BARS), end=first, rebuild=rebuild)
    update_all(store, master(spark, (400,)), quotes(spark, BARS), start=first, end=second, rebuild=rebuild)
    update_all(store, master(spark), quotes(spark, BARS), start=second, rebuild=rebuild)

    df = em.frame(spark, BARS)
    assert store.read("stocks").count() == 4
    em.assert_same(em.keyed(store.read("stock_return")), em.keyed(op.returns(df)))
    em.assert_same(em.keyed(store.read("stock_price")), em.keyed(op.price_history(df)))
    assert store.read("last_price").exceptAll(op.last_price(df)).count() == 0
    assert store.read("last_volume").exceptAll(op.last_volume(df)).count() == 0


def test_unknown_rebuild(spark, tmp_path):
    with pytest.raises(ValueError, match="rebuild"):
        update_all(Store(spark, str(tmp_path / "s")), master(spark), quotes(spark, BARS), rebuild="none")


@pytest.fixture(scope="module")
def tables(spark):
    df = em.frame(spark, BARS)
    return {"returns": op.returns(df), "last_prices": op.last_price(df),
            "last_volumes": op.last_volume(df), "history": op.price_history(df)}


def catch_up(spark, tables, prices):
    return em.keyed(op.price_catch_up(master(spark), tables["returns"], prices,
                                      tables["last_prices"], tables["last_volumes"]))


def test_catch_up_adds_only_new_dates(spark, tables):
    cut = em.DAY0 + timedelta(days=20)
    rows = catch_up(spark, tables, tables["history"].where(F.col("Date") <= F.lit(cut)))
    expected = {k: v for k, v in em.keyed(tables["history"]).items() if k[1] > 20}
    em.assert_same(rows, expected)


def test_catch_up_rebuilds_a_drifted_security(spark, tables):
    cut = em.DAY0 + timedelta(days=20)
    prices = tables["history"].where(F.col("Date") <= F.lit(cut)).withColumn(
        "adj_close", F.col("adj_close") * F.when(F.col("sec_id") == 2, 1.5).otherwise(1.0))
    rows = catch_up(spark, tables, prices)
    expected = {k: v for k, v in em.keyed(tables["history"]).items() if k[1] > 20 or k[0] == 2}
    em.assert_same(rows, expected)


def test_catch_up_rebuilds_where_the_last_date_has_no_return(spark, tables):
    halted = next(d for d in range(20, 0, -1) if (d + 3) % 6 == 0)
    prices = tables["history"].where((F.col("sec_id") == 3) & (F.dayofyear("Date") <= halted)).unionByName(
        em.frame(spark, {3: {halted: bar(1, 1)}}))
    rows = catch_up(spark, tables, prices)
    em.assert_same(rows, em.keyed(tables["history"]))


def test_catch_up_leaves_current_prices_alone(spark, tables):
    assert catch_up(spark, tables, tables["history"]) == {}


def test_refresh_gives_the_full_table(spark, tables):
    cut = em.DAY0 + timedelta(days=20)
    stored = tables["history"].where(F.col("Date") <= F.lit(cut))
    out = op.refresh_prices(master(spark), tables["returns"], stored, tables["last_prices"],
                            tables["last_volumes"])
    em.assert_same(em.keyed(out), em.keyed(tables["history"]))


# Securities whose bars are ordinary most days, so that many series stand.
sound = st.builds(lambda c, v: bar(c, v), st.integers(20, 40), st.integers(0, 3))
odd = st.fixed_dictionaries({c: price for c in PRICES} | {"volume": volume})
negative = st.builds(lambda c, v: bar(-c, v), st.integers(1, 9), st.integers(0, 3))
day = st.one_of(sound, sound, sound, sound, odd, st.just(bar(0, 0)), negative)
market = st.dictionaries(st.integers(1, 6), st.lists(day, min_size=1, max_size=12), min_size=2)


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(bars=market, cut=st.integers(3, 9), overlap=st.integers(0, 3), revise=st.booleans())
def test_changed_prices_are_those_a_full_rebuild_changes(spark, bars, cut, overlap, revise):
    days = {s: dict(enumerate(rows)) for s, rows in bars.items()}
    old = em.frame(spark, {s: {d: b for d, b in r.items() if d <= cut} for s, r in days.items()})
    if revise:
        days[1 if 1 in days else min(days)][cut - 1] = bar(33, 2)
    new = em.frame(spark, {s: {d: b for d, b in r.items() if d >= cut - overlap} for s, r in days.items()})

    def merged(build, key):
        before, fresh = materialise(build(old)), materialise(build(new))
        return before, fresh, materialise(op.upsert(before, fresh, key))

    old_returns, fresh, returns = merged(op.returns, [KEY, ON])
    old_prices, _, prices = merged(op.last_price, [KEY])
    old_volumes, _, volumes = merged(op.last_volume, [KEY])
    stored = op.reconstruct(old_returns, old_prices, old_volumes)
    rows = op.price_changes(fresh, returns, prices, volumes, old_returns, old_prices, old_volumes)
    whole = op.reconstruct(returns, prices, volumes)
    em.assert_same(em.keyed(op.upsert(stored, rows, [KEY, ON])),
                   em.keyed(op.upsert(stored, whole, [KEY, ON])))


def test_an_ordinary_day_builds_only_its_own_rows(spark):
    days = {s: {d: bar(20 + (d * s) % 7, 1 + d % 3) for d in range(20)} for s in (1, 2, 3)}
    before = em.frame(spark, {s: {d: b for d, b in r.items() if d < 19} for s, r in days.items()})
    after = em.frame(spark, {s: {d: b for d, b in r.items() if d > 15} for s, r in days.items()})
    old = [op.returns(before), op.last_price(before), op.last_volume(before)]
    fresh = [op.returns(after), op.last_price(after), op.last_volume(after)]
    keys = ([KEY, ON], [KEY], [KEY])
    new = [materialise(op.upsert(o, f, k)) for o, f, k in zip(old, fresh, keys)]
    rows = op.price_changes(fresh[0], *new, *old)
    assert sorted(em.keyed(rows)) == [(s, 19) for s in (1, 2, 3)]


def test_an_update_that_stops_half_way_changes_nothing_and_the_next_one_heals(spark, tmp_path, monkeypatch):
    from barfold.plans import update

    store, first = Store(spark, str(tmp_path / "store")), em.DAY0 + timedelta(days=12)
    update_all(store, master(spark), quotes(spark, BARS), end=first)
    version, rows = store.version(), store.read("stock_return").count()

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(update, "price_changes", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            update_all(store, master(spark), quotes(spark, BARS), start=first)
    assert (store.version(), store.read("stock_return").count()) == (version, rows)

    update_all(store, master(spark), quotes(spark, BARS), start=first)
    history = em.keyed(op.price_history(em.frame(spark, BARS)))
    em.assert_same(em.keyed(store.read("stock_price")), history)


def test_prices_that_end_before_their_returns_are_rebuilt(spark, tmp_path):
    store, first = Store(spark, str(tmp_path / "store")), em.DAY0 + timedelta(days=12)
    update_all(store, master(spark), quotes(spark, BARS), end=first)
    behind = materialise(store.read("stock_price").where(F.col(ON) < F.lit(first - timedelta(days=3))))
    store.publish({"stock_price": behind})
    update_all(store, master(spark), quotes(spark, BARS).limit(0), start=first)
    df = em.frame(spark, BARS).where(F.col(ON) <= F.lit(first))
    em.assert_same(em.keyed(store.read("stock_price")), em.keyed(op.price_history(df)))


def test_a_restated_security_rewrites_one_bucket(spark, tmp_path):
    many = {s: {d: bar(20 + (d * 7 + s) % 11, 5 + (d + s) % 4) for d in range(0, 900, 90)} for s in range(1, 40)}
    store = Store(spark, str(tmp_path / "store"))
    update_all(store, master(spark, many), quotes(spark, many))
    before = {n: store._entry(n)["parts"] for n in ("stock_return", "stock_price")}
    many[7] = {d: bar(10 + d % 13, 7) for d in many[7]}
    update_all(store, master(spark, many), quotes(spark, {7: many[7]}))
    em.assert_same(em.keyed(store.read("stock_price")), em.keyed(op.price_history(em.frame(spark, many))))
    for name, old in before.items():
        new = store._entry(name)["parts"]
        changed = {p for p in new if new[p] != old.get(p)}
        assert changed and {p.split("/")[0] for p in changed} == {next(iter(changed)).split("/")[0]}
        assert len(changed) < len(new) / 4


def test_refresh_leaves_other_files_alone(spark, tmp_path):
    df = em.frame(spark, BARS)
    history = op.price_history(df)
    cut = F.lit(em.DAY0 + timedelta(days=20))
    store = Store(spark, str(tmp_path / "store"))
    update_all(store, master(spark), quotes(spark, BARS))
    store.publish({"stock_price": history.where((F.col(KEY) != 2) | (F.col(ON) <= cut))})
    before = store._entry("stock_price")["parts"]
    refresh_stored(store)
    after = store._entry("stock_price")["parts"]
    em.assert_same(em.keyed(store.read("stock_price")), em.keyed(history))
    bucket = spark.range(1).selectExpr("pmod(hash(2L), 16) AS b").first()["b"]
    assert {p.split("/")[0] for p in after if after[p] != before.get(p)} == {f"bucket={bucket}"}
    refresh_stored(store)
    assert store._entry("stock_price")["parts"] == after
