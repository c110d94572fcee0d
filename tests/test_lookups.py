from datetime import date

import pytest
from pyspark.sql import functions as F

from barfold import operators as op
from tests.conftest import rows_of

D = [date(2020, 1, d) for d in range(1, 10)]
NEVER = date(1900, 1, 1)


@pytest.fixture
def stocks(spark):
    return spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "sec_id long, id_yahoo string")


@pytest.fixture
def returns(spark):
    rows = [(1, D[0], 0.5), (1, D[1], -0.5), (1, D[2], 0.0), (1, D[3], None), (2, D[4], 0.0)]
    return spark.createDataFrame(rows, "sec_id long, Date date, volume double")


def test_range_is_inclusive_on_both_sides(returns):
    assert op.get_return(returns, D[1], D[3]).count() == 3
    assert op.get_return(returns).count() == 5


def resume(stocks, returns, **options):
    return {r["sec_id"]: r["Date"] for r in op.max_date(stocks, returns, **options).collect()}


def test_resume_date_is_strictly_before_the_bound(stocks, returns):
    assert resume(stocks, returns, before=D[1]) == {1: D[0], 2: NEVER, 3: NEVER}
    assert resume(stocks, returns, before=D[8]) == {1: D[1], 2: NEVER, 3: NEVER}


def test_without_a_bound_given_every_security_starts_over(stocks, returns):
    assert resume(stocks, returns) == {1: NEVER, 2: NEVER, 3: NEVER}


def test_volume_filters(stocks, returns):
    assert resume(stocks, returns, before=None, volume_filter="positive")[1] == D[0]
    found = resume(stocks, returns, before=None, volume_filter="notnull", default=None)
    assert found == {1: D[2], 2: D[4], 3: None}
    with pytest.raises(ValueError):
        op.max_date(stocks, returns, volume_filter="any")


def test_last_date(spark, stocks, returns):
    prices = spark.createDataFrame([(1, D[0], 5.0), (1, D[1], None), (3, D[0], 7.0)],
                                   "sec_id long, Date date, close double")
    last = spark.createDataFrame([(1,), (2,)], "sec_id long")
    out = op.last_date(stocks, returns, prices, last)
    assert rows_of(out) == [(1, D[3], D[1], 0.0), (2, D[4], NEVER, 0.0)]
    assert "id_yahoo" in op.last_date(stocks, returns, prices, last, with_symbol=True).columns


def params(spark, rows):
    return spark.createDataFrame(rows, "no int, sid long, lo date, hi date")


@pytest.mark.parametrize("pieces", [1, 3, 1024])
def test_each_range_returns_its_rows(spark, returns, pieces):
    asked = params(spark, [(1, 1, D[0], D[1]), (2, 1, D[1], D[8]), (3, 1, D[5], date(9999, 1, 1)),
                           (4, 1, D[3], D[2]), (5, 1, None, D[8]), (6, 1, NEVER, D[0])])
    out = op.param_query(returns, asked, between={"Date": ("lo", "hi")}, pieces=pieces)
    brute = asked.crossJoin(returns).where("Date between lo and hi")
    assert rows_of(out) == rows_of(brute)
    assert {r["no"] for r in out.collect()} == {1, 2, 6}


@pytest.mark.parametrize("kind", ["int", "double", "timestamp", "timestamp_ntz", "decimal(9,2)"])
def test_ranges_of_other_types(spark, kind):
    number = kind in ("int", "double", "decimal(9,2)")
    value = F.expr("n * n - 40" if number else "timestamp_seconds(n * n * 5000)").cast(kind)
    table = spark.range(60).select(F.col("id").alias("n")).withColumn("x", value)
    bound = F.expr("a * 37 - 30" if number else "timestamp_seconds(a * 500000)").cast(kind)
    asked = spark.range(12).select(F.col("id").alias("a")).withColumn("lo", bound)
    asked = asked.withColumn("hi", F.expr("lo + a * 11" if number else "lo + make_dt_interval(a)").cast(kind))
    out = op.param_query(table, asked, between={"x": ("lo", "hi")}, pieces=7)
    brute = asked.crossJoin(table).where("x between lo and hi")
    assert rows_of(out, "a", "n") == rows_of(brute, "a", "n")
    assert out.count() > 20


def test_a_range_over_text_needs_an_equality(spark):
    table = spark.createDataFrame([("a", 1)], "x string, n int")
    asked = spark.createDataFrame([("a", "b", 1)], "lo string, hi string, m int")
    with pytest.raises(TypeError, match="number, date or time"):
        op.param_query(table, asked, between={"x": ("lo", "hi")})
    out = op.param_query(table, asked, equal={"n": "m"}, between={"x": ("lo", "hi")})
    assert out.count() == 1


def test_equality_and_range(spark, returns):
    asked = params(spark, [(1, 1, D[0], D[1]), (2, 2, D[0], D[8]), (2, 9, D[0], D[8])])
    out = op.param_query(returns, asked, equal={"sec_id": "sid"}, between={"Date": ("lo", "hi")})
    assert rows_of(out, "no", "Date") == [(1, D[0]), (1, D[1]), (2, D[4])]


def test_no_match_and_no_parameters(spark, returns):
    none = params(spark, [(1, 1, D[7], D[8])])
    assert op.param_query(returns, none, between={"Date": ("lo", "hi")}).count() == 0
    assert op.param_query(returns, None) is returns
    with pytest.raises(ValueError, match="needs a condition"):
        op.param_query(returns, none)
    with pytest.raises(ValueError, match="also name"):
        op.param_query(returns, returns, equal={"sec_id": "sec_id"})


def test_strict_and_open_bounds_with_aggregates(spark):
    table = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (None, 4.0)], "at long, x double")
    params = spark.createDataFrame([("a", 1, 3), ("b", 3, 3), ("c", None, 9)], "p string, lo long, hi long")

    def found(**how):
        rows = op.param_query(table, params, agg={"n": F.count("x"), "top": F.max("x")}, **how).collect()
        return {r["p"]: (r["n"], r["top"]) for r in rows}

    assert found(within={"at": ("lo", "hi")}) == {"a": (1, 2.0), "b": (0, None), "c": (0, None)}
    assert found(between={"at": ("lo", "hi")}) == {"a": (3, 3.0), "b": (1, 3.0), "c": (0, None)}
    assert found(within={"at": (None, "hi")}) == {"a": (2, 2.0), "b": (2, 2.0), "c": (3, 3.0)}
    assert found(between={"at": ("lo", None)}) == {"a": (3, 3.0), "b": (1, 3.0), "c": (0, None)}
