import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from barfold.functions import finite, lag_cum_chg, lag_cum_chg_na, pct_chg, positive

def ordered():
    return Window.partitionBy("k").orderBy("i")


def run(spark, values, expression):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "k int, i int, x double")
    return [r["y"] for r in df.withColumn("y", expression).orderBy("i").collect()]


def test_change_skips_zero_null_and_nan(spark):
    out = run(spark, [10.0, 0.0, None, float("nan"), 15.0, 12.0], pct_chg("x", ordered()))
    assert out == [None, None, None, None, 0.5, -0.2]


def test_change_is_relative_to_the_size_of_the_base(spark):
    assert run(spark, [-5.0, 10.0], pct_chg("x", ordered())) == [None, 3.0]


def test_infinite_values_give_no_change(spark):
    out = run(spark, [1.0, float("inf"), 2.0, 3.0], pct_chg("x", ordered()))
    assert out == [None, None, None, 0.5]


def test_lagged_product(spark):
    out = run(spark, [1.0, None, 0.25, -0.5], lag_cum_chg("x", ordered()))
    assert out == [1.0, 0.5, 0.5, 0.4]


def test_lagged_product_keeps_missing(spark):
    out = run(spark, [1.0, None, 0.25, float("nan")], lag_cum_chg_na("x", ordered()))
    assert out == [1.0, None, 0.5, None]


def test_total_loss_has_no_finite_inverse(spark):
    out = run(spark, [-1.0, 0.0], lag_cum_chg("x", ordered()))
    assert out == [1.0, math.inf]


def test_guards(spark):
    values = [1.0, 0.0, -1.0, None, float("nan"), float("inf"), float("-inf")]
    assert run(spark, values, finite("x")) == [1.0, 0.0, -1.0, None, None, None, None]
    assert run(spark, values, F.coalesce(positive("x"), F.lit(False))) == [
        True, False, False, False, False, True, False
    ]
