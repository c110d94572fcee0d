import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold import operators as op
from tests.conftest import rows_of

SCHEMA = "k long, d int, v string, n double"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def target(spark):
    return table(spark, [(1, 1, "a", 1.0), (2, 1, "b", 2.0), (3, 2, "c", None), (None, 2, "x", 9.0)])


@pytest.fixture
def source(spark):
    return spark.createDataFrame(
        [("S", 2, 5, 20.0, 0), ("S", 4, 2, 40.0, 0), ("S", None, 5, 50.0, 0), ("S", 4, 2, 40.0, 1)],
        "v string, k long, d int, n double, ignored int",
    )


def test_delete_matching_never_matches_null(target, source):
    assert rows_of(op.delete_matching(target, source, ["k"]), "k") == [(None,), (1,), (3,)]


def test_delete_keeps_column_order(target, source):
    assert op.delete_matching(target, source, ["d"]).columns == target.columns


def test_delete_without_keys(target, source):
    assert op.delete_matching(target, source, []).count() == 0
    assert op.delete_matching(target, source.where("d > 100"), []).count() == 4


def test_insert_absent(target, source):
    out = op.insert_absent(target, source, ["k"])
    assert rows_of(out) == rows_of(target.unionAll(table(out.sparkSession, [(4, 2, "S", 40.0)])))


def test_upsert_replaces_whole_rows(target, source):
    out = rows_of(op.upsert(target, source, ["k"]))
    assert out == [(None, 2, "x", 9.0), (1, 1, "a", 1.0), (2, 5, "S", 20.0), (3, 2, "c", None),
                   (4, 2, "S", 40.0)]


def test_upsert_twice_is_upsert_once(target, source):
    once = op.upsert(target, source, ["k"])
    assert rows_of(op.upsert(once, source, ["k"])) == rows_of(once)


def test_equal_source_rows_with_nulls_are_one_row(spark, target):
    twice = table(spark, [(7, 1, None, None), (7, 1, None, None)])
    assert rows_of(op.upsert(target, twice, ["k"]).where("k = 7")) == [(7, 1, None, None)]


@pytest.mark.parametrize("other", [(7, 1, "b", 1.0), (7, 1, None, 1.0), (7, 1, "a", None)])
def test_different_source_rows_with_one_key_raise(spark, target, other):
    clash = table(spark, [(7, 1, "a", 1.0), other])
    with pytest.raises(Exception, match="share the key"):
        op.upsert(target, clash, ["k"]).collect()


def test_source_must_have_the_fields(target, source):
    with pytest.raises(ValueError, match="lacks the fields"):
        op.upsert(target, source.drop("n"), ["k"])


def test_a_target_without_key_is_rejected(target, source):
    with pytest.raises(ValueError, match="no primary key"):
        op.insert_absent(target, source, [])


def test_replace_by_one_column(target, source):
    # d = 2 and 5 go, but key 2 stays held by d = 1, so its new row is not inserted.
    out = rows_of(op.replace_by(target, source, "d", ["k"]))
    assert out == [(1, 1, "a", 1.0), (2, 1, "b", 2.0), (4, 2, "S", 40.0)]


def test_replace_by_many_columns(spark, source):
    target = table(spark, [(2, 5, "a", 1.0), (2, 6, "b", 1.0), (4, 1, "c", 1.0)])
    out = rows_of(op.replace_by(target, source, ["k", "d"], ["k", "d"]))
    assert out == [(2, 5, "S", 20.0), (2, 6, "b", 1.0), (4, 1, "c", 1.0), (4, 2, "S", 40.0)]


HAND = [
    (1, 1, "a", 1.0), (1, 2, "a", 1.0), (1, 3, None, 1.0), (1, 4, "", 1.0), (1, 5, "b", None),
    (1, 6, "b", None), (1, 7, "b", 0.0), (1, 8, "a", 1.0), (2, 4, "a", 1.0),
]


@pytest.mark.parametrize("limit", [1, 2, 3, 100])
def test_drop_unchanged_hand_table(spark, limit):
    out = op.drop_unchanged(table(spark, HAND), "d", ["k"], rows_per_span=limit)
    assert rows_of(out, "k", "d") == [(1, 1), (1, 3), (1, 5), (1, 7), (1, 8), (2, 4)]


def test_drop_unchanged_twice_is_once(spark):
    once = op.drop_unchanged(table(spark, HAND), "d", ["k"])
    assert rows_of(op.drop_unchanged(once, "d", ["k"])) == rows_of(once)


def test_drop_unchanged_compares_listed_columns_only(spark):
    out = op.drop_unchanged(table(spark, HAND), "d", ["k"], check=["n"])
    assert rows_of(out, "k", "d") == [(1, 1), (1, 5), (1, 7), (1, 8), (2, 4)]


def test_rows_without_key_or_ordinal_stay(spark):
    rows = [(None, 1, "a", 1.0), (None, 2, "a", 1.0), (1, None, "a", 1.0), (1, 1, "a", 1.0)]
    assert op.drop_unchanged(table(spark, rows), "d", ["k"]).count() == 4


def test_required_columns_need_no_null_rule(spark):
    schema = T.StructType([T.StructField("k", T.LongType(), False),
                           T.StructField("d", T.IntegerType(), False),
                           T.StructField("v", T.StringType(), False)])
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "")], schema)
    assert rows_of(op.drop_unchanged(df, "d", ["k"]), "d") == [(1,), (3,)]


def test_a_table_without_other_keys_is_one_run(spark):
    out = op.drop_unchanged(table(spark, HAND).where("k = 1").drop("k"), "d", [])
    assert rows_of(out, "d") == [(1,), (3,), (5,), (7,), (8,)]


def test_tied_ordinals_raise(spark):
    with pytest.raises(Exception, match="not unique"):
        op.drop_unchanged(table(spark, [(1, 1, "a", 1.0), (1, 1, "b", 1.0)]), "d", ["k"]).collect()


@pytest.mark.parametrize("ordinal", ["n", "date_add(DATE '2020-01-01', int(n))",
                                     "timestamp_seconds(n * 977)", "lpad(n, 8, '0')"])
def test_a_hot_key_is_cut_and_gives_the_same_rows(spark, ordinal):
    # Key 0 holds a third of the rows, in two dense stretches far apart.
    rows = spark.range(6000).select(
        F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 50 + 1).alias("k"),
        F.expr("int(if(id < 1000, id, id + 20000))").alias("n"),
        F.expr("string(int(id / 3) % 2)").alias("v"),
    ).withColumn("o", F.expr(ordinal)).select("k", "o", "v")
    whole = op.drop_unchanged(rows, "o", ["k"])
    cut = op.drop_unchanged(rows, "o", ["k"], rows_per_span=100)
    assert rows_of(cut) == rows_of(whole)
    assert 0 < whole.count() < 6000
