import pytest
from pyspark.sql import functions as F

from barfold import operators as op
from tests.conftest import rows_of


def enum(spark, rows, value="string"):
    return spark.createDataFrame(rows, f"id long, value {value}")


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def test_new_values_follow_the_highest_id(spark):
    out = op.extend_enum(enum(spark, [(3, "m"), (10, "b")]), column(spark, ["z", None, "a", "b", "a"]), "c")
    assert rows_of(out) == [(10, "b"), (11, "a"), (12, "z"), (3, "m")]


def test_an_empty_dictionary_starts_at_one(spark):
    out = op.extend_enum(enum(spark, []), column(spark, ["b", "a"]), "c")
    assert rows_of(out) == [(1, "a"), (2, "b")]


def test_nothing_new(spark):
    out = op.extend_enum(enum(spark, [(5, "a")]), column(spark, ["a", None]), "c")
    assert rows_of(out) == [(5, "a")]


def test_ids_are_dense_and_in_value_order_over_many_partitions(spark):
    values = spark.range(0, 20000, numPartitions=16).selectExpr("(id * 7919) % 20011 AS c")
    out = op.extend_enum(enum(spark, [(100, -1)], "long"), values, "c").where("id > 100")
    got = [(r["id"], r["value"]) for r in out.orderBy("id").collect()]
    expected = sorted({(i * 7919) % 20011 for i in range(20000)})
    assert got == [(101 + i, v) for i, v in enumerate(expected)]


def test_encode(spark):
    tables = {"enum_c": enum(spark, [(4, "a"), (2, "a"), (9, "b")]), "enum_other": enum(spark, [])}
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "i int, c string")
    out = op.encode_enums(frame, tables)
    assert out.columns == ["i", "c"]
    assert rows_of(out) == [(1, 2), (2, 9), (3, None), (4, None)]


def test_encode_with_an_empty_dictionary_gives_null(spark):
    out = op.encode_enums(column(spark, ["a"]), {"enum_c": enum(spark, [])})
    assert rows_of(out) == [(None,)]


def test_extended_dictionaries_encode_every_value(spark):
    frame = spark.createDataFrame([(i % 7, f"v{i % 11}", i) for i in range(100)], "a int, b string, i int")
    tables = {"enum_a": enum(spark, [(1, 3)], "int"), "enum_b": enum(spark, [(1, "v3")]),
              "enumerate": frame, "enum_i": frame.select("i")}
    extended = op.extend_enums(tables, frame)
    assert sorted(extended) == ["enum_a", "enum_b"]
    encoded = op.encode_enums(frame, extended)
    assert encoded.where("a IS NULL OR b IS NULL").count() == 0
    assert encoded.select("a").distinct().count() == 7


def test_a_failing_dictionary_does_not_stop_the_others(spark, caplog):
    frame = spark.createDataFrame([("x", "y")], "a string, b string")
    tables = {"enum_a": enum(spark, [], "int"), "enum_b": enum(spark, [])}
    extended = op.extend_enums(tables, frame)
    assert sorted(extended) == ["enum_b"]
    assert "enum_a was not extended" in caplog.text


def test_repeatable(spark):
    values = column(spark, [f"v{i}" for i in range(500)])
    first, second = (rows_of(op.extend_enum(enum(spark, []), values, "c")) for _ in range(2))
    assert first == second


@pytest.mark.parametrize("count", [0, 1])
def test_tiny_sources(spark, count):
    out = op.extend_enum(enum(spark, []), column(spark, ["v"]).limit(count), "c")
    assert out.count() == count


def wide(spark):
    rows = [("b", 2, 1.5, None), ("a", 10, 2.5, "q"), (None, 9, None, "q"), ("c", None, 1.5, "p"), ("a", 2, 0.5, "p")]
    frame = spark.createDataFrame(rows, "s string, n long, d double, column string").repartition(3)
    tables = {"enum_s": enum(spark, [(4, "a"), (2, "a"), (1, "z"), (9, None)]), "enum_n": enum(spark, [], "long"),
              "enum_d": enum(spark, [(3, 1.5)], "double"), "enum_column": enum(spark, []), "enum_x": enum(spark, [])}
    return frame, tables


def test_at_once_is_one_by_one(spark):
    frame, tables = wide(spark)
    one, all_ = op.extend_enums(tables, frame), op.extend_enums_at_once(tables, frame)
    assert one.keys() == all_.keys() == {"enum_s", "enum_n", "enum_d", "enum_column"}
    for name in one:
        assert rows_of(one[name]) == rows_of(all_[name]) and one[name].schema == all_[name].schema
    held = {n: all_[n] for n in all_}
    assert rows_of(op.encode_enums_at_once(frame, held)) == rows_of(op.encode_enums(frame, held))
    assert rows_of(op.encode_enums_at_once(frame, tables)) == rows_of(op.encode_enums(frame, tables))
    assert op.extend_enums_at_once({}, frame) == {} and op.encode_enums_at_once(frame, {}) is frame


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_exchanges_do_not_grow_with_columns(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = []
        for columns in (2, 12):
            frame = spark.range(50).select("id", *[(F.col("id") % (n + 2)).cast("string").alias(f"c{n}") for n in range(columns)])
            tables = {f"enum_c{n}": enum(spark, [(1, "0"), (2, "1")]) for n in range(columns)}
            found.append(exchanges(op.encode_enums_at_once(frame, tables)))
        assert found[0] == found[1] > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
