"""As-of joins, running aggregates and appended change logs against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from barfold import operators as op
from tests.conftest import rows_of

LEFT = "id long, k string, at long"
RIGHT = "key string, on long, v long"


def sample(seed, hot=False):
    draw = random.Random(seed)
    key = lambda: "a" if hot and draw.random() < 0.7 else draw.choice(["a", "b", "c", None])
    left = [(n, key(), draw.choice([None, *range(60)])) for n in range(150)] + [(7, "a", 30), (7, "a", 30)]
    right = {(key(), draw.choice([None, *range(0, 60, 3)])): draw.randint(0, 9) for _ in range(60)}
    return left, [(k, at, v) for (k, at), v in right.items()] + [(None, 1, 1), (None, 1, 2)]


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("direction", ["previous", "next"])
@pytest.mark.parametrize("strict", [False, True])
def test_asof(spark, direction, strict, hot):
    left, right = sample(3, hot)
    found = op.asof(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ("at", "on"), {"k": "key"},
                    direction=direction, strict=strict)
    want = []
    for n, k, at in left:
        sign = 1 if direction == "previous" else -1
        near = [(sign * o, o, v) for key, o, v in right if None not in (k, at, o) and key == k
                and (sign * o < sign * at or (o == at and not strict))]
        want.append((n, k, at, *(max(near)[1:] if near else (None, None))))
    assert rows_of(found) == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_asof_without_keys_and_its_errors(spark):
    left, right = spark.createDataFrame([(1, "x", 5), (2, "x", 0)], LEFT), spark.createDataFrame([("a", 3, 1), ("b", 9, 2)], RIGHT)
    assert rows_of(op.asof(left, right, ("at", "on"), columns=["v"])) == [(1, "x", 5, 1), (2, "x", 0, None)]
    assert rows_of(op.asof(left, right.limit(0), ("at", "on"), columns=["v"]), "v") == [(None,), (None,)]
    assert op.asof(left.limit(0), right, ("at", "on")).count() == 0
    with pytest.raises(Exception, match="not unique"):
        op.asof(left, right.unionAll(right), ("at", "on")).collect()
    with pytest.raises(ValueError, match="both sides"):
        op.asof(left, right.withColumnRenamed("v", "id"), ("at", "on"))
    with pytest.raises(ValueError, match="direction"):
        op.asof(left, right, ("at", "on"), direction="up")


@pytest.mark.parametrize("falling", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_aggregate_up_to(spark, falling, strict):
    left, right = sample(5, True)
    agg = {"n": ("count", "v"), "total": ("sum", "v"), "low": ("min", "v"), "high": ("max", "on")}
    table = spark.createDataFrame([*right, ("a", 12, None)], RIGHT)
    found = op.aggregate_up_to(table, spark.createDataFrame(left, LEFT), ("on", "at"), agg, {"key": "k"}, falling, strict)
    want = []
    for n, k, at in left:
        rows = [(o, v) for key, o, v in [*right, ("a", 12, None)] if None not in (k, at, o) and key == k
                and ((o > at if falling else o < at) or (o == at and not strict))]
        vs = [v for _, v in rows if v is not None]
        want.append((n, k, at, len(vs), sum(vs) if vs else None, min(vs, default=None), max((o for o, _ in rows), default=None)))
    assert rows_of(found) == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
    with pytest.raises(ValueError, match="no running"):
        op.aggregate_up_to(table, table, ("on", "on"), {"x": ("avg", "v")})


def test_one_sided_parameters_form_no_pairs(spark):
    table = spark.range(1000).select(F.col("id").alias("on"))
    asked = spark.range(500).select(F.col("id").alias("lo"))
    found = op.param_query(table, asked, within={"on": (None, "lo")}, agg={"n": ("count", "on")})
    assert set(rows_of(found)) == {(n, n) for n in range(500)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_repeated_parameter_rows_are_runs_of_their_own(spark):
    table = spark.createDataFrame([(n, n) for n in range(1, 6)], "at long, x long")
    asked = spark.createDataFrame([(1, 3), (1, 3), (8, 9), (None, 2)], "lo long, hi long")
    agg = {"n": F.count("*"), "xs": F.coalesce(F.max("x"), F.lit(-1))}
    found = op.param_query(table, asked, between={"at": ("lo", "hi")}, agg=agg)
    assert rows_of(found) == [(None, 2, 0, -1), (1, 3, 3, 3), (1, 3, 3, 3), (8, 9, 0, -1)]


@pytest.mark.parametrize("seed", range(3))
def test_append_is_the_full_run(spark, seed):
    draw = random.Random(seed)
    places = draw.sample(range(300), 160)
    rows = [(draw.choice("aab"), n, draw.choice(["x", "x", "y", "", None]), draw.choice([1, None])) for n in places]
    rows += [(None, 1, "x", 1), (None, 1, "x", 1)]
    kind = "k string, at long, v string, w long"
    cut = draw.choice([20, 80, 140])
    clean = op.drop_unchanged(spark.createDataFrame(rows[cut:], kind), "at", ["k"]).collect()
    stored = spark.createDataFrame(clean, kind)
    batch = spark.createDataFrame(rows[:cut], kind)
    found = op.drop_unchanged_append(stored, batch, "at", ["k"])
    assert rows_of(found) == rows_of(op.drop_unchanged(stored.unionByName(batch), "at", ["k"]))
    one = op.drop_unchanged_append(stored, batch, "at", ["k"], ["v"])
    again = op.drop_unchanged(stored.unionByName(batch), "at", ["k"], ["v"])
    if op.drop_unchanged(stored, "at", ["k"], ["v"]).count() == stored.count():
        assert rows_of(one) == rows_of(again)


def test_append_raises_on_a_repeated_ordinal(spark):
    frame = spark.createDataFrame([("a", 1, "x")], "k string, at long, v string")
    with pytest.raises(Exception, match="not unique"):
        op.drop_unchanged_append(frame, frame, "at", ["k"]).collect()
