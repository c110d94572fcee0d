from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from barfold.llm import mixing


def mixed(spark, sizes, weights, rest, block_rows):
    rows = [(n, s) for n, s in enumerate(s for s, count in sizes.items() for _ in range(count))]
    frame = spark.createDataFrame(rows, "doc_id long, source string")
    return mixing.mix(frame, weights, rest=rest, block_rows=block_rows).orderBy("position").collect()


@pytest.mark.parametrize("sizes, weights, rest, block_rows", [
    ({"a": 300, "b": 100, "c": 37}, {"a": 2, "b": 3, "c": 1}, 1, 4),
    ({"a": 500, "b": 3, "x": 40, None: 20}, {"a": 1, "b": 5}, 2, 3),
    ({"a": 64, "b": 64}, {"a": 7, "b": 5}, 1, 1),
    ({"a": 5}, {"a": 4, "unseen": 9}, 1, 2),
    ({"*": 9, "a": 10}, {"a": 2}, 3, 2),
])
def test_less_than_a_block_from_target(spark, sizes, weights, rest, block_rows):
    rows = mixed(spark, sizes, weights, rest, block_rows)
    assert [r["position"] for r in rows] == list(range(sum(sizes.values())))
    group = lambda s: s if s in weights else mixing.REST
    totals, blocks = Counter(), []
    for r in rows:
        key = (group(r["source"]), r["block"])
        if not blocks or blocks[-1] != key:
            blocks.append(key)
    assert len(set(blocks)) == len(blocks)  # blocks are whole
    left = Counter({s: sum(1 for b in blocks if b[0] == s) for s in {b[0] for b in blocks}})
    weight = {s: weights.get(s, rest) for s in left}
    # The ideal schedule: time in frames, sources leave when they run out.
    fluid = lambda time: {s: min(Fraction(left[s]), weight[s] * time) for s in left}
    done = Counter()
    for slot, (source, _) in enumerate(blocks):
        low, high = Fraction(0), Fraction(max(Fraction(left[s], weight[s]) for s in left))
        ends = sorted({Fraction(left[s], weight[s]) for s in left} | {low})
        for a, b in zip(ends, ends[1:]):
            if sum(fluid(a).values()) <= slot <= sum(fluid(b).values()):
                rate = sum(weight[s] for s in left if Fraction(left[s], weight[s]) > a)
                high = a + (slot - sum(fluid(a).values())) / rate
                break
        for s, share in fluid(high).items():
            assert abs(done[s] - share) < 1, (slot, s)
        done[source] += 1
    assert done == left


def test_odd_rows(spark, odd_rows, no_rows):
    found = mixing.mix(odd_rows.withColumns({"_source": F.lit("mine"), "block": F.lit("old")}), {"a": 2, "b": 1}, block_rows=2)
    rows = found.collect()
    assert sorted(r["position"] for r in rows) == list(range(odd_rows.count()))
    assert {r["_source"] for r in rows} == {"mine"} and all(isinstance(r["block"], int) for r in rows)
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd_rows.collect())
    assert mixing.mix(no_rows, {"a": 1}).count() == 0
    with pytest.raises(ValueError, match="positive"):
        mixing.mix(no_rows, {"a": 0})


def test_no_python_in_the_plan(spark, odd_rows):
    plan = mixing.mix(odd_rows, {"a": 2})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_rows_of_one_number_have_a_defined_order(spark):
    rows = [(n % 3, f"text {n}", "ab"[n % 2], {"k": n}) for n in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, more map<string,int>")
    places = [
        {r["text"]: r["position"] for r in mixing.mix(f, {"a": 2, "b": 1}, block_rows=4).collect()}
        for f in (frame, frame.repartition(7), frame.orderBy(F.rand(3)))]
    assert places[0] == places[1] == places[2]
