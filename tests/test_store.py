import os
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold.plans import stored_return
from barfold.schema import BUCKETS, STOCK_RETURN, STOCKS, Partition, TableSpec, enum_spec
from barfold.sources.store import ConcurrentChange, Store
from tests.conftest import rows_of

SPEC = TableSpec(
    "t",
    T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.StringType())]),
    ("k",), (Partition("tens", "{} div 10", "k", True),),
)


@pytest.fixture
def store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create(SPEC, STOCKS)
    return store


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def test_an_empty_table_has_its_columns(store):
    assert store.read("t").columns == ["k", "v"]
    assert store.read("t").count() == 0
    assert store.names() == ["stocks", "t"]
    assert store.spec("t") == SPEC


def test_definitions_outlive_the_object(spark, store):
    again = Store(spark, store.root)
    assert again.spec("t").primary_key == ("k",)
    assert again.registry().nullable_fields("t") == ["v"]
    again.create(STOCK_RETURN, SPEC)
    assert again.names() == ["stock_return", "stocks", "t"]


def test_publish_and_read_back(spark, store):
    store.publish({"t": frame(spark, [(1, "a"), (11, "b")])})
    assert rows_of(store.read("t")) == [(1, "a"), (11, "b")]
    store.publish({"t": store.read("t").where("k > 5")})
    assert rows_of(store.read("t")) == [(11, "b")]
    assert rows_of(store.read("t", version=2)) == [(1, "a"), (11, "b")]


def test_a_failing_job_publishes_nothing(spark, store):
    store.publish({"t": frame(spark, [(1, "a")])})
    before = store.version()
    broken = frame(spark, [(1, "x"), (25, "y")]).withColumn(
        "v", F.when(F.col("k") == 25, F.raise_error(F.lit("broken row"))).otherwise(F.col("v")))
    good = spark.createDataFrame([(1, "n", "HKD", "HK", "1.HK")], STOCKS.schema)
    for change in (store.publish, store.upsert):
        with pytest.raises(Exception, match="broken row"):
            change({"stocks": good, "t": broken})
    assert store.version() == before
    assert rows_of(store.read("t")) == [(1, "a")]
    assert store.read("stocks").count() == 0


def test_upsert_rewrites_only_the_partitions_it_touches(spark, store):
    store.publish({"t": frame(spark, [(1, "a"), (11, "b"), (21, "c")])})
    before = store._entry("t")["parts"]
    store.upsert({"t": frame(spark, [(11, "B"), (12, "n"), (35, "z"), (None, "gone")])})
    after = store._entry("t")["parts"]
    assert rows_of(store.read("t")) == [(1, "a"), (11, "B"), (12, "n"), (21, "c"), (35, "z")]
    assert {p for p in after if after[p] == before.get(p)} == {"tens=0", "tens=2"}
    assert os.listdir(f"{store.root}/staging") == []


def test_upsert_by_other_columns(spark, store):
    store.publish({"t": frame(spark, [(1, "a"), (11, "a"), (21, "c")])})
    store.upsert({"t": frame(spark, [(5, "a")])}, by={"t": ["v"]})
    assert rows_of(store.read("t")) == [(21, "c"), (5, "a")]


def test_replacing_dates_rewrites_only_their_years(spark, store):
    store.create(STOCK_RETURN)
    day = {y: date(y, 6, 1) for y in (1999, 2000, 2001)}
    rows = [(s, d, *[1.0] * 6) for s in (1, 2) for d in day.values()]
    store.publish({"stock_return": spark.createDataFrame(rows, STOCK_RETURN.schema)})
    before = store._entry("stock_return")["parts"]
    new = spark.createDataFrame([(3, day[2000], *[2.0] * 6)], STOCK_RETURN.schema)
    store.upsert({"stock_return": new}, by={"stock_return": ["Date"]})
    after = store._entry("stock_return")["parts"]
    assert rows_of(store.read("stock_return").where("Date = '2000-06-01'"), "sec_id") == [(3,)]
    kept = {p.split("/")[1] for p in after if after[p] == before.get(p)}
    assert kept == {"year=1999", "year=2001"}
    assert not {p for p in after if p.endswith("year=2000")} & {p for p in after if after[p] == before.get(p)}


def test_upsert_of_different_rows_with_one_key_fails(spark, store):
    with pytest.raises(Exception, match="share the key"):
        store.upsert({"t": frame(spark, [(1, "a"), (1, "b")])})
    assert store.read("t").count() == 0


def test_compact_keeps_the_rows(spark, store):
    for i in range(4):
        store.upsert({"t": frame(spark, [(i, "a"), (10 + i, "b")])})
    rows = rows_of(store.read("t"))
    store.compact("t")
    assert rows_of(store.read("t")) == rows and len(rows) == 8
    assert len(store.read("t").inputFiles()) == 2
    with pytest.raises(KeyError):
        store.compact("nope")


def test_expire_frees_old_versions_only(spark, store):
    store.publish({"t": frame(spark, [(1, "a"), (11, "b")])})
    old = store._directories(store.version())
    store.upsert({"t": frame(spark, [(1, "A")])})
    store.expire(keep=2)
    assert rows_of(store.read("t", store.version() - 1)) == [(1, "a"), (11, "b")]
    store.expire()
    store.expire()
    assert rows_of(store.read("t")) == [(1, "A"), (11, "b")]
    left = {d for d in old if os.path.exists(f"{store.root}/{d}")}
    assert left == old & store._directories(store.version()) and len(left) == 1
    with pytest.raises(ValueError):
        store.expire(0)


def test_the_slower_of_two_writers_fails(spark, store):
    base = store.version()
    store.publish({"t": frame(spark, [(1, "first")])})
    with pytest.raises(ConcurrentChange):
        store._switch(base, store._manifest(base))
    assert rows_of(store.read("t")) == [(1, "first")]


def test_dictionaries_are_found_by_name(spark, store):
    store.create(enum_spec("sector"))
    store.publish({"enum_sector": spark.createDataFrame([(1, "x")], "id long, value string")})
    assert list(store.dictionaries()) == ["enum_sector"]


@pytest.fixture
def series(spark, store):
    store.create(STOCK_RETURN)
    rows = [(s, date(y, 6, d), *[float(s)] * 6) for s in range(1, 60) for y in (1999, 2000, 2001) for d in (1, 9)]
    store.publish({"stock_return": spark.createDataFrame(rows, STOCK_RETURN.schema)})
    return store


def test_series_are_in_buckets_and_years(series):
    parts = [p.split("/") for p in series._entry("stock_return")["parts"]]
    assert {y for _, y in parts} == {"year=1999", "year=2000", "year=2001"}
    assert 10 < len({b for b, _ in parts}) <= BUCKETS


def test_a_month_opens_one_year(series):
    one = stored_return(series, date(2000, 6, 1), date(2000, 6, 5))
    assert one.count() == 59
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "2000" in filters
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    files = scan.selectedPartitions().totalNumberOfFiles()
    assert 0 < files <= BUCKETS < len(series.read("stock_return").inputFiles())
    assert stored_return(series).count() == series.read("stock_return").count()
    assert stored_return(series, date(2002, 1, 1)).count() == 0


def test_one_security_opens_one_bucket(series):
    one = series.read("stock_return", between={"sec_id": (7, 7), "Date": (None, date(2000, 6, 1))})
    assert rows_of(one, "sec_id", "Date") == [(7, date(y, 6, d)) for y, d in ((1999, 1), (1999, 9), (2000, 1))]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_replacing_securities_rewrites_only_their_buckets(spark, series):
    before = series._entry("stock_return")["parts"]
    new = spark.createDataFrame([(7, date(2005, 6, 1), *[2.0] * 6)], STOCK_RETURN.schema)
    series.upsert({"stock_return": new}, by={"stock_return": ["sec_id"]})
    after = series._entry("stock_return")["parts"]
    changed = {p.split("/")[0] for p in after.keys() | before.keys() if after.get(p) != before.get(p)}
    assert len(changed) == 1
    assert rows_of(series.read("stock_return").where("sec_id = 7"), "Date") == [(date(2005, 6, 1),)]
    assert series.read("stock_return").count() == 58 * 6 + 1


def test_partitions_are_checked(spark):
    for column, name in (("v", "x"), ("k", "v"), ("k", "change")):
        with pytest.raises(ValueError, match="partition"):
            TableSpec("t", SPEC.schema, ("k",), (Partition(name, "{}", column),))


def test_source_rows_are_written_once_and_told_by_added(spark, store):
    store.publish({"t": frame(spark, [(1, "a"), (2, "b"), (11, "c")])})
    kept = store._entry("t")["parts"]["tens=1"]
    with store.change() as change:
        change.upsert({"t": frame(spark, [(2, "z"), (2, "z"), (25, "new"), (None, "lost")])})
        assert rows_of(change.added("t")) == [(2, "z"), (25, "new")]
    assert rows_of(store.read("t")) == [(1, "a"), (11, "c"), (2, "z"), (25, "new")]
    parts = store._entry("t")["parts"]
    assert parts["tens=1"] == kept and len(parts["tens=0"]) == 2 and len(parts["tens=2"]) == 1
    with pytest.raises(Exception, match="share the key"):
        store.upsert({"t": frame(spark, [(3, "x"), (3, None)])})


def test_an_empty_table_drops_out_of_joins_before_they_run(spark, store):
    joined = frame(spark, [(1, "a")]).join(store.read("t").select("k"), "k", "left_anti")
    assert "Join" not in joined._jdf.queryExecution().optimizedPlan().toString()
