"""One Spark query per operator, each over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold import operators as op
from barfold import sources as src
from barfold.functions import lag_cum_chg, lag_cum_chg_na, pct_chg
from barfold.plans import refresh_stored, stored_return, update_all
from barfold.schema import KEY, LEVELS, MARKET_TABLES, ON, Partition, TableSpec
from barfold.sources.store import Store
from workload import standins as make

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RESUME_BEFORE = date(1998, 1, 1)
FETCH_END = date(2000, 12, 31)
FIRST_RUN_END = date(2000, 6, 30)


def query(build: Callable[[make.Inputs], DataFrame]) -> Callable[[make.Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(make.tables(spark, sf_dir))
    return build


def _returns(t: make.Inputs) -> DataFrame:
    return op.returns(make.bars(t))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{src.checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Bars, changes, levels


@query
def bars(t):
    return make.bars(t)


@query
def pct_change(t):
    """The change expression by itself, on a column that is zero and negative at times."""
    ordered = Window.partitionBy(KEY).orderBy(ON)
    return make.bars(t).select(
        KEY, ON, pct_chg("high", ordered).alias("high_chg"),
        pct_chg(F.col("volume") - 25, ordered).alias("volume_chg"),
    )


@query
def cumulative_change(t):
    """The two product expressions by themselves."""
    ordered = Window.partitionBy(KEY).orderBy(F.desc(ON))
    return _returns(t).select(
        KEY, ON, F.round(lag_cum_chg("volume", ordered), 6).alias("lagged"),
        F.round(lag_cum_chg_na("volume", ordered), 6).alias("lagged_na"),
    )


@query
def price_returns(t):
    return op.price_returns(make.bars(t))


@query
def volume_returns(t):
    return op.volume_returns(make.bars(t))


@query
def return_table(t):
    return _returns(t)


@query
def last_price(t):
    return op.last_price(make.bars(t))


@query
def last_volume(t):
    return op.last_volume(make.bars(t))


@query
def reconstruct(t):
    b = make.bars(t)
    return op.reconstruct(op.returns(b), op.last_price(b), op.last_volume(b))


@query
def price_history(t):
    return op.price_history(make.bars(t))


@query
def returns_revised(t):
    """Returns of bars of which a fifth come late and a few were wrong at first, corrected around those bars alone."""
    whole = src.materialise(make.bars(t))
    day = F.datediff(ON, F.lit("1990-01-01")) + F.col(KEY)
    wrong = whole.withColumn("close", F.when(day % 7 == 1, F.col("close") * 2).otherwise(F.col("close"))).withColumn(
        "volume", F.when(day % 11 == 1, 0.0).otherwise(F.col("volume")))
    early = wrong.where(day % 5 != 0)
    return op.returns_revised(early, op.returns(early), whole.where((day % 5 == 0) | (day % 7 == 1) | (day % 11 == 1)))


@query
def return_table_in_spans(t):
    return op.returns(make.bars(t), span_days=365)


@query
def price_history_in_spans(t):
    return op.price_history(make.bars(t), span_days=365)


@query
def roundtrip_diff(t):
    diffs = op.roundtrip_diff(make.bars(t))
    return diffs.select(
        KEY, ON, *LEVELS,
        *[(F.round(f"{c}_diff", 6) + F.lit(0.0)).alias(f"{c}_diff") for c in LEVELS],
    )


@query
def refresh_prices(t):
    """A price table that fell behind, caught up from the stored return and last tables."""
    b = src.materialise(make.bars(t))
    changes, prices, volumes = (
        src.materialise(table) for table in (op.returns(b), op.last_price(b), op.last_volume(b))
    )
    stored = src.materialise(make.stored_prices(t, op.reconstruct(changes.repartition(KEY), prices, volumes)))
    return op.refresh_prices(make.stocks(t), changes, stored, prices, volumes)


def _days_back(rows: DataFrame, days: int) -> DataFrame:
    return rows.withColumn(ON, F.date_sub(ON, days))


@query
def refresh_prices_early(t):
    """The same some hundred years earlier, over a price table that is partly empty."""
    b = src.materialise(_days_back(make.bars(t), 36524))
    changes, prices, volumes = (
        src.materialise(table) for table in (op.returns(b), op.last_price(b), op.last_volume(b))
    )
    late = make.stored_prices(t, _days_back(op.reconstruct(changes.repartition(KEY), prices, volumes), -36524))
    stored = src.materialise(_days_back(late, 36524))
    return op.refresh_prices(make.stocks(t), changes, stored, prices, volumes)


@query
def refresh_stored_prices(t):
    """The same catch-up in a store, merged into the partitions it touches."""
    b = src.materialise(make.bars(t))
    store = Store(b.sparkSession, _scratch(b.sparkSession, "market"))
    store.create(*MARKET_TABLES)
    store.publish({"stocks": make.stocks(t), "stock_return": op.returns(op.by_security(b)),
                   "last_price": op.last_price(b), "last_volume": op.last_volume(b)}, laid_out=True)
    changes, prices, volumes = (store.read(name) for name in ("stock_return", "last_price", "last_volume"))
    history = op.reconstruct(op.by_security(changes), prices, volumes)
    store.publish({"stock_price": make.stored_prices(t, history)}, laid_out=True)
    refresh_stored(store)
    return store.read("stock_price")


@query
def refresh_prices_small_drift(t):
    """Stored levels off by a millionth of a unit, with volumes near a billion."""
    b = src.materialise(make.bars(t).withColumn("volume", F.col("volume") * 1e7))
    changes, prices, volumes = (
        src.materialise(table) for table in (op.returns(b), op.last_price(b), op.last_volume(b))
    )
    stored = src.materialise(
        op.reconstruct(changes.repartition(KEY), prices, volumes)
        .where(F.col(ON) <= F.lit(FIRST_RUN_END))
        .withColumn("close", F.round(F.col("close") + F.when(F.pmod(KEY, F.lit(2)) == 0, 1e-6).otherwise(0.0), 6))
    )
    found = op.refresh_prices(make.stocks(t), changes, stored, prices, volumes)
    return found.withColumn("volume", F.round("volume", 0))


# Sources


@query
def securities_first(t):
    return src.first_per_security(make.securities(t))


@query
def fetch_bars(t):
    resume = op.max_date(make.stocks(t), _returns(t), before=RESUME_BEFORE)
    return src.select_bars(make.quotes(t), resume, FETCH_END)


def _csv(t, name: str, rows: DataFrame) -> str:
    path = _scratch(rows.sparkSession, name)
    rows.select(*sorted(rows.columns, reverse=True)).write.csv(path, header=True)
    return path


@query
def fetch_bars_resumed(t):
    """Bars from each security's resume date; every other security was never stored and needs all of them."""
    stored = _returns(t).where(F.pmod(KEY, F.lit(2)) == 0)
    resume = op.max_date(make.stocks(t), stored, before=RESUME_BEFORE, default=None)
    return src.select_bars(make.quotes(t), resume, FETCH_END)


@query
def read_bars_csv(t):
    """Bars from CSV files whose columns stand in another order."""
    path = _csv(t, "quotes", make.quotes(t))
    return src.read_bars(make.quotes(t).sparkSession, [path], "csv", end=FETCH_END)


@query
def read_securities_csv(t):
    """Two CSV sheets whose columns stand in another order, one of them lacking a column."""
    rows = make.securities(t)
    sheets = [rows.where(F.col("sheet_ord") == n).drop("sheet_ord", *more) for n, more in ((0, ["ccy"]), (1, []))]
    paths = [_csv(t, "sheet", sheet) for sheet in sheets]
    return src.read_securities(rows.sparkSession, paths)


@query
def normalise_bars(t):
    return src.normalise_bars(make.quotes(t), make.stocks(t))


@query
def stack_sheets(t):
    """Sheets with different columns, stacked by name."""
    supplier = t("supplier").select(F.col("s_suppkey").alias("sec_id"), F.col("s_name").alias("name"),
                                    F.col("s_acctbal").alias("balance"))
    customer = t("customer").select(F.col("c_mktsegment").alias("segment"),
                                    F.col("c_custkey").alias("sec_id"), F.col("c_name").alias("name"))
    return src.stack([supplier, customer])


@query
def conform(t):
    return src.conform(make.changed_rows(t), make.target(t).schema)


@query
def iso_text(t):
    return src.iso_text(t("orders").select("o_orderkey", "o_orderdate",
                                           F.to_date("o_orderdate").alias("o_date")))


@query
def key_values(t):
    listed = src.key_values(make.changed_rows(t), ["o_custkey", "o_date", "no_such_column"])
    return reduce(DataFrame.unionAll, [
        v.select(F.lit(k).alias("key"), F.col(k).cast("string").alias("value"))
        for k, v in listed.items()
    ])


# Lookups


@query
def return_range(t):
    return op.get_return(_returns(t), date(1996, 1, 1), date(1998, 6, 30))


@query
def return_range_stored(t):
    """The same from a stored table, of which only the years in question are opened."""
    rows = _returns(t)
    store = Store(rows.sparkSession, _scratch(rows.sparkSession, "market"))
    store.create(*MARKET_TABLES)
    store.publish({"stock_return": rows})
    return stored_return(store, date(1996, 1, 1), date(1998, 6, 30))


@query
def max_date(t):
    return op.max_date(make.stocks(t), _returns(t), before=RESUME_BEFORE)


@query
def max_date_positive(t):
    return op.max_date(make.stocks(t), _returns(t), before=None, volume_filter="positive")


@query
def max_date_notnull(t):
    return op.max_date(make.stocks(t), _returns(t), before=None, volume_filter="notnull",
                       default=None)


@query
def last_date(t):
    b = src.materialise(make.bars(t))
    return op.last_date(make.stocks(t), op.returns(b), make.stored_prices(t, op.price_history(b)),
                        op.last_price(b), with_symbol=True)


@query
def param_query(t):
    found = op.param_query(make.bars(t), make.date_ranges(t), between={ON: ("lo", "hi")})
    return found.select("param_no", KEY, ON, "close", "volume")


@query
def param_query_by_security(t):
    found = op.param_query(make.bars(t), make.security_ranges(t), equal={KEY: "wanted"},
                           between={ON: ("lo", "hi")})
    return found.select("param_no", KEY, ON, "close", "volume")


def _with_outlier(rows: DataFrame) -> DataFrame:
    """Bars and one far from all others."""
    far = F.to_date(F.lit("9000-01-01"))
    return rows.unionByName(rows.agg(F.min(KEY).alias(KEY), *[
        F.lit(1.0).alias(c) for c in LEVELS]).withColumn(ON, far))


@query
def param_query_outlier(t):
    found = op.param_query(_with_outlier(make.bars(t)), make.date_ranges(t), between={ON: ("lo", "hi")})
    return found.select("param_no", KEY, ON, "close", "volume")


@query
def param_query_before(t):
    """The latest date with volume strictly before each range begins, one row per range."""
    traded = make.bars(t).where("volume > 0")
    return op.param_query(traded, make.date_ranges(t).select("param_no", "lo"), within={ON: (None, "lo")},
                          agg={"latest": ("max", ON), "n_bars": ("count", KEY)})


@query
def param_query_from(t):
    """Per security wanted: bars, volume and lowest close from the date on; each parameter row is given twice."""
    asked = make.security_ranges(t).select("param_no", "wanted", "lo")
    return op.param_query(make.bars(t), asked.unionAll(asked), equal={KEY: "wanted"}, between={ON: ("lo", None)},
                          agg={"n_bars": ("count", KEY), "traded": ("sum", "volume"), "lowest": ("min", "close")})


@query
def param_query_repeated(t):
    """Aggregates over two-sided ranges, each parameter row given twice."""
    asked = make.security_ranges(t)
    return op.param_query(make.bars(t), asked.unionAll(asked), equal={KEY: "wanted"}, between={ON: ("lo", "hi")},
                          agg={"n_rows": F.count("*"), "latest": F.max(ON)})


def _asof(t, hot):
    prices = make.bars(t).where("close > 0").select(KEY, F.col(ON).alias("day"), "close")
    return op.asof(make.asked_dates(t, hot), prices, ("asked", "day"), [KEY])


@query
def asof_price(t):
    """The last close on or before each order's date."""
    return _asof(t, hot=False)


@query
def asof_price_hot(t):
    """The same where one security has half of the rows."""
    return _asof(t, hot=True)


@query
def asof_next_order(t):
    """Each customer order with the next later one of the same customer."""
    orders = t("orders").select("o_custkey", "o_orderkey")
    return op.asof(orders, orders.withColumn("next", F.col("o_orderkey")).select("o_custkey", "next", F.col("next").alias("at")),
                   ("o_orderkey", "at"), ["o_custkey"], ["next"], direction="next", strict=True)


# Keyed maintenance


@query
def delete_matching(t):
    return op.delete_matching(make.target(t), make.changed_rows(t), ["o_orderkey"])


@query
def delete_keyless(t):
    """Everything goes where the source has rows, nothing where it has none."""
    none = make.changed_rows(t).where("o_date < '1900-01-01'")
    emptied = op.delete_matching(make.target(t), make.changed_rows(t), [])
    return op.delete_matching(make.target(t), none, []).unionByName(emptied)


@query
def insert_absent(t):
    return op.insert_absent(make.target(t), make.changed_rows(t), ["o_orderkey"])


@query
def upsert(t):
    return op.upsert(make.target(t), make.changed_rows(t), ["o_orderkey"])


@query
def replace_by_date(t):
    return op.replace_by(make.target(t), make.latest_orders(t), "o_date", ["o_orderkey"])


@query
def replace_by_many(t):
    return op.replace_by(make.target(t), make.latest_orders(t), ["o_date", "o_custkey"],
                         ["o_orderkey"])


@query
def drop_unchanged(t):
    return op.drop_unchanged(t("events").select("user_id", "event_id", "event_type"),
                             "event_id", ["user_id"])


@query
def drop_unchanged_uneven(t):
    """Ordinals from one end of the integers to the other, most of them close together, in cut keys."""
    most = 9223372036854775807
    place = (F.when(F.col("event_id") % 997 == 0, F.col("event_id") - most)
             .when(F.col("event_id") % 991 == 0, most - F.col("event_id")).otherwise(F.col("event_id")))
    rows = t("events").select((F.col("user_id") % 3).alias("user_id"), place.alias("event_id"), "event_type")
    return op.drop_unchanged(rows, "event_id", ["user_id"], rows_per_span=100)


@query
def drop_unchanged_append(t):
    """Two thirds of the events, then the others, most of them late, against them."""
    rows = t("events").select("user_id", "event_id", "event_type")
    late = F.pmod("event_id", F.lit(3)) == 0
    stored = src.materialise(op.drop_unchanged(rows.where(~late), "event_id", ["user_id"]))
    return op.drop_unchanged_append(stored, rows.where(late), "event_id", ["user_id"])


@query
def drop_unchanged_status(t):
    """A customer's orders whose status differs from that of the order before."""
    orders = t("orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    return op.drop_unchanged(orders, "o_orderkey", ["o_custkey"], ["o_orderstatus"])


ORDERS = TableSpec(
    "orders",
    T.StructType([
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_date", T.DateType()),
    ]),
    ("o_orderkey",), (Partition("part", "pmod(xxhash64({}), 16)", "o_orderkey"),),
)


@query
def publish_and_compact(t):
    """Publish a partitioned table, merge rows into it, compact it, read it back."""
    target = make.target(t)
    store = Store(target.sparkSession, _scratch(target.sparkSession, "orders"))
    store.create(ORDERS)
    store.publish({"orders": target})
    store.upsert({"orders": make.changed_rows(t)})
    store.compact("orders")
    return store.read("orders")


@query
def update_all_prices(t):
    """Two daily updates, the second resuming where the first ended; the price table."""
    quotes = src.materialise(make.quotes(t))
    store = Store(quotes.sparkSession, _scratch(quotes.sparkSession, "market"))
    update_all(store, make.stocks(t), quotes, end=FIRST_RUN_END)
    update_all(store, make.stocks(t), quotes, start=FIRST_RUN_END)
    return store.read("stock_price")


@query
def update_all_restated(t):
    """An update with all bars, then one with the restated bars of a few securities alone."""
    bars = src.materialise(make.bars(t))
    restated = make.restated(bars).where(F.pmod(KEY, F.lit(10)) == 3)
    store = Store(bars.sparkSession, _scratch(bars.sparkSession, "market"))
    update_all(store, make.stocks(t), make.feed(bars))
    update_all(store, make.stocks(t), make.feed(restated))
    return store.read("stock_price")


@query
def update_all_interrupted(t):
    """Returns and last levels of a first run without their prices, then two runs."""
    quotes = src.materialise(make.quotes(t))
    spark, stocks = quotes.sparkSession, make.stocks(t)
    store = Store(spark, _scratch(spark, "market"))
    store.create(*MARKET_TABLES)
    fetched = src.materialise(src.normalise_bars(src.select_bars(quotes, end=RESUME_BEFORE), stocks))
    store.upsert({"stocks": stocks, "last_price": op.last_price(fetched),
                  "last_volume": op.last_volume(fetched), "stock_return": op.returns(fetched)})
    update_all(store, stocks, quotes, start=RESUME_BEFORE, end=FIRST_RUN_END)
    update_all(store, stocks, quotes, start=FIRST_RUN_END)
    return store.read("stock_price")


# Dictionaries


@query
def extend_enum(t):
    return op.extend_enum(make.brand_dictionary(t), make.parts(t), "p_brand")


@query
def extend_enum_wide(t):
    """A column with about as many values as the table has rows, over a partial dictionary."""
    names = t("supplier").select(F.concat(F.lit("Customer"), F.substring("s_name", 9, 20)).alias("n"))
    return op.extend_enum(make.dictionary(names, "n"), t("customer"), "c_name")


@query
def extend_enums(t):
    tables = {"enum_p_brand": make.brand_dictionary(t), "enum_p_type": make.type_dictionary(t),
              "enum_elsewhere": make.type_dictionary(t)}
    extended = op.extend_enums(tables, make.parts(t))
    return reduce(DataFrame.unionByName, [
        rows.select(F.lit(name).alias("name"), "id", "value") for name, rows in extended.items()
    ])


@query
def encode_enums(t):
    tables = {"enum_p_brand": make.brand_dictionary(t), "enum_p_type": make.type_dictionary(t)}
    return op.encode_enums(make.parts(t), tables)


@query
def extend_enums_at_once(t):
    """Dictionaries of text, numbers and dates extended in one pass."""
    extended = op.extend_enums_at_once(make.wide_dictionaries(t), make.wide_codes(t))
    return reduce(DataFrame.unionByName, [
        rows.select(F.lit(name).alias("name"), "id", F.col("value").cast("string").alias("value"))
        for name, rows in extended.items()
    ])


@query
def encode_enums_wide(t):
    """The same columns encoded in one pass, values without an id among them."""
    return op.encode_enums_at_once(make.wide_codes(t), make.wide_dictionaries(t))
