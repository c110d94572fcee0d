"""Market-shaped inputs derived from the test tables.

The test tables hold no price series. Each function derives one input from whole
tables; ``workload/oracle.py`` states the same in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barfold.operators import extend_enum
from barfold.sources import first_per_security

Inputs = Callable[[str], DataFrame]


def tables(spark: SparkSession, sf_dir: str) -> Inputs:
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(t: Inputs) -> DataFrame:
    """One bar per supplier and ship date.

    A day whose lowest line number is 7 is a halt, with 0 in every column (a null
    adjusted close). Lines with return flag R carry no volume.
    """
    price = F.col("l_extendedprice")
    traded = F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_quantity"))
    # In order: the price of two lines that differ in their discount alone is the same.
    line = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    halted = F.col("first_line") == 7

    def unless_halted(value: Column | str) -> Column:
        return F.when(halted, 0.0).otherwise(F.col(value))

    return (
        t("lineitem")
        .select(F.col("l_suppkey").alias("sec_id"), F.to_date("l_shipdate").alias("Date"), *line, "l_discount",
                traded.alias("traded"))
        # Days have few lines: these are narrower than what aggregates of them would carry through the shuffle.
        .repartition("sec_id", "Date")
        .groupBy("sec_id", "Date")
        .agg(
            F.min("l_linenumber").alias("first_line"),
            F.min(F.struct(*line)).alias("first"),
            F.max(F.struct(*line, "l_discount")).alias("last"),
            F.max(price).alias("top"),
            F.min(price).alias("bottom"),
            F.sum("traded").alias("traded"),
        )
        .select(
            "sec_id", "Date",
            unless_halted("first.l_extendedprice").alias("open"),
            unless_halted("top").alias("high"),
            unless_halted("bottom").alias("low"),
            unless_halted("last.l_extendedprice").alias("close"),
            F.when(~halted, F.col("last.l_extendedprice") * (1 - F.col("last.l_discount")))
            .alias("adj_close"),
            unless_halted("traded").alias("volume"),
        )
    )


def quotes(t: Inputs) -> DataFrame:
    """The bars as a feed would deliver them: by symbol, no volume instead of 0."""
    return feed(bars(t))


def feed(rows: DataFrame) -> DataFrame:
    return rows.select(
        symbol_of("sec_id").alias("symbol"), F.col("Date").alias("date"),
        "open", "high", "low", "close",
        F.when(F.col("volume") != 0, F.col("volume")).alias("volume"),
        F.col("adj_close").alias("adjusted"),
    )


def restated(rows: DataFrame) -> DataFrame:
    """Bars after a split: every tenth security has half the price and twice the volume before 1996."""
    split = (F.pmod("sec_id", F.lit(10)) == 3) & (F.col("Date") < F.lit("1996-01-01").cast("date"))
    factor = {c: 2.0 if c == "volume" else 0.5 for c in rows.columns if c not in ("sec_id", "Date")}
    return rows.withColumns({c: F.when(split, F.col(c) * f).otherwise(F.col(c)) for c, f in factor.items()})


def symbol_of(sec_id: str) -> Column:
    return F.concat(F.lpad(F.col(sec_id).cast("string"), 8, "0"), F.lit(".SW"))


def securities(t: Inputs) -> DataFrame:
    """Two sheets with overlapping ids: suppliers, then customers."""
    def sheet(name: str, number: int, prefix: str) -> DataFrame:
        rows = t(name)
        key = f"{prefix}_{'suppkey' if prefix == 's' else 'custkey'}"
        return rows.select(
            F.lit(number).alias("sheet_ord"), F.col(key).alias("row_ord"),
            F.col(key).alias("sec_id"), F.col(f"{prefix}_name").alias("name"),
            F.lit("CHF").alias("ccy"), F.lit("SW").alias("exch_yahoo"),
            symbol_of(key).alias("id_yahoo"),
        )
    return sheet("supplier", 0, "s").unionByName(sheet("customer", 1, "c"))


def stocks(t: Inputs) -> DataFrame:
    """The master: securities of both sheets, most of which have no bars."""
    return first_per_security(securities(t))


def target(t: Inputs) -> DataFrame:
    """A table keyed by ``o_orderkey``."""
    return t("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.to_date("o_orderdate").alias("o_date"),
    )


def changed_rows(t: Inputs) -> DataFrame:
    """Rows to merge into ``target``, one per shipped order.

    Keys are doubled, so about half of them are new; orders whose first line is 7
    have no key. ``ignored`` is not a field of the target.
    """
    return (
        t("lineitem").groupBy("l_orderkey")
        .agg(F.min("l_linenumber").alias("first_line"), F.max("l_partkey").alias("o_custkey"),
             F.max("l_extendedprice").alias("o_totalprice"),
             F.to_date(F.max("l_shipdate")).alias("o_date"))
        .select(
            F.when(F.col("first_line") != 7, F.col("l_orderkey") * 2).alias("o_orderkey"),
            "o_custkey", F.lit("U").alias("o_orderstatus"), "o_totalprice", "o_date",
            F.lit("extra").alias("ignored"),
        )
    )


def latest_orders(t: Inputs) -> DataFrame:
    """Each customer's latest order, under a doubled key: few dates, many keys."""
    latest = F.max(F.struct(F.to_date("o_orderdate").alias("o_date"), "o_orderkey")).alias("latest")
    return (
        t("orders").groupBy("o_custkey").agg(latest)
        .select((F.col("latest.o_orderkey") * 2).alias("o_orderkey"), "o_custkey",
                F.lit("L").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
                F.col("latest.o_date").alias("o_date"))
    )


def dictionary(rows: DataFrame, column: str, step: int = 1) -> DataFrame:
    """A dictionary of a text column with ids ``step, 2 * step, ...`` in value order."""
    empty = rows.sparkSession.createDataFrame([], "id long, value string")
    return extend_enum(empty, rows, column).select((F.col("id") * step).alias("id"), "value")


def brand_dictionary(t: Inputs) -> DataFrame:
    """The brands with a one-digit number, ids with gaps."""
    return dictionary(t("part").where(F.length("p_brand") == 7), "p_brand", 10)


def type_dictionary(t: Inputs) -> DataFrame:
    return dictionary(t("part"), "p_type")


def parts(t: Inputs) -> DataFrame:
    """Parts with a column to encode; a part of size 1 has no brand."""
    return t("part").select(
        "p_partkey", F.when(F.col("p_size") != 1, F.col("p_brand")).alias("p_brand"), "p_type"
    )


def date_ranges(t: Inputs) -> DataFrame:
    """One parameter row per month with orders: 45 days from its first, so they overlap."""
    month = F.trunc("o_orderdate", "month")
    return t("orders").groupBy(month.alias("lo")).agg(F.count("*").alias("n_orders")).select(
        (F.year("lo") * 100 + F.month("lo")).alias("param_no"), "lo", F.date_add("lo", 44).alias("hi")
    )


def security_ranges(t: Inputs) -> DataFrame:
    """One parameter row per customer nation: the security of that number, and the
    nation's first and last order date."""
    dated = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return dated.groupBy("c_nationkey").agg(
        F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi")
    ).select(F.col("c_nationkey").alias("param_no"),
             F.col("c_nationkey").cast("long").alias("wanted"), "lo", "hi")


def asked_dates(t: Inputs, hot: bool = False) -> DataFrame:
    """One security and date per order; half of the orders ask for security 1 if ``hot``."""
    security = F.pmod("o_custkey", F.lit(10)) + 1
    if hot:
        security = F.when(F.pmod("o_orderkey", F.lit(2)) == 0, F.lit(1)).otherwise(security)
    return t("orders").select("o_orderkey", security.cast("long").alias("sec_id"), F.to_date("o_orderdate").alias("asked"))


def wide_codes(t: Inputs) -> DataFrame:
    """Orders with text, number and date columns that have dictionaries of their own."""
    return t("orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("clerk"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        (F.col("o_custkey") % 97).alias("customer"), F.to_date("o_orderdate").alias("day"))


def wide_dictionaries(t: Inputs) -> dict[str, DataFrame]:
    """Partial dictionaries of ``wide_codes``, one of them with a value held twice."""
    rows = wide_codes(t)
    few = rows.where("o_orderkey % 5 = 1")
    status = few.sparkSession.createDataFrame([(7, "O"), (3, "O"), (9, "X")], "id long, value string")
    empty = few.sparkSession.createDataFrame([], "id long, value date")
    customers = few.select((F.col("customer") * 2 + 5).alias("id"), F.col("customer").alias("value")).distinct()
    return {"enum_status": status, "enum_customer": customers, "enum_day": empty,
            "enum_elsewhere": status}


def stored_prices(t: Inputs, history: DataFrame) -> DataFrame:
    """A price table that has fallen behind ``history``.

    Nation 3's securities are up to date, nation 5's were never stored, the others
    end at mid-2000. Securities in debt are stored at twice their close; those with
    more than 9000 have an error in the old rows only, which the check of the last
    row cannot see.
    """
    supplier = t("supplier").select(F.col("s_suppkey").alias("sec_id"), "s_nationkey", "s_acctbal")
    close = F.col("close") * F.when(F.col("s_acctbal") < 0, 2.0).otherwise(1.0)
    off = (F.col("s_acctbal") > 9000) & (F.col("Date") < F.lit("1997-01-01").cast("date"))
    return (
        history.join(supplier, "sec_id")
        .where((F.col("s_nationkey") == 3) | (F.col("Date") <= F.lit("2000-06-30").cast("date")))
        .where(F.col("s_nationkey") != 5)
        .withColumn("close", close + F.when(off, 1.0).otherwise(0.0))
        .select(*history.columns)
    )
