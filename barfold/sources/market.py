"""Bars and the security master."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barfold.functions.series import finite, not_nan
from barfold.schema import BAR_SCHEMA, FIRST_DATE, KEY, LEVELS, ON, STOCKS
from barfold.sources.scratch import materialise


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _load(spark: SparkSession, paths: Sequence[str], source_format: str,
          schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """Columns of ``schema`` by name, whatever their order; a column the source lacks is null."""
    if source_format != "csv":
        return spark.read.format(source_format).schema(schema).options(**options).load(list(paths))
    return stack([_load_csv(spark, path, schema, options) for path in paths])


def _load_csv(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """One CSV source, by its header. A value that is not of its column's type raises, as does a
    row or a further file that does not fit the header."""
    named = {"header": "true", "mode": "FAILFAST", "enforceSchema": "false"} | options
    text = spark.read.options(**named).csv(path)
    if named["header"] != "true":
        # Without a header there is only the position.
        text = text.toDF(*[f.name for f in schema.fields][:len(text.columns)])

    def typed(field: T.StructField) -> Column:
        if field.name not in text.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name)
        cast = value.try_cast(field.dataType)
        wrong = F.raise_error(F.concat(F.lit(f"{field.name}: not a {field.dataType.simpleString()}: "), value))
        return F.when(value.isNotNull() & cast.isNull(), wrong).otherwise(cast).alias(field.name)

    return text.select(*map(typed, schema.fields))


def read_bars(spark: SparkSession, paths: Sequence[str], source_format: str = "parquet",
              resume: DataFrame | None = None, end: date | None = None,
              **options: str) -> DataFrame:
    """Bars of all symbols: ``symbol, date, open, high, low, close, volume, adjusted``.

    ``resume`` (``id_yahoo, Date``, see :func:`barfold.operators.lookups.max_date`)
    gives each symbol its own first date, null for all dates, and drops symbols it does not
    list; ``end`` is the last date, included. CSV columns are found by their header. NaN and infinities are read as null.
    """
    return select_bars(_load(spark, paths, source_format, BAR_SCHEMA, options), resume, end)


def select_bars(bars: DataFrame, resume: DataFrame | None = None,
                end: date | None = None) -> DataFrame:
    """Cut bars down to the dates each symbol still needs, and clean their numbers.

    Where all symbols have a resume date the earliest is a filter of the scan itself, so files and row groups
    before it are skipped. Symbols without one need all their dates.
    """
    if end is not None:
        bars = bars.where(F.col("date") <= F.lit(end))
    if resume is not None:
        starts = materialise(resume.select(F.col("id_yahoo").alias("symbol"), F.col(ON).alias("_start")))
        any_never = F.max(F.col("_start").isNull())
        first = starts.agg(F.when(any_never, F.lit(FIRST_DATE).cast("date")).otherwise(F.min("_start"))).scalar()
        wanted = bars.where((F.col("date") >= first) | F.col("date").isNull()).join(starts, "symbol")
        bars = wanted.where("_start is null or date >= _start").select(*bars.columns)
    numbers = [f.name for f in bars.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return bars.withColumns({c: finite(c) for c in numbers})


def normalise_bars(bars: DataFrame, securities: DataFrame) -> DataFrame:
    """Bars under the names of the series tables, one row per security and date.

    A missing volume is 0. Bars of a symbol the master does not list are dropped.
    """
    renamed = bars.withColumnsRenamed({"symbol": "id_yahoo", "date": ON, "adjusted": "adj_close"})
    joined = renamed.drop(KEY).join(securities.select(KEY, "id_yahoo"), "id_yahoo")
    volume = F.coalesce(not_nan("volume"), F.lit(0.0)).alias("volume")
    return joined.select(KEY, ON, *[volume if c == "volume" else F.col(c) for c in LEVELS])


def first_per_security(rows: DataFrame, order: Sequence[str] = ("sheet_ord", "row_ord")) -> DataFrame:
    """The first row per ``sec_id`` in ``order``, without the ordering columns.

    An aggregate and not a window: repeated ids fold together before the shuffle.
    """
    rest = [c for c in rows.columns if c not in (KEY, *order)]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return rows.groupBy(KEY).agg(first).select(
        *[F.col(KEY) if c == KEY else F.col(f"_first.{c}") for c in rows.columns if c not in order]
    )


def read_securities(spark: SparkSession, sheets: Sequence[str], source_format: str = "csv",
                    row_order: str = "row_ord", **options: str) -> DataFrame:
    """The security master from several sheets, the earlier sheet winning on a shared id.

    One path per sheet. Files have no row order of their own in Spark, so each sheet
    carries it as the integer column ``row_order``.
    """
    schema = T.StructType([T.StructField(row_order, T.LongType()), *STOCKS.schema.fields])
    frames = [
        _load(spark, [path], source_format, schema, options).withColumn("sheet_ord", F.lit(i))
        for i, path in enumerate(sheets)
    ]
    return first_per_security(stack(frames), ("sheet_ord", row_order))
