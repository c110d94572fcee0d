"""Column roles, sentinels and table definitions.

Parquet gives every column back as nullable and knows no primary key, so both
live here (and in the manifest of a :class:`barfold.sources.store.Store`).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

# Column roles, in table order.
PRICES = ("open", "high", "low", "close", "adj_close")
VOLUME = "volume"
LEVELS = ("open", "high", "low", "close", "volume", "adj_close")

# Stand-ins for a missing date and for an open upper bound.
EARLIEST = date(1900, 1, 1)
LATEST = date(9999, 1, 1)

# The first date there is: a lower bound that cuts nothing.
FIRST_DATE = "0001-01-01"

KEY = "sec_id"
ON = "Date"

ENUM_PREFIX = "enum_"


#: Buckets of the securities in series tables.
BUCKETS = 16


@dataclass(frozen=True)
class Partition:
    """One level of a table's folders: an integer expression over one primary key column.

    ``expr`` is SQL with ``{}`` in the place of the column. A ``rising`` one never falls as
    the column rises, so a range of the column is a range of the partition too.
    """

    name: str
    expr: str
    column: str
    rising: bool = False

    def of(self, value: str | None = None) -> str:
        """The expression over the column, or over SQL text in its place."""
        return self.expr.format(self.column if value is None else value)


@dataclass(frozen=True)
class TableSpec:
    """Fields, primary key and storage partitioning of one table.

    Partitions are made of primary key columns only, so that a keyed change touches just the
    partitions its source rows fall into.
    """

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    partition_by: tuple[Partition, ...] = ()

    def __post_init__(self) -> None:
        for p in self.partition_by:
            if p.column not in self.primary_key or p.name in [*self.schema.fieldNames(), "change"]:
                raise ValueError(f"{self.name}: partition {p.name!r} is not over a key column, or its name is taken")
        unknown = [k for k in self.primary_key if k not in self.schema.fieldNames()]
        if unknown:
            raise ValueError(f"{self.name}: key columns {unknown} are not fields")

    @property
    def fields(self) -> list[str]:
        """Field names in column order."""
        return self.schema.fieldNames()

    @property
    def nullable_fields(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.nullable]


def _table(name: str, columns: list[tuple[str, T.DataType]], key: tuple[str, ...],
           partition_by: tuple[Partition, ...] = (), required: Iterable[str] = ()) -> TableSpec:
    required = {*key, *required}
    schema = T.StructType([T.StructField(c, t, c not in required) for c, t in columns])
    return TableSpec(name, schema, key, partition_by)


def _doubles(names: Iterable[str]) -> list[tuple[str, T.DataType]]:
    return [(n, T.DoubleType()) for n in names]


_SERIES_KEY: list[tuple[str, T.DataType]] = [(KEY, T.LongType()), (ON, T.DateType())]

# The table definitions.
STOCKS = _table(
    "stocks",
    [(KEY, T.LongType())]
    + [(c, T.StringType()) for c in ("name", "ccy", "exch_yahoo", "id_yahoo")],
    (KEY,),
)
# A restated security is one bucket, a new day one year.
_SERIES = (Partition("bucket", f"pmod(hash({{}}), {BUCKETS})", KEY), Partition("year", "year({})", ON, rising=True))
STOCK_RETURN = _table("stock_return", _SERIES_KEY + _doubles(LEVELS), (KEY, ON), _SERIES)
STOCK_PRICE = _table("stock_price", _SERIES_KEY + _doubles(LEVELS), (KEY, ON), _SERIES)
LAST_PRICE = _table("last_price", _SERIES_KEY + _doubles(PRICES), (KEY,), required=(ON,))
LAST_VOLUME = _table("last_volume", _SERIES_KEY + _doubles([VOLUME]), (KEY,), required=(ON,))

# Bars as they arrive, before the security master is joined.
BAR_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType())]
    + [T.StructField(c, T.DoubleType())
       for c in ("open", "high", "low", "close", "volume", "adjusted")]
)

MARKET_TABLES = (STOCKS, STOCK_RETURN, LAST_PRICE, LAST_VOLUME, STOCK_PRICE)


def enum_spec(column: str, value_type: T.DataType | None = None) -> TableSpec:
    """The ``{id, value}`` dictionary table of one column."""
    return _table(
        ENUM_PREFIX + column,
        [("id", T.LongType()), ("value", value_type or T.StringType())],
        ("id",),
    )


class Registry:
    """Table definitions by name."""

    def __init__(self, specs: Iterable[TableSpec] = MARKET_TABLES) -> None:
        self._specs = {s.name: s for s in specs}

    def register(self, spec: TableSpec) -> TableSpec:
        self._specs[spec.name] = spec
        return spec

    def __getitem__(self, name: str) -> TableSpec:
        if name not in self._specs:
            raise KeyError(f"unknown table {name!r}")
        return self._specs[name]

    def __contains__(self, name: str) -> bool:
        return name in self._specs

    def fields(self, name: str) -> list[str]:
        return self[name].fields

    def keys(self, name: str) -> list[str]:
        return list(self[name].primary_key)

    def nullable_fields(self, name: str) -> list[str]:
        return self[name].nullable_fields

    def dictionaries(self) -> list[str]:
        """Names of the dictionary tables, in name order."""
        return sorted(n for n, s in self._specs.items() if is_dictionary(n, s.fields))


def is_dictionary(name: str, fields: list[str]) -> bool:
    return name.startswith(ENUM_PREFIX) and len(fields) >= 2
