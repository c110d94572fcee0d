"""The same queries in SQL over the test tables."""

from __future__ import annotations

from collections.abc import Iterable

from barfold.schema import LEVELS, PRICES

# Inputs, as common table expressions. Each may use those before it.

_LINE = "l_orderkey, l_linenumber, l_partkey, l_extendedprice"


def _halt(expr: str, otherwise: str = "0.0::DOUBLE") -> str:
    return f"CASE WHEN min(l_linenumber) = 7 THEN {otherwise} ELSE {expr} END"


_CTE = {
    "bars": f"""
  SELECT l_suppkey AS sec_id, CAST(l_shipdate AS DATE) AS "Date",
    {_halt(f'first(l_extendedprice ORDER BY {_LINE})')} AS "open",
    {_halt('max(l_extendedprice)')} AS high,
    {_halt('min(l_extendedprice)')} AS low,
    {_halt(f'last(l_extendedprice ORDER BY {_LINE})')} AS "close",
    {_halt(f'last(l_extendedprice * (1 - l_discount) ORDER BY {_LINE})', 'NULL')} AS adj_close,
    {_halt("sum(CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE ELSE l_quantity END)")} AS volume
  FROM lineitem GROUP BY 1, 2""",
    "quotes": """
  SELECT lpad(CAST(sec_id AS VARCHAR), 8, '0') || '.SW' AS symbol, "Date" AS "date",
    "open", high, low, "close", nullif(volume, 0) AS volume, adj_close AS adjusted
  FROM bars""",
    "securities": """
  SELECT 0 AS sheet_ord, s_suppkey AS row_ord, s_suppkey AS sec_id, s_name AS name, 'CHF' AS ccy,
    'SW' AS exch_yahoo, lpad(CAST(s_suppkey AS VARCHAR), 8, '0') || '.SW' AS id_yahoo FROM supplier
  UNION ALL
  SELECT 1, c_custkey, c_custkey, c_name, 'CHF', 'SW',
    lpad(CAST(c_custkey AS VARCHAR), 8, '0') || '.SW' FROM customer""",
    "stocks": """
  SELECT sec_id, name, ccy, exch_yahoo, id_yahoo FROM (
    SELECT *, row_number() OVER (PARTITION BY sec_id ORDER BY sheet_ord, row_ord) AS place
    FROM securities) WHERE place = 1""",
    "px": f"""
  SELECT sec_id, "Date", {', '.join(f'nullif("{c}", 0) AS "{c}"' for c in PRICES)} FROM bars""",
    "price_chg": f"""
  SELECT sec_id, "Date", {', '.join(f'("{c}" - "{c}_0") / abs("{c}_0") AS "{c}"' for c in PRICES)}
  FROM (SELECT *, {', '.join(f'last_value("{c}" IGNORE NULLS) OVER before AS "{c}_0"' for c in PRICES)}
    FROM px WINDOW before AS (PARTITION BY sec_id ORDER BY "Date"
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
    "volume_chg": """
  SELECT sec_id, "Date", volume AS level, (volume - base) / abs(base) AS volume
  FROM (SELECT *, lag(volume) OVER (PARTITION BY sec_id ORDER BY "Date") AS base
    FROM bars WHERE volume > 0)""",
    "chg": f"""
  SELECT p.sec_id, p."Date", {', '.join(f'{"v" if c == "volume" else "p"}."{c}"' for c in LEVELS)}
  FROM price_chg p LEFT JOIN volume_chg v ON v.sec_id = p.sec_id AND v."Date" = p."Date\"""",
    "ret": """
  SELECT * FROM chg WHERE "close" IS NOT NULL""",
    "last_p": f"""
  SELECT sec_id, "Date", {', '.join(f'"{c}"' for c in PRICES)}
  FROM bars JOIN (SELECT sec_id, max("Date") AS "Date" FROM bars WHERE "close" > 0 GROUP BY 1)
  USING (sec_id, "Date")""",
    "last_v": """
  SELECT sec_id, "Date", volume
  FROM bars JOIN (SELECT sec_id, max("Date") AS "Date" FROM bars WHERE volume > 0 GROUP BY 1)
  USING (sec_id, "Date")""",
    "target": """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_date
  FROM orders""",
    "changed": """
  SELECT CASE WHEN min(l_linenumber) <> 7 THEN l_orderkey * 2 END AS o_orderkey,
    max(l_partkey) AS o_custkey, 'U' AS o_orderstatus, max(l_extendedprice) AS o_totalprice,
    CAST(max(l_shipdate) AS DATE) AS o_date
  FROM lineitem GROUP BY l_orderkey""",
    "latest": """
  SELECT o_orderkey * 2 AS o_orderkey, o_custkey, 'L' AS o_orderstatus, 1.0::DOUBLE AS o_totalprice,
    CAST(o_orderdate AS DATE) AS o_date
  FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders) WHERE place = 1""",
    "enum_p_brand": """
  SELECT row_number() OVER (ORDER BY p_brand) * 10 AS id, p_brand AS value
  FROM (SELECT DISTINCT p_brand FROM part WHERE length(p_brand) = 7)""",
    "enum_p_type": """
  SELECT row_number() OVER (ORDER BY p_type) AS id, p_type AS value
  FROM (SELECT DISTINCT p_type FROM part)""",
    "parts": """
  SELECT p_partkey, CASE WHEN p_size <> 1 THEN p_brand END AS p_brand, p_type FROM part""",
    "date_ranges": """
  SELECT CAST(year(lo) * 100 + month(lo) AS INTEGER) AS param_no, lo, lo + 44 AS hi
  FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS lo FROM orders)""",
    "security_ranges": """
  SELECT c_nationkey AS param_no, CAST(c_nationkey AS BIGINT) AS wanted,
    CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
}


def _last(c: str) -> str:
    return f'{"v" if c == "volume" else "p"}."{c}" AS "{c}_last"'


def _levels(name: str, source: str, digits: int | None) -> dict[str, str]:
    """Levels of a change table: join last values by date, fill them towards older rows,
    multiply by the inverse product of the newer changes."""
    level = '"{0}_fill" * "{0}_newer"'
    out = f"round({level}, {digits})" if digits is not None else level
    return {
        f"{name}_joined": f"""
  SELECT r.*, {', '.join(_last(c) for c in LEVELS)}
  FROM {source} r
  LEFT JOIN last_p p ON p.sec_id = r.sec_id AND p."Date" = r."Date"
  LEFT JOIN last_v v ON v.sec_id = r.sec_id AND v."Date" = r."Date\"""",
        f"{name}_filled": f"""
  SELECT *, {', '.join(f'last_value("{c}_last" IGNORE NULLS) OVER down AS "{c}_fill"' for c in LEVELS)},
    {', '.join(f'coalesce(product(1 / (1 + coalesce("{c}", 0))) OVER newer, 1) AS "{c}_newer"' for c in LEVELS)}
  FROM {name}_joined
  WINDOW down AS (PARTITION BY sec_id ORDER BY "Date" DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    newer AS (PARTITION BY sec_id ORDER BY "Date" DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
        name: f"""
  SELECT sec_id, "Date", {', '.join(f'CASE WHEN "{c}" IS NOT NULL THEN {out.format(c)} END AS "{c}"' for c in LEVELS)}
  FROM {name}_filled""",
    }


_CTE |= _levels("history", "ret", 6)
_CTE |= _levels("unrounded", "chg", None)
_CTE |= {
    "stored": f"""
  SELECT h.sec_id, h."Date", {', '.join('h."close" * CASE WHEN s_acctbal < 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END + CASE WHEN s_acctbal > 9000 AND h."Date" < DATE ' + "'1997-01-01'" + ' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "close"' if c == "close" else f'h."{c}"' for c in LEVELS)}
  FROM history h JOIN supplier ON s_suppkey = h.sec_id
  WHERE (s_nationkey = 3 OR h."Date" <= DATE '2000-06-30') AND s_nationkey <> 5""",
    "state": """
  SELECT r.sec_id, r.last_return, s.last_stored, s.last_stored IS NOT NULL AND NOT EXISTS (
      SELECT 1 FROM stored a JOIN history b ON a.sec_id = b.sec_id AND a."Date" = b."Date"
      WHERE a.sec_id = r.sec_id AND a."Date" = s.last_stored AND a."close" = b."close") AS drifted
  FROM (SELECT sec_id, max("Date") AS last_return FROM ret GROUP BY 1) r
  LEFT JOIN (SELECT sec_id, max("Date") AS last_stored FROM stored GROUP BY 1) s USING (sec_id)""",
}

_ORDER = list(_CTE)


def _with(names: Iterable[str], select: str) -> str:
    """``select`` with the inputs it needs, directly or through other inputs."""
    needed: set[str] = set()

    def need(text: str, below: int) -> None:
        words = set(text.replace(",", " ").replace("(", " ").replace(")", " ").split())
        for i, name in enumerate(_ORDER[:below]):
            if name in words and name not in needed:
                needed.add(name)
                need(_CTE[name], i)

    need(" ".join(names), len(_ORDER))
    parts = ",\n".join(f"{n} AS ({_CTE[n]})" for n in _ORDER if n in needed)
    return f"WITH {parts}\n{select}"


def _changes(columns: Iterable[str]) -> str:
    return ", ".join(f'c."{c}" AS "{c}_chg"' for c in columns)


_FIELDS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_date"
_SERIES = "sec_id, \"Date\", " + ", ".join(f'"{c}"' for c in LEVELS)

def _insert_absent(kept: str, source: str) -> str:
    return f"""SELECT {_FIELDS} FROM {kept} UNION ALL
SELECT DISTINCT {_FIELDS} FROM {source} s WHERE s.o_orderkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {kept} k WHERE k.o_orderkey = s.o_orderkey)"""


def _kept(source: str, *by: str) -> str:
    match = " AND ".join(f"s.{c} = t.{c}" for c in by)
    return f"(SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {match}))"


def _resume(where: str, default: str | None) -> str:
    """Every security with its last qualifying date: one grouped pass over the joined returns."""
    found = f'max(r."Date") FILTER (WHERE {where})'
    if default:
        found = f"coalesce({found}, DATE '{default}')"
    return f'''SELECT s.sec_id, s.id_yahoo, {found} AS "Date"
FROM stocks s LEFT JOIN ret r USING (sec_id) GROUP BY ALL'''


def _max_date(where: str, default: str | None) -> str:
    return _with(["stocks", "ret"], _resume(where, default))


def _extended(enum: str, source: str, column: str) -> str:
    return f"""SELECT id, value FROM {enum} UNION ALL
SELECT (SELECT coalesce(max(id), 0) FROM {enum}) + row_number() OVER (ORDER BY value), value
FROM (SELECT DISTINCT {column} AS value FROM {source} s WHERE {column} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {enum} e WHERE e.value = s.{column}))"""


_UNCHANGED = """SELECT {columns} FROM (
  SELECT *, lag(shown) OVER run AS earlier, row_number() OVER run AS place
  FROM (SELECT *, coalesce({check}, '') AS shown FROM {table})
  WINDOW run AS (PARTITION BY {key} ORDER BY {ordinal}))
WHERE place = 1 OR earlier <> shown"""

ORACLE: dict[str, str] = {
    "bars": _with(["bars"], "SELECT * FROM bars"),
    "pct_change": _with(["bars"], """
SELECT sec_id, "Date", (p - p0) / abs(p0) AS high_chg, (q - q0) / abs(q0) AS volume_chg
FROM (SELECT *, last_value(p IGNORE NULLS) OVER before AS p0, last_value(q IGNORE NULLS) OVER before AS q0
  FROM (SELECT sec_id, "Date", nullif(high, 0) AS p, nullif(volume - 25, 0) AS q FROM bars)
  WINDOW before AS (PARTITION BY sec_id ORDER BY "Date" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""),
    "cumulative_change": _with(["ret"], """
SELECT sec_id, "Date", round(y, 6) AS lagged, CASE WHEN volume IS NOT NULL THEN round(y, 6) END AS lagged_na
FROM (SELECT *, coalesce(product(1 / (1 + coalesce(volume, 0))) OVER (PARTITION BY sec_id
    ORDER BY "Date" DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS y FROM ret)"""),
    "price_returns": _with(["bars", "price_chg"], f"""
SELECT b.sec_id, b."Date", {', '.join(f'b."{c}"' for c in PRICES)}, {_changes(PRICES)}
FROM bars b JOIN price_chg c ON c.sec_id = b.sec_id AND c."Date" = b."Date\""""),
    "volume_returns": _with(["volume_chg"], """
SELECT sec_id, "Date", level AS volume, volume AS volume_chg FROM volume_chg"""),
    "return_table": _with(["ret"], f"SELECT {_SERIES} FROM ret"),
    "last_price": _with(["last_p"], "SELECT * FROM last_p"),
    "last_volume": _with(["last_v"], "SELECT * FROM last_v"),
    "reconstruct": _with(["history"], f"SELECT {_SERIES} FROM history"),
    "price_history": _with(["history"], f"SELECT {_SERIES} FROM history"),
    "return_table_in_spans": _with(["ret"], f"SELECT {_SERIES} FROM ret"),
    "price_history_in_spans": _with(["history"], f"SELECT {_SERIES} FROM history"),
    "update_all_prices": _with(["history"], f"SELECT {_SERIES} FROM history"),
    "update_all_interrupted": _with(["history"], f"SELECT {_SERIES} FROM history"),
    "roundtrip_diff": _with(["unrounded", "bars"], f"""
SELECT sec_id, "Date", {', '.join(f'"{c}"' for c in LEVELS)},
  {', '.join(f'round("{c}" - "{c}_built", 6) + 0.0::DOUBLE AS "{c}_diff"' for c in LEVELS)}
FROM (SELECT b.sec_id, b."Date", {', '.join('CASE WHEN b.volume > 0 THEN b.volume END AS volume' if c == 'volume' else f'b."{c}"' for c in LEVELS)},
    {', '.join(f'u."{c}" AS "{c}_built"' for c in LEVELS)}
  FROM bars b LEFT JOIN unrounded u ON u.sec_id = b.sec_id AND u."Date" = b."Date")"""),
    "refresh_prices": _with(["history", "stored", "state"], f"""
SELECT {_SERIES} FROM stored WHERE sec_id NOT IN (
  SELECT sec_id FROM state WHERE last_stored < last_return AND drifted)
UNION ALL
SELECT {_SERIES} FROM history JOIN state USING (sec_id)
WHERE last_stored IS NULL OR (last_stored < last_return AND (drifted OR "Date" > last_stored))"""),
    "refresh_prices_small_drift": _with(["history"], f"""
SELECT sec_id, "Date", {', '.join('round(volume * 1e7, 0) AS volume' if c == 'volume' else f'"{c}"' for c in LEVELS)}
FROM history"""),
    "read_bars_csv": _with(["quotes"], """
SELECT * FROM quotes WHERE "date" <= DATE '2000-12-31'"""),
    "read_securities_csv": _with(["stocks"], """
SELECT sec_id, name, CASE WHEN sec_id NOT IN (SELECT s_suppkey FROM supplier) THEN ccy END AS ccy, exch_yahoo, id_yahoo
FROM stocks"""),
    "securities_first": _with(["stocks"], "SELECT * FROM stocks"),
    "fetch_bars": _with(["stocks", "ret", "quotes"], """
SELECT q.* FROM quotes q JOIN (""" + _resume("""r.volume <> 0 AND r."Date" < DATE '1998-01-01'""", "1900-01-01") + """) m
ON m.id_yahoo = q.symbol AND q."date" BETWEEN m."Date" AND DATE '2000-12-31'"""),
    "normalise_bars": _with(["stocks", "quotes"], """
SELECT m.sec_id, q."date" AS "Date", q."open", q.high, q.low, q."close",
  coalesce(q.volume, 0) AS volume, q.adjusted AS adj_close
FROM quotes q JOIN stocks m ON m.id_yahoo = q.symbol"""),
    "stack_sheets": """
SELECT s_suppkey AS sec_id, s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer""",
    "conform": _with(["changed"], f"SELECT {_FIELDS} FROM changed"),
    "iso_text": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  strftime(o_orderdate, '%Y-%m-%d') AS o_date FROM orders""",
    "key_values": _with(["changed"], """
SELECT DISTINCT 'o_custkey' AS "key", CAST(o_custkey AS VARCHAR) AS value FROM changed
UNION ALL SELECT DISTINCT 'o_date', CAST(o_date AS VARCHAR) FROM changed"""),
    "return_range": _with(["ret"], f"""
SELECT {_SERIES} FROM ret WHERE "Date" >= DATE '1996-01-01' AND "Date" <= DATE '1998-06-30'"""),
    "max_date": _max_date("""r.volume <> 0 AND r."Date" < DATE '1998-01-01'""", "1900-01-01"),
    "max_date_positive": _max_date("r.volume > 0", "1900-01-01"),
    "max_date_notnull": _max_date("r.volume IS NOT NULL", None),
    "last_date": _with(["stocks", "ret", "stored", "last_p"], """
SELECT sec_id, id_yahoo, coalesce(returned, DATE '1900-01-01') AS last_return_date,
  coalesce(priced, DATE '1900-01-01') AS last_price_date, coalesce(closed, 0) AS last_close
FROM (SELECT sec_id, id_yahoo FROM stocks SEMI JOIN last_p USING (sec_id))
LEFT JOIN (SELECT sec_id, max("Date") AS returned FROM ret GROUP BY sec_id) USING (sec_id)
LEFT JOIN (SELECT sec_id, max("Date") AS priced, arg_max("close", "Date") AS closed
  FROM stored GROUP BY sec_id) USING (sec_id)"""),
    "param_query": _with(["bars", "date_ranges"], """
SELECT p.param_no, b.sec_id, b."Date", b."close", b.volume
FROM date_ranges p JOIN bars b ON b."Date" BETWEEN p.lo AND p.hi"""),
    "param_query_outlier": _with(["bars", "date_ranges"], f"""
SELECT p.param_no, b.sec_id, b."Date", b."close", b.volume FROM date_ranges p JOIN (
  SELECT sec_id, "Date", "close", volume FROM bars
  UNION ALL SELECT min(sec_id), DATE '9000-01-01', 1.0, 1.0 FROM bars) b ON b."Date" BETWEEN p.lo AND p.hi"""),
    "param_query_before": _with(["bars", "date_ranges"], """
SELECT param_no, lo, max("Date") AS latest, count(sec_id) AS n_bars
FROM date_ranges LEFT JOIN (SELECT sec_id, "Date" FROM bars WHERE volume > 0) ON "Date" < lo GROUP BY ALL"""),
    "param_query_by_security": _with(["bars", "security_ranges"], """
SELECT p.param_no, b.sec_id, b."Date", b."close", b.volume
FROM security_ranges p JOIN bars b ON b.sec_id = p.wanted AND b."Date" BETWEEN p.lo AND p.hi"""),
    "delete_matching": _with(["target", "changed"], f"SELECT * FROM {_kept('changed', 'o_orderkey')}"),
    "delete_keyless": _with(["target"], "SELECT * FROM target"),
    "insert_absent": _with(["target", "changed"], _insert_absent("target", "changed")),
    "upsert": _with(["target", "changed"],
                    _insert_absent(_kept("changed", "o_orderkey"), "changed")),
    "publish_and_compact": _with(["target", "changed"],
                                 _insert_absent(_kept("changed", "o_orderkey"), "changed")),
    "replace_by_date": _with(["target", "latest"],
                             _insert_absent(_kept("latest", "o_date"), "latest")),
    "replace_by_many": _with(["target", "latest"],
                             _insert_absent(_kept("latest", "o_date", "o_custkey"), "latest")),
    "drop_unchanged": _UNCHANGED.format(columns="user_id, event_id, event_type", table="events",
                                        key="user_id", check="event_type", ordinal="event_id"),
    "drop_unchanged_uneven": _UNCHANGED.format(
        columns="user_id, event_id, event_type", key="user_id", check="event_type", ordinal="event_id",
        table="""(SELECT user_id % 3 AS user_id, event_type, CASE
    WHEN event_id % 997 = 0 THEN event_id - 9223372036854775807
    WHEN event_id % 991 = 0 THEN 9223372036854775807 - event_id ELSE event_id END AS event_id FROM events)"""),
    "drop_unchanged_status": _UNCHANGED.format(
        columns="o_custkey, o_orderkey, o_orderstatus, o_orderpriority", table="orders",
        key="o_custkey", check="o_orderstatus", ordinal="o_orderkey"),
    "extend_enum": _with(["enum_p_brand", "parts"], _extended("enum_p_brand", "parts", "p_brand")),
    "extend_enum_wide": f"""
WITH enum_n AS (SELECT row_number() OVER (ORDER BY value) AS id, value FROM (
  SELECT DISTINCT 'Customer' || substring(s_name, 9, 20) AS value FROM supplier))
{_extended('enum_n', 'customer', 'c_name')}""",
    "extend_enums": _with(["enum_p_brand", "enum_p_type", "parts"], f"""
SELECT 'enum_p_brand' AS name, id, value FROM ({_extended('enum_p_brand', 'parts', 'p_brand')})
UNION ALL SELECT 'enum_p_type', id, value FROM ({_extended('enum_p_type', 'parts', 'p_type')})"""),
    "encode_enums": _with(["enum_p_brand", "enum_p_type", "parts"], """
SELECT p_partkey, (SELECT min(id) FROM enum_p_brand e WHERE e.value = p.p_brand) AS p_brand,
  (SELECT min(id) FROM enum_p_type e WHERE e.value = p.p_type) AS p_type FROM parts p"""),
}

ORACLE["fetch_bars_resumed"] = _with(["stocks", "ret", "quotes"], """
SELECT q.* FROM quotes q JOIN (""" + _resume(
    """r.volume <> 0 AND r."Date" < DATE '1998-01-01' AND r.sec_id % 2 = 0""", None) + """) m
ON m.id_yahoo = q.symbol AND (m."Date" IS NULL OR q."date" >= m."Date") AND q."date" <= DATE '2000-12-31'""")
ORACLE["param_query_from"] = _with(["bars", "security_ranges"], """
SELECT param_no, wanted, lo, count(b.sec_id) AS n_bars, sum(b.volume) AS traded, min(b."close") AS lowest
FROM (SELECT *, unnest([1, 2]) AS given FROM security_ranges) LEFT JOIN bars b ON b.sec_id = wanted AND b."Date" >= lo
GROUP BY param_no, wanted, lo, given""")
ORACLE["param_query_repeated"] = _with(["bars", "security_ranges"], """
SELECT param_no, wanted, lo, hi, count(b.sec_id) AS n_rows, max(b."Date") AS latest
FROM (SELECT *, unnest([1, 2]) AS given FROM security_ranges)
LEFT JOIN bars b ON b.sec_id = wanted AND b."Date" BETWEEN lo AND hi GROUP BY param_no, wanted, lo, hi, given""")


def _asof(security: str) -> str:
    return _with(["bars"], f"""
SELECT o.o_orderkey, o.sec_id, o.asked, p."Date" AS day, p."close"
FROM (SELECT o_orderkey, {security} AS sec_id, CAST(o_orderdate AS DATE) AS asked FROM orders) o
ASOF LEFT JOIN (SELECT * FROM bars WHERE "close" > 0) p ON p.sec_id = o.sec_id AND p."Date" <= o.asked""")


ORACLE["asof_price"] = _asof("o_custkey % 10 + 1")
ORACLE["asof_price_hot"] = _asof("CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE o_custkey % 10 + 1 END")
ORACLE["asof_next_order"] = """
SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS next FROM orders"""
_STORED_EVENTS = _UNCHANGED.format(
    columns="user_id, event_id, event_type", key="user_id", check="event_type", ordinal="event_id",
    table="(SELECT user_id, event_id, event_type FROM events WHERE event_id % 3 <> 0)")
ORACLE["drop_unchanged_append"] = _UNCHANGED.format(
    columns="user_id, event_id, event_type", key="user_id", check="event_type", ordinal="event_id",
    table=f"(({_STORED_EVENTS}) UNION ALL SELECT user_id, event_id, event_type FROM events WHERE event_id % 3 = 0)")
_WIDE = """wide AS (SELECT o_orderkey, {clerk} AS clerk, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
  o_custkey % 97 AS customer, CAST(o_orderdate AS DATE) AS day FROM orders),
enum_status(id, value) AS (VALUES (7, 'O'), (3, 'O'), (9, 'X')),
enum_customer AS (SELECT DISTINCT customer * 2 + 5 AS id, customer AS value FROM wide WHERE o_orderkey % 5 = 1),
enum_day AS (SELECT 0 AS id, day AS value FROM wide WHERE false)""".format(clerk="o_orderpriority")
ORACLE["extend_enums_at_once"] = f"WITH {_WIDE}\n" + " UNION ALL ".join(
    f"SELECT 'enum_{c}' AS name, CAST(id AS BIGINT) AS id, CAST(value AS VARCHAR) AS value FROM ({_extended(f'enum_{c}', 'wide', c)})"
    for c in ("status", "customer", "day"))
ORACLE["encode_enums_wide"] = f"""WITH {_WIDE}
SELECT o_orderkey, clerk, CAST((SELECT min(id) FROM enum_status e WHERE e.value = w.status) AS BIGINT) AS status,
  (SELECT min(id) FROM enum_customer e WHERE e.value = w.customer) AS customer,
  CAST((SELECT min(id) FROM enum_day e WHERE e.value = w.day) AS BIGINT) AS day FROM wide w"""

ORACLE["returns_revised"] = ORACLE["return_table"]
# The same series some hundred years earlier, by whole days.
ORACLE["refresh_prices_early"] = (
    "SELECT * REPLACE (\"Date\" - 36524 AS \"Date\") FROM (" + ORACLE["refresh_prices"] + ")")
ORACLE["refresh_stored_prices"] = ORACLE["refresh_prices"]
ORACLE["return_range_stored"] = ORACLE["return_range"]
# Bars after a split of every tenth security.
_SPLIT = f"""sent AS ({_CTE['bars']}),
bars AS (SELECT * REPLACE (
    {', '.join(f'"{c}" * CASE WHEN split THEN {2.0 if c == "volume" else 0.5} ELSE 1.0 END AS "{c}"' for c in LEVELS)})
  FROM (SELECT *, sec_id % 10 = 3 AND "Date" < DATE '1996-01-01' AS split FROM sent))"""
ORACLE["update_all_restated"] = ORACLE["update_all_prices"].replace(f"bars AS ({_CTE['bars']})", _SPLIT)
