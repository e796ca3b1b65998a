"""DuckDB SQL building blocks for the correctness checks of registered queries.

Each function returns a SELECT (or CTE body) over the pre-registered table
views; ``queries.py`` composes them into one statement per registered query.
"""

from __future__ import annotations

TICKS = {
    "orders": """SELECT o_orderpriority AS symbol, o_orderdate AS ts, o_orderkey AS tick_id,
        0 AS seq, o_totalprice AS price, 1.0 AS qty FROM orders""",
    "brands": """SELECT p_brand AS symbol, l_shipdate AS ts, l_orderkey AS tick_id,
        l_linenumber AS seq,
        CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS price,
        l_quantity AS qty
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "suppliers": """SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS ts,
        l_orderkey AS tick_id, l_linenumber AS seq,
        CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS price,
        l_quantity AS qty FROM lineitem""",
    "events": """SELECT event_type AS symbol, ts, event_id AS tick_id, 0 AS seq,
        value AS price, 1.0 AS qty FROM events""",
}


def bars(source: str = "orders") -> str:
    return f"""SELECT symbol, CAST(ts AS DATE) AS date,
        arg_min(price, (ts, tick_id, seq, price)) AS open,
        max(price) AS high, min(price) AS low,
        arg_max(price, (ts, tick_id, seq, price)) AS close,
        CAST(sum(qty) AS BIGINT) AS volume
      FROM ({TICKS[source]}) t WHERE price IS NOT NULL GROUP BY 1, 2"""


def _roll(expr: str, n: int, fn: str = "avg", w: str = "PARTITION BY symbol ORDER BY date") -> str:
    frame = f"({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({expr}) OVER {frame} = {n} THEN {fn}({expr}) OVER {frame} END"


def indicators(src: str = "bars", extra: str = "") -> str:
    """SELECT of bars columns + the eight indicator columns over relation ``src``."""
    w = "PARTITION BY symbol ORDER BY date"
    f14 = f"({w} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"
    return f"""SELECT symbol, date, open, high, low, close, volume{extra},
        {_roll('close', 5)} AS MA_5,
        {_roll('close', 20)} AS MA_20,
        {_roll('close', 50)} AS MA_50,
        CASE WHEN count(gain) OVER {f14} = 14 THEN
          CASE WHEN avg(loss) OVER {f14} > 0
               THEN 100.0 - 100.0 / (1.0 + avg(gain) OVER {f14} / avg(loss) OVER {f14})
               WHEN avg(gain) OVER {f14} > 0 THEN 100.0 END END AS RSI,
        {_roll('close', 20)} AS BB_Middle,
        {_roll('close', 20)} + 2.0 * {_roll('close', 20, 'stddev_samp')} AS BB_Upper,
        {_roll('close', 20)} - 2.0 * {_roll('close', 20, 'stddev_samp')} AS BB_Lower,
        {_roll('volume', 20)} AS Volume_MA
      FROM (SELECT *,
              CASE WHEN close - lag(close) OVER ({w}) > 0 THEN close - lag(close) OVER ({w}) ELSE 0.0 END AS gain,
              CASE WHEN close - lag(close) OVER ({w}) < 0 THEN lag(close) OVER ({w}) - close ELSE 0.0 END AS loss
            FROM {src}) g"""


def round_all(select_sql: str, cols_double: list[str], cols_other: list[str], digits: int = 4) -> str:
    parts = list(cols_other) + [
        f"CASE WHEN round({c}, {digits}) = 0 THEN CAST(0 AS DOUBLE) ELSE round({c}, {digits}) END AS {c}"
        for c in cols_double]
    return f"SELECT {', '.join(parts)} FROM ({select_sql}) r"


SEQ_FEATURES = ["close", "volume", "MA_5", "MA_20", "RSI", "BB_Upper", "BB_Lower"]


def seq_features(source: str = "orders", complete: bool = True) -> str:
    """P1 (+P2): keys and the seven sequence features as doubles."""
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SEQ_FEATURES)
    where = (" WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in SEQ_FEATURES)) if complete else ""
    return f"SELECT symbol, date, {cols} FROM ({indicators(f'({bars(source)})')}) i{where}"


def simple_features(source: str = "orders") -> str:
    """W6/W7 simplified features over bars, incomplete rows dropped."""
    return f"""SELECT * FROM (SELECT symbol, date, open, high, low, close, volume,
        {_roll('close', 5)} AS MA_5, {_roll('close', 20)} AS MA_20, 50.0 AS RSI,
        {_roll('volume', 20)} AS Volume_MA, close * 1.02 AS BB_Upper, close * 0.98 AS BB_Lower
      FROM ({bars(source)}) b) f
      WHERE MA_5 IS NOT NULL AND MA_20 IS NOT NULL AND Volume_MA IS NOT NULL AND close IS NOT NULL
        AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND volume IS NOT NULL"""


def linear_dataset(source: str = "orders") -> str:
    """Next-day target and 80/20 split over the simplified features."""
    t = f"""SELECT symbol, date, close, MA_5, MA_20, RSI, Volume_MA,
        lead(close) OVER (PARTITION BY symbol ORDER BY date) AS target FROM ({simple_features(source)}) f"""
    return f"""SELECT *, CASE WHEN rn <= (n * 4) // 5 THEN 'train' ELSE 'test' END AS split FROM (
      SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn,
             count(*) OVER (PARTITION BY symbol) AS n
      FROM ({t}) t WHERE target IS NOT NULL) s"""


def metrics(pred: str, keys: str = "symbol") -> str:
    """A1 over a relation with ``y`` and ``yhat``: n, mae, rmse, r2."""
    return f"""SELECT {keys}, count(*) AS n, avg(abs(y - yhat)) AS mae,
        sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
        CASE WHEN var_pop(y) * count(*) > 0 THEN 1.0 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))
             WHEN sum((y - yhat) * (y - yhat)) = 0 THEN 1.0 ELSE 0.0 END AS r2
      FROM ({pred}) p WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY {keys}"""
