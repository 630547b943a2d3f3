"""Independent SQL (DuckDB) for every registered query that SQL can express."""

from __future__ import annotations

from tickloom.operators.indicators import FEATURES
from tickloom.schema import DEFAULT_THRESHOLDS, SYMBOL_ROWS

DENSE = "TIMESTAMP '2026-07-11 13:30:00' + to_seconds(event_id)"


def rounded(x: str, digits: int) -> str:
    return f"floor(({x})*1e{digits}+0.5)/1e{digits}"


def r(x: str, digits: int = 6) -> str:
    return rounded(x, digits)


def group_mean(c: str) -> str:
    return f"(floor(sum({c})*1e8+0.5)/1e8 / count({c}))"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def _ticks(clock: str) -> str:
    values = ", ".join(
        f"('{s}','{n}','{u}','{c}',CAST({b} AS DOUBLE),{i})" for i, (s, n, u, c, b) in enumerate(SYMBOL_ROWS)
    )
    limits = ", ".join(
        f"('{s}',CAST({u} AS DOUBLE),CAST({lo} AS DOUBLE),CAST({v} AS DOUBLE))" for s, u, lo, v in DEFAULT_THRESHOLDS
    )
    return f"""WITH dim(symbol, name, unit, color, base, rk) AS (VALUES {values}),
limits(symbol, upper, lower, vol_pct) AS (VALUES {limits}),
base AS (SELECT event_id AS seq,
  CASE event_type WHEN 'click' THEN 'GOLD' WHEN 'error' THEN 'OIL' WHEN 'purchase' THEN 'SILVER'
                  WHEN 'signup' THEN 'COPPER' WHEN 'view' THEN 'GAS' END AS symbol,
  {DENSE if clock == "dense" else "ts"} AS event_ts, value AS price,
  CAST(props->>'$.k' AS DOUBLE) AS volume, value * (1 + event_id % 7) / 10000 AS spread
  FROM events WHERE event_type IN ('click','error','purchase','signup','view')),
lagd AS (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY event_ts, seq) AS p1,
  row_number() OVER (PARTITION BY symbol ORDER BY event_ts, seq) - 1 AS pos,
  count(*) OVER (PARTITION BY symbol) AS n FROM base),
t AS (SELECT seq, symbol, event_ts, price, volume, price - spread/2 AS bid, price + spread/2 AS ask, spread,
  CASE WHEN p1 IS NULL OR price = p1 THEN 'FLAT' WHEN price > p1 THEN 'UP' ELSE 'DOWN' END AS direction,
  coalesce(abs(price - p1) / nullif(p1, 0), 0.0) AS volatility,
  max(price) OVER (PARTITION BY symbol, CAST(event_ts AS DATE) ORDER BY event_ts, seq
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS high,
  min(price) OVER (PARTITION BY symbol, CAST(event_ts AS DATE) ORDER BY event_ts, seq
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS low,
  p1, pos, n, price - p1 AS chg, (price - p1) / nullif(p1, 0) * 100 AS chg_pct,
  CASE WHEN price > 0 THEN spread / price * 100 END AS sp
  FROM lagd)
"""


SQL: dict[str, str] = {}


def oracle(name: str, body: str, clock: str = "dense") -> None:
    glue = "" if body.lstrip().upper().startswith("SELECT") else ", "
    SQL[name] = _ticks(clock) + glue + body


# --- bars
BAR = f"""arg_min(price, pos) AS open_price, max(high) AS high_price, min(low) AS low_price,
  arg_max(price, pos) AS close_price, {r(group_mean('price'))} AS avg_price, sum(volume) AS total_volume,
  count(price) AS tick_count"""
MINUTE = "date_trunc('minute', event_ts)"
BAR8 = BAR.replace(r(group_mean("price")), r(group_mean("price"), 8))
BARS_1MIN = f"""SELECT symbol, {ts(MINUTE)} AS minute, {BAR}, {day(MINUTE)} AS dt
FROM t GROUP BY symbol, {MINUTE}"""
for _name in ("bars_1min", "bars_merge_partials", "stream_bars_partial"):
    oracle(_name, BARS_1MIN)
oracle("stream_bars_watermark", f"SELECT symbol, {ts(MINUTE)} AS minute, {BAR} FROM t GROUP BY symbol, {MINUTE}")


def _dws(bucket: str, digits: int, with_time: bool = False) -> str:
    def r(x: str) -> str:
        return rounded(x, digits)

    return f"""SELECT symbol, {ts(bucket) + ' AS bar_time, ' if with_time else ''}
  arg_min(price, pos) AS open_price, max(price) AS high_price, min(price) AS low_price,
  arg_max(price, pos) AS close_price, {r(group_mean('price'))} AS avg_price, sum(volume) AS total_volume,
  CAST(count(*) AS INT) AS tick_count, {r(group_mean('spread'))} AS avg_spread, {r('avg(sp)')} AS avg_spread_pct,
  {r('avg(volatility)')} AS avg_volatility, {r('max(volatility)')} AS max_volatility,
  CAST(count(*) FILTER (direction = 'UP') AS INT) AS up_count,
  CAST(count(*) FILTER (direction = 'DOWN') AS INT) AS down_count,
  CAST(count(*) FILTER (direction = 'FLAT') AS INT) AS flat_count,
  {r('arg_max(price, pos) - arg_min(price, pos)')} AS price_change,
  {r('(arg_max(price, pos) - arg_min(price, pos)) / nullif(arg_min(price, pos), 0) * 100')} AS price_change_pct,
  strftime({bucket}, '%H:%M') AS minute, {day(bucket)} AS dt
FROM t"""


_FIVE = "time_bucket(INTERVAL '5 minutes', event_ts)"
_FIFTEEN = "time_bucket(INTERVAL '15 minutes', event_ts)"
oracle("dws_1min", _dws(MINUTE, 6) + f" GROUP BY symbol, {MINUTE}")
oracle("dws_5min", _dws(_FIVE, 8) + f" GROUP BY symbol, {_FIVE}")
oracle("serve_aggregates", _dws(_FIFTEEN, 8, True) + f" GROUP BY symbol, {_FIFTEEN}")

HOURLY = f"""SELECT symbol, strftime(date_trunc('hour', event_ts), '%Y-%m-%d %H:00') AS time,
  arg_min(price, pos) AS open, arg_max(price, pos) AS close, max(price) AS high, min(price) AS low,
  {r('sum(volume)', 2)} AS volume, count(*) AS tick_count"""
oracle("bars_hourly", HOURLY + " FROM t GROUP BY symbol, date_trunc('hour', event_ts)", "wide")
oracle(
    "source_fallback",
    HOURLY
    + """, CASE WHEN symbol IN ('GOLD', 'OIL') THEN 'live' ELSE 'history' END AS source
FROM t GROUP BY symbol, date_trunc('hour', event_ts)""",
    "wide",
)
_START = f"{MINUTE} - k * INTERVAL '1 minute'"
_SLIDE = f"FROM t, (SELECT unnest(range(5)) AS k) GROUP BY symbol, {_START}"
oracle(
    "bars_sliding",
    f"""SELECT symbol, {ts(_START)} AS window_start, {BAR8}, {ts(_START + " + INTERVAL '5 minutes'")} AS window_end {_SLIDE}""",
)
oracle(
    "stream_bars_sliding",
    f"""SELECT symbol, {ts(_START)} AS minute, {ts(_START + " + INTERVAL '5 minutes'")} AS minute_end, {BAR8} {_SLIDE}""",
)

# --- detail layer
MID = "CASE WHEN bid > 0 AND ask > 0 THEN (bid + ask) / 2 END"
oracle(
    "dwd_tick_detail",
    f"""SELECT symbol, {ts('event_ts')} AS event_time, seq, {r('price')} AS price, volume, {r('bid')} AS bid,
  {r('ask')} AS ask, {r('spread')} AS spread, {r('sp')} AS spread_pct, direction, {r('volatility')} AS volatility,
  high, low, {r('chg')} AS price_change, {r('chg_pct')} AS price_change_pct, {r(MID)} AS mid_price,
  CAST(hour(event_ts) AS INT) AS hour, {day('event_ts')} AS dt FROM t""",
    "wide",
)
oracle(
    "dwd_roundtrip_orc",
    f"""SELECT symbol, {day('event_ts')} AS dt, seq, {ts('event_ts')} AS event_time, {r('price')} AS price,
  {r('sp')} AS spread_pct, {r('chg')} AS price_change, {r(MID)} AS mid_price, CAST(hour(event_ts) AS INT) AS hour FROM t""",
    "wide",
)
oracle("enrich_spread_mid", f"SELECT symbol, seq, price, {r('sp')} AS spread_pct, {r(MID)} AS mid_price FROM t")
oracle(
    "derive_direction",
    """SELECT symbol, seq, price, p1 AS previous_price,
  CASE WHEN price > p1 THEN 'UP' WHEN price < p1 THEN 'DOWN' ELSE 'FLAT' END AS derived_direction FROM t""",
)
oracle("intraday_high_low", f"SELECT symbol, seq, {day('event_ts')} AS dt, high AS day_high, low AS day_low FROM t", "wide")
oracle(
    "parse_event_time",
    f""" x AS (SELECT seq, CASE seq % 3 WHEN 0 THEN strftime(event_ts, '%Y-%m-%dT%H:%M:%S')
  WHEN 1 THEN {ts('event_ts')} ELSE strftime(event_ts, '%d/%m/%Y %H:%M') END AS text FROM t),
y AS (SELECT seq, text, coalesce(try_strptime(text, '%Y-%m-%d %H:%M:%S'), try_strptime(text, '%Y-%m-%dT%H:%M:%S')) AS p FROM x)
SELECT seq, text, {ts('p')} AS parsed, {day('p')} AS dt, CAST(hour(p) AS INT) AS hour, strftime(p, '%H:%M') AS minute,
  {ts("date_trunc('hour', p)")} AS hour_start FROM y""",
    "wide",
)


# --- indicators
def last(n: int) -> str:
    return f"OVER (PARTITION BY symbol ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(n: int, x: str) -> str:
    return f"CASE WHEN pos >= {n - 1} THEN {x} END"


def lag(c: str, k: int) -> str:
    return f"lag({c}, {k}) OVER (PARTITION BY symbol ORDER BY pos)"


def pct(c: str, k: int) -> str:
    return f"({c} - {lag(c, k)}) / nullif({lag(c, k)}, 0) * 100"


def mean(n: int, c: str = "price") -> str:
    return full(n, f"avg({c}) {last(n)}")


RSI = full(
    15,
    f"100 - 100 / (1 + (avg(greatest(chg, 0.0)) {last(14)}) / ((avg(greatest(-chg, 0.0)) {last(14)}) + 1e-10))",
)
BB = full(20, f"(price - (avg(price) {last(20)})) / ((stddev_samp(price) {last(20)}) * 2 + 1e-10)")
VOL_RATIO = full(5, f"volume / ((avg(volume) {last(5)}) + 1e-10)")
SMAS = ", ".join(f"{r(mean(n))} AS sma_{n}" for n in (5, 10, 20))
oracle("sma_ticks", f"SELECT symbol, seq, {SMAS} FROM t")
LONG_RSI = full(
    401,
    f"100 - 100 / (1 + (avg(greatest(chg, 0.0)) {last(400)}) / ((avg(greatest(-chg, 0.0)) {last(400)}) + 1e-10))",
)
oracle(
    "sma_long",
    f"""SELECT symbol, seq, {r(mean(300))} AS sma_300, {r(mean(1000))} AS sma_1000, {r(pct('price', 500))} AS mom_500,
  {r(LONG_RSI)} AS rsi_400 FROM t""",
)
oracle(
    "series_append",
    f"SELECT symbol, seq, pos, direction, high, low, {r(mean(20))} AS sma_20 FROM t",
    "wide",
)
oracle("rsi_14", f"SELECT symbol, seq, {r(RSI)} AS rsi FROM t")
oracle("bollinger_pos", f"SELECT symbol, seq, {r(BB)} AS bb_pos FROM t")
oracle(
    "momentum",
    f"SELECT symbol, seq, {r(pct('price', 5))} AS mom5, {r(pct('price', 10))} AS mom10, {r(pct('price', 1))} AS chg1 FROM t",
)
oracle("volume_features", f"SELECT symbol, seq, {r(VOL_RATIO)} AS vol_ratio, {r(pct('volume', 5))} AS vol_chg FROM t")
oracle(
    "stream_sma_state",
    f"SELECT symbol, seq, price, {SMAS}, {r('chg')} AS price_change, {r('chg_pct')} AS price_change_pct, false AS late FROM t",
)
_OVER_BARS = "OVER (PARTITION BY symbol ORDER BY minute ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)"
oracle(
    "sma_bars",
    f""" b AS (SELECT symbol, {MINUTE} AS minute, arg_max(price, pos) AS close_price FROM t GROUP BY symbol, {MINUTE})
SELECT symbol, {ts('minute')} AS minute, close_price, """
    + ", ".join(
        f"CASE WHEN count(*) {_OVER_BARS.format(k=n - 1)} = {n} THEN {r(f'avg(close_price) {_OVER_BARS.format(k=n - 1)}')} END AS sma_{n}"
        for n in (5, 10, 20)
    )
    + " FROM b",
    "wide",
)

# --- model
_FEATURE_SQL = {
    "lag1": lag("price", 1),
    "lag2": lag("price", 2),
    "chg1": pct("price", 1),
    "sma_5_10": f"(({mean(5)}) - ({mean(10)})) / (price + 1e-10) * 100",
    "sma_10_20": f"(({mean(10)}) - ({mean(20)})) / (price + 1e-10) * 100",
    "rsi": RSI,
    "mom5": pct("price", 5),
    "mom10": pct("price", 10),
    "bb_pos": BB,
    "vol_ratio": VOL_RATIO,
    "vol_chg": pct("volume", 5),
    "spread_p": "spread / (price + 1e-10) * 100",
    "hl_p": "(high - low) / (price + 1e-10) * 100",
    "bam": "(bid + ask) / 2 - price",
    "volat": "volatility * 10000",
}
_LABEL = "CAST(lead(direction) OVER (PARTITION BY symbol ORDER BY pos) = 'UP' AS INT)"
FEATURE_ROWS = (
    " f AS (SELECT symbol, seq, pos, n, "
    + ", ".join(f"{_FEATURE_SQL[c]} AS {c}" for c in FEATURES)
    + f", {_LABEL} AS label FROM t), "
    + f"g AS (SELECT * FROM f WHERE {' AND '.join(f'{c} IS NOT NULL' for c in (*FEATURES, 'label'))}) "
)
oracle("ml_features", FEATURE_ROWS + f"SELECT symbol, seq, {', '.join(f'{r(c)} AS {c}' for c in FEATURES)}, label FROM g")
oracle(
    "ml_label_balance",
    FEATURE_ROWS + f"SELECT symbol, count(*) AS row_count, {r('avg(CAST(label AS DOUBLE))')} AS up_share FROM g GROUP BY symbol",
)
oracle(
    "ml_split",
    FEATURE_ROWS.replace("FROM t)", "FROM t)", 1)
    + """, pr AS (SELECT symbol, seq, percent_rank() OVER (PARTITION BY symbol ORDER BY pos) AS rank FROM t)
SELECT g.symbol, g.seq, g.label, CASE WHEN pr.rank <= 0.8 THEN 'train' ELSE 'test' END AS split
FROM g JOIN pr ON g.symbol = pr.symbol AND g.seq = pr.seq""",
)

oracle(
    "ml_newest_features",
    FEATURE_ROWS
    + f"""SELECT symbol, seq, {', '.join(f'{r(c)} AS {c}' for c in FEATURES)} FROM f
WHERE pos = n - 1 AND n >= 25 AND {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)}""",
)
oracle(
    "ml_holdout_base",
    FEATURE_ROWS
    + f""", pr AS (SELECT symbol, seq, percent_rank() OVER (PARTITION BY symbol ORDER BY pos) AS rank FROM t)
SELECT count(*) AS row_count, {r('avg(CAST(label AS DOUBLE))')} AS base_rate
FROM g JOIN pr ON g.symbol = pr.symbol AND g.seq = pr.seq WHERE pr.rank > 0.8""",
)
oracle(
    "rule_flips",
    f""" a AS (SELECT symbol, seq, pos, price, {mean(5)} AS s5 FROM t),
b AS (SELECT symbol, seq, pos, CAST(price > s5 AS INT) AS prediction FROM a WHERE s5 IS NOT NULL),
c AS (SELECT *, lag(prediction) OVER (PARTITION BY symbol ORDER BY pos) AS previous FROM b)
SELECT symbol, seq, previous, prediction FROM c WHERE previous <> prediction""",
)

# --- risk
FALL = "CASE WHEN peak > 0 THEN (peak - price) / peak * 100 ELSE 0.0 END"
RECENT = " w AS (SELECT * FROM t WHERE event_ts >= (SELECT max(event_ts) FROM t) - INTERVAL '7 days')"
RISK = (
    RECENT
    + f""", l AS (SELECT *, max(price) OVER (PARTITION BY symbol ORDER BY pos) AS peak FROM w WHERE pos >= n - 500),
risk AS (SELECT symbol, coalesce(avg(CASE WHEN volatility <> 0 THEN volatility END), 0) AS av,
  coalesce(max(CASE WHEN volatility <> 0 THEN volatility END), 0) AS mv, {group_mean('spread')} AS asp,
  max({FALL}) AS dd, count(*) AS tick_count FROM l GROUP BY symbol)"""
)
oracle(
    "max_drawdown",
    f""" p AS (SELECT symbol, price, max(price) OVER (PARTITION BY symbol ORDER BY pos) AS peak FROM t)
SELECT symbol, {r(f'max({FALL})')} AS max_drawdown_pct FROM p GROUP BY symbol""",
)
oracle(
    "max_drawdown_newest_first",
    RECENT
    + f""", p AS (SELECT symbol, price, max(price) OVER (PARTITION BY symbol ORDER BY pos DESC) AS peak
  FROM w WHERE pos >= n - 500)
SELECT symbol, {r(f'max({FALL})')} AS max_drawdown_pct FROM p GROUP BY symbol""",
    "wide",
)
oracle(
    "risk_metrics",
    RISK
    + f""" SELECT dim.symbol, name, {r('coalesce(av, 0)', 6)} AS avg_volatility, {r('coalesce(mv, 0)', 6)} AS max_volatility,
  {r('coalesce(asp, 0)', 4)} AS avg_spread, {r('coalesce(dd, 0)', 4)} AS max_drawdown_pct,
  coalesce(tick_count, 0) AS tick_count, color FROM dim LEFT JOIN risk USING (symbol)""",
    "wide",
)
oracle(
    "risk_radar",
    RISK
    + f""" SELECT symbol, {r('av * 10000')} AS volatility_axis, {r('asp * 100')} AS spread_axis, {r('dd')} AS drawdown_axis FROM risk""",
    "wide",
)

# --- marts, history
oracle(
    "ads_dashboard_metrics",
    f""" d AS (SELECT *, CAST(event_ts AS DATE) AS dte, {mean(5)} AS s5, {mean(10)} AS s10, {mean(20)} AS s20,
  max(price) OVER (PARTITION BY symbol, CAST(event_ts AS DATE) ORDER BY pos) AS peak FROM t)
SELECT symbol, {day('dte')} AS dt, arg_max(price, pos) AS latest_price, arg_min(price, pos) AS open_price,
  max(price) AS high_price, min(price) AS low_price, sum(volume) AS total_volume,
  {r('avg(volatility)')} AS avg_volatility, {r(f'max({FALL})')} AS max_drawdown, {r(group_mean('spread'))} AS avg_spread,
  {r('avg(sp)')} AS avg_spread_pct, {r('arg_max(s5, CASE WHEN s5 IS NOT NULL THEN pos END)')} AS sma_5,
  {r('arg_max(s10, CASE WHEN s10 IS NOT NULL THEN pos END)')} AS sma_10,
  {r('arg_max(s20, CASE WHEN s20 IS NOT NULL THEN pos END)')} AS sma_20,
  {r("avg(CASE WHEN direction = 'UP' THEN 1.0 ELSE 0.0 END)")} AS up_ratio, {ts('max(event_ts)')} AS update_time,
  {r('arg_max(price, pos) - arg_min(price, pos)')} AS price_change,
  {r('(arg_max(price, pos) - arg_min(price, pos)) / nullif(arg_min(price, pos), 0) * 100')} AS price_change_pct
FROM d GROUP BY symbol, dte""",
    "wide",
)
NEWEST = "FROM t WHERE pos = n - 1"
oracle(
    "ads_latest_snapshot",
    f"""SELECT symbol, price, volume, direction, {r('volatility')} AS volatility, {r('spread')} AS spread,
  {r('sp')} AS spread_pct, {r('chg_pct')} AS price_change_pct, {r('bid')} AS bid, {r('ask')} AS ask,
  {ts('event_ts')} AS event_time, {day('event_ts')} AS dt {NEWEST}""",
    "wide",
)
PROFILE = f""" h AS (SELECT symbol, count(*) AS cnt, {group_mean("price")} AS ap, min(price) AS mn, max(price) AS mx,
  sum(volume) AS tv, {group_mean("volume")} AS av, min(event_ts) AS ft, max(event_ts) AS lt,
  percentile_disc(0.5) WITHIN GROUP (ORDER BY price DESC) AS med FROM t GROUP BY symbol)"""
oracle(
    "hist_stats",
    PROFILE
    + f""" SELECT symbol, cnt AS count, {r('ap')} AS avg_price, mn AS min_price, mx AS max_price, tv AS total_volume,
  {r('av')} AS avg_volume, {ts('ft')} AS first_time, {ts('lt')} AS last_time, med AS median_price FROM h""",
    "wide",
)
oracle(
    "hist_total_rollup",
    """SELECT coalesce(symbol, 'ALL') AS symbol, count(*) AS row_count, sum(volume) AS total_volume
FROM t GROUP BY ROLLUP (symbol)""",
)
oracle(
    "hist_vs_latest",
    PROFILE
    + f""", nw AS (SELECT symbol, price AS rp, volume AS rv {NEWEST})
SELECT dim.symbol, name, {r('coalesce(ap, 0)', 4)} AS csv_avg, {r('coalesce(mn, 0)', 4)} AS csv_min,
  {r('coalesce(mx, 0)', 4)} AS csv_max, {r('coalesce(tv, 0)', 2)} AS csv_volume, coalesce(cnt, 0) AS csv_count,
  coalesce(rp, 0) AS rt_price, coalesce(rv, 0) AS rt_volume,
  CASE WHEN ap > 0 THEN {r(f'(coalesce(rp, 0) - {r("ap", 4)}) / ({r("ap", 4)}) * 100', 4)} ELSE 0 END AS diff_pct, color
FROM dim LEFT JOIN h USING (symbol) LEFT JOIN nw USING (symbol)""",
    "wide",
)
oracle(
    "data_asset_stats",
    PROFILE
    + f""" SELECT dim.symbol, name, color, coalesce(cnt, 0) AS csv_rows, {r('coalesce(ap, 0)', 4)} AS avg_price,
  {r('coalesce(mn, 0)', 4)} AS min_price, {r('coalesce(mx, 0)', 4)} AS max_price, {r('coalesce(tv, 0)', 2)} AS total_volume,
  coalesce({ts('ft')}, '') AS first, coalesce({ts('lt')}, '') AS last, coalesce(cnt, 0) AS lake_rows, cnt IS NOT NULL AS has_files
FROM dim LEFT JOIN h USING (symbol)""",
    "wide",
)

# --- serving
LATEST = (
    RECENT
    + f""", latest AS (SELECT dim.symbol, name, coalesce(price, 0) AS price, {r('coalesce(chg, 0)', 4)} AS price_change,
  {r('coalesce(chg_pct, 0)', 2)} AS price_change_pct, coalesce(volume, 0) AS volume, {r('coalesce(bid, 0)')} AS bid,
  {r('coalesce(ask, 0)')} AS ask, {r('coalesce(spread, 0)')} AS spread, coalesce(direction, 'N/A') AS direction,
  {r('coalesce(volatility, 0)')} AS volatility, color, unit
  FROM dim LEFT JOIN (SELECT * FROM w WHERE pos = n - 1) USING (symbol))"""
)
oracle("serve_latest", LATEST + " SELECT * FROM latest", "wide")
oracle(
    "serve_summary",
    LATEST
    + RISK.replace(RECENT, "")
    + f""" SELECT l.symbol, l.name, l.price, l.price_change, l.price_change_pct, {r('coalesce(dd, 0)', 4)} AS max_drawdown_pct
FROM latest l LEFT JOIN risk USING (symbol)""",
    "wide",
)
oracle(
    "serve_trend",
    f""" g AS (SELECT *, {mean(5)} AS s5, {mean(10)} AS s10 FROM t)
SELECT {ts('event_ts')} AS time, price, volume, {r('s5')} AS sma_5, {r('s10')} AS sma_10 FROM g
WHERE symbol = 'GOLD' AND pos >= n - 2000
  AND event_ts >= (SELECT max(event_ts) FROM t WHERE symbol = 'GOLD') - INTERVAL '4320 minutes'""",
)
oracle(
    "serve_volume",
    RECENT
    + f""" SELECT dim.symbol, any_value(name) AS name, {r('coalesce(sum(volume), 0)', 2)} AS total_volume,
  count(w.pos) AS tick_count, {r('coalesce(avg(volume), 0)', 4)} AS avg_volume, any_value(color) AS color
  FROM dim LEFT JOIN w USING (symbol) GROUP BY dim.symbol""",
    "wide",
)
oracle(
    "serve_candles",
    f""" b AS (SELECT symbol, {MINUTE} AS m, {BAR.replace(r(group_mean('price')), group_mean('price'))} FROM t
  WHERE symbol = 'GOLD' GROUP BY symbol, {MINUTE} ORDER BY m DESC LIMIT 60)
SELECT symbol, {ts('m')} AS bar_time, strftime(m, '%H:%M') AS time, {r('open_price', 2)} AS open, {r('high_price', 2)} AS high,
  {r('low_price', 2)} AS low, {r('close_price', 2)} AS close, {r('avg_price', 2)} AS avg, {r('total_volume', 2)} AS volume,
  tick_count FROM b""",
    "wide",
)
for _name in ("serve_latest", "serve_volume", "serve_summary", "hist_vs_latest"):
    SQL[f"{_name}_gap"] = SQL[_name].replace("'purchase','signup','view')", "'purchase','signup')")
oracle(
    "sample_head",
    f"""SELECT symbol, {ts('event_ts')} AS event_ts, price, volume, {r('bid')} AS bid, {r('ask')} AS ask,
  {r('spread')} AS spread, direction FROM t WHERE symbol = 'GOLD' AND pos < 5""",
)
oracle(
    "trend_downsample",
    f""" x AS (SELECT *, ntile(800) OVER (PARTITION BY symbol ORDER BY pos) AS tile FROM t)
SELECT symbol, CAST(tile AS INT) AS tile, arg_max(seq, pos) AS seq, {ts('max(event_ts)')} AS event_ts,
  arg_max(price, pos) AS price FROM x GROUP BY symbol, tile""",
)
oracle("systematic_sample", "SELECT symbol, pos // 50 AS sample_idx, seq, price FROM t WHERE pos % 50 = 0")
oracle(
    "dim_symbols",
    """ c AS (SELECT symbol, count(*) AS k FROM t GROUP BY symbol)
SELECT dim.symbol, name, unit, color, base, coalesce(k, 0) AS tick_count FROM dim LEFT JOIN c USING (symbol)""",
    "wide",
)


def _search(where: str, keyword: str | None = None) -> str:
    tag = "" if keyword is None else f", '{keyword}' AS keyword"
    return f"""(SELECT symbol, {ts('event_ts')} AS event_ts, price, volume, direction{tag}
  FROM t JOIN dim USING (symbol) WHERE {where} ORDER BY rk, pos LIMIT 10)"""


oracle("search_price_range", f"SELECT * FROM {_search('price BETWEEN 10 AND 20')}")
oracle("search_half_open", f"SELECT * FROM {_search('price >= 100', '100-')} UNION ALL {_search('price <= 1', '-1')}")
oracle(
    "search_keyword",
    f"""SELECT * FROM {_search("contains(symbol, 'UP') OR contains(lower(direction), 'up')", 'up')}
UNION ALL {_search("contains(symbol, 'GOL') OR contains(lower(direction), 'gol')", 'gol')}
UNION ALL {_search("true", '')}""",
)

# --- correlation
CORR = "coalesce(covar_pop(a.price, b.price) / nullif(stddev_pop(a.price) * stddev_pop(b.price), 0), 0)"
ALIGNED = """ m AS (SELECT min(k) AS len FROM (SELECT CAST(ceil(count(*) / 50.0) AS BIGINT) AS k FROM t GROUP BY symbol)),
s AS (SELECT t.symbol, pos // 50 AS i, price, rk, name, color FROM t JOIN dim USING (symbol), m
      WHERE pos % 50 = 0 AND pos // 50 < len)"""
oracle(
    "correlation_matrix",
    ALIGNED
    + f""" SELECT a.symbol AS from_symbol, b.symbol AS to_symbol, {r(CORR, 4)} AS value
FROM s a JOIN s b ON a.i = b.i GROUP BY a.symbol, b.symbol""",
)
oracle(
    "correlation_top_pairs",
    ALIGNED
    + f""", p AS (SELECT a.symbol || '-' || b.symbol AS pair, a.name || ' vs ' || b.name AS name,
  {r(CORR, 4)} AS correlation, a.color AS color1, b.color AS color2, a.rk AS ra, b.rk AS rb
  FROM s a JOIN s b ON a.i = b.i AND a.rk < b.rk GROUP BY a.symbol, b.symbol, a.name, b.name, a.color, b.color, a.rk, b.rk),
u AS ((SELECT *, 'top' AS listing FROM p ORDER BY abs(correlation) DESC, ra, rb LIMIT 3)
UNION ALL (SELECT *, 'positive' FROM p WHERE correlation > 0 ORDER BY abs(correlation) DESC, ra, rb LIMIT 2)
UNION ALL (SELECT *, 'negative' FROM p WHERE correlation < 0 ORDER BY abs(correlation) DESC, ra, rb LIMIT 2))
SELECT pair, name, correlation, color1, color2, CASE WHEN correlation > 0.5 THEN 'strong positive'
  WHEN correlation > 0 THEN 'weak positive' WHEN correlation < -0.5 THEN 'strong negative' ELSE 'weak negative' END AS strength,
  listing FROM u""",
)
oracle(
    "correlation_full",
    """ m AS (SELECT min(k) AS len FROM (SELECT count(*) AS k FROM t GROUP BY symbol)),
s AS (SELECT symbol, pos AS i, price FROM t, m WHERE pos < len)"""
    + f""" SELECT a.symbol AS from_symbol, b.symbol AS to_symbol, {r(CORR, 4)} AS value
FROM s a JOIN s b ON a.i = b.i GROUP BY a.symbol, b.symbol""",
)
oracle(
    "enough_rows_fallback",
    f""" live AS (SELECT * FROM t WHERE symbol = 'GOLD' OR (symbol = 'OIL' AND pos < 24)),
x AS (SELECT *, 'live' AS source FROM live
  UNION ALL SELECT *, 'history' FROM t WHERE symbol <> 'GOLD' AND seq NOT IN (SELECT seq FROM live)),
y AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY event_ts DESC, seq DESC) AS place FROM x)
SELECT symbol, {ts('event_ts')} AS event_ts, seq, price, source FROM y WHERE place <= 60""",
)
oracle(
    "correlation_by_minute",
    f""" s AS (SELECT symbol, {MINUTE} AS i, arg_max(price, pos) AS price FROM t GROUP BY symbol, {MINUTE}),
ranked AS (SELECT s.*, rk FROM s JOIN dim USING (symbol))
SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, {r(CORR, 4)} AS correlation
FROM ranked a JOIN ranked b ON a.i = b.i AND a.rk < b.rk GROUP BY a.symbol, b.symbol""",
)


# --- alerts
def _alerts(move: str) -> str:
    return f""" al AS (
SELECT symbol, event_ts, seq, price, {move} AS mv, 'upper' AS kind, 100.0::DOUBLE AS threshold FROM t WHERE price > 100
UNION ALL SELECT symbol, event_ts, seq, price, {move}, 'lower', 1.0::DOUBLE FROM t WHERE price < 1
UNION ALL SELECT symbol, event_ts, seq, price, {move}, 'volatility', 50.0::DOUBLE FROM t WHERE abs({move}) >= 50)
SELECT symbol, {ts('event_ts')} AS event_time, seq, price, {r('mv')} AS price_change_pct, kind, threshold FROM al"""


oracle("alerts_evaluate", _alerts("chg_pct"))
oracle("stream_alerts", _alerts("chg_pct"))
oracle("alerts_recent", _alerts("chg_pct") + " ORDER BY event_ts DESC, seq DESC, kind LIMIT 20")
LEARNED = f""" l AS (SELECT symbol, {r('avg(price) * 2', 4)} AS upper, {r('avg(price) / 2', 4)} AS lower,
  {r('max(volatility) * 100', 4)} AS vol_pct FROM t WHERE symbol IN ('GOLD', 'OIL') GROUP BY symbol)"""
oracle(
    "alert_config_upsert",
    LEARNED + " SELECT * FROM l UNION ALL SELECT * FROM limits WHERE symbol NOT IN (SELECT symbol FROM l)",
)
oracle(
    "alert_config_reset",
    LEARNED + " SELECT * FROM l WHERE symbol <> 'GOLD' UNION ALL SELECT * FROM limits WHERE symbol <> 'OIL'",
)

# --- sources and sinks
_TEXT = ts("event_ts")
_NUMBERS = ", ".join(f"{r(c)} AS {c}" for c in ("price", "volume", "bid", "ask", "spread", "volatility", "high", "low"))
oracle("src_csv_ticks", f"SELECT symbol, {_TEXT} AS timestamp, {_NUMBERS}, direction, {_TEXT} AS event_time FROM t")
oracle(
    "union_symbols",
    f"""SELECT symbol, count(*) AS row_count, min({_TEXT}) AS first_time, max({_TEXT}) AS last_time,
  sum(volume) AS total_volume FROM t GROUP BY symbol""",
    "wide",
)
oracle(
    "src_validate",
    """SELECT symbol, count(*) AS total_rows, count(*) FILTER (seq % 97 = 0) AS bad_rows,
  count(*) FILTER (seq % 97 = 0) = 0 AS ok FROM t GROUP BY symbol""",
)
oracle(
    "ods_scan",
    f"""SELECT symbol, seq, {_TEXT} AS event_ts, {day('event_ts')} AS dt, price, volume, {r('bid')} AS bid,
  {r('ask')} AS ask, {r('spread')} AS spread, direction FROM t""",
    "wide",
)
oracle(
    "stream_raw_ingest",
    f"""SELECT symbol, seq, {_TEXT} AS event_time, {day('event_ts')} AS dt, price, volume, {r('bid')} AS bid,
  {r('ask')} AS ask, direction FROM t""",
)
oracle(
    "json_encode_ticks",
    f"""SELECT symbol || '_' || {_TEXT} AS key, symbol, {_TEXT} AS event_time, direction, {_NUMBERS} FROM t""",
)
oracle(
    "json_decode_ticks",
    f""" k AS (SELECT *, seq % 50 AS kind FROM t)
SELECT seq, CASE WHEN kind = 7 THEN NULL WHEN kind = 37 THEN 'TIN' ELSE symbol END AS symbol,
  CASE WHEN kind NOT IN (7, 41) THEN price END AS price, CASE WHEN kind NOT IN (7, 31) THEN volume END AS volume,
  CASE WHEN kind <> 7 THEN {r('spread')} END AS spread, CASE WHEN kind <> 7 THEN direction END AS direction,
  CASE WHEN kind <> 7 THEN {_TEXT} END AS event_ts, CASE WHEN kind <> 7 THEN {day('event_ts')} END AS dt FROM k""",
)
oracle(
    "json_quarantine",
    """SELECT seq, CASE seq % 50 WHEN 7 THEN 'not a tick' WHEN 37 THEN 'unknown symbol' ELSE 'bad price' END AS reason
FROM t WHERE seq % 50 IN (7, 37, 41)""",
)
oracle(
    "replay_round_robin",
    """SELECT t.symbol, seq, pos AS round, row_number() OVER (ORDER BY pos, rk) - 1 AS send_order
FROM t JOIN dim USING (symbol)""",
)
oracle(
    "replay_loop",
    f""" sp AS (SELECT max(event_ts) - min(event_ts) + INTERVAL '1 second' AS span FROM t),
k AS (SELECT unnest(range(2)) AS pass)
SELECT symbol, seq, CAST(pass AS INT) AS pass, {ts('CASE WHEN pass = 0 THEN event_ts ELSE event_ts + span END')} AS event_ts,
  price FROM t, k, sp""",
)
oracle(
    "upsert_latest_by_key",
    f"""SELECT symbol, {ts(MINUTE)} AS timestamp, arg_max(seq, pos) AS seq, arg_max(price, pos) AS price
FROM t GROUP BY symbol, {MINUTE}""",
)
oracle(
    "stream_keyed_upsert",
    f""" x AS (SELECT *, row_number() OVER (PARTITION BY symbol, {MINUTE} ORDER BY pos DESC) AS k FROM t)
SELECT symbol, strftime(event_ts, '%Y-%m-%d %H:%M') AS timestamp, seq, price, {r('sp')} AS spread_pct,
  {r(MID)} AS mid_price FROM x WHERE k = 1
UNION ALL SELECT symbol, 'bad ' || seq, seq, price, {r('sp')}, {r(MID)} FROM t WHERE seq % 50 = 23""",
)

# --- data quality
oracle(
    "tick_rules",
    """SELECT symbol, count(*) AS tick_count, count(*) FILTER (direction NOT IN ('UP','DOWN','FLAT')) AS bad_direction,
  count(*) FILTER (NOT bid <= ask) AS crossed_quote, count(*) FILTER (NOT (price BETWEEN low AND high)) AS outside_range,
  count(*) FILTER (NOT price > 0) AS price_not_positive FROM t GROUP BY symbol""",
)
_COUNTS = {
    "ods_tick": "SELECT count(*) AS c FROM t",
    "dwd_tick_detail": "SELECT count(*) FROM t",
    "dws_tick_1min": f"SELECT count(*) FROM (SELECT DISTINCT symbol, {MINUTE} FROM t)",
    "dws_tick_5min": f"SELECT count(*) FROM (SELECT DISTINCT symbol, {_FIVE} FROM t)",
    "ads_dashboard_metrics": "SELECT count(*) FROM (SELECT DISTINCT symbol, CAST(event_ts AS DATE) FROM t)",
    "ads_latest_snapshot": "SELECT count(DISTINCT symbol) FROM t",
    "alerts_above_1e9": "SELECT count(*) FROM t WHERE price > 1e9",
}
oracle(
    "layer_health",
    " c AS ("
    + " UNION ALL ".join(f"SELECT '{k}' AS layer, ({v}) AS row_count" for k, v in _COUNTS.items())
    + ") SELECT layer, row_count, CASE WHEN row_count > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM c",
    "wide",
)
oracle(
    "adhoc_sql",
    f""" b AS (SELECT symbol, {_FIVE} AS m, {day('max(event_ts)')} AS dt, count(*) AS n, max(price) AS high,
  count(*) FILTER (direction = 'UP') AS u, count(*) FILTER (direction = 'DOWN') AS d FROM t GROUP BY symbol, {_FIVE})
SELECT symbol, dt, CAST(sum(n) AS BIGINT) AS ticks, max(high) AS high FROM b WHERE u > d GROUP BY symbol, dt""",
    "wide",
)
oracle(
    "flow_reconcile",
    f""" c AS (SELECT symbol, count(*) AS n, count(DISTINCT {MINUTE}) + count(*) FILTER (seq % 50 = 23) AS docs FROM t GROUP BY symbol),
u AS (SELECT count(*) AS n FROM t WHERE seq % 97 = 0)
SELECT symbol, n AS messages, n AS ticks, 0 AS rejected, n AS lake_rows, docs AS keyed_docs FROM c
UNION ALL SELECT 'TIN', n, 0, n, 0, 0 FROM u WHERE n > 0""",
)
