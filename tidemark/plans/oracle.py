"""DuckDB SQL twins of the named compositions in ``catalog``.

Each entry is a complete statement over the raw test tables (region nation
supplier part lineitem events).  Shared steps are CTE fragments; every
statement lists only the fragments it needs.  Column names and types are
aligned with the Spark results (INTEGER for calendar parts and ranks, BIGINT
for counts and sums).
"""

from __future__ import annotations

# ------------------------------------------------------------- fragments

_SEQ = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, quantity"

FRAG = {
    "dim": """dim AS (
    SELECT CAST(r_regionkey AS INTEGER) AS exchange_id, r_name AS exchange_name FROM region)""",
    "bar_trades": """bar_trades AS (
    SELECT p.p_brand AS ticker, d.exchange_id, d.exchange_name,
           CAST(l.l_shipdate AS DATE) AS trade_date,
           l.l_extendedprice / l.l_quantity AS price, l.l_quantity AS quantity,
           l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice
    FROM lineitem l
    JOIN part p ON l.l_partkey = p.p_partkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN dim d ON n.n_regionkey = d.exchange_id)""",
    "bars": f"""bars AS (
    SELECT ticker, exchange_id, exchange_name, trade_date,
           first(price ORDER BY {_SEQ}) AS open_price,
           max(price) AS high_price,
           min(price) AS low_price,
           first(price ORDER BY {_SEQ.replace(',', ' DESC,')} DESC) AS close_price,
           CAST(sum(quantity) AS BIGINT) AS volume,
           first(price ORDER BY {_SEQ.replace(',', ' DESC,')} DESC) AS adjusted_close_price
    FROM bar_trades
    GROUP BY ticker, exchange_id, exchange_name, trade_date)""",
    "clean": """clean AS (
    SELECT * FROM bars
    WHERE trade_date IS NOT NULL AND open_price > 0 AND high_price > 0 AND low_price > 0
      AND close_price > 0 AND volume IS NOT NULL AND volume >= 0 AND high_price >= low_price)""",
    "deduped": """deduped AS (
    SELECT ticker, trade_date, open_price, high_price, low_price, close_price,
           adjusted_close_price, volume, exchange_id
    FROM (SELECT *, row_number() OVER (
                 PARTITION BY ticker, trade_date
                 ORDER BY exchange_id, open_price, high_price, low_price, close_price,
                          adjusted_close_price, volume) AS rn
          FROM clean) x
    WHERE rn = 1)""",
    "silver": """silver AS (
    SELECT ticker, trade_date,
           CAST(year(trade_date) AS INTEGER) AS year,
           CAST(month(trade_date) AS INTEGER) AS month,
           CAST(quarter(trade_date) AS INTEGER) AS quarter,
           CAST(dayofweek(trade_date) + 1 AS INTEGER) AS day_of_week,
           open_price, high_price, low_price, close_price, adjusted_close_price, volume,
           high_price - low_price AS daily_range,
           close_price - open_price AS daily_change,
           CASE WHEN open_price > 0
                THEN (close_price - open_price) / open_price * 100 END AS daily_change_pct
    FROM deduped)""",
    "bridge": """bridge AS (
    SELECT DISTINCT ticker, CAST(exchange_id AS INTEGER) AS exchange_id FROM clean)""",
    "daily_w": """daily_w AS (
    SELECT ticker, trade_date, year, open_price, high_price, low_price, close_price,
           adjusted_close_price, volume, daily_change_pct,
           lag(close_price) OVER (PARTITION BY ticker ORDER BY trade_date) AS prev_close_price,
           CAST(round(avg(volume) OVER (PARTITION BY ticker ORDER BY trade_date
                ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)) AS BIGINT) AS avg_volume_20d,
           CAST(round(avg(volume) OVER (PARTITION BY ticker ORDER BY trade_date
                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) AS BIGINT) AS avg_volume_7d,
           max(high_price) OVER (PARTITION BY ticker ORDER BY trade_date
                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_high_7d,
           min(low_price) OVER (PARTITION BY ticker ORDER BY trade_date
                ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_low_7d,
           stddev_samp(daily_change_pct) OVER (PARTITION BY ticker ORDER BY trade_date
                ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_volatility_30d
    FROM silver)""",
    "daily": """daily AS (
    SELECT *, volume_ratio > 2.0 AS is_volume_spike,
           daily_change_pct < -10 AS is_significant_drop
    FROM (SELECT *, CASE WHEN avg_volume_20d > 0
                         THEN volume / avg_volume_20d END AS volume_ratio
          FROM daily_w) x)""",
    "monthly": """monthly AS (
    SELECT *, CASE WHEN month_open_price > 0
                   THEN (month_close_price - month_open_price) / month_open_price * 100
              END AS monthly_return_pct
    FROM (SELECT ticker, year, month,
                 min(trade_date) AS first_trade_date, max(trade_date) AS last_trade_date,
                 count(*) AS trading_days,
                 arg_min(open_price, trade_date) AS month_open_price,
                 arg_max(close_price, trade_date) AS month_close_price,
                 max(high_price) AS month_high_price, min(low_price) AS month_low_price,
                 CAST(sum(volume) AS BIGINT) AS total_volume,
                 CAST(round(avg(volume)) AS BIGINT) AS avg_daily_volume,
                 avg(daily_range) AS avg_intraday_range,
                 max(daily_range) AS max_intraday_range,
                 avg(CASE WHEN open_price > 0 THEN daily_range / open_price * 100 END)
                     AS avg_intraday_range_pct
          FROM silver GROUP BY ticker, year, month) x)""",
    "yearly": """yearly AS (
    SELECT *, CASE WHEN year_open_price > 0
                   THEN (year_close_price - year_open_price) / year_open_price * 100
              END AS yearly_return_pct
    FROM (SELECT ticker, year,
                 min(trade_date) AS first_trade_date, max(trade_date) AS last_trade_date,
                 count(*) AS trading_days,
                 arg_min(open_price, trade_date) AS year_open_price,
                 arg_max(close_price, trade_date) AS year_close_price,
                 max(high_price) AS year_high_price, min(low_price) AS year_low_price,
                 CAST(sum(volume) AS BIGINT) AS total_volume,
                 CAST(round(avg(volume)) AS BIGINT) AS avg_daily_volume,
                 avg(daily_change_pct) AS avg_daily_return_pct,
                 stddev_samp(daily_change_pct) AS stddev_daily_return,
                 count(*) FILTER (WHERE daily_change_pct > 0) AS positive_days,
                 count(*) FILTER (WHERE daily_change_pct < 0) AS negative_days
          FROM silver GROUP BY ticker, year) x)""",
    "mret": """mret AS (
    SELECT ticker, year, month, monthly_return_pct FROM monthly
    WHERE monthly_return_pct IS NOT NULL)""",
    "trades": """trades AS (
    SELECT event_type AS symbol, value AS price, epoch_us(ts) // 1000 AS timestamp_ms,
           CAST(1.0 AS DOUBLE) AS volume, ts AS event_time, event_id
    FROM events)""",
    "valid_trades": """valid_trades AS (
    SELECT * FROM trades WHERE price IS NOT NULL AND price > 0)""",
    "quote_days": """quote_days AS (
    SELECT symbol, CAST(event_time AS DATE) AS d,
           first(price ORDER BY event_time, event_id) AS open_price,
           first(price ORDER BY event_time DESC, event_id DESC) AS current_price,
           max(price) AS high_price, min(price) AS low_price,
           first(timestamp_ms ORDER BY event_time DESC, event_id DESC) AS api_timestamp
    FROM trades GROUP BY symbol, CAST(event_time AS DATE))""",
    "quotes": """quotes AS (
    SELECT symbol,
           ['X' || CAST(length(symbol) % 3 AS VARCHAR), 'ALL'] AS exchange,
           current_price,
           current_price - prev_close AS change,
           CASE WHEN prev_close > 0
                THEN (current_price - prev_close) / prev_close * 100 END AS change_pct,
           high_price, low_price, open_price, prev_close, api_timestamp,
           strftime(d, '%Y-%m-%d') AS quote_date
    FROM (SELECT *, lag(current_price) OVER (PARTITION BY symbol ORDER BY d) AS prev_close
          FROM quote_days) x)""",
    "snapshot": """snapshot AS (
    SELECT * FROM quotes WHERE quote_date = (SELECT max(quote_date) FROM quotes))""",
    "baselines": """baselines AS (
    SELECT symbol, max(high_price) AS max_7d_high, min(low_price) AS min_7d_low,
           avg(prev_close) AS avg_prev_close,
           CAST(count(DISTINCT quote_date) AS INTEGER) AS days_count
    FROM quotes
    WHERE quote_date >= (SELECT min(quote_date) FROM
                           (SELECT DISTINCT quote_date FROM quotes
                            ORDER BY quote_date DESC LIMIT 7) t)
    GROUP BY symbol)""",
}

# Which fragments each fragment needs (in dependency order).
_NEEDS = {
    "dim": [], "bar_trades": ["dim"], "bars": ["bar_trades"], "clean": ["bars"],
    "deduped": ["clean"], "silver": ["deduped"], "bridge": ["clean"],
    "daily_w": ["silver"], "daily": ["daily_w"], "monthly": ["silver"], "yearly": ["silver"],
    "mret": ["monthly"], "trades": [], "valid_trades": ["trades"],
    "quote_days": ["trades"], "quotes": ["quote_days"], "snapshot": ["quotes"],
    "baselines": ["quotes"],
}


def _resolve(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for dep in _NEEDS[n]:
            visit(dep)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def with_(names, body: str) -> str:
    return "WITH " + ",\n".join(FRAG[n] for n in _resolve(names)) + "\n" + body


def _r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"


# ------------------------------------------------------------ statements

SQL: dict[str, str] = {}

SQL["bars"] = with_(["bars"], "SELECT * FROM bars")

SQL["bar_quality_report"] = with_(["bars"], """
SELECT count(*) AS total,
       count(*) FILTER (WHERE NOT coalesce(trade_date IS NOT NULL, false)) AS failed_date_present,
       count(*) FILTER (WHERE NOT coalesce(open_price > 0, false)) AS failed_open_positive,
       count(*) FILTER (WHERE NOT coalesce(high_price > 0, false)) AS failed_high_positive,
       count(*) FILTER (WHERE NOT coalesce(low_price > 0, false)) AS failed_low_positive,
       count(*) FILTER (WHERE NOT coalesce(close_price > 0, false)) AS failed_close_positive,
       count(*) FILTER (WHERE NOT coalesce(volume IS NOT NULL, false)) AS failed_volume_present,
       count(*) FILTER (WHERE NOT coalesce(volume >= 0, false)) AS failed_volume_non_negative,
       count(*) FILTER (WHERE NOT coalesce(high_price >= low_price, false))
           AS failed_high_not_below_low,
       count(*) FILTER (WHERE coalesce(trade_date IS NOT NULL AND open_price > 0
           AND high_price > 0 AND low_price > 0 AND close_price > 0 AND volume IS NOT NULL
           AND volume >= 0 AND high_price >= low_price, false)) AS passed
FROM bars""")

SQL["bar_quality_filter"] = with_(["clean"], "SELECT * FROM clean")
SQL["bar_dedupe"] = with_(["deduped"], "SELECT * FROM deduped")
SQL["bar_derivations"] = with_(["silver"], """
SELECT ticker, trade_date, daily_range, daily_change, daily_change_pct FROM silver""")
SQL["silver"] = with_(["silver"], "SELECT * FROM silver")
SQL["exchange_dim"] = with_(["dim"], "SELECT * FROM dim")
SQL["ticker_exchanges"] = with_(["bridge"], "SELECT * FROM bridge")
SQL["ticker_exchanges_kept"] = with_(["deduped"], """
SELECT DISTINCT ticker, CAST(exchange_id AS INTEGER) AS exchange_id FROM deduped""")

SQL["daily_metrics"] = with_(["daily"], f"""
SELECT ticker, trade_date, year, open_price, high_price, low_price, close_price,
       adjusted_close_price, volume, daily_change_pct, prev_close_price, avg_volume_20d,
       avg_volume_7d, volume_ratio, is_volume_spike, is_significant_drop,
       {_r('rolling_volatility_30d')} AS rolling_volatility_30d, rolling_high_7d, rolling_low_7d
FROM daily""")

SQL["monthly_performance"] = with_(["monthly"], f"""
SELECT * REPLACE ({_r('avg_intraday_range')} AS avg_intraday_range,
                  {_r('avg_intraday_range_pct')} AS avg_intraday_range_pct)
FROM monthly""")

SQL["yearly_performance"] = with_(["yearly"], f"""
SELECT * REPLACE ({_r('avg_daily_return_pct')} AS avg_daily_return_pct,
                  {_r('stddev_daily_return')} AS stddev_daily_return)
FROM yearly""")

SQL["daily_quotes"] = with_(["quotes"], "SELECT * FROM quotes")
SQL["latest_snapshot"] = with_(["snapshot"], "SELECT * FROM snapshot")
SQL["quote_baselines"] = with_(["baselines"], f"""
SELECT * REPLACE ({_r('avg_prev_close')} AS avg_prev_close) FROM baselines""")
SQL["quote_baselines_all_days"] = with_(["quotes"], f"""
SELECT symbol, max(high_price) AS max_7d_high, min(low_price) AS min_7d_low,
       {_r('avg(prev_close)')} AS avg_prev_close,
       CAST(count(DISTINCT quote_date) AS INTEGER) AS days_count
FROM quotes GROUP BY symbol""")

# ------------------------------------------------------------- questions

_EXCH_YEARLY = """
    SELECT y.ticker, y.year, y.yearly_return_pct, b.exchange_id, d.exchange_name
    FROM yearly y JOIN bridge b ON y.ticker = b.ticker JOIN dim d ON b.exchange_id = d.exchange_id
    WHERE y.yearly_return_pct IS NOT NULL"""

SQL["q01_top_n"] = with_(["yearly", "bridge", "dim"], f"""
SELECT exchange_id, exchange_name, year, ticker, yearly_return_pct, return_rank
FROM (SELECT *, CAST(rank() OVER (PARTITION BY exchange_id, year
                                  ORDER BY yearly_return_pct DESC) AS INTEGER) AS return_rank
      FROM ({_EXCH_YEARLY}) j) r
WHERE return_rank <= 3""")

SQL["q02_period_change"] = with_(["yearly"], """
SELECT ticker, year, yearly_return_pct, prev_year_return_pct,
       round(yearly_return_pct - prev_year_return_pct, 4) AS yoy_return_change
FROM (SELECT ticker, year, yearly_return_pct,
             lag(yearly_return_pct) OVER (PARTITION BY ticker ORDER BY year)
                 AS prev_year_return_pct
      FROM yearly WHERE yearly_return_pct IS NOT NULL) x""")

SQL["q02_adjacent"] = with_(["yearly"], """
SELECT ticker, year, yearly_return_pct, prev_year_return_pct,
       round(yearly_return_pct - prev_year_return_pct, 4) AS yoy_return_change
FROM (SELECT ticker, year, yearly_return_pct,
             CASE WHEN year - lag(year) OVER (PARTITION BY ticker ORDER BY year) = 1
                  THEN lag(yearly_return_pct) OVER (PARTITION BY ticker ORDER BY year)
             END AS prev_year_return_pct
      FROM yearly WHERE yearly_return_pct IS NOT NULL) x""")

SQL["q03_worst_vs_mean"] = with_(["mret"], """
SELECT year, month, ticker,
       round(monthly_return_pct, 4) AS monthly_return_pct,
       round(avg_monthly_return_pct, 4) AS avg_monthly_return_pct,
       round(return_vs_avg, 4) AS return_vs_avg
FROM (SELECT *, rank() OVER (PARTITION BY year, month ORDER BY return_vs_avg ASC) AS drop_rank
      FROM (SELECT *, avg(monthly_return_pct) OVER (PARTITION BY ticker)
                          AS avg_monthly_return_pct,
                   monthly_return_pct - avg(monthly_return_pct) OVER (PARTITION BY ticker)
                          AS return_vs_avg
            FROM mret) a) r
WHERE drop_rank = 1""")


def _q04(total: str) -> str:
    return with_(["mret"], f"""
SELECT ticker, year, month, drop_month_return_pct, rolling_3month_recovery_pct
FROM (SELECT ticker, year, month,
             round(prev_month_return_pct, 4) AS drop_month_return_pct,
             round(rolling_return, 4) AS rolling_3month_recovery_pct
      FROM (SELECT ticker, year, month,
                   lag(monthly_return_pct) OVER (PARTITION BY ticker ORDER BY year, month)
                       AS prev_month_return_pct,
                   {total} AS rolling_return
            FROM mret) x
      WHERE prev_month_return_pct < 0 AND rolling_return > 0) y
ORDER BY rolling_3month_recovery_pct DESC, ticker, year, month
LIMIT 100""")


_W3 = "OVER (PARTITION BY ticker ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
SQL["q04_recovery"] = _q04(f"sum(monthly_return_pct) {_W3}")
SQL["q04_compound"] = _q04(f"(exp(sum(ln(1 + monthly_return_pct / 100)) {_W3}) - 1) * 100")

SQL["q05_cumulative_rank"] = with_(["mret"], """
SELECT ticker, year, month,
       round(monthly_return_pct, 4) AS monthly_return_pct,
       round(cumulative_return_pct, 4) AS cumulative_return_pct,
       CAST(rank() OVER (PARTITION BY year, month ORDER BY cumulative_return_pct DESC)
            AS INTEGER) AS cumulative_rank
FROM (SELECT *, sum(monthly_return_pct) OVER (
                    PARTITION BY ticker, year ORDER BY month
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_return_pct
      FROM mret) c""")

SQL["q05_compound"] = with_(["mret"], """
SELECT ticker, year, month,
       round(monthly_return_pct, 4) AS monthly_return_pct,
       round(cumulative_return_pct, 4) AS cumulative_return_pct,
       CAST(rank() OVER (PARTITION BY year, month ORDER BY cumulative_return_pct DESC)
            AS INTEGER) AS cumulative_rank
FROM (SELECT *, (exp(sum(ln(1 + monthly_return_pct / 100)) OVER (
                    PARTITION BY ticker, year ORDER BY month
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) - 1) * 100
                    AS cumulative_return_pct
      FROM mret) c""")

SQL["q06_outperformance"] = with_(["yearly", "bridge", "dim"], f"""
SELECT ticker, exchange_id, exchange_name, years_outperformed, total_years,
       CAST(round(years_outperformed * 100.0 / total_years, 2) AS DOUBLE)
           AS outperformance_rate_pct
FROM (SELECT ticker, exchange_id, exchange_name,
             CAST(sum(CASE WHEN yearly_return_pct > exchange_avg_return_pct THEN 1 ELSE 0 END)
                  AS BIGINT) AS years_outperformed,
             count(*) AS total_years
      FROM (SELECT *, avg(yearly_return_pct) OVER (PARTITION BY exchange_id, year)
                          AS exchange_avg_return_pct
            FROM ({_EXCH_YEARLY}) j) a
      GROUP BY ticker, exchange_id, exchange_name) s
WHERE years_outperformed >= 5""")

SQL["q07_above_mean"] = with_(["daily"], """
SELECT ticker, trade_date, year,
       round(rolling_volatility_30d, 6) AS rolling_volatility_30d,
       round(annual_avg_volatility, 6) AS annual_avg_volatility,
       round(rolling_volatility_30d - annual_avg_volatility, 6) AS volatility_above_avg
FROM (SELECT ticker, trade_date, year, rolling_volatility_30d,
             avg(rolling_volatility_30d) OVER (PARTITION BY ticker, year)
                 AS annual_avg_volatility
      FROM daily WHERE rolling_volatility_30d IS NOT NULL) v
WHERE rolling_volatility_30d > annual_avg_volatility""")


def _q08(inner: str) -> str:
    return with_(["daily"], f"""
SELECT ticker, trade_date, year, volume, avg_volume_20d,
       round(volume_ratio, 4) AS volume_ratio,
       round(daily_change_pct, 6) AS spike_day_change_pct,
       round(next_day_change_pct, 6) AS next_day_change_pct,
       CASE WHEN next_day_change_pct > 0 THEN 'up'
            WHEN next_day_change_pct < 0 THEN 'down' ELSE 'flat' END AS next_day_direction
FROM ({inner}) s
WHERE next_day_change_pct IS NOT NULL""")


SQL["q08_spike_followup"] = _q08("""
    SELECT *, lead(daily_change_pct) OVER (PARTITION BY ticker ORDER BY trade_date)
                  AS next_day_change_pct
    FROM daily WHERE is_volume_spike = TRUE""")
SQL["q08_trading_day"] = _q08("""
    SELECT * FROM (SELECT *, lead(daily_change_pct) OVER (PARTITION BY ticker ORDER BY trade_date)
                                 AS next_day_change_pct FROM daily) a
    WHERE is_volume_spike = TRUE""")

SQL["q09_percentile"] = with_(["monthly", "bridge", "dim"], """
SELECT m.ticker, b.exchange_id, d.exchange_name, m.year, m.month,
       round(m.avg_intraday_range_pct, 4) AS avg_intraday_range_pct,
       round(percent_rank() OVER (PARTITION BY b.exchange_id, m.year, m.month
                                  ORDER BY m.avg_intraday_range_pct), 4)
           AS volatility_percentile
FROM monthly m JOIN bridge b ON m.ticker = b.ticker JOIN dim d ON b.exchange_id = d.exchange_id
WHERE m.avg_intraday_range_pct IS NOT NULL""")


def _q10(brk: str, bounds: str) -> str:
    return with_(["mret"], f"""
SELECT ticker, {bounds}, count(*) AS consecutive_months
FROM (SELECT *, sum(brk) OVER (PARTITION BY ticker ORDER BY year, month
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak_id
      FROM (SELECT *, CASE WHEN {brk} THEN 1 ELSE 0 END AS brk
            FROM (SELECT *, CASE WHEN monthly_return_pct > 0 THEN 1 ELSE 0 END AS pos,
                         lag(CASE WHEN monthly_return_pct > 0 THEN 1 ELSE 0 END)
                             OVER (PARTITION BY ticker ORDER BY year, month) AS prev_pos,
                         year * 12 + month - lag(year * 12 + month)
                             OVER (PARTITION BY ticker ORDER BY year, month) AS step
                  FROM mret) a) b) c
GROUP BY ticker, streak_id
HAVING min(pos) = 1 AND count(*) >= 6""")


_FIRST_LAST = """arg_min(year, year * 12 + month) AS streak_start_year,
       arg_min(month, year * 12 + month) AS streak_start_month,
       arg_max(year, year * 12 + month) AS streak_end_year,
       arg_max(month, year * 12 + month) AS streak_end_month"""
_INDEPENDENT = """min(year) AS streak_start_year, min(month) AS streak_start_month,
       max(year) AS streak_end_year, max(month) AS streak_end_month"""
SQL["q10_streaks"] = _q10("prev_pos IS NULL OR pos <> prev_pos", _FIRST_LAST)
SQL["q10_independent_bounds"] = _q10("prev_pos IS NULL OR pos <> prev_pos", _INDEPENDENT)
SQL["q10_adjacent"] = _q10("prev_pos IS NULL OR pos <> prev_pos OR step <> 1", _FIRST_LAST)

# ------------------------------------------------------ windows in isolation

SQL["win_lag"] = with_(["silver"], """
SELECT ticker, trade_date, close_price,
       lag(close_price) OVER (PARTITION BY ticker ORDER BY trade_date) AS prev_close_price
FROM silver""")

SQL["win_lag_default"] = with_(["silver"], """
SELECT ticker, trade_date, volume,
       lag(volume, 5, volume) OVER (PARTITION BY ticker ORDER BY trade_date) AS volume_5_before
FROM silver""")

SQL["win_row_number"] = with_(["silver"], """
SELECT ticker, year, trade_date, volume,
       CAST(row_number() OVER (PARTITION BY ticker, year ORDER BY volume DESC, trade_date)
            AS INTEGER) AS volume_place
FROM silver""")

SQL["win_lead"] = with_(["silver"], """
SELECT ticker, trade_date, daily_change_pct,
       lead(daily_change_pct) OVER (PARTITION BY ticker ORDER BY trade_date) AS next_change_pct
FROM silver""")

SQL["win_rank"] = with_(["mret"], """
SELECT *, CAST(rank() OVER (PARTITION BY year, month ORDER BY monthly_return_pct DESC)
               AS INTEGER) AS return_rank
FROM mret""")

SQL["win_percent_rank"] = with_(["mret"], f"""
SELECT *, {_r('percent_rank() OVER (PARTITION BY year, month ORDER BY monthly_return_pct)')}
              AS pct_rank
FROM mret""")

SQL["win_rolling_mean_excl"] = with_(["silver"], """
SELECT ticker, trade_date, volume,
       avg(volume) OVER (PARTITION BY ticker ORDER BY trade_date
                         ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS avg_volume_prev20
FROM silver""")

SQL["win_rolling_extrema"] = with_(["silver"], """
SELECT ticker, trade_date, high_price, low_price,
       max(high_price) OVER (PARTITION BY ticker ORDER BY trade_date
                             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS high_7,
       min(low_price) OVER (PARTITION BY ticker ORDER BY trade_date
                            ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS low_7
FROM silver""")

SQL["win_rolling_stddev"] = with_(["silver"], f"""
SELECT ticker, trade_date, daily_change_pct,
       {_r('stddev_samp(daily_change_pct) OVER (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)')}
           AS vol_30
FROM silver""")

SQL["win_rolling_sum"] = with_(["mret"], f"""
SELECT *, {_r('sum(monthly_return_pct) OVER (PARTITION BY ticker ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')}
              AS sum_3
FROM mret""")

SQL["win_running_sum"] = with_(["mret"], f"""
SELECT *, {_r('sum(monthly_return_pct) OVER (PARTITION BY ticker, year ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')}
              AS ytd_return
FROM mret""")

SQL["win_partition_mean"] = with_(["mret"], f"""
SELECT *, {_r('avg(monthly_return_pct) OVER (PARTITION BY ticker)')} AS mean_return,
       {_r('monthly_return_pct - avg(monthly_return_pct) OVER (PARTITION BY ticker)')} AS vs_mean
FROM mret""")

SQL["win_islands"] = _q10("prev_pos IS NULL OR pos <> prev_pos", _FIRST_LAST).replace(
    "HAVING min(pos) = 1 AND count(*) >= 6", "HAVING min(pos) = 1 AND count(*) >= 1").replace(
    "streak_start_year", "start_year").replace("streak_start_month", "start_month").replace(
    "streak_end_year", "end_year").replace("streak_end_month", "end_month").replace(
    "AS consecutive_months", "AS length")

# ------------------------------------------------------------- aggregates

SQL["agg_first_last"] = with_(["silver"], """
SELECT ticker, year, quarter,
       arg_min(open_price, trade_date) AS quarter_open,
       arg_max(close_price, trade_date) AS quarter_close
FROM silver GROUP BY ticker, year, quarter""")

SQL["agg_conditional"] = with_(["silver"], """
SELECT ticker, year,
       count(*) FILTER (WHERE daily_change_pct > 0) AS up_days,
       count(*) FILTER (WHERE daily_change_pct < 0) AS down_days,
       round(avg(CASE WHEN daily_change_pct > 0 THEN daily_change_pct END), 6) AS avg_up_pct
FROM silver GROUP BY ticker, year""")

SQL["agg_distinct_days"] = with_(["quotes"], """
SELECT symbol, CAST(count(DISTINCT quote_date) AS INTEGER) AS days_count
FROM quotes GROUP BY symbol""")

# ------------------------------------------------------------ stream twins

SQL["trade_decode"] = with_(["trades"], """
SELECT symbol, price, timestamp_ms, volume, epoch_ms(timestamp_ms) AS event_time
FROM trades""")

SQL["trade_envelope_flatten"] = with_(["trades"], """
SELECT symbol, price, timestamp_ms, volume, epoch_ms(timestamp_ms) AS event_time
FROM trades WHERE symbol <> 'error' AND symbol IS NOT NULL AND symbol <> ''""")


def _bucket(width: str) -> str:
    return (f"time_bucket(INTERVAL '{width}', event_time) AS window_start, "
            f"time_bucket(INTERVAL '{width}', event_time) + INTERVAL '{width}' AS window_end")


SQL["sq1_price_volatility"] = with_(["valid_trades"], f"""
SELECT {_bucket('10 minutes')}, symbol,
       round(avg(price), 4) AS avg_price,
       round(stddev_samp(price), 4) AS stddev_price,
       round(stddev_samp(price) / avg(price) * 100, 4) AS volatility_coeff,
       count(price) AS trade_count
FROM valid_trades
GROUP BY 1, 2, symbol
HAVING stddev_samp(price) IS NOT NULL""")

SQL["sq2_market_sentiment"] = with_(["valid_trades", "snapshot"], f"""
SELECT window_start, window_end, exchange, rising_count, falling_count,
       round(rising_count / (rising_count + falling_count), 4) AS sentiment_ratio
FROM (SELECT {_bucket('1 minute')}, s.exchange,
             count(*) FILTER (WHERE t.price > s.prev_close) AS rising_count,
             count(*) FILTER (WHERE t.price < s.prev_close) AS falling_count
      FROM valid_trades t
      JOIN (SELECT symbol, prev_close, unnest(exchange) AS exchange FROM snapshot
            WHERE prev_close IS NOT NULL AND prev_close > 0) s ON t.symbol = s.symbol
      GROUP BY 1, 2, s.exchange) w
WHERE rising_count + falling_count > 0""")


def _sq3(threshold: float) -> str:
    return with_(["valid_trades"], f"""
SELECT {_bucket('10 minutes')}, symbol, count(price) AS trade_count,
       count(price) > {threshold} AS is_high_frequency
FROM valid_trades GROUP BY 1, 2, symbol""")


SQL["sq3_trade_frequency"] = _sq3(2.0)
SQL["sq3_default_baseline"] = _sq3(20.0)

SQL["sq3_symbol_baseline"] = with_(["valid_trades"], f"""
SELECT w.window_start, w.window_end, w.symbol, w.trade_count,
       w.trade_count > b.baseline * 1.5 AS is_high_frequency
FROM (SELECT {_bucket('10 minutes')}, symbol, count(price) AS trade_count
      FROM valid_trades GROUP BY 1, 2, symbol) w
LEFT JOIN (SELECT symbol, avg(n) AS baseline
           FROM (SELECT symbol, count(price) AS n FROM valid_trades
                 GROUP BY time_bucket(INTERVAL '10 minutes', event_time), symbol) x
           GROUP BY symbol) b ON w.symbol = b.symbol""")

SQL["sq4_price_vs_range"] = with_(["valid_trades", "baselines"], f"""
SELECT window_start, window_end, symbol,
       round(current_price, 4) AS current_price,
       round(max_7d_high, 4) AS max_7d_high,
       round(min_7d_low, 4) AS min_7d_low,
       pct_from_high, pct_from_low,
       CASE WHEN pct_from_high <= 2.0 THEN 'near_high'
            WHEN pct_from_low <= 2.0 THEN 'near_low' ELSE 'neutral' END AS position
FROM (SELECT w.*, b.max_7d_high, b.min_7d_low,
             round((b.max_7d_high - w.current_price) / b.max_7d_high * 100, 4) AS pct_from_high,
             round((w.current_price - b.min_7d_low) / b.min_7d_low * 100, 4) AS pct_from_low
      FROM (SELECT {_bucket('5 minutes')}, symbol, avg(price) AS current_price
            FROM valid_trades GROUP BY 1, 2, symbol) w
      JOIN baselines b ON w.symbol = b.symbol
      WHERE b.max_7d_high IS NOT NULL AND b.min_7d_low IS NOT NULL
        AND b.max_7d_high > 0 AND b.min_7d_low > 0) x""")

SQL["sq5_vs_prev_close"] = with_(["valid_trades", "snapshot"], f"""
SELECT window_start, window_end, symbol,
       round(current_price, 4) AS current_price,
       round(prev_close, 4) AS prev_close,
       deviation_pct,
       CASE WHEN deviation_pct > 0 THEN 'up' WHEN deviation_pct < 0 THEN 'down'
            ELSE 'flat' END AS direction
FROM (SELECT w.*, s.prev_close,
             round((w.current_price - s.prev_close) / s.prev_close * 100, 4) AS deviation_pct
      FROM (SELECT {_bucket('1 minute')}, symbol, avg(price) AS current_price
            FROM valid_trades GROUP BY 1, 2, symbol) w
      JOIN snapshot s ON w.symbol = s.symbol
      WHERE s.prev_close IS NOT NULL AND s.prev_close > 0) x""")


# ------------------------------------------------- options and dirty rows

def swap(name: str, *changes: tuple[str, str]) -> str:
    """A registered statement with some of its text replaced."""
    out = SQL[name]
    for old, new in changes:
        if old not in out:
            raise ValueError(f"{name} has no {old!r}")
        out = out.replace(old, new)
    return out


SQL["q07_rounded"] = swap("q07_above_mean", (
    "WHERE rolling_volatility_30d > annual_avg_volatility",
    "WHERE round(rolling_volatility_30d - annual_avg_volatility, 6) > 0"))
SQL["q06_any_year"] = swap("q06_outperformance", ("WHERE years_outperformed >= 5", "WHERE years_outperformed >= 1"))

_GAP = """FROM (SELECT * FROM {} QUALIFY total_volume * count(*) OVER (PARTITION BY ticker)
              >= sum(total_volume) OVER (PARTITION BY ticker)) busy WHERE"""
for _name in ("q02_gaps", "q02_gaps_adjacent"):
    SQL[_name] = swap({"q02_gaps": "q02_period_change"}.get(_name, "q02_adjacent"), ("FROM yearly WHERE", _GAP.format("yearly")))
for _name in ("q10_gaps", "q10_gaps_adjacent"):
    SQL[_name] = swap({"q10_gaps": "q10_streaks"}.get(_name, "q10_adjacent"), (
        "FROM monthly\n    WHERE", _GAP.format("monthly")), ("count(*) >= 6", "count(*) >= 2"))

SQL["q05_compound_total_loss"] = swap(
    "q05_compound",
    ("(exp(sum(ln(1 + monthly_return_pct / 100)) OVER (", """CASE WHEN min(monthly_return_pct) OVER (
                    PARTITION BY ticker, year ORDER BY month) = -100 THEN -100.0
                    ELSE (exp(sum(CASE WHEN monthly_return_pct > -100 THEN ln(1 + monthly_return_pct / 100) END) OVER ("""),
    (")) - 1) * 100\n                    AS cumulative_return_pct", ")) - 1) * 100 END\n                    AS cumulative_return_pct"),
    ("SELECT ticker, year, month, monthly_return_pct FROM monthly\n    WHERE monthly_return_pct IS NOT NULL",
     """SELECT * FROM (SELECT ticker, year, month,
           CASE WHEN month = 6 AND year % 2 = 0 THEN -100.0 ELSE monthly_return_pct END AS monthly_return_pct
           FROM monthly) m
    WHERE monthly_return_pct IS NOT NULL"""))

SQL["bar_dedupe_unknown_exchange"] = swap("bar_dedupe", (
    "FROM clean)", "FROM (SELECT * REPLACE (CASE WHEN exchange_id <> 0 THEN exchange_id END AS exchange_id) FROM clean) c)"),
    ("ORDER BY exchange_id,", "ORDER BY exchange_id NULLS LAST,"))

_DAY = "datediff('day', DATE '1970-01-01', trade_date)"
_DIRTY_BARS = f"""(SELECT * EXCLUDE (k) REPLACE (
        CASE WHEN k = 1 THEN 0.0 ELSE open_price END AS open_price,
        CASE WHEN k = 2 THEN -1.0 WHEN k = 3 THEN low_price / 2 ELSE high_price END AS high_price,
        CASE WHEN k = 4 THEN NULL ELSE low_price END AS low_price,
        CASE WHEN k = 5 THEN 0.0 ELSE close_price END AS close_price,
        CASE WHEN k = 6 THEN NULL WHEN k = 7 THEN -5 ELSE volume END AS volume,
        CASE WHEN k = 8 THEN NULL ELSE trade_date END AS trade_date)
    FROM (SELECT *, {_DAY} % 23 AS k FROM bars) d) dirty"""
SQL["dirty_bar_quality_report"] = swap("bar_quality_report", ("passed\nFROM bars", "passed\nFROM " + _DIRTY_BARS))
SQL["dirty_bar_quality_filter"] = swap("bar_quality_filter", (
    "SELECT * FROM bars\n    WHERE", f"SELECT * FROM {_DIRTY_BARS}\n    WHERE trade_date >= DATE '1993-06-01' AND"))

SQL["dirty_quotes"] = with_(["quotes"], """
SELECT * EXCLUDE (day) FROM (
    SELECT day, CASE WHEN day % 7 <> 1 THEN symbol END AS symbol, exchange,
           CASE WHEN day % 7 = 2 THEN 0.0 WHEN day % 7 <> 3 THEN current_price END AS current_price,
           change, change_pct, high_price, low_price, open_price, prev_close, api_timestamp,
           CASE WHEN day % 7 = 4 THEN '' ELSE quote_date END AS quote_date
    FROM (SELECT *, CAST(substr(quote_date, 9, 2) AS INTEGER) AS day FROM quotes) x) y
WHERE symbol IS NOT NULL AND current_price > 0 AND quote_date <> ''""")

SQL["sq1_dirty_trades"] = swap("sq1_price_volatility", ("SELECT * FROM trades WHERE", """SELECT * FROM (
        SELECT * REPLACE (CASE event_id % 9 WHEN 1 THEN NULL WHEN 2 THEN 0.0 WHEN 3 THEN -price ELSE price END AS price)
        FROM trades) d WHERE"""))
for _name, _of in (("sq2_dirty_snapshot", "sq2_market_sentiment"), ("sq5_dirty_snapshot", "sq5_vs_prev_close")):
    SQL[_name] = swap(_of, ("SELECT * FROM quotes WHERE quote_date = (SELECT max(quote_date) FROM quotes)", """
    SELECT * REPLACE (CASE length(symbol) % 5 WHEN 0 THEN NULL WHEN 1 THEN 0.0 ELSE prev_close END AS prev_close,
                      CASE length(symbol) % 5 WHEN 3 THEN [] ELSE exchange END AS exchange)
    FROM quotes WHERE quote_date = (SELECT max(quote_date) FROM quotes)"""))

SQL["bars_text_ingest"] = with_(["bars"], f"""
SELECT ticker, trade_date AS date,
       CASE WHEN k <> 2 THEN open_price END AS open, high_price AS high, low_price AS low,
       CASE WHEN k <> 5 THEN close_price END AS close, adjusted_close_price AS adjusted_close,
       CASE WHEN k <> 3 THEN volume END AS volume, exchange_name AS source_exchange
FROM (SELECT *, {_DAY} % 17 AS k FROM bars) x
WHERE k <> 1 AND trade_date >= DATE '1994-01-01'""")

SQL["layer_rebuild_shrinks"] = SQL["yearly_performance"] + "\nWHERE year % 2 = 0"
SQL["layer_roundtrip_quotes"] = SQL["daily_quotes"]
SQL["windows_after_restart"] = SQL["sq3_trade_frequency"]
SQL["windows_latest_sq2"] = SQL["sq2_market_sentiment"]
for _name, _of in (("sq1_stream", "sq1_price_volatility"), ("sq2_stream", "sq2_market_sentiment"),
                   ("sq3_stream", "sq3_trade_frequency"), ("sq4_stream", "sq4_price_vs_range"),
                   ("sq5_stream", "sq5_vs_prev_close")):
    SQL[_name] = SQL[_of]


# ------------------------------------------------ windows given once, when closed

def closed(statement: str, delay: str) -> str:
    """Only windows that the watermark has passed when all trades are in."""
    return f"""
SELECT * FROM ({statement}) every_window
WHERE window_end <= (SELECT max(ts) FROM events WHERE value > 0) - INTERVAL '{delay}'"""


SQL["sq2_refreshed"] = with_(["valid_trades", "quotes"], f"""
SELECT window_start, window_end, exchange, rising_count, falling_count,
       round(rising_count / (rising_count + falling_count), 4) AS sentiment_ratio
FROM (SELECT {_bucket('1 minute')}, exchange,
             count(*) FILTER (WHERE price > prev_close) AS rising_count,
             count(*) FILTER (WHERE price < prev_close) AS falling_count
      FROM (SELECT t.event_time, t.price, s.prev_close, unnest(s.exchange) AS exchange
            FROM valid_trades t
            ASOF JOIN (SELECT symbol, exchange, prev_close, CAST(quote_date AS TIMESTAMP) AS since
                       FROM quotes WHERE prev_close > 0) s
              ON t.symbol = s.symbol AND t.event_time >= s.since) met
      GROUP BY 1, 2, exchange) w
WHERE rising_count + falling_count > 0""")

SQL["sq1_closed_stream"] = closed(SQL["sq1_price_volatility"], "5 minutes")
SQL["sq2_closed_stream"] = closed(SQL["sq2_market_sentiment"], "2 minutes")
SQL["sq2_refreshed_stream"] = closed(SQL["sq2_refreshed"], "2 minutes")

SQL["daily_metrics_incremental"] = SQL["daily_metrics"]
SQL["yearly_performance_incremental"] = SQL["yearly_performance"]
SQL["windows_compacted"] = SQL["sq3_trade_frequency"]
SQL["bars_hash_order"] = SQL["bars"]


# ------------------------------------------------------- files, catalog, exports

SQL["bars_from_files"] = with_(["bars"], """
SELECT * REPLACE (CASE WHEN exchange_name <> 'ASIA' THEN exchange_id END AS exchange_id)
FROM bars WHERE exchange_name <> 'AFRICA' AND trade_date >= DATE '1993-01-01'""")
SQL["quotes_from_files"] = with_(["quotes"], "SELECT * FROM quotes WHERE current_price > 0")
SQL["q02_from_catalog"] = swap("q02_period_change", ("FROM yearly WHERE", "FROM yearly WHERE year >= 1995 AND"))


def exported(name: str, order: str) -> str:
    return f"""
SELECT *, row_number() OVER (ORDER BY {order}) AS position, count(*) OVER () AS exported_rows
FROM ({SQL[name]}) report"""


SQL["q02_exported"] = exported("q02_period_change", "ticker, year")
SQL["q05_exported"] = exported("q05_cumulative_rank", "year, month, cumulative_rank, ticker DESC")
