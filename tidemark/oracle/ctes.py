"""Plain-SQL second implementation of the pipeline, for checking results.

Each entry is one common table expression; ``build`` pulls in the ones a query
names. Nothing here is used by the Spark code.
"""

from __future__ import annotations

import re


def r(expr: str, digits: int) -> str:
    """Rounded through the exact decimal digits of the double, which DuckDB's formatter gives."""
    return f"(CAST(format('{{:.{digits}f}}', CAST({expr} AS DOUBLE)) AS DOUBLE) + 0.0)"


def clamp(expr: str, low: float = 0.0, high: float = 100.0) -> str:
    return f"(CASE WHEN ({expr}) IS NOT NULL THEN greatest({low}::DOUBLE, least({high}::DOUBLE, {expr})) END)"


def mean(expr: str, cond: str = "true") -> str:
    exact = f"CAST({expr} AS DECIMAL(28,8))"
    return f"(CAST(sum({exact}) FILTER (WHERE {cond}) AS DOUBLE) / count({expr}) FILTER (WHERE {cond}))"


def piecewise(x: str, knots: list[tuple[float, float]]) -> str:
    out = f"CASE WHEN {x} <= {knots[0][0]} THEN {knots[0][1]}::DOUBLE"
    for (x0, y0), (x1, y1) in zip(knots, knots[1:]):
        out += f" WHEN {x} <= {x1} THEN {y0}::DOUBLE + ({x} - {x0}::DOUBLE) / {x1 - x0}::DOUBLE * {y1 - y0}::DOUBLE"
    return out + f" WHEN {x} IS NOT NULL THEN {knots[-1][1]}::DOUBLE END"


def profit_factor(value: str, cond: str = "true") -> str:
    exact = f"CAST({value} AS DECIMAL(28,8))"
    gain = f"coalesce(CAST(sum({exact}) FILTER (WHERE {cond} AND {value} > 0) AS DOUBLE), 0.0)"
    loss = f"abs(CAST(sum({exact}) FILTER (WHERE {cond} AND {value} < 0) AS DOUBLE))"
    return f"CASE WHEN {loss} > 0 THEN {r(f'{gain} / {loss}', 8)} END"


TICK = ("CASE WHEN {p} <= 0 THEN NULL WHEN {p} < 200 THEN 1.0::DOUBLE WHEN {p} < 500 THEN 2.0::DOUBLE "
        "WHEN {p} < 2000 THEN 5.0::DOUBLE WHEN {p} < 5000 THEN 10.0::DOUBLE WHEN {p} IS NOT NULL THEN 25.0::DOUBLE END")

CTES: dict[str, str] = {}

CTES["instruments"] = """
SELECT s_suppkey AS instrument_id, s_name AS symbol, r_name AS sector_code, s_nationkey AS nation_key
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

CTES["daily_totals"] = """
SELECT l_suppkey AS instrument_id, CAST(l_shipdate AS DATE) AS trading_date,
       CAST(sum(CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) % 401) - 199 * count(*) AS BIGINT) AS step,
       sum(l_quantity) AS volume,
       CAST(sum(CAST(round_even(l_extendedprice * 100, 0) AS BIGINT)) AS BIGINT) AS value_cents, max(l_linenumber) AS arrival_days
FROM lineitem GROUP BY 1, 2"""

CTES["walk_close"] = f"""
SELECT *, {r("1000.0 * exp(CAST(sum(step) OVER (PARTITION BY instrument_id ORDER BY trading_date) AS DOUBLE) / 10000.0)", 2)} AS close
FROM daily_totals"""

CTES["walk_open"] = """
SELECT *, coalesce(lag(close) OVER (PARTITION BY instrument_id ORDER BY trading_date), 1000.0::DOUBLE) AS open
FROM walk_close"""

CTES["bars_walk"] = """
SELECT instrument_id, trading_date, open,
       (hi + CAST(floor(CAST(hi * (CAST(volume AS BIGINT) % 5) AS DOUBLE) / 5e2) AS BIGINT)) / 1e2 AS high,
       (lo - CAST(floor(CAST(lo * (CAST(volume AS BIGINT) % 7) AS DOUBLE) / 7e2) AS BIGINT)) / 1e2 AS low,
       close, volume, value_cents / 1e2 AS value, trading_date + arrival_days AS ingested_at
FROM (SELECT *, CAST(round_even(greatest(open, close) * 100, 0) AS BIGINT) AS hi,
             CAST(round_even(least(open, close) * 100, 0) AS BIGINT) AS lo FROM walk_open)"""

CTES["bars_raw"] = f"""
SELECT l_suppkey AS instrument_id, CAST(l_shipdate AS DATE) AS trading_date,
       arg_min({r("l_extendedprice / l_quantity", 4)}, (l_orderkey, l_linenumber, l_partkey, l_quantity)) AS open,
       max({r("l_extendedprice / l_quantity", 4)}) AS high, min({r("l_extendedprice / l_quantity", 4)}) AS low,
       arg_max({r("l_extendedprice / l_quantity", 4)}, (l_orderkey, l_linenumber, l_partkey, l_quantity)) AS close,
       sum(l_quantity) AS volume
FROM lineitem GROUP BY 1, 2"""

CTES["bars"] = """
SELECT *, lag(close) OVER (PARTITION BY instrument_id ORDER BY trading_date) AS previous_close
FROM bars_walk
WHERE isodow(trading_date) < 6 AND open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low
  AND high >= open AND high >= close AND low <= open AND low <= close AND NOT volume < 0"""


def _mean(c: str) -> str:
    return r(f"CAST(sum(CAST(round_even({c} * 100, 0) AS BIGINT)) AS DOUBLE) / count(*) / 1e2", 6) + f" AS {c}"


CTES["index_bars"] = f"""
SELECT -1::BIGINT AS instrument_id, * FROM (
  SELECT trading_date, {_mean("open")}, {_mean("high")}, {_mean("low")}, {_mean("close")}, sum(volume) AS volume, max(ingested_at) AS ingested_at
  FROM bars GROUP BY 1)
WHERE isodow(trading_date) < 6 AND least(open, high, low, close) > 0
  AND high >= greatest(open, high, low, close) AND low <= least(open, high, low, close) AND volume >= 0"""


def _features(name: str, bars: str) -> None:
    CTES[f"{name}_series"] = f"""
SELECT *, row_number() OVER w AS pos, max(ingested_at) OVER w AS updated_at, close - lag(close) OVER w AS change,
       greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr
FROM {bars} WINDOW w AS (PARTITION BY instrument_id ORDER BY trading_date)"""

    def step(out: str, alpha: str, x: str) -> str:
        return f"({alpha}) * {x} + (1.0 - {alpha}) * e.{out}"

    w14 = "(1.0 / 14.0)::DOUBLE"
    gain, loss = "greatest(s.change, 0.0::DOUBLE)", "greatest(-s.change, 0.0::DOUBLE)"
    CTES[f"{name}_smooth"] = f"""
SELECT instrument_id, pos, close AS e20, close AS e50, close AS e100, close AS e200,
       NULL::DOUBLE AS ag, NULL::DOUBLE AS al, tr AS atr
FROM {name}_series WHERE pos = 1
UNION ALL
SELECT s.instrument_id, s.pos, {step("e20", "(2.0 / 21.0)::DOUBLE", "s.close")}, {step("e50", "(2.0 / 51.0)::DOUBLE", "s.close")},
       {step("e100", "(2.0 / 101.0)::DOUBLE", "s.close")}, {step("e200", "(2.0 / 201.0)::DOUBLE", "s.close")},
       CASE WHEN e.ag IS NULL THEN {gain} ELSE {step("ag", w14, gain)} END,
       CASE WHEN e.al IS NULL THEN {loss} ELSE {step("al", w14, loss)} END, {step("atr", w14, "s.tr")}
FROM {name}_smooth e JOIN {name}_series s ON s.instrument_id = e.instrument_id AND s.pos = e.pos + 1"""
    z = ("CASE WHEN count(volume) OVER w20 >= 20 AND stddev_pop(volume) OVER w20 > 0 "
         "THEN (volume - avg(volume) OVER w20) / stddev_pop(volume) OVER w20 END")
    volume = r(z, 6) if name == "stock" else "NULL::DOUBLE"

    def ret(n: int) -> str:
        return r(f"close / lag(close, {n}) OVER w - 1.0", 8) + f" AS return_{n}d"

    CTES[name] = f"""
SELECT b.*, {", ".join(f"CASE WHEN pos >= {n} THEN {r(f'e{n}', 6)} END AS ema{n}" for n in (20, 50, 100, 200))},
       {r('''CASE WHEN pos < 15 THEN NULL WHEN al = 0 AND ag > 0 THEN 100.0::DOUBLE WHEN al = 0 AND ag = 0 THEN 50.0::DOUBLE
              ELSE 100.0 - 100.0 / (1.0 + ag / al) END''', 6)} AS rsi14,
       CASE WHEN pos >= 14 THEN {r('atr', 6)} END AS atr14
FROM (SELECT *, {ret(1)}, {ret(5)}, {ret(20)}, {ret(60)}, {volume} AS volume_z20,
             CASE WHEN n20 >= 20 THEN close > h20 END AS breakout_flag,
             CASE WHEN n20 >= 20 THEN high > h20 AND close <= h20 END AS failed_breakout_flag
      FROM (SELECT *, max(high) OVER p20 AS h20, count(high) OVER p20 AS n20 FROM {name}_series
            WINDOW p20 AS (PARTITION BY instrument_id ORDER BY trading_date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
      WINDOW w AS (PARTITION BY instrument_id ORDER BY trading_date),
             w20 AS (PARTITION BY instrument_id ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) b
JOIN (SELECT * FROM {name}_smooth) e USING (instrument_id, pos)"""


_features("stock", "bars")
_features("idx", "index_bars")

CTES["features"] = f"""
SELECT f.* REPLACE (greatest(f.updated_at, i.updated_at) AS updated_at), {r("f.return_20d - i.return_20d", 8)} AS rs_ihsg_20d, symbol, sector_code,
       count(f.close) OVER p20 AS prior_20_count, max(f.close) OVER p20 AS prior_20_high, min(f.close) OVER p20 AS prior_20_low,
       count(f.close) OVER p252 AS prior_252_count, max(f.close) OVER p252 AS prior_252_high, min(f.close) OVER p252 AS prior_252_low
FROM stock f LEFT JOIN (SELECT trading_date, return_20d, updated_at FROM idx) i ON i.trading_date = f.trading_date
JOIN instruments n ON n.instrument_id = f.instrument_id
WINDOW p20 AS (PARTITION BY f.instrument_id ORDER BY f.trading_date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING),
       p252 AS (PARTITION BY f.instrument_id ORDER BY f.trading_date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)"""

CTES["regime_parts"] = f"""
SELECT *, CASE WHEN return_20d IS NOT NULL AND return_60d IS NOT NULL AND ema20 IS NOT NULL AND ema50 IS NOT NULL
                AND ema200 IS NOT NULL AND rsi14 IS NOT NULL AND atr14 IS NOT NULL AND close IS NOT NULL THEN {clamp('''
   50.0::DOUBLE + CASE WHEN close > ema20 THEN 5 ELSE -5 END + CASE WHEN close > ema50 THEN 7 ELSE -7 END
   + CASE WHEN close > ema200 THEN 10 ELSE -10 END + CASE WHEN ema20 > ema50 THEN 7 ELSE -7 END
   + CASE WHEN ema50 > ema200 THEN 8 ELSE -8 END + CASE WHEN return_20d > 0 THEN 5 ELSE -5 END
   + CASE WHEN return_60d > 0 THEN 5 ELSE -5 END + CASE WHEN rsi14 >= 55 THEN 3 WHEN rsi14 <= 45 THEN -3 ELSE 0 END''')} END AS trend,
  CASE WHEN share IS NOT NULL AND len(bag) >= 60 THEN
    CAST(len(list_filter(bag, lambda x: x <= share)) AS DOUBLE) / len(bag) END AS pctl,
  close / CASE WHEN year_rows >= 60 THEN year_top END - 1.0 AS drawdown
FROM (SELECT *, list(share) FILTER (WHERE share IS NOT NULL) OVER y AS bag, max(close) OVER y AS year_top, count(close) OVER y AS year_rows
      FROM (SELECT *, atr14 / close AS share FROM idx)
      WINDOW y AS (ORDER BY trading_date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW))"""

CTES["regimes"] = f"""
SELECT instrument_id, trading_date, close, {r("trend", 4)} AS trend_score, {r("vol", 4)} AS volatility_score,
       {r("comp", 4)} AS composite_score,
       CASE WHEN comp >= 60 THEN 'BULLISH' WHEN comp <= 40 THEN 'BEARISH' ELSE 'NEUTRAL' END AS direction,
       CASE WHEN comp >= 60 THEN 'BULL' WHEN comp <= 40 THEN 'BEAR' ELSE 'SIDEWAYS' END AS regime,
       {r(clamp("0.25::DOUBLE + abs(comp - 50.0) / 50.0 * 0.30", 0.25, 0.55), 4)} AS confidence, updated_at
FROM (SELECT *, 0.75 * trend + 0.25 * vol AS comp
      FROM (SELECT *, 0.70 * (100.0 - pctl * 100.0) + 0.30 * {clamp("100.0 + drawdown * 333.333333")} AS vol FROM regime_parts))
WHERE comp IS NOT NULL"""


def _direction(groups: str) -> str:
    def above(c: str) -> str:
        return f"100.0::DOUBLE * count(*) FILTER (WHERE close > {c}) / count(*) AS pct_above_{c}"

    return f"""{groups}, count(*) AS eligible_count, count(*) FILTER (WHERE close > previous_close) AS advances,
       count(*) FILTER (WHERE close < previous_close) AS declines, count(*) FILTER (WHERE close = previous_close) AS unchanged,
       {above("ema20")}, {above("ema50")}, {above("ema200")},
       coalesce(sum(volume) FILTER (WHERE close > previous_close), 0.0::DOUBLE) AS up_volume,
       coalesce(sum(volume) FILTER (WHERE close < previous_close), 0.0::DOUBLE) AS down_volume"""


def _bal(p: str, n: str, total: str) -> str:
    return f"(CASE WHEN {total} <= 0 THEN 0.0::DOUBLE ELSE CAST({p} - {n} AS DOUBLE) / ({total}) END)"


CTES["breadth_daily"] = f"""
SELECT {_direction("trading_date")},
       count(*) FILTER (WHERE prior_20_count = 20 AND close > prior_20_high) AS new_high_20d,
       count(*) FILTER (WHERE prior_20_count = 20 AND close < prior_20_low) AS new_low_20d,
       count(*) FILTER (WHERE prior_252_count = 252 AND close > prior_252_high) AS new_high_52w,
       count(*) FILTER (WHERE prior_252_count = 252 AND close < prior_252_low) AS new_low_52w
FROM features WHERE ema200 IS NOT NULL GROUP BY trading_date"""


def _tilt(c: str) -> str:
    return clamp(f"({c} - 50.0) / 50.0", -1.0, 1.0)


_ADU = "(advances + declines + unchanged)"
CTES["breadth"] = f"""
SELECT trading_date, 'ALL_current_20011104_EMA200_BREADTH_V1' AS universe_code, eligible_count, advances, declines, unchanged,
       new_high_20d, new_low_20d, new_high_52w, new_low_52w,
       {r("pct_above_ema20", 4)} AS pct_above_ema20, {r("pct_above_ema50", 4)} AS pct_above_ema50,
       {r("pct_above_ema200", 4)} AS pct_above_ema200, up_volume, down_volume,
       {r(clamp(f'''(0.40 * (({_tilt("pct_above_ema20")} + {_tilt("pct_above_ema50")} + {_tilt("pct_above_ema200")}) / 3.0)
         + 0.25 * {_bal("advances", "declines", _ADU)} + 0.15 * {_bal("new_high_52w", "new_low_52w", _ADU)}
         + 0.10 * {_bal("new_high_20d", "new_low_20d", _ADU)}
         + 0.10 * {_bal("up_volume", "down_volume", "(up_volume + down_volume)")} + 1.0) * 50.0'''), 4)} AS breadth_score
FROM breadth_daily"""

CTES["sector_daily"] = f"""
SELECT s.* REPLACE (greatest(s.updated_at, i.updated_at) AS updated_at), i.return_20d AS index_return_20d, i.return_60d AS index_return_60d
FROM (SELECT {_direction("trading_date, sector_code")}, max(updated_at) AS updated_at, {mean("return_20d")} AS sector_return_20d, {mean("return_60d")} AS sector_return_60d
      FROM features WHERE ema200 IS NOT NULL GROUP BY trading_date, sector_code) s
JOIN (SELECT trading_date, return_20d, return_60d, updated_at FROM idx WHERE return_20d IS NOT NULL AND return_60d IS NOT NULL) i
  ON i.trading_date = s.trading_date"""

CTES["sector_scored"] = f"""
SELECT *, {r(clamp("0.45 * relative_strength_score + 0.35 * breadth_score + 0.20 * volume_score"), 4)} AS score
FROM (SELECT *,
  {r(clamp("50.0 + 200.0 * (0.65 * (sector_return_20d - index_return_20d) + 0.35 * (sector_return_60d - index_return_60d))"), 4)} AS relative_strength_score,
  {r(clamp(f'''0.70 * ((pct_above_ema20 + pct_above_ema50 + pct_above_ema200) / 3.0)
      + 0.30 * (50.0 + 50.0 * {_bal("advances", "declines", _ADU)})'''), 4)} AS breadth_score,
  {r(clamp(f'50.0 + 50.0 * {_bal("up_volume", "down_volume", "(up_volume + down_volume)")}'), 4)} AS volume_score
  FROM sector_daily)"""

CTES["rotation"] = f"""
SELECT trading_date, sector_code, eligible_count,
       CASE WHEN ch IS NULL THEN CASE WHEN score >= 60 THEN 'LEADING' WHEN score <= 40 THEN 'LAGGING' ELSE 'NEUTRAL' END
            WHEN score >= 60 AND ch >= 0 THEN 'LEADING' WHEN score <= 40 AND ch <= 0 THEN 'LAGGING'
            WHEN ch >= 5 THEN 'IMPROVING' WHEN ch <= -5 THEN 'WEAKENING' ELSE 'NEUTRAL' END AS rotation_label,
       score, relative_strength_score, breadth_score, volume_score, ch AS score_change_20d,
       'sector_rotation_v1_current_20011104' AS model_version, updated_at
FROM (SELECT *, {r("score - lag(score, 20) OVER (PARTITION BY sector_code ORDER BY trading_date)", 4)} AS ch FROM sector_scored)"""

CTES["snapshots"] = f"""
SELECT *, security_number - foreign_shares AS local_shares,
       {r("CAST(foreign_shares AS DOUBLE) / security_number * 100.0", 8)} AS foreign_ownership_pct
FROM (SELECT instrument_id, as_of_date,
             max(ingested_at) OVER w AS updated_at, CAST(sum(bought) OVER w AS BIGINT) AS security_number, CAST(sum(bought_foreign) OVER w AS BIGINT) AS foreign_shares
      FROM (SELECT l_suppkey AS instrument_id, last_day(l_shipdate) AS as_of_date, last_day(l_shipdate) + max(l_linenumber) AS ingested_at, CAST(sum(l_quantity) AS BIGINT) AS bought,
                   CAST(coalesce(sum(l_quantity) FILTER (WHERE c_nationkey <> nation_key), 0) AS BIGINT) AS bought_foreign
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN instruments ON instrument_id = l_suppkey GROUP BY 1, 2)
      WINDOW w AS (PARTITION BY instrument_id ORDER BY as_of_date))"""

CTES["pairs"] = """
SELECT * FROM (
  SELECT *, lag(as_of_date) OVER w AS previous_as_of_date, lag(foreign_ownership_pct) OVER w AS previous_foreign_ownership_pct,
         lag(foreign_shares) OVER w AS previous_foreign_shares, lag(security_number) OVER w AS previous_security_number
  FROM snapshots WINDOW w AS (PARTITION BY instrument_id ORDER BY as_of_date))
WHERE previous_as_of_date IS NOT NULL"""

CTES["trends"] = f"""
SELECT instrument_id, as_of_date, previous_as_of_date, foreign_ownership_pct, previous_foreign_ownership_pct,
       {r("d", 8)} AS delta_foreign_ownership_pp, foreign_shares, previous_foreign_shares,
       foreign_shares - previous_foreign_shares AS delta_foreign_shares, security_number, previous_security_number,
       {r("s", 8)} AS delta_security_number_pct,
       {r("CAST(foreign_shares - previous_foreign_shares AS DOUBLE) / previous_security_number * 100.0", 8)} AS normalized_foreign_share_change_pct,
       CAST(days AS INTEGER) AS days_between_snapshots,
       CASE WHEN d >= 0.10::DOUBLE THEN 'ACCUMULATING' WHEN d <= -0.10::DOUBLE THEN 'DISTRIBUTING' ELSE 'STABLE' END AS trend_label,
       {r(clamp(clamp("abs(d) / 0.50 * 100.0") + " * CASE WHEN abs(s) >= 1.0 THEN 0.5 ELSE 1.0 END * CASE WHEN days > 45 THEN 0.75 ELSE 1.0 END"), 4)} AS signal_strength,
       abs(s) >= 1.0 AS corporate_action_risk, days > 45 AS snapshot_gap_flag, 'ownership_trend_v1' AS model_version, updated_at
FROM (SELECT *, foreign_ownership_pct - previous_foreign_ownership_pct AS d,
             CAST(security_number - previous_security_number AS DOUBLE) / previous_security_number * 100.0 AS s,
             as_of_date - previous_as_of_date AS days FROM pairs)"""

CTES["sector_owned"] = f"""
SELECT as_of_date, sector_code, max(updated_at) AS updated_at, count(*) AS eligible_count, max(n) AS current_universe_count,
       count(*) FILTER (WHERE clean) AS clean_count,
       count(*) FILTER (WHERE clean AND trend_label = 'ACCUMULATING') AS accumulating_count,
       count(*) FILTER (WHERE clean AND trend_label = 'STABLE') AS stable_count,
       count(*) FILTER (WHERE clean AND trend_label = 'DISTRIBUTING') AS distributing_count,
       count(*) FILTER (WHERE corporate_action_risk) AS corporate_action_risk_count,
       count(*) FILTER (WHERE snapshot_gap_flag) AS snapshot_gap_count,
       count(*) FILTER (WHERE abs(delta_foreign_ownership_pp) >= 5.0) AS extreme_move_count,
       {mean("delta_foreign_ownership_pp")} AS avg_delta,
       {mean("least(0.5::DOUBLE, greatest(-0.5::DOUBLE, delta_foreign_ownership_pp))", "clean")} AS avg_clean
FROM (SELECT *, NOT corporate_action_risk AND NOT snapshot_gap_flag AS clean FROM trends) t
JOIN instruments USING (instrument_id)
JOIN (SELECT sector_code, count(*) AS n FROM instruments GROUP BY 1) USING (sector_code)
GROUP BY 1, 2"""

CTES["sector_ownership"] = f"""
SELECT * EXCLUDE (avg_delta, avg_clean, raw), {r("avg_delta", 8)} AS avg_delta_foreign_ownership_pp,
       {r("coalesce(avg_clean, 0.0)", 8)} AS avg_clean_clipped_delta_pp,
       CASE WHEN score >= 65 THEN 'STRONG_ACCUMULATION' WHEN score >= 55 THEN 'ACCUMULATION' WHEN score <= 35 THEN 'STRONG_DISTRIBUTION'
            WHEN score <= 45 THEN 'DISTRIBUTION' ELSE 'NEUTRAL' END AS signal_label,
       coverage_pct < 80 AS low_coverage_flag, 'sector_ownership_v1_current_20011104' AS model_version
FROM (SELECT *, {r(clamp("CASE WHEN coverage_pct < 80 THEN 50.0 + (raw - 50.0) * 0.50 ELSE raw END"), 6)} AS score
      FROM (SELECT *, 0.65 * breadth_score + 0.35 * intensity_score AS raw
            FROM (SELECT *, {r(clamp("CAST(eligible_count AS DOUBLE) / current_universe_count * 100.0"), 6)} AS coverage_pct,
                         {r(clamp(f'50.0 + 50.0 * {_bal("accumulating_count", "distributing_count", "clean_count")}'), 6)} AS breadth_score,
                         {r(clamp("50.0 + coalesce(avg_clean, 0.0) / 0.25 * 50.0"), 6)} AS intensity_score
                  FROM sector_owned)))"""

_DIR = "CASE WHEN {s} >= 55 THEN 1 WHEN {s} <= 45 THEN -1 ELSE 0 END"
CTES["integrated"] = f"""
SELECT trading_date, sector_code, technical_score, technical_rotation_label, ownership_as_of_date, ownership_score,
       ownership_signal_label, CAST(age AS INTEGER) AS ownership_age_days, ownership_low_coverage_flag, stale AS ownership_stale_flag,
       CASE WHEN stale THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END AS technical_weight,
       CASE WHEN stale THEN 0.0::DOUBLE ELSE 0.2::DOUBLE END AS ownership_weight, integrated_score,
       CASE WHEN integrated_score >= 65 THEN 'STRONG_BULLISH' WHEN integrated_score >= 55 THEN 'BULLISH'
            WHEN integrated_score <= 35 THEN 'STRONG_BEARISH' WHEN integrated_score <= 45 THEN 'BEARISH' ELSE 'NEUTRAL' END AS integrated_label,
       CASE WHEN stale THEN 'OWNERSHIP_STALE' WHEN t = 1 AND o = 1 THEN 'CONFIRMED_BULLISH' WHEN t = -1 AND o = -1 THEN 'CONFIRMED_BEARISH'
            WHEN t = 0 AND o = 0 THEN 'NEUTRAL' WHEN o = 0 THEN 'TECHNICAL_LEAD' WHEN t = 0 THEN 'OWNERSHIP_LEAD' ELSE 'DIVERGENCE' END AS alignment_label,
       'integrated_sector_v1_current_20011104' AS model_version, updated_at
FROM (SELECT *, {_DIR.format(s="technical_score")} AS t, {_DIR.format(s="ownership_score")} AS o,
             {r(clamp("technical_score * CASE WHEN stale THEN 1.0 ELSE 0.8 END::DOUBLE + ownership_score * CASE WHEN stale THEN 0.0 ELSE 0.2 END::DOUBLE"), 6)} AS integrated_score
      FROM (SELECT s.trading_date, s.sector_code, greatest(s.updated_at, o.updated_at) AS updated_at, {r("s.score", 6)} AS technical_score, s.rotation_label AS technical_rotation_label,
                   o.as_of_date AS ownership_as_of_date, {r("o.score", 6)} AS ownership_score, o.signal_label AS ownership_signal_label,
                   o.low_coverage_flag AS ownership_low_coverage_flag, s.trading_date - o.as_of_date AS age,
                   s.trading_date - o.as_of_date > 45 AS stale
            FROM rotation s ASOF JOIN sector_ownership o ON s.sector_code = o.sector_code AND s.trading_date >= o.as_of_date))"""

CTES["turnover"] = """
SELECT instrument_id, trading_date, avg(close * volume) OVER (PARTITION BY instrument_id ORDER BY trading_date
       ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS avg_turnover_20d,
       max(ingested_at) OVER (PARTITION BY instrument_id ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS turnover_updated_at
FROM bars WHERE close > 0 AND trading_date BETWEEN (SELECT min(trading_date) - 45 FROM integrated) AND (SELECT max(trading_date) FROM integrated)"""

CTES["screener_inputs"] = """
SELECT *, percent_rank() OVER (PARTITION BY trading_date ORDER BY avg_turnover_20d) AS liquidity_percentile
FROM (SELECT f.instrument_id, f.symbol, f.sector_code, f.trading_date, f.close, f.return_20d, f.ema20, f.ema50, f.ema200, f.rsi14, f.atr14,
             f.volume_z20, f.rs_ihsg_20d, f.breakout_flag, f.failed_breakout_flag, p.avg_turnover_20d,
             s.integrated_score AS sector_input_score, s.ownership_stale_flag AS sector_ownership_stale_flag,
             m.regime AS market_regime, m.confidence AS market_confidence,
             greatest(f.updated_at, p.turnover_updated_at, s.updated_at, m.updated_at, coalesce(o.updated_at, DATE '1970-01-01')) AS input_updated_at,
             o.as_of_date AS ownership_as_of_date, o.trend_label AS ownership_trend_label, o.signal_strength AS ownership_signal_strength
      FROM features f JOIN turnover p ON p.instrument_id = f.instrument_id AND p.trading_date = f.trading_date
      JOIN integrated s ON s.trading_date = f.trading_date AND s.sector_code = f.sector_code
      JOIN regimes m ON m.trading_date = f.trading_date
      ASOF LEFT JOIN trends o ON o.instrument_id = f.instrument_id AND f.trading_date >= o.as_of_date
      WHERE f.return_20d IS NOT NULL AND f.ema20 IS NOT NULL AND f.ema50 IS NOT NULL AND f.ema200 IS NOT NULL AND f.rsi14 IS NOT NULL
        AND f.atr14 IS NOT NULL AND f.rs_ihsg_20d IS NOT NULL AND f.breakout_flag IS NOT NULL AND f.failed_breakout_flag IS NOT NULL
        AND p.avg_turnover_20d IS NOT NULL)"""

_MOM = [(30.0, 20.0), (40.0, 50.0), (50.0, 70.0), (65.0, 100.0), (75.0, 80.0), (85.0, 50.0), (100.0, 20.0)]
_RISK = [(1.0, 95.0), (2.5, 85.0), (4.0, 70.0), (6.0, 50.0), (8.0, 30.0), (12.0, 10.0)]
CTES["screener_parts"] = f"""
SELECT *, coalesce(CAST(ownership_age_days > 45 AS BOOLEAN), false) AS ownership_stale_flag,
  {r(clamp('''50.0 + (CASE market_regime WHEN 'BULL' THEN 80.0 WHEN 'SIDEWAYS' THEN 50.0 WHEN 'BEAR' THEN 30.0 END::DOUBLE - 50.0)
     * coalesce(market_confidence, 0.0)'''), 4)} AS market_score,
  (CASE WHEN close > ema20 THEN 25 ELSE 0 END + CASE WHEN ema20 > ema50 THEN 25 ELSE 0 END + CASE WHEN ema50 > ema200 THEN 25 ELSE 0 END
   + CASE WHEN return_20d > 0 THEN 25 ELSE 0 END)::DOUBLE AS trend_score,
  {r(clamp(piecewise("rsi14", _MOM)), 4)} AS momentum_score,
  {r(clamp("50.0 + rs_ihsg_20d / 0.20 * 50.0"), 4)} AS relative_strength_score,
  coalesce({r(clamp("50.0 + volume_z20 * 15.0"), 4)}, 50.0::DOUBLE) AS volume_score,
  CASE WHEN failed_breakout_flag THEN 0.0::DOUBLE WHEN breakout_flag THEN 100.0::DOUBLE ELSE 50.0::DOUBLE END AS breakout_score,
  {r("liquidity_percentile * 100.0", 4)} AS liquidity_score,
  CASE WHEN ownership_as_of_date IS NULL OR ownership_age_days > 45 THEN 50.0::DOUBLE ELSE {r(clamp('''50.0 + ownership_signal_strength * 0.5 *
     CASE ownership_trend_label WHEN 'ACCUMULATING' THEN 1 WHEN 'DISTRIBUTING' THEN -1 ELSE 0 END'''), 4)} END AS ownership_score,
  {r(clamp(piecewise("atr_raw", _RISK)), 4)} AS risk_score, {r("atr_raw", 4)} AS atr_pct
FROM (SELECT *, atr14 / close * 100.0 AS atr_raw, CAST(trading_date - ownership_as_of_date AS INTEGER) AS ownership_age_days FROM screener_inputs)"""

CTES["screener_scored"] = f"""
SELECT *, {r(clamp('''0.15 * market_score + 0.20 * sector_input_score + 0.35 * technical_score + 0.10 * liquidity_score
    + 0.10 * ownership_score + 0.10 * risk_score'''), 4)} AS overall_score,
  100.0::DOUBLE - CASE WHEN ownership_as_of_date IS NULL THEN 10 WHEN ownership_stale_flag THEN 5 ELSE 0 END
    - CASE WHEN sector_ownership_stale_flag THEN 5 ELSE 0 END - CASE WHEN volume_z20 IS NULL THEN 5 ELSE 0 END - 5 AS data_completeness
FROM (SELECT *, {r(clamp('''0.35 * trend_score + 0.20 * momentum_score + 0.30 * relative_strength_score + 0.10 * volume_score
    + 0.05 * breakout_score'''), 4)} AS technical_score FROM screener_parts)"""

CTES["screened"] = f"""
SELECT * EXCLUDE (sector_input_score), {r(clamp("sector_input_score"), 4)} AS sector_score, input_updated_at AS input_updated_on,
  row_number() OVER (PARTITION BY trading_date ORDER BY overall_score DESC, technical_score DESC, symbol) AS universe_rank,
  row_number() OVER (PARTITION BY trading_date, sector_code ORDER BY overall_score DESC, technical_score DESC, symbol) AS sector_rank,
  'stock_screener_v1_current_20011104' AS model_version,
  CASE WHEN failed_breakout_flag OR risk_score < 20 OR liquidity_score < 5 OR sector_input_score < 30 OR market_score < 25 THEN 'AVOID'
       WHEN overall_score >= 65 AND market_score >= 40 AND sector_input_score >= 55 AND technical_score >= 65 AND liquidity_score >= 25
        AND risk_score >= 35 AND (breakout_flag OR (rs_ihsg_20d >= 0.03 AND rsi14 BETWEEN 50 AND 75 AND close > ema20)) THEN 'BUY_SETUP'
       WHEN overall_score >= 55 AND market_score >= 35 AND sector_input_score >= 45 AND technical_score >= 55 AND liquidity_score >= 20
        AND risk_score >= 30 THEN 'WATCH'
       WHEN overall_score >= 45 AND technical_score >= 40 THEN 'WAIT' ELSE 'AVOID' END AS status
FROM screener_scored"""

CTES["structure"] = """
SELECT instrument_id, trading_date, min(low) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS prior_low_10d,
       max(high) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS prior_high_20d,
       max(high) OVER (w ROWS BETWEEN 55 PRECEDING AND 1 PRECEDING) AS prior_high_55d,
       count(low) OVER (w ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS prior_count_10d,
       max(ingested_at) OVER (w ROWS BETWEEN 55 PRECEDING AND CURRENT ROW) AS price_updated_at
FROM bars WHERE trading_date BETWEEN (SELECT min(trading_date) - 90 FROM screened) AND (SELECT max(trading_date) FROM screened)
WINDOW w AS (PARTITION BY instrument_id ORDER BY trading_date)"""

CTES["setup_zone"] = f"""
SELECT *, (prior_count_10d IS NULL OR prior_low_10d IS NULL OR prior_low_10d <= 0 OR prior_count_10d < 10) AS early,
       {r("lo", 6)} AS entry_low, {r("greatest(hi, lo)", 6)} AS entry_high, {r("(lo + greatest(hi, lo)) / 2.0", 6)} AS entry_mid,
       {r("prior_low_10d", 6)} AS invalidation_price, {r("prior_low_10d - 0.25 * atr14", 6)} AS stop_price,
       {r("least(CASE WHEN prior_high_20d > close THEN prior_high_20d END, CASE WHEN prior_high_55d > close THEN prior_high_55d END)", 6)} AS nearest_resistance
FROM (SELECT *, greatest(ema20, close - CASE WHEN ext > 2.0 THEN 1.0 ELSE 0.5 END::DOUBLE * atr14) AS lo,
             CASE WHEN ext > 2.0 THEN close - 0.5 * atr14 ELSE close END AS hi
      FROM (SELECT s.* REPLACE (greatest(s.input_updated_at, coalesce(f.updated_at, DATE '1970-01-01'), coalesce(p.price_updated_at, DATE '1970-01-01')) AS input_updated_at),
                   p.* EXCLUDE (instrument_id, trading_date, price_updated_at), (s.close - s.ema20) / s.atr14 AS ext
            FROM screened s LEFT JOIN structure p ON p.instrument_id = s.instrument_id AND p.trading_date = s.trading_date
            LEFT JOIN (SELECT instrument_id, trading_date, updated_at FROM features) f ON f.instrument_id = s.instrument_id AND f.trading_date = s.trading_date
            WHERE status = 'BUY_SETUP'))"""

CTES["setup_risk"] = f"""
SELECT *, risk_per_share / entry_mid AS rp, risk_per_share / atr14 AS sr,
       CASE WHEN risk_per_share IS NOT NULL THEN {r("least(entry_mid + 2.0 * risk_per_share, nearest_resistance)", 6)} END AS target_primary,
       CASE WHEN risk_per_share IS NOT NULL THEN CAST(greatest(0, least(floor(1000000.0::DOUBLE / (risk_per_share * 100)), floor(100000000.0::DOUBLE / (entry_mid * 100)))) AS BIGINT) END AS lots
FROM (SELECT *, CASE WHEN entry_mid - stop_price > 0 THEN {r("entry_mid - stop_price", 6)} END AS risk_per_share FROM setup_zone)"""

CTES["setup_gates"] = """
SELECT *, list_filter([
  CASE WHEN close <= ema20 THEN 'CLOSE_NOT_ABOVE_EMA20' END, CASE WHEN stop_price <= 0 THEN 'INVALID_STOP_PRICE' END,
  CASE WHEN stop_price >= entry_low THEN 'STOP_NOT_BELOW_ENTRY_ZONE' END,
  CASE WHEN risk_per_share IS NULL THEN 'NON_POSITIVE_RISK_PER_SHARE' END,
  CASE WHEN sr > 2.5 THEN 'STRUCTURE_STOP_TOO_WIDE_ATR' END, CASE WHEN rp > 0.10::DOUBLE THEN 'STRUCTURE_STOP_TOO_WIDE_PCT' END,
  CASE WHEN target_primary <= entry_high THEN 'TARGET_NOT_ABOVE_ENTRY_ZONE' END,
  CASE WHEN rr < 1.5 THEN 'INSUFFICIENT_REWARD_RISK' END, CASE WHEN lots < 1 THEN 'REFERENCE_CAPITAL_CANNOT_SIZE_ONE_LOT' END],
  lambda x: x IS NOT NULL) AS gates
FROM (SELECT *, CASE WHEN target_primary > entry_high THEN (target_primary - entry_mid) / risk_per_share END AS rr FROM setup_risk)"""

CTES["setups"] = f"""
SELECT instrument_id, symbol, sector_code, trading_date, overall_score, market_score, sector_score, technical_score, liquidity_score,
       ownership_score, risk_score, data_completeness, setup_decision,
       CASE setup_decision WHEN 'REJECT' THEN 'AVOID' WHEN 'WATCH' THEN 'WATCH' ELSE 'BUY_SETUP' END AS status,
       CASE WHEN early THEN CASE WHEN prior_low_10d IS NULL OR prior_count_10d IS NULL THEN concat_ws('|',
              CASE WHEN prior_low_10d IS NULL THEN 'MISSING_PRIOR_LOW_10D' END, CASE WHEN prior_count_10d IS NULL THEN 'MISSING_PRIOR_HISTORY_COUNT' END)
              ELSE concat_ws('|', CASE WHEN prior_low_10d <= 0 THEN 'INVALID_PRIOR_LOW_10D' END, CASE WHEN prior_count_10d < 10 THEN 'INSUFFICIENT_PRIOR_HISTORY' END) END
            WHEN setup_decision = 'WATCH' THEN 'PRICE_EXTENDED_FROM_EMA20' ELSE array_to_string(gates, '|') END AS decision_reasons,
       CASE WHEN NOT early THEN entry_low END AS entry_low, CASE WHEN NOT early THEN entry_high END AS entry_high,
       CASE WHEN NOT early THEN entry_mid END AS entry_mid, CASE WHEN NOT early THEN invalidation_price END AS invalidation_price,
       CASE WHEN NOT early THEN stop_price END AS stop_price, CASE WHEN NOT early THEN target_primary END AS target_primary,
       CASE WHEN NOT early THEN nearest_resistance END AS nearest_resistance, CASE WHEN NOT early THEN {r("rr", 6)} END AS expected_rr,
       CASE WHEN NOT early THEN risk_per_share END AS risk_per_share, CASE WHEN NOT early THEN {r("rp", 8)} END AS risk_pct_price,
       CASE WHEN NOT early THEN {r("sr", 6)} END AS structure_risk_atr, CASE WHEN NOT early THEN {r("ext", 6)} END AS extension_atr,
       CASE WHEN NOT early THEN lots END AS position_size_lots, CASE WHEN NOT early THEN lots * 100 END AS position_size_shares,
       CASE WHEN NOT early THEN {r("lots * 100 * entry_mid", 2)} END AS capital_required,
       CASE WHEN NOT early THEN {r("lots * 100 * risk_per_share", 2)} END AS planned_risk_amount, 10 AS horizon_days, input_updated_at AS input_updated_on
FROM (SELECT *, CASE WHEN early OR len(gates) > 0 THEN 'REJECT' WHEN {r("ext", 6)} > 2.0 THEN 'WATCH' ELSE 'ACCEPT' END AS setup_decision FROM setup_gates)"""

CTES["signals"] = """
SELECT instrument_id || '|' || trading_date AS signal_id, instrument_id, symbol, sector_code, trading_date, entry_low, entry_high,
       stop_price, target_primary, horizon_days FROM setups WHERE setup_decision = 'ACCEPT'"""

CTES["paths"] = """
SELECT s.*, b.n AS bar_no, b.trading_date AS bar_date, b.open, b.high, b.low, b.close,
       b.high >= entry_low AND b.low <= entry_high AS touch,
       CASE WHEN b.open BETWEEN entry_low AND entry_high THEN b.open WHEN b.open > entry_high THEN entry_high ELSE entry_low END AS fill,
       CASE WHEN b.open BETWEEN entry_low AND entry_high THEN 'OPEN_IN_ZONE' WHEN b.open > entry_high THEN 'PULLBACK_TOUCH' ELSE 'RECOVERY_TOUCH' END AS method
FROM signals s LEFT JOIN (
  SELECT s2.signal_id AS sid, b2.*, row_number() OVER (PARTITION BY s2.signal_id ORDER BY b2.trading_date) AS n
  FROM signals s2 JOIN bars b2 ON b2.instrument_id = s2.instrument_id AND b2.trading_date > s2.trading_date
  QUALIFY n <= 25) b ON b.sid = s.signal_id"""

CTES["path_fill"] = """
SELECT *, max(CASE WHEN bar_no = fill_no THEN fill END) OVER (PARTITION BY signal_id) AS price,
       bar_no BETWEEN fill_no AND fill_no + horizon_days - 1 AS held
FROM (SELECT *, min(CASE WHEN bar_no = event_no AND touch THEN bar_no END) OVER (PARTITION BY signal_id) AS fill_no
      FROM (SELECT *, min(CASE WHEN bar_no <= 5 AND (touch OR low <= stop_price) THEN bar_no END) OVER (PARTITION BY signal_id) AS event_no FROM paths))"""

CTES["path_exit"] = """
SELECT *, min(CASE WHEN held AND (low <= stop_price OR high >= target_primary) THEN bar_no END) OVER (PARTITION BY signal_id) AS exit_no
FROM path_fill"""

CTES["outcome_flat"] = """
SELECT signal_id, instrument_id, symbol, sector_code, trading_date, stop_price, target_primary, horizon_days,
       count(bar_no) AS available_bars, max(bar_date) AS evaluated_through, max(event_no) AS event_no, max(fill_no) AS fill_no, max(price) AS price,
       max(bar_date) FILTER (WHERE bar_no = fill_no) AS entry_date, max(method) FILTER (WHERE bar_no = fill_no) AS fill_method,
       max(exit_no) AS exit_no, max(bar_date) FILTER (WHERE bar_no = exit_no) AS exit_day,
       bool_or(low <= stop_price) FILTER (WHERE bar_no = exit_no) AS stopped, bool_or(high >= target_primary) FILTER (WHERE bar_no = exit_no) AS reached,
       count(*) FILTER (WHERE held) AS held_bars, max(bar_date) FILTER (WHERE held) AS last_day, arg_max(close, bar_no) FILTER (WHERE held) AS last_close,
       max(high) FILTER (WHERE held AND bar_no <= coalesce(exit_no, 25)) AS top, min(low) FILTER (WHERE held AND bar_no <= coalesce(exit_no, 25)) AS bottom,
       max(close) FILTER (WHERE bar_no = fill_no + 1) AS c1, max(close) FILTER (WHERE bar_no = fill_no + 3) AS c3,
       max(close) FILTER (WHERE bar_no = fill_no + 5) AS c5, max(close) FILTER (WHERE bar_no = fill_no + 10) AS c10,
       max(close) FILTER (WHERE bar_no = fill_no + 20) AS c20
FROM path_exit GROUP BY ALL"""

CTES["outcome_label"] = """
SELECT *, CASE lab WHEN 'STOP' THEN stop_price WHEN 'TARGET' THEN target_primary WHEN 'EXPIRED' THEN last_close END AS leave
FROM (SELECT *, CASE WHEN exit_no IS NOT NULL AND stopped THEN 'STOP' WHEN exit_no IS NOT NULL THEN 'TARGET'
              WHEN fill_no IS NOT NULL AND held_bars >= horizon_days THEN 'EXPIRED' WHEN fill_no IS NOT NULL THEN 'OPEN'
              WHEN event_no IS NOT NULL THEN 'CANCELLED' WHEN available_bars >= 5 THEN 'NO_FILL' ELSE 'PENDING' END AS lab FROM outcome_flat)"""

CTES["outcomes"] = f"""
SELECT signal_id, instrument_id, symbol, sector_code, trading_date, evaluated_through, lab AS outcome_label,
       fill_no IS NOT NULL AS entry_filled, lab = 'TARGET' AS target_hit, lab = 'STOP' AS stop_hit, entry_date, {r("price", 6)} AS entry_price,
       CASE WHEN exit_no IS NOT NULL THEN exit_day WHEN lab = 'EXPIRED' THEN last_day END AS exit_date, {r("leave", 6)} AS exit_price, stop_price,
       {r("leave / price - 1.0", 8)} AS realized_return, {r("(leave - price) / (price - stop_price)", 8)} AS realized_r,
       {r("top / price - 1.0", 8)} AS mfe, {r("bottom / price - 1.0", 8)} AS mae,
       {r("(top - price) / (price - stop_price)", 8)} AS mfe_r, {r("(bottom - price) / (price - stop_price)", 8)} AS mae_r,
       {", ".join(f"{r(f'c{n} / price - 1.0', 8)} AS return_t{n}" for n in (1, 3, 5, 10, 20))},
       CAST(fill_no AS INTEGER) AS bars_to_entry,
       CAST(CASE WHEN exit_no IS NOT NULL THEN exit_no - fill_no + 1 WHEN fill_no IS NOT NULL THEN held_bars END AS BIGINT) AS bars_held,
       CASE WHEN lab = 'TARGET' THEN exit_day END AS target_hit_date, CASE WHEN lab = 'STOP' THEN exit_day END AS stop_hit_date,
       lab IN ('STOP', 'TARGET', 'EXPIRED', 'CANCELLED', 'NO_FILL') AS horizon_complete, available_bars,
       coalesce(stopped AND reached, false) AS sequence_ambiguous, fill_method
FROM outcome_label"""

CTES["calibration_base"] = """
SELECT o.*, s.expected_rr AS setup_expected_rr, s.risk_pct_price AS setup_risk_pct, s.horizon_days, s.overall_score, s.market_score, s.sector_score,
       s.technical_score, s.liquidity_score, s.ownership_score, s.risk_score, s.data_completeness,
       CASE WHEN outcome_label IN ('TARGET', 'STOP', 'EXPIRED') THEN 'MATURE_TRADE' WHEN outcome_label IN ('NO_FILL', 'CANCELLED') THEN 'UNFILLED_COMPLETE'
            ELSE 'UNRESOLVED' END AS sample_status
FROM outcomes o JOIN setups s ON s.instrument_id = o.instrument_id AND s.trading_date = o.trading_date"""

CTES["split_sizes"] = """
SELECT *, greatest(1, least(CAST(floor(CAST(n AS DOUBLE) * 0.15::DOUBLE) AS BIGINT), n - train - 1)) AS val
FROM (SELECT *, greatest(1, least(CAST(floor(CAST(n AS DOUBLE) * 0.70::DOUBLE) AS BIGINT), n - 2)) AS train
      FROM (SELECT trading_date, row_number() OVER (ORDER BY trading_date) - 1 AS i, count(*) OVER () AS n
            FROM (SELECT DISTINCT trading_date FROM calibration_base WHERE sample_status = 'MATURE_TRADE')))"""

CTES["calibration"] = """
SELECT signal_id, 'backtest_calibration_v1_current_20011104' AS dataset_version, instrument_id, symbol, c.trading_date AS signal_date, sector_code, sample_status,
       CASE WHEN sample_status <> 'MATURE_TRADE' THEN 'EXCLUDED' WHEN n = 1 OR (n = 2 AND i = 0) THEN 'TRAIN' WHEN n = 2 THEN 'TEST'
            WHEN i < train THEN 'TRAIN' WHEN i < train + val THEN 'VALIDATION' ELSE 'TEST' END AS split_label,
       sample_status = 'MATURE_TRADE' AS calibration_eligible, outcome_label, entry_filled, horizon_complete, entry_date, exit_date,
       entry_price, exit_price, stop_price, realized_return, realized_r, mfe_r, mae_r, target_hit, stop_hit,
       CASE WHEN sample_status = 'MATURE_TRADE' THEN target_hit END AS tp_before_sl_label,
       CASE WHEN sample_status = 'MATURE_TRADE' THEN realized_r > 0 END AS positive_r_label, setup_expected_rr, setup_risk_pct, horizon_days,
       overall_score, market_score, sector_score, technical_score, liquidity_score, ownership_score, risk_score, data_completeness,
       CASE WHEN overall_score >= 70 THEN 'GE_70' WHEN overall_score >= 67 THEN '67_TO_70' WHEN overall_score >= 65 THEN '65_TO_67'
            WHEN overall_score IS NOT NULL THEN 'LT_65' END AS score_bucket
FROM calibration_base c LEFT JOIN split_sizes d ON d.trading_date = c.trading_date"""

CTES["actions"] = """
SELECT DISTINCT l_suppkey AS instrument_id, CAST(o_orderdate AS DATE) AS ex_date, CAST(o_orderdate AS DATE) - 2 AS cum_date,
       CAST(o_orderdate AS DATE) + 2 AS record_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'"""

CTES["execution_inputs"] = """
SELECT b.signal_id, b.instrument_id, b.symbol, b.signal_date, b.sector_code, b.sample_status, b.split_label, b.calibration_eligible, b.outcome_label,
       b.setup_risk_pct, b.liquidity_score, b.overall_score, b.realized_return AS raw_realized_return, b.realized_r AS raw_realized_r,
       b.entry_price AS raw_entry_price, b.exit_price AS raw_exit_price, b.stop_price AS raw_stop_price,
       e.previous_close AS entry_reference_price, x.previous_close AS exit_reference_price,
       EXISTS (SELECT 1 FROM actions a WHERE a.instrument_id = b.instrument_id AND (
          a.ex_date BETWEEN b.signal_date AND coalesce(b.exit_date, b.entry_date, b.signal_date)
          OR a.cum_date BETWEEN b.signal_date AND coalesce(b.exit_date, b.entry_date, b.signal_date)
          OR a.record_date BETWEEN b.signal_date AND coalesce(b.exit_date, b.entry_date, b.signal_date))) AS corporate_action_overlap_detected
FROM calibration b LEFT JOIN bars e ON e.instrument_id = b.instrument_id AND e.trading_date = b.entry_date
LEFT JOIN bars x ON x.instrument_id = b.instrument_id AND x.trading_date = b.exit_date"""


def _modeled(source: str, entry: str, exit_: str, buy: str, sell: str) -> str:
    up = "CAST(ceil(CAST({p} AS DECIMAL(20,6)) / CAST({t} AS DECIMAL(10,0))) AS DOUBLE) * {t}"
    down = "CAST(floor(CAST({p} AS DECIMAL(20,6)) / CAST({t} AS DECIMAL(10,0))) AS DOUBLE) * {t}"
    return f"""
SELECT *, {r("(me_x - me) / me", 8)} AS gross_modeled_return, {r("(me_x - me) / (me - ms)", 8)} AS gross_modeled_r,
       {r("net / (me + me * bf)", 8)} AS net_modeled_return, {r("net / (me - ms)", 8)} AS net_realized_r,
       {r("raw_realized_r - (me_x - me) / (me - ms)", 8)} AS slippage_drag_r,
       {r("(me_x - me) / (me - ms) - net / (me - ms)", 8)} AS fee_drag_r, {r("raw_realized_r - net / (me - ms)", 8)} AS total_cost_drag_r
FROM (SELECT *, me_x - me_x * sf - me - me * bf AS net
      FROM (SELECT *, {r(up.format(p="raw_entry_price", t="et") + f" + et * {entry}", 6)} AS me, {r(down.format(p="raw_stop_price", t="et"), 6)} AS ms,
                   {r(down.format(p="raw_exit_price", t="xt") + f" - xt * {exit_}", 6)} AS me_x, {buy}::DOUBLE AS bf, {sell}::DOUBLE AS sf
            FROM (SELECT *, {TICK.format(p="entry_reference_price")} AS et, {TICK.format(p="exit_reference_price")} AS xt FROM {source})))"""


CTES["execution_usable"] = """
SELECT * FROM execution_inputs WHERE sample_status = 'MATURE_TRADE' AND raw_entry_price IS NOT NULL AND raw_exit_price IS NOT NULL
   AND raw_stop_price IS NOT NULL AND entry_reference_price IS NOT NULL AND exit_reference_price IS NOT NULL AND raw_realized_r IS NOT NULL"""
CTES["execution_modeled"] = _modeled("execution_usable", "1", "CASE WHEN outcome_label = 'TARGET' THEN 0 ELSE 1 END", "0.000433", "0.001433")
CTES["execution"] = """
SELECT i.*, m.signal_id IS NOT NULL AS execution_metrics_available, m.et AS entry_tick_size, m.xt AS exit_tick_size, m.me AS modeled_entry_price,
       m.me_x AS modeled_exit_price, m.ms AS modeled_stop_price, m.gross_modeled_return, m.gross_modeled_r, m.net_modeled_return, m.net_realized_r,
       m.slippage_drag_r, m.fee_drag_r, m.total_cost_drag_r,
       concat_ws('|', 'POINT_IN_TIME_KSEI_NOT_SAFE', 'CURRENT_UNIVERSE_SURVIVORSHIP_BIAS', 'CORPORATE_ACTION_HISTORY_NOT_COMPLETE',
         CASE WHEN i.corporate_action_overlap_detected THEN 'CORPORATE_ACTION_OVERLAP_DETECTED' END, 'BROKER_COMMISSION_NOT_MODELED',
         'BOARD_SPECIFIC_AUTO_REJECTION_NOT_MODELED',
         CASE WHEN i.sample_status = 'MATURE_TRADE' AND m.signal_id IS NULL THEN 'EXECUTION_INPUT_MISSING:' || concat_ws(',',
            CASE WHEN i.entry_reference_price IS NULL THEN 'entry_reference_price' END, CASE WHEN i.exit_reference_price IS NULL THEN 'exit_reference_price' END,
            CASE WHEN i.raw_entry_price IS NULL THEN 'raw_entry_price' END, CASE WHEN i.raw_exit_price IS NULL THEN 'raw_exit_price' END,
            CASE WHEN i.raw_realized_r IS NULL THEN 'raw_realized_r' END, CASE WHEN i.raw_stop_price IS NULL THEN 'raw_stop_price' END) END,
         CASE WHEN i.calibration_eligible AND m.signal_id IS NULL THEN 'EXECUTION_METRICS_UNAVAILABLE' END) AS blocking_reasons,
       false AS strict_calibration_eligible
FROM execution_inputs i LEFT JOIN execution_modeled m ON m.signal_id = i.signal_id"""

CTES["scenarios"] = """
SELECT * FROM (VALUES ('TICK_ONLY', 0, 0, 0, 0, 0.0, 0.0), ('MIN_COST_ZERO_SLIPPAGE', 0, 0, 0, 0, 0.000433, 0.001433),
  ('BASELINE_CONSERVATIVE', 1, 0, 1, 1, 0.000433, 0.001433), ('STRESS_2T', 2, 1, 2, 2, 0.000433, 0.001433))
  t(scenario, t_in, t_target, t_stop, t_exp, buy, sell)"""
CTES["scenario_inputs"] = """
SELECT m.signal_id, m.symbol, m.sector_code, m.split_label, m.outcome_label, m.raw_entry_price, m.raw_exit_price, m.raw_stop_price, m.raw_realized_r,
       m.entry_reference_price, m.exit_reference_price, m.setup_risk_pct, m.liquidity_score, m.overall_score,
       m.gross_modeled_r AS stored_baseline_gross_r, m.net_realized_r AS stored_baseline_net_r, m.total_cost_drag_r AS stored_baseline_drag_r, s.*
FROM execution_modeled m CROSS JOIN scenarios s"""
CTES["scenario_modeled"] = _modeled(
    "scenario_inputs", "t_in", "CASE outcome_label WHEN 'TARGET' THEN t_target WHEN 'STOP' THEN t_stop ELSE t_exp END", "buy", "sell")
CTES["sensitivity"] = f"""
SELECT signal_id, symbol, sector_code, split_label, outcome_label, scenario, raw_entry_price, raw_exit_price, raw_stop_price, entry_reference_price,
       et AS entry_tick_size, xt AS exit_tick_size, me AS modeled_entry_price, me_x AS modeled_exit_price, ms AS modeled_stop_price, rt AS raw_risk_ticks,
       CASE WHEN entry_reference_price < 200 THEN 'LT_200' WHEN entry_reference_price < 500 THEN '200_TO_499' WHEN entry_reference_price < 2000 THEN '500_TO_1999'
            WHEN entry_reference_price < 5000 THEN '2000_TO_4999' ELSE 'GE_5000' END AS price_bucket,
       CASE WHEN rt < 4 THEN 'LT_4' WHEN rt < 6 THEN '4_TO_LT_6' WHEN rt < 11 THEN '6_TO_LT_11' WHEN rt < 21 THEN '11_TO_LT_21' ELSE 'GE_21' END AS risk_tick_bucket,
       CASE WHEN liquidity_score < 25 THEN 'LT_25' WHEN liquidity_score < 50 THEN '25_TO_LT_50' WHEN liquidity_score < 75 THEN '50_TO_LT_75'
            WHEN liquidity_score IS NOT NULL THEN 'GE_75' ELSE 'MISSING' END AS liquidity_bucket,
       setup_risk_pct, liquidity_score, overall_score, raw_realized_r, gross_modeled_r AS gross_r, net_realized_r AS net_r, total_cost_drag_r AS total_drag_r,
       stored_baseline_gross_r, stored_baseline_net_r, stored_baseline_drag_r
FROM (SELECT *, {r("(raw_entry_price - raw_stop_price) / et", 6)} AS rt FROM scenario_modeled)"""

RECURSIVE = {"stock_smooth", "idx_smooth"}


def build(query: str, extra: dict[str, str] | None = None) -> str:
    """The query with every table expression it needs in front of it."""
    known = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(text: str, seen: tuple[str, ...]) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN)\s+\(*\s*([a-z_0-9]+)", text)):
            if name in known and name not in order and name not in seen:
                visit(known[name], (*seen, name))
                order.append(name)

    visit(query, ())
    if not order:
        return query
    parts = []
    for name in order:
        keep = "" if name in RECURSIVE else " MATERIALIZED"
        parts.append(f"{name} AS{keep} ({known[name]})")
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + query
