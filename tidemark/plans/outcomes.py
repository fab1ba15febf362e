"""Signal outcomes: what the next bars did to each accepted setup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import rnd
from tidemark.operators.joins import next_rows

# Fixed values of the outcome model.
ENTRY_WINDOW = 5
FUTURE_BARS = 25
HORIZONS = (1, 3, 5, 10, 20)


def accepted_signals(setups: DataFrame) -> DataFrame:
    return setups.filter("setup_decision = 'ACCEPT'").select(
        F.concat_ws("|", F.col("instrument_id").cast("string"), F.col("trading_date").cast("string")).alias("signal_id"),
        "instrument_id", "symbol", "sector_code", "trading_date",
        "entry_low", "entry_high", "stop_price", "target_primary", "horizon_days",
    )


def level_errors() -> Column:
    """First rule the levels of a signal break, NULL when they are usable."""
    return (
        F.when(F.col("entry_low") <= 0, "entry_low must be positive")
        .when(F.col("entry_high") < F.col("entry_low"), "entry_high cannot be below entry_low")
        .when(F.col("stop_price") <= 0, "stop_price must be positive")
        .when(F.col("stop_price") >= F.col("entry_low"), "stop_price must be below the entry zone")
        .when(F.col("target_primary") <= F.col("entry_high"), "target_primary must be above the entry zone")
        .when(F.col("horizon_days") <= 0, "horizon_days must be positive")
    )


def signal_bars(signals: DataFrame, bars: DataFrame) -> DataFrame:
    """Each signal with its next 25 bars; signals without bars keep one NULL row."""
    return next_rows(
        signals, bars, ["instrument_id"], "trading_date", "trading_date", FUTURE_BARS,
        ["open", "high", "low", "close"],
    )


def fill_price() -> Column:
    """Open inside the zone, else the edge the bar crosses first."""
    inside = F.col("open").between(F.col("entry_low"), F.col("entry_high"))
    return F.when(inside, F.col("open")).when(F.col("open") > F.col("entry_high"), F.col("entry_high")).otherwise(F.col("entry_low"))


def fill_method() -> Column:
    inside = F.col("open").between(F.col("entry_low"), F.col("entry_high"))
    return F.when(inside, "OPEN_IN_ZONE").when(F.col("open") > F.col("entry_high"), "PULLBACK_TOUCH").otherwise("RECOVERY_TOUCH")


def signal_outcomes(paths: DataFrame, model_version: str) -> DataFrame:
    """One outcome per signal from its bar rows (at most 25 each).

    Within the first five bars the first one that touches the entry zone or
    falls to the stop decides fill or cancellation, a touch winning on the same
    bar. Held bars start with the fill bar; the stop wins over the target when
    one bar reaches both.
    """
    checked = paths.withColumn("_error", level_errors())
    checked = checked.filter(F.when(F.col("_error").isNull(), F.lit(True)).otherwise(
        F.raise_error(F.col("_error")).cast("boolean"))).drop("_error")
    signal = ["signal_id", "instrument_id", "symbol", "sector_code", "trading_date"]
    w = Window.partitionBy("signal_id")
    no = F.col("bar_no")
    touch = (F.col("high") >= F.col("entry_low")) & (F.col("low") <= F.col("entry_high"))
    decides = (no <= ENTRY_WINDOW) & (touch | (F.col("low") <= F.col("stop_price")))
    df = checked.withColumn("_event", F.min(F.when(decides, no)).over(w))
    df = df.withColumn("_fill", F.min(F.when((no == F.col("_event")) & touch, no)).over(w))
    at_fill = no == F.col("_fill")
    df = df.withColumn("_price", F.max(F.when(at_fill, fill_price())).over(w))
    held = no.between(F.col("_fill"), F.col("_fill") + F.col("horizon_days") - 1)
    stopped, reached = F.col("low") <= F.col("stop_price"), F.col("high") >= F.col("target_primary")
    df = df.withColumn("_exit", F.min(F.when(held & (stopped | reached), no)).over(w))
    at_exit = no == F.col("_exit")
    on_path = held & (no <= F.coalesce(F.col("_exit"), F.lit(FUTURE_BARS)))

    def close_after(n: int) -> Column:
        return F.max(F.when(no == F.col("_fill") + n, F.col("close"))).alias(f"_c{n}")

    flat = df.groupBy(*signal).agg(
        F.max("entry_low").alias("entry_low"), F.max("stop_price").alias("stop_price"),
        F.max("target_primary").alias("target_primary"), F.max("horizon_days").alias("horizon_days"),
        F.count("bar_no").alias("available_bars"), F.max("bar_date").alias("evaluated_through"),
        F.max("_event").alias("_event"), F.max("_fill").alias("_fill"), F.max("_price").alias("_price"),
        F.max(F.when(at_fill, F.col("bar_date"))).alias("entry_date"),
        F.max(F.when(at_fill, fill_method())).alias("fill_method"),
        F.max("_exit").alias("_exit"),
        F.max(F.when(at_exit, F.col("bar_date"))).alias("_exit_date"),
        F.max(F.when(at_exit, stopped)).alias("_stopped"), F.max(F.when(at_exit, reached)).alias("_reached"),
        F.count(F.when(held, no)).alias("_held"),
        F.max(F.when(held, F.struct("bar_no", "bar_date", "close"))).alias("_last"),
        F.max(F.when(on_path, F.col("high"))).alias("_high"), F.min(F.when(on_path, F.col("low"))).alias("_low"),
        *[close_after(n) for n in HORIZONS],
    )
    filled, exited = F.col("_fill").isNotNull(), F.col("_exit").isNotNull()
    expired = filled & ~exited & (F.col("_held") >= F.col("horizon_days"))
    label = (
        F.when(filled & exited & F.col("_stopped"), "STOP").when(filled & exited, "TARGET")
        .when(expired, "EXPIRED").when(filled, "OPEN")
        .when(F.col("_event").isNotNull(), "CANCELLED")
        .when(F.col("available_bars") >= ENTRY_WINDOW, "NO_FILL").otherwise("PENDING")
    )
    flat = flat.withColumn("outcome_label", label)
    is_stop, is_target = F.col("outcome_label") == "STOP", F.col("outcome_label") == "TARGET"
    price, risk = F.col("_price"), F.col("_price") - F.col("stop_price")
    leave = (
        F.when(is_stop, F.col("stop_price")).when(is_target, F.col("target_primary"))
        .when(expired, F.col("_last.close"))
    )
    flat = flat.withColumn("_leave", leave)
    return flat.select(
        *signal, "evaluated_through", "outcome_label",
        filled.alias("entry_filled"), is_target.alias("target_hit"), is_stop.alias("stop_hit"),
        "entry_date", rnd(price, 6).alias("entry_price"),
        F.when(exited, F.col("_exit_date")).when(expired, F.col("_last.bar_date")).alias("exit_date"),
        rnd("_leave", 6).alias("exit_price"), "stop_price",
        rnd(F.col("_leave") / price - 1.0, 8).alias("realized_return"),
        rnd((F.col("_leave") - price) / risk, 8).alias("realized_r"),
        rnd(F.col("_high") / price - 1.0, 8).alias("mfe"), rnd(F.col("_low") / price - 1.0, 8).alias("mae"),
        rnd((F.col("_high") - price) / risk, 8).alias("mfe_r"), rnd((F.col("_low") - price) / risk, 8).alias("mae_r"),
        *[rnd(F.col(f"_c{n}") / price - 1.0, 8).alias(f"return_t{n}") for n in HORIZONS],
        F.col("_fill").alias("bars_to_entry"),
        F.when(exited, F.col("_exit") - F.col("_fill") + 1).when(filled, F.col("_held")).cast("long").alias("bars_held"),
        F.when(is_target, F.col("_exit_date")).alias("target_hit_date"),
        F.when(is_stop, F.col("_exit_date")).alias("stop_hit_date"),
        F.col("outcome_label").isin("STOP", "TARGET", "EXPIRED", "CANCELLED", "NO_FILL").alias("horizon_complete"),
        "available_bars",
        F.coalesce(filled & F.col("_stopped") & F.col("_reached"), F.lit(False)).alias("sequence_ambiguous"),
        "fill_method", F.lit(model_version).alias("evaluation_model_version"),
    )


# Caveats of every outcome row.
OUTCOME_WARNINGS = [
    "RESEARCH_BACKTEST_FOUNDATION_ONLY", "YAHOO_EOD_IS_THIRD_PARTY_MARKET_DATA", "DAILY_OHLC_HAS_NO_INTRADAY_SEQUENCE",
    "SAME_BAR_TARGET_STOP_USES_STOP_FIRST", "NO_SLIPPAGE_MODEL", "NO_TRANSACTION_FEE_MODEL",
    "CURRENT_UNIVERSE_HISTORY_IS_SURVIVORSHIP_BIASED", "HISTORICAL_KSEI_AS_OF_DATE_IS_NOT_PUBLICATION_TIME_SAFE",
]


def outcome_warnings() -> Column:
    fixed = F.array(*[F.lit(w) for w in OUTCOME_WARNINGS])
    return F.when(F.col("sequence_ambiguous"), F.array_append(fixed, "SAME_BAR_TARGET_STOP_AMBIGUOUS")).otherwise(fixed)
