"""Execution realism, cost scenarios and the fragility verdict."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import col, ladder, mean, profit_factor, reasons, rnd
from tidemark.operators.joins import points_in_ranges
from tidemark.operators.ordering import medians
from tidemark.session import Workspace

# Exchange levies per side, and the price fraction ladder.
BUY_FEE, SELL_FEE = 0.000433, 0.001433
TICKS = [(200.0, 1.0), (500.0, 2.0), (2000.0, 5.0), (5000.0, 10.0)]
LAST_TICK = 25.0


@dataclass(frozen=True)
class Scenario:
    name: str
    entry_ticks: int
    target_ticks: int
    stop_ticks: int
    expired_ticks: int
    buy_fee: float
    sell_fee: float


# The four cost scenarios.
SCENARIOS = (
    Scenario("TICK_ONLY", 0, 0, 0, 0, 0.0, 0.0),
    Scenario("MIN_COST_ZERO_SLIPPAGE", 0, 0, 0, 0, BUY_FEE, SELL_FEE),
    Scenario("BASELINE_CONSERVATIVE", 1, 0, 1, 1, BUY_FEE, SELL_FEE),
    Scenario("STRESS_2T", 2, 1, 2, 2, BUY_FEE, SELL_FEE),
)
BASELINE = SCENARIOS[2]


def price_fraction(reference) -> Column:
    reference = col(reference)
    return F.when(reference > 0, ladder(reference, TICKS, LAST_TICK))


def to_tick(price, tick, up: bool) -> Column:
    """Nearest valid price above or below, decided on the decimal price."""
    exact, step = col(price).cast("decimal(20,6)"), col(tick).cast("decimal(10,0)")
    units = exact / step
    whole = F.ceil(units) if up else F.floor(units)
    return (whole * step).cast("double")


def modeled_trade(rows: DataFrame, entry_ticks: Column, exit_ticks: Column, buy_fee: Column,
                  sell_fee: Column) -> DataFrame:
    """Tick-rounded, slipped and charged version of each raw trade.

    The stop uses the entry day's tick; a modeled exit or risk that is not
    positive stops the job.
    """
    df = rows.withColumns({
        "entry_tick_size": price_fraction("entry_reference_price"),
        "exit_tick_size": price_fraction("exit_reference_price"),
    }).withColumns({
        "modeled_entry_price": rnd(to_tick("raw_entry_price", "entry_tick_size", True)
                                   + F.col("entry_tick_size") * entry_ticks, 6),
        "modeled_stop_price": rnd(to_tick("raw_stop_price", "entry_tick_size", False), 6),
        "modeled_exit_price": rnd(to_tick("raw_exit_price", "exit_tick_size", False)
                                  - F.col("exit_tick_size") * exit_ticks, 6),
    })
    entry, leave = F.col("modeled_entry_price"), F.col("modeled_exit_price")
    risk = entry - F.col("modeled_stop_price")
    broken = (
        F.when(leave <= 0, F.raise_error(F.lit("Modeled sell price became non-positive")).cast("double"))
        .when(risk <= 0, F.raise_error(F.lit("Modeled risk per share must be positive")).cast("double"))
        .otherwise(risk)
    )
    df = df.withColumn("_risk", broken)
    gross = leave - entry
    buy_cost, sell_cost = entry * buy_fee, leave * sell_fee
    net = leave - sell_cost - entry - buy_cost
    gross_r, net_r = gross / F.col("_risk"), net / F.col("_risk")
    return df.withColumns({
        "gross_modeled_return": rnd(gross / entry, 8), "gross_modeled_r": rnd(gross_r, 8),
        "net_modeled_return": rnd(net / (entry + buy_cost), 8), "net_realized_r": rnd(net_r, 8),
        "slippage_drag_r": rnd(F.col("raw_realized_r") - gross_r, 8), "fee_drag_r": rnd(gross_r - net_r, 8),
        "total_cost_drag_r": rnd(F.col("raw_realized_r") - net_r, 8),
    }).drop("_risk")


def exit_ticks(scenario: Scenario) -> Column:
    label = F.col("outcome_label")
    return (
        F.when(label == "TARGET", F.lit(scenario.target_ticks))
        .when(label == "STOP", F.lit(scenario.stop_ticks)).when(label == "EXPIRED", F.lit(scenario.expired_ticks))
    )


def execution_inputs(calibration: DataFrame, bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Raw prices, previous closes of the entry and exit days, and action overlap."""
    closes = bars.select("instrument_id", "trading_date", "previous_close")

    def reference(side: str) -> DataFrame:
        return closes.select("instrument_id", F.col("trading_date").alias(f"{side}_date"),
                             F.col("previous_close").alias(f"{side}_reference_price"))

    held = calibration.withColumn("_until", F.coalesce("exit_date", "entry_date", "signal_date"))
    # actions of instruments without a signal are left out before they are spread over their dates
    actions = actions.join(held.select("instrument_id").distinct().hint("shuffle_hash"), "instrument_id", "left_semi")
    dates = actions.select(
        "instrument_id", F.explode(F.array("ex_date", "cum_date", "record_date")).alias("action_date")
    )
    hit = points_in_ranges(held, dates, ["instrument_id"], "signal_id", "signal_date", "_until", "action_date")
    return (
        held.drop("_until").join(reference("entry"), ["instrument_id", "entry_date"], "left")
        .join(reference("exit"), ["instrument_id", "exit_date"], "left")
        .join(hit.withColumn("_hit", F.lit(True)), "signal_id", "left")
        .select(
            "signal_id", "dataset_version", "instrument_id", "symbol", "signal_date", "sector_code", "sample_status",
            "split_label", "calibration_eligible", "outcome_label", "setup_risk_pct", "liquidity_score", "overall_score",
            F.col("realized_return").alias("raw_realized_return"), F.col("realized_r").alias("raw_realized_r"),
            F.col("entry_price").alias("raw_entry_price"), F.col("exit_price").alias("raw_exit_price"),
            F.col("stop_price").alias("raw_stop_price"), "entry_reference_price", "exit_reference_price",
            F.col("warnings").alias("calibration_warnings"),
            F.coalesce("_hit", F.lit(False)).alias("corporate_action_overlap_detected"),
        )
    )


RAW_INPUTS = ["entry_reference_price", "exit_reference_price", "raw_entry_price", "raw_exit_price",
              "raw_realized_r", "raw_stop_price"]
MODELED = [
    "entry_tick_size", "exit_tick_size", "modeled_entry_price", "modeled_exit_price", "modeled_stop_price",
    "gross_modeled_return", "gross_modeled_r", "net_modeled_return", "net_realized_r",
    "slippage_drag_r", "fee_drag_r", "total_cost_drag_r",
]


def execution_rows(inputs: DataFrame, model_version: str, actions_complete: bool = False,
                   commission_modeled: bool = False, auto_rejection_modeled: bool = False) -> DataFrame:
    """Modeled result of every mature trade with complete prices, and what blocks strict use.

    A row is point-in-time and survivorship safe unless its calibration warnings say otherwise.
    """
    def free_of(warning: str) -> Column:
        return ~F.array_contains("calibration_warnings", warning)

    inputs = inputs.withColumns({
        "point_in_time_safe": free_of("HISTORICAL_KSEI_AS_OF_DATE_IS_NOT_PUBLICATION_TIME_SAFE"),
        "survivorship_safe": free_of("CURRENT_UNIVERSE_HISTORY_IS_SURVIVORSHIP_BIASED")})
    mature = F.col("sample_status") == "MATURE_TRADE"
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in RAW_INPUTS]))
    df = inputs.withColumn("_absent", absent).withColumn(
        "execution_metrics_available", mature & (F.size("_absent") == 0)
    )
    usable = F.col("execution_metrics_available")
    # rows that cannot be modeled carry NULL prices through the arithmetic
    modeled = modeled_trade(
        df.withColumns({f"_keep_{c}": F.col(c) for c in RAW_INPUTS}).withColumns(
            {c: F.when(usable, F.col(c)) for c in RAW_INPUTS}),
        F.lit(BASELINE.entry_ticks), exit_ticks(BASELINE), F.lit(BUY_FEE), F.lit(SELL_FEE),
    ).withColumns({c: F.col(f"_keep_{c}") for c in RAW_INPUTS})
    overlap = F.col("corporate_action_overlap_detected")
    blocking = reasons(
        ("POINT_IN_TIME_KSEI_NOT_SAFE", ~F.col("point_in_time_safe")),
        ("CURRENT_UNIVERSE_SURVIVORSHIP_BIAS", ~F.col("survivorship_safe")),
        ("CORPORATE_ACTION_HISTORY_NOT_COMPLETE", F.lit(not actions_complete)),
        ("CORPORATE_ACTION_OVERLAP_DETECTED", overlap),
        ("BROKER_COMMISSION_NOT_MODELED", F.lit(not commission_modeled)),
        ("BOARD_SPECIFIC_AUTO_REJECTION_NOT_MODELED", F.lit(not auto_rejection_modeled)),
    )
    missing = F.when(mature & (F.size("_absent") > 0), F.array(
        F.concat(F.lit("EXECUTION_INPUT_MISSING:"), F.array_join("_absent", ","))))
    unavailable = F.when(F.col("calibration_eligible") & ~usable, F.array(F.lit("EXECUTION_METRICS_UNAVAILABLE")))
    nothing = F.array().cast("array<string>")
    modeled_fully = F.lit(actions_complete and commission_modeled and auto_rejection_modeled)
    safe = F.col("point_in_time_safe") & F.col("survivorship_safe") & modeled_fully
    return modeled.withColumns({
        "blocking_reasons": F.concat(blocking, F.coalesce(missing, nothing), F.coalesce(unavailable, nothing)),
        "entry_slippage_ticks": F.when(usable, F.lit(BASELINE.entry_ticks)),
        "exit_slippage_ticks": F.when(usable, exit_ticks(BASELINE)),
        "buy_fee_rate": F.when(usable, F.lit(BUY_FEE)), "sell_fee_rate": F.when(usable, F.lit(SELL_FEE)),
        "strict_calibration_eligible": F.col("calibration_eligible") & usable & ~overlap & safe,
        "model_version": F.lit(model_version),
    }).drop("_absent", *[f"_keep_{c}" for c in RAW_INPUTS])


def execution_summary(rows: DataFrame, ws: Workspace) -> DataFrame:
    mature = F.col("sample_status") == "MATURE_TRADE"
    usable = mature & F.col("execution_metrics_available")

    def average(c: str, name: str) -> Column:
        return rnd(mean(F.when(usable, F.col(c))), 8).alias(name)

    base = rows.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(mature).alias("mature_trades"),
        F.count_if(usable).alias("execution_metrics_available"),
        F.count_if("strict_calibration_eligible").alias("strict_eligible"),
        *[F.count_if(mature & (F.col("outcome_label") == n)).alias(f"{n.lower()}_trades") for n in ("TARGET", "STOP", "EXPIRED")],
        average("raw_realized_r", "raw_average_r"), average("gross_modeled_r", "gross_average_r"),
        average("net_realized_r", "net_average_r"),
        profit_factor(F.when(usable, F.col("raw_realized_r"))).alias("raw_profit_factor"),
        profit_factor(F.when(usable, F.col("net_realized_r"))).alias("net_profit_factor"),
        average("slippage_drag_r", "average_slippage_drag_r"), average("fee_drag_r", "average_fee_drag_r"),
        average("total_cost_drag_r", "average_total_drag_r"),
    )
    middle = medians(rows.filter(usable).select(F.lit(1).alias("_one"), "raw_realized_r", "net_realized_r"),
                     ws, ["_one"], ["raw_realized_r", "net_realized_r"])
    edge = (F.col("net_average_r") > 0) & (F.col("net_profit_factor") > 1)
    return (
        base.withColumn("_one", F.lit(1)).join(middle, "_one", "left").drop("_one")
        .withColumnRenamed("median_raw_realized_r", "raw_median_r")
        .withColumnRenamed("median_net_realized_r", "net_median_r")
        .withColumn("baseline_edge_positive", F.coalesce(edge, F.lit(False)))
    )


def risk_ticks() -> Column:
    risk = F.col("raw_entry_price") - F.col("raw_stop_price")
    return rnd(risk / price_fraction("entry_reference_price"), 6)


def sensitivity_rows(execution: DataFrame) -> DataFrame:
    """Every modeled trade under the four scenarios."""
    options = F.array(*[F.struct(
        F.lit(s.name).alias("scenario"), F.lit(s.entry_ticks).alias("entry_ticks"),
        F.lit(s.target_ticks).alias("target_ticks"), F.lit(s.stop_ticks).alias("stop_ticks"),
        F.lit(s.expired_ticks).alias("expired_ticks"), F.lit(s.buy_fee).alias("buy_fee"), F.lit(s.sell_fee).alias("sell_fee"),
    ) for s in SCENARIOS])
    base = execution.filter("sample_status = 'MATURE_TRADE' and execution_metrics_available").select(
        "signal_id", "symbol", "sector_code", "split_label", "outcome_label", *RAW_INPUTS,
        "setup_risk_pct", "liquidity_score", "overall_score",
        F.col("gross_modeled_r").alias("stored_baseline_gross_r"), F.col("net_realized_r").alias("stored_baseline_net_r"),
        F.col("total_cost_drag_r").alias("stored_baseline_drag_r"),
        F.explode(options).alias("s"),
    )
    label = F.col("outcome_label")
    ticks = F.when(label == "TARGET", F.col("s.target_ticks")).when(label == "STOP", F.col("s.stop_ticks")).when(
        label == "EXPIRED", F.col("s.expired_ticks"))
    modeled = modeled_trade(base, F.col("s.entry_ticks"), ticks, F.col("s.buy_fee"), F.col("s.sell_fee"))
    return modeled.withColumn("raw_risk_ticks", risk_ticks()).select(
        "signal_id", "symbol", "sector_code", "split_label", "outcome_label", F.col("s.scenario").alias("scenario"),
        "raw_entry_price", "raw_exit_price", "raw_stop_price", "entry_reference_price", "entry_tick_size",
        "exit_tick_size", "modeled_entry_price", "modeled_exit_price", "modeled_stop_price", "raw_risk_ticks",
        ladder("entry_reference_price", [(200.0, "LT_200"), (500.0, "200_TO_499"), (2000.0, "500_TO_1999"),
                                         (5000.0, "2000_TO_4999")], "GE_5000").alias("price_bucket"),
        ladder("raw_risk_ticks", [(4.0, "LT_4"), (6.0, "4_TO_LT_6"), (11.0, "6_TO_LT_11"),
                                  (21.0, "11_TO_LT_21")], "GE_21").alias("risk_tick_bucket"),
        F.coalesce(ladder("liquidity_score", [(25.0, "LT_25"), (50.0, "25_TO_LT_50"), (75.0, "50_TO_LT_75")],
                          "GE_75"), F.lit("MISSING")).alias("liquidity_bucket"),
        "setup_risk_pct", "liquidity_score", "overall_score", "raw_realized_r",
        F.col("gross_modeled_r").alias("gross_r"), F.col("net_realized_r").alias("net_r"),
        F.col("total_cost_drag_r").alias("total_drag_r"),
        "stored_baseline_gross_r", "stored_baseline_net_r", "stored_baseline_drag_r",
    )


def scenario_summary(rows: DataFrame, ws: Workspace) -> DataFrame:
    base = rows.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("trades"), rnd(mean("net_r"), 8).alias("average_r"),
        profit_factor("net_r").alias("profit_factor"), F.count_if(F.col("net_r") > 0).alias("positive_trades"),
        rnd(F.count_if(F.col("net_r") > 0) / F.count(F.lit(1)), 8).alias("positive_rate"),
        rnd(mean("total_drag_r"), 8).alias("average_drag_r"),
    )
    return base.join(medians(rows, ws, ["scenario"], ["net_r"]), "scenario", "left").withColumnRenamed(
        "median_net_r", "median_r")


def group_summary(rows: DataFrame, scenario: str, bucket: str) -> DataFrame:
    """One scenario by a bucket column, most trades first."""
    return rows.filter(F.col("scenario") == scenario).groupBy(F.col(bucket).cast("string").alias(bucket)).agg(
        F.count(F.lit(1)).alias("trades"), rnd(mean("raw_realized_r"), 8).alias("raw_avg_r"),
        rnd(mean("net_r"), 8).alias("net_avg_r"), rnd(mean("total_drag_r"), 8).alias("avg_drag_r"),
        profit_factor("net_r").alias("net_profit_factor"),
        rnd(F.count_if(F.col("net_r") > 0) / F.count(F.lit(1)), 8).alias("positive_rate"),
    ).orderBy(F.col("trades").desc(), F.col(bucket))


def fragility(summary: DataFrame) -> DataFrame:
    """The costliest scenario that still has a positive edge names the verdict."""
    good = (F.col("average_r") > 0) & (F.col("profit_factor") > 1)
    flags = summary.agg(*[
        F.coalesce(F.max((F.col("scenario") == s.name) & good), F.lit(False)).alias(s.name) for s in SCENARIOS
    ])
    return flags.select(
        F.when(F.col("STRESS_2T"), "ROBUST_TO_STRESS_2T").when(F.col("BASELINE_CONSERVATIVE"), "ROBUST_TO_BASELINE")
        .when(F.col("MIN_COST_ZERO_SLIPPAGE"), "FRAGILE_TO_EXTRA_SLIPPAGE")
        .when(F.col("TICK_ONLY"), "NEGATIVE_AFTER_MINIMUM_FEES_ZERO_EXTRA_SLIPPAGE")
        .otherwise("NEGATIVE_AFTER_TICK_ROUNDING_ONLY").alias("fragility")
    )
