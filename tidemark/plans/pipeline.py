"""The research pipeline over one source folder, each stage built once."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import breadth, calibration, execution, features, incremental, lifecycle, outcomes, ownership, screener, setups
from tidemark.session import PLANNING, STORED, WRITING, Workspace
from tidemark.sources import bars as bar_rules
from tidemark.sources import feeds
from tidemark.sources.tables import PART_BYTES, Source

VERSION = "current_20011104"
#: Feature columns that a screened row needs.
#: Decimals of the stored doubles.
DIGITS = {
    **{c: 2 for c in ("open", "high", "low", "close", "value", "previous_close")}, "volume": 0,
    **{f"return_{n}d": 8 for n in (1, 5, 20, 60)}, "rs_ihsg_20d": 8,
    **{c: 6 for c in ("ema20", "ema50", "ema100", "ema200", "rsi14", "atr14", "volume_z20")},
    "market_confidence": 4, "ownership_signal_strength": 4, "atr_pct": 4, "data_completeness": 0,
    **{f"{c}_score": 4 for c in ("overall", "market", "sector", "technical", "liquidity", "ownership", "risk", "trend",
                                 "momentum", "relative_strength", "volume", "breakout")},
}
SCREENED = ["instrument_id", "trading_date", "symbol", "sector_code", "close", "volume_z20", *screener.REQUIRED[:-1], "updated_at"]


class Pipeline:
    """Stages that several others read are written to the workspace, as the
    stored tables of a daily build are; the rest stay lazy."""

    def __init__(self, spark: SparkSession, folder: str, part_bytes: int = PART_BYTES):
        """``part_bytes``: about how much of the largest table one bucket of the keyed stages holds."""
        self.spark = spark
        self.source = Source(spark, folder)
        self.ws = Workspace(spark, self.source.parts("lineitem", part_bytes), WRITING, STORED, DIGITS)
        for k, v in PLANNING.items():
            spark.conf.set(k, v)

    @cached_property
    def instruments(self) -> DataFrame:
        return self.source.instruments()

    @cached_property
    def raw_bars(self) -> DataFrame:
        return self.source.bars_walk()

    @cached_property
    def bars(self) -> DataFrame:
        """Valid bars with the previous valid close, stored by instrument.

        Every look-back and look-ahead of the pipeline is per instrument, so the
        table is bucketed on it: the windows over it run without a shuffle.
        """
        rows = self.source.bars_walk(self.ws.keyed(self.source.daily_totals(), "instrument_id"))
        return self.ws.write_keyed(bar_rules.with_previous_close(bar_rules.valid_equity_bars(rows)), "bars", "instrument_id")

    @cached_property
    def index_bars(self) -> DataFrame:
        return bar_rules.validate_index_bars(
            self.source.index_bars(self.bars).withColumn("adjusted_close", F.col("close"))
        ).filter("quality = 'VALID'").drop("reasons", "quality", "adjusted_close").withColumn(
            "instrument_id", F.lit(-1).cast("long"))

    @cached_property
    def index_features(self) -> DataFrame:
        return self.ws.write(features.technical_features(self.index_bars, with_volume=False), "index-features")

    @cached_property
    def features(self) -> DataFrame:
        """Features and index strength, one row per valid bar."""
        rows = features.with_index_strength(features.technical_features(self.bars), self.index_features)
        # hashed, not sorted: the rows keep the order that the windows put them in
        members = self.instruments.select("instrument_id", "symbol", "sector_code").hint("shuffle_hash")
        return self.ws.write_keyed(rows.join(members, "instrument_id"), "features", "instrument_id")

    @cached_property
    def ranged(self) -> DataFrame:
        """Features with the prior close ranges of their bar, which only the breadth of a day asks for."""
        keys = ["instrument_id", "trading_date"]
        ranges = breadth.prior_close_range(self.bars.select(*keys, "close")).drop("close")
        return self.features.join(ranges, keys)

    @cached_property
    def regimes(self) -> DataFrame:
        return self.ws.write(features.index_regimes(self.index_features), "regimes")

    @cached_property
    def breadth(self) -> DataFrame:
        return breadth.market_breadth(self.ranged, f"ALL_{VERSION}_EMA200_BREADTH_V1")

    @cached_property
    def rotation(self) -> DataFrame:
        return self.ws.write(
            breadth.sector_rotation(self.features, self.index_features, f"sector_rotation_v1_{VERSION}"), "rotation")

    @cached_property
    def snapshots(self) -> DataFrame:
        return self.ws.write_keyed(self.source.ownership_snapshots(self.ws), "snapshots", "instrument_id")

    @cached_property
    def trends(self) -> DataFrame:
        return self.ws.write_keyed(
            ownership.ownership_trends(self.snapshots, "ownership_trend_v1"), "trends", "instrument_id")

    @cached_property
    def sector_ownership(self) -> DataFrame:
        inputs = ownership.sector_ownership_inputs(self.trends, self.instruments)
        return self.ws.write(ownership.sector_ownership(inputs, f"sector_ownership_v1_{VERSION}"), "sector-ownership")

    @cached_property
    def integrated(self) -> DataFrame:
        inputs = ownership.integrated_inputs(self.rotation, self.sector_ownership)
        return self.ws.write(ownership.integrated_sector(inputs, f"integrated_sector_v1_{VERSION}"), "integrated")

    @cached_property
    def screener_inputs(self) -> DataFrame:
        return screener.screener_inputs(
            self.features.select(*SCREENED), self.bars, self.integrated, self.regimes, self.trends, self.ws)

    def screened_after(self, after: Column) -> DataFrame:
        """Screener rows of the dates after one, from bounded slices of the stored stages."""
        return incremental.screener_after(
            self.features.select(*SCREENED), self.bars, self.integrated, self.regimes, self.trends, after,
            f"stock_screener_v1_{VERSION}", self.ws)

    @cached_property
    def screened(self) -> DataFrame:
        rows = screener.screener_scores(self.screener_inputs, f"stock_screener_v1_{VERSION}")
        return screener.ranked(rows, self.ws)

    @cached_property
    def setups(self) -> DataFrame:
        candidates = setups.setup_candidates(self.screened, self.features, self.bars)
        return self.ws.write(setups.trade_setups(candidates, f"trade_setup_v1_{VERSION}"), "setups")

    @cached_property
    def outcomes(self) -> DataFrame:
        paths = outcomes.signal_bars(outcomes.accepted_signals(self.setups), self.bars)
        return self.ws.write(outcomes.signal_outcomes(paths, f"signal_outcome_v1_{VERSION}"), "outcomes")

    @cached_property
    def calibration(self) -> DataFrame:
        return self.ws.write(
            calibration.calibration_rows(self.outcomes, self.setups, f"backtest_calibration_v1_{VERSION}"), "calibration")

    @cached_property
    def execution(self) -> DataFrame:
        inputs = execution.execution_inputs(self.calibration, self.bars, self.source.corporate_actions())
        return self.ws.write(execution.execution_rows(inputs, f"execution_realism_v1_{VERSION}"), "execution")

    @cached_property
    def presence(self) -> DataFrame:
        return self.ws.write(feeds.presence(self.source), "presence")

    @cached_property
    def life_events(self) -> DataFrame:
        stream = lifecycle.event_stream(feeds.lifecycle_events(self.presence))
        # symbols keep the case of the feed here
        return self.ws.write(stream.withColumn("symbol", F.replace("symbol", F.lit("SUPPLIER"), F.lit("Supplier"))), "life-events")

    @cached_property
    def listing_feeds(self) -> DataFrame:
        return self.ws.write(feeds.listing_feeds(self.source), "listing-feeds")

    @cached_property
    def sensitivity(self) -> DataFrame:
        return self.ws.write(execution.sensitivity_rows(self.execution), "sensitivity")
