"""Adapters from the sample star schema to the market tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import rnd
from tidemark.session import Workspace


PART_BYTES = 16 << 20


class Source:
    """Lazy logical tables over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def parts(self, name: str, part_bytes: int = PART_BYTES) -> int:
        """How many parts to lay a table out in: one per ``part_bytes`` of input and at least
        one per core. Reads file sizes only."""
        files = self.spark.read.format("binaryFile").load(f"{self.folder}/{name}.parquet")
        size = files.select("length").agg(F.sum("length")).first()[0] or 0
        return max(self.spark.sparkContext.defaultParallelism, -(-size // part_bytes))

    def instruments(self) -> DataFrame:
        """supplier x nation x region; the two lookups are small fixed tables."""
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return self.table("supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("instrument_id"),
            F.col("s_name").alias("symbol"),
            F.col("r_name").alias("sector_code"),
            F.col("s_nationkey").alias("nation_key"),
        )

    def daily_totals(self) -> DataFrame:
        cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
        return (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("instrument_id"), F.to_date("l_shipdate").alias("trading_date"))
            .agg(
                (F.sum(cents % 401) - F.lit(199) * F.count(F.lit(1))).alias("step"),
                F.sum("l_quantity").alias("volume"),
                F.sum(cents).alias("value_cents"),
                F.max("l_linenumber").alias("arrival_days"),
            )
        )

    def bars_walk(self, totals: DataFrame | None = None) -> DataFrame:
        """Smooth random-walk bars, one row per (instrument, date).

        A bar arrives as many days after its date as its highest line number says. ``totals`` may be the daily totals already partitioned by instrument.
        """
        w = Window.partitionBy("instrument_id").orderBy("trading_date")
        cum = F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        close = rnd(F.lit(1000.0) * F.exp(F.col("_cum") / F.lit(10000.0)), 2)
        # the sum is projected before it is rounded, so it is evaluated once
        steps = (self.daily_totals() if totals is None else totals).withColumn("_cum", cum).withColumn("close", close)
        steps = steps.withColumn("open", F.coalesce(F.lag("close").over(w), F.lit(1000.0)))
        whole = F.col("volume").cast("long")
        top = F.rint(F.greatest("open", "close") * 100).cast("long")
        bottom = F.rint(F.least("open", "close") * 100).cast("long")
        up = F.floor((top * (whole % 5)).cast("double") / F.lit(500.0)).cast("long")
        down = F.floor((bottom * (whole % 7)).cast("double") / F.lit(700.0)).cast("long")
        return steps.select(
            "instrument_id", "trading_date", "open",
            ((top + up) / F.lit(100.0)).alias("high"),
            ((bottom - down) / F.lit(100.0)).alias("low"),
            "close", "volume",
            (F.col("value_cents") / F.lit(100.0)).alias("value"),
            F.date_add("trading_date", F.col("arrival_days")).cast("timestamp").alias("ingested_at"),
        )

    def bars_raw(self) -> DataFrame:
        """First/last/max/min unit price of the day: rough bars with jumps."""
        price = rnd(F.col("l_extendedprice") / F.col("l_quantity"), 4)
        order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
        return (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("instrument_id"), F.to_date("l_shipdate").alias("trading_date"))
            .agg(
                F.min_by(price, order).alias("open"), F.max(price).alias("high"),
                F.min(price).alias("low"), F.max_by(price, order).alias("close"),
                F.sum("l_quantity").alias("volume"),
            )
        )

    def index_bars(self, bars: DataFrame) -> DataFrame:
        """Mean bar of all instruments per date, from whole cents so it is exact."""

        def mean(c: str):
            return rnd(F.sum(F.rint(F.col(c) * 100).cast("long")) / F.count(F.lit(1)) / F.lit(100.0), 6).alias(c)

        return bars.groupBy("trading_date").agg(
            mean("open"), mean("high"), mean("low"), mean("close"), F.sum("volume").alias("volume"),
            F.max("ingested_at").alias("ingested_at"),
        )

    def ownership_snapshots(self, ws: Workspace | None = None) -> DataFrame:
        """Month-end running local/foreign quantity per instrument.

        A line is local when buyer and instrument share a nation. The customer
        side is reduced to the order's nation before the large join. ``ws`` lays the months out in its buckets before they are summed up.
        """
        buyers = self.table("orders").join(
            self.table("customer"), F.col("o_custkey") == F.col("c_custkey")
        ).select("o_orderkey", F.col("c_nationkey").alias("buyer_nation"))
        lines = self.table("lineitem").select(
            "l_orderkey", F.col("l_suppkey").alias("instrument_id"),
            F.last_day("l_shipdate").alias("as_of_date"), "l_quantity", "l_linenumber",
        )
        home = self.instruments().select("instrument_id", "nation_key")
        foreign = F.col("buyer_nation") != F.col("nation_key")
        monthly = (
            lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("instrument_id", "as_of_date", "buyer_nation")
            .agg(F.sum("l_quantity").alias("quantity"), F.max("l_linenumber").alias("arrival_days"))
            .join(home, "instrument_id")
            .groupBy("instrument_id", "as_of_date")
            .agg(
                F.sum("quantity").cast("long").alias("bought"),
                F.coalesce(F.sum(F.when(foreign, F.col("quantity"))), F.lit(0.0)).cast("long").alias("bought_foreign"),
                F.date_add("as_of_date", F.max("arrival_days")).cast("timestamp").alias("ingested_at"),
            )
        )
        monthly = ws.keyed(monthly, "instrument_id") if ws else monthly
        w = (
            Window.partitionBy("instrument_id").orderBy("as_of_date")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        totals = monthly.select(
            "instrument_id", "as_of_date",
            F.sum("bought").over(w).alias("security_number"),
            F.sum("bought_foreign").over(w).alias("foreign_shares"),
            F.max("ingested_at").over(w).alias("updated_at"),
        )
        return totals.withColumn(
            "local_shares", F.col("security_number") - F.col("foreign_shares")
        ).withColumn(
            "foreign_ownership_pct", rnd(F.col("foreign_shares") / F.col("security_number") * 100.0, 8)
        )

    def corporate_actions(self) -> DataFrame:
        """Urgent orders as actions of every instrument in the order."""
        urgent = self.table("orders").filter("o_orderpriority = '1-URGENT'").select(
            "o_orderkey", F.to_date("o_orderdate").alias("ex_date")
        )
        return (
            self.table("lineitem").select("l_orderkey", F.col("l_suppkey").alias("instrument_id"))
            .join(urgent, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                "instrument_id", "ex_date",
                F.date_sub("ex_date", 2).alias("cum_date"), F.date_add("ex_date", 2).alias("record_date"),
            ).distinct()
        )
