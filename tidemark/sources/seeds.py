"""Fixed seed rows: data sources and the benchmark instrument."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.rules import inline_table

# Code, name, type, authority rank and address of each source.
DATA_SOURCES = [
    ("IDX_OFFICIAL", "Indonesia Stock Exchange", "OFFICIAL_EXCHANGE", 1, "https://www.idx.id/"),
    ("BI_OFFICIAL", "Bank Indonesia", "OFFICIAL_CENTRAL_BANK", 1, "https://www.bi.go.id/"),
    ("BPS_WEBAPI", "BPS - Statistics Indonesia", "OFFICIAL_STATISTICS", 1, "https://www.bps.go.id/"),
    ("OJK_OFFICIAL", "Otoritas Jasa Keuangan", "OFFICIAL_REGULATOR", 1, "https://www.ojk.go.id/"),
    ("KSEI_OFFICIAL", "Kustodian Sentral Efek Indonesia", "OFFICIAL_DEPOSITORY", 1, "https://www.ksei.co.id/"),
    ("YAHOO_FINANCE", "Yahoo Finance", "THIRD_PARTY_MARKET_DATA", 3, "https://query1.finance.yahoo.com/"),
]
BENCHMARK = ("IHSG", "Indeks Harga Saham Gabungan", "INDEX", "IDX", "IDR")


def data_sources(spark: SparkSession) -> DataFrame:
    return inline_table(spark, DATA_SOURCES, "code string, name string, source_type string, authority_rank int, base_url string")


def benchmark_instrument(spark: SparkSession) -> DataFrame:
    return inline_table(spark, [BENCHMARK], "symbol string, name string, asset_type string, exchange string, currency string")
