"""Company profiles, new-listing pages and the universe refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import event_symbol, provider_date
from tidemark.functions.numeric import reasons, written_as
from tidemark.operators.keyed import last_per_key, merge_keep_known

# Sector names as written, by sector code.
SECTOR_NAMES = {
    "IDXENERGY": ["energi", "energy"], "IDXBASIC": ["barang baku", "basic materials"],
    "IDXINDUST": ["perindustrian", "industrials"], "IDXNONCYC": ["barang konsumen primer", "consumer non-cyclicals"],
    "IDXCYCLIC": ["barang konsumen non-primer", "consumer cyclicals"], "IDXHEALTH": ["kesehatan", "healthcare"],
    "IDXFINANCE": ["keuangan", "financials"], "IDXPROPERT": ["properti & real estat", "properties & real estate"],
    "IDXTECHNO": ["teknologi", "technology"], "IDXINFRA": ["infrastruktur", "infrastructures"],
    "IDXTRANS": ["transportasi & logistik", "transportation & logistic"],
}
# Key aliases of each profile field, best first.
PROFILE_KEYS = {
    "symbol": ["kodeemiten", "kode_emiten", "code", "symbol"],
    "name": ["namaemiten", "nama_emiten", "name", "company_name"],
    "listed": ["tanggalpencatatan", "listing_date", "listingdate", "listed_date"],
    "sector_name": ["sector", "sektor", "namasektor"],
    "subsector_name": ["subsector", "subsektor", "namasubsektor"],
    "industry_name": ["industry", "industri", "namaindustri"],
    "subindustry_name": ["subindustry", "sub-industry", "subindustri"],
    "listing_board": ["listingboard", "papanpencatatan", "board"],
}
SYMBOL_SHAPE = "^[A-Z0-9]{1,12}$"


def sector_code(name: Column) -> Column:
    clean = F.trim(F.regexp_replace(F.lower(F.trim(name)), r"\s+", " "))
    return written_as(clean, SECTOR_NAMES)


def normalize_profiles(rows: DataFrame, body: str = "body") -> DataFrame:
    """Typed profile of each JSON object; keys match whatever their case."""
    kept = [c for c in rows.columns if c != body]
    # keys that differ only in case collapse to one entry, the later one winning
    entries = F.aggregate(
        F.map_entries(F.from_json(body, "map<string,string>")), F.create_map().cast("map<string,string>"),
        lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, v: k != F.lower(e["key"])),
                                    F.create_map(F.lower(e["key"]), e["value"])))
    lowered = rows.withColumn("_m", entries)

    def pick(field: str) -> Column:
        values = F.transform(F.array(*[F.lit(k) for k in PROFILE_KEYS[field]]), lambda k: F.try_element_at("_m", k))
        return F.get(F.filter(values, lambda v: v != ""), F.lit(0))

    return lowered.select(
        *kept, event_symbol(pick("symbol")).alias("symbol"), F.trim(pick("name")).alias("name"),
        provider_date(pick("listed")).alias("listed_date"), sector_code(pick("sector_name")).alias("sector_code"),
        *[pick(f).alias(f) for f in ("sector_name", "subsector_name", "industry_name", "subindustry_name", "listing_board")])


def validate_profiles(profiles: DataFrame, snapshot_date: Column) -> DataFrame:
    return profiles.withColumn("reasons", reasons(
        ("Invalid symbol format.", F.coalesce(~F.regexp_like("symbol", F.lit(SYMBOL_SHAPE)), F.lit(True))),
        ("Company name is empty.", F.coalesce(F.trim("name") == "", F.lit(True))),
        ("Listing date is after snapshot date.", F.col("listed_date") > snapshot_date)))


def accepted_profiles(profiles: DataFrame, snapshot_date: Column, arrival: str) -> DataFrame:
    """Valid profiles, the last arrival of a symbol winning."""
    valid = validate_profiles(profiles, snapshot_date).filter(F.size("reasons") == 0).drop("reasons")
    return last_per_key(valid, ["symbol"], [F.col(arrival)])


def refresh_universe(stored: DataFrame, accepted: DataFrame, snapshot_date: Column,
                     minimum: int) -> tuple[DataFrame, DataFrame]:
    """Merged instruments and the snapshot rows; too few profiles stop the refresh.

    New values replace old ones unless they are missing; metadata is merged.
    """
    found = accepted.count()
    if found < minimum:
        raise ValueError(f"universe has {found} profiles, expected at least {minimum}; nothing written")
    details = ["sector_name", "subsector_name", "industry_name", "subindustry_name", "listing_board"]
    known = F.map_filter(F.create_map(*[x for d in details for x in (F.lit(d), F.col(d))]), lambda k, v: v.isNotNull())
    incoming = accepted.select("symbol", "name", "sector_code", "listed_date", F.lit(True).alias("is_active"), known.alias("metadata"))
    merged = merge_keep_known(stored.select(*incoming.columns), incoming, ["symbol"], ["metadata"])
    snapshot = accepted.select("symbol", "name", "sector_code", "listing_board", "listed_date",
                               snapshot_date.alias("snapshot_date"), F.lit(True).alias("is_member"))
    return merged, snapshot


LISTING_ROW = ("struct<code:string,issuerName:string,ListingDate:string,ListedShares:string,NumOfShares:string,"
               "Nominal:string,Offering:string,FundRaised:string,Type:string>")
LISTING_PAGE = f"struct<data:array<{LISTING_ROW}>,meta:struct<totalItems:bigint,pageSize:bigint,pageNumber:bigint>>"


def parse_new_listings(pages: DataFrame, body: str = "body") -> DataFrame:
    """Rows of landed listing pages with the reasons a row is unusable.

    ``year`` and ``month`` of the page say which month was asked for.
    """
    rows = pages.withColumn("_p", F.from_json(body, LISTING_PAGE)).select(
        "year", "month", F.col("_p.meta.totalItems").alias("total_items"), F.col("_p.meta.pageSize").alias("page_size"),
        F.col("_p.meta.pageNumber").alias("page_number"), F.posexplode("_p.data").alias("row_no", "d"))
    number = {c: F.col(f"d.{c}").try_cast("decimal(38,6)") for c in ("ListedShares", "NumOfShares", "Nominal", "Offering", "FundRaised")}
    code = F.upper(F.trim("d.code"))
    day = F.when(F.regexp_like("d.ListingDate", F.lit(r"^\d{4}-\d{2}-\d{2}$")), F.to_date(F.try_to_timestamp("d.ListingDate", F.lit("yyyy-MM-dd"))))
    blank = F.coalesce(F.trim("d.issuerName") == "", F.lit(True))

    def whole(c: str) -> Column:
        return number[c].isNull() | (number[c] != F.floor(number[c])) | (number[c] < 0)

    def positive(c: str) -> Column:
        return number[c].isNull() | (number[c] < 0)

    errors = reasons(
        ("INVALID_SYMBOL", F.coalesce(~F.regexp_like(code, F.lit(SYMBOL_SHAPE)), F.lit(True))), ("EMPTY_ISSUER_NAME", blank),
        ("INVALID_LISTING_DATE", day.isNull()),
        ("OUTSIDE_REQUESTED_MONTH", (F.year(day) != F.col("year")) | (F.month(day) != F.col("month"))),
        *[(f"INVALID_{c.upper()}", whole(c)) for c in ("ListedShares", "NumOfShares")],
        *[(f"INVALID_{c.upper()}", positive(c)) for c in ("Nominal", "Offering", "FundRaised")])
    return rows.select(
        "year", "month", "page_number", "total_items", "page_size", "row_no", code.alias("symbol"), F.trim("d.issuerName").alias("issuer_name"),
        day.alias("listing_date"), number["ListedShares"].cast("decimal(38,0)").alias("listed_shares"),
        number["NumOfShares"].cast("decimal(38,0)").alias("shares_offered"), number["Nominal"].alias("par_value"),
        number["Offering"].alias("offering_price"), number["FundRaised"].alias("fund_raised"),
        F.nullif(F.trim("d.Type"), F.lit("")).alias("listing_type"), errors.alias("errors"))


def listing_coverage(rows: DataFrame) -> DataFrame:
    """Per month: collected rows against the announced total, bad rows and repeated symbols."""
    by_symbol = rows.groupBy("year", "month", "symbol").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.size("errors") > 0).alias("_bad"), F.max("total_items").alias("_total"))
    out = by_symbol.groupBy("year", "month").agg(
        F.sum("_n").alias("collected_rows"), F.max("_total").alias("total_items"), F.sum("_bad").alias("bad_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicate_symbols"))
    return out.withColumn("complete", (F.col("collected_rows") == F.col("total_items")) & (F.col("bad_rows") == 0)
                          & (F.col("duplicate_symbols") == 0))
