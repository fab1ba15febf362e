"""Event feeds and monthly presence derived from the sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import Source


def month_index(date) -> Column:
    """Months since year 0, so the next month is always + 1."""
    return F.year(date) * 12 + F.month(date) - 1


def month_start(index) -> Column:
    index = F.col(index) if isinstance(index, str) else index
    return F.make_date(F.floor(index / 12).cast("int"), (F.pmod(index, F.lit(12)) + 1).cast("int"), F.lit(1))


def presence(source: Source) -> DataFrame:
    """Symbols with at least one line in a month, with the first date of the month."""
    return source.table("lineitem").select(
        F.col("l_suppkey").alias("instrument_id"), F.to_date("l_shipdate").alias("d")
    ).groupBy("instrument_id", month_index(F.col("d")).alias("month")).agg(F.min("d").alias("first_seen")).join(
        source.instruments().select("instrument_id", "symbol"), "instrument_id")


def lifecycle_events(present: DataFrame) -> DataFrame:
    """Listing, relisting and delisting events read off gaps in monthly presence."""
    span = present.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    w = Window.partitionBy("symbol").orderBy("month")
    lagged = present.withColumns({"_prev": F.lag("month").over(w), "_next": F.lead("month").over(w)})
    first, last = span.select("a").scalar(), span.select("b").scalar()
    opened = lagged.filter(
        (F.col("_prev").isNull() & (F.col("month") > first)) | (F.col("month") - F.col("_prev") > 1)
    ).select("symbol", F.col("first_seen").alias("effective_date"),
             F.when(F.col("_prev").isNull(), "LISTED").otherwise("RELISTED").alias("event_type"),
             F.lit("VALID").alias("quality"))
    closed = lagged.filter(
        (F.col("_next").isNull() & (F.col("month") < last)) | (F.col("_next") - F.col("month") > 1)
    ).select("symbol", month_start(F.col("month") + 1).alias("effective_date"), F.lit("DELISTED").alias("event_type"),
             F.lit("WARNING").alias("quality"))
    return opened.unionByName(closed)


def listing_feeds(source: Source) -> DataFrame:
    """First month of each (symbol, year) as three sources of different density see it."""
    lines = source.table("lineitem").select(
        F.col("l_suppkey").alias("instrument_id"), F.to_date("l_shipdate").alias("d"),
        "l_returnflag", "l_linenumber", "l_quantity")
    named = {
        "LISTING_ACTIVITY": F.lit(True),
        "DIGITAL_STATISTIC": (F.col("l_returnflag") == "A") & (F.col("l_linenumber") >= 6),
        "NEWLY_LISTED_PERFORMANCE": (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 46),
    }
    tagged = lines.withColumn("source", F.explode(F.array_compact(F.array(
        *[F.when(test, F.lit(name)) for name, test in named.items()]))))
    return tagged.groupBy("source", "instrument_id", F.year("d").alias("year")).agg(
        F.trunc(F.min("d"), "month").alias("listing_date")
    ).join(source.instruments().select("instrument_id", "symbol"), "instrument_id").select(
        "source", "year", "symbol", "listing_date")


def activity_rows(source: Source, *line_numbers: int) -> DataFrame:
    """Raw (symbol, date) records of some line numbers, copies included."""
    return source.table("lineitem").filter(F.col("l_linenumber").isin(*line_numbers)).select(
        F.col("l_suppkey").alias("instrument_id"), F.to_date("l_shipdate").alias("listing_date"),
        "l_linenumber", "l_returnflag", "l_quantity"
    ).join(source.instruments().select("instrument_id", "symbol"), "instrument_id").withColumn(
        "year", F.year("listing_date"))


# --- landed documents rebuilt from the tables, so parsers run over whole tables ---

def bar_payloads(bars: DataFrame) -> DataFrame:
    """One JSON document per symbol; every 50th bar has a missing high.

    The array holds one entry per trading day of a symbol, so it is as long as
    the calendar at most.
    """
    # 09:00 in the market's zone, which is UTC+7
    local_open = F.unix_date("trading_date").cast("long") * 86400 + 2 * 3600
    broken = F.pmod(F.col("instrument_id") + F.unix_date("trading_date"), F.lit(50)) == 0
    entry = F.struct(
        local_open.alias("timestamp"), "open", F.when(~broken, F.col("high")).alias("high"), "low", "close", "volume",
        F.when(F.pmod(F.unix_date("trading_date"), F.lit(3)) != 0, F.col("close")).alias("adjclose"))
    days = bars.groupBy("instrument_id", "symbol").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    columns = ["timestamp", "open", "high", "low", "close", "volume", "adjclose"]
    body = F.struct("symbol", F.when(F.pmod("instrument_id", F.lit(11)) == 0, "1h").otherwise("1d").alias("granularity"),
                    *[F.col(f"e.{c}").alias(c) for c in columns])
    return days.select("symbol", F.to_json(body, {"ignoreNullFields": "false"}).alias("body"))


def profile_payloads(source: Source) -> DataFrame:
    """Company profiles in three key spellings, five date spellings and several defects."""
    i = F.col("instrument_id")
    day = F.date_add(F.lit("1995-01-01").cast("date"), (i % 2000).cast("int"))
    text = (
        F.when(i % 5 == 0, F.concat(F.lit("/Date("), (F.unix_date(day).cast("long") * 86400000).cast("string"), F.lit(")/")))
        .when(i % 5 == 1, F.date_format(day, "yyyy-MM-dd'T'00:00:00")).when(i % 5 == 2, F.date_format(day, "dd MMM yyyy"))
        .when(i % 5 == 3, F.date_format(day, "dd/MM/yyyy")))
    sector = F.when(F.col("sector_code") == "AFRICA", "Energi").when(F.col("sector_code") == "AMERICA", "  Barang   Baku ").when(
        F.col("sector_code") == "ASIA", "FINANCIALS").when(F.col("sector_code") == "EUROPE", "technology").otherwise("Other")
    code = F.when(i % 13 == 0, F.concat(F.lit("bad-"), i.cast("string"))).otherwise(F.concat(F.lit(" t"), i.cast("string")))
    name = F.when(i % 17 == 0, "").otherwise(F.concat(F.lit(" "), F.col("symbol"), F.lit(" ")))
    board = F.get(F.array(*[F.lit(b) for b in BOARD_TEXTS]), (i % len(BOARD_TEXTS)).cast("int"))
    rows = source.instruments().withColumns({"_c": code, "_n": name, "_d": text, "_s": sector, "_b": board})
    spellings = [("KodeEmiten", "NamaEmiten", "TanggalPencatatan", "Sektor", "PapanPencatatan"),
                 ("CODE", "Company_Name", "listing_date", "SECTOR", "Board"), ("symbol", "name", "ListedDate", "NamaSektor", "listingboard")]
    documents = [F.to_json(F.struct(*[F.col(c).alias(k) for c, k in zip(["_c", "_n", "_d", "_s", "_b"], keys)])) for keys in spellings]
    body = F.when(i % 3 == 0, documents[0]).when(i % 3 == 1, documents[1]).otherwise(documents[2])
    return rows.select("instrument_id", body.alias("body"))


BOARD_TEXTS = ["Papan Utama", "pengembangan", "New-Economy_Board", "  AKSELERASI ", "Watchlist", "Second Board"]


def listing_pages(source: Source, page_size: int = 100) -> DataFrame:
    """New-listing pages: one month asked for per 36 symbols' turn, at most ``page_size`` rows each."""
    i = F.col("instrument_id")
    slot, turn = F.pmod(i, F.lit(36)), F.floor(i / 36)
    year, month = (F.lit(2023) + F.floor(slot / 12)).cast("int"), (slot % 12 + 1).cast("int")
    day = F.make_date(year, F.when(i % 29 == 0, F.pmod(month, F.lit(12)) + 1).otherwise(month), (i % 28 + 1).cast("int"))
    row = F.struct(
        F.concat(F.lit("n"), F.when(i % 31 == 0, F.lit(0)).otherwise(i).cast("string")).alias("code"), F.col("symbol").alias("issuerName"),
        F.date_format(day, "yyyy-MM-dd").alias("ListingDate"), (i * 1000).cast("string").alias("ListedShares"),
        F.when(i % 23 == 0, "12.5").otherwise((i * 10).cast("string")).alias("NumOfShares"), F.lit("100").alias("Nominal"),
        F.when(i % 19 == 0, "-5").otherwise("250.5").alias("Offering"), F.lit("1000000").alias("FundRaised"), F.lit("").alias("Type"))
    rows = source.instruments().select(year.alias("year"), month.alias("month"), (F.floor(turn / page_size) + 1).alias("page"), i.alias("_i"), row.alias("r"))
    totals = rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("_total"))
    pages = rows.groupBy("year", "month", "page").agg(F.array_sort(F.collect_list(F.struct("_i", "r"))).alias("e"))
    body = F.struct(
        F.transform("e", lambda x: x["r"]).alias("data"),
        F.struct((F.col("_total") + F.when(F.col("month") == 5, 1).otherwise(0)).alias("totalItems"), F.lit(page_size).alias("pageSize"),
                 F.col("page").alias("pageNumber")).alias("meta"))
    return pages.join(totals, ["year", "month"]).select("year", "month", F.to_json(body).alias("body"))


def holding_lines(snapshots: DataFrame, instruments: DataFrame) -> DataFrame:
    """Pipe-delimited month-end lines, some of other types, wrong totals or unreadable."""
    i = F.col("instrument_id")
    fields = [
        F.upper(F.date_format("as_of_date", "dd-MMM-yyyy")), F.concat(F.lit(" c"), i.cast("string")),
        F.when(i % 9 == 0, "BOND").otherwise("Equity"), F.col("security_number").cast("string"),
        F.when(i % 16 == 0, "").otherwise("1250.5")]
    for side in ("local", "foreign"):
        part = F.floor(F.col(f"{side}_shares") / 9)
        fields.append((F.col(f"{side}_shares") - part * 8).cast("string"))
        fields += [part.cast("string")] * 8
        wrong = F.when(i % 7 == 0, 1).otherwise(0) if side == "local" else F.lit(0)
        fields.append((F.col(f"{side}_shares") + wrong).cast("string"))
    stamp = F.date_format("as_of_date", "yyyyMMdd")
    member_date = F.when(F.month("as_of_date") == 2, F.date_format(F.date_add("as_of_date", 1), "yyyyMMdd")).otherwise(stamp)
    return snapshots.select(
        F.concat(F.lit("BalanceposEfek"), stamp, F.lit(".zip")).alias("archive"), F.concat(F.lit("Balancepos"), member_date, F.lit(".txt")).alias("member"),
        (i + 2).cast("int").alias("line_no"), F.concat_ws("|", *fields).alias("line"), F.lit(None).cast("string").alias("problem"))


def delisting_pages(events: DataFrame, rows_per_page: int = 50) -> DataFrame:
    """HTML tables of delistings, a bounded number of rows per page."""
    rows = events.filter("event_type = 'DELISTED'").select(
        "symbol", "effective_date", month_index(F.col("effective_date")).alias("month"),
        F.pmod(F.xxhash64("symbol"), F.lit(4096)).alias("_slot"))
    html = F.concat(
        F.lit("<tr><td> "), F.lower("symbol"), F.lit("</td><td><b>Co</b>&amp; "), F.col("symbol"), F.lit("</td><td>-</td><td>"),
        F.date_format("effective_date", "dd MMM yyyy"), F.lit("</td></tr>"))
    w = Window.partitionBy("month", "_slot").orderBy("symbol", "effective_date")
    paged = rows.withColumn("_page", F.floor((F.row_number().over(w) - 1) / rows_per_page)).withColumn("_row", html)
    body = F.concat(
        F.lit("<html><body><!-- <tr><td>no</td></tr> --><table><tr><th>Kode Emiten</th><th>Nama Perusahaan</th>"
              "<th>Tanggal Pencatatan</th><th>Delisting  Date</th></tr>"),
        F.array_join(F.array_sort(F.collect_list("_row")), ""), F.lit("</table></body></html>"))
    return paged.groupBy("month", "_slot", "_page").agg(body.alias("html")).select(
        F.concat_ws("-", "month", "_slot", "_page").alias("page_id"), "html")


def highlight_pages(events: DataFrame) -> DataFrame:
    """One statistics page per year and month with the number of delistings in a sentence."""
    counts = events.groupBy(month_index(F.col("effective_date")).alias("month")).agg(
        F.count_if(F.col("event_type") == "DELISTED").alias("n"))
    number = F.format_number(F.col("n") * 1000 + F.col("month") % 7, 0)
    section = (
        F.when(F.col("month") % 5 == 0, F.lit("<h3>Other Section</h3>"))
        .when(F.col("month") % 5 == 1, F.lit("<h3>Stock <i>Delisting</i></h3><p>Issuers Volume</p>"))
        .when(F.col("month") % 5 == 2, F.lit("<h3>STOCK DELISTING</h3><p>none</p><p>Rights Announcement Issuers 5</p>"))
        .otherwise(F.concat(F.lit("<h3>Stock\n Delisting</h3><p>Issuers <b>"), number, F.lit("</b></p><p>Rights announcement</p>"))))
    return counts.select("month", "n", F.concat(F.lit("<html><script>var x = 1;</script><p>Monthly</p>"), section, F.lit("</html>")).alias("html"))


def performance_pages(source: Source, rows_per_page: int = 50) -> DataFrame:
    """New-listing performance pages: a table inside a layout table, numbered or with named columns, some rows defective."""
    i = F.col("instrument_id")
    day = F.when(i % 11 == 0, "soon").otherwise(F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (i % 2000).cast("int")), "dd MMM yyyy"))
    number = F.when(i % 7 == 0, "-").otherwise(i.cast("string"))
    low = F.lower("symbol")
    by_place = F.concat(F.lit("<tr><td> "), number, F.lit("</td><td>"), low, F.lit("</td><td><i>PT</i> &amp; "), "symbol", F.lit("</td><td>"), day, F.lit("</td></tr>"))
    by_name = F.concat(F.lit("<tr><td>"), day, F.lit("</td><td>1</td><td>2</td><td> "), low, F.lit(" </td></tr>"))
    slot = F.floor(i / rows_per_page)
    rows = source.instruments().select(slot.alias("slot"), F.struct("instrument_id", F.when(slot % 2 == 0, by_place).otherwise(by_name).alias("row")).alias("_e"))
    head = F.when(F.col("slot") % 2 == 0, "<TR><th>No</th><th colspan=2>Emiten</th><th>Listing</th></TR>").otherwise(
        "<tr><th>Tanggal  Pencatatan</th><th colspan='2'>Harga</th><th>KODE</th></tr>")
    return rows.groupBy("slot").agg(F.array_sort(F.collect_list("_e")).alias("_e")).select(F.col("slot").alias("page_id"), F.concat(
        F.lit("<html><table class=layout><tr><td>1</td><td>menu</td><td>x</td><td>01 Jan 2001</td><td><table>"), head,
        F.array_join(F.transform("_e", lambda e: e["row"]), "\n"), F.lit("</table></td></tr></table></html>")).alias("html"))
