import datetime as dt
import zipfile
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import rules
from tidemark.plans import pit
from tidemark.sources import bars, holdings, pages, profiles, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("base", ["http://a.b/c/d.html?x=1#f", "https://a.b", "https://a.b/x/", "http://a.b/c/d/e"])
def test_resolve_url_equals_urljoin(spark, base):
    refs = ["/p/q", "r/s.csv", "../up.zip", "../../../top", "./here", "?only=query", "//other.org/z", "https://full.org/a?b#c", "a/./b/../c", "../", "deep/../x/"]
    df = spark.createDataFrame([(base, r) for r in refs], "u string, r string")
    for row in df.select("r", pages.resolve_url("u", F.col("r")).alias("got")).collect():
        assert row["got"] == urljoin(base, row["r"]), row["r"]


@pytest.mark.parametrize("bad", ["javascript:void(0)", "mailto:x@y.z", "tel:1", "data:text", "#frag", "ftp://a.b/c", "  ", "'\"'"])
def test_resolve_url_refuses(spark, bad):
    df = spark.createDataFrame([("http://a.b/c", bad)], "u string, r string")
    assert df.select(pages.resolve_url("u", F.col("r")).alias("got")).first()["got"] is None


HTML = """<html><!-- <a href="/no.csv"> --><head><script src='/js/api.js'>var a = "<a href='/inner.json'>";</script></head>
<body><A HREF="/data/listing.xlsx">x</a><a class=k href=relist.html>y</a><form action="/primary/get?a=1&amp;b=2"></form>
<div data-url="https://www.idx.id/api/v1">z</div><a href="/about">q</a> see https://cdn.example.org/file.zip) and "/quoted/path.json" </body></html>"""


def test_page_contract(spark):
    df = spark.createDataFrame([(1, "https://www.idx.id/en/page", HTML), (2, "https://x.y/", "<p>plain</p>")], "page_id long, url string, html string")
    links = {r["candidate"] for r in pages.candidate_links(df.filter("page_id = 1")).collect()}
    assert links == {
        "https://www.idx.id/js/api.js", "https://www.idx.id/inner.json", "https://www.idx.id/data/listing.xlsx", "https://www.idx.id/en/relist.html",
        "https://www.idx.id/primary/get?a=1&b=2", "https://www.idx.id/api/v1", "https://cdn.example.org/file.zip", "https://www.idx.id/quoted/path.json",
        "https://www.idx.id/no.csv", "https://www.idx.id/primary/get?a=1&amp;b=2"}
    got = {r["page_id"]: r for r in pages.page_contracts(df, ["www.idx.id"]).collect()}
    assert (got[1]["anchor_count"], got[1]["script_count"], got[1]["form_count"], got[1]["parser_status"]) == (3, 1, 1, "CANDIDATE")
    assert (got[2]["candidate_url_count"], got[2]["parser_status"]) == (0, "DISCOVERY")


def test_markers_and_json(spark):
    df = spark.createDataFrame([(1, "A  New\nListing here"), (2, "nothing")], "id int, html string")
    got = {r["id"]: (r["matched"], r["success"]) for r in pages.marker_hits(df, ["new listing", "HERE", "absent"], 2).collect()}
    assert got == {1: ("new listing|HERE", True), 2: ("", False)}
    js = spark.createDataFrame([('{"data":[{"a":1},{"a":2}]}',), ('{"data":[]}',), ("broken",)], "b string")
    assert [(r["json_rows"], r["success"]) for r in pages.json_rows(js, "b").collect()] == [(2, True), (0, False), (0, False)]


@pytest.mark.parametrize("html, want", [
    ("<p>Stock Delisting</p><b>Issuers 1,234</b>", ("COUNT_PARSED", 1234)), ("<p>stock delisting</p> Issuers Volume", ("EMPTY_FIELD", None)),
    ("Stock Delisting then Rights Announcement Issuers 5", ("COUNT_NOT_PARSED", None)), ("nothing", ("SECTION_NOT_FOUND", None)),
    ("Stock Delisting " + "x" * 600 + " Issuers 7", ("COUNT_NOT_PARSED", None))])
def test_section_count(spark, html, want):
    got = spark.createDataFrame([(html,)], "html string").select(*[c.alias(n) for n, c in pages.section_count("html").items()]).first()
    assert (got["status"], got["issuer_count"]) == want


def test_delisting_table(spark):
    html = """<table><tr><td>Report</td></tr><tr><th>No</th><th>Kode</th><th>Stock Name</th><th>Delisting Date</th></tr>
    <tr><td>1</td><td> abcd </td><td>A &amp; B <i>Tbk</i></td><td>2020-05-06T00:00</td></tr><tr><td>2</td><td></td><td>x</td><td>01/02/2020</td></tr>
    <tr><td>3</td><td>efgh</td><td></td><td>7-Jan-20</td></tr><tr><td>4</td><td>ijkl</td><td>y</td><td>0001-01-01</td></tr></table>"""
    got = pages.delisting_table(spark.createDataFrame([("p", html)], "page_id string, html string")).orderBy("row_no").collect()
    assert [(r["symbol"], r["company_name"], r["delisting_date"]) for r in got] == [
        ("ABCD", "A & B Tbk", dt.date(2020, 5, 6)), ("EFGH", None, dt.date(2020, 1, 7))]


@pytest.mark.parametrize("text, want", [
    ("2021-03-04", dt.date(2021, 3, 4)), ("2021-03-04T10:00:00Z", dt.date(2021, 3, 4)), ("/Date(1614816000000)/", dt.date(2021, 3, 4)),
    ("04 Mar 2021", dt.date(2021, 3, 4)), ("4 March 2021", dt.date(2021, 3, 4)), ("04/03/2021", dt.date(2021, 3, 4)), ("soon", None), ("", None)])
def test_provider_dates(spark, text, want):
    assert one(spark, dates.provider_date(F.lit(text))) == want


@pytest.mark.parametrize("text, want", [
    ("31/02/1999", None), ("2/1/1999", dt.date(1999, 1, 2)), ("02-01-1999", dt.date(1999, 1, 2)), ("0001-01-01", None), ("7-Jan-20", dt.date(2020, 1, 7))])
def test_event_dates(spark, text, want):
    assert one(spark, dates.event_date(F.lit(text))) == want


def test_universe_date(spark):
    assert one(spark, dates.universe_date(F.lit("x_v1_current_20240131_eod"))) == dt.date(2024, 1, 31)
    assert one(spark, dates.universe_date(F.lit("x_current_20241331"))) is None


def holding_line(code, sec=1000, local=500, foreign=300, kind="EQUITY", day="31-JAN-2024", bad_total=0):
    def side(total):
        return [str(total)] + ["0"] * 8

    return "|".join([day, code, kind, str(sec), "10.5", *side(local), str(local + bad_total), *side(foreign), str(foreign)])


def test_holding_archives(spark, tmp_path):
    good = ["|".join(holdings.HEADER), holding_line("AADI"), holding_line("BOND1", kind="CORPORATE BOND"), holding_line("AALI", bad_total=1),
            holding_line("OVER", local=900, foreign=300), holding_line("LATE", day="29-FEB-2024"), "31-JAN-2024|XX|EQUITY|abc", holding_line("EMPT").replace("|1000|", "||")]
    with zipfile.ZipFile(tmp_path / "BalanceposEfek20240131.zip", "w") as z:
        z.writestr("Balancepos20240131.txt", "\r\n".join(good).encode("cp1252"))
    with zipfile.ZipFile(tmp_path / "BalanceposEfek20240229.zip", "w") as z:
        z.writestr("Balancepos20240228.txt", "\n".join(["wrong|header", holding_line("AADI", day="29-FEB-2024")]).encode("utf-8-sig"))
    with zipfile.ZipFile(tmp_path / "BalanceposEfek20240331.zip", "w") as z:
        z.writestr("readme.md", "x")
    lines = holdings.read_archives(spark, str(tmp_path))
    assert {r["archive"] for r in holdings.check_headers(lines).collect()} == {"BalanceposEfek20240229.zip", "BalanceposEfek20240331.zip"}
    rows = holdings.parse_lines(lines)
    got = {r["code"]: r["errors"] for r in rows.filter("archive like '%0131%'").collect()}
    assert got["AADI"] == [] and "BOND1" not in got
    assert got["AALI"] == ["Local category sum does not match Local Total."]
    assert got["OVER"] == ["Local + foreign holdings exceed total securities.", "scripless_pct outside 0-100."]
    assert got["LATE"] == ["Mixed snapshot dates in archive."] and got["XX"] == ["Unexpected column count."] and got["EMPT"] == ["Unreadable field."]
    identity = {r["archive"]: r["problem"] for r in holdings.archive_identity(rows).collect()}
    assert identity["BalanceposEfek20240131.zip"] is None and identity["BalanceposEfek20240229.zip"] == "file name and member dates differ"
    mapped, unmapped = holdings.snapshot_rows(rows, spark.createDataFrame([(7, "ZZZZ")], "instrument_id long, symbol string"))
    assert mapped.count() == 0 and [r["code"] for r in unmapped.collect()] == ["AADI"]
    mapped, _ = holdings.snapshot_rows(rows, spark.createDataFrame([(7, "AADI")], "instrument_id long, symbol string"))
    row = mapped.orderBy("as_of_date").first()
    assert (row["local_ownership_pct"], row["holder_details"]["foreign"]["total"]) == (50.0, 300)


def test_bar_payload_dates_and_guard(spark):
    late = int(dt.datetime(2024, 1, 2, 18, 0, tzinfo=dt.UTC).timestamp())
    body = ('{"symbol":"X","granularity":"1d","timestamp":[%d,%d],"open":[1,2],"high":[2,null],"low":[1,1],"close":[1.5,2],"volume":[1,null],"adjclose":[null,2]}'
            % (late, late + 86400))
    df = spark.createDataFrame([(body,)], "body string")
    first = bars.parse_bar_payloads(df).orderBy("bar_index").first()
    assert first["trading_date"] == dt.date(2024, 1, 2) and first["adjusted_close"] is None
    first = bars.parse_bar_payloads(df, index=True).orderBy("bar_index").first()
    assert first["trading_date"] == dt.date(2024, 1, 3) and first["adjusted_close"] == 1.5
    got = bars.payload_summary(bars.parse_bar_payloads(df)).first()
    assert (got["bars"], got["dropped_bars"], got["accepted"]) == (2, 1, True)
    weekly = df.select(F.replace("body", F.lit('"1d"'), F.lit('"1wk"')).alias("body"))
    assert not bars.payload_summary(bars.parse_bar_payloads(weekly)).first()["accepted"]


def test_profile_keys_and_rejections(spark):
    rows = [('{"KODEEMITEN":" abcd ","Name":" Foo ","Sektor":"Barang  Baku","Sector":""}',), ('{"code":"TOO-LONG","name":"x"}',), ('{"code":"OK","name":""}',),
            ('{"code":"NEW","name":"n","listing_date":"2030-01-01"}',)]
    df = profiles.validate_profiles(profiles.normalize_profiles(spark.createDataFrame(rows, "body string")), F.lit("2024-01-01").cast("date"))
    got = {r["symbol"]: (r["name"], r["sector_code"], r["reasons"]) for r in df.collect()}
    assert got["ABCD"] == ("Foo", "IDXBASIC", []) and got["TOO-LONG"][2] == ["Invalid symbol format."]
    assert got["OK"][2] == ["Company name is empty."] and got["NEW"][2] == ["Listing date is after snapshot date."]


def test_refresh_refuses_small_universe(spark):
    rows = spark.createDataFrame([('{"code":"A","name":"n"}', 1)], "body string, n int")
    accepted = profiles.accepted_profiles(profiles.normalize_profiles(rows), F.lit("2024-01-01").cast("date"), "n")
    with pytest.raises(ValueError, match="nothing written"):
        profiles.refresh_universe(accepted, accepted, F.lit("2024-01-01").cast("date"), 2)


@pytest.mark.parametrize("name, code", [("Papan Utama", "MAIN"), ("new-economy_board", "NEW_ECONOMY"), ("  Papan   Pemantauan Khusus ", "WATCHLIST"), ("x", "UNKNOWN"), (None, "UNKNOWN")])
def test_board_names(spark, name, code):
    assert spark.createDataFrame([(name,)], "b string").select(pit.board_code("b").alias("c")).first()["c"] == code


def test_seeded_rules(spark):
    d = dt.date(2025, 5, 1)
    rows = [(i, d, p, g) for i, (p, g) in enumerate([
        (199.0, "MAIN_DEV_NEW"), (200.0, "MAIN_DEV_NEW"), (200.5, "MAIN_DEV_NEW"), (5000.0, "MAIN_DEV_NEW"), (5001.0, "MAIN_DEV_NEW"), (49.0, "MAIN_DEV_NEW"),
        (10.0, "ACCEL_WATCH"), (10.5, "ACCEL_WATCH"), (100.0, "UNKNOWN")])] + [(99, dt.date(2010, 1, 1), 100.0, "MAIN_DEV_NEW")]
    df = spark.createDataFrame(rows, "i int, d date, p double, g string")
    seeds = rules.seed_rules(spark)
    ticks = {r["i"]: r["tick_size"] for r in rules.lookup(df, seeds, "TICK_SIZE", ["i"], "d", "p", values=["tick_size"]).collect()}
    assert ticks == {0: 1.0, 1: 2.0, 2: 2.0, 3: 25.0, 4: 25.0, 5: 1.0, 6: 1.0, 7: 1.0, 8: 1.0, 99: None}
    ara = {r["i"]: (r["ara_pct"], r["ara_absolute"]) for r in rules.lookup(
        df, seeds, "AUTO_REJECTION", ["i"], "d", "p", "g", ["ara_pct", "ara_absolute"]).collect()}
    assert ara == {0: (0.35, None), 1: (0.35, None), 2: (0.25, None), 3: (0.25, None), 4: (0.20, None), 5: (None, None), 6: (None, 1.0),
                   7: (0.10, None), 8: (None, None), 99: (None, None)}
    twice = seeds.unionByName(seeds)
    with pytest.raises(Exception, match="Ambiguous"):
        rules.require_unambiguous(rules.lookup(df, twice, "TICK_SIZE", ["i"], "d", "p", values=["tick_size"])).collect()


def test_availability(spark):
    rows = [("UNKNOWN", None), ("KNOWN", None), ("ESTIMATED", "2024-01-05"), ("KNOWN", "2024-01-05")]
    df = spark.createDataFrame(rows, "availability_status string, a string").select(
        "availability_status", F.col("a").cast("timestamp").alias("available_at"), F.lit(None).cast("timestamp").alias("published_at"),
        F.lit("2024-01-05").cast("date").alias("s"))
    got = [(r["reason"], r["ok"]) for r in pit.availability(df).withColumn("ok", pit.available_on("s")).collect()]
    assert got == [("AVAILABILITY_UNKNOWN", False), ("AVAILABLE_AT_MISSING", False), ("AVAILABILITY_ESTIMATED", False), ("KNOWN_AVAILABLE_AT", True)]
    with pytest.raises(Exception, match="before published_at"):
        pit.availability(df.withColumn("published_at", F.lit("2025-01-01").cast("timestamp"))).collect()


def test_merge_and_delete_tables(spark, ws, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([("m1", 1, "a"), ("m1", 2, "b"), ("m2", 1, "c")], "model_version string, k int, v string")
    sinks.replace_partitions(base, path, ["model_version"])
    fresh = spark.createDataFrame([("m1", 2, "B"), ("m1", 3, "d")], "model_version string, k int, v string")
    sinks.merge_table(spark, ws, path, fresh, ["model_version", "k"], ["model_version"])

    def read():
        return sorted((r["model_version"], r["k"], r["v"]) for r in spark.read.parquet(path).collect())

    assert read() == [("m1", 1, "a"), ("m1", 2, "B"), ("m1", 3, "d"), ("m2", 1, "c")]
    sinks.delete_rows(spark, ws, path, F.col("model_version") == "m1", ["model_version"])
    assert read() == [("m2", 1, "c")]
    sinks.append_log(base, str(tmp_path / "log"))
    sinks.append_log(fresh, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 5
    sinks.export_json(base, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 3
    typed = sinks.stored_types(spark.createDataFrame([(1.23456789,)], "p double"), {"p": sinks.PRICE})
    assert str(typed.first()["p"]) == "1.234568"


def test_pages_are_read_once_and_never_shuffled(spark, tmp_path):
    rows = [(1, "https://a.b/c", HTML), (2, "https://a.b/c", None), (3, "https://a.b/c", ""), (4, None, '<a href="/x.csv">'), (1, "https://a.b/c", HTML)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages")
    df = spark.read.parquet(f"{tmp_path}/pages")
    for frame in (pages.page_contracts(df, ["www.idx.id"]), pages.candidate_links(df)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Exchange" not in plan
    got = sorted((r["page_id"], r["candidate_url_count"], r["anchor_count"]) for r in pages.page_contracts(df, ["www.idx.id"]).collect())
    assert [g[1:] for g in got] == [(10, 3), (10, 3), (0, 0), (0, 0), (0, 1)]
    links = pages.candidate_links(df)
    assert links.columns == ["page_id", "url", "candidate"] and links.filter("page_id = 1").count() == 20


def test_performance_tables(spark, tmp_path):
    nested = """<table><tr><td>1</td><td>aaaa</td><td>A</td><td>2020-01-02</td></tr><tr><td>2</td><td>bbbb <TABLE class=in><tr><th>Listing Date</th><th colspan="2">Price</th>
    <th>Code</th><th>Company Name</th></tr><tr><td>03 Feb 2021</td><td>5</td><td>6</td><td>cccc</td><td>C &amp; Co</td></tr><tr><td>later</td><td>5</td><td>6</td><td>dddd</td><td></td></tr>
    </TABLE ></td><td>B</td><td>04/03/2022</td></tr><tr><td>x</td><td>eeee</td><td>E</td><td>2020-01-02</td></tr><tr><td>3</td><td>short</td><td>2020-01-02</td></tr></table>"""
    spark.createDataFrame([("p", nested), ("no", "<p>x</p>"), ("null", None), ("open", "<table><tr><td>1</td>"), ("empty", "")],
                          "page_id string, html string").write.parquet(f"{tmp_path}/pages")
    frame = pages.performance_table(spark.read.parquet(f"{tmp_path}/pages"))
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    got = sorted((r["page_id"], r["level"], r["symbol"], r["company_name"], r["listing_date"]) for r in frame.collect())
    assert got == [("p", 0, "CCCC", "C & Co", dt.date(2021, 2, 3)), ("p", 1, "AAAA", "A", dt.date(2020, 1, 2)), ("p", 1, "BBBB", "B", dt.date(2022, 3, 4))]
