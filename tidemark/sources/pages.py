"""Landed web pages: links, endpoint classes, markers, table rows and counts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What makes a link a candidate.
KEYWORDS = ["listing", "listed", "delist", "relist", "download", "primary", "api", "statistic", "excel", "csv",
            "xlsx", "xls", "zip", "json"]
EXTENSIONS = [".csv", ".xlsx", ".xls", ".zip", ".json"]
# Header texts by meaning.
HEADERS = {
    "code": ["code", "kode", "kode emiten"],
    "company": ["company name", "stock name", "nama perusahaan", "nama emiten"],
    "listing": ["listing date", "tanggal pencatatan"],
    "delisting": ["delisting date", "tanggal delisting"],
}
LINK_ATTRIBUTES = {"a": "href", "script": "src", "form": "action"}
DATA_ATTRIBUTES = ["data-url", "data-api", "data-endpoint", "data-download", "data-source"]


# What counts as a reference in the text of a page.
ABSOLUTE_REFERENCE = r"(?i)https?://[^\s\"'<>]+"
QUOTED_PATH = r"[\"'](/[^\"'<>]{2,300})[\"']"

def unescape(text) -> Column:
    """The common character references; the ampersand last."""
    out = F.col(text) if isinstance(text, str) else text
    for code, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def markup(html: str) -> Column:
    """Page without comments and without the bodies of scripts and styles."""
    bare = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    bare = F.regexp_replace(bare, r"(?is)(<script\b[^>]*>).*?</script\s*>", "$1")
    return F.regexp_replace(bare, r"(?is)(<style\b[^>]*>).*?</style\s*>", "$1")


def visible_text(html: str) -> Column:
    spaced = F.regexp_replace(markup(html), r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(unescape(spaced), r"\s+", " "))


def attribute(tag, name: str) -> Column:
    """Attribute value, double-quoted, single-quoted or bare; NULL when absent or empty."""
    head = rf"(?is)[\s\"']{name}\s*=\s*"
    forms = [F.regexp_extract(tag, head + r"\"([^\"]*)\"", 1), F.regexp_extract(tag, head + r"'([^']*)'", 1),
             F.regexp_extract(tag, head + r"([^\s\"'>]+)", 1)]
    return unescape(F.coalesce(*[F.nullif(f, F.lit("")) for f in forms]))


def _segments(path: Column) -> Column:
    """Path with '.' and '..' resolved."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .when(s == ".", acc).otherwise(F.array_append(acc, s)))
    closed = F.when(F.regexp_like(path, F.lit(r"(^|/)\.\.?$")), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(kept, "/"), closed)


def clean_reference(value) -> Column:
    """A raw reference without quotes around and punctuation after it, NULL when nothing is left."""
    raw = F.rtrim(F.regexp_replace(F.regexp_replace(F.trim(value), r"^[\"']+|[\"']+$", ""), r"[),.;]+$", ""))
    return F.nullif(raw, F.lit(""))


def base_parts(base: str) -> Column:
    """What the links of a page are resolved against: scheme, site, document and folder."""
    page = F.col(base)
    site, document = F.regexp_extract(page, r"^(https?://[^/?#]+)", 1), F.regexp_extract(page, r"^(https?://[^?#]*)", 1)
    here = F.regexp_extract(F.substr(document, F.length(site) + 1), r"^(.*/)", 1)
    return F.struct(
        F.regexp_extract(page, r"^(https?):", 1).alias("scheme"), site.alias("site"), document.alias("document"),
        F.when(here == "", "/").otherwise(here).alias("folder"))


def absolute_url(page: Column, raw: Column) -> Column:
    """Absolute http(s) address of a cleaned reference, NULL for other schemes and fragments."""
    low = F.lower(raw)
    site = page["site"]
    path, rest = F.regexp_extract(raw, r"^([^?#]*)", 1), F.regexp_extract(raw, r"([?#].*)$", 1)
    return (
        F.when(F.regexp_like(low, F.lit(r"^(javascript|mailto|tel|data):")) | low.startswith("#"), None)
        .when(F.regexp_like(low, F.lit(r"^https?://[^/?#]+")), raw)
        .when(F.regexp_like(low, F.lit(r"^[a-z][a-z0-9+.-]*:")), None)
        .when(raw.startswith("//"), F.concat(page["scheme"], F.lit(":"), raw))
        .when(raw.startswith("/"), F.concat(site, _segments(path), rest))
        .when(raw.startswith("?"), F.concat(page["document"], raw))
        .when(raw.isNotNull(), F.concat(site, _segments(F.concat(page["folder"], path)), rest)))


def resolve_url(base: str, value) -> Column:
    """Absolute http(s) address of a link, NULL for other schemes and fragments."""
    return absolute_url(base_parts(base), clean_reference(value))


def is_candidate(url: Column, keywords: list[str] = KEYWORDS) -> Column:
    ends, words = "|".join(map(re.escape, EXTENSIONS)), "|".join(map(re.escape, keywords))
    return F.regexp_like(F.lower(url), F.lit(f"({ends})$" + (f"|{words}" if words else "")))


def references(html: str, clean: str) -> Column:
    """Raw references of a page: link attributes of its markup ``clean``, absolute addresses and quoted paths of its text."""

    def of_tag(tag: Column) -> Column:
        low = F.lower(tag)
        name = F.regexp_extract(low, r"^<([a-z][a-z0-9]*)", 1)
        found = [F.when(name == element, attribute(tag, attr)) for element, attr in LINK_ATTRIBUTES.items()]
        found += [F.when(F.contains(low, F.lit(attr)), attribute(tag, attr)) for attr in DATA_ATTRIBUTES]
        return F.array_compact(F.array(*found))

    tags = F.regexp_extract_all(clean, F.lit(r"(?is)<[a-z][^>]*=[^>]*>"), F.lit(0))
    return F.concat(
        F.flatten(F.transform(tags, of_tag)), F.regexp_extract_all(html, F.lit(ABSOLUTE_REFERENCE), F.lit(0)),
        F.regexp_extract_all(html, F.lit(QUOTED_PATH), F.lit(1)))


def with_candidates(pages: DataFrame, keywords: list[str] = KEYWORDS, base: str = "url", html: str = "html") -> DataFrame:
    """The pages with ``candidates``, the distinct candidate addresses of each, and ``_m``, the page's markup.

    One projection: the text is read once and nothing is shuffled. A page without text or links has an empty list.
    """
    raw = F.filter(F.transform(references(html, "_m"), clean_reference), lambda x: x.isNotNull())
    found = F.filter("_url", lambda u: u.isNotNull() & is_candidate(u, keywords))
    return (
        pages.withColumns({"_m": markup(html), "_page": base_parts(base)})
        .withColumn("_raw", F.array_distinct(raw))
        .withColumn("_url", F.transform("_raw", lambda x: absolute_url(F.col("_page"), x)))
        .withColumn("candidates", F.coalesce(F.array_distinct(found), F.array().cast("array<string>")))
        .drop("_page", "_raw", "_url"))


def candidate_links(pages: DataFrame, keywords: list[str] = KEYWORDS, base: str = "url", html: str = "html") -> DataFrame:
    """One row per page and distinct candidate address; a page that is there twice gives its rows twice."""
    kept = [c for c in pages.columns if c != html]
    return with_candidates(pages, keywords, base, html).select(*kept, F.explode("candidates").alias("candidate"))


def endpoint_classes(url, domains: list[str]) -> dict[str, Column]:
    address = F.col(url) if isinstance(url, str) else url
    low = F.lower(address)
    host = F.lower(F.regexp_extract(address, r"^https?://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return {
        "download_like": F.regexp_like(low, F.lit("|".join(map(re.escape, EXTENSIONS)))),
        "api_like": low.contains("/api/") | low.contains("api.") | low.contains("json"),
        "primary_like": low.contains("/primary/"), "source_domain": host.isin(domains)}


def page_contracts(pages: DataFrame, domains: list[str], keywords: list[str] = KEYWORDS) -> DataFrame:
    """Per page: element counts, body digest, candidate counts by class and parser status.

    All of it comes from one projection of the page's row; a page that is there twice gives two rows.
    """

    def elements(tag: str) -> Column:
        return F.coalesce(F.nullif(F.size(F.regexp_extract_all("_m", F.lit(rf"(?i)<{tag}\b"), F.lit(0))), F.lit(-1)), F.lit(0))

    def of_class(name: str) -> Column:
        return F.size(F.filter("candidates", lambda u: endpoint_classes(u, domains)[name])).cast("long").alias(name)

    counted = with_candidates(pages, keywords).select(
        "page_id", elements("a").alias("anchor_count"), elements("script").alias("script_count"),
        elements("form").alias("form_count"), F.sha2(F.encode("html", "UTF-8"), 256).alias("body_sha256"),
        F.octet_length("html").alias("body_length"), F.size("candidates").cast("long").alias("candidate_url_count"),
        *[of_class(name) for name in endpoint_classes("url", domains)])
    hit = (F.col("download_like") > 0) | (F.col("api_like") > 0) | (F.col("primary_like") > 0)
    return counted.withColumn("parser_status", F.when(hit, "CANDIDATE").otherwise("DISCOVERY"))


def marker_hits(pages: DataFrame, markers: list[str], minimum: int, html: str = "html") -> DataFrame:
    """Expected phrases found in a page, whatever the case, and whether enough were."""
    text = F.lower(F.trim(F.regexp_replace(html, r"\s+", " ")))
    wanted = F.array(*[F.lit(m) for m in markers])
    return pages.withColumn("_t", text).withColumns({
        "matched": F.array_join(F.filter(wanted, lambda m: F.contains(F.col("_t"), F.lower(m))), "|"),
        "marker_hits": F.size(F.filter(wanted, lambda m: F.contains(F.col("_t"), F.lower(m)))),
    }).withColumn("success", F.col("marker_hits") >= minimum).drop("_t", html)


def json_rows(payloads: DataFrame, body: str, path: str = "data") -> DataFrame:
    """Row count of a JSON list; unreadable text fails validation."""
    rows = F.size(F.from_json(F.get_json_object(body, f"$.{path}"), "array<string>"))
    count = F.when(rows >= 0, rows).otherwise(0)
    return payloads.withColumn("json_rows", count).withColumn("success", F.col("json_rows") > 0)


def section_count(html: str, marker: str = "Stock Delisting", stop: str = "rights announcement",
                  label: str = "Issuers", blank: str = "Volume", length: int = 500) -> dict[str, Column]:
    """Number after a label inside a section of the visible text, and how reading it went."""
    text = visible_text(html)
    at = F.instr(F.lower(text), marker.lower())
    section = F.substr(text, at, F.lit(length))
    end = F.instr(F.lower(section), stop.lower())
    section = F.when(end > 0, F.substr(section, F.lit(1), end - 1)).otherwise(section)
    number = F.regexp_extract(section, rf"(?i){label}\s+([0-9][0-9,]*)", 1)
    status = (
        F.when(at == 0, "SECTION_NOT_FOUND").when(number != "", "COUNT_PARSED")
        .when(F.regexp_like(section, F.lit(rf"(?i){label}\s+{blank}")), "EMPTY_FIELD").otherwise("COUNT_NOT_PARSED"))
    count = F.when((at > 0) & (number != ""), F.regexp_replace(number, ",", "").cast("long"))
    return {"status": status, "issuer_count": count}


def table_cells(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows of the page's tables as arrays of clean cell texts, in page order."""
    rows = F.regexp_extract_all("_m", F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))
    kept = [c for c in pages.columns if c != html]
    exploded = pages.withColumn("_m", markup(html)).select(*kept, F.posexplode(rows).alias("row_no", "_row"))
    cells = F.regexp_extract_all("_row", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), F.lit(1))
    clean = F.transform(cells, lambda c: F.trim(F.regexp_replace(unescape(F.regexp_replace(c, r"(?s)<[^>]*>", " ")), r"\s+", " ")))
    return exploded.withColumn("cells", clean).filter(F.size("cells") > 0).drop("_row")


def delisting_table(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(symbol, company, listing, delisting) rows below the first header that has code and delisting date."""
    from tidemark.functions.dates import event_date, event_symbol

    rows = table_cells(pages, html)
    plain = F.transform("cells", lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " ")))
    rows = rows.withColumn("_plain", plain)

    def position(meaning: str) -> Column:
        # the last matching column wins
        hits = F.transform("_plain", lambda c, i: F.when(c.isin(HEADERS[meaning]), i))
        return F.array_max(F.array_compact(hits))

    rows = rows.withColumns({f"_{m}": position(m) for m in HEADERS})
    heads = rows.filter("_code is not null and _delisting is not null").groupBy(key).agg(
        F.min_by(F.struct("row_no", *[f"_{m}" for m in HEADERS]), "row_no").alias("_h"))
    body = rows.drop(*[f"_{m}" for m in HEADERS]).join(heads, key).filter(F.col("row_no") > F.col("_h.row_no"))

    def cell(meaning: str) -> Column:
        return F.when(F.col(f"_h._{meaning}").isNotNull(), F.get("cells", F.col(f"_h._{meaning}")))

    return body.select(
        key, "row_no", event_symbol(cell("code")).alias("symbol"),
        F.nullif(F.trim(cell("company")), F.lit("")).alias("company_name"),
        event_date(cell("listing")).alias("listing_date"), event_date(cell("delisting")).alias("delisting_date"),
    ).filter("symbol is not null and delisting_date is not null")


def page_tables(pages: DataFrame, html: str = "html", depth: int = 3) -> DataFrame:
    """One row per table of a page with its ``grid`` of clean cell texts; a table inside a cell is a table of its own.

    Innermost tables are taken out first and leave their place blank, ``depth`` times, in projections that never shuffle;
    ``level`` 0 is the innermost. Cells are repeated by their column span. Row spans are not carried down. What lies
    deeper, or has no end tag, is left out.
    """
    kept = [c for c in pages.columns if c != html]

    def tagged(level: int) -> Column:
        return F.transform(f"_b{level}", lambda b, i: F.struct(F.lit(level).alias("level"), i.alias("table_no"), b.alias("body")))

    work = pages.withColumn("_m", markup(html))
    found = []
    for level in range(depth):
        work = work.withColumn("_p", F.split("_m", r"(?i)<table\b"))
        work = work.withColumn("_t", F.transform(F.expr("slice(_p, 2, size(_p))"), lambda x: F.split(x, r"(?i)</table\s*>", 2)))
        rest = F.transform("_t", lambda x: F.when(F.size(x) == 2, x[1]).otherwise(F.concat(F.lit("<table"), x[0])))
        work = work.withColumn(f"_b{level}", F.transform(F.filter("_t", lambda x: F.size(x) == 2), lambda x: x[0])).withColumn(
            "_m", F.concat(F.col("_p")[0], F.array_join(rest, " ")))
        found.append(tagged(level))
    bodies = work.select(*kept, F.explode(F.concat(*found)).alias("_b")).select(*kept, "_b.level", "_b.table_no", F.col("_b.body").alias("_body"))
    rows = F.regexp_extract_all("_body", F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))
    return bodies.withColumn("grid", F.filter(F.transform(rows, row_cells), lambda row: F.size(row) > 0)).drop("_body")


def row_cells(row: Column) -> Column:
    """Clean texts of a table row's cells, each as often as it spans columns (at most 1,000, as browsers do)."""
    shape = r"(?is)<t[dh]\b([^>]*)>(.*?)</t[dh]\s*>"

    def spread(marks: Column, body: Column) -> Column:
        span = F.coalesce(F.regexp_extract(marks, r"(?i)\bcolspan\s*=\s*[\"']?(\d+)", 1).try_cast("int"), F.lit(1))
        clean = F.trim(F.regexp_replace(unescape(F.regexp_replace(body, r"(?s)<[^>]*>", " ")), r"\s+", " "))
        return F.array_repeat(clean, F.greatest(F.lit(1), F.least(F.lit(1000), span)))

    return F.flatten(F.zip_with(F.regexp_extract_all(row, F.lit(shape), F.lit(1)), F.regexp_extract_all(row, F.lit(shape), F.lit(2)), spread))


def performance_table(pages: DataFrame, html: str = "html") -> DataFrame:
    """(symbol, company, listing date) rows of new-listing performance tables, each table read by itself.

    Below the first row whose texts mean code and listing date the columns are taken by meaning. A table without such
    a row is read by place: rows of four cells or more that begin with a number hold the symbol second, the company third and the
    date fourth. Rows without a symbol or a readable date are left out; no page is shuffled.
    """
    from tidemark.functions.dates import event_date, event_symbol

    def roles(row: Column) -> Column:
        plain = F.transform(row, lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " ")))

        def place(meaning: str) -> Column:  # the last matching column wins
            return F.array_max(F.array_compact(F.transform(plain, lambda c, i: F.when(c.isin(HEADERS[meaning]), i)))).alias(meaning)

        return F.struct(*map(place, ("code", "company", "listing")))

    tables = page_tables(pages, html).withColumn("_r", F.transform("grid", roles))
    first = F.array_min(F.array_compact(F.transform("_r", lambda h, i: F.when(h["code"].isNotNull() & h["listing"].isNotNull(), i))))
    kept = [c for c in tables.columns if c not in ("grid", "_r")]
    rows = tables.withColumn("_first", first).select(
        *kept, "_first", F.get("_r", F.col("_first")).alias("_h"), F.posexplode("grid").alias("row_no", "cells"))

    def cell(meaning: str, place: int) -> Column:
        by_meaning = F.when(F.col(f"_h.{meaning}").isNotNull(), F.get("cells", F.col(f"_h.{meaning}")))
        return F.when(F.col("_first").isNotNull(), by_meaning).otherwise(F.get("cells", F.lit(place)))

    numbered = (F.size("cells") >= 4) & F.regexp_like(F.get("cells", F.lit(0)), F.lit(r"^\d+$"))
    return rows.filter(F.when(F.col("_first").isNotNull(), F.col("row_no") > F.col("_first")).otherwise(numbered)).select(
        *kept, "row_no", event_symbol(cell("code", 1)).alias("symbol"), F.nullif(F.trim(cell("company", 2)), F.lit("")).alias("company_name"),
        event_date(cell("listing", 3)).alias("listing_date")).filter("symbol is not null and listing_date is not null")
