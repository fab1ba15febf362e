"""Month-end holding archives: reading, parsing, validation and snapshots."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import reasons, rnd

# Investor categories and the exact header of the file.
CATEGORIES = ["IS", "CP", "PF", "IB", "ID", "MF", "SC", "FD", "OT"]
HEADER = ["Date", "Code", "Type", "Sec. Num", "Price", *[f"Local {c}" for c in CATEGORIES], "Total",
          *[f"Foreign {c}" for c in CATEGORIES], "Total"]
LINES = "archive string, member string, line_no int, line string, problem string"


def _decode(raw: bytes) -> str:
    for name in ("utf-8-sig", "utf-8", "cp1252", "latin-1"):
        try:
            return raw.decode(name)
        except UnicodeDecodeError:
            continue
    raise ValueError("undecodable text")


def _unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import io
    import zipfile

    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            name = path.rsplit("/", 1)[-1]
            with zipfile.ZipFile(io.BytesIO(content)) as bundle:
                wanted = [m for m in bundle.namelist() if not m.endswith("/")
                          and "balancepos" in m.lower() and m.lower().endswith(".txt")]
                if len(wanted) != 1:
                    yield pd.DataFrame([(name, None, 0, None, f"{len(wanted)} holding members")],
                                       columns=["archive", "member", "line_no", "line", "problem"])
                    continue
                lines = _decode(bundle.read(wanted[0])).splitlines()
            for start in range(0, len(lines), 20_000):
                part = lines[start:start + 20_000]
                yield pd.DataFrame({
                    "archive": name, "member": wanted[0], "line_no": range(start + 1, start + 1 + len(part)),
                    "line": part, "problem": None})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of every ZIP in a folder, one archive per task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return files.select("path", "content").mapInPandas(_unzip, LINES)


def check_headers(lines: DataFrame) -> DataFrame:
    """Archives whose first line is not the expected header, or that could not be opened."""
    split = F.transform(F.split("line", r"\|"), lambda c: F.trim(c))
    wrong = F.coalesce(split != F.array(*[F.lit(h) for h in HEADER]), F.lit(True))
    return lines.filter((F.col("line_no") == 1) & wrong | F.col("problem").isNotNull()).select(
        "archive", F.coalesce("problem", F.lit("Unexpected header layout.")).alias("problem"))


def parse_lines(lines: DataFrame, equity_only: bool = True) -> DataFrame:
    """Typed rows below the header with the list of errors; an empty list is a good row."""
    rows = lines.filter("line_no > 1 and line is not null and trim(line) <> ''").withColumn(
        "_c", F.transform(F.split("line", r"\|", -1), lambda c: F.trim(c)))
    if equity_only:
        rows = rows.filter((F.size("_c") < 3) | (F.upper(F.get("_c", F.lit(2))) == "EQUITY"))

    def cell(i: int) -> Column:
        return F.get("_c", F.lit(i))

    def block(start: int) -> Column:
        """The nine category cells of one side."""
        return F.transform(F.slice("_c", start + 1, len(CATEGORIES)), lambda c: c.try_cast("long"))

    wide = F.size("_c") == len(HEADER)
    day = F.when(F.regexp_like(cell(0), F.lit(r"^\d{1,2}-[A-Za-z]{3}-\d{4}$")), F.to_date(F.try_to_timestamp(cell(0), F.lit("d-MMM-yyyy"))))
    typed = rows.select(
        "archive", "member", "line_no", wide.alias("_wide"), day.alias("as_of_date"), F.upper(cell(1)).alias("code"),
        F.upper(cell(2)).alias("security_type"), cell(3).try_cast("long").alias("security_number"), cell(4).try_cast("double").alias("price"),
        F.when(wide, block(5)).alias("local"), cell(14).try_cast("long").alias("local_total"),
        F.when(wide, block(15)).alias("foreign"), cell(24).try_cast("long").alias("foreign_total"))
    readable = F.col("_wide") & ~F.exists("local", lambda v: v.isNull()) & ~F.exists("foreign", lambda v: v.isNull())
    for c in ("as_of_date", "security_number", "price", "local_total", "foreign_total"):
        readable = readable & F.col(c).isNotNull()
    typed = typed.withColumn("_readable", F.coalesce(readable, F.lit(False)))
    first = typed.filter("_readable").groupBy("archive").agg(F.min_by("as_of_date", "line_no").alias("_date"))
    typed = typed.join(first, "archive", "left").withColumns(percentages())
    mixed = F.col("as_of_date") != F.col("_date")
    errors = (
        F.when(~F.col("_wide"), F.array(F.lit("Unexpected column count.")))
        .when(~F.col("_readable"), F.array(F.lit("Unreadable field.")))
        .when(mixed, F.array(F.lit("Mixed snapshot dates in archive."))).otherwise(record_errors()))
    return typed.withColumn("errors", errors).drop("_wide", "_readable", "_date")


def percentages() -> dict[str, Column]:
    """Share of securities held locally, abroad and in total; 0 without securities."""
    base = F.col("security_number")

    def share(value: Column) -> Column:
        return F.when(base <= 0, F.lit(0.0)).otherwise(value / base * 100.0)

    both = F.col("local_total") + F.col("foreign_total")
    return {
        "scripless_total": both, "local_ownership_pct": share(F.col("local_total")),
        "foreign_ownership_pct": share(F.col("foreign_total")), "scripless_pct": share(both)}


def record_errors() -> Column:
    names = F.array(*[F.lit(c) for c in CATEGORIES])

    def negatives(side: str, label: str) -> Column:
        return F.array_compact(F.transform(side, lambda v, i: F.when(
            v < 0, F.concat(F.lit(f"{label} "), F.get(names, i), F.lit(" cannot be negative.")))))

    def total(side: str) -> Column:
        return F.aggregate(side, F.lit(0).cast("long"), lambda a, v: a + v)

    head = reasons(
        ("Empty security code.", F.col("code") == ""),
        ("Security number must be greater than zero.", F.col("security_number") <= 0),
        ("Price cannot be negative.", F.col("price") < 0))
    tail = reasons(
        ("Local total cannot be negative.", F.col("local_total") < 0),
        ("Foreign total cannot be negative.", F.col("foreign_total") < 0),
        ("Local category sum does not match Local Total.", total("local") != F.col("local_total")),
        ("Foreign category sum does not match Foreign Total.", total("foreign") != F.col("foreign_total")),
        ("Local + foreign holdings exceed total securities.", F.col("scripless_total") > F.col("security_number")),
        *[(f"{c} outside 0-100.", ~F.col(c).between(0.0, 100.0001))
          for c in ("local_ownership_pct", "foreign_ownership_pct", "scripless_pct")])
    return F.concat(head, negatives("local", "Local"), negatives("foreign", "Foreign"), tail)


def archive_identity(rows: DataFrame) -> DataFrame:
    """Per archive: file name date, member date and record date must be one; and dates unique."""
    good = rows.filter(F.size("errors") == 0).groupBy("archive", "member").agg(
        F.count_distinct("as_of_date").alias("record_dates"), F.min("as_of_date").alias("record_date"))
    every = rows.groupBy("archive", "member").agg(F.count(F.lit(1)).alias("rows")).join(good, ["archive", "member"], "left")

    def digits(c: str, shape: str) -> Column:
        text = F.regexp_extract(F.element_at(F.split(c, "/"), -1), shape, 1)
        return F.to_date(F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyyMMdd")))

    dated = every.withColumns({
        "archive_date": digits("archive", r"(?i)^BalanceposEfek(\d{8})\.zip$"),
        "member_date": digits("member", r"(?i)^Balancepos(\d{8})\.txt$")})
    problem = (
        F.when(F.col("record_dates").isNull(), "no valid records").when(F.col("record_dates") != 1, "multiple snapshot dates")
        .when(F.col("archive_date").isNull() | F.col("member_date").isNull(), "unexpected file name")
        .when(F.col("archive_date") != F.col("member_date"), "file name and member dates differ")
        .when(F.col("archive_date") != F.col("record_date"), "file name and record dates differ"))
    twice = dated.groupBy("archive_date").agg(F.count(F.lit(1)).alias("_n"))
    return dated.withColumn("problem", problem).join(twice, "archive_date", "left").withColumn(
        "problem", F.coalesce("problem", F.when(F.col("_n") > 1, "more than one archive for the date"))
    ).select("archive", "member", "rows", "record_date", "problem")


def snapshot_rows(rows: DataFrame, instruments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Snapshot rows of known symbols, and the unmapped codes."""
    good = rows.filter(F.size("errors") == 0)
    known = instruments.select(F.col("symbol").alias("code"), "instrument_id")

    def side(name: str) -> Column:
        return F.struct(*[F.get(name, F.lit(i)).alias(c) for i, c in enumerate(CATEGORIES)], F.col(f"{name}_total").alias("total"))

    details = F.struct(
        F.col("archive").alias("archive_name"), F.col("member").alias("member_name"), "security_type", "security_number", "price",
        side("local").alias("local"), side("foreign").alias("foreign"), "scripless_total")
    mapped = good.join(known, "code").select(
        "instrument_id", "code", "as_of_date", rnd("local_ownership_pct", 8).alias("local_ownership_pct"),
        rnd("foreign_ownership_pct", 8).alias("foreign_ownership_pct"), rnd("scripless_pct", 8).alias("scripless_pct"),
        details.alias("holder_details"))
    unmapped = good.select("code").distinct().join(known, "code", "left_anti")
    return mapped, unmapped
