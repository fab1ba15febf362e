"""Symbols and dates as event feeds write them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import col

# Accepted text dates, day first. Each goes with the shape it may have,
# because the parser would otherwise read a short year as a full one.
TEXT_DATES = [
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"), (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", "d-MMM-yy"),
]


def event_symbol(value) -> Column:
    return F.nullif(F.upper(F.trim(col(value))), F.lit(""))


def text_date(value, shapes=TEXT_DATES) -> Column:
    text = F.trim(col(value))
    return F.coalesce(*[
        F.when(F.regexp_like(text, F.lit(shape)), F.to_date(F.try_to_timestamp(text, F.lit(fmt)))) for shape, fmt in shapes])


def event_date(value) -> Column:
    """ISO prefix or one of the text forms; year 1 is a placeholder and gives NULL."""
    text = F.trim(col(value))
    iso = F.when(F.regexp_like(text, F.lit(r"^\d{4}-\d{2}-\d{2}")), F.to_date(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd"))))
    found = F.coalesce(iso, text_date(text))
    return F.when(F.year(found) != 1, found)


def provider_date(value) -> Column:
    """``/Date(ms)/`` in UTC, ISO with or without time, or a text form."""
    text = F.trim(col(value))
    millis = F.regexp_extract(text, r"^/Date\((-?\d+)", 1)
    epoch = F.when(millis != "", F.date_from_unix_date(F.floor(millis.try_cast("long") / 86400000).cast("int")))
    iso = F.when(F.regexp_like(text, F.lit(r"^\d{4}-\d{2}-\d{2}")), F.to_date(F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd"))))
    return F.coalesce(epoch, iso, text_date(text, [TEXT_DATES[2], TEXT_DATES[3], TEXT_DATES[0]]))


def universe_date(version) -> Column:
    """Universe date inside a model version, NULL when absent or not a date."""
    digits = F.regexp_extract(col(version), r"current_(\d{8})", 1)
    return F.to_date(F.try_to_timestamp(F.nullif(digits, F.lit("")), F.lit("yyyyMMdd")))


def model_version(prefix: str, snapshot: Column, suffix: str = "") -> Column:
    return F.concat(F.lit(f"{prefix}_current_"), F.date_format(snapshot, "yyyyMMdd"), F.lit(suffix))


def when_updated(*frames: DataFrame, column: str = "updated_at") -> bool:
    """Whether all inputs carry update times; without them the results carry none."""
    return all(column in df.columns for df in frames)


def newest_input(required: list[str], optional: list[str] = ()) -> Column:
    """Latest of several update times; optional ones count as the epoch when missing."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
    return F.greatest(*[F.col(c) for c in required], *[F.coalesce(F.col(c), epoch) for c in optional])
