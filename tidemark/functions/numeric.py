"""Small numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def rnd(value, digits: int) -> Column:
    """Decimal rounding of the exact value of the double, exact ties to even.

    The product with the power of ten is itself rounded, and may land on a half that the
    exact product misses. There the sign of the product's error decides: the value is split in a
    float and the rest, whose products with a power of ten (up to the tenth, 24 bits) are exact.
    ``round``/``bround`` go through the decimal text of the double instead. The added zero turns
    -0.0 into 0.0.
    """
    x, scale = col(value).cast("double"), F.lit(float(10**digits))
    product, upper = x * scale, x.cast("float").cast("double")
    error = (upper * scale - product) + (x - upper) * scale
    nudge = F.when(product - F.floor(product) == 0.5, F.signum(error) * 0.25).otherwise(0.0)
    return F.when(F.abs(product) >= F.lit(2.0**52), x).otherwise(F.rint(product + nudge) / scale) + F.lit(0.0)


def with_rounded(df: DataFrame, columns: dict[str, tuple[Column, int]]) -> DataFrame:
    """Add columns rounded to so many decimals. ``rnd`` names its value many times, so the value is projected before: it is evaluated once."""
    raw = df.withColumns({f"_raw_{name}": value for name, (value, _) in columns.items()})
    return raw.withColumns({name: rnd(f"_raw_{name}", digits) for name, (_, digits) in columns.items()}).drop(
        *[f"_raw_{name}" for name in columns])


def clamp(value, low: float = 0.0, high: float = 100.0) -> Column:
    """NULL stays NULL, although greatest/least skip NULL."""
    value = col(value)
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def interpolate(value, x0: float, y0: float, x1: float, y1: float) -> Column:
    if x1 == x0:
        return F.lit(y0)
    return F.lit(y0) + (col(value) - F.lit(x0)) / F.lit(x1 - x0) * F.lit(y1 - y0)


def piecewise(value, knots: list[tuple[float, float]]) -> Column:
    """Linear between knots, constant outside them."""
    value = col(value)
    out = F.when(value <= knots[0][0], F.lit(knots[0][1]))
    for (x0, y0), (x1, y1) in zip(knots, knots[1:]):
        out = out.when(value <= x1, interpolate(value, x0, y0, x1, y1))
    return out.when(value.isNotNull(), F.lit(knots[-1][1]))


def balance(positive, negative, total=None, empty: float = 0.0) -> Column:
    """(positive - negative) / total, with a neutral value for no population."""
    positive, negative = col(positive), col(negative)
    total = positive + negative if total is None else col(total)
    return F.when(total <= 0, F.lit(empty)).otherwise((positive - negative) / total)


def ladder(value, steps: list[tuple[float, str]], last, strict: bool = True) -> Column:
    """First label whose upper bound exceeds the value; NULL gives NULL."""
    value = col(value)
    out = None
    for bound, label in steps:
        test = value < bound if strict else value <= bound
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.when(value.isNotNull(), F.lit(last))


def at_least(value, steps: list[tuple[float, str]], last) -> Column:
    """First label whose lower bound is reached; NULL gives NULL."""
    value = col(value)
    out = None
    for bound, label in steps:
        test = value >= bound
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.when(value.isNotNull(), F.lit(last))


def reasons(*pairs) -> Column:
    """Array of the codes whose condition is true, in the given order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(code)) for code, cond in pairs]))


def none_of(*pairs) -> Column:
    """Whether ``reasons`` of the same pairs is empty, as plain comparisons: a list per row only to count it costs far more."""
    out = F.lit(True)
    for _, cond in pairs:
        out = out & ~F.coalesce(cond, F.lit(False))
    return out


def profit_factor(value) -> Column:
    """Sum of gains over absolute sum of losses, summed exactly at 8 decimals; NULL without losses."""
    value = col(value)
    exact = value.cast("decimal(28,8)")
    gain = F.coalesce(F.sum(F.when(exact > 0, exact)).cast("double"), F.lit(0.0))
    loss = F.abs(F.sum(F.when(exact < 0, exact)).cast("double"))
    return F.when(loss > 0, rnd(gain / loss, 8))


def mean(value, digits: int = 8) -> Column:
    """Average of values that carry ``digits`` decimals, summed exactly.

    A decimal sum does not depend on the order partitions arrive in, so a rerun
    gives the same bits.
    """
    exact = col(value).cast(f"decimal(28,{digits})")
    return F.sum(exact).cast("double") / F.count(exact)


def written_as(text: Column, names: dict[str, list[str]]) -> Column:
    """Code whose list of spellings holds the text, NULL for none; one map lookup."""
    pairs = [F.lit(x) for code, spellings in names.items() for name in spellings for x in (name, code)]
    return F.try_element_at(F.create_map(*pairs), text)
