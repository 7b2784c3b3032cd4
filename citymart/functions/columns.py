"""Reusable column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Income bands, inclusive upper bounds on the income index.
INCOME_CUTS = (70, 85, 100, 120)
INCOME_LABELS = ("Q1_Lowest", "Q2_Low", "Q3_Medium", "Q4_High", "Q5_Highest")

# Market accessibility by number of listings.
MARKET_CUTS = (50, 100)
MARKET_LABELS = ("Low", "Medium", "High")

# Weights of the attractiveness score.
INCOME_WEIGHT = 0.3
DENSITY_WEIGHT = 0.3
CHEAPNESS_WEIGHT = 0.4


def band(value: Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first cut that ``value`` does not exceed, the last label beyond all cuts.

    NULL stays NULL.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("one more label than cuts is needed")
    if list(cuts) != sorted(cuts):
        raise ValueError("cuts must ascend")
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels):
        chain = chain.when(value <= cut, label)
    return chain.otherwise(labels[-1])


def income_band(index: Column) -> Column:
    return band(index, INCOME_CUTS, INCOME_LABELS)


def market_accessibility(listings: Column) -> Column:
    return band(listings, MARKET_CUTS, MARKET_LABELS)


def variation_pct(stddev: Column, mean: Column) -> Column:
    """Coefficient of variation in percent; NULL where the mean is zero."""
    return F.round(F.try_divide(stddev, mean) * 100, 2)


def per_thousand(amount: Column, population: Column) -> Column:
    """Amount per 1000 residents; NULL without a population."""
    return F.round(F.try_divide(amount, population) * 1000, 2)


def per_thousand_or_zero(amount: Column, population: Column) -> Column:
    """As :func:`per_thousand`, with 0.0 for an unknown or non-positive population."""
    return F.when(population > 0, per_thousand(amount, population)).otherwise(F.lit(0.0))


def affordability(median_price: Column, income_index: Column) -> Column:
    """Median price over a thousand income index points; lower is more affordable."""
    return F.round(F.try_divide(median_price, income_index * 1000), 2)


def attractiveness(income_index: Column, density: Column, price_per_m2: Column) -> Column:
    """Weighted score: 30 % income, 30 % amenity density, 40 % cheapness. NULL if any part is."""
    cheapness = F.try_divide(F.lit(1000), price_per_m2) * 100
    return F.round(
        income_index * INCOME_WEIGHT + density * 10 * DENSITY_WEIGHT + cheapness * CHEAPNESS_WEIGHT, 2
    )


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, 0 for an empty whole."""
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def null_if_blank(value: Column, sentinel: str = "-") -> Column:
    """Text with the exact sentinel and the empty string turned into NULL."""
    text = value.cast("string")
    return F.when((text != "") & (text != sentinel), text)


def clean_number(value: Column, dtype: str, sentinel: str = "-") -> Column:
    """Number read from dirty text: sentinel, blank and unparsable text become NULL.

    A whole number may be written with a decimal point.
    """
    text = null_if_blank(value, sentinel)
    if dtype in ("int", "bigint"):
        return F.coalesce(text.try_cast(dtype), text.try_cast("double").try_cast(dtype))
    return text.try_cast(dtype)


def with_default(value: Column, default: object, dtype: str) -> Column:
    """``value`` in the wanted type, with the default for NULL and for what the type cannot hold."""
    return F.coalesce(value.try_cast(dtype), F.lit(default).cast(dtype))


def all_digits(value: Column) -> Column:
    return value.rlike(r"^\d+$")


def clip_text(value: Column, width: int = 20) -> Column:
    """The first ``width`` characters followed by an ellipsis, for previews."""
    return F.concat(F.substring(value.cast("string"), 1, width), F.lit("..."))


def matching_key(value: Column) -> Column:
    """Name folded for joining: surrounding blanks and letter case are ignored."""
    return F.lower(F.trim(value))
