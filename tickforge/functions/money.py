"""Money as column expressions: integer minor units (amount times 100), and the domain inside which amounts compare."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values: (code, ISO code, thousands separator, decimal separator) of known currencies.
CURRENCIES = (
    (1, "USD", ",", "."),
    (2, "GBP", ",", "."),
    (3, "EUR", ".", ","),
    (4, "CHF", ",", "."),
    (5, "RUB", ".", ","),
    (7, "BRL", ".", ","),
    (8, "JPY", ",", ""),
    (10, "IDR", " ", ""),
    (13, "SGD", ",", "."),
    (18, "UAH", " ", ""),
    (20, "CAD", ",", "."),
    (23, "CNY", ",", "."),
    (24, "INR", ",", "."),
)
#: Units of a currency for one US dollar.
RATES = (("EUR", 0.85609), ("IDR", 17797.0), ("SGD", 1.2722), ("USD", 1.0))


def money_domain(currency: Column, endpoint: Column) -> Column:
    """``currency:<code>`` where the currency is known, else ``endpoint:<name>``."""
    return F.coalesce(F.concat(F.lit("currency:"), currency.cast("string")), F.concat(F.lit("endpoint:"), endpoint))


def parse_price(text: Column, thousands: Column, decimal: Column, lenient: bool = False) -> Column:
    """Minor units of a localised price text; null if the currency (its thousands separator) is unknown or nothing parses.

    A currency without a decimal separator is taken as whole units, so a text that shows decimals all the same
    is read as if they were more digits; ``lenient`` takes one last group of one or two digits as decimals instead.
    """
    point = F.coalesce(decimal, F.lit(""))
    kept = F.regexp_replace(text, F.concat(F.lit("[^0-9"), thousands, point, F.lit("]")), F.lit(""))
    kept = F.replace(kept, thousands, F.lit(""))
    whole = kept.try_cast("bigint") * 100
    if lenient:
        parts = F.regexp_extract(text, r"^[^0-9]*([0-9][0-9., ]*?)[.,]([0-9]{1,2})[^0-9]*$", 1)
        cents = F.regexp_extract(text, r"^[^0-9]*[0-9][0-9., ]*?[.,]([0-9]{1,2})[^0-9]*$", 1)
        exact = F.concat(F.regexp_replace(parts, "[^0-9]", ""), F.lit("."), cents).try_cast("decimal(20,4)")
        whole = F.coalesce(F.round(exact * 100).cast("bigint"), whole)
    fraction = F.round(F.replace(kept, point, F.lit(".")).try_cast("decimal(20,4)") * 100).cast("bigint")
    return F.when(point == "", whole).otherwise(fraction)


def parse_volume(text: Column) -> Column:
    """The digits of a text as a number; null without any."""
    return F.regexp_replace(text, "[^0-9]", "").try_cast("bigint")


def to_usd(minor_units: Column, rate: Column) -> Column:
    """Minor units in US dollars; ``rate`` is units of the currency for one dollar."""
    return F.try_divide(minor_units.cast("double") / F.lit(100.0), rate)


def gap(value: Column, baseline: Column) -> tuple[Column, Column]:
    """Difference, and difference in percent of the baseline (null if that is null or 0)."""
    return value - baseline, F.try_divide(value - baseline, baseline) * 100
