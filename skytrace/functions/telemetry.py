"""Values parsed out of the raw text of a radio packet."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text patterns and unit factors of the packet format.
CLOCK_DIGITS = "([0-9]{6})h"
TEMPERATURE = " (-?[0-9]{1,6})T-?[0-9]{1,6}P"
PRESSURE = "([0-9]{1,6})P"
PRESSURE_AFTER_TEMPERATURE = " -?[0-9]{1,6}T-?([0-9]{1,6})P"
BURST_REPORT = "(?i)DETECTED.*BURST|DETECTED COMMANDED RELEASE"
BURST_FEET = "(?i)([0-9]+)\\s*ft"
RELAY_EXCLUDED = "WA0GEH-10"
MILES_TO_KM = Decimal("1.609344")
FEET_TO_METRES = Decimal("0.3048")
PRESSURE_UNITS_PER_ATM = Decimal("10132.5")


def header(raw: Column) -> Column:
    """Text up to and including the first colon; empty without one."""
    return F.left(raw, F.position(F.lit(":"), raw))


def payload(raw: Column) -> Column:
    """Text after the first colon; the whole text without one."""
    return F.substr(raw, F.position(F.lit(":"), raw) + F.lit(1))


def packet_time(raw: Column, received: Column) -> Column:
    """Time stamped into the packet on the date of receipt, else the time of receipt.

    The digits are kept as written and the date is not rolled over at midnight. ``raw`` occurs once
    in the expression, so filters that Catalyst pushes down match the pattern once as well.
    """
    digits = F.regexp_extract(raw, CLOCK_DIGITS, 1)
    clock = F.regexp_replace(digits, "(..)(..)(..)", "$1:$2:$3")
    date = F.to_date(received).cast("string")
    # The fraction makes a date without clock digits no valid time.
    stamped = F.concat(date, F.lit(" "), clock, F.lit(".0")).try_cast("timestamp_ntz")
    return F.coalesce(stamped, received)


def _exact(value: Column) -> Column:
    return value.cast("decimal(20,8)")


def rounded(value: Column, places: int) -> Column:
    """Decimal rounding, then double."""
    return F.round(_exact(value), places).cast("double")


def kilometres(value: Column) -> Column:
    return F.round(_exact(value) * F.lit(MILES_TO_KM), 1).cast("double")


def metres(value: Column) -> Column:
    return F.round(_exact(value) * F.lit(FEET_TO_METRES), 2).cast("double")


def temperature_digits(raw: Column) -> Column:
    """Tenths of a degree Celsius as text, empty unless temperature and pressure are reported."""
    return F.regexp_extract(raw, TEMPERATURE, 1)


def pressure_digits(raw: Column, anchored: bool = False) -> Column:
    """Pressure as text: the leftmost digits before any P, even in the address part of the packet,
    or with ``anchored`` those that follow the temperature."""
    return F.regexp_extract(raw, PRESSURE_AFTER_TEMPERATURE if anchored else PRESSURE, 1)


def whole_number(digits: Column) -> Column:
    """Matched digits as a number, null for no match."""
    return F.when(digits != "", digits.cast("decimal(10,0)"))


def celsius(tenths: Column) -> Column:
    return F.round(tenths * F.lit(Decimal("0.1")), 2).cast("double")


def fahrenheit(tenths: Column) -> Column:
    return F.round(F.lit(Decimal("32.0")) + tenths * F.lit(Decimal("0.18")), 2).cast("double")


def kelvin(tenths: Column) -> Column:
    return F.round(F.lit(Decimal("273.15")) + tenths * F.lit(Decimal("0.1")), 2).cast("double")


def atmospheres(units: Column) -> Column:
    return F.round(units / F.lit(PRESSURE_UNITS_PER_ATM), 2).cast("double")


def pascals(units: Column) -> Column:
    return F.round(units * F.lit(Decimal("10.0")), 2).cast("double")


def burst_feet(raw: Column) -> Column:
    """Altitude in a burst or release report, null for any other text."""
    feet = F.regexp_extract(raw, BURST_FEET, 1).try_cast("bigint")
    return F.when(F.regexp_like(raw, F.lit(BURST_REPORT)), feet)
