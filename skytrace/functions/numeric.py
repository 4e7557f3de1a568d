"""Arithmetic on columns. Everything stays inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results must agree with published figures that use these constants.
MILES_TO_KM = 1.609344
FEET_TO_METRES = 0.3048
POUNDS_TO_KG = 0.4535924
EARTH_RADIUS_MILES = 3956.0
DRY_AIR_GAS_CONSTANT = 287.05
KGM3_PER_SLUGFT3 = 515.3788199999872
NEAR_ZERO = 1e-10


# Largest double below one half: adding it and cutting rounds ties up and never anything else.
ALMOST_HALF = 0.49999999999999994


def round_half_away(value: Column, places: int) -> Column:
    """Round the scaled binary value, ties away from zero. Values of 2**52 units and more, which have
    no such decimals, infinities and NaN stay as they are.

    ``F.round`` works on the shortest decimal text of the double, which differs on ties and
    allocates a BigDecimal per value.
    """
    factor = F.lit(float(10**places))
    size = F.abs(value) * factor
    units = F.floor(size + F.lit(ALMOST_HALF))
    return F.when(size < F.lit(2.0**52), F.signum(value) * units / factor + F.lit(0.0)).otherwise(
        value)


def scaled(value: Column, places: int) -> Column:
    """``value`` in units of ``10**-places``, without the noise of its binary form.

    A value with no more than ``places`` decimals gives a whole number; others keep their fraction.
    """
    units = value * F.lit(float(10**places))
    whole = F.rint(units)
    return F.when(F.abs(units - whole) <= F.abs(units) * F.lit(4e-16), whole).otherwise(units)


def has_places(value: Column, places: int) -> Column:
    """Whether a value is a whole number of units that a double holds exactly."""
    units = scaled(value, places)
    return (F.abs(units) < F.lit(2.0**53)) & (units == F.rint(units))


def ticks(value: Column, places: int) -> Column:
    """``value`` as a 38-digit whole number of units; null where it is none."""
    return F.when(has_places(value, places),
                  scaled(value, places).cast("bigint")).cast("decimal(38,0)")


def exactly_summed(n: Column, all_whole: Column, largest: Column) -> Column:
    """Whether the sums of a whole series, and of its squares, fit exact arithmetic.

    Decided for a series, never for a row, so one series has one formula.
    """
    return F.coalesce(all_whole & (largest * n.cast("double") < F.lit(3e18)), F.lit(False))


def mean_from_sums(n: Column, total: Column, places: int) -> Column:
    """Mean of values counted in ticks."""
    return total.cast("double") / n.cast("double") / F.lit(float(10**places))


def variance_from_sums(n: Column, total: Column, squares: Column, places: int) -> Column:
    """Sample variance of values counted in ticks; null below two values.

    The numerator is formed exactly, so nothing cancels.
    """
    count = n.cast("decimal(38,0)")
    exact = F.try_subtract(F.try_multiply(count, squares), F.try_multiply(total, total))
    pairs = n.cast("double") * (n.cast("double") - F.lit(1.0))
    return F.when(n > 1, exact.cast("double") / pairs / F.lit(float(10 ** (2 * places))))


def variance_to_mean(variance: Column, mean: Column) -> Column:
    """Variance-to-mean ratio, 0 where the mean vanishes."""
    return F.when(F.abs(mean) > NEAR_ZERO, variance / mean).otherwise(F.lit(0.0))


def fit_degree(vmr: Column, max_degree: int = 13) -> Column:
    """Polynomial degree for a variance-to-mean ratio: the steadier the series, the higher."""
    top = float(max_degree)
    degree = (
        F.when(vmr.isNull() | F.isnan(vmr), F.lit(max_degree))
        .when(vmr > 1.75, ((F.lit(top) + vmr) / vmr).cast("int"))
        .when(vmr >= 1.0, (F.lit(top) / vmr).cast("int"))
        .otherwise(F.lit(max_degree))
    )
    return F.greatest(degree, F.lit(1))


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in miles."""
    a, b = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((b - a) / 2.0)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2.0)
    chord = half_lat * half_lat + F.cos(a) * F.cos(b) * half_lon * half_lon
    return F.lit(2.0) * F.asin(F.sqrt(chord)) * F.lit(EARTH_RADIUS_MILES)


def line_distance(x: Column, y: Column, slope: Column, intercept: Column) -> Column:
    """Signed distance of a point from a line; positive when the point lies below it."""
    return (slope * x - y + intercept) / F.sqrt(slope * slope + F.lit(1.0))


def air_density_kgm3(pressure_pa: Column, temperature_k: Column) -> Column:
    """Dry-air density, null unless the temperature is positive."""
    return F.when(
        temperature_k > 0, pressure_pa / (F.lit(DRY_AIR_GAS_CONSTANT) * temperature_k)
    )


def air_density_slugs(pressure_pa: Column, temperature_k: Column) -> Column:
    """Dry-air density in slugs per cubic foot."""
    return air_density_kgm3(pressure_pa, temperature_k) / F.lit(KGM3_PER_SLUGFT3)
