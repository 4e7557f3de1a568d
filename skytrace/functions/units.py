"""Pound/kilogram and foot/metre pairs from the texts of the flight list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skytrace.functions.numeric import FEET_TO_METRES, POUNDS_TO_KG, round_half_away

# Fixed value: texts accepted as numbers (no blanks, no type suffix).
NUMBER = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)$"


def number(text: Column) -> Column:
    """A number written as text; 0 when it cannot be read."""
    return F.coalesce(F.when(text.rlike(NUMBER), text.try_cast("double")), F.lit(0.0))


def kilograms(pounds: Column) -> Column:
    return round_half_away(pounds * F.lit(POUNDS_TO_KG), 2)


def metres(feet: Column) -> Column:
    return round_half_away(feet * F.lit(FEET_TO_METRES), 2)


def weight_pairs(weights: Column) -> Column:
    """Map of name to text, expanded to ``{name}_lb`` and ``{name}_kg`` numbers."""
    pairs = F.transform(
        F.map_entries(weights),
        lambda entry: F.array(
            F.struct(F.concat(entry.key, F.lit("_lb")), number(entry.value)),
            F.struct(F.concat(entry.key, F.lit("_kg")), kilograms(number(entry.value))),
        ),
    )
    return F.map_from_entries(F.flatten(pairs))


def parachute(given: Column, weights: Column) -> Column:
    """Parachute with its size in both units and its weight, if the list names one."""
    size = number(given.getField("size"))
    pounds = F.when(
        F.map_contains_key(weights, "parachute"), number(F.try_element_at(weights, F.lit("parachute")))
    )
    return F.struct(
        given.getField("description").alias("description"),
        size.alias("size_ft"),
        metres(size).alias("size_m"),
        pounds.alias("weight_lb"),
        kilograms(pounds).alias("weight_kg"),
    )
