"""Column order, unions of frames with different columns, flattening of nested records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytrace.schemas import OUTPUT_COLUMNS, TRAILING_COLUMNS


def reorder(df: DataFrame, order: Sequence[str] = OUTPUT_COLUMNS) -> DataFrame:
    """Known columns in the standard order, the others behind them."""
    known = [c for c in order if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


def published(tracked: DataFrame, *extra: str) -> DataFrame:
    """Key and published packet columns; everything used on the way is left out.

    Fails if a column is missing: packets are published whole.
    """
    named = tracked.withColumn("flightid", F.col("flight"))
    standard = [*OUTPUT_COLUMNS, *TRAILING_COLUMNS]
    if missing := [c for c in standard if c not in named.columns]:
        raise ValueError(f"columns missing from the packets: {missing}")
    return named.select("flight", *extra, *standard)


def diagonal_union(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns in the order first seen, null where a frame lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def flat_columns(df: DataFrame, map_keys: Mapping[str, Sequence[str]] | None = None,
                 ) -> dict[str, Column]:
    """Dotted name to expression: structs opened, arrays as JSON text, maps by the keys given.

    Empty arrays stay ``[]`` and fields inside arrays keep their order.
    """
    found: dict[str, Column] = {}

    def walk(name: str, value: Column, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                walk(f"{name}.{field.name}", value.getField(field.name), field.dataType)
        elif isinstance(kind, T.ArrayType):
            found[name] = F.to_json(value)
        elif isinstance(kind, T.MapType):
            for key in (map_keys or {}).get(name, ()):
                found[f"{name}.{key}"] = F.try_element_at(value, F.lit(key))
        else:
            found[name] = value

    for field in df.schema.fields:
        walk(field.name, F.col(f"`{field.name}`"), field.dataType)
    return found


def map_key_names(df: DataFrame, column: str) -> list[str]:
    """Every key in use in a map column, sorted: the union over all rows.

    One aggregate merges the keys of rows, then of tasks; only the union reaches the driver, as one
    schema with as many fields as there are columns afterwards.
    """
    keys = F.map_keys(F.col(f"`{column}`").cast("map<string,string>"))
    marks = F.map_from_arrays(keys, F.transform(keys, lambda k: F.lit(True)))
    found = df.agg(F.schema_of_variant_agg(F.to_variant_object(marks)).alias("found")).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return []
    kind = T.DataType.fromDDL(f"struct<{found[len('OBJECT<'):-1]}>")
    return sorted(f.name for f in kind.fields)


def flatten(df: DataFrame, map_keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One flat row per record with dotted, alphabetical column names."""
    if map_keys is None:
        map_keys = {
            f.name: map_key_names(df, f.name) for f in df.schema.fields
            if isinstance(f.dataType, T.MapType)
        }
    flat = flat_columns(df, map_keys)
    return df.select(*[flat[name].alias(name) for name in sorted(flat)])
