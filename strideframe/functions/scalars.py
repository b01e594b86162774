"""Text, map, JSON and interpolation scalars as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def dict_literal(text: Column) -> Column:
    """The first ``{'name': number, ...}`` in a text as map<string,double>; null if there is none."""
    found = F.regexp_extract(text, r"(\{[^{}]*\})", 1)
    return F.from_json(F.translate(F.nullif(found, F.lit("")), "'", '"'), "map<string,double>")


def path_segment(path: Column, i: int) -> Column:
    """The i-th part (from 0) between slashes; the empty text beyond the last."""
    return F.split_part(path, F.lit("/"), F.lit(i + 1))


def canonical_json(fields: dict[str, Column]) -> Column:
    """A JSON object with sorted keys, ``", "`` and ``": "`` between; null values stay as null. Values are texts, numbers or booleans."""
    value = lambda c: F.coalesce(F.regexp_replace(F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"}), r'^\{"v":(.*)\}$', "$1"), F.lit("null"))
    parts = [F.concat(F.lit(f'"{k}": '), value(fields[k])) for k in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def json_get(text: Column, path: str, default: Column, kind: str = "string") -> Column:
    """A value inside a JSON text; the default where the path, or the text, holds none."""
    return F.coalesce(F.get_json_object(text, path).cast(kind), default.cast(kind))


def merge_counts(a: Column, b: Column) -> Column:
    """Sum of two map<string,bigint> counters; a null map is empty."""
    none = F.create_map().cast("map<string,bigint>")
    return F.map_zip_with(F.coalesce(a, none), F.coalesce(b, none), lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def lookup(value: Column, names: dict[str, str], default: str) -> Column:
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, value), F.lit(default))


def violation(value: Column, low: float, high: float) -> Column:
    """Distance outside a band, 0 inside."""
    return F.greatest(F.lit(low) - value, value - F.lit(high), F.lit(0.0))


def interpolate(known: DataFrame, asked: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Linear interpolation of (at, value) at the asked places of each key; beyond the ends the end value holds.

    Both sides are merged in one order per key, so no place meets more than its two neighbours. Returns key, at, value.
    """
    rows = known.select(key, F.col(at).cast("double").alias(at), F.col(value).cast("double").alias(value), F.lit(0).alias("_ask"))
    both = rows.unionByName(asked.select(key, F.col(at).cast("double").alias(at), F.lit(None).cast("double").alias(value), F.lit(1).alias("_ask")))
    w = W.partitionBy(key).orderBy(at, "_ask")
    point = F.when(F.col("_ask") == 0, F.struct(F.col(at).alias("x"), F.col(value).alias("y")))
    both = both.withColumns({"_lo": F.last(point, True).over(w.rowsBetween(W.unboundedPreceding, 0)), "_hi": F.first(point, True).over(w.rowsBetween(0, W.unboundedFollowing))})
    width = F.col("_hi.x") - F.col("_lo.x")
    inside = F.col("_lo.y") + (F.col("_hi.y") - F.col("_lo.y")) * F.try_divide(F.col(at) - F.col("_lo.x"), F.nullif(width, F.lit(0.0)))
    return both.where("_ask = 1").select(key, at, F.coalesce(inside, "_lo.y", "_hi.y").alias(value))


def flatten(df: DataFrame, key: str, column: str) -> DataFrame:
    """key, label, value: one row per leaf of a nested struct, labels joined by dots, values as text; nulls stay."""

    def leaves(kind, path):
        for f in kind.fields:
            if isinstance(f.dataType, StructType):
                yield from leaves(f.dataType, [*path, f.name])
            else:
                yield [*path, f.name]

    found = leaves(df.schema[column].dataType, [])
    rows = [F.struct(F.lit(".".join(p)).alias("label"), F.col(".".join([column, *p])).cast("string").alias("value")) for p in found]
    return df.select(key, F.inline(F.array(*rows)))
