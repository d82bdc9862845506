"""Arrays, structs and JSON, all null-tolerant."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(a: Column) -> Column:
    """The array without null elements; null stays null."""
    return F.filter(a, lambda x: x.isNotNull())


def project(a: Column, field: str) -> Column:
    """One field of each non-null struct in an array."""
    return F.transform(present(a), lambda x: x[field])


def length_or_0(a: Column) -> Column:
    return F.coalesce(F.size(a), F.lit(0))


def flatten_present(a: Column) -> Column:
    """``flatten`` that skips null inner arrays instead of turning null."""
    return F.flatten(present(a))


def first_per_key(a: Column, key: str, kind: str) -> Column:
    """Structs of an array with the first of each key kept, in order; ``kind`` is the array's SQL type."""
    start = F.array().cast(kind)
    return F.aggregate(present(a), start, lambda acc, x: F.when(F.exists(acc, lambda y: y[key] == x[key]), acc).otherwise(F.array_append(acc, x)))


def first_where(a: Column, test: Callable[[Column], Column], take: Callable[[Column], Column]) -> Column:
    """``take`` of the first element that passes, or null."""
    return F.get(F.transform(F.filter(a, test), take), F.lit(0))


def total(a: Column) -> Column:
    """Sum of a numeric array as double, nulls as 0; 0 for null or empty."""
    return F.coalesce(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.coalesce(x.cast("double"), F.lit(0.0))), F.lit(0.0))


def nearest_rank(a: Column, p: float) -> Column:
    """Element ``ceil(n p)`` of the sorted array, 0.0 if there is none."""
    kept = F.array_sort(present(a))
    return F.coalesce(F.get(kept, (F.ceil(F.size(kept) * F.lit(p)) - 1).cast("int")).cast("double"), F.lit(0.0))


def arg_max(a: Column, value: str, key: str) -> Column:
    """The key of the struct with the largest value; ties: smallest key."""
    best = F.array_sort(F.transform(present(a), lambda x: F.struct((-x[value].cast("double")).alias("v"), x[key].alias("k"))))
    return F.get(best, F.lit(0))["k"]


def fan_out(df: DataFrame, structs: list[Column], alias: str = "entity", where: Callable[[Column], Column] | None = None) -> DataFrame:
    """A row per non-null struct of a list of struct columns, its fields spread out: one scan for many roles."""
    test = where or (lambda x: x.isNotNull())
    return df.select("*", F.explode(F.filter(F.array(*structs), lambda x: x.isNotNull() & test(x))).alias(alias)).select("*", f"{alias}.*").drop(alias)


def as_json_text(df: DataFrame, column: str) -> Column:
    """A column as JSON text, whatever generation of files it comes from: text stays, anything nested is serialised."""
    kind = df.schema[column].dataType
    return F.to_json(column) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else F.col(column).cast("string")


def json_first(column: str | Column, *paths: str) -> Column:
    """The first non-empty value among some JSON paths."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(*[F.nullif(F.get_json_object(c, p), F.lit("")) for p in paths])


def payload(df: DataFrame) -> Column:
    """The whole row as JSON."""
    return F.to_json(F.struct("*"))


def json_csv(c: Column) -> Column:
    """A JSON array of strings as a comma-separated list; null if there is none."""
    items = F.from_json(c, "array<string>")
    return F.when(length_or_0(items) > 0, F.array_join(items, ","))


def wide(a: Column, fields: list[str], prefix: str, count: int) -> list[Column]:
    """The first ``count`` structs of an array as numbered columns ``prefix_001_field``."""
    return [F.get(a, F.lit(i))[f].alias(f"{prefix}_{i + 1:03d}_{f}") for i in range(count) for f in fields]
