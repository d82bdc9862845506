"""JSON in string columns, opened into typed columns without a declared schema.

A pass parses every string column as a variant and merges the schemas of what
it finds, before the shuffle, into one schema a column: a few hundred
characters reach the driver. Columns whose values are all objects are then parsed with that schema
and flattened; arrays inside become JSON text, as everywhere in :func:`flatten`. Strings inside are strings again and
may hold JSON themselves: the passes go on, one a level of nesting.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.columns import flatten

#: Levels of JSON inside strings inside JSON that are opened, at most.
MOST_LEVELS = 5


def declared(schema: str) -> str:
    """A variant's schema as one that ``from_json`` takes: objects are structs; what has no type, or several, is text."""
    schema = re.sub(r"\bOBJECT<", "STRUCT<", schema)
    return re.sub(r"\b(VOID|VARIANT)\b", "STRING", schema)


def schemas(df: DataFrame, skip: tuple[str, ...] = ()) -> dict[str, str]:
    """The merged schema of each string column all of whose values, one at least, are JSON objects."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]
    if not texts:
        return {}
    aggregates = []
    for i, name in enumerate(texts):
        c = df[name]
        opens = F.coalesce(F.regexp_like(c, F.lit(r"^\s*\{")), F.lit(False))  # numbers and words are JSON, too, but stay text
        v = F.when(opens, F.try_parse_json(c))
        aggregates += [F.count(c).alias(f"n{i}"), F.count(v).alias(f"j{i}"), F.schema_of_variant_agg(v).alias(f"s{i}")]
    found = df.agg(*aggregates).first()
    out = {}
    for i, name in enumerate(texts):
        if found[f"n{i}"] and found[f"n{i}"] == found[f"j{i}"] and re.match(r"OBJECT<[\w`]", found[f"s{i}"]):
            out[name] = declared(found[f"s{i}"])
    return out


def open_json_strings(df: DataFrame, keep_text: bool = False, levels: int = MOST_LEVELS, skip: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with objects in strings opened as ``name_field`` columns, level by level.

    ``keep_text`` keeps the strings as ``name_json``; columns in ``skip`` are left alone. A column with a value that is no JSON
    object stays as it is, as does an object without fields.
    """
    df, kept = flatten(df), list(skip)
    for _ in range(levels):
        found = schemas(df, tuple(kept))
        if not found:
            break
        if keep_text:
            df = df.withColumns({f"{c}_json": F.col(c) for c in found})
            kept += [f"{c}_json" for c in found]
        df = flatten(df.withColumns({c: F.from_json(F.col(c), s) for c, s in found.items()}))
    return df
