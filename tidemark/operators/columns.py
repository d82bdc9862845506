"""Projections, typed contracts and record hashes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

META = ("_commit_time", "_commit_seqno", "_record_key")


def ensure_columns(df: DataFrame, wanted: dict[str, str], cast: bool = False) -> DataFrame:
    """Missing columns as typed nulls; with ``cast``, present ones in the wanted type (null where unreadable)."""
    new = {c: F.lit(None).cast(kind) for c, kind in wanted.items() if c not in df.columns}
    if cast:
        new |= {c: F.col(c).try_cast(kind) for c, kind in wanted.items() if c in df.columns}
    return df.withColumns(new) if new else df


def typed(df: DataFrame, contract: dict[str, tuple[str, str]]) -> DataFrame:
    """``{output: (input, type)}`` as one projection; unreadable values become null."""
    return df.select(*[F.col(source).try_cast(kind).alias(name) for name, (source, kind) in contract.items()])


def first_available(df: DataFrame, *names: str, kind: str | None = None) -> Column:
    """Coalesce of those columns that exist, whatever the case of their names; a null if none does."""
    have = {c.lower(): c for c in df.columns}
    found = [F.col(have[n.lower()]) for n in names if n.lower() in have]
    out = F.coalesce(*found) if found else F.lit(None)
    return out.cast(kind) if kind else out


def record_hash(columns: list[str | Column], separator: str = "||") -> Column:
    """SHA-256 over the text of columns, nulls as empty text."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(separator, *parts), 256)


def key_hash(columns: list[str | Column]) -> Column:
    """SHA-256 over the text of columns, each with its length in front and nulls apart: different keys never get the same text."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]), 256)


def drop_meta(df: DataFrame) -> DataFrame:
    return df.drop(*META)


def require_scalar(df: DataFrame) -> DataFrame:
    """``df``, or an error that names the columns which are not scalar."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    if nested:
        raise ValueError(f"not scalar: {', '.join(nested)}")
    return df


def clean_name(name: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"[^0-9A-Za-z_]", "_", name)).strip("_").lower() or "column"


def flatten(df: DataFrame) -> DataFrame:
    """Structs spread into columns ``outer_inner`` in one projection from the schema; arrays and maps serialised to JSON."""
    out: list[Column] = []
    used: set[str] = set()

    def walk(column: Column, kind: T.DataType, name: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(column[f.name], f.dataType, f"{name}_{f.name}" if name else f.name)
            return
        unique, k = clean_name(name), 2
        while unique in used:
            unique, k = f"{clean_name(name)}_{k}", k + 1
        used.add(unique)
        out.append((F.to_json(column) if isinstance(kind, (T.ArrayType, T.MapType)) else column).alias(unique))

    for f in df.schema.fields:
        walk(F.col(f"`{f.name}`"), f.dataType, f.name)
    return df.select(*out)


TENANT_COLUMNS = ("tenant_id", "tx_tenant_id", "tenantid")


def tenant_column(df: DataFrame, names=TENANT_COLUMNS) -> str:
    """The first tenant column there is; an error if there is none, so nothing is read unscoped."""
    for n in names:
        if n in df.columns:
            return n
    raise ValueError("no tenant column")


def for_tenant(df: DataFrame, tenant, names=TENANT_COLUMNS) -> DataFrame:
    """Rows of one tenant; the value is cast to the column's type, so files can be skipped."""
    name = tenant_column(df, names)
    return df.where(F.col(name) == F.lit(tenant).cast(df.schema[name].dataType))
