"""Sinks beside keyed tables: metric tables, appended reports, fitted models."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_metric(df: DataFrame, folder: str, name: str, mode: str = "overwrite", by: list[str] | None = None) -> None:
    """A metric table below ``folder``, replaced or appended to; ``by`` splits it into folders. ``df`` must not read the table it replaces."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    df.write.mode(mode).partitionBy(*(by or [])).parquet(f"{folder.rstrip('/')}/{name}")


def append_json(df: DataFrame, folder: str) -> None:
    """Rows of a report as JSON lines beside earlier ones."""
    df.write.mode("append").json(folder)


def save_model(model, folder: str) -> None:
    """A fitted ``pyspark.ml`` model in place of an earlier one; its class's ``load`` reads it back."""
    model.write().overwrite().save(folder)
