"""Data quality: rows are split by reason codes, none is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.columns import record_hash


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """An array ``dq_reasons`` of the codes whose rule holds."""
    codes = F.array(*[F.when(test, F.lit(code)) for code, test in rules.items()])
    return df.withColumn("dq_reasons", F.filter(codes, lambda x: x.isNotNull()))


def split(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``(passed, failed)``; together they are the input."""
    coded = with_reasons(df, rules)
    return coded.where(F.size("dq_reasons") == 0).drop("dq_reasons"), coded.where(F.size("dq_reasons") > 0)


def dead_letters(failed: DataFrame, keys: list[str]) -> DataFrame:
    """Failed rows with an id from their keys and reasons, so that different failures stay apart."""
    return failed.withColumn("dlq_id", record_hash([*keys, F.array_join("dq_reasons", ",")]))
