"""Profiling and the checks a database would enforce as constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def null_counts(df: DataFrame) -> DataFrame:
    """One row with ``{column}_missing`` for every column."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}_missing") for c in df.columns])


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).filter("count > 1")


def primary_key_violations(df: DataFrame, key: str, table: str) -> DataFrame:
    """Values of ``key`` that are missing or repeated."""
    value = F.col(f"`{key}`").cast("string")
    counts = df.groupBy(value.alias("key_value")).agg(F.count("*").alias("count"))
    return counts.filter("count > 1 or key_value is null").select(
        F.lit(table).alias("table_name"), F.lit(key).alias("key_name"), "key_value", "count"
    )


def foreign_key_violations(
    child: DataFrame, parent: DataFrame, keys: Sequence[str], relation: str
) -> DataFrame:
    """Key values used by ``child`` that ``parent`` lacks, with the rows using them.

    A key with a missing value refers to nothing, as in a database, and is no violation.
    Children are counted per key before the join, so a hot key joins as one row.
    """
    used = child.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("rows"))
    orphans = used.join(parent.select(*keys), list(keys), "left_anti")
    values = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return orphans.select(F.lit(relation).alias("relation"), values.alias("key_value"), "rows")


def summary_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column."""
    measures = {
        "count": lambda c: F.count(c).cast("double"),
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    wide = df.agg(*[f(F.col(f"`{c}`")).alias(f"{c}|{name}") for c in columns for name, f in measures.items()])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}|{name}`").alias(name) for name in measures])
            for c in columns
        ]
    )
    return wide.select(F.inline(rows))
