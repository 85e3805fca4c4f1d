"""Id expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_ids(expression: Column) -> Column:
    """`1,3-5,10` as a sorted array of distinct ids, ranges inclusive; null or empty: null (no filter)."""
    part = lambda p: F.when(
        F.contains(p, F.lit("-")),
        F.when(F.substring_index(p, "-", 1).cast("int") <= F.regexp_extract(p, r"-(.*)$", 1).cast("int"), F.sequence(F.substring_index(p, "-", 1).cast("int"), F.regexp_extract(p, r"-(.*)$", 1).cast("int"))).otherwise(F.array().cast("array<int>")),
    ).otherwise(F.array(F.when(~F.contains(p, F.lit("-")), p).cast("int")))
    all_parts = F.flatten(F.transform(F.split(expression, ","), lambda p: part(F.trim(p))))
    return F.when(F.coalesce(expression, F.lit("")) != "", F.array_sort(F.array_distinct(all_parts)))


def filter_ids(rows: DataFrame, ids: DataFrame | None, key: str = "id") -> DataFrame:
    """Rows whose key is among ids (one column of that name); None: all."""
    return rows if ids is None else rows.join(ids.select(key).distinct(), key, "left_semi")


def missing_ids(wanted: DataFrame, rows: DataFrame, key: str = "id") -> DataFrame:
    """Wanted ids that no row has; empty when a run may start."""
    return wanted.select(key).distinct().join(rows.select(key), key, "left_anti")


def same_ids(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """One row, same: whether both sides have the same set of ids."""
    apart = missing_ids(left, right, key).union(missing_ids(right, left, key))
    return apart.agg((F.count("*") == 0).alias("same"))
