"""Lookups and keyed merges.

All the reference's joins are dictionary probes: equi joins whose build side
is "last value wins" per key. Here the build side is reduced to one row per
key first (a partial-aggregating ``max_by``), then joined. No side is broadcast by a
hint: Spark does so below its own byte threshold, at run time (AQE) from the
measured size, and splits skewed partitions of the shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def last_wins(df: DataFrame, keys: list[str], order: str | Column,
              values: list[str]) -> DataFrame:
    """One row per key holding the values of its last row by ``order``.

    ``max_by`` over a struct keeps a NULL value of the winning row (a null
    description stays null) and aggregates partially before the shuffle, so
    a hot key costs one partial row per task.
    """
    o = F.col(order) if isinstance(order, str) else order
    win = F.max_by(F.struct(*[F.col(v) for v in values]), o).alias("_w")
    return df.groupBy(*keys).agg(win).select(*keys, *[F.col(f"_w.{v}").alias(v) for v in values])


def lookup(df: DataFrame, table: DataFrame, left_key: str, right_key: str,
           value: str, out: str, default: Column) -> DataFrame:
    """Left lookup with a default on *no match* (a matched NULL stays NULL).
    ``table`` must already hold one row per key."""
    t = table.select(F.col(right_key).alias("_lk"), F.col(value).alias("_lv"),
                     F.lit(True).alias("_hit"))
    j = df.join(t, df[left_key] == t["_lk"], "left")
    return j.withColumn(out, F.when(F.col("_hit"), F.col("_lv")).otherwise(default)) \
        .drop("_lk", "_lv", "_hit")


def update_join(df: DataFrame, updates: DataFrame, keys: list[str], target: str,
                value: str) -> DataFrame:
    """``target := value`` where a row of ``updates`` matches (even when the
    value is NULL or ''), else unchanged. ``updates`` holds one row per key."""
    u = updates.select(*keys, F.col(value).alias("_uv"), F.lit(True).alias("_hit"))
    j = df.join(u, keys, "left")
    return j.withColumn(target, F.when(F.col("_hit"), F.col("_uv")).otherwise(F.col(target))) \
        .withColumn("matched", F.coalesce(F.col("_hit"), F.lit(False))) \
        .drop("_uv", "_hit")


def unprocessed(todo: DataFrame, done: DataFrame, key: str = "ID") -> DataFrame:
    """Requested ids with no finished output (duplicates kept)."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def already_processed(todo: DataFrame, done: DataFrame, key: str = "ID") -> DataFrame:
    """Requested ids that already have output (logged as skipped)."""
    return todo.join(done.select(key).distinct(), key, "left_semi")


def missing_columns(df: DataFrame, required: set[str]) -> set[str]:
    return set(required) - set(df.columns)


def require_columns(df: DataFrame, required: set[str], what: str = "input") -> DataFrame:
    """Raise with the missing column names (the reference logs and skips)."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what} missing required columns: {sorted(missing)}")
    return df


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add a literal column only where it is absent (a present NULL stays
    NULL); decided on the schema, no data is read."""
    missing = {k: F.lit(v) for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(missing) if missing else df
