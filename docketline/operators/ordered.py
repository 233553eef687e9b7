"""Ordered scans per key that never put a whole key into one task.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to
one task, so one book or watched path holding a third of all rows would run in
a single task. Both helpers here cut each key into bounded blocks, scan the
blocks in parallel, and add a carry computed over the small per-block summary
table (one row per block; a hot key has at most a few thousand blocks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketline.session import materialize

DEFAULT_BLOCK_ROWS = 1 << 16


def exclusive_running_sum(df: DataFrame, key: str, pos: str, value: str, out: str,
                          block_rows: int = DEFAULT_BLOCK_ROWS,
                          materialize_as: str | None = "running_sum") -> DataFrame:
    """``out`` = sum of ``value`` over the rows of the same ``key`` with a
    smaller ``pos`` (0 for the first row).

    ``pos`` must be unique within a key and roughly dense (an array position
    or a sequence id), so that a block ``pos div block_rows`` holds at most
    ``block_rows`` rows. One shuffle on (key, block). The windowed rows are
    written once (``materialize_as``) so that the block totals read three
    narrow columns instead of recomputing the input; Spark picks the join from
    the size of the per-block offsets.
    """
    blk = "_blk"
    d = df.withColumn(blk, F.floor(F.col(pos) / F.lit(block_rows)))
    w_in = (Window.partitionBy(key, blk).orderBy(pos)
            .rowsBetween(Window.unboundedPreceding, -1))
    local = d.withColumn("_local", F.coalesce(F.sum(value).over(w_in), F.lit(0)))
    if materialize_as:
        local = materialize(local, materialize_as)
    totals = local.groupBy(key, blk).agg(F.sum(value).alias("_tot"))
    w_blk = (Window.partitionBy(key).orderBy(blk)
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(key, blk,
                            F.coalesce(F.sum("_tot").over(w_blk), F.lit(0)).alias("_off"))
    return (_join_blocks(local, offsets, key, blk)
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop(blk, "_local", "_off"))


def _join_blocks(rows: DataFrame, blocks: DataFrame, key: str, blk: str) -> DataFrame:
    """Join per-block values back to the rows. Null-safe equality keeps rows
    with a NULL key and stops Spark from inferring IsNotNull filters on one
    side only, so both branches share one exchange of the input. Every row has
    its block: the join is an outer one so that the rows, whose files can be
    smaller than the decoded blocks, are never the side that is broadcast."""
    b = blocks.withColumnRenamed(key, "_bk").withColumnRenamed(blk, "_bb")
    cond = rows[key].eqNullSafe(b["_bk"]) & rows[blk].eqNullSafe(b["_bb"])
    return rows.join(b, cond, "left").drop("_bk", "_bb")


def previous_non_null(df: DataFrame, key: str, order: list[str], value: str,
                      out: str, first_flag: str | None = None,
                      n_blocks: int | None = None) -> DataFrame:
    """``out`` = last non-null ``value`` of an earlier row of the same key
    (rows ordered by ``order``), NULL if none. ``first_flag`` marks the first
    row of each key.

    Rows are range-partitioned on (key, order): Spark samples the boundaries,
    so a hot key is spread over many partitions, and the partition id is the
    block. The block id is written with the rows before both branches below
    read it: a second evaluation of the exchange could sample other boundaries
    and give other blocks.
    """
    spark = df.sparkSession
    n = n_blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blk = "_blk"
    ranged = materialize(df.repartitionByRange(n, key, *order).withColumn(blk, F.spark_partition_id()), "ranged")
    w_in = Window.partitionBy(key, blk).orderBy(*order)
    local = (ranged
             .withColumn("_prev_local",
                         F.last(value, ignorenulls=True).over(
                             w_in.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("_rn", F.row_number().over(w_in)))
    summary = (local.groupBy(key, blk)
               .agg(F.expr(f"max_by({value}, struct({', '.join(order)})) "
                           f"FILTER (WHERE {value} IS NOT NULL)").alias("_last")))
    w_blk = Window.partitionBy(key).orderBy(blk)
    carry = summary.select(
        key, blk,
        F.last("_last", ignorenulls=True).over(
            w_blk.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"),
        (F.row_number().over(w_blk) == 1).alias("_first_blk"))
    res = (_join_blocks(local, carry, key, blk)
           .withColumn(out, F.coalesce(F.col("_prev_local"), F.col("_carry"))))
    if first_flag:
        res = res.withColumn(first_flag, F.col("_first_blk") & (F.col("_rn") == 1))
    return res.drop(blk, "_prev_local", "_rn", "_carry", "_first_blk")
