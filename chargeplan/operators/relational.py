"""Relational building blocks that Spark has no single operator for."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder (spark.checkpoint.dir). Only a local session may do without that setting."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        spark.sparkContext.setCheckpointDir(where or tempfile.mkdtemp(prefix="chargeplan-"))
    return df.checkpoint()


def _in_order(df: DataFrame, key: str) -> DataFrame:
    """df in as many ranges of key as there are shuffle partitions; _p is a row's range, _own its place there from 0.

    The checkpoint fixes the ranges, so that later reads agree on them.
    """
    df = checkpointed(df.repartitionByRange(F.col(key)).sortWithinPartitions(key))
    row = F.monotonically_increasing_id()
    return df.withColumn("_p", F.shiftright(row, 33)).withColumn("_own", row.bitwiseAND(F.lit((1 << 33) - 1)))


def _before(rows: DataFrame, value: Column, out: str) -> DataFrame:
    """Per range the sum of value over the ranges before: one row a shuffle partition."""
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy("_p").agg(F.sum(value).alias("_s")).select("_p", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias(out))


def dense_index(df: DataFrame, key: str, out: str = "idx", first: int = 0) -> DataFrame:
    """Number rows by a unique numeric key, without gaps: a sort by ranges, and the ranges' sizes added up."""
    rows = _in_order(df, key)
    return rows.join(F.broadcast(_before(rows, F.lit(1), "_first")), "_p").withColumn(out, (F.col("_own") + F.col("_first") + first).cast("long")).drop("_p", "_own", "_first")


def running(df: DataFrame, value: Column, key: str, out: str) -> DataFrame:
    """Running sum of value by a numeric key, inclusive, within ranges like dense_index."""
    rows = _in_order(df.withColumn("_value", value), key)
    own = F.sum("_value").over(Window.partitionBy("_p").orderBy("_own").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_sum", own).join(F.broadcast(_before(rows, F.col("_value"), "_first")), "_p").withColumn(out, F.col("_sum") + F.col("_first")).drop("_p", "_own", "_sum", "_first", "_value")


def weighted_pick(draws: DataFrame, sites: DataFrame, u: str, weight: str, key: str = "idx") -> DataFrame:
    """For each draw u in [0, 1) the site whose share of the running weights holds it.

    The range join is an equi-join: the unit interval is cut into as many cells as there are sites, a site stands in each cell
    that its interval touches, and a draw looks into its own cell. Rows made are twice the sites, whatever the weights.
    """
    ends = sites.where(F.col(weight) > 0).agg(F.sum(weight).alias("s"), F.count(F.lit(1)).alias("n")).first()
    cells, total = max(1, ends["n"]), F.lit(ends["s"])
    cum = running(sites.where(F.col(weight) > 0), F.col(weight), key, "_hi")
    cum = cum.withColumn("_lo", (F.col("_hi") - F.col(weight)) / total).withColumn("_hi", F.col("_hi") / total)
    cum = cum.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_lo") * cells), F.floor(F.least(F.col("_hi"), F.lit(1.0)) * cells))))
    draws = draws.withColumn("_cell", F.floor(F.col(u) * cells))
    return draws.join(cum, "_cell").where((F.col(u) >= F.col("_lo")) & (F.col(u) < F.col("_hi"))).drop("_cell", "_lo", "_hi")


def forward_fill(df: DataFrame, order: str, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Last known value in order. Without by this is one ordered time-line of bounded length (its steps), hence one task."""
    w = Window.partitionBy(*(by or [])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def prefix_to_target(df: DataFrame, value: str, key: str, target: Column | float) -> DataFrame:
    """Rows in order of key before the first whose running sum exceeds the target (values not negative)."""
    return running(df, F.col(value), key, "_cum").where(F.col("_cum") <= target).drop("_cum")


def min_max(df: DataFrame, value: str, out: str) -> DataFrame:
    """(v - min) / (max - min); 1 where all are equal."""
    ends = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return df.crossJoin(F.broadcast(ends)).withColumn(out, F.when(F.col("_hi") == F.col("_lo"), 1.0).otherwise((F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))).drop("_lo", "_hi")


def share(df: DataFrame, weight: str, out: str) -> DataFrame:
    total = df.agg(F.sum(weight).alias("_total"))
    return df.crossJoin(F.broadcast(total)).withColumn(out, F.col(weight) / F.col("_total")).drop("_total")


def index_aligned(a: DataFrame, b: DataFrame, index: str, value: str, op) -> DataFrame:
    """Arithmetic of two tables by row index; an index that one lacks gives null."""
    other = b.select(F.col(index), F.col(value).alias("_other"))
    return a.select(index, value).join(other, index, "full").select(index, op(F.col(value), F.col("_other")).alias(value))
