"""Deterministic choice, numbering and batching of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top1(df: DataFrame, keys: Sequence[str], order: Sequence[Column], ties: Sequence[str]) -> DataFrame:
    """The first row of each group; ties are broken by columns that make the order total.

    As a running rank with a limit, so that Spark keeps one row of a group in
    each task before it shuffles.
    """
    own = "_sequoir_rank"
    by = Window.partitionBy(*keys).orderBy(*order, *(F.col(t).asc_nulls_last() for t in ties))
    return df.withColumn(own, F.row_number().over(by)).where(F.col(own) == 1).drop(own)


def with_metrics(df: DataFrame, keys: Sequence[str], metrics: Sequence[Column]) -> DataFrame:
    """Every row with the metrics of its group, by an aggregate and a join, so that no group is held in one task."""
    return df.join(df.groupBy(*keys).agg(*metrics), list(keys))


def numbered(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Rows numbered without gaps in an order, by parts.

    Rows are dealt into ranges of the order and numbered within each; the sizes
    of the ranges before it are added. Only those sizes meet in one place, so
    no task sees all rows. The order must be total for a result that repeats.
    """
    ranged = df.repartitionByRange(*(F.col(c) for c in order)).withColumn("_sequoir_part", F.spark_partition_id())
    ranged = _settled(ranged)
    sizes = ranged.groupBy("_sequoir_part").agg(F.count("*").alias("_sequoir_n"))
    before = F.coalesce(F.sum("_sequoir_n").over(Window.orderBy("_sequoir_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_sequoir_part", before.alias("_sequoir_before"))
    within = F.row_number().over(Window.partitionBy("_sequoir_part").orderBy(*order))
    return ranged.withColumn("_sequoir_row", within).join(F.broadcast(starts), "_sequoir_part").withColumn(name, (F.col("_sequoir_row") + F.col("_sequoir_before") + (start - 1)).cast("long")).drop("_sequoir_part", "_sequoir_row", "_sequoir_before")


def _settled(df: DataFrame) -> DataFrame:
    """df computed once, so that both uses of its partition numbers see the same ranges."""
    from sequoir.operators.store import settled

    return settled(df)


def batches(df: DataFrame, order: Sequence[str], size: int, name: str = "batch") -> DataFrame:
    """Rows numbered and put into batches of `size`, from 0."""
    return numbered(df, order, "_sequoir_ordinal").withColumn(name, F.floor((F.col("_sequoir_ordinal") - 1) / size).cast("long")).drop("_sequoir_ordinal")
