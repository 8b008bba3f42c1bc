"""Consensus of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def consensus(df: DataFrame, target: str, label: str, least: float = 0.7) -> DataFrame:
    """Per target: all votes, those of the leading label, that label and its share, if the share is `least` or more.

    Of labels with equally many votes the smallest leads; null counts as a
    label and loses ties. Two aggregates, both of which combine before they
    shuffle.
    """
    votes = df.groupBy(target, label).agg(F.count("*").alias("connections"))
    best = F.min(F.struct((-F.col("connections")).alias("n"), F.col(label).isNull().alias("none"), F.col(label).alias("label")))
    tally = votes.groupBy(target).agg(F.sum("connections").alias("total_connections"), F.max("connections").alias("max_connections"), best.alias("best"))
    shown = tally.select(target, "total_connections", "max_connections", F.col("best.label").alias("top_label"), (F.col("max_connections") / F.col("total_connections")).alias("agreement"))
    return shown.where(F.col("agreement") >= least)
