"""New identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.operators.rank import numbered


def rename(sequences: DataFrame, existing: int = 0, prefix: str = "SEQ-") -> tuple[DataFrame, DataFrame]:
    """(sequences under new ids, original_id with new_id): prefix and a number that goes on after `existing`, in the order of the old ids."""
    counted = numbered(sequences.select("id").distinct(), ["id"], "_n", existing + 1)
    mapping = counted.select(F.col("id").alias("original_id"), F.concat(F.lit(prefix), F.col("_n").cast("string")).alias("new_id"))
    named = sequences.join(mapping, sequences.id == mapping.original_id).select(F.col("new_id").alias("id"), *[c for c in sequences.columns if c != "id"])
    return named, mapping


def classify_rename(classified: DataFrame, mapping: DataFrame) -> DataFrame:
    """classified under new names, with the old one as original_id; rows without a new name are dropped."""
    return classified.withColumnRenamed("seq_name", "original_id").join(mapping, "original_id").withColumnRenamed("new_id", "seq_name")
