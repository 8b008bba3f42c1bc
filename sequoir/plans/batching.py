"""Work items by source, in batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.operators.rank import numbered

#: How many times the base size a batch of a source has; others have it once.
FACTORS = {"ATB": 10, "ENA": 10, "LOGAN": 5}


def source_batches(items: DataFrame, size: int = 1000, factors: Mapping[str, int] = FACTORS) -> DataFrame:
    """id, source_db, batch, urls: items (sample, source_db, fna) with a url, in batches of their source, by sample."""
    known = items.where(F.col("fna").isNotNull() & F.col("source_db").isNotNull()).select("source_db", "sample", "fna")
    listed = numbered(known, ["source_db", "sample", "fna"], "ordinal")
    first = listed.groupBy("source_db").agg(F.min("ordinal").alias("first"))
    own = F.lit(size)
    for source, factor in factors.items():
        own = F.when(F.col("source_db") == source, size * factor).otherwise(own)
    dealt = listed.join(first, "source_db").withColumn("batch", F.floor((F.col("ordinal") - F.col("first")) / own).cast("long"))
    lists = dealt.groupBy("source_db", "batch").agg(F.sort_array(F.collect_list(F.struct("sample", "fna"))).alias("urls"))
    return lists.select(F.concat_ws("_", "source_db", F.col("batch").cast("string")).alias("id"), "source_db", "batch", "urls")
