"""Lifestyle evidence of each sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.functions.exprs import genome_of


def lifestyle(classified: DataFrame, bacphlip: DataFrame, proteins: DataFrame, pharokka: DataFrame, phold: DataFrame, empathi: DataFrame, least: float = 0.9) -> DataFrame:
    """Sequences with a lifestyle prediction, and how many of their proteins speak of integration; null for none.

    Counts are of annotated proteins in each sequence, from two annotators and
    a classifier; proteins: protein_id, hash.
    """
    placed = proteins.select(F.col("hash").alias("cds_id"), genome_of("protein_id").alias("seq_name"))
    a = pharokka.select(F.col("ID").alias("cds_id"), "annot", "category")
    b = phold.select("cds_id", F.col("product").alias("annot"), F.col("function").alias("category"))
    named = a.unionByName(b).join(placed, "cds_id", "left")
    counted = lambda df, name: df.groupBy("seq_name").agg(F.count("*").alias(name))
    integrases = counted(named.where(F.col("annot").rlike("integrase|recombinase")), "phrog_integrases")
    excision = counted(named.where(F.col("category").contains("integration and excision")), "phrog_integration_excision")
    classed = counted(empathi.where(F.col("integration").cast("double") >= least).join(placed, "cds_id", "left"), "empathi_integration")
    own = classified.select("seq_name", "topology", "provirus").join(bacphlip, "seq_name")
    return own.join(integrases, "seq_name", "left").join(excision, "seq_name", "left").join(classed, "seq_name", "left")
