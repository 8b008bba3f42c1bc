"""Host prediction by spacers and shared k-mers, one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.functions.exprs import part, reverse_complement, strand
from sequoir.operators.dataflow import residuals
from sequoir.operators.intervals import overlap_join
from sequoir.operators.rank import top1
from sequoir.operators.similarity import containment, kmers
from sequoir.operators.vote import consensus
from sequoir.sources.hits import accession


def crispr_host(spacers: DataFrame, hosts: DataFrame, most_mismatches: int = 1, least: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """(hits with their host's lineage, host of each target by consensus)."""
    near = spacers.where(F.col("N mismatches") <= most_mismatches).withColumn("Genome", part("Spacer id", ":", 0))
    hits = near.join(hosts, "Genome").select("Spacer id", "Genome", "Repr_taxonomy", "Target id", "Start", "End", "Strand", "N mismatches")
    return hits, _host(hits, least)


def _host(hits: DataFrame, least: float) -> DataFrame:
    return consensus(hits, "Target id", "Repr_taxonomy", least).withColumnsRenamed({"top_label": "top_taxonomy", "agreement": "species_agreement"})


def phist_host(matrix: DataFrame, hosts: DataFrame, least_containment: float = 0.2, least: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """(hits, host of each target) of a k-mer matrix (row: host genome, col: virus, value: containment)."""
    near = matrix.where(F.col("value") >= least_containment).select(F.col("col").alias("Target id"), accession("row").alias("Genome"), F.col("value").alias("Containment"))
    hits = near.join(hosts, "Genome")
    return hits, _host(hits, least)


def kmer_matrix(viruses: DataFrame, genomes: DataFrame, k: int = 25, least_shared: int = 20, least: float = 0.2, fraction: int = 1) -> DataFrame:
    """row, col, value: containment of viruses (id, seq) in host genomes (id, seq) by shared k-mers."""
    a = viruses.select(F.col("id").alias("col"), kmers("seq", k).alias("grams"))
    b = genomes.select(F.col("id").alias("row"), kmers("seq", k).alias("grams"))
    found = containment(a, b, "col", "row", "grams", least_shared, least, fraction)
    return found.select("row", "col", F.col("containment").alias("value"))


def spacer_hits(sam: DataFrame, masked: DataFrame, width: int = 1000) -> DataFrame:
    """Hits of an alignment in the form that crispr_host() reads, with flags.

    Of hits at one target, spacer, start and strand one stays, by the smallest
    CIGAR and sequence. flags: low_complexity where the hit overlaps any masked
    block, mismatches where it has over one.
    """
    rows = sam.select(
        F.col("spacer").alias("Spacer id"),
        F.col("target").alias("Target id"),
        F.col("start").alias("Start"),
        (F.col("start") + F.length("seq") - 1).alias("End"),
        strand("flag").alias("Strand"),
        F.get(F.array(F.col("tags")["NM"]), F.lit(0)).try_cast("int").alias("N mismatches"),
        F.col("cigar").alias("CIGAR"),
        F.coalesce(F.col("tags")["MD"], F.lit("NA")).alias("MD"),
        F.col("seq").alias("spacer"),
    )
    keys = ["Target id", "Spacer id", "Start", "Strand"]
    own = top1(rows, keys, [], ["CIGAR", "spacer", "MD", "N mismatches"])
    blocks = masked.withColumnRenamed("target", "Target id")
    low = overlap_join(own.select(*keys, "End"), blocks, ["Target id"], width, ("Start", "End")).select(*keys).distinct().withColumn("low", F.lit("low_complexity"))
    flagged = own.join(low, keys, "left")
    return flagged.withColumn("flags", F.concat_ws(";", "low", F.when(F.col("N mismatches") > 1, "mismatches"))).drop("low")


def oriented(hits: DataFrame) -> DataFrame:
    """spacer as it was before alignment: its reverse complement on the minus strand."""
    return hits.withColumn("spacer", F.when(F.col("Strand") == "-", reverse_complement("spacer")).otherwise(F.col("spacer")))


def cascade(sequences: DataFrame, phist: DataFrame, crispr: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sequences with the step that found a host, those that are left for the next predictor)."""
    of = lambda df: df.select(F.col("Target id").alias("id"))
    return residuals(sequences, "id", [("phist", of(phist)), ("crispr", of(crispr))])
