"""Which sequences are viral, of high quality, or worth a second look."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sequoir.config import Thresholds
from sequoir.functions.exprs import count_true, family_of, flag, genome_of, not_contains_or_null, overlaps, strip_provirus, sum_flags
from sequoir.operators.rank import top1

#: The flags whose sum classifies a sequence.
FLAGS = (
    "genomad_virus_score_95",
    "viralverify_virus_score_15",
    "virus_hallmarks_gt_3",
    "ictv_known_family",
    "zot_gene",
    "inoviridae_marker_genes_gt_5",
    "viralverify_chromosome_plasmid",
    "plasmid_hallmarks_gt_0",
    "conj_genes_gt_0",
    "marker_duplicity_penalty",
    "checkv_host_genes_gt_2",
)


def marker_duplicity(genes: DataFrame, na_is_marker: bool = True) -> DataFrame:
    """genome, total_markers, n_dup_markers, marker_duplicity of genes (gene, marker).

    duplicity is 1 + duplicated / all, and null, not 1, where none is
    duplicated. The text NA counts as a marker like any other unless
    na_is_marker is off.
    """
    own = genes.select(genome_of("gene").alias("genome"), "marker" if na_is_marker else F.nullif("marker", F.lit("NA")).alias("marker"))
    counted = own.groupBy("genome", "marker").agg(F.count("marker").alias("n"))
    tally = counted.groupBy("genome").agg(F.sum("n").alias("total_markers"), F.sum(F.when(F.col("n") > 1, 1)).alias("dup"))
    return tally.select("genome", "total_markers", F.coalesce("dup", F.lit(0)).cast("long").alias("n_dup_markers"), (1 + F.try_divide(F.col("dup"), F.col("total_markers"))).alias("marker_duplicity"))


def gene_counts(genes: DataFrame, conj_genes: Sequence[str], zot_gene: str, na_is_marker: bool = True) -> DataFrame:
    """Per genome the counts of plasmid hallmarks, conjugation, toxin and Inoviridae genes, and the marker duplicity."""
    listed = genes.withColumns({"genome": genome_of("gene"), "accessions": F.split("annotation_accessions", ";")})
    counts = listed.groupBy("genome").agg(
        F.coalesce(F.sum("plasmid_hallmark"), F.lit(0)).alias("plasmid_hallmarks"),
        count_true(overlaps("accessions", conj_genes)).alias("conj_genes"),
        count_true(F.array_contains("accessions", zot_gene)).alias("zot_genes"),
        count_true(F.col("taxname").contains("Inoviridae")).alias("inoviridae_marker_genes"),
    )
    return counts.join(marker_duplicity(genes, na_is_marker), "genome", "left")


def dtr_override(quality: DataFrame, dtr: DataFrame, least: float = 80.0) -> DataFrame:
    """quality with completeness 100 and method DTR for the contigs in dtr (seq_name) that are complete to `least` or more."""
    known = dtr.select(F.col("seq_name").alias("contig_id")).distinct().withColumn("_dtr", F.lit(True))
    hit = F.coalesce("_dtr", F.lit(False)) & (F.col("completeness") >= least)
    both = quality.join(known, "contig_id", "left")
    return both.withColumns({"completeness": F.when(hit, 100.0).otherwise(F.col("completeness")), "completeness_method": F.when(hit, "DTR").otherwise(F.col("completeness_method"))}).drop("_dtr")


def score_flags(t: Thresholds = Thresholds()) -> dict[str, Column]:  # noqa: B008
    """The eleven flags. Ratios are written as products: a zero denominator passes, as an infinite ratio would."""
    c = F.col
    return {
        "genomad_virus_score_95": flag(c("virus_score") >= t.virus_score),
        "viralverify_virus_score_15": flag((c("Prediction") == "Virus") & (c("Score") >= t.verify_score)),
        "virus_hallmarks_gt_3": flag((c("n_hallmarks") >= t.hallmarks) | (c("viral_genes") >= t.hallmarks) & (c("viral_genes") >= 3 * c("host_genes"))),
        "ictv_known_family": flag(c("ictv_family") != ""),
        "zot_gene": flag(c("zot_genes") > 0),
        "inoviridae_marker_genes_gt_5": flag(c("inoviridae_marker_genes") >= 5),
        "viralverify_chromosome_plasmid": flag(c("Prediction").isin("Chromosome", "Plasmid"), -1),
        "checkv_host_genes_gt_2": flag((c("host_genes") >= 2) & (c("host_genes") > c("viral_genes")), -1),
        "plasmid_hallmarks_gt_0": flag(c("plasmid_hallmarks") > 0, -1),
        "conj_genes_gt_0": flag(c("conj_genes") > 0, -1),
        "marker_duplicity_penalty": flag(c("marker_duplicity") >= t.duplicity, -7),
    }


def label_of(total: Column | str) -> Column:
    c = F.col(total) if isinstance(total, str) else total
    return F.when(c >= 2, "confident").when(c >= 0, "uncertain").otherwise("non-viral")


def virus_filter(summary: DataFrame, genes: DataFrame, quality: DataFrame, verify: DataFrame, dtr: DataFrame, source_db: str = "no_source_db", conj_genes: Sequence[str] = (), zot_gene: str = "", thresholds: Thresholds = Thresholds(), na_is_marker: bool = True) -> DataFrame:  # noqa: B008
    """Every detected sequence with its joined evidence, flags, their sum and its class.

    A Score that is the bare placeholder `-` is 0; a negative one stays
    negative. Sequences with several viral regions are left out.
    """
    counts = gene_counts(genes, conj_genes or ("",), zot_gene, na_is_marker)
    verified = verify.select(F.col("Contig name").alias("seq_name"), "Prediction", F.when(F.col("Score") == "-", 0.0).otherwise(F.col("Score").try_cast("double")).alias("Score"), "Pfam hits")
    checked = dtr_override(quality, dtr, thresholds.dtr_completeness).withColumnRenamed("contig_id", "seq_name")
    joined = summary.withColumn("genome", strip_provirus("seq_name")).join(counts, "genome", "left").join(checked, "seq_name", "left").join(verified, "seq_name", "left")
    kept = joined.withColumn("ictv_family", family_of("taxonomy")).where(not_contains_or_null("warnings", ">1 viral region"))
    scored = kept.withColumns(score_flags(thresholds)).withColumn("viral_score_sum", sum_flags(FLAGS))
    return scored.withColumns({"virus_classification": label_of("viral_score_sum"), "source_db": F.lit(source_db)})


def viral_sequences(fasta: DataFrame, classified: DataFrame) -> DataFrame:
    """Sequences of confident and uncertain ones; of records with the same id one."""
    ids = classified.where(F.col("virus_classification").isin("confident", "uncertain")).select(F.col("seq_name").alias("id")).distinct()
    return top1(fasta.join(ids, "id", "left_semi"), ["id"], [], ["description", "seq"])


def coarse_filter() -> Column:
    """Which detections go on (virus_score, length, taxonomy)."""
    score, length, tax = F.col("virus_score"), F.col("length"), F.col("taxonomy")
    ino = tax.contains("Inoviridae")
    return (
        (((score >= 0.7) & (length >= 2000)) | ino)
        & ~(tax.contains("Caudoviricetes") & (length < 10_000))
        & ~(ino & ((length < 4500) | (length > 12_500)))
        & ~(tax == "Unclassified")
        & (tax.contains("viricetes") | tax.contains("Anelloviridae"))
    )


def completeness_filter() -> Column:
    """Which contigs are complete and unchimeric enough; an expected length of 0 or null drops them."""
    return (F.col("aai_completeness") >= 50) & (F.col("kmer_freq") <= 1.2) & (F.try_divide(F.col("contig_length"), F.col("aai_expected_length").try_cast("double")) <= 1.5)


def ani_filter() -> Column:
    return (F.col("ani") >= 0.95) & ((F.col("qcov") >= 0.85) | (F.col("rcov") >= 0.85))


def hallmark_filter() -> Column:
    return (F.col("PLASMID_HALLMARK") == 1) | (F.col("VIRUS_HALLMARK") == 1)


def complete_genomes(classified: DataFrame, methods: Sequence[str] = ("AAI-based (high-confidence)",)) -> DataFrame:
    """seq_name of complete genomes: DTR with 80 or more, or from NCBI with 90 or more by one of the methods."""
    dtr = F.col("completeness_method").contains("DTR") & (F.col("completeness") >= 80)
    ncbi = (F.col("source_db") == "NCBI") & (F.col("completeness") >= 90) & F.col("completeness_method").isin(*methods)
    return classified.where(dtr | ncbi).select("seq_name")


def hq_filter(completeness: DataFrame, classified: DataFrame, least: float = 90.0) -> DataFrame:
    """contig_id of contigs that are `least` complete or more by AAI, or have DTR among their methods."""
    dtr = classified.where(F.col("completeness_method").contains("DTR")).select(F.col("seq_name").alias("contig_id")).distinct().withColumn("_dtr", F.lit(True))
    return completeness.join(dtr, "contig_id", "left").where((F.col("aai_completeness") >= least) | F.col("_dtr")).select("contig_id")


def split_uncertain(classified: DataFrame, sequences: DataFrame, least_length: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(uncertain sequences of `least_length` or more, all others, short uncertain ones among them)."""
    length = F.coalesce("contig_length", "proviral_length")
    ids = classified.where((F.col("virus_classification") == "uncertain") & (length >= least_length)).select(F.col("seq_name").alias("id")).distinct()
    return sequences.join(ids, "id", "left_semi"), sequences.join(ids, "id", "left_anti")


def uncertain_to_confident(hits: DataFrame, markers: DataFrame, least: int = 3) -> tuple[DataFrame, DataFrame]:
    """(genome with its counts of virus and plasmid hallmarks, genomes with `least` virus and no plasmid ones).

    hits: protein, hallmark, evalue; a protein counts for its best hit, ties by hallmark.
    """
    kinds = markers.select(F.col("MARKER").alias("hallmark"), (F.col("VIRUS_HALLMARK") == 1).alias("v"), (F.col("PLASMID_HALLMARK") == 1).alias("p")).groupBy("hallmark").agg(F.max("v").alias("v"), F.max("p").alias("p"))
    best = top1(hits.withColumn("genome", genome_of("protein")), ["protein"], [F.col("evalue").asc_nulls_first()], ["hallmark"])
    counts = best.join(kinds, "hallmark", "left").groupBy("genome").agg(count_true(F.col("v")).alias("virus_hallmarks"), count_true(F.col("p")).alias("plasmid_hallmarks"))
    return counts, counts.where((F.col("virus_hallmarks") >= least) & (F.col("plasmid_hallmarks") == 0)).select("genome")
