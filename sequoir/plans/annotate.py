"""Function tables, and what annotation is still open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.operators.dataflow import residuals
from sequoir.operators.store import settled
from sequoir.sources.tables import renamed

TAG = "Locus Tag"


def uniprot(bakta: DataFrame, foldseek: DataFrame) -> DataFrame:
    """Annotations with their structural hit, if any."""
    return renamed(bakta, {"#Sequence Id": "Sequence Id"}).join(foldseek.drop("mismatch", "gapopen", "qstart", "qend", "tstart", "tend"), TAG, "left")


def phrogs(pharokka: DataFrame, phold: DataFrame, phynteny: DataFrame) -> DataFrame:
    """Annotations of three tools for each gene; of the second only what it found itself."""
    a = renamed(pharokka.select("gene", "pyhmmer_bitscore", "pyhmmer_evalue", "phrog", "annot", "category"), {"gene": TAG, "phrog": "Pharokka Phrog", "annot": "Pharokka Annotation", "pyhmmer_bitscore": "Pharokka Bitscore", "pyhmmer_evalue": "Pharokka E-value", "category": "Pharokka Category"})
    own = phold.where(~F.col("annotation_method").isin("pharokka", "none")).drop("annotation_method")
    b = renamed(own, {"cds_id": TAG, "phrog": "Phold Phrog", "function": "Phold Category", "product": "Phold Annotation", "annotation_confidence": "Annotation Confidence", "bitscore": "Phold bitscore", "fident": "Phold fident", "evalue": "Phold evalue", "prostt5_confidence": "ProstT5 Confidence"})
    c = renamed(phynteny, {"ID": TAG, "phrog_id": "Phynteny Phrog", "phynteny_category": "Phynteny Category", "phynteny_confidence": "Phynteny Confidence"})
    return a.join(b, TAG, "left").join(c, TAG, "left")


def defense(padloc: DataFrame, finder: DataFrame, apis: DataFrame) -> DataFrame:
    """Three defence tables by gene, each row of any of them, under one key."""
    return full_chain([padloc, finder, apis], TAG)


def full_chain(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Full joins of several tables under one coalesced key; a key that only a later table has finds its rows in the others too."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, key, "full")
    return out


def no_hit_proteins(proteins: DataFrame, annotations: DataFrame) -> DataFrame:
    """Proteins (id) whose annotation names no protein of a database, by accession texts or their lack."""
    open_ = annotations.where(F.col("Accession").isNull() | ~F.col("Accession").rlike("UniParc|UniRef|UserProtein")).select(F.col(TAG).alias("id"))
    return proteins.join(open_, "id", "left_semi")


def no_hit_records(records: DataFrame, hits: DataFrame) -> DataFrame:
    """GenBank records with the genes and coding sequences that are still open, without records that have none.

    Open are the locus tags of coding sequences that no hit (id) names and that
    have a cross-reference, in any record; features without a tag are open if
    such a coding sequence has none either. Features keep their order.
    """
    tag = lambda f: F.get(f["qualifiers"]["locus_tag"], F.lit(0))
    numbered = settled(records.withColumn("_row", F.monotonically_increasing_id()), "records")
    each = numbered.select("_row", F.posexplode("features").alias("_at", "f")).select("_row", "_at", F.col("f.kind").alias("kind"), tag(F.col("f")).alias("tag"), F.get(F.col("f.qualifiers")["db_xref"], F.lit(0)).alias("xref"))
    coding = each.where("kind = 'CDS' and xref is not null").select("tag").distinct()
    open_ = coding.join(hits.select(F.col("id").alias("tag")), "tag", "left_anti").select(F.col("tag").alias("open"))
    kept = each.where(F.col("kind").isin("gene", "CDS")).join(open_, F.col("tag").eqNullSafe(F.col("open")), "left_semi").groupBy("_row").agg(F.collect_set("_at").alias("_kept"))
    found = numbered.join(kept, "_row").withColumn("features", F.filter("features", lambda f, i: F.array_contains(F.col("_kept"), i)))
    return found.select(*records.columns)


def cascade(proteins: DataFrame, steps: Sequence[tuple[str, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Proteins with the first tool that annotated them, and the rest; steps: tool and table with id."""
    return residuals(proteins, "id", steps)
