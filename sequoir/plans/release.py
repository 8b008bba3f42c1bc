"""Versioned releases and the plan over all stages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequoir import schemas
from sequoir.config import Config
from sequoir.operators.dedup import ledger_update
from sequoir.operators.store import settled
from sequoir.plans import classify, cluster, host, lifestyle, naming, taxonomy
from sequoir.sources.sinks import read_release, write_release


def unique_sequences(hashes: DataFrame, classified: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new unique sequences, ledger with all); hashes: original_id, hash, seq. Of equal hashes one with DTR stands for them, then the smallest id."""
    methods = classified.select(F.col("seq_name").alias("original_id"), "completeness_method")
    rows = hashes.join(methods, "original_id")
    return ledger_update(rows, ledger, "hash", ["original_id"], [F.coalesce(F.col("completeness_method").contains("DTR"), F.lit(False)).desc()])


def unique_proteins(proteins: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new unique proteins keyed by hash, ledger with all); proteins: protein_id, seq, hash."""
    new, all_ = ledger_update(proteins, ledger, "hash", ["protein_id"])
    return new.select(F.col("hash").alias("id"), "seq"), all_.orderBy("protein_id")


def plan(tables: Mapping[str, DataFrame], config: Config = Config()) -> dict[str, DataFrame]:  # noqa: B008
    """Every stage that is switched on and whose tables are there, as lazy tables by name.

    tables: summary, genes, quality, verify, dtr, fasta; hashes; scores, vmr;
    phist, spacers, hosts; bacphlip, proteins, pharokka, phold, empathi; edges,
    completeness.
    """
    t, on, out = config.thresholds, config.stages, {}
    have = lambda *names: all(n in tables for n in names)
    if on.classify and have("summary", "genes", "quality", "verify", "dtr"):
        out["classify"] = classify.virus_filter(*(tables[n] for n in ("summary", "genes", "quality", "verify", "dtr")), thresholds=t)
        if have("fasta"):
            out["fasta"] = classify.viral_sequences(tables["fasta"], out["classify"])
    own = out.get("classify", tables.get("classify"))
    if own is None:
        return out
    if on.hqfilter and have("completeness"):
        out["hq"] = classify.hq_filter(tables["completeness"], own, t.complete)
    if on.hcfilter and have("hashes"):
        spark = own.sparkSession
        ledger = read_release(spark, config.previous, "seqhash", schemas.SEQ_LEDGER)
        out["unique"], out["seqhash"] = unique_sequences(tables["hashes"], own, ledger)
        named, mapping = naming.rename(out["unique"].select(F.col("original_id").alias("id"), "seq"), ledger.count())
        out["renamed"], out["id_mapping"] = named, mapping
        own = out["renamed_classify"] = classify_renamed(own, mapping)
    if on.taxonomy and have("scores", "vmr"):
        out["taxonomy"] = taxonomy.taxonomy(own, tables["scores"], tables["vmr"], config.segmented)
    if on.phist and have("phist", "hosts"):
        out["phist_hits"], out["phist_host"] = host.phist_host(tables["phist"], tables["hosts"], t.containment, t.agreement)
    if on.crisprhost and have("spacers", "hosts"):
        out["crispr_hits"], out["crispr_host"] = host.crispr_host(tables["spacers"], tables["hosts"], t.mismatches, t.agreement)
    if "phist_host" in out and "crispr_host" in out and have("fasta"):
        out["hosts_found"], out["hosts_open"] = host.cascade(tables["fasta"], out["phist_host"], out["crispr_host"])
    if on.lifestyle and have("bacphlip", "proteins", "pharokka", "phold", "empathi"):
        out["lifestyle"] = lifestyle.lifestyle(own, *(tables[n] for n in ("bacphlip", "proteins", "pharokka", "phold", "empathi")), least=t.integration)
    if on.anicluster and have("edges", "completeness"):
        out["cluster_info"], out["representatives"] = cluster.species(tables["edges"], own, tables["completeness"])
    if on.aaicluster and have("norm_scores"):
        for step, found in cluster.proteome_ladder(tables["norm_scores"], t.ladder).items():
            out[f"aai_{step:g}"] = found
    return out


def classify_renamed(classified: DataFrame, mapping: DataFrame) -> DataFrame:
    return settled(naming.classify_rename(classified, mapping), "renamed")


def update(spark: SparkSession, artefacts: Mapping[str, DataFrame], config: Config) -> str:
    """Write the next release: each artefact joined to the one before. Returns its folder."""
    folder = f"{config.output}/release_{config.release}"
    write_release(dict(artefacts), folder, config.previous)
    return folder
