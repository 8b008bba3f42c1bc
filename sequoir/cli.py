"""Command line: python -m sequoir COMMAND --name path ... --out folder [--option value]."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequoir import schemas
from sequoir.operators import dgr, graph, similarity
from sequoir.plans import annotate, classify, cluster, host, lifestyle, naming, release, taxonomy, verify
from sequoir.sources import hits, sequences, sinks, tables

Inputs = dict[str, str]
Command = Callable[[SparkSession, argparse.Namespace], dict[str, DataFrame]]
COMMANDS: dict[str, tuple[tuple[str, ...], dict[str, object], Command]] = {}


def command(name: str, inputs: str, **options: object):
    """Register a function under a name: what files it reads, and its options with their defaults."""

    def register(fn: Command) -> Command:
        COMMANDS[name] = (tuple(inputs.split()), options, fn)
        return fn

    return register


def tsv(spark: SparkSession, path: str, schema: str, **more) -> DataFrame:
    return tables.delimited(spark, path, schema, **more)


def optional(spark: SparkSession, path: str | None, schema: str, **more) -> DataFrame:
    return tables.read_or_none(spark, path, schema, **more)


@command("self-score", "m8")
def _(s, a):
    return {"selfscore": similarity.self_score(hits.m8(s, a.m8))}


@command("norm-score", "m8 selfscore", min_score=5.5)
def _(s, a):
    return {"normscore": similarity.norm_score(hits.m8(s, a.m8), tsv(s, a.selfscore, "genome string, selfscore double"), a.min_score).orderBy("query", "reference")}


@command("virus-filter", "summary genes quality verify dtr? fasta?", source_db="no_source_db", conj_genes="", zot_gene="")
def _(s, a):
    dtr = optional(s, a.dtr, "seq_name string", header=False)
    got = classify.virus_filter(tsv(s, a.summary, schemas.VIRUS_SUMMARY), tsv(s, a.genes, schemas.GENES), tsv(s, a.quality, schemas.QUALITY), tsv(s, a.verify, schemas.VERIFY, sep=","), dtr, a.source_db, a.conj_genes.split(","), a.zot_gene)
    return {"classify": got} | ({"fasta": classify.viral_sequences(sequences.fasta(s, a.fasta), got).select("id", "seq")} if a.fasta else {})


CLASSIFIED = "seq_name string, completeness double, completeness_method string, source_db string"


@command("complete-genomes", "classify")
def _(s, a):
    return {"ids": classify.complete_genomes(tsv(s, a.classify, CLASSIFIED, null="NA"))}


@command("hq-filter", "completeness classify", least=90.0)
def _(s, a):
    return {"ids": classify.hq_filter(tsv(s, a.completeness, schemas.COMPLETENESS, null="NA"), tsv(s, a.classify, CLASSIFIED), a.least)}


@command("unique-hash", "hashes classify ledger?")
def _(s, a):
    new, ledger = release.unique_sequences(tsv(s, a.hashes, schemas.SEQ_HASH, header=False), tsv(s, a.classify, CLASSIFIED), optional(s, a.ledger, schemas.SEQ_LEDGER))
    return {"fasta": new.select(F.col("original_id").alias("id"), "seq"), "ledger": ledger}


@command("protein-hash", "proteins ledger?")
def _(s, a):
    new, ledger = release.unique_proteins(tsv(s, a.proteins, schemas.PROTEIN, header=False), optional(s, a.ledger, schemas.PROTEIN_LEDGER))
    return {"fasta": new, "ledger": ledger}


@command("uncertain2confident", "hmms markers")
def _(s, a):
    counts, ids = classify.uncertain_to_confident(hits.hmm_table(s, a.hmms), tsv(s, a.markers, schemas.MARKERS))
    return {"counts": counts, "ids": ids}


@command("rename", "fasta", existing=0, prefix="SEQ-")
def _(s, a):
    named, mapping = naming.rename(sequences.fasta(s, a.fasta).select("id", "seq"), a.existing, a.prefix)
    return {"fasta": named, "mapping": mapping}


@command("taxonomy", "classify normscore vmr", segmented=False)
def _(s, a):
    scores = tsv(s, a.normscore, "seq_name string, ref string, normscore double", header=False, null="NA")
    return {"taxonomy": taxonomy.taxonomy(tsv(s, a.classify, "seq_name string, taxonomy string", null="NA"), scores, tsv(s, a.vmr, "Species string, Genus string, Family string, `Order` string, Class string"), a.segmented)}


@command("taxa-split", "classify", rank="Class")
def _(s, a):
    return {"taxa": taxonomy.split_by(tsv(s, a.classify, "seq_name string, taxonomy string", null="NA"), a.rank)}


@command("accessions", "vmr", kinds="B")
def _(s, a):
    return {"accessions": taxonomy.accessions(tsv(s, a.vmr, schemas.VMR), a.kinds)}


@command("lifestyle", "classify bacphlip proteins pharokka phold empathi")
def _(s, a):
    read = lambda name, schema: tsv(s, getattr(a, name), schema, null="NA")
    return {"lifestyle": lifestyle.lifestyle(read("classify", "seq_name string, topology string, provirus string"), read("bacphlip", schemas.BACPHLIP), tsv(s, a.proteins, "protein_id string, hash string"), read("pharokka", schemas.PHARAOH), read("phold", schemas.PHOLD), tables.unnamed_first(s, a.empathi, schemas.EMPATHI, null="NA"))}


@command("crispr-host", "spacers hosts", mismatches=1, agreement=0.7)
def _(s, a):
    found, best = host.crispr_host(tsv(s, a.spacers, schemas.SPACER_MAP), tsv(s, a.hosts, schemas.HOST_INFO), a.mismatches, a.agreement)
    return {"hits": found, "hosts": best}


@command("phist-host", "matrix hosts", containment=0.2, agreement=0.7)
def _(s, a):
    found, best = host.phist_host(hits.sparse_matrix(s, a.matrix), tsv(s, a.hosts, schemas.HOST_INFO), a.containment, a.agreement)
    return {"hits": found, "hosts": best}


@command("spacer-hits", "sam dust")
def _(s, a):
    return {"hits": host.spacer_hits(hits.sam(s, a.sam), hits.dust(s, a.dust))}


@command("mcl", "edges", inflation=2.0)
def _(s, a):
    return {"clusters": graph.markov_clusters(tsv(s, a.edges, schemas.EDGES, header=False), a.inflation)}


@command("prune", "edges clusters", threshold=32.0)
def _(s, a):
    return {"edges": graph.prune(tsv(s, a.edges, schemas.EDGES, header=False), hits.cluster_lines(s, a.clusters), a.threshold)}


@command("ani-reps", "clusters unique classify completeness")
def _(s, a):
    own = tsv(s, a.classify, "seq_name string, contig_length long, proviral_length long, viral_genes long, completeness_method string, source_db string")
    groups = graph.with_singletons(hits.cluster_lines(s, a.clusters), tsv(s, a.unique, "member string", header=False))
    members = cluster.members_of(groups, own, tsv(s, a.completeness, "contig_id string, aai_expected_length string"))
    reps = graph.representatives(members)
    return {"reps": reps.select("votu_rep"), "clusters": graph.cluster_info(members, reps)}


@command("verify", "fasta domains table", threshold=7.0)
def _(s, a):
    from sequoir.functions.exprs import circular_overlap

    contigs = sequences.fasta(s, a.fasta).select("id", F.length("seq").cast("long").alias("length"), F.when(circular_overlap("seq").isNull(), "-").otherwise("+").alias("circular"))
    return {"verdicts": verify.verify(contigs, hits.hmm_domains(s, a.domains), hits.classifier_table(s, a.table), a.threshold)}


@command("train", "viral chrom hmms plasmid?")
def _(s, a):
    kinds = [(k, getattr(a, k)) for k in ("viral", "chrom", "plasmid") if getattr(a, k)]
    found = [hits.hmm_domains(s, path).select("hmm", F.lit(k).alias("kind"), "i_evalue") for k, path in kinds]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    names = s.read.text(a.hmms).where(F.col("value").startswith("NAME")).select(F.regexp_extract("value", r"^NAME\s+(\S+)", 1).alias("hmm"))
    return {"table": verify.train(rows, names).orderBy(F.col("p_chrom").desc())}


@command("blast-verdict", "xml")
def _(s, a):
    return {"verdicts": verify.blast_verdict(hits.blast_xml(s, a.xml))}


@command("dgr", "fasta")
def _(s, a):
    return {"pairs": dgr.scan(sequences.fasta(s, a.fasta).select("id", "seq"))}


@command("no-hits", "fasta annotations")
def _(s, a):
    return {"fasta": annotate.no_hit_proteins(sequences.fasta(s, a.fasta).select("id", "seq"), tables.with_preamble(s, a.annotations, "`Locus Tag` string, Accession string"))}


#: Outputs without a header.
BARE = ("ids", "normscore", "reps")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sequoir")
    sub = top.add_subparsers(dest="command", required=True)
    for name, (inputs, options, _) in sorted(COMMANDS.items()):
        p = sub.add_parser(name)
        for i in inputs:
            p.add_argument(f"--{i.rstrip('?')}", required=not i.endswith("?"))
        for o, default in options.items():
            flag = f"--{o.replace('_', '-')}"
            if isinstance(default, bool):
                p.add_argument(flag, action="store_true")
            else:
                p.add_argument(flag, type=type(default), default=default)
        p.add_argument("--out", required=True)
    return top


def main(args: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("sequoir").getOrCreate()
    for name, df in COMMANDS[a.command][2](spark, a).items():
        if name == "fasta":
            sinks.write_fasta(df, f"{a.out}/{name}")
        else:
            sinks.write_table(df, f"{a.out}/{name}", header=name not in BARE, null="", decimals=2 if name == "normscore" else None)
    return 0


if __name__ == "__main__":
    sys.exit(main())
