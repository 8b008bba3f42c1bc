"""Naive-Bayes classification of contigs by their domains, its training, and verdicts of BLAST reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sequoir.operators.intervals import covered
from sequoir.operators.rank import top1


def chosen_domains(domains: DataFrame) -> DataFrame:
    """gene, hmm of the domains that stay: in the order of score, then of the start as text, greatest first.

    The first stays. A later one stays if it doesn't overlap the first; it is
    compared with no other.
    """
    order = Window.partitionBy("gene").orderBy(F.col("score").desc_nulls_last(), F.col("start_text").desc_nulls_last(), F.col("hmm").asc_nulls_last())
    first = lambda c: F.first(c).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = domains.select("gene", "hmm", "start", "end", F.row_number().over(order).alias("place"), first("start").alias("first_start"), first("end").alias("first_end"))
    return ranked.where("place = 1 or end <= first_start or start >= first_end").select("gene", "hmm")


def naive_bayes(contig_hmms: DataFrame, table: DataFrame, threshold: float = 7.0) -> DataFrame:
    """contig, Prediction, Score, n_hmms of contigs (contig, hmm distinct) by the classifier's table.

    Log-probabilities are summed over the domains that the table knows.
    """
    logs = table.select("hmm", *(F.log(F.col(f"p_{k}")).alias(k) for k in ("plasmid", "chrom", "viral", "nonviral")))
    sums = contig_hmms.join(logs, "hmm", "left").groupBy("contig").agg(F.count("*").alias("n_hmms"), *(F.coalesce(F.sum(k), F.lit(0.0)).alias(k) for k in ("plasmid", "chrom", "viral", "nonviral")))
    viral, plasmid = F.col("viral") - F.col("nonviral"), F.col("plasmid") - F.col("chrom")
    label = (
        F.when(viral > threshold, "Virus")
        .when(viral > -threshold, F.when(F.col("n_hmms") > 2, "Uncertain - viral or bacterial").otherwise("Uncertain - too short"))
        .when(plasmid > threshold, "Plasmid")
        .when(-plasmid > threshold, "Chromosome")
        .otherwise("Uncertain - plasmid or chromosomal")
    )
    shown = F.when(viral > -threshold, viral).otherwise(plasmid)
    return sums.select("contig", label.alias("Prediction"), F.format_string("%.2f", shown).alias("Score"), "n_hmms")


def verify(contigs: DataFrame, domains: DataFrame, table: DataFrame, threshold: float = 7.0, long: int = 3000) -> DataFrame:
    """Verdict of every contig (id, length, circular): Contig name, Prediction, Length, Circular, Score, Pfam hits.

    Too short becomes uncertain for contigs over `long` or circular ones; a
    contig without domains has the score `-`.
    """
    own = chosen_domains(domains).select(F.regexp_replace("gene", "_[^_]*$", "").alias("contig"), "hmm").distinct()
    hits = own.groupBy("contig").agg(F.array_join(F.sort_array(F.collect_set("hmm")), " ").alias("Pfam hits"))
    judged = contigs.join(naive_bayes(own, table, threshold), contigs.id == F.col("contig"), "left").drop("contig").join(hits, F.col("id") == F.col("contig"), "left")
    big = (F.col("length") > long) | (F.col("circular") == "+")
    none = F.col("Prediction").isNull()
    label = F.when((none | (F.col("Prediction") == "Uncertain - too short")) & big, "Uncertain - viral or bacterial").when(none, "Uncertain - too short").otherwise(F.col("Prediction"))
    return judged.select(F.col("id").alias("Contig name"), label.alias("Prediction"), F.col("length").alias("Length"), F.col("circular").alias("Circular"), F.coalesce("Score", F.lit("-")).alias("Score"), "Pfam hits")


def with_blast(verdicts: DataFrame, blast: DataFrame) -> DataFrame:
    """verdicts with the BLAST hit (query, hit) of their contig, the smallest of several, `No BLAST hits` for none."""
    best = blast.groupBy(F.col("query").alias("Contig name")).agg(F.min("hit").alias("hit"))
    return verdicts.join(best, "Contig name", "left").withColumn("hit", F.coalesce("hit", F.lit("No BLAST hits")))


def train(hits: DataFrame, hmms: DataFrame, pseudo: float = 0.01, most_evalue: float = 1e-6, least: int = 10) -> DataFrame:
    """The classifier's table from domain hits (hmm, kind: plasmid, chrom or viral, i_evalue) over all hmms (hmm).

    Frequencies have a pseudocount; kept are domains seen `least` times or more in some kind.
    """
    good = hits.where(F.col("i_evalue") <= most_evalue).join(hmms.select("hmm").distinct(), "hmm", "left_semi")
    counts = good.groupBy("hmm").pivot("kind", ["plasmid", "chrom", "viral"]).count()
    n = {k: F.coalesce(F.col(k), F.lit(0)).alias(f"n_{k}") for k in ("plasmid", "chrom", "viral")}
    all_ = hmms.select("hmm").distinct().join(counts, "hmm", "left").select("hmm", *n.values())
    total = all_.agg(F.count("*").alias("hmms"), *(F.coalesce(F.sum(f"n_{k}"), F.lit(0)).alias(k) for k in ("plasmid", "chrom", "viral"))).first()
    share = lambda seen, of: (seen + pseudo) / F.lit(of + total.hmms * pseudo)
    c = F.col
    table = all_.select(
        "hmm",
        "n_plasmid",
        "n_chrom",
        "n_viral",
        share(c("n_plasmid"), total.plasmid).alias("p_plasmid"),
        share(c("n_chrom"), total.chrom).alias("p_chrom"),
        share(c("n_viral"), total.viral).alias("p_viral"),
        share(c("n_plasmid") + c("n_chrom"), total.plasmid + total.chrom).alias("p_nonviral"),
    )
    return table.where(F.greatest("n_plasmid", "n_chrom", "n_viral") >= least)


def title_kind(title: Column | str) -> Column:
    t = F.col(title) if isinstance(title, str) else title
    return F.when(t.rlike("hage|irus"), "Virus").when(t.contains("lasmid"), "Plasmid").when(t.rlike("hromosome|omplete genome"), "Chromosome").otherwise("Other")


def blast_verdict(hsps: DataFrame, most_evalue: float = 0.01, least_coverage: float = 0.1, ratio: float = 0.9) -> DataFrame:
    """query, verdict, title, coverage: what a BLAST report says of each query.

    Alignments count that cover `least_coverage` of the query; the best gives
    its kind. If others within `ratio` of its coverage are of another kind,
    the first such that is a virus or plasmid decides; if there are only others
    of other kinds, the best does. Queries without such alignments are
    `no_significant`.
    """
    good = hsps.where(F.col("evalue") < most_evalue)
    lengths = covered(good, ["query", "hit"], "start", "end")
    shown = good.groupBy("query", "hit").agg(F.min("title").alias("title"), F.min("query_length").alias("query_length"))
    aligned = shown.join(lengths, ["query", "hit"]).where(F.col("covered") >= least_coverage * F.col("query_length")).withColumn("kind", title_kind("title"))
    order = [F.col("covered").desc(), F.col("title").desc()]
    best = top1(aligned, ["query"], order, ["hit"]).select("query", F.col("kind").alias("best_kind"), "title", "covered", "query_length")
    close = aligned.join(best.select("query", "best_kind", F.col("covered").alias("best")), "query").where(F.col("covered") >= ratio * F.col("best"))
    other = top1(close.where((F.col("kind") != F.col("best_kind")) & F.col("kind").isin("Virus", "Plasmid")), ["query"], order, ["hit"]).select("query", F.col("kind").alias("other_kind"))
    judged = best.join(other, "query", "left")
    found = hsps.select("query").distinct().join(judged, "query", "left")
    return found.select("query", F.coalesce("other_kind", "best_kind", F.lit("no_significant")).alias("verdict"), "title", (F.col("covered") / F.col("query_length")).alias("coverage"))


def genes_within(genes: DataFrame, contigs: DataFrame) -> DataFrame:
    """Genes (contig, start, ...) that begin within their contig (id, length); circular contigs were lengthened before genes were called."""
    own = contigs.select(F.col("id").alias("contig"), F.col("length").alias("_length"))
    return genes.join(own, "contig").where(F.col("start") <= F.col("_length")).drop("_length")
