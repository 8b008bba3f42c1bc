"""Species clusters: edges, clusters, representatives, and nested clusterings of proteomes."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequoir.operators import graph
from sequoir.operators.similarity import kmers, similar_pairs
from sequoir.operators.store import settled


def ani_edges(ani: DataFrame, least: float = 0.95, coverage: float = 0.85) -> DataFrame:
    """src, dst, w of an alignment table (query, reference, ani, qcov, rcov)."""
    kept = ani.where((F.col("ani") >= least) & ((F.col("qcov") >= coverage) | (F.col("rcov") >= coverage)) & (F.col("query") != F.col("reference")))
    return kept.select(F.col("query").alias("src"), F.col("reference").alias("dst"), F.col("ani").alias("w"))


def kmer_edges(sequences: DataFrame, k: int = 25, least_shared: int = 20, least: float = 0.95, fraction: int = 1) -> DataFrame:
    """src < dst, w of sequences (id, seq) by shared k-mers, where no alignments are at hand.

    fraction f, for quick looks, keeps one in f k-mers and asks for as many
    fewer shared ones: w then has a standard error of sqrt(w * (1 - w) * f / n) for n
    k-mers, so pairs within some of these of `least` may be missed or wrong.
    """
    needed = max(1, -(-least_shared // fraction))
    near = similar_pairs(sequences, "id", kmers("seq", k), needed, least, fraction)
    return near.select("src", "dst", F.col("containment").alias("w"))


def kmer_store(spark: SparkSession, folder: str, buckets: int = 200) -> str:
    """The table of all releases' k-mers (gram, id, n: how many the genome has) in a folder, by its name in this session; made if it isn't there.

    It is bucketed by gram, so that what is new is dealt into its buckets and
    nothing of what is there is moved. `buckets` holds for the folder's life.
    """
    name = f"kmers_{hashlib.md5(folder.encode()).hexdigest()}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (gram BIGINT, id STRING, n INT) USING parquet CLUSTERED BY (gram) SORTED BY (gram) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return name


def against_store(new: DataFrame, store: str, k: int = 25, least_shared: int = 20, least: float = 0.95) -> DataFrame:
    """src, dst, w: edges of new sequences (id, seq) with those in the store and with each other."""
    spark = new.sparkSession
    old = spark.table(store)
    sets = new.select("id", F.array_distinct(F.transform(kmers("seq", k), lambda g: F.xxhash64(g))).alias("grams"))
    rows = sets.select(F.col("id").alias("src"), F.size("grams").alias("n_new"), F.explode("grams").alias("gram"))
    # the old side stays as it lies: no broadcast, which would send it, and no exchange
    met = rows.join(old.hint("merge"), "gram").groupBy("src", F.col("id").alias("dst")).agg(F.count("*").alias("shared"), F.least(F.max("n_new"), F.max("n")).alias("least_n"))
    found = met.where((F.col("shared") >= least_shared) & (F.col("shared") >= F.col("least_n") * least)).select("src", "dst", (F.col("shared") / F.col("least_n")).alias("w"))
    return found.unionByName(kmer_edges(new, k, least_shared, least))


def add_to_store(new: DataFrame, store: str, k: int = 25) -> None:
    """The k-mers of new sequences (id, seq) appended to the store: a file for each bucket, and none rewritten."""
    spark = new.sparkSession
    buckets = next(int(r.data_type) for r in spark.sql(f"DESCRIBE EXTENDED {store}").collect() if r.col_name == "Num Buckets")
    sets = new.select("id", F.array_distinct(F.transform(kmers("seq", k), lambda g: F.xxhash64(g))).alias("grams"))
    rows = sets.select(F.explode("grams").alias("gram"), "id", F.size("grams").alias("n"))
    rows.repartition(buckets, "gram").write.insertInto(store)
    spark.catalog.refreshTable(store)


def extended(clusters: DataFrame, edges: DataFrame, new_edges: DataFrame, inflation: float = 2.0) -> DataFrame:
    """member, cluster_id after a release: clusters (member, cluster_id) of edges, extended by new edges (src, dst, w).

    Markov clusters of parts that aren't connected have nothing to do with each
    other: only components of the old edges that a new edge touches are
    clustered anew, with the new edges. The others keep their ids; new ids are
    numbered after the last. Members without any edge are no concern of this.
    """
    parts = graph.components(edges.select("src", "dst"))
    ends = new_edges.select(F.col("src").alias("node")).unionByName(new_edges.select(F.col("dst").alias("node"))).distinct()
    touched = parts.join(ends, "node", "left_semi").select("component").distinct()
    moved = settled(parts.join(touched, "component", "left_semi").select("node"), "touched")
    again = edges.join(moved, edges.src == moved.node, "left_semi").select("src", "dst", "w").unionByName(new_edges.select("src", "dst", "w"))
    anew = graph.markov_clusters(again, inflation)
    kept = clusters.join(anew.select("member"), "member", "left_anti").select("member", "cluster_id")
    last = clusters.agg(F.coalesce(F.max("cluster_id"), F.lit(0))).first()[0]
    return kept.unionByName(anew.select("member", (F.col("cluster_id") + last).alias("cluster_id")))


def species(edges: DataFrame, classified: DataFrame, completeness: DataFrame, inflation: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(cluster and representative of every classified sequence that has a completeness row, representatives)."""
    clusters = graph.with_singletons(graph.markov_clusters(edges, inflation), classified.select(F.col("seq_name").alias("member")))
    members = members_of(clusters, classified, completeness)
    reps = graph.representatives(members)
    return graph.cluster_info(members, reps), reps


def members_of(clusters: DataFrame, classified: DataFrame, completeness: DataFrame) -> DataFrame:
    """Classified sequences in clusters with their length and expected length; those without a completeness row are left out."""
    own = classified if "original_id" in classified.columns else classified.withColumn("original_id", F.col("seq_name"))
    known = completeness.select(F.col("contig_id").alias("original_id"), "aai_expected_length")
    named = clusters.select(F.col("member").alias("seq_name"), "cluster_id")
    length = F.coalesce("contig_length", "proviral_length").cast("double")
    return own.join(known, "original_id").join(named, "seq_name").withColumn("length", length)


def proteome_ladder(norm_scores: DataFrame, thresholds: tuple[float, ...] = (5.5, 32.0, 65.0, 80.0)) -> dict[float, DataFrame]:
    """Nested clusterings of genomes by their normalised scores (query, reference, norm_score)."""
    return graph.ladder(norm_scores.select(F.col("query").alias("src"), F.col("reference").alias("dst"), F.col("norm_score").alias("w")), thresholds)
