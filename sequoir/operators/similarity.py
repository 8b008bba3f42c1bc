"""Protein-similarity scores and k-mer containment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sequoir.functions.exprs import genome_of_numbered
from sequoir.operators.store import settled


def self_score(hits: DataFrame) -> DataFrame:
    """genome, genes, selfscore: count and sum of the bit scores of genes against themselves (q_gene, r_gene, bitscore)."""
    own = hits.where(F.col("q_gene") == F.col("r_gene"))
    return own.groupBy(genome_of_numbered("q_gene").alias("genome")).agg(F.count("*").alias("genes"), F.sum("bitscore").alias("selfscore"))


def best_sums(rows: DataFrame, fine: str, query: str, reference: str, value: str) -> DataFrame:
    """Per query and reference the sum, over the fine keys, of the greatest value: a maximum under a sum."""
    best = rows.groupBy(fine, query, reference).agg(F.max(value).alias("best"))
    return best.groupBy(query, reference).agg(F.sum("best").alias("raw_score"))


def normalised(raw: DataFrame, selfs: DataFrame, query: str, least: float) -> DataFrame:
    """raw with norm_score = 100 * raw_score / selfscore, where it is `least` or more; selfs: `query`, selfscore.

    Queries without a self score, or one of zero, are dropped.
    """
    score = F.try_divide(F.lit(100) * F.col("raw_score"), F.col("selfscore"))
    return raw.join(selfs, query).withColumn("norm_score", score).where(F.col("norm_score") >= least)


def norm_score(hits: DataFrame, selfs: DataFrame, min_score: float) -> DataFrame:
    """query, reference, norm_score (2 decimals) of genome pairs; selfs: genome, selfscore."""
    rows = hits.select("q_gene", genome_of_numbered("q_gene").alias("query"), genome_of_numbered("r_gene").alias("reference"), "bitscore").where(F.col("query") != F.col("reference"))
    raw = best_sums(rows, "q_gene", "query", "reference", "bitscore")
    scored = normalised(raw, selfs.select(F.col("genome").alias("query"), "selfscore"), "query", min_score)
    return scored.select("query", "reference", F.round("norm_score", 2).alias("norm_score"))


def kmers(seq: Column | str, k: int) -> Column:
    """All k-letter parts of a text; none if it is shorter.

    Parts of a text of one-byte letters are cut from its bytes, as finding a
    place in a text means to walk there: time is linear in its length.
    """
    s = F.col(seq) if isinstance(seq, str) else seq
    places = F.sequence(F.lit(1), F.length(s) - (k - 1))
    by_byte = F.transform(places, lambda i: F.substring(s.cast("binary"), i, F.lit(k)).cast("string"))
    by_letter = F.transform(places, lambda i: F.substring(s, i, F.lit(k)))
    none = F.array().cast("array<string>")
    return F.when(F.length(s) < k, none).when(F.octet_length(s) == F.length(s), by_byte).when(F.length(s) >= k, by_letter).otherwise(none)


def word_grams(words: Column, n: int) -> Column:
    """All runs of n words of a list, joined by a space.

    Shifted lists are zipped, so that `words` is worked out n times and not
    once for every run.
    """
    count = F.size(words) - (n - 1)
    runs = F.slice(words, 1, F.greatest(count, F.lit(0)))
    for k in range(1, n):
        runs = F.zip_with(runs, F.slice(words, k + 1, F.greatest(count, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(count > 0, runs).otherwise(F.array().cast("array<string>"))


def hashed_sets(df: DataFrame, name: str, grams: Column | str, own: str, fraction: int = 1) -> DataFrame:
    """own (the id) and grams: the distinct 64-bit hashes of a row's grams, written once; fraction f keeps those divisible by f."""
    hashed = F.array_distinct(F.transform(grams, lambda g: F.xxhash64(g)))
    chosen = hashed if fraction == 1 else F.filter(hashed, lambda h: F.pmod(h, F.lit(fraction)) == 0)
    return settled(df.select(F.col(name).alias(own), chosen.alias("grams")), own)


def _each(sets: DataFrame, own: str) -> DataFrame:
    return sets.select(own, F.size("grams").alias(f"n_{own}"), F.explode("grams").alias("gram"))


def _rarest(sets: DataFrame, own: str, pairs: DataFrame, least_shared: int, least: float) -> DataFrame:
    """The grams by which a set finds sets that are no smaller.

    pairs: gram, pairs of those that both sides have. A pair must share t
    grams, so it shares one of the smaller set's without its t - 1 most
    frequent ones. What the other side lacks is rarer than all, so places are
    counted among what it has.
    """
    rows = _each(sets, own).join(pairs, "gram")
    needed = F.greatest(F.lit(least_shared), F.ceil(F.col(f"n_{own}") * least - 1e-9), F.lit(1))
    place = F.row_number().over(Window.partitionBy(own).orderBy("pairs", "gram"))
    last = F.count("*").over(Window.partitionBy(own)) - needed + 1
    return rows.withColumn("place", place).withColumn("last", last).where("place <= last").select(own, f"n_{own}", "gram")


def _counted(proposed: DataFrame, a: DataFrame, b: DataFrame, least_shared: int, least: float) -> DataFrame:
    """Pairs (q, t) with the shared grams of their sets and their share of the smaller one, where enough."""
    both = proposed.distinct().join(a.withColumnRenamed("grams", "grams_q"), "q").join(b.withColumnRenamed("grams", "grams_t"), "t")
    counted = both.select("q", "t", F.size(F.array_intersect("grams_q", "grams_t")).cast("long").alias("shared"), F.least(F.size("grams_q"), F.size("grams_t")).alias("n"))
    found = counted.where(F.col("shared") >= least_shared).withColumn("containment", F.col("shared") / F.col("n")).where(F.col("containment") >= least)
    return found.select("q", "t", "shared", "containment")


def containment(queries: DataFrame, targets: DataFrame, query: str, target: str, grams: str, least_shared: int = 1, least: float = 0.2, fraction: int = 1) -> DataFrame:
    """Pairs of queries and targets by distinct shared grams: shared count and its share of the smaller set.

    queries and targets have an id and a list of grams. Grams are 64-bit hashes
    (two that share one would count as shared: once in some billions of pairs
    of a million grams). Pairs are proposed by the smaller set's rarest grams
    alone and then counted exactly: a gram that nearly all rows have makes no
    pairs. fraction f keeps the grams whose hash is divisible by f, alike on both sides.
    """
    a, b = hashed_sets(queries, query, grams, "q", fraction), hashed_sets(targets, target, grams, "t", fraction)
    # grams that the other side lacks go first: where one side's are few, they are sent to the other's, of which nothing is shuffled
    in_t = settled(_each(b, "t").groupBy("gram").agg(F.count("*").alias("in_t")), "grams")
    in_q = _each(a, "q").join(in_t, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("in_q"))
    common = settled(in_q.join(in_t, "gram").select("gram", (F.col("in_q") * F.col("in_t")).alias("pairs")), "grams")
    by_query, by_target = (settled(_rarest(df, own, common, least_shared, least), "rarest") for df, own in ((a, "q"), (b, "t")))
    small_query = by_query.join(_each(b, "t"), "gram").where("n_q <= n_t")
    small_target = by_target.join(_each(a, "q"), "gram").where("n_t < n_q")
    proposed = settled(small_query.select("q", "t").unionByName(small_target.select("q", "t")).distinct(), "proposed")
    found = _counted(proposed, a, b, least_shared, least)
    return found.select(F.col("q").alias(query), F.col("t").alias(target), "shared", "containment")


def similar_pairs(rows: DataFrame, name: str, grams: Column | str, least_shared: int = 1, least: float = 0.2, fraction: int = 1) -> DataFrame:
    """src < dst, shared, containment of the pairs within rows (an id, a list of grams), as containment() has them; each pair once and no row with itself."""
    a = hashed_sets(rows, name, grams, "q", fraction)
    b = a.select(F.col("q").alias("t"), F.col("grams").alias("grams"))
    common = _each(a, "q").groupBy("gram").agg(F.count("*").alias("pairs")).where("pairs > 1")
    met = _rarest(a, "q", common, least_shared, least).join(_each(b, "t"), "gram").where("n_q < n_t or n_q = n_t and q < t")
    found = _counted(met.select(F.least("q", "t").alias("q"), F.greatest("q", "t").alias("t")), a, b, least_shared, least)
    return found.select(F.col("q").alias("src"), F.col("t").alias("dst"), "shared", "containment")
