"""The operators as queries over the star schema, each with its SQL.

Money is summed in whole cents, so that a sum does not depend on its order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sequoir.functions import exprs
from sequoir.operators import dataflow, dedup, graph, intervals, rank, similarity, vote
from sequoir.operators.store import shared_dir, spread
from sequoir.plans import classify

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (table reader) under its name; sql is what DuckDB runs."""

    def register(fn):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("long")


C = "CAST(round({} * 100) AS BIGINT)".format


def epoch(c: str) -> Column:
    """Seconds since 1970 to the nearest whole one, halves to the even one, as SQL's CAST(epoch(c) AS BIGINT); times have no zone, so the session's plays no part."""
    since = F.expr(f"CAST(CAST({c} - TIMESTAMP_NTZ'1970-01-01' AS INTERVAL SECOND) AS DECIMAL(20, 6))")
    return F.rint(since.cast("double")).cast("long")


@query(f"""
WITH rows AS (SELECT l_orderkey, l_suppkey, p_brand, {C('l_extendedprice')} AS v FROM lineitem JOIN part ON l_partkey = p_partkey),
best AS (SELECT l_orderkey, l_suppkey, p_brand, max(v) AS b FROM rows GROUP BY ALL),
raw AS (SELECT l_suppkey, p_brand, CAST(sum(b) AS BIGINT) AS raw_score FROM best GROUP BY ALL),
own AS (SELECT l_suppkey, CAST(sum({C('l_extendedprice')}) AS BIGINT) AS s FROM lineitem GROUP BY 1)
SELECT raw.l_suppkey AS l_suppkey, p_brand, 100.0::DOUBLE * raw_score / s AS norm_score FROM raw JOIN own ON raw.l_suppkey = own.l_suppkey WHERE 100.0::DOUBLE * raw_score / s >= 4.0
""")
def norm_score_lineitem(t):
    """Greatest price per order, supplier and brand, summed, as a share of the supplier's total."""
    rows = t("lineitem").join(t("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey").select("l_orderkey", "l_suppkey", "p_brand", cents("l_extendedprice").alias("v"))
    raw = similarity.best_sums(rows, "l_orderkey", "l_suppkey", "p_brand", "v")
    selfs = t("lineitem").groupBy("l_suppkey").agg(F.sum(cents("l_extendedprice")).alias("selfscore"))
    return similarity.normalised(raw, selfs, "l_suppkey", 4.0).select("l_suppkey", "p_brand", "norm_score")


@query(f"SELECT l_suppkey, count(*) AS genes, CAST(sum({C('l_extendedprice')}) AS BIGINT) AS selfscore FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1")
def self_score_supplier(t):
    return t("lineitem").where("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.count("*").alias("genes"), F.sum(cents("l_extendedprice")).alias("selfscore"))


def _genes(t):
    return t("lineitem").select(F.concat_ws("_", "l_orderkey", "l_linenumber").alias("gene"), (F.col("l_suppkey") % 9).cast("string").alias("marker"))


DUP = """
counted AS (SELECT l_orderkey AS genome, l_suppkey % 9 AS marker, count(*) AS n FROM lineitem GROUP BY ALL),
dup AS (SELECT genome, CAST(sum(n) AS BIGINT) AS total_markers, CAST(sum(CASE WHEN n > 1 THEN 1 END) AS BIGINT) AS d FROM counted GROUP BY 1)
"""


@query(f"WITH {DUP} SELECT CAST(genome AS VARCHAR) AS genome, total_markers, coalesce(d, 0) AS n_dup_markers, 1 + CAST(d AS DOUBLE) / total_markers AS marker_duplicity FROM dup")
def dup_marker_ratio(t):
    return classify.marker_duplicity(_genes(t))


@query(f"""
WITH {DUP}, per AS (SELECT l_orderkey, count(*) AS n_items, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_r FROM lineitem GROUP BY 1),
f AS (SELECT o_orderkey, 1 + CAST(d AS DOUBLE) / total_markers AS marker_duplicity,
  CASE WHEN o_totalprice >= 200000 THEN 1 ELSE 0 END AS f1, CASE WHEN o_orderstatus = 'F' AND n_items >= 4 THEN 1 ELSE 0 END AS f2,
  CASE WHEN n_r >= 2 THEN 1 ELSE 0 END AS f3, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN -1 ELSE 0 END AS f4,
  CASE WHEN 1 + CAST(d AS DOUBLE) / total_markers >= 1.2 THEN -7 ELSE 0 END AS f5
  FROM orders LEFT JOIN per ON o_orderkey = l_orderkey LEFT JOIN dup ON o_orderkey = genome)
SELECT o_orderkey, marker_duplicity, CAST(f1 + f2 + f3 + f4 + f5 AS INTEGER) AS score_sum, CASE WHEN f1 + f2 + f3 + f4 + f5 >= 2 THEN 'confident' WHEN f1 + f2 + f3 + f4 + f5 >= 0 THEN 'uncertain' ELSE 'non-viral' END AS label FROM f
""")
def virus_filter_score(t):
    """Flags with positive and negative points, a heavy penalty, their sum and a three-way label."""
    per = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_items"), exprs.count_true(F.col("l_returnflag") == "R").alias("n_r"))
    dup = classify.marker_duplicity(_genes(t)).select(F.col("genome").cast("long").alias("o_orderkey"), "marker_duplicity")
    o = t("orders").join(per, "o_orderkey", "left").join(dup, "o_orderkey", "left")
    c = F.col
    flags = [exprs.flag(c("o_totalprice") >= 200000), exprs.flag((c("o_orderstatus") == "F") & (c("n_items") >= 4)), exprs.flag(c("n_r") >= 2), exprs.flag(c("o_orderpriority").isin("1-URGENT", "2-HIGH"), -1), exprs.flag(c("marker_duplicity") >= 1.2, -7)]
    return o.select("o_orderkey", "marker_duplicity", exprs.sum_flags(flags).alias("score_sum")).withColumn("label", classify.label_of("score_sum"))


@query("SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' AND o_totalprice >= 80000) OR (o_orderpriority = '5-LOW' AND o_totalprice >= 150000 AND o_orderstatus IN ('O', 'P'))")
def complete_genomes_pred(t):
    c = F.col
    return t("orders").where((c("o_orderstatus") == "F") & (c("o_totalprice") >= 80000) | (c("o_orderpriority") == "5-LOW") & (c("o_totalprice") >= 150000) & c("o_orderstatus").isin("O", "P")).select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_acctbal >= 9000 OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice >= 400000)")
def hq_filter_or_member(t):
    member = t("orders").where("o_totalprice >= 400000").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("m", F.lit(True))
    return t("customer").join(member, "c_custkey", "left").where((F.col("c_acctbal") >= 9000) | F.col("m")).select("c_custkey")


@query("""
SELECT p_partkey, CASE WHEN h AND p_size >= 20 THEN 100 ELSE p_size END AS p_size, CASE WHEN h AND p_size >= 20 THEN 'DTR' ELSE p_type END AS p_type
FROM (SELECT *, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount >= 0.1) AS h FROM part)
""")
def dtr_override(t):
    """A key set overwrites two columns where a threshold holds too."""
    key = t("lineitem").where("l_discount >= 0.1").select(F.col("l_partkey").alias("seq_name"))
    quality = t("part").select(F.col("p_partkey").alias("contig_id"), F.col("p_size").alias("completeness"), F.col("p_type").alias("completeness_method"))
    return classify.dtr_override(quality, key, 20).select(F.col("contig_id").alias("p_partkey"), F.col("completeness").cast("int").alias("p_size"), F.col("completeness_method").alias("p_type"))


@query("""
SELECT p_partkey FROM part WHERE ((p_retailprice >= 930 AND p_size >= 10) OR p_type LIKE '%PROMO%') AND NOT (p_type LIKE '%LARGE%' AND p_size < 30)
AND NOT (p_type LIKE '%PROMO%' AND (p_size < 5 OR p_size > 45)) AND NOT (p_brand = 'Brand#11') AND (p_type LIKE '%R%' OR p_type LIKE '%M%')
""")
def prefilter_5clause(t):
    c, p = F.col, F.col("p_type")
    sized = ((c("p_retailprice") >= 930) & (c("p_size") >= 10)) | p.contains("PROMO")
    odd = p.contains("PROMO") & ((c("p_size") < 5) | (c("p_size") > 45))
    return t("part").where(sized & ~(p.contains("LARGE") & (c("p_size") < 30)) & ~odd & ~(c("p_brand") == "Brand#11") & (p.contains("R") | p.contains("M"))).select("p_partkey")


@query("SELECT doc_id FROM documents WHERE nullif(lang, 'es') IS NULL OR NOT contains(nullif(lang, 'es'), 'e')")
def null_safe_not_contains(t):
    """Rows whose text lacks a literal, null ones too."""
    return t("documents").withColumn("l", F.nullif("lang", F.lit("es"))).where(exprs.not_contains_or_null("l", "e")).select("doc_id")


@query("""
WITH v AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS k, sum(n) OVER (PARTITION BY user_id) AS total FROM v)
SELECT user_id, CAST(total AS BIGINT) AS total_connections, n AS max_connections, event_type AS top_label, CAST(n AS DOUBLE) / total AS agreement FROM r WHERE k = 1 AND CAST(n AS DOUBLE) / total >= 0.25
""")
def consensus_event_user(t):
    return vote.consensus(t("events"), "user_id", "event_type", 0.25)


TIES = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate"


@query(f"SELECT l_suppkey, l_orderkey, l_linenumber, {C('l_extendedprice')} AS price FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, {TIES}) AS k FROM lineitem) WHERE k = 1")
def top1_desc_per_group(t):
    best = rank.top1(t("lineitem"), ["l_suppkey"], [F.col("l_extendedprice").desc_nulls_first()], TIES.split(", "))
    return best.select("l_suppkey", "l_orderkey", "l_linenumber", cents("l_extendedprice").alias("price"))


@query(f"SELECT l_suppkey, l_orderkey, l_linenumber, {C('l_extendedprice')} AS price FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice, {TIES}) AS k FROM lineitem) WHERE k = 1")
def top1_asc_per_group(t):
    best = rank.top1(t("lineitem"), ["l_suppkey"], [F.col("l_extendedprice").asc_nulls_first()], TIES.split(", "))
    return best.select("l_suppkey", "l_orderkey", "l_linenumber", cents("l_extendedprice").alias("price"))


@query("""
WITH m AS (SELECT p_type, median(p_size) AS median_size, max(p_size) AS max_size, count(*) AS n FROM part GROUP BY 1)
SELECT p_partkey, CAST(median_size AS DOUBLE) AS median_size, max_size, n FROM part JOIN m ON part.p_type = m.p_type
""")
def group_metrics_back(t):
    return rank.with_metrics(t("part"), ["p_type"], [F.median("p_size").alias("median_size"), F.max("p_size").alias("max_size"), F.count("*").alias("n")]).select("p_partkey", "median_size", "max_size", "n")


def _cluster_members(t) -> DataFrame:
    c = F.col
    return t("part").select(c("p_partkey").cast("string").alias("seq_name"), F.concat_ws("/", "p_brand", "p_size").alias("cluster_id"), cents("p_retailprice").cast("double").alias("length"), (c("p_partkey") % 5).alias("viral_genes"), F.when(c("p_type").contains("PROMO"), "DTR").otherwise("AAI").alias("completeness_method"), F.when(c("p_partkey") % 3 == 0, "NA").otherwise("130000").alias("aai_expected_length"), c("p_brand").alias("source_db"))


@query("""
WITH m AS (SELECT p_partkey AS id, p_brand || '/' || p_size AS cl, CAST(round(p_retailprice * 100) AS DOUBLE) AS len, p_partkey % 5 AS genes, CASE WHEN p_type LIKE '%PROMO%' THEN 'DTR' ELSE 'AAI' END AS method, CASE WHEN p_partkey % 3 = 0 THEN 'NA' ELSE '130000' END AS expected FROM part),
s AS (SELECT *, count(*) OVER (PARTITION BY cl) AS n, max(genes) OVER (PARTITION BY cl) AS mg FROM m), md AS (SELECT cl, median(len) AS med FROM m GROUP BY 1),
single AS (SELECT cl, id FROM s WHERE n = 1),
dtr AS (SELECT cl, id FROM (SELECT *, row_number() OVER (PARTITION BY cl ORDER BY len DESC, CAST(id AS VARCHAR)) AS k FROM s WHERE n > 1 AND method = 'DTR') WHERE k = 1),
lin AS (SELECT cl, id FROM (SELECT s.cl, s.id, row_number() OVER (PARTITION BY s.cl ORDER BY abs(len - CASE WHEN expected = 'NA' THEN med ELSE CAST(nullif(expected, 'NA') AS DOUBLE) END), CAST(s.id AS VARCHAR)) AS k FROM s JOIN md ON s.cl = md.cl WHERE n > 1 AND genes = mg AND s.cl NOT IN (SELECT cl FROM dtr)) WHERE k = 1)
SELECT cl AS cluster_id, CAST(id AS VARCHAR) AS votu_rep FROM (SELECT * FROM single UNION ALL SELECT * FROM dtr UNION ALL SELECT * FROM lin)
""")
def rep_selection(t):
    """A representative for each group: alone, else longest of a kind, else nearest to the expected length."""
    return graph.representatives(_cluster_members(t))


@query("""
WITH m AS (SELECT p_partkey AS id, p_brand || '/' || p_size AS cl, CAST(round(p_retailprice * 100) AS DOUBLE) AS len, p_partkey % 5 AS genes, CASE WHEN p_type LIKE '%PROMO%' THEN 'DTR' ELSE 'AAI' END AS method, CASE WHEN p_partkey % 3 = 0 THEN 'NA' ELSE '130000' END AS expected FROM part),
s AS (SELECT *, count(*) OVER (PARTITION BY cl) AS n, max(genes) OVER (PARTITION BY cl) AS mg FROM m), md AS (SELECT cl, median(len) AS med FROM m GROUP BY 1),
single AS (SELECT cl, id FROM s WHERE n = 1),
dtr AS (SELECT cl, id FROM (SELECT *, row_number() OVER (PARTITION BY cl ORDER BY len DESC, CAST(id AS VARCHAR)) AS k FROM s WHERE n > 1 AND method = 'DTR') WHERE k = 1),
lin AS (SELECT cl, id FROM (SELECT s.cl, s.id, row_number() OVER (PARTITION BY s.cl ORDER BY abs(len - CASE WHEN expected = 'NA' THEN med ELSE CAST(nullif(expected, 'NA') AS DOUBLE) END), CAST(s.id AS VARCHAR)) AS k FROM s JOIN md ON s.cl = md.cl WHERE n > 1 AND genes = mg AND s.cl NOT IN (SELECT cl FROM dtr)) WHERE k = 1)
SELECT CAST(s.id AS VARCHAR) AS seq_name, s.cl AS cluster_id, n AS num_seqs, len AS length, med AS median_length, expected AS aai_expected_length, genes AS viral_genes, mg AS max_viral_genes, method AS completeness_method, brand AS source_db, CAST(r.id AS VARCHAR) AS votu_rep
FROM s JOIN md ON s.cl = md.cl JOIN (SELECT id AS brand_id, brand FROM (SELECT p_partkey AS id, p_brand AS brand FROM part)) b ON brand_id = s.id LEFT JOIN (SELECT * FROM single UNION ALL SELECT * FROM dtr UNION ALL SELECT * FROM lin) r ON s.cl = r.cl
""")
def cluster_info(t):
    """Every member of a cluster with its cluster's numbers and representative."""
    members = _cluster_members(t)
    found = graph.cluster_info(members, graph.representatives(members))
    return found.select("seq_name", "cluster_id", "num_seqs", "length", "median_length", "aai_expected_length", "viral_genes", "max_viral_genes", "completeness_method", "source_db", "votu_rep")


@query("SELECT c_custkey, 'ID-' || (500 + row_number() OVER (ORDER BY c_name, c_custkey)) AS new_id FROM customer")
def rename_ids(t):
    """Ids without gaps in an order, after an offset."""
    return rank.numbered(t("customer").select("c_custkey", "c_name"), ["c_name", "c_custkey"], "n", 501).select("c_custkey", F.concat(F.lit("ID-"), F.col("n").cast("string")).alias("new_id"))


@query("""
WITH d AS (SELECT doc_id, md5(text) AS hash, source FROM documents), known AS (SELECT hash FROM d WHERE source = 'src0')
SELECT hash, min(doc_id) AS doc_id FROM d WHERE source <> 'src0' AND hash IS NOT NULL AND hash NOT IN (SELECT hash FROM known) GROUP BY hash
""")
def hash_ledger_docs(t):
    """Hashes that a ledger lacks, with the first id of each."""
    hashed = dedup.with_hash(t("documents"), "text").select("doc_id", "hash", "source")
    new, _ = dedup.ledger_update(hashed.where("source <> 'src0'"), hashed.where("source = 'src0'"), "hash", ["doc_id"])
    return new.select("hash", "doc_id")


@query("""
SELECT l.l_orderkey AS l_orderkey, l.l_linenumber AS l_linenumber, l.l_partkey AS l_partkey, returned FROM lineitem l
LEFT JOIN (SELECT l_partkey, l_suppkey, count(*) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) r ON l.l_partkey = r.l_partkey AND l.l_suppkey = r.l_suppkey
""")
def left_join_composite(t):
    """Left join on two keys, null where the pair is unknown."""
    lines = t("lineitem")
    returned = lines.where("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("returned"))
    return lines.join(returned, ["l_partkey", "l_suppkey"], "left").select("l_orderkey", "l_linenumber", "l_partkey", "returned")


@query("""
SELECT c.k AS cust_nation, c.n AS customers, s.n AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal < -900 GROUP BY 1) c
FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 8000 GROUP BY 1) s ON c.k = s.k
""")
def full_outer_pair(t):
    """Full join that keeps the left key, null where only the right side has it."""
    a = t("customer").where("c_acctbal < -900").groupBy(F.col("c_nationkey").alias("cust_nation")).agg(F.count("*").alias("customers"))
    b = t("supplier").where("s_acctbal > 8000").groupBy("s_nationkey").agg(F.count("*").alias("suppliers"))
    return a.join(b, F.col("cust_nation") == F.col("s_nationkey"), "full").drop("s_nationkey")


@query("""
WITH a AS (SELECT c_nationkey AS k, count(*) AS n_c FROM customer WHERE c_acctbal < -900 GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS n_s FROM supplier WHERE s_acctbal > 8000 GROUP BY 1),
c AS (SELECT n_nationkey AS k, n_regionkey AS r FROM nation WHERE n_name >= 'I') SELECT k, n_c, n_s, r FROM a FULL JOIN b USING (k) FULL JOIN c USING (k)
""")
def full_outer_chain(t):
    from sequoir.plans.annotate import full_chain

    a = t("customer").where("c_acctbal < -900").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n_c"))
    b = t("supplier").where("s_acctbal > 8000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n_s"))
    return full_chain([a, b, t("nation").where("n_name >= 'I'").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("r"))], "k")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def semi_join(t):
    return t("customer").join(t("orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def anti_join(t):
    return t("customer").join(t("orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("""
WITH e AS (SELECT event_id, user_id % 20 AS k, CAST(epoch(ts) AS BIGINT) - 883008000 AS s FROM events), b AS (SELECT o_orderkey, o_custkey % 20 AS k, CAST(epoch(o_orderdate) AS BIGINT) AS bs FROM orders WHERE o_totalprice > 350000)
SELECT event_id, o_orderkey FROM e JOIN b ON e.k = b.k AND s <= bs + 2592000 AND bs <= s + 604800
""")
def range_join_events(t):
    """Intervals of events and orders with a common key that overlap."""
    e = t("events").select("event_id", (F.col("user_id") % 20).alias("k"), (epoch("ts") - 883008000).alias("start"), (epoch("ts") - 883008000 + 604800).alias("end"))
    b = t("orders").where("o_totalprice > 350000").select("o_orderkey", (F.col("o_custkey") % 20).alias("k"), epoch("o_orderdate").alias("block_start"), (epoch("o_orderdate") + 2592000).alias("block_end"))
    return intervals.overlap_join(e, b, ["k"], 2592000).select("event_id", "o_orderkey")


EDGES = "(SELECT o_custkey AS c, l_suppkey AS s, count(*) AS w FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)"


@query(f"SELECT 'c' || c AS src, 's' || s AS dst, CAST(w AS DOUBLE) AS w, c_nationkey AS src_cluster, s_nationkey AS dst_cluster FROM {EDGES} e JOIN customer ON c = c_custkey JOIN supplier ON s = s_suppkey WHERE c_nationkey = s_nationkey AND w >= 2")
def prune_graph(t):
    edges = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey", "l_suppkey").agg(F.count("*").cast("double").alias("w"))
    edges = edges.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst"), "w")
    of = lambda df, k, mark, n: df.select(F.concat(F.lit(mark), F.col(k).cast("string")).alias("member"), F.col(n).alias("cluster_id"))
    clusters = of(t("customer"), "c_custkey", "c", "c_nationkey").unionByName(of(t("supplier"), "s_suppkey", "s", "s_nationkey"))
    return graph.prune(edges, clusters, 2)


@query("""
WITH d AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents), b AS (SELECT item_id, string_split(text, ' ') AS w FROM benchmark),
dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' '))) AS g FROM d),
bg AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' '))) AS g FROM b),
nd AS (SELECT doc_id, count(*) AS n FROM dg GROUP BY 1), nb AS (SELECT item_id, count(*) AS n FROM bg GROUP BY 1),
s AS (SELECT doc_id, item_id, count(*) AS shared FROM dg JOIN bg ON dg.g = bg.g GROUP BY ALL)
SELECT s.doc_id AS doc_id, s.item_id AS item_id, shared, CAST(shared AS DOUBLE) / least(nd.n, nb.n) AS containment FROM s JOIN nd ON s.doc_id = nd.doc_id JOIN nb ON s.item_id = nb.item_id
WHERE shared >= 2 AND CAST(shared AS DOUBLE) / least(nd.n, nb.n) >= 0.2
""")
def kmer_containment(t):
    """Word trigrams that documents share with benchmark items, as a share of the smaller set."""
    grams = lambda df, name: df.select(name, similarity.word_grams(F.split("text", " "), 3).alias("grams"))
    return similarity.containment(grams(spread(t("documents")), "doc_id"), grams(t("benchmark"), "item_id"), "doc_id", "item_id", "grams", 2, 0.2)


def _nation_edges(t):
    """Nations by how much they trade; the weight is the number of lines."""
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.groupBy(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst")).agg(F.count("*").alias("w"))


@query("""
WITH RECURSIVE w AS (SELECT c_nationkey AS src, s_nationkey AS dst, count(*) AS w FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON o_orderkey = l_orderkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
e AS (SELECT src, dst FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY w DESC, dst) AS k FROM w WHERE src <> dst) WHERE k = 1),
u AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
r AS (SELECT src AS node, src AS reach FROM u UNION SELECT r.node, u.dst FROM r JOIN u ON r.reach = u.src)
SELECT node, min(reach) AS component FROM r GROUP BY node
""")
def cluster_components(t):
    """Components of nations that are linked to the one they trade most with."""
    most = rank.top1(_nation_edges(t).where("src <> dst"), ["src"], [F.col("w").desc()], ["dst"])
    return graph.components(most.select("src", "dst"))


@query()
def markov_clusters_nations(t):
    """Markov clusters of the nations' trade; iterative, so held against a dense matrix in the tests."""
    named = lambda c: F.concat(F.lit("n"), F.col(c).cast("string"))
    edges = _nation_edges(t).select(named("src").alias("src"), named("dst").alias("dst"), F.col("w").cast("double").alias("w"))
    return graph.markov_clusters(edges)


@query()
def ladder_suppliers(t):
    """Nested clusterings of suppliers by thresholds; iterative, so its steps are held against dense matrices and each other in the tests."""
    key = lambda a, n: F.floor(F.col(a) / n)
    side = lambda name: t("supplier").select(F.col("s_suppkey").alias(name), key("s_suppkey", 12).alias("part"))
    w = F.when(key("src", 3) == key("dst", 3), 90.0).when(key("src", 6) == key("dst", 6), 70.0).otherwise(10.0) + (F.col("src") * 7 + F.col("dst") * 3) % 5
    edges = side("src").join(side("dst"), "part").where("src < dst").select("src", "dst", w.alias("w"))
    steps = [df.select("member", "cluster_id", F.lit(x).alias("step")) for x, df in graph.ladder(edges).items()]
    return dataflow.mix(*steps)


@query()
def greedy_clusters_nations(t):
    """Greedy clusters of nations that trade more than the average; sequential by nature, so held against a loop in the tests."""
    edges = _nation_edges(t)
    mean = edges.agg(F.avg("w")).first()[0] or 0.0
    near = edges.where(F.col("w") >= 1.15 * mean).select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))
    nodes = t("customer").groupBy(F.col("c_nationkey").cast("string").alias("member")).agg(F.count("*").alias("length"))
    return graph.greedy_clusters(nodes, near)


@query("""
SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'toxic' WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'labelled' ELSE 'residual' END AS step FROM documents
""")
def cascade_residual(t):
    """Rows with the first of several tables that knows them, and what is left."""
    labels = t("labels")
    found, rest = dataflow.residuals(t("documents").select("doc_id"), "doc_id", [("toxic", labels.where("toxic = 1")), ("labelled", labels)])
    return found.unionByName(rest.withColumn("step", F.lit("residual")))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000")
def union_strict(t):
    """Both inputs' rows, those of both twice."""
    o = t("orders")
    return dataflow.mix(o.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"), o.where("o_totalprice > 100000").select("o_orderkey", "o_custkey"))


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(t):
    return t("orders").select("o_custkey", "o_orderstatus").distinct()


@query("SELECT doc_id, list_has_any(string_split(text, ' '), ['the', 'der', 'la', 'que']) AS any_of, len(string_split(text, ' ')) AS n_parts, list_contains(string_split(text, ' '), 'and') AS has_and FROM documents")
def array_overlap(t):
    words = F.split("text", " ")
    return t("documents").withColumn("w", words).select("doc_id", exprs.overlaps("w", ["the", "der", "la", "que"]).alias("any_of"), F.size("w").cast("long").alias("n_parts"), F.array_contains("w", "and").alias("has_and"))


@query("SELECT p_partkey, string_split(p_name, ' ')[1] AS first_part, string_split(p_name, ' ')[2] AS second_part, string_split(p_name, ' ')[9] AS no_part FROM part")
def lineage_rank(t):
    p = lambda i: exprs.part("p_name", " ", i)
    return t("part").select("p_partkey", p(0).alias("first_part"), p(1).alias("second_part"), p(8).alias("no_part"))


@query("SELECT p_partkey, CASE WHEN strpos(p_name, 'a') > 0 THEN substr(p_name, 1, strpos(p_name, 'a') - 1) || '_' || substr(p_name, strpos(p_name, 'a') + 1) ELSE p_name END AS first_only, replace(p_name, 'a', '_') AS all_of FROM part")
def replace_first(t):
    return t("part").select("p_partkey", exprs.replace_first("p_name", "a", "_").alias("first_only"), F.replace("p_name", F.lit("a"), F.lit("_")).alias("all_of"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(t):
    return t("events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT batch, count(*) AS n, min(s_suppkey) AS first_id, max(s_suppkey) AS last_id FROM (SELECT s_suppkey, CAST((row_number() OVER (ORDER BY s_suppkey) - 1) // 7 AS BIGINT) AS batch FROM supplier) GROUP BY batch")
def batch_collate(t):
    lists = dataflow.collate(t("supplier").select("s_suppkey"), ["s_suppkey"], 7, "s_suppkey")
    return lists.select("batch", F.size("items").cast("long").alias("n"), F.get("items", F.lit(0)).alias("first_id"), F.element_at("items", -1).alias("last_id"))


@query("SELECT o_custkey, array_to_string(list_sort(list(o_orderkey)), ',') AS orders FROM orders GROUP BY 1 HAVING count(*) > 12")
def group_tuple_having(t):
    return dataflow.group_tuple(t("orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 12).select("o_custkey", F.array_join(F.transform("o_orderkey", lambda x: x.cast("string")), ",").alias("orders"))


@query("SELECT r_name, segment FROM region, (SELECT DISTINCT c_mktsegment AS segment FROM customer) s")
def cross_combine(t):
    return dataflow.combine(t("region").select("r_name"), t("customer").select(F.col("c_mktsegment").alias("segment")).distinct())


@query("""
SELECT n.k AS k, n_name, r_name, customers, suppliers FROM (SELECT n_nationkey AS k, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) n
JOIN (SELECT c_nationkey AS k, count(*) AS customers FROM customer GROUP BY 1) c ON n.k = c.k JOIN (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1) s ON n.k = s.k
""")
def key_combine(t):
    n = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("k"), "n_name", "r_name")
    c = t("customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    s = t("supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return dataflow.combine_all([n, c, s], ["k"])


@query("""
SELECT l_orderkey, n, n_l_returnflag, n_l_linenumber FROM (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_returnflag) AS n_l_returnflag, count(DISTINCT l_linenumber) AS n_l_linenumber FROM lineitem GROUP BY 1)
WHERE n_l_returnflag <> 1 OR n_l_linenumber <> n
""")
def validate_groups(t):
    """Groups whose rows differ where they must agree, or agree where they must differ."""
    return dataflow.invalid_groups(t("lineitem"), "l_orderkey", ["l_returnflag"], ["l_linenumber"])


@query("""
WITH g AS (SELECT event_type, CAST(sum(CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_plasmid, CAST(sum(CASE WHEN user_id % 3 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_chrom, CAST(sum(CASE WHEN user_id % 3 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_viral FROM events WHERE value <= 50 GROUP BY 1),
h AS (SELECT DISTINCT event_type FROM events)
SELECT h.event_type AS hmm, coalesce(n_plasmid, 0) AS n_plasmid, coalesce(n_chrom, 0) AS n_chrom, coalesce(n_viral, 0) AS n_viral FROM h LEFT JOIN g ON h.event_type = g.event_type WHERE greatest(coalesce(n_plasmid, 0), coalesce(n_chrom, 0), coalesce(n_viral, 0)) >= 10
""")
def pivot_train(t):
    """Counts by two labels with a least size, of the classifier's training."""
    from sequoir.plans.verify import train

    kind = F.when(F.col("user_id") % 3 == 0, "plasmid").when(F.col("user_id") % 3 == 1, "chrom").otherwise("viral")
    hits = t("events").select(F.col("event_type").alias("hmm"), kind.alias("kind"), F.when(F.col("value") <= 50, 1e-9).otherwise(1.0).alias("i_evalue"))
    return train(hits, t("events").select(F.col("event_type").alias("hmm"))).select("hmm", "n_plasmid", "n_chrom", "n_viral")


@query("""
WITH o AS (SELECT o_custkey, CAST(epoch(o_orderdate) AS BIGINT) // 86400 AS s, CAST(epoch(o_orderdate) AS BIGINT) // 86400 + 40 AS e FROM orders),
m AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM o),
i AS (SELECT *, sum(n) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl FROM m),
g AS (SELECT o_custkey, isl, min(s) AS a, max(e) AS b FROM i GROUP BY ALL) SELECT o_custkey, CAST(sum(b - a) AS BIGINT) AS covered FROM g GROUP BY 1
""")
def coverage_sweep(t):
    """Days that intervals cover together; null for customers whose orders all lack a date."""
    orders = t("orders").select("o_custkey", epoch("o_orderdate").alias("at")).withColumn("s", F.expr("at div 86400"))
    return intervals.covered(orders.select("o_custkey", "s", (F.col("s") + 40).alias("e")), ["o_custkey"], "s", "e")


@query("SELECT item_id, translate(reverse(text), 'ACGTacgt', 'TGCAtgca') AS rc FROM benchmark")
def revcomp_text(t):
    return t("benchmark").select("item_id", exprs.reverse_complement("text").alias("rc"))


@query("""
WITH r AS (SELECT user_id, event_id, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS hit, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT event_id, CAST(sum(hit) OVER (PARTITION BY user_id, p % 3 ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS BIGINT) AS in_window FROM r
""")
def rolling_codon(t):
    """Counts in a sliding window of every third place."""
    from pyspark.sql import Window

    placed = t("events").withColumn("p", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))).withColumn("frame", F.col("p") % 3)
    hit = F.when(F.col("event_type") == "click", 1).otherwise(0)
    return placed.select("event_id", F.sum(hit).over(Window.partitionBy("user_id", "frame").orderBy("p").rowsBetween(-19, 0)).alias("in_window"))


@query("""
WITH v AS (SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'S: ' || n_name || '1234; L:' || n_name || '5678 (10.200)' ELSE n_name || '9999, X1:Y:Z, ' || n_name || '0001' END AS acc FROM nation),
p AS (SELECT n_nationkey, unnest(string_split(replace(replace(acc, ' ', ''), ',', ';'), ';')) AS part, unnest(range(1, len(string_split(replace(replace(acc, ' ', ''), ',', ';'), ';')) + 1)) AS i FROM v),
q AS (SELECT n_nationkey, i, CASE WHEN strpos(part, ':') > 0 THEN string_split(part, ':')[1] END AS seg, CASE WHEN strpos(part, ':') > 0 THEN string_split(part, ':')[2] ELSE part END AS txt FROM p WHERE len(string_split(part, ':')) <= 2)
SELECT n_nationkey, CAST(i AS INTEGER) AS acc_index, seg AS segment, CASE WHEN regexp_matches(txt, '^(\\w+)\\s*\\((\\d+)\\.(\\w+)\\)') THEN regexp_extract(txt, '^(\\w+)\\s*\\((\\d+)\\.(\\w+)\\)', 1) ELSE txt END AS accession, regexp_extract(txt, '^(\\w+)\\s*\\((\\d+)\\.(\\w+)\\)', 2) AS start_loc FROM q
""")
def accession_explode(t):
    """Lists of accessions with segments and ranges as rows."""
    from sequoir.plans.taxonomy import accessions

    acc = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("S: "), "n_name", F.lit("1234; L:"), "n_name", F.lit("5678 (10.200)"))).otherwise(F.concat("n_name", F.lit("9999, X1:Y:Z, "), "n_name", F.lit("0001")))
    table = t("nation").select("n_nationkey", F.lit("E").alias("Exemplar or additional isolate"), acc.alias("Virus GENBANK accession"))
    return accessions(table).select("n_nationkey", F.col("Accession_Index").alias("acc_index"), F.col("Segment_Name").alias("segment"), F.col("Accession").alias("accession"), F.col("Start_Loc").alias("start_loc"))


@query("SELECT o_orderkey, o_orderdate < TIMESTAMP '1995-01-01' AS early, strftime(o_orderdate, '%Y_%m_%d') AS stamp, abs(CAST(round(o_totalprice * 100) AS BIGINT) - 10000000) AS gap FROM orders")
def dates_and_gaps(t):
    return t("orders").select("o_orderkey", (F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp")).alias("early"), F.date_format("o_orderdate", "yyyy_MM_dd").alias("stamp"), F.abs(cents("o_totalprice") - 10000000).alias("gap"))


@query("SELECT url_key, count(*) AS n FROM (SELECT nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') AS url_key FROM pages) GROUP BY 1")
def regex_key(t):
    """A key captured from a name, null where there is none."""
    return dataflow.keyed_by_name(t("pages"), "url", "/([a-z]{2})/", "url_key").groupBy("url_key").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, TRY_CAST(CASE WHEN l_linenumber = 3 THEN 'NA' ELSE CAST(l_linenumber AS VARCHAR) END AS DOUBLE) AS n, CASE WHEN l_linenumber = 3 THEN 1 WHEN l_linenumber > 5 THEN 2 END AS c FROM lineitem")
def tolerant_numbers(t):
    """Texts that are no number become null; a CASE without ELSE is null."""
    text = F.when(F.col("l_linenumber") == 3, "NA").otherwise(F.col("l_linenumber").cast("string"))
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", exprs.number_or_null(text).alias("n"), F.when(F.col("l_linenumber") == 3, 1).when(F.col("l_linenumber") > 5, 2).alias("c"))


@query("SELECT conv_id, max(CASE WHEN turn = 0 THEN role END) AS first_role, count(*) AS n, coalesce(sum(CASE WHEN role = 'user' THEN length(text) END), 0)::BIGINT AS user_chars FROM conversations GROUP BY 1")
def conditional_aggregates(t):
    c = F.col
    return t("conversations").groupBy("conv_id").agg(F.max(F.when(c("turn") == 0, c("role"))).alias("first_role"), F.count("*").alias("n"), F.coalesce(F.sum(F.when(c("role") == "user", F.length("text"))), F.lit(0)).cast("long").alias("user_chars"))


@query("SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_windows(t):
    """Counts by day and type, by a stream that reads the events to their end."""
    from sequoir.streaming.ledger import windowed_counts

    path, schema, spark = _stream_path(t, "events")
    stream = spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = windowed_counts(stream, "1 day", "1 day").select(F.unix_timestamp("window_start").alias("day"), "event_type", "n")
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    run = counts.writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{out}/rows")).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def _stream_path(t, name: str):
    """Folder and glob of a table's files for a stream, which reads folders; its schema; the session."""
    df = t(name)
    files = df.inputFiles()
    folder = files[0].rsplit("/", 1)[0]
    return (folder if folder.endswith(".parquet") else f"{folder}/{name}.parquet*"), df.schema, df.sparkSession


@query("SELECT md5(text) AS hash, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def stream_ledger(t):
    """New hashes by a streamed ledger; a second run over the same files finds none."""
    from sequoir.streaming.ledger import grow_ledger

    path, schema, spark = _stream_path(t, "documents")
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(schema).parquet(path)
    hashed = dedup.with_hash(stream, "text").select("doc_id", "hash")
    grow_ledger(hashed, out, f"{out}/checkpoint", "hash", "doc_id").awaitTermination()
    return spark.read.parquet(f"{out}/new").select("hash", "doc_id")


from sequoir.plans import composites, tables  # noqa: E402, F401 - they register themselves
