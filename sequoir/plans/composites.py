"""The composites as queries over tables derived from the star schema, each with its SQL.

A derived table is stated once, in SQL that Spark and DuckDB both read; what a
composite makes of it is stated twice, as the composite itself and in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.operators import similarity
from sequoir.plans import annotate, batching, classify, host, lifestyle, naming, release, taxonomy, verify
from sequoir.plans.queries import QUERIES, SQL

BASE = "region nation customer supplier part orders lineitem events documents".split()

_CONTIG = "'g' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 7 = 0 THEN '|provirus_1_9' ELSE '' END"

INPUTS = {
    "summary": f"""SELECT {_CONTIG} AS seq_name, CAST(o_totalprice AS DOUBLE) * 0.000004 AS virus_score, o_orderkey % 9 AS n_hallmarks,
CASE o_orderkey % 4 WHEN 0 THEN 'Viruses;Duplodnaviria;Heunggongvirae;Uroviricota;Caudoviricetes;;Fam' || CAST(o_orderkey % 5 AS STRING) WHEN 1 THEN 'Unclassified' WHEN 2 THEN 'Viruses;;;;;;Anelloviridae' ELSE NULL END AS taxonomy FROM {{orders}}""",
    "genes": """SELECT 'g' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) AS gene, CASE WHEN l_suppkey % 5 = 0 THEN 'NA' ELSE 'M' || CAST(l_suppkey % 9 AS STRING) END AS marker,
CASE WHEN l_suppkey % 11 = 0 THEN 1 ELSE 0 END AS plasmid_hallmark, CASE l_partkey % 6 WHEN 0 THEN 'A1;B2' WHEN 1 THEN 'Z1' WHEN 2 THEN 'B2;C3' ELSE NULL END AS annotation_accessions,
CASE WHEN l_suppkey % 3 = 0 THEN 'Inoviridae sp' ELSE 'other' END AS taxname FROM {lineitem}""",
    "quality": f"""SELECT {_CONTIG} AS contig_id, o_custkey * 37 AS contig_length, CAST(o_custkey % 101 AS DOUBLE) AS completeness,
CASE o_orderkey % 3 WHEN 0 THEN 'AAI-based (high-confidence)' WHEN 1 THEN 'DTR (low)' ELSE 'HMM-based' END AS completeness_method, o_custkey % 7 AS viral_genes, o_custkey % 4 AS host_genes,
CASE WHEN o_orderkey % 13 = 0 THEN '>1 viral region' WHEN o_orderkey % 5 = 0 THEN 'short' ELSE NULL END AS warnings FROM {{orders}} WHERE o_orderkey % 10 <> 0""",
    "verdicts": f"""SELECT {_CONTIG} AS contig, CASE o_custkey % 4 WHEN 0 THEN 'Virus' WHEN 1 THEN 'Chromosome' WHEN 2 THEN 'Plasmid' ELSE 'Uncertain - too short' END AS prediction,
CASE WHEN o_orderkey % 8 = 0 THEN '-' ELSE CAST(o_custkey % 40 - 10 AS STRING) || '.50' END AS score FROM {{orders}} WHERE o_orderkey % 6 <> 0""",
    "dtr": f"SELECT {_CONTIG} AS seq_name FROM {{orders}} WHERE o_orderkey % 9 = 1",
    "classified": """SELECT 'c' || CAST(c_custkey AS STRING) AS seq_name, CASE c_custkey % 3 WHEN 0 THEN 'confident' WHEN 1 THEN 'uncertain' ELSE 'non-viral' END AS virus_classification,
CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey * 41 END AS contig_length, c_custkey * 17 AS proviral_length, CAST(c_custkey % 101 AS DOUBLE) AS completeness,
CASE c_custkey % 5 WHEN 0 THEN 'DTR (high)' WHEN 1 THEN 'AAI-based (high-confidence)' WHEN 2 THEN 'HMM-based' ELSE NULL END AS completeness_method,
CASE WHEN c_custkey % 2 = 0 THEN 'NCBI' ELSE 'ENA' END AS source_db,
CASE c_custkey % 6 WHEN 0 THEN 'Viruses;Duplodnaviria;Heunggongvirae;Uroviricota;Caudoviricetes;;Fam' WHEN 1 THEN 'Viruses;;;;;;Anelloviridae' WHEN 2 THEN 'Viruses;;;;;;' WHEN 3 THEN 'Viruses;Monodnaviria' WHEN 4 THEN 'Viruses;A;B;C;Malgrandaviricetes' ELSE NULL END AS taxonomy,
CASE WHEN c_custkey % 7 = 0 THEN 'DTR' ELSE 'linear' END AS topology, CASE WHEN c_custkey % 8 = 0 THEN 'Yes' ELSE 'No' END AS provirus FROM {customer}""",
    "completeness": "SELECT 'c' || CAST(c_custkey AS STRING) AS contig_id, CAST(c_custkey * 3 % 101 AS DOUBLE) AS aai_completeness FROM {customer} WHERE c_custkey % 11 <> 0",
    "sequences": "SELECT 'c' || CAST(c_custkey AS STRING) AS id, c_name AS seq FROM {customer}",
    "hashes": "SELECT CAST(doc_id AS STRING) AS original_id, md5(text) AS hash, CAST(length(text) AS STRING) AS seq FROM {documents}",
    "methods": "SELECT CAST(doc_id AS STRING) AS seq_name, CASE doc_id % 3 WHEN 0 THEN 'DTR' WHEN 1 THEN 'AAI' ELSE NULL END AS completeness_method FROM {documents} WHERE doc_id % 4 <> 0",
    "ledger": "SELECT CAST(doc_id AS STRING) AS original_id, md5(text) AS hash, 'AAI' AS completeness_method FROM {documents} WHERE source = 'src1'",
    "marker_hits": """SELECT 'g' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber % 3 AS STRING) AS protein, 'P' || CAST(l_partkey % 50 AS STRING) AS hallmark,
CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE CAST(l_suppkey % 10 AS DOUBLE) * 0.5 END AS evalue FROM {lineitem}""",
    "markers": "SELECT 'P' || CAST(p_partkey % 60 AS STRING) AS marker, p_size % 2 AS virus, CASE WHEN p_size % 5 = 0 AND p_partkey % 2 = 0 THEN 1 ELSE 0 END AS plasmid FROM {part} WHERE p_partkey <= 70",
    "gene_hits": """SELECT 's' || CAST(l_suppkey AS STRING) || '_' || CAST(l_orderkey % 20 AS STRING) AS q_gene,
CASE WHEN l_returnflag = 'R' THEN 's' || CAST(l_suppkey AS STRING) || '_' || CAST(l_orderkey % 20 AS STRING) ELSE 's' || CAST(l_partkey % 10 + 1 AS STRING) || '_' || CAST(l_linenumber AS STRING) END AS r_gene, CAST(l_quantity AS DOUBLE) AS bitscore FROM {lineitem}""",
    "scores": "SELECT 'c' || CAST(o_custkey AS STRING) AS seq_name, 'Sp' || CAST(o_orderkey % 25 AS STRING) || '_x_y--ACC' || CAST(o_orderkey AS STRING) AS ref, CAST(o_orderkey % 100 AS DOUBLE) AS normscore FROM {orders}",
    "vmr": """SELECT 'Sp' || CAST(n_nationkey AS STRING) || ' x_y' AS species, 'Gen' || CAST(n_regionkey AS STRING) AS genus, 'Fam' || CAST(n_regionkey AS STRING) AS family, 'Ord' || CAST(n_regionkey AS STRING) AS ord,
CASE n_regionkey WHEN 0 THEN 'Caudoviricetes' WHEN 1 THEN 'Cardeaviricetes' WHEN 2 THEN 'No class' ELSE 'Malgrandaviricetes' END AS class_ FROM {nation}""",
    "spacers": """SELECT 'GCA_' || CAST(l_suppkey % 30 AS STRING) || '.1:' || CAST(l_linenumber AS STRING) AS spacer, 't' || CAST(l_orderkey % 400 AS STRING) AS target, l_partkey AS start, l_partkey + 30 AS stop, l_linenumber % 3 AS mismatches FROM {lineitem}""",
    "kmer_cells": "SELECT 'GCA_' || CAST(l_suppkey % 30 AS STRING) || '.1_asm' AS row_, 't' || CAST(l_orderkey % 400 AS STRING) AS col_, CAST(l_discount AS DOUBLE) * 4 AS value FROM {lineitem}",
    "hosts": "SELECT 'GCA_' || CAST(n_nationkey AS STRING) || '.1' AS Genome, 'tax' || CAST(n_regionkey AS STRING) AS Repr_taxonomy FROM {nation}",
    "bacphlip": "SELECT 'c' || CAST(c_custkey AS STRING) AS seq_name, CAST(c_custkey % 10 AS DOUBLE) AS virulent FROM {customer} WHERE c_custkey % 3 <> 1",
    "proteins": "SELECT 'c' || CAST(l_orderkey % 300 AS STRING) || '_' || CAST(l_linenumber AS STRING) AS protein_id, 'h' || CAST(l_partkey % 500 AS STRING) AS hash FROM {lineitem}",
    "pharokka": """SELECT 'h' || CAST(p_partkey AS STRING) AS id, CASE p_size % 4 WHEN 0 THEN 'site integrase' WHEN 1 THEN 'DNA recombinase' WHEN 2 THEN 'tail' ELSE NULL END AS annot,
CASE WHEN p_size % 3 = 0 THEN 'integration and excision' ELSE 'other' END AS category FROM {part} WHERE p_partkey < 400""",
    "phold": """SELECT 'h' || CAST(p_partkey AS STRING) AS id, CASE p_size % 5 WHEN 0 THEN 'integrase' ELSE 'head' END AS annot,
CASE WHEN p_size % 7 = 0 THEN 'integration and excision' ELSE NULL END AS category, CASE p_size % 3 WHEN 0 THEN 'pharokka' WHEN 1 THEN 'foldseek' ELSE 'none' END AS method FROM {part} WHERE p_partkey >= 100 AND p_partkey < 450""",
    "empathi": "SELECT 'h' || CAST(p_partkey AS STRING) AS id, CAST(p_size % 11 AS DOUBLE) * 0.1 AS integration FROM {part} WHERE p_partkey < 500",
    "structures": "SELECT 'h' || CAST(p_partkey AS STRING) AS id, p_name AS reference, p_retailprice AS score FROM {part} WHERE p_size < 20",
    "annotations": "SELECT 'h' || CAST(p_partkey AS STRING) AS id, CASE p_size % 4 WHEN 0 THEN 'UniRef:UniRef90_X' WHEN 1 THEN 'UniParc:UPI' WHEN 2 THEN 'SO:0001217' ELSE NULL END AS accession FROM {part}",
    "alignments": """SELECT 's' || CAST(l_partkey % 100 AS STRING) AS spacer, CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE 16 END AS flag, 't' || CAST(l_suppkey % 10 AS STRING) AS target, l_orderkey % 5000 + 1 AS start,
CAST(l_linenumber + 20 AS STRING) || 'M' AS cigar, substr('ACGTACGTACGTACGTACGTACGTACGTACGT', 1, CAST(l_linenumber + 20 AS INT)) AS seq, CAST(l_linenumber % 3 AS STRING) AS nm, CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE CAST(l_linenumber AS STRING) END AS md FROM {lineitem}""",
    "masked": "SELECT 't' || CAST(o_custkey % 10 AS STRING) AS target, (o_orderkey * 13) % 5000 AS block_start, (o_orderkey * 13) % 5000 + 4 AS block_end FROM {orders} WHERE o_orderkey % 20 = 0",
    "contigs": "SELECT 'c' || CAST(o_orderkey AS STRING) AS id, o_custkey * 10 AS length, CASE WHEN o_orderkey % 9 = 0 THEN '+' ELSE '-' END AS circular FROM {orders}",
    "domains": """SELECT 'c' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber % 2 AS STRING) AS gene, 'D' || CAST(l_partkey % 40 AS STRING) AS hmm, CAST(l_suppkey % 8 AS DOUBLE) AS score,
CAST(l_partkey % 90 AS STRING) AS start_text, CAST(l_partkey % 90 AS DOUBLE) AS start, CAST(l_partkey % 90 + 30 AS DOUBLE) AS stop FROM {lineitem}""",
    "classifier": """SELECT 'D' || CAST(p_partkey AS STRING) AS hmm, CAST(p_size + 1 AS DOUBLE) * 0.01 AS p_plasmid, CAST(p_size % 7 + 1 AS DOUBLE) * 0.03 AS p_chrom, CAST(p_size % 5 + 1 AS DOUBLE) * 0.06 AS p_viral, CAST(p_size % 3 + 1 AS DOUBLE) * 0.02 AS p_nonviral FROM {part} WHERE p_partkey < 35""",
    "training": """SELECT 'D' || CAST(l_partkey % 60 AS STRING) AS hmm, CASE l_suppkey % 3 WHEN 0 THEN 'plasmid' WHEN 1 THEN 'chrom' ELSE 'viral' END AS kind, CASE WHEN l_linenumber % 4 = 0 THEN 0.1 ELSE 0.0 END AS i_evalue FROM {lineitem}""",
    "hmms": "SELECT 'D' || CAST(p_partkey AS STRING) AS hmm FROM {part} WHERE p_partkey < 80",
    "hsps": """SELECT 'q' || CAST(l_orderkey % 500 AS STRING) AS query, 1000 AS query_length, l_suppkey % 6 AS hit, CASE l_suppkey % 6 WHEN 0 THEN 'a phage' WHEN 1 THEN 'plasmid p' WHEN 2 THEN 'chromosome 1' WHEN 3 THEN 'complete genome' WHEN 4 THEN 'virus v' ELSE 'thing' END AS title,
CASE WHEN l_linenumber % 4 = 0 THEN 1.0 ELSE 0.001 END AS evalue, l_partkey % 900 AS start, l_partkey % 900 + l_linenumber * 15 AS stop FROM {lineitem}""",
    "isolates": """SELECT n_nationkey AS sort, CASE n_nationkey % 3 WHEN 0 THEN 'E' WHEN 1 THEN 'A' ELSE '' END AS kind,
CASE n_nationkey % 4 WHEN 0 THEN 'L: AB1234' || CAST(n_nationkey AS STRING) || '; S: CD5678' WHEN 1 THEN 'NC_00' || CAST(n_nationkey + 100 AS STRING) || ' (12.3456)' WHEN 2 THEN 'a:b:c, XY99999' ELSE 'none' END AS listed FROM {nation}""",
    "items": """SELECT 'o' || CAST(o_orderkey AS STRING) AS sample, CASE o_custkey % 5 WHEN 0 THEN 'ATB' WHEN 1 THEN 'LOGAN' WHEN 2 THEN 'NCBI' WHEN 3 THEN 'ENA' ELSE NULL END AS source_db, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'u' || CAST(o_orderkey AS STRING) END AS fna FROM {orders}""",
}


INPUTS |= {
    "relatives": """SELECT 's' || CAST(s_suppkey AS STRING) AS id, translate(md5(CAST(floor(s_suppkey / 4) AS STRING)) || substr(md5('y' || CAST(s_suppkey AS STRING)), 1, 4 + 4 * CAST(s_suppkey % 4 AS INT)) || md5('z' || CAST(floor(s_suppkey / 4) AS STRING)),
'0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM {supplier}""",
    "similar_places": """SELECT 'n' || CAST(l_suppkey % 25 AS STRING) AS r_gene, CAST(l_quantity AS DOUBLE) + 50 AS identity, CASE WHEN l_orderkey % 2 = 0 THEN l_partkey % 550 + 1 ELSE l_partkey % 550 + 1 + l_linenumber * 3 END AS tstart,
CASE WHEN l_orderkey % 2 = 0 THEN l_partkey % 550 + 1 + l_linenumber * 3 ELSE l_partkey % 550 + 1 END AS tend FROM {lineitem} WHERE l_partkey % 11 = 0""",
    "placed_in": "SELECT 'n' || CAST(n_nationkey AS STRING) AS id, repeat(translate(md5(n_name), '0123456789abcdef', 'ACGTACGTACGTACGT'), 18) AS seq FROM {nation}",
    "detections": """SELECT p_partkey AS id, CAST(p_size AS DOUBLE) * 0.02 AS virus_score, p_size * 400 AS length,
CASE p_partkey % 5 WHEN 0 THEN 'Viruses;A;B;C;Caudoviricetes' WHEN 1 THEN 'Viruses;Inoviridae' WHEN 2 THEN 'Unclassified' WHEN 3 THEN 'x;Faserviricetes;Inoviridae' ELSE 'Viruses;Anelloviridae' END AS taxonomy FROM {part}""",
    "checked": """SELECT p_partkey AS id, CAST(p_size * 2 AS DOUBLE) AS aai_completeness, CAST(p_partkey % 9 AS DOUBLE) * 0.2 AS kmer_freq, p_size * 300 AS contig_length,
CASE WHEN p_partkey % 7 = 0 THEN 'NA' WHEN p_partkey % 11 = 0 THEN '0' ELSE CAST(p_partkey % 40 * 200 AS STRING) END AS aai_expected_length FROM {part}""",
    "ani": """SELECT 's' || CAST(l_suppkey AS STRING) AS query, 's' || CAST(l_partkey % 40 AS STRING) AS reference, 1.0 - CAST(l_discount AS DOUBLE) AS ani, CAST(l_linenumber AS DOUBLE) * 0.15 AS qcov, CAST(l_tax AS DOUBLE) * 12 AS rcov FROM {lineitem}""",
    "marks": "SELECT p_partkey AS id, p_size % 3 AS PLASMID_HALLMARK, p_partkey % 4 AS VIRUS_HALLMARK FROM {part}",
    "repeats": """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN substr(md5(c_name), 1, 22 + CAST(c_custkey % 5 AS INT)) || md5(c_mktsegment || c_name) || substr(md5(c_name), 1, 22 + CAST(c_custkey % 5 AS INT)) ELSE md5(c_name) || md5(c_mktsegment || c_name) END AS seq FROM {customer}""",
    "long_repeats": """SELECT n_nationkey AS id, CASE n_nationkey % 4 WHEN 0 THEN repeat(md5(n_name), 1 + n_nationkey * 3) || repeat(md5('z' || n_name), 1 + n_nationkey * 3) WHEN 1 THEN repeat('A', 100 * n_nationkey)
ELSE repeat(md5(n_name), 1 + n_nationkey * 3) || md5('z' || n_name) || repeat(md5(n_name), 1 + n_nationkey * 3) END AS seq FROM {nation}""",
    "circles": """SELECT id, CASE k WHEN 0 THEN r || a || r || b || r || c WHEN 1 THEN r || b || r || a || r || c WHEN 2 THEN a || r || b || r || c || r ELSE translate(reverse(r || a || r || b || r || c), 'ACGT', 'TGCA') END AS seq FROM (
SELECT n_nationkey * 4 + k AS id, k, translate(md5(n_name), '0123456789abcdef', 'ACGTACGTACGTACGT') AS r, translate(md5('a' || n_name), '0123456789abcdef', 'ACGTACGTACGTACGT') AS a,
translate(md5('b' || n_name), '0123456789abcdef', 'ACGTACGTACGTACGT') AS b, translate(md5('c' || n_name), '0123456789abcdef', 'ACGTACGTACGTACGT') AS c FROM {nation} CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(k)) AS x""",
    "called": "SELECT 'c' || CAST(l_orderkey AS STRING) AS contig, l_linenumber AS number, l_partkey AS start FROM {lineitem}",
    "headers": """SELECT 'UniRef90_P' || CAST(p_partkey AS STRING) || CASE p_size % 3 WHEN 0 THEN ' Uncharacterized protein n=' WHEN 1 THEN ' Tail fiber n=' ELSE ' Phage protein n=' END || CAST(p_size AS STRING) || ' Tax=T TaxID=1 RepID=R' || CAST(p_partkey AS STRING) AS description FROM {part}""",
}


#: Derived tables that Spark reads in words of its own to get what DuckDB gets: there floor() gives a DOUBLE, so the number's text ends in .0.
SPARK_INPUTS = {"relatives": INPUTS["relatives"].replace("CAST(floor(s_suppkey / 4) AS STRING)", "CAST(floor(s_suppkey / 4) AS STRING) || '.0'")}


def composite(*inputs: str, sql: str):
    """Register a function of (reader of derived tables) under its name, with SQL that follows the inputs as CTEs."""

    def register(fn: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark, sf_dir: str) -> DataFrame:
            tables = {x: spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in BASE if any("{" + x + "}" in INPUTS[i] for i in inputs)}
            return fn(lambda name: spark.sql(SPARK_INPUTS.get(name, INPUTS[name]), **{k: v for k, v in tables.items() if "{" + k + "}" in INPUTS[name]}))

        QUERIES[fn.__name__] = run
        own = ", ".join(f"{x} AS ({INPUTS[x].format(**{b: b for b in BASE})})" for x in inputs)
        SQL[fn.__name__] = f"WITH {own}{' ' if sql.lstrip().startswith('SELECT') else ', '}{sql}"
        return fn

    return register


_COUNTS = """
g AS (SELECT regexp_replace(gene, '_[^_]*$', '') AS genome, * FROM genes),
cnt AS (SELECT genome, CAST(sum(plasmid_hallmark) AS BIGINT) AS plasmid_hallmarks,
  CAST(sum(CASE WHEN list_has_any(string_split(annotation_accessions, ';'), ['A1', 'C3']) THEN 1 ELSE 0 END) AS BIGINT) AS conj_genes,
  CAST(sum(CASE WHEN list_contains(string_split(annotation_accessions, ';'), 'Z1') THEN 1 ELSE 0 END) AS BIGINT) AS zot_genes,
  CAST(sum(CASE WHEN contains(taxname, 'Inoviridae') THEN 1 ELSE 0 END) AS BIGINT) AS inoviridae_marker_genes FROM g GROUP BY 1),
m AS (SELECT genome, marker, count(marker) AS n FROM g GROUP BY ALL),
d AS (SELECT genome, CAST(sum(n) AS BIGINT) AS total_markers, CAST(sum(CASE WHEN n > 1 THEN 1 END) AS BIGINT) AS dup FROM m GROUP BY 1)
"""


@composite("genes", sql=_COUNTS + "SELECT cnt.*, total_markers, coalesce(dup, 0) AS n_dup_markers, 1 + CAST(dup AS DOUBLE) / total_markers AS marker_duplicity FROM cnt LEFT JOIN d USING (genome)")
def c1_gene_counts(t):
    """Hallmarks, conjugation, toxin and family genes of each genome, with its marker duplicity."""
    return classify.gene_counts(t("genes"), ["A1", "C3"], "Z1")


@composite("summary", "genes", "quality", "verdicts", "dtr", sql=_COUNTS + """,
q AS (SELECT contig_id, CASE WHEN contig_id IN (SELECT seq_name FROM dtr) AND completeness >= 80 THEN 100 ELSE completeness END AS completeness,
  CASE WHEN contig_id IN (SELECT seq_name FROM dtr) AND completeness >= 80 THEN 'DTR' ELSE completeness_method END AS completeness_method, viral_genes, host_genes, warnings FROM quality),
j AS (SELECT s.*, regexp_replace(s.seq_name, '\\|provirus[^|provirus]*$', '') AS genome FROM summary s),
k AS (SELECT j.*, cnt.* EXCLUDE (genome), 1 + CAST(dup AS DOUBLE) / total_markers AS marker_duplicity, q.* EXCLUDE (contig_id), prediction, CASE WHEN score = '-' THEN 0 ELSE CAST(score AS DOUBLE) END AS score,
  CASE WHEN contains(taxonomy, ';') THEN trim(string_split(taxonomy, ';')[-1]) ELSE '' END AS family
  FROM j LEFT JOIN cnt USING (genome) LEFT JOIN d USING (genome) LEFT JOIN q ON j.seq_name = contig_id LEFT JOIN verdicts ON j.seq_name = contig
  WHERE warnings IS NULL OR NOT contains(warnings, '>1 viral region')),
f AS (SELECT seq_name, genome, completeness, completeness_method, family, marker_duplicity, score,
  CASE WHEN virus_score >= 0.95 THEN 1 ELSE 0 END + CASE WHEN prediction = 'Virus' AND score >= 15 THEN 1 ELSE 0 END
  + CASE WHEN n_hallmarks >= 3 OR (viral_genes >= 3 AND viral_genes >= 3 * host_genes) THEN 1 ELSE 0 END + CASE WHEN family <> '' THEN 1 ELSE 0 END
  + CASE WHEN zot_genes > 0 THEN 1 ELSE 0 END + CASE WHEN inoviridae_marker_genes >= 5 THEN 1 ELSE 0 END - CASE WHEN prediction IN ('Chromosome', 'Plasmid') THEN 1 ELSE 0 END
  - CASE WHEN host_genes >= 2 AND host_genes > viral_genes THEN 1 ELSE 0 END - CASE WHEN plasmid_hallmarks > 0 THEN 1 ELSE 0 END - CASE WHEN conj_genes > 0 THEN 1 ELSE 0 END
  - CASE WHEN marker_duplicity >= 1.2 THEN 7 ELSE 0 END AS total FROM k)
SELECT seq_name, genome, completeness, completeness_method, family, marker_duplicity, score, CAST(total AS INTEGER) AS total, CASE WHEN total >= 2 THEN 'confident' WHEN total >= 0 THEN 'uncertain' ELSE 'non-viral' END AS label, 'db' AS source_db FROM f
""")
def c1_virus_filter(t):
    """All evidence of a sequence joined, flagged, summed up and labelled."""
    verdicts = t("verdicts").select(F.col("contig").alias("Contig name"), F.col("prediction").alias("Prediction"), F.col("score").alias("Score"), F.lit(None).cast("string").alias("Pfam hits"))
    found = classify.virus_filter(t("summary"), t("genes"), t("quality"), verdicts, t("dtr"), "db", ["A1", "C3"], "Z1")
    return found.select("seq_name", "genome", "completeness", "completeness_method", F.col("ictv_family").alias("family"), "marker_duplicity", F.col("Score").alias("score"), F.col("viral_score_sum").alias("total"), F.col("virus_classification").alias("label"), "source_db")


@composite("classified", sql="SELECT seq_name FROM classified WHERE (completeness_method LIKE '%DTR%' AND completeness >= 80) OR (source_db = 'NCBI' AND completeness >= 90 AND completeness_method = 'AAI-based (high-confidence)')")
def c2_complete_genomes(t):
    return classify.complete_genomes(t("classified"))


@composite("classified", "completeness", sql="SELECT contig_id FROM completeness WHERE aai_completeness >= 90 OR contig_id IN (SELECT seq_name FROM classified WHERE completeness_method LIKE '%DTR%')")
def c3_hq_filter(t):
    return classify.hq_filter(t("completeness"), t("classified"))


@composite("hashes", "methods", "ledger", sql="""
r AS (SELECT original_id, hash, completeness_method, row_number() OVER (PARTITION BY hash ORDER BY coalesce(contains(completeness_method, 'DTR'), false) DESC, original_id) AS k
  FROM hashes JOIN methods ON original_id = seq_name WHERE hash IS NOT NULL AND hash NOT IN (SELECT hash FROM ledger WHERE hash IS NOT NULL))
SELECT original_id, hash, completeness_method FROM r WHERE k = 1""")
def c4_unique_hash(t):
    """New hashes, one record of each, those with DTR first."""
    new, _ = release.unique_sequences(t("hashes"), t("methods"), t("ledger"))
    return new.select("original_id", "hash", "completeness_method")


@composite("hashes", "ledger", sql="SELECT DISTINCT hash AS id, seq FROM hashes WHERE hash IS NOT NULL AND hash NOT IN (SELECT hash FROM ledger WHERE hash IS NOT NULL)")
def c5_protein_hash(t):
    proteins = t("hashes").withColumnRenamed("original_id", "protein_id")
    return release.unique_proteins(proteins, t("ledger").select(F.col("original_id").alias("protein_id"), "hash"))[0]


@composite("classified", "sequences", sql="""
u AS (SELECT seq_name FROM classified WHERE virus_classification = 'uncertain' AND coalesce(contig_length, proviral_length) >= 10000)
SELECT id, seq, id IN (SELECT seq_name FROM u) AS open FROM sequences""")
def c6_uncertain_split(t):
    """Long uncertain sequences, and all others."""
    long_, rest = classify.split_uncertain(t("classified"), t("sequences"))
    return long_.withColumn("open", F.lit(True)).unionByName(rest.withColumn("open", F.lit(False)))


@composite("marker_hits", "markers", sql="""
b AS (SELECT *, row_number() OVER (PARTITION BY protein ORDER BY evalue ASC NULLS FIRST, hallmark) AS k FROM marker_hits),
kinds AS (SELECT marker, max(virus) AS v, max(plasmid) AS p FROM markers GROUP BY 1),
c AS (SELECT regexp_replace(protein, '_[^_]*$', '') AS genome, CAST(sum(coalesce(v, 0)) AS BIGINT) AS virus_hallmarks, CAST(sum(coalesce(p, 0)) AS BIGINT) AS plasmid_hallmarks FROM b LEFT JOIN kinds ON hallmark = marker WHERE k = 1 GROUP BY 1)
SELECT *, virus_hallmarks >= 2 AND plasmid_hallmarks = 0 AS confident FROM c""")
def c7_uncertain_to_confident(t):
    """Hallmarks of each genome by its proteins' best hits, and which genomes they make confident."""
    markers = t("markers").select(F.col("marker").alias("MARKER"), F.col("virus").alias("VIRUS_HALLMARK"), F.col("plasmid").alias("PLASMID_HALLMARK"))
    counts, sure = classify.uncertain_to_confident(t("marker_hits"), markers, 2)
    return counts.join(sure.withColumn("confident", F.lit(True)), "genome", "left").withColumn("confident", F.coalesce("confident", F.lit(False)))


@composite("classified", "sequences", sql="""
m AS (SELECT id, 'SEQ-' || CAST(row_number() OVER (ORDER BY id) + 100 AS VARCHAR) AS new_id FROM (SELECT DISTINCT id FROM sequences WHERE id <> 'c7'))
SELECT new_id AS seq_name, seq_name AS original_id, virus_classification FROM classified JOIN m ON seq_name = id""")
def c8_rename(t):
    """New numbered names that go on after those of the last release, and the table under them."""
    _, mapping = naming.rename(t("sequences").where("id <> 'c7'"), 100)
    return naming.classify_rename(t("classified"), mapping).select("seq_name", "original_id", "virus_classification")


@composite("gene_hits", sql="SELECT regexp_replace(q_gene, '_[0-9]+$', '') AS genome, count(*) AS genes, sum(bitscore) AS selfscore FROM gene_hits WHERE q_gene = r_gene GROUP BY 1")
def c9_self_score(t):
    return similarity.self_score(t("gene_hits"))


@composite("gene_hits", sql="""
s AS (SELECT regexp_replace(q_gene, '_[0-9]+$', '') AS query, sum(bitscore) AS selfscore FROM gene_hits WHERE q_gene = r_gene GROUP BY 1),
b AS (SELECT q_gene, regexp_replace(q_gene, '_[0-9]+$', '') AS query, regexp_replace(r_gene, '_[0-9]+$', '') AS reference, max(bitscore) AS best FROM gene_hits GROUP BY ALL),
r AS (SELECT query, reference, sum(best) AS raw FROM b WHERE query <> reference GROUP BY ALL)
SELECT query, reference, round(100 * raw / selfscore, 2) AS norm_score FROM r JOIN s USING (query) WHERE 100 * raw / selfscore >= 2""")
def c10_norm_score(t):
    return similarity.norm_score(t("gene_hits"), similarity.self_score(t("gene_hits")), 2.0)


@composite("classified", "scores", "vmr", sql="""
o AS (SELECT seq_name, taxonomy, CASE WHEN contains(taxonomy, 'Anelloviridae') THEN 'Cardeaviricetes' WHEN NOT contains(taxonomy, 'viricetes') THEN 'No class' WHEN contains(taxonomy, 'viricetes') THEN string_split(taxonomy, ';')[5] END AS class_ FROM classified),
b AS (SELECT *, row_number() OVER (PARTITION BY seq_name ORDER BY normscore DESC NULLS FIRST, ref) AS k FROM scores),
n AS (SELECT seq_name, ref, normscore, b.species AS species, genus, family, ord, class_ FROM (SELECT *, regexp_replace(string_split(ref, '--')[1], '^([^_]*)_', '\\1 ') AS species FROM b WHERE k = 1) b LEFT JOIN vmr ON b.species = vmr.species)
SELECT o.seq_name, o.taxonomy, o.class_, ref, normscore, species, genus, family, ord FROM o LEFT JOIN n ON o.seq_name = n.seq_name AND o.class_ = n.class_""")
def c11_taxonomy(t):
    """The best reference's lineage, where it is of the same class."""
    vmr = t("vmr").toDF("Species", "Genus", "Family", "Order", "Class")
    found = taxonomy.taxonomy(t("classified").select("seq_name", "taxonomy"), t("scores"), vmr)
    return found.select("seq_name", "taxonomy", F.col("Class").alias("class_"), "ref", "normscore", F.col("Species").alias("species"), F.col("Genus").alias("genus"), F.col("Family").alias("family"), F.col("Order").alias("ord"))


@composite("classified", sql="""
r AS (SELECT seq_name, replace(replace(taxonomy, 'Viruses;;;;;;Anelloviridae', 'Viruses;Monodnavira;Shotukuvirae;Commensaviricota;Cardeaviricetes;Sanitavirales;Anelloviridae'), 'Viruses;;;;;;', 'Unclassified') AS x FROM classified)
SELECT seq_name, string_split(x, ';')[5] AS class_ FROM r WHERE x IS NOT NULL AND x <> 'Unclassified'""")
def c12_taxa_split(t):
    return taxonomy.split_by(t("classified").select("seq_name", "taxonomy"), "Class").select("seq_name", F.col("Class").alias("class_"))


_VOTE = """
v AS (SELECT target, Repr_taxonomy, count(*) AS n FROM hits GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY n DESC, Repr_taxonomy) AS k, sum(n) OVER (PARTITION BY target) AS total FROM v)
SELECT target, CAST(total AS BIGINT) AS total, n AS most, Repr_taxonomy AS top, CAST(n AS DOUBLE) / total AS agreement FROM r WHERE k = 1 AND CAST(n AS DOUBLE) / total >= 0.3"""


def _voted(df: DataFrame) -> DataFrame:
    return df.toDF("target", "total", "most", "top", "agreement")


@composite("spacers", "hosts", sql="hits AS (SELECT target, Repr_taxonomy FROM spacers JOIN hosts ON string_split(spacer, ':')[1] = Genome WHERE mismatches <= 1)," + _VOTE)
def c13_crispr_host(t):
    """Host of each target by the consensus of its spacers' genomes."""
    spacers = t("spacers").select(F.col("spacer").alias("Spacer id"), F.col("target").alias("Target id"), F.col("start").alias("Start"), F.col("stop").alias("End"), F.lit("+").alias("Strand"), F.col("mismatches").alias("N mismatches"))
    return _voted(host.crispr_host(spacers, t("hosts"), least=0.3)[1])


@composite("kmer_cells", "hosts", sql="hits AS (SELECT col_ AS target, Repr_taxonomy FROM kmer_cells JOIN hosts ON regexp_extract(row_, '^(GC[AF]_[0-9]+\\.[0-9]+)', 1) = Genome WHERE value >= 0.2)," + _VOTE)
def c14_phist_host(t):
    """Host of each target by the consensus of the genomes that share its k-mers."""
    return _voted(host.phist_host(t("kmer_cells").toDF("row", "col", "value"), t("hosts"), least=0.3)[1])


@composite("classified", "bacphlip", "proteins", "pharokka", "phold", "empathi", sql="""
p AS (SELECT hash, regexp_replace(protein_id, '_[^_]*$', '') AS seq_name FROM proteins),
n AS (SELECT seq_name, annot, category FROM (SELECT id, annot, category FROM pharokka UNION ALL SELECT id, annot, category FROM phold) x LEFT JOIN p ON id = hash),
i AS (SELECT seq_name, count(*) AS integrases FROM n WHERE regexp_matches(annot, 'integrase|recombinase') GROUP BY 1),
e AS (SELECT seq_name, count(*) AS excision FROM n WHERE contains(category, 'integration and excision') GROUP BY 1),
m AS (SELECT seq_name, count(*) AS empathi FROM empathi LEFT JOIN p ON id = hash WHERE integration >= 0.9 GROUP BY 1)
SELECT c.seq_name, topology, provirus, virulent, integrases, excision, empathi FROM classified c JOIN bacphlip USING (seq_name) LEFT JOIN i USING (seq_name) LEFT JOIN e USING (seq_name) LEFT JOIN m USING (seq_name)""")
def c15_lifestyle(t):
    """Evidence of integration in each sequence, from three annotators."""
    phold = t("phold").select(F.col("id").alias("cds_id"), F.col("annot").alias("product"), F.col("category").alias("function"))
    found = lifestyle.lifestyle(t("classified"), t("bacphlip"), t("proteins"), t("pharokka").withColumnRenamed("id", "ID"), phold, t("empathi").withColumnRenamed("id", "cds_id"))
    return found.select("seq_name", "topology", "provirus", "virulent", F.col("phrog_integrases").alias("integrases"), F.col("phrog_integration_excision").alias("excision"), F.col("empathi_integration").alias("empathi"))


@composite("annotations", "structures", sql="SELECT a.id AS tag, accession, reference, score FROM annotations a LEFT JOIN structures s ON a.id = s.id")
def c19_uniprot(t):
    """Annotations with their structural hit."""
    foldseek = t("structures").select(F.col("id").alias(annotate.TAG), "reference", "score", *(F.lit(1).alias(x) for x in ("mismatch", "gapopen", "qstart", "qend", "tstart", "tend")))
    return annotate.uniprot(t("annotations").withColumnRenamed("id", annotate.TAG), foldseek).withColumnRenamed(annotate.TAG, "tag")


@composite("pharokka", "phold", "empathi", sql="""
b AS (SELECT id, annot AS phold_annot, category AS phold_category FROM phold WHERE method NOT IN ('pharokka', 'none'))
SELECT a.id AS tag, a.annot, a.category, phold_annot, phold_category, integration AS confidence FROM pharokka a LEFT JOIN b USING (id) LEFT JOIN empathi c USING (id)""")
def c19_phrogs(t):
    """Three annotators by gene; of the second only what it found itself."""
    a = t("pharokka").select(F.col("id").alias("gene"), F.lit(1.0).alias("pyhmmer_bitscore"), F.lit(0.1).alias("pyhmmer_evalue"), F.lit("1").alias("phrog"), "annot", "category")
    b = t("phold").select(F.col("id").alias("cds_id"), F.lit("2").alias("phrog"), F.col("category").alias("function"), F.col("annot").alias("product"), F.col("method").alias("annotation_method"))
    c = t("empathi").select(F.col("id").alias("ID"), F.lit("3").alias("phrog_id"), F.col("integration").alias("phynteny_confidence"))
    found = annotate.phrogs(a, b, c)
    return found.select(F.col(annotate.TAG).alias("tag"), F.col("Pharokka Annotation").alias("annot"), F.col("Pharokka Category").alias("category"), F.col("Phold Annotation").alias("phold_annot"), F.col("Phold Category").alias("phold_category"), F.col("Phynteny Confidence").alias("confidence"))


@composite("pharokka", "structures", "empathi", sql="SELECT coalesce(a.id, b.id, c.id) AS tag, annot, reference, integration FROM pharokka a FULL JOIN structures b ON a.id = b.id FULL JOIN empathi c ON coalesce(a.id, b.id) = c.id")
def c19_defense(t):
    """Every gene of any of three tables, under one key."""
    keyed = lambda name, column: t(name).select(F.col("id").alias(annotate.TAG), column)
    return annotate.defense(keyed("pharokka", "annot"), keyed("structures", "reference"), keyed("empathi", "integration")).withColumnRenamed(annotate.TAG, "tag")


@composite("annotations", "empathi", sql="SELECT id, integration FROM empathi WHERE id IN (SELECT id FROM annotations WHERE accession IS NULL OR NOT regexp_matches(accession, 'UniParc|UniRef|UserProtein'))")
def c20_no_hit(t):
    return annotate.no_hit_proteins(t("empathi"), t("annotations").select(F.col("id").alias(annotate.TAG), F.col("accession").alias("Accession")))


@composite("alignments", "masked", sql="""
h AS (SELECT spacer, target, start, start + length(seq) - 1 AS stop, CASE flag WHEN 0 THEN '+' ELSE '-' END AS strand, CAST(nm AS INTEGER) AS mismatches, cigar, coalesce(md, 'NA') AS md, seq FROM alignments),
o AS (SELECT *, row_number() OVER (PARTITION BY target, spacer, start, strand ORDER BY cigar, seq, md, mismatches) AS k FROM h),
l AS (SELECT o.*, EXISTS (SELECT 1 FROM masked m WHERE m.target = o.target AND block_start <= stop AND start <= block_end) AS low FROM o WHERE k = 1)
SELECT spacer, target, start, stop, strand, mismatches, cigar, md, concat_ws(';', CASE WHEN low THEN 'low_complexity' END, CASE WHEN mismatches > 1 THEN 'mismatches' END) AS flags FROM l""")
def c21_spacer_hits(t):
    """Alignments of spacers, one for each place, flagged where they lie in masked blocks or differ."""
    tags = F.map_filter(F.create_map(F.lit("NM"), "nm", F.lit("MD"), "md"), lambda k, v: v.isNotNull())
    found = host.spacer_hits(t("alignments").withColumn("tags", tags), t("masked"), 64)
    return found.select(F.col("Spacer id").alias("spacer"), F.col("Target id").alias("target"), F.col("Start").alias("start"), F.col("End").alias("stop"), F.col("Strand").alias("strand"), F.col("N mismatches").alias("mismatches"), F.col("CIGAR").alias("cigar"), F.col("MD").alias("md"), "flags")


_CHOSEN = """
w AS (SELECT *, row_number() OVER o AS k, first_value(start) OVER o AS fs, first_value(stop) OVER o AS fe FROM domains WINDOW o AS (PARTITION BY gene ORDER BY score DESC, start_text DESC, hmm)),
chosen AS (SELECT gene, hmm FROM w WHERE k = 1 OR stop <= fs OR start >= fe)
"""


def _domains(t) -> DataFrame:
    return t("domains").withColumnRenamed("stop", "end")


@composite("domains", sql=_CHOSEN + "SELECT DISTINCT gene, hmm FROM chosen")
def c22_chosen_domains(t):
    """Of a gene's domains the best, and those apart from it."""
    return verify.chosen_domains(_domains(t)).distinct()


@composite("contigs", "domains", "classifier", sql=_CHOSEN + """,
own AS (SELECT DISTINCT regexp_replace(gene, '_[^_]*$', '') AS contig, hmm FROM chosen),
s AS (SELECT contig, count(*) AS n, coalesce(sum(ln(p_viral)), 0) - coalesce(sum(ln(p_nonviral)), 0) AS viral, coalesce(sum(ln(p_plasmid)), 0) - coalesce(sum(ln(p_chrom)), 0) AS plasmid, string_agg(own.hmm, ' ' ORDER BY own.hmm) AS hits
  FROM own LEFT JOIN classifier c ON own.hmm = c.hmm GROUP BY 1),
l AS (SELECT *, CASE WHEN viral > 1 THEN 'Virus' WHEN viral > -1 THEN CASE WHEN n > 2 THEN 'Uncertain - viral or bacterial' ELSE 'Uncertain - too short' END WHEN plasmid > 1 THEN 'Plasmid' WHEN plasmid < -1 THEN 'Chromosome' ELSE 'Uncertain - plasmid or chromosomal' END AS label FROM s)
SELECT id AS contig, length, circular, CASE WHEN (label IS NULL OR label = 'Uncertain - too short') AND (length > 3000 OR circular = '+') THEN 'Uncertain - viral or bacterial' WHEN label IS NULL THEN 'Uncertain - too short' ELSE label END AS prediction,
  round(CASE WHEN viral > -1 THEN viral ELSE plasmid END, 2) + 0.0 AS score, hits FROM contigs LEFT JOIN l ON id = contig""")
def c22_verify(t):
    """Naive Bayes over the domains of each contig."""
    found = verify.verify(t("contigs"), _domains(t), t("classifier"), threshold=1.0)
    return found.select(F.col("Contig name").alias("contig"), F.col("Length").alias("length"), F.col("Circular").alias("circular"), F.col("Prediction").alias("prediction"), (F.col("Score").try_cast("double") + 0.0).alias("score"), F.col("Pfam hits").alias("hits"))


@composite("training", "hmms", sql="""
g AS (SELECT * FROM training WHERE i_evalue <= 0.000001 AND hmm IN (SELECT hmm FROM hmms)),
a AS (SELECT h.hmm, CAST(count(CASE WHEN kind = 'plasmid' THEN 1 END) AS BIGINT) AS n_plasmid, CAST(count(CASE WHEN kind = 'chrom' THEN 1 END) AS BIGINT) AS n_chrom, CAST(count(CASE WHEN kind = 'viral' THEN 1 END) AS BIGINT) AS n_viral FROM (SELECT DISTINCT hmm FROM hmms) h LEFT JOIN g USING (hmm) GROUP BY 1),
s AS (SELECT count(*) AS n, sum(n_plasmid) AS p, sum(n_chrom) AS c, sum(n_viral) AS v FROM a)
SELECT hmm, n_plasmid, n_chrom, n_viral, round((n_plasmid + 0.01::DOUBLE) / (p + n * 0.01::DOUBLE), 12) AS p_plasmid, round((n_chrom + 0.01::DOUBLE) / (c + n * 0.01::DOUBLE), 12) AS p_chrom, round((n_viral + 0.01::DOUBLE) / (v + n * 0.01::DOUBLE), 12) AS p_viral,
  round((n_plasmid + n_chrom + 0.01::DOUBLE) / (p + c + n * 0.01::DOUBLE), 12) AS p_nonviral FROM a, s WHERE greatest(n_plasmid, n_chrom, n_viral) >= 10""")
def c23_train(t):
    """The classifier's table, with pseudocounts."""
    found = verify.train(t("training").withColumn("i_evalue", F.col("i_evalue").cast("double")), t("hmms"))
    return found.select("hmm", "n_plasmid", "n_chrom", "n_viral", *(F.round(c, 12).alias(c) for c in ("p_plasmid", "p_chrom", "p_viral", "p_nonviral")))


@composite("hsps", sql="""
g AS (SELECT * FROM hsps WHERE evalue < 0.01),
w AS (SELECT *, max(stop) OVER (PARTITION BY query, hit ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM g),
i AS (SELECT *, sum(CASE WHEN start <= before THEN 0 ELSE 1 END) OVER (PARTITION BY query, hit ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS island FROM w),
c AS (SELECT query, hit, sum(b - a) AS covered FROM (SELECT query, hit, island, min(start) AS a, max(stop) AS b FROM i GROUP BY ALL) GROUP BY ALL),
a AS (SELECT c.*, title, query_length, CASE WHEN regexp_matches(title, 'hage|irus') THEN 'Virus' WHEN contains(title, 'lasmid') THEN 'Plasmid' WHEN regexp_matches(title, 'hromosome|omplete genome') THEN 'Chromosome' ELSE 'Other' END AS kind
  FROM c JOIN (SELECT query, hit, min(title) AS title, min(query_length) AS query_length FROM g GROUP BY ALL) USING (query, hit) WHERE covered >= 0.1 * query_length),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY covered DESC, title DESC, hit) AS k FROM a),
o AS (SELECT a.query, a.kind, row_number() OVER (PARTITION BY a.query ORDER BY a.covered DESC, a.title DESC, a.hit) AS k FROM a JOIN r ON a.query = r.query AND r.k = 1 WHERE a.covered >= 0.9 * r.covered AND a.kind <> r.kind AND a.kind IN ('Virus', 'Plasmid'))
SELECT q.query, coalesce(o.kind, r.kind, 'no_significant') AS verdict, r.title, CAST(r.covered AS DOUBLE) / r.query_length AS coverage FROM (SELECT DISTINCT query FROM hsps) q LEFT JOIN r ON q.query = r.query AND r.k = 1 LEFT JOIN o ON q.query = o.query AND o.k = 1""")
def c24_blast_verdict(t):
    """What the alignments of each query say it is."""
    return verify.blast_verdict(t("hsps").withColumn("evalue", F.col("evalue").cast("double")).withColumnRenamed("stop", "end"))


@composite("isolates", sql="""
p AS (SELECT sort, kind, unnest(string_split(replace(replace(listed, ' ', ''), ',', ';'), ';')) AS part, generate_subscripts(string_split(replace(replace(listed, ' ', ''), ',', ';'), ';'), 1) AS i FROM isolates WHERE kind <> ''),
s AS (SELECT *, string_split(part, ':') AS pair FROM p WHERE len(string_split(part, ':')) <= 2),
x AS (SELECT *, pair[-1] AS body, CASE WHEN len(pair) = 2 THEN pair[1] END AS segment FROM s)
SELECT sort, CAST(i AS INTEGER) AS place, segment, CASE WHEN regexp_matches(body, '^\\w+\\(\\d+\\.\\w+\\)') THEN regexp_extract(body, '^(\\w+)\\(', 1) ELSE body END AS accession,
  regexp_extract(body, '^\\w+\\((\\d+)\\.\\w+\\)', 1) AS start_, regexp_extract(body, '^\\w+\\(\\d+\\.(\\w+)\\)', 1) AS stop, NOT (len(regexp_extract_all(body, '[a-z]')) < 3 AND len(regexp_extract_all(body, '[0-9]')) > 3) AS suspect FROM x""")
def c26_accessions(t):
    """A row for each accession of each isolate."""
    vmr = t("isolates").toDF("sort", "Exemplar or additional isolate", "Virus GENBANK accession")
    return taxonomy.accessions(vmr).select("sort", F.col("Accession_Index").alias("place"), F.col("Segment_Name").alias("segment"), F.col("Accession").alias("accession"), F.col("Start_Loc").alias("start_"), F.col("End_Loc").alias("stop"), "suspect")


@composite("items", sql="""
r AS (SELECT *, (row_number() OVER (PARTITION BY source_db ORDER BY sample, fna) - 1) // (CASE source_db WHEN 'ATB' THEN 500 WHEN 'ENA' THEN 500 WHEN 'LOGAN' THEN 250 ELSE 50 END) AS batch FROM items WHERE fna IS NOT NULL AND source_db IS NOT NULL)
SELECT source_db || '_' || CAST(batch AS VARCHAR) AS id, source_db, CAST(batch AS BIGINT) AS batch, CAST(count(*) AS INTEGER) AS n, min(sample) AS first_sample, max(sample) AS last_sample FROM r GROUP BY ALL""")
def c27_source_batches(t):
    """Work items in batches whose size depends on their source."""
    found = batching.source_batches(t("items"), 50)
    return found.select("id", "source_db", "batch", F.size("urls").alias("n"), F.array_min(F.transform("urls", lambda x: x["sample"])).alias("first_sample"), F.array_max(F.transform("urls", lambda x: x["sample"])).alias("last_sample"))


@composite("sequences", "bacphlip", "completeness", sql="""
SELECT id, seq, CASE WHEN id IN (SELECT seq_name FROM bacphlip) THEN 'phist' WHEN id IN (SELECT contig_id FROM completeness) THEN 'crispr' ELSE 'open' END AS step FROM sequences""")
def c28_host_cascade(t):
    """Which predictor found a host first, and what is left."""
    found, rest = host.cascade(t("sequences"), t("bacphlip").withColumnRenamed("seq_name", "Target id"), t("completeness").withColumnRenamed("contig_id", "Target id"))
    return found.unionByName(rest.withColumn("step", F.lit("open")))


@composite("annotations", "pharokka", "phold", "empathi", sql="""
SELECT id, accession, CASE WHEN id IN (SELECT id FROM pharokka) THEN 'bakta' WHEN id IN (SELECT id FROM phold) THEN 'foldseek' WHEN id IN (SELECT id FROM empathi) THEN 'interpro' ELSE 'open' END AS step FROM annotations""")
def c29_annotation_cascade(t):
    """Which annotator had a protein first, and what is left."""
    found, rest = annotate.cascade(t("annotations"), [("bakta", t("pharokka")), ("foldseek", t("phold")), ("interpro", t("empathi"))])
    return found.unionByName(rest.withColumn("step", F.lit("open")))


@composite("ledger", "hashes", sql="SELECT original_id, hash FROM ledger UNION ALL SELECT original_id, hash FROM hashes")
def c30_release(t):
    """A release written onto the one before, read back."""
    import uuid

    from sequoir.config import Config
    from sequoir.operators.store import shared_dir
    from sequoir.sources.sinks import read_release

    old, new = t("ledger").select("original_id", "hash"), t("hashes").select("original_id", "hash")
    spark, base = old.sparkSession, f"{shared_dir(t('ledger').sparkSession)}/releases-{uuid.uuid4().hex}"
    first = release.update(spark, {"hashes": old}, Config(release="1", output=base))
    second = release.update(spark, {"hashes": new}, Config(release="2", output=base, previous=first))
    return read_release(spark, second, "hashes", new.schema)


@composite("detections", sql="""
d AS (SELECT *, contains(taxonomy, 'Inoviridae') AS ino FROM detections)
SELECT id FROM d WHERE ((virus_score >= 0.7 AND length >= 2000) OR ino) AND NOT (contains(taxonomy, 'Caudoviricetes') AND length < 10000) AND NOT (ino AND (length < 4500 OR length > 12500))
AND taxonomy <> 'Unclassified' AND (contains(taxonomy, 'viricetes') OR contains(taxonomy, 'Anelloviridae'))""")
def filter_coarse(t):
    """Which detections go on."""
    return t("detections").where(classify.coarse_filter()).select("id")


@composite("checked", sql="SELECT id FROM checked WHERE aai_completeness >= 50 AND kmer_freq <= 1.2 AND TRY_CAST(aai_expected_length AS DOUBLE) > 0 AND contig_length / TRY_CAST(aai_expected_length AS DOUBLE) <= 1.5")
def filter_completeness(t):
    return t("checked").where(classify.completeness_filter()).select("id")


@composite("ani", sql="SELECT query AS src, reference AS dst, ani AS w FROM ani WHERE ani >= 0.95 AND (qcov >= 0.85 OR rcov >= 0.85) AND query <> reference")
def edges_ani(t):
    """Edges between genomes by their alignments."""
    from sequoir.plans.cluster import ani_edges

    return ani_edges(t("ani"))


@composite("marks", sql="SELECT id FROM marks WHERE PLASMID_HALLMARK = 1 OR VIRUS_HALLMARK = 1")
def filter_hallmark(t):
    return t("marks").where(classify.hallmark_filter()).select("id")


@composite("repeats", sql="""
k AS (SELECT id, seq, unnest(range(20, CAST(length(seq) // 2 AS BIGINT) + 1)) AS n FROM repeats)
SELECT r.id, CAST(coalesce(max(CASE WHEN left(k.seq, k.n) = right(k.seq, k.n) THEN k.n END), 0) AS INTEGER) AS repeat_length FROM repeats r LEFT JOIN k ON r.id = k.id GROUP BY 1""")
def terminal_repeats(t):
    """The longest beginning of a sequence that is its end too."""
    from sequoir.functions.circles import terminal_repeat

    return t("repeats").select("id", terminal_repeat("seq").cast("int").alias("repeat_length"))


@composite("long_repeats", sql="""
k AS (SELECT id, seq, unnest(range(20, CAST(length(seq) // 2 AS BIGINT) + 1)) AS n FROM long_repeats)
SELECT r.id, CAST(coalesce(max(CASE WHEN substr(k.seq, length(k.seq) - k.n + 1, 12) = left(k.seq, 12) AND left(k.seq, k.n) = right(k.seq, k.n) THEN k.n END), 0) AS INTEGER) AS repeat_length FROM long_repeats r LEFT JOIN k ON r.id = k.id GROUP BY 1""")
def long_terminal_repeats(t):
    """Repeats of up to some thousand letters at the ends of sequences."""
    from sequoir.functions.circles import terminal_repeat

    return t("long_repeats").select("id", terminal_repeat("seq").alias("repeat_length"))


@composite("circles", sql="""
b AS (SELECT id, seq, translate(reverse(seq), 'ACGT', 'TGCA') AS back, unnest(range(1, CAST(length(seq) AS BIGINT) + 1)) AS i FROM circles)
SELECT id, md5(min(least(substr(seq, i) || left(seq, i - 1), substr(back, i) || left(back, i - 1)))) AS hash FROM b GROUP BY 1""")
def circular_identity(t):
    """One hash for all rotations and strands of a circle; circles with the same parts in another order differ."""
    from sequoir.functions.circles import canonical_circular_hash

    return t("circles").select("id", canonical_circular_hash("seq").alias("hash"))


@composite("repeats", sql="SELECT id, CASE WHEN id % 3 = 0 THEN seq || substr(seq, CAST(22 + id % 5 + 1 AS BIGINT), CAST(60 - (22 + id % 5) AS BIGINT)) ELSE seq END AS longer FROM repeats")
def circular_extension(t):
    """Circular sequences lengthened by what follows their overlap."""
    from sequoir.functions.exprs import circular_extended

    overlap = F.when(F.col("id") % 3 == 0, (22 + F.col("id") % 5).cast("int"))
    return t("repeats").select("id", circular_extended("seq", overlap, 60).alias("longer"))


@composite("called", "contigs", sql="SELECT contig, number, start FROM called JOIN contigs ON contig = id WHERE start <= length")
def genes_within_contigs(t):
    return verify.genes_within(t("called"), t("contigs").select("id", "length")).select("contig", "number", "start")


@composite("headers", sql="""
SELECT description, regexp_extract(description, '^(\\S+)', 1) || ' 30~~~80~~~80~~~' || regexp_extract(description, 'RepID=(\\S+)', 1) || '~~~' || CASE WHEN contains(description, 'Tail') THEN 'Tail fiber' ELSE 'hypothetical protein' END
  || '~~~UniRef:' || regexp_extract(description, '^(\\S+)', 1) AS header FROM headers""")
def protein_headers(t):
    """Headers of reference proteins as annotators read them."""
    return t("headers").select("description", taxonomy.protein_header().alias("header"))


@composite("sequences", sql="SELECT id, replace(replace(seq, ' ', '_'), '-', '_') || '-' || CASE WHEN id LIKE '%3' THEN '' ELSE 'L' END || '-' || id AS header FROM sequences")
def species_headers(t):
    """Header ids of reference sequences: species, segment, accession."""
    rows = t("sequences").select("id", F.col("seq").alias("Species"), F.when(~F.col("id").endswith("3"), "L").alias("Segment_Name"), F.col("id").alias("Accession"))
    return rows.select("id", taxonomy.fasta_header().alias("header"))


@composite("relatives", sql="""
g AS (SELECT DISTINCT id, substr(seq, i, 11) AS gram FROM (SELECT id, seq, unnest(range(1, CAST(length(seq) AS BIGINT) - 9)) AS i FROM relatives)),
n AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.id AS src, b.id AS dst, count(*) AS shared FROM g a JOIN g b ON a.gram = b.gram AND a.id < b.id GROUP BY ALL)
SELECT src, dst, CAST(shared AS DOUBLE) / least(x.n, y.n) AS w FROM p JOIN n x ON src = x.id JOIN n y ON dst = y.id WHERE shared >= 8 AND shared >= 0.6 * least(x.n, y.n)""")
def edges_kmers(t):
    """Edges between sequences by the k-mers that they share."""
    from sequoir.plans.cluster import kmer_edges

    return kmer_edges(t("relatives"), 11, 8, 0.6)


@composite("similar_places", "placed_in", sql="""
h AS (SELECT DISTINCT r_gene AS id, CASE WHEN tstart <= tend THEN '+' ELSE '-' END AS strand, least(tstart, tend) AS b, greatest(tstart, tend) AS e FROM similar_places WHERE identity >= 60),
m AS (SELECT *, CASE WHEN b <= max(e) OVER (PARTITION BY id, strand ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM h),
i AS (SELECT *, sum(n) OVER (PARTITION BY id, strand ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS k FROM m),
g AS (SELECT id, strand, greatest(min(b) - 5, 1) AS begin_, max(e) + 5 AS end_ FROM i GROUP BY id, strand, k),
c AS (SELECT g.*, substr(seq, CAST(begin_ AS BIGINT), CAST(end_ - begin_ + 1 AS BIGINT)) AS s FROM g JOIN placed_in USING (id))
SELECT id, strand, CAST(begin_ AS BIGINT) AS begin_at, CAST(end_ AS BIGINT) AS end_at, CASE WHEN strand = '-' THEN translate(reverse(s), 'ACGT', 'TGCA') ELSE s END AS seq FROM c""")
def dgr_candidates(t):
    """Places that are like known templates, merged where they overlap, with flanks and turned to their strand."""
    from sequoir.operators import dgr

    found = dgr.candidates(t("similar_places"), t("placed_in"), 5, 60.0)
    return found.select("id", "strand", F.col("begin").cast("long").alias("begin_at"), F.col("end").cast("long").alias("end_at"), "seq")


def retroelements(nations: DataFrame) -> DataFrame:
    """id, seq: made-up sequences, each with a template of 14 codons AAC among others and a copy of it that has GAC for them."""
    letters = lambda *salt: F.translate(F.concat(*(F.md5(F.concat("n_name", F.lit(x))) for x in salt)), "0123456789abcdef", "ACGTACGTACGTACGT")
    copy = lambda codon: F.concat(*(x for k in range(14) for x in (F.lit(codon), F.substring(letters(*"abc"), 6 * k + 1, 6))))
    return nations.select(F.col("n_name").alias("id"), F.concat(letters(*"efgh"), copy("AAC"), letters(*"ijklm"), copy("GAC"), letters(*"nopq")).alias("seq"))


def c25_dgr_scan(spark, sf_dir: str) -> DataFrame:
    """Template and variable repeats in sequences. Alignments are beyond SQL; a test holds it against all pairs of places."""
    from sequoir.operators import dgr

    found = dgr.scan(retroelements(spark.read.parquet(f"{sf_dir}/nation.parquet")))
    return found.select("id", "strand", "template_begin", "template_end", "variable_begin", "variable_end", "length", "mismatches", "at_a", "at_t")


QUERIES["c25_dgr_scan"] = c25_dgr_scan


def fragments(suppliers: DataFrame) -> DataFrame:
    """id, template, seq: made-up fragments, five by five of one template: like it, with A changed (some turned around), and with C and G changed."""
    group = F.floor(F.col("s_suppkey") / 5).cast("string")
    template = F.translate(F.concat(*(F.md5(F.concat(group, F.lit(x))) for x in "abc")), "0123456789abcdef", "ACGTACGTACGTACGT")
    back = F.translate(F.reverse(F.translate("template", "A", "C")), "ACGT", "TGCA")
    forms = [F.concat(F.substring("template", 1, 40), F.lit("A"), F.expr("substring(template, 42)")), F.translate("template", "A", "G"), back, F.translate("template", "A", "T"), F.translate("template", "CG", "GC")]
    rows = suppliers.select(F.format_string("s%08d", "s_suppkey").alias("id"), "s_suppkey", group.alias("part"), template.alias("template"))
    return rows.select("id", "part", "template", F.element_at(F.array(*forms), (F.col("s_suppkey") % 5 + 1).cast("int")).alias("seq"))


def dgr_fragment_tags(spark, sf_dir: str) -> DataFrame:
    """Fragments as templates, variable repeats or neither, every other group with its template known. Alignments are beyond SQL; a test holds it against the passes one by one."""
    from sequoir.operators import dgr
    from sequoir.operators.store import spread

    rows = fragments(spread(spark.read.parquet(f"{sf_dir}/supplier.parquet")))
    known = rows.where(F.col("part").cast("long") % 2 == 0).select(F.col("part").alias("id"), F.col("template").alias("seq")).distinct()
    return dgr.tags(rows.select("id", "seq"), known)


QUERIES["dgr_fragment_tags"] = dgr_fragment_tags
