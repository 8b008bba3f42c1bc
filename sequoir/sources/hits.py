"""Hit tables of search tools, cluster lists, sparse matrices and alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sequoir import schemas
from sequoir.sources.tables import delimited, numbered_lines


def _cells(spark: SparkSession, path: str) -> DataFrame:
    """Cells between white space, of the lines that are no comments."""
    return spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith("#")).select(F.split(F.trim("value"), r"\s+").alias("c"))


def _at(i: int, kind: str | None = None) -> Column:
    c = F.get("c", F.lit(i))
    return c.try_cast(kind) if kind else c


def hmm_table(spark: SparkSession, path: str) -> DataFrame:
    """protein, hallmark, evalue of a per-sequence HMM table."""
    return _cells(spark, path).select(_at(0).alias("protein"), _at(2).alias("hallmark"), _at(4, "double").alias("evalue"))


def hmm_domains(spark: SparkSession, path: str) -> DataFrame:
    """gene, hmm, i_evalue, score, start (as text too, for its order), end of a per-domain HMM table."""
    return _cells(spark, path).select(_at(0).alias("gene"), _at(3).alias("hmm"), _at(6, "double").alias("i_evalue"), _at(13, "double").alias("score"), _at(17).alias("start_text"), _at(17, "double").alias("start"), _at(18, "double").alias("end"))


def m8(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, schemas.M8, header=False)


def classifier_table(spark: SparkSession, path: str) -> DataFrame:
    kinds = ["string", "long", "long", "long", "double", "double", "double", "double"]
    names = [x.split()[0] for x in schemas.CLASSIFIER.split(", ")]
    return _cells(spark, path).select(*(_at(i, k).alias(n) for i, (n, k) in enumerate(zip(names, kinds, strict=True))))


def cluster_lines(spark: SparkSession, path: str) -> DataFrame:
    """member, cluster_id of a list with a cluster in each line; the id is the line's number from 1."""
    ids = numbered_lines(spark, path, "cluster_id")
    return ids.select(F.explode(F.split(F.trim("value"), r"\s+")).alias("member"), "cluster_id").where("member <> ''")


def sparse_matrix(spark: SparkSession, path: str) -> DataFrame:
    """row, col, value of a sparse k-mer matrix: a header line of columns, and lines of `index:value` with indices from 1."""
    lines = spark.read.text(path).select(F.split("value", ",").alias("c"))
    first = _at(0)
    header = lines.where(first.startswith("kmer-length")).select(F.posexplode(F.slice("c", 2, F.size("c"))).alias("i", "col")).select((F.col("i") + 1).alias("i"), "col")
    rows = lines.where(~first.startswith("kmer-length") & ~first.startswith("query-samples"))
    cells = rows.select(first.alias("row"), F.explode(F.slice("c", 2, F.size("c"))).alias("cell")).where(F.col("cell").contains(":"))
    split = F.split("cell", ":")
    entries = cells.select("row", F.get(split, F.lit(0)).try_cast("int").alias("i"), F.get(split, F.lit(1)).try_cast("double").alias("value"))
    return entries.join(header, "i").select("row", "col", "value")


def accession(name: Column | str) -> Column:
    """The assembly accession at the beginning of a name; null if there is none."""
    got = F.regexp_extract(F.col(name) if isinstance(name, str) else name, r"^(GC[AF]_\d+\.\d+)", 1)
    return F.when(got != "", got)


def sam(spark: SparkSession, path: str) -> DataFrame:
    """spacer, flag, target, start, cigar, seq, tags (map) of an alignment file."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.trim("value") != "")).select(F.split("value", "\t").alias("c"))
    tags = F.transform(F.slice("c", 12, F.greatest(F.size("c"), F.lit(1))), lambda t: F.struct(F.substring(t, 1, 2).alias("key"), F.regexp_extract(t, r"^..:.:(.*)$", 1).alias("value")))
    return lines.select(_at(0).alias("spacer"), _at(1, "int").alias("flag"), _at(2).alias("target"), _at(3, "long").alias("start"), _at(5).alias("cigar"), _at(9).alias("seq"), F.map_from_entries(tags).alias("tags"))


def dust(spark: SparkSession, path: str) -> DataFrame:
    """target, block_start, block_end of masked blocks; records begin with `>`."""
    raw = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "").select(F.split("value", "\r?\n").alias("l"))
    blocks = raw.select(F.trim(F.get("l", F.lit(0))).alias("target"), F.explode(F.slice("l", 2, F.size("l"))).alias("b")).where(F.trim("b") != "")
    ends = F.split(F.replace("b", F.lit(" "), F.lit("")), "-")
    return blocks.select("target", F.get(ends, F.lit(0)).try_cast("long").alias("block_start"), F.get(ends, F.lit(1)).try_cast("long").alias("block_end"))


BLAST = (
    "`Iteration_query-def` string, `Iteration_query-len` long, Iteration_hits struct<Hit:array<struct<Hit_def:string,Hit_hsps:struct<Hsp:array<struct<"
    "`Hsp_evalue`:double,`Hsp_query-from`:long,`Hsp_query-to`:long,`Hsp_align-len`:long,`Hsp_identity`:long>>>>>>"
)


def blast_xml(spark: SparkSession, path: str) -> DataFrame:
    """query, query_length, hit (its number), title, evalue, start, end, length, identities of the HSPs of BLAST XML reports; queries without hits have a row of nulls."""
    raw = spark.read.format("xml").option("rowTag", "Iteration").schema(BLAST).load(path)
    hits = raw.select(F.col("Iteration_query-def").alias("query"), F.col("Iteration_query-len").alias("query_length"), F.posexplode_outer("Iteration_hits.Hit").alias("hit", "h"))
    hsps = hits.select("query", "query_length", "hit", F.col("h.Hit_def").alias("title"), F.explode_outer("h.Hit_hsps.Hsp").alias("s"))
    return hsps.select("query", "query_length", "hit", "title", F.col("s.Hsp_evalue").alias("evalue"), F.col("s.Hsp_query-from").alias("start"), F.col("s.Hsp_query-to").alias("end"), F.col("s.Hsp_align-len").alias("length"), F.col("s.Hsp_identity").alias("identities"))


def square_matrix(rows: DataFrame, cols: DataFrame) -> DataFrame:
    """ordinal, line of a sparse matrix squared up: a header of columns and then row names, a line for every column, then the rows.

    rows: name and its cells as text, in order of `ordinal`; cols: name, ordinal.
    """
    names = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "name"))), lambda x: x["name"]), ",")
    both = cols.select(F.col("ordinal"), "name").unionByName(rows.select((F.col("ordinal") + 1_000_000_000).alias("ordinal"), "name"))
    header = both.agg(F.concat(F.lit(","), names).alias("line")).select(F.lit(-1).cast("long").alias("ordinal"), "line")
    empty = cols.select(F.col("ordinal").cast("long"), F.concat("name", F.lit(",")).alias("line"))
    body = rows.select((F.col("ordinal") + 1_000_000_000).cast("long").alias("ordinal"), F.concat_ws(",", "name", "cells").alias("line"))
    return header.unionByName(empty).unionByName(body).orderBy("ordinal")
