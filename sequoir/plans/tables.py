"""Writers and readers as queries: what is written from the star schema and read back, with the SQL of what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sequoir.operators.store import shared_dir
from sequoir.plans.queries import query
from sequoir.sources import hits, sequences, sinks, tables


def _path(df: DataFrame, suffix: str = "") -> str:
    return f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}{suffix}"


def _text(df: DataFrame, line: Column, *first: str, order: str | None = None) -> str:
    """Lines of df as a text in parts, after fixed first lines; returns its folder."""
    path, spark = _path(df), df.sparkSession
    rows = df.select(F.lit(1).alias("part"), (F.col(order) if order else F.lit(0)).cast("long").alias("place"), line.alias("value"))
    head = spark.range(1).select(F.lit(0).alias("part"), F.posexplode(F.array(*map(F.lit, first))).alias("place", "value")) if first else None
    sinks.write_lines(rows if head is None else head.unionByName(rows), ["part", "place", "value"], path)
    return path


def s(c: str) -> Column:
    return F.col(c).cast("string")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS name, printf('%.2f', c_custkey * 0.25) AS amount FROM customer")
def sink_table(t):
    """A gzipped table with a header, NA for null and two decimals."""
    df = t("customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("name"), (F.col("c_custkey") * 0.25).cast("double").alias("amount"))
    path = _path(df, ".tsv.gz")
    sinks.write_table(df, path, null="NA", decimals=2)
    return tables.delimited(df.sparkSession, path, "id long, name string, amount string", null="NA")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'F'")
def sink_ids(t):
    """An id list without a header."""
    df = t("orders").where("o_orderstatus = 'F'")
    path = _path(df)
    sinks.write_ids(df, "o_orderkey", path)
    return tables.trimmed_rows(df.sparkSession, path, ["id"])


@query("SELECT 'c' || CAST(c_custkey AS VARCHAR) AS id, 'c' || CAST(c_custkey AS VARCHAR) AS description, upper(replace(c_name || c_name || c_name || c_name || c_name, ' ', '')) AS seq FROM customer")
def sink_fasta(t):
    """Sequence records in lines of 60."""
    df = t("customer").select(F.concat(F.lit("c"), s("c_custkey")).alias("id"), F.upper(F.replace(F.repeat("c_name", F.lit(5)), F.lit(" "), F.lit(""))).alias("seq"))
    path = _path(df)
    sinks.write_fasta(df, path, width=60)
    return sequences.fasta(df.sparkSession, path)


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders")
def sink_split(t):
    """A folder for each value of a column."""
    df = t("orders").select(s("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    path = _path(df)
    sinks.write_split(df, "status", path, ["id"])
    return df.sparkSession.read.option("header", True).option("sep", "\t").csv(path).select(F.col("id").cast("long").alias("id"), "status")


@query("SELECT c_custkey AS id, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 100 AS INTEGER) AS chunk FROM customer")
def sink_chunks(t):
    """Folders of 100 rows in order."""
    df = t("customer").select(F.col("c_custkey").alias("id"))
    path = _path(df)
    sinks.write_chunks(df, ["id"], 100, path)
    return df.sparkSession.read.parquet(path).select("id", F.col("chunk").cast("int").alias("chunk"))


@query("SELECT p_partkey AS id, CASE WHEN p_type LIKE '%BRASS%' THEN 'virus' WHEN p_type LIKE '%STEEL%' THEN 'plasmid' ELSE 'rest' END AS route FROM part")
def sink_routed(t):
    """Rows into folders by an expression of their label."""
    df = t("part").select(F.col("p_partkey").alias("id"), "p_type")
    path = _path(df)
    sinks.write_routed(df, F.when(F.col("p_type").contains("BRASS"), "virus").when(F.col("p_type").contains("STEEL"), "plasmid").otherwise("rest"), path)
    return df.sparkSession.read.parquet(path).select("id", "route")


@query("SELECT n_name AS name, n_nationkey AS id FROM nation UNION ALL SELECT r_name, r_regionkey FROM region")
def source_concat(t):
    """Two files with a header each as one table."""
    a, b = t("nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id")), t("region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("id"))
    paths = [_path(a), _path(b)]
    for df, path in zip((a, b), paths, strict=True):
        sinks.write_table(df, path)
    return sinks.concat_tables(a.sparkSession, paths, "name string, id long")


@query("""
WITH l AS (SELECT 0 AS part, n_nationkey AS place, CASE WHEN n_nationkey % 5 = 0 THEN '#' || n_name ELSE n_name END AS value FROM nation UNION ALL SELECT 1, r_regionkey, CASE WHEN r_regionkey % 2 = 0 THEN '#' || r_name ELSE r_name END FROM region
UNION ALL SELECT 2, c_custkey, c_name FROM customer)
SELECT CAST(row_number() OVER (ORDER BY CASE WHEN starts_with(value, '#') THEN 0 ELSE 1 END, part, place) AS BIGINT) AS line, value FROM l""")
def sink_gff(t):
    """Comment lines of all parts first, then the parts one after another: written, and read back by line."""
    marked = lambda df, key, n, name: df.orderBy(key).select(F.concat(F.when(F.col(key) % n == 0, "#").otherwise(""), name).alias("value"))
    parts = [marked(t("nation"), "n_nationkey", 5, "n_name"), marked(t("region"), "r_regionkey", 2, "r_name"), t("customer").orderBy("c_custkey").select(F.col("c_name").alias("value"))]
    path = _path(parts[0])
    sinks.write_gff(parts, path)
    return tables.numbered_lines(parts[0].sparkSession, path)


@query("SELECT 's' || CAST(l_suppkey AS VARCHAR) AS q_gene, 'p' || CAST(l_partkey AS VARCHAR) AS r_gene, CAST(l_quantity AS BIGINT) AS length, CAST(round(l_quantity * 4) AS BIGINT) AS score FROM lineitem")
def source_m8(t):
    """A headerless similarity table by position."""
    columns = {"q_gene": F.concat(F.lit("s"), s("l_suppkey")), "r_gene": F.concat(F.lit("p"), s("l_partkey")), "identity": F.lit(90.5), "length": F.col("l_quantity").cast("long")}
    df = t("lineitem").select(*(c.alias(n) for n, c in columns.items()), *(F.lit(k).alias(f"x{k}") for k in range(6)), F.lit(0.001).alias("evalue"), (F.col("l_quantity") * 4).alias("bitscore"))
    path = _path(df)
    sinks.write_table(df, path, header=False)
    return hits.m8(df.sparkSession, path).select("q_gene", "r_gene", "length", F.round("bitscore").cast("long").alias("score"))


@query("SELECT 'g' || CAST(l_orderkey AS VARCHAR) AS protein, 'H' || CAST(l_suppkey AS VARCHAR) AS hallmark, CAST(l_linenumber AS DOUBLE) AS evalue FROM lineitem")
def source_hmm_table(t):
    """Cells between white space, comments skipped."""
    df = t("lineitem")
    line = F.concat_ws("  ", F.concat(F.lit("g"), s("l_orderkey")), F.lit("-"), F.concat(F.lit("H"), s("l_suppkey")), F.lit("-"), s("l_linenumber"), F.lit("rest of it"))
    return hits.hmm_table(df.sparkSession, _text(df, line, "# target", "#", ""))


@query("SELECT 'g' || CAST(l_orderkey AS VARCHAR) AS gene, 'H' || CAST(l_suppkey AS VARCHAR) AS hmm, CAST(l_quantity AS DOUBLE) AS score, CAST(l_partkey AS DOUBLE) AS start, CAST(l_partkey + 50 AS DOUBLE) AS stop FROM lineitem")
def source_hmm_domains(t):
    df = t("lineitem")
    cells = {0: F.concat(F.lit("g"), s("l_orderkey")), 3: F.concat(F.lit("H"), s("l_suppkey")), 6: F.lit("0.001"), 13: s("l_quantity"), 17: s("l_partkey"), 18: (F.col("l_partkey") + 50).cast("string")}
    path = _text(df, F.concat_ws(" ", *(cells.get(i, F.lit("-")) for i in range(23))), "#  a comment")
    return hits.hmm_domains(df.sparkSession, path).select("gene", "hmm", "score", "start", F.col("end").alias("stop"))


@query("WITH c AS (SELECT n_regionkey, dense_rank() OVER (ORDER BY n_regionkey) AS id, n_name FROM nation) SELECT replace(n_name, ' ', '_') AS member, CAST(id AS BIGINT) AS cluster_id FROM c")
def source_cluster_lines(t):
    """Members of the cluster of each line, numbered by line."""
    df = t("nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.replace("n_name", F.lit(" "), F.lit("_")))).alias("names"))
    return hits.cluster_lines(df.sparkSession, _text(df, F.concat_ws("\t", "names"), order="n_regionkey"))


@query("SELECT 'row' || CAST(n_nationkey AS VARCHAR) AS row, 'v' || CAST(n_regionkey + 1 AS VARCHAR) AS col, n_nationkey * 0.5::DOUBLE AS value FROM nation")
def source_sparse_matrix(t):
    """A header of columns, and lines of index:value."""
    df = t("nation")
    line = F.concat(F.lit("row"), s("n_nationkey"), F.lit(",7,"), (F.col("n_regionkey") + 1).cast("string"), F.lit(":"), (F.col("n_nationkey") * 0.5).cast("string"), F.lit(","))
    path = _text(df, line, "kmer-length: 25 fraction: 1,v1,v2,v3,v4,v5", "query-samples,total-kmers,3,3,3,3,3", order="n_nationkey")
    found = hits.sparse_matrix(df.sparkSession, path)
    return found.select("row", F.col("col"), "value")


@query("SELECT 's' || CAST(l_orderkey AS VARCHAR) AS spacer, CAST(CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE 16 END AS INTEGER) AS flag, 't' || CAST(l_suppkey AS VARCHAR) AS target, CAST(l_partkey AS BIGINT) AS start, CAST(l_linenumber AS VARCHAR) AS nm FROM lineitem")
def source_sam(t):
    """Alignment lines with optional tags."""
    df = t("lineitem")
    cells = [F.concat(F.lit("s"), s("l_orderkey")), F.when(F.col("l_linenumber") % 2 == 0, "0").otherwise("16"), F.concat(F.lit("t"), s("l_suppkey")), s("l_partkey"), F.lit("60"), F.lit("20M"), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.lit("*"), F.concat(F.lit("NM:i:"), s("l_linenumber"))]
    path = _text(df, F.concat_ws("\t", *cells), "@HD\tVN:1.6")
    return hits.sam(df.sparkSession, path).select("spacer", "flag", "target", "start", F.col("tags")["NM"].alias("nm"))


@query("SELECT 't' || CAST(o_orderkey AS VARCHAR) AS target, CAST(o_custkey AS BIGINT) AS block_start, CAST(o_custkey + 9 AS BIGINT) AS block_end FROM orders")
def source_dust(t):
    """Masked blocks by record."""
    df = t("orders")
    line = F.concat(F.lit(">t"), s("o_orderkey"), F.lit("\n"), s("o_custkey"), F.lit(" - "), (F.col("o_custkey") + 9).cast("string"))
    return hits.dust(df.sparkSession, _text(df, line))


@query("SELECT c_custkey AS key, c_name AS name FROM customer")
def source_preamble(t):
    """A table after two lines of preamble and a header."""
    df = t("customer")
    path = _text(df, F.concat_ws("\t", "c_name", F.lit("x"), s("c_custkey")), "# made by", "", "# version 2", "name\tother\tkey")
    return tables.with_preamble(df.sparkSession, path, "key long, name string", skip=2)


@query("SELECT n_name AS name, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey END AS key FROM nation")
def source_unnamed(t):
    """A table whose first header cell is empty, with NA for null."""
    df = t("nation")
    path = _path(df)
    sinks.write_table(df.select(F.col("n_name").alias(""), F.when(F.col("n_nationkey") % 3 == 0, "NA").otherwise(s("n_nationkey")).alias("key")), path, sep=",")
    return tables.unnamed_first(df.sparkSession, path, "name string, key long", null="NA")


@query("SELECT 'D' || CAST(p_partkey AS VARCHAR) AS hmm, CAST(p_size AS BIGINT) AS n_plasmid, CAST(p_size + 1 AS BIGINT) AS n_viral, p_size * 0.5::DOUBLE AS p_viral FROM part")
def source_classifier(t):
    df = t("part")
    line = F.concat_ws(" ", F.concat(F.lit("D"), s("p_partkey")), s("p_size"), F.lit("1"), (F.col("p_size") + 1).cast("string"), F.lit("0.1"), F.lit("0.2"), (F.col("p_size") * 0.5).cast("string"), F.lit("0.3"))
    return hits.classifier_table(df.sparkSession, _text(df, line, "# hmm")).select("hmm", "n_plasmid", "n_viral", "p_viral")


@query("SELECT 'q' || CAST(n_nationkey AS VARCHAR) AS query, 1000 AS query_length, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_name END AS title, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST(n_regionkey + 1 AS BIGINT) END AS start FROM nation")
def source_blast_xml(t):
    """A report with an iteration for each query, some without hits."""
    df = t("nation")
    hsp = F.concat(F.lit("<Hit_hsps><Hsp><Hsp_evalue>0.001</Hsp_evalue><Hsp_query-from>"), (F.col("n_regionkey") + 1).cast("string"), F.lit("</Hsp_query-from><Hsp_query-to>50</Hsp_query-to></Hsp></Hit_hsps>"))
    hit = F.when(F.col("n_nationkey") % 4 == 0, "").otherwise(F.concat(F.lit("<Hit><Hit_def>"), "n_name", F.lit("</Hit_def>"), hsp, F.lit("</Hit>")))
    line = F.concat(F.lit("<Iteration><Iteration_query-def>q"), s("n_nationkey"), F.lit("</Iteration_query-def><Iteration_query-len>1000</Iteration_query-len><Iteration_hits>"), hit, F.lit("</Iteration_hits></Iteration>"))
    path = _text(df, line, "<BlastOutput><BlastOutput_iterations>")
    return hits.blast_xml(df.sparkSession, path).select("query", F.col("query_length").cast("int").alias("query_length"), "title", "start")


@query("SELECT 'r' || CAST(n_nationkey AS VARCHAR) AS record, 'ACGT' AS seq, 'tag_' || CAST(n_nationkey AS VARCHAR) AS tag, CASE WHEN n_nationkey % 2 = 0 THEN 'UniRef:X' ELSE NULL END AS ref FROM nation")
def source_genbank(t):
    """Records with a feature each, some with a cross-reference."""
    df = t("nation")
    number = s("n_nationkey")
    ref = F.when(F.col("n_nationkey") % 2 == 0, '\n                     /db_xref="UniRef:X"').otherwise("")
    line = F.concat(F.lit("LOCUS       r"), number, F.lit(" 4 bp\nFEATURES             Location/Qualifiers\n     CDS             1..4\n                     /locus_tag=\"tag_"), number, F.lit('"'), ref, F.lit("\nORIGIN\n        1 acgt\n//"))
    found = sequences.genbank(df.sparkSession, _text(df, line)).select("record", "seq", F.explode("features").alias("f"))
    value = lambda k: F.get(F.col("f.qualifiers")[k], F.lit(0))
    return found.select("record", "seq", value("locus_tag").alias("tag"), value("db_xref").alias("ref"))


@query("SELECT 'c' || CAST(c_custkey AS VARCHAR) AS id, 'c' || CAST(c_custkey AS VARCHAR) || ' of > ' || c_name AS description, 'ACGT' AS seq FROM customer")
def source_fasta_preamble(t):
    """Records after lines that are none."""
    df = t("customer")
    line = F.concat(F.lit(">c"), s("c_custkey"), F.lit(" of > "), F.col("c_name"), F.lit("\nAC\nGT"))
    return sequences.fasta(df.sparkSession, _text(df, line, "; a comment", "no record", order="c_custkey"))


@query("""
SELECT 'r' || CAST(n_nationkey AS VARCHAR) AS record, f.kind AS kind, 'join(1..3,5..8)' AS location, 'tag_' || CAST(n_nationkey AS VARCHAR) AS tag, translate(left(md5(n_name), 8), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, 'a ' || n_name || repeat(' and ' || n_name, 9) AS note, repeat(md5(n_name), 5) AS translation
FROM nation, (VALUES ('gene'), ('CDS')) f(kind) WHERE n_nationkey % 3 > 0 AND n_nationkey % 4 > 0""")
def genbank_no_hits(t):
    """Records written and read; of their features those stay that no hit names and that have a cross-reference, and these are written and read again."""
    from sequoir.plans.annotate import no_hit_records

    df, none = t("nation"), F.array().cast("array<string>")
    tag = F.concat(F.lit("tag_"), s("n_nationkey"))
    note = F.concat(F.lit("a "), "n_name", F.repeat(F.concat(F.lit(" and "), "n_name"), F.lit(9)))
    xref = F.when(F.col("n_nationkey") % 3 > 0, F.array(F.lit("UniRef:X"))).otherwise(none)
    pairs = F.map_filter(F.create_map(F.lit("locus_tag"), F.array(tag), F.lit("db_xref"), xref, F.lit("note"), F.array(note), F.lit("translation"), F.array(F.repeat(F.md5("n_name"), F.lit(5)))), lambda k, v: F.size(v) > 0)
    feature = lambda kind: F.struct(F.lit(kind).alias("kind"), F.lit("join(1..3,5..8)").alias("location"), pairs.alias("qualifiers"))
    rows = df.select(F.concat(F.lit("r"), s("n_nationkey")).alias("record"), F.translate(F.substring(F.md5("n_name"), 1, 8), "0123456789abcdef", "ACGTACGTACGTACGT").alias("seq"), F.array(feature("source"), feature("gene"), feature("CDS")).alias("features"))
    hits_ = df.where("n_nationkey % 4 = 0").select(tag.alias("id"))
    spark, first, second = df.sparkSession, _path(df), _path(df)
    sinks.write_genbank(rows, first)
    sinks.write_genbank(no_hit_records(sequences.genbank(spark, first), hits_), second)
    found = sequences.genbank(spark, second).select("record", "seq", F.explode("features").alias("f"))
    value = lambda k: F.get(F.col("f.qualifiers")[k], F.lit(0))
    return found.select("record", F.col("f.kind").alias("kind"), F.col("f.location").alias("location"), value("locus_tag").alias("tag"), "seq", value("note").alias("note"), value("translation").alias("translation"))


@query("SELECT 's' || CAST(c_custkey AS VARCHAR) AS sample, 'g' || CAST(c_nationkey AS VARCHAR) AS grp FROM customer")
def source_samplesheet(t):
    """A samplesheet that is valid."""
    df = t("customer").select(F.concat(F.lit("s"), s("c_custkey")).alias("sample"), F.concat(F.lit("g"), s("c_nationkey")).alias("group"))
    path = _path(df, ".csv")
    sinks.write_table(df, path, sep=",")
    return tables.samplesheet(df.sparkSession, path, "sample string, `group` string").withColumnRenamed("group", "grp")


SHEET = {
    "type": "array",
    "items": {
        "properties": {"sample": {"type": "string", "pattern": "^\\S+$", "unique": True}, "group": {}, "size": {"type": "integer"}, "kind": {"enum": ["AUTOMOBILE", "BUILDING", "MACHINERY"]}, "acc": {"minLength": 9, "maxLength": 12}},
        "required": ["sample", "group", "acc"],
    },
}


@query("""
WITH c AS (SELECT CASE WHEN c_custkey % 10 = 0 THEN 'twice' WHEN c_custkey % 7 = 0 THEN 'with space ' || CAST(c_custkey AS VARCHAR) ELSE 's' || CAST(c_custkey AS VARCHAR) END AS sample, CASE WHEN c_custkey % 4 > 0 THEN 'g' END AS grp,
CASE WHEN c_custkey % 6 = 0 THEN 'x' ELSE CAST(c_nationkey AS VARCHAR) END AS size, c_mktsegment AS kind, CASE WHEN c_custkey % 3 > 0 THEN 'a' || CAST(c_custkey * 1000000 AS VARCHAR) END AS acc FROM customer)
SELECT * FROM (SELECT 'sample' AS col, 'pattern' AS rule, count(*) AS n FROM c WHERE regexp_matches(sample, '\\s') UNION ALL SELECT 'sample', 'unique', count(*) FROM c WHERE sample = 'twice' AND (SELECT count(*) FROM c WHERE sample = 'twice') > 1
UNION ALL SELECT 'group', 'required', count(*) FROM c WHERE grp IS NULL UNION ALL SELECT 'size', 'type', count(*) FROM c WHERE size = 'x' UNION ALL SELECT 'kind', 'enum', count(*) FROM c WHERE kind NOT IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
UNION ALL SELECT 'acc', 'required', count(*) FROM c WHERE acc IS NULL UNION ALL SELECT 'acc', 'minLength', count(*) FROM c WHERE length(acc) < 9 UNION ALL SELECT 'acc', 'maxLength', count(*) FROM c WHERE length(acc) > 12) WHERE n > 0""")
def sheet_violations(t):
    """How many rows of a sheet break each rule of its JSON schema."""
    key = F.col("c_custkey")
    sample = F.when(key % 10 == 0, "twice").when(key % 7 == 0, F.concat(F.lit("with space "), s("c_custkey"))).otherwise(F.concat(F.lit("s"), s("c_custkey")))
    acc = F.when(key % 3 > 0, F.concat(F.lit("a"), (key * 1_000_000).cast("string")))
    sheet = t("customer").select(sample.alias("sample"), F.when(key % 4 > 0, "g").alias("group"), F.when(key % 6 == 0, "x").otherwise(s("c_nationkey")).alias("size"), F.col("c_mktsegment").alias("kind"), acc.alias("acc"))
    return tables.violations(sheet, SHEET).withColumnRenamed("column", "col")


@query("SELECT n_nationkey AS key FROM nation WHERE false")
def source_absent(t):
    """A table that isn't there has no rows."""
    df = t("nation")
    return tables.read_or_none(df.sparkSession, _path(df), "key bigint").select(F.col("key").cast("int").alias("key"))


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey <= 10")
def sink_once(t):
    """A result that is remembered by its path: the second one isn't written."""
    from sequoir.operators.store import once

    df = t("customer").select(F.col("c_custkey").alias("id"))
    path = _path(df)
    once(df.where("id <= 10"), path)
    return once(df, path)


@query("SELECT o_orderkey AS id, o_orderstatus AS label FROM orders WHERE o_orderstatus IN ('F', 'P')")
def channel_demux(t):
    """A shared stage's output taken apart by label, and two parts put together again."""
    from sequoir.operators.dataflow import demux, mix

    parts = demux(t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("label")), "label", ["F", "O", "P"])
    return mix(parts["F"], parts["P"])


@query("SELECT o_orderkey AS id FROM (SELECT * FROM orders ORDER BY o_orderstatus = 'F' DESC, o_totalprice DESC, o_orderkey LIMIT 50)")
def sorted_head(t):
    """The first rows by a derived flag, a number downwards, and an id."""
    return t("orders").orderBy((F.col("o_orderstatus") == "F").desc(), F.col("o_totalprice").desc(), "o_orderkey").limit(50).select(F.col("o_orderkey").alias("id"))
