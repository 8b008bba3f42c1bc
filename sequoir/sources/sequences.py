"""Sequence files: FASTA and GenBank."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """id, description, seq of the records of FASTA files, gzipped or not.

    Records are split at line beginnings with `>`, so an uncompressed file is
    read by many tasks. The id is the header's first word, the description all
    of it; line breaks and spaces of the sequence are taken out. Text before
    the first header is no record.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Without what begins a file and has no header: all other parts follow a line beginning with `>`."""
        last = None
        for batch in batches:
            keep = []
            for file, block, value in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(0), strict=True):
                begins, last = (file, block) != last and block == 0, (file, block)
                keep.append(not begins or value.as_py()[:4096].lstrip()[:1] == ">")
            yield batch.filter(pa.array(keep, pa.bool_()))

    text = raw.mapInArrow(headed, raw.schema).select(F.regexp_replace(F.regexp_replace("value", "\r", ""), r"^\s*>", "").alias("r"))
    header = F.regexp_extract("r", r"^([^\n]*)", 1)
    rows = text.where(F.trim("r") != "").select(header.alias("description"), F.regexp_replace(F.regexp_replace("r", r"^[^\n]*\n?", ""), r"\s", "").alias("seq"))
    return rows.select(F.regexp_extract("description", r"^(\S*)", 1).alias("id"), "description", "seq")


FEATURE = "array<struct<kind:string,location:string,qualifiers:map<string,array<string>>>>"


def genbank(spark: SparkSession, path: str) -> DataFrame:
    """record, seq, features of GenBank records, each feature with its kind, location and lists of qualifiers.

    Lines that go on are joined by a space, those of a location and of a
    translation without; doubled quotes in a value are one.
    """
    raw = spark.read.option("lineSep", "\n//").text(path).select(F.regexp_replace("value", "\r", "").alias("r")).where(F.col("r").contains("LOCUS"))
    table = F.regexp_extract("r", r"(?s)\nFEATURES[^\n]*((?:\n .*?)?)(?:\nORIGIN|\nCONTIG|\z)", 1)
    seq = F.upper(F.regexp_replace(F.regexp_extract("r", r"(?s)\nORIGIN[^\n]*\n(.*)", 1), r"[^A-Za-z]", ""))
    parts = F.filter(F.split(table, r"\n {5}(?=\S)"), lambda x: F.trim(x) != "")

    def feature(x):
        flat = F.regexp_replace(x, r"\n {6,}(?=/)", "\u0001")
        flat = F.regexp_replace(flat, r"\n {6,}", " ")
        fields = F.split(flat, "\u0001")
        head = F.get(fields, F.lit(0))
        bare = lambda q: F.replace(F.regexp_replace(F.regexp_extract(q, r"(?s)=(.*)$", 1), '^"|"$', ""), F.lit('""'), F.lit('"'))
        value = lambda q: F.when(q.startswith("/translation="), F.regexp_replace(bare(q), r"\s", "")).otherwise(bare(q))
        pairs = F.transform(F.slice(fields, 2, F.size(fields)), lambda q: F.struct(F.regexp_extract(q, r"^/([^=]*)", 1).alias("key"), value(q).alias("value")))
        keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
        values = F.transform(keys, lambda k: F.transform(F.filter(pairs, lambda p: p["key"] == k), lambda p: p["value"]))
        return F.struct(F.regexp_extract(head, r"^(\S+)", 1).alias("kind"), F.regexp_replace(F.regexp_extract(head, r"^\S+\s+(.*)$", 1), r"\s", "").alias("location"), F.map_from_arrays(keys, values).alias("qualifiers"))

    return raw.select(F.regexp_extract("r", r"LOCUS\s+(\S+)", 1).alias("record"), seq.alias("seq"), F.transform(parts, feature).cast(FEATURE).alias("features"))


#: Columns at which a feature's location and qualifiers begin and lines end.
INDENT, WIDTH = 21, 79


def genbank_text(record: Column | str = "record", seq: Column | str = "seq", features: Column | str = "features") -> Column:
    """A GenBank record as text, that genbank() reads back.

    Values break at single spaces, locations after commas, translations
    anywhere; a word longer than a line stays whole.
    """
    name, letters, listed = (F.col(c) if isinstance(c, str) else c for c in (record, seq, features))
    pad, room = "\n" + " " * INDENT, WIDTH - INDENT

    def written(key: Column, value: Column) -> Column:
        plain = F.concat(F.lit("/"), key, F.lit('="'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        whole = F.when(value == "", F.concat(F.lit("/"), key)).otherwise(plain)
        anywhere = F.regexp_replace(whole, rf"(.{{{room}}})(?=.)", f"$1{pad}")
        return F.when(key == "translation", anywhere).otherwise(F.regexp_replace(whole, rf"(.{{0,{room - 1}}}\S) (?=\S)", f"$1{pad}"))

    def feature(f: Column) -> Column:
        place = F.regexp_replace(f["location"], rf"(.{{1,{room - 1}}},)(?=.)", f"$1{pad}")
        pairs = F.flatten(F.transform(F.map_entries(f["qualifiers"]), lambda e: F.transform(e["value"], lambda v: written(e["key"], v))))
        return F.array_join(F.concat(F.array(F.concat(F.rpad(F.concat(F.lit("     "), f["kind"]), INDENT, " "), place)), pairs), pad)

    tens = F.regexp_replace(F.lower(letters), "(.{10})", "$1 ")
    lines = F.transform(F.regexp_extract_all(tens, F.lit(".{1,66}"), F.lit(0)), lambda x, i: F.concat(F.lpad((i * 60 + 1).cast("string"), 9, " "), F.lit(" "), F.rtrim(x)))
    head = F.concat(F.lit("LOCUS       "), name, F.lit(" "), F.length(letters).cast("string"), F.lit(" bp    DNA     linear   UNK\nACCESSION   "), name, F.lit("\nFEATURES             Location/Qualifiers"))
    return F.concat(F.concat_ws("\n", head, F.array_join(F.transform(F.filter(listed, lambda f: f.isNotNull()), feature), "\n"), F.lit("ORIGIN"), F.array_join(lines, "\n")), F.lit("\n//"))
