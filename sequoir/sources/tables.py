"""Delimited tables: strict, tolerant, headerless, with a preamble, or absent."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Mapping, Sequence
from functools import reduce
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sequoir.operators.rank import numbered
from sequoir.operators.store import exists


def _schema(schema: str | T.StructType) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def delimited(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType, sep: str = "\t", header: bool = True, null: str | None = None) -> DataFrame:
    """A delimited table with the columns of the schema, by name if it has a header and else by position.

    Text equal to `null` is null, for this read alone; an empty cell always is.
    A cell that is not of its column's type is null (so the read is tolerant).
    With a header, columns of the file that the schema lacks are not read.
    """
    own = _schema(schema)
    reader = spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"')
    if null is not None:
        reader = reader.option("nullValue", null)
    if not header:
        return reader.schema(own).csv(path)
    text = reader.option("inferSchema", False).csv(path)
    there = {c.strip(): c for c in text.columns}
    missing = [f.name for f in own if f.name not in there]
    if missing:
        raise ValueError(f"no columns {missing} in {path}")
    return text.select(*(typed(f"`{there[f.name]}`", f.dataType).alias(f.name) for f in own))


def typed(name: str, kind: T.DataType) -> Column:
    c = F.col(name)
    return c if isinstance(kind, T.StringType) else F.trim(c).try_cast(kind)


def unnamed_first(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",", null: str | None = None) -> DataFrame:
    """A table whose first header cell is empty; the schema's first column is that one."""
    own = _schema(schema)
    reader = spark.read.option("sep", sep).option("header", True)
    text = (reader.option("nullValue", null) if null is not None else reader).csv(path)
    first, rest = own.fields[0], own.fields[1:]
    return text.select(typed(f"`{text.columns[0]}`", first.dataType).alias(first.name), *(typed(f"`{f.name}`", f.dataType).alias(f.name) for f in rest))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """value of each line, with the text it is of, and file, block and place, in whose order the lines are.

    A text is a file, or a folder whose parts (part-*) are it in the order of their names.
    """
    file = F.col("_metadata.file_path")
    text = F.regexp_replace(file, "/part-[^/]*$", "")
    return spark.read.text(path).select("value", text.alias("text"), file.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))


def numbered_lines(spark: SparkSession, path: str, name: str = "line") -> DataFrame:
    """value and number from 1 of the lines of texts, numbered on from file to file.

    Every task numbers its own lines, and the counts before them are added.
    """
    return numbered(text_lines(spark, path), ["file", "block", "place"], name).select("value", name)


def with_preamble(spark: SparkSession, path: str, schema: str | T.StructType, skip: int = 5, sep: str = "\t", null: str | None = None) -> DataFrame:
    """A table after `skip` lines of preamble and a header line; the schema names columns of the header.

    Empty lines don't count. Of each file `skip` + 1 lines at most are ranked,
    which must lie in its first split; a text in parts has one preamble.
    """
    own = _schema(schema)
    lines = text_lines(spark, path).withColumn("line", F.regexp_replace("value", "\r$", "")).where("line <> ''")
    in_file = F.row_number().over(Window.partitionBy("file").orderBy("place"))
    first = lines.where("block = 0").withColumn("rank", in_file).where(F.col("rank") <= skip + 1)
    header = first.withColumn("rank", F.row_number().over(Window.partitionBy("text").orderBy("file", "rank"))).where(F.col("rank") == skip + 1)
    names = header.select("text", F.split("line", sep).alias("names"), F.col("file").alias("header_file"), F.col("place").alias("header"))
    body = lines.join(names, "text").where("file > header_file or file = header_file and (block > 0 or place > header)")
    cells = body.select("names", F.split("line", sep).alias("cells"))
    value = lambda f: F.get("cells", (F.array_position("names", f.name) - 1).cast("int"))
    clean = lambda c: F.when((c == "") | (c == null if null is not None else F.lit(False)), None).otherwise(c)
    return cells.select(*(clean(value(f)).try_cast(f.dataType).alias(f.name) for f in own))


def workbook(spark: SparkSession, path: str, sheet: str, schema: str | T.StructType) -> DataFrame:
    """A sheet of an Excel workbook (.xlsx), by its name or a pattern of it; the schema names columns of its first row.

    A workbook is one zip archive of at most 1,048,576 rows a sheet, so it is
    one task's. A cell that is not of its column's type is null; the first
    sheet that fits is read; a missing sheet or column is an error.
    """
    own = _schema(schema)
    names = [f.name for f in own]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows = _sheet_rows(content, sheet, names)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(len(names))], names)

    read = spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, text)
    return read.select(*(typed(f"`{f.name}`", f.dataType).alias(f.name) for f in own))


def _sheet_rows(content: bytes, sheet: str, names: Sequence[str]) -> list[list[str | None]]:
    """Rows of a sheet below its header, the named columns in order."""
    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        tree = lambda name: ElementTree.fromstring(archive.read(name))
        targets = {r.get("Id"): r.get("Target").removeprefix("/xl/") for r in tree("xl/_rels/workbook.xml.rels")}
        sheets = [(x.get("name"), x.get("{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id")) for x in tree("xl/workbook.xml").iter(f"{space}sheet")]
        chosen = next((i for n, i in sheets if n == sheet or re.search(sheet, n)), None)
        if chosen is None:
            raise ValueError(f"no sheet {sheet!r} among {[n for n, _ in sheets]}")
        texts = lambda x: "".join(t.text or "" for t in x.iter(f"{space}t"))
        shared = [texts(x) for x in tree("xl/sharedStrings.xml").iter(f"{space}si")] if "xl/sharedStrings.xml" in archive.namelist() else []
        rows = []
        for row in tree(f"xl/{targets[chosen]}").iter(f"{space}row"):
            cells: dict[int, str | None] = {}
            for k, cell in enumerate(row.iter(f"{space}c")):
                letters = re.match("[A-Z]*", cell.get("r") or "")[0]
                at = reduce(lambda n, c: n * 26 + ord(c) - 64, letters, 0) - 1 if letters else k
                value = cell.find(f"{space}v")
                kind = cell.get("t")
                text = texts(cell) if kind == "inlineStr" else None if value is None else shared[int(value.text)] if kind == "s" else value.text
                cells[at] = text or None
            rows.append(cells)
    header = {v: k for k, v in (rows[0] if rows else {}).items()}
    missing = [n for n in names if n not in header]
    if missing:
        raise ValueError(f"no columns {missing} in sheet {sheet!r}")
    return [[r.get(header[n]) for n in names] for r in rows[1:] if any(r.values())]


def read_or_none(spark: SparkSession, path: str | None, schema: str | T.StructType, **options) -> DataFrame:
    """delimited(), or no rows if the path is none or there is no such file."""
    if path and exists(spark, path):
        return delimited(spark, path, schema, **options)
    return spark.createDataFrame([], _schema(schema))


def trimmed_rows(spark: SparkSession, path: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    """A headerless file as rows of trimmed texts."""
    cells = F.split("value", f"\\Q{sep}\\E")
    return spark.read.text(path).select(*(F.trim(F.get(cells, F.lit(i))).alias(n) for i, n in enumerate(names)))


def samplesheet(spark: SparkSession, path: str, schema: str, required: Sequence[str] = ("sample", "group"), unique: str = "sample", pattern: str = r"^\S+$") -> DataFrame:
    """A samplesheet, or ValueError naming what is wrong with it: a required cell that is empty or has white space, an id twice."""
    sheet = delimited(spark, path, schema, sep=",")
    bad = [c for c in required if sheet.where(F.col(c).isNull() | ~F.col(c).rlike(pattern)).limit(1).count()]
    twice = sheet.groupBy(unique).count().where("count > 1").limit(1).count()
    if bad or twice:
        raise ValueError(f"samplesheet: {'empty or spaced ' + ', '.join(bad) if bad else ''}{' and ' if bad and twice else ''}{unique + ' twice' if twice else ''}")
    return sheet


def violations(sheet: DataFrame, rules: Mapping) -> DataFrame:
    """column, rule, n: how many rows of a sheet (all text) break each rule of a JSON schema of its rows; only broken rules.

    rules: a schema of an array of objects or of one object. Known rules:
    required, type (string, integer, number, boolean), pattern, enum, minLength,
    maxLength, and unique. Cells without a value break nothing but required.
    """
    own = rules.get("items", rules)
    kinds = {"integer": r"^[+-]?\d+$", "number": r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$", "boolean": "^(true|false)$"}
    broken: dict[tuple[str, str], Column] = {}
    there = set(sheet.columns)
    for name, rule in own.get("properties", {}).items():
        c = F.col(f"`{name}`") if name in there else F.lit(None).cast("string")
        if name in own.get("required", ()):
            broken[name, "required"] = c.isNull() | (c == "")
        for key, test in (
            ("type", lambda c, v: ~c.rlike(kinds[v]) if v in kinds else F.lit(False)),
            ("pattern", lambda c, v: ~c.rlike(v)),
            ("enum", lambda c, v: ~c.isin([str(x) for x in v])),
            ("minLength", lambda c, v: F.length(c) < v),
            ("maxLength", lambda c, v: F.length(c) > v),
        ):
            if key in rule:
                broken[name, key] = test(c, rule[key])
    counts = [F.struct(F.lit(name).alias("column"), F.lit(rule).alias("rule"), F.count_if(c).alias("n")) for (name, rule), c in broken.items()]
    none = F.array().cast("array<struct<column:string,rule:string,n:bigint>>")
    found = sheet.agg(F.array(*counts).alias("x") if counts else F.first(none).alias("x")).select(F.inline("x"))
    for name, rule in own.get("properties", {}).items():
        if rule.get("unique") and name in there:
            twice = sheet.groupBy(F.col(f"`{name}`").alias("value")).count().where("value is not null and count > 1")
            found = found.unionByName(twice.agg(F.lit(name).alias("column"), F.lit("unique").alias("rule"), F.coalesce(F.sum("count"), F.lit(0)).alias("n")))
    return found.where("n > 0")


def schema_sheet(spark: SparkSession, path: str, rules_path: str) -> DataFrame:
    """A samplesheet with the columns of a JSON schema (those that it lacks are null), or ValueError naming what rules are broken, and how often."""
    rules = json.loads(spark.read.text(rules_path, wholetext=True).first()[0])
    text = spark.read.option("header", True).option("inferSchema", False).csv(path)
    text = text.select(*(F.trim(F.col(f"`{c}`")).alias(c.strip()) for c in text.columns))
    wrong = sorted((r.column, r.rule, r.n) for r in violations(text, rules).collect())
    if wrong:
        raise ValueError("samplesheet: " + "; ".join(f"{column}: {rule} ({n})" for column, rule, n in wrong))
    names = rules.get("items", rules)["properties"]
    return text.select(*(F.col(f"`{n}`") if n in text.columns else F.lit(None).cast("string").alias(n) for n in names))


def files(spark: SparkSession, pattern: str) -> DataFrame:
    """path, name, stem (name to its first dot), length of the files of a glob, empty ones too; they are listed and not opened."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob) or []
    listed = spark.createDataFrame([(f.getPath().toString(), f.getLen()) for f in found if f.isFile()], "path string, length long")
    return listed.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.regexp_extract("path", r"([^/.]+)[^/]*$", 1).alias("stem"), "length")


def file_pairs(spark: SparkSession, pattern: str, mate: str = r"_R?[12]$") -> DataFrame:
    """stem, paths: files of a glob grouped by their stem without the mark of the mate, sorted."""
    own = files(spark, pattern).withColumn("stem", F.regexp_replace("stem", mate, ""))
    return own.groupBy("stem").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def json_config(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON list of records, or one record."""
    return spark.read.schema(schema).json(path, multiLine=True)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
