"""Writers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sequoir.functions.exprs import fasta_record
from sequoir.operators.rank import batches
from sequoir.operators.store import exists, write_whole
from sequoir.sources.sequences import genbank_text

CODECS = {".gz": "gzip", ".bz2": "bzip2", ".zst": "zstd"}


def compression(name: str) -> str:
    """Codec by the suffix of a name; none if it has no known one."""
    return next((codec for suffix, codec in CODECS.items() if name.endswith(suffix)), "none")


def write_table(df: DataFrame, path: str, sep: str = "\t", header: bool = True, null: str = "", decimals: int | None = None) -> None:
    """df as delimited text. decimals rounds every float or double; null is what null is written as."""
    if decimals is not None:
        df = df.select(*(F.format_string(f"%.{decimals}f", F.col(f"`{n}`")).alias(n) if t in ("double", "float") else F.col(f"`{n}`") for n, t in df.dtypes))
    df.write.option("sep", sep).option("header", header).option("nullValue", null).option("emptyValue", "").option("compression", compression(path)).csv(path)


def write_ids(df: DataFrame, column: str, path: str) -> None:
    """One column without a header."""
    df.select(F.col(column).cast("string")).write.option("compression", compression(path)).text(path)


def write_fasta(df: DataFrame, path: str, name: str = "id", seq: str = "seq", width: int | None = None) -> None:
    df.select(fasta_record(name, seq, width).alias("value")).write.option("compression", compression(path)).text(path)


def write_split(df: DataFrame, column: str, path: str, columns: Sequence[str]) -> None:
    """A folder for each value of a column."""
    df.select(*columns, column).write.partitionBy(column).option("header", True).option("sep", "\t").csv(path)


def write_chunks(df: DataFrame, order: Sequence[str], size: int, path: str) -> None:
    """A folder for each chunk of `size` rows in order."""
    batches(df, order, size, "chunk").write.partitionBy("chunk").parquet(path)


def write_routed(df: DataFrame, route, path: str, name: str = "route") -> None:
    """Rows into folders by an expression of their label."""
    df.withColumn(name, route).write.partitionBy(name).parquet(path)


def write_lines(df: DataFrame, order: Sequence[str], path: str, value: str = "value") -> None:
    """Lines as a text in numbered parts: read in the order of their names, the parts give the lines in order.

    Every part is a range of the order and written by a task of its own.
    """
    df.orderBy(*order).select(F.col(value).alias("value")).write.option("compression", compression(path)).text(path)


def write_genbank(records: DataFrame, path: str) -> None:
    """Records (record, seq, features) as GenBank files, one part a task."""
    records.select(genbank_text().alias("value")).write.option("compression", compression(path)).text(path)


def gff(parts: Sequence[DataFrame]) -> DataFrame:
    """value, body, part, place of the lines of several GFF texts (value): in the order of body, part and place, comments come first."""
    marked = [p.select("value", (~F.col("value").startswith("#")).cast("int").alias("body"), F.lit(k).alias("part"), F.monotonically_increasing_id().alias("place")) for k, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, marked)


def write_gff(parts: Sequence[DataFrame], path: str) -> None:
    """Several GFF texts as one: all their comment lines first, then the others."""
    write_lines(gff(parts), ["body", "part", "place"], path)


def concat_tables(spark: SparkSession, paths: Sequence[str], schema: str, header: bool = True, sep: str = "\t") -> DataFrame:
    """Several delimited files of a schema as one table; of their headers none is a row."""
    from sequoir.sources.tables import delimited

    return delimited(spark, list(paths), schema, sep=sep, header=header)


MANIFEST = "manifest.json"


def write_release(artefacts: dict[str, DataFrame], folder: str, previous: str | None = None) -> None:
    """A new versioned snapshot: each artefact's new rows, with those of the release before by reference.

    Only new rows are written. A release is a manifest, which names the folders
    of each artefact's rows, old ones included; it is written last and put in
    place by one rename, so a release is whole or not there. What a killed
    update has written is named by no manifest.
    """
    if not artefacts:
        raise ValueError("a release has artefacts")
    spark = next(iter(artefacts.values())).sparkSession
    if exists(spark, f"{folder}/{MANIFEST}"):
        raise FileExistsError(f"{folder} is released")
    named = _manifest(spark, previous) if previous else {}
    for name, new in artefacts.items():
        path = f"{folder}/{name}/rows-{uuid.uuid4().hex}"
        new.write.parquet(path)
        named[name] = [*named.get(name, []), path]
    write_whole(spark, json.dumps(named, indent=1), f"{folder}/{MANIFEST}")


def _manifest(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Folders by artefact of a release; none if it is not (or not wholly) there."""
    path = f"{folder}/{MANIFEST}"
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if exists(spark, path) else {}


def read_release(spark: SparkSession, folder: str | None, name: str, schema: T.StructType | str) -> DataFrame:
    """All rows of an artefact of a release; none if there is no such release or artefact."""
    paths = _manifest(spark, folder).get(name) if folder else None
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
