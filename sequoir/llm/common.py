"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sequoir.operators.store import forget, shared_dir, spread
from sequoir.operators.store import settled as materialise

__all__ = ["BATCH_BYTES", "WORD_CLASS", "WORD_SPACE", "crc_mod", "forget", "free_names", "keep_rows", "map_arrow", "materialise", "shared_dir", "table", "utf8"]

#: Bytes that separate words: space and U+0009 to U+000D, as bytes.split() has them.
WORD_SPACE = b" \t\n\r\x0b\x0c"
#: The same set as a Java or RE2 character class of what words are made of.
WORD_CLASS = r"[^\x20\x09-\x0D]+"
#: Most bytes of one Arrow batch that goes to Python; a longer text travels alone.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with batches bounded in bytes, so that long texts don't pile up."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def keep_rows(df: DataFrame, column: str, verdicts: Callable[[list[bytes]], list[bool]]) -> DataFrame:
    """The rows of df, with all their columns, whose text passes; verdicts judges the texts of a batch."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(verdicts(utf8(batch.column(at))), pa.bool_()))

    return map_arrow(df, run, df.schema)


def free_names(names: Sequence[str], taken: Sequence[str]) -> list[str]:
    """names for columns of one's own, lengthened until none is taken in any case of its letters."""
    used = {x.lower() for x in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        out.append(name)
    return out


def crc_mod(column: str, k: int):
    """crc32 of the column's text, modulo k; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % k
