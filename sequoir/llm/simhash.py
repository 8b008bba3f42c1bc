"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Each distinct fingerprint emits itself and all variants within half the radius
(one bit of two). Two fingerprints within the radius meet at a variant, and
all that meet at one variant lie within the radius of each other; so links
between neighbours in a variant's sorted list connect what all pairs would,
and a variant's list is never gathered. Components are found by alternating
stars over tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sequoir.llm.common import free_names, map_arrow, materialise, utf8
from sequoir.operators import graph

SHINGLE_WORDS = 3
SEED = 42
BITS = 64
#: Most differing bits of linked fingerprints, and half of it.
RADIUS = 2
HALF = 1
#: Shingle hashes that are unpacked to bits at a time.
SLAB = 8192
#: Hashes that are counted at a time in counters of one byte, and the odd number that mixes them.
BYTE, MIX = 254, np.uint64(0x9FB21C651E98DF25)


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, unsigned; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size)
    starts = (ends - size)[: len(words) - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SLAB):
        part = hashes[at : at + SLAB]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view(np.uint64)[0])


def majority(hashes: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """The bits of the SimHash of a set of hashes, sorted, of 64 bits for each odd multiplier; where half have a bit the first decides."""
    n, half = len(hashes), np.uint64(32)
    counts = np.zeros(len(odd) * BITS, np.int64)
    for at in range(0, n, BYTE):
        x = hashes[at : at + BYTE, None] * odd
        x ^= x >> half
        x *= MIX
        x ^= x >> half
        bits = np.unpackbits(x.view(np.uint8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint8)
        if not at and n % 2 == 0:
            counts += bits[0]
    return 2 * counts > n


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp long (the fingerprint's bits) of every row; null text has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(x) for x in utf8(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(marks)], ["doc_id", "fp"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, fp long")


def ball_links(marks: DataFrame) -> DataFrame:
    """Distinct links (src < dst) that connect the distinct fp of marks within RADIUS."""
    flips = F.array(F.lit(0).cast("long"), *(F.shiftleft(F.lit(1).cast("long"), i) for i in range(BITS)))
    sent = marks.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    met = sent.withColumn("other", F.lag("fp").over(Window.partitionBy("variant").orderBy("fp")))
    near = met.where("other is not null").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS)
    return near.select(F.col("other").alias("src"), F.col("fp").alias("dst")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node of links (src, dst)."""
    return graph.components(links).withColumnRenamed("component", "root")


def _roots(marks: DataFrame) -> DataFrame:
    """marks (fp distinct, more columns) with the column root, the smallest fp of the component."""
    rooted = components(ball_links(marks.select("fp")))
    return marks.join(rooted, marks.fp == rooted.node, "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of docs (doc_id, text).

    Null and empty texts have fingerprint zero and link like any other. Ties
    and repeated rows share a fingerprint, hence a component. component_id is
    the smallest doc_id of the component, null if all its doc_ids are null.
    Other columns aren't read; an empty table gives an empty result. A long
    text's words are a list while it is hashed, about fifteen times the text.
    """
    marked = materialise(fingerprints(docs), "fingerprints")
    roots = _roots(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    smallest = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = roots.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Columns that representatives() adds while it works, under other names if docs has them.
OWN = ("_sequoir_fp", "_sequoir_row")


def representatives(docs: DataFrame) -> DataFrame:
    """One row of docs, with all its columns, of each component: that of its smallest doc_id.

    Rows without a doc_id come last; of several with that doc_id one stays.
    Columns named fp, root or node pass through.
    """
    at = docs.columns.index("text")
    mark, row = free_names(OWN, docs.columns)
    names = [*docs.columns, mark]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(x) for x in utf8(batch.column(at))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks)], names)

    marked = map_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField(mark, T.LongType())]))
    marked = materialise(marked.withColumn(row, F.monotonically_increasing_id()), "marked")  # row numbers hold once they are written
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    roots = _roots(marked.groupBy(F.col(mark).alias("fp")).agg(F.min(order).alias("first")))
    kept = roots.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return marked.join(kept, row, "left_semi").select(*docs.columns)
