"""Product quantisation whose Lloyd rounds move only what changed.

Vectors become integers and are cut into parts; every part position has a
codebook. A round assigns parts to their nearest entries and writes the
assignments next to the vectors. Running integer sums and counts of the entries
are kept from round to round: only parts whose assignment changed are shuffled,
as a minus at the old entry and a plus at the new one, added up in each task
first. Vectors are never shuffled. Sums are exact whatever the size of the
components: they travel as digits of 31 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.llm.common import forget, map_arrow, materialise

#: Parts of a vector, entries of a codebook, rounds.
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: A component x becomes floor(SCALE * x).
SCALE = 256
#: Rows that are compared with the codebooks at once.
AT_ONCE = 2_048
#: Bits of a digit that a sum travels in.
DIGIT = 31
#: Sums over so few labels are broadcast (a row has 16 bytes); more are shuffled.
SENT_LABELS = 200_000
#: The largest error that a long can hold; greater ones stay at it.
MOST = (1 << 63) - 1

STATE = "vec_id long, label string, ints array<double>, code binary, old binary"


def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id, label (as text), ints of the rows whose vector is whole; doubles hold all integers that floats give exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            values = column.flatten().cast(pa.float64())
            flat = values.to_numpy(zero_copy_only=False) * SCALE
            lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            keep = (bad[ends] == bad[ends - lengths]) & column.is_valid().to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            ints = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.floor(flat)))
            n = batch.num_rows
            out = pa.record_batch([batch.column(0), batch.column(1), ints, pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=["vec_id", "label", "ints", "code", "old"])
            yield out.filter(pa.array(keep))

    return map_arrow(vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>")), run, STATE)


def padded(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows of PARTS * width numbers, short ones filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == PARTS * width).all():
        return flat.reshape(len(lengths), PARTS * width)
    out = np.zeros((len(lengths), PARTS * width))
    out[np.arange(PARTS * width) < lengths[:, None]] = flat
    return out


def nearest(x: np.ndarray, book: list[list[int]]) -> tuple[np.ndarray, list[int]]:
    """The nearest entry of each row (ties: the first) and its squared distance, exactly.

    Within what doubles hold exactly this is a product of matrices; beyond, whole numbers of any size.
    """
    width = x.shape[1]
    most = max([float(np.abs(x).max(initial=0)), *(abs(v) for e in book for v in e)], default=0)
    if 4 * width * most * most < 2**53:
        c = np.array(book, float).reshape(len(book), width)
        d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
        at = d.argmin(1)
        return at, d[np.arange(len(x)), at].astype(np.int64).tolist()
    rows = [[int(v) for v in row] for row in x.tolist()]
    best = [min((sum((a - b) ** 2 for a, b in zip(row, e, strict=True)), k) for k, e in enumerate(book)) for row in rows]
    return np.array([k for _, k in best]), [d for d, _ in best]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE)


def assigned(state: DataFrame, books: list[list[list[int]]], width: int) -> DataFrame:
    """The state with the parts' nearest entries as code and the codes before as old."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = padded(batch.column(2), width)
            codes = np.column_stack([nearest(x[:, p * width : (p + 1) * width], books[p])[0] for p in range(PARTS)]).astype(np.uint8)
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column(3)], names=["vec_id", "label", "ints", "code", "old"])

    return map_arrow(state, run, STATE)


def changes(state: DataFrame, width: int) -> DataFrame:
    """part, entry, place, digit, amount: what the parts whose entry changed take from the old one and add to the new one.

    Place -1 counts parts; amount * 2**(DIGIT * digit) add up to the sum.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], int] = {}
        for batch in _slices(batches):
            new = np.array([list(c) for c in batch.column(1).to_pylist()]).reshape(-1, PARTS)
            old = np.array([[-1] * PARTS if c is None else list(c) for c in batch.column(2).to_pylist()]).reshape(-1, PARTS)
            x = padded(batch.column(0), width)
            exact = float(np.abs(x).max(initial=0)) * len(x) < 2**53
            for p in range(PARTS):
                moved = new[:, p] != old[:, p]
                part = x[moved, p * width : (p + 1) * width]
                for sign, codes in ((1, new[moved, p]), (-1, old[moved, p])):
                    for entry in np.unique(codes[codes >= 0]).tolist():
                        rows = part[codes == entry]
                        total = rows.sum(0).tolist() if exact else [sum(map(int, c)) for c in rows.T.tolist()]
                        for place, v in enumerate([len(rows), *total], -1):
                            sums[p, entry, place] = sums.get((p, entry, place), 0) + sign * int(v)
        out = []
        for key, v in sums.items():
            sign, v, digit = (-1 if v < 0 else 1), abs(v), 0
            while v:
                out.append((*key, digit, sign * (v & ((1 << DIGIT) - 1))))
                v, digit = v >> DIGIT, digit + 1
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = [pa.int32()] * 4 + [pa.int64()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["part", "entry", "place", "digit", "amount"])

    moved = map_arrow(state.where("not code <=> old").select("ints", "code", "old"), run, "part int, entry int, place int, digit int, amount long")
    return moved.groupBy("part", "entry", "place", "digit").agg(F.sum("amount").alias("amount"))


class Codebooks:
    """Entries by part, with the running sums and counts that they follow from."""

    def __init__(self, seeds: list[list[float]], width: int) -> None:
        rows = [[int(v) for v in s] + [0] * (PARTS * width - len(s)) for s in seeds]
        self.width = width
        self.books = [[row[p * width : (p + 1) * width] for row in rows] for p in range(PARTS)]
        self.sums: dict[tuple[int, int, int], int] = {}

    def add(self, rows: list) -> None:
        """rows: part, entry, place, digit, amount. Entries that have parts become their floored means; others stay."""
        for part, entry, place, digit, amount in rows:
            self.sums[part, entry, place] = self.sums.get((part, entry, place), 0) + (amount << (DIGIT * digit))
        for p, book in enumerate(self.books):
            for e in range(len(book)):
                n = self.sums.get((p, e, -1), 0)
                if n:
                    book[e] = [self.sums.get((p, e, k), 0) // n for k in range(self.width)]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for book in self.books for entry in book for v in entry).encode()).hexdigest()


def coded(state: DataFrame, codebooks: Codebooks) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits a part), error of every row of the state."""
    books, width = codebooks.books, codebooks.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = padded(batch.column(2), width)
            found = [nearest(x[:, p * width : (p + 1) * width], books[p]) for p in range(PARTS)]
            codes = np.column_stack([at for at, _ in found]).astype(np.uint8)
            errors = [min(sum(ds), MOST) for ds in zip(*(d for _, d in found), strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    return map_arrow(state, run, "vec_id long, label string, code string, error long")


def train(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """The last state of the vectors and the codebooks after the rounds; the state is a table in the shared folder."""
    state = materialise(scaled(vectors), "vectors")
    longest = state.agg(F.max(F.size("ints"))).first()[0] or 0
    first = state.where("vec_id is not null").orderBy("vec_id", "ints").limit(ENTRIES).select("vec_id", "ints").collect()
    if len(first) < ENTRIES:
        first += state.where("vec_id is null").orderBy("ints").limit(ENTRIES - len(first)).select("vec_id", "ints").collect()
    codebooks = Codebooks([r.ints for r in first], -(-longest // PARTS))
    for k in range(rounds if first else 0):
        before, state = state, materialise(assigned(state, codebooks.books, codebooks.width), f"assigned-{k}")
        forget(before)
        codebooks.add(changes(state, codebooks.width).collect())
    return state, codebooks


def quantise(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row of vectors (vec_id, embedding, label) that is kept.

    Rows go whose vector is null or holds null or a number that isn't finite
    (or isn't once multiplied by SCALE). The codebooks begin as the parts of the ENTRIES rows with the smallest ids
    (equal ids: by vector; null ids last; fewer rows: fewer entries). Vectors whose length differs,
    or is no multiple of PARTS, are filled up with zeros to the longest one's
    next multiple. Repeated rows are each kept and counted; nulls are one
    label; an empty table gives no rows; other columns aren't read. Errors
    over 2**63 - 1 are given as that. The driver gets PARTS * ENTRIES sums a
    round, whatever the number of vectors.
    """
    state, codebooks = train(vectors, rounds)
    done = materialise(coded(state, codebooks), "codes")
    forget(state)
    whole = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")
    labels = done.groupBy(F.col("label").alias("of")).agg(whole.alias("label_error"))
    near = F.broadcast if done.agg(F.approx_count_distinct("label")).first()[0] <= SENT_LABELS else (lambda x: x)
    return done.join(near(labels), F.col("label").eqNullSafe(F.col("of")), "left").select("vec_id", "code", "error", "label_error", F.lit(codebooks.digest()).alias("codebooks_sha256"))


def quantise_sql(dims: int = 64, rounds: int = ROUNDS) -> str:
    """The query in DuckDB's SQL."""
    width = dims // PARTS
    places = range(1, width + 1)
    dist = " + ".join(f"(p.x{k} - e.x{k}) * (p.x{k} - e.x{k})" for k in places)
    xs = ", ".join(f"x{k}" for k in places)
    near = lambda k: f"SELECT vec_id, label, part, min(d * {ENTRIES} + entry) % {ENTRIES} AS entry, min(d) AS d, {', '.join(f'any_value(x{i}) AS x{i}' for i in places)} FROM (SELECT p.*, e.entry, {dist} AS d FROM parts p JOIN book{k} e USING (part)) GROUP BY vec_id, label, part"
    steps = []
    for k in range(rounds):
        mean = ", ".join(f"CASE WHEN n.n IS NULL THEN b.x{i} ELSE (n.s{i} - ((n.s{i} % n.n) + n.n) % n.n) // n.n END AS x{i}" for i in places)
        sums = ", ".join(f"CAST(sum(x{i}) AS BIGINT) AS s{i}" for i in places)
        steps.append(f"near{k} AS MATERIALIZED ({near(k)}), sum{k} AS (SELECT part, entry, count(*) AS n, {sums} FROM near{k} GROUP BY part, entry), book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, {mean} FROM book{k} b LEFT JOIN sum{k} n USING (part, entry))")
    joined = reduce(lambda a, b: f"{a} || ',' || {b}", (f"CAST(x{k} AS VARCHAR)" for k in places))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, CAST(part AS BIGINT) AS part, {", ".join(f"v[part * {width} + {k}] AS x{k}" for k in places)} FROM kept, range({PARTS}) t(part)
), seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {ENTRIES}),
book0 AS MATERIALIZED (SELECT part, entry, {xs} FROM parts JOIN seeds USING (vec_id)), {", ".join(steps)},
ended AS MATERIALIZED ({near(rounds)}),
books AS (SELECT sha256(string_agg({joined}, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}),
codes AS (SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM ended GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM codes, books
"""
