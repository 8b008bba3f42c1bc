"""Alignment of two tokenizers over a corpus, by distinct segments.

A text is cut before runs of white space where neither vocabulary can merge
across: the byte-level model's pre-tokenizer begins a new part there, and no
piece of the other model has such a white-space character after another
character, which is looked up in the file. What lies between two cuts is a
segment; its tokens depend on nothing else. Texts are taken in chunks; a chunk
names its distinct segments once and keeps its documents as rows of numbers.
Distinct segments of the corpus are tokenised and aligned once, the alignments
are joined back to the chunks, and a chunk composes its documents from them.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.llm.bpe import Unsupported, byte_letters
from sequoir.llm.common import forget, map_arrow, materialise

#: Characters that a cut may precede, if the second vocabulary allows it.
CUTS = " \n\t"
#: Bytes of text after which a chunk ends; a longer text is a chunk of its own.
CHUNK_BYTES = 32 << 20
#: Characters from which a text's segments are read one by one.
LONG = 1 << 20
#: Segments that are tokenised at once.
AT_ONCE = 2_000
#: So many pairs of linked ids at most are sent to all workers, 20 bytes each; more are joined to the segments by a shuffle.
PAIRS_SENT = 2_000_000
#: What stands before a segment while the second model reads it; its tokens are taken off again.
BEFORE = "a"


class Pair:
    """Both tokenizers and what they have in common: where texts may be cut."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        import tokenizers

        with open(path_a, "rb") as f:
            data = f.read()
        spec = json.loads(data)
        step = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or step.get("type") != "ByteLevel" or not step["use_regex"] or step["add_prefix_space"]:
            raise Unsupported("the first model must be byte-level BPE that splits by its pattern and adds no space")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = tokenizers.Tokenizer.from_buffer(data)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        letters = byte_letters()
        self.bytes_a = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.cuts = cuts([p.replace("▁", " ") for i, p in enumerate(pieces) if not self.b.is_byte(i)])
        self.before = len(self.b.encode(BEFORE))
        #: Numbers that a group list is written in: `|` and `;`, then the ids.
        self.kind = np.dtype("<u2" if max(self.a.get_vocab_size(), len(pieces)) + 2 <= 1 << 16 else "<u4")
        self.names = ["|", ";", *map(str, range(max(max(self.bytes_a) + 1, len(pieces))))]
        #: White space, then no white space, and on over white space that no cut may precede.
        no_cut = rf"[^\S{re.escape(self.cuts)}]" if self.cuts else r"\s"
        self.segment = re.compile(rf"\s*\S*(?:{no_cut}\s*\S*)*")

    def segments(self, text: str) -> Iterator[str]:
        """The segments of a space and the text, in order."""
        text = " " + text
        if len(text) < LONG:
            yield from filter(None, self.segment.findall(text))
        else:
            yield from filter(None, (m.group() for m in self.segment.finditer(text)))

    def tokens(self, segments: list[str]) -> Iterator[tuple[str, list[int], list[int]]]:
        """Each segment with its ids of both models; without ids where the tokens' bytes are not the segment's."""
        a = self.a.encode_batch(segments, add_special_tokens=False)
        b = self.b.encode([BEFORE + s for s in segments], num_threads=1)
        for s, x, y in zip(segments, a, b, strict=True):
            x, y, data = x.ids, y[self.before :], s.encode()
            whole = b"".join(map(self.bytes_a.__getitem__, x)) == data == b"".join(map(self.bytes_b.__getitem__, y))
            yield (s, x, y) if whole else (s, [], [])

    def align(self, x: list[int], y: list[int]) -> tuple[list[tuple[list[int], list[int]]], list[tuple[int, int]]]:
        """Groups of ids between bytes at which tokens of both end, and the pairs of tokens that overlap."""
        groups, links = [], []
        ends_a, ends_b = ([*accumulate(len(table[t]) for t in ids)] for table, ids in ((self.bytes_a, x), (self.bytes_b, y)))
        i = j = start = other = 0
        while i < len(x):
            links.append((x[i], y[j]))
            here, there = ends_a[i], ends_b[j]
            i, j = i + (here <= there), j + (there <= here)
            if here == there:
                groups.append((x[start:i], y[other:j]))
                start, other = i, j
        return groups, links

    def coded(self, groups: list[tuple[list[int], list[int]]]) -> bytes:
        """Groups as numbers."""
        out: list[int] = []
        for x, y in groups:
            out += [*(i + 2 for i in x), 0, *(i + 2 for i in y), 1]
        return np.array(out[:-1], self.kind).tobytes()

    def written(self, coded: bytes) -> str:
        """Groups as text: `a1,a2|b1;a3|b2,b3`."""
        text = ",".join(map(self.names.__getitem__, np.frombuffer(coded, self.kind).tolist()))
        return text.replace(",|,", "|").replace(",;,", ";")


def cuts(pieces: list[str]) -> str:
    """Those of CUTS that no piece has after a character that isn't white space."""
    return "".join(c for c in CUTS if not any(re.search(rf"\S{c}", p) for p in pieces if c in p))


@cache
def pair_of(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


CHUNKS = "chunk long, doc_id long, seq binary, has_tokens boolean, local int, segment string, n long"
ALIGNED = "segment string, n long, ok boolean, groups binary, links_a array<int>, links_b array<int>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def chunked(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents as rows of numbers (seq) and, of each chunk, the segments that the numbers stand for with how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, schema = pair_of(path_a, path_b), None
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        schema = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.binary()), ("has_tokens", pa.bool_()), ("local", pa.int32()), ("segment", pa.string()), ("n", pa.int64())])
        local: dict[str, int] = {}
        ids: list[int | None] = []
        seqs: list[np.ndarray | None] = []
        size, chunk = 0, first

        def flush() -> Iterator[pa.RecordBatch]:
            n = np.zeros(len(local), np.int64)
            for s in seqs:
                if s is not None:
                    n += np.bincount(s, minlength=len(local))
            # frequent segments get small numbers, which compress well
            order = np.argsort(-n, kind="stable")
            number = np.empty(len(local), np.uint32)
            number[order] = np.arange(len(local), dtype=np.uint32)
            none = lambda k, t: pa.nulls(k, t)
            d, k = len(ids), len(local)
            yield pa.record_batch(
                [pa.array(np.full(d, chunk)), pa.array(ids, pa.int64()), pa.array([None if s is None else packed(number[s]) for s in seqs], pa.binary()), pa.array([s is not None for s in seqs], pa.bool_()), none(d, pa.int32()), none(d, pa.string()), none(d, pa.int64())],
                schema=schema,
            )
            yield pa.record_batch([pa.array(np.full(k, chunk)), none(k, pa.int64()), none(k, pa.binary()), none(k, pa.bool_()), pa.array(number.astype(np.int32)), pa.array(list(local), pa.string()), pa.array(n)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                ids.append(doc_id)
                if not text:
                    seqs.append(None)
                else:
                    seq = [local.setdefault(s, len(local)) for s in pair.segments(text)] if len(text) < LONG else (local.setdefault(s, len(local)) for s in pair.segments(text))
                    seqs.append(np.fromiter(seq, np.uint32))
                    size += len(text.encode())
                if size >= CHUNK_BYTES or len(ids) >= 50_000:
                    yield from flush()
                    local, ids, seqs, size, chunk = {}, [], [], 0, chunk + 1
        if ids:
            yield from flush()

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, CHUNKS)


def aligned(segments: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Distinct segments (segment, n), tokenised by both models and aligned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b)
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                rows = []
                for _, x, y in pair.tokens(batch.column(0).to_pylist()):
                    groups, links = pair.align(x, y)
                    rows.append((bool(x), pair.coded(groups), [a for a, _ in links], [b for _, b in links]))
                kinds = [pa.bool_(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["segment", "n", "ok", "groups", "links_a", "links_b"]
                yield pa.record_batch([batch.column(0), batch.column(1), *columns], names=names)

    return map_arrow(segments, run, ALIGNED)


def linked(segments: DataFrame) -> DataFrame:
    """a, b, count of all pairs of ids that segments (links_a, links_b, n) link, as often as they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times = np.repeat(batch.column(2).to_numpy(), batch.column(0).value_lengths().to_numpy())
            key, at = np.unique(_key(batch.column(0), batch.column(1)), return_inverse=True)
            count = np.zeros(len(key), np.int64)
            np.add.at(count, at, times)
            yield pa.record_batch([pa.array((key >> 32).astype(np.int32)), pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(count)], names=["a", "b", "count"])

    parts = map_arrow(segments.select("links_a", "links_b", "n"), run, "a int, b int, count long")
    return parts.groupBy("a", "b").agg(F.sum("count").alias("count"))


def _key(a: pa.ListArray, b: pa.ListArray) -> np.ndarray:
    return a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy()


RATED = "segment string, part binary"


def rated(segments: DataFrame, pairs: DataFrame) -> DataFrame:
    """segment, part: what a document needs of each segment, its n_best, count_sum and groups, by the counts of pairs (a, b, count)."""
    best = pairs.groupBy("b").agg(F.max("count").alias("best"))
    marked = pairs.join(best, "b").select("a", "b", "count", (F.col("count") == F.col("best")).alias("is_best"))
    if pairs.count() > PAIRS_SENT:
        each = segments.select("sid", F.explode(F.arrays_zip("links_a", "links_b")).alias("x")).select("sid", F.col("x.links_a").alias("a"), F.col("x.links_b").alias("b"))
        each = each.groupBy("sid", "a", "b").agg(F.count("*").alias("times")).join(marked, ["a", "b"])
        sums = each.groupBy("sid").agg(F.sum(F.col("times") * F.col("is_best").cast("long")).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
        found = segments.join(sums, "sid", "left").select("segment", "groups", F.coalesce("n_best", F.lit(0)), F.coalesce("count_sum", F.lit(0)))

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.record_batch([batch.column(0), _parts(*batch.columns[1:])], names=["segment", "part"])

        return map_arrow(found, join, RATED)
    table = marked.toArrow()
    keys = table["a"].to_numpy().astype(np.int64) << 32 | table["b"].to_numpy()
    order = np.argsort(keys)
    sent = segments.sparkSession.sparkContext.broadcast((keys[order], table["count"].to_numpy()[order], table["is_best"].to_numpy(zero_copy_only=False)[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, is_best = sent.value
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            at = np.searchsorted(keys, _key(a, b))
            ends = np.cumsum(a.value_lengths().to_numpy())
            starts = np.concatenate([[0], ends[:-1]]).astype(int)
            sums = [np.concatenate([[0], np.cumsum(x[at] if len(at) else [])]).astype(np.int64) for x in (is_best, counts)]
            yield pa.record_batch([batch.column(0), _parts(batch.column(1), *(pa.array(x[ends] - x[starts]) for x in sums))], names=["segment", "part"])

    return map_arrow(segments.select("segment", "groups", "links_a", "links_b"), run, RATED)


def _parts(groups: pa.Array, n_best: pa.Array, count_sum: pa.Array) -> pa.Array:
    """Two numbers, each after a byte with its length, and the groups; nothing for a segment without tokens."""
    number = lambda x: (n := (x.bit_length() + 7) // 8).to_bytes(1, "little") + x.to_bytes(n, "little")
    rows = zip(groups.to_pylist(), n_best.to_pylist(), count_sum.to_pylist(), strict=True)
    return pa.array([number(b) + number(c) + g if g else b"" for g, b, c in rows], pa.binary())


def _opened(part: bytes) -> tuple[int, int, bytes]:
    """n_best, count_sum and groups of a part."""
    at = 1 + part[0]
    end = at + 1 + part[at]
    return int.from_bytes(part[1:at], "little"), int.from_bytes(part[at + 1 : end], "little"), part[end:]


def packed(seq: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, as high bytes are mostly alike, compressed."""
    return zstandard.compress(seq.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def sequences(column: pd.Series) -> list[np.ndarray | None]:
    return [None if s is None else np.ascontiguousarray(np.frombuffer(zstandard.decompress(s), np.uint8).reshape(4, -1).T).view("<u4").ravel() for s in column]


def lost(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """chunk, local, lost: how often segments occur in documents that hold a segment of bad (chunk, local)."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        without = right["local"].to_numpy()
        hit = [s for s in sequences(left["seq"]) if s is not None and np.isin(s, without).any()]
        local, n = np.unique(np.concatenate(hit), return_counts=True) if hit else ([], [])
        return pd.DataFrame({"chunk": np.full(len(local), right["chunk"].iloc[0] if len(right) else 0), "local": local, "lost": n}).astype({"chunk": "int64", "local": "int32", "lost": "int64"})

    touched = docs.join(bad.select("chunk").distinct(), "chunk", "left_semi")
    return touched.groupBy("chunk").cogroup(bad.groupBy("chunk")).applyInPandas(run, "chunk long, local int, lost long")


def compose(docs: DataFrame, parts: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """Documents of each chunk put together from the parts (chunk, local, part) of its segments; with_groups adds the groups as text."""
    schema = RESULT + ", groups string" * with_groups

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        pair = pair_of(path_a, path_b)
        numbers = np.zeros((len(right), 5), np.int64)  # n_a, n_b, n_groups, n_best, count_sum
        groups, ok = np.empty(len(right), object), np.zeros(len(right), bool)
        for k, part in zip(right["local"], right["part"], strict=True):
            if part:
                best, total, coded = _opened(part)
                text = groups[k] = pair.written(coded)
                n, both = text.count("|"), text.count(",")
                a = text.count(",", 0, text.index("|")) if n == 1 else sum(g.partition("|")[0].count(",") for g in text.split(";"))
                numbers[k], ok[k] = (a + n, both - a + n, n, best, total), True
        rows = []
        for doc_id, seq in zip(left["doc_id"], sequences(left["seq"]), strict=True):
            if seq is None or not ok[seq].all():
                rows.append((doc_id, 0, 0, 0, 0, 0, 0, "") + (None,) * with_groups)
                continue
            a, b, g, best, total = (int(x) for x in numbers[seq].sum(axis=0))
            text = ";".join(groups[seq])
            rows.append((doc_id, a, b, g, a + b - g, best, total, hashlib.sha256(text.encode()).hexdigest()) + (text,) * with_groups)
        return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]).astype({"doc_id": "Int64"})

    return docs.groupBy("chunk").cogroup(parts.groupBy("chunk")).applyInPandas(run, schema)


def align_corpus(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of docs (doc_id, text).

    Model A (byte-level BPE, tokenizer.json) reads a space and the text, model B
    (sentencepiece BPE) the text, before which it puts a space itself. Two
    tokens are linked if their bytes overlap; an id pair's count is how many
    links of the corpus hold it; n_best counts links whose count is the highest
    of their B id, and count_sum adds the counts of all links. Texts that are
    null, empty, or not what their tokens' bytes give have zeros and ''; they
    add to no count. Rows with null or equal ids, and repeated rows, are each
    read and counted; an empty table gives no rows; other columns aren't read. A
    long text is a chunk of its own, so memory is in proportion to the longest
    text and CHUNK_BYTES; a segment as long as its text is one row of the
    distinct segments.
    """
    chunks = materialise(chunked(docs, path_a, path_b), "chunks", "zstd")
    texts = chunks.where("has_tokens is not null").select("chunk", "doc_id", "seq")
    names = chunks.where("segment is not null").select(*(F.col(c).alias(c) for c in ("chunk", "local", "segment", "n")))
    distinct = names.groupBy("segment").agg(F.sum("n").alias("n"))
    known = materialise(aligned(distinct, path_a, path_b).withColumn("sid", F.monotonically_increasing_id()), "segments", "zstd")

    counted, less = known.where("ok"), None
    bad = known.where("not ok").select("segment")
    if bad.take(1):
        without = names.join(bad, "segment", "left_semi").select("chunk", "local")
        less = materialise(lost(texts, without).join(names, ["chunk", "local"]).groupBy("segment").agg(F.sum("lost").alias("lost")), "lost")
        counted = counted.join(less, "segment", "left").withColumn("n", F.col("n") - F.coalesce("lost", F.lit(0)))

    pairs = materialise(linked(counted), "pairs")
    parts = names.join(rated(known, pairs), "segment").drop("segment", "n")
    out = materialise(compose(texts, parts, path_a, path_b, with_groups), "alignments")
    for df in (chunks, known, pairs, *([less] if less is not None else [])):
        forget(df)
    return out


def segment_alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """segment, n, ok, groups (as text), links_a, links_b of the distinct segments of docs' texts, n being how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b)
        for batch in batches:
            text = pa.array([pair.written(x) for x in batch.column("groups").to_pylist()], pa.string())
            yield batch.set_column(batch.schema.get_field_index("groups"), "groups", text)

    names = chunked(docs, path_a, path_b).where("segment is not null")
    known = aligned(names.groupBy("segment").agg(F.sum("n").alias("n")), path_a, path_b)
    return map_arrow(known, run, ALIGNED.replace("groups binary", "groups string"))


__all__ = ["Pair", "align_corpus", "aligned", "chunked", "compose", "cuts", "pair_of", "segment_alignments"]
