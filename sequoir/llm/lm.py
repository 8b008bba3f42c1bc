"""Language-model scores from a log-frequency Bloom filter.

The filter holds unigrams and bigrams of the training documents with their
counts in powers of two: one that was seen c times is entered with the marks 1
to 1 + floor(log2(c)), so that asking for mark after mark until one is missing
gives back its level, floor(log2(c)). N-grams fall into buckets by the first
bits of their hash; a bucket is counted and built by one task, holds no more
than a few MB, and is a filter of its own, sized by what it holds.

A filter within SENT_BYTES goes to the workers, which probe it. Beyond that the
probes go to the buckets: every part of documents sends its distinct hashes,
and gets their levels and counts back. Exact unigram counts, by 64-bit hash,
give the base score.

A bigram's count is taken at the least and its context's at the most that their
levels allow, so the probabilities of all tokens in a context add up to at most
one, but for false positives.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.llm.common import crc_mod, forget, map_arrow, materialise, utf8

FOLDS, HELD_OUT = 7, 2
#: Token of the end of a text; words are never empty.
END = b""
#: Hash of what stands before a text's first token.
START = np.uint64(0x5851F42D4C957F2D)
MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bits for each entered mark, and bits that a mark sets.
BITS_PER_MARK, PROBES = 12, 5
#: Bytes of text whose n-grams share a bucket, about.
BUCKET_BYTES = 4 << 20
#: Most bytes of filter and exact counts that are sent to the workers.
SENT_BYTES = 192 << 20
#: Weight of the unigram estimate in the bigram's (Dirichlet smoothing).
PRIOR = 4.0
#: Bytes of text that are encoded at once, so that a worker's arrays stay small.
SLICE_BYTES = 2 << 20
#: Distinct words that a task keeps, and bigrams that it gathers before it passes them on.
HELD_WORDS, HELD_BIGRAMS = 100_000, 1_000_000

SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z), then the end."""
    found = text.lower().split()
    found.append(END)
    return found


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def token_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def slices(texts: list[bytes], most: int) -> Iterator[slice]:
    """Texts in a row of `most` bytes together, or one longer text."""
    first = held = 0
    for k, text in enumerate(texts):
        if held and held + len(text) > most:
            yield slice(first, k)
            first, held = k, 0
        held += len(text)
    if first < len(texts):
        yield slice(first, len(texts))


class Vocabulary(dict):
    """Numbers of the tokens that a task has met, in order, with their hashes."""

    def __init__(self) -> None:
        super().__init__()
        self.words: list[bytes] = []
        self.hashes = np.zeros(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n

    def settle(self) -> None:
        """Hash the words that are new."""
        self.hashes = np.concatenate([self.hashes, token_hashes(self.words[len(self.hashes) :])])


def bigram_hashes(own: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each token's hash with the one before it; texts begin at starts."""
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[starts] = START
    return _scramble(before * MIX[0] + own)


class Encoded:
    """Texts as numbers: of each place its token and bigram."""

    def __init__(self, texts: list[bytes], vocabulary: Vocabulary | None = None) -> None:
        self.vocabulary = Vocabulary() if vocabulary is None else vocabulary
        get = self.vocabulary.__getitem__
        parts = [np.array(list(map(get, tokens(text))), np.int32) for text in texts]
        self.vocabulary.settle()
        self.sizes = np.array([len(x) for x in parts], np.int64)
        self.starts = np.r_[0, np.cumsum(self.sizes)[:-1]].astype(np.int64)[: len(parts)]
        self.ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def bigrams(self) -> np.ndarray:
        """Hash of each token with the one before it."""
        return bigram_hashes(self.vocabulary.hashes[self.ids], self.starts)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of the values of every text."""
        return np.add.reduceat(values, self.starts) if len(self.starts) else np.zeros(0, values.dtype)


#: Bytes of text whose counts, or probes, for a bucket are put together in one group before they meet those of all others.
SALT_BYTES = 64 << 30
COUNTED = "bucket long, gram int, h binary, c binary, salt int"


def _cut(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that sorted hashes fall into, and where each begins, with the end."""
    bucket = h >> np.uint64(64 - bits)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(h) else np.zeros(0, np.int64)
    return bucket[first].astype(np.int64), np.r_[first, len(h)]


def _blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """values, cut at ends, as binary values."""
    offsets = (ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def count_ngrams(train: DataFrame, bits: int, salts: int = 1) -> DataFrame:
    """Counts of the n-grams of train (text), as each task has met them: sorted hashes and counts by bucket, dealt into so many salts."""
    most, held_words, held_bigrams = SLICE_BYTES, HELD_WORDS, HELD_BIGRAMS

    def batch_of(gram: int, h: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        buckets, ends = _cut(h, bits)
        salt = int(h[len(h) // 2] % np.uint64(salts)) if len(h) else 0
        columns = [pa.array(buckets), pa.array(np.full(len(buckets), gram, np.int32)), _blobs(h, ends), _blobs(c.astype(np.uint32), ends), pa.array(np.full(len(buckets), salt, np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "gram", "h", "c", "salt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, counts, pairs, held = Vocabulary(), np.zeros(0, np.int64), [], 0

        def singles() -> pa.RecordBatch:
            order = np.argsort(vocabulary.hashes)
            return batch_of(1, vocabulary.hashes[order], counts[order])

        for batch in batches:
            texts = utf8(batch.column(0))
            for part in slices(texts, most):
                if len(vocabulary) > held_words:
                    yield singles()
                    vocabulary, counts = Vocabulary(), np.zeros(0, np.int64)
                own = Encoded(texts[part], vocabulary)
                more = np.bincount(own.ids, minlength=len(vocabulary))
                more[: len(counts)] += counts
                counts = more
                pairs.append(own.bigrams())
                held += len(own.ids)
                if held >= held_bigrams:
                    yield batch_of(2, *np.unique(np.concatenate(pairs), return_counts=True))
                    pairs, held = [], 0
        if held:
            yield batch_of(2, *np.unique(np.concatenate(pairs), return_counts=True))
        if len(vocabulary):
            yield singles()

    return map_arrow(train.select("text"), run, COUNTED)


def least_count(levels: np.ndarray) -> np.ndarray:
    """The least count of a level; 0 for none."""
    return np.where(levels >= 0, np.exp2(levels.astype(np.float64)), 0.0)


def most_count(levels: np.ndarray) -> np.ndarray:
    """The greatest count of a level; 0 for none."""
    return np.where(levels >= 0, np.exp2(levels + 1.0) - 1, 0.0)


def _halves(h: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray]:
    a = _scramble(h + np.array([mark], np.uint64) * MIX[0])
    return a & np.uint64(0xFFFFFFFF), (a >> np.uint64(32)) | np.uint64(1)


def _bit(low: np.ndarray, high: np.ndarray, k: int, size: np.ndarray | int) -> np.ndarray:
    """The k-th of a bucket's bits that a mark sets; size: the bucket's bits, under 2**32."""
    return ((((low + np.uint64(k) * high) & np.uint64(0xFFFFFFFF)) * np.asarray(size, np.uint64)) >> np.uint64(32)).astype(np.int64)


def bucket_bits(h: np.ndarray, c: np.ndarray, bits_per_mark: int) -> bytes:
    """The filter of a bucket that holds n-grams h with their counts c."""
    marks = np.frexp(c.astype(np.float64))[1]  # 1 + floor(log2(c))
    size = max(64, -(-int(marks.sum()) * bits_per_mark // 64) * 64)
    bits = np.zeros(size, bool)
    for mark in range(1, int(marks.max(initial=0)) + 1):
        low, high = _halves(h[marks >= mark], mark)
        for k in range(PROBES):
            bits[_bit(low, high, k, size)] = True
    return np.packbits(bits, bitorder="little").tobytes()


BUILT = "bucket long, distinct long, total long, texts long, bits binary, h binary, c binary"


def summed(group: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of order n in rows of COUNTED, with the sums of their counts."""
    at = np.flatnonzero(group.column("gram").to_numpy() == n).tolist()
    h, c = ([column[i] for i in at] for column in (group.column("h").to_pylist(), group.column("c").to_pylist()))
    found, back = np.unique(np.frombuffer(b"".join(h), np.uint64), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    counts = [np.frombuffer(y, f"<u{len(y) * 8 // len(x)}").astype(np.int64) for x, y in zip(h, c, strict=True) if x]
    np.add.at(total, back, np.concatenate(counts) if counts else total[:0])
    return found, total


def merged(counted: DataFrame) -> DataFrame:
    """counted with one row for each bucket, salt and order."""

    def run(group: pa.Table) -> pa.Table:
        bucket, salt = (group.column(x)[0].as_py() for x in ("bucket", "salt"))
        rows = [(n, *(x.tobytes() for x in summed(group, n))) for n in (1, 2)]
        columns = [pa.array([bucket] * 2), pa.array([n for n, _, _ in rows], pa.int32()), pa.array([h for _, h, _ in rows], pa.binary()), pa.array([c for _, _, c in rows], pa.binary()), pa.array([salt] * 2, pa.int32())]
        return pa.table(columns, names=["bucket", "gram", "h", "c", "salt"])

    return counted.groupBy("bucket", "salt").applyInArrow(run, COUNTED)


def build_filter(counted: DataFrame, salts: int = 1) -> DataFrame:
    """A row for each bucket of counted: its filter, and its unigrams with their exact counts.

    distinct, total: unigrams and their occurrences; texts: those of the end.
    A frequent n-gram's bucket has a row from nearly every slice of the corpus:
    rows are merged by bucket and salt first, so that no group grows with it.
    """
    end, bits_per_mark = token_hashes([END])[0], BITS_PER_MARK

    def build(group: pa.Table) -> pa.Table:
        (one, ones), (two, twos) = summed(group, 1), summed(group, 2)
        row = [group.column("bucket")[0].as_py(), len(one), int(ones.sum()), int(ones[one == end].sum()), bucket_bits(np.r_[one, two], np.r_[ones, twos], bits_per_mark), one.tobytes(), ones.tobytes()]
        kinds = [pa.int64()] * 4 + [pa.binary()] * 3
        return pa.table({x.split()[0]: pa.array([v], k) for x, v, k in zip(BUILT.split(", "), row, kinds, strict=True)})

    return (merged(counted) if salts > 1 else counted).groupBy("bucket").applyInArrow(build, BUILT)


class LogFrequencyFilter:
    """The filters of buckets (ascending) of 2**bits: where each begins in `data`, in bytes, and all their bits, packed."""

    def __init__(self, bits: int, buckets: np.ndarray, starts: np.ndarray, data: np.ndarray) -> None:
        self.bits, self.buckets, self.starts, self.data = bits, buckets, starts, data

    def levels(self, h: np.ndarray) -> np.ndarray:
        """Levels of n-grams, -1 for what was never seen: marks are asked for until one is missing."""
        found = np.full(len(h), -1, np.int8)
        if not len(self.buckets):
            return found
        bucket = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        own = np.minimum(np.searchsorted(self.buckets, bucket), len(self.buckets) - 1)
        active = np.flatnonzero(self.buckets[own] == bucket)
        base = self.starts[own[active]] * 8
        size = self.starts[own[active] + 1] * 8 - base
        mark = 1
        while len(active):
            low, high = _halves(h[active], mark)
            for k in range(PROBES):  # the first bit that is missing ends it
                at = base + _bit(low, high, k, size)
                kept = np.flatnonzero((self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
                active, base, size, low, high = active[kept], base[kept], size[kept], low[kept], high[kept]
            found[active] = mark - 1
            mark += 1
        return found


class Counts:
    """Exact counts of unigrams by hash, sorted."""

    def __init__(self, h: np.ndarray, c: np.ndarray) -> None:
        self.h, self.c = h, c

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.h):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, self.c[at], 0).astype(np.int64)


def gathered(built: DataFrame, bits: int, n: int, filter_bytes: int, distinct: int) -> tuple[LogFrequencyFilter, Counts]:
    """The n rows of built, bucket by bucket, as one filter and one table of counts, of sizes that are known."""
    data, buckets, sizes = np.zeros(filter_bytes, np.uint8), np.zeros(n, np.int64), np.zeros(n, np.int64)
    at, one, ones, most, got = 0, np.zeros(distinct, np.uint64), np.zeros(distinct, np.int64), 0, 0
    rows = built.select("bucket", "bits", "h", "c").orderBy("bucket").toLocalIterator()
    for k, row in enumerate(rows):
        data[at : at + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
        own = len(row.h) // 8
        one[got : got + own], ones[got : got + own] = np.frombuffer(row.h, np.uint64), np.frombuffer(row.c, np.int64)
        buckets[k], sizes[k] = row.bucket, len(row.bits)
        at, got, most = at + len(row.bits), got + own, max(most, int(ones[got : got + own].max(initial=0)))
    return LogFrequencyFilter(bits, buckets, np.r_[0, np.cumsum(sizes)], data), Counts(one, ones.astype(np.uint32) if most < 1 << 32 else ones)


class Totals(NamedTuple):
    """Of the training documents: tokens, distinct tokens, texts."""

    tokens: int
    distinct: int
    texts: int

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1.0) / (self.tokens + self.distinct + 1))


def log_probability(own: np.ndarray, pair: np.ndarray, starts: np.ndarray, totals: Totals) -> np.ndarray:
    """log10 of the smoothed probability of every place's token after the one before it, from levels of tokens and bigrams."""
    before = np.empty(len(own))
    before[1:] = most_count(own[:-1])
    before[starts] = totals.texts
    alone = (least_count(own) + 1) / (totals.tokens + totals.distinct + 1)
    seen = least_count(pair)
    return np.log10((seen + PRIOR * alone) / (np.maximum(before, seen) + PRIOR))


class Measured:
    """A vocabulary with what the model knows of each token: level, base score, and whether it is known."""

    def __init__(self, part: LogFrequencyFilter, counts: Counts, totals: Totals, held_words: int = HELD_WORDS) -> None:
        self.part, self.counts, self.totals, self.held_words = part, counts, totals, held_words
        self.restart()

    def restart(self) -> None:
        self.vocabulary = Vocabulary()
        self.level, self.base, self.known = np.zeros(0, np.int8), np.zeros(0), np.zeros(0, np.int64)

    def scores(self, texts: list[bytes]) -> list[np.ndarray]:
        """n_tokens, n_known, base_score, score of each text."""
        if len(self.vocabulary) > self.held_words:
            self.restart()
        own = Encoded(texts, self.vocabulary)
        h = self.vocabulary.hashes[len(self.base) :]
        count = self.counts.of(h)
        self.base = np.concatenate([self.base, self.totals.base(count)])
        self.known = np.concatenate([self.known, (count > 0).astype(np.int64)])
        self.level = np.concatenate([self.level, self.part.levels(h)])
        pairs, back = np.unique(own.bigrams(), return_inverse=True)
        score = log_probability(self.level[own.ids], self.part.levels(pairs)[back], own.starts, self.totals)
        return [own.sizes, own.sums(self.known[own.ids]), own.sums(self.base[own.ids]), own.sums(score)]


def _scored_rows(doc_id: pa.Array, held_out: pa.Array, values: list[np.ndarray], totals: Totals) -> pa.RecordBatch:
    sizes, known, base, score = values
    columns = [doc_id.cast(pa.int64()), held_out, pa.array(sizes), pa.array(known), pa.array(np.full(len(sizes), totals.tokens, np.int64)), pa.array(base), pa.array(score)]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SCORED.split(", ")])


def score(docs: DataFrame, sent_bytes: int = SENT_BYTES) -> DataFrame:
    """Scores of every row of docs (doc_id, text) under a model of the rows outside the held-out fold.

    base_score: sum of log10((c + 1) / (N + V + 1)) over the tokens, c their
    exact counts, N all and V distinct training tokens; two tokens of one
    64-bit hash would count as one. score: log10 of the smoothed bigram
    probability. Null text is the end alone. Repeated rows stay and count as
    often as they occur. Without training rows N and V are 0. Other columns
    aren't read; an empty table gives an empty result. A text longer than
    SLICE_BYTES is a slice of its own, about fifteen times its size in memory.
    """
    spark = docs.sparkSession
    fold = crc_mod("doc_id", FOLDS)
    train = docs.where(fold != HELD_OUT).select("text")
    size = train.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    bits = max(1, (size // BUCKET_BYTES).bit_length())
    salts = -(-size // SALT_BYTES) or 1
    built = materialise(build_filter(count_ngrams(train, bits, salts), salts), "filter")
    found = built.agg(F.sum("total"), F.sum("distinct"), F.sum("texts"), F.count("*"), F.sum(F.length("bits"))).first()
    totals, n, filter_bytes = Totals(*(int(x or 0) for x in found[:3])), found[3], int(found[4] or 0)
    marked = docs.select("doc_id", "text", (fold == HELD_OUT).alias("held_out"))
    if filter_bytes + 12 * totals.distinct > sent_bytes:
        return _asked(marked, built, bits, totals, salts)
    sent = spark.sparkContext.broadcast(gathered(built, bits, n, filter_bytes, totals.distinct))
    forget(built)
    most, held_words = SLICE_BYTES, HELD_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Measured(*sent.value, totals, held_words)
        for batch in batches:
            texts = utf8(batch.column(1))
            parts = [model.scores(texts[s]) for s in slices(texts, most)]
            if parts:
                yield _scored_rows(batch.column(0), batch.column(2), [np.concatenate(x) for x in zip(*parts, strict=True)], totals)

    return map_arrow(marked, run, SCORED)


#: Bytes of text that ask the buckets together: each of these parts makes a row for every bucket.
ASKED_BYTES = 8 << 20
ASKED = "slice string, bucket long, one binary, two binary, body binary"
ANSWERED = "slice string, bucket long, one binary, known binary, two binary, body binary"
ASKED_NAMES, ANSWERED_NAMES = ([x.split()[0] for x in schema.split(", ")] for schema in (ASKED, ANSWERED))


def _body(doc_id: pa.Array, held_out: pa.Array, own: Encoded) -> tuple[bytes, np.ndarray]:
    """What finish() needs of a part besides the answers, compressed, and the sorted hashes of its tokens."""
    one, at = np.unique(own.vocabulary.hashes, return_inverse=True)
    whole = pickle.dumps((doc_id.to_pylist(), held_out.to_pylist(), own.sizes, one, at[own.ids].astype(np.int32)))
    return len(whole).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True), one


def _opened(body: bytes) -> tuple:
    return pickle.loads(pa.decompress(body[8:], decompressed_size=int.from_bytes(body[:8], "little"), codec="zstd", asbytes=True))


def _flat(column: pa.ChunkedArray, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column, one after another, and where each row's end."""
    found = column.to_pylist()
    return np.frombuffer(b"".join(found), dtype), np.r_[0, np.cumsum([len(x) for x in found])].astype(np.int64) // np.dtype(dtype).itemsize


def _asked(marked: DataFrame, built: DataFrame, bits: int, totals: Totals, salts: int = 1) -> DataFrame:
    """score() by sending the distinct hashes of every part of documents to the buckets, and what these know back.

    Hashes are sorted, so the answers of a part, joined in the order of
    buckets, are in the order of its hashes. A bucket looks all its probes up at
    once. A part's body (rows, and places as numbers) goes along under a bucket
    of its own below zero, so that texts are gone through once and nothing is
    written. Names are those of a part's place in its partition, which a
    repeated task gives again. With several salts, the parts of a salt ask a
    bucket together, each hash once, so that the bucket of a frequent n-gram
    isn't asked by every part.
    """
    most = ASKED_BYTES

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, parts = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = utf8(batch.column(1))
            for part in slices(texts, most):
                name, own = f"{partition}-{parts}", Encoded(texts[part])
                parts += 1
                doc_id, held_out = (batch.column(k).slice(part.start, part.stop - part.start) for k in (0, 2))
                body, one = _body(doc_id, held_out, own)
                two = np.unique(own.bigrams())
                buckets = np.unique(np.concatenate([_cut(one, bits)[0], _cut(two, bits)[0]]))
                ends = [np.searchsorted((h >> np.uint64(64 - bits)).astype(np.int64), np.r_[buckets, 1 << bits]) for h in (one, two)]
                k = len(buckets)
                yield pa.RecordBatch.from_arrays([pa.array([name] * k), pa.array(buckets), _blobs(one, ends[0]), _blobs(two, ends[1]), pa.nulls(k, pa.binary())], ASKED_NAMES)
                below = -1 - (xxhash.xxh64_intdigest(name) >> 1)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([below]), *(pa.nulls(1, pa.binary()) for _ in range(2)), pa.array([body], pa.binary())], ASKED_NAMES)

    def answer(asked: pa.Table, own: pa.Table) -> pa.Table:
        n = asked.num_rows
        none = pa.nulls(n, pa.binary())
        if n and asked.column("bucket")[0].as_py() < 0:
            return pa.table([asked.column("slice"), asked.column("bucket"), none, none, none, asked.column("body")], names=ANSWERED_NAMES)
        part, counts = LogFrequencyFilter(bits, *[np.zeros(0, np.int64)] * 2, np.zeros(0, np.uint8)), Counts(np.zeros(0, np.uint64), np.zeros(0, np.int64))
        if own.num_rows:
            row = own.to_pylist()[0]
            part = LogFrequencyFilter(bits, np.array([row["bucket"]]), np.array([0, len(row["bits"])]), np.frombuffer(row["bits"], np.uint8))
            counts = Counts(np.frombuffer(row["h"], np.uint64), np.frombuffer(row["c"], np.int64))
        (one, one_ends), (two, two_ends) = (_flat(asked.column(x), np.uint64) for x in ("one", "two"))
        (one, one_back), (two, two_back) = (np.unique(h, return_inverse=True) for h in (one, two))
        known = [_blobs(x, e) for x, e in ((part.levels(one)[one_back], one_ends), (counts.of(one)[one_back], one_ends), (part.levels(two)[two_back], two_ends))]
        return pa.table([asked.column("slice"), asked.column("bucket"), *known, none], names=ANSWERED_NAMES)

    def finish(group: pa.Table) -> pa.Table:
        group = group.sort_by("bucket")
        ids, held, sizes, one, at = _opened(group.column("body")[0].as_py())
        answers = group.slice(1)
        own, count, pair = (_flat(answers.column(x), t)[0] for x, t in (("one", np.int8), ("known", np.int64), ("two", np.int8)))
        starts = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)
        back = np.unique(bigram_hashes(one[at], starts), return_inverse=True)[1]
        sums = [np.add.reduceat(x, starts) for x in ((count > 0).astype(np.int64)[at], totals.base(count)[at], log_probability(own[at], pair[back], starts, totals))]
        return pa.Table.from_batches([_scored_rows(pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), [sizes, *sums], totals)])

    asked = map_arrow(marked, ask, ASKED)

    def together(group: pa.Table) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
        """The distinct hashes of both orders in a group of probes, and those of its rows with their ends."""
        rows = [_flat(group.column(x), np.uint64) for x in ("one", "two")]
        return [np.unique(h) for h, _ in rows], rows

    def join_probes(group: pa.Table) -> pa.Table:
        bucket, salt = (group.column(x)[0].as_py() for x in ("bucket", "salt"))
        (one, two), _ = together(group)
        return pa.table([pa.array([str(salt)]), pa.array([bucket]), *(pa.array([h.tobytes()], pa.binary()) for h in (one, two)), pa.nulls(1, pa.binary())], names=ASKED_NAMES)

    def hand_out(group: pa.Table, answered: pa.Table) -> pa.Table:
        (one, two), ((ones, one_ends), (twos, two_ends)) = together(group)
        at, to = np.searchsorted(one, ones), np.searchsorted(two, twos)
        own, count, pair = (_flat(answered.column(x), t)[0] for x, t in (("one", np.int8), ("known", np.int64), ("two", np.int8)))
        known = [_blobs(x, e) for x, e in ((own[at], one_ends), (count[at], one_ends), (pair[to], two_ends))]
        return pa.table([group.column("slice"), group.column("bucket"), *known, pa.nulls(group.num_rows, pa.binary())], names=ANSWERED_NAMES)

    if salts > 1:
        asked = materialise(asked, "asked")
        salted = asked.where("bucket >= 0").withColumn("salt", F.pmod(F.xxhash64("slice"), F.lit(salts)).cast("int"))
        few = salted.groupBy("bucket", "salt").applyInArrow(join_probes, ASKED)
        known = few.groupBy("bucket").cogroup(built.groupBy("bucket")).applyInArrow(answer, ANSWERED)
        known = known.withColumn("salt", F.col("slice").cast("int"))
        answers = salted.groupBy("bucket", "salt").cogroup(known.groupBy("bucket", "salt")).applyInArrow(hand_out, ANSWERED)
        bodies = asked.where("bucket < 0").select("slice", "bucket", *(F.lit(None).cast("binary").alias(x) for x in ("one", "known", "two")), "body")
        answers = answers.unionByName(bodies)
    else:
        answers = asked.groupBy("bucket").cogroup(built.groupBy("bucket")).applyInArrow(answer, ANSWERED)
    return answers.groupBy("slice").applyInArrow(finish, SCORED)
