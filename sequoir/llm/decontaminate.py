"""Benchmark decontamination by SimHash of item-sized windows.

Of every benchmark item and of every window of a document that has as many
words, the five-word shingles make a SimHash. Fingerprints are cut into four
blocks of 16 bits: within radius 19, some block differs in four bits at most.
Items are entered under their blocks' values and those one flip away, a window
asks under its values and those up to three flips away, so it finds every item
within the radius. Those are the candidates, and are verified by the exact
weighted similarity: shingles weigh as often as they occur, and what both have
is divided by what either has.

Similarity 0.8 makes about 10 differing bits and more than 19 in one of 1,000
cases; an unrelated item shares a block with one window in seven. Windows in
which too few shingles occur in any item for that similarity, which is bounded
over whole documents first and loses nothing, aren't fingerprinted.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.llm.common import keep_rows, map_arrow, utf8

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BITS = 64
#: Most differing bits of a candidate.
RADIUS = 19
BLOCKS = 4
BLOCK_BITS = BITS // BLOCKS
#: Bits that are flipped in an item's block; the window flips the others.
ITEM_FLIPS = 1
#: Words and items of the benchmark that go to the workers at once (an item has 68 entries of 4 bytes); a larger benchmark takes several passes.
WORDS_AT_ONCE, ITEMS_AT_ONCE = 2_000_000, 100_000
SEED = 42
#: Windows that are fingerprinted at once begin within so many words.
SPAN = 4_096


def shingles(words: list[bytes], width: int = SHINGLE_WORDS) -> list[bytes]:
    """Shingles of a text in order; of fewer words the whole."""
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]


def simhash(counts: Counter) -> int:
    """64-bit SimHash of shingles with weights; a bit needs over half the weight."""
    hashes = np.array([xxhash.xxh64_intdigest(x, SEED) for x in counts], np.uint64)
    weights = np.fromiter(counts.values(), np.int64, len(counts))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * (weights @ bits.astype(np.int64)) > weights.sum(), bitorder="little").view(np.uint64)[0])


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets of shingles."""
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    either = sum(a.values()) + sum(b.values()) - both
    return both / either if either else 0.0


def flips(n: int) -> np.ndarray:
    """All values of a block with n bits set at most."""
    return np.array([sum(1 << b for b in c) for k in range(n + 1) for c in combinations(range(BLOCK_BITS), k)], np.int64)


class Items:
    """Benchmark items, indexed for windows of documents."""

    def __init__(self, rows: list[tuple[int | None, bytes]], least: float = SIMILARITY, radius: int = RADIUS) -> None:
        self.least, self.radius = least, radius
        self.ids, self.counts, self.words = [], [], []
        for item_id, text in rows:
            words = text.lower().split()
            if words:
                self.ids.append(item_id)
                self.words.append(len(words))
                self.counts.append(Counter(shingles(words)))
        self.marks = np.array([simhash(c) for c in self.counts], np.uint64)
        vocabulary = sorted({w for c in self.counts for x in c for w in x.split(b" ")})
        self.place = {w: i for i, w in enumerate(vocabulary)}
        self.sizes = [sum(c.values()) for c in self.counts]
        holders: dict[int, list[int]] = defaultdict(list)
        for i, (n, c) in enumerate(zip(self.words, self.counts, strict=True)):
            for key in {int(self._keys(np.array([self.place[w] for w in x.split(b" ")]))[0]) for x in c} if n >= SHINGLE_WORDS else ():
                holders[key].append(i)
        self.keys = np.array(sorted(holders), np.uint64)
        self.holders = [holders[k] for k in self.keys.tolist()]
        self.short = sorted({n for n in self.words if n < SHINGLE_WORDS})
        most = radius // BLOCKS
        own = flips(min(ITEM_FLIPS, most))
        self.asked = flips(most - min(ITEM_FLIPS, most))
        entries = np.concatenate([(values[:, None] ^ own) + (k << BLOCK_BITS) for k, values in enumerate(self._values(self.marks))]).ravel()
        order = np.argsort(entries, kind="stable")
        self.entered = (order // len(own) % max(1, len(self.marks))).astype(np.int32)
        self.begins = np.searchsorted(entries[order], np.arange((BLOCKS << BLOCK_BITS) + 1)).astype(np.int32)

    @staticmethod
    def _values(marks: np.ndarray) -> list[np.ndarray]:
        """The blocks' values of fingerprints."""
        return [((marks >> np.uint64(k * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64) for k in range(BLOCKS)]

    @staticmethod
    def _keys(places: np.ndarray) -> np.ndarray:
        """One number for every five places in a row. Unlike rows may share one: it only says which windows to look at."""
        n = len(places) - SHINGLE_WORDS + 1
        key = np.zeros(n, np.uint64)
        for k in range(SHINGLE_WORDS):
            key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ (places[k : k + n].astype(np.uint64) + np.uint64(1))
        return key

    def within(self, mark: int) -> list[int]:
        """Every item whose fingerprint lies within the radius, by the blocks' index."""
        values = self._values(np.array([mark], np.uint64))
        keys = np.concatenate([(v ^ self.asked) + (k << BLOCK_BITS) for k, v in enumerate(values)])
        begin, end = self.begins[keys], self.begins[keys + 1]
        some = np.flatnonzero(end > begin).tolist()
        if not some:
            return []
        found = np.unique(np.concatenate([self.entered[begin[j] : end[j]] for j in some]))
        return found[np.bitwise_count(self.marks[found] ^ np.uint64(mark)) <= self.radius].tolist()

    def hits(self, text: bytes) -> list[tuple[int | None, int, int, float]]:
        """item_id, first word, words, similarity of the best window of every item that is in the text."""
        words = text.lower().split()
        best: dict[int, tuple[float, int]] = {}
        n = len(words) - SHINGLE_WORDS + 1
        if n > 0 and len(self.keys):
            places = np.array(list(map(self.place.get, words, repeat(-1))))
            inside = places >= 0
            whole = inside[:n].copy()
            for k in range(1, SHINGLE_WORDS):
                whole &= inside[k : k + n]
            at = np.flatnonzero(whole)
            if len(at):
                keys = self._keys(places)[at]
                rank = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                same = self.keys[rank] == keys
                spots: dict[int, list[int]] = defaultdict(list)  # of each item, where its shingles are
                for spot, key in zip(at[same].tolist(), rank[same].tolist(), strict=True):
                    for i in self.holders[key]:
                        spots[i].append(spot)
                todo: set[tuple[int, int]] = set()
                for i, own in spots.items():
                    size = min(self.sizes[i], n)  # a document shorter than the item is one window
                    need = math.ceil((self.sizes[i] + size) * self.least / (1 + self.least) - 1e-9)
                    if len(own) >= need:
                        for first, last in zip(own, own[need - 1 :], strict=False):  # so many spots in a row must lie in the window
                            if last - first < size:
                                todo.update((start, size) for start in range(max(0, last - size + 1), min(first, n - size) + 1))
                by_size: dict[int, list[int]] = defaultdict(list)
                for start, size in sorted(todo):
                    by_size[size].append(start)
                for size, starts in by_size.items():
                    for start, mark in window_marks(words, starts, size):
                        self._window(words, start, size + SHINGLE_WORDS - 1, mark, best)
        for m in self.short:  # items of fewer words are one shingle each
            for start in range(len(words) - m + 1):
                if words[start] in self.place:
                    self._window(words, start, m, simhash(Counter(shingles(words[start : start + m]))), best)
        return [(self.ids[i], start, min(self.words[i], len(words)), score) for i, (score, start) in sorted(best.items())]

    def _window(self, words: list[bytes], start: int, length: int, mark: int, best: dict[int, tuple[float, int]]) -> None:
        found = [i for i in self.within(mark) if min(self.words[i], len(words)) == length]
        if found:
            counts = Counter(shingles(words[start : start + length]))
            for i in found:
                score = similarity(counts, self.counts[i])
                if score >= self.least - 1e-12 and score > best.get(i, (0.0, 0))[0]:
                    best[i] = score, start


def window_marks(words: list[bytes], starts: list[int], size: int) -> Iterator[tuple[int, int]]:
    """(start, SimHash) of windows of `size` shingles at ascending starts; each shingle between them is hashed once.

    A window's bits are counted as differences of running sums, some thousand shingles at a time.
    """
    at = 0
    while at < len(starts):
        end = at + 1
        while end < len(starts) and starts[end] - starts[at] < SPAN and starts[end] - starts[end - 1] <= size:
            end += 1
        first = starts[at]
        own = shingles(words[first : starts[end - 1] + size + SHINGLE_WORDS - 1])
        bits = np.unpackbits(np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in own), np.uint64, len(own)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total = np.zeros((len(own) + 1, BITS), np.int32)
        np.cumsum(bits, axis=0, dtype=np.int32, out=total[1:])
        places = np.array(starts[at:end]) - first
        marks = np.packbits(2 * (total[places + size] - total[places]) > size, axis=1, bitorder="little").view(np.uint64).ravel()
        yield from zip(starts[at:end], marks.tolist(), strict=True)
        at = end


def item_blocks(benchmark: DataFrame, at_once: int = WORDS_AT_ONCE, items: int = ITEMS_AT_ONCE) -> Iterator[Items]:
    """The benchmark (item_id, text) as indexes of bounded size, one after another. Null texts are no items."""
    rows = benchmark.select("item_id", "text").where("text is not null").distinct()
    sized = rows.withColumn("n", F.size(F.split("text", r"[\x20\x09-\x0D]+")))
    total, count = sized.agg(F.sum("n"), F.count("*")).first()
    parts = max(1, -(-(total or 0) // at_once), -(-count // items))
    for k in range(parts):
        part = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        yield Items(sorted(((r.item_id, r.text.encode()) for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1])))


FOUND = "doc_id long, item_id long, start_word long, n_words long, similarity double"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for every row of docs (doc_id, text) and item of benchmark (item_id, text) that it holds a passage of.

    start_word, n_words: the window most like the item, the first of equal
    ones. Null and empty texts hold nothing. Repeated rows of docs give
    repeated rows; an item listed twice counts once; items of the same text
    count each. Other columns aren't read; empty tables give an empty result. A
    long text's words are a list while it is searched, about fifteen times the
    text; overlapping windows are fingerprinted from running sums.
    """
    spark = docs.sparkSession
    found = None
    for items in item_blocks(benchmark):
        sent = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                rows = [(doc_id, *hit) for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True) for hit in own.hits(text)]
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.float64()], strict=True)], ["doc_id", "item_id", "start_word", "n_words", "similarity"])

        part = map_arrow(docs.select("doc_id", "text"), run, FOUND)
        found = part if found is None else found.unionByName(part)
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that hold no passage of the benchmark.

    Null and empty texts hold none and stay; repeated rows each stay or go; an
    empty benchmark leaves all rows, and of an empty table nothing is left.
    """
    for items in item_blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)
        docs = keep_rows(docs, "text", lambda texts, sent=sent: [not sent.value.hits(x) for x in texts])
    return docs
