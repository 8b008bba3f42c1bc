"""Quality rules by compression bands.

zstandard's ratio (compressed bytes by bytes) of the whole document and of its
fixed chunks must lie in a band: below it a text repeats itself, above it it is
noise. The bands depend on the length, as short texts compress less; the last
chunk, which may be shorter, has the band of its own length. A document's bad
chunks may hold a share of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from sequoir.llm.common import WORD_SPACE, keep_rows, map_arrow, utf8

#: (from so many bytes, least ratio, greatest ratio). Under 16 bytes the frame outweighs the text, and any ratio is in the band.
BANDS = (
    (1, 0.00, 16.0),
    (16, 0.80, 2.20),
    (32, 0.60, 1.50),
    (64, 0.40, 1.25),
    (128, 0.40, 1.00),
    (256, 0.36, 0.86),
    (512, 0.32, 0.80),
    (1024, 0.28, 0.74),
    (2048, 0.25, 0.68),
    (4096, 0.22, 0.66),
    (16384, 0.18, 0.64),
)
CHUNK_BYTES = 2048
#: Band of a whole chunk, and the share of a document's bytes in bad chunks that is still kept.
CHUNK_BAND = (0.22, 0.72)
BAD_SHARE = 0.3
LEVEL = 3
SYMBOLS = b"#*$%&|<>"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, zstd_ratio double, n_chunks long, n_bad_chunks long, reason string"
)


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in windows of `width` words found twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    code = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = code[:n].copy()
    for k in range(1, width):
        key *= np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
        key += code[k : k + n]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    seen: dict[tuple, int] = {}  # equal keys are only likely repeats; the words decide
    hits = np.zeros(n, bool)
    for i in np.sort(order[np.r_[False, same] | np.r_[same, False]]).tolist():
        first = seen.setdefault(tuple(words[i : i + width]), i)
        if first != i:
            hits[first] = hits[i] = True
    steps = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(hits)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + width, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def base_rules(text: bytes) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = text.split()
    bare = text.translate(None, WORD_SPACE)
    word_chars = len(bare.decode("utf-8", "surrogatepass"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeats = repeat_words(words)
    n = len(words)
    return n, word_chars, symbols, len(lines) - len(set(lines)), repeats, n < 10 or 100 * repeats > 20 * n


def band(n_bytes: int) -> tuple[float, float] | None:
    found = None
    for least, low, high in BANDS:
        if n_bytes >= least:
            found = (low, high)
    return found


def compression(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float | None, int, int, str | None]:
    """Ratio of the whole, number of chunks, those out of their band, and why it is rejected. An empty text has no ratio."""
    limits = band(len(text))
    if limits is None:
        return None, 0, 0, None
    ratio = len(packer.compress(text)) / len(text)
    chunks = bad = bad_bytes = 0
    for at in range(0, len(text), CHUNK_BYTES):
        part = text[at : at + CHUNK_BYTES]
        low, high = CHUNK_BAND if len(part) == CHUNK_BYTES else band(len(part))
        own = ratio if len(part) == len(text) else len(packer.compress(part)) / len(part)
        chunks += 1
        if not low <= own <= high:
            bad, bad_bytes = bad + 1, bad_bytes + len(part)
    reason = None
    if ratio < limits[0]:
        reason = "repetitive"
    elif ratio > limits[1]:
        reason = "incompressible"
    elif bad_bytes > BAD_SHARE * len(text):
        reason = "chunks"
    return ratio, chunks, bad, reason


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text), with base counts and the verdict.

    Null text counts as no text (no words, base_failed) and has no ratio. Every
    byte of a text is in a chunk that is judged. Repeated rows and ids stay as
    they are; other columns are not read. An empty table gives an empty result.
    A long text's words are a list while it is judged, about fifteen times the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rows = []
            for text in utf8(batch.column(1)):
                base = base_rules(text)
                ratio, chunks, bad, reason = compression(text, packer)
                why = "base" if base[-1] else reason
                rows.append((*base, why is None, ratio, chunks, bad, why))
            types = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
            cols = zip(*rows, strict=True) if rows else [[]] * len(types)
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names)

    return map_arrow(docs.select("doc_id", "text"), run, SCHEMA)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that quality_rules() keeps.

    Null and empty texts fail the base rules and go; repeated rows each stay or
    go; of an empty table nothing is left.
    """

    def verdicts(texts: list[bytes]) -> list[bool]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        return [not base_rules(x)[-1] and compression(x, packer)[-1] is None for x in texts]

    return keep_rows(docs, "text", verdicts)
