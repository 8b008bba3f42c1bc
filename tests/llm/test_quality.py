import re
from collections import Counter

import pytest

from sequoir.llm.quality import BANDS, base_rules, compression, keep_good, quality_rules
from tests.llm.cases import frame, prose, rows, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), n < 10 or 100 * len(hit) > 20 * n


def test_base_rules_against_slow_version():
    more = ["a b c d e a b c d e", "a b c d e f " * 3, "a a a a a a", "x\n\n x\nx\n x", "#a <b>|", prose(500, 9) + " " + prose(40, 9)]
    for text in texts() + more:
        assert base_rules((text or "").encode()) == slow_base(text)


def test_every_row_and_the_table(spark):
    found = quality_rules(frame(spark)).collect()
    assert len(found) == len(rows())
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    for doc_id, text, *_ in rows():
        if doc_id is not None:
            assert tuple(by[doc_id])[1:7] == slow_base(text)
    assert by[0].base_failed and not by[0].kept and by[0].zstd_ratio is None
    assert by[8].kept and by[10].kept
    assert not by[9].kept and not by[13].kept
    assert quality_rules(frame(spark, [])).count() == 0


def test_bands():
    import os

    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    assert compression(prose(400, 5).encode(), packer)[-1] is None
    assert compression(b"word " * 2000, packer)[-1] == "repetitive"
    assert compression(os.urandom(5000), packer)[-1] == "incompressible"
    half = prose(3000, 6).encode()[:16000] + b"ab " * 4000
    assert compression(half, packer)[-1] == "chunks"
    assert compression(b"x" * (BANDS[0][0] - 1), packer) == (None, 0, 0, None)


def test_keep_good_keeps_columns(spark):
    docs = frame(spark)
    good = keep_good(docs)
    assert good.schema == docs.schema
    want = sorted(r.doc_id for r in quality_rules(docs).where("kept and doc_id is not null").collect())
    assert sorted(r.doc_id for r in good.where("doc_id is not null").collect()) == want
    assert keep_good(frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", [1, 4, 5, 9, 10])
def test_few_words(n):
    assert base_rules(" ".join(f"w{i}" for i in range(n)).encode())[-1] == (n < 10)


#: What the module states, written down once more.
LIMITS = {1: (0, 16), 16: (0.8, 2.2), 32: (0.6, 1.5), 64: (0.4, 1.25), 128: (0.4, 1), 256: (0.36, 0.86), 512: (0.32, 0.8), 1024: (0.28, 0.74), 2048: (0.25, 0.68), 4096: (0.22, 0.66), 16384: (0.18, 0.64)}


def slow_verdict(text):
    """Whether the bands reject a text: every byte of it counts."""
    import zstandard

    data = text.encode()
    if not data:
        return None
    ratio = lambda x: len(zstandard.ZstdCompressor(level=3).compress(x)) / len(x)
    of = lambda n: LIMITS[max(k for k in LIMITS if k <= n)]
    low, high = of(len(data))
    if not low <= ratio(data) <= high:
        return "repetitive" if ratio(data) < low else "incompressible"
    bad = 0
    for at in range(0, len(data), 2048):
        part = data[at : at + 2048]
        low, high = (0.22, 0.72) if len(part) == 2048 else of(len(part))
        bad += 0 if low <= ratio(part) <= high else len(part)
    return "chunks" if bad > 0.3 * len(data) else None


def test_verdicts_against_a_slow_version(spark, small):
    from sequoir.llm.quality import quality_rules

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    docs += [(10**6 + k, "x" * n) for k, n in enumerate((1, 15, 16, 31, 40, 63, 64, 100, 127, 128, 300))]
    docs += [(2 * 10**6 + k, prose(n, k)) for k, n in enumerate((10, 12, 20, 300, 370, 371, 372, 380, 700))]
    noisy = "".join(chr(33 + (k * k * 7919 + k // 3) % 90) for k in range(3000))
    docs += [(3 * 10**6, prose(330, 4) + " " + noisy[:1900]), (3 * 10**6 + 1, prose(3000, 4) + " " + noisy[:1000]), (3 * 10**6 + 2, prose(12, 3) + " ab" * 15)]
    found = {r.doc_id: r for r in quality_rules(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for doc_id, text in docs:
        why = "base" if slow_base(text)[-1] else slow_verdict(text or "")
        assert (found[doc_id].reason, found[doc_id].kept) == (why, why is None)


def test_no_byte_escapes():
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    import random

    clean = prose(1200, 9).encode()[:4096]
    noise = bytes(random.Random(1).choices(range(33, 127), k=2000))
    assert compression(clean, packer)[-1] is None
    assert compression(clean + noise, packer)[1:] == (3, 1, "chunks")  # only the last, short chunk is bad
    assert compression(b"a" * 40, packer)[-1] == "repetitive"
