import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sequoir.llm import lm
from tests.llm.cases import frame, prose, rows


def data():
    return rows() + [(100 + k, prose(40 + k, k % 9), "en", "s", 0, None, None, None, None) for k in range(60)]


def held(k):
    return zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2


def counts(docs):
    """Of the training rows: N, V, texts, unigrams, bigrams."""
    train = [lm.tokens((t or "").encode()) for k, t, *_ in docs if not held(k)]
    one, two = Counter(x for w in train for x in w), Counter(p for w in train for p in zip([None, *w[:-1]], w, strict=True))
    return sum(one.values()), len(one), len(train), one, two


def least(c):
    return 2 ** math.floor(math.log2(c)) if c else 0


def most(c):
    return 2 * least(c) - 1 if c else 0


def probability(before, word, total, distinct, texts, one, two):
    """Every n-gram counts, also one that was seen once."""
    context = texts if before is None else most(one[before])
    return (least(two[before, word]) + lm.PRIOR * (least(one[word]) + 1) / (total + distinct + 1)) / (context + lm.PRIOR)


def slow(docs):
    total, distinct, texts, one, two = counts(docs)
    out = []
    for k, t, *_ in docs:
        w = lm.tokens((t or "").encode())
        base = sum(math.log10((one[x] + 1) / (total + distinct + 1)) for x in w)
        score = sum(math.log10(probability(v, x, total, distinct, texts, one, two)) for v, x in zip([None, *w[:-1]], w, strict=True))
        out.append((k, held(k), len(w), sum(one[x] > 0 for x in w), total, base, score))
    return out


@pytest.mark.parametrize("sent", [lm.SENT_BYTES, 100])
def test_against_slow_version(spark, sent, monkeypatch):
    """By broadcast, and by sending the probes to the buckets; in several slices and buckets."""
    monkeypatch.setattr(lm, "BITS_PER_MARK", 200)  # few false positives
    monkeypatch.setattr(lm, "SLICE_BYTES", 5000)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 1000)
    monkeypatch.setattr(lm, "HELD_BIGRAMS", 300)
    monkeypatch.setattr(lm, "HELD_WORDS", 100)
    got = [tuple(r) for r in lm.score(frame(spark, data()), sent_bytes=sent).collect()]
    key = lambda r: (str(r[0]), r[2])
    for a, b in zip(sorted(got, key=key), sorted(slow(data()), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] == pytest.approx(b[6], rel=2e-3)


def test_probabilities_of_a_context_add_up_to_at_most_one(spark):
    """Over all known tokens and one that is unknown, after every context."""
    docs = data()
    total, distinct, texts, one, two = counts(docs)
    words = [*one, b"never-seen"]
    for before in [None, *words]:
        assert sum(probability(before, w, total, distinct, texts, one, two) for w in words) <= 1 + 1e-12
    # the operator's own arithmetic, over all tokens after one context
    level = lambda c: math.floor(math.log2(c)) if c else -1
    totals = lm.Totals(total, distinct, texts)
    for before in list(one)[:20]:
        own = np.array([v for w in words for v in (level(one[before]), level(one[w]))], np.int8)
        pair = np.array([v for w in words for v in (-1, level(two[before, w]))], np.int8)
        p = 10 ** lm.log_probability(own, pair, np.arange(0, len(own), 2), totals)[1::2]
        assert p.sum() <= 1 + 1e-9
        assert p[0] == pytest.approx(probability(before, words[0], total, distinct, texts, one, two))


def built(spark, h, c):
    order = np.argsort(h)
    rows = []
    buckets, ends = lm._cut(h[order], 3)
    for b, i, j in zip(buckets.tolist(), ends, ends[1:], strict=False):
        rows.append((b, 2, bytearray(h[order][i:j].tobytes()), bytearray(c[order][i:j].astype(np.uint32).tobytes()), 0))
    made = lm.build_filter(spark.createDataFrame(rows, lm.COUNTED))
    return lm.gathered(made, 3, made.count(), sum(len(r.bits) for r in made.collect()), 0)[0]


def test_filter_gives_levels_back(spark):
    r = np.random.default_rng(1)
    h = np.unique(r.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2))
    c = r.integers(1, 5000, len(h))
    c[:1500] = 1
    part = built(spark, h, c)
    got, want = part.levels(h), np.floor(np.log2(c)).astype(int)
    assert (got >= want).all() and (got == want).mean() > 0.98
    assert (part.levels(np.unique(r.integers(0, 1 << 63, 9000).astype(np.uint64) * np.uint64(2) + np.uint64(1))) >= 0).mean() < 0.02


def test_salts_give_the_same(spark, monkeypatch):
    """Counts and probes that meet by bucket and salt first: scores, to the last digit, and no group grows with the corpus."""
    data = [r for r in rows() if r[0] is not None] + [(1000 + k, "the same frequent words " * (k % 7) + f"own{k}", *[None] * 7) for k in range(120)]
    scored = lambda sent: sorted(map(tuple, lm.score(frame(spark, data).repartition(6), sent).collect()), key=str)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 1 << 14)
    monkeypatch.setattr(lm, "SLICE_BYTES", 1 << 10)
    monkeypatch.setattr(lm, "HELD_BIGRAMS", 500)
    monkeypatch.setattr(lm, "HELD_WORDS", 50)
    want = scored(lm.SENT_BYTES)
    monkeypatch.setattr(lm, "SALT_BYTES", 1 << 16)
    assert scored(lm.SENT_BYTES) == want and scored(-1) == want

    train = frame(spark, data).select("text")
    counted = lm.materialise(lm.count_ngrams(train, 3, 3))
    largest = lambda df, *keys: df.groupBy(*keys).count().agg({"count": "max"}).first()[0]
    merged = lm.merged(counted)
    assert largest(merged, "bucket") <= 6 < largest(counted, "bucket")
    assert largest(counted, "bucket", "salt") < largest(counted, "bucket")


def test_counts_over_four_bytes_add_up(spark):
    h = np.array([3, 9], np.uint64)
    row = lambda c, salt: (0, 1, bytearray(h.tobytes()), bytearray(np.array(c, np.uint32).tobytes()), salt)
    counted = spark.createDataFrame([row([2**32 - 1, 1], k % 3) for k in range(10)], lm.COUNTED)
    got = lm.build_filter(counted, 3).first()
    assert np.frombuffer(got.c, np.int64).tolist() == [10 * (2**32 - 1), 10] and got.total == 10 * 2**32


def test_buckets_cut_without_loss():
    h = np.sort(np.random.default_rng(2).integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    buckets, ends = lm._cut(h, 4)
    blobs = lm._blobs(h, ends)
    assert b"".join(blobs.to_pylist()) == h.tobytes() and len(blobs) == len(buckets)
    assert all((np.frombuffer(x, np.uint64) >> np.uint64(60) == b).all() for b, x in zip(buckets.tolist(), blobs.to_pylist(), strict=True))
    assert lm._cut(h[:0], 4)[1].tolist() == [0] and isinstance(lm._blobs(h[:0], np.array([0])), pa.Array)


@pytest.mark.parametrize("sent", [lm.SENT_BYTES, -1])
def test_no_rows_and_no_training(spark, sent):
    assert lm.score(frame(spark, []), sent).count() == 0
    k = next(k for k in range(100) if held(k))
    only = lm.score(frame(spark, [(k, "a b", *[None] * 7)]), sent).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in only] == [(True, 3, 0, 0, 0.0)]
    assert math.isfinite(only[0].score)


def test_slices_lose_nothing():
    texts = [b"x" * n for n in (5, 0, 50, 3, 3, 100, 1)]
    parts = list(lm.slices(texts, 10))
    assert [t for s in parts for t in texts[s]] == texts
    assert list(lm.slices([], 10)) == []


def test_probes_are_not_written_and_meet_a_bucket_at_once(spark, monkeypatch):
    """Beyond what is sent, parts of documents ask the buckets in one pass: no table of probes, one row of a part for a bucket, the same scores."""
    monkeypatch.setattr(lm, "BUCKET_BYTES", 1 << 12)
    docs = [r for r in data() if r[0] is not None]
    scored = lambda sent: sorted(map(tuple, lm.score(frame(spark, docs).repartition(3), sent).collect()), key=str)
    want = scored(lm.SENT_BYTES)
    monkeypatch.setattr(lm, "ASKED_BYTES", 3000)
    written = []
    monkeypatch.setattr(lm, "materialise", lambda df, name, f=lm.materialise: written.append(name) or f(df, name))
    assert scored(-1) == want and written == ["filter"]


def test_a_bucket_answers_rows_in_their_order():
    h = np.array([7, 3, 3, 9], np.uint64)
    column = pa.chunked_array([lm._blobs(h, np.array([0, 2, 2])), lm._blobs(h[2:], np.array([0, 2]))])
    values, ends = lm._flat(column, np.uint64)
    assert values.tolist() == h.tolist() and ends.tolist() == [0, 2, 2, 4]
    assert lm._blobs(values.astype(np.int8), ends).to_pylist() == [b"\7\3", b"", b"\3\x09"]
