import random
from collections import Counter

import numpy as np

from sequoir.llm import decontaminate as D
from tests.llm.cases import frame, prose, rows

BENCH = [(1, prose(15, 9021)), (2, prose(40, 9022)), (3, prose(58, 9023)), (4, "just three words"), (5, None), (6, " "), (7, prose(40, 9022)), (None, prose(30, 9024))]


def bench(spark, data=None):
    return spark.createDataFrame([(k, t, "x") for k, t in (BENCH if data is None else data)], "item_id long, text string, doc_id string")


def slow(text, items, least=0.8):
    words = (text or "").encode().lower().split()
    out = {}
    for k, t in items:
        own = (t or "").encode().lower().split()
        if not own or not words:
            continue
        a = Counter(D.shingles(own))
        n = min(len(own), len(words)) if len(own) >= D.SHINGLE_WORDS else len(own)
        for s in range(len(words) - n + 1):
            x = D.similarity(Counter(D.shingles(words[s : s + n])), a)
            if x >= least and x > out.get(k, (0, 0))[0]:
                out[k] = x, s
    return {(k, s, round(x, 9)) for k, (x, s) in out.items()}


def altered(text, r, edits):
    words = text.split()
    for _ in range(edits):
        at = r.randrange(len(words))
        r.choice([lambda: words.__setitem__(at, "changed"), lambda: words.pop(at), lambda: words.insert(at, "added")])()
    return " ".join(words)


def test_hits_against_every_window():
    r = random.Random(6)
    items = [(k, t) for k, t in BENCH if k is not None]
    index = D.Items([(k, t.encode()) for k, t in items if t is not None])
    for k in range(150):
        passage = altered(r.choice([t for _, t in items if t and t.strip()]), r, r.choice([0, 0, 1, 1, 2, 3]))
        text = r.choice([passage, passage.upper(), prose(r.randint(0, 80), 1000 + k) + " " + passage + " " + prose(r.randint(0, 80), 2000 + k)])
        got = {(i, s, round(x, 9)) for i, s, _, x in index.hits(text.encode())}
        assert got == slow(text, items)


def test_multi_index_finds_all_within_the_radius():
    r = random.Random(7)
    index = D.Items([(k, prose(30, 100 + k).encode()) for k in range(150)])
    for _ in range(400):
        mark = r.choice(index.marks.tolist())
        for bit in r.sample(range(64), r.randint(0, 26)):
            mark ^= 1 << bit
        assert index.within(mark) == [i for i, m in enumerate(index.marks.tolist()) if (m ^ mark).bit_count() <= D.RADIUS]


def docs():
    return rows() + [(50, prose(100, 31) + " " + BENCH[1][1] + " " + prose(5, 32), None, *[None] * 6), (51, BENCH[0][1], None, *[None] * 6), (51, BENCH[0][1], None, *[None] * 6), (52, "see: just three words here", None, *[None] * 6), (53, BENCH[2][1][:120], None, *[None] * 6)]


def test_table(spark):
    found = D.contaminated(frame(spark, docs()), bench(spark)).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(50, 2), (50, 7), (51, 1), (51, 1), (52, 4)]
    assert all(r.similarity == 1.0 for r in found)
    assert D.contaminated(frame(spark, []), bench(spark)).count() == 0
    assert D.contaminated(frame(spark), bench(spark, [])).count() == 0


def test_benchmark_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(D, "item_blocks", lambda b, f=D.item_blocks: f(b, 20))
    found = D.contaminated(frame(spark, docs()), bench(spark)).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(50, 2), (50, 7), (51, 1), (51, 1), (52, 4)]
    assert {r.doc_id for r in D.keep_clean(frame(spark, docs()), bench(spark)).collect()} & {50, 51, 52} == set()


def test_stage_keeps_clean_rows(spark):
    kept = D.keep_clean(frame(spark, docs()), bench(spark))
    assert kept.schema == frame(spark).schema
    assert kept.count() == len(docs()) - 4
    assert D.keep_clean(frame(spark, []), bench(spark)).count() == 0


def test_the_index_finds_what_lies_within_the_radius():
    """Every item within the radius, and hardly any pair of similarity 0.8 lies beyond it."""
    r = np.random.default_rng(1)
    words = [b"w%d" % k for k in range(4000)]
    texts = [b" ".join(r.choice(words, 60)) for _ in range(400)]
    items = D.Items(list(enumerate(texts)))
    marks = items.marks.tolist()
    for mark in [*marks[:20], *(m ^ sum(1 << int(b) for b in r.choice(64, n, replace=False)) for m in marks[:30] for n in (4, 12, 19, 20)), *r.integers(0, 1 << 63, 50).tolist()]:
        assert items.within(mark) == [i for i, m in enumerate(marks) if (m ^ mark).bit_count() <= 19]
    found = n = 0
    for _ in range(400):
        x = [b"%d" % v for v in r.integers(0, 1 << 40, 90)]
        a, b = D.Counter(x[:81]), D.Counter(x[9:])
        assert D.similarity(a, b) == 0.8
        found, n = found + ((D.simhash(a) ^ D.simhash(b)).bit_count() <= D.RADIUS), n + 1
    assert found / n >= 0.98


def test_candidates_come_from_the_index(monkeypatch):
    text = b" ".join(b"w%d" % k for k in range(50))
    items = D.Items([(1, text)])
    assert items.hits(b"some words before " + text)
    monkeypatch.setattr(D.Items, "within", lambda self, mark: [])
    assert not items.hits(b"some words before " + text)


def test_many_items_take_several_passes(spark):
    bench = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(9))) for k in range(30)], "item_id long, text string")
    parts = list(D.item_blocks(bench, items=8))
    assert len(parts) == 4 and sorted(i for p in parts for i in p.ids) == list(range(30))


def test_windows_at_once_have_the_fingerprints_of_each(monkeypatch):
    import random
    from collections import Counter

    from sequoir.llm import decontaminate as D

    r = random.Random(4)
    words = [r.choice([b"a", b"b", b"cc", b"dd", b"e"]) for _ in range(400)]
    for span in (1, 7, 4096):
        monkeypatch.setattr(D, "SPAN", span)
        for size in (1, 2, 30):
            starts = sorted(r.sample(range(len(words) - size - D.SHINGLE_WORDS + 2), 120))
            want = [(x, D.simhash(Counter(D.shingles(words[x : x + size + D.SHINGLE_WORDS - 1])))) for x in starts]
            assert list(D.window_marks(words, starts, size)) == want


def test_a_document_that_repeats_an_item():
    """Work in proportion to its words: an item over and over in a long text."""
    import time

    from sequoir.llm import decontaminate as D

    item = " ".join(f"word{k}" for k in range(60)).encode()
    items = D.Items([(1, item)])
    began = time.process_time()
    assert items.hits(b" ".join([item] * 500)) == [(1, 0, 60, 1.0)]
    assert time.process_time() - began < 6
