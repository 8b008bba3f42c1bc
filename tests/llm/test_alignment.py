import hashlib
import random
from collections import Counter

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
pytest.importorskip("sentencepiece")

from sequoir.llm import alignment  # noqa: E402
from tests.llm.cases import frame, prose, rows, texts  # noqa: E402

A, B = str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))
ODD = [
    " leading", "trailing ", "  ", " ", "\n", "a\n\nb", "a \n b\t\tc", "x\r\ny;\r\nz {\r\n}", "tab\tand　wide\xa0space", "under▁score here", "▁", "don't 'tis we'll", "<|endoftext|> <s>x</s> <0x41>",
    "\x00nul \x1c sep\x85next", "naïve ﬁ ½ 中文 字 한국어 🎉🎉 ", "a" * 3000, "a b " * 500, "    four    spaces    ", "é é ‍ zero​width", ".\n.\n.\n", " line sep a",
]


@pytest.fixture(scope="module")
def pair():
    return alignment.pair_of(A, B)


def whole(pair, text):
    """Ids of both models over one whole text."""
    if not text:
        return [], []
    a, b, data = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text), (" " + text).encode()
    same = b"".join(pair.bytes_a[i] for i in a) == data == b"".join(pair.bytes_b[i] for i in b)
    return (a, b) if same else ([], [])


def slow_groups(pair, a, b):
    """Groups and links by looking at all pairs of spans, in bytes."""
    spans = []
    for ids, table in ((a, pair.bytes_a), (b, pair.bytes_b)):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(table[i]), i))
            at = out[-1][1]
        spans.append(out)
    links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
    both = sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]})
    groups = ["|".join(",".join(str(i) for s, e, i in part if lo <= s and e <= hi) for part in spans) for lo, hi in zip([0, *both], both, strict=False)]
    return groups, links


def slow(pair, data):
    each = [slow_groups(pair, *whole(pair, t)) + whole(pair, t) for t in data]
    counts = Counter(link for _, links, _, _ in each for link in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for groups, links, a, b in each:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return out


def made(n, seed):
    r = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "\r", "\r\n", "▁", "　", "\x1c", "the", "The", "ing", "'s", "1", "22", "é", "中", "🎉", "{", "}", ";", "_", "\xa0", "word", "."]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_segments_give_what_whole_texts_give(pair):
    for text in [*filter(None, ODD + made(3000, 1) + [t or "" for t in texts() if len(t or "") < 20_000])]:
        segments = list(pair.segments(text))
        assert "".join(segments) == " " + text
        a, b, ok = [], [], True
        for s, x, y in pair.tokens(segments):
            assert s
            ok &= bool(x)
            a += x
            b += y
        assert ((a, b) if ok else ([], [])) == whole(pair, text), repr(text)


def test_cuts_are_looked_up():
    assert alignment.cuts(["ab", " a", "  ", "b\r"]) == " \n\t"
    assert alignment.cuts(["a b", "x\n"]) == "\t"
    assert alignment.cuts([" \n x"]) == " \n\t"


def test_a_vocabulary_that_merges_across_leaves_whole_texts(pair, monkeypatch):
    other = alignment.Pair(A, B)
    import re

    monkeypatch.setattr(other, "segment", re.compile(r"\s*\S*(?:\s\s*\S*)*"))
    assert list(other.segments("a b  c\nd")) == [" a b  c\nd"]


def test_links_against_all_pairs(pair):
    for text in ODD + made(500, 2):
        a, b = whole(pair, text)
        groups, links = pair.align(a, b)
        want = slow_groups(pair, a, b)
        assert (pair.written(pair.coded(groups)), sorted(links)) == (";".join(want[0]), sorted(want[1]))


@pytest.mark.parametrize(("size", "sent"), [(1, 0), (5_000, 1 << 20), (2 << 20, 0), (2 << 20, 1 << 20)])
def test_every_row(spark, pair, monkeypatch, size, sent):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", size)
    monkeypatch.setattr(alignment, "PAIRS_SENT", sent)
    monkeypatch.setattr(alignment, "LONG", 10_000)
    data = [r[:1] + ((r[1] or "")[:30_000] if r[1] else r[1],) + r[2:] for r in rows()]
    data += [(1000 + k, t, None, "s", None, None, 7, "r", "c") for k, t in enumerate(ODD + made(60, 3) + [prose(200, 1)] * 5)]
    found = alignment.align_corpus(frame(spark, data), A, B, with_groups=True).collect()
    want = slow(pair, [r[1] for r in data])
    assert Counter((r.doc_id, *tuple(r)[1:8]) for r in found) == Counter((d[0], *w) for d, w in zip(data, want, strict=True))
    for r in found:
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")


def test_no_rows_and_no_tokens(spark):
    assert alignment.align_corpus(frame(spark, []), A, B).count() == 0
    nothing = [(1, None, None, None, None, None, None, None, None), (1, "", None, None, None, None, None, None, None), (None, "▁", None, None, None, None, None, None, None)]
    assert [tuple(r)[1:] for r in alignment.align_corpus(frame(spark, nothing), A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 3


def test_segments_are_tokenised_once(spark):
    data = [(k, "the same words here", None, None, None, None, None, None, None) for k in range(50)]
    rows_ = alignment.segment_alignments(frame(spark, data), A, B).collect()
    assert all(r.ok and "|" in r.groups for r in rows_)
    found = {r.segment: r.n for r in rows_}
    assert found == {" the": 50, " same": 50, " words": 50, " here": 50}
