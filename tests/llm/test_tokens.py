import hashlib
import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from sequoir.llm import bpe, tokencount  # noqa: E402
from tests.llm.cases import frame, rows, texts  # noqa: E402

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
PARTS = ["'s", "'t", " ", "\n", "<|endoftext|>", "<|", "é", "́", "Σ", "İ", "A", "don't", "'LL", "1", "½", "中", "\xa0", "\x1c", "\x85", "!", "...", "🎉", "th", "ing", "가", "K", "\x00", "the", "</w>", "Ᲊ", "՘"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return bpe.model_of(f.read())


def made(seed, n, most=9):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, most))) for _ in range(n)]


def test_encoding_against_the_library(model, library):
    for text in made(1, 3000) + [t or "" for t in texts()]:
        assert model.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_compatibility_against_merging(model):
    r = random.Random(2)
    keys = list(model.symbols.items())
    first = [x for x in keys if bpe.END not in x[0]]
    for a, b in zip(r.choices(first, k=4000), r.choices(keys, k=4000), strict=True):
        assert model.compatible(a[1], b[1]) == (model.naive(a[0] + b[0]) == [a[1], b[1]])


@pytest.mark.parametrize("word", ["......'", "aaaaaaaaaaaaa", "xxxx", "hahahahaha", "''''", "0", "ſ"])
def test_backtracking_against_merging(model, word):
    key = word.encode().decode("latin-1") + bpe.END
    assert model.encode_word(word) == model.naive(key)


def test_transducer_with_small_chunks(model, library, monkeypatch):
    monkeypatch.setattr(tokencount, "CHUNK_BYTES", 7)
    monkeypatch.setattr(tokencount, "MAX_STATES", 50)
    count = tokencount.counter(model)
    for text in made(3, 2000, 14) + [(t or "")[:3000] for t in texts()]:
        assert count(text.encode()) == len(library.encode(text, add_special_tokens=False).ids)


def chunked(model, data, size):
    tokencount.counter(model)
    reader, memo = tokencount._counters[model]
    return tokencount.Chunks(data, reader, lambda words: sum(memo.all(words)), size)


def test_chunk_maps_compose_in_any_order(model):
    """Maps of states: from any state, the composed map does what the chunks do one after another."""
    r = random.Random(5)
    for text in [x for x in made(4, 300, 14) if "<|endoftext|>" not in x and x] + ["ab cd's efg\th ijklmnop 'r 're q''s stuvw", "nospacehere" * 9]:
        data = text.encode()
        for size in (1, 2, 3, 5, 8):
            chunks = chunked(model, data, size)
            left = chunks.maps[0]
            for m in chunks.maps[1:]:
                left = chunks.compose(left, m)
            top = chunks.sweep()[-1][0]
            assert (top.start, top.stop, top.count, top.out) == tuple(left)
            start = chunks.reader.read(tokencount.BETWEEN, "".join(r.choice("abc'r1!") for _ in range(r.randint(0, 5))))[0]
            state, total = start, 0
            for m in chunks.maps:
                state, added = chunks.apply(m, state)
                total += added
            assert chunks.apply(top, start) == (state, total)


def test_scan_has_the_count_at_every_chunk(model, library):
    """At a chunk's end: the tokens up to there, once the word is closed there."""
    for text in ["it's a  long-ish text, with 12 numbers; and 'quotes' 're here " * 3, "unspaced'reallythatis'so" * 4]:
        chunks = chunked(model, text.encode(), 6)
        found = chunks.scan()
        for end, (state, total) in zip(chunks.ends, found, strict=True):
            assert total + chunks.reader.close(state) == len(library.encode(text[:end], add_special_tokens=False).ids)
        assert found[-1][1] + chunks.reader.close(found[-1][0]) == chunks.total()


def test_reading_is_cut_where_normalisation_does_not_reach():
    data = "a\u0301\u0301가\u1161\u11a8e\u0301xyz中\u0301".encode()
    for size in range(1, 12):
        ends = [0, *tokencount.cuts(data, size)]
        parts = [data[i:j].decode() for i, j in zip(ends, ends[1:], strict=False)]
        assert "".join(map(bpe.normalise, parts)) == bpe.normalise(data.decode())


def test_long_texts_without_a_space(model, library):
    """Time and memory in proportion to the length."""
    import tracemalloc

    count = tokencount.counter(model)
    small = "xyzzyé中" * 3000
    assert count(small.encode()) == len(library.encode(small, add_special_tokens=False).ids)
    for unit in ("a", "word!9", "é中"):
        long = (unit * (3_000_000 // len(unit.encode()))).encode()
        few = len(library.encode(unit * 4000, add_special_tokens=False).ids)
        tracemalloc.start()
        n = count(long)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 15_000_000
        assert abs(n / len(long) - few / (4000 * len(unit.encode()))) < 0.01


def test_counts_of_every_row(spark, library):
    found = {r.doc_id: r for r in tokencount.count_tokens(frame(spark), PATH, 100).collect() if r.doc_id is not None}
    for doc_id, text, *_ in rows():
        if doc_id is not None:
            n = len(library.encode(text or "", add_special_tokens=False).ids)
            assert tuple(found[doc_id]) == (doc_id, len((text or "").encode()), n, n > 100)
    assert tokencount.count_tokens(frame(spark), PATH).count() == len(rows())
    assert tokencount.count_tokens(frame(spark, []), PATH).count() == 0


def test_digests_of_every_row(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "SLAB", 5)
    found = {r.doc_id: r for r in bpe.encode_decode(frame(spark), PATH).collect() if r.doc_id is not None}
    for doc_id, text, *_ in rows():
        if doc_id is not None:
            ids = library.encode(text or "", add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            want = (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
            assert tuple(found[doc_id]) == want
    assert bpe.encode_decode(frame(spark, []), PATH).count() == 0


def test_ids_and_back(spark, library):
    ids = bpe.encode_ids(frame(spark), PATH)
    back = {r.doc_id: r.text for r in bpe.decode_ids(ids, PATH).collect() if r.doc_id is not None}
    for doc_id, text, *_ in rows():
        if doc_id is not None:
            assert back[doc_id] == library.decode(library.encode(text or "", add_special_tokens=False).ids, skip_special_tokens=False)


def test_memo_keeps_two_generations(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 3)
    made_ = []
    memo = bpe.Memo(lambda w: made_.append(w) or w.upper())
    assert memo.all([b"a", b"b", b"c", b"d", b"a"]) == [b"A", b"B", b"C", b"D", b"A"]
    assert made_ == [b"a", b"b", b"c", b"d"]
    assert len(memo.seen) <= 3


def test_unsupported_models_are_refused():
    with pytest.raises(bpe.Unsupported):
        bpe.Model(b'{"model": {"type": "BPE", "vocab": {}, "merges": []}, "normalizer": null, "pre_tokenizer": null, "added_tokens": []}')
