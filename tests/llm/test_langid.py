import random
import zlib

import numpy as np

from sequoir.llm import langid
from tests.llm.cases import frame, rows

SETS = {"en": "the of and that with which they this have from".split(), "de": "der die und nicht auch über schön straße sich werden".split(), "fr": "le être à déjà où les avec français même très".split()}


def labelled(n, seed=1):
    r = random.Random(seed)
    return [(k, " ".join(r.choice(SETS[lang]) for _ in range(r.randint(5, 60))), lang, "s", 0, None, None, None, None) for k in range(n) for lang in [r.choice(list(SETS))]]


def test_held_out_accuracy_and_the_split(spark):
    data = labelled(400)
    wrong = [(k, t, lang if zlib.crc32(str(k).encode()) % 5 else "xx", *rest) for k, t, lang, *rest in data]  # labels of held-out rows must not matter
    found = {r.doc_id: r for r in langid.language_id(frame(spark, wrong)).collect()}
    held = [k for k, *_ in data if zlib.crc32(str(k).encode()) % 5 == 0]
    assert {k for k, r in found.items() if r.held_out} == set(held)
    right = sum(found[k].lang_pred == lang for k, _, lang, *_ in data if k in set(held))
    assert right / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values()) and "xx" not in {r.lang_pred for r in found.values()}


def test_same_input_same_network(spark):
    x, labels = langid.training_windows(frame(spark, labelled(60)))
    again, _ = langid.training_windows(frame(spark, labelled(60)).repartition(7))
    assert (x == again).all()
    a, b = langid.train(x, labels, epochs=2), langid.train(x, labels, epochs=2)
    assert all((p == q).all() for p, q in zip(a.tables, b.tables, strict=True)) and (a.out == b.out).all()


def test_sample_is_bounded_and_distinct(spark):
    data = labelled(50) + [(1000 + k, "the of and that", "en", "s", 0, None, None, None, None) for k in range(300)]
    x, labels = langid.training_windows(frame(spark, data), per_language=5)
    assert max(labels.count(v) for v in set(labels)) <= 5 * langid.WINDOWS_PER_TEXT


def test_compiled_tables_score_as_a_convolution():
    r = np.random.default_rng(3)
    net = langid.train(r.integers(0, 27, (30, langid.WINDOW)).astype(np.uint8), ["a", "b", "c"] * 10, epochs=1)
    x = r.integers(0, langid.CODES, (4, langid.WINDOW)).astype(np.uint8)
    pooled = []
    for t in net.tables:
        w = len(t)
        pooled.append(np.array([[max(sum(t[k, row[i + k], f] for k in range(w)) for i in range(langid.WINDOW - w + 1)) for f in range(langid.FILTERS)] for row in x.tolist()]))
    z = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0) @ net.out + net.out_bias
    want = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    assert np.allclose(net.probabilities(x), want, atol=1e-4)


def test_windows_cover_the_whole_text():
    text = ("Wörter " * 500).encode()
    own = langid.windows(text)
    assert (own != 32).sum() == 500 * 7  # six letters, one of two bytes
    assert own.tobytes().strip() == text.strip().lower()
    assert langid.windows(b"").shape == (1, langid.WINDOW)


def test_rows_that_are_hard(spark):
    found = langid.language_id(frame(spark)).collect()
    assert len(found) == len(rows())
    by = {r.doc_id: r for r in found}
    for k in (0, 1, 2, 3):
        assert (by[k].lang_pred, by[k].score) == ("und", 0.0)
    assert by[10].lang_pred in ("en", "fr") and by[11].lang_pred != "und"
    assert langid.language_id(frame(spark, [])).count() == 0
    none = [(1, "some text", None, *[None] * 6)]
    assert [(r.lang_pred, r.score) for r in langid.language_id(frame(spark, none)).collect()] == [("und", 0.0)]


def test_stage_keeps_what_is_a_language(spark):
    docs = frame(spark)
    kept = langid.keep_identified(docs)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} & {0, 1, 2, 3} == set()
    assert {5, 8, 10, 11} <= {r.doc_id for r in kept.collect()}
    assert langid.keep_identified(frame(spark, [])).count() == 0
    assert langid.keep_identified(frame(spark, [(1, "text", None, *[None] * 6)])).count() == 1


def slow_score(net, text):
    """A whole document's answer, window by window and place by place."""
    read = b" " + bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode()) + b" "
    total, weight = np.zeros(len(net.languages) + 1), 0
    for at in range(0, len(read), langid.WINDOW):
        part = read[at : at + langid.WINDOW].ljust(langid.WINDOW, b" ")
        pooled = []
        for t in net.tables:
            w = len(t)
            pooled.append(np.max([sum(t[k, part[i + k]] for k in range(w)) for i in range(langid.WINDOW - w + 1)], axis=0))
        z = np.maximum(np.concatenate(pooled) + net.bias, 0) @ net.out + net.out_bias
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        own = sum(97 <= b <= 122 or b > 127 for b in part)
        total, weight = total + p * own, weight + own
    p = total / weight
    best = int(np.argmax(p[:-1]))
    return net.languages[best], p[best]


FOREIGN = ["Это русский текст о погоде и о природе в большой стране", "これは日本語の文章です。天気が良いので散歩に行きます。", "xqzvjk wpfgh zzxcvb qwrtp mnbvc lkjhg fdsq " * 4]


def test_whole_documents_against_a_slow_version(spark):
    data = labelled(120)
    net = langid.trained(frame(spark, data))
    texts = [t for _, t, *_ in data[:12]] + FOREIGN + [" ".join(SETS["de"]) * 20]
    for (lang, score), text in zip(langid.score_texts(net, None, [t.encode() for t in texts]), texts, strict=True):
        want = slow_score(net, text)
        assert lang == want[0] and abs(score - want[1]) < 1e-4


def test_filter_drops_other_languages_and_noise(spark):
    """The network's answer decides: foreign texts have letters, and still go."""
    data = labelled(200)
    odd = [(1000 + k, t, None, "s", 0, None, None, None, None) for k, t in enumerate(FOREIGN)]
    docs = frame(spark, data + odd)
    net = langid.trained(docs)
    kept = {r.doc_id for r in langid.keep_identified(docs, net).collect()}
    assert kept == {k for k, t, *_ in data + odd if slow_score(net, t)[1] >= langid.LEAST_SCORE}
    assert kept == {k for k, *_ in data}
    german = {r.doc_id for r in langid.keep_identified(docs, net, languages=["de"]).collect()}
    assert german == {k for k in kept if slow_score(net, dict((a, b) for a, b, *_ in data)[k])[0] == "de"}
    assert 0 < len(german) < len(kept)
