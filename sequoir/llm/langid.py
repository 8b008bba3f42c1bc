"""Language identification by a byte convolutional network, trained in numpy.

A window of bytes goes through filters of several widths, each filter's greatest
response in the window is kept, and softmax classifies those: into the labelled
languages and noise, which is made of the training windows and lets the score
of a text in no known language fall. As the input is
one-hot, a filter is a table of weights by offset and byte, and a convolution a
sum of table rows; for scoring, two neighbouring offsets make one table over
byte pairs. Texts are cut into fixed-length windows, all of which are scored,
in batches; a document has the mean of its windows, weighted by their letters.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.llm.common import crc_mod, keep_rows, map_arrow, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Windows that are scored at a time.
BATCH = 128
#: The bound of the training sample: distinct texts of each language, and windows of each text.
TEXTS_PER_LANGUAGE = 1000
WINDOWS_PER_TEXT = 4
EPOCHS = 8
RATE = 6e-3
SEED = 7
UNDETERMINED = "und"
#: Windows of noise at least.
NOISE = 1000
FOLDS, HELD_OUT = 5, 0
#: Score under which the filter takes a text for no learned language.
LEAST_SCORE = 0.2
#: Languages that are learned at most: those with the most distinct texts.
LANGUAGES = 200
#: A code is a byte, A-Z in lower case; windows are padded with spaces.
CODES = 256
SPACE = 32
#: Which codes count as letters when windows are weighed: a-z and the bytes of letters beyond ASCII.
LETTERS = np.array([chr(c).isalpha() if c < 128 else True for c in range(CODES)])
letter = regex.compile(r"\p{L}").search


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # for each width: (width, CODES, FILTERS)
    bias: np.ndarray  # (widths * FILTERS,)
    out: np.ndarray  # (widths * FILTERS, languages + 1): the last is noise
    out_bias: np.ndarray

    def compiled(self) -> list[list[tuple[int, bool, np.ndarray]]]:
        """For each width: (offset, whether over pairs, table)."""
        found = []
        for t in self.tables:
            steps = [(k, True, (t[k][:, None, :] + t[k + 1][None, :, :]).reshape(-1, t.shape[2])) for k in range(0, len(t) - 1, 2)]
            found.append(steps + [(len(t) - 1, False, t[-1])] * (len(t) % 2))
        return found

    def probabilities(self, x: np.ndarray, steps: list | None = None) -> np.ndarray:
        """(n, languages + 1) for windows x of codes, (n, WINDOW); the last is noise."""
        single = x.astype(np.int32)
        pair = single[:, :-1] * CODES + single[:, 1:]
        pooled = []
        for t, parts in zip(self.tables, steps or self.compiled(), strict=True):
            n, total = x.shape[1] - len(t) + 1, None
            for k, pairs, rows in parts:
                found = rows.take((pair if pairs else single)[:, k : k + n], axis=0)
                total = found if total is None else np.add(total, found, out=total)
            pooled.append(total.max(axis=1))
        z = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def windows(text: bytes) -> np.ndarray:
    """All windows of a text as codes, (n, WINDOW); there is a space before and after it."""
    read = b" " + text.lower() + b" "
    n = -(-len(read) // WINDOW)
    return np.frombuffer(read.ljust(n * WINDOW), np.uint8).reshape(n, WINDOW)


def noise(x: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Windows that are no language: those of x with their codes in any order, and such of any codes."""
    mixed = random.permuted(x, axis=1)
    anything = random.random(len(x)) < 0.5
    share = random.random((len(x), 1))
    drawn = random.integers(0, CODES, x.shape).astype(np.uint8)
    return np.where(anything[:, None] & (random.random(x.shape) < share), drawn, mixed)


def some_windows(text: bytes, most: int = WINDOWS_PER_TEXT) -> np.ndarray:
    own = windows(text)
    return own[np.linspace(0, len(own) - 1, min(most, len(own))).astype(int)]


def train(x: np.ndarray, labels: list[str], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """A network for the labels of windows x and for noise made of them, by Adam on the cross entropy.

    The same input gives the same network.
    """
    languages = sorted(set(labels))
    random = np.random.default_rng(seed)
    other = noise(x[random.integers(0, len(x), max(NOISE, len(x) // len(languages)))], random)
    y = np.array([languages.index(v) for v in labels] + [len(languages)] * len(other))
    x = np.concatenate([x, other])
    weight = (len(y) / ((len(languages) + 1) * np.bincount(y)))[y].astype(np.float32)
    hidden = len(WIDTHS) * FILTERS
    tables = [random.normal(0, 0.3, (w, CODES, FILTERS)).astype(np.float32) for w in WIDTHS]
    net = Network(languages, tables, np.zeros(hidden, np.float32), random.normal(0, 0.2, (hidden, len(languages) + 1)).astype(np.float32), np.zeros(len(languages) + 1, np.float32))
    values = [*net.tables, net.bias, net.out, net.out_bias]
    mean, square = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    filters, step = np.arange(FILTERS), 0
    for epoch in range(epochs):
        order = random.permutation(len(x))
        for at in range(0, len(order), 64):
            pick = order[at : at + 64]
            xb, wb, rows = x[pick].astype(np.int64), weight[pick], np.arange(len(pick))
            peaks, pooled = [], []
            for t in net.tables:
                n = WINDOW - len(t) + 1
                total = t[0].take(xb[:, :n], axis=0)
                for k in range(1, len(t)):
                    total += t[k].take(xb[:, k : k + n], axis=0)
                peaks.append(total.argmax(axis=1))
                pooled.append(np.take_along_axis(total, peaks[-1][:, None, :], axis=1)[:, 0, :])
            before = np.concatenate(pooled, axis=1) + net.bias
            h = np.maximum(before, 0)
            z = h @ net.out + net.out_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[rows, y[pick]] -= 1
            dz = (p * wb[:, None] / len(pick)).astype(np.float32)
            dh = (dz @ net.out.T) * (before > 0)
            grads = []
            for i, (t, peak) in enumerate(zip(net.tables, peaks, strict=True)):
                g, own = np.zeros_like(t), dh[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(len(t)):
                    np.add.at(g[k], (xb[rows[:, None], peak + k], filters[None, :]), own)
                grads.append(g)
            grads += [dh.sum(axis=0), h.T @ dz, dz.sum(axis=0)]
            step += 1
            rate = RATE * (1 - epoch / epochs) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            for v, g, a, b in zip(values, grads, mean, square, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                v -= (rate * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
    return net


def training_windows(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE) -> tuple[np.ndarray, list[str]]:
    """Windows and languages of a bounded sample of the labelled rows of docs in the training folds.

    Of each of LANGUAGES languages at most, the distinct texts with the smallest hashes: per_language
    at most, WINDOWS_PER_TEXT windows of WINDOW bytes of each. An estimate of
    how many distinct texts there are bounds the hashes first, with a fifth to
    spare, so that the driver gets few more than it takes and no task ranks a
    language.
    """
    able = docs.select("doc_id", "text", "lang").where("lang is not null").where(F.col("text").rlike(r"\p{L}")).where(crc_mod("doc_id", FOLDS) != HELD_OUT)
    hashed = able.select("lang", F.xxhash64("text").alias("order"), "text")
    sizes = {r.lang: r.n for r in hashed.groupBy("lang").agg(F.approx_count_distinct("order", 0.02).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not sizes:
        return np.zeros((0, WINDOW), np.uint8), []
    least, most = -(1 << 63), (1 << 63) - 1
    last = {k: min(most, least + int((1.2 * per_language + 100) / max(1, n) * 2.0**64)) for k, n in sorted(sizes.items())}
    limit = F.create_map(*(F.lit(v).cast("long" if isinstance(v, int) else "string") for pair in last.items() for v in pair))
    sample = hashed.where(F.col("order") <= limit[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [some_windows(x).tobytes() for x in utf8(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.binary())], ["lang", "order", "own"])

    cut = map_arrow(sample, run, "lang string, order long, own binary").groupBy("lang", "order").agg(F.min("own").alias("own"))
    taken: dict[str, list[np.ndarray]] = {}
    for lang, _, own in sorted((r.lang, r.order, bytes(r.own)) for r in cut.collect()):
        if len(taken.setdefault(lang, [])) < per_language:
            taken[lang].append(np.frombuffer(own, np.uint8).reshape(-1, WINDOW))
    return np.concatenate([x for own in taken.values() for x in own]), [lang for lang, own in taken.items() for x in own for _ in range(len(x))]


def score_texts(net: Network, steps: list | None, texts: list[bytes]) -> list[tuple[str, float]]:
    """Predicted language and its probability, noise being another answer, for each text."""
    out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
    if not net.languages:
        return out
    steps = steps or net.compiled()
    kept = [i for i, x in enumerate(texts) if letter(x.decode("utf-8", "replace"))]
    group: list[int] = []
    held: list[np.ndarray] = []

    def finish() -> None:
        sizes = np.array([len(x) for x in held])
        x = np.concatenate(held)
        p = np.concatenate([net.probabilities(x[at : at + BATCH], steps) for at in range(0, len(x), BATCH)])
        weight = LETTERS[x].sum(axis=1)[:, None].astype(np.float64)
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        total = np.add.reduceat(p * weight, starts, axis=0) / np.maximum(np.add.reduceat(weight, starts, axis=0), 1)
        for i, row in zip(group, total, strict=True):
            best = int(row[:-1].argmax())
            out[i] = net.languages[best], float(min(1.0, row[best]))
        group.clear()
        held.clear()

    n = 0
    for i in kept:
        group.append(i)
        held.append(windows(texts[i]))
        n += len(held[-1])
        if n >= 16 * BATCH:
            finish()
            n = 0
    if group:
        finish()
    return out


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs (doc_id, text), from the text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select("doc_id", "text", (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        steps = own.compiled()
        for batch in batches:
            found = score_texts(own, steps, utf8(batch.column(1)))
            columns = [batch.column(0).cast(pa.int64()), batch.column(2), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    return map_arrow(rows, run, PREDICTED)


def trained(docs: DataFrame) -> Network:
    x, labels = training_windows(docs)
    return train(x, labels) if labels else Network([], [], *[np.zeros(0, np.float32)] * 3)


def keep_identified(docs: DataFrame, net: Network | None = None, languages: Collection[str] | None = None, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of docs, with all their columns, whose text is predicted with a score of at least `least`.

    languages: the wanted ones, all learned ones if None. Texts without letters
    go, as do texts that are noise or in another language to the network.
    Without a network, one is trained on docs itself. If none could be trained,
    nothing is known of any text, and all rows stay. Null texts are without
    letters; repeated rows each stay or go; of an empty table nothing is left.
    """
    net = net or trained(docs)
    if not net.languages:
        return docs
    wanted = frozenset(net.languages if languages is None else languages)
    sent = docs.sparkSession.sparkContext.broadcast(net)
    return keep_rows(docs, "text", lambda texts: [lang in wanted and score >= least for lang, score in score_texts(sent.value, None, texts)])


def language_id(docs: DataFrame) -> DataFrame:
    """Train on the labelled rows of docs (doc_id, text, lang) outside the held-out fold, and predict every row.

    Null texts and texts without a letter are `und` with score 0, as is every
    text if no row can be learned from. Rows without a language are predicted
    and not learned from. Repeated rows stay; other columns aren't read; an
    empty table gives an empty result. Every window of a long text is scored,
    some at a time, so memory is a few times the text. Of more than LANGUAGES
    languages those with the fewest texts are not learned, and never predicted.
    """
    return identify(docs, trained(docs))
