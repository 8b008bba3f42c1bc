"""BPE encoding and decoding for tokenizer.json models with word ends.

Encoding a word: an Aho-Corasick automaton reads it once and finds all tokens
in it; the longest at each place is tried first and kept if it may follow the token before it, as
the pair-compatibility table says; else the next shorter, else one step back. A
place that led nowhere is never tried again, so the work is linear in the word.
A row of tokens in which all neighbours are compatible is the merges' result.
Decoding gathers token texts from one buffer through an offset table.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sequoir.llm.common import map_arrow, utf8

#: Stands for the end of a word inside the automaton; no byte has this code.
END = "Ā"
#: White space as the tokenizer's normaliser and pre-tokenizer take it (Unicode White_Space).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Entries and bytes of a generation of seen words; a worker keeps two.
MEMO_ENTRIES, MEMO_BYTES = 300_000, 24 << 20
#: Longer words are not kept.
MEMO_WORD = 256


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


#: Letters and numbers that Unicode got after version 16, whose tables the tokenizers library has.
LATER = {
    "L": "\\u0558 \\u058b-\\u058c \\u088f \\u0c5c \\u0cdc \\u208f \\u209d-\\u209f \\ua7ce-\\ua7cf \\ua7d2 \\ua7d4 \\ua7dd \\ua7e2 \\ua7f1 \\uab6c-\\uab6d "
    "\\U000107bb-\\U000107bf \\U00010940-\\U00010959 \\U00010ec5-\\U00010ec7 \\U00010ed9-\\U00010eee \\U00011b0a \\U00011db0-\\U00011ddb \\U00011df1 "
    "\\U00016ea0-\\U00016eb8 \\U00016ebb-\\U00016ed3 \\U00016ff2-\\U00016ff3 \\U000187f8-\\U000187ff \\U00018cd6-\\U00018cda \\U00018d09-\\U00018d20 "
    "\\U00018d80-\\U00018df2 \\U00018e00-\\U00019191 \\U000191a0-\\U000191d2 \\U0001b123-\\U0001b128 \\U0001b168 \\U0001d6a6 \\U0001df1f-\\U0001df24 "
    "\\U0001df2b-\\U0001df81 \\U0001df90-\\U0001df96 \\U0001dfcd-\\U0001dfff \\U0001e6c0-\\U0001e6de \\U0001e6e0-\\U0001e6e2 \\U0001e6e4-\\U0001e6e5 "
    "\\U0001e6e7-\\U0001e6ed \\U0001e6f0-\\U0001e6f4 \\U0001e6fe-\\U0001e6ff \\U0002b73a-\\U0002b73f \\U0002b81e \\U0002cea2-\\U0002cead "
    "\\U000323b0-\\U00033479 \\U0003d000-\\U0003fc3f",
    "N": "\\U00011de0-\\U00011de9 \\U0001246f \\U00012475-\\U0001247f \\U00012550-\\U00012686 \\U00016ff4-\\U00016ff6",
}
#: Lower case that the library has and Python's tables (15.1) don't.
LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


class Unsupported(ValueError):
    """The file asks for something that this encoder does not have."""


class Model:
    """A tokenizer.json BPE model with end_of_word_suffix, compiled for encoding."""

    def __init__(self, text: bytes) -> None:
        spec = json.loads(text)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or not self.suffix or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("ignore_merges"):
            raise Unsupported("a BPE model with end_of_word_suffix alone is needed")
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise Unsupported(f"normalisers {kinds}")
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if [x["type"] for x in steps] != ["Split", "ByteLevel"] or not steps[0]["invert"] or steps[1]["use_regex"] or steps[1]["add_prefix_space"]:
            raise Unsupported("pre-tokenizers")
        pattern = steps[0]["pattern"]["Regex"].replace(r"\s", SPACE)
        classes = {group: rf"[\p{{{group}}}--[{later.replace(' ', '')}]]" for group, later in LATER.items()}
        for group, own in classes.items():
            pattern = pattern.replace(rf"\p{{{group}}}", own)
        self.words = regex.compile(pattern, regex.V1).findall
        #: The pattern's parts: contractions, and runs of letters, numbers, white space and the rest.
        *short, letters, number, rest = steps[0]["pattern"]["Regex"].split("|")
        if (letters, number, rest) != (r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+") or any(x[0] != "'" or not 2 <= len(x) <= 3 for x in short):
            raise Unsupported("pattern")
        self.contractions = frozenset(short)
        self.letters, self.number, self.spaces, self.rest = (
            regex.compile(x, regex.V1).match for x in (f"[{classes['L']}]+", f"[{classes['N']}]", f"[{SPACE}]+", f"[^{SPACE}{classes['L']}{classes['N']}]+")
        )
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise Unsupported("added tokens")
        self.find_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))).split if self.special else None
        self.special_start = sorted({x[0] for x in self.special})

        letters = byte_letters()
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.size = max(names) + 1
        self._offsets(names)
        self.left, self.right, self.rank = {}, {}, {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ids = model["vocab"][a], model["vocab"][b]
            both = model["vocab"][a + b]
            if both in self.rank:
                raise Unsupported("two merges make one token")
            self.merged[ids], self.rank[both] = both, rank
            self.left[both], self.right[both] = ids
        self.symbols = {}
        for token, i in model["vocab"].items():
            ended = token.endswith(self.suffix)
            body = token.removesuffix(self.suffix) if ended else token
            try:
                key = "".join(chr(letters[c]) for c in body) + END * ended
            except KeyError:
                continue
            if i in self.rank or len(body) == 1:
                self.symbols[key] = i
        self.symbols = {k: i for k, i in self.symbols.items() if self.naive(k) == [i]}  # the others can't come out of the merges
        self.length = {i: len(k) for k, i in self.symbols.items()}
        self.automaton = ahocorasick.Automaton()
        #: For every token the next shorter one that it begins with; -1 if none.
        self.shorter, reach = {}, {"": -1}
        for key in sorted(self.symbols):
            self.automaton.add_word(key, self.symbols[key])
            for n in range(1, len(key) + 1):
                if key[:n] not in reach:
                    reach[key[:n]] = self.symbols.get(key[:n], reach[key[: n - 1]])
            self.shorter[self.symbols[key]] = reach[key[:-1]]
        self.automaton.make_automaton()
        self.bytes_of = [int(i).to_bytes(4, "little") for i in range(self.size)]
        self.fits: dict[tuple[int, int], bool] = {}

    def _offsets(self, names: dict[int, str]) -> None:
        parts = [(names.get(i, "") + " ").encode() for i in range(self.size)]
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        self.buffer = np.frombuffer(b"".join(parts), np.uint8)

    def naive(self, key: str) -> list[int]:
        """Merges one after another, lowest rank first; for compilation and tests."""
        body = key.removesuffix(END)
        parts = [self.symbols[c] for c in body[:-1]] + [self.symbols[body[-1] + END * (key != body)]]
        while len(parts) > 1:
            ranks = [self.rank.get(self.merged.get(p), 1 << 60) for p in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == 1 << 60:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [self.merged[parts[at], parts[at + 1]]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether merges leave the border between tokens a and b alone.

        The two are taken apart at the border, latest merge first. While the
        left piece and the right piece stand side by side, a merge of the two
        must not come before the merge that next takes one of them away.
        """
        known = self.fits.get((a, b))
        if known is not None:
            return known
        none, x, y = -1, a, b
        until = 1 << 60  # the merge that ends this pair, by rank; one at the same rank is to the left or right of it
        left_first = False
        good = True
        while True:
            both = self.merged.get((x, y))
            if both is not None:
                r = self.rank[both]
                if r < until or r == until and left_first:
                    good = False
                    break
            rx, ry = self.rank.get(x, none), self.rank.get(y, none)
            if rx < 0 and ry < 0:
                break
            if rx > ry:  # x was made last; of equal ranks the one to the right, y, was
                until, left_first = rx, False
                x = self.right[x]
            else:
                until, left_first = ry, True
                y = self.left[y]
        if len(self.fits) >= 1 << 20:
            self.fits.clear()
        self.fits[a, b] = good
        return good

    def longest(self, key: str) -> array:
        """The longest token that begins at each place of a word, by one pass of the automaton; -1 if none."""
        best, size = array("i", [-1]) * len(key), self.length
        for end, token in self.automaton.iter(key):  # a later end is a longer token
            best[end - size[token] + 1] = token
        return best

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one pre-token (normalised text)."""
        key = word.encode("utf-8", "surrogatepass").decode("latin-1") + END
        n, size, shorter, fits = len(key), self.length, self.shorter, self.fits
        dead = bytearray(n + 1)  # places from which the rest cannot be encoded
        out: list[int] = []
        longest = self.longest(key)
        at, token = 0, longest[0]
        while True:
            if token >= 0:
                after = at + size[token]
                good = not dead[after]
                if good and out:
                    good = fits.get((out[-1], token))
                    if good is None:
                        good = self.compatible(out[-1], token)
                if good:
                    out.append(token)
                    if after == n:
                        return out
                    at, token = after, longest[after]
                else:
                    token = shorter[token]
            else:
                dead[at] = 1
                if not out:
                    raise ValueError(f"no tokens for {word!r}")
                token = out.pop()
                at -= size[token]
                token = shorter[token]

    def pieces(self, text: str) -> Iterator[str | int]:
        """Pre-tokens of a text in order; special tokens as their ids."""
        if self.find_special is not None and any([c in text for c in self.special_start]):
            parts = self.find_special(text)
            if len(parts) > 1:
                found = regex.findall("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))), text)
                for k, part in enumerate(parts):
                    yield from self.words(normalise(part))
                    if k < len(found):
                        yield self.special[found[k]]
                return
        yield from self.words(normalise(text))

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for x in self.pieces(text):
            if isinstance(x, int):
                out.append(x)
            else:
                out += self.encode_word(x)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Texts of the tokens with a space between them, UTF-8."""
        if not len(ids):
            return b""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        return self.buffer[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])].tobytes()[:-1]


def normalise(text: str) -> str:
    """NFC, then lower case letter by letter (a final sigma is like any other).

    White space is what separates words, so that runs of it needn't be joined.
    """
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower().translate(LOWER)


_models: dict[str, Model] = {}


def model_of(text: bytes) -> Model:
    """The compiled model of a tokenizer.json; each Python worker compiles it once."""
    key = hashlib.sha256(text).hexdigest()
    if key not in _models:
        _models[key] = Model(text)
    return _models[key]


class Memo:
    """What was found for words seen before, bounded in entries and bytes.

    Two generations: when the new one is full it becomes the old one, whose
    words move back into the new one as they are met again.
    """

    def __init__(self, make) -> None:
        self.make, self.seen, self.old, self.bytes = make, {}, {}, 0

    def __call__(self, word):
        """The value of a word that isn't in `seen`."""
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= MEMO_WORD:
            if len(self.seen) >= MEMO_ENTRIES or self.bytes >= MEMO_BYTES:
                self.old, self.seen, self.bytes = self.seen, {}, 0
            self.seen[word] = value
            self.bytes += len(word) + (len(value) if isinstance(value, bytes) else 0)
        return value

    def all(self, words: list) -> list:
        """The values of words, in order."""
        found = list(map(self.seen.get, words))
        if None in found:
            for k, x in enumerate(found):
                if x is None:
                    x = self.seen.get(words[k])
                    found[k] = self(words[k]) if x is None else x
        return found


ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _encoder(model: Model):
    """A function from a whole text (UTF-8) to its ids as little-endian uint32 bytes.

    Pre-tokens never hold white space and neither NFC nor lower case reach
    across it, so words between spaces are encoded on their own.
    """
    if model not in _memos:
        inner = Memo(lambda w: b"".join([model.bytes_of[i] for i in model.encode_word(w)]))
        _memos[model] = Memo(lambda w: b"".join([model.bytes_of[x] if isinstance(x, int) else inner.seen.get(x) or inner(x) for x in model.pieces(w.decode())]))
    memo = _memos[model]
    return lambda text: b"".join(memo.all(text.split()))


_memos: dict[Model, Memo] = {}


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Ids and decoded text of every row of docs (doc_id, text), as digests.

    tokenizer: path of the tokenizer.json, read on the driver and sent to the
    workers (a few MB, whatever the input). Null text is empty: no tokens, and
    the digests of nothing. Repeated rows stay; other columns aren't read; an
    empty table gives an empty result. A long text travels alone; its words and
    ids are lists while it is encoded, about fifteen times the text.
    """
    with open(tokenizer, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(spec.value)
        encode = _encoder(model)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in utf8(batch.column(1)):
                ids = encode(text)
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                digest, array = hashlib.sha256(), np.frombuffer(ids, "<u4").astype(np.int64)
                for at in range(0, len(array), SLAB):
                    digest.update((b" " if at else b"") + model.decode(array[at : at + SLAB]))
                text_sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(docs.select("doc_id", "text"), run, ENCODED)


#: Tokens that are decoded at a time.
SLAB = 1 << 18


def encode_ids(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (array of int) of every row of docs (doc_id, text)."""
    with open(tokenizer, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(model_of(spec.value))
        for batch in batches:
            ids = [np.frombuffer(encode(x), "<u4").astype(np.int32) for x in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode_ids(rows: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, text of every row of rows (doc_id, ids); null ids give an empty text."""
    with open(tokenizer, "rb") as f:
        spec = rows.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(spec.value)
        for batch in batches:
            texts = [model.decode(np.array(x or [], np.int64)).decode("utf-8") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_arrow(rows.select("doc_id", "ids"), run, "doc_id long, text string")
