"""Token counts by a compiled finite-state transducer.

Reading a word symbol by symbol, a state knows the longest suffix that may
still grow into a token and, for each place in it where a token may start, the
last token of what precedes it and how many tokens that took. Tokens have a
greatest length, so the states are finitely many; a transition's annotation is
by how many tokens the prefix's encoding grew, and the annotations along a word
add up to its token count. States and transitions are compiled when first met.
Around it, a small automaton cuts a text into words: it is between words, in a
run of letters or of other characters, or after an apostrophe.

A text is cut into chunks, at places that normalisation doesn't reach across.
White space sends every state back to the start, so what a chunk does to any
state is: to read on up to its first space, to add a constant count, and to end
in a constant state. A chunk without a space only reads on. These maps of
states compose associatively and hold no text but its place, so they are
reduced and scanned as a tree, in memory that grows with the number of chunks.
A table of words that were seen before stands in front of the transducer.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from sequoir.llm.bpe import END, Memo, Model, model_of, normalise
from sequoir.llm.common import WORD_SPACE, map_arrow, utf8

CHUNK_BYTES = 64 << 10
#: Compiled states that a worker keeps; beyond it, it compiles anew.
MAX_STATES = 200_000
START = ("", ((-1, 0),))


class Transducer:
    """Deterministic transducer of a BPE model over the bytes of a word and its end."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.open = {k[:n] for k in model.symbols for n in range(len(k))}  # what may still grow into a token
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, int] = {START: 0}
        self.names = [START]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def compile(self, state: int, symbol: str) -> tuple[int, int]:
        """The transition of a state for a symbol: next state (0 after END) and tokens added."""
        suffix, places = self.names[state]
        text, before = suffix + symbol, places[-1][1]
        for at in range(len(text)):
            token = self.model.symbols.get(text[at:])
            if token is not None and places[at] is not None and (places[at][0] < 0 or self.model.compatible(places[at][0], token)):
                count = places[at][1] + 1
                break
        else:
            raise ValueError(f"no token ends {text!r}")
        if symbol == END:
            move = 0, count - before
        else:
            start = next(k for k in range(len(text) + 1) if text[k:] in self.open)
            kept = [*places, (token, count)][start:]
            rest = text[start:]
            name = rest, tuple((x[0], x[1] - count) if x is not None and rest[k:] in self.open else None for k, x in enumerate(kept))
            if (then := self.states.get(name)) is None:
                then = self.states[name] = len(self.names)
                self.names.append(name)
                self.moves.append({})
            move = then, count - before
        self.moves[state][symbol] = move
        return move

    def feed(self, name: tuple, symbols: str) -> tuple[tuple, int]:
        """The state, by name, after symbols (and 0 after END), and the tokens that they added."""
        if len(self.names) > MAX_STATES:
            self.reset()
        state = self.states.get(name)
        if state is None:
            state = self.states[name] = len(self.names)
            self.names.append(name)
            self.moves.append({})
        total, moves = 0, self.moves
        for symbol in symbols:
            move = moves[state].get(symbol)
            state, added = move if move is not None else self.compile(state, symbol)
            total += added
        return self.names[state], total

    def run(self, word: str) -> int:
        """Tokens of a pre-token (normalised text)."""
        return self.feed(START, word.encode().decode("latin-1") + END)[1]


class State(NamedTuple):
    """Where reading stands: between words, in a run of letters or of the rest (kind) with a state of the transducer, or after an apostrophe."""

    kind: str = ""
    name: tuple = START
    open: str = ""  # an apostrophe and what may still make a contraction with it


BETWEEN = State()
APOSTROPHE = "'"


class Reader:
    """Reads normalised text from any state, word boundaries included."""

    def __init__(self, model: Model) -> None:
        self.model, self.machine = model, Transducer(model)
        self.runs = {"letters": model.letters, "rest": model.rest}
        self.beginnings = {x[:n] for x in model.contractions for n in range(1, len(x))}

    def feed(self, name: tuple, text: str) -> tuple[tuple, int]:
        return self.machine.feed(name, text.encode().decode("latin-1"))

    def close(self, state: State) -> int:
        """Tokens that the end of a word adds."""
        if state.open:
            return sum(map(self.machine.run, (APOSTROPHE, state.open[1:]) if len(state.open) > 1 else (APOSTROPHE,)))
        return self.machine.feed(state.name, END)[1] if state.kind else 0

    def read(self, state: State, text: str) -> tuple[State, int]:
        at, total, model = 0, 0, self.model
        while at < len(text):
            if state.kind:
                if run := self.runs[state.kind](text, at):
                    name, added = self.feed(state.name, run[0])
                    state, total, at = State(state.kind, name), total + added, run.end()
                else:
                    state, total = BETWEEN, total + self.close(state)
            elif state.open:
                longer = state.open + text[at]
                if longer in model.contractions:
                    state, total, at = BETWEEN, total + self.machine.run(longer), at + 1
                elif longer in self.beginnings:
                    state, at = State(open=longer), at + 1
                elif len(state.open) == 1:
                    state = State("rest", self.feed(START, APOSTROPHE)[0])
                    total += self.feed(START, APOSTROPHE)[1]
                else:
                    name, added = self.feed(START, state.open[1:])
                    state, total = State("letters", name), total + self.machine.run(APOSTROPHE) + added
            elif text[at] == APOSTROPHE:
                state, at = State(open=APOSTROPHE), at + 1
            elif run := model.spaces(text, at):
                at = run.end()
            elif model.number(text, at):
                total, at = total + self.machine.run(text[at]), at + 1
            else:
                state = State("letters" if model.letters(text, at) else "rest")
        return state, total


class ChunkMap(NamedTuple):
    """What a chunk does to any state: reads from start to stop, adds count and ends in out.

    Without white space it only reads: count and out are None.
    """

    start: int
    stop: int
    count: int | None = None
    out: State | None = None


def _joins(c: str) -> bool:
    """Whether normalisation may change a character with what stands before it."""
    return unicodedata.category(c)[0] == "M" or "\u1160" <= c <= "\u11ff" or "\U00016d63" <= c <= "\U00016d6a"


def cuts(data: bytes, size: int) -> list[int]:
    """Ends of chunks of about `size` bytes, none of which parts what belongs together."""
    ends, at = [], size
    while at < len(data):
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at += 1
        while at < len(data) and data[at] > 127:
            width = 2 + (data[at] >= 0xE0) + (data[at] >= 0xF0)
            if not _joins(data[at : at + width].decode()):
                break
            at += width
        if at < len(data):
            ends.append(at)
        at += size
    return [*ends, len(data)]


class Chunks:
    """The chunks of a text without special tokens, and how their maps compose."""

    def __init__(self, data: bytes, reader: Reader, count: Callable[[list[bytes]], int], size: int | None = None) -> None:
        self.data, self.reader, self.count = data, reader, count
        self.ends = cuts(data, size or CHUNK_BYTES)
        self.maps = list(map(self.of, [0, *self.ends], self.ends))

    def of(self, start: int, stop: int) -> ChunkMap:
        first, last = _space(self.data, start, stop), _last_space(self.data, start, stop)
        if first is None or last is None:
            return ChunkMap(start, stop)
        out, added = self.reader.read(BETWEEN, normalise(self.data[last + 1 : stop].decode()))
        return ChunkMap(start, first, self.count(self.data[first:last].split()) + added, out)

    def apply(self, m: ChunkMap, state: State) -> tuple[State, int]:
        """The state after a map, and the tokens added."""
        total, at = 0, m.start
        while at < m.stop:  # a chunk at a time
            end = min(m.stop, self.ends[bisect_right(self.ends, at)])
            state, added = self.reader.read(state, normalise(self.data[at:end].decode()))
            total, at = total + added, end
        return (state, total) if m.count is None else (m.out, total + self.reader.close(state) + m.count)

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        """First a, then b, its neighbour."""
        if a.count is None:
            return ChunkMap(a.start, b.stop, b.count, b.out)
        out, added = self.apply(b, a.out)
        return ChunkMap(a.start, a.stop, a.count + added, out)

    def sweep(self) -> list[list[ChunkMap]]:
        """The scan's way up: at every level, neighbours composed, in independent steps; the last level has the whole."""
        levels = [self.maps]
        while len(levels[-1]) > 1:
            own = levels[-1]
            levels.append([self.compose(*own[k : k + 2]) if k + 1 < len(own) else own[k] for k in range(0, len(own), 2)])
        return levels

    def total(self) -> int:
        state, added = self.apply(self.sweep()[-1][0], BETWEEN)
        return added + self.reader.close(state)

    def scan(self) -> list[tuple[State, int]]:
        """State and tokens at the end of every chunk: the way down again, from what precedes each node."""
        levels = self.sweep()
        before = [(BETWEEN, 0)]
        for own in reversed(levels[:-1]):
            down = []
            for k, m in enumerate(own):
                if k % 2:
                    state, added = self.apply(own[k - 1], before[k // 2][0])
                    down.append((state, before[k // 2][1] + added))
                else:
                    down.append(before[k // 2])
            before = down
        found = []
        for m, (state, total) in zip(self.maps, before, strict=True):
            state, added = self.apply(m, state)
            found.append((state, total + added))
        return found


_SPACES = re.compile(rb"[\x20\x09-\x0D]")


def _space(data: bytes, start: int, stop: int) -> int | None:
    m = _SPACES.search(data, start, stop)
    return m and m.start()


def _last_space(data: bytes, start: int, stop: int) -> int | None:
    at = max(data.rfind(bytes([c]), start, stop) for c in WORD_SPACE)
    return None if at < 0 else at


def counter(model: Model) -> Callable[[bytes], int]:
    """A function from a whole text (UTF-8) to its number of tokens."""
    if model not in _counters:
        reader = Reader(model)
        inner = Memo(reader.machine.run)
        _counters[model] = reader, Memo(lambda w: sum([inner.seen.get(x) or inner(x) for x in model.words(normalise(w.decode()))]))
    reader, memo = _counters[model]
    marks = sorted((x.encode() for x in model.special), key=len, reverse=True)
    special = re.compile(b"|".join(map(re.escape, marks))) if marks else None
    begin = {x[:1] for x in marks}

    def count(words: list[bytes]) -> int:
        return sum(memo.all(words))

    def whole(text: bytes) -> int:
        parts = special.split(text) if special and any(x in text for x in begin) else [text]
        return len(parts) - 1 + sum(Chunks(x, reader, count).total() for x in parts if x)

    return whole


_counters: dict[Model, tuple[Reader, Memo]] = {}
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row of docs (doc_id, text).

    tokenizer: path of the tokenizer.json, read on the driver and sent to the
    workers (a few MB, whatever the input). Null and empty texts have no bytes
    and no tokens. A text of any length, also without a space, takes memory in
    proportion to its length. Repeated rows stay; other columns aren't read; an
    empty table gives an empty result.
    """
    with open(tokenizer, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_of(spec.value))
        for batch in batches:
            texts = utf8(batch.column(1))
            tokens = [count(x) for x in texts]
            columns = [batch.column(0).cast(pa.int64()), pa.array(map(len, texts), pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_arrow(docs.select("doc_id", "text"), run, COUNTS)
