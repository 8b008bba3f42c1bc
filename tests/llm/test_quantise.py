import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from sequoir.llm import quantise

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, part int, of string"


def frame(spark, data, kind="float"):
    return spark.createDataFrame([(i, v, k, "c", "e", 1, "o") for i, v, k in data], SCHEMA.replace("array<float>", f"array<{kind}>"))


def slow(data, rounds=2, parts=16, entries=64):
    """The same with whole numbers of any size, everything computed anew in every round."""
    kept = [(i, [math.floor(256 * x) for x in v], k) for i, v, k in data if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    kept = [(i, [(v + [0] * (parts * width))[p * width : (p + 1) * width] for p in range(parts)], k) for i, v, k in kept]
    seeds = sorted((x for x in kept), key=lambda x: (x[0] is None, x[0] or 0, x[1]))[:entries]
    books = [[list(s[1][p]) for s in seeds] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[p], e, strict=True)), j) for j, e in enumerate(books[p])) for p in range(parts)] for _, v, _ in kept]

    for _ in range(rounds):
        at = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [v[p] for (_, v, _), a in zip(kept, at, strict=True) if a[p][1] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    at = assign()
    errors = [sum(d for d, _ in a) for a in at]
    labels = Counter()
    for (_, _, k), e in zip(kept, errors, strict=True):
        labels[k] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most = (1 << 63) - 1
    return Counter((i, "".join(f"{j:02x}" for _, j in a), min(e, most), min(labels[k], most), digest) for (i, _, k), a, e in zip(kept, at, errors, strict=True))


def found(df, **more):
    return Counter(tuple(r) for r in quantise.quantise(df, **more).collect())


def made(n, dims, seed, scale=1.0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(9, dims))
    return [(k, (scale * (centres[k % 9] + 0.3 * r.normal(size=dims))).astype(np.float32).tolist(), k % 5 if k % 7 else None) for k in range(n)]


@pytest.mark.parametrize("rounds", [0, 1, 2, 5])
def test_against_everything_anew(spark, rounds):
    data = made(400, 32, rounds)
    assert found(frame(spark, data).repartition(5), rounds=rounds) == slow(data, rounds)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = made(150, 32, 9) + made(10, 32, 9)  # repeated rows and ids
    data += [(500, None, 1), (501, [nan] * 32, 1), (502, [0.0] * 31 + [inf], 1), (503, [None] + [0.0] * 31, 1), (None, [0.5] * 32, 2), (None, [0.25] * 32, None)]
    data += [(504, [], None), (505, [1.0] * 5, 3), (506, [-0.001, 0.0] * 20, 3), (-7, [0.0] * 32, 3)]
    assert found(frame(spark, data)) == slow(data)


def test_ties_go_to_the_lower_entry(spark):
    data = [(k, [float(k % 3)] * 16, 0) for k in range(70)]
    assert found(frame(spark, data)) == slow(data)


def test_large_components(spark):
    data = made(80, 16, 3, 1e4) + [(1000 + k, [(-1) ** k * 3e38 / (k + 1)] * 16, 1) for k in range(6)] + [(2000, [1e12] * 16, 2)]
    data = [(i, np.array(v, np.float32).astype(float).tolist(), k) for i, v, k in data]
    assert found(frame(spark, data)) == slow(data)


def test_few_and_no_rows(spark):
    assert found(frame(spark, [])) == Counter()
    assert found(frame(spark, [(1, None, 1)])) == Counter()
    data = [(3, [0.1] * 16, None), (2, [0.7] * 16, None)]
    assert found(frame(spark, data)) == slow(data)


def test_shuffled_labels_give_the_same(spark, monkeypatch):
    data = made(100, 16, 4)
    monkeypatch.setattr(quantise, "SENT_LABELS", -1)
    assert found(frame(spark, data)) == slow(data)


def test_later_rounds_move_only_what_changed(spark):
    """Contributions come from changed parts alone, and add up to what all parts give."""
    r = random.Random(1)
    data = [(k, [r.random() for _ in range(16)], 0) for k in range(300)]
    state = quantise.scaled(frame(spark, data))
    books = quantise.Codebooks([x.ints for x in state.orderBy("vec_id").limit(64).collect()], 1)
    one = quantise.materialise(quantise.assigned(state, books.books, 1))
    books.add(quantise.changes(one, 1).collect())
    two = quantise.materialise(quantise.assigned(one, books.books, 1))
    rows = two.collect()
    moved = sum(a != b for x in rows for a, b in zip(x.code, x.old, strict=True))
    deltas = quantise.changes(two, 1).collect()
    assert 0 < sum(d.amount for d in deltas if d.place == -1 and d.amount > 0) <= moved < 300 * 16
    assert sum(d.amount for d in deltas if d.place == -1) == 0
    books.add(deltas)
    for p in range(16):
        for e in range(64):
            mine = [int(x.ints[p]) for x in rows if x.code[p] == e]
            assert (books.sums.get((p, e, -1), 0), books.sums.get((p, e, 0), 0)) == (len(mine), sum(mine))
