import random

import pytest

from sequoir.functions import circles as C
from tests.test_plans import make


def letters(n, seed, of="ACGT"):
    return "".join(random.Random(seed).choices(of, k=n))


def slow_border(s, least):
    return next((k for k in range(len(s) // 2, least - 1, -1) if s[:k] == s[-k:]), 0)


@pytest.mark.parametrize("n", [20, 21, 500, 2000, 2001, 2500, 50_000])
def test_repeats_of_any_length(n):
    unit = letters(n, n)
    assert C.border(unit + "T" * 50 + unit) == n
    assert C.border(unit + letters(77, 1) + unit[:-1] + ("A" if unit[-1] != "A" else "C")) == 0


def test_borders_against_a_loop():
    r = random.Random(4)
    for _ in range(2000):
        s = letters(r.randint(0, 60), r.random(), r.choice(["A", "AC", "ACGT", "aé"]))
        least = r.randint(1, 6)
        assert C.border(s, least) == slow_border(s, least), s
    for s in ["A" * 3001, "A" * 3000 + "T", "AC" * 1500, "A" * 1000 + "C" + "A" * 1000, ("A" * 99 + "C") * 30 + "A" * 99]:
        assert C.border(s) == slow_border(s, 20)


def test_long_sequences_take_linear_time():
    for s in ["A" * 3_000_000, "A" * 1_500_000 + "C" + "A" * 1_500_000, letters(3_000_000, 2)]:
        assert C.border(s) == (0 if s[:9] != "A" * 9 else 1_500_000)
        assert len(C.least_rotation(s.encode())) == len(s)


def test_rotations_against_all():
    r = random.Random(5)
    for _ in range(3000):
        s = letters(r.randint(1, 40), r.random(), r.choice(["A", "AC", "ACGT"])) * r.choice([1, 1, 2, 3])
        assert C.least_rotation(s.encode()) == min((s[i:] + s[:i]).encode() for i in range(len(s))), s
    for s in ["A" * 200 + "T", "T" + "A" * 200, "AAT" * 60 + "A", "ACACACAG" * 9 + "ACAC", "AB" * 31 + "A", ("A" * 7 + "C") * 8 + "A" * 5]:
        assert C.least_rotation(s.encode()) == min((s[i:] + s[:i]).encode() for i in range(len(s))), s


def test_circles_of_the_same_parts_differ(spark):
    r, a, b, c = (letters(40, k) for k in range(4))
    first, second = r + a + r + b + r + c, r + b + r + a + r + c
    back = first[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [("first", first), ("second", second), ("turned", first[55:] + first[:55]), ("back", back), ("small", first.lower()), ("none", None), ("empty", "")]
    got = dict(make(spark, "id string, s string", *rows).select("id", C.canonical_circular_hash("s").alias("h")).collect())
    assert got["first"] == got["turned"] == got["back"] == got["small"] != got["second"]
    assert got["none"] is None and got["empty"] is None
    n = dict(make(spark, "id string, s string", *rows, ("long", r * 900 + a + r * 900)).select("id", C.terminal_repeat("s").alias("n")).collect())
    assert n["long"] == 36_000 and n["none"] == n["empty"] == 0
