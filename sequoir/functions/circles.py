"""Repeats at a sequence's ends, and one identity for all forms of a circle.

Both run in numpy, in time and memory in proportion to a sequence's length, as
Pandas UDFs whose batches are bounded in bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from sequoir.functions.exprs import col

#: Most bytes of a batch of sequences that goes to Python; a longer one goes alone.
BATCH_BYTES = 8 << 20
#: Places that are compared letter by letter before whole sums are made.
FEW = 64
#: A prime under 2**31 and two bases, for sums of letters times powers.
PRIME, BASES = (1 << 31) - 1, (1_000_003, 1_640_531_527)
COMPLEMENT = bytes.maketrans(b"ACGT", b"TGCA")


def _bounded() -> None:
    session = SparkSession.getActiveSession()
    if session is not None:
        session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _sums(s: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and the sums of letters times powers up to each place, modulo PRIME."""
    n, power = len(s), np.ones(1, np.uint64)
    while len(power) < n + 1:
        step = np.uint64(int(power[-1]) * base % PRIME)
        power = np.concatenate([power, power * step % np.uint64(PRIME)])
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(s.astype(np.uint64) * power[:n] % np.uint64(PRIME), out=total[1:])
    return power[: n + 1], total % np.uint64(PRIME)


def border(seq: str, least: int = 20) -> int:
    """The longest k from `least` to half the length for which the first k letters are the last k too; 0 if none."""
    s = np.frombuffer(seq.encode(), np.uint8) if seq.isascii() else np.frombuffer(seq.encode("utf-32-le"), np.uint32)
    n = len(s)
    if n < 2 * least or least < 1:
        return 0
    k = np.arange(n // 2, least - 1, -1)
    for i in range(min(8, least)):  # a repeat of k letters begins at n - k like the sequence itself
        k = k[s[n - k + i] == s[i]]
    if len(k) > FEW:
        for base in BASES:
            power, total = _sums(s, base)
            ending = (total[n] + np.uint64(PRIME) - total[n - k]) % np.uint64(PRIME)
            k = k[ending == total[k] * power[n - k] % np.uint64(PRIME)]
    return next((int(x) for x in k if np.array_equal(s[:x], s[n - x :])), 0)


def least_rotation(s: bytes) -> bytes:
    """The smallest of all rotations.

    Places that begin with the smallest letters of a length are kept and the length
    is doubled until one is left. Of places that follow each other within half
    the length the text repeats itself; the smallest rotation begins at the
    first or the last of such a chain, so few stay.
    """
    n = len(s)
    if n < 2:
        return s
    twice = np.frombuffer(s + s, np.uint8)
    length = 1
    places = np.flatnonzero(twice[:n] == twice[:n].min())
    while len(places) > 1 and length < n:
        near = np.diff(places) <= length // 2
        inner = np.zeros(len(places), bool)
        inner[1:-1] = near[:-1] & near[1:]
        places = places[~inner]
        step = min(length, n - length)
        rows = np.lib.stride_tricks.sliding_window_view(twice, step)[(places + length) % n]
        texts = np.ascontiguousarray(rows).view(f"V{step}").ravel().tolist()
        best = min(texts)
        places = places[[x == best for x in texts]]
        length += step
    at = int(places[0])
    return s[at:] + s[:at]


def circle(seq: str) -> str:
    """The smallest rotation of a circular DNA sequence or its reverse complement, in capitals."""
    s = seq.upper().encode()
    return min(least_rotation(s), least_rotation(s.translate(COMPLEMENT)[::-1])).decode()


def terminal_repeat(seq: Column | str, least: int = 20) -> Column:
    """Length of the longest direct terminal repeat: a beginning that is also the end and covers half at most, of any length; 0 if none or null."""
    _bounded()

    @F.pandas_udf("int")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([0 if x is None else border(x, least) for x in column], dtype="int32")

    return run(col(seq))


def canonical_circular_hash(seq: Column | str) -> Column:
    """One hash for all rotations and both strands of a circular sequence, and for no other: MD5 of the smallest of them; null for none or empty."""
    _bounded()

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([hashlib.md5(circle(x).encode()).hexdigest() if x else None for x in column], dtype=object)

    return run(col(seq))
