import random

import xxhash

from sequoir.llm import simhash as S
from tests.llm.cases import frame, prose, rows, texts


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """(id, fingerprint) pairs to the smallest id that each reaches."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= S.RADIUS:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(prints):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [least.get(find(i)) for i in range(len(prints))]


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(S, "SLAB", 7)
    for text in [*texts(), "One", "one  TWO", "a b c", "a b c d", prose(50, 8)]:
        assert S.fingerprint((text or "").encode()) == slow_print((text or "")[:40_000] if text and len(text) > 400_000 else text) or len(text) > 400_000


def test_jvm_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([("a b c",)], "s string").select(F.xxhash64("s").alias("h")).first()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", 42)


def chained(seed, n):
    r, out = random.Random(seed), []
    for _ in range(n):
        mark = r.getrandbits(64)
        for _ in range(r.randint(1, 9)):
            out.append(mark)
            for bit in r.sample(range(64), r.randint(0, 3)):
                mark ^= 1 << bit
    r.shuffle(out)
    return out


def test_links_and_components_against_all_pairs(spark):
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    marks = chained(9, 60)
    df = spark.createDataFrame([(signed(m),) for m in marks], "fp long").distinct()
    named = {r.node: r.root for r in S.components(S.ball_links(df)).collect()}
    distinct = sorted(set(marks), key=signed)
    want = slow_components([(signed(m), m) for m in distinct])
    assert [named.get(signed(m), signed(m)) for m in distinct] == want


def test_long_chains_settle(spark):
    data = [(k, k + 1) for k in range(300)] + [(1000, 999)] + [(2000, 2000 + k) for k in range(1, 200)] + [(5, 5)]
    named = {r.node: r.root for r in S.components(spark.createDataFrame(data, "src long, dst long")).collect()}
    assert all(named[k] == 0 for k in range(301)) and named[1000] == 999 and all(named[2000 + k] == 2000 for k in range(200))
    assert S.components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_rows(spark):
    found = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(frame(spark)).collect()), key=str)
    prints = [(k, S.fingerprint((t or "").encode())) for k, t, *_ in rows()]
    want = sorted(((k, f"{p:016x}", c) for (k, p), c in zip(prints, slow_components(prints), strict=True)), key=str)
    assert found == want
    assert S.near_duplicates(frame(spark, [])).count() == 0


def test_representatives(spark):
    docs = frame(spark)
    kept = S.representatives(docs)
    assert kept.schema == docs.schema
    prints = [(k, S.fingerprint((t or "").encode())) for k, t, *_ in rows()]
    groups = slow_components(prints)
    assert kept.count() == len({g if g is not None else p for g, (_, p) in zip(groups, prints, strict=True)})
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == {g for g in groups if g is not None}
    assert S.representatives(frame(spark, [])).count() == 0


def test_columns_of_any_name_pass_through(spark):
    from pyspark.sql import functions as F

    docs = frame(spark).withColumns({x: F.lit(k) for k, x in enumerate([*S.OWN, S.OWN[-1] + "_", "node", "root", "first", "id"])})
    kept = S.representatives(docs)
    assert kept.columns == docs.columns and kept.count() == S.representatives(frame(spark)).count()
