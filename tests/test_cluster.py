"""Edges from sequences, and a release's new genomes against those that are there."""

import random

from pyspark.sql import functions as F

from sequoir.operators import graph
from sequoir.plans import cluster
from tests.test_plans import make

LETTERS = "ACGT"


def genomes(n, seed):
    """Families of genomes that differ in some letters, in an order of their own."""
    r = random.Random(seed)
    out = []
    for f in range(n // 5):
        base = "".join(r.choices(LETTERS, k=400))
        out += [(f"g{f:02d}-{k}", "".join(r.choice(LETTERS) if r.random() < 0.009 * k else x for x in base)) for k in range(5)]
    r.shuffle(out)
    return out


def slow_edges(data, k, least_shared, least):
    sets = [(i, {s[j : j + k] for j in range(len(s) - k + 1)}) for i, s in sorted(data)]
    out = {}
    for n, (j, y) in enumerate(sets):
        for i, x in sets[:n]:
            both, size = len(x & y), min(len(x), len(y))
            if both >= least_shared and both / size >= least:
                out[i, j] = both / size
    return out


def partition(clusters):
    groups = {}
    for r in clusters.collect():
        groups.setdefault(r.cluster_id, set()).add(r.member)
    return {frozenset(g) for g in groups.values()}


def test_edges_have_all_kmers(spark):
    data = genomes(40, 1)
    got = {(r.src, r.dst): r.w for r in cluster.kmer_edges(make(spark, "id string, seq string", *data), 15, 20, 0.6).collect()}
    want = slow_edges(data, 15, 20, 0.6)
    assert got == want and 20 < len(want) < 80, len(want)


def test_a_sample_of_kmers_has_the_error_that_it_states(spark):
    data = genomes(60, 2)
    exact = slow_edges(data, 15, 1, 0.0)
    rough = {(r.src, r.dst): r.w for r in cluster.kmer_edges(make(spark, "id string, seq string", *data), 15, 1, 0.3, fraction=4).collect()}
    off = [(w - exact[p]) / (exact[p] * (1 - exact[p]) * 4 / 386) ** 0.5 for p, w in rough.items() if 0.4 < exact[p] < 0.99]
    # k-mers over one letter come and go together, so the error is up to sqrt(15) times that of lone ones
    assert len(off) > 50 and sum(abs(x) < 2 * 15**0.5 for x in off) > 0.95 * len(off)


def test_new_against_all(spark, tmp_path):
    """Three releases: edges and clusters are those of everything at once, and nothing that is stored is moved."""
    data, k, least = genomes(60, 3), 15, 0.6
    parts = [data[:30], data[30:50], data[50:]]
    store = cluster.kmer_store(spark, str(tmp_path / "kmers"), 8)
    edges = clusters = None
    for part in parts:
        new = make(spark, "id string, seq string", *part)
        found = cluster.against_store(new, store, k, 20, least)
        plan = found._jdf.queryExecution().executedPlan().toString()
        scan = next(i for i, x in enumerate(plan.splitlines()) if "kmers" in x and "Scan parquet" in x)
        above = plan.splitlines()[scan - 4 : scan]
        assert not any("Exchange" in x for x in above), above
        fresh = graph.settled(found, "edges")
        clusters = graph.markov_clusters(fresh) if edges is None else cluster.extended(clusters, edges, fresh)
        clusters = graph.settled(clusters, "clusters")
        edges = graph.settled(fresh if edges is None else edges.unionByName(fresh), "edges")
        cluster.add_to_store(new, store, k)
    want = slow_edges(data, k, 20, least)
    assert {tuple(sorted((r.src, r.dst))): r.w for r in edges.collect()} == want
    every = make(spark, "src string, dst string, w double", *((a, b, w) for (a, b), w in want.items()))
    assert partition(clusters) == partition(graph.markov_clusters(every))
    assert clusters.count() == clusters.select("member").distinct().count()
    files = list((tmp_path / "kmers").glob("part-*"))
    assert len(files) <= 3 * 8 and spark.table(store).select("id").distinct().count() == 60
    # what few new genomes touch is little
    assert clusters.agg(F.count_distinct("cluster_id")).first()[0] == len(partition(clusters))
