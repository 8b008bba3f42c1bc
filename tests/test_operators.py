import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sequoir.operators import dataflow, dedup, graph, intervals, rank, similarity, vote

FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_top1_orders_nulls_and_ties(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", None, "y"), ("b", 2.0, "q"), ("b", 2.0, "p"), (None, 1.0, "n")], "k string, v double, id string")
    assert rows(rank.top1(df, ["k"], [F.col("v").desc_nulls_first()], ["id"]).select("k", "id")) == rows(spark.createDataFrame([("a", "y"), ("b", "p"), (None, "n")], "k string, id string"))


def test_numbers_have_no_gaps(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")).repartition(13)
    out = rank.numbered(df, ["x"], "n", 11).orderBy("x").collect()
    assert [r.n for r in out] == list(range(11, 1011))
    assert rank.numbered(df.limit(0), ["x"], "n").count() == 0
    dealt = rank.batches(df, ["x"], 64).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in dealt] == [64] * 15 + [40]


@FEW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["x", "y", "z", None])), max_size=30))
def test_consensus(spark, votes):
    df = spark.createDataFrame(votes, "t string, l string")
    got = {r.t: r for r in vote.consensus(df, "t", "l", 0.0).collect()}
    for t in {v[0] for v in votes}:
        own = [l for k, l in votes if k == t]
        best = min(set(own), key=lambda l: (-own.count(l), l is None, l or ""))
        assert (got[t].total_connections, got[t].max_connections, got[t].top_label) == (len(own), own.count(best), best)


def test_consensus_threshold_is_closed(spark):
    df = spark.createDataFrame([("a", "x")] * 7 + [("a", "y")] * 3 + [("b", "x")] * 2 + [("b", "y")], "t string, l string")
    assert [r.t for r in vote.consensus(df, "t", "l", 0.7).collect()] == ["a"]


@FEW
@given(st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["h1", "h2", "h3", None])), max_size=20), st.lists(st.tuples(st.integers(20, 29), st.sampled_from(["h1", "h4"])), max_size=5))
def test_ledger_is_idempotent(spark, new, old):
    n, o = (spark.createDataFrame([(f"s{i}", h) for i, h in x], "id string, hash string") for x in (new, old))
    fresh, ledger = dedup.ledger_update(n, o, "hash", ["id"])
    hashes = [r.hash for r in fresh.collect()]
    assert sorted(hashes) == sorted({h for _, h in new if h} - {h for _, h in old})
    assert dedup.ledger_update(n, ledger, "hash", ["id"])[0].count() == 0
    assert ledger.count() == len(new) + len(old)


@FEW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.integers(0, 25)), max_size=12), st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.integers(0, 25)), max_size=12), st.sampled_from([1, 7, 100]))
def test_overlap_join_against_all_pairs(spark, left, right, width):
    a = spark.createDataFrame([(i, k, s, s + n) for i, (k, s, n) in enumerate(left)], "i int, k string, start long, end long")
    b = spark.createDataFrame([(j, k, s, s + n) for j, (k, s, n) in enumerate(right)], "j int, k string, block_start long, block_end long")
    got = rows(intervals.overlap_join(a, b, ["k"], width).select("i", "j"))
    want = [(i, j) for i, (k, s, n) in enumerate(left) for j, (q, t, m) in enumerate(right) if k == q and s <= t + m and t <= s + n]
    assert got == sorted(want, key=str)


@FEW
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 9)), max_size=15))
def test_covered_length(spark, spans):
    df = spark.createDataFrame([("q", s, s + n) for s, n in spans], "k string, s long, e long")
    got = [r.covered for r in intervals.covered(df, ["k"], "s", "e").collect()]
    assert got == ([len({p for s, n in spans for p in range(s, s + n)})] if spans else [])


def merged_one_by_one(spans):
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e), out[-1][2] + 1)
        else:
            out.append((s, e, 1))
    return out


@pytest.mark.parametrize(("parts", "longest"), [(1, 5), (7, 5), (7, 400), (40, 3), (40, 5000)])
def test_islands_over_ranges(spark, parts, longest):
    """One key has most intervals, which ranges cut anywhere; some reach over many ranges."""
    r = random.Random(parts * longest)
    data = [(r.choice(["hot"] * 9 + ["a", None]), r.randint(0, 3000)) for _ in range(600)]
    data = [(k, s, s + (r.randint(0, longest) if r.random() < 0.1 else 1)) for k, s in data] + [("hot", None, 5), ("hot", 5, None), (None, None, None)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = intervals.islands(spark.createDataFrame(data, "k string, s long, e long"), ["k"], "s", "e").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = [(k, *x) for k in ("hot", "a", None) for x in merged_one_by_one([(s, e) for q, s, e in data if q == k and s is not None and e is not None])]
    assert sorted(((r.k, r.island_start, r.island_end, r.n) for r in found), key=str) == sorted(want, key=str)


def test_islands_of_one_key_use_all_ranges(spark):
    n = 200_000
    df = spark.range(n).select(F.lit("q").alias("k"), (F.col("id") * 3).alias("s"), (F.col("id") * 3 + F.when(F.col("id") % 1000 < 999, 3).otherwise(1)).alias("e"))
    found = intervals.islands(df, ["k"], "s", "e")
    assert found.count() == n // 1000 and found.agg(F.sum("n")).first()[0] == n
    sizes = df.repartitionByRange(4, "k", "s", "e").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < n / 3


@FEW
@given(st.lists(st.lists(st.integers(0, 30), max_size=14), max_size=8), st.lists(st.lists(st.integers(0, 30), max_size=14), max_size=8), st.integers(1, 4), st.sampled_from([0.0, 0.2, 0.5, 0.8, 1.0]))
def test_containment_against_all_pairs(spark, left, right, least_shared, least):
    make = lambda side: spark.createDataFrame([(k, [str(x) for x in g]) for k, g in enumerate(side)], "id int, g array<string>")
    got = rows(similarity.containment(make(left).withColumnRenamed("id", "q"), make(right).withColumnRenamed("id", "t"), "q", "t", "g", least_shared, least))
    want = []
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            n, both = min(len(set(x)), len(set(y))), len(set(x) & set(y))
            if n and both >= least_shared and both / n >= least:
                want.append((i, j, both, both / n))
    assert got == sorted(want, key=str)


@FEW
@given(st.lists(st.lists(st.integers(0, 30), max_size=14), max_size=12), st.integers(1, 4), st.sampled_from([0.0, 0.2, 0.5, 0.8, 1.0]))
def test_pairs_within_one_table(spark, sets, least_shared, least):
    df = spark.createDataFrame([(k, [str(x) for x in g]) for k, g in enumerate(sets)], "id int, g array<string>")
    got = rows(similarity.similar_pairs(df, "id", F.col("g"), least_shared, least))
    want = []
    for j, y in enumerate(sets):
        for i, x in enumerate(sets[:j]):
            n, both = min(len(set(x)), len(set(y))), len(set(x) & set(y))
            if n and both >= least_shared and both / n >= least:
                want.append((i, j, both, both / n))
    assert got == sorted(want, key=str)


def test_a_gram_that_all_have_proposes_no_pairs(spark):
    """Rows share two grams that all have, and else only what few have."""
    df = spark.range(400).select(F.col("id").alias("q"), F.array(F.lit("all"), F.lit("every"), F.concat(F.lit("x"), (F.col("id") / 2).cast("int").cast("string")), F.concat(F.lit("y"), "id")).alias("g"))
    found = similarity.containment(df, df.withColumnRenamed("q", "t"), "q", "t", "g", 3, 0.1)
    assert found.count() == 800  # itself and the other of its two


def test_norm_score(spark):
    hits = spark.createDataFrame([("a_1", "b_1", 50.0), ("a_1", "b_2", 60.0), ("a_2", "b_1", 40.0), ("a_1", "a_1", 100.0), ("a_2", "a_2", 100.0), ("a_2", "a_2", 20.0), ("c_1", "b_1", 9.0), ("b_1", "a_1", 1.0), ("b_1", "b_1", 100.0)], "q_gene string, r_gene string, bitscore float")
    selfs = similarity.self_score(hits)
    assert rows(selfs) == [("a", 3, 220.0), ("b", 1, 100.0)]
    assert rows(similarity.norm_score(hits, selfs, 5.5)) == [("a", "b", 45.45)]  # c has no self score; b to a is under the threshold


def test_kmers_and_containment(spark):
    df = spark.createDataFrame([("a", "ACGTACGT"), ("b", "AC"), ("c", "ACGTA")], "id string, seq string")
    assert [len(r.k) for r in df.select(similarity.kmers("seq", 4).alias("k")).collect()] == [5, 0, 2]
    x = df.select(F.col("id").alias("q"), similarity.kmers("seq", 4).alias("g"))
    y = df.select(F.col("id").alias("t"), similarity.kmers("seq", 4).alias("g"))
    assert rows(similarity.containment(x, y, "q", "t", "g", 1, 0.5)) == [("a", "a", 4, 1.0), ("a", "c", 2, 1.0), ("c", "a", 2, 1.0), ("c", "c", 2, 1.0)]


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_word_grams(spark, n):
    words = "a b c d".split()
    got = spark.createDataFrame([(words,)], "w array<string>").select(similarity.word_grams(F.col("w"), n).alias("g")).first().g
    assert got == [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


def test_prune(spark):
    edges = spark.createDataFrame([("a", "b", 5.0), ("a", "c", 9.0), ("a", "d", 9.0), ("b", "a", 4.9)], "src string, dst string, w double")
    clusters = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "member string, cluster_id long")
    assert rows(graph.prune(edges, clusters, 5)) == [("a", "b", 5.0, 1, 1)]


def find_all(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(parent)}


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randint(0, 80), r.randint(0, 80)) for _ in range(60)] + [(k, k + 1) for k in range(100, 140)]
    got = {x.node: x.component for x in graph.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == find_all(edges)


def dense_mcl(edges, inflation=2.0, rounds=50):
    names = sorted({x for a, b, _ in edges for x in (a, b)})
    m = np.zeros((len(names),) * 2)
    for a, b, w in edges:
        i, j = names.index(a), names.index(b)
        m[i, j] = m[j, i] = max(m[i, j], w)
    np.fill_diagonal(m, m.max(axis=0))
    m /= m.sum(axis=0)
    for _ in range(rounds):
        m = m @ m
        m[m < 1e-5] = 0
        m = m**inflation
        m /= m.sum(axis=0)
    links = [(names[i], names[j]) for i, j in zip(*np.nonzero(m > 0.1), strict=True)]
    return find_all(links)


@pytest.mark.parametrize("dense", [graph.DENSE_NODES, 0])
def test_markov_clusters_against_a_dense_matrix(spark, dense):
    r = random.Random(2)
    edges = [(f"n{a}", f"n{b}", r.uniform(0.9, 1.0)) for g in range(4) for a in range(g * 5, g * 5 + 5) for b in range(a + 1, g * 5 + 5)] + [("n4", "n5", 0.05), ("n9", "n10", 0.05)]
    got = graph.markov_clusters(spark.createDataFrame(edges, "src string, dst string, w double"), dense=dense)
    groups = {}
    for x in got.collect():
        groups.setdefault(x.cluster_id, set()).add(x.member)
    want = {}
    for k, v in dense_mcl(edges).items():
        want.setdefault(v, set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values())) and set(groups) == set(range(1, len(groups) + 1))
    more = graph.with_singletons(got, spark.createDataFrame([("n0",), ("zz",), ("aa",)], "member string"))
    assert {x.member: x.cluster_id for x in more.collect() if x.member in ("zz", "aa")} == {"aa": len(groups) + 1, "zz": len(groups) + 2}


@pytest.mark.parametrize(("n", "least"), [(12, 1.0), (40, 1.0), (40, 0.99)])
def test_markov_clusters_keep_large_cliques(spark, n, least):
    r = random.Random(n)
    edges = [(f"{g}{a:02d}", f"{g}{b:02d}", r.uniform(least, 1.0)) for g in "pq" for a in range(n) for b in range(a + 1, n)]
    got = graph.markov_clusters(spark.createDataFrame(edges, "src string, dst string, w double")).collect()
    assert {x.member: x.cluster_id for x in got} == {f"{g}{a:02d}": k for k, g in enumerate("pq", 1) for a in range(n)} and len(got) == 2 * n


def test_greedy_clusters_against_a_loop(spark):
    r = random.Random(3)
    nodes = [(f"s{k:02d}", r.randint(1, 20)) for k in range(40)]
    edges = [(f"s{r.randint(0, 39):02d}", f"s{r.randint(0, 39):02d}") for _ in range(70)]
    near = {frozenset(e) for e in edges if e[0] != e[1]}
    reps, want = [], {}
    for name, _ in sorted(nodes, key=lambda x: (-x[1], x[0])):
        want[name] = next((p for p in reps if frozenset((p, name)) in near), name)
        if want[name] == name:
            reps.append(name)
    for few in (graph.FEW_LINKS, 0):
        got = graph.greedy_clusters(spark.createDataFrame(nodes, "member string, length long"), spark.createDataFrame(edges, "src string, dst string"), few).collect()
        assert {x.member: x.representative for x in got} == want and len(got) == len(want)


def test_ladder_goes_up_with_each_component_at_once(spark, monkeypatch):
    """The same clusters as step by step, with the components of the first step alone if all are small."""
    r = np.random.default_rng(4)
    edges = [(f"n{a}", f"n{b}", float(w)) for part, n in enumerate([6, 7, 20, 3]) for a, b, w in zip(*r.integers(part * 100, part * 100 + n, (2, 4 * n)), r.integers(1, 100, 4 * n), strict=True)]
    edges += [("x", "x", 50.0), ("y", "z", None), (None, "z", 40.0), ("nan", "n1", float("nan"))]
    df = spark.createDataFrame(edges, "src string, dst string, w double").coalesce(1)
    rows = lambda df: sorted(map(tuple, df.select("member", "cluster_id").collect()))
    first = graph.settled(graph.markov_clusters(df.where("w >= 5.5")), "clusters")
    want = {5.5: rows(first), 60.0: rows(graph.markov_clusters(graph.prune(df, first, 60.0)))}
    calls = []
    monkeypatch.setattr(graph, "components", lambda *a, f=graph.components: calls.append(a) or f(*a))
    assert {t: rows(x) for t, x in graph.ladder(df, (5.5, 60.0)).items()} == want and len(want[60.0]) > 10
    assert len(calls) == 1
    assert {t: rows(x) for t, x in graph.ladder(df, (5.5, 60.0), dense=8).items()} == want


def test_ladder_nests(spark):
    edges = [("a", "b", 90.0), ("b", "c", 40.0), ("c", "d", 70.0), ("x", "y", 6.0), ("p", "q", 5.0)]
    found = graph.ladder(spark.createDataFrame(edges, "src string, dst string, w double"))
    assert list(found) == [5.5, 32.0, 65.0, 80.0]
    members = {t: {r.member for r in df.collect()} for t, df in found.items()}
    assert members[80.0] <= members[65.0] <= members[32.0] <= members[5.5] and members[80.0] == {"a", "b"} and "p" not in members[5.5]


def member(name, cluster, length=10.0, genes=1, method="AAI", expected="10"):
    return name, cluster, length, genes, method, expected


def test_representatives(spark):
    data = [
        member("one", 1),
        member("d1", 2, 50.0, method="DTR"), member("d2", 2, 60.0, method="AAI;DTR"), member("l", 2, 99.0, 9),
        member("x", 3, 30.0, 5, expected="32"), member("y", 3, 33.0, 5, expected="NA"), member("z", 3, 90.0, 4),
        member("n1", 4, genes=None), member("n2", 4, genes=None),
        member("t2", 5), member("t1", 5),
    ]
    members = spark.createDataFrame(data, "seq_name string, cluster_id long, length double, viral_genes long, completeness_method string, aai_expected_length string")
    reps = graph.representatives(members)
    assert rows(reps) == [(1, "one"), (2, "d2"), (3, "y"), (5, "t1")]  # the median of 3 is 33; 4 has no viral genes known
    info = graph.cluster_info(members, reps).collect()
    assert len(info) == len(data) and {r.votu_rep for r in info if r.cluster_id == 4} == {None}
    assert {(r.num_seqs, r.median_length, r.max_viral_genes) for r in info if r.cluster_id == 3} == {(3, 33.0, 5)}


def test_dataflow(spark):
    df = spark.createDataFrame([("a", 1, "r1"), ("a", 2, "r1"), ("b", 1, "r2"), ("c", 1, None), ("c", 1, "r3")], "id string, kind int, run string")
    assert rows(dataflow.invalid_groups(df, "id", ["kind"], ["run"]).select("id")) == [("a",)]
    assert rows(dataflow.group_tuple(df.select("id", "kind"), ["id"], ["kind"], 1)) == [("a", [1, 2]), ("c", [1, 1])]
    assert rows(dataflow.combine(df.select("id").distinct(), spark.createDataFrame([(1,), (2,)], "n int"))) == sorted(((x, n) for x in "abc" for n in (1, 2)), key=str)
    assert dataflow.combine(df, spark.createDataFrame([], "n int")).count() == 0
    lists = dataflow.collate(spark.range(10), ["id"], 4, "id").orderBy("batch").collect()
    assert [list(r["items"]) for r in lists] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    found, rest = dataflow.residuals(df.select("id").distinct(), "id", [("s1", spark.createDataFrame([("a",)], "id string")), ("s2", spark.createDataFrame([("a",), ("b",)], "id string"))])
    assert rows(found) == [("a", "s1"), ("b", "s2")] and rows(rest) == [("c",)]
    assert set(dataflow.fork(df, {"x": ["id"], "y": ["kind", "run"]})) == {"x", "y"}
    assert dataflow.demux(df, "run", ["r1"])["r1"].count() == 2
    named = dataflow.keyed_by_name(spark.createDataFrame([("x_taxaAbc.fna",), ("x.fna",)], "p string"), "p", r"taxa([^.]+)\.fna", "taxa")
    assert rows(named.select("taxa")) == [("Abc",), (None,)]
    assert dataflow.non_empty(df.select("id").distinct(), df, "id", 2).count() == 2
    with pytest.raises(Exception, match="broken: small"):
        dataflow.require(df, {"small": F.col("kind") < 2}).collect()
    assert dataflow.require(df, {"there": F.col("id").isNotNull()}).count() == 5


def test_long_lists_are_not_multiplied(spark, monkeypatch):
    monkeypatch.setattr(dataflow, "SHORT_LIST", 3)
    with pytest.raises(ValueError, match="key to combine"):
        dataflow.combine(spark.range(2), spark.range(4).withColumnRenamed("id", "n"))


def test_components_of_a_long_path(spark):
    """The smallest node at the far end; by stars alone, and by one task."""
    n = 10_000
    path = spark.range(1, n).select(F.col("id").alias("src"), F.when(F.col("id") == n - 1, 0).otherwise(F.col("id") + 1).alias("dst"))
    assert graph.components(path).where("component = 0").count() == n
    short = spark.range(1, 300).select(F.col("id").alias("src"), F.when(F.col("id") == 299, 0).otherwise(F.col("id") + 1).alias("dst"))
    assert graph.components(short, few=-1).where("component = 0").count() == 300


def test_components_of_names_and_loops(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "c"), ("d", "b"), (None, "x"), ("f", "e")], "src string, dst string")
    for few in (-1, 100):
        assert sorted(map(tuple, graph.components(edges, few).collect())) == [("a", "a"), ("b", "a"), ("c", "c"), ("d", "a"), ("e", "e"), ("f", "e")]


def test_kmers_take_time_in_proportion(spark):
    import time

    df = spark.range(1).select(F.repeat(F.lit("ACGTTGCA"), 60_000).alias("seq"))
    began = time.time()
    assert df.select(F.size(similarity.kmers("seq", 25)).alias("n")).first().n == 480_000 - 24
    assert time.time() - began < 30
    other = spark.createDataFrame([("äbcdé", ["äbc", "bcd", "cdé"]), ("ab", []), ("abcd", ["abc", "bcd"]), (None, [])], "seq string, want array<string>")
    assert all(r.got == r.want for r in other.select(similarity.kmers("seq", 3).alias("got"), "want").collect())


def test_markov_clusters_say_when_they_do_not_settle(spark):
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 0.9), ("c", "d", 1.0)], "src string, dst string, w double")
    for dense in (0, 10):
        with pytest.warns(UserWarning, match="did not settle in 1 rounds"):
            assert graph.markov_clusters(edges, rounds=1, dense=dense).count() == 4


def test_markov_clusters_of_a_star(spark):
    """A hub's column keeps few entries, its products stay few, and all that hangs on it is one cluster."""
    edges = spark.range(3000).select(F.lit("hub").alias("src"), F.format_string("leaf%05d", "id").alias("dst"), F.lit(1.0).alias("w"))
    with pytest.warns(UserWarning, match="of a column's flow"):
        found = graph.markov_clusters(edges, dense=10, most=40)
    assert found.count() == 3001 and found.select("cluster_id").distinct().count() == 1


def test_containment_shuffles_no_large_side(spark, monkeypatch):
    """Where one side's grams are few, they go to the other's: its grams and sets are joined where they lie."""
    written = {}

    def keep(df, name):
        written.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return settled(df, name)

    settled = similarity.settled
    monkeypatch.setattr(similarity, "settled", keep)
    many = spark.range(300).select("id", F.transform(F.sequence(F.lit(0), F.lit(40)), lambda k: F.col("id") * 20 + k).alias("grams"))
    few = many.where("id % 100 = 7").select(F.col("id").alias("t"), "grams")
    found = similarity.containment(many, few, "id", "t", "grams", 5, 0.4)
    plans = [*written["grams"][1:], *written["proposed"], found._jdf.queryExecution().executedPlan().toString()]
    assert all("SortMergeJoin" not in p and "BroadcastHashJoin" in p for p in plans)
    assert rows(found.select("id", "t", "shared")) == sorted(((i, t, 41 - 20 * abs(i - t)) for t in (7, 107, 207) for i in (t - 1, t, t + 1)), key=str)
