"""Similarity graphs: pruning, components, Markov and greedy clustering."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sequoir.operators.rank import numbered, top1
from sequoir.operators.store import forget, settled


#: Links that one task connects or goes through; more are worked on in rounds.
FEW_LINKS = 100_000
#: Nodes of a component that Markov clustering takes as one matrix (32 MB).
DENSE_NODES = 2000
#: Entries that a column of a larger component keeps in Markov clustering, the greatest.
COLUMN_ENTRIES = 1000


def prune(edges: DataFrame, clusters: DataFrame, threshold: float) -> DataFrame:
    """Edges (src, dst, w) within a cluster and of weight `threshold` or more; clusters: member, cluster_id.

    Nodes without a cluster have no edges left.
    """
    of = lambda node, name: clusters.select(F.col("member").alias(node), F.col("cluster_id").alias(name))
    kept = edges.where(F.col("w") >= threshold).join(of("src", "src_cluster"), "src").join(of("dst", "dst_cluster"), "dst")
    return kept.where(F.col("src_cluster") == F.col("dst_cluster")).select("src", "dst", "w", "src_cluster", "dst_cluster")


def components(edges: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """node, component (its smallest node) of every node of edges (src, dst); edges with a null end are none.

    Alternating large and small stars: every node points its larger neighbours
    at the smallest node that it knows, then its smaller ones. Rounds are tables
    in the shared folder, each deleted once the next is there, and as many as
    the logarithm of the longest path makes. What is few, from the start or
    after a round, is connected by one task.
    """
    ends = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    now = settled(ends.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct(), "links")
    alone = now.where("src = dst").select(F.col("src").alias("node"), F.col("src").alias("component"))
    links, first, mark = now.where("src <> dst"), now, None
    while True:
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst")), F.sum(F.xxhash64("dst", "src").cast("decimal(38,0)"))).first()
        if state == mark:
            rooted = links.select(F.col("dst").alias("node"), F.col("src").alias("component"))
            break
        if state[0] <= few:
            rooted = _connected(links)
            break
        mark = state
        both = links.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(links.select(F.col("dst").alias("u"), F.col("src").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        lower = down.groupBy("u").agg(F.min("v").alias("m"))
        star = F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))
        small = down.join(lower, "u").select(F.explode(star).alias("e")).where("e.a <> e.b")
        after = settled(small.select(F.least("e.a", "e.b").alias("src"), F.greatest("e.a", "e.b").alias("dst")).distinct(), "links")
        if now is not first:
            forget(now)
        now = links = after
    roots = rooted.select(F.col("component").alias("node"), "component").distinct()
    found = settled(rooted.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("component").alias("component")), "components")
    for table in {id(now): now, id(first): first}.values():
        forget(table)
    return found


def _connected(links: DataFrame) -> DataFrame:
    """node, component of every link's larger end that has a smaller node in its component; by one task."""
    kind = links.schema["src"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        types = None
        for batch in batches:
            types = types or batch.schema.field("src").type
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = sorted((find(a), find(b)))
                root[b] = a
        if types is not None:
            nodes = [x for x in root if find(x) != x]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, types), pa.array([find(x) for x in nodes], types)], ["node", "component"])

    return links.select("src", "dst").coalesce(1).mapInArrow(run, f"node {kind}, component {kind}")


def markov_clusters(edges: DataFrame, inflation: float = 2.0, rounds: int = 50, floor: float = 1e-5, settle: float = 1e-4, dense: int = DENSE_NODES, most: int = COLUMN_ENTRIES) -> DataFrame:
    """member, cluster_id of a weighted graph (src, dst, w), by Markov clustering.

    Columns get self-loops of their greatest weight and sum to one; every round
    squares the matrix, drops entries under `floor`, raises what is left to
    `inflation` and rescales. It ends when no entry moves by more than its
    share `settle`, or after `rounds`, with a warning. What isn't connected has
    nothing to do with each other: a component of up to `dense` nodes is one
    task's matrix, larger ones are tables (row, col, v) that are squared by a
    join. There a column keeps its `most` greatest entries (ties: the smallest
    rows), so that a hub of d neighbours makes `most` times d products and not
    d times d; a warning says how much of a column's flow that ever dropped,
    if it was over a hundredth. A node goes to the attractor with the greatest flow, ties (within
    `settle`, so that rounding makes none) to the smallest; sets of nodes that
    share attractors are clusters. Ids are numbered from 1 by size, largest
    first, then by smallest member.
    """
    return _numbered_clusters(_parts(edges, inflation, rounds, floor, settle, dense, most))


def _numbered_clusters(clusters: DataFrame) -> DataFrame:
    """member, cluster_id of node, component: ids from 1 by size, largest first, then by smallest member."""
    counted = clusters.groupBy("component").agg(F.count("*").alias("n"))
    ids = numbered(counted.withColumn("_small", -F.col("n")), ["_small", "component"], "cluster_id").select("component", "cluster_id")
    return clusters.join(ids, "component").select(F.col("node").alias("member"), "cluster_id")


def _placed(known: DataFrame) -> DataFrame:
    """Edges (src, dst, w) with their component and n, its number of nodes."""
    named = components(known)
    sizes = settled(named.join(named.groupBy("component").agg(F.count("*").alias("n")), "component"), "sizes")
    return known.join(sizes.select(F.col("node").alias("src"), "component", "n"), "src")


def _by_component(placed: DataFrame):
    """Edges grouped by component, over all cores: components are small and their work is not, so their bytes say nothing of it."""
    cores = placed.sparkSession.sparkContext.defaultParallelism
    return placed.select("src", "dst", "w", "component").repartition(2 * cores, "component").groupBy("component")


def _warn_moving(moving: int, rounds: int) -> None:
    if moving:
        warnings.warn(f"Markov clustering of {moving} nodes in small components did not settle in {rounds} rounds", stacklevel=3)


def _parts(edges: DataFrame, inflation: float, rounds: int, floor: float, settle: float, dense: int, most: int) -> DataFrame:
    """node, component (its smallest node) of the Markov clusters of edges."""
    placed = _placed(edges.select("src", "dst", F.col("w").cast("double").alias("w")))
    kind = edges.schema["src"].dataType.simpleString()

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        nodes = sorted(set(frame["src"]) | set(frame["dst"]))
        best, still = _dense_flows(frame, {x: i for i, x in enumerate(nodes)}, inflation, rounds, floor, settle)
        return pd.DataFrame({"src": [nodes[i] for i in best], "dst": nodes, "still": still})

    flows = _by_component(placed.where(F.col("n") <= dense)).applyInPandas(one, f"src {kind}, dst {kind}, still boolean")
    flows = settled(flows, "flows")
    _warn_moving(flows.where("not still").count(), rounds)
    flows = flows.select("src", "dst")
    large = placed.where(F.col("n") > dense)
    if large.limit(1).count():
        flows = flows.unionByName(_table_flows(large.select("src", "dst", "w"), inflation, rounds, floor, settle, most))
    return components(flows)


def _dense_flows(frame: pd.DataFrame, at: dict, inflation: float, rounds: int, floor: float, settle: float) -> tuple[np.ndarray, bool]:
    """The attractor of each node of one component, by number, and whether the flows stand still."""
    m = np.zeros((len(at), len(at)))
    for a, b, w in zip(frame["src"].map(at), frame["dst"].map(at), frame["w"], strict=True):
        if a != b and w > 0:
            m[a, b] = m[b, a] = max(m[a, b], w)
    most = m.max(axis=0)
    m[np.diag_indices(len(at))] = np.where(most > 0, most, 1.0)
    m /= m.sum(axis=0)
    for _ in range(rounds):
        after = m @ m
        after = np.where(after >= floor, after, 0.0) ** inflation
        after /= after.sum(axis=0)
        moved = np.abs(after - m) > settle * np.maximum(after, m)
        m = after
        if not moved.any():
            break
    return (m >= m.max(axis=0) * (1 - settle)).argmax(axis=0), not moved.any()


def _table_flows(edges: DataFrame, inflation: float, rounds: int, floor: float, settle: float, most: int) -> DataFrame:
    """src (attractor), dst (node) of the nodes of large components, by tables."""
    flat = edges.where("src <> dst").select(F.col("dst").alias("row"), F.col("src").alias("col"), F.col("w").alias("v")).where("v > 0")
    flat = flat.unionByName(flat.select(F.col("col").alias("row"), F.col("row").alias("col"), "v")).groupBy("row", "col").agg(F.max("v").alias("v"))
    loops = flat.groupBy("col").agg(F.max("v").alias("v")).select(F.col("col").alias("row"), "col", "v")
    every = edges.select(F.col("src").alias("col")).unionByName(edges.select(F.col("dst").alias("col"))).distinct()
    alone = every.join(loops.select("col"), "col", "left_anti").select(F.col("col").alias("row"), "col", F.lit(1.0).alias("v"))

    def scaled(m: DataFrame) -> DataFrame:
        return m.join(m.groupBy("col").agg(F.sum("v").alias("s")), "col").select("row", "col", (F.col("v") / F.col("s")).alias("v"))

    rank = F.row_number().over(Window.partitionBy("col").orderBy(F.col("v").desc(), "row"))
    dropped = 0.0
    m = settled(scaled(flat.unionByName(loops).unionByName(alone)), "flow")
    for _ in range(rounds):
        if m.groupBy("col").count().where(F.col("count") > most).limit(1).count():
            cut = settled(m.withColumn("rank", rank).where(F.col("rank") <= most).drop("rank"), "flow")
            held = cut.groupBy("col").agg(F.sum("v").alias("s")).agg(F.min("s")).first()[0]
            dropped = max(dropped, 1 - held)
            forget(m)
            m = settled(scaled(cut), "flow")
            forget(cut)
        left = m.select("row", F.col("col").alias("mid"), F.col("v").alias("a"))
        right = m.select(F.col("row").alias("mid"), "col", F.col("v").alias("b"))
        squared = left.join(right, "mid").groupBy("row", "col").agg(F.sum(F.col("a") * F.col("b")).alias("v"))
        after = settled(scaled(squared.where(F.col("v") >= floor).withColumn("v", F.pow("v", F.lit(inflation)))), "flow")
        was, now = F.coalesce("v", F.lit(0.0)), F.coalesce("n", F.lit(0.0))
        moved = after.withColumnRenamed("v", "n").join(m, ["row", "col"], "full").where(F.abs(now - was) > settle * F.greatest(now, was)).limit(1).count()
        forget(m)
        m = after
        if moved == 0:
            break
    else:
        warnings.warn(f"Markov clustering did not settle in {rounds} rounds", stacklevel=2)
    if dropped > 0.01:
        warnings.warn(f"Markov clustering dropped up to {dropped:.3f} of a column's flow beyond its {most} greatest entries", stacklevel=2)
    greatest = m.groupBy("col").agg(F.max("v").alias("most"))
    return m.join(greatest, "col").where(F.col("v") >= F.col("most") * (1 - settle)).groupBy(F.col("col").alias("dst")).agg(F.min("row").alias("src")).select("src", "dst")


def with_singletons(clusters: DataFrame, ids: DataFrame) -> DataFrame:
    """clusters (member, cluster_id) with every id (member) that has none as a cluster of its own, numbered after the last."""
    last = clusters.agg(F.coalesce(F.max("cluster_id"), F.lit(0))).first()[0]
    rest = ids.select("member").distinct().join(clusters, "member", "left_anti")
    return clusters.select("member", "cluster_id").unionByName(numbered(rest, ["member"], "cluster_id", last + 1).select("member", "cluster_id"))


def greedy_clusters(nodes: DataFrame, edges: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """member, representative by greedy incremental clustering; nodes: member, length; edges: src, dst.

    Longest first, ties by id: a node joins the first representative that it
    has an edge with, or becomes one. Worked out in rounds: a node is settled
    once all longer neighbours are; each round adds a table of its own. Once
    few edges are open, one task goes through them in order.
    """
    rank = F.struct((-F.col("length")).alias("n"), F.col("member").alias("id"))
    ranked = settled(nodes.select("member", rank.alias("rank")), "ranked")
    pairs = edges.where("src <> dst").select("src", "dst")
    pairs = pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    up = pairs.join(ranked.select(F.col("member").alias("src"), F.col("rank").alias("own")), "src").join(ranked.select(F.col("member").alias("dst"), F.col("rank").alias("other")), "dst")
    up = settled(up.where("other < own").select(F.col("src").alias("member"), "own", F.col("dst").alias("longer"), "other"), "up")
    done = [settled(ranked.join(up.select("member"), "member", "left_anti").select("member", F.col("member").alias("representative")), "greedy")]
    fixed = lambda: reduce(DataFrame.unionByName, done).select(F.col("member").alias("longer"), F.col("representative").alias("rep"))
    while up.limit(few + 1).count() > few:
        seen = up.join(fixed(), "longer", "left")
        first = F.min(F.when(F.col("rep") == F.col("longer"), F.col("other")))
        waits = F.min(F.when(F.col("rep").isNull(), F.col("other")))
        tally = seen.groupBy("member").agg(first.alias("first"), waits.alias("wait"))
        # a node can be settled when nothing before its first representative is still open
        ready = tally.where(F.col("wait").isNull() | F.col("first").isNotNull() & (F.col("first") < F.col("wait")))
        new = settled(ready.select("member", F.coalesce(F.col("first.id"), F.col("member")).alias("representative")), "greedy")
        # what stays open keeps its edges, but for those to nodes that have joined another
        left = seen.join(new.select("member"), "member", "left_anti").where("rep is null or rep = longer").drop("rep")
        done.append(new)
        up, old = settled(left.select("member", "own", "longer", "other"), "up"), up
        forget(old)
    kind = nodes.schema["member"].dataType.simpleString()

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges_of: dict = {}
        types = None
        for batch in batches:
            types = types or batch.schema.field("member").type
            for row in batch.to_pylist():
                edges_of.setdefault((row["n"], row["member"]), []).append((row["m"], row["longer"], row["rep"]))
        chosen: dict = {}
        for (_, member), longer in sorted(edges_of.items()):
            found = (x for _, x, rep in sorted(longer, key=lambda e: e[:2]) if (chosen.get(x) if rep is None else rep) == x)
            chosen[member] = next(found, member)
        if types is not None:
            yield pa.RecordBatch.from_arrays([pa.array(list(chosen), types), pa.array(list(chosen.values()), types)], ["member", "representative"])

    open_ = up.join(fixed(), "longer", "left").select("member", F.col("own.n").alias("n"), F.col("other.n").alias("m"), "longer", "rep")
    last = open_.coalesce(1).mapInArrow(rest, f"member {kind}, representative {kind}")
    return reduce(DataFrame.unionByName, done).unionByName(last)


def _joined(links: Iterator[tuple]) -> dict:
    """The smallest node of its component of every end of links."""
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root}


def ladder(edges: DataFrame, thresholds: tuple[float, ...] = (5.5, 32.0, 65.0, 80.0), inflation: float = 2.0, rounds: int = 50, floor: float = 1e-5, settle: float = 1e-4, dense: int = DENSE_NODES, most: int = COLUMN_ENTRIES) -> dict[float, DataFrame]:
    """Nested clusterings: each prunes the edges within the last one's clusters at the next threshold and clusters anew, as markov_clusters() does.

    Clusters lie within components of the first step, so one task goes up the
    whole ladder with a component of up to `dense` nodes; larger ones go step
    by step.
    """
    first = settled(edges.where(F.col("w") >= thresholds[0]).select("src", "dst", F.col("w").cast("double").alias("w")), "edges")
    placed = settled(_placed(first), "placed")
    forget(first)
    kind = edges.schema["src"].dataType.simpleString()

    def climb(frame: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        links = list(zip(frame["src"], frame["dst"], frame["w"], strict=True))
        for step, t in enumerate(thresholds):
            if step:  # not under t: NaN stays, as Spark has it above all numbers
                links = [e for e in links if not e[2] < t and cluster[e[0]] == cluster[e[1]]]  # noqa: F821
            part = _joined((a, b) for a, b, _ in links)
            inner: dict = {}
            for e in links:
                inner.setdefault(part[e[0]], []).append(e)
            cluster: dict = {}
            for own in inner.values():
                nodes = sorted({x for e in own for x in e[:2]})
                best, still = _dense_flows(pd.DataFrame(own, columns=["src", "dst", "w"]), {x: i for i, x in enumerate(nodes)}, inflation, rounds, floor, settle)
                found = _joined(zip((nodes[i] for i in best), nodes, strict=True))
                cluster |= found
                rows += [(step, x, found[x], still) for x in nodes]
        return pd.DataFrame(rows, columns=["step", "node", "component", "still"])

    small = _by_component(placed.where(F.col("n") <= dense))
    climbed = settled(small.applyInPandas(climb, f"step int, node {kind}, component {kind}, still boolean"), "climbed")
    _warn_moving(climbed.where("not still").count(), rounds)
    rest = placed.where(F.col("n") > dense).select("src", "dst", "w")
    large = rest.limit(1).count() > 0
    found: dict[float, DataFrame] = {}
    for step, t in enumerate(thresholds):
        clusters = climbed.where(F.col("step") == step).select("node", "component")
        if large:
            if step:
                rest = settled(prune(rest, last.select(F.col("node").alias("member"), F.col("component").alias("cluster_id")), t).select("src", "dst", "w"), "edges")  # noqa: F821
            last = _parts(rest, inflation, rounds, floor, settle, dense, most)
            clusters = clusters.unionByName(last)
        found[t] = settled(_numbered_clusters(clusters), "clusters")
    return found


def representatives(members: DataFrame) -> DataFrame:
    """One representative of each cluster, cluster_id and votu_rep; members: seq_name, cluster_id, length, viral_genes, completeness_method, aai_expected_length.

    A cluster of one is its own. Else the longest with DTR among its methods.
    Else, of those with the cluster's most viral genes, the one nearest to its
    expected length (the median length if that is NA); a cluster whose viral
    genes are all null has none. Ties go to the smallest name.
    """
    sized = cluster_metrics(members)
    single = sized.where("num_seqs = 1").select("cluster_id", "seq_name")
    more = sized.where("num_seqs > 1")
    dtr = top1(more.where(F.col("completeness_method").contains("DTR")), ["cluster_id"], [F.col("length").desc_nulls_first()], ["seq_name"]).select("cluster_id", "seq_name")
    rest = more.join(dtr.select("cluster_id"), "cluster_id", "left_anti").where("viral_genes = max_viral_genes")
    gap = F.abs(F.col("length") - F.coalesce(F.col("aai_expected_length").try_cast("double"), F.when(F.col("aai_expected_length") == "NA", F.col("median_length"))))
    linear = top1(rest.withColumn("_gap", gap), ["cluster_id"], [F.col("_gap").asc_nulls_first()], ["seq_name"]).select("cluster_id", "seq_name")
    return single.unionByName(dtr).unionByName(linear).withColumnRenamed("seq_name", "votu_rep")


def cluster_metrics(members: DataFrame) -> DataFrame:
    """members with num_seqs, median_length and max_viral_genes of their cluster."""
    metrics = members.groupBy("cluster_id").agg(F.median("length").alias("median_length"), F.max("viral_genes").alias("max_viral_genes"), F.count("*").alias("num_seqs"))
    return members.join(metrics, "cluster_id")


def cluster_info(members: DataFrame, reps: DataFrame) -> DataFrame:
    """Members with their metrics and representative, by a full join that keeps the left side's cluster_id."""
    named = reps.select(F.col("cluster_id").alias("_right"), "votu_rep")
    sized = cluster_metrics(members)
    return sized.join(named, sized.cluster_id == F.col("_right"), "full").drop("_right")


def sequential(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """Groups handed to a function of a pandas frame, for what has to go row by row; a group must fit a task."""

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        return fn(frame)

    return df.groupBy(*keys).applyInPandas(one, schema)


def in_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """Batches handed to a function of a pandas frame."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield fn(frame)

    return df.mapInPandas(run, schema)
