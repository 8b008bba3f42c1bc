import math

import pytest

import __spark_entry__ as entry
from sequoir.plans import queries

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_and_its_sql_agree(spark, con, small, name):
    df = queries.QUERIES[name](spark, small)
    result = con.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in df.columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=str)
    assert sorted((tuple(plain(v) for v in r) for r in df.collect()), key=str) == want


def test_iterative_queries(spark, small):
    nations = queries.QUERIES["markov_clusters_nations"](spark, small).collect()
    assert len({r.member for r in nations}) == len(nations) > 0
    parts = {r.member: r.representative for r in queries.QUERIES["greedy_clusters_nations"](spark, small).collect()}
    assert all(parts[r] == r for r in parts.values())


def test_ladder_of_suppliers(spark, small):
    """Each step's clusters lie within those of the step before; groups of three of weight 90 and more stay together to the end."""
    found = {}
    for r in queries.QUERIES["ladder_suppliers"](spark, small).collect():
        found.setdefault(r.step, {})[r.member] = r.cluster_id
    steps = sorted(found)
    assert steps == [5.5, 32.0, 65.0, 80.0]
    for above, below in zip(steps, steps[1:], strict=False):
        inside = {}
        for member, k in found[below].items():
            inside.setdefault(k, set()).add(found[above][member])
        assert all(len(x) == 1 for x in inside.values())
    last = found[80.0]
    assert all(last[m] == last[m - m % 3] for m in last if m - m % 3 in last)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and set(queries.SQL) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_retroelements_against_all_places(spark, small):
    """Every planted pair is found where it is; what is found is a pair, letter by letter."""
    from sequoir.plans import composites

    sequences = {r.id: r.seq for r in composites.retroelements(spark.read.parquet(f"{small}/nation.parquet")).collect()}
    found = {}
    for r in queries.QUERIES["c25_dgr_scan"](spark, small).collect():
        found.setdefault(r.id, []).append(r)
    assert set(found) == set(sequences)
    for name, seq in sequences.items():
        template, variable = seq[128:254], seq[414:540]
        assert {template[i] for i in range(126) if template[i] != variable[i]} == {"A"}
        planted = [r for r in found[name] if r.strand == "+" and r.variable_begin - r.template_begin == 286 and r.length >= 100 and r.at_a >= 11]
        assert planted, name
        for r in planted:
            a, b = seq[r.template_begin - 1 : r.template_end - 1], seq[r.variable_begin - 1 : r.variable_end - 1]
            wrong = [x for x, y in zip(a, b, strict=True) if x != y]
            assert (r.mismatches, r.at_a, r.at_t) == (len(wrong), wrong.count("A"), wrong.count("T")) and r.at_a >= max(7, 0.7 * r.mismatches)


def against_sql(spark, folder, tables, name):
    """Rows that a query and its SQL give of the tables, written into a folder."""
    con = duckdb.connect()
    for table, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{table}.parquet'")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    df = queries.QUERIES[name](spark, str(folder))
    order = lambda rows: sorted((tuple(plain(v) for v in r) for r in rows), key=str)
    return order(df.collect()), order(con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.SQL[name]})").fetchall())


def test_range_join_rounds_to_the_nearest_second(spark, tmp_path):
    """Events within a second of a block's ends: SQL rounds their time, halves to even."""
    base = "TIMESTAMP '1997-12-25 00:00:00'"
    off = "(VALUES (-1500), (-1000), (-636), (-500), (-400), (0), (400), (499), (500), (636), (1000), (1500)) v(ms)"
    event = f"SELECT row_number() OVER () AS event_id, {base} + to_days(CAST(883008000 // 86400 + d AS INTEGER)) + to_milliseconds(ms) AS ts, 7 AS user_id FROM {off}, (VALUES (30), (-7), (-8), (31)) w(d)"
    order = f"SELECT 1 AS o_orderkey, 27 AS o_custkey, {base} AS o_orderdate, 400000.0::DOUBLE AS o_totalprice"
    got, want = against_sql(spark, tmp_path, {"events": event, "orders": order}, "range_join_events")
    assert got == want and 0 < len(want) < 48


def test_kmer_edges_of_many_relatives(spark, tmp_path):
    """The made-up sequences are SQL's own, letter by letter: chance repeats within them move weights in some groups of a thousand."""
    suppliers = "SELECT CAST(i AS BIGINT) AS s_suppkey FROM range(1000) r(i)"
    got, want = against_sql(spark, tmp_path, {"supplier": suppliers}, "edges_kmers")
    assert len(want) == 1500 and got == want


def test_coverage_of_odd_dates(spark, tmp_path):
    """Orders without a date, before 1970, within a second of midnight, and equal ones."""
    rows = "(1, NULL), (1, NULL), (2, NULL), (2, '1996-03-01'), (3, '1969-12-30 12:00:00'), (3, '1969-12-20'), (4, '1996-03-01 23:59:59.6'), (4, '1996-04-12'), (NULL, '1996-01-01'), (5, '1996-03-01'), (5, '1996-03-01'), (6, '1969-12-31 12:00:00'), (6, '1970-02-10')"
    orders = f"SELECT CAST(a AS BIGINT) AS o_custkey, CAST(b AS TIMESTAMP) AS o_orderdate FROM (VALUES {rows}) v(a, b)"
    got, want = against_sql(spark, tmp_path, {"orders": orders}, "coverage_sweep")
    assert got == want and (1, None) in want and len(want) == 7


def test_equal_alignments_cover_their_place_once(spark, tmp_path):
    """However often an alignment is repeated, a query is covered from its first to its last letter at most. (The SQL's windows order equal rows anyhow, each in its own order.)"""
    n = 40_000
    lines = f"SELECT CAST(0 AS BIGINT) AS l_orderkey, CAST(i * 300 % 900 AS BIGINT) AS l_partkey, CAST(5 AS BIGINT) AS l_suppkey, CAST(1 + i // 3 % 3 AS INTEGER) AS l_linenumber FROM range({n}) r(i)"
    duckdb.connect().execute(f"COPY ({lines}) TO '{tmp_path}/lineitem.parquet'")
    found = queries.QUERIES["c24_blast_verdict"](spark, str(tmp_path)).collect()
    assert [(r.query, r.verdict, r.title, r.coverage) for r in found] == [("q0", "Other", "thing", 0.135)]
