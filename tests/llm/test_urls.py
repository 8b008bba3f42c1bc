import random

import pytest

from sequoir.llm import urls

SCHEMA = "page_id long, url string, rule string, block long, canonical string"


def slow(url, rules, default="allow"):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))]
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[1] if best else None, best[2] if best else default


CASES = [None, "", "://", "http://", "nothing", "http://com/", "http://com", "http://x.com?q", "http://x.com#f", "HTTP://WWW.Example.COM/en/", "http://www.example.com/en", "http://example.com/en/x?y#z", "http://a.www.example.com/en/", "http://badexample.com/en/", "http://x.net/es/", "http://net/fr/a", "http://x.net/de/", "http://.com/", "http://x.com./", "http://a://b.com/en/", "http://ÉXAMPLE.com/", "x://" + "a." * 3000 + "com/" + "p" * 5000, "http://com:80/", "http://x.net/es", "http://a\nb.com/c\nd"]


def found(spark, data, rules, **more):
    df = spark.createDataFrame([(k, u, "r", 1, "c") for k, u in data], SCHEMA)
    return {r.page_id: tuple(r)[1:] for r in urls.filter_urls(df, urls.rule_table(spark, rules), **more).collect()}


def test_cases(spark):
    got = found(spark, list(enumerate(CASES)), urls.RULES)
    assert got == {k: slow(u, urls.RULES) for k, u in enumerate(CASES)}


def test_many_rules(spark):
    r = random.Random(5)
    part = lambda: r.choice(["a", "b", "cc", "d-d"])
    rules = {(h, p): r.choice(["allow", "block"]) for h, p in ((".".join(part() for _ in range(r.randint(1, 3))), "/" + "".join(part() for _ in range(r.randint(0, 2)))) for _ in range(60))}
    rules = [(v, h, p) for (h, p), v in rules.items()]
    data = [(k, f"http://{'.'.join(part() for _ in range(r.randint(1, 5)))}/{''.join(part() for _ in range(r.randint(0, 4)))}") for k in range(600)]
    got = found(spark, data, rules, default="block")
    for k, u in data:
        host, path, rule, verdict = slow(u, rules, "block")
        assert got[k][:2] == (host, path) and len(got[k][2] or "") == len(rule or "")
        if rule == got[k][2]:
            assert got[k][3] == verdict


def test_shuffled_list_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_ROWS", 0)
    assert found(spark, list(enumerate(CASES)), urls.RULES) == {k: slow(u, urls.RULES) for k, u in enumerate(CASES)}


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    from pyspark.sql import functions as F

    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("canonical"))
    bloom = urls.blocked_bloom(keys, 250)
    asked = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("ask"), "id").withColumn("block", urls._block(F.col("ask"), 250))
    test = F.lit(True)
    for i in range(urls.WORDS):
        bit = urls._bit(F.col("ask"), i)
        test = test & (F.col(f"word{i}").bitwiseAND(bit) == bit)
    hits = {r.id for r in asked.join(bloom, "block").where(test).collect()}
    assert set(range(2000)) <= hits and len(hits) < 2040


def test_edges(spark):
    assert found(spark, [(1, "http://a.com/")], []) == {1: ("a.com", "/", None, "allow")}
    assert found(spark, [], urls.RULES) == {}
    df = spark.createDataFrame([(None, "http://a.com/", None, None, None)] * 3, SCHEMA)
    assert [tuple(r) for r in urls.filter_urls(df, urls.rule_table(spark, urls.RULES)).collect()] == [(None, "a.com", "/", "com/", "allow")] * 3


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "http://a.com/", None, None, None)], SCHEMA)
    plan = urls.filter_urls(df, urls.rule_table(spark, urls.RULES))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("url", CASES)
def test_sql_has_the_same_rules(url):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.execute("INSERT INTO pages VALUES (1, ?)", [url])
    row = con.execute(urls.rules_sql()).fetchall()[0]
    assert tuple(row[1:]) == slow(url, urls.RULES)


def test_a_list_of_many_path_lengths(spark):
    """100,000 rules of 2,000 path lengths: a page asks for the lengths of its own hosts alone."""
    from pyspark.sql import functions as F

    rules = spark.range(100_000).select(
        F.when(F.col("id") % 2 == 0, "allow").otherwise("block").alias("list_verdict"),
        F.concat(F.lit("h"), F.col("id"), F.lit(".example")).alias("list_host"),
        F.concat(F.lit("/"), F.repeat(F.lit("x"), (F.col("id") % 2000).cast("int"))).alias("list_path"),
    )
    pages = spark.range(0, 100_000, 37).select(F.col("id").alias("page_id"), F.concat(F.lit("http://www.h"), F.col("id"), F.lit(".example/"), F.repeat(F.lit("x"), (F.col("id") % 2000).cast("int") + 5)).alias("url"))
    found = urls.filter_urls(pages, rules)
    assert found.where("rule is null").count() == 0
    wrong = found.where((F.col("verdict") == "allow") != (F.col("page_id") % 2 == 0))
    assert wrong.count() == 0 and found.count() == pages.count()
