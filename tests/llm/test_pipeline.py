import hashlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

import corpus_pipeline  # noqa: E402
from sequoir.llm import langid  # noqa: E402
from sequoir.llm.decontaminate import shingles  # noqa: E402
from sequoir.llm.registry import oracle_sql, queries, tokenizer_path  # noqa: E402
from tests.llm.cases import frame, rows  # noqa: E402
from tests.llm.test_decontaminate import slow as slow_hits  # noqa: E402
from tests.llm.test_langid import slow_score  # noqa: E402
from tests.llm.test_neardup import smallest  # noqa: E402
from tests.llm.test_quality import slow_base, slow_verdict  # noqa: E402


def near_items(text, items):
    """Items of which the whole text has eight in ten shingles at least, each as often as it has them; no window can be like any other."""
    has = Counter(shingles((text or "").lower().encode().split()))
    out = []
    for item_id, item in items:
        own = Counter(shingles(item.lower().encode().split()))
        if len(item.split()) < 5 or sum(min(n, has[x]) for x, n in own.items()) >= 0.8 * sum(own.values()) - 1e-9:
            out.append((item_id, item))
    return out


def test_stages_in_order(spark, small):
    """Each stage's result against a slow version of what it is given."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, given, small)
        before, after = given.collect(), out.collect()
        if name == "quality rules":
            want = {r.doc_id for r in before if not slow_base(r.text)[-1] and slow_verdict(r.text) is None}
            assert {r.doc_id for r in after} == want
        elif name == "language ID":
            net, kept = langid.trained(given), {r.doc_id for r in after}
            some = [r for r in before if r.doc_id not in kept or r.doc_id % 9 == 0 and len(r.text) < 3000]  # a slow version of all would take minutes
            assert all((slow_score(net, r.text)[1] >= langid.LEAST_SCORE) == (r.doc_id in kept) for r in some)
            assert net.languages == ["de", "en", "es", "fr"]
        elif name == "SimHash near-dedup":
            want = smallest([(r.doc_id, r.text) for r in before])
            assert sorted((r.doc_id for r in after), key=str) == want and len(after) == len({r.doc_id for r in after})
        elif name == "benchmark decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
            gone = {r.doc_id for r in before} - {r.doc_id for r in after}
            assert gone and all(bool(slow_hits(r.text, near_items(r.text, items))) == (r.doc_id in gone) for r in before)
        else:
            library = tokenizers.Tokenizer.from_file(tokenizer_path())
            texts = {r.doc_id: r.text for r in before}
            for r in after:
                ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
                assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert len(after) == len(before)
            break
        assert out.columns == columns
        given = spark.createDataFrame(after, docs.schema)
    run = corpus_pipeline.run(spark, small)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, after))


@pytest.mark.parametrize("k", range(5))
def test_stages_bear_hard_rows_and_none(spark, small, k):
    stage = corpus_pipeline.STAGES[k][1]
    docs = frame(spark)
    out = stage(spark, docs, small)
    assert out.count() <= len(rows()) and (k == 4 or out.columns == docs.columns)
    assert stage(spark, frame(spark, []), small).count() == 0


def test_queries_are_registered():
    names = queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(oracle_sql()) <= set(names)
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_sql_agrees(spark, small):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("pages", "documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{small}/{table}.parquet')")
    for name, sql in oracle_sql().items():
        df = queries()[name](spark, small)
        result = con.execute(sql)
        at = [[d[0] for d in result.description].index(c) for c in df.columns]
        assert sorted((tuple(r) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=str)
