from sequoir.streaming import ledger


def test_ledger_over_batches(spark, tmp_path):
    into, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "original_id string, hash string"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(into)
    run = lambda: ledger.grow_ledger(ledger.arrivals(spark, into, schema), out, mark).awaitTermination()
    put([("a", "h1"), ("b", "h1"), ("c", "h2")])
    run()
    put([("d", "h2"), ("e", "h3"), ("f", None)])
    run()
    run()  # nothing new has come
    new = sorted((r.original_id, r.hash) for r in spark.read.schema(schema).parquet(f"{out}/new").collect())
    assert new == [("a", "h1"), ("c", "h2"), ("e", "h3")]
    assert sorted(r.hash for r in spark.read.parquet(f"{out}/ledger").collect()) == ["h1", "h2", "h3"]  # new hashes alone


def test_windows_and_sessions(spark):
    from pyspark.sql import functions as F

    data = [(0, "x", 1, 1.0), (600, "x", 1, 2.0), (3600, "x", 1, 4.0), (9000, "y", 2, 8.0)]
    events = spark.createDataFrame(data, "s long, event_type string, user_id long, value double").withColumn("ts", F.timestamp_seconds("s"))
    got = sorted((r.event_type, r.n, r.total) for r in ledger.windowed_counts(events).collect())
    assert got == [("x", 1, 4.0), ("x", 2, 3.0), ("y", 1, 8.0)]
    assert sorted((r.user_id, r.n) for r in ledger.sessions(events).collect()) == [(1, 1), (1, 2), (2, 1)]
