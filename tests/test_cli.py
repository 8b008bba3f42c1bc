import pytest

from sequoir import cli
from sequoir.plans import batching, verify
from sequoir.sources import hits


def lines(spark, path):
    return sorted(r.value for r in spark.read.text(str(path)).collect())


def test_scores_end_to_end(spark, tmp_path):
    m8 = tmp_path / "h.m8"
    row = "{}\t{}\t99\t9\t0\t0\t1\t9\t1\t9\t0\t{}\n"
    m8.write_text("".join(row.format(*x) for x in [("a_1", "a_1", 100), ("a_1", "b_1", 50), ("b_1", "b_1", 200), ("b_1", "a_1", 5)]))
    assert cli.main(["self-score", "--m8", str(m8), "--out", str(tmp_path / "s")], spark) == 0
    assert lines(spark, tmp_path / "s/selfscore") == ["a\t1\t100.0", "b\t1\t200.0", "genome\tgenes\tselfscore"]
    cli.main(["norm-score", "--m8", str(m8), "--selfscore", str(tmp_path / "s/selfscore"), "--out", str(tmp_path / "n")], spark)
    assert lines(spark, tmp_path / "n/normscore") == ["a\tb\t50.00"]


def test_host_and_prune(spark, tmp_path):
    (tmp_path / "hosts.tsv").write_text("Genome\tRepr_taxonomy\ng1\ttax\n")
    head = "Spacer id\tTarget id\tStart\tEnd\tStrand\tN mismatches\tCIGAR\tMD\tspacer\tflags\n"
    (tmp_path / "sp.tsv").write_text(head + "g1:x\tv\t1\t2\t+\t0\t\t\t\t\n")
    cli.main(["crispr-host", "--spacers", str(tmp_path / "sp.tsv"), "--hosts", str(tmp_path / "hosts.tsv"), "--out", str(tmp_path / "c")], spark)
    assert "v\t1\t1\ttax\t1.0" in lines(spark, tmp_path / "c/hosts")
    (tmp_path / "e.tsv").write_text("a\tb\t40\na\tc\t40\n")
    (tmp_path / "c.mcl").write_text("a\tb\nc\n")
    cli.main(["prune", "--edges", str(tmp_path / "e.tsv"), "--clusters", str(tmp_path / "c.mcl"), "--out", str(tmp_path / "p")], spark)
    assert "a\tb\t40.0\t1\t1" in lines(spark, tmp_path / "p/edges")


def test_sequences(spark, tmp_path):
    (tmp_path / "a.fna").write_text(">b x\nAC\n>a\nGG\n")
    cli.main(["rename", "--fasta", str(tmp_path / "a.fna"), "--existing", "4", "--out", str(tmp_path / "r")], spark)
    assert lines(spark, tmp_path / "r/mapping")[:2] == ["a\tSEQ-5", "b\tSEQ-6"] and ">SEQ-5" in lines(spark, tmp_path / "r/fasta")


def test_every_command_parses():
    assert len(cli.COMMANDS) >= 24
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["prune"])


def test_batches_by_source(spark):
    items = spark.createDataFrame([(f"s{k:02d}", "ENA" if k < 25 else "own", f"u{k}") for k in range(30)] + [("x", None, "u"), ("y", "ENA", None)], "sample string, source_db string, fna string")
    got = {r.id: len(r.urls) for r in batching.source_batches(items, 2, {"ENA": 10}).collect()}
    assert got == {"ENA_0": 20, "ENA_1": 5, "own_0": 2, "own_1": 2, "own_2": 1}


def test_genes_and_matrix(spark):
    genes = spark.createDataFrame([("c", 10, "g1"), ("c", 11, "g2"), ("d", 1, "g3")], "contig string, start long, gene string")
    assert [r.gene for r in verify.genes_within(genes, spark.createDataFrame([("c", 10)], "id string, length long")).collect()] == ["g1"]
    cols = spark.createDataFrame([("v1", 0), ("v2", 1)], "name string, ordinal long")
    rows = spark.createDataFrame([("q1", "1:5,", 0)], "name string, cells string, ordinal long")
    assert [r.line for r in hits.square_matrix(rows, cols).collect()] == [",v1,v2,q1", "v1,", "v2,", "q1,1:5,"]
