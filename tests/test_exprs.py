import random

import pytest
from pyspark.sql import functions as F

from sequoir.functions import exprs as E


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr.alias("x")).first().x


@pytest.mark.parametrize(("value", "want"), [("a_b_12", "a_b"), ("a", "a"), (None, None), ("a_", "a"), ("_x", "")])
def test_genome_of(spark, value, want):
    assert one(spark, value, E.genome_of("c")) == want


@pytest.mark.parametrize(("value", "want"), [("g_1_12", "g_1"), ("g_1a", "g_1a"), ("g", "g"), (None, None)])
def test_genome_of_numbered(spark, value, want):
    assert one(spark, value, E.genome_of_numbered("c")) == want


@pytest.mark.parametrize(("value", "want"), [("s|provirus_1_20", "s"), ("s|provirus", "s"), ("s", "s"), ("s|provirus_x|y", "s|provirus_x|y"), (None, None)])
def test_strip_provirus(spark, value, want):
    assert one(spark, value, E.strip_provirus("c")) == want


@pytest.mark.parametrize(("value", "i", "want"), [("a;b;c", 0, "a"), ("a;b;c", 2, "c"), ("a;b;c", 3, None), ("a;b", -1, "b"), (None, 0, None), ("", 0, "")])
def test_part(spark, value, i, want):
    assert one(spark, value, E.part("c", ";", i)) == want


def test_part_takes_its_separator_literally(spark):
    assert one(spark, "a.b--c", E.part("c", "--", 1)) == "c"
    assert one(spark, "a.b", E.part("c", ".", 0)) == "a"


@pytest.mark.parametrize(("value", "want"), [("a_b_c", "a b_c"), ("abc", "abc"), (None, None), ("_", " ")])
def test_replace_first(spark, value, want):
    assert one(spark, value, E.replace_first("c", "_", " ")) == want


@pytest.mark.parametrize(("value", "want"), [("Viruses;A; Fam ", "Fam"), ("one", ""), (None, ""), ("a;", "")])
def test_family(spark, value, want):
    assert one(spark, value, E.family_of("c")) == want


@pytest.mark.parametrize(("value", "want"), [("Viruses;;;;;;Anelloviridae", "Cardeaviricetes"), ("V;R;K;P;Caudoviricetes;O", "Caudoviricetes"), ("Viruses", "No class"), (None, None), ("Caudoviricetes", None)])
def test_class(spark, value, want):
    assert one(spark, value, E.class_label("c")) == want


@pytest.mark.parametrize(("value", "want"), [("a >1 viral region b", False), ("fine", True), (None, True)])
def test_null_safe_negation(spark, value, want):
    assert one(spark, value, E.not_contains_or_null("c", ">1 viral region")) is want


@pytest.mark.parametrize(("value", "want"), [("1.5", 1.5), ("NA", None), ("-", None), (None, None)])
def test_number_or_null(spark, value, want):
    assert one(spark, value, E.number_or_null("c")) == want


def test_flags_and_sums(spark):
    df = spark.createDataFrame([(1, None, 3), (None, None, None)], "a int, b int, c int")
    assert [r.s for r in df.select(E.sum_flags(["a", "b", "c"]).alias("s")).collect()] == [4, 0]
    assert [r.f for r in df.select(E.flag(F.col("a") > 0, -7).alias("f")).collect()] == [-7, 0]


@pytest.mark.parametrize(("value", "want"), [("AACGT", "ACGTT"), ("acgN", "Ncgt"), ("", ""), (None, None)])
def test_reverse_complement(spark, value, want):
    assert one(spark, value, E.reverse_complement("c")) == want


def test_wrapping_and_records(spark):
    assert one(spark, "abcdefg", E.wrapped("c", 3)) == "abc\ndef\ng"
    assert one(spark, "abcdef", E.wrapped("c", 3)) == "abc\ndef"
    assert one(spark, "ACGT", E.fasta_record(F.lit("id"), "c")) == ">id\nACGT"


def test_repeats_and_circles(spark):
    body = "".join(random.Random(1).choices("ACGT", k=700))
    circle = body + body[:120]
    assert one(spark, circle, E.circular_overlap("c")) == 120
    assert one(spark, body[:300], E.circular_overlap("c")) is None
    assert one(spark, circle, E.circular_extended("c", F.lit(120))) == circle + circle[120:5000]


def test_strand(spark):
    assert one(spark, 0, E.strand("c"), "int") == "+" and one(spark, 16, E.strand("c"), "int") == "-"
    with pytest.raises(Exception, match="unexpected flag"):
        one(spark, 4, E.strand("c"), "int")
