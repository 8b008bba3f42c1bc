import random

import pytest
from pyspark.sql import functions as F

from sequoir import schemas
from sequoir.config import Config, Stages
from sequoir.functions.align import align, codon_sums, mismatch_profile, seeds, template_bias
from sequoir.operators import dgr
from sequoir.plans import annotate, classify, cluster, host, lifestyle, naming, release, taxonomy, verify


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def make(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


BASE = dict(virus_score=0.5, n_hallmarks=0, viral_genes=0, host_genes=0, taxonomy="Viruses", Prediction=None, Score=None, warnings=None, zot=0, ino=0, plasmid=0, conj=0, dup=0)


def virus(spark, **changes):
    """One sequence through the filter: its row."""
    v = BASE | changes
    genes = [("s_1", "ZOT" if v["zot"] else "x", v["plasmid"], "t", "m1"), ("s_2", "T_x;CONJ" if v["conj"] else None, 0, "t", "m2")]
    genes += [(f"s_{9 + k}", None, 0, "V;Inoviridae", f"i{k}") for k in range(v["ino"])]
    genes += [(f"s_{90 + k}", None, 0, None, "dup") for k in range(v["dup"])]
    return classify.virus_filter(
        make(spark, "seq_name string, virus_score double, n_hallmarks long, taxonomy string", ("s|provirus_1_9", v["virus_score"], v["n_hallmarks"], v["taxonomy"])),
        make(spark, schemas.GENES, *genes),
        make(spark, "contig_id string, viral_genes long, host_genes long, completeness double, completeness_method string, warnings string", ("s|provirus_1_9", v["viral_genes"], v["host_genes"], 50.0, "AAI", v["warnings"])),
        make(spark, schemas.VERIFY, ("s|provirus_1_9", v["Prediction"], 1, "-", v["Score"], None)),
        make(spark, "seq_name string", ("none",)),
        conj_genes=["CONJ"],
        zot_gene="ZOT",
    ).collect()


@pytest.mark.parametrize(
    ("changes", "flag", "value"),
    [
        (dict(virus_score=0.95), "genomad_virus_score_95", 1),
        (dict(virus_score=0.9499), "genomad_virus_score_95", 0),
        (dict(Prediction="Virus", Score="15"), "viralverify_virus_score_15", 1),
        (dict(Prediction="Virus", Score="14.99"), "viralverify_virus_score_15", 0),
        (dict(Prediction="Virus", Score="-20.00"), "viralverify_virus_score_15", 0),
        (dict(Prediction="Chromosome", Score="-20.00"), "viralverify_chromosome_plasmid", -1),
        (dict(n_hallmarks=3), "virus_hallmarks_gt_3", 1),
        (dict(viral_genes=3, host_genes=1), "virus_hallmarks_gt_3", 1),
        (dict(viral_genes=3, host_genes=0), "virus_hallmarks_gt_3", 1),
        (dict(viral_genes=5, host_genes=2), "virus_hallmarks_gt_3", 0),
        (dict(taxonomy="Viruses;a;Fam"), "ictv_known_family", 1),
        (dict(taxonomy=None), "ictv_known_family", 0),
        (dict(zot=1), "zot_gene", 1),
        (dict(ino=5), "inoviridae_marker_genes_gt_5", 1),
        (dict(ino=4), "inoviridae_marker_genes_gt_5", 0),
        (dict(host_genes=2, viral_genes=0), "checkv_host_genes_gt_2", -1),
        (dict(host_genes=2, viral_genes=2), "checkv_host_genes_gt_2", 0),
        (dict(plasmid=1), "plasmid_hallmarks_gt_0", -1),
        (dict(conj=1), "conj_genes_gt_0", -1),
        (dict(dup=3), "marker_duplicity_penalty", -7),
    ],
)
def test_flags(spark, changes, flag, value):
    row = virus(spark, **changes)[0]
    assert row[flag] == value
    assert row.viral_score_sum == sum(row[f] for f in classify.FLAGS) and -11 <= row.viral_score_sum <= 6


def test_classes_and_warnings(spark):
    assert virus(spark)[0].virus_classification == "uncertain"
    assert virus(spark, virus_score=1.0, zot=1)[0].virus_classification == "confident"
    assert virus(spark, conj=1)[0].virus_classification == "non-viral"
    assert virus(spark, warnings="x; >1 viral region detected") == [] and len(virus(spark, warnings="other")) == 1


def test_duplicity_is_null_without_duplicates(spark):
    genes = [("a_1", None, 0, None, "m"), ("a_2", None, 0, None, "n"), ("b_1", None, 0, None, "NA"), ("b_2", None, 0, None, "NA"), ("c_1", None, 0, None, None)] + [("d_1", None, 0, None, "x")] * 2 + [(f"d_{k}", None, 0, None, f"u{k}") for k in range(3)]
    got = {r.genome: (r.n_dup_markers, r.marker_duplicity) for r in classify.marker_duplicity(make(spark, schemas.GENES, *genes)).collect()}
    assert got == {"a": (0, None), "b": (1, 1.5), "c": (0, None), "d": (1, 1.2)}
    assert {r.genome: r.marker_duplicity for r in classify.marker_duplicity(make(spark, schemas.GENES, *genes), False).collect()}["b"] is None


def test_filters(spark):
    d = make(spark, "virus_score double, length long, taxonomy string", (0.7, 2000, "x;Faserviricetes"), (0.69, 2000, "x;Faserviricetes"), (0.1, 5000, "Inoviridae;viricetes"), (0.1, 4499, "Inoviridae;viricetes"), (0.9, 9999, "Caudoviricetes"), (0.9, 10000, "Caudoviricetes"), (0.9, 3000, "Unclassified"), (0.9, 3000, "Anelloviridae"))
    assert [r.length for r in d.where(classify.coarse_filter()).collect()] == [2000, 5000, 10000, 3000]
    q = make(spark, schemas.COMPLETENESS, ("a", 150, 50.0, "100", 1.2), ("b", 151, 50.0, "100", 1.2), ("c", 1, 90.0, "NA", 1.0), ("d", 1, 90.0, "0", 1.0), ("e", 1, 90.0, "10", 1.21))
    assert [r.contig_id for r in q.where(classify.completeness_filter()).collect()] == ["a"]
    c = make(spark, "seq_name string, completeness double, completeness_method string, source_db string", ("a", 80.0, "DTR (x)", "x"), ("b", 79.0, "DTR", "x"), ("c", 90.0, "AAI-based (high-confidence)", "NCBI"), ("d", 90.0, "AAI-based (high-confidence)", "x"), ("e", 95.0, "HMM", "NCBI"))
    assert rows(classify.complete_genomes(c)) == [("a",), ("c",)]
    assert rows(classify.hq_filter(make(spark, "contig_id string, aai_completeness double", ("a", 1.0), ("b", None), ("c", 90.0), ("d", 89.9)), c)) == [("a",), ("b",), ("c",)]
    o = classify.dtr_override(make(spark, "contig_id string, completeness double, completeness_method string", ("a", 80.0, "AAI"), ("b", 79.9, "AAI"), ("c", None, None)), make(spark, "seq_name string", ("a",), ("b",), ("c",), ("a",)))
    assert rows(o) == [("a", 100.0, "DTR"), ("b", 79.9, "AAI"), ("c", None, None)]
    u = make(spark, "seq_name string, virus_classification string, contig_length long, proviral_length long", ("a", "uncertain", 10_000, None), ("b", "uncertain", 9999, None), ("c", "confident", 20_000, None), ("d", "uncertain", None, 10_000))
    left, right = classify.split_uncertain(u, make(spark, "id string, seq string", *[(x, "A") for x in "abcde"]))
    assert (rows(left.select("id")), rows(right.select("id"))) == ([("a",), ("d",)], [("b",), ("c",), ("e",)])


def test_uncertain_to_confident(spark):
    markers = make(spark, schemas.MARKERS, ("V", 1, 0), ("P", 0, 1), ("B", 1, 1))
    hits = make(spark, "protein string, hallmark string, evalue double", ("g_1", "V", 1e-9), ("g_1", "P", 1e-3), ("g_2", "V", 1e-9), ("g_3", "V", 1e-9), ("h_1", "B", 1e-9), ("h_2", "V", 1.0), ("k_1", "x", 1.0))
    counts, ids = classify.uncertain_to_confident(hits, markers)
    assert rows(counts) == [("g", 3, 0), ("h", 2, 1), ("k", 0, 0)] and rows(ids) == [("g",)]


def test_naming(spark):
    seqs = make(spark, "id string, seq string", ("b", "C"), ("a", "A"))
    named, mapping = naming.rename(seqs, 41)
    assert rows(mapping) == [("a", "SEQ-42"), ("b", "SEQ-43")] and rows(named) == [("SEQ-42", "A"), ("SEQ-43", "C")]
    assert rows(naming.classify_rename(make(spark, "seq_name string, x int", ("a", 1), ("z", 2)), mapping).select("original_id", "seq_name", "x")) == [("a", "SEQ-42", 1)]


def test_taxonomy(spark):
    classified = make(spark, "seq_name string, taxonomy string", ("s1", "V;R;K;P;Caudoviricetes;O;F"), ("s2", "V;R;K;P;Other_viricetes"), ("s3", None), ("s4", "Viruses;;;;;;Anelloviridae"))
    scores = make(spark, "seq_name string, ref string, normscore double", ("s1", "Phage_one_x--A1", 50.0), ("s1", "Other--A2", 10.0), ("s2", "Phage_one_x--A1", 50.0), ("s4", "Seg-1-A3", 9.0))
    vmr = make(spark, "Species string, Genus string, Family string, `Order` string, Class string", ("Phage one_x", "G", "F", "O", "Caudoviricetes"), ("Seg", "g", "f", "o", "Cardeaviricetes"))
    got = {r.seq_name: (r.Class, r.Genus) for r in taxonomy.taxonomy(classified, scores, vmr).collect()}
    assert got == {"s1": ("Caudoviricetes", "G"), "s2": ("Other_viricetes", None), "s3": (None, None), "s4": ("Cardeaviricetes", None)}
    assert {r.seq_name: r.Genus for r in taxonomy.taxonomy(classified, scores, vmr, segmented=True).collect()}["s4"] == "g"
    assert rows(taxonomy.split_by(classified)) == [("s1", "Caudoviricetes"), ("s2", "Other_viricetes"), ("s4", "Cardeaviricetes")]


def test_accessions(spark):
    vmr = make(spark, "`Isolate ID` string, `Exemplar or additional isolate` string, `Virus GENBANK accession` string", ("i1", "E", "DNA-C: EF546812; DNA-M: EF546811(12.400)"), ("i2", "A", "HM246720, a:b:c"), ("i3", "E", None))
    got = taxonomy.accessions(vmr).select("Isolate ID", "Accession_Index", "Segment_Name", "Accession", "Start_Loc", "End_Loc", "suspect")
    assert rows(got) == [("i1", 1, "DNA-C", "EF546812", "", "", False), ("i1", 2, "DNA-M", "EF546811", "12", "400", False), ("i2", 1, None, "HM246720", "", "", False)]
    assert taxonomy.accessions(vmr, "A").count() == 1
    head = make(spark, "Species string, Segment_Name string, Accession string", ("A b-c", None, "X1"), ("A b", "S 1", "X2"))
    assert [r.h for r in head.select(taxonomy.fasta_header().alias("h")).collect()] == ["A_b_c--X1", "A_b-S_1-X2"]
    protein = make(spark, "description string", ("UniRef50_A Tail fiber n=3 Tax=x RepID=R1", ), ("UniRef50_B Phage protein n=1 RepID=R2",))
    assert [r.h for r in protein.select(taxonomy.protein_header().alias("h")).collect()] == ["UniRef50_A 30~~~80~~~80~~~R1~~~Tail fiber~~~UniRef:UniRef50_A", "UniRef50_B 30~~~80~~~80~~~R2~~~hypothetical protein~~~UniRef:UniRef50_B"]


def test_hosts(spark):
    info = make(spark, schemas.HOST_INFO, ("g1", "tax1"), ("g2", "tax2"))
    spacers = make(spark, schemas.SPACER_MAP, *[(f"g1:{k}", "v1", k, k, "+", 1, "", "", "", "") for k in range(7)], *[(f"g2:{k}", "v1", k, k, "+", 0, "", "", "", "") for k in range(3)], ("g1:z", "v2", 1, 1, "+", 2, "", "", "", ""), ("gx:z", "v3", 1, 1, "+", 0, "", "", "", ""))
    hits, found = host.crispr_host(spacers, info)
    assert hits.count() == 10 and rows(found) == [("v1", 10, 7, "tax1", 0.7)]
    matrix = make(spark, "row string, col string, value double", ("g1", "v2", 0.2), ("g2", "v2", 0.19))
    genomes = matrix.withColumn("row", F.concat(F.lit("GCA_00000"), F.substring("row", 2, 1), F.lit(".1_x")))
    hosts = make(spark, schemas.HOST_INFO, ("GCA_000001.1", "tax1"))
    phits, pfound = host.phist_host(genomes, hosts)
    assert rows(phits.select("Target id", "Genome")) == [("v2", "GCA_000001.1")] and rows(pfound)[0][:4] == ("v2", 1, 1, "tax1")
    done, rest = host.cascade(make(spark, "id string, seq string", ("v1", ""), ("v2", ""), ("v3", "")), pfound, found)
    assert rows(done.select("id", "step")) == [("v1", "crispr"), ("v2", "phist")] and rows(rest.select("id")) == [("v3",)]
    r = random.Random(1)
    seq = "".join(r.choices("ACGT", k=300))
    near = host.kmer_matrix(make(spark, "id string, seq string", ("v", seq[50:150]), ("w", "A" * 100)), make(spark, "id string, seq string", ("h", seq)))
    assert rows(near) == [("h", "v", 1.0)]


def test_lifestyle(spark):
    got = lifestyle.lifestyle(
        make(spark, "seq_name string, topology string, provirus string", ("s", "t", "No"), ("u", "t", "No"), ("w", "t", "No")),
        make(spark, schemas.BACPHLIP, ("s", 0.1, 0.9), ("u", 0.5, 0.5)),
        make(spark, "protein_id string, hash string", ("s_1", "h1"), ("s_2", "h1"), ("u_1", "h2"), ("u_2", "h3")),
        make(spark, schemas.PHARAOH, ("h1", "p", "integrase", "integration and excision"), ("h2", "p", "tail", None)),
        make(spark, schemas.PHOLD, ("h1", "p", "x", "site-specific recombinase")),
        make(spark, schemas.EMPATHI, ("h3", "a", 0.9), ("h2", "a", 0.89)),
    )
    assert rows(got.select("seq_name", "phrog_integrases", "phrog_integration_excision", "empathi_integration")) == [("s", 4, 2, None), ("u", None, None, 1)]


def test_annotation_tables(spark):
    bakta = make(spark, "`#Sequence Id` string, `Locus Tag` string, Accession string", ("s", "t1", None), ("s", "t2", "UniRef50_X"), ("s", "t3", "SO:1"))
    assert rows(annotate.uniprot(bakta, make(spark, schemas.FOLDSEEK)).select("Locus Tag", "Foldseek Reference")) == [("t1", None), ("t2", None), ("t3", None)]
    assert rows(annotate.no_hit_proteins(make(spark, "id string, seq string", ("t1", "M"), ("t2", "M"), ("t3", "M")), bakta).select("id")) == [("t1",), ("t3",)]
    k = "`Locus Tag` string, {} int"
    full = annotate.defense(make(spark, k.format("a"), ("x", 1)), make(spark, k.format("b"), ("y", 2)), make(spark, k.format("c"), ("y", 3), ("z", 4)))
    assert rows(full) == [("x", 1, None, None), ("y", None, 2, 3), ("z", None, None, 4)]
    pharokka = make(spark, "gene string, pyhmmer_bitscore double, pyhmmer_evalue double, phrog string, annot string, category string", ("g", 1.0, 1.0, "p", "a", "c"))
    phold = make(spark, "cds_id string, phrog string, `function` string, product string, annotation_method string, annotation_confidence string, bitscore double, fident double, evalue double, prostt5_confidence double", ("g", "p", "f", "o", "pharokka", "h", 1.0, 1.0, 1.0, 1.0))
    phynteny = make(spark, "ID string, phrog_id string, phynteny_category string, phynteny_confidence double", ("g", "q", "c", 0.5))
    row = annotate.phrogs(pharokka, phold, phynteny).first()
    assert (row["Pharokka Phrog"], row["Phold Phrog"], row["Phynteny Phrog"]) == ("p", None, "q")
    done, rest = annotate.cascade(make(spark, "id string", ("a",), ("b",)), [("t", make(spark, "id string", ("a",)))])
    assert rows(done) == [("a", "t")] and rows(rest) == [("b",)]


def test_domains_are_compared_with_the_first_only(spark):
    d = make(spark, "gene string, hmm string, score double, start_text string, start double, end double", ("c_1", "A", 50.0, "10", 10.0, 100.0), ("c_1", "B", 40.0, "200", 200.0, 300.0), ("c_1", "C", 30.0, "250", 250.0, 350.0), ("c_1", "D", 20.0, "50", 50.0, 120.0), ("c_1", "E", 10.0, "100", 100.0, 110.0))
    assert rows(verify.chosen_domains(d)) == [("c_1", "A"), ("c_1", "B"), ("c_1", "C"), ("c_1", "E")]


def test_verify(spark):
    table = make(spark, schemas.CLASSIFIER, ("V", 0, 0, 9, 1e-4, 1e-4, 0.5, 1e-4), ("P", 9, 0, 0, 0.5, 1e-4, 1e-9, 0.3), ("C", 0, 9, 0, 1e-4, 0.5, 1e-9, 0.3), ("N", 1, 1, 1, 0.1, 0.1, 0.1, 0.1))
    domains = make(spark, "gene string, hmm string, score double, start_text string, start double, end double", *[(f"{c}_1", h, 9.0, "1", 1.0, 2.0) for c, h in (("v", "V"), ("p", "P"), ("c", "C"), ("n", "N"), ("m", "N"))])
    contigs = make(spark, "id string, length long, circular string", *[(c, n, o) for c, n, o in (("v", 10, "-"), ("p", 10, "-"), ("c", 10, "-"), ("n", 10, "-"), ("m", 3001, "-"), ("x", 10, "-"), ("y", 10, "+"))])
    got = {r["Contig name"]: (r.Prediction, r.Score) for r in verify.verify(contigs, domains, table).collect()}
    assert got == {"v": ("Virus", "8.52"), "p": ("Plasmid", "8.52"), "c": ("Chromosome", "-8.52"), "n": ("Uncertain - too short", "0.00"), "m": ("Uncertain - viral or bacterial", "0.00"), "x": ("Uncertain - too short", "-"), "y": ("Uncertain - viral or bacterial", "-")}
    blast = verify.with_blast(verify.verify(contigs, domains, table), make(spark, "query string, hit string", ("v", "h")))
    assert {r["Contig name"]: r.hit for r in blast.collect()}["x"] == "No BLAST hits"


def test_training(spark):
    hits = make(spark, "hmm string, kind string, i_evalue double", *[("A", "viral", 1e-9)] * 10, *[("A", "chrom", 1e-9)] * 2, *[("B", "plasmid", 1e-6)] * 9, ("B", "plasmid", 1e-5), ("Z", "viral", 1e-9))
    got = verify.train(hits, make(spark, "hmm string", ("A",), ("B",), ("C",))).collect()
    assert [(r.hmm, r.n_plasmid, r.n_chrom, r.n_viral) for r in got] == [("A", 0, 2, 10)]
    assert got[0].p_viral == pytest.approx(10.01 / 10.03) and got[0].p_nonviral == pytest.approx(2.01 / 11.03)


def slow_align(a, b):
    n, m = len(a), len(b)
    s = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            s[i][j] = max(0, s[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), s[i - 1][j] - 10, s[i][j - 1] - 10)
    return max(max(r) for r in s)


def test_alignment_scores():
    r = random.Random(3)
    for _ in range(60):
        a, b = ("".join(r.choices("ACGT", k=r.randint(1, 60))) for _ in "ab")
        if r.random() < 0.5:
            b = a[:20] + r.choice("ACGT") + a[20:]
        found = align(a, b)
        assert found.score == slow_align(a, b)
        again = sum(1 if x == y else -10 if "-" in (x, y) else -1 for x, y in zip(found.first, found.second, strict=True))
        assert again == found.score
        assert a[found.start_first :].startswith(found.first.replace("-", "")) and b[found.start_second :].startswith(found.second.replace("-", ""))
    assert align("AAAACCCC", "CCCCGGGG", local=False).first == "CCCC"


def test_bias():
    assert template_bias("A" * 10, "C" * 7 + "AAA") == (True, 7, 7)
    assert not template_bias("A" * 10, "C" * 6 + "AAAA").template
    assert not template_bias("A" * 7 + "CCCC", "G" * 11).template  # 7 of 11 is under the share
    assert not template_bias("A" * 9 + "N", "C" * 9 + "N").template
    assert template_bias("T" * 8, "C" * 8, "T").template
    assert mismatch_profile("AATC", "CATG") == {"A": 1, "T": 0, "C": 1, "G": 0}


def test_codon_sums():
    seq = "AACGTTAATAACCCCAACAAT" * 6
    got = codon_sums(seq, ("AAC", "AAT"), 30)
    for p in range(30, len(seq)):
        assert got[p] == sum(seq[e - 2 : e + 1] in ("AAC", "AAT") for e in range(p, p - 30, -3))


def repeat(seed):
    r = random.Random(seed)
    template = list("".join(r.choices("ACGT", k=140)))
    for k in range(20, 120, 9):
        template[k : k + 3] = "AAC"
    variable = list(template)
    for k in range(20, 120, 9):
        variable[k] = r.choice("CGT")
        variable[k + 1] = r.choice("CGT")
    pad = lambda n: "".join(r.choices("ACGT", k=n))
    return pad(400) + "".join(template) + pad(600) + "".join(variable) + pad(300)


def test_retroelements(spark):
    r = random.Random(4)
    data = [("dgr", repeat(5)), ("none", "".join(r.choices("ACGT", k=1500))), ("short", "ACGT"), ("null", None)]
    seqs = make(spark, "id string, seq string", *data)
    found = dgr.scan(seqs).collect()
    assert {x.id for x in found} == {"dgr"}
    best = max(found, key=lambda x: x.at_a)
    assert abs(best.template_begin - 400) < 160 and abs(best.variable_begin - 1140) < 160 and best.at_a >= 7 and best.length >= 60
    assert dgr.scan(seqs, make(spark, "id string, begin long, end long", ("dgr", 0, 500))).count() == 0
    assert seeds("A" * 30) == []


def test_candidates(spark):
    hits = make(spark, "r_gene string, identity double, tstart long, tend long", ("s", 90.0, 10, 20), ("s", 90.0, 18, 30), ("s", 90.0, 60, 50))
    got = dgr.candidates(hits, make(spark, "id string, seq string", ("s", "ACGT" * 30)), 2)
    assert rows(got.select("strand", "begin", "end")) == [("+", 8, 32), ("-", 48, 62)]


def test_species(spark):
    classified = make(spark, "seq_name string, contig_length long, proviral_length long, viral_genes long, completeness_method string, source_db string", ("a", 10, None, 3, "AAI", "x"), ("b", None, 12, 3, "DTR", "x"), ("c", 9, None, 1, "AAI", "x"), ("d", 9, None, 1, "AAI", "x"))
    done = make(spark, "contig_id string, aai_expected_length string", ("a", "11"), ("b", "NA"), ("c", "9"))
    ani = make(spark, schemas.ANI, ("a", "b", 0.97, 0.9, 0.1), ("b", "c", 0.9, 1.0, 1.0))
    info, reps = cluster.species(cluster.ani_edges(ani), classified, done)
    assert {(r.seq_name, r.votu_rep) for r in info.collect()} == {("a", "b"), ("b", "b"), ("c", "c")}  # d has no completeness row
    r = random.Random(8)
    seq = "".join(r.choices("ACGT", k=400))
    near = cluster.kmer_edges(make(spark, "id string, seq string", ("p", seq), ("q", seq), ("z", seq[::-1])), fraction=1)
    assert rows(near) == [("p", "q", 1.0)]


def test_release(spark, tmp_path):
    from sequoir.sources.sinks import read_release

    classified = make(spark, "seq_name string, completeness_method string, virus_classification string, contig_length long, proviral_length long", ("a", "AAI", "confident", 1, None), ("b", "DTR", "confident", 1, None), ("c", None, "confident", 1, None))
    hashes = make(spark, schemas.SEQ_HASH, ("a", "h", "AC"), ("b", "h", "AC"), ("c", "i", "GG"))
    new, ledger = release.unique_sequences(hashes, classified, spark.createDataFrame([], schemas.SEQ_LEDGER))
    assert rows(new.select("original_id")) == [("b",), ("c",)]
    assert release.unique_sequences(hashes, classified, ledger)[0].count() == 0
    proteins, all_ = release.unique_proteins(make(spark, schemas.PROTEIN, ("p2", "M", "h"), ("p1", "M", "h")), spark.createDataFrame([], schemas.PROTEIN_LEDGER))
    assert rows(proteins) == [("h", "M")] and [r.protein_id for r in all_.collect()] == ["p1", "p2"]
    out = release.plan({"classify": classified, "hashes": hashes}, Config(stages=Stages(anicluster=False)))
    assert rows(out["id_mapping"]) == [("b", "SEQ-1"), ("c", "SEQ-2")]
    config = Config(release="2", previous=str(tmp_path / "release_1"), output=str(tmp_path))
    first = release.update(spark, {"seqhash": ledger}, Config(release="1", output=str(tmp_path)))
    second = release.update(spark, {"seqhash": ledger}, config)
    assert read_release(spark, second, "seqhash", ledger.schema).count() == 2 * read_release(spark, first, "seqhash", ledger.schema).count() > 0
    again = release.plan({"classify": classified, "hashes": hashes}, config)
    assert again["unique"].count() == 0


def test_stages_are_switched(spark):
    assert release.plan({}, Config()) == {}
    classified = make(spark, "seq_name string, taxonomy string", ("s", None))
    off = Config(stages=Stages(taxonomy=False))
    tables = {"classify": classified, "scores": make(spark, "seq_name string, ref string, normscore double"), "vmr": make(spark, "Species string, Genus string, Family string, `Order` string, Class string")}
    assert "taxonomy" in release.plan(tables, Config()) and "taxonomy" not in release.plan(tables, off)
