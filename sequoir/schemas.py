"""Schemas of the tables that the plans read; nothing is inferred."""

from __future__ import annotations

SAMPLESHEET = "sample string, source_db string, project string, `group` string, biosample string, acc string, fastq_1 string, fastq_2 string, fna string, virus_fna string"
FASTA = "id string, description string, seq string"
PROTEIN = "protein_id string, seq string, hash string"
SEQ_HASH = "original_id string, hash string, seq string"
PROTEIN_LEDGER = "protein_id string, hash string"
SEQ_LEDGER = "original_id string, hash string, completeness_method string"
ID_MAPPING = "original_id string, new_id string"
VIRUS_SUMMARY = "seq_name string, length long, topology string, coordinates string, n_genes long, genetic_code int, virus_score double, fdr double, n_hallmarks long, marker_enrichment double, taxonomy string"
GENES = "gene string, annotation_accessions string, plasmid_hallmark int, taxname string, marker string"
QUALITY = "contig_id string, contig_length long, proviral_length long, viral_genes long, host_genes long, provirus string, completeness double, completeness_method string, kmer_freq double, warnings string"
VERIFY = "`Contig name` string, Prediction string, Length long, Circular string, Score string, `Pfam hits` string"
COMPLETENESS = "contig_id string, contig_length long, aai_completeness double, aai_expected_length string, kmer_freq double"
MARKERS = "MARKER string, VIRUS_HALLMARK int, PLASMID_HALLMARK int"
CLASSIFIER = "hmm string, n_plasmid long, n_chrom long, n_viral long, p_plasmid double, p_chrom double, p_viral double, p_nonviral double"
M8 = "q_gene string, r_gene string, identity double, length long, mismatch long, gapopen long, qstart long, qend long, tstart long, tend long, evalue double, bitscore float"
SELF_SCORE = "genome string, genes long, selfscore double"
NORM_SCORE = "query string, reference string, norm_score double"
EDGES = "src string, dst string, w double"
CLUSTERS = "member string, cluster_id long"
ANI = "query string, reference string, ani double, qcov double, rcov double"
HOST_INFO = "Genome string, Repr_taxonomy string"
SPACER_MAP = "`Spacer id` string, `Target id` string, Start long, End long, Strand string, `N mismatches` int, CIGAR string, MD string, spacer string, flags string"
BACPHLIP = "seq_name string, virulent double, temperate double"
PHARAOH = "ID string, phrog string, annot string, category string"
PHOLD = "cds_id string, phrog string, function string, product string"
EMPATHI = "cds_id string, Annotation string, integration double"
FOLDSEEK = "`Locus Tag` string, `Foldseek Reference` string, `Foldseek Identity` double, `Foldseek Align Length` long, mismatch long, gapopen long, qstart long, qend long, tstart long, tend long, `Foldseek E-value` double, `Foldseek Bitscore` double"
VMR = (
    "`Isolate ID` string, `Exemplar or additional isolate` string, `Species Sort` long, `Isolate Sort` long, Realm string, Subrealm string, Kingdom string, Subkingdom string, Phylum string, "
    "Subphylum string, Class string, Subclass string, `Order` string, Suborder string, Family string, Subfamily string, Genus string, Subgenus string, Species string, ICTV_ID string, "
    "`Virus name(s)` string, `Virus GENBANK accession` string, `Genome coverage` string"
)
