"""Lineages, classes and the accession table of the reference taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sequoir.functions.exprs import class_label, lineage, part
from sequoir.operators.rank import top1

ANELLO = "Viruses;Monodnavira;Shotukuvirae;Commensaviricota;Cardeaviricetes;Sanitavirales;Anelloviridae"


def taxonomy(classified: DataFrame, scores: DataFrame, vmr: DataFrame, segmented: bool = False) -> DataFrame:
    """seq_name, taxonomy and Class of all, with species, genus, family and order of the best reference where it is of the same class.

    The species is the reference's name before `--`, its first `_` read as a
    space. With segmented, names of segments (`Species-seg-ACC`) are read too.
    """
    own = classified.select("seq_name", "taxonomy").withColumn("Class", class_label("taxonomy"))
    name = F.when(F.col("ref").contains("--"), part("ref", "--", 0)).otherwise(F.regexp_replace("ref", "-[^-]*-[^-]*$", "")) if segmented else part("ref", "--", 0)
    best = top1(scores, ["seq_name"], [F.col("normscore").desc_nulls_first()], ["ref"])
    species = best.withColumn("Species", F.regexp_replace(name, "^([^_]*)_", "$1 "))
    named = species.join(vmr.select("Species", "Genus", "Family", F.col("Order"), "Class"), "Species", "left")
    return own.join(named, ["seq_name", "Class"], "left")


def ranked(classified: DataFrame) -> DataFrame:
    """classified with a column for every rank, without the unclassified."""
    tax = F.replace(F.replace("taxonomy", F.lit("Viruses;;;;;;Anelloviridae"), F.lit(ANELLO)), F.lit("Viruses;;;;;;"), F.lit("Unclassified"))
    named = classified.withColumn("taxonomy", tax).where(F.col("taxonomy").isNotNull() & (F.col("taxonomy") != "Unclassified"))
    return named.withColumns(lineage("taxonomy"))


def split_by(classified: DataFrame, rank: str = "Class") -> DataFrame:
    """seq_name with the value of a rank, for a partitioned writer."""
    return ranked(classified).select("seq_name", rank)


def accessions(vmr: DataFrame, kinds: str = "B") -> DataFrame:
    """A row for each accession of each isolate: index, segment, accession, subsequence and what else the table has.

    Lists are split at `;` and `,`; a part is `[SEGMENT:]ACCESSION[(start.end)]`.
    Parts with more than one colon are dropped. kinds: E exemplars, A
    additional isolates, B both. suspect marks what doesn't look like an
    accession: three letters or more in lower case, or three digits or fewer.
    """
    chosen = vmr.where(F.col("Exemplar or additional isolate") != "") if kinds == "B" else vmr.where(F.col("Exemplar or additional isolate") == kinds)
    listed = F.split(F.replace(F.replace("Virus GENBANK accession", F.lit(" "), F.lit("")), F.lit(","), F.lit(";")), ";")
    rows = chosen.select("*", F.posexplode(listed).alias("_i", "_part")).withColumn("_pair", F.split("_part", ":")).where(F.size("_pair") <= 2)
    segment = F.when(F.size("_pair") == 2, F.get("_pair", F.lit(0)))
    text = F.element_at("_pair", -1)
    ranged = r"^(\w+)\s*\((\d+)\.(\w+)\)"
    rows = rows.withColumns({"Accession_Index": F.col("_i") + 1, "Segment_Name": segment, "_text": text})
    located = F.col("_text").rlike(ranged)
    letters, digits = F.regexp_count("_text", F.lit("[a-z]")), F.regexp_count("_text", F.lit("[0-9]"))
    return rows.withColumns(
        {
            "Accession": F.when(located, F.regexp_extract("_text", ranged, 1)).otherwise(F.col("_text")),
            "Start_Loc": F.when(located, F.regexp_extract("_text", ranged, 2)).otherwise(""),
            "End_Loc": F.when(located, F.regexp_extract("_text", ranged, 3)).otherwise(""),
            "suspect": ~((letters < 3) & (digits > 3)),
        }
    ).drop("_i", "_part", "_pair", "_text")


def fasta_header(species: str = "Species", segment: str = "Segment_Name", accession: str = "Accession"):
    """Header id of a reference sequence: species, segment and accession by `-`; an empty segment leaves `--`."""
    clean = lambda c: F.translate(F.coalesce(F.col(c), F.lit("")), " -", "__")
    return F.concat(clean(species), F.lit("-"), clean(segment), F.lit("-"), F.col(accession))


def protein_header(header: str = "description"):
    """Header of a reference protein in the form that annotators read: uninformative names become `hypothetical protein`."""
    h = F.col(header)
    name = F.regexp_extract(F.regexp_extract(h, r"^(.*?) n=", 1), r"^\S+\s+(.*)$", 1)
    dull = h.rlike("(Uncharacterized|Phage|hypothetical) protein n=")
    acc = F.regexp_extract(h, r"^(\S+)", 1)
    return F.concat(acc, F.lit(" 30~~~80~~~80~~~"), F.regexp_extract(h, r"RepID=(\S+)", 1), F.lit("~~~"), F.when(dull, "hypothetical protein").otherwise(name), F.lit("~~~UniRef:"), acc)
