"""Column expressions for identifiers, lineages, flags and null-safe predicates.

All are built-in expressions, so that they stay inside generated code and
filters on them reach the scan where Spark can push them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

RANKS = ("Root", "Realm", "Kingdom", "Phylum", "Class", "Order", "Family")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def genome_of(gene: Column | str) -> Column:
    """A gene's genome: the id without its last `_` part."""
    return F.regexp_replace(col(gene), "_[^_]*$", "")


def genome_of_numbered(gene: Column | str) -> Column:
    """A gene's genome: the id without a numeric `_` suffix."""
    return F.regexp_replace(col(gene), r"_\d+$", "")


def strip_provirus(name: Column | str) -> Column:
    """A sequence's id without its provirus suffix.

    What may follow the word is anything without the letters of `|provirus`, as
    the pattern has a class of characters and not a word there.
    """
    return F.regexp_replace(col(name), r"\|provirus[^|provirus]*$", "")


def part(c: Column | str, separator: str, i: int) -> Column:
    """The i-th part from 0 (from the end if negative) of a split by a literal; null past the end."""
    parts = F.split(col(c), f"\\Q{separator}\\E")
    return F.get(parts, F.lit(i) if i >= 0 else F.size(parts) + i)


def replace_first(c: Column | str, literal: str, by: str) -> Column:
    """The first occurrence of a literal replaced."""
    c = col(c)
    at = F.instr(c, literal)
    return F.when(at > 0, F.concat(F.substring(c, F.lit(1), at - 1), F.lit(by), F.substring(c, at + len(literal), F.length(c)))).otherwise(c)


def family_of(taxonomy: Column | str) -> Column:
    """The last of several lineage parts, trimmed; empty for one part or null."""
    parts = F.split(col(taxonomy), ";")
    return F.when(F.size(parts) > 1, F.trim(F.element_at(parts, -1))).otherwise("")


def lineage(taxonomy: Column | str) -> dict[str, Column]:
    """A column for every rank; null where the lineage is shorter."""
    return {rank: part(taxonomy, ";", i) for i, rank in enumerate(RANKS)}


def class_label(taxonomy: Column | str) -> Column:
    """Class of a virus lineage: the family Anelloviridae has its own, others give theirs or `No class`; null stays null."""
    t = col(taxonomy)
    return F.when(t.contains("Anelloviridae"), "Cardeaviricetes").when(~t.contains("viricetes"), "No class").when(t.contains("viricetes"), part(t, ";", 4))


def not_contains_or_null(c: Column | str, literal: str) -> Column:
    """True where the text lacks the literal or is null."""
    return ~col(c).contains(literal) | col(c).isNull()


def number_or_null(c: Column | str, kind: str = "double") -> Column:
    """The value as a number; null where it isn't one."""
    return col(c).try_cast(kind)


def flag(condition: Column, value: int = 1) -> Column:
    """value where the condition holds, else 0, also where it is null."""
    return F.when(condition, value).otherwise(0)


def sum_flags(flags: Iterable[Column | str]) -> Column:
    """Sum across columns with null as 0."""
    return reduce(add, (F.coalesce(col(f), F.lit(0)) for f in flags))


def count_true(condition: Column) -> Column:
    """Rows for which the condition holds, as an aggregate; 0 if none."""
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0).cast("long"))


def overlaps(c: Column | str, values: Sequence[str]) -> Column:
    """Whether a list has any of the values; null for a null list."""
    return F.size(F.array_intersect(col(c), F.array(*map(F.lit, values)))) > 0


def reverse_complement(seq: Column | str) -> Column:
    """Reverse complement of a DNA text; other letters stay."""
    return F.translate(F.reverse(col(seq)), "ACGTacgt", "TGCAtgca")


def joined(parts: Iterable[Column | str], separator: str = "-") -> Column:
    return F.concat_ws(separator, *parts)


def wrapped(seq: Column | str, width: int = 70) -> Column:
    """A sequence in lines of a width."""
    return F.regexp_replace(col(seq), f"(.{{{width}}})(?=.)", "$1\n")


def fasta_record(name: Column | str, seq: Column | str, width: int | None = None) -> Column:
    return F.concat(F.lit(">"), col(name), F.lit("\n"), wrapped(seq, width) if width else col(seq))


def circular_overlap(seq: Column | str, least: int = 51, most: int = 200, min_length: int = 500) -> Column:
    """The greatest k from most down to least for which the first and last k letters are equal; null if none or too short."""
    s = col(seq)
    hits = F.filter(F.sequence(F.lit(most), F.lit(least), F.lit(-1)), lambda k: (k < F.length(s)) & (F.left(s, k) == F.right(s, k)))
    return F.when(F.length(s) >= min_length, F.get(hits, 0))


def circular_extended(seq: Column | str, overlap: Column | str, most: int = 5000) -> Column:
    """A circular sequence lengthened by what follows its overlap, up to the letter `most`."""
    s, k = col(seq), col(overlap)
    return F.when(k.isNull(), s).otherwise(F.concat(s, F.substring(s, k + 1, F.lit(most) - k)))


def strand(sam_flag: Column | str) -> Column:
    """+ for flag 0 and - for flag 16; any other is an error."""
    f = col(sam_flag)
    return F.when(f == 0, "+").when(f == 16, "-").otherwise(F.raise_error(F.concat(F.lit("unexpected flag "), F.coalesce(f.cast("string"), F.lit("null")))))
