"""Work items: batching, grouping, routing, joining and validating."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sequoir.operators.rank import batches


def mix(*items: DataFrame) -> DataFrame:
    """All rows of all inputs, with duplicates."""
    return reduce(lambda a, b: a.unionByName(b), items)


#: Most rows of a list that every item is combined with.
SHORT_LIST = 10_000


def combine(left: DataFrame, right: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Pairs of items with equal keys or, without keys, every item with every row of a short list.

    The list is counted first: of more than SHORT_LIST rows it is refused, as
    the product would be.
    """
    if by:
        return left.join(right, list(by), "inner")
    rows = right.limit(SHORT_LIST + 1).collect()
    if len(rows) > SHORT_LIST:
        raise ValueError(f"a list of over {SHORT_LIST} rows needs a key to combine by")
    if not rows:
        return left.join(right, F.lit(False))
    listed = F.array(*(F.struct(*(F.lit(r[c]).cast(t).alias(c) for c, t in right.dtypes)) for r in rows))
    return left.withColumn("_sequoir_other", F.explode(listed)).select(*left.columns, *(F.col(f"_sequoir_other.{c}").alias(c) for c in right.columns))


def combine_all(items: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """Inner join of several inputs on their keys, one after another."""
    return reduce(lambda a, b: combine(a, b, by), items)


def group_tuple(df: DataFrame, keys: Sequence[str], values: Sequence[str], more_than: int = 0) -> DataFrame:
    """Values of each key as sorted lists, of groups of more than so many."""
    grouped = df.groupBy(*keys).agg(F.count("*").alias("_sequoir_n"), *(F.sort_array(F.collect_list(v)).alias(v) for v in values))
    return grouped.where(F.col("_sequoir_n") > more_than).drop("_sequoir_n")


def collate(df: DataFrame, order: Sequence[str], size: int, value: str, name: str = "items") -> DataFrame:
    """Batches of `size` items in order: batch, items."""
    dealt = batches(df, order, size)
    pairs = F.sort_array(F.collect_list(F.struct(*order, F.col(value).alias("_sequoir_value"))))
    return dealt.groupBy("batch").agg(F.transform(pairs, lambda x: x["_sequoir_value"]).alias(name))


def fork(df: DataFrame, outputs: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """One input as several named outputs with columns of their own."""
    return {name: df.select(*columns) for name, columns in outputs.items()}


def demux(df: DataFrame, column: str, labels: Sequence[str]) -> dict[str, DataFrame]:
    """Rows by the label they carry."""
    return {x: df.where(F.col(column) == x) for x in labels}


def non_empty(items: DataFrame, records: DataFrame, key: str, least: int = 1) -> DataFrame:
    """Items whose file has `least` records or more."""
    return items.join(records.groupBy(key).agg(F.count("*").alias("_sequoir_n")).where(F.col("_sequoir_n") >= least), key, "left_semi")


def invalid_groups(df: DataFrame, key: str, same: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    """Keys whose rows differ in a column that must be the same, or share a value of one that must be distinct. Null counts as a value."""
    kinds = lambda c: F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("\0null")))
    counted = df.groupBy(key).agg(F.count("*").alias("n"), *(kinds(c).alias(f"n_{c}") for c in [*same, *distinct]))
    wrong = reduce(lambda a, b: a | b, [F.col(f"n_{c}") != 1 for c in same] + [F.col(f"n_{c}") != F.col("n") for c in distinct])
    return counted.where(wrong)


def residuals(items: DataFrame, key: str, steps: Sequence[tuple[str, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """(items with the first step that has their key, items that none has); steps: name and keys, asked in order."""
    rest, found = items, None
    for name, keys in steps:
        known = keys.select(key).distinct()
        hit = rest.join(known, key, "left_semi").withColumn("step", F.lit(name))
        found = hit if found is None else found.unionByName(hit)
        rest = rest.join(known, key, "left_anti")
    return found, rest


def keyed_by_name(df: DataFrame, path: str, pattern: str, name: str) -> DataFrame:
    """A key taken from a file name by the pattern's first group; null where it doesn't fit."""
    got = F.regexp_extract(F.col(path), pattern, 1)
    return df.withColumn(name, F.when(got != "", got))


def require(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """df, failing as soon as a row breaks a named condition; unknown counts as broken."""
    for what, condition in conditions.items():
        df = df.where(F.when(F.coalesce(condition, F.lit(False)), True).otherwise(F.raise_error(F.lit(f"broken: {what}")).cast("boolean")))
    return df
