"""Exact deduplication against a ledger of hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sequoir.operators.rank import top1


def with_hash(df: DataFrame, seq: str = "seq", name: str = "hash") -> DataFrame:
    return df.withColumn(name, F.md5(F.col(seq)))


def ledger_update(new: DataFrame, ledger: DataFrame, key: str, ids: Sequence[str], prefer: Sequence[Column] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows of new that are first of their hash and not in the ledger, ledger with all of new's rows added).

    Which of several rows with a hash stands for it: the preferred, then the
    smallest id. A null hash is new to nothing and is left out of the first.
    Applying it again with the second result as ledger finds nothing new.
    """
    fresh = new.where(F.col(key).isNotNull()).join(ledger.select(key).distinct(), key, "left_anti").select(*new.columns)
    columns = [c for c in ledger.columns if c in new.columns]
    return top1(fresh, [key], list(prefer), list(ids)), ledger.select(*columns).unionByName(new.select(*columns))


def first_by_id(df: DataFrame, key: str, ties: Sequence[str]) -> DataFrame:
    """One row of each id, the first by the ties."""
    return top1(df, [key], [], ties)
