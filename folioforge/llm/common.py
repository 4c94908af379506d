"""Helpers the operators of this package share."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import clear_shared, shared_dir, table
from ..session import stored as written

__all__ = ["by_size", "clear_shared", "every_of", "keyed_join", "one_of", "shared_dir", "shares_of", "table", "texts_of", "vocabulary", "written"]


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the folder can be set with FOLIOFORGE_TOKENIZERS."""
    folder = os.environ.get("FOLIOFORGE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


SHARES, LEAST_HOT = 1000, 64


def shares_of(on: list[str], counts: DataFrame, total: int) -> Column:
    """Over how many tasks the rows of a key (columns ``on``) should be dealt: 1, but for hot keys, of more than a thousandth of all ``total`` rows.

    counts: the keys with their number of rows ``n``. There are fewer than a thousand hot keys: their hashes and numbers of shares (powers
    of two) become part of the plan, so that no join is needed to know them.
    """
    limit = max(LEAST_HOT, -(-total // SHARES))
    tiers: dict[int, list[int]] = {}
    for r in counts.where(F.col("n") > limit).select(F.xxhash64(*on).alias("key"), "n").collect():  # fewer than SHARES rows
        tiers.setdefault(1 << (-(-r["n"] // limit) - 1).bit_length(), []).append(r["key"])
    deal = F.lit(1)
    for shares, keys in sorted(tiers.items()):
        deal = F.when(F.xxhash64(*on).isin(keys), shares).otherwise(deal)
    return deal


def one_of(deal: Column, by: list[str | Column]) -> Column:
    """The share a row falls to, by a hash of the columns ``by``."""
    return F.pmod(F.xxhash64(*by), deal).cast("int")


def every_of(deal: Column) -> Column:
    """All shares of a key, a row for each."""
    return F.explode(F.sequence(F.lit(0), deal - 1))


def keyed_join(many: DataFrame, one: DataFrame, on: list[str], by: list[str | Column], counts: DataFrame | None = None, total: int | None = None, how: str = "inner") -> DataFrame:
    """many joined with one on the columns ``on``; the rows of a key that is hot in many are dealt over many tasks by the columns ``by``.

    counts: the keys with their number of rows ``n``, of all ``total`` rows or of a sample of that size (it settles the dealing, not the result).
    """
    counts = many.groupBy(*on).agg(F.count("*").alias("n")) if counts is None else counts
    deal = shares_of(on, counts, many.count() if total is None else total)
    return many.withColumn("_share", one_of(deal, by)).join(one.withColumn("_share", every_of(deal)), [*on, "_share"], how).drop("_share")


def by_size(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: at most 2,000 rows and about ``limit`` bytes of ``column`` each. At the end, freed memory goes back to the system."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        mean = max(1, col.nbytes // max(1, len(col)))
        step = max(1, min(2000, limit // mean))
        for at in range(0, len(batch), step):
            yield batch.slice(at, step)
        del batch, col
    give_back()


def give_back() -> None:
    """Workers outlive their tasks and are many on a machine: what a task has freed is not kept for the next one."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        return


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a column; a null is an empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]
