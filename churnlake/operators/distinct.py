"""Exact distinct counts that can be merged, as bitmaps.

Ids are cut into buckets of 32,768 neighbouring values and each bucket's ids are
the bits of one bitmap (4 KB). Bitmaps of finer groups are merged into coarser
ones by OR, so one aggregate of the rows serves every level of a rollup, without
the row copies that several COUNT(DISTINCT) expand to. Meant for ids that a
sequence gave (users, documents); ids that are spread over all longs would be a
bitmap each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, by: Sequence[str], id_: str, *sums: Column) -> DataFrame:
    """``by``, ``id_bucket``, ``ids`` (bitmap) and the given aggregates of each
    group and bucket. Rows with a null id are in the bucket null, whose bitmap is
    empty: they count in the aggregates and not as an id."""
    return (df.withColumn("id_bucket", F.bitmap_bucket_number(id_))
            .groupBy(*by, "id_bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_)).alias("ids"), *sums))


def merged(bitmaps: DataFrame, by: Sequence[str], *sums: Column) -> DataFrame:
    """The same for coarser groups."""
    return bitmaps.groupBy(*by, "id_bucket").agg(F.bitmap_or_agg("ids").alias("ids"), *sums)


def distinct_ids(bitmaps: DataFrame, by: Sequence[str], name: str, *sums: Column) -> DataFrame:
    """``by``, the number of different ids of each group, and aggregates over its buckets."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("ids")).alias(name), *sums)


def rollup_ids(df: DataFrame, by: Sequence[str], id_: str, name: str, rows: str = "n_rows") -> DataFrame:
    """Distinct ids and rows by all of ``by``, by each shorter list of its first
    columns, and in total (null where a column is not grouped by), from one
    aggregate of ``df``; every level merges the one below it. ``level`` says how
    many columns a row is grouped by."""
    by = list(by)
    level = id_bitmaps(df, by, id_, F.count(F.lit(1)).alias(rows))
    out = None
    for n in range(len(by), -1, -1):
        if n < len(by):
            level = merged(level, by[:n], F.sum(rows).alias(rows))
        got = distinct_ids(level, by[:n], name, F.sum(rows).alias(rows)).withColumn("level", F.lit(n))
        out = got if out is None else out.unionByName(got, allowMissingColumns=True)
    return out.select("level", *by, name, rows)
