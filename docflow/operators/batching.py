"""Rows into shards and batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docflow.lineage import cut


def numbered(df: DataFrame, order: str) -> DataFrame:
    """Adds row_number from 1 in one global order, without one task for all rows: range partitions are counted, then offset."""
    parts = cut(df.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()))
    counts = {r["_part"]: r["count"] for r in parts.groupBy("_part").count().collect()}  # as many as partitions
    offset, begin = 0, {}
    for p in sorted(counts):
        begin[p], offset = offset, offset + counts[p]
    if not begin:
        return df.withColumn("row_number", F.lit(0).cast("long"))
    first = F.element_at(F.create_map(*[F.lit(x) for p, n in begin.items() for x in (p, n)]), F.col("_part"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return parts.withColumn("row_number", (first + place + 1).cast("long")).drop("_part", "_id")


def by_count(df: DataFrame, order: str, size: int, name: str = "batch") -> DataFrame:
    """Adds the number of the batch of `size` rows, from 0, in the given order."""
    return numbered(df, order).withColumn(name, F.floor((F.col("row_number") - 1) / size).cast("long")).drop("row_number")


def by_bytes(df: DataFrame, group: str, order: str, size_col: str, most_rows: int = 200, most_bytes: int = 1 << 20, row_cap: int = 1000, byte_cap: int = 2 << 20) -> DataFrame:
    """Adds batch, from 0 in each group: rows in order fill a batch while neither limit is exceeded; a larger row stands alone.

    Filling is sequential, so each group is one task's work: groups are shards of bounded size (see by_count). Only
    the columns group, order and size travel. Limits are clamped to the caps.
    """
    rows, size = max(1, min(most_rows, row_cap)), min(most_bytes, byte_cap)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        batch, n, total, out = 0, 0, 0, []
        for b in pdf[size_col]:
            if n and (n >= rows or total + b > size):
                batch, n, total = batch + 1, 0, 0
            n, total = n + 1, total + b
            out.append(batch)
        return pdf.assign(batch=out)

    return df.select(group, order, size_col).groupBy(group).applyInPandas(fill, f"{group} {kinds[group]}, {order} {kinds[order]}, {size_col} {kinds[size_col]}, batch bigint")


def batch_sizes(df: DataFrame, batch: str = "batch") -> DataFrame:
    return df.groupBy(batch).agg(F.count("*").alias("rows"))


def top_per_group(df: DataFrame, group: str, order: list, n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= n)
