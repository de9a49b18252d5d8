"""Gapless row numbers without one task for all rows, and pairing of two tables by position.

Rows are dealt out in ranges of the sort keys and of a hash of the whole row,
so equal keys are cut too; a range numbers its rows, and the rows of all ranges
before it, a count for each range, are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.session import staging_path

LOW_BITS = (1 << 33) - 1  # of monotonically_increasing_id: the row in its partition


def _free(df: DataFrame, base: str) -> str:
    while base in df.columns:
        base += "_"
    return base


def numbered(df: DataFrame, order_by: Sequence[str | Column], name: str = "row_number", ranges: int | None = None) -> DataFrame:
    """``df`` with the row's number (from 0) in the order of ``order_by``; ties are ordered by a hash of the row.

    Nulls come first, as in ``orderBy``; rows that are equal throughout get numbers in any order.
    The rows are staged once in ``spark.checkpoint.dir``, so ranges and numbers hold if executors are lost.
    """
    spark = df.sparkSession
    tie, part, place, before = (_free(df, n) for n in ("tie", "part", "place", "rows_before"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by]
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    dealt = df.withColumn(tie, hashed).repartitionByRange(n, *keys, tie).sortWithinPartitions(*keys, tie)
    path = staging_path(spark, "numbered")
    dealt.withColumn(part, F.spark_partition_id()).withColumn(place, F.monotonically_increasing_id().bitwiseAND(LOW_BITS)).write.parquet(path)
    rows = spark.read.parquet(path)
    total, starts = 0, []
    for r in rows.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy(part).collect():  # a row for each range
        starts.append((r[part], total))
        total += r["n"]
    offsets = spark.createDataFrame(starts, f"{part} int, {before} long")
    out = rows.join(F.broadcast(offsets), part)
    return out.select(*(F.col(f"`{c}`") for c in df.columns), (F.col(before) + F.col(place)).alias(name))


def pair_by_position(left: DataFrame, right: DataFrame, left_order: Sequence[str | Column], right_order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """The n-th row of ``left`` beside the n-th of ``right``, with ``name`` = n from 0; rows beyond the shorter side's end have no pair.

    Column names must differ between the sides.
    """
    return numbered(left, left_order, name).join(numbered(right, right_order, name), name)
