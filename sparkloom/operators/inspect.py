"""Table inspection: schema rows, schema hash, schema drift and column profiles.

The schema itself is driver-side metadata (no job).  Profiles run as one
aggregate over every column (partial aggregation on each partition, one
small final merge), and the per-column rows come out of ``stack``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, MapType, StructType

SAMPLE_VALUES = 5

SCHEMA_COLUMNS = "ordinal int, column_name string, data_type string, nullable boolean, metadata string"


def schema_rows(df: DataFrame) -> list[tuple]:
    return [
        (i, f.name, f.dataType.simpleString(), bool(f.nullable), json.dumps(f.metadata, sort_keys=True, ensure_ascii=False))
        for i, f in enumerate(df.schema.fields)
    ]


def schema_frame(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """One row per column: ordinal, name, simple type string, nullability, field metadata JSON."""
    spark = spark or df.sparkSession
    return spark.createDataFrame(schema_rows(df), SCHEMA_COLUMNS)


def schema_hash(df: DataFrame) -> str:
    """sha256 over the sorted-key JSON of ``{column: {type, nullable, metadata}}``."""
    import hashlib

    doc = {f.name: {"type": f.dataType.simpleString(), "nullable": f.nullable, "metadata": f.metadata} for f in df.schema.fields}
    return hashlib.sha256(json.dumps(doc, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def _json_string(c: Column) -> Column:
    escaped = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def schema_hash_frame(schema: DataFrame) -> DataFrame:
    """The same hash computed by Spark from a schema frame (for schemas held as data)."""
    entry = F.concat(
        _json_string(F.col("column_name")),
        F.lit(': {"metadata": '),
        F.col("metadata"),
        F.lit(', "nullable": '),
        F.when(F.col("nullable"), F.lit("true")).otherwise(F.lit("false")),
        F.lit(', "type": '),
        _json_string(F.col("data_type")),
        F.lit("}"),
    )
    body = F.array_join(F.sort_array(F.collect_list(entry)), ", ")
    return schema.agg(F.sha2(F.concat(F.lit("{"), body, F.lit("}")), 256).alias("schema_hash"))


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Compare two schema frames: added / removed / type_changed / nullability_changed columns."""
    o = old.select(
        F.col("column_name"), F.col("data_type").alias("old_type"), F.col("nullable").alias("old_nullable")
    )
    n = new.select(
        F.col("column_name"), F.col("data_type").alias("new_type"), F.col("nullable").alias("new_nullable")
    )
    j = o.join(n, "column_name", "full_outer")
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "type_changed")
        .when(F.col("old_nullable") != F.col("new_nullable"), "nullability_changed")
    )
    return j.withColumn("change", change).filter(F.col("change").isNotNull()).select(
        "column_name", "change", "old_type", "new_type", "old_nullable", "new_nullable"
    )


def _column(name: str) -> Column:
    """A top-level column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def _orderable(dt) -> bool:
    return not isinstance(dt, (MapType,)) and not (
        isinstance(dt, (ArrayType, StructType)) and "map<" in dt.simpleString()
    )


def _as_text(c: Column, dt) -> Column:
    if isinstance(dt, BinaryType):
        return F.hex(c)
    if isinstance(dt, (ArrayType, StructType, MapType)):
        return F.to_json(c)
    return c.cast("string")


def _distinct_key(c: Column, dt) -> Column:
    """A string with the same equality as the value (-0.0 and 0.0 count as one, as in Spark)."""
    if isinstance(dt, (DoubleType, FloatType)):
        c = F.when(c == 0, F.lit(0.0).cast(dt)).otherwise(c)
    return _as_text(c, dt)


def profile_columns(df: DataFrame, approximate: bool = False, rsd: float = 0.05) -> DataFrame:
    """Per column: non-null count, distinct count, min and max (as text) and sample values.

    The sample values are the first five distinct ones in the order of their
    text (fewer if the column has fewer; none with ``approximate``).

    Counts, minima and maxima come from one wide aggregate over all columns.
    Exact distinct counts use a long form ``(ordinal, value)``: deduplicated
    by a hash aggregate that is partial per task, then counted per column.
    (Several ``count(DISTINCT)`` in one aggregate would instead expand every
    row once per column and sort.)  ``approximate`` uses HyperLogLog++
    sketches in the wide aggregate and needs no second pass.
    """
    fields = df.schema.fields
    aggs = []
    for i, f in enumerate(fields):
        c = _column(f.name)
        aggs.append(F.count(c).alias(f"n{i}"))
        if approximate:
            aggs.append(F.approx_count_distinct(c, rsd).alias(f"d{i}"))
        if _orderable(f.dataType):
            aggs.append(_as_text(F.min(c), f.dataType).alias(f"lo{i}"))
            aggs.append(_as_text(F.max(c), f.dataType).alias(f"hi{i}"))
        else:
            aggs.append(F.lit(None).cast("string").alias(f"lo{i}"))
            aggs.append(F.lit(None).cast("string").alias(f"hi{i}"))
    wide = df.agg(*aggs)
    entries = [
        F.struct(
            F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"n{i}").cast("bigint").alias("total_count"),
            (F.col(f"d{i}") if approximate else F.lit(None)).cast("bigint").alias("distinct_count"),
            F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
        )
        for i, f in enumerate(fields)
    ]
    rows = wide.select(F.inline(F.array(*entries)))
    if approximate:
        return rows
    pairs = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), _distinct_key(_column(f.name), f.dataType).alias("v"))
        for i, f in enumerate(fields)
    ])
    values = df.select(F.explode(pairs).alias("p")).select("p.ordinal", "p.v").filter(F.col("v").isNotNull()).distinct()
    distinct = values.groupBy("ordinal").agg(F.count(F.lit(1)).alias("nd"))
    # a rank limit is applied by each task before the shuffle, so a column sends a few values a task
    ranked = values.withColumn("rn", F.row_number().over(Window.partitionBy("ordinal").orderBy("v"))).filter(F.col("rn") <= SAMPLE_VALUES)
    samples = ranked.groupBy("ordinal").agg(F.sort_array(F.collect_list("v")).alias("samples"))
    out = rows.drop("distinct_count").join(distinct, "ordinal", "left").join(samples, "ordinal", "left")
    return out.select("ordinal", "column_name", "data_type", "total_count",
                      F.coalesce("nd", F.lit(0)).cast("bigint").alias("distinct_count"), "min_value", "max_value",
                      F.coalesce("samples", F.array().cast("array<string>")).alias("sample_values"))


def sample_rows(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows (a top-k when ``order_by`` is given, else any ``n`` rows)."""
    if order_by:
        return df.orderBy(*order_by).limit(n)
    return df.limit(n)
