"""Inspection that follows a dataset's files: a stored profile of each file, refreshed for changed files alone.

The state is a Parquet table with a row for each data file and column: the
file's path, size and modification time, and a mergeable profile (rows, nulls, least and
greatest value, a distinct-count sketch).  A refresh lists the files (no data is
read), profiles those that are new or were replaced, drops those that are gone, and
writes the next version of the state; the dataset's profile is the merge over its files.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from sparkloom.errors import ValidationError

STATE = (
    "path string, modified timestamp, size bigint, column string, type string, rows bigint, nulls bigint, "
    "least_number double, greatest_number double, least string, greatest string, sketch binary"
)


def _versions(spark: SparkSession, state_path: str) -> list[int]:
    """Versions of the state, whose files appear when their write is committed."""
    try:
        found = files_of(spark, state_path).select(F.regexp_extract("path", r"/version=(\d+)/", 1).cast("int").alias("v")).distinct()
        return sorted(r["v"] for r in found.where("v is not null").collect())  # a row a version
    except AnalysisException:
        return []


def state(spark: SparkSession, state_path: str) -> DataFrame:
    """The newest stored state, empty if there's none."""
    versions = _versions(spark, state_path)
    if not versions:
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(f"{state_path.rstrip('/')}/version={versions[-1]}")


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """``(path, modified, size)`` of the Parquet files of a dataset: a listing, no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return listed.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def file_profiles(df: DataFrame) -> DataFrame:
    """``(path, column, type, rows, nulls, ...)`` of each file that ``df`` (a file-based scan) reads, in one aggregate."""
    simple = [f for f in df.schema.fields if f.dataType.simpleString() not in ("binary", "variant") and not f.dataType.simpleString().startswith(("map<", "array<", "struct<"))]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for n, f in enumerate(simple):
        c = F.col(f"`{f.name}`")
        number, text = (c.cast("double"), F.lit(None).cast("string")) if isinstance(f.dataType, NumericType) else (F.lit(None).cast("double"), c.cast("string"))
        aggs += [
            F.count(c).alias(f"n{n}"), F.min(number).alias(f"a{n}"), F.max(number).alias(f"b{n}"), F.min(text).alias(f"c{n}"), F.max(text).alias(f"d{n}"),
            F.hll_sketch_agg(c.cast("string")).alias(f"s{n}"),
        ]
    by_file = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(*aggs)
    rows = [
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col("rows"), (F.col("rows") - F.col(f"n{n}")).alias("nulls"), F.col(f"a{n}").alias("least_number"),
            F.col(f"b{n}").alias("greatest_number"), F.col(f"c{n}").alias("least"), F.col(f"d{n}").alias("greatest"), F.col(f"s{n}").alias("sketch"),
        )
        for n, f in enumerate(simple)
    ]
    return by_file.select("path", F.explode(F.array(*rows)).alias("p")).select("path", "p.*")


def refresh(spark: SparkSession, path: str, state_path: str) -> DataFrame:
    """Bring the state of the Parquet dataset at ``path`` up to date and return it; only new and replaced files are read."""
    old = state(spark, state_path)
    known = old.select(F.col("path").alias("old_path"), F.col("modified").alias("old_modified"), F.col("size").alias("old_size")).distinct()
    now = files_of(spark, path)
    same = (F.col("path") == F.col("old_path")) & (F.col("modified") == F.col("old_modified")) & (F.col("size") == F.col("old_size"))
    changed = now.join(known, same, "left_anti")
    names = [r["path"] for r in changed.select("path").collect()]  # a name for each changed file
    kept = old.join(now.select(F.col("path").alias("p"), F.col("modified").alias("m"), F.col("size").alias("s")), (F.col("path") == F.col("p")) & (F.col("modified") == F.col("m")) & (F.col("size") == F.col("s")), "left_semi")
    columns = kept.columns
    if names:
        plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")  # noqa: E731  # a listing and a scan write local paths differently
        new = file_profiles(spark.read.parquet(*names)).withColumn("key", plain(F.col("path"))).drop("path")
        new = new.join(changed.withColumn("key", plain(F.col("path"))), "key")
        kept = kept.unionByName(new.select(*columns))
    versions = _versions(spark, state_path)
    kept.write.parquet(f"{state_path.rstrip('/')}/version={versions[-1] + 1 if versions else 1}")
    return state(spark, state_path)


def merged_profile(file_state: DataFrame) -> DataFrame:
    """``(column, type, files, rows, nulls, least, greatest, approx_distinct)`` of the whole dataset from its files' profiles.

    Least and greatest are given as text; a column with two types is a ``ValidationError``.
    """
    types = file_state.groupBy("column").agg(F.count_distinct("type").alias("n")).where("n > 1").select("column").limit(1).collect()
    if types:
        raise ValidationError(f"Column {types[0][0]!r} has different types in different files")
    out = file_state.groupBy("column", "type").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.coalesce(F.min("least_number").cast("string"), F.min("least")).alias("least"), F.coalesce(F.max("greatest_number").cast("string"), F.max("greatest")).alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"),
    )
    return out
