"""Load, save and create datasets; catalog tables; JSON metadata sidecars.

Everything goes through Spark's readers and writers, so paths may be on any
Hadoop-compatible file system.  The sidecar is a one-row JSON dataset at
``<path>_metadata`` keyed by the data path both when saving and loading.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, DataType, DecimalType, DoubleType, IntegerType, LongType, NullType, ShortType, StringType, StructField, StructType, TimestampType,
)

from sparkloom.dataset import Dataset
from sparkloom.errors import ValidationError

FORMATS = ("parquet", "delta", "csv", "json", "orc", "text")
SAVE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")

# Schema of an empty image dataset when no schema is given.
DEFAULT_IMAGE_SCHEMA = StructType(
    [
        StructField("id", StringType(), False),
        StructField("image_data", BinaryType(), True),
        StructField("metadata", StringType(), True),
        StructField("timestamp", StringType(), True),
    ]
)


def _stem(path: str) -> str:
    base = path.rstrip("/").rsplit("/", 1)[-1]
    return base.rsplit(".", 1)[0] if "." in base else base


def sidecar_path(path: str) -> str:
    return path.rstrip("/") + "_metadata"


def create_dataset(spark: SparkSession, name: str, schema: StructType | None = None) -> Dataset:
    """An empty, typed dataset (default: the image schema)."""
    return Dataset(spark.createDataFrame([], schema or DEFAULT_IMAGE_SCHEMA), name)


def read_metadata(spark: SparkSession, path: str) -> dict[str, Any]:
    """Read the sidecar written by :func:`save_dataset`; ``{}`` when there is none."""
    try:
        rows = spark.read.text(sidecar_path(path)).limit(1).collect()  # one small metadata row
    except AnalysisException:
        return {}
    return json.loads(rows[0][0]) if rows else {}


def write_metadata(spark: SparkSession, path: str, metadata: Mapping[str, Any], mode: str = "overwrite") -> None:
    doc = json.dumps(dict(metadata), sort_keys=True, default=str)
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode(mode).text(sidecar_path(path))


def reader(spark: SparkSession, format: str = "parquet", options: Mapping[str, Any] | None = None, schema=None):
    fmt = format.lower()
    if fmt not in FORMATS:
        raise ValidationError(f"Unsupported format {format!r}; expected one of {FORMATS}")
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def load_dataset(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    options: Mapping[str, Any] | None = None,
    schema: StructType | str | None = None,
    with_metadata: bool = True,
) -> Dataset:
    """Lazily read ``path``; the dataset is named after the path stem."""
    try:
        df = reader(spark, format, options, schema).load(path)
    except Exception as e:  # the missing-provider error arrives as a Py4J or analysis error
        if "DATA_SOURCE_NOT_FOUND" in str(e) or "Failed to find the data source" in str(e):
            raise ValidationError(f"Data source {format!r} is not available in this Spark installation") from None
        raise
    meta = read_metadata(spark, path) if with_metadata else {}
    return Dataset(df, _stem(path), meta)


def load_parquet(spark: SparkSession, path: str, **options: Any) -> DataFrame:
    return load_dataset(spark, path, "parquet", options, with_metadata=False).df


# Numeric types from narrow to wide.
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _wider(a: DataType, b: DataType, where: str) -> DataType:
    """The type that holds the values of both; ``ValidationError`` if there's none."""
    if a == b:
        return a
    if isinstance(a, NullType) or isinstance(b, NullType):
        return b if isinstance(a, NullType) else a
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged_schema([a, b], where + ".")
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(_wider(a.elementType, b.elementType, where + "[]"), a.containsNull or b.containsNull)
    names = {a.simpleString(), b.simpleString()}
    if names <= set(_INTEGERS):
        return LongType() if "bigint" in names else IntegerType() if "int" in names else ShortType()
    if names == {"float", "double"} or (names & {"float", "double"} and names & {"tinyint", "smallint", "int"}):
        return DoubleType()
    if names == {"date", "timestamp"}:
        return TimestampType()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        if whole + scale <= 38:
            return DecimalType(whole + scale, scale)
    raise ValidationError(f"Column {where!r} is {a.simpleString()} in one version and {b.simpleString()} in another")


def merged_schema(schemas: Sequence[StructType], prefix: str = "") -> StructType:
    """All columns of ``schemas`` by name, in order of appearance, each in the type that holds every version's values."""
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            old = fields.get(f.name)
            if old is None:
                fields[f.name] = f
            else:
                fields[f.name] = StructField(f.name, _wider(old.dataType, f.dataType, prefix + f.name), old.nullable or f.nullable)
    return StructType([StructField(f.name, f.dataType, f.nullable or any(f.name not in s.fieldNames() for s in schemas)) for f in fields.values()])


def _conformed(value: Column, have: DataType, want: DataType) -> Column:
    """``value`` in the wider type ``want``; fields that a struct lacks are null."""
    if have == want:
        return value
    if isinstance(have, StructType) and isinstance(want, StructType):
        known = {f.name: f.dataType for f in have.fields}
        fields = [(_conformed(value[f.name], known[f.name], f.dataType) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(value, lambda x: _conformed(x, have.elementType, want.elementType))
    return value.cast(want)


def load_merged(spark: SparkSession, paths: Sequence[str], format: str = "parquet", options: Mapping[str, Any] | None = None) -> DataFrame:
    """The rows of several versions of a dataset as one: columns by name, added ones null where a version lacks them,
    types widened (integers, float to double, date to timestamp, decimals, inside structs and arrays too).

    A clash of types, or no path, is a ``ValidationError``.  Each version is read with its own schema (files of a
    version with the reader's ``mergeSchema``), so filters and column pruning still reach every scan.
    """
    if not paths:
        raise ValidationError("load_merged needs at least one path")
    opts = {"mergeSchema": "true", **(options or {})} if format.lower() in ("parquet", "orc") else options
    versions = [reader(spark, format, opts).load(p) for p in paths]
    schema = merged_schema([v.schema for v in versions])
    out = None
    for v in versions:
        have = {f.name: f.dataType for f in v.schema.fields}
        row = v.select(*(
            (_conformed(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields
        ))
        out = row if out is None else out.unionAll(row)
    return out


def load_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, **options: Any) -> DataFrame:
    """CSV with a header; give ``schema`` at scale, since inference costs a full extra pass."""
    opts = {"header": "true", **options}
    if schema is None:
        opts.setdefault("inferSchema", "true")
    return load_dataset(spark, path, "csv", opts, schema=schema, with_metadata=False).df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table ``db.table``, a temp view, or ``format.`/path```."""
    return spark.table(name)


def save_dataset(
    dataset: Dataset | DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    options: Mapping[str, Any] | None = None,
    partition_by: tuple[str, ...] = (),
) -> Dataset | DataFrame:
    """Write the data (and a metadata sidecar when there is metadata); returns the input."""
    fmt, m = format.lower(), mode.lower()
    if fmt not in FORMATS:
        raise ValidationError(f"Unsupported format {format!r}; expected one of {FORMATS}")
    if m not in SAVE_MODES:
        raise ValidationError(f"Unsupported save mode {mode!r}; expected one of {SAVE_MODES}")
    df = dataset.df if isinstance(dataset, Dataset) else dataset
    w = df.write.format(fmt).mode(m)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    kept = m == "ignore" and _exists(df.sparkSession, path)
    w.save(path)
    if kept:
        return dataset  # the data there stay, and so does what is said of them
    if isinstance(dataset, Dataset) and dataset.metadata:
        write_metadata(df.sparkSession, path, dataset.metadata)
    elif m == "overwrite":
        _remove(df.sparkSession, sidecar_path(path))
    return dataset


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def _remove(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def filter_dataset(dataset: Dataset, condition: str) -> Dataset:
    """One SQL condition; the result is named ``<name>_filtered`` and keeps the metadata."""
    return Dataset(dataset.df.filter(condition), f"{dataset.name}_filtered", dict(dataset.metadata))


def parse_json_column(df: DataFrame, column: str, schema: StructType | str, into: str | None = None) -> DataFrame:
    """Parse a JSON string column with an explicit schema (no inference pass)."""
    return df.withColumn(into or column, F.from_json(F.col(column), schema))
