"""Text vectors without a pretrained model: hashed TF-IDF, L2-normalised.

Terms hash to ``n_features`` buckets (first 32 bits of md5, modulo).  The
counts of a row are made where its text is read and staged once; the document
frequencies are at most ``n_features`` numbers, which are shared with the tasks that
weigh the rows.  IDF is the smoothed form ``ln((1 + N) / (1 + df)) + 1``.  Output is long form ``(id, bucket, value)``
(sparse: only non-zero buckets) or a dense ``ARRAY<DOUBLE>``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparkloom.functions.text.tokens import require_text_column, token_array
from sparkloom.session import staging_path

DEFAULT_FEATURES = 256
ROWS_AT_ONCE = 512
MEMO_WORDS = 200_000

_memo: dict[str, int] = {}


def hash_bucket(term: Column, n_features: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint"), F.lit(n_features)).cast("int")


def _hash(term: str) -> int:
    """What ``hash_bucket`` takes modulo the number of buckets."""
    found = _memo.get(term)
    if found is None:
        found = int(hashlib.md5(term.encode()).hexdigest()[:8], 16)
        if len(_memo) < MEMO_WORDS:
            _memo[term] = found
    return found


def _counts(df: DataFrame, id_col: str, text_col: str, n_features: int) -> DataFrame:
    """``(id, at, tf)`` of every row, ids null or repeated as they are: the buckets of its terms, ascending, and how often they occur."""
    require_text_column(df, text_col)
    of_id = df.schema[id_col].dataType
    schema = pa.schema([("id", to_arrow_type(of_id)), ("at", pa.list_(pa.int32())), ("tf", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                terms = part.column(1).flatten().dictionary_encode()
                bucket = np.array([_hash(t) % n_features for t in terms.dictionary.to_pylist()], np.int64)
                row = np.repeat(np.arange(part.num_rows), part.column(1).value_lengths().to_numpy(zero_copy_only=False))
                cell, tf = np.unique(row * n_features + bucket[terms.indices.to_numpy(zero_copy_only=False)], return_counts=True)
                ends = pa.array(np.searchsorted(cell, np.arange(part.num_rows + 1) * n_features), pa.int32())
                at, tf = pa.array(cell % n_features, pa.int32()), pa.array(tf, pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, at), pa.ListArray.from_arrays(ends, tf)], schema=schema)

    rows = df.select(F.col(id_col).alias("id"), token_array(F.col(text_col)).alias("terms"))
    return rows.mapInArrow(run, f"id {of_id.simpleString()}, at array<int>, tf array<double>")


def _weighed(df: DataFrame, id_col: str, text_col: str, n_features: int, dense: bool) -> DataFrame:
    """Long or dense form of every row that holds a term, made from its counts where they are read; rows that share an id, or have none, stay apart."""
    path = staging_path(df.sparkSession, "tfidf")
    _counts(df, id_col, text_col, n_features).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    n_docs = rows.count()
    idf = np.zeros(n_features)
    for r in rows.select(F.explode("at").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("df")).collect():  # <= n_features rows
        idf[r["bucket"]] = np.log((1 + n_docs) / (1 + r["df"])) + 1
    shared = df.sparkSession.sparkContext.broadcast(idf)
    of_id = df.schema[id_col].dataType
    fields = [("vector", pa.list_(pa.float64()))] if dense else [("bucket", pa.int32()), ("value", pa.float64())]
    schema = pa.schema([("id", to_arrow_type(of_id)), *fields])

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                row = np.repeat(np.arange(part.num_rows), part.column(1).value_lengths().to_numpy(zero_copy_only=False))
                at = part.column(1).flatten().to_numpy()
                w = part.column(2).flatten().to_numpy() * shared.value[at]
                w = w / np.sqrt(np.bincount(row, w * w, part.num_rows))[row]
                if dense:
                    table = np.zeros((part.num_rows, n_features))
                    table[row, at] = w
                    held = np.unique(row)
                    ends = pa.array(np.arange(len(held) + 1) * n_features, pa.int32())
                    columns = [part.column(0).take(pa.array(held)), pa.ListArray.from_arrays(ends, pa.array(table[held].ravel()))]
                else:
                    columns = [part.column(0).take(pa.array(row)), pa.array(at, pa.int32()), pa.array(w)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    ddl = f"id {of_id.simpleString()}, " + ("vector array<double>" if dense else "bucket int, value double")
    return rows.mapInArrow(run, ddl).withColumnRenamed("id", id_col)


def hashed_tfidf(df: DataFrame, id_col: str, text_col: str, n_features: int = DEFAULT_FEATURES) -> DataFrame:
    """Sparse long form ``(id, bucket, value)`` of every row's L2-normalised TF-IDF vector.

    A row is counted, and later weighed, in the task that reads it; only the document
    frequencies are exchanged, and at most ``n_features`` of them reach the driver.
    """
    return _weighed(df, id_col, text_col, n_features, dense=False)


def dense_tfidf(df: DataFrame, id_col: str, text_col: str, n_features: int = DEFAULT_FEATURES) -> DataFrame:
    """Dense ``(id, vector ARRAY<DOUBLE>)``, one for each row that holds a term; ids may be null or repeat."""
    return _weighed(df, id_col, text_col, n_features, dense=True)


def dense(long: DataFrame, id_col: str, n_features: int = DEFAULT_FEATURES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Dense ``(id, *keep, vector ARRAY<DOUBLE>)`` from sparse long form (bounded: n_features per row); ids must be unique."""
    pairs = long.groupBy(id_col, *keep).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "value"))).alias("m"))
    vec = F.transform(F.sequence(F.lit(0), F.lit(n_features - 1)), lambda b: F.coalesce(F.element_at("m", b), F.lit(0.0)))
    return pairs.select(id_col, *keep, vec.alias("vector"))
