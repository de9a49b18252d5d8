"""Learnt semantic vectors: randomised singular value decomposition of the hashed document-term matrix.

Terms are hashed to ``BINS`` columns (weights 1 + ln tf, rows of length 1),
so there's no vocabulary anywhere.  A random range finder with power rounds
multiplies the matrix, read in the tasks that hold its rows, with a shared
table of ``BINS`` x ``width`` numbers: each round is one narrow pass whose partial
products are added by column.  The last product is tall and skinny; its QR
factors are taken by task and merged up a tree of groups, and the small
factor's decomposition gives singular values and vectors.

Scale.  Rows are counted and staged once; a pass moves one table of fixed size for
each task, added map-side by column, and nothing that grows with documents or terms
reaches the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparkloom.functions.text.tokens import require_text_column
from sparkloom.session import staging_path

BINS = 1 << 15
DIMENSIONS = 64
MORE = 16  # columns beyond the wanted ones
ROUNDS = 4
SEED = 20240311
TILE_ROWS = 128  # multiplied together; their dense form has at most BINS columns
GROUP = 16  # factors that a merge takes at a time
LETTERS = re.compile(r"[^\W\d_]+")
MEMO_WORDS = 200_000

_memo: dict[str, int] = {}


def _bin(word: str) -> int:
    found = _memo.get(word)
    if found is None:
        found = zlib.crc32(word.encode("utf-8", "replace"))
        if len(_memo) < MEMO_WORDS:
            _memo[word] = found
    return found


def sparse_row(text: str | None, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """(columns, values) of a text's row, columns ascending; of no length without letters."""
    counts = Counter(LETTERS.findall((text or "").lower()))
    if not counts:
        return np.empty(0, np.int32), np.empty(0)
    at = np.fromiter(map(_bin, counts), np.int64, len(counts)) % bins
    columns, of = np.unique(at, return_inverse=True)
    values = 1 + np.log(np.bincount(of, np.fromiter(counts.values(), float, len(counts))))
    return columns.astype(np.int32), values / np.sqrt((values**2).sum())


def sparse_rows(df: DataFrame, id_col: str, text_col: str, bins: int = BINS) -> DataFrame:
    """``(id, at, value)`` of every row, ids null or repeated as they are."""
    require_text_column(df, text_col)
    of_id = df.schema[id_col].dataType
    schema = pa.schema([("id", to_arrow_type(of_id)), ("at", pa.list_(pa.int32())), ("value", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                rows = [sparse_row(t, bins) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([a for a, _ in rows], schema.field("at").type), pa.array([v for _, v in rows], schema.field("value").type)], schema=schema)

    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {of_id.simpleString()}, at array<int>, value array<double>")


def _staged(df: DataFrame) -> DataFrame:
    path = staging_path(df.sparkSession, "semantic")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of each entry, from the last two columns."""
    at, value = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
    size = at.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(batch.num_rows), size), at.flatten().to_numpy().astype(np.int64), value.flatten().to_numpy()


def _tiles(batch: pa.RecordBatch, bins: int):
    """(first row, columns, dense values) of every ``TILE_ROWS`` rows: the columns they use, and their values in these."""
    for first in range(0, batch.num_rows, TILE_ROWS):
        part = batch.slice(first, TILE_ROWS)
        row, column, value = _entries(part)
        place = np.zeros(bins, np.int64)
        place[column] = 1
        columns = np.flatnonzero(place)
        place[columns] = np.arange(len(columns))
        tile = np.zeros((part.num_rows, len(columns)))
        tile[row, place[column]] = value  # a row has a column once
        yield first, columns, tile


def _product(batch: pa.RecordBatch, table: np.ndarray) -> np.ndarray:
    """Rows of the batch times ``table``."""
    out = np.zeros((batch.num_rows, table.shape[1]))
    for first, columns, tile in _tiles(batch, len(table)):
        out[first : first + len(tile)] = tile @ table[columns]
    return out


def _add_back(total: np.ndarray, batch: pa.RecordBatch, table: np.ndarray) -> None:
    """Add the transposed batch times (the batch times ``table``) to ``total``."""
    for _, columns, tile in _tiles(batch, len(table)):
        total[columns] += tile.T @ (tile @ table[columns])


def _back(rows: DataFrame, table: np.ndarray) -> np.ndarray:
    """The transposed matrix times (the matrix times ``table``): partial products added by column."""
    shared = rows.sparkSession.sparkContext.broadcast(table)
    width = table.shape[1]

    def run(batches):
        total = np.zeros(table_shape)
        for batch in batches:
            _add_back(total, batch, shared.value)
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(list(total[used]), pa.list_(pa.float64()))], names=["bin", "sums"])

    table_shape = table.shape
    parts = rows.select("at", "value").mapInArrow(run, "bin long, sums array<double>")
    sums = parts.groupBy("bin").agg(*(F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)))
    out = np.zeros(table_shape)
    for r in sums.toLocalIterator():  # at most BINS rows, the table's own size
        out[r[0]] = r[1:]
    return out


def _triangle(rows: DataFrame, table: np.ndarray) -> np.ndarray:
    """The triangular factor of (the matrix times ``table``): by task, then merged in groups up a tree."""
    shared = rows.sparkSession.sparkContext.broadcast(table)
    width = table.shape[1]

    def run(batches):
        from pyspark import TaskContext

        r = np.zeros((0, width))
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                r = np.linalg.qr(np.vstack([r, _product(batch.slice(first, 4096), shared.value)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([r.ravel()], pa.list_(pa.float64()))], names=["node", "r"])

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        stack = np.vstack([np.asarray(x).reshape(-1, width) for x in frame.sort_values("node")["r"]])
        return pd.DataFrame({"node": [int(frame["node"].iloc[0]) // GROUP], "r": [np.linalg.qr(stack, mode="r").ravel()]})

    ddl = "node int, r array<double>"
    level = _staged(rows.select("at", "value").mapInArrow(run, ddl))
    while level.count() > GROUP:
        level = _staged(level.groupBy((F.col("node") / GROUP).cast("int").alias("g")).applyInPandas(merged, ddl))
    factors = [np.asarray(r["r"]).reshape(-1, width) for r in level.orderBy("node").collect()]  # GROUP small factors
    return np.linalg.qr(np.vstack(factors), mode="r") if factors else np.zeros((width, width))


@dataclass(frozen=True)
class Semantics:
    singular: np.ndarray  # k values, descending
    directions: np.ndarray  # BINS x k, orthonormal columns


def fit(rows: DataFrame, k: int = DIMENSIONS, rounds: int = ROUNDS, more: int = MORE, bins: int = BINS) -> Semantics:
    """The k greatest singular values and right singular vectors of ``sparse_rows``."""
    rng = np.random.default_rng(SEED)
    width = min(k + more, bins)
    table = rng.standard_normal((bins, width))
    for _ in range(max(rounds, 1)):
        table = np.linalg.qr(_back(rows, table))[0]
    _, singular, turned = np.linalg.svd(_triangle(rows, table))
    singular, directions = singular[:k], table @ turned.T[:, : len(singular)]
    directions = directions[:, :k]
    # the sign of a direction is free: its greatest entry is positive
    sign = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])])
    return Semantics(singular, directions * np.where(sign == 0, 1, sign))


def vectors(rows: DataFrame, model: Semantics) -> DataFrame:
    """``(id, vector)``: each row's coordinates along the directions, of length 1 (zeros for a text without letters)."""
    shared = rows.sparkSession.sparkContext.broadcast(model.directions)
    of_id = rows.schema["id"].dataType
    schema = pa.schema([("id", to_arrow_type(of_id)), ("vector", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                v = _product(part, shared.value)
                v /= np.maximum(np.sqrt((v**2).sum(axis=1, keepdims=True)), 1e-300)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(v), schema.field("vector").type)], schema=schema)

    return rows.select("id", "at", "value").mapInArrow(run, f"id {of_id.simpleString()}, vector array<double>")


def semantic_vectors(df: DataFrame, id_col: str, text_col: str, k: int = DIMENSIONS, rounds: int = ROUNDS) -> DataFrame:
    """``(id, vector ARRAY<DOUBLE>)`` of every row, learnt from all rows; ids may be null or repeat."""
    rows = _staged(sparse_rows(df, id_col, text_col))
    return vectors(rows, fit(rows, k, rounds)).withColumnRenamed("id", id_col)
