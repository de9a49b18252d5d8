"""Document fingerprints by winnowing.

A rolling hash of every k-gram of code points; of each window of w hashes the
smallest is chosen, the rightmost of equal ones; the chosen hashes and their
positions are the fingerprint.  Texts that share w + k - 1 code points share a
fingerprint hash, and none of under k code points counts.

Scale.  Fingerprints are local to a text; long texts are read in overlapping
segments, so memory follows the segment.  For comparing each document with
its neighbour in the order of ids, rows are dealt out in ranges of the id with
one shuffle of the texts; only the first row of each range is sent to
the range before it as well.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.shingles import mix

K, WINDOW = 12, 32
SEGMENT = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)


def _chosen(codes: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions that winnowing chooses in one segment."""
    n = len(codes)
    gram = min(k, n)
    h = np.full(n - gram + 1, gram, np.uint64)
    for i in range(gram):
        h = h * BASE + codes[i : n - gram + 1 + i]
    h = mix(h) >> np.uint64(32)
    # one number orders by hash, then by the rightmost position
    key = h << np.uint64(32) | (np.uint64(0xFFFFFFFF) - np.arange(len(h), dtype=np.uint64))
    width = min(window, len(key))
    size = 1
    low = key
    while size * 2 <= width:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    span = len(key) - width + 1
    low = np.minimum(low[:span], low[width - size : width - size + span])
    low = low[np.concatenate([[True], low[1:] != low[:-1]])]  # a minimum holds for windows in a row
    at = (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64)
    return h[at].astype(np.uint32), at


def fingerprint(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) in the order of positions; a text of under k code points has one of the whole, an empty one none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(codes):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    hashes, places = [], []
    over = k + window - 2  # so that every window lies in some segment
    for at in range(0, max(len(codes) - over, 1), SEGMENT):
        h, p = _chosen(codes[at : at + SEGMENT + over], k, window)
        new = p + at > (places[-1][-1] if places else -1)
        if new.any():
            hashes.append(h[new])
            places.append(p[new] + at)
    return np.concatenate(hashes), np.concatenate(places)


def as_string(prints: tuple[np.ndarray, np.ndarray]) -> str:
    """Eight hexadecimal digits of the hash and eight of the position for each."""
    out = np.empty(len(prints[0]), [("h", ">u4"), ("p", ">u4")])
    out["h"], out["p"] = prints
    return out.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of sorted distinct hashes; 1 if both have none."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first code points of ``following``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class _Neighbours:
    """Takes the rows of a range in order and gives each its result once the next text is known."""

    fields = pa.schema([
        ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])

    def __init__(self, k: int, window: int):
        self.k, self.window, self.part, self.row = k, window, None, None

    def take(self, part: int, extra: bool, doc_id, text: str):
        if part != self.part:
            self.part, self.row = part, None
        if extra and self.row is None:
            return None
        prints = fingerprint(text, self.k, self.window)
        distinct = np.unique(prints[0])
        out = None
        if self.row is not None:
            own_id, own, own_prints, own_distinct = self.row
            new = edited(own, text)
            new_prints = fingerprint(new, self.k, self.window)
            out = {
                "id": own_id, "n_chars": len(own), "edited_sha256": hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                "fingerprint": as_string(own_prints), "edited_fingerprint": as_string(new_prints),
                "near_edited": likeness(own_distinct, np.unique(new_prints[0])), "near_next": likeness(own_distinct, distinct),
            }
        self.row = None if extra else (doc_id, text, prints, distinct)
        return out


def _compared(schema: pa.Schema, k: int, window: int):
    def run(batches):
        state = _Neighbours(k, window)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                rows = batch.slice(at, 128).to_pylist()
                found = [state.take(r["part"], r["extra"], r["id"], r["text"] or "") for r in rows]
                yield pa.RecordBatch.from_pylist([x for x in found if x], schema=schema)

    return run


def neighbour_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = K, window: int = WINDOW) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is that with the next smaller id; after the last comes
    the first.  Null texts are empty (fingerprint ''), null ids come last, rows
    with equal ids are ordered by the hash of their texts.  Other columns aren't read.
    """
    spark = docs.sparkSession
    of_id = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / (4 * tasks) for i in range(1, 4 * tasks)]  # more ranges than tasks even out
    found = rows.agg(F.percentile_approx("id", cuts, 100_000)).first()[0] or []
    bounds = np.unique(np.array(found, np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        # ranges are numbered in the order of descending ids
        known = ids.fillna(0).astype("int64").to_numpy()
        part = len(bounds) - np.searchsorted(bounds, known, side="left")
        return pd.Series(np.where(ids.isna(), len(bounds) + 1, part).astype("int32"))

    placed = rows.withColumn("part", range_of(F.col("id").cast("long")))
    heads = placed.groupBy("part").agg(F.max("id").alias("head")).orderBy("part").collect()  # a row for each range
    order = [r["part"] for r in heads]
    ahead = spark.createDataFrame(
        [(r["part"], r["head"], order[i - 1]) for i, r in enumerate(heads)], f"part int, head {of_id}, target int"
    )
    first = placed.join(F.broadcast(ahead), "part").where(F.col("id").eqNullSafe(F.col("head"))).select("id", "text", F.col("target").alias("part"), F.lit(True).alias("extra"))
    dealt = placed.select("id", "text", "part", F.lit(False).alias("extra")).unionByName(first)
    ranked = dealt.repartition(tasks, "part").withColumn("h", F.xxhash64("text")).sortWithinPartitions("part", "extra", F.col("id").desc_nulls_last(), F.col("h").desc())
    schema = pa.schema([pa.field("id", _id_type(docs, id_col)), *_Neighbours.fields])
    ddl = f"id {of_id}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ranked.select("part", "extra", "id", "text").mapInArrow(_compared(schema, k, window), ddl).withColumnRenamed("id", id_col)


def _id_type(docs: DataFrame, id_col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[id_col].dataType)


def document_prints(docs: DataFrame, text_col: str = "text", *, k: int = K, window: int = WINDOW, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text in a column ``name`` (null texts: '')."""

    @F.pandas_udf("string")
    def prints(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: as_string(fingerprint(t or "", k, window)))

    return docs.withColumn(name, prints(F.col(text_col).cast("string")))
