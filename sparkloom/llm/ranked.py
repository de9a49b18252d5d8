"""Ranked lexical search by exact maximum inner products, in buckets of vectors of nearly equal length.

A document is the vector of its terms' impacts, an item the vector of its
terms' weights, and a score their inner product.  Impact vectors are ordered
by length (Euclidean norm), longest first, and read in buckets.  An item
passes over a bucket if its own length times the bucket's greatest length can't reach
the item's k-th best score (Cauchy-Schwarz).  Inside a bucket, the item's
heaviest coordinates are summed and the others bounded by the
lengths that remain, so only a few vectors are scored, exactly, in 64-bit
integers.  Bounds are rounded up, so no document of the true result is lost.

Scale.  Documents are tokenised where they're read, keep only terms of items,
and are never shuffled.  The longest vectors are searched first and
give every item a threshold for all other tasks; each task returns at
most k documents an item, merged in two steps.  Items, the stated
queries, are taken in blocks of at most ``BLOCK_CHARS`` characters; what is
collected or broadcast at a time (terms, their counts, thresholds) is bounded by that.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import arrow_schema, staged

TOP = 50
BUCKET = 1024
FOCUS = 8
BLOCK_CHARS = 4_000_000
FIRST_SHARE = 1 / 64  # of the documents, the longest vectors: searched first
MERGE = 64
ROUND_UP = 1 + 1e-9

#: Bytes of a term; A-Z become a-z, all other ASCII bytes but digits and letters separate.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return raw.translate(_TERM_BYTES).split()


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def _vectors(vocabulary, schema: pa.Schema):
    """Rows (id, n, terms, tfs) of (id, bytes of the text)."""

    def run(batches):
        number = vocabulary.value
        for batch in batches:
            ids, texts = batch.columns
            for at in range(0, batch.num_rows, 512):
                total, held, times = [], [], []
                for raw in texts.slice(at, 512):
                    words = terms(raw.as_py() or b"")
                    known = np.array([t for t in map(number.get, words) if t is not None], np.int32)
                    known, tf = np.unique(known, return_counts=True)
                    total.append(len(words))
                    held.append(known)
                    times.append(tf)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 512), pa.array(total, pa.int64()), pa.array(held, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                    schema=schema,
                )

    return run


class _Bucket:
    """Some vectors, longest first, with the entries of each term."""

    def __init__(self, batch: pa.RecordBatch, documents: int, total: int):
        n, held, times = (batch.column(i) for i in (1, 2, 3))
        self.ids = batch.column(0)
        size = held.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        n = n.to_numpy(zero_copy_only=False)
        self.term = held.flatten().to_numpy().astype(np.int64)
        tf = times.flatten().to_numpy()
        self.first = np.concatenate([[0], np.cumsum(size)])
        self.row = np.repeat(np.arange(len(size)), size)
        self.impact = impacts(tf, (50 + 50 * n * documents // total)[self.row])
        self.square = np.zeros(len(size))
        np.add.at(self.square, self.row, self.impact.astype(float) ** 2)
        self.by_term = np.argsort(self.term, kind="stable")
        self.sorted_terms = self.term[self.by_term]

    def longest(self) -> float:
        return math.sqrt(self.square.max(initial=0)) * ROUND_UP

    def bounds(self, focus: np.ndarray, weights: np.ndarray, rest: float) -> np.ndarray:
        """What each vector's product with an item can be at most, from its coordinates ``focus``."""
        known, left = np.zeros(len(self.square)), self.square.copy()
        low, high = np.searchsorted(self.sorted_terms, focus), np.searchsorted(self.sorted_terms, focus, "right")
        for a, b, w in zip(low, high, weights):
            if a < b:
                entry = self.by_term[a:b]
                rows, x = self.row[entry], self.impact[entry].astype(float)
                known[rows] += w * x
                left[rows] -= x * x
        return (known + np.sqrt(np.maximum(left, 0) + 1e-9 * self.square) * rest) * ROUND_UP

    def scores(self, rows: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Exact products of ``rows`` with the weights by term."""
        size = self.first[rows + 1] - self.first[rows]
        entry = np.repeat(self.first[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out = np.zeros(len(rows), np.int64)
        np.add.at(out, np.repeat(np.arange(len(rows)), size), weight_of[self.term[entry]] * self.impact[entry])
        return out


def _order(hit: tuple) -> tuple:
    score, doc = hit
    return -score, doc is None, doc if doc is not None else 0


def _searched(shared, schema: pa.Schema, k: int, documents: int, total: int):
    """Rows (q, doc, score): the k best of a partition for each item, none under the item's threshold."""

    def run(batches):
        items, floor, vocabulary_size = shared.value
        length = np.array([math.sqrt(sum(float(w) ** 2 for w in ws)) for _, _, ws in items])
        theta = np.maximum(np.array(floor, float), 1)
        best: list[list[tuple]] = [[] for _ in items]
        weight_of = np.zeros(vocabulary_size, np.int64)
        plan = []
        for _, ts, ws in items:
            order = np.argsort([-w for w in ws], kind="stable")
            ts, ws = np.array(ts, np.int64)[order], np.array(ws, np.int64)[order]
            plan.append((ts, ws, math.sqrt(float((ws[FOCUS:].astype(float) ** 2).sum()))))
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                bucket = _Bucket(batch.slice(at, BUCKET), documents, total)
                for j in np.flatnonzero(length * bucket.longest() >= theta):
                    ts, ws, rest = plan[j]
                    rows = np.flatnonzero(bucket.bounds(ts[:FOCUS], ws[:FOCUS], rest) >= theta[j])
                    if not len(rows):
                        continue
                    weight_of[ts] = ws
                    score = bucket.scores(rows, weight_of)
                    weight_of[ts] = 0
                    good = score >= theta[j]
                    if not good.any():
                        continue
                    new = zip(score[good].tolist(), bucket.ids.take(pa.array(rows[good])).to_pylist())
                    best[j] = sorted([*best[j], *new], key=_order)[:k]
                    if len(best[j]) == k:
                        theta[j] = max(theta[j], best[j][-1][0])
        for j, hits in enumerate(best):
            if hits:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([items[j][0]] * len(hits), pa.int32()), pa.array([d for _, d in hits], schema.field("doc").type), pa.array([s for s, _ in hits], pa.int64())],
                    schema=schema,
                )

    return run


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each q, numbered: first within a part of its rows, so that no task takes all of an item."""
    best = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    part = F.spark_partition_id() % MERGE
    some = hits.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("q", "part").orderBy(*best))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*best))).where(F.col("rank") <= k).drop("part")


def _item_blocks(items: DataFrame):
    """Distinct (id, text) rows, numbered, in blocks of at most ``BLOCK_CHARS`` characters (or one item)."""
    rows = staged(items.distinct().withColumn("h", F.xxhash64("i", "t")), "queries")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    parts = 2 * (total // BLOCK_CHARS) + 1
    for p in range(parts):
        block, chars = [], 0
        for r in rows.where(F.pmod("h", F.lit(parts)) == p).orderBy("h", "i", "t").toLocalIterator():
            if block and chars + len(r["t"]) > BLOCK_CHARS:
                yield block
                block, chars = [], 0
            block.append((r["i"], r["t"]))
            chars += len(r["t"])
        if block:
            yield block


def _block_ranked(rows: DataFrame, block: list[tuple], of_id: str, of_item: str, k: int) -> DataFrame | None:
    spark = rows.sparkSession
    sc = spark.sparkContext
    wanted = [sorted(set(terms(t.encode("utf-8", "surrogatepass")))) for _, t in block]
    number = {t: n for n, t in enumerate(sorted(set().union(*wanted)))}
    ddl = f"id {of_id}, n long, terms array<int>, tfs array<long>"
    read = staged(rows.mapInArrow(_vectors(sc.broadcast(number), arrow_schema(ddl)), ddl), "terms")
    stats = read.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    documents, total = stats[0], stats[1]
    if not documents or not number:
        return None
    # one row a term of the block
    df = {r["t"]: r["n"] for r in read.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}
    items = []
    for q, own in enumerate(wanted):
        pairs = [(number[t], weight(df[number[t]], documents)) for t in own if number[t] in df]
        items.append((q, [t for t, _ in pairs], [w for _, w in pairs]))

    m = F.lit(50) + F.expr(f"(50L * n * {documents}L) div {total}L")
    impact = F.transform("tfs", lambda tf: F.pow(F.floor(F.lit(1e9) * tf / (F.lit(1000) * tf + F.lit(20) * F.col("m"))), F.lit(2)))
    norm = F.sqrt(F.aggregate(impact, F.lit(0.0), lambda a, x: a + x))
    vectors = read.where("size(terms) > 0").withColumn("m", m).withColumn("norm", norm).drop("m")
    vectors = staged(vectors.sortWithinPartitions(F.desc("norm")), "vectors")
    cut = vectors.agg(F.percentile_approx("norm", 1 - FIRST_SHARE, 10_000)).first()[0]
    if cut is None:
        return None
    schema = f"q int, doc {of_id}, score long"

    def search(some: DataFrame, floor: list[int]) -> DataFrame:
        shared = sc.broadcast((items, floor, len(number)))
        return some.select("id", "n", "terms", "tfs").mapInArrow(_searched(shared, arrow_schema(schema), k, documents, total), schema)

    first = staged(_ranked(search(vectors.where(F.col("norm") >= cut), [0] * len(items)), k), "first")
    floor = [0] * len(items)
    for r in first.where(F.col("rank") == k).select("q", "score").collect():  # one row an item
        floor[r["q"]] = r["score"]
    rest = search(vectors.where(F.col("norm") < cut), floor)
    found = _ranked(first.drop("rank").unionByName(rest), k)
    ids = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], f"q int, i {of_item}")
    # one row an item of the block
    return found.join(F.broadcast(ids), "q").select(F.col("i").alias("item_id"), "rank", "doc", "score")


def top_documents(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", *, k: int = TOP
) -> DataFrame:
    """The k documents of highest score above 0 for each item: item id, rank (from 1), doc id, score.

    Terms are maximal stretches of ASCII digits, letters (A-Z as a-z) and
    characters beyond ASCII.  Equal scores go by ascending id, null ids last; rows
    that share an id are documents of their own.  Null or empty texts hold no
    term and are found by nothing; equal item rows count once, an item without
    an id is ranked under a null id.  Other columns aren't read.
    """
    of_id, of_item = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    wanted = items.select(F.col(item_col).alias("i"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("t"))
    out = None
    for block in _item_blocks(wanted):
        part = _block_ranked(rows, block, of_id, of_item, k)
        out = out.unionByName(part) if out is not None and part is not None else part if part is not None else out
    if out is None:
        out = docs.sparkSession.createDataFrame([], f"item_id {of_item}, rank int, doc {of_id}, score long")
    return out.select(F.col("item_id").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
