"""Helpers shared by the operators: staging in the shared folder, components of a graph, ordering."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sparkloom.session import ensure_checkpoint_dir


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``; removed when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Delete folders of ``fresh_path`` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def arrow_rows(fn: Callable[[list[dict]], list[dict]], schema: pa.Schema, rows: int = 256):
    """A ``mapInArrow`` function that hands ``fn`` at most ``rows`` rows at a time, so memory follows them alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows).to_pylist())
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)``: one row (id, label) per node, label = smallest id reachable.

    Every round points each node at its smallest neighbour, follows the
    pointers twice and contracts the edges, so the edges left shrink fast.
    Minima are aggregated map-side; the rows never leave the cluster.
    """
    cur = staged(edges.select("a", "b").where("a <> b").distinct(), label)
    labels = staged(cur.select(F.col("a").alias("id")).union(cur.select("b")).distinct().withColumn("label", F.col("id")), label)
    while not cur.isEmpty():
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = staged(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("p")), label)
        for _ in range(2):
            up = up.alias("u").join(up.alias("v"), F.col("u.p") == F.col("v.a")).select(F.col("u.a").alias("a"), F.col("v.p").alias("p"))
        up = staged(up, label)
        labels = staged(
            labels.join(up, labels["label"] == up["a"], "left").select("id", F.coalesce("p", "label").alias("label")), label
        )
        left = up.select(F.col("a"), F.col("p").alias("pa"))
        right = up.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        cur = staged(
            cur.join(left, "a").join(right, "b").where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
            label,
        )
    return labels


BATCH_BYTES = 4 << 20  # of an Arrow batch of whole texts


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` (or one row) in this session from now on; a smaller bound that the user has set stays.

    Spark's own bound is 10,000 rows or 64 MB: a task's whole input as one batch, which the JVM holds outside its heap while
    buffers double, and the Python worker holds as Arrow and as strings.  Tasks are planned when the result is written, so
    the bound is the session's.  No row depends on the batch it is in.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    jvm = spark.sparkContext._jvm
    now = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


_held: dict[str, object] = {}


def held(token: str, make: Callable[[], object]):
    """What ``make`` returns, kept by a Python worker under ``token``; one thing at a time."""
    if token not in _held:
        _held.clear()
        _held[token] = make()
    return _held[token]


def let_go() -> None:
    """Free what ``held`` keeps: workers outlive a stage and serve the next one, which has no use for it."""
    _held.clear()


BIT_BLOCK = 32768  # bits of a row of Spark's bitmaps
MARKED_BITS = 1 << 26  # at most, 8 MB


def marked(df: DataFrame, column: str, keys: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with a boolean ``name``: false only where ``column`` is no ``key`` of ``keys``, and true for about a sixteenth of the others.

    A hash of the key is looked up in a broadcast bitmap of 16 bits a key, up to ``MARKED_BITS`` (beyond, more others are true), so rows that
    have no partner need not be shuffled; the join that follows decides.  ``keys`` is read twice.
    """
    blocks = min(max(-(-16 * keys.count() // BIT_BLOCK), 1), MARKED_BITS // BIT_BLOCK)
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks * BIT_BLOCK))
    block, bits = free_name(df, "bit_block"), free_name(df, "bits")
    at = keys.where(F.col(key).isNotNull()).select(F.floor(place(F.col(key)) / BIT_BLOCK).cast("int").alias(block), F.pmod(place(F.col(key)), F.lit(BIT_BLOCK)).alias("bit"))
    table = at.repartition(block).groupBy(block).agg(F.bitmap_construct_agg("bit").alias(bits))
    of_row = place(F.col(f"`{column}`"))
    joined = df.withColumn(block, F.floor(of_row / BIT_BLOCK).cast("int")).join(F.broadcast(table), block, "left")
    bit = F.pmod(of_row, F.lit(BIT_BLOCK)).cast("int")
    octet = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = octet.bitwiseAND(F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), F.pmod(bit, F.lit(8)) + 1)) != 0
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), F.coalesce(hit & F.col(f"`{column}`").isNotNull(), F.lit(False)).alias(name))


def crc_of(column: str, modulus: int) -> Column:
    """crc32 of a column as text, modulo ``modulus`` (null: null)."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
