"""Shards of equal bytes by Karmarkar-Karp differencing of indivisible groups.

Documents with equal texts are a group that stays in one shard.  A partial
partition is a vector with the bytes of each shard; again and again the two with the
largest spread become one, the heaviest shard of one joined with the
lightest of the other.

Scale.  Groups are summed map-side, so a group of copies is a row per task.
Tasks difference blocks of at most ``BLOCK`` vectors and pass on one vector
for each block; levels follow until one block is left, which a single task
finishes.  Each level's choices are a table, and the shard of a group is read
back down the levels with joins.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import staged

SHARDS = 16
BLOCK = 20_000


def difference(vectors: list[list[int]]) -> tuple[list[int], np.ndarray]:
    """(sums, places): the differenced vector, and for each input vector the shard in it of each of its shards."""
    n, k = len(vectors), len(vectors[0])
    sums: list[list[int]] = [sorted(v, reverse=True) for v in vectors]
    joined: list[tuple[int, int, list[int]]] = []  # of each new vector: its parts, and their merged shards in its order
    heap = [(s[-1] - s[0], i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        raw = [x + y for x, y in zip(sums[a], reversed(sums[b]))]  # oppositely ordered
        order = sorted(range(k), key=raw.__getitem__, reverse=True)
        joined.append((a, b, order))
        sums.append([raw[i] for i in order])
        sums[a] = sums[b] = []
        heapq.heappush(heap, (sums[-1][-1] - sums[-1][0], len(sums) - 1))
    where: list[list[int] | None] = [None] * (n + len(joined))
    where[-1] = list(range(k))
    for at in range(len(joined) - 1, -1, -1):
        a, b, order = joined[at]
        own = where[n + at]
        merged = [0] * k
        for position, i in enumerate(order):
            merged[i] = own[position]
        where[a], where[b] = merged, merged[::-1]
        where[n + at] = None
    places = np.empty((n, k), np.int32)
    for i, v in enumerate(vectors):
        order = sorted(range(k), key=v.__getitem__, reverse=True)
        places[i, order] = where[i]
    return sums[-1], places


def _block(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("node")
    sums, places = difference([list(map(int, v)) for v in frame["sums"]])
    out = pd.DataFrame({"block": frame["block"], "node": frame["node"], "places": list(places)})
    out["sums"] = [sums] + [None] * (len(out) - 1)  # once for the block
    return out


def shard_of_groups(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(node, shard) for ``groups(node string, weight long)``, nodes distinct; heavier groups first, the rest evens out."""
    vector = F.concat(F.array(F.col("weight")), F.array_repeat(F.lit(0).cast("long"), shards - 1))
    level, levels = groups.select("node", vector.alias("sums")), []
    count = level.count()
    while True:
        blocks = -(-count // BLOCK) or 1
        dealt = level.withColumn("block", F.pmod(F.xxhash64("node", F.lit(len(levels))), F.lit(blocks)))
        made = staged(
            dealt.groupBy("block").applyInPandas(_block, "block long, node string, places array<int>, sums array<long>"), "differenced"
        )
        levels.append(made)
        if blocks == 1:
            break
        level = made.where("sums is not null").select(F.concat_ws(":", F.lit(len(levels)), "block").alias("node"), "sums")
        count = blocks
    # from the last level down: the shard of each place of a vector
    final = levels[-1].select("node", "places")
    for depth in range(len(levels) - 2, -1, -1):
        up = final.select(F.col("node").alias("up"), F.col("places").alias("to"))
        down = levels[depth].withColumn("up", F.concat_ws(":", F.lit(depth + 1), "block")).join(up, "up")
        final = down.select("node", F.transform("places", lambda p: F.element_at(F.col("to"), p + 1)).alias("places"))
    return final.select("node", F.element_at("places", 1).alias("shard"))


def numbered(rows: DataFrame, group: str, order: list[Column], slot: str) -> DataFrame:
    """``rows`` with a gapless number from 0 in each ``group`` (a long) along ``order``, without one task for a group.

    Rows are sorted over ranges, counted along each range, and the ranges'
    starts added: as many numbers as ranges and groups.
    """
    spark, cols = rows.sparkSession, rows.columns
    ranged = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", __part int, __within long"
    place = cols.index(group)

    def count(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            within = []
            for g in batch.column(place).to_pylist():
                within.append(seen.get(g, 0))
                seen[g] = within[-1] + 1
            extra = [pa.array([part] * len(within), pa.int32()), pa.array(within, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*cols, "__part", "__within"])

    counted = staged(ranged.mapInArrow(count, ddl), "numbered")
    found = counted.groupBy(group, "__part").agg(F.count("*").alias("n")).collect()
    starts, before = [], {}
    for g, part, n in sorted((r[0], r[1], r[2]) for r in found):
        starts.append((g, part, before.get(g, 0)))
        before[g] = before.get(g, 0) + n
    starts = spark.createDataFrame(starts, "__g long, __p int, __before long")
    joined = counted.join(F.broadcast(starts), (F.col(group) == F.col("__g")) & (F.col("__part") == F.col("__p")))
    return joined.select(*cols, (F.col("__before") + F.col("__within")).alias(slot))


def sharded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per document: id, size, text_crc32, law ('bytes'), shard, slot (gapless from 0, by id, then text), grown_shard (null).

    The size is the text's UTF-8 bytes plus 1.  A null text has no bytes,
    crc32 0 and is a group with other nulls; rows with equal ids may differ in
    shard if their texts do.  A group heavier than a shard's share
    fills a shard by itself.  Other columns aren't read.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("node"),
    )
    rows = staged(rows, "documents-by-text")
    groups = staged(rows.groupBy("node").agg(F.sum("size").alias("weight")), "groups")
    placed = rows.join(shard_of_groups(groups, shards), "node").select("id", "size", "text_crc32", "node", F.col("shard").cast("long").alias("shard"))
    out = numbered(placed, "shard", [F.col("id").asc_nulls_first(), F.col("node")], "slot")
    return out.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> None:
    """Write ``docs`` as Parquet in a folder for each shard; ids must be distinct."""
    name = "shard"
    own = sharded(docs, id_col, text_col, shards).select(F.col(id_col).alias("__id"), F.col("shard").alias(name))
    docs.join(own, docs[id_col] == own["__id"]).drop("__id").write.partitionBy(name).parquet(path)
