"""Near-duplicate documents: fast similarity sketching, banding and exact verification.

A text's shingle set fills ``t`` bins in rounds: round i hashes every shingle
to a bin and a value, and a bin keeps its smallest (round, value); from round
t on, all shingles go to bin i - t, so after 2t rounds at the latest each
coordinate is filled.  Two sets agree in a coordinate with a probability
equal to their Jaccard similarity.  Bands of coordinates give candidates;
links are confirmed on the full sets.

Scale.  Texts with equal sets are one class (partial aggregation, so a group
of copies costs a row per task).  Documents that share a band key form
coarse clusters; a cluster's sets are dealt out in blocks of bounded size, and
a task tests one block, or two blocks against each other, with an inverted
index of shingles, and returns only links that join something (at most one
a member).  Clusters of several blocks first shrink: links inside blocks, then
among one representative of every group, and only members of band keys whose
members are still in different groups meet in pairs of blocks.  No pair of
documents that shares a band key is left out, nothing is capped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import arrow_schema, bounded_batches, components, free_name, let_go, marked, staged
from sparkloom.llm.shingles import mix, shingle_set

BANDS, ROWS = 32, 6
BLOCK_SHINGLES = 400_000  # of a task; more are dealt out to several
PACKS_OF_RANGE = 64
CHUNK_SHINGLES = 200_000
EMPTY = np.uint64(2**64 - 1)


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """The sketches (len(sets) x t) of non-empty sets."""
    n = len(sets)
    out = np.full(n * t, EMPTY, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    flat = np.concatenate(sets) if n else np.empty(0, np.uint64)
    low = np.uint64(0xFFFFFFFF)
    for i in range(2 * t):
        h = mix(flat + np.uint64((i + 1) * 0xD1342543DE82EF95 % 2**64))
        bins = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else i - t
        np.minimum.at(out, owner * t + bins, np.uint64(i << 32) | (h & low))
        if i % 2 or i == 0:  # later rounds change no filled bin, so it may be looked at now and then
            open_ = (out.reshape(n, t) == EMPTY).any(axis=1)
            if not open_.any():
                break
            keep = open_[owner]
            owner, flat = owner[keep], flat[keep]
    return out.reshape(n, t)


def band_keys(sketches: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each sketch."""
    cut = sketches.reshape(len(sketches), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sketches), bands)).copy()
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, r])
    return key.view(np.int64)


def _sketched(schema: pa.Schema, words: int, bands: int, rows: int):
    def run(batches):
        let_go()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at = 0
            while at < batch.num_rows:
                first, sets, total = at, [], 0
                while at < batch.num_rows and total < CHUNK_SHINGLES:
                    sets.append(shingle_set(texts[at].as_py(), words))
                    total += len(sets[-1])
                    at += 1
                keys = iter(band_keys(sketch([s for s in sets if len(s)], bands * rows), bands, rows).tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, at - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )

    return run


def _sets(schema: pa.Schema, words: int):
    def run(batches):
        for batch in batches:
            *rest, texts = batch.columns
            for at in range(0, batch.num_rows, 512):
                sets = [shingle_set(x.as_py(), words).view(np.int64) for x in texts.slice(at, 512)]
                yield pa.RecordBatch.from_arrays([*(c.slice(at, 512) for c in rest), pa.array(sets, pa.list_(pa.int64()))], schema=schema)

    return run


def block_links(ids: list, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple]:
    """Links that join the groups of a block; with two sides, only between them.

    An inverted index counts exact intersections; a link is returned if its
    ends weren't joined before, so there are fewer links than members.
    """
    n = len(ids)
    size = np.array([len(s) for s in sets])
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(n), size)
    often = np.bincount(code)[code] > 1
    code, owner = code[often], owner[often]
    by_code = np.argsort(code, kind="stable")
    holders, start = owner[by_code], np.concatenate([[0], np.cumsum(np.bincount(code))]) if len(code) else np.zeros(1, int)
    first = np.searchsorted(owner, np.arange(n + 1))
    group = np.arange(n)
    two = sides.min() != sides.max()
    links = []
    for i in range(n):
        own = code[first[i] : first[i + 1]]
        if not len(own):
            continue
        length = start[own + 1] - start[own]
        where = np.arange(length.sum()) + np.repeat(start[own] - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
        both = np.bincount(holders[where], minlength=n)
        hit = np.flatnonzero((100 * both >= percent * (size + size[i] - both)) & (both > 0))
        hit = hit[hit > i]
        if two:
            hit = hit[sides[hit] != sides[i]]
        for j in hit:
            if group[j] != group[i]:
                links.append((ids[i], ids[j]))
                group[group == group[j]] = group[i]
    return links


def _linked(id_type, percent: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        links = block_links(
            frame["id"].tolist(), frame["side"].to_numpy(), [np.asarray(s, np.int64) for s in frame["shingles"]], percent
        )
        return pd.DataFrame(links, columns=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5, percent: int = 85, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable), kept.

    Documents with 100 * intersection >= ``percent`` * union of their shingle
    sets are linked.  Null, empty and blank texts have no shingles and are
    linked with nothing; rows with equal ids share a verdict; a row without an
    id is linked with nothing, has a null component and is kept.  A pair at
    similarity s is a candidate with probability 1 - (1 - s^rows)^bands
    (0.9999997 at 0.85).  Other columns aren't read.
    """
    bounded_batches(docs.sparkSession)
    of_id = docs.schema[id_col].dataType.simpleString()
    rows_in = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {of_id}, n long, content binary, keys array<long>"
    arrow = arrow_schema(schema)
    seen = staged(rows_in.mapInArrow(_sketched(arrow, words, bands, rows), schema), "sketches")

    found = seen.where("id is not null and content is not null")
    classes = staged(found.groupBy("content").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys")), "classes")
    keyed = classes.select("rep", F.explode("keys").alias("key"))
    leads = keyed.groupBy("key").agg(F.min("rep").alias("lead"), F.count("*").alias("members")).where("members > 1").select("key", "lead")
    leads = staged(leads, "leads")
    shared = marked(keyed, "key", leads, "key", "shared").where("shared").drop("shared")
    coarse = components(shared.join(leads, "key").where("rep <> lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")), "coarse")

    members = coarse.join(classes.select(F.col("rep").alias("id"), "n"), "id")
    sizes = members.groupBy(F.col("label").alias("cluster")).agg(F.sum("n").alias("total"))
    sizes = staged(sizes.withColumn("blocks", F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int")), "sizes")
    small = sizes.where("blocks = 1").agg(F.sum("total")).first()[0] or 0
    # clusters of one block share a task: packs are cut by the running size within a range of hashes, so none is over two blocks
    span = F.pmod(F.xxhash64("cluster"), F.lit(small // (PACKS_OF_RANGE * BLOCK_SHINGLES) + 1))
    before = F.sum("total").over(Window.partitionBy("span").orderBy("cluster").rowsBetween(Window.unboundedPreceding, -1))
    packed = sizes.where("blocks = 1").withColumn("span", span).withColumn("pack", F.floor(F.coalesce(before, F.lit(0)) / BLOCK_SHINGLES))
    packed = packed.select("cluster", "blocks", (F.shiftleft("span", 32) + F.col("pack")).alias("pack"))
    spread = sizes.where("blocks > 1").select("cluster", "blocks", F.lit(-1).cast("long").alias("pack"))
    placed = packed.unionByName(spread)
    dealt = coarse.join(placed, coarse["label"] == placed["cluster"]).select(
        "id", "cluster", "blocks", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks"))).otherwise(F.lit(0)).cast("int").alias("block"), "pack"
    )
    set_schema = f"id {of_id}, cluster {of_id}, blocks int, block int, pack long, shingles array<long>"
    arrow_sets = arrow_schema(set_schema)
    # an id that repeats brings each of its different texts once
    # most texts are in no cluster, and stay where they are
    known = marked(rows_in, "id", coarse, "id", "close").where("close").drop("close")
    repeated = staged(found.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id"), "repeated")
    single = known.join(dealt.join(repeated, "id", "left_anti"), "id")
    several = dealt.join(repeated, "id", "left_semi")
    texts = known.join(several, "id", "left_semi").withColumn("h", F.md5(F.col("text").cast("binary"))).dropDuplicates(["id", "h"])
    columns = ["id", "cluster", "blocks", "block", "pack", "text"]
    with_text = single.select(*columns).unionByName(texts.join(several, "id").select(*columns))
    sets = staged(with_text.mapInArrow(_sets(arrow_sets, words), set_schema), "sets")

    link_schema = f"a {of_id}, b {of_id}"
    link = _linked(of_id, percent)
    one = sets.where("blocks = 1").withColumn("side", F.lit(0)).groupBy("pack").applyInPandas(link, link_schema)
    links = staged(one, "links")
    large = sets.where("blocks > 1")
    if not large.isEmpty():
        links = _large(large, links, link, link_schema, classes)

    joined = components(links, "links")
    reps = classes.join(joined, classes["rep"] == joined["id"], "left").select(
        F.col("content"), F.coalesce("label", "rep").alias("component")
    )
    out = seen.join(reps, "content", "left").withColumn("component", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def _large(large: DataFrame, links: DataFrame, link, link_schema: str, classes: DataFrame) -> DataFrame:
    """Links of the clusters of several blocks, added to ``links``."""
    inside = large.withColumn("side", F.lit(0)).groupBy("cluster", "block").applyInPandas(link, link_schema)
    links = staged(links.union(inside), "links")
    # one representative for every group that a block has found; few if the cluster is tight
    now = components(links, "links")
    labelled = staged(large.join(now, "id", "left").withColumn("label", F.coalesce("label", "id")), "labelled")
    reps = labelled.where("id = label").withColumn("side", F.lit(0))
    again = F.pmod(F.xxhash64("id", F.lit(2)), F.col("blocks"))
    links = staged(links.union(reps.groupBy("cluster", again.alias("block")).applyInPandas(link, link_schema)), "links")
    # band keys whose members are still apart: these members meet in pairs of blocks
    now = components(links, "links")
    ids = large.select("id", "cluster", "block").distinct().join(now, "id", "left").withColumn("label", F.coalesce("label", "id"))
    # a key's members are in one cluster, so clusters that are one group by now have no such key; keys of the others alone are looked at
    several = ids.groupBy("cluster").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("cluster")
    left = staged(ids.join(several, "cluster", "left_semi").join(classes.select(F.col("rep").alias("id"), "keys"), "id"), "left")
    keyed = left.select("id", "cluster", "block", "label", F.explode("keys").alias("key"))
    apart = keyed.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
    placed = staged(keyed.join(apart, "key", "left_semi").select("id", "cluster", "block", "key"), "placed")
    # blocks that share an open key meet; few different sets of blocks stand for many keys
    sets = placed.groupBy("cluster", "key").agg(F.sort_array(F.collect_set("block")).alias("blocks")).select("cluster", "blocks").distinct()
    two = F.flatten(F.transform("blocks", lambda p: F.transform(F.filter("blocks", lambda q: q > p), lambda q: F.struct(p.alias("p"), q.alias("q")))))
    both = staged(sets.select("cluster", F.explode(two).alias("two")).select("cluster", "two.p", "two.q").distinct(), "open")
    open_ = large.join(placed.select("id").distinct(), "id", "left_semi").select("id", "cluster", "shingles", "block")
    sides = [open_.withColumnRenamed("block", mine).join(both, ["cluster", mine]).withColumn("side", F.lit(n)) for n, mine in enumerate("pq")]
    pairs = sides[0].unionByName(sides[1])
    return staged(links.union(pairs.groupBy("cluster", "p", "q").applyInPandas(link, link_schema)), "links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` without the near copies: of each group one row stays, that with the smallest id (null last); columns as before.

    Groups are found by text, so copies without an id or with one id count
    as any others; of rows that agree in id and text one stays.  Texts
    without words are in no group.  Names that clash with other columns don't matter.
    """
    key, group, row, copies = (free_name(docs, n) for n in ("text_key", "group", "row_id", "copies"))
    keyed = docs.withColumn(key, F.unhex(F.md5(F.col(f"`{text_col}`").cast("string").cast("binary"))))
    of_row = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"), F.col(key).alias("key"))
    found = near_duplicates(keyed.select(key, f"`{text_col}`"), key, text_col, **params).where("n_shingles > 0")
    groups = staged(found.select(F.col(key), F.col("component_id").alias(group)).distinct(), "groups")
    distinct = keyed.select(F.col(key), of_row.alias(row)).groupBy(key, row).agg(F.count("*").alias(copies))
    members = staged(distinct.join(groups, key), "members")
    best = members.groupBy(group).agg(F.min_by(F.struct(row, copies), row).alias("best"), F.sum(copies).alias("rows")).where("rows > 1")
    best = best.select(group, F.col(f"best.{row}").alias(row), F.col(f"best.{copies}").alias(copies))
    verdict = staged(groups.join(best, group).select(key, row, copies), "verdicts")
    # a row that is in no group passes where it is; verdicts grow with the input, so the others meet them in a shuffle at every size
    may = free_name(docs, "may_be_grouped")
    looked_up = marked(keyed, key, verdict, key, may)
    rows = looked_up.where(may).drop(may).join(verdict.hint("merge"), key, "left")
    passed = looked_up.where(~F.col(may)).drop(may)
    alone = rows.where(F.col(row).isNull() | ((F.col(row) == of_row) & (F.col(copies) == 1)))
    several = rows.where((F.col(row) == of_row) & (F.col(copies) > 1)).dropDuplicates([row])
    own = [F.col(f"`{c}`") for c in docs.columns]
    return passed.select(*own).unionAll(alone.select(*own)).unionAll(several.select(*(f"`{c}`" for c in docs.columns)))
