"""Combine per-row text and image vectors: concat, weighted sum, cross-attention.

Rows are paired by key (an equi-join), never by position.  Vectors are
``ARRAY<FLOAT|DOUBLE>`` columns.

Cross-attention (``softmax(T Iᵀ) I`` over *all* image rows, no scaling) is an
N x M x d computation by definition.  It runs as a blocked matrix product:
rows of both sides are dealt by row number (never by a key) into groups of about
``GROUP_ROWS`` rows at most, every text group meets every image group in a cogroup that holds
each row once (never pairs of blocks), and numpy computes one dense product per
pair of blocks of ``block_rows`` rows.  Each pair yields
a partial softmax state per text row (running max, sum of exps, weighted vector
sum); the states of an image group are merged as they come, the few that are
left are merged exactly with the log-sum-exp rule by the text row's own number,
in one way for any number of blocks, so repeated and null keys keep a row each.
"""

from __future__ import annotations

import math
from typing import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.errors import ValidationError

METHODS = ("CONCAT", "WEIGHTED", "CROSS_ATTENTION")
IMAGE_GROUPS = 8
GROUP_ROWS = 1 << 15


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def pair_features(
    text: DataFrame,
    image: DataFrame,
    key: str = "id",
    text_vec: str = "vector",
    image_vec: str = "vector",
) -> DataFrame:
    """``(key, text_vec, image_vec)`` joined 1:1 on ``key`` (shuffle join on the key)."""
    t = text.select(F.col(key), F.col(text_vec).alias("text_vec"))
    i = image.select(F.col(key), F.col(image_vec).alias("image_vec"))
    return t.join(i, key, "inner")


def pairing_report(text: DataFrame, image: DataFrame, key: str = "id") -> DataFrame:
    """One row: keys only on the text side, only on the image side, and duplicated keys.

    A full outer join of the per-side key counts; all aggregates are partial
    before the shuffle, so the report is cheap at any scale.
    """
    t = text.groupBy(key).agg(F.count(F.lit(1)).alias("nt"))
    i = image.groupBy(key).agg(F.count(F.lit(1)).alias("ni"))
    j = t.join(i, key, "full_outer")
    return j.agg(
        F.count_if(F.col("ni").isNull()).alias("text_only"),
        F.count_if(F.col("nt").isNull()).alias("image_only"),
        F.count_if((F.col("nt") > 1) | (F.col("ni") > 1)).alias("duplicated"),
    )


def check_pairing(text: DataFrame, image: DataFrame, key: str = "id") -> None:
    """Raise when text and image rows do not match 1:1 on ``key`` (one small job)."""
    r = pairing_report(text, image, key).first()
    if r["text_only"] or r["image_only"] or r["duplicated"]:
        raise ValidationError(
            f"Text and image features must pair 1:1 on {key!r}: "
            f"{r['text_only']} text-only, {r['image_only']} image-only, {r['duplicated']} duplicated keys"
        )


def combine_concat(pairs: DataFrame) -> DataFrame:
    return pairs.select("*", F.concat(F.col("text_vec").cast("array<double>"), F.col("image_vec").cast("array<double>")).alias("combined"))


def combine_weighted(pairs: DataFrame, text_weight: float = 0.5, image_weight: float = 0.5) -> DataFrame:
    """``w_t * t/|t| + w_i * i/|i|``; unequal lengths raise at run time, a zero vector contributes zeros."""
    nt, ni = l2_norm(F.col("text_vec")), l2_norm(F.col("image_vec"))
    with_norms = pairs.withColumn("_nt", nt).withColumn("_ni", ni)
    combined = F.zip_with(
        "text_vec",
        "image_vec",
        lambda a, b: F.lit(float(text_weight)) * F.when(F.col("_nt") > 0, a / F.col("_nt")).otherwise(F.lit(0.0))
        + F.lit(float(image_weight)) * F.when(F.col("_ni") > 0, b / F.col("_ni")).otherwise(F.lit(0.0)),
    )
    checked = F.when(
        F.size("text_vec") != F.size("image_vec"),
        F.raise_error(F.lit("WEIGHTED combination needs text and image vectors of equal length")).cast("array<double>"),
    ).otherwise(combined)
    return with_norms.withColumn("combined", checked).drop("_nt", "_ni")


# ------------------------------------------------------------- cross-attention

def _matrix(vecs: pa.ListArray) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    if len(widths := pc.list_value_length(vecs).unique()) > 1:
        raise ValidationError(f"Vectors of one side must have one length, found {sorted(widths.to_pylist())}")
    return vecs.flatten().to_numpy(zero_copy_only=False).reshape(len(vecs), -1)


def _group_partials(block_rows: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Softmax states of a text group's rows over an image group, a block of each at a time."""
    names = ["_row", "text_id", "m", "s", "v"]
    one = pa.list_(pa.float64())

    def run(text: pa.Table, image: pa.Table) -> pa.Table:
        text = text.slice(0, len(text) if len(image) else 0)
        I = _matrix(image["_iv"].combine_chunks()) if len(text) else None
        parts = []
        for at in range(0, len(text), block_rows):
            T, state = _matrix(text["_tv"].slice(at, block_rows).combine_chunks()), None
            for first in range(0, len(I), block_rows):
                block = I[first : first + block_rows]
                S = T @ block.T  # (bt, bi)
                m = S.max(axis=1)
                if state is not None:
                    m = np.maximum(m, state[0])
                E = np.exp(np.subtract(S, m[:, None], out=S), out=S)
                s, V = E.sum(axis=1), E @ block  # (bt), (bt, d)
                if state is not None:
                    w = np.exp(state[0] - m)
                    s, V = s + state[1] * w, V + state[2] * w[:, None]
                state = m, s, V
            parts.append(state)
        m, s = (pa.array(np.concatenate([p[i] for p in parts]) if parts else [], pa.float64()) for i in (0, 1))
        V = np.concatenate([p[2] for p in parts]) if parts else np.empty((0, 0))
        v = pa.ListArray.from_arrays(pa.array(np.arange(len(V) + 1) * V.shape[1], pa.int32()), pa.array(V.ravel())).cast(one)
        return pa.Table.from_arrays([text["_row"], text["_tid"], m, s, v], names=names)

    return run


def cross_attention(
    text: DataFrame,
    image: DataFrame,
    text_key: str = "id",
    image_key: str = "id",
    text_vec: str = "vector",
    image_vec: str = "vector",
    block_rows: int = 1024,
    image_rows: int | None = None,
) -> DataFrame:
    """``(text_key, combined)`` with ``combined = softmax(t · Iᵀ) · I`` over all image rows.

    One row for every text row, whatever its key; without a vector, ``combined``
    is null.  Image rows without a vector aren't attended to; without any image
    row the result is empty.  ``image_rows`` (if known) saves one counting job
    over the image side.
    """
    spark = text.sparkSession
    n_img = image_rows if image_rows is not None else image.count()
    # a text row is left with a state for each image group, so these are few; there are so many
    # text groups that pairs of groups fill the tasks; no group grows with the rows
    i_groups = max(1, min(math.ceil(n_img / block_rows), IMAGE_GROUPS), math.ceil(n_img / GROUP_ROWS))
    t_groups = max(math.ceil(2 * int(spark.conf.get("spark.sql.shuffle.partitions")) / i_groups), math.ceil(text.count() / GROUP_ROWS))
    img = (
        image.select(F.col(image_vec).cast("array<double>").alias("_iv")).where("_iv is not null")
        .withColumn("igrp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(i_groups)))
        .withColumn("tgrp", F.explode(F.sequence(F.lit(0), F.lit(t_groups - 1))))
        .select("_iv", (F.col("tgrp") + F.col("igrp") * t_groups).alias("pair"))
    )
    txt = text.select(F.col(text_key).alias("_tid"), F.col(text_vec).cast("array<double>").alias("_tv"))
    rows = (
        txt.where("_tv is not null")
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("tgrp", F.pmod(F.xxhash64("_row"), F.lit(t_groups)))
        .withColumn("igrp", F.explode(F.sequence(F.lit(0), F.lit(i_groups - 1))))
        .select("_row", "_tid", "_tv", (F.col("tgrp") + F.col("igrp") * t_groups).alias("pair"))
    )
    pairs = i_groups * t_groups
    sides = [side.repartition(pairs, "pair").groupBy("pair") for side in (rows, img)]
    key_type = text.schema[text_key].dataType.simpleString()
    partials = sides[0].cogroup(sides[1]).applyInArrow(_group_partials(block_rows), f"_row long, text_id {key_type}, m double, s double, v array<double>")
    # exact merge of a text row's few states, in a fixed order: scale each by exp(m - max m)
    state = F.struct("m", "s", "v")
    per_row = partials.groupBy("_row").agg(F.first("text_id").alias(text_key), F.sort_array(F.collect_list(state)).alias("states"))
    top = F.element_at("states", -1)["m"]  # they're ordered by m
    weighed = per_row.select(text_key, F.transform("states", lambda x: F.struct(F.exp(x["m"] - top).alias("w"), x["s"].alias("s"), x["v"].alias("v"))).alias("states"))
    den = F.aggregate("states", F.lit(0.0), lambda a, x: a + x["s"] * x["w"])
    zeros = F.transform(F.element_at("states", 1)["v"], lambda _: F.lit(0.0))
    num = F.aggregate("states", zeros, lambda a, x: F.zip_with(a, x["v"], lambda p, q: p + q * x["w"]))
    vec = weighed.select(text_key, num.alias("num"), den.alias("den"))
    vec = vec.select(text_key, F.transform("num", lambda x: x / F.col("den")).alias("combined"))
    without = txt.where("_tv is null").select(F.col("_tid").alias(text_key), F.lit(None).cast("array<double>").alias("combined"))
    if n_img == 0:
        without = without.limit(0)
    return vec.unionAll(without)


def combine_features(
    text: DataFrame,
    image: DataFrame,
    method: str = "CONCAT",
    key: str = "id",
    text_vec: str = "vector",
    image_vec: str = "vector",
    weights: dict[str, float] | None = None,
    validate: bool = True,
) -> DataFrame:
    """Dispatcher over the three methods; ``validate`` checks 1:1 pairing first."""
    m = method.upper()
    if m not in METHODS:
        raise ValidationError(f"Unknown combination method: {method}")
    if validate:
        check_pairing(text, image, key)
    if m == "CROSS_ATTENTION":
        return cross_attention(text, image, key, key, text_vec, image_vec)
    pairs = pair_features(text, image, key, text_vec, image_vec)
    if m == "CONCAT":
        return combine_concat(pairs)
    w = {"text": 0.5, "image": 0.5, **(weights or {})}
    return combine_weighted(pairs, w["text"], w["image"])


def vector_summary(text: DataFrame, image: DataFrame, combined: DataFrame, method: str,
                   text_vec: str = "vector", image_vec: str = "vector", combined_vec: str = "combined") -> DataFrame:
    """Shapes of the inputs and of the result: rows ``(side, n_rows, dim, method)``."""
    def shape(df: DataFrame, col: str, side: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.size(col)).alias("dim")).select(
            F.lit(side).alias("side"), "n_rows", "dim"
        )

    out = shape(text, text_vec, "text").unionByName(shape(image, image_vec, "image"))
    out = out.unionByName(shape(combined, combined_vec, "combined"))
    return out.withColumn("method", F.lit(method.upper()))


def long_form(df: DataFrame, key: str, vec: str, digits: int | None = None) -> DataFrame:
    """``(key, dim, value)`` rows from an array column (dims from 0)."""
    out = df.select(F.col(key), F.posexplode(vec).alias("dim", "value"))
    out = out.withColumn("value", F.col("value").cast("double"))
    if digits is not None:
        out = out.withColumn("value", F.round("value", digits))
    return out
