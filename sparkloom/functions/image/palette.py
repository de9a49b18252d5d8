"""Dominant colours: deterministic k-means for all images at once.

Pixels are first reduced to distinct colours with counts (a map-side
combined aggregate), since k-means only needs colour weights.  This is the form for a
pixel relation; ``raster.color_palette`` clusters an image where its raster is read.

Initial centres: colour channels quantised by ``div 32``; the ``k`` most
frequent bins of each image (ties by bin id) with their weighted mean
colour.  Each round joins every colour to its image's centres (at most k
rows per image), takes the nearest centre (ties: lowest cluster id) and
recomputes the weighted means; a centre that loses all its colours keeps
its position.  Every ``checkpoint_every`` rounds the centres are
checkpointed to the cluster's checkpoint directory to cut the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.session import ensure_checkpoint_dir

DEFAULT_K = 5
DEFAULT_ROUNDS = 5


def color_counts(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("image_id", "r", "g", "b").agg(F.count(F.lit(1)).alias("cnt"))


def _c(j: int, ch: str) -> str:
    return f"k{j}_{ch}"


def initial_centres(colors: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """One row per image with centre columns ``k{j}_r, k{j}_g, k{j}_b`` (null when the
    image has fewer than j+1 distinct bins)."""
    bin_id = F.shiftright("r", 5) * 64 + F.shiftright("g", 5) * 8 + F.shiftright("b", 5)
    bins = colors.withColumn("bin", bin_id).groupBy("image_id", "bin").agg(
        F.sum("cnt").alias("n"),
        (F.sum(F.col("cnt") * F.col("r")) / F.sum("cnt")).alias("cr"),
        (F.sum(F.col("cnt") * F.col("g")) / F.sum("cnt")).alias("cg"),
        (F.sum(F.col("cnt") * F.col("b")) / F.sum("cnt")).alias("cb"),
    )
    # at most 512 bins per image
    w = Window.partitionBy("image_id").orderBy(F.col("n").desc(), F.col("bin"))
    top = bins.withColumn("k", F.row_number().over(w) - 1).filter(F.col("k") < k)
    aggs = []
    for j in range(k):
        for ch, src in (("r", "cr"), ("g", "cg"), ("b", "cb")):
            aggs.append(F.max(F.when(F.col("k") == j, F.col(src))).alias(_c(j, ch)))
    return top.groupBy("image_id").agg(*aggs)


def _nearest(k: int) -> F.Column:
    """Nearest centre: ``least`` over ``struct(distance, j)`` compares distance first and
    then the index, so ties go to the lowest index; missing centres are null and skipped.
    Linear in k and inside whole-stage codegen."""
    cands = []
    for j in range(k):
        d = sum(((F.col(ch) - F.col(_c(j, ch))) * (F.col(ch) - F.col(_c(j, ch))) for ch in "rgb"), F.lit(0.0))
        cands.append(F.when(F.col(_c(j, "r")).isNotNull(), F.struct(d.alias("d"), F.lit(j).alias("j"))))
    return (F.least(*cands) if k > 1 else cands[0])["j"]


def assign(colors: DataFrame, centres: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """Colours with their nearest centre ``k`` (and the centre columns carried along).

    An equi-join with one centre row per image, so colours are not duplicated.
    """
    # Build the hash table on the centres (one row per image).  Catalyst cannot see the
    # row growth of the pixel explode and would otherwise broadcast the colour side.
    return colors.join(centres.hint("shuffle_hash"), "image_id").withColumn("k", _nearest(k))


def update(assigned: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """New centres = weighted means per cluster; a cluster without colours keeps its centre.

    One aggregate per image (partial per task, then one row per image shuffled).
    """
    aggs = []
    for j in range(k):
        hit = F.col("k") == j
        n = F.sum(F.when(hit, F.col("cnt")))
        for ch in "rgb":
            new = F.sum(F.when(hit, F.col("cnt") * F.col(ch))) / n
            aggs.append(F.coalesce(new, F.first(_c(j, ch), ignorenulls=True)).alias(_c(j, ch)))
    return assigned.groupBy("image_id").agg(*aggs)


def kmeans_colors(pixels: DataFrame, k: int = DEFAULT_K, rounds: int = DEFAULT_ROUNDS, checkpoint_every: int = 10) -> tuple[DataFrame, DataFrame]:
    """Returns ``(centres, assigned colours)`` after ``rounds`` rounds (lazy).

    Each round is one join (colours with their image's centre row) and one
    per-image aggregate, so the plan grows linearly with the rounds.  For
    long runs the centres are checkpointed every ``checkpoint_every`` rounds
    to the shared ``spark.checkpoint.dir`` to cut the lineage.
    """
    ensure_checkpoint_dir(pixels.sparkSession)
    colors = color_counts(pixels)
    centres = initial_centres(colors, k)
    for i in range(rounds):
        centres = update(assign(colors, centres, k), k)
        if (i + 1) % checkpoint_every == 0 and i + 1 < rounds:
            centres = centres.checkpoint(eager=True)
    return centres, assign(colors, centres, k)


def centres_long(centres: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """``(image_id, k, cr, cg, cb)`` rows for the existing centres."""
    parts = ", ".join(f"{j}, {_c(j, 'r')}, {_c(j, 'g')}, {_c(j, 'b')}" for j in range(k))
    return centres.selectExpr("image_id", f"stack({k}, {parts}) as (k, cr, cg, cb)").filter(F.col("cr").isNotNull())


def _hex2(c) -> F.Column:
    return F.lpad(F.lower(F.hex(F.floor(c).cast("int"))), 2, "0")


def color_palette(pixels: DataFrame, k: int = DEFAULT_K, rounds: int = DEFAULT_ROUNDS) -> DataFrame:
    """``(image_id, rank, color_hex, weight)``: clusters by share (rank 0 = largest)."""
    centres, assigned = kmeans_colors(pixels, k, rounds)
    shares = assigned.groupBy("image_id", "k").agg(F.sum("cnt").alias("n"))
    j = shares.join(centres_long(centres, k), ["image_id", "k"])
    total = F.sum("n").over(Window.partitionBy("image_id"))
    j = j.withColumn("total", total)
    w = Window.partitionBy("image_id").orderBy(F.col("n").desc(), F.col("k"))
    return j.select(
        "image_id",
        (F.row_number().over(w) - 1).alias("rank"),
        F.concat(F.lit("#"), _hex2(F.col("cr")), _hex2(F.col("cg")), _hex2(F.col("cb"))).alias("color_hex"),
        (F.col("n") / F.col("total")).alias("weight"),
    )


def color_stats(pixels: DataFrame, palette: DataFrame | None = None, **kw) -> DataFrame:
    """``(image_id, mean_r, mean_g, mean_b, std_r, std_g, std_b, color_diversity)``.

    Diversity is the population std of the pixels' cluster labels, with
    labels numbered by cluster share (0 = largest).
    """
    base = pixels.groupBy("image_id").agg(
        F.avg("r").alias("mean_r"), F.avg("g").alias("mean_g"), F.avg("b").alias("mean_b"),
        F.stddev_pop("r").alias("std_r"), F.stddev_pop("g").alias("std_g"), F.stddev_pop("b").alias("std_b"),
    )
    pal = palette if palette is not None else color_palette(pixels, **kw)
    div = pal.groupBy("image_id").agg(
        F.sqrt(F.greatest(
            F.sum(F.col("weight") * F.col("rank") * F.col("rank")) - F.pow(F.sum(F.col("weight") * F.col("rank")), 2),
            F.lit(0.0),
        )).alias("color_diversity")
    )
    return base.join(div, "image_id", "left").fillna({"color_diversity": 0.0})
