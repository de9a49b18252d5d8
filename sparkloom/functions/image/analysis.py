"""Per-image statistics over the pixel relation, all as DataFrame jobs.

Shuffle plan: every per-image aggregate is partial (map-side) first, so a
very large image costs one partial row per task before the shuffle.  The
neighbour operators (GLCM, horizontal differences, Sobel) use windows
partitioned by ``(image_id, y)`` (one image row) or ``(image_id, x)`` (one
image column), which are bounded by the image width or height, never by
the whole image.

Numbers are computed in double precision (the 8-bit arithmetic of some
image libraries wraps around; these do not).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.image.pixels import with_gray



def _row() -> Window:
    """One image row, left to right."""
    return Window.partitionBy("image_id", "y").orderBy("x")


def _col() -> Window:
    """One image column, top to bottom."""
    return Window.partitionBy("image_id", "x").orderBy("y")


def dimensions(pixels: DataFrame) -> DataFrame:
    """``(image_id, width, height, aspect_ratio, orientation)``; square counts as portrait."""
    d = pixels.groupBy("image_id").agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"))
    return d.select(
        "image_id", "width", "height",
        (F.col("width").cast("double") / F.col("height")).alias("aspect_ratio"),
        F.when(F.col("width") > F.col("height"), "landscape").otherwise("portrait").alias("orientation"),
    )


def horizontal_pairs(pixels: DataFrame) -> DataFrame:
    """``(image_id, y, x, a, b)``: gray of each pixel and of its right neighbour."""
    g = with_gray(pixels).select("image_id", "x", "y", "gray")
    return g.select("image_id", "y", "x", F.col("gray").alias("a"), F.lead("gray").over(_row()).alias("b")).filter(
        F.col("b").isNotNull()
    )


def texture(pixels: DataFrame) -> DataFrame:
    """GLCM at distance 1, angle 0, 256 levels, symmetric, normalised:
    ``(image_id, texture_contrast, energy, homogeneity)``.

    With P symmetric, contrast and homogeneity are means over the horizontal
    pairs; energy needs the joint histogram (at most 65,536 cells per image).
    """
    pairs = horizontal_pairs(pixels)
    diff2 = (F.col("a") - F.col("b")) * (F.col("a") - F.col("b"))
    sums = pairs.groupBy("image_id").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg(diff2.cast("double")).alias("texture_contrast"),
        F.avg(F.lit(1.0) / (F.lit(1.0) + diff2)).alias("homogeneity"),
    )
    # symmetric joint histogram: each pair counts as (a, b) and (b, a)
    both = pairs.select("image_id", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"))
    cells = both.groupBy("image_id", F.col("p.a").alias("i"), F.col("p.b").alias("j")).agg(F.count(F.lit(1)).alias("c"))
    energy = cells.groupBy("image_id").agg(F.sum(F.col("c") * F.col("c")).alias("sum_c2"))
    out = sums.join(energy, "image_id")
    return out.select(
        "image_id", "texture_contrast",
        (F.sqrt(F.col("sum_c2").cast("double")) / (F.lit(2.0) * F.col("n_pairs"))).alias("energy"),
        "homogeneity",
    )


def edge_density(pixels: DataFrame) -> DataFrame:
    """Mean Sobel gradient magnitude per image, borders repeating the edge pixel.

    Separable: a horizontal pass per image row (derivative and smoothing along
    x), then a vertical pass per image column.
    """
    g = with_gray(pixels).select("image_id", "x", "y", "gray")
    left = F.coalesce(F.lag("gray").over(_row()), F.col("gray"))
    right = F.coalesce(F.lead("gray").over(_row()), F.col("gray"))
    h = g.select("image_id", "x", "y", (right - left).alias("dx"), (left + 2 * F.col("gray") + right).alias("sx"))
    up_dx = F.coalesce(F.lag("dx").over(_col()), F.col("dx"))
    dn_dx = F.coalesce(F.lead("dx").over(_col()), F.col("dx"))
    up_sx = F.coalesce(F.lag("sx").over(_col()), F.col("sx"))
    dn_sx = F.coalesce(F.lead("sx").over(_col()), F.col("sx"))
    gx = (up_dx + 2 * F.col("dx") + dn_dx).cast("double")
    gy = (dn_sx - up_sx).cast("double")
    mag = h.select("image_id", F.sqrt(gx * gx + gy * gy).alias("mag"))
    return mag.groupBy("image_id").agg(F.avg("mag").alias("edge_density"))


def focal_point(pixels: DataFrame) -> DataFrame:
    """Brightest pixel (first in row-major order on ties), normalised by width and height."""
    g = with_gray(pixels)
    agg = g.groupBy("image_id").agg(
        F.max_by(F.struct("x", "y"), F.struct("gray", -F.col("y"), -F.col("x"))).alias("p"),
        (F.max("x") + 1).alias("width"),
        (F.max("y") + 1).alias("height"),
    )
    return agg.select(
        "image_id",
        (F.col("p.x") / F.col("width")).alias("focal_x"),
        (F.col("p.y") / F.col("height")).alias("focal_y"),
    )


def style(pixels: DataFrame) -> DataFrame:
    """``(image_id, brightness, pixel_std, saturation, var_r, var_g, var_b)``.

    brightness / pixel_std: mean and population std over all channel values;
    saturation: mean over pixels of the population std across r, g, b;
    color variance: population variance per channel.
    """
    r, g, b = (F.col(c).cast("double") for c in ("r", "g", "b"))
    s1 = r + g + b
    s2 = r * r + g * g + b * b
    px_std = F.sqrt(F.greatest(s2 / 3.0 - (s1 / 3.0) * (s1 / 3.0), F.lit(0.0)))
    agg = pixels.groupBy("image_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(s1).alias("s1"),
        F.sum(s2).alias("s2"),
        F.avg(px_std).alias("saturation"),
        F.var_pop("r").alias("var_r"),
        F.var_pop("g").alias("var_g"),
        F.var_pop("b").alias("var_b"),
    )
    n3 = F.col("n") * 3.0
    mean = F.col("s1") / n3
    return agg.select(
        "image_id",
        mean.alias("brightness"),
        F.sqrt(F.greatest(F.col("s2") / n3 - mean * mean, F.lit(0.0))).alias("pixel_std"),
        "saturation", "var_r", "var_g", "var_b",
    )


def aesthetics(pixels: DataFrame) -> DataFrame:
    """``(image_id, aesthetic_score, sharpness, complexity)``: mean value / 255,
    population std of gray, mean absolute horizontal gray difference."""
    g = with_gray(pixels)
    base = g.groupBy("image_id").agg(
        (F.avg((F.col("r") + F.col("g") + F.col("b")).cast("double") / 3.0) / 255.0).alias("aesthetic_score"),
        F.stddev_pop("gray").alias("sharpness"),
    )
    diffs = horizontal_pairs(pixels).groupBy("image_id").agg(F.avg(F.abs(F.col("b") - F.col("a")).cast("double")).alias("complexity"))
    return base.join(diffs, "image_id", "left").select(
        "image_id", "aesthetic_score", "sharpness", F.coalesce("complexity", F.lit(0.0)).alias("complexity")
    )


def composition(pixels: DataFrame) -> DataFrame:
    """Dimensions + edge density + focal point, joined on image_id."""
    return dimensions(pixels).join(edge_density(pixels), "image_id").join(focal_point(pixels), "image_id")


def full_style(pixels: DataFrame) -> DataFrame:
    """Style statistics plus GLCM texture.

    ``contrast`` is the GLCM contrast, which is what the style analysis
    reports as its contrast; the plain pixel std stays available as ``pixel_std``.
    An image one pixel wide has no horizontal pairs: its GLCM is empty and the
    three texture numbers are 0, the style statistics stay what they are.
    """
    s = style(pixels).join(texture(pixels), "image_id", "left")
    s = s.fillna(0.0, ["texture_contrast", "energy", "homogeneity"])
    return s.withColumn("contrast", F.col("texture_contrast"))
