"""Images as a pixel relation ``(image_id, x, y, r, g, b)``.

Sources: Spark's ``image`` data source (decoded in the JVM, BGR(A) byte
order, row-major, no padding), or a raster declared with array functions.
Pixel rows are produced with ``explode(sequence(...))`` after the per-image
row has been placed, so only the small per-image rows ever shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIXEL_COLUMNS = ("image_id", "x", "y", "r", "g", "b")

# ITU-R 601 luma weights in 16-bit fixed point, and the rounding term.
LUMA_R, LUMA_G, LUMA_B, LUMA_ROUND = 19595, 38470, 7471, 32768


def gray(r: Column, g: Column, b: Column) -> Column:
    """8-bit luma, ITU-R 601 weights in 16-bit fixed point (the usual "L" conversion)."""
    return F.shiftright(r * LUMA_R + g * LUMA_G + b * LUMA_B + LUMA_ROUND, 16).cast("int")


def with_gray(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("gray", gray(F.col("r"), F.col("g"), F.col("b")))


def load_images(spark: SparkSession, path: str, drop_invalid: bool = False, recursive: bool = True) -> DataFrame:
    """Spark's image source: one row per file with ``image`` struct
    ``(origin, height, width, nChannels, mode, data)``; an undecodable file
    keeps its row with height = width = -1 unless ``drop_invalid``."""
    r = spark.read.format("image").option("dropInvalid", str(drop_invalid).lower())
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(path)


def image_info(images: DataFrame, id_col: str = "image_id") -> DataFrame:
    """``(image_id, origin, width, height, n_channels, data)`` from the image struct."""
    return images.select(
        F.col(id_col) if id_col in images.columns else F.col("image.origin").alias(id_col),
        F.col("image.origin").alias("origin"),
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("n_channels"),
        F.col("image.data").alias("data"),
    )


def _byte_at(data: Column, offset: Column) -> Column:
    # substring on BINARY is 1-based; the byte's hex digits parsed as an int
    return F.conv(F.hex(F.substring(data, offset + 1, 1)), 16, 10).cast("int")


def struct_to_pixels(info: DataFrame, id_col: str = "image_id", partition_by_image: bool = False) -> DataFrame:
    """Explode decoded images into pixels; BGR(A) -> RGB, alpha dropped, gray -> r = g = b.

    ``partition_by_image`` hash-partitions the per-image rows by id *before*
    exploding (see :func:`_place_images`).
    """
    ok = info.filter((F.col("width") > 0) & (F.col("height") > 0))
    if partition_by_image:
        ok = _place_images(ok, id_col)
    px = ok.select(
        id_col, "width", "n_channels", "data",
        F.explode(F.sequence(F.lit(0), F.col("width") * F.col("height") - 1)).alias("pos"),
    )
    base = F.col("pos") * F.col("n_channels")
    is_gray = F.col("n_channels") < 3
    b = _byte_at(F.col("data"), base)
    g = F.when(is_gray, b).otherwise(_byte_at(F.col("data"), base + 1))
    r = F.when(is_gray, b).otherwise(_byte_at(F.col("data"), base + 2))
    return px.select(
        F.col(id_col).alias("image_id"),
        (F.col("pos") % F.col("width")).cast("int").alias("x"),
        F.floor(F.col("pos") / F.col("width")).cast("int").alias("y"),
        r.alias("r"), g.alias("g"), b.alias("b"),
    )


def _place_images(images: DataFrame, id_col: str) -> DataFrame:
    """Hash-partition per-image rows by image id before they are exploded into pixels.

    The explode keeps this partitioning, so every later per-image aggregate,
    the k-means joins and the row / column windows ``(image_id, y)``,
    ``(image_id, x)`` are satisfied without shuffling a single pixel row;
    only the compact per-image rows move.  An image is one record decoded
    by one task anyway, so this adds no skew beyond the record layout.

    Off by default: plans that read the pixels several times (k-means
    rounds, several analyses) then lose the shuffle outputs Spark would
    otherwise reuse and recompute the explode per branch (measured ~3x
    slower for the palette); it pays off for single-pass analyses.
    """
    return images.repartition(F.col(id_col))


def dealt(ids: DataFrame) -> DataFrame:
    """Rows that each stand for an image, dealt over tasks: a file of many ids is small, what they stand for isn't."""
    spark = ids.sparkSession
    tasks = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return ids.repartition(tasks)


def synthetic_raster(ids: DataFrame, id_col: str, partition_by_image: bool = False) -> DataFrame:
    """Deterministic test raster per id: width ``16 + id % 4``, height 12 (fixture formula)."""
    shapes = ids.select(F.col(id_col).cast("bigint").alias("image_id")).select(
        "image_id", (F.lit(16) + F.pmod(F.col("image_id"), F.lit(4))).cast("int").alias("width"), F.lit(12).alias("height")
    )
    shapes = _place_images(shapes, "image_id") if partition_by_image else dealt(shapes)
    px = shapes.select("image_id", "width", F.explode(F.sequence(F.lit(0), F.col("width") * F.col("height") - 1)).alias("pos"))
    px = px.select("image_id", (F.col("pos") % F.col("width")).cast("int").alias("x"),
                   F.floor(F.col("pos") / F.col("width")).cast("int").alias("y"))
    x, y, i = F.col("x").cast("bigint"), F.col("y").cast("bigint"), F.col("image_id")
    return px.select(
        "image_id", "x", "y",
        F.pmod(x * x * 7 + y * 13 * x + i * 31, F.lit(256)).cast("int").alias("r"),
        F.pmod(x * 5 + y * y * 3 + i * 17, F.lit(256)).cast("int").alias("g"),
        F.pmod(x * y * 11 + i * 7, F.lit(256)).cast("int").alias("b"),
    )


# DuckDB form of the same raster over a table of ids (for oracles).
def duck_raster(source_sql: str) -> str:
    return f"""(SELECT image_id, x, y,
        (x * x * 7 + y * 13 * x + image_id * 31) % 256 AS r,
        (x * 5 + y * y * 3 + image_id * 17) % 256 AS g,
        (x * y * 11 + image_id * 7) % 256 AS b
  FROM (SELECT image_id, pos % width AS x, pos // width AS y
        FROM (SELECT image_id, width, unnest(range(width * 12)) AS pos
              FROM (SELECT image_id, 16 + image_id % 4 AS width FROM ({source_sql})))))"""


DUCK_GRAY = f"(({LUMA_R} * r + {LUMA_G} * g + {LUMA_B} * b + {LUMA_ROUND}) >> 16)"
