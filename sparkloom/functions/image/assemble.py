"""Feature vectors, suggestions, error defaults, object detection and the dispatcher."""

from __future__ import annotations

from typing import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkloom.errors import ValidationError
from sparkloom.functions.image import analysis, palette, raster
from sparkloom.functions.image.pixels import with_gray

Detector = Callable[[np.ndarray], list[tuple[tuple[float, float, float, float], int, float]]]

ANALYSES = ("COMPOSITION", "COLOR_PALETTE", "OBJECTS", "STYLE", "AESTHETICS")
DEFAULT_ANALYSES = ("COMPOSITION", "STYLE")

# Per-analysis results used when an image cannot be analysed.
DEFAULTS = {
    "aspect_ratio": 1.0, "width": 0, "height": 0, "orientation": "unknown", "edge_density": 0.0,
    "focal_x": 0.5, "focal_y": 0.5,
    "brightness": 0.0, "contrast": 0.0, "pixel_std": 0.0, "saturation": 0.0,
    "var_r": 0.0, "var_g": 0.0, "var_b": 0.0, "texture_contrast": 0.0, "energy": 0.0, "homogeneity": 0.0,
    "aesthetic_score": 0.0, "sharpness": 0.0, "complexity": 0.0,
    "mean_r": 0.0, "mean_g": 0.0, "mean_b": 0.0, "std_r": 0.0, "std_g": 0.0, "std_b": 0.0, "color_diversity": 0.0,
}
DEFAULT_COLOR = "#000000"
# Suggestion defaults when an analysis was not run.
SUGGESTION_DEFAULTS = {"aspect_ratio": 1.0, "orientation": "square", "brightness": 0.5, "contrast": 0.5, "saturation": 0.5}


def analyze_images(pixels: DataFrame, analyses: Iterable[str] = DEFAULT_ANALYSES, ids: DataFrame | None = None,
                   detector: Detector | None = None, channels: str = "GRAY", palette_size: tuple[int, int] | None = None) -> DataFrame:
    """One row per image with the columns of the selected analyses.

    ``pixels`` is a pixel relation, or rasters (``raster``, ``sources.png``), which are analysed
    where they're read; ``palette_size`` resamples these before their palette.
    With ``ids`` (a frame of ``image_id``), every listed image gets a row and
    images without pixels (undecodable) get the per-analysis defaults.
    OBJECTS runs ``detector`` (by default the stub) and gives an array
    ``objects`` of (rank, x1, y1, x2, y2, label, score), empty where it finds none.
    """
    chosen = [a.upper() for a in analyses]
    bad = [a for a in chosen if a not in ANALYSES]
    if bad:
        raise ValidationError(f"Unknown analysis types {bad}; expected {ANALYSES}")
    if "rgb" in pixels.columns:
        return _analyze_rasters(pixels, chosen, ids, detector, channels, palette_size)
    detector = detector or bright_region_detector
    out = ids.select("image_id").distinct() if ids is not None else pixels.select("image_id").distinct()
    parts = []
    if "COMPOSITION" in chosen:
        parts.append(analysis.composition(pixels))
    if "STYLE" in chosen:
        parts.append(analysis.full_style(pixels))
    if "AESTHETICS" in chosen:
        parts.append(analysis.aesthetics(pixels))
    if "COLOR_PALETTE" in chosen:
        pal = palette.color_palette(pixels)
        parts.append(pal.groupBy("image_id").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("rank", "color_hex"))), lambda e: e["color_hex"]).alias("dominant_colors")
        ))
    if "OBJECTS" in chosen:
        found = detect_objects(pixels, detector, channels)
        entry = F.struct(*[c for c in found.columns if c != "image_id"])
        parts.append(found.groupBy("image_id").agg(F.sort_array(F.collect_list(entry)).alias("objects")))
    return _with_defaults(out, parts)


#: Columns of ``raster.measures`` by analysis.
MEASURES = {
    "COMPOSITION": ("width", "height", "aspect_ratio", "orientation", "edge_density", "focal_x", "focal_y"),
    "STYLE": ("brightness", "pixel_std", "saturation", "var_r", "var_g", "var_b", "texture_contrast", "energy", "homogeneity", "contrast"),
    "AESTHETICS": ("aesthetic_score", "sharpness", "complexity"),
}


def _analyze_rasters(rasters: DataFrame, chosen: list[str], ids: DataFrame | None, detector: Detector | None, channels: str, size: tuple[int, int] | None) -> DataFrame:
    """``analyze_images`` of rasters: all statistics from one pass, palette with its statistics from another, no shuffle of pixels.

    Images without pixels have the defaults, whether ``ids`` lists them or a raster row does.
    """
    out = (rasters if ids is None else ids).select("image_id").distinct()
    parts = []
    columns = [c for a, cs in MEASURES.items() if a in chosen for c in cs]
    if columns:
        parts.append(raster.measures(rasters).select("image_id", *columns))
    if "COLOR_PALETTE" in chosen:
        parts.append(raster.color_stats(rasters, size=size))
    if "OBJECTS" in chosen:
        found = raster.detect_objects(rasters, detector or raster.bright_regions, channels)
        entry = F.struct(*[c for c in found.columns if c != "image_id"])
        parts.append(found.groupBy("image_id").agg(F.sort_array(F.collect_list(entry)).alias("objects")))
    # Spark takes what a worker makes of an id to be as small as the id, and would broadcast it
    return _with_defaults(out, [p.hint("merge") for p in parts])


def _with_defaults(out: DataFrame, parts: list[DataFrame]) -> DataFrame:
    for p in parts:
        out = out.join(p, "image_id", "left")
    # analyses give every image with pixels a value, so only images without pixels are filled
    out = out.fillna({c: v for c, v in DEFAULTS.items() if c in out.columns})
    if "dominant_colors" in out.columns:
        out = out.withColumn("dominant_colors", F.coalesce("dominant_colors", F.array_repeat(F.lit(DEFAULT_COLOR), palette.DEFAULT_K)))
    if "color_weights" in out.columns:
        out = out.withColumn("color_weights", F.coalesce("color_weights", F.array_repeat(F.lit(0.0), palette.DEFAULT_K)))
    if "objects" in out.columns:
        out = out.withColumn("objects", F.coalesce("objects", F.array().cast(out.schema["objects"].dataType)))
    return out


def visual_feature_vector(features: DataFrame, analyses: Iterable[str] = DEFAULT_ANALYSES) -> DataFrame:
    """``(image_id, visual_features ARRAY<DOUBLE>)``: [aspect, edge_density] for COMPOSITION,
    [brightness, contrast, saturation, var_r, var_g, var_b] for STYLE,
    [score, sharpness, complexity] for AESTHETICS, in that order."""
    chosen = {a.upper() for a in analyses}
    cols = []
    if "COMPOSITION" in chosen:
        cols += ["aspect_ratio", "edge_density"]
    if "STYLE" in chosen:
        cols += ["brightness", "contrast", "saturation", "var_r", "var_g", "var_b"]
    if "AESTHETICS" in chosen:
        cols += ["aesthetic_score", "sharpness", "complexity"]
    return features.select("image_id", F.array(*[F.col(c).cast("double") for c in cols]).alias("visual_features"))


def style_vector(features: DataFrame) -> DataFrame:
    """``(image_id, style_vector)``: [brightness, contrast, saturation, texture contrast, energy, homogeneity]."""
    cols = ["brightness", "contrast", "saturation", "texture_contrast", "energy", "homogeneity"]
    return features.select("image_id", F.array(*[F.col(c).cast("double") for c in cols]).alias("style_vector"))


def suggested_params(features: DataFrame) -> DataFrame:
    """Generation suggestions per image (every image, not only the first)."""
    def col(name):
        if name in features.columns:
            return F.col(name)
        return F.lit(SUGGESTION_DEFAULTS[name])

    palette_col = F.col("dominant_colors") if "dominant_colors" in features.columns else F.array().cast("array<string>")
    quality = (
        F.struct(F.col("aesthetic_score").alias("target_score"), F.col("sharpness").alias("sharpness"))
        if "aesthetic_score" in features.columns else F.lit(None).cast("struct<target_score:double,sharpness:double>")
    )
    return features.select(
        "image_id",
        F.struct(col("aspect_ratio").alias("aspect_ratio"), col("orientation").alias("orientation")).alias("composition"),
        F.struct(col("brightness").alias("brightness"), col("contrast").alias("contrast"), col("saturation").alias("saturation")).alias("style"),
        F.struct(palette_col.alias("palette")).alias("colors"),
        quality.alias("quality"),
    )


# ---------------------------------------------------------------- objects

def bright_region_detector(img: np.ndarray):
    """Stub detector for tests: one box around pixels with gray > 200, label 1, score = their share."""
    g = img if img.ndim == 2 else img[..., 0]
    ys, xs = np.nonzero(g > 200)
    if len(xs) == 0:
        return []
    return [((float(xs.min()), float(ys.min()), float(xs.max() + 1), float(ys.max() + 1)), 1, float(len(xs) / g.size))]


OBJECT_COLUMNS = "rank int, x1 double, y1 double, x2 double, y2 double, label int, score double"


def detect_objects(pixels: DataFrame, detector: Detector = bright_region_detector, channels: str = "GRAY") -> DataFrame:
    """Run a detector on each image: ``(image_id, rank, x1, y1, x2, y2, label, score)``.

    Pixels of one image are grouped into one pandas frame (bounded by the
    image size) and rebuilt for the detector: a gray ``H x W`` array, or with
    ``channels="RGB"`` an ``H x W x 3`` one.  Image ids may be of any type.
    """
    if channels not in ("GRAY", "RGB"):
        raise ValidationError(f"channels must be GRAY or RGB, not {channels!r}")
    values = ["gray"] if channels == "GRAY" else ["r", "g", "b"]
    px = (with_gray(pixels) if channels == "GRAY" else pixels).select("image_id", "x", "y", *values)
    schema = StructType([px.schema["image_id"], *StructType.fromDDL(OBJECT_COLUMNS).fields])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        iid = pdf["image_id"].iloc[0]
        w, h = int(pdf["x"].max()) + 1, int(pdf["y"].max()) + 1
        img = np.zeros((h, w, len(values)), dtype=np.uint8)
        img[pdf["y"].to_numpy(), pdf["x"].to_numpy()] = pdf[values].to_numpy()
        rows = [
            (iid, i, b[0], b[1], b[2], b[3], int(label), float(score))
            for i, (b, label, score) in enumerate(sorted(detector(img[..., 0] if channels == "GRAY" else img), key=lambda d: -d[2]))
        ]
        return pd.DataFrame(rows, columns=schema.names)

    return px.groupBy("image_id").applyInPandas(run, schema)
