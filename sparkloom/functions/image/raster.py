"""Rasters ``(image_id, width, height, rgb)``: every analysis of an image in the task that holds its row.

``rgb`` are the RGB bytes in row-major order (``sources.png``, Spark's image
source, or the fixture).  One pass over a raster takes the sums that all
statistics need, neighbours included; the statistics are columns of these sums.  No
pixel is ever a row of a shuffle, and the arrays in use are bands of rows of
at most ``BAND_PIXELS``, so memory follows the image's bytes alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructField, StructType

from sparkloom.functions.image.pixels import LUMA_B, LUMA_G, LUMA_R, LUMA_ROUND, dealt

BAND_PIXELS = 1 << 18
STACK_PIXELS = 1 << 16  # small images are analysed together, as many as a core's cache holds
PIXEL_ROWS = 1 << 16

SUMS = (
    "width int, height int, n long, s1 long, s2 long, spread double, r1 long, g1 long, b1 long, r2 long, g2 long, b2 long, gray1 long, gray2 long, "
    "pairs long, diff1 long, diff2 long, closeness double, cells2 double, sobel double, focal_col int, focal_row int"
)


def gray_of(image: np.ndarray) -> np.ndarray:
    """8-bit luma of height x width x 3 bytes, as in ``pixels.gray``."""
    r, g, b = (image[..., i].astype(np.int64) for i in range(3))
    return r * LUMA_R + g * LUMA_G + b * LUMA_B + LUMA_ROUND >> 16


def _bands(height: int, width: int) -> Iterator[tuple[int, int]]:
    rows = max(1, BAND_PIXELS // max(width, 1))
    for y in range(0, height, rows):
        yield y, min(y + rows, height)


def _stack_sums(images: np.ndarray) -> list[list]:
    """The values of ``SUMS`` for each of n x height x width x 3 bytes."""
    n, height, width = images.shape[:3]
    ints, spread, pair, closeness, sobel = np.zeros((10, n), np.int64), np.zeros(n), np.zeros((3, n), np.int64), np.zeros(n), np.zeros(n)
    light, focal = np.full(n, -1), np.zeros(n, np.int64)
    codes, times = np.empty(0, np.int64), np.empty(0)
    for y, end in _bands(height, width * n):
        v = images[:, y:end].astype(np.int64).reshape(n, -1, 3)
        gray = gray_of(images[:, max(y - 1, 0) : min(end + 1, height)])
        own = gray[:, min(y, 1) : min(y, 1) + end - y]
        ints += [v.sum((1, 2)), (v * v).sum((1, 2)), *v.sum(1).T, *(v * v).sum(1).T, own.sum((1, 2)), (own * own).sum((1, 2))]
        s1, s2 = v.sum(2), (v * v).sum(2)
        spread += np.sqrt(np.maximum(s2 / 3.0 - (s1 / 3.0) * (s1 / 3.0), 0)).sum(1)
        a, b = own[..., :-1].reshape(n, -1), own[..., 1:].reshape(n, -1)
        d = (b - a) ** 2
        pair += [np.full(n, d.shape[1]), np.abs(b - a).sum(1), d.sum(1)]
        closeness += (1.0 / (1.0 + d)).sum(1)
        # (image, lower gray, higher gray) with counts, joined to those of the bands before
        code = (np.arange(n)[:, None] << 16 | np.minimum(a, b) << 8 | np.maximum(a, b)).ravel()
        codes, of = np.unique(np.concatenate([codes, code]), return_inverse=True)
        times = np.bincount(of, np.concatenate([times, np.ones(len(code))]), len(codes))
        # borders repeat the edge pixel; a band sees one row more on each side
        padded = np.pad(gray, ((0, 0), (0 if y else 1, 0 if end < height else 1), (1, 1)), mode="edge")
        dx, sx = padded[..., 2:] - padded[..., :-2], padded[..., :-2] + 2 * padded[..., 1:-1] + padded[..., 2:]
        gx, gy = dx[:, :-2] + 2 * dx[:, 1:-1] + dx[:, 2:], sx[:, 2:] - sx[:, :-2]
        sobel += np.sqrt((gx * gx + gy * gy).astype(float)).sum((1, 2))
        flat = own.reshape(n, -1)
        at = flat.argmax(1)
        value = flat[np.arange(n), at]
        focal = np.where(value > light, at + y * width, focal)
        light = np.maximum(light, value)
    # the symmetric joint histogram: a pair of two grays stands in two cells, one of equal grays twice in its cell
    cells2 = np.bincount(codes >> 16, times * times * np.where(codes >> 8 & 255 == codes & 255, 4, 2), n)
    columns = [*ints[:2], spread, *ints[2:], *pair, closeness, cells2, sobel, focal % width, focal // width]
    return [[width, height, width * height, *row] for row in zip(*(c.tolist() for c in columns))]


def _sums(image: np.ndarray) -> list:
    """The values of ``SUMS`` for height x width x 3 bytes."""
    return _stack_sums(image[None])[0]


def _image(width: int, height: int, rgb: bytes) -> np.ndarray:
    return np.frombuffer(rgb, np.uint8).reshape(height, width, 3)


def _stacks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, n x height x width x 3 bytes) of a batch's rasters: those of one size together, ``STACK_PIXELS`` at most or one image."""
    width, height = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
    for w, h in sorted(set(zip(width.tolist(), height.tolist()))):
        here = np.flatnonzero((width == w) & (height == h))
        most = max(1, STACK_PIXELS // (w * h))
        for at in range(0, len(here), most):
            some = pa.array(here[at : at + most])
            raw = batch.column(3).take(some) if len(here) < batch.num_rows or len(some) < len(here) else batch.column(3)
            yield batch.column(0).take(some), np.stack([_image(w, h, r.as_buffer()) for r in raw])


def per_stack(rasters: DataFrame, make: Callable[[np.ndarray], list[list[list]]], ddl: str) -> DataFrame:
    """``image_id`` and the columns ``ddl`` of the rows that ``make`` gives for each of n rasters of one size (n x height x width x 3 bytes)."""
    of_id = rasters.schema["image_id"].dataType
    schema = StructType([StructField("image_id", of_id), *StructType.fromDDL(ddl).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for ids, images in _stacks(batch):
                found = make(images)
                rows = [row for of_image in found for row in of_image]
                columns = list(zip(*rows)) if rows else [()] * (len(arrow) - 1)
                which = ids.take(pa.array(np.repeat(np.arange(len(ids)), [len(x) for x in found])))
                yield pa.RecordBatch.from_arrays([which.cast(arrow.field(0).type), *(pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:]))], schema=arrow)

    return rasters.where("width > 0 and height > 0 and rgb is not null").select("image_id", "width", "height", "rgb").mapInArrow(run, schema)


def per_image(rasters: DataFrame, make: Callable[[np.ndarray], list[list]], ddl: str) -> DataFrame:
    """``image_id`` and the columns ``ddl`` of the rows that ``make`` gives for each raster with pixels (height x width x 3 bytes)."""
    return per_stack(rasters, lambda images: [make(image) for image in images], ddl)


def measures(rasters: DataFrame) -> DataFrame:
    """Every statistic of COMPOSITION, STYLE and AESTHETICS, from one pass over each raster; images without pixels have no row."""
    s = per_stack(rasters, lambda images: [[sums] for sums in _stack_sums(images)], SUMS)
    n, n3 = F.col("n"), F.col("n") * 3.0
    mean = F.col("s1") / n3
    of_pairs = lambda c: F.when(F.col("pairs") > 0, c).otherwise(F.lit(0.0))
    variance = lambda c: F.greatest(F.col(f"{c}2") / n - (F.col(f"{c}1") / n) * (F.col(f"{c}1") / n), F.lit(0.0))
    contrast = of_pairs(F.col("diff2") / F.col("pairs"))
    return s.select(
        "image_id", "width", "height", (F.col("width").cast("double") / F.col("height")).alias("aspect_ratio"),
        F.when(F.col("width") > F.col("height"), "landscape").otherwise("portrait").alias("orientation"),
        (F.col("sobel") / n).alias("edge_density"),
        (F.col("focal_col") / F.col("width")).alias("focal_x"), (F.col("focal_row") / F.col("height")).alias("focal_y"),
        mean.alias("brightness"), F.sqrt(F.greatest(F.col("s2") / n3 - mean * mean, F.lit(0.0))).alias("pixel_std"), (F.col("spread") / n).alias("saturation"),
        *(variance(c).alias(f"var_{c}") for c in "rgb"), *((F.col(f"{c}1") / n).alias(f"mean_{c}") for c in "rgb"),
        contrast.alias("texture_contrast"), contrast.alias("contrast"),
        of_pairs(F.sqrt("cells2") / (F.lit(2.0) * F.col("pairs"))).alias("energy"), of_pairs(F.col("closeness") / F.col("pairs")).alias("homogeneity"),
        (mean / 255.0).alias("aesthetic_score"), F.sqrt(variance("gray")).alias("sharpness"), of_pairs(F.col("diff1") / F.col("pairs")).alias("complexity"),
    )


# ---------------------------------------------------------------- palette


def _palette(images: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(centres, pixels) of the clusters of each of n x height x width x 3 bytes, n x k x 3 and n x k, the largest first (0 pixels: no cluster).

    k-means of colours from the most frequent bins.
    """
    total = len(images)
    code = images.reshape(total, -1, 3).astype(np.int64) @ [1 << 16, 1 << 8, 1]
    colours, count = np.unique(np.arange(total)[:, None] << 24 | code, return_counts=True)
    owner = colours >> 24
    colours_of = np.bincount(owner, minlength=total)
    v = np.stack([colours >> 16 & 255, colours >> 8 & 255, colours & 255], axis=1)
    bins, of = np.unique(owner * 512 + (v[:, 0] >> 5) * 64 + (v[:, 1] >> 5) * 8 + (v[:, 2] >> 5), return_inverse=True)

    def means(label: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        n = np.bincount(label, count, m)
        sums = np.stack([np.bincount(label, count * v[:, c], m) for c in range(3)], axis=1)
        return n, sums / np.maximum(n, 1)[:, None]

    n, middle = means(of, len(bins))
    best = np.lexsort((bins, -n, bins // 512))
    place = np.arange(len(bins)) - np.searchsorted(bins // 512, bins // 512)  # within its image
    centre = np.full((total, k, 3), np.inf)  # an image of fewer bins has fewer centres
    first = best[place < k]
    centre[bins[first] // 512, place[place < k]] = middle[first]

    def nearest() -> np.ndarray:
        d = np.zeros((len(v), k))
        for c in range(3):
            apart = v[:, c, None] - np.repeat(np.ascontiguousarray(centre[..., c]), colours_of, axis=0)
            d += np.multiply(apart, apart, out=apart)
        return owner * k + d.argmin(axis=1)  # the first of equal ones

    for _ in range(rounds):
        n, new = means(nearest(), total * k)
        centre = np.where((n > 0).reshape(total, k, 1), new.reshape(total, k, 3), centre)
    n = np.bincount(nearest(), count, total * k).astype(np.int64).reshape(total, k)
    order = np.argsort(-n, axis=1, kind="stable")
    return np.take_along_axis(centre, order[..., None], 1), np.take_along_axis(n, order, 1)


def _hex(centres: np.ndarray, pixels: np.ndarray) -> list[list[str]]:
    """``#rrggbb`` of each image's clusters."""
    whole = np.where(pixels[..., None] > 0, centres, 0).astype(np.int64) @ [1 << 16, 1 << 8, 1]
    return [[f"#{c:06x}" for c in row[:used]] for row, used in zip(whole.tolist(), (pixels > 0).sum(1).tolist())]


def color_palette(rasters: DataFrame, k: int = 5, rounds: int = 5, size: tuple[int, int] | None = None) -> DataFrame:
    """``(image_id, rank, color_hex, weight)``: clusters by share (rank 0 = largest), as ``palette.color_palette`` of the pixels.

    An image's colours are clustered in the task that holds its raster: no shuffle, no join by round.
    With ``size`` (width, height) the image is resampled to it first (see ``resized``).
    """

    def make(images: np.ndarray) -> list[list[list]]:
        images = _resized(images, *size) if size else images
        centres, pixels = _palette(images, k, rounds)
        weights = (pixels / (images.shape[1] * images.shape[2])).tolist()
        return [[[rank, *row] for rank, row in enumerate(zip(c, w))] for c, w in zip(_hex(centres, pixels), weights)]

    return per_stack(rasters, make, "rank int, color_hex string, weight double")


def color_stats(rasters: DataFrame, k: int = 5, rounds: int = 5, size: tuple[int, int] | None = None) -> DataFrame:
    """``(image_id, mean_r, mean_g, mean_b, std_r, std_g, std_b, color_diversity, dominant_colors, color_weights)`` in one pass.

    Diversity is the population std of the pixels' cluster labels, numbered by share (0 = largest).
    With ``size`` (width, height) the image is resampled to it first (see ``resized``).
    """

    def make(images: np.ndarray) -> list[list[list]]:
        images = _resized(images, *size) if size else images
        centres, pixels = _palette(images, k, rounds)
        total = images.shape[1] * images.shape[2]
        weight, rank = pixels / total, np.arange(k)
        diversity = np.sqrt(np.maximum((weight * rank * rank).sum(1) - (weight * rank).sum(1) ** 2, 0.0))
        v = images.reshape(len(images), total, 3)
        s1 = v.sum(1, dtype=np.int64)
        s2 = np.stack([sum((v[:, at : at + BAND_PIXELS, c].astype(np.int64) ** 2).sum(1) for at in range(0, total, BAND_PIXELS)) for c in range(3)], axis=1)
        std = np.sqrt(np.maximum(s2 / total - (s1 / total) ** 2, 0.0))
        rows = zip((s1 / total).tolist(), std.tolist(), diversity.tolist(), _hex(centres, pixels), weight.tolist())
        return [[[*m, *s, d, colours, w[: len(colours)]]] for m, s, d, colours, w in rows]

    numbers = ", ".join(f"{s}_{c} double" for s in ("mean", "std") for c in "rgb")
    return per_stack(rasters, make, f"{numbers}, color_diversity double, dominant_colors array<string>, color_weights array<double>")


# ---------------------------------------------------------------- resize

# Bicubic kernel's parameter and reach, bits of a coefficient's fraction.
CUBIC, REACH, FRACTION = -0.5, 2.0, 22


def _cubic(x: np.ndarray) -> np.ndarray:
    x = np.abs(x)
    near = ((CUBIC + 2.0) * x - (CUBIC + 3.0)) * x * x + 1.0
    far = ((CUBIC * x - 5.0 * CUBIC) * x + 8.0 * CUBIC) * x - 4.0 * CUBIC
    return np.where(x < 1.0, near, np.where(x < 2.0, far, 0.0))


def coefficients(size: int, target: int) -> list[tuple[int, np.ndarray]]:
    """For each place of ``target`` the first place of ``size`` that counts, and fixed-point weights from there on."""
    scale = size / target
    wide = max(scale, 1.0)
    out = []
    for i in range(target):
        centre = (i + 0.5) * scale
        low, high = max(int(centre - REACH * wide + 0.5), 0), min(int(centre + REACH * wide + 0.5), size)
        w = _cubic((np.arange(low, high) - centre + 0.5) / wide)
        w = w / w.sum()
        out.append((low, np.where(w < 0, np.ceil(w * (1 << FRACTION) - 0.5), np.floor(w * (1 << FRACTION) + 0.5)).astype(np.int64)))
    return out


_tables: dict[tuple[int, int], list] = {}


def _table(size: int, target: int) -> list:
    if (size, target) not in _tables:
        if len(_tables) >= 256:
            _tables.clear()
        _tables[size, target] = coefficients(size, target)
    return _tables[size, target]


def _resized(images: np.ndarray, width: int, height: int) -> np.ndarray:
    """Separable bicubic resampling of n x height x width x 3 bytes, columns first; sums are rounded and cut to 0..255 after each direction."""

    def along(values: np.ndarray, target: int) -> np.ndarray:  # the first axis
        out = np.empty((target, *values.shape[1:]), np.uint8)
        for i, (low, w) in enumerate(_table(len(values), target)):
            total = np.tensordot(w, values[low : low + len(w)].astype(np.int64), axes=1) + (1 << (FRACTION - 1))
            out[i] = np.clip(total >> FRACTION, 0, 255)
        return out

    wide = np.moveaxis(along(np.moveaxis(images, 2, 0), width), 0, 2) if images.shape[2] != width else images
    return np.moveaxis(along(np.moveaxis(wide, 1, 0), height), 0, 1) if images.shape[1] != height else wide


def resized(rasters: DataFrame, width: int = 150, height: int = 150) -> DataFrame:
    """Rasters of ``width`` x ``height`` pixels; rows without pixels stay as they are."""
    of_id = rasters.schema["image_id"].dataType
    schema = pa.schema([("image_id", to_arrow_type(of_id)), ("width", pa.int32()), ("height", pa.int32()), ("rgb", pa.binary())])

    def run(batches):
        for batch in batches:
            w, rgb = batch.column("width"), batch.column("rgb")
            known = pc.fill_null(pc.and_(pc.greater(w, 0), pc.greater(pc.binary_length(rgb), 0)), False)
            for ids, images in _stacks(batch.filter(known)):
                images = np.ascontiguousarray(_resized(images, width, height))
                n = len(images)
                for at in range(0, n, 64):
                    some = [image.tobytes() for image in images[at : at + 64]]
                    sizes = [pa.array([x] * len(some), pa.int32()) for x in (width, height)]
                    yield pa.RecordBatch.from_arrays([ids.slice(at, 64).cast(schema.field(0).type), *sizes, pa.array(some, pa.binary())], schema=schema)
            rest = batch.filter(pc.invert(known))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(rest.columns, schema)], schema=schema)

    return rasters.select("image_id", "width", "height", "rgb").mapInArrow(run, f"image_id {of_id.simpleString()}, width int, height int, rgb binary")


# ---------------------------------------------------------------- objects

BRIGHT, LEAST_PIXELS, OVERLAP = 200, 2, 0.5


def _runs(mask: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(y, starts, ends) of the stretches of True in each row that has any."""
    for y in np.flatnonzero(mask.any(axis=1)):
        change = np.diff(np.concatenate([[0], mask[y].astype(np.int8), [0]]))
        yield int(y), np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def regions(mask: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(x1, y1, x2, y2, pixels) of the connected regions of ``mask``: runs that touch in neighbouring rows are one region."""
    parent: list[int] = []
    boxes: list[list[int]] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    last_y, above = -2, []
    for y, starts, ends in _runs(mask):
        here, at = [], 0
        above = above if y == last_y + 1 else []
        for a, b in zip(starts.tolist(), ends.tolist()):
            i = len(parent)
            parent.append(i)
            boxes.append([a, y, b, y + 1, b - a])
            here.append((a, b, i))
            while at < len(above) and above[at][1] <= a:
                at += 1
            for c, _, j in above[at:]:
                if c >= b:
                    break
                i, j = sorted((root(i), root(j)))
                parent[j] = i
        last_y, above = y, here
    merged: dict[int, list[int]] = {}
    for i, (x1, y1, x2, y2, n) in enumerate(boxes):
        m = merged.setdefault(root(i), [x1, y1, x2, y2, 0])
        m[:] = [min(m[0], x1), min(m[1], y1), max(m[2], x2), max(m[3], y2), m[4] + n]
    return [tuple(m) for m in merged.values()]


def without_overlaps(boxes: list[tuple], most: float = OVERLAP) -> list[tuple]:
    """Non-maximum suppression: boxes (x1, y1, x2, y2, score), best first, unless a kept one covers more than ``most`` of their union."""
    kept: list[tuple] = []
    for box in sorted(boxes, key=lambda b: (-b[4], b[1], b[0])):
        x1, y1, x2, y2 = box[:4]
        for k in kept:
            both = max(0, min(x2, k[2]) - max(x1, k[0])) * max(0, min(y2, k[3]) - max(y1, k[1]))
            if both > most * ((x2 - x1) * (y2 - y1) + (k[2] - k[0]) * (k[3] - k[1]) - both):
                break
        else:
            kept.append(box)
    return kept


def bright_regions(image: np.ndarray, bright: int = BRIGHT, least: int = LEAST_PIXELS, overlap: float = OVERLAP):
    """A detector: boxes of connected regions with gray over ``bright`` of at least ``least`` pixels, score = their share of the image.

    Takes gray (height x width) or RGB arrays, gives ((x1, y1, x2, y2), label 1, score), the best first.
    """
    gray = image if image.ndim == 2 else gray_of(image)
    found = [(*box, n) for *box, n in regions(gray > bright) if n >= least]
    return [(tuple(map(float, box[:4])), 1, box[4] / gray.size) for box in without_overlaps(found, overlap)]


def detect_objects(rasters: DataFrame, detector=bright_regions, channels: str = "GRAY") -> DataFrame:
    """``(image_id, rank, x1, y1, x2, y2, label, score)``, several a raster, the best first."""

    def make(image: np.ndarray) -> list[list]:
        found = detector(gray_of(image).astype(np.uint8) if channels == "GRAY" else image)
        return [[i, *map(float, box), int(label), float(score)] for i, (box, label, score) in enumerate(sorted(found, key=lambda d: -d[2]))]

    return per_image(rasters, make, "rank int, x1 double, y1 double, x2 double, y2 double, label int, score double")


# ---------------------------------------------------------------- from and to other forms


def pixels(rasters: DataFrame) -> DataFrame:
    """The pixel relation ``(image_id, x, y, r, g, b)``, some rows of an image at a time."""
    of_id = rasters.schema["image_id"].dataType
    ddl = f"image_id {of_id.simpleString()}, x int, y int, r int, g int, b int"

    def run(batches):
        for batch in batches:
            for ids, images in _stacks(batch):
                n, _, w = images.shape[:3]
                flat = images.reshape(n, -1, 3)
                rows = max(1, PIXEL_ROWS // flat.shape[1])
                for i in range(0, n, rows):
                    for at in range(0, flat.shape[1], PIXEL_ROWS):
                        part = flat[i : i + rows, at : at + PIXEL_ROWS].astype(np.int32)
                        places = np.tile(np.arange(at, at + part.shape[1], dtype=np.int32), len(part))
                        which = pa.array(np.repeat(np.arange(i, i + len(part)), part.shape[1]))
                        columns = [ids.take(which).cast(to_arrow_type(of_id)), pa.array(places % w), pa.array(places // w)]
                        columns += [pa.array(part[..., c].ravel()) for c in range(3)]
                        yield pa.RecordBatch.from_arrays(columns, names=["image_id", "x", "y", "r", "g", "b"])

    return rasters.where("width > 0 and height > 0 and rgb is not null").select("image_id", "width", "height", "rgb").mapInArrow(run, ddl)


def from_struct(info: DataFrame, id_col: str = "image_id") -> DataFrame:
    """Rasters of ``pixels.image_info`` rows (Spark's image source): BGR(A) or gray bytes to RGB, alpha dropped."""
    of_id = info.schema[id_col].dataType
    schema = pa.schema([("image_id", to_arrow_type(of_id)), ("width", pa.int32()), ("height", pa.int32()), ("rgb", pa.binary())])

    def run(batches):
        for batch in batches:
            for image_id, width, height, channels, data in zip(*batch.columns):
                w, h, c, raw = width.as_py(), height.as_py(), channels.as_py(), data.as_py()
                rgb = None
                if w > 0 and h > 0 and raw:
                    v = np.frombuffer(raw, np.uint8).reshape(h, w, c)
                    rgb = (np.repeat(v[..., :1], 3, axis=2) if c < 3 else v[..., 2::-1]).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((image_id.as_py(), w, h, rgb), schema)], schema=schema)

    source = info.select(F.col(id_col).alias("image_id"), "width", "height", "n_channels", "data")
    return source.mapInArrow(run, f"image_id {of_id.simpleString()}, width int, height int, rgb binary")


@cache
def _grid(height: int, width: int) -> np.ndarray:
    return np.mgrid[:height, :width].astype(np.int64)


def synthetic(ids: DataFrame, id_col: str, width: int | None = None, height: int = 12, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fixture of ``pixels.synthetic_raster`` as rasters, with the columns ``keep``: width ``16 + id % 4`` unless given."""
    kept = ids.select(F.col(id_col).cast("bigint").alias("image_id"), *keep)
    schema = StructType([*StructType.fromDDL("image_id bigint, width int, height int, rgb binary").fields, *kept.schema.fields[1:]])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                numbers = some.column(0).to_numpy()
                widths = np.full(len(numbers), width) if width else 16 + numbers % 4
                for w in np.unique(widths).tolist():
                    which = np.flatnonzero(widths == w)
                    own, i = some.take(pa.array(which)), numbers[which][:, None, None]
                    y, x = _grid(height, w)
                    v = np.stack([(x * x * 7 + y * 13 * x + i * 31) % 256, (x * 5 + y * y * 3 + i * 17) % 256, (x * y * 11 + i * 7) % 256], axis=3)
                    rgb = [image.tobytes() for image in v.astype(np.uint8)]
                    columns = [own.column(0), pa.array([w] * len(which)), pa.array([height] * len(which)), pa.array(rgb, pa.binary()), *own.columns[1:]]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return dealt(kept).mapInArrow(run, schema)
