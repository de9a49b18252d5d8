"""Images held as PNG bytes in a column: decode to rasters, encode from them.

A raster row is ``(image_id, width, height, rgb)`` with ``rgb`` the RGB bytes in
row-major order; bytes that can't be decoded give width = height = -1 and a
null ``rgb``, as Spark's image source does for files.  Decoding follows the
PNG specification: chunks with checksums, one zlib stream, five row filters,
gray, RGB and palette images of every bit depth, with or without alpha (which is
dropped) and interlacing; of 16-bit samples the high byte counts.

Both directions are narrow: an image is decoded by the task that reads its row.
Small images of one size are filtered together, as stacks of arrays.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import BinaryType, StructField, StructType

from sparkloom.functions.image import raster

MAX_PIXELS = 1 << 28  # a header that claims more is taken as broken
BATCH_BYTES = 1 << 24
LEAST_STACK = 8  # fewer images of one size are decoded one by one

# Signature, samples a pixel by colour type, (x start, y start, x step, y step) of interlace passes.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))
NONE, SUB, UP, AVERAGE, PAETH = range(5)


def _chunks(raw: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = len(SIGNATURE)
    if raw[:at] != SIGNATURE:
        raise ValueError("no PNG signature")
    while True:
        if at + 12 > len(raw):
            raise ValueError("a chunk is cut short")
        size, kind = struct.unpack_from(">I4s", raw, at)
        data = raw[at + 8 : at + 8 + size]
        if len(data) != size or raw[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(kind + data)):
            raise ValueError(f"chunk {kind!r} doesn't have its checksum")
        yield kind, data
        if kind == b"IEND":
            return
        at += 12 + size


def _unfiltered(raw: np.ndarray, before: np.ndarray, kind: int, step: int) -> np.ndarray:
    """A row's bytes from its filtered ones and the row above; ``step`` bytes lie between a byte and its left neighbour."""
    if kind == NONE:
        return raw
    if kind == UP:
        return raw + before
    if kind == SUB:
        return np.cumsum(raw.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
    if kind not in (AVERAGE, PAETH):
        raise ValueError(f"unknown row filter {kind}")
    out, up = [0] * step + raw.tolist(), [0] * step + before.tolist()
    for i in range(step, len(out)):
        a, b = out[i - step], up[i]
        if kind == AVERAGE:
            guess = (a + b) >> 1
        else:
            c = up[i - step]
            pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
        out[i] = (out[i] + guess) & 255
    return np.array(out[step:], np.uint8)


def _unfiltered_rows(raw: np.ndarray, before: np.ndarray, kind: int, step: int) -> np.ndarray:
    """``_unfiltered`` of a row of each of n images, n x bytes."""
    n = len(raw)
    if kind == NONE:
        return raw
    if kind == UP:
        return raw + before
    if kind == SUB:
        return np.cumsum(raw.reshape(n, -1, step), axis=1, dtype=np.uint8).reshape(n, -1)
    values, above = (np.ascontiguousarray(v.reshape(n, -1, step).swapaxes(0, 1)).astype(np.int16) for v in (raw, before))
    out, a, c = np.empty_like(values), np.zeros((n, step), np.int16), np.zeros((n, step), np.int16)
    for x, b in enumerate(above):
        if kind == AVERAGE:
            guess = (a + b) >> 1
        else:
            pa_, pb, pc_ = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
            guess = np.where((pa_ <= pb) & (pa_ <= pc_), a, np.where(pb <= pc_, b, c))
        a = out[x] = (values[x] + guess) & 255
        c = b
    return out.swapaxes(0, 1).reshape(n, -1).astype(np.uint8)


def _samples(row: np.ndarray, width: int, depth: int, per_pixel: int) -> np.ndarray:
    """The samples of a row, width x per_pixel, as stored (16-bit: the high byte)."""
    if depth == 8:
        flat = row
    elif depth == 16:
        flat = row[::2]
    else:
        bits = np.unpackbits(row).reshape(-1, depth)
        flat = bits @ (1 << np.arange(depth - 1, -1, -1))
    return flat[: width * per_pixel].reshape(width, per_pixel)


def _grids(width: int, height: int, interlace: int) -> list[tuple[int, int, int, int]]:
    return [(x, y, dx, dy) for x, y, dx, dy in PASSES if x < width and y < height] if interlace else [(0, 0, 1, 1)]


def _opened(raw: bytes) -> tuple[tuple, np.ndarray | None, np.ndarray]:
    """(header, palette, filtered rows) of a PNG; ``ValueError`` if it's broken."""
    head, palette, packed = None, None, []
    for kind, data in _chunks(raw):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data)
        elif kind == b"PLTE":
            palette = np.frombuffer(data, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(data)
    if head is None:
        raise ValueError("no header")
    width, height, depth, colour, _, _, interlace = head
    if colour not in SAMPLES or depth not in (1, 2, 4, 8, 16) or not 0 < width * height <= MAX_PIXELS or (colour == 3 and palette is None):
        raise ValueError("a header that no image has")
    per_pixel = SAMPLES[colour]
    sizes = [(-(-(width - x) // dx), -(-(height - y) // dy)) for x, y, dx, dy in _grids(width, height, interlace)]
    expected = sum(h * (1 + -(-w * per_pixel * depth // 8)) for w, h in sizes)
    unpacker = zlib.decompressobj()
    try:
        flat = np.frombuffer(unpacker.decompress(b"".join(packed), expected + 1), np.uint8)
    except zlib.error as e:
        raise ValueError("the pixels can't be unpacked") from e
    if len(flat) != expected:
        raise ValueError("the pixels aren't as many as the header says")
    return head, palette, flat


def decode(raw: bytes) -> np.ndarray:
    """Height x width x 3 bytes of a PNG; ``ValueError`` if it's broken."""
    return _image(*_opened(raw))


def _image(head: tuple, palette: np.ndarray | None, flat: np.ndarray) -> np.ndarray:
    width, height, depth, colour, _, _, interlace = head
    per_pixel = SAMPLES[colour]
    step = max(1, per_pixel * depth // 8)
    grids = _grids(width, height, interlace)
    sizes = [(-(-(width - x) // dx), -(-(height - y) // dy)) for x, y, dx, dy in grids]
    image, at = np.zeros((height, width, per_pixel), np.uint8), 0
    for (x, y, dx, dy), (w, h) in zip(grids, sizes):
        size = -(-w * per_pixel * depth // 8)
        before = np.zeros(size, np.uint8)
        for r in range(h):
            before = _unfiltered(flat[at + 1 : at + 1 + size], before, int(flat[at]), step)
            image[y + r * dy, x::dx] = _samples(before, w, depth, per_pixel)
            at += 1 + size
    if colour == 3:
        if image.max(initial=0) >= len(palette):
            raise ValueError("a colour that the palette lacks")
        return palette[image[..., 0]]
    if colour in (0, 4):
        gray = image[..., :1]
        if depth < 8:
            gray = (gray.astype(np.uint16) * 255 // ((1 << depth) - 1)).astype(np.uint8)
        return np.repeat(gray, 3, axis=2)
    return np.ascontiguousarray(image[..., :3])


def _images(head: tuple, flats: list[np.ndarray]) -> list[np.ndarray | None]:
    """``_image`` of each of several images with one header: 8 bits a sample, no palette, not interlaced; None if it's broken."""
    width, height, _, colour = head[:4]
    per_pixel = SAMPLES[colour]
    flat = np.stack(flats).reshape(len(flats), height, 1 + width * per_pixel)
    known = (flat[..., 0] <= PAETH).all(axis=1)
    flat = flat[known]
    rows, before = np.empty((len(flat), height, width * per_pixel), np.uint8), np.zeros((len(flat), width * per_pixel), np.uint8)
    for y in range(height):
        kinds, raw = flat[:, y, 0], flat[:, y, 1:]
        for kind in np.unique(kinds).tolist():
            at = np.flatnonzero(kinds == kind)
            rows[at, y] = _unfiltered_rows(raw[at], before[at], kind, per_pixel)
        before = rows[:, y]
    made = rows.reshape(len(flat), height, width, per_pixel)
    made = iter(np.repeat(made[..., :1], 3, axis=3) if colour in (0, 4) else made[..., :3])
    return [next(made) if ok else None for ok in known.tolist()]


def _decoded(opened: list[tuple | None]) -> list[np.ndarray | None]:
    """The image of each of ``_opened``'s results; None if it's broken."""
    out: list[np.ndarray | None] = [None] * len(opened)
    by_head: dict[tuple, list[int]] = {}
    for i, one in enumerate(opened):
        if one is not None:
            by_head.setdefault(one[0], []).append(i)
    for head, which in by_head.items():
        if len(which) >= LEAST_STACK and head[2] == 8 and head[3] != 3 and not head[6]:
            for i, image in zip(which, _images(head, [opened[i][2] for i in which])):
                out[i] = image
            continue
        for i in which:
            try:
                out[i] = _image(*opened[i])
            except ValueError:
                pass
    return out


def encode(image: np.ndarray) -> bytes:
    """A PNG of height x width x 3 bytes, rows filtered in turn by each of the five filters."""
    return encode_all(image[None])[0]


def encode_all(images: np.ndarray) -> list[bytes]:
    """``encode`` of each of n x height x width x 3 bytes."""
    n, height, width = images.shape[:3]
    own = images.reshape(n, height, width * 3).astype(np.int16)
    rows = np.empty((n, height, 1 + width * 3), np.uint8)
    for kind in range(min(5, height)):
        here = own[:, kind::5]
        left = np.pad(here, ((0, 0), (0, 0), (3, 0)))[..., : width * 3]
        up = np.pad(own, ((0, 0), (1, 0), (0, 0)))[:, kind:height:5]
        if kind == PAETH:
            corner = np.pad(up, ((0, 0), (0, 0), (3, 0)))[..., : width * 3]
            a, b, c = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
            guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        else:
            guess = (0, left, up, (left + up) >> 1)[kind]
        rows[:, kind::5, 0] = kind
        rows[:, kind::5, 1:] = (here - guess) & 255

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head, end = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)), chunk(b"IEND", b"")
    return [SIGNATURE + head + chunk(b"IDAT", zlib.compress(image.tobytes())) + end for image in rows]


def rasters(df: DataFrame, id_col: str = "id", image_col: str = "image_data") -> DataFrame:
    """``(image_id, width, height, rgb)`` of the PNG bytes in ``image_col``, one row per row; null and broken bytes: -1, -1, null."""
    id_type = df.schema[id_col].dataType
    schema = pa.schema([("image_id", to_arrow_type(id_type)), ("width", pa.int32()), ("height", pa.int32()), ("rgb", pa.binary())])

    def run(batches):
        for batch in batches:
            first, held, size = 0, [], 0
            for i, raw in enumerate(batch.column(1)):
                try:
                    held.append(_opened(raw.as_py() or b""))
                    size += len(held[-1][2])
                except ValueError:
                    held.append(None)
                if size >= BATCH_BYTES or i + 1 == batch.num_rows:
                    images = _decoded(held)
                    shapes = [(-1, -1) if image is None else image.shape[:2] for image in images]
                    columns = [[w for _, w in shapes], [h for h, _ in shapes], [None if image is None else image.tobytes() for image in images]]
                    ids = batch.column(0).slice(first, len(held)).cast(schema.field(0).type)
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))], schema=schema)
                    first, held, size = i + 1, [], 0

    source = df.select(F.col(id_col).alias("image_id"), F.col(image_col).cast("binary").alias("raw"))
    return source.mapInArrow(run, f"image_id {id_type.simpleString()}, width int, height int, rgb binary")


def encoded(images: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(image_id, image_data, *keep)``: rasters as PNG bytes (null where there are no pixels)."""
    fields = images.select("image_id", *keep).schema.fields
    schema = StructType([fields[0], StructField("image_data", BinaryType()), *fields[1:]])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            rgb = batch.column(3)
            known = pc.fill_null(pc.greater(pc.binary_length(rgb), 0), False)
            places = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows)), *batch.columns[1:4]], names=["place", "width", "height", "rgb"])
            parts = ((some, encode_all(stack)) for some, stack in raster._stacks(places.filter(known)))
            for some, data in chain(parts, [(places.filter(pc.invert(known)).column(0), None)]):
                own = batch.take(some)
                data = pa.nulls(len(some), pa.binary()) if data is None else pa.array(data, pa.binary())
                columns = [own.column(0), data, *own.columns[4:]]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return images.select("image_id", "width", "height", "rgb", *keep).mapInArrow(run, schema)
