import itertools
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.functions.image import assemble, palette, raster
from sparkloom.functions.image.pixels import image_info, load_images
from sparkloom.sources import png

from test_image import glcm_np, gray_np, sobel_np


def chunk(kind, data):
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def plain_png(samples, depth, colour, palette_rows=None, interlace=False):
    """A PNG without row filters from height x width x samples-a-pixel values, written bit by bit."""
    height, width, per_pixel = samples.shape
    grids = [(x, y, dx, dy) for x, y, dx, dy in png.PASSES if x < width and y < height] if interlace else [(0, 0, 1, 1)]
    raw = b""
    for x, y, dx, dy in grids:
        for row in samples[y::dy, x::dx]:
            bits = "".join(f"{int(v):0{depth}b}" for v in row.ravel())
            bits += "0" * (-len(bits) % 8)
            raw += b"\0" + bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))
    out = png.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, colour, 0, 0, int(interlace)))
    if palette_rows is not None:
        out += chunk(b"PLTE", bytes(palette_rows.ravel().tolist()))
    packed = zlib.compress(raw)
    return out + chunk(b"tEXt", b"a\0b") + chunk(b"IDAT", packed[:7]) + chunk(b"IDAT", packed[7:]) + chunk(b"IEND", b"")


@pytest.mark.parametrize("interlace", [False, True])
def test_every_kind_of_png(interlace):
    rng = np.random.default_rng(1)
    for height, width in ((1, 1), (3, 7), (9, 5), (16, 17)):
        for depth in (1, 2, 4, 8, 16):
            v = rng.integers(0, 1 << depth, (height, width, 1))
            scaled = (v * 255 // ((1 << depth) - 1) if depth < 8 else v >> (depth - 8)).astype(np.uint8)
            assert (png.decode(plain_png(v, depth, 0, interlace=interlace)) == np.repeat(scaled, 3, axis=2)).all()
        for depth in (1, 2, 4, 8):
            colours = rng.integers(0, 256, (1 << depth, 3))
            v = rng.integers(0, 1 << depth, (height, width, 1))
            assert (png.decode(plain_png(v, depth, 3, colours, interlace)) == colours[v[..., 0]]).all()
        for depth, colour, n in itertools.product((8, 16), (2, 4, 6), (0,)):
            n = png.SAMPLES[colour]
            v = rng.integers(0, 1 << depth, (height, width, n))
            rgb = (v >> (depth - 8))[..., :3] if n > 2 else np.repeat((v >> (depth - 8))[..., :1], 3, axis=2)
            assert (png.decode(plain_png(v, depth, colour, interlace=interlace)) == rgb).all()


def test_filters_round_trip_and_agree_with_the_jvm(spark, tmp_path):
    rng = np.random.default_rng(2)
    images = {f"{h}x{w}.png": rng.integers(0, 256, (h, w, 3), dtype=np.uint8) for h, w in ((1, 1), (1, 9), (7, 1), (13, 21))}
    for name, a in images.items():
        raw = png.encode(a)
        assert (png.decode(raw) == a).all()
        (tmp_path / name).write_bytes(raw)
    (tmp_path / "broken.png").write_bytes(b"not an image")
    got = {r["image_id"].rsplit("/", 1)[-1]: r for r in raster.from_struct(image_info(load_images(spark, str(tmp_path)))).collect()}
    assert got["broken.png"]["width"] == -1 and got["broken.png"]["rgb"] is None
    for name, a in images.items():
        assert (got[name]["height"], got[name]["width"]) == a.shape[:2] and bytes(got[name]["rgb"]) == a.tobytes()


def test_broken_bytes_give_defaults(spark):
    good = png.encode(np.full((4, 6, 3), 77, np.uint8))
    flipped = bytearray(good)
    flipped[-20] ^= 1
    big = png.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", 1 << 20, 1 << 20, 8, 2, 0, 0, 0)) + chunk(b"IEND", b"")
    few = png.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 4, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0" * 9)) + chunk(b"IEND", b"")
    rows = [(1, good), (2, None), (3, b""), (4, good[:-3]), (5, bytes(flipped)), (6, big), (7, few), (None, good), (1, good)]
    df = spark.createDataFrame([(i, None if b is None else bytearray(b), "x") for i, b in rows], "id long, image_data binary, rgb string")
    got = sorted(((r["image_id"] or 0, r["width"]) for r in png.rasters(df).collect()))
    assert got == [(0, 6), (1, 6), (1, 6), (2, -1), (3, -1), (4, -1), (5, -1), (6, -1), (7, -1)]
    f = {r["image_id"]: r for r in assemble.analyze_images(png.rasters(df.where("id > 1")), assemble.ANALYSES).collect()}
    assert len(f) == 6 and all(r["aspect_ratio"] == 1.0 and r["dominant_colors"] == ["#000000"] * 5 and r["color_weights"] == [0.0] * 5 and r["objects"] == [] for r in f.values())
    assert png.rasters(df.limit(0)).count() == 0


def some_rasters(spark, images):
    rows = [(i, a.shape[1], a.shape[0], bytearray(a.tobytes())) for i, a in images.items()]
    return spark.createDataFrame(rows, "image_id long, width int, height int, rgb binary")


def test_measures_in_bands_equal_numpy(spark, monkeypatch):
    rng = np.random.default_rng(3)
    shapes = {1: (7, 9), 2: (5, 5), 3: (1, 8), 4: (6, 1), 5: (1, 1), 6: (40, 3)}
    images = {i: rng.integers(0, 256, (*s, 3), dtype=np.uint8) for i, s in shapes.items()}
    images[7] = np.full((4, 6, 3), 77, np.uint8)
    whole = {i: raster._sums(a) for i, a in images.items()}
    monkeypatch.setattr(raster, "BAND_PIXELS", 10)
    for i, a in images.items():
        assert raster._sums(a) == pytest.approx(whole[i])
    for r in raster.measures(some_rasters(spark, images)).collect():
        a = images[r["image_id"]]
        g = gray_np(a)
        assert r["edge_density"] == pytest.approx(sobel_np(g)) and r["brightness"] == pytest.approx(a.mean()) and r["pixel_std"] == pytest.approx(a.std())
        assert r["saturation"] == pytest.approx(a.astype(float).std(axis=2).mean()) and r["sharpness"] == pytest.approx(g.std())
        y, x = np.unravel_index(g.argmax(), g.shape)
        assert (r["focal_x"], r["focal_y"]) == pytest.approx((x / a.shape[1], y / a.shape[0]))
        if a.shape[1] > 1:
            assert (r["texture_contrast"], r["energy"], r["homogeneity"]) == pytest.approx(glcm_np(g))
            assert r["complexity"] == pytest.approx(np.abs(np.diff(g, axis=1)).mean())
        else:
            assert (r["texture_contrast"], r["energy"], r["homogeneity"], r["complexity"]) == (0, 0, 0, 0)


def test_palette_of_rasters_equals_that_of_pixels(spark):
    rng = np.random.default_rng(4)
    images = {i: rng.integers(0, 256, (9, 11, 3), dtype=np.uint8) // 40 * 40 for i in range(4)}
    images[9] = np.zeros((3, 3, 3), np.uint8)
    r = some_rasters(spark, images)
    key = lambda rows: sorted((x["image_id"], x["rank"], x["color_hex"], round(x["weight"], 9)) for x in rows)
    assert key(raster.color_palette(r).collect()) == key(palette.color_palette(raster.pixels(r)).collect())
    old = {x["image_id"]: x for x in palette.color_stats(raster.pixels(r)).collect()}
    for x in raster.color_stats(r).collect():
        for c in ("mean_r", "mean_g", "mean_b", "std_r", "std_g", "std_b", "color_diversity"):
            assert x[c] == pytest.approx(old[x["image_id"]][c])


def test_no_pixels_are_shuffled(spark):
    images = spark.range(3).select(F.col("id"), F.lit(bytearray(png.encode(np.zeros((2, 2, 3), np.uint8)))).alias("image_data"))
    f = assemble.analyze_images(png.rasters(images), ("COMPOSITION", "STYLE", "AESTHETICS"))
    plan = f._sc._jvm.PythonSQLUtils.explainString(f._jdf.queryExecution(), "formatted")
    exchanges = [x for x in plan.split("Exchange")[1:] if "rgb" in x.split("\n\n")[0]]
    assert not exchanges and "Window" not in plan and "Generate" not in plan


def test_regions_equal_a_flood_fill():
    rng = np.random.default_rng(5)
    for _ in range(200):
        mask = rng.random((rng.integers(1, 12), rng.integers(1, 12))) < rng.random()
        seen, expect = np.zeros_like(mask), []
        for y, x in zip(*np.nonzero(mask)):
            if seen[y, x]:
                continue
            todo, cells = [(y, x)], []
            seen[y, x] = True
            while todo:
                a, b = todo.pop()
                cells.append((a, b))
                for c, d in ((a - 1, b), (a + 1, b), (a, b - 1), (a, b + 1)):
                    if 0 <= c < mask.shape[0] and 0 <= d < mask.shape[1] and mask[c, d] and not seen[c, d]:
                        seen[c, d] = True
                        todo.append((c, d))
            ys, xs = zip(*cells)
            expect.append((min(xs), min(ys), max(xs) + 1, max(ys) + 1, len(cells)))
        assert sorted(raster.regions(mask)) == sorted(expect)


def test_boxes_without_overlaps():
    boxes = [(0, 0, 10, 10, 9.0), (1, 1, 10, 10, 8.0), (0, 0, 10, 4, 7.0), (20, 0, 30, 10, 6.0), (21, 0, 30, 10, 6.5)]
    assert raster.without_overlaps(boxes) == [boxes[0], boxes[2], boxes[4]]
    assert raster.without_overlaps(boxes, 1.0) == sorted(boxes, key=lambda b: -b[4]) and raster.without_overlaps([]) == []


def test_resize_of_a_300_by_200_image(spark):
    rng = np.random.default_rng(6)
    a = rng.integers(0, 256, (200, 300, 3), dtype=np.uint8)
    row = raster.resized(some_rasters(spark, {1: a, 2: np.full((200, 300, 3), 91, np.uint8)})).collect()
    got = np.frombuffer(bytes(row[0]["rgb"]), np.uint8).reshape(150, 150, 3)

    def weights(size, target):  # a dense matrix, each weight by itself
        out = np.zeros((target, size))
        for i in range(target):
            centre, wide = (i + 0.5) * size / target, max(size / target, 1.0)
            for j in range(max(int(centre - 2 * wide + 0.5), 0), min(int(centre + 2 * wide + 0.5), size)):
                x = abs((j - centre + 0.5) / wide)
                out[i, j] = 1.5 * x**3 - 2.5 * x**2 + 1 if x < 1 else -0.5 * x**3 + 2.5 * x**2 - 4 * x + 2 if x < 2 else 0
        return out / out.sum(axis=1, keepdims=True)

    for c in range(3):
        across = np.clip(np.floor(a[..., c] @ weights(300, 150).T + 0.5), 0, 255)
        expect = np.clip(np.floor(weights(200, 150) @ across + 0.5), 0, 255)
        assert np.abs(got[..., c] - expect).max() <= 1 and (got[..., c] == expect).mean() > 0.999
    assert set(bytes(row[1]["rgb"])) == {91}
    same = raster.resized(some_rasters(spark, {1: a}), 300, 200).first()
    assert bytes(same["rgb"]) == a.tobytes()


def test_images_of_one_size_are_analysed_together(spark, monkeypatch):
    rng = np.random.default_rng(8)
    images = {i: rng.integers(0, 256, ((5, 7, 3), (1, 4, 3), (6, 1, 3))[i % 3], dtype=np.uint8) // (1 + i % 2 * 63) for i in range(40)}
    sizes = []
    whole = raster._stack_sums
    monkeypatch.setattr(raster, "_stack_sums", lambda x: sizes.append(len(x)) or whole(x))
    stacks = [raster._stack_sums(np.stack([a for i, a in images.items() if i % 3 == s])) for s in range(3)]
    assert sizes == [14, 13, 13]
    for s, found in enumerate(stacks):
        for row, a in zip(found, [a for i, a in images.items() if i % 3 == s]):
            assert row == pytest.approx(raster._sums(a))
    for s in range(3):
        some = np.stack([a for i, a in images.items() if i % 3 == s])
        centres, pixels = raster._palette(some, 5, 5)
        for n, a in enumerate(some):
            own, count = raster._palette(a[None], 5, 5)
            assert (count[0] == pixels[n]).all() and (own[0][count[0] > 0] == centres[n][pixels[n] > 0]).all()
            assert (raster._resized(some, 9, 4)[n] == raster._resized(a[None], 9, 4)[0]).all()
    r = some_rasters(spark, images)
    got = {(p["image_id"], p["x"], p["y"]): (p["r"], p["g"], p["b"]) for p in raster.pixels(r).collect()}
    assert got == {(i, x, y): tuple(a[y, x]) for i, a in images.items() for y in range(a.shape[0]) for x in range(a.shape[1])}


def test_rasters_of_one_small_file_are_made_in_many_tasks(spark):
    from sparkloom.functions.image.pixels import synthetic_raster

    ids = spark.range(0, 3000, 1, 1)
    for made in (raster.synthetic(ids, "id"), synthetic_raster(ids, "id")):
        rows = made.select("image_id", F.spark_partition_id().alias("task")).distinct().groupBy("task").count().collect()
        assert len(rows) >= 8 and sum(r["count"] for r in rows) == 3000 and max(r["count"] for r in rows) < 600


def test_small_images_in_stacks_that_fit_a_cache(spark, monkeypatch):
    rng = np.random.default_rng(11)
    images = {i: rng.integers(0, 256, (6, 7, 3), dtype=np.uint8) for i in range(40)}
    batch = pa.RecordBatch.from_arrays(
        [pa.array(list(images)), pa.array([7] * 40, pa.int32()), pa.array([6] * 40, pa.int32()), pa.array([a.tobytes() for a in images.values()])],
        names=["image_id", "width", "height", "rgb"],
    )
    monkeypatch.setattr(raster, "STACK_PIXELS", 42 * 9)
    stacks = list(raster._stacks(batch))
    assert [len(s) for _, s in stacks] == [9, 9, 9, 9, 4]
    together = raster._palette(np.stack(list(images.values())), 5, 5)
    apart = [raster._palette(s, 5, 5) for _, s in stacks]
    assert all(np.array_equal(together[i], np.concatenate([a[i] for a in apart])) for i in (0, 1))


def test_made_images_are_not_broadcast(spark, tmp_path):
    from sparkloom.plans.registry import all_queries

    rows = [(i, 40 + i % 10) for i in range(60)] + [(7, 50), (7, 3), (8, None), (None, 4)]  # ids and sizes
    spark.createDataFrame(rows, "p_partkey long, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    found = all_queries()["image_bytes_default_on_error"].fn(spark, str(tmp_path))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    got = [tuple(r) for r in found.collect()]
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()  # nor when it ran
    broken = {(i, 1.0, "unknown", 0.0, 0.5, 0.0) for i in range(60) if 40 + i % 10 > 45 and i not in (7, 8)} | {(None, 1.0, "unknown", 0.0, 0.5, 0.0)}
    assert {r for r in got if r[2] == "unknown"} == broken
    # each row's image meets each size of its id: 9 images of 7, 3 of them whole; 4 of 8, 2 of them whole
    times = {i: sum(r[0] == i for r in got) for i in range(60)}
    assert times == {i: 3 if i == 7 else 2 if i == 8 else 1 for i in range(60)}
    ids = spark.createDataFrame([(i,) for i in range(60) if 40 + i % 10 <= 45 or i in (7, 8)], "image_id long")
    whole = raster.measures(raster.synthetic(ids, "image_id")).select("image_id", *(F.round(c, 6).alias(c) if c != "orientation" else c for c in ("aspect_ratio", "orientation", "edge_density", "focal_x", "brightness")))
    assert {r for r in got if r[2] != "unknown"} == {tuple(r) for r in whole.collect()}


def test_stacked_png_equals_one_by_one(spark):
    rng = np.random.default_rng(9)
    shapes = [(4, 6)] * 20 + [(1, 1)] * 9 + [(7, 3)] * 2
    images = [rng.integers(0, 256, (*s, 3), dtype=np.uint8) for s in shapes]
    data = [png.encode(a) for a in images]
    # any filter in any row, samples of every kind, one of the stack broken
    raws = []
    for colour, samples in ((0, 1), (2, 3), (4, 2), (6, 4)):
        for n in range(12):
            body = rng.integers(0, 256, (5, 1 + 3 * samples), dtype=np.uint8)
            body[:, 0] = 9 if n == 5 else rng.integers(0, 5, 5)
            head = struct.pack(">IIBBBBB", 3, 5, 8, colour, 0, 0, 0)
            raws.append(png.SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(body.tobytes())) + chunk(b"IEND", b""))
    for i, (image, raw) in enumerate(zip(png._decoded([png._opened(r) for r in raws]), raws)):
        if i % 12 == 5:
            assert image is None
        else:
            assert (image == png.decode(raw)).all()
    assert png._decoded([None, png._opened(data[0])])[0] is None
    df = spark.createDataFrame([(f"i{i}", a.shape[1], a.shape[0], bytearray(a.tobytes()), i) for i, a in enumerate(images)] + [("none", -1, -1, None, 99)],
                               "image_id string, width int, height int, rgb binary, n int").coalesce(1)
    made = {r["image_id"]: r for r in png.encoded(df, keep=("n",)).collect()}
    assert len(made) == 32 and made["none"]["image_data"] is None and made["none"]["n"] == 99
    assert all(bytes(made[f"i{i}"]["image_data"]) == d and made[f"i{i}"]["n"] == i for i, d in enumerate(data))
    again = {r["image_id"]: r for r in png.rasters(png.encoded(df), "image_id").collect()}
    assert again["none"]["width"] == -1 and all(bytes(again[f"i{i}"]["rgb"]) == a.tobytes() for i, a in enumerate(images))
