import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions.image import analysis, assemble, palette, pixels


def raster(spark, arrays):
    """Pixel relation from {image_id: HxWx3 uint8 array}."""
    rows = [(int(i), int(x), int(y), int(a[y, x, 0]), int(a[y, x, 1]), int(a[y, x, 2]))
            for i, a in arrays.items() for y in range(a.shape[0]) for x in range(a.shape[1])]
    return spark.createDataFrame(rows, "image_id long, x int, y int, r int, g int, b int")


def gray_np(a):
    a = a.astype(np.int64)
    return (19595 * a[..., 0] + 38470 * a[..., 1] + 7471 * a[..., 2] + 32768) >> 16


def sobel_np(g):
    p = np.pad(g.astype(float), 1, mode="edge")
    gx = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
    gy = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
    return np.hypot(gx, gy).mean()


def glcm_np(g):
    P = np.zeros((256, 256))
    for a, b in zip(g[:, :-1].ravel(), g[:, 1:].ravel()):
        P[a, b] += 1
        P[b, a] += 1
    P /= P.sum()
    i, j = np.indices(P.shape)
    return (P * (i - j) ** 2).sum(), np.sqrt((P ** 2).sum()), (P / (1 + (i - j) ** 2)).sum()


@pytest.fixture(scope="module")
def images():
    rng = np.random.default_rng(3)
    return {
        1: rng.integers(0, 256, size=(7, 9, 3), dtype=np.uint8),
        2: rng.integers(0, 256, size=(5, 5, 3), dtype=np.uint8),
        3: np.full((4, 6, 3), 77, dtype=np.uint8),                 # uniform colour
        4: rng.integers(0, 256, size=(1, 8, 3), dtype=np.uint8),   # one row
        5: rng.integers(0, 256, size=(6, 1, 3), dtype=np.uint8),   # one column
        6: np.repeat(rng.integers(0, 256, size=(5, 4, 1), dtype=np.uint8), 3, axis=2),  # gray
    }


def test_statistics_match_numpy(spark, images):
    px = raster(spark, images)
    dims = {r["image_id"]: r for r in analysis.dimensions(px).collect()}
    edges = {r["image_id"]: r["edge_density"] for r in analysis.edge_density(px).collect()}
    sty = {r["image_id"]: r for r in analysis.style(px).collect()}
    tex = {r["image_id"]: r for r in analysis.texture(px).collect()}
    foc = {r["image_id"]: r for r in analysis.focal_point(px).collect()}
    aes = {r["image_id"]: r for r in analysis.aesthetics(px).collect()}
    for i, a in images.items():
        h, w = a.shape[:2]
        g = gray_np(a)
        assert (dims[i]["width"], dims[i]["height"]) == (w, h)
        assert dims[i]["orientation"] == ("landscape" if w > h else "portrait")
        assert np.isclose(edges[i], sobel_np(g))
        assert np.isclose(sty[i]["brightness"], a.mean())
        assert np.isclose(sty[i]["pixel_std"], a.astype(float).std())
        assert np.isclose(sty[i]["saturation"], a.astype(float).std(axis=2).mean())
        assert np.allclose([sty[i]["var_r"], sty[i]["var_g"], sty[i]["var_b"]], a.reshape(-1, 3).astype(float).var(axis=0))
        fy, fx = np.unravel_index(np.argmax(g), g.shape)
        assert np.isclose(foc[i]["focal_x"], fx / w) and np.isclose(foc[i]["focal_y"], fy / h)
        assert np.isclose(aes[i]["aesthetic_score"], a.mean() / 255.0)
        assert np.isclose(aes[i]["sharpness"], g.std())
        comp = np.abs(np.diff(g, axis=1)).mean() if w > 1 else 0.0
        assert np.isclose(aes[i]["complexity"], comp)
        if w > 1:
            c, e, hmg = glcm_np(g)
            assert np.isclose(tex[i]["texture_contrast"], c) and np.isclose(tex[i]["energy"], e)
            assert np.isclose(tex[i]["homogeneity"], hmg)
        else:
            assert i not in tex  # no horizontal pairs in a one-column image


def test_palette(spark, images):
    px = raster(spark, images)
    pal = palette.color_palette(px).collect()
    by = {}
    for r in pal:
        by.setdefault(r["image_id"], []).append(r)
    for i, rows in by.items():
        assert 1 <= len(rows) <= 5
        assert np.isclose(sum(r["weight"] for r in rows), 1.0)
        assert all(len(r["color_hex"]) == 7 and r["color_hex"].startswith("#") for r in rows)
    assert [r["color_hex"] for r in by[3]] == ["#4d4d4d"]
    stats = {r["image_id"]: r for r in palette.color_stats(px).collect()}
    assert stats[3]["color_diversity"] == 0.0
    # long runs checkpoint the centres to the checkpoint directory
    c, _ = palette.kmeans_colors(px, rounds=4, checkpoint_every=2)
    assert c.count() == len(images)


def test_vectors_suggestions_defaults(spark, images):
    px = raster(spark, images)
    ids = spark.createDataFrame([(i,) for i in list(images) + [99]], "image_id long")
    f = assemble.analyze_images(px, ("COMPOSITION", "STYLE", "AESTHETICS", "COLOR_PALETTE"), ids=ids)
    vec = {r["image_id"]: r["visual_features"] for r in assemble.visual_feature_vector(f, ("COMPOSITION", "STYLE", "AESTHETICS")).collect()}
    assert all(len(v) == 11 for v in vec.values())
    assert vec[99][:2] == [1.0, 0.0]
    sv = assemble.style_vector(f).collect()
    assert all(len(r["style_vector"]) == 6 for r in sv)
    sug = {r["image_id"]: r for r in assemble.suggested_params(f).collect()}
    assert sug[99]["composition"]["orientation"] == "unknown" and sug[1]["colors"]["palette"]
    only_comp = assemble.analyze_images(px, ("COMPOSITION",))
    s2 = assemble.suggested_params(only_comp).first()
    assert s2["style"]["brightness"] == 0.5 and s2["quality"] is None
    with pytest.raises(Exception):
        assemble.analyze_images(px, ("NOPE",))


def test_objects_stub(spark):
    a = np.zeros((6, 8, 3), dtype=np.uint8)
    a[1:3, 2:5] = 255
    px = raster(spark, {7: a, 8: np.zeros((3, 3, 3), dtype=np.uint8)})
    out = assemble.detect_objects(px).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["x1"], r["y1"], r["x2"], r["y2"], r["label"]) == (2.0, 1.0, 5.0, 3.0, 1)
    assert np.isclose(r["score"], 6 / 48)


def test_narrow_images_through_the_dispatcher(spark):
    rng = np.random.default_rng(9)
    images = {i: rng.integers(0, 256, size=s, dtype=np.uint8) for i, s in ((1, (1, 1, 3)), (2, (1, 6, 3)), (3, (6, 1, 3)))}
    rows = {r["image_id"]: r for r in assemble.analyze_images(raster(spark, images), ("COMPOSITION", "STYLE", "AESTHETICS")).collect()}
    for i, a in images.items():
        g = gray_np(a)
        assert np.isclose(rows[i]["brightness"], a.mean()) and np.isclose(rows[i]["sharpness"], g.std())
        assert np.isclose(rows[i]["saturation"], a.astype(float).std(axis=2).mean())
        assert np.isclose(rows[i]["edge_density"], sobel_np(g))
        texture = glcm_np(g) if a.shape[1] > 1 else (0.0, 0.0, 0.0)
        assert np.allclose([rows[i][c] for c in ("contrast", "energy", "homogeneity")], texture)


def test_objects_and_defaults_through_the_dispatcher(spark):
    a = np.zeros((6, 8, 3), dtype=np.uint8)
    a[1:3, 2:5] = 255
    px = raster(spark, {7: a, 8: np.zeros((3, 3, 3), dtype=np.uint8)}).withColumn("image_id", F.concat(F.lit("dir/"), F.col("image_id"), F.lit(".png")))
    ids = spark.createDataFrame([("dir/7.png",), ("dir/8.png",), ("dir/broken.png",)], "image_id string")
    rows = {r["image_id"]: r for r in assemble.analyze_images(px, ("OBJECTS", "COLOR_PALETTE"), ids=ids).collect()}
    assert [(o["x1"], o["y1"], o["x2"], o["y2"], o["label"]) for o in rows["dir/7.png"]["objects"]] == [(2.0, 1.0, 5.0, 3.0, 1)]
    assert rows["dir/8.png"]["objects"] == [] and rows["dir/8.png"]["dominant_colors"] == ["#000000"]
    assert rows["dir/broken.png"]["objects"] == [] and rows["dir/broken.png"]["dominant_colors"] == ["#000000"] * 5

    def red(img):
        assert img.ndim == 3 and img.shape[2] == 3
        return [((0.0, 0.0, 1.0, 1.0), 2, float(img[..., 0].mean()))]

    assert {r["image_id"]: r["label"] for r in assemble.detect_objects(px, red, channels="RGB").collect()} == {"dir/7.png": 2, "dir/8.png": 2}


def _png(path, arr):
    h, w = arr.shape[:2]
    color = {1: 0, 3: 2, 4: 6}[1 if arr.ndim == 2 else arr.shape[2]]
    raw = b"".join(b"\x00" + arr[y].tobytes() for y in range(h))

    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)

    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0))
                + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_load_png_files(spark, tmp_out):
    rng = np.random.default_rng(5)
    rgb = rng.integers(0, 256, size=(4, 5, 3), dtype=np.uint8)
    rgba = rng.integers(0, 256, size=(3, 2, 4), dtype=np.uint8)
    gray = rng.integers(0, 256, size=(2, 3), dtype=np.uint8)
    _png(os.path.join(tmp_out, "rgb.png"), rgb)
    _png(os.path.join(tmp_out, "rgba.png"), rgba)
    _png(os.path.join(tmp_out, "gray.png"), gray)
    with open(os.path.join(tmp_out, "broken.png"), "wb") as f:
        f.write(b"not an image")
    imgs = pixels.load_images(spark, tmp_out)
    info = pixels.image_info(imgs.withColumn("image_id", F.regexp_extract("image.origin", r"([a-z]+)\.png$", 1)))
    dims = {r["image_id"]: (r["width"], r["height"], r["n_channels"]) for r in info.collect()}
    assert dims["rgb"] == (5, 4, 3) and dims["rgba"] == (2, 3, 4) and dims["gray"] == (3, 2, 1)
    assert dims["broken"][0] == -1
    px = {(r["image_id"], r["x"], r["y"]): (r["r"], r["g"], r["b"]) for r in pixels.struct_to_pixels(info).collect()}
    assert all(px[("rgb", x, y)] == tuple(int(v) for v in rgb[y, x]) for y in range(4) for x in range(5))
    assert all(px[("rgba", x, y)] == tuple(int(v) for v in rgba[y, x, :3]) for y in range(3) for x in range(2))
    assert all(px[("gray", x, y)] == (int(gray[y, x]),) * 3 for y in range(2) for x in range(3))
    assert not any(k[0] == "broken" for k in px)
