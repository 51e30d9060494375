"""Small PNGs written here, decoded by Spark, measured by the kernels."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenset.functions import kernels
from lumenset.operators import gate, validation
from lumenset.sources import files


def png(x: np.ndarray, level: int = 6) -> bytes:
    h, w = x.shape[:2]
    raw = b"".join(b"\0" + row.tobytes() for row in x.astype(np.uint8))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, level)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    board = np.repeat(np.repeat(np.indices((16, 16)).sum(axis=0) % 2 * 255, 8, axis=0), 8, axis=1)
    sharp = np.stack([board] * 3, axis=2)
    gradient = np.stack([np.tile(np.linspace(0, 255, 128), (128, 1))] * 3, axis=2)
    images = {"A___healthy/sharp.png": png(sharp), "A___healthy/again.png": png(sharp, 1), "train/B___rot/gradient.png": png(gradient), "B___rot/flat.png": png(np.full((64, 64, 3), 128)), "B___rot/small.png": png(sharp[:20, :20]), "B___rot/junk.png": b"junk", "B___rot/empty.png": b"", "loose.png": png(sharp)}
    for name, data in images.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    return str(root)


def test_scan(spark, folder):
    rows = {r.source_relpath: r for r in files.scan(spark, folder, "s").collect()}
    assert len(rows) == 8
    assert (rows["train/B___rot/gradient.png"].source_class, rows["train/B___rot/gradient.png"].source_split) == ("B___rot", "train")
    assert rows["loose.png"].rejection_code == "label_missing"
    assert rows["A___healthy/sharp.png"].source_class == "A___healthy"


def test_probe_and_ladder(spark, folder):
    rows = {r.path.rsplit("/", 1)[-1]: r for r in validation.image_ladder(files.probe_files(spark, folder), min_dimension=32).collect()}
    assert (rows["sharp.png"].width, rows["sharp.png"].image_format, rows["sharp.png"].color_mode, rows["sharp.png"].complete) == (128, "png", "RGB", True)
    assert {n: rows[n].code for n in ("sharp.png", "small.png", "junk.png", "empty.png")} == {"sharp.png": None, "small.png": "invalid_dimensions", "junk.png": "unreadable_file", "empty.png": "empty_file"}


def test_measures(spark, folder):
    rows = {r.path.rsplit("/", 1)[-1]: r for r in files.measure_images(spark, folder).collect()}
    assert rows["junk.png"].decode_failed and "empty.png" not in rows
    assert rows["sharp.png"].pixel_hash == rows["again.png"].pixel_hash
    assert rows["flat.png"].quality_contrast == 0 and rows["flat.png"].quality_entropy == 0
    assert rows["sharp.png"].quality_blur_score > rows["gradient.png"].quality_blur_score
    assert abs(rows["sharp.png"].quality_brightness - 127.5) < 1e-9


def test_gate_on_images(spark, folder):
    df = files.measure_images(spark, folder).withColumn("megapixels", F.col("width") * F.col("height") / 1e6).withColumn("aspect_ratio", F.try_divide("width", "height"))
    got = {r.path.rsplit("/", 1)[-1]: r.rejection_code for r in gate.decided(gate.scored(df)).collect()}
    assert got["junk.png"] == "unreadable_file" and got["flat.png"] == "blurry" and got["sharp.png"] is None


def test_kernels():
    rgb = np.random.default_rng(0).integers(0, 256, (40, 50, 3)).astype(np.uint8)
    luma = kernels.gray(rgb)
    p = np.pad(luma.astype(float), 1, mode="reflect")
    want = np.array([[p[i, j + 1] + p[i + 2, j + 1] + p[i + 1, j] + p[i + 1, j + 2] - 4 * p[i + 1, j + 1] for j in range(50)] for i in range(40)]).var()
    assert abs(kernels.laplacian_variance(luma) - want) < 1e-6
    assert np.allclose(kernels.area_resize(luma, 10, 10), luma.reshape(10, 4, 10, 5).mean(axis=(1, 3)))
    assert len(kernels.cosine_hash(luma)) == len(kernels.average_hash(luma)) == len(kernels.difference_hash(luma)) == 16
    for o in range(1, 9):
        assert kernels.oriented(rgb, o).shape[:2] == ((40, 50) if o < 5 else (50, 40))
