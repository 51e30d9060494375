"""Accepted images as files by split and class, written by the tasks that hold them; and batches of them for training."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import ship
from ..functions import kernels, transforms
from . import store
from .files import plain_path

OUTCOME = "image_id string, split string, label string, output_path string, bytes long, error string"


def png(rgb) -> bytes:  # noqa: ANN001
    """An RGB array (height, width, 3) as a PNG."""
    h, w = rgb.shape[:2]
    rows = b"".join(b"\0" + rgb[i].tobytes() for i in range(h))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 6)) + chunk(b"IEND", b"")


def _open(path: str):  # noqa: ANN202
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _name(split: str, label: str, image_id: str, suffix: str) -> str:
    clean = lambda s: "".join(ch if ch.isalnum() or ch in "._-" else "_" for ch in s or "unlabelled")
    return f"{clean(split)}/{clean(label)}/{clean(image_id)}{suffix}"


def _oriented(r: dict):  # noqa: ANN202
    import numpy as np

    x = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], r["channels"])
    rgb = np.repeat(x, 3, axis=2) if r["channels"] == 1 else x[..., 2::-1]
    return np.ascontiguousarray(kernels.oriented(rgb, r.get("exif_orientation")))


def _place(fs, at: str, data: bytes | None, source: str | None, mode: str) -> int:  # noqa: ANN001
    """Writes data, or the file at source as a link or copy, and returns its size."""
    if data is None:
        from_fs, from_path = _open(source)
        if mode == "link" and type(from_fs) is type(fs) and type(fs).__name__ == "LocalFileSystem":
            import os

            if os.path.exists(at):
                os.unlink(at)
            os.link(from_path, at)
            return os.path.getsize(at)
        with from_fs.open_input_file(from_path) as f:
            data = f.read()
    with fs.open_output_stream(at) as out:
        out.write(data)
    return len(data)


def decoded(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """image_id, split, label, class_index and the pixels of the manifest's accepted rows with a split; manifest has source_path."""
    images = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", "true").load(path)
    pixels = images.select(plain_path(F.col("image.origin")).alias("source_path"), "image.height", "image.width", F.col("image.nChannels").alias("channels"), "image.data")
    extra = [c for c in ("class_index", "exif_orientation") if c in manifest.columns]
    wanted = manifest.filter("status = 'accepted' and split is not null").select("source_path", "image_id", "split", "label", *extra)
    return wanted.join(pixels, "source_path")


def export(spark: SparkSession, path: str, manifest: DataFrame, target: str, mode: str = "resize", width: int = 224, height: int = 224) -> DataFrame:
    """Where each accepted image of the manifest went, or why it didn't; one that fails doesn't stop the others.

    resize writes PNGs of that size, copy the files as they are, link hard links (copies where there can be none), none
    only says where files would go. A task that runs twice writes the same files with the same content.
    """
    if mode not in ("resize", "copy", "link", "none"):
        raise ValueError("mode is resize, copy, link or none")
    ship(spark)
    names = [x.split()[0] for x in OUTCOME.split(", ")]
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string()]

    def batches_of(handle: Callable[[dict], tuple[str, bytes | None, str | None]]):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, base = _open(target)
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    try:
                        name, data, source = handle(r)
                        at, size = f"{base}/{name}", 0
                        if mode != "none":
                            fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                            size = _place(fs, at, data, source, mode)
                        rows.append((r["image_id"], r["split"], r["label"], f"{target.rstrip('/')}/{name}", size, None))
                    except Exception as e:  # noqa: BLE001  an image is no reason to fail the others
                        rows.append((r["image_id"], r["split"], r["label"], None, None, f"{type(e).__name__}: {e}"[:300]))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], names=names)

        return run

    if mode == "resize":
        import numpy as np

        def resized(r: dict) -> tuple[str, bytes, None]:
            rgb = np.clip(np.rint(kernels.area_resize(_oriented(r), height, width)), 0, 255).astype(np.uint8)
            return _name(r["split"], r["label"], r["image_id"], ".png"), png(rgb), None

        return decoded(spark, path, manifest).mapInArrow(batches_of(resized), OUTCOME)

    def as_is(r: dict) -> tuple[str, None, str]:
        suffix = "." + r["source_path"].rsplit(".", 1)[-1].lower() if "." in r["source_path"].rsplit("/", 1)[-1] else ""
        return _name(r["split"], r["label"], r["image_id"], suffix), None, r["source_path"]

    rows = manifest.filter("status = 'accepted' and split is not null").select("source_path", "image_id", "split", "label")
    return rows.mapInArrow(batches_of(as_is), OUTCOME)


def summary(outcome: DataFrame) -> DataFrame:
    """split, images, failed and bytes."""
    return outcome.groupBy("split").agg(F.count(F.lit(1)).alias("images"), F.count("error").alias("failed"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def write_summary(outcome: DataFrame, path: str) -> dict:
    rows = {r["split"]: {"images": r["images"], "failed": r["failed"], "bytes": r["bytes"]} for r in summary(outcome).collect()}
    store.write_json(outcome.sparkSession, path, {"splits": rows, "images": sum(r["images"] for r in rows.values()), "failed": sum(r["failed"] for r in rows.values())})
    return rows


ITEM = "image_id string, split string, features array<float>, target long"


def dataset(spark: SparkSession, path: str, manifest: DataFrame, transform: Callable | None = None, target_transform: Callable[[int], int] | None = None) -> DataFrame:
    """Items for training: the transformed image as a flat array (channel, row, column), and its class index, 0 where it has none."""
    ship(spark)
    transform = transform or (lambda rgb, image_id: transforms.evaluate(rgb))
    target_transform = target_transform or (lambda i: i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for r in batch.to_pylist():
                x = np.asarray(transform(_oriented(r), r["image_id"]), dtype=np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([r["image_id"]]), pa.array([r["split"]]), pa.array([x.reshape(-1)], pa.list_(pa.float32())), pa.array([int(target_transform(r.get("class_index") or 0))], pa.int64())], names=[c.split()[0] for c in ITEM.split(", ")])

    return decoded(spark, path, manifest).filter("height > 0").mapInArrow(run, ITEM)


def loader(items: DataFrame, split: str, batch_size: int = 32, shuffle: bool | None = None, seed: int = 42, epoch: int = 0) -> Iterator[list]:
    """Batches of a split's items, a partition at a time on the driver; train is shuffled by a hash of id, seed and epoch."""
    rows = items.filter(F.col("split") == split)
    if shuffle if shuffle is not None else split == "train":
        rows = rows.orderBy(F.xxhash64("image_id", F.lit(seed), F.lit(epoch)), "image_id")
    else:
        rows = rows.orderBy("image_id")
    held: list = []
    for r in rows.toLocalIterator():
        held.append(r)
        if len(held) == batch_size:
            yield held
            held = []
    if held:
        yield held


def loaders(items: DataFrame, batch_size: int = 32, seed: int = 42, epoch: int = 0) -> dict[str, Iterator[list]]:
    return {s: loader(items, s, batch_size, seed=seed, epoch=epoch) for s in ("train", "val", "test")}
