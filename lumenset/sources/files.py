"""Folder-per-class image collections as DataFrames."""

from __future__ import annotations

import fnmatch
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import ship
from ..functions import kernels
from ..operators.corpus import numbered
from ..operators.labels import _plain

# The suffixes of images and the names of split folders.
SUFFIXES = (".jpg", ".jpeg", ".png")
SPLITS = ("train", "val", "valid", "validation", "test", "eval")


# Folders that are no sources.
EXCLUDED = (".*", "_*", "*backup*", "*bak", "*tmp*", "*temp*", "*archive*")


def list_sources(spark: SparkSession, root: str, exclude: tuple[str, ...] = EXCLUDED) -> list[tuple[str, str]]:
    """(name, path) of the folders directly under root, by Hadoop's file system; excluded patterns are left out."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    folders = [(s.getPath().getName(), s.getPath().toString()) for s in found if s.isDirectory()]
    return sorted(f for f in folders if not any(fnmatch.fnmatch(f[0].lower(), p) for p in exclude))


def resolve_sources(spark: SparkSession, configured: list[dict], root: str | None = None, exclude: tuple[str, ...] = EXCLUDED, **defaults) -> list[dict]:
    """The enabled configured sources, then the folders under root that none of the configured ones (enabled or not) claims.

    A found source is named by the label form of its folder. No source at all, or two of one name, are errors.
    """
    plain_path = lambda p: re.sub("^[a-z0-9]+:/*", "/", p).rstrip("/")
    out = [{**defaults, **s} for s in configured if s.get("enabled", True)]
    claimed = {plain_path(s["path"]) for s in configured}
    if root:
        for name, path in list_sources(spark, root, tuple(exclude)):
            if plain_path(path) not in claimed:
                out.append({**defaults, "name": _plain(name), "path": path})
    names = [s["name"] for s in out]
    if not out or len(set(names)) < len(names):
        raise ValueError("sources must be given, with distinct names")
    return out


def listing(spark: SparkSession, path: str, suffixes: tuple[str, ...] | None = None) -> DataFrame:
    """path and length of all files under path, sorted by path, hidden ones left out: the plain scan, without classes."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").unionByName(empty_files(spark, path).select("path", "length"))
    if suffixes is not None:
        rows = rows.filter(F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin(*suffixes))
    return rows.orderBy("path")


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """path, modificationTime and length of files without content, which Spark's file sources leave out.

    The driver lists the folders, as Spark's own file index does, one at a time; only empty files are kept.
    """
    import datetime

    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    rows, todo = [], [target]
    while todo:
        for f in fs.listStatus(todo.pop()):
            name = f.getPath().getName()
            if name.startswith((".", "_")):
                continue
            if f.isDirectory():
                todo.append(f.getPath())
            elif f.getLen() == 0:
                rows.append((f.getPath().toString(), datetime.datetime.fromtimestamp(f.getModificationTime() / 1000), 0))
    return spark.createDataFrame(rows, "path string, modificationTime timestamp, length long")


def scan(spark: SparkSession, path: str, name: str, version: str = "unversioned", depth: int = 1, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """One row a file: path, relpath, size, time, class and split folder. File contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "modificationTime", "length")
    files = files.unionByName(empty_files(spark, path))
    root = path.rstrip("/")
    plain = re.sub("^[a-z0-9]+:/*", "/", root)
    rel = F.substr(F.regexp_replace("path", "^[a-z0-9]+:/*", "/"), F.lit(len(plain) + 2))
    rows = files.withColumn("source_relpath", rel).filter(F.lower(F.regexp_extract("source_relpath", r"(\.[^./]*)$", 1)).isin(*suffixes))
    parts = F.split("source_relpath", "/")
    folder = F.size(parts) > 1
    split = F.when(folder & F.lower(F.get(parts, F.lit(0))).isin(*SPLITS), F.lower(F.get(parts, F.lit(0))))
    at = F.when(split.isNotNull(), depth).otherwise(depth - 1)
    label = F.when(F.size(parts) - 1 > at, F.get(parts, at))
    return rows.select(
        F.lit(name).alias("dataset_name"), F.lit(version).alias("dataset_version"), F.lit(root).alias("source_root"), F.col("path").alias("source_path"), "source_relpath",
        F.element_at(parts, -1).alias("original_filename"), label.alias("source_class"), split.alias("source_split"), F.col("length").alias("source_size_bytes"),
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss").alias("source_modified_at"), F.col("path").alias("path"), F.when(label.isNull(), "label_missing").alias("rejection_code"),
    )


def scan_all(spark: SparkSession, sources: list[tuple[str, str]] | list[dict], **options) -> DataFrame:
    """The scans of all sources, with an ordinal that later ties go by: sources as given, then paths, files of a folder before its folders.

    A source is (name, path), or a mapping that may hold version and class_depth too. Rows are numbered range by range.
    """
    given = [s if isinstance(s, dict) else {"name": s[0], "path": s[1]} for s in sources]
    names = [s["name"] for s in given]
    if not given or len(set(names)) < len(names):
        raise ValueError("sources must be given, with distinct names")
    out = None
    for i, s in enumerate(given):
        own = {k: s[o] for o, k in (("version", "version"), ("class_depth", "depth")) if o in s}
        rows = scan(spark, s["path"], s["name"], **{**options, **own}).withColumn("_source", F.lit(i))
        out = rows if out is None else out.unionByName(rows)
    parts = F.split("source_relpath", "/")
    folders = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.concat(F.lit("1"), p))
    out = out.withColumn("_place", F.array_join(F.concat(folders, F.array(F.concat(F.lit("0"), F.element_at(parts, -1)))), "\0")).withColumn("_one", F.lit(0))
    return numbered(out, ["_one"], ["_source", "_place"], "ordinal").drop("_source", "_place", "_one")


def _orientation(exif: bytes) -> int | None:
    if exif[:2] not in (b"II", b"MM"):
        return None
    e = "<" if exif[:2] == b"II" else ">"
    at = struct.unpack(e + "I", exif[4:8])[0]
    for i in range(struct.unpack(e + "H", exif[at : at + 2])[0]):
        tag, kind, _, value = struct.unpack(e + "HHIH", exif[at + 2 + 12 * i : at + 12 + 12 * i])
        if tag == 0x0112 and kind == 3:
            return value
    return None


def probe(data: bytes) -> dict:
    """Width, height, format, mode and orientation from a JPEG's or PNG's header; empty if it is neither."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            w, h, _, kind = struct.unpack(">IIBB", data[16:26])
            return {"width": w, "height": h, "image_format": "png", "color_mode": {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}.get(kind), "exif_orientation": None}
        if data[:2] == b"\xff\xd8":
            at, turn = 2, None
            while at + 4 <= len(data):
                while data[at] == 0xFF and data[at + 1] == 0xFF:
                    at += 1
                marker, n = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
                if marker == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
                    turn = _orientation(data[at + 10 : at + 2 + n])
                if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                    _, h, w, bands = struct.unpack(">BHHB", data[at + 4 : at + 10])
                    return {"width": w, "height": h, "image_format": "jpeg", "color_mode": {1: "L", 3: "RGB", 4: "CMYK"}.get(bands), "exif_orientation": turn}
                at += 2 + n
    except (struct.error, IndexError):
        pass
    return {}


PROBE_SCHEMA = "path string, file_size_bytes long, content_hash string, width long, height long, image_format string, color_mode string, exif_orientation long, complete boolean"


def probe_files(spark: SparkSession, path: str) -> DataFrame:
    """Header facts, size and SHA-256 of each file; `complete` tells whether the end marker is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = content.as_py() or b""
                ended = data.rstrip(b"\0")[-2:] == b"\xff\xd9" if data[:2] == b"\xff\xd8" else data[-8:-4] == b"IEND"
                rows.append({"path": p, "file_size_bytes": len(data), "content_hash": hashlib.sha256(data).hexdigest(), "complete": ended, **{k: probe(data).get(k) for k in ("width", "height", "image_format", "color_mode", "exif_orientation")}})
            fields = [("path", pa.string()), ("file_size_bytes", pa.int64()), ("content_hash", pa.string()), ("width", pa.int64()), ("height", pa.int64()), ("image_format", pa.string()), ("color_mode", pa.string()), ("exif_orientation", pa.int64()), ("complete", pa.bool_())]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in fields], names=[n for n, _ in fields])

    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    none = empty_files(spark, path).select("path", F.lit(b"").alias("content"))
    return files.select("path", "content").unionByName(none).mapInArrow(run, PROBE_SCHEMA)


MEASURES = ["quality_blur_score", "tenengrad", "quality_brightness", "shadow_fraction", "highlight_fraction", "quality_contrast", "quality_entropy", "quality_colorfulness"]
MEASURE_SCHEMA = "path string, width long, height long, channels long, decode_failed boolean, pixel_hash string, " + ", ".join(f"{m} double" for m in MEASURES) + ", average_hash string, difference_hash string, perceptual_hash string"


def plain_path(origin: Column) -> Column:
    """The path as file listings have it, of an image's origin, which is a URI."""
    return F.regexp_replace(F.url_decode(F.replace(origin, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def measure_images(spark: SparkSession, path: str, orientations: DataFrame | None = None, longest: int = 512, contrast: str = "std", blur: str = "laplacian", hash_type: str = "phash") -> DataFrame:
    """Every image decoded once by the JVM, all measures and hashes from that one array; failures are a flag, not an error.

    blur (laplacian or tenengrad) is the measure in quality_blur_score, hash_type (phash, dhash or ahash) the hash in
    perceptual_hash; the others keep columns of their own. With `orientations` (path, exif_orientation) only its paths come back.
    """
    chosen = {"quality_blur_score": {"laplacian": "quality_blur_score", "tenengrad": "tenengrad"}[blur], "perceptual_hash": {"phash": "perceptual_hash", "dhash": "difference_hash", "ahash": "average_hash"}[hash_type]}
    ship(spark)
    images = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", "true").load(path)
    rows = images.select(plain_path(F.col("image.origin")).alias("path"), "image.height", "image.width", F.col("image.nChannels").alias("channels"), "image.data")
    rows = rows.join(orientations.select("path", "exif_orientation"), "path") if orientations is not None else rows.withColumn("exif_orientation", F.lit(None).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        names = [x.split()[0] for x in MEASURE_SCHEMA.split(", ")]
        kinds = {"path": pa.string(), "width": pa.int64(), "height": pa.int64(), "channels": pa.int64(), "decode_failed": pa.bool_(), "pixel_hash": pa.string(), "average_hash": pa.string(), "difference_hash": pa.string(), "perceptual_hash": pa.string()}
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["height"] <= 0 or r["width"] <= 0 or not r["data"]:
                    out.append({"path": r["path"], "decode_failed": True})
                    continue
                x = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], r["channels"])
                rgb = np.repeat(x, 3, axis=2) if r["channels"] == 1 else x[..., 2::-1]
                rgb = np.ascontiguousarray(kernels.oriented(rgb, r["exif_orientation"]))
                out.append({"path": r["path"], "width": rgb.shape[1], "height": rgb.shape[0], "channels": 3, "decode_failed": False, "pixel_hash": hashlib.sha1(rgb.tobytes()).hexdigest(), **(m := kernels.measure(rgb, longest, contrast_method=contrast)), **{k: m[v] for k, v in chosen.items()}})
            yield pa.RecordBatch.from_arrays([pa.array([o.get(n) for o in out], kinds.get(n, pa.float64())) for n in names], names=names)

    return rows.select("path", "height", "width", "channels", "data", "exif_orientation").mapInArrow(run, MEASURE_SCHEMA)


def write_manifest(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """The manifest as a folder of Parquet (snappy) or CSV files, in the manifest's column order."""
    from ..schema import typed

    w = typed(df).write.mode("overwrite")
    w.option("compression", "snappy").parquet(path) if kind == "parquet" else w.option("header", True).csv(path)
