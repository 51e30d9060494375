"""Statistics of colour channels: sums, squares and histograms that are added up over all pixels."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import ship
from ..functions import kernels
from ..sources import store

CHANNELS = ("red", "green", "blue")
PARTIAL_SCHEMA = "channel int, pixels long, total double, squares double, histogram array<long>, images long, failed long"


def channel_partials(data: bytes, height: int, width: int, channels: int, side: int = 256, bins: int = 64) -> list[tuple]:
    """(channel, pixels, sum, sum of squares, histogram) of an image of `channels` bands, blue first, scaled so that its longest side is at most `side`; values lie in [0, 1]."""
    import numpy as np

    x = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    rgb = np.repeat(x, 3, axis=2) if channels == 1 else x[..., 2::-1]
    rgb = kernels.downscale(np.ascontiguousarray(rgb), side)
    out = []
    for c in range(3):
        v = rgb[..., c].reshape(-1)
        scaled = v.astype(np.float64) / 255
        out.append((c, v.size, float(scaled.sum()), float((scaled * scaled).sum()), np.bincount(v.astype(np.int64) * bins // 256, minlength=bins)[:bins].tolist()))
    return out


def image_partials(images: DataFrame, side: int = 256, bins: int = 64) -> DataFrame:
    """A row for each batch and channel of images (height, width, nChannels, data); what can't be read counts as failed."""
    ship(images.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            sums = [[0, 0.0, 0.0, np.zeros(bins, np.int64)] for _ in range(3)]
            good = bad = 0
            for r in batch.to_pylist():
                try:
                    parts = channel_partials(r["data"], r["height"], r["width"], r["nChannels"], side, bins)
                except (ValueError, TypeError, IndexError):
                    bad += 1
                    continue
                good += 1
                for c, n, total, squares, histogram in parts:
                    s = sums[c]
                    s[0], s[1], s[2], s[3] = s[0] + n, s[1] + total, s[2] + squares, s[3] + np.array(histogram)
            columns = [[0, 1, 2], [s[0] for s in sums], [s[1] for s in sums], [s[2] for s in sums], [s[3].tolist() for s in sums], [good] * 3, [bad] * 3]
            kinds = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in PARTIAL_SCHEMA.split(", ")])

    return images.select("height", "width", "nChannels", "data").mapInArrow(run, PARTIAL_SCHEMA)


def accumulate(partials: DataFrame, bins: int = 64) -> DataFrame:
    """channel, pixels, mean, std, histogram, images and failed: partial sums added up; a variance below zero by rounding is zero."""
    sums = partials.groupBy("channel").agg(F.sum("pixels").alias("pixels"), F.sum("total").alias("t"), F.sum("squares").alias("q"), *[F.sum(F.col("histogram")[i]).alias(f"h{i}") for i in range(bins)], F.sum("images").alias("images"), F.sum("failed").alias("failed"))
    mean = F.try_divide("t", "pixels")
    std = F.sqrt(F.greatest(F.try_divide("q", "pixels") - mean * mean, F.lit(0.0)))
    return sums.select("channel", "pixels", mean.alias("mean"), std.alias("std"), F.array(*[F.col(f"h{i}") for i in range(bins)]).alias("histogram"), "images", "failed")


def rgb_statistics(spark: SparkSession, path: str, sample: int | None = 4000, seed: int = 42, side: int = 256, bins: int = 64) -> DataFrame:
    """The channels' statistics of the images under path; of about `sample` of them, chosen by a hash of the path, unless it is None."""
    rows = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", "true").load(path).select("image.*")
    if sample is not None:
        n = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").count()
        rows = rows.filter(F.pmod(F.xxhash64("origin", F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, sample / max(1, n)) * (1 << 30)) + 1)
    return accumulate(image_partials(rows, side, bins), bins)


def byte_statistics(df: DataFrame, column: str, bins: int = 64) -> DataFrame:
    """The same sums over the UTF-8 bytes of a text column, as one channel: bin and how many bytes lie in it, with the number, mean and deviation of all.

    A batch yields one row of its 256 counts.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            counts = np.zeros(256, np.int64)
            for v in batch.column(0):
                counts += np.bincount(np.frombuffer(v.as_buffer() or b"", np.uint8), minlength=256) if v.is_valid else 0
            yield pa.RecordBatch.from_arrays([pa.array([counts.tolist()], pa.list_(pa.int64()))], names=["counts"])

    per = df.select(column).mapInArrow(run, "counts array<long>").select(F.posexplode("counts").alias("byte", "n")).groupBy("byte").agg(F.sum("n").alias("n"))
    v = F.col("byte") / 255.0
    sums = per.agg(F.sum("n").alias("bytes"), F.sum(F.col("n") * v).alias("t"), F.sum(F.col("n") * v * v).alias("q"))
    mean = F.try_divide("t", "bytes")
    moments = sums.select("bytes", mean.alias("mean"), F.sqrt(F.greatest(F.try_divide("q", "bytes") - mean * mean, F.lit(0.0))).alias("std"))
    return per.groupBy(F.expr(f"byte * {bins} div 256").alias("bin")).agg(F.sum("n").alias("count")).join(F.broadcast(moments))


def cached_statistics(spark: SparkSession, cache_root: str | None, key: Mapping[str, object], compute) -> list[dict]:  # noqa: ANN001
    """compute()'s rows as dictionaries, from a JSON file named by the digest of key where there is one; without a root, always anew."""
    path = f"{cache_root.rstrip('/')}/rgb_{store.digest(dict(key))[:16]}.json" if cache_root else None
    held = store.read_json(spark, path) if path else None
    if isinstance(held, dict) and held.get("key") == store.plain(dict(key)) and isinstance(held.get("rows"), list):
        return held["rows"]
    rows = [store.plain(r) for r in compute().orderBy("channel").collect()]  # three rows
    if path:
        store.write_json(spark, path, {"key": dict(key), "rows": rows})
    return rows
