"""A manifest over the generated tables: one item per document, with measures derived from its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import ship
from ..functions import scalar
from . import labels


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance and geometry of the items, before labels are harmonised."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = d.join(known, "doc_id", "left")
    kind = F.when(F.col("quality") == 1, "Healthy").when(F.col("quality") == 0, "Low Quality").otherwise("Unrated")
    size = F.octet_length("text").cast("long")
    lines = F.size(F.split("text", "\n")).cast("long")
    words = F.size(F.split("text", " ")).cast("long")
    return rows.select(
        F.col("doc_id").alias("ordinal"),
        F.col("source").alias("dataset_name"),
        F.lit("1.0").alias("dataset_version"),
        F.concat(F.upper("lang"), F.lit("___"), kind).alias("source_class"),
        F.concat(F.upper("lang"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_relpath"),
        scalar.stable_id(F.col("source"), F.col("doc_id")).alias("image_id"),
        size.alias("file_size_bytes"),
        F.col("n_chars").alias("width"),
        lines.alias("height"),
        words.alias("words"),
        F.sha2("text", 256).alias("content_hash"),
        F.sha1(F.lower(F.regexp_replace("text", "[ \\t\\r\\n]+", " "))).alias("pixel_hash"),
        "text",
    )


def measured(df: DataFrame) -> DataFrame:
    """Geometry and the stand-ins for pixel measures, all from counts of the text."""
    n = F.col("width").cast("double")
    blur = F.try_divide(n * 40.0, F.col("words"))
    return df.withColumns(
        {
            "megapixels": n * F.col("height") / 1e6,
            "aspect_ratio": F.try_divide(n, F.col("height")),
            "quality_blur_score": blur,
            "quality_brightness": F.try_divide(F.col("words") * 255.0, n),
            "quality_contrast": F.try_divide(n * 2.0, F.col("height") * 10.0),
        }
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled and measured manifest of the documents."""
    ship(spark)
    return labels.harmonise(measured(base(spark, sf_dir)))


def majority_hash(texts):  # noqa: ANN001, ANN201
    """16 hexadecimal digits for each text: 64 majority bits over the first half of the MD5s of its distinct words; zeros without a word."""
    import hashlib
    import re

    import numpy as np
    import pyarrow as pa

    blanks = re.compile("[ \\t\\r\\n]+").split
    out = []
    for text in texts:
        words = set(blanks(text.as_py() or "")) - {""}
        if not words:
            out.append("0" * 16)
            continue
        digests = b"".join(hashlib.md5(w.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()[:8] for w in words)
        ones = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out.append(np.packbits(2 * ones > len(words)).tobytes().hex())
    return pa.array(out, pa.string())


def text_hash(text: Column) -> Column:
    """The perceptual hash of a text column: one Arrow-batched pass over whole rows, without a shuffle of words."""
    return F.arrow_udf(majority_hash, "string")(F.lower(text))


def text_entropy(texts):  # noqa: ANN001, ANN201
    """The entropy in bits of each text's characters; 0 for null and empty texts."""
    import math
    from collections import Counter

    import pyarrow as pa

    out = []
    for text in texts:
        counts = Counter(text.as_py() or "")
        n = sum(counts.values())
        out.append(math.log2(n) - sum(k * math.log2(k) for k in counts.values()) / n if n else 0.0)
    return pa.array(out, pa.float64())


def character_entropy(text: Column) -> Column:
    return F.arrow_udf(text_entropy, "double")(text)
