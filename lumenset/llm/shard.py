"""Sharding by a keyed permutation of global row numbers.

Rows get the numbers 0..N-1 in the order (doc_id, checksum, size, hash); a Feistel network with cycle
walking permutes them, and position p lands in shard p % shards at slot p // shards. Anyone who knows N,
the seed and the shard count can compute where a row is, and which row sits in a slot, without any table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, ship

ROUNDS = 8


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """SplitMix64's finaliser on x and a round key."""
    x = x + np.uint64(key & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _network(x: np.ndarray, bits: int, seed: int, inverse: bool) -> np.ndarray:
    low = bits // 2
    low_mask, high_mask = np.uint64((1 << low) - 1), np.uint64((1 << (bits - low)) - 1)
    left, right = x >> np.uint64(low), x & low_mask
    for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        key = (seed * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF
        if r % 2:
            right = right ^ (_mix(left, key) & low_mask)
        else:
            left = left ^ (_mix(right, key) & high_mask)
    return (left << np.uint64(low)) | right


def permute(numbers, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """The image of each number under a permutation of 0..n-1 (its preimage if inverse)."""
    x = np.asarray(numbers, dtype=np.uint64)
    if n <= 1:
        return x.astype(np.int64)
    bits = max(2, int(n - 1).bit_length())
    with np.errstate(over="ignore"):
        x = _network(x, bits, seed, inverse)
        while (outside := x >= np.uint64(n)).any():  # the domain is under twice n, so few rounds remain
            x[outside] = _network(x[outside], bits, seed, inverse)
    return x.astype(np.int64)


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """The global row number that sits in a slot of a shard."""
    return int(permute([slot * shards + shard], n, seed, inverse=True)[0])


def number_rows(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """df with row_number_global 0..N-1 in the order of its columns `order`, and N.

    Rows are dealt to ranges of all the order columns, which are numbered side by side, so a value of the first column
    that a third of all rows have is spread over many ranges. The cuts steer only the work; the numbers don't depend on
    them. Equal rows are counted before the shuffle and numbered as one run, so a row that repeats a billion times is
    one row here.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    held = checkpoint(counted.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    sums = {r[0]: r[1] for r in held.groupBy("__range").agg(F.sum("__copies")).collect()}  # a row a partition
    before, offsets = 0, []
    for r in sorted(sums):
        offsets += [F.lit(r), F.lit(before).cast("long")]
        before += sums[r]
    if not offsets:
        return held.withColumn("row_number_global", F.lit(0).cast("long")).drop("__copies", "__range"), 0
    run = Window.partitionBy("__range").orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.create_map(*offsets)[F.col("__range")] + F.sum("__copies").over(run) - F.col("__copies")
    numbered = held.withColumn("__first", first).withColumn("__k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)))
    return numbered.withColumn("row_number_global", F.col("__first") + F.col("__k")).drop("__range", "__first", "__k", "__copies"), before


def shuffle_shards(df: DataFrame, order: list[str], shards: int = 24, seed: int = 20) -> DataFrame:
    """df with shard (0..shards-1) and slot (gapless from 0 in each shard); counts differ by one at most.

    Nulls sort first. Rows that agree in all columns are interchangeable: each gets a slot of its own. An empty
    table stays empty; df must hold the order columns, others travel along. Columns named shard, slot or
    row_number_global are replaced.
    """
    ship(df.sparkSession)
    df = df.drop("shard", "slot", "row_number_global")
    numbered, n = number_rows(df, order)

    @F.pandas_udf("long")
    def position(numbers):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(permute(numbers.to_numpy(), n, seed))

    placed = numbered.withColumn("__at", position("row_number_global"))
    return placed.withColumn("shard", (F.col("__at") % shards).cast("int")).withColumn("slot", F.expr(f"__at div {shards}")).drop("__at")


def op7_feistel_shards(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents into 24 shards under the law `rows`."""
    from .common import table

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_h"))
    out = shuffle_shards(rows, ["doc_id", "text_crc32", "size", "_h"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number_global")
