"""Deterministic stratified splits whose units are duplicate groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .corpus import numbered

RATIOS = (0.70, 0.15, 0.15)


def units(df: DataFrame, group: bool = True) -> DataFrame:
    """label, unit and its images among the accepted rows."""
    unit = F.coalesce("duplicate_group", "image_id") if group and "duplicate_group" in df.columns else F.col("image_id")
    return df.filter("status = 'accepted'").groupBy("label", unit.alias("unit")).agg(F.count(F.lit(1)).alias("images"))


def assign(df: DataFrame, ratios: tuple[float, float, float] = RATIOS, seed: int = 42, min_samples: int = 1, drop_small: bool = False, group: bool = True) -> DataFrame:
    """image_id, label, unit and split of the accepted rows.

    Units of a label are shuffled by the MD5 of seed and unit; the first n_train go to train, the next n_val to val,
    the others to test. Sizes round half to even and keep one test unit where there are more than two. Units get their
    split on their own narrow table, numbered range by range, so a label with a third of all units needs no single task.
    """
    total = sum(ratios)
    train, val = ratios[0] / total, ratios[1] / total
    table = units(df, group).withColumn("_md5", F.md5(F.concat(F.lit(f"{seed}:"), "unit")))
    sizes = table.groupBy(F.col("label").alias("_label")).agg(F.sum("images").alias("images_of_label"), F.count(F.lit(1)).alias("n"))
    if drop_small:
        sizes = sizes.filter(F.col("images_of_label") >= min_samples)
    rows = numbered(table, ["label"], ["_md5", "unit"], "place").withColumn("place", F.col("place") + 1)
    rows = rows.join(F.broadcast(sizes) if sizes.limit(100_001).count() <= 100_000 else sizes, F.col("label").eqNullSafe(F.col("_label")))
    rows = rows.withColumn("n_train", F.greatest(F.lit(1), F.bround(F.col("n") * train).cast("long"))).withColumn("n_val", F.bround(F.col("n") * val).cast("long"))
    tight = (F.col("n_train") + F.col("n_val") >= F.col("n")) & (F.col("n") > 2)
    rows = rows.withColumn("n_val", F.when(tight, F.greatest(F.lit(1), F.col("n") - F.col("n_train") - 1)).otherwise(F.col("n_val")))
    split = F.when(F.col("place") <= F.col("n_train"), "train").when(F.col("place") <= F.col("n_train") + F.col("n_val"), "val").otherwise("test")
    chosen = rows.select("label", "unit", split.alias("split"))
    unit = F.coalesce("duplicate_group", "image_id") if group and "duplicate_group" in df.columns else F.col("image_id")
    right = chosen.select(F.col("label").alias("_label"), F.col("unit").alias("_unit"), "split")
    rows = df.filter("status = 'accepted'").select("image_id", "label", unit.alias("unit"))
    return rows.join(right, F.col("label").eqNullSafe(F.col("_label")) & (F.col("unit") == F.col("_unit"))).select("label", "unit", "image_id", "split")


def split_counts(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("label", "split").agg(F.count(F.lit(1)).alias("images"), F.count_distinct("unit").alias("units"))


def dropped_classes(df: DataFrame, min_samples: int) -> DataFrame:
    return df.filter("status = 'accepted'").groupBy("label").agg(F.count(F.lit(1)).alias("images")).filter(F.col("images") < min_samples)


def sampler_weights(df: DataFrame, key: str = "label") -> DataFrame:
    """image_id and weight, one over its class's images; counts join back, so no class needs one task."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return df.join(F.broadcast(counts) if counts.limit(100_001).count() <= 100_000 else counts, key).select("image_id", key, (1.0 / F.col("_n")).alias("weight"))


def weighted_sample(df: DataFrame, draws: int, seed: int = 42, key: str = "label") -> DataFrame:
    """About `draws` rows with replacement: each row repeats by the whole part of its expected number of draws, and once more by a hash against the rest."""
    w = sampler_weights(df, key)
    total = w.agg(F.sum("weight")).first()[0] or 1.0
    expected = F.col("weight") * F.lit(draws / total)
    u = F.pmod(F.xxhash64(F.col("image_id"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    times = (F.floor(expected) + F.when(u < expected - F.floor(expected), 1).otherwise(0)).cast("int")
    return w.withColumn("times", times).filter("times > 0").select("image_id", key, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("draw"))
