"""Ingest-side operators over items: ids, caps, filters, first-seen merge, summaries."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_ids(items: DataFrame, base: Column, order: str = "ordinal") -> DataFrame:
    """items with image_id = base, and -1, -2, ... appended to repeats in scan order. Only repeated ids are numbered, range by range."""
    rows = items.withColumn("_base", base)
    many = rows.groupBy("_base").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_base", F.lit(True).alias("_many"))
    j = rows.join(many, "_base", "left")
    once = j.filter("_many is null").withColumn("image_id", F.col("_base"))
    more = numbered(j.filter("_many"), ["_base"], [order], "_k")
    more = more.withColumn("image_id", F.when(F.col("_k") == 0, F.col("_base")).otherwise(F.concat_ws("-", "_base", F.col("_k").cast("string")))).drop("_k")
    return once.unionByName(more).drop("_base", "_many")


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """df with `name`: each row's number in its group by `order`, from 0. A group with a third of all rows is spread over many tasks.

    Rows are dealt to ranges of (keys, order). Inside a range they are numbered by a window over the range and the key;
    the rows that a key has in earlier ranges are counted before, a row for each range and key that it ends or begins in.
    """
    held = df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    held = _cut(held)
    counts = held.groupBy("_range", *keys).agg(F.count(F.lit(1)).alias("_c"))
    # a key lies in several ranges only where it fills them, so a window of one key has a row a range
    before = F.coalesce(F.sum("_c").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumn("_before", before).filter("_before > 0").select(F.col("_range").alias("_range2"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_before")
    inside = held.withColumn("_in", F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*order)) - 1)
    on = F.col("_range") == F.col("_range2")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return inside.join(starts, on, "left").select(*df.columns, (F.col("_in") + F.coalesce("_before", F.lit(0))).cast("long").alias(name))


def _cut(df: DataFrame) -> DataFrame:
    from .duplicates import _checkpoint

    return _checkpoint(df)


def first_per_group(items: DataFrame, keys: list[str], order: str, n: int, salts: int = 64) -> DataFrame:
    """The first n rows of each group by `order`: cut per salt first, so a group with a third of all rows is spread out."""
    w = lambda *more: Window.partitionBy(*keys, *more).orderBy(order)
    salted = items.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)))
    cut = salted.withColumn("_r", F.row_number().over(w("_salt"))).filter(F.col("_r") <= n)
    return cut.withColumn("_r", F.row_number().over(w())).filter(F.col("_r") <= n).drop("_r", "_salt")


def global_cap(items: DataFrame, n: int, order: str = "ordinal", labelled: Column | None = None) -> DataFrame:
    """Items in scan order up to the n-th labelled one; all if there are fewer."""
    labelled = F.col("label").isNotNull() if labelled is None else labelled
    last = items.filter(labelled).select(order).orderBy(order).limit(n).agg(F.max(order).alias("_last"), F.count(F.lit(1)).alias("_n"))
    return items.join(F.broadcast(last)).filter((F.col("_n") < n) | (F.col(order) <= F.col("_last"))).drop("_last", "_n")


def label_filter(items: DataFrame, include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """status and rejection_code label_excluded for labels not included or excluded."""
    out = F.lit(False)
    if include:
        out = out | ~F.col("label").isin(list(include))
    if exclude:
        out = out | F.col("label").isin(list(exclude))
    out = F.coalesce(out, F.lit(False))
    return items.withColumn("status", F.when(out, "rejected").otherwise("pending")).withColumn("rejection_code", F.when(out, "label_excluded"))


def minimum_class_size(items: DataFrame, least: int) -> DataFrame:
    """rejection_code class_below_minimum for items of small classes; counts join back, no class needs one task."""
    counts = items.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    j = items.join(counts, "label", "left")
    small = F.coalesce(F.col("_n") < least, F.lit(False)) if least > 1 else F.lit(False)
    return j.withColumn("rejection_code", F.when(small, "class_below_minimum")).drop("_n")


def first_seen(items: DataFrame, index: DataFrame, run_id: str, at: str) -> DataFrame:
    """items with the run and time that first saw them, from index (image_id, first_seen_run_id, first_seen_at), else this run's."""
    old = index.select("image_id", F.col("first_seen_run_id").alias("_run"), F.col("first_seen_at").alias("_at"))
    return items.join(old, "image_id", "left").withColumn("first_seen_run_id", F.coalesce("_run", F.lit(run_id))).withColumn("first_seen_at", F.coalesce("_at", F.lit(at))).drop("_run", "_at")


def source_summary(items: DataFrame) -> DataFrame:
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), " | ")
    splits = [joined("source_split").alias("splits")] if "source_split" in items.columns else []
    return items.groupBy("dataset_name").agg(F.count(F.lit(1)).alias("images"), F.count_distinct("source_class").alias("classes"), F.sum("file_size_bytes").alias("bytes"), joined("source_class").alias("labels"), *splits)


def corpus_summary(items: DataFrame) -> DataFrame:
    return items.agg(F.count(F.lit(1)).alias("images"), F.count_if(F.col("status") == "accepted").alias("accepted"), F.count_if(F.col("status") == "rejected").alias("rejected"), F.count_distinct("label").alias("labels"), F.count_distinct("dataset_name").alias("sources"), F.sum("file_size_bytes").alias("bytes"))


def rejection_counts(items: DataFrame) -> DataFrame:
    return items.filter("rejection_code is not null").groupBy("rejection_code").agg(F.count(F.lit(1)).alias("images"))


def identities(items: DataFrame) -> DataFrame:
    """The line that stands for each item in the composition hash."""
    return items.select(F.concat_ws("\0", "image_id", "dataset_name", "source_relpath", F.col("file_size_bytes").cast("string"), "label").alias("identity"))


def composition_hash(items: DataFrame) -> str:
    """SHA-256 over the digests of 65,536 buckets of identities, whatever the items' order or partitions.

    A bucket is chosen by the first digits of an identity's SHA-256; its digest is of the identities' number and of the sums
    of the other digits, so no bucket has to be sorted and every aggregate combines before its shuffle. Only buckets reach the driver.
    """
    long = identities(items).select(F.sha2("identity", 256).alias("h"))
    part = lambda at, n: F.conv(F.substring("h", at, n), 16, 10).cast("decimal(38,0)")
    sums = [F.sum(part(5 + 12 * i, 12)).alias(f"s{i}") for i in range(5)]
    rows = long.groupBy(F.substring("h", 1, 4).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), *sums)
    h = hashlib.sha256()
    for r in sorted(map(tuple, rows.collect())):
        h.update((":".join(map(str, r)) + "\n").encode())
    return h.hexdigest()
