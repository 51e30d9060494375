"""Imbalance, diversity, bias and leakage of a manifest, and the dataset score made of them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar
from . import duplicates, statistics

RATIOS = (0.70, 0.15, 0.15)
# Weights of the dataset score's components.
SCORE_WEIGHTS = {"class_balance": 0.25, "duplicate_ratio": 0.15, "diversity": 0.15, "quality_score": 0.20, "label_consistency": 0.10, "resolution_consistency": 0.05, "source_diversity": 0.10}
GRADES = {"A": 0.85, "B": 0.70, "C": 0.55, "D": 0.40}


def class_counts(df: DataFrame) -> DataFrame:
    return df.filter("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("images"))


def required_per_class(ratios: tuple[float, ...] = RATIOS, least: int = 1) -> int:
    active = [r for r in ratios if r > 0]
    return max(least, math.ceil(1 / min(active))) if active else least


def imbalance(counts: DataFrame, rare_ratio: float = 0.25, min_size: int = 20, required: int | None = None) -> DataFrame:
    """One row: classes, images, largest, smallest, ratio, gini, evenness, and the numbers of rare, undersized and infeasible classes."""
    required = required_per_class() if required is None else required
    mean = counts.agg(F.avg("images").alias("mean"))
    rows = counts.join(F.broadcast(mean))
    a = rows.agg(F.count(F.lit(1)).alias("classes"), F.sum("images").alias("images"), F.max("images").alias("largest"), F.min("images").alias("smallest"), F.round(F.max("images") / F.min("images"), 4).alias("imbalance_ratio"), F.count_if(F.col("images") < rare_ratio * F.col("mean")).alias("rare"), F.count_if(F.col("images") < min_size).alias("undersized"), F.count_if(F.col("images") < required).alias("infeasible"))
    e = statistics.evenness(counts).select(F.round("gini", 6).alias("gini"), F.round("evenness", 6).alias("evenness"))
    return a.join(F.broadcast(e))


def long_tail(counts: DataFrame, head_share: float = 0.8) -> DataFrame:
    """head_classes, the fewest largest classes that cover head_share of the images, and the others' share."""
    n = F.col("images").cast("double")
    run = Window.orderBy(F.desc("images"), "label").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = counts.withColumn("upto", F.sum(n).over(run) / F.sum(n).over(Window.partitionBy())).withColumn("place", F.row_number().over(Window.orderBy(F.desc("images"), "label")))
    head = rows.agg(F.least(F.count_if(F.col("upto") < head_share) + 1, F.count(F.lit(1))).alias("head_classes"))
    tail = rows.join(F.broadcast(head)).agg(F.sum(F.when(F.col("place") > F.col("head_classes"), n).otherwise(0.0)).alias("t"), F.sum(n).alias("n"))
    return head.join(F.broadcast(tail)).select("head_classes", F.round(F.coalesce(F.try_divide("t", "n"), F.lit(0.0)), 6).alias("tail_share"))


def rare_classes(counts: DataFrame, rare_ratio: float = 0.25) -> DataFrame:
    return counts.join(F.broadcast(counts.agg(F.avg("images").alias("mean")))).filter(F.col("images") < rare_ratio * F.col("mean")).select("label", "images")


def split_feasibility(counts: DataFrame, ratios: tuple[float, ...] = RATIOS, least: int = 1) -> DataFrame:
    need = required_per_class(ratios, least)
    return counts.select("label", "images", F.lit(need).alias("required"), (F.col("images") >= need).alias("feasible"))


def source_shares(df: DataFrame) -> DataFrame:
    rows = df.filter("dataset_name is not null").groupBy("dataset_name").agg(F.count(F.lit(1)).alias("images"))
    return rows.select("dataset_name", "images", F.round(F.col("images") / F.sum("images").over(Window.partitionBy()), 6).alias("share"))


def source_diversity(df: DataFrame) -> DataFrame:
    """The evenness of the shares (rounded first)."""
    return statistics.evenness(source_shares(df).select(F.col("share").alias("images"))).select(F.round("evenness", 6).alias("source_diversity"))


def class_source_mix(df: DataFrame, max_share: float = 0.8) -> DataFrame:
    """Per label: sources, the largest one with its share, and whether it dominates or is alone."""
    rows = df.filter("label is not null").groupBy("label", "dataset_name").agg(F.count(F.lit(1)).alias("images"))
    per = rows.groupBy("label").agg(F.sum("images").alias("total"), F.count("dataset_name").alias("sources"), F.min_by("dataset_name", F.struct(-F.col("images"), "dataset_name")).alias("top_source"), F.max("images").alias("top"))
    share = F.col("top") / F.col("total")
    return per.select("label", "sources", "top_source", F.round(share, 6).alias("top_share"), (share > max_share).alias("dominated"), (F.col("sources") == 1).alias("single_source"))


def label_conflicts(df: DataFrame) -> DataFrame:
    """Raw names that became more than one label."""
    pairs = df.filter("source_class is not null and label is not null").select("source_class", "label").distinct()
    return pairs.groupBy("source_class").agg(F.count(F.lit(1)).alias("labels"), F.array_join(F.array_sort(F.collect_set("label")), " | ").alias("canonical")).filter("labels > 1")


def label_consistency(df: DataFrame) -> DataFrame:
    pairs = df.filter("source_class is not null and label is not null").select("source_class", "label").distinct()
    per = pairs.groupBy("source_class").agg(F.count(F.lit(1)).alias("labels"))
    return per.agg(F.round(F.coalesce(1 - F.try_divide(F.count_if(F.col("labels") > 1), F.count(F.lit(1))), F.lit(1.0)), 6).alias("label_consistency"))


def mean_by_source(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy("dataset_name").agg(F.round(F.avg(column), 6).alias("mean")).filter("dataset_name is not null and mean is not null")


def spread(means: DataFrame) -> DataFrame:
    top = F.max("mean")
    return means.agg(F.round(F.when((F.count(F.lit(1)) >= 2) & (top > 0), (top - F.min("mean")) / top).otherwise(F.lit(0.0)), 6).alias("spread"))


def leakage_clusters(df: DataFrame) -> DataFrame:
    """Per duplicate cluster: size, labels, sources, retained images, the first 20 ids and the risk."""
    held = df.filter("duplicate_group is not null").withColumn("_kept", (F.col("status") == "accepted").cast("int"))
    first = held.withColumn("_r", F.row_number().over(Window.partitionBy("duplicate_group").orderBy("ordinal"))).filter("_r <= 20")
    ids = first.groupBy("duplicate_group").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "image_id"))), lambda x: x["image_id"]), " ").alias("image_ids"))
    join = lambda c: F.array_join(F.array_sort(F.collect_set(c)), " | ")
    rows = held.groupBy("duplicate_group").agg(F.count(F.lit(1)).alias("group_size"), join("label").alias("labels"), join("dataset_name").alias("sources"), F.count_distinct("label").alias("distinct_labels"), F.count_distinct("dataset_name").alias("distinct_sources"), F.sum("_kept").alias("retained_images"))
    risk = F.when(F.col("distinct_labels") > 1, "label_conflict").when(F.col("retained_images") > 1, "split_leakage").when(F.col("distinct_sources") > 1, "cross_source_overlap").otherwise("contained")
    return rows.join(ids, "duplicate_group").select(F.col("duplicate_group").alias("group_id"), "group_size", risk.alias("risk"), "labels", "sources", "image_ids", "distinct_labels", "distinct_sources", "retained_images")


def leak_probability(clusters: DataFrame, ratios: tuple[float, ...] = RATIOS) -> DataFrame:
    together: Column = F.lit(0.0)
    for r in ratios:
        if r > 0:
            together = together + F.pow(F.lit(r), F.col("retained_images"))
    return clusters.filter("retained_images > 1").agg(F.round(F.coalesce(F.avg(1 - together), F.lit(0.0)), 6).alias("leak_probability"))


def leakage_summary(clusters: DataFrame) -> DataFrame:
    return clusters.agg(F.count(F.lit(1)).alias("clusters"), F.coalesce(F.sum("group_size"), F.lit(0)).alias("clustered_images"), F.count_if(F.col("distinct_labels") > 1).alias("cross_class"), F.count_if(F.col("distinct_sources") > 1).alias("cross_source"), F.coalesce(F.max("group_size"), F.lit(0)).alias("largest"), F.coalesce(F.sum(F.when(F.col("retained_images") > 1, F.col("retained_images"))), F.lit(0)).alias("at_risk"))


def diversity_global(df: DataFrame, bits: int = 64) -> DataFrame:
    """Mean pairwise distance and its share of the bits, over all pairs."""
    d = duplicates.mean_pairwise_distance(df, [], bits=bits)
    return d.agg(F.round(F.coalesce(F.max("mean_distance"), F.lit(0.0)), 4).alias("mean_distance"), F.round(F.coalesce(F.max("mean_distance"), F.lit(0.0)) / bits, 6).alias("normalized"))


def diversity_per_class(df: DataFrame, bits: int = 64) -> DataFrame:
    return duplicates.mean_pairwise_distance(df, ["label"], bits=bits).select("label", F.round(F.col("mean_distance") / bits, 6).alias("diversity"))


def least_diverse(df: DataFrame, top: int = 10) -> DataFrame:
    return diversity_per_class(df).orderBy("diversity", "label").limit(top)


def unique_hash_ratio(df: DataFrame) -> DataFrame:
    return df.agg(F.round(F.try_divide(F.count_distinct("perceptual_hash"), F.count("perceptual_hash")), 6).alias("unique_hash_ratio"))


def duplicate_ratios(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    share = lambda kind: F.round(F.coalesce(F.try_divide(F.count_if(F.col("quality_duplicate_status") == kind), n), F.lit(0.0)), 6)
    return df.agg(share("exact_duplicate").alias("duplicate_ratio"), share("near_duplicate").alias("near_duplicate_ratio"))


def dataset_score(df: DataFrame, weights: dict[str, float] = SCORE_WEIGHTS) -> DataFrame:
    """One row: the components, the score and its grade. df is the manifest after the gate, rejected rows included."""
    kept = df.filter("status = 'accepted'")
    parts = [
        imbalance(class_counts(kept)).select("gini"),
        duplicate_ratios(kept),
        diversity_global(kept).select("normalized"),
        kept.agg(F.avg("quality_score").alias("mean_quality"), F.abs(F.try_divide(F.stddev_pop("megapixels"), F.avg("megapixels"))).alias("cv")),
        label_consistency(kept),
        source_diversity(kept),
        leak_probability(leakage_clusters(df)),
    ]
    row = parts[0]
    for p in parts[1:]:
        row = row.join(F.broadcast(p))  # one row each
    c = {
        "class_balance": 1 - F.col("gini"),
        "duplicate_ratio": 1 - (F.col("duplicate_ratio") + F.col("near_duplicate_ratio")),
        "diversity": F.col("normalized") / 0.5,
        "quality_score": F.coalesce("mean_quality", F.lit(0.0)),
        "label_consistency": F.col("label_consistency"),
        "resolution_consistency": 1 - F.coalesce("cv", F.lit(0.0)),
        "source_diversity": F.col("source_diversity"),
        "leakage_containment": 1 - F.col("leak_probability"),
    }
    c = {k: scalar.clamp(v) for k, v in c.items()}
    score = scalar.weighted_score(c, weights)
    return row.select(*[F.round(v, 6).alias(k) for k, v in c.items()], score.alias("score"), scalar.grade(score, GRADES, "F").alias("grade"))
