"""The analysis as findings: a metric each, with its value, bounds and status."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import status
from . import analysis

SCHEMA = "key string, value_num double, value_str string, status string"


@dataclass(frozen=True)
class Rules:
    # The bounds of the findings.
    rare_ratio: float = 0.25
    min_class_size: int = 20
    max_imbalance: float = 10.0
    max_source_share: float = 0.8
    ratios: tuple[float, float, float] = (0.70, 0.15, 0.15)
    min_samples: int = 3
    grouped_split: bool = True


def _find(key: str, value: Column, healthy: Column | None = None, tolerable: Column | None = None, text: Column | None = None) -> Column:
    state = F.lit("info") if healthy is None else status(healthy, F.lit(False) if tolerable is None else tolerable)
    return F.struct(F.lit(key).alias("key"), value.cast("double").alias("value_num"), (F.lit(None) if text is None else text).cast("string").alias("value_str"), state.alias("status"))


def _rows(one: DataFrame, found: list[Column]) -> DataFrame:
    return one.select(F.explode(F.array(*found)).alias("f")).select("f.*")


def imbalance_findings(kept: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Seven findings on class sizes; none without classes."""
    counts = analysis.class_counts(kept)
    required = analysis.required_per_class(rules.ratios, rules.min_samples)
    one = analysis.imbalance(counts, rules.rare_ratio, rules.min_class_size, required).join(F.broadcast(analysis.long_tail(counts))).filter("classes > 0")
    c = F.col
    return _rows(
        one,
        [
            _find("imbalance.ratio", c("imbalance_ratio"), c("imbalance_ratio") <= rules.max_imbalance, c("imbalance_ratio") <= 2 * rules.max_imbalance),
            _find("imbalance.gini", c("gini"), c("gini") <= 0.5, c("gini") <= 0.7),
            _find("imbalance.evenness", c("evenness"), c("evenness") >= 0.8, c("evenness") >= 0.6),
            _find("imbalance.rare_classes", c("rare"), c("rare") == 0, c("rare") <= 0.1 * c("classes")),
            _find("imbalance.undersized_classes", c("undersized"), c("undersized") == 0, c("undersized") <= 3),
            _find("imbalance.long_tail", c("head_classes")),
            _find("imbalance.split_feasibility", c("infeasible"), c("infeasible") == 0),
        ],
    )


def diversity_findings(kept: DataFrame, bits: int = 64) -> DataFrame:
    """Five findings on hashes and duplicates; none without hashes."""
    hashes = kept.agg(F.count("perceptual_hash").alias("hashes"))
    least = analysis.least_diverse(kept, 1).agg(F.max("label").alias("label"), F.max("diversity").alias("lowest"))
    one = hashes.join(F.broadcast(analysis.diversity_global(kept, bits))).join(F.broadcast(analysis.unique_hash_ratio(kept))).join(F.broadcast(analysis.duplicate_ratios(kept))).join(F.broadcast(least)).filter("hashes > 0")
    c = F.col
    return _rows(
        one,
        [
            _find("diversity.normalized", c("normalized"), c("normalized") >= 0.25, c("normalized") >= 0.15),
            _find("diversity.unique_hashes", c("unique_hash_ratio"), c("unique_hash_ratio") >= 0.95, c("unique_hash_ratio") >= 0.85),
            _find("diversity.duplicate_ratio", c("duplicate_ratio"), c("duplicate_ratio") <= 0.02, c("duplicate_ratio") <= 0.10),
            _find("diversity.near_duplicate_ratio", c("near_duplicate_ratio"), c("near_duplicate_ratio") <= 0.05, c("near_duplicate_ratio") <= 0.15),
            _find("diversity.least_diverse_classes", c("lowest"), text=c("label")),
        ],
    )


def bias_findings(kept: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Six findings on sources; those that compare sources only inform where there are fewer than two."""
    mix = analysis.class_source_mix(kept, rules.max_source_share).agg(F.count(F.lit(1)).alias("classes"), F.count_if("dominated").alias("dominated"), F.count_if("single_source").alias("single"))
    sources = kept.agg(F.count_distinct("dataset_name").alias("sources"))
    size, score = (analysis.spread(analysis.mean_by_source(kept, c)).withColumnRenamed("spread", n) for c, n in (("megapixels", "size"), ("quality_score", "score")))
    one = sources.join(F.broadcast(mix)).join(F.broadcast(analysis.source_diversity(kept))).join(F.broadcast(analysis.label_consistency(kept))).join(F.broadcast(size)).join(F.broadcast(score)).filter("sources > 0")
    c, few = F.col, F.col("sources") < 2

    def compared(key: str, value: Column, healthy: Column, tolerable: Column) -> Column:
        return F.when(few, _find(key, value)).otherwise(_find(key, value, healthy, tolerable))

    return _rows(
        one,
        [
            compared("bias.source_diversity", c("source_diversity"), c("source_diversity") >= 0.6, c("source_diversity") >= 0.35),
            compared("bias.dominated_classes", c("dominated"), c("dominated") == 0, c("dominated") <= 0.5 * c("classes")),
            _find("bias.single_source_classes", c("single")),
            _find("bias.label_consistency", c("label_consistency"), c("label_consistency") >= 1.0, c("label_consistency") >= 0.95),
            compared("bias.resolution_consistency", c("size"), c("size") <= 0.5, c("size") <= 0.8),
            compared("bias.quality_consistency", c("score"), c("score") <= 0.3, c("score") <= 0.5),
        ],
    )


def leakage_findings(clusters: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Five findings on duplicate clusters, given all of them, rejected rows included."""
    one = analysis.leakage_summary(clusters).join(F.broadcast(analysis.leak_probability(clusters, rules.ratios)))
    c, grouped = F.col, F.lit(rules.grouped_split)
    return _rows(
        one,
        [
            _find("leakage.clusters", c("clusters")),
            _find("leakage.at_risk_images", c("at_risk"), (c("at_risk") == 0) | grouped),
            _find("leakage.random_split_probability", c("leak_probability"), (c("leak_probability") == 0) | grouped),
            _find("leakage.cross_class_clusters", c("cross_class"), c("cross_class") == 0, c("cross_class") <= F.greatest(F.lit(1), F.floor(c("clusters") / 20))),
            _find("leakage.cross_source_clusters", c("cross_source")),
        ],
    )


def findings(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """All findings on the manifest after the gate."""
    kept = df.filter("status = 'accepted'")
    out = imbalance_findings(kept, rules).unionByName(diversity_findings(kept)).unionByName(bias_findings(kept, rules))
    return out.unionByName(leakage_findings(analysis.leakage_clusters(df), rules))


def worst(found: DataFrame) -> DataFrame:
    """area, metrics and the worst status of each group of findings."""
    rank = F.when(F.col("status") == "critical", 3).when(F.col("status") == "warning", 2).when(F.col("status") == "ok", 1).otherwise(0)
    return found.groupBy(F.substring_index("key", ".", 1).alias("area")).agg(F.count(F.lit(1)).alias("metrics"), F.max_by("status", rank).alias("status"))
