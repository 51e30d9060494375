"""What a run leaves behind: tables, JSON documents, pages. Every path comes from Layout."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analysis, corpus, duplicates, labels, statistics
from ..schema import typed
from . import store
from .files import write_manifest

FIRST_SEEN = "image_id string, first_seen_run_id string, first_seen_at string"


@dataclass(frozen=True)
class Layout:
    """Where a run's artefacts lie."""

    root: str

    def at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def manifest(self) -> str:
        return self.at("metadata", "image_manifest.parquet")

    @property
    def manifest_csv(self) -> str:
        return self.at("metadata", "metadata.csv")

    @property
    def labels(self) -> str:
        return self.at("metadata", "label_mapping.json")

    @property
    def fingerprint(self) -> str:
        return self.at("metadata", "dataset_fingerprint.json")

    @property
    def run(self) -> str:
        return self.at("metadata", "run.json")

    @property
    def splits(self) -> str:
        return self.at("metadata", "splits.json")

    @property
    def first_seen(self) -> str:
        return self.at("corpus", "corpus_index.parquet")

    @property
    def cache(self) -> str:
        return self.at("cache")

    @property
    def dataset(self) -> str:
        return self.at("dataset")

    @property
    def summary(self) -> str:
        return self.at("reports", "preprocessing_summary.json")

    def log(self, run_id: str) -> str:
        return self.at("logs", f"run_{run_id}.jsonl")


def write_table(df: DataFrame, path: str, kind: str = "csv") -> None:
    """df as a folder of CSV files with a header, or of Parquet files; arrays and structs become JSON in CSV."""
    if kind == "parquet":
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
        return
    flat = [F.to_json(c).alias(c) if k.startswith(("array", "struct", "map")) else F.col(c) for c, k in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def read_first_seen(spark: SparkSession, path: str) -> DataFrame:
    """image_id with the run and time that first saw it; empty where there is no such table or it has other columns."""
    from pyspark.errors import AnalysisException

    wanted = [c.split()[0] for c in FIRST_SEEN.split(", ")]
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        df = None
    if df is None or not set(wanted) <= set(df.columns):
        return spark.createDataFrame([], FIRST_SEEN)
    return df.select(*[F.col(c).cast("string").alias(c) for c in wanted]).filter("image_id is not null").dropDuplicates(["image_id"])


def write_first_seen(df: DataFrame, path: str) -> None:
    """The ids with the run and time that first saw them; the table that was read may be the one that is replaced."""
    spark = df.sparkSession
    beside = f"{path}.next"
    df.select(*[c.split()[0] for c in FIRST_SEEN.split(", ")]).write.mode("overwrite").option("compression", "snappy").parquet(beside)
    fs, target = store._at(spark, path)
    fs.delete(target, True)
    if not fs.rename(store._at(spark, beside)[1], target):
        raise OSError(f"can't rename to {path}")


def write_labels(spark: SparkSession, path: str, resolved: DataFrame, mapping: DataFrame, run: Mapping[str, object]) -> None:
    """label -> index, images by label, and how each raw name became its label; there are as many entries as names."""
    index = {r["label"]: r["class_index"] for r in mapping.orderBy("class_index").collect()}
    history = [r.asDict() for r in resolved.select("dataset_name", "raw_label", "image_count", "canonical", "rule").orderBy("dataset_name", "raw_label").collect()]
    counts: dict[str, int] = {}
    for h in history:
        counts[h["canonical"]] = counts.get(h["canonical"], 0) + h["image_count"]
    aliases = {r["alias"]: r["label"] for r in labels.alias_table(resolved).collect()}
    store.write_json(spark, path, {"labels": index, "images": counts, "aliases": aliases, "history": history, "run": dict(run)})


def write_metadata(df: DataFrame, layout: Layout, resolved: DataFrame, mapping: DataFrame, run: Mapping[str, object]) -> None:
    """The manifest as Parquet and CSV, and the label mapping."""
    write_manifest(df, layout.manifest)
    write_manifest(df, layout.manifest_csv, "csv")
    write_labels(df.sparkSession, layout.labels, resolved, mapping, run)


def read_fingerprint(spark: SparkSession, path: str) -> dict | None:
    """The stored fingerprint; None if there is none or it can't be read."""
    found = store.read_json(spark, path)
    return found if isinstance(found, dict) and "fingerprint" in found else None


def write_fingerprint(df: DataFrame, path: str, parts: Mapping[str, str], version: str, reason: str) -> None:
    """The fingerprint with counts, sources and images by class."""
    counts = corpus.corpus_summary(df).first().asDict()
    sources = [r.asDict() for r in corpus.source_summary(df).orderBy("dataset_name").collect()]
    classes = {r["label"]: r["images"] for r in statistics.counts_by(df.filter("label is not null"), "label").orderBy("label").collect()}
    store.write_json(df.sparkSession, path, {**parts, "version": version, "reason": reason, "counts": counts, "sources": sources, "classes": classes})


def write_validation(df: DataFrame, layout: Layout, report: DataFrame) -> None:
    """Accepted and rejected rows apart, and the report."""
    flat = typed(df.drop("rejections", "operations"))
    for status in ("accepted", "rejected"):
        write_table(flat.filter(F.col("status") == status), layout.at("validation", f"{status}_images.csv"))
    rows = [r.asDict() for r in report.orderBy("kind", "name").collect()]
    store.write_json(df.sparkSession, layout.at("validation", "validation_report.json"), {"report": rows})


def write_quality(df: DataFrame, layout: Layout, grouped: DataFrame, links: DataFrame) -> None:
    """A row of measures for each assessed row, and a row for each member of a duplicate cluster."""
    measures = [c for c in df.columns if c.startswith("quality_")]
    write_table(df.select("image_id", "label", "dataset_name", *measures, "failures", "action", "rejection_code"), layout.at("analytics", "quality_metrics.csv"))
    write_table(duplicate_members(df, grouped, links), layout.at("analytics", "duplicate_report.csv"))


def duplicate_members(items: DataFrame, grouped: DataFrame, links: DataFrame) -> DataFrame:
    """group_id, image_id, role, similarity, size and label of each member of a cluster."""
    g = grouped.select("ordinal", F.col("duplicate_group").alias("group_id"), "representative", "cluster_size")
    k = links.select("ordinal", "kind", "similarity")
    rows = g.join(k, "ordinal", "left").join(items.select("ordinal", "image_id", "label"), "ordinal")
    return rows.select("group_id", "image_id", F.when(F.col("ordinal") == F.col("representative"), "representative").otherwise(F.col("kind")).alias("role"), "similarity", "cluster_size", "label")


def write_profile(df: DataFrame, layout: Layout) -> None:
    write_table(statistics.class_distribution(df), layout.at("analytics", "class_distribution.csv"))
    write_table(statistics.numeric_summary(df), layout.at("analytics", "image_statistics.csv"))


def write_analysis(df: DataFrame, layout: Layout, found: DataFrame) -> None:
    """The clusters, and the score with all findings."""
    write_table(analysis.leakage_clusters(df), layout.at("analytics", "leakage_report.csv"))
    score = analysis.dataset_score(df).first().asDict()
    store.write_json(df.sparkSession, layout.at("analytics", "dataset_score.json"), {**score, "metrics": [r.asDict() for r in found.orderBy("key").collect()]})


def write_splits(assigned: DataFrame, path: str, table_path: str | None = None, most: int = 5_000_000) -> None:
    """split -> ids as JSON; beyond `most` ids as a table of (split, image_id) beside it, which the JSON names."""
    rows = assigned.select("split", "image_id")
    if rows.limit(most + 1).count() > most:
        table_path = table_path or path.removesuffix(".json") + ".parquet"
        write_table(rows, table_path, "parquet")
        store.write_json(assigned.sparkSession, path, {"table": table_path})
        return
    out: dict[str, list[str]] = {"train": [], "val": [], "test": []}
    for r in rows.orderBy("split", "image_id").toLocalIterator():
        out.setdefault(r["split"], []).append(r["image_id"])
    store.write_json(assigned.sparkSession, path, out)


def write_duplicate_summary(links: DataFrame, grouped: DataFrame, path: str) -> None:
    store.write_json(links.sparkSession, path, duplicates.duplicate_report(links, grouped).first().asDict())
