"""The batch pipeline over image folders: ingest, validate, gate, profile, analyse, split, package, report.

Each stage but the first can be switched off. A stage's frame is cut by a checkpoint in the shared folder before the next
one reads it, so a lost executor costs a stage at most, and the counts in the log come from frames that are there.
"""

from __future__ import annotations

import datetime
import json
import logging
import platform
import subprocess
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as configuration
from .functions import scalar
from .operators import corpus, duplicates, findings, gate, labels, records, rgb, splitting, validation, versioning
from .reports import figures, html
from .schema import COLUMNS, complete
from .sources import artefacts, files, package, store

log = logging.getLogger("lumenset")


class PipelineError(Exception):
    """What ends a run; what is wrong with an image becomes a rejection instead."""


@dataclass
class StageReport:
    stage: str
    status: str = "started"
    seconds: float = 0.0
    counters: dict[str, int] = field(default_factory=dict)
    error: str | None = None


@dataclass
class Run:
    """A run's identity and what it has found so far."""

    spark: SparkSession
    config: dict
    run_id: str
    started: str
    layout: artefacts.Layout
    environment: dict
    version: str | None = None
    stages: list[StageReport] = field(default_factory=list)
    manifest: DataFrame | None = None
    findings: DataFrame | None = None
    grouped: DataFrame | None = None
    links: DataFrame | None = None
    outcome: DataFrame | None = None

    def record(self) -> dict:
        """The run as a JSON document."""
        return {"run_id": self.run_id, "started": self.started, "project": self.config["project"], "config_hash": configuration.fingerprint(self.config), "location_free_hash": configuration.location_free_fingerprint(self.config), "dataset_version": self.version, "seed": self.config["seed"], "environment": self.environment, "stages": [vars(s) for s in self.stages]}

    def event(self, **what: object) -> None:
        """One JSON object in the log, and a line for people."""
        entry = {"at": _now(), "run_id": self.run_id, **what}
        log.info("%s", json.dumps(store.plain(entry)))
        store.append_line(self.spark, self.layout.log(self.run_id), json.dumps(store.plain(entry)))


def _now() -> str:
    return datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")


def environment(spark: SparkSession) -> dict:
    """Versions of what the run rests on, and the commit if there is one."""
    import numpy
    import pyarrow

    try:
        commit = subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, timeout=5, check=False).stdout.strip() or None
    except (OSError, subprocess.SubprocessError):
        commit = None
    return {"spark": spark.version, "python": platform.python_version(), "platform": platform.platform(), "numpy": numpy.__version__, "pyarrow": pyarrow.__version__, "master": spark.sparkContext.master, "commit": commit}


def start(spark: SparkSession, config: Mapping, run_id: str | None = None) -> Run:
    """A run with an id of its own. Random choices are hashes with config's seed, so there is no state to seed."""
    if not config["output"]["root"]:
        raise PipelineError("output.root must say where artefacts go")
    configuration.check(config)
    run = Run(spark, dict(config), run_id or uuid.uuid4().hex[:12], _now(), artefacts.Layout(config["output"]["root"]), environment(spark))
    run.event(event="run", status="started")
    return run


@contextmanager
def stage_scope(run: Run, name: str) -> Iterator[StageReport]:
    """Reports a stage's start and its end, with time and counters, also where it fails."""
    report = StageReport(name)
    run.stages.append(report)
    run.event(event="stage", stage=name, status="started")
    began = time.monotonic()
    try:
        yield report
        report.status = "completed"
    except Exception as e:
        report.status, report.error = "failed", f"{type(e).__name__}: {e}"[:500]
        raise
    finally:
        report.seconds = round(time.monotonic() - began, 3)
        run.event(event="stage", **vars(report))


def _counts(df: DataFrame) -> dict[str, int]:
    return {r["status"]: r["count"] for r in df.groupBy("status").count().collect()}


def _cut(df: DataFrame) -> DataFrame:
    return duplicates._checkpoint(df)


def ingest(run: Run) -> DataFrame:
    """Records of all sources with ids, labels, class indices and first sight; the fingerprint and version that follow."""
    spark, c = run.spark, run.config
    sources = files.resolve_sources(spark, c["sources"], c["discovery"]["root"], tuple(c["discovery"]["exclude"]), version=c["discovery"]["version"], class_depth=c["discovery"]["class_depth"])
    rows = records.constructed(files.scan_all(spark, sources))
    if (n := c["execution"]["max_images_per_class"]) is not None:
        rows = corpus.first_per_group(rows, ["dataset_name", "source_class"], "ordinal", n)
    if (n := c["execution"]["max_images"]) is not None:
        rows = corpus.global_cap(rows, n, labelled=F.col("source_class").isNotNull())
    probed = None
    for s in sources:
        p = files.probe_files(spark, s["path"])
        probed = p if probed is None else probed.unionByName(p)
    observed = ["file_size_bytes", "content_hash", "width", "height", "image_format", "color_mode", "exif_orientation", "complete"]
    rows = _cut(validation.store_observations(rows.drop("image_format"), probed.withColumnRenamed("path", "source_path"), observed))
    by_path = scalar.stable_id(F.col("dataset_name"), F.col("source_relpath"))
    rows = corpus.with_ids(rows, by_path if c["corpus"]["id_strategy"] == "path" else F.when(F.col("content_hash").isNotNull(), scalar.stable_id(F.col("content_hash"))).otherwise(by_path))
    rules = configuration.label_rules(spark, c)
    resolved = _cut(labels.resolve(labels.distinct_labels(rows), rules))
    rows = labels.attach(rows, resolved)
    excluded = corpus.label_filter(rows, c["corpus"]["include"], c["corpus"]["exclude"])
    missing = F.when(F.col("source_class").isNull(), "label_missing")
    small = corpus.minimum_class_size(excluded.select("ordinal", F.col("rejection_code").alias("_excluded"), "label"), c["corpus"]["minimum_class_size"])
    rows = excluded.drop("rejection_code").join(small.select("ordinal", F.coalesce("_excluded", "rejection_code").alias("_code")), "ordinal")
    rows = rows.withColumn("_code", F.coalesce(missing, F.col("_code"))).withColumn("status", F.when(F.col("_code").isNotNull(), "rejected").otherwise("pending"))
    entry = F.struct(F.lit("ingest").alias("stage"), F.col("_code").alias("code"), F.replace(F.col("_code"), F.lit("_"), F.lit(" ")).alias("message"))
    rows = rows.withColumn("rejections", F.when(F.col("_code").isNotNull(), F.array(entry)).otherwise(F.array())).drop("_code")
    rows = rows.withColumn("megapixels", F.col("width") * F.col("height") / 1e6).withColumn("aspect_ratio", F.try_divide("width", "height"))
    if c["corpus"]["first_seen"]:
        rows = corpus.first_seen(rows, artefacts.read_first_seen(spark, run.layout.first_seen), run.run_id, run.started)
    kept = resolved.join(rows.filter("status <> 'rejected'").select(F.col("label").alias("canonical")).distinct(), "canonical", "left_semi")
    mapping = _cut(labels.mapping(kept))
    rows = _cut(labels.with_class_index(rows, mapping, most=100_000))
    parts = versioning.fingerprint(rows, mapping, configuration.location_free_fingerprint(c))
    run.version, reason = versioning.resolve_version(parts, artefacts.read_fingerprint(spark, run.layout.fingerprint), c["versioning"]["initial"], c["versioning"]["bump"])
    artefacts.write_fingerprint(rows, run.layout.fingerprint, parts, run.version, reason)
    if c["corpus"]["first_seen"]:
        old = artefacts.read_first_seen(spark, run.layout.first_seen)
        known = rows.select("image_id", "first_seen_run_id", "first_seen_at")
        artefacts.write_first_seen(known.unionByName(old.join(known, "image_id", "left_anti")), run.layout.first_seen)
    artefacts.write_metadata(_flat(rows), run.layout, resolved, mapping, {"run_id": run.run_id, "version": run.version})
    return rows


def _flat(df: DataFrame) -> DataFrame:
    """The manifest's columns of a working frame."""
    rows = records.flat_operations(df) if "operations" in df.columns else df
    if "rejections" in df.columns:
        first = F.try_element_at("rejections", F.lit(1))
        rows = rows.withColumn("rejection_stage", first["stage"]).withColumn("rejection_code", first["code"]).withColumn("rejection_reason", first["message"]).withColumn("rejection_count", F.size("rejections"))
        rows = rows.withColumn("rejected", F.col("status") == "rejected").drop("rejections")
    return complete(rows.select(*[c for c, k in rows.dtypes if c in COLUMNS and not k.startswith(("array", "struct", "map"))]))


def validate(run: Run, df: DataFrame) -> DataFrame:
    """Metadata, labels and headers checked, cheapest first; errors reject, warnings annotate."""
    v, spark = run.config["validation"], run.spark
    rows = df.withColumn("source_path", F.regexp_replace("source_path", "^[a-z0-9]+:/*", "/")).withColumn("source_root", F.regexp_replace("source_root", "^[a-z0-9]+:/*", "/"))
    live = rows.filter("status <> 'rejected'").withColumn("perceptual_hash", F.lit(None).cast("string")).withColumn("pixel_hash", F.lit(None).cast("string"))
    found = validation.metadata_issues(live, first_seen=run.config["corpus"]["first_seen"])
    mapping = df.select("label", "class_index").filter("class_index is not null").distinct()
    clean = live.join(found.select("image_id").distinct(), "image_id", "left_anti")
    said = validation.label_issues(clean, mapping).select("image_id", F.lit("labels").alias("validator"), "code", "check", F.lit("error").alias("severity"))
    ladder = {"extensions": tuple(v["extensions"]), "formats": tuple(v["formats"]), "modes": tuple(v["modes"]), "min_dimension": v["min_dimension"], "max_pixels": v["max_pixels"], "max_bytes": v["max_bytes"]}
    chain = validation.image_ladder(live.withColumn("path", F.col("source_path")), **ladder)
    seen = chain.filter("code is not null").select("image_id", F.lit("images").alias("validator"), "code", F.col("code").alias("check"), F.lit("error").alias("severity"))
    warned = chain.select("image_id", F.lit("images").alias("validator"), F.explode("warnings").alias("code")).select("image_id", "validator", "code", F.col("code").alias("check"), F.lit("warning").alias("severity"))
    found = _cut(found.unionByName(said).unionByName(seen).unionByName(warned))
    out = validation.validated(df.drop("rejection_stage", "rejection_code", "rejection_reason", "rejection_count", "rejected"), found)
    out = _cut(out.drop("rejection_stage", "rejection_code", "rejection_reason", "rejection_count", "rejected"))
    report = validation.validation_report(out, found)
    artefacts.write_validation(_flat(out).withColumn("status", F.col("status")), run.layout, report)
    problems = validation.fingerprint_agreement(versioning.fingerprint(df, mapping, configuration.location_free_fingerprint(run.config)), artefacts.read_fingerprint(spark, run.layout.fingerprint))
    if problems:
        run.event(event="integrity", problems=problems)
    return out


def assess(run: Run, df: DataFrame) -> DataFrame:
    """Every accepted image decoded once, measured, compared with the others, and decided."""
    spark, c = run.spark, run.config
    rules, d = configuration.gate_rules(c), c["duplicates"]
    ok = df.filter("status <> 'rejected'")
    measured = None
    for root in [r[0] for r in df.select("source_root").distinct().collect()]:
        turned = ok.select(F.col("source_path").alias("path"), "exif_orientation")
        m = files.measure_images(spark, root, turned, *(c["measures"][k] for k in ("longest", "contrast", "blur", "hash")))
        measured = m if measured is None else measured.unionByName(m)
    m = measured.select(F.col("path").alias("source_path"), *[x for x in measured.columns if x not in ("path", "width", "height")])
    rows = _cut(gate.scored(ok.drop("channels", "pixel_hash", "perceptual_hash").join(m, "source_path", "left").withColumn("decode_failed", F.coalesce("decode_failed", F.lit(True))), rules))
    links = duplicates.exact_links(rows, tuple(d["hashes"]), d["across_classes"]).unionByName(duplicates.near_links(rows, d["radius"], d["bits"], d["across_classes"]).select("a", "b")).distinct()
    run.grouped = _cut(duplicates.representatives(duplicates.clusters(links).join(rows.select("ordinal", "image_id", "quality_score", "megapixels"), "ordinal"), d["keep"]))
    run.links = _cut(duplicates.links_to_representative(rows, run.grouped, d["bits"]))
    judged = gate.applied(gate.decided(duplicates.duplicate_status(rows, run.grouped, run.links), rules), rules)
    out = _cut(judged.unionByName(df.filter("status = 'rejected'"), allowMissingColumns=True))
    artefacts.write_quality(judged, run.layout, run.grouped, run.links)
    return out


def run_pipeline(spark: SparkSession, config: Mapping, run_id: str | None = None) -> Run:
    """All stages that config switches on, in order. The run holds the manifest, the findings and a report of each stage."""
    run = start(spark, config, run_id)
    on = run.config["stages"]
    df: DataFrame | None = None
    channels: list[dict] = []

    def staged(name: str, f) -> None:  # noqa: ANN001
        nonlocal df
        if on.get(name, True):
            with stage_scope(run, name) as report:
                df = f(run, df) if df is not None else f(run)
                report.counters = _counts(df)

    try:
        staged("ingest", ingest)
        staged("validate", validate)
        staged("quality", assess)
        scope = lambda: records.profile_scope(df, run.config["profiling"]["include_rejected"] or not (on["validate"] or on["quality"]))
        if on["profile"] and on["quality"]:
            with stage_scope(run, "profile"):
                p = run.config["profiling"]
                artefacts.write_profile(scope(), run.layout)
                for root in sorted(r[0] for r in df.select("source_root").distinct().collect()):
                    key = {"root": root, "sample": p["rgb_sample"], "side": p["rgb_side"], "bins": p["rgb_bins"], "composition": corpus.composition_hash(df)}
                    channels += rgb.cached_statistics(spark, run.layout.cache, key, lambda root=root, p=p: rgb.rgb_statistics(spark, root, p["rgb_sample"], run.config["seed"], p["rgb_side"], p["rgb_bins"]))
        if on["analyse"] and on["quality"]:
            with stage_scope(run, "analyse") as report:
                a, s = run.config["analysis"], run.config["split"]
                run.findings = _cut(findings.findings(df, findings.Rules(a["rare_ratio"], a["min_class_size"], a["max_imbalance"], a["max_source_share"], tuple(s["ratios"]), s["min_samples"], s["group"])))
                artefacts.write_analysis(df, run.layout, run.findings)
                report.counters = {"findings": run.findings.count()}
        if on["split"]:
            with stage_scope(run, "split") as report:
                s = run.config["split"]
                ready = df if on["validate"] or on["quality"] else df.withColumn("status", F.when(F.col("status") == "pending", "accepted").otherwise(F.col("status")))
                assigned = _cut(splitting.assign(ready, tuple(s["ratios"]), s["seed"] if s["seed"] is not None else run.config["seed"], s["min_samples"], s["drop_small"], s["group"]))
                artefacts.write_splits(assigned, run.layout.splits)
                df = _cut(ready.drop("split").join(assigned.select("image_id", "split"), "image_id", "left"))
                report.counters = {r["split"] or "none": r["count"] for r in df.groupBy("split").count().collect()}
        if on["package"] and on["split"]:
            with stage_scope(run, "package"):
                p = run.config["packaging"]
                outcome = None
                for root in [r[0] for r in df.select("source_root").distinct().collect()]:
                    part = package.export(spark, root, df.filter(F.col("source_root") == root), run.layout.dataset, p["mode"], p["width"], p["height"])
                    outcome = part if outcome is None else outcome.unionByName(part)
                run.outcome = _cut(outcome)
                package.write_summary(run.outcome, run.layout.summary)
                df = _cut(df.drop("output_path").join(run.outcome.select("image_id", "output_path"), "image_id", "left"))
        if on["reports"]:
            with stage_scope(run, "reports") as report:
                pages = {}
                if run.links is not None:
                    pages["quality"] = html.quality_page(df.filter("action is not null"), duplicates.duplicate_report(run.links, run.grouped))
                    pages["profiling"] = html.profile_page(scope(), channels)
                if run.findings is not None:
                    pages["analysis"] = html.analysis_page(df, run.findings)
                for name, text in pages.items():
                    store.write_bytes(spark, run.layout.at("reports", f"{name}_report.html"), text.encode())
                if run.findings is not None:
                    drawn, failed = figures.render(df, run.findings)
                    for name, svg in drawn.items():
                        store.write_bytes(spark, run.layout.at("visualizations", f"{name}.svg"), svg.encode())
                    report.counters = {"pages": len(pages), "figures": len(drawn), "failed": len(failed)}
        files.write_manifest(_flat(df), run.layout.manifest)
        files.write_manifest(_flat(df), run.layout.manifest_csv, "csv")
    finally:
        run.manifest = df
        store.write_json(spark, run.layout.run, run.record())
        run.event(event="run", status="failed" if any(s.status == "failed" for s in run.stages) else "completed")
    return run
