"""A run over a folder of small images, its artefacts, a second run, and what configuration allows."""

import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenset import config as configuration
from lumenset import pipeline
from lumenset.operators import findings, gate, rgb, validation, versioning
from lumenset.sources import artefacts, files, package, store


def picture(seed, shade=0, size=96):
    rng = np.random.default_rng(seed)
    low = rng.integers(0, 200, (size // 8, size // 8, 3))
    return np.clip(np.repeat(np.repeat(low, 8, axis=0), 8, axis=1) + shade, 0, 255).astype(np.uint8)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("sources")
    n = 0
    for source, labels in (("First Set", ["Tomato___Late blight", "Tomato___Healthy"]), ("second", ["Corn___Rust", "Tomato___Fresh"])):
        for label in labels:
            for i in range(5):
                n += 1
                f = root / source / label / f"im{i}.png"
                f.parent.mkdir(parents=True, exist_ok=True)
                f.write_bytes(package.png(picture(n)))
    (root / "second" / "Corn___Rust" / "copy.png").write_bytes((root / "second" / "Corn___Rust" / "im0.png").read_bytes())
    (root / "second" / "Corn___Rust" / "flat.png").write_bytes(package.png(np.full((96, 96, 3), 120, np.uint8)))
    (root / "second" / "Corn___Rust" / "junk.png").write_bytes(b"not an image")
    (root / "second" / "Corn___Rust" / "none.png").write_bytes(b"")
    (root / "second" / "stray.png").write_bytes(package.png(picture(99)))
    (root / "_hidden" / "x").mkdir(parents=True)
    return root


@pytest.fixture(scope="module")
def run(spark, raw, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    config = configuration.load(environment={}, overrides={"discovery.root": str(raw), "output.root": str(out), "split.min_samples": 1, "split.drop_small": False, "stages.package": True, "packaging.width": 32, "packaging.height": 32, "quality.blur_min": 1.0})
    return pipeline.run_pipeline(spark, config, "run1"), out, config


def test_run(spark, run, raw):
    done, out, _ = run
    assert [(s.stage, s.status) for s in done.stages] == [(n, "completed") for n in ("ingest", "validate", "quality", "profile", "analyse", "split", "package", "reports")]
    rows = {(r.dataset_name, r.source_relpath): r for r in done.manifest.collect()}
    assert len(rows) == 25 and {d for d, _ in rows} == {"first_set", "second"}
    code = lambda d, p: [x.code for x in rows[(d, p)].rejections]
    assert code("second", "stray.png") == ["label_missing"]
    assert code("second", "Corn___Rust/junk.png") == ["unreadable_file"] and code("second", "Corn___Rust/none.png") == ["empty_file"]
    twins = [rows[("second", f"Corn___Rust/{n}.png")] for n in ("copy", "im0")]
    assert sorted(t.quality_duplicate_status for t in twins) == ["exact_duplicate", "representative"]
    flat = rows[("second", "Corn___Rust/flat.png")]
    assert (flat.action, flat.rejection_reason) == ("reject", "sharpness 0 is under 1")
    assert rows[("second", "Tomato___Fresh/im0.png")].label == "tomato___healthy"
    order = [p for (_, p), r in sorted(rows.items(), key=lambda x: x[1].ordinal) if r.dataset_name == "second"]
    assert order[0] == "stray.png" and order[1:] == sorted(order[1:])
    kept = [r for r in rows.values() if r.status == "accepted"]
    assert kept and all(r.split in ("train", "val", "test") and r.output_path for r in kept) and all([o.name for o in r.operations] == ["ingest", "validate", "gate"] for r in kept)
    assert all(r.first_seen_run_id == "run1" for r in rows.values())
    assert done.version == "1.0.0"


def test_artefacts(spark, run):
    done, out, config = run
    splits = json.loads((out / "metadata/splits.json").read_text())
    kept = {r.image_id for r in done.manifest.filter("status = 'accepted'").collect()}
    assert set().union(*splits.values()) == kept
    print_ = json.loads((out / "metadata/dataset_fingerprint.json").read_text())
    assert print_["version"] == "1.0.0" and print_["reason"] == "initial" and len(print_["sources"]) == 2
    mapping = json.loads((out / "metadata/label_mapping.json").read_text())
    assert mapping["labels"] == {"corn___rust": 0, "tomato___healthy": 1, "tomato___late_blight": 2}
    assert mapping["aliases"]["Tomato___Fresh"] == "tomato___healthy"
    manifest = spark.read.parquet(str(out / "metadata/image_manifest.parquet"))
    assert len(manifest.columns) == 58 and manifest.count() == 25
    assert spark.read.option("header", True).csv(str(out / "metadata/metadata.csv")).columns == manifest.columns
    assert spark.read.option("header", True).csv(str(out / "validation/rejected_images.csv")).count() == 3
    assert spark.read.option("header", True).csv(str(out / "analytics/duplicate_report.csv")).count() == 2
    score = json.loads((out / "analytics/dataset_score.json").read_text())
    assert 0 <= score["score"] <= 1 and len(score["metrics"]) == 23
    assert all((out / f"reports/{n}_report.html").read_text().startswith("<!doctype html>") for n in ("quality", "profiling", "analysis"))
    assert len(list((out / "visualizations").glob("*.svg"))) == 8
    pngs = list((out / "dataset").rglob("*.png"))
    assert len(pngs) == len(kept) and {files.probe(p.read_bytes())["width"] for p in pngs} == {32}
    events = [json.loads(x) for x in (out / "logs/run_run1.jsonl").read_text().splitlines()]
    assert events[0]["event"] == "run" and events[-1]["status"] == "completed"
    record = json.loads((out / "metadata/run.json").read_text())
    assert record["dataset_version"] == "1.0.0" and record["config_hash"] == configuration.fingerprint(config)
    assert list((out / "cache").glob("rgb_*.json"))


def test_second_run(spark, run, raw):
    _, out, config = run
    off = {**config, "stages": {**config["stages"], **dict.fromkeys(("validate", "quality", "profile", "analyse", "split", "package", "reports"), False)}}
    again = pipeline.run_pipeline(spark, off, "run2")
    assert [s.stage for s in again.stages] == ["ingest"] and again.version == "1.0.0"
    assert {r.first_seen_run_id for r in again.manifest.collect()} == {"run1"}
    extra = Path(raw) / "second" / "Corn___Rust" / "new.png"
    extra.write_bytes(package.png(picture(77)))
    try:
        third = pipeline.run_pipeline(spark, off, "run3")
        assert third.version == "1.0.1"
        assert {r.source_relpath for r in third.manifest.filter("first_seen_run_id = 'run3'").collect()} == {"Corn___Rust/new.png"}
    finally:
        extra.unlink()


def test_dataset_and_loaders(spark, run, raw):
    done, _, _ = run
    items = None
    for root in [r[0] for r in done.manifest.select("source_root").distinct().collect()]:
        part = package.dataset(spark, root, done.manifest)
        items = part if items is None else items.unionByName(part)
    rows = items.collect()
    assert len(rows) == done.manifest.filter("split is not null").count() and all(len(r.features) == 3 * 224 * 224 for r in rows)
    held = package.loaders(items, batch_size=4)
    train = list(held["train"])
    assert all(len(b) == 4 for b in train[:-1]) and {r.image_id for b in train for r in b} == {r.image_id for r in rows if r.split == "train"}


@pytest.mark.parametrize("mode", ["copy", "link", "none"])
def test_export_modes(spark, run, tmp_path, mode):
    done, _, _ = run
    root = done.manifest.filter("dataset_name = 'second'").first().source_root
    outcome = package.export(spark, root, done.manifest.filter("dataset_name = 'second'"), str(tmp_path), mode).collect()
    assert outcome and all(r.error is None for r in outcome)
    assert all(Path(r.output_path).exists() == (mode != "none") for r in outcome)
    missing = done.manifest.filter("dataset_name = 'second'").withColumn("source_path", F.lit("/nowhere/x.png"))
    if mode != "none":
        assert all(r.error for r in package.export(spark, root, missing, str(tmp_path), mode).collect())


def test_configuration(spark, tmp_path):
    (tmp_path / "base.json").write_text(json.dumps({"seed": 7, "split": {"ratios": [0.8, 0.1, 0.1]}}))
    (tmp_path / "run.json").write_text(json.dumps({"include": ["base.json"], "split": {"seed": 3}, "corpus": {"aliases": {"x": "y___z"}, "alias_file": str(tmp_path / "aliases.json")}}))
    (tmp_path / "aliases.json").write_text(json.dumps({"x": "lost", "w": "a___b"}))
    c = configuration.load(spark, str(tmp_path / "run.json"), {"quality.blur_min": 5}, {"LUMENSET__SPLIT__MIN_SAMPLES": "2", "OTHER": "1"})
    assert (c["seed"], c["split"]["ratios"], c["split"]["seed"], c["split"]["min_samples"], c["quality"]["blur_min"]) == (7, [0.8, 0.1, 0.1], 3, 2, 5)
    assert configuration.alias_table(spark, c) == {"x": "y___z", "w": "a___b"}
    for bad in ({"nothing": 1}, {"split.ratios": [0.5, 0.1, 0.1]}, {"packaging.mode": "burn"}, {"quality.warn_score": 0.1}):
        with pytest.raises(ValueError):
            configuration.load(overrides=bad, environment={})
    moved = configuration.load(overrides={"output.root": "/elsewhere"}, environment={})
    plain = configuration.load(environment={})
    assert configuration.location_free_fingerprint(moved) == configuration.location_free_fingerprint(plain) and configuration.fingerprint(moved) != configuration.fingerprint(plain)


def test_versions():
    assert [versioning.bump("1.2.3", p) for p in ("major", "minor", "patch")] == ["2.0.0", "1.3.0", "1.2.4"]
    now = {"fingerprint": "f", "labels": "l", "composition": "c"}
    assert versioning.resolve_version(now, None) == ("1.0.0", "initial")
    assert versioning.resolve_version(now, {**now, "version": "1.0.4"}) == ("1.0.4", "unchanged")
    assert versioning.resolve_version(now, {**now, "fingerprint": "g", "labels": "m", "version": "1.0.4"}) == ("1.1.0", "labels_changed")
    assert versioning.resolve_version(now, {**now, "fingerprint": "g", "composition": "d", "version": "1.0.4"}) == ("1.0.5", "composition_changed")


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "a" / "x.json")
    store.write_json(spark, path, {"b": float("nan"), "a": {3, 1}, "c": np.arange(2)})
    assert store.read_json(spark, path) == {"a": [1, 3], "b": None, "c": [0, 1]} and store.read_json(spark, path + "x") is None
    assert store.digest({"a": 1, "b": 2}) == store.digest({"b": 2, "a": 1})
    store.copy(spark, path, str(tmp_path / "b" / "y.json"))
    assert store.link(spark, path, str(tmp_path / "c" / "z.json")) and (tmp_path / "c" / "z.json").read_bytes() == (tmp_path / "b" / "y.json").read_bytes()
    assert artefacts.read_first_seen(spark, str(tmp_path / "none")).count() == 0
    spark.range(3).write.parquet(str(tmp_path / "other"))
    assert artefacts.read_first_seen(spark, str(tmp_path / "other")).count() == 0


def test_channel_statistics(spark, raw):
    got = {r.channel: r for r in rgb.rgb_statistics(spark, str(raw / "First Set"), sample=None).collect()}
    pixels = np.concatenate([picture(n).reshape(-1, 3) for n in range(1, 11)])
    for c in range(3):
        v = pixels[:, c] / 255
        assert got[c].pixels == len(v) and abs(got[c].mean - v.mean()) < 1e-9 and abs(got[c].std - v.std()) < 1e-9
        assert list(got[c].histogram) == np.bincount(pixels[:, c].astype(int) * 64 // 256, minlength=64).tolist()


def test_strategies(spark, raw, tmp_path):
    chosen = {"discovery.root": str(raw), "output.root": str(tmp_path), "corpus.id_strategy": "content", "measures.blur": "tenengrad", "measures.contrast": "michelson", "measures.hash": "dhash", "duplicates.keep": "first", "duplicates.exact_action": "keep"}
    with pytest.raises(ValueError):
        configuration.load(environment={}, overrides=chosen)
    chosen["quality.exact_action"] = chosen.pop("duplicates.exact_action")
    off = {f"stages.{n}": False for n in ("profile", "analyse", "split", "package", "reports")}
    done = pipeline.run_pipeline(spark, configuration.load(environment={}, overrides={**chosen, **off}), "other")
    rows = {(r.dataset_name, r.source_relpath): r for r in done.manifest.collect()}
    twins = [rows[("second", f"Corn___Rust/{n}.png")] for n in ("copy", "im0")]
    assert twins[1].image_id == f"{twins[0].image_id}-1" and twins[0].quality_duplicate_status == "representative" and twins[1].rejection_code is None
    measured = rows[("first_set", "Tomato___Healthy/im0.png")]
    assert measured.quality_blur_score == measured.tenengrad and measured.perceptual_hash == measured.difference_hash and 0 < measured.quality_contrast <= 255


def test_agreement():
    now = {"fingerprint": "f", "composition": "c", "labels": "l", "sources": "s", "config": "x"}
    assert validation.fingerprint_agreement(now, now) == [] and validation.fingerprint_agreement(now, None)[0][0] == "missing"
    assert [k for k, _ in validation.fingerprint_agreement(now, {**now, "labels": "m"})] == ["labels"]
    assert [k for k, _ in validation.manifest_agreement({"run_id": "1", "config_hash": "a", "dataset_version": "1.0.0"}, {"run_id": "1", "config_hash": "b", "dataset_version": "1.0.0"})] == ["config_hash"]


def test_significant_digits(spark):
    values = [0.0, 1.0, 0.35, 123.456, 99995.0, 99994.9, 12345.678, 0.00012346, 0.000012346, -2.5, 9.9996, 1e-5, 80.0, 0.34567891]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(gate.significant(F.col("v"))).collect()]
    assert got == [f"{v:.4g}" for v in values]


def test_worst_status(spark):
    found = spark.createDataFrame([("a.x", 1.0, None, "ok"), ("a.y", 1.0, None, "critical"), ("b.x", 1.0, None, "info")], findings.SCHEMA)
    assert {r.area: (r.metrics, r.status) for r in findings.worst(found).collect()} == {"a": (2, "critical"), "b": (1, "info")}
