"""Queries that write to the shared folder and read back: files of a small collection, and the artefacts of a run."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as configuration
from .. import pipeline
from ..cluster import scratch
from ..functions import scalar
from ..operators import corpus, duplicates, findings, labels, manifest, records, rgb, validation, versioning
from ..reports import figures, html
from ..schema import COLUMNS
from ..sources import artefacts, files, package, store
from . import sql
from .catalogue import KEPT_RULES, _assigned, _k, _m, _mc, _r, _resolved, _sp, _va, _validated, gated, grouped_of, hashes, query, read

# A folder for each region with a file for each nation: a picture of one colour, n + 4 pixels wide and 5 high, red n, green 2 n, blue 255 - n.
_FILES = """fl AS (SELECT n_nationkey AS n, r_name, 'regions' AS dataset_name, CASE WHEN n_nationkey % 5 = 0 THEN 'test/' ELSE '' END || r_name || '___Land/n' || n_nationkey || '.png' AS relpath, CASE WHEN n_nationkey % 5 = 0 THEN 'test' END AS split,
 r_name || '___Land' AS class FROM nation JOIN region ON n_regionkey = r_regionkey)"""
_ID = "substr(sha1(dataset_name || chr(31) || relpath), 1, 16)"


def collection(spark: SparkSession, sf_dir: str) -> str:
    """The collection, written anew; there are 25 files."""
    root = scratch(spark, "collection")
    rows = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name").collect()
    for r in rows:
        n = r["n_nationkey"]
        pixels = np.zeros((5, n + 4, 3), np.uint8) + np.array([n, 2 * n, 255 - n], np.uint8)
        store.write_bytes(spark, f"{root}/Regions/{'test/' if n % 5 == 0 else ''}{r['r_name']}___Land/n{n}.png", package.png(pixels))
    store.write_bytes(spark, f"{root}/_other/X___Y/hidden.png", b"x")
    store.write_bytes(spark, f"{root}/Regions/notes.txt", b"x")
    return root


def _scanned(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    root = collection(spark, sf_dir)
    return root, records.constructed(files.scan_all(spark, files.resolve_sources(spark, [], root, version="2")))


def _manifest(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The collection's accepted manifest, with split and class index."""
    root, rows = _scanned(spark, sf_dir)
    rows = corpus.with_ids(rows, scalar.stable_id(F.col("dataset_name"), F.col("source_relpath")))
    rows = labels.harmonise(rows).withColumn("status", F.lit("accepted")).withColumn("split", F.coalesce("source_split", F.lit("train")))
    known = labels.mapping(rows.select(F.col("label").alias("canonical")).distinct())
    return root, duplicates._checkpoint(labels.with_class_index(rows, known))


@query(f"WITH {_FILES} SELECT row_number() OVER (ORDER BY CASE WHEN split IS NULL THEN '1' || class ELSE '1test' || chr(0) || '1' || class END, 'n' || n || '.png') - 1 AS ordinal, dataset_name, '2' AS dataset_version, relpath AS source_relpath, 'n' || n || '.png' AS original_filename, class AS source_class, split AS source_split, 'pending' AS status, 'png' AS image_format, {_ID} AS image_id, 'ingest' AS operations FROM fl")
def file_scan(spark, sf_dir):  # noqa: ANN001, ANN201
    """Sources found, files listed, records with class, split, order, id and trail."""
    _, rows = _scanned(spark, sf_dir)
    rows = records.flat_operations(corpus.with_ids(rows, scalar.stable_id(F.col("dataset_name"), F.col("source_relpath"))))
    return rows.select("ordinal", "dataset_name", "dataset_version", "source_relpath", "original_filename", "source_class", "source_split", "status", "image_format", "image_id", "operations")


@query(f"WITH {_FILES} SELECT 'n' || n || '.png' AS name, n + 4 AS width, 5 AS height, 'png' AS image_format, 'RGB' AS color_mode, true AS complete, 64 AS hash_digits FROM fl")
def header_probe(spark, sf_dir):  # noqa: ANN001, ANN201
    root = collection(spark, sf_dir)
    rows = files.probe_files(spark, f"{root}/Regions").filter("path like '%.png'")
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("name"), "width", "height", "image_format", "color_mode", "complete", F.length("content_hash").alias("hash_digits"))


@query(f"WITH {_FILES} SELECT 'n' || n || '.png' AS name FROM fl UNION ALL SELECT 'notes.txt'")
def plain_listing(spark, sf_dir):  # noqa: ANN001, ANN201
    root = collection(spark, sf_dir)
    return files.listing(spark, f"{root}/Regions").select(F.element_at(F.split("path", "/"), -1).alias("name"))


_LUMA = "floor(n * 0.299::DOUBLE + 2 * n * 0.587::DOUBLE + (255 - n) * 0.114::DOUBLE + 0.5)"


@query(f"WITH {_FILES} SELECT 'n' || n || '.png' AS name, n + 4 AS width, 5 AS height, 3 AS channels, false AS decode_failed, {_LUMA} AS brightness, 0::DOUBLE AS contrast, 0::DOUBLE AS blur, 40 AS hash_digits, repeat('0', 16) AS difference_hash FROM fl")
def decoded_measures(spark, sf_dir):  # noqa: ANN001, ANN201
    """Files decoded once by the JVM and measured."""
    root = collection(spark, sf_dir)
    rows = files.measure_images(spark, f"{root}/Regions").filter("path like '%.png'")
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("name"), "width", "height", "channels", "decode_failed", F.col("quality_brightness").alias("brightness"), F.col("quality_contrast").alias("contrast"), F.col("quality_blur_score").alias("blur"), F.length("pixel_hash").alias("hash_digits"), "difference_hash")


@query(f"WITH {_FILES}, w AS (SELECT (n + 4) * 5 AS k, unnest([n, 2 * n, 255 - n]) / 255::DOUBLE AS v, unnest([0, 1, 2]) AS channel FROM fl) SELECT channel, sum(k)::BIGINT AS pixels, round(sum(k * v) / sum(k), 6) AS mean, round(sqrt(sum(k * v * v) / sum(k) - pow(sum(k * v) / sum(k), 2)), 6) AS std, 25 AS images, 1 AS failed, true AS cached FROM w GROUP BY channel")
def channel_statistics(spark, sf_dir):  # noqa: ANN001, ANN201
    """The channels' sums over decoded pictures, computed, stored, and read from the store."""
    root, cache = collection(spark, sf_dir), scratch(spark, "cache")
    compute = lambda: rgb.rgb_statistics(spark, f"{root}/Regions", sample=None)
    first = rgb.cached_statistics(spark, cache, {"root": root}, compute)
    again = rgb.cached_statistics(spark, cache, {"root": root}, lambda: spark.range(0).withColumn("channel", F.lit(0)))
    rows = [(r["channel"], r["pixels"], r["mean"], r["std"], r["images"], r["failed"], r == f) for r, f in zip(again, first, strict=True)]
    return spark.createDataFrame(rows, "channel long, pixels long, mean double, std double, images long, failed long, cached boolean")


@query(f"WITH {_FILES} SELECT {_ID} AS image_id, coalesce(split, 'train') AS split, lower(replace(r_name, ' ', '_')) || '___land' AS label, 16 AS width, 12 AS height, true AS written, 25 AS images, 0 AS failed FROM fl")
def image_package(spark, sf_dir):  # noqa: ANN001, ANN201
    """Pictures resized into folders of split and label, probed there, and the summary."""
    root, rows = _manifest(spark, sf_dir)
    target = scratch(spark, "package")
    outcome = duplicates._checkpoint(package.export(spark, f"{root}/Regions", rows, target, "resize", 16, 12))
    package.write_summary(outcome, f"{target}-summary.json")
    total = store.read_json(spark, f"{target}-summary.json")
    probed = files.probe_files(spark, target).select(F.regexp_replace("path", "^[a-z0-9]+:/*", "/").alias("_at"), "width", "height")
    j = outcome.withColumn("_at", F.regexp_replace("output_path", "^[a-z0-9]+:/*", "/")).join(probed, "_at")
    return j.select("image_id", "split", "label", "width", "height", (F.col("bytes") > 0).alias("written"), F.lit(total["images"]).alias("images"), F.lit(total["failed"]).alias("failed"))


@query(f"WITH {_FILES}, ix AS (SELECT r_name, row_number() OVER (ORDER BY lower(replace(r_name, ' ', '_'))) - 1 AS i FROM region) SELECT {_ID} AS image_id, coalesce(split, 'train') AS split, i AS target, 150528 AS features, round((n / 255::DOUBLE - 0.485) / 0.229, 4) AS red, round((2 * n / 255::DOUBLE - 0.456) / 0.224, 4) AS green FROM fl JOIN ix USING (r_name)")
def dataset_items(spark, sf_dir):  # noqa: ANN001, ANN201
    """Training items: transformed pictures and class indices, as the loaders of both splits give them."""
    root, rows = _manifest(spark, sf_dir)
    items = duplicates._checkpoint(package.dataset(spark, f"{root}/Regions", rows))
    got = [(r.image_id, r.split, r.target, len(r.features), round(float(r.features[0]), 4), round(float(r.features[50176]), 4)) for held in package.loaders(items, batch_size=4).values() for batch in held for r in batch]
    return spark.createDataFrame(got, "image_id string, split string, target long, features long, red double, green double")


@query(_m("SELECT image_id, label, width::BIGINT AS width, round(megapixels, 6) AS megapixels, true AS same, 58 AS columns FROM m"))
def manifest_sinks(spark, sf_dir):  # noqa: ANN001, ANN201
    """The manifest written as Parquet and CSV; both are read back and compared."""
    rows = manifest.manifest(spark, sf_dir).drop("text").withColumn("status", F.lit("accepted"))
    layout = artefacts.Layout(scratch(spark, "sinks"))
    frame = duplicates._checkpoint(records.to_frame(rows.select(*[c for c in rows.columns if c in COLUMNS])))
    files.write_manifest(frame, layout.manifest)
    files.write_manifest(frame, layout.manifest_csv, "csv")
    a = spark.read.parquet(layout.manifest)
    b = spark.read.option("header", True).csv(layout.manifest_csv).select(F.col("image_id").alias("_id"), F.col("label").alias("_label"), F.col("width").cast("long").alias("_width"))
    j = a.join(b, F.col("image_id") == F.col("_id"))
    return j.select("image_id", "label", "width", "megapixels", ((F.col("label") == F.col("_label")) & (F.col("width") == F.col("_width"))).alias("same"), F.lit(len(a.columns)).alias("columns"))


@query(_r("SELECT canonical AS label, row_number() OVER (ORDER BY canonical) - 1 AS class_index, sum(image_count)::BIGINT AS images FROM res GROUP BY canonical"))
def label_mapping_sink(spark, sf_dir):  # noqa: ANN001, ANN201
    resolved = _resolved(spark, sf_dir)
    path = artefacts.Layout(scratch(spark, "labels")).labels
    artefacts.write_labels(spark, path, resolved, labels.mapping(resolved), {"run_id": "r"})
    held = store.read_json(spark, path)
    return spark.createDataFrame([(k, v, held["images"][k]) for k, v in held["labels"].items()], "label string, class_index long, images long")


@query(_sp("SELECT split, image_id FROM assigned"))
def splits_sink(spark, sf_dir):  # noqa: ANN001, ANN201
    path = artefacts.Layout(scratch(spark, "splits")).splits
    artefacts.write_splits(_assigned(spark, sf_dir), path)
    return spark.createDataFrame([(s, i) for s, ids in store.read_json(spark, path).items() for i in ids], "split string, image_id string")


@query(sql.over(sql.BASE, "SELECT image_id, CASE WHEN ordinal % 3 = 0 THEN 'run-1' ELSE 'run-2' END AS first_seen_run_id, 0 AS without_index FROM base"))
def first_seen_store(spark, sf_dir):  # noqa: ANN001, ANN201
    """Two runs over the index: the second one keeps what the first has seen. A missing index is an empty one."""
    path = artefacts.Layout(scratch(spark, "seen")).first_seen
    none = artefacts.read_first_seen(spark, path).count()
    items = manifest.base(spark, sf_dir).select("ordinal", "image_id")
    artefacts.write_first_seen(corpus.first_seen(items.filter("ordinal % 3 = 0"), artefacts.read_first_seen(spark, path), "run-1", "a"), path)
    artefacts.write_first_seen(corpus.first_seen(items, artefacts.read_first_seen(spark, path), "run-2", "b"), path)
    return artefacts.read_first_seen(spark, path).select("image_id", "first_seen_run_id", F.lit(none).alias("without_index"))


@query(_va("SELECT status, image_id FROM va"))
def validation_artefacts(spark, sf_dir):  # noqa: ANN001, ANN201
    rows, found = _validated(spark, sf_dir)
    layout = artefacts.Layout(scratch(spark, "validation"))
    artefacts.write_validation(rows.drop("rejection_stage", "rejection_code", "rejection_reason", "rejection_count", "rejected"), layout, validation.validation_report(rows, found))
    part = lambda s: spark.read.option("header", True).csv(layout.at("validation", f"{s}_images.csv")).select(F.lit(s).alias("status"), "image_id")
    return part("accepted").unionByName(part("rejected"))


@query(sql.over(sql.BASE, "SELECT image_id, file_size_bytes * 2 AS file_size_bytes, CASE WHEN ordinal % 2 = 0 THEN 'rejected' ELSE 'pending' END AS status FROM base WHERE ordinal % 2 = 1 UNION ALL SELECT image_id, file_size_bytes, 'rejected' FROM base WHERE ordinal % 2 = 0"))
def stored_observations(spark, sf_dir):  # noqa: ANN001, ANN201
    """Observations reach the rows that weren't rejected."""
    b = manifest.base(spark, sf_dir).select("ordinal", "image_id", F.col("source_relpath").alias("source_path"), "file_size_bytes", F.when(F.col("ordinal") % 2 == 0, "rejected").otherwise("pending").alias("status"))
    seen = b.select("source_path", (F.col("file_size_bytes") * 2).alias("file_size_bytes"))
    return validation.store_observations(b, seen, ["file_size_bytes"]).select("image_id", "file_size_bytes", "status")


@query(_k("SELECT image_id, action, 'metrics' AS part FROM g UNION ALL SELECT h.image_id, grouped.kind, 'duplicates' FROM grouped JOIN h USING (ordinal)"))
def quality_artefacts(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = duplicates._checkpoint(gated(spark, sf_dir, KEPT_RULES))
    items = hashes(spark, sf_dir)
    grouped = grouped_of(items)
    layout = artefacts.Layout(scratch(spark, "quality"))
    artefacts.write_quality(rows, layout, grouped, duplicates.links_to_representative(items, grouped))
    table = lambda name: spark.read.option("header", True).csv(layout.at("analytics", name))
    return table("quality_metrics.csv").select("image_id", "action", F.lit("metrics").alias("part")).unionByName(table("duplicate_report.csv").select("image_id", F.col("role").alias("action"), F.lit("duplicates").alias("part")))


@query(_mc("SELECT label, images, 'class_distribution' AS part FROM cc UNION ALL SELECT 'width', count(*), 'image_statistics' FROM m"))
def profile_artefacts(spark, sf_dir):  # noqa: ANN001, ANN201
    from . import catalogue

    layout = artefacts.Layout(scratch(spark, "profile"))
    artefacts.write_profile(catalogue.scored(spark, sf_dir).drop("text"), layout)
    table = lambda name: spark.read.option("header", True).csv(layout.at("analytics", name))
    a = table("class_distribution.csv").select("label", F.col("images").cast("long").alias("images"), F.lit("class_distribution").alias("part"))
    return a.unionByName(table("image_statistics.csv").filter("name = 'width'").select(F.col("name").alias("label"), F.col("count").cast("long").alias("images"), F.lit("image_statistics").alias("part")))


@query(_k("SELECT (SELECT count(DISTINCT duplicate_group) FROM g WHERE duplicate_group IS NOT NULL) AS clusters, 23 AS metrics, true AS scored, true AS graded"))
def analysis_artefacts(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = duplicates._checkpoint(gated(spark, sf_dir, KEPT_RULES).drop("failures"))
    layout = artefacts.Layout(scratch(spark, "analysis"))
    artefacts.write_analysis(rows, layout, duplicates._checkpoint(findings.findings(rows)))
    held = store.read_json(spark, layout.at("analytics", "dataset_score.json"))
    clusters = spark.read.option("header", True).csv(layout.at("analytics", "leakage_report.csv")).count()
    return spark.createDataFrame([(clusters, len(held["metrics"]), 0 <= held["score"] <= 1, held["grade"] in "ABCDF")], "clusters long, metrics long, scored boolean, graded boolean")


@query(_m("SELECT '1.0.0' AS version, 'initial' AS reason, count(*) AS images, count(DISTINCT dataset_name) AS sources, count(DISTINCT label) AS classes, '1.0.1' AS after_a_removal, '1.1.0' AS after_a_new_label FROM m"))
def fingerprint_store(spark, sf_dir):  # noqa: ANN001, ANN201
    """The fingerprint written, read, and the versions that follow from two changes."""
    rows = duplicates._checkpoint(manifest.manifest(spark, sf_dir).drop("text").withColumn("status", F.lit("accepted")))
    path = artefacts.Layout(scratch(spark, "fingerprint")).fingerprint
    known = labels.mapping(rows.select(F.col("label").alias("canonical")).distinct())
    now = versioning.fingerprint(rows, known, "config")
    version, reason = versioning.resolve_version(now, artefacts.read_fingerprint(spark, path))
    artefacts.write_fingerprint(rows, path, now, version, reason)
    held = artefacts.read_fingerprint(spark, path)
    fewer = versioning.fingerprint(rows.filter("ordinal <> 1"), known, "config")
    more = versioning.fingerprint(rows, known.unionByName(spark.createDataFrame([("zz", 1000)], "label string, class_index long")), "config")
    out = (held["version"], held["reason"], held["counts"]["images"], len(held["sources"]), len(held["classes"]), versioning.resolve_version(fewer, held)[0], versioning.resolve_version(more, held)[0])
    return spark.createDataFrame([out], "version string, reason string, images long, sources long, classes long, after_a_removal string, after_a_new_label string")


@query("SELECT n_name, sha256('{\"key\":' || n_nationkey || ',\"name\":\"' || n_name || '\"}') AS digest, '1.' || (n_nationkey + 1) || '.0' AS minor, '1.' || n_nationkey || '.4' AS patch, '2.0.0' AS major FROM nation")
def version_bump(spark, sf_dir):  # noqa: ANN001, ANN201
    """Canonical hashes of small mappings, and the next versions."""
    rows = []
    for r in read(spark, sf_dir, "nation").select("n_name", "n_nationkey").collect():
        old = f"1.{r['n_nationkey']}.3"
        rows.append((r["n_name"], store.digest({"name": r["n_name"], "key": r["n_nationkey"]}), *(versioning.bump(old, p) for p in ("minor", "patch", "major"))))
    return spark.createDataFrame(rows, "n_name string, digest string, minor string, patch string, major string")


@query("SELECT n_name, 'alias ' || n_name AS label, 'loaded' AS origin FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT n_name, 'inline', 'inline' FROM nation WHERE n_nationkey % 2 = 1")
def alias_file(spark, sf_dir):  # noqa: ANN001, ANN201
    """Aliases of a file, which inline ones override; configuration comes from a file that includes another."""
    root = scratch(spark, "config")
    names = [(r["n_nationkey"], r["n_name"]) for r in read(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()]
    store.write_json(spark, f"{root}/aliases.json", {n: f"alias {n}" for _, n in names})
    store.write_json(spark, f"{root}/base.json", {"corpus": {"alias_file": f"{root}/aliases.json"}})
    store.write_json(spark, f"{root}/run.json", {"include": ["base.json"], "corpus": {"aliases": {n: "inline" for k, n in names if k % 2}}})
    table = configuration.alias_table(spark, configuration.load(spark, f"{root}/run.json", environment={}))
    return spark.createDataFrame([(k, v, "inline" if v == "inline" else "loaded") for k, v in table.items()], "n_name string, label string, origin string")


@query("SELECT n_nationkey AS place, n_name AS name, 'copied' AS how FROM nation WHERE n_nationkey < 5")
def event_log(spark, sf_dir):  # noqa: ANN001, ANN201
    """Lines added to a log one by one, copied, and read as JSON."""
    root = scratch(spark, "log")
    for r in read(spark, sf_dir, "nation").filter("n_nationkey < 5").orderBy("n_nationkey").collect():
        store.append_line(spark, f"{root}/run.jsonl", store.canonical({"place": r["n_nationkey"], "name": r["n_name"]}))
    store.copy(spark, f"{root}/run.jsonl", f"{root}/copy/run.jsonl")
    return spark.read.json(f"{root}/copy/run.jsonl").select("place", "name", F.lit("copied").alias("how"))


@query(_mc("SELECT 'class_distribution' AS figure, label AS name, images::DOUBLE AS value FROM cc UNION ALL SELECT 'source_distribution', dataset_name, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) FROM m GROUP BY dataset_name UNION ALL SELECT 'cumulative_share', label, round(sum(images) OVER (ORDER BY images DESC, label)::DOUBLE / sum(images) OVER (), 6) FROM cc"))
def figure_tables(spark, sf_dir):  # noqa: ANN001, ANN201
    """The data of figures, which are drawn from the same frames."""
    made = figures.tables(manifest.manifest(spark, sf_dir).withColumn("status", F.lit("accepted")))
    out = None
    for name in ("class_distribution", "source_distribution", "cumulative_share"):
        part = made[name]().select(F.lit(name).alias("figure"), "name", "value")
        out = part if out is None else out.unionByName(part)
    return out


@query(_mc("SELECT label, least(images, 5) AS drawn FROM cc"))
def capped_classes(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = corpus.first_per_group(manifest.manifest(spark, sf_dir).select("ordinal", "label"), ["label"], "ordinal", 5)
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("drawn"))



@query("SELECT * FROM (VALUES ('quality', 5, true), ('profile', 7, true), ('analysis', 4, true)) t(page, sections, whole)")
def html_reports(spark, sf_dir):  # noqa: ANN001, ANN201
    """The three pages of a run."""
    rows = duplicates._checkpoint(gated(spark, sf_dir, KEPT_RULES).drop("failures"))
    items = rows.select("ordinal", "image_id", "label", "content_hash", "pixel_hash", "perceptual_hash", "quality_score", "megapixels")
    grouped = grouped_of(items)
    report = duplicates.duplicate_report(duplicates.links_to_representative(items, grouped), grouped)
    pages = {"quality": html.quality_page(rows, report), "profile": html.profile_page(rows, [{"channel": 0, "pixels": 1, "mean": 0.5, "std": 0.1}]), "analysis": html.analysis_page(rows, duplicates._checkpoint(findings.findings(rows)))}
    got = [(name, text.count("<h2>"), text.startswith("<!doctype html>") and text.endswith("</html>") and "<table>" in text) for name, text in pages.items()]
    return spark.createDataFrame(got, "page string, sections long, whole boolean")


@query("SELECT lower(replace(r_name, ' ', '_')) || '___land' AS label, split, CASE split WHEN 'train' THEN 4 ELSE 1 END AS images, '1.0.0' AS version, 8 AS stages FROM region, (VALUES ('train'), ('val')) t(split)")
def batch_pipeline(spark, sf_dir):  # noqa: ANN001, ANN201
    """All stages over the collection of files: pictures of one colour, so that blur, contrast and size have no bounds and near hashes are kept."""
    chosen = {"discovery.root": collection(spark, sf_dir), "output.root": scratch(spark, "run"), "stages.package": True, "packaging.width": 8, "packaging.height": 8, "split.group": False, "split.min_samples": 1}
    none = {f"quality.{k}": None for k in ("blur_min", "contrast_min", "min_width", "min_height")}
    kept = {"quality.brightness_min": 0.0, "quality.brightness_max": 255.0, "quality.max_aspect": 100.0, "quality.min_score": 0.0, "quality.warn_score": 0.0, "quality.near_action": "keep", "profiling.rgb_sample": None}
    done = pipeline.run_pipeline(spark, configuration.load(environment={}, overrides={**chosen, **none, **kept}))
    stages = sum(s.status == "completed" for s in done.stages)
    counts = done.manifest.filter("status = 'accepted'").groupBy("label", "split").agg(F.count("output_path").alias("images"))
    return counts.select("label", "split", "images", F.lit(done.version).alias("version"), F.lit(stages).alias("stages"))
