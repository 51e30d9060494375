"""Hand-made rows: labels, gate, splits, statistics, duplicates, validation."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lumenset import schema
from lumenset.operators import analysis, duplicates, gate, labels, splitting, statistics, validation
from lumenset.streaming import events


def test_manifest_columns(spark):
    assert len(schema.COLUMNS) == 58 == len(set(schema.COLUMNS))
    df = schema.complete(spark.createDataFrame([("a", "12", "x", "e")], "image_id string, width string, height string, extra string"))
    row = df.first()
    assert df.columns[0] == "image_id" and df.columns[-1] == "extra" and row.width == 12 and row.height is None


@pytest.mark.parametrize(
    ("raw", "canonical", "rule"),
    [
        ("Tomato___Late_Blight", "tomato___late_blight", "delimiter"),
        ("tomato_late_blight", "tomato___late_blight", "crop_vocabulary"),
        ("Late Blight", "late_blight", "condition_only"),
        ("Corn_(maize)___Common_rust_", "corn_maize___common_rust", "delimiter"),
        ("___x", "unknown___x", "delimiter"),
        ("Tomato___", "tomato___unknown", "delimiter"),
        ("Tomato__Fresh", "tomato___healthy", "delimiter"),
        ("Café___Rouille", "cafe___rouille", "delimiter"),
    ],
)
def test_label_ladder(spark, raw, canonical, rule):
    names = ["Tomato___Late_Blight", "tomato_late_blight", "Late Blight", "Corn_(maize)___Common_rust_", "___x", "Tomato___", "Tomato__Fresh", "Café___Rouille"]
    df = labels.resolve(spark.createDataFrame([("s", n, 1) for n in names], "dataset_name string, raw_label string, image_count long"))
    row = df.filter(F.col("raw_label") == raw).first()
    assert (row.canonical, row.rule) == (canonical, rule)


def test_overrides_aliases_and_default_crop(spark):
    rules = labels.LabelRules(aliases={"blight": "Tomato___Blight"}, overrides={"a": {"x": "Corn___Rust"}}, default_crops={"b": "Wheat"})
    rows = [("a", "x", 1), ("b", "x", 1), ("b", "Blight", 1)]
    got = {(r.dataset_name, r.raw_label): (r.canonical, r.rule) for r in labels.resolve(spark.createDataFrame(rows, "dataset_name string, raw_label string, image_count long"), rules).collect()}
    assert got == {("a", "x"): ("corn___rust", "source_override"), ("b", "x"): ("wheat___x", "default_crop"), ("b", "Blight"): ("tomato___blight", "alias")}


@pytest.mark.parametrize(("n", "sizes"), [(1, (1, 0, 0)), (2, (1, 0, 1)), (3, (2, 0, 1)), (4, (3, 1, 0)), (10, (7, 2, 1)), (30, (21, 4, 5))])
def test_split_sizes(spark, n, sizes):
    df = spark.range(n).select(F.concat(F.lit("i"), "id").alias("image_id"), F.lit("c").alias("label"), F.lit("accepted").alias("status"), F.lit(None).cast("string").alias("duplicate_group"))
    got = {r.split: r.images for r in splitting.split_counts(splitting.assign(df)).collect()}
    assert tuple(got.get(s, 0) for s in ("train", "val", "test")) == sizes


def test_groups_stay_together(spark):
    df = spark.range(200).select(F.concat(F.lit("i"), "id").alias("image_id"), F.lit("c").alias("label"), F.lit("accepted").alias("status"), F.concat(F.lit("g"), (F.col("id") % 40).cast("string")).alias("duplicate_group"))
    assert splitting.assign(df).groupBy("unit").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0


def test_gate_order(spark):
    rows = [("a", 50.0, 20.0, "unique"), ("b", 50.0, 100.0, "near_duplicate"), ("c", 400.0, 100.0, "unique"), ("d", 90.0, 100.0, "unique")]
    df = spark.createDataFrame(rows, "image_id string, quality_blur_score double, quality_brightness double, quality_duplicate_status string")
    df = df.withColumns({"quality_contrast": F.lit(70.0), "megapixels": F.lit(0.25), "width": F.lit(500), "height": F.lit(500), "aspect_ratio": F.lit(1.0)})
    got = {r.image_id: (r.action, r.rejection_code, r.failures) for r in gate.decided(gate.scored(df)).collect()}
    assert got["a"] == ("reject", "blurry", ["blurry", "too_dark"])
    assert got["b"] == ("reject", "near_duplicate", ["blurry"])
    assert got["c"] == ("accept", None, [])
    assert got["d"] == ("accept", None, [])


def test_statistics_edges(spark):
    empty = spark.createDataFrame([(None,)], "width double")
    assert statistics.histogram(empty, "width").count() == 0
    one = spark.createDataFrame([(3.0,), (3.0,)], "width double")
    assert [tuple(r) for r in statistics.histogram(one, "width").collect()] == [(0, 3.0, 3.0, 2)]
    assert statistics.numeric_summary(spark.createDataFrame([(0.0,), (None,)], "width double")).first().cv is None
    assert statistics.evenness(spark.createDataFrame([(5,)], "images long")).first().evenness == 1.0
    assert statistics.evenness(spark.createDataFrame([], "images long")).first().gini == 0.0


def test_gini_equals_sorted_formula(spark):
    rnd = random.Random(1)
    values = [rnd.randint(1, 30) for _ in range(50)]
    values_sorted, n, total = sorted(values), len(values), sum(values)
    want = 2 * sum(i * v for i, v in enumerate(values_sorted, 1)) / (n * total) - (n + 1) / n
    assert abs(statistics.evenness(spark.createDataFrame([(v,) for v in values], "images long")).first().gini - want) < 1e-9


def test_banding_finds_all_near_pairs(spark):
    rnd = random.Random(4)
    base = [rnd.getrandbits(64) for _ in range(20)]
    hashes = [b ^ sum(1 << p for p in rnd.sample(range(64), rnd.randint(0, 7))) for b in base for _ in range(8)]
    df = spark.createDataFrame([(i, f"{h:016x}", "c") for i, h in enumerate(hashes)], "ordinal long, perceptual_hash string, label string")
    links = duplicates.near_links(df, 5)
    roots = {r.ordinal: r.root for r in duplicates.clusters(links).collect()}
    parent = list(range(len(hashes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(hashes)), 2):
        if (hashes[a] ^ hashes[b]).bit_count() <= 5:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert roots == {i: find(i) for i in range(len(hashes)) if find(i) != i or any(find(j) == i for j in range(len(hashes)) if j != i)}


def test_chain_is_one_cluster(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r.root for r in duplicates.clusters(links).collect()} == {0}


def test_mean_distance_equals_all_pairs(spark):
    rnd = random.Random(2)
    hashes = [rnd.getrandbits(64) for _ in range(30)]
    df = spark.createDataFrame([(f"{h:016x}",) for h in hashes], "perceptual_hash string")
    want = sum((a ^ b).bit_count() for a, b in itertools.combinations(hashes, 2)) / (30 * 29 / 2)
    assert abs(duplicates.mean_pairwise_distance(df, []).first().mean_distance - want) < 1e-9


def test_golden_imbalance(spark):
    """Sizes whose ratio and long tail are easy to see."""
    counts = spark.createDataFrame([("a", 80), ("b", 15), ("c", 5)], "label string, images long")
    assert analysis.imbalance(counts).first().imbalance_ratio == 16.0
    assert tuple(analysis.long_tail(counts).first()) == (1, 0.2)
    assert analysis.required_per_class() == 7


def test_metadata_issues(spark):
    row = {"image_id": "i", "dataset_name": "d", "dataset_version": "1", "source_root": "/r", "source_path": "/r/c/x.png", "source_relpath": "c/x.png", "source_class": "c", "original_filename": "x.png", "source_modified_at": "2024-01-01T00:00:00", "first_seen_run_id": "r", "first_seen_at": "2024-01-01T00:00:00+00:00", "content_hash": "a" * 64, "pixel_hash": "b" * 40, "perceptual_hash": "c" * 16}
    bad = row | {"image_id": "j", "source_path": "c/y.png", "content_hash": "a" * 63, "source_modified_at": "soon", "source_class": " "}
    df = spark.createDataFrame([row, bad], ", ".join(f"{k} string" for k in row))
    got = {(r.image_id, r.check) for r in validation.metadata_issues(df).collect()}
    assert got == {("j", c) for c in ("provenance", "path_absolute", "filename", "hash:content_hash", "timestamp:source_modified_at")}


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(500).select(F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("ts"), (F.col("id") % 3).cast("string").alias("event_type"), F.col("id").cast("double").alias("value"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = events.windowed(events.read(spark, str(tmp_path / "in"), rows.schema))
    q = stream.writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, events.windowed(rows).collect()))
