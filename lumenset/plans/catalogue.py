"""The queries by name, each beside DuckDB SQL for the same rows.

Results have long integers and doubles rounded to six places, on both sides.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import scalar
from ..operators import analysis, corpus, duplicates, findings, gate, labels, manifest, records, rgb, splitting, statistics, validation, versioning
from ..sources import artefacts
from . import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The gate's bounds for items that are texts: their aspect (characters a line) is wide, their height (lines) small.
TEXT_RULES = gate.GateRules(min_width=300, min_height=None, max_aspect=2000.0)
#: The same with duplicates kept (near ones) or warned of (exact ones), so that clusters are retained.
KEPT_RULES = dataclasses.replace(TEXT_RULES, exact_action="warn", near_action="keep")


def plain(df: DataFrame) -> DataFrame:
    kinds = dict(df.dtypes)
    cast = {c: F.col(c).cast("long") if k in ("int", "smallint", "tinyint") or k.startswith("decimal") else F.round(F.col(c).cast("double"), 6) if k in ("double", "float") else F.col(c) for c, k in kinds.items()}
    return df.select(*[v.alias(c) for c, v in cast.items()])


def query(oracle: str):  # noqa: ANN201
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: plain(f(spark, sf_dir))
        ORACLES[f.__name__] = oracle
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.scored(manifest.manifest(spark, sf_dir), TEXT_RULES)


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).withColumn("perceptual_hash", manifest.text_hash(F.col("text")))


def narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hashed without its texts, which are read once: cut, since several operators read it."""
    return duplicates._checkpoint(hashed(spark, sf_dir).drop("text"))


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side of hashed that the duplicate operators need."""
    keep = ["ordinal", "image_id", "label", "content_hash", "pixel_hash", "perceptual_hash", "quality_score", "megapixels"]
    return duplicates._checkpoint(hashed(spark, sf_dir).select(*keep))


def links_of(items: DataFrame) -> DataFrame:
    return duplicates.exact_links(items).unionByName(duplicates.near_links(items).select("a", "b")).distinct()


def grouped_of(items: DataFrame) -> DataFrame:
    roots = duplicates.clusters(links_of(items))
    return duplicates._checkpoint(duplicates.representatives(roots.join(items, "ordinal")))


def gated(spark: SparkSession, sf_dir: str, rules: gate.GateRules = TEXT_RULES) -> DataFrame:
    items = narrow(spark, sf_dir)
    grouped = grouped_of(items.select("ordinal", "image_id", "label", "content_hash", "pixel_hash", "perceptual_hash", "quality_score", "megapixels"))
    links = duplicates.links_to_representative(items, grouped)
    rows = duplicates.duplicate_status(items, grouped, links)
    return gate.decided(rows, rules).withColumn("status", F.when(F.col("action") == "reject", "rejected").otherwise("accepted"))


_m = lambda q: sql.over(sql.MANIFEST, q)
_s = lambda q: sql.over(sql.SCORED, q)
_h = lambda q: sql.over(sql.HASHED, q)
_c = lambda q: sql.over(sql.CLUSTERED, q)
_g = lambda q: sql.over(sql.GATED, q)
_COUNTS = "cc AS (SELECT label, count(*) AS images FROM m WHERE label IS NOT NULL GROUP BY label)"
_mc = lambda q: sql.over(f"{sql.MANIFEST}, {_COUNTS}", q)


@query(_s("SELECT label, count(*) AS images, count(DISTINCT dataset_name) AS sources, round(avg(quality_score), 6) AS mean_quality_score, round(avg(megapixels), 6) AS mean_megapixels, round(avg(quality_blur_score), 6) AS mean_sharpness, round(avg(quality_brightness), 6) AS mean_brightness, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share, row_number() OVER (ORDER BY count(*) DESC, label) AS rank FROM s GROUP BY label"))
def class_distribution(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.class_distribution(scored(spark, sf_dir))


@query(_m("SELECT dataset_name, count(*) AS images, count(DISTINCT label) AS classes, round(avg(megapixels), 6) AS mean_megapixels, round(avg(file_size_bytes), 6) AS mean_file_size_bytes, min(dataset_version) AS version, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM m GROUP BY dataset_name"))
def source_distribution(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.source_distribution(manifest.manifest(spark, sf_dir))


_NUMERIC = ("width", "height", "megapixels", "aspect_ratio", "file_size_bytes", "quality_brightness", "quality_contrast", "quality_blur_score", "quality_score")


@query(_s("SELECT name, count(v) AS count, count(*) - count(v) AS missing, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max, round(abs(stddev_pop(v) / nullif(avg(v), 0)), 6) AS cv, round(quantile_cont(v, 0.05), 6) AS p05, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, round(quantile_cont(v, 0.95), 6) AS p95 FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS name, {c}::DOUBLE AS v FROM s" for c in _NUMERIC) + ") GROUP BY name"))
def numeric_summary(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.numeric_summary(scored(spark, sf_dir).select(*_NUMERIC))


_CATEGORIES = ("label", "dataset_name", "quality_grade", "crop")
_LONG = " UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS v FROM s" for c in _CATEGORIES)


@query(_s(f"SELECT name, count(v) AS count, count(*) - count(v) AS missing, count(DISTINCT v) AS unique, first(top) AS top FROM ({_LONG}) JOIN (SELECT name, v AS top FROM (SELECT name, v, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, v) AS r FROM ({_LONG}) WHERE v IS NOT NULL GROUP BY name, v) WHERE r = 1) USING (name) GROUP BY name"))
def categorical_summary(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.categorical_summary(scored(spark, sf_dir), _CATEGORIES)


@query(_s(f"SELECT name, v AS key, count(*) AS count, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, v) AS rank, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY name), 6) AS share FROM ({_LONG}) WHERE v IS NOT NULL GROUP BY name, v"))
def category_distribution(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.category_distribution(scored(spark, sf_dir), _CATEGORIES)


def _histogram_sql(table: str, column: str, bins: int = 40) -> str:
    return f"""v AS (SELECT {column}::DOUBLE AS v FROM {table} WHERE {column} IS NOT NULL), ends AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
 c AS (SELECT least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1})::BIGINT AS bin, count(*) AS count FROM v, ends GROUP BY 1)
 SELECT b.bin AS bin, round(lo + b.bin * ((hi - lo) / {bins}), 6) AS lo, round(CASE WHEN b.bin = {bins - 1} THEN hi ELSE lo + (b.bin + 1) * ((hi - lo) / {bins}) END, 6) AS hi, coalesce(c.count, 0) AS count FROM (SELECT unnest(range(0, {bins})) AS bin) b CROSS JOIN ends LEFT JOIN c USING (bin)"""


@query(sql.over(sql.MANIFEST, ", " + _histogram_sql("m", "width")).replace(" , v AS", ", v AS"))
def histogram_width(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.histogram(manifest.manifest(spark, sf_dir), "width")


@query("WITH " + _histogram_sql("lineitem", "l_extendedprice"))
def histogram_price(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.histogram(read(spark, sf_dir, "lineitem"), "l_extendedprice")


@query(_m("SELECT width || 'x' || height AS resolution, count(*) AS count FROM m GROUP BY 1 ORDER BY count DESC, resolution LIMIT 25"))
def resolution_distribution(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.resolution_distribution(manifest.manifest(spark, sf_dir))


@query(_m("SELECT count(*) AS images, count(DISTINCT label) AS classes, count(DISTINCT dataset_name) AS sources, sum(file_size_bytes)::BIGINT AS bytes, round(sum(megapixels), 6) AS megapixels FROM m"))
def totals(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.totals(manifest.manifest(spark, sf_dir))


_EVEN = "SELECT count(*) AS groups, sum(n)::BIGINT AS total, round(2 * sum(i * n)::DOUBLE / (count(*) * sum(n)) - (count(*) + 1)::DOUBLE / count(*), 6) AS gini, round(-sum((n / t) * log2(n / t)), 6) AS entropy, round(CASE WHEN count(*) = 1 THEN 1 ELSE -sum((n / t) * log2(n / t)) / log2(count(*)) END, 6) AS evenness FROM (SELECT n::DOUBLE AS n, row_number() OVER (ORDER BY n) AS i, sum(n::DOUBLE) OVER () AS t FROM ({0}))"


@query(_mc(_EVEN.format("SELECT images AS n FROM cc")))
def gini_evenness(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.evenness(analysis.class_counts(manifest.manifest(spark, sf_dir)))


@query(_mc("SELECT count(*) AS classes, sum(images)::BIGINT AS images, max(images) AS largest, min(images) AS smallest, round(max(images)::DOUBLE / min(images), 4) AS imbalance_ratio, count(*) FILTER (images < 0.25 * (SELECT avg(images) FROM cc)) AS rare, count(*) FILTER (images < 20) AS undersized, count(*) FILTER (images < 7) AS infeasible, (SELECT gini FROM (" + _EVEN.format("SELECT images AS n FROM cc") + ")) AS gini, (SELECT evenness FROM (" + _EVEN.format("SELECT images AS n FROM cc") + ")) AS evenness FROM cc"))
def imbalance_metrics(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.imbalance(analysis.class_counts(manifest.manifest(spark, sf_dir)))


@query(_mc("SELECT head AS head_classes, round(sum(CASE WHEN place > head THEN images ELSE 0 END)::DOUBLE / sum(images), 6) AS tail_share FROM (SELECT *, row_number() OVER (ORDER BY images DESC, label) AS place FROM cc), (SELECT least(count(*) FILTER (upto < 0.8) + 1, count(*)) AS head FROM (SELECT sum(images) OVER (ORDER BY images DESC, label)::DOUBLE / sum(images) OVER () AS upto FROM cc)) GROUP BY head"))
def long_tail(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.long_tail(analysis.class_counts(manifest.manifest(spark, sf_dir)))


@query(_mc("SELECT label, images FROM cc WHERE images < 0.25 * (SELECT avg(images) FROM cc)"))
def rare_classes(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.rare_classes(analysis.class_counts(manifest.manifest(spark, sf_dir)))


@query(_mc("SELECT label, images, 7::BIGINT AS required, images >= 7 AS feasible FROM cc"))
def split_feasibility(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.split_feasibility(analysis.class_counts(manifest.manifest(spark, sf_dir)))


_RESOLVED = f"res AS (SELECT dataset_name, source_class AS raw_label, count(*) AS image_count, {sql.slug('source_class')} AS normalized, min(crop) AS crop, min(condition) AS condition, min(label) AS canonical, 'delimiter' AS rule FROM m GROUP BY dataset_name, source_class)"
_r = lambda q: sql.over(f"{sql.MANIFEST}, {_RESOLVED}", q)


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.resolve(labels.distinct_labels(manifest.base(spark, sf_dir)))


@query(_r("SELECT * FROM res"))
def harmonize_labels(spark, sf_dir):  # noqa: ANN001, ANN201
    return _resolved(spark, sf_dir)


@query(_r("SELECT rule, count(*) AS labels FROM res GROUP BY rule"))
def rule_counts(spark, sf_dir):  # noqa: ANN001, ANN201
    return labels.rule_counts(_resolved(spark, sf_dir))


@query(_r("SELECT label, row_number() OVER (ORDER BY label) - 1 AS class_index FROM (SELECT DISTINCT canonical AS label FROM res)"))
def label_mapping(spark, sf_dir):  # noqa: ANN001, ANN201
    return labels.mapping(_resolved(spark, sf_dir))


@query(_r("SELECT DISTINCT CASE WHEN n = 1 THEN raw_label ELSE dataset_name || ':' || raw_label END AS alias, canonical AS label FROM res JOIN (SELECT raw_label, count(DISTINCT canonical) AS n FROM res GROUP BY raw_label) USING (raw_label)"))
def alias_table(spark, sf_dir):  # noqa: ANN001, ANN201
    return labels.alias_table(_resolved(spark, sf_dir))


@query(_r("SELECT DISTINCT crop FROM res"))
def crop_vocabulary(spark, sf_dir):  # noqa: ANN001, ANN201
    return labels.crop_vocabulary(labels.distinct_labels(manifest.base(spark, sf_dir)))


@query(sql.over(sql.BASE, "SELECT ordinal, image_id FROM base"))
def image_ids(spark, sf_dir):  # noqa: ANN001, ANN201
    items = manifest.base(spark, sf_dir)
    return corpus.with_ids(items, scalar.stable_id(F.col("dataset_name"), F.col("ordinal"))).select("ordinal", "image_id")


@query(sql.over(sql.BASE, "SELECT ordinal, b || CASE WHEN k = 0 THEN '' ELSE '-' || k END AS image_id FROM (SELECT ordinal, b, row_number() OVER (PARTITION BY b ORDER BY ordinal) - 1 AS k FROM (SELECT ordinal, substr(sha1(content_hash), 1, 16) AS b FROM base))"))
def id_collisions(spark, sf_dir):  # noqa: ANN001, ANN201
    items = manifest.base(spark, sf_dir).select("ordinal", "content_hash")
    return corpus.with_ids(items, scalar.stable_id(F.col("content_hash"))).select("ordinal", "image_id")


@query(_m("SELECT image_id, label, CASE WHEN x THEN 'rejected' ELSE 'pending' END AS status, CASE WHEN x THEN 'label_excluded' END AS rejection_code FROM (SELECT image_id, label, label NOT IN ('en___healthy', 'en___unrated', 'fr___healthy', 'de___unrated') OR label IN ('fr___healthy') AS x FROM m)"))
def label_filter(spark, sf_dir):  # noqa: ANN001, ANN201
    out = corpus.label_filter(manifest.manifest(spark, sf_dir), ["en___healthy", "en___unrated", "fr___healthy", "de___unrated"], ["fr___healthy"])
    return out.select("image_id", "label", "status", "rejection_code")


@query(_mc("SELECT image_id, label, CASE WHEN images < 20 THEN 'class_below_minimum' END AS rejection_code FROM m JOIN cc USING (label)"))
def min_class_size(spark, sf_dir):  # noqa: ANN001, ANN201
    return corpus.minimum_class_size(manifest.manifest(spark, sf_dir), 20).select("image_id", "label", "rejection_code")


@query(sql.over(sql.BASE, "SELECT ordinal, dataset_name, source_class FROM base QUALIFY row_number() OVER (PARTITION BY dataset_name, source_class ORDER BY ordinal) <= 3"))
def per_class_cap(spark, sf_dir):  # noqa: ANN001, ANN201
    return corpus.first_per_group(manifest.base(spark, sf_dir).select("ordinal", "dataset_name", "source_class"), ["dataset_name", "source_class"], "ordinal", 3)


@query(sql.over(sql.BASE, "SELECT ordinal, dataset_name, source_class FROM base WHERE ordinal <= (SELECT max(ordinal) FROM (SELECT ordinal FROM base WHERE source_class NOT LIKE '%Unrated' ORDER BY ordinal LIMIT 50))"))
def global_cap(spark, sf_dir):  # noqa: ANN001, ANN201
    return corpus.global_cap(manifest.base(spark, sf_dir).select("ordinal", "dataset_name", "source_class"), 50, labelled=~F.col("source_class").endswith("Unrated"))


@query(sql.over(sql.BASE, "SELECT image_id, CASE WHEN doc_id IS NULL THEN 'run-2' ELSE 'run-1' END AS first_seen_run_id, CASE WHEN doc_id IS NULL THEN '2024-02-01T00:00:00' ELSE '2024-01-01T00:00:00' END AS first_seen_at FROM base LEFT JOIN labels ON doc_id = ordinal"))
def first_seen_merge(spark, sf_dir):  # noqa: ANN001, ANN201
    items = manifest.base(spark, sf_dir)
    known = items.join(read(spark, sf_dir, "labels").select(F.col("doc_id").alias("ordinal")), "ordinal", "left_semi")
    index = known.select("image_id", F.lit("run-1").alias("first_seen_run_id"), F.lit("2024-01-01T00:00:00").alias("first_seen_at"))
    return corpus.first_seen(items, index, "run-2", "2024-02-01T00:00:00").select("image_id", "first_seen_run_id", "first_seen_at")


@query(sql.over(sql.BASE, "SELECT dataset_name, count(*) AS images, count(DISTINCT source_class) AS classes, sum(file_size_bytes)::BIGINT AS bytes, array_to_string(list_sort(list(DISTINCT source_class)), ' | ') AS labels FROM base GROUP BY dataset_name"))
def source_summary(spark, sf_dir):  # noqa: ANN001, ANN201
    return corpus.source_summary(manifest.base(spark, sf_dir))


@query(_g("SELECT count(*) AS images, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'rejected') AS rejected, count(DISTINCT label) AS labels, count(DISTINCT dataset_name) AS sources, sum(file_size_bytes)::BIGINT AS bytes FROM g"))
def corpus_summary(spark, sf_dir):  # noqa: ANN001, ANN201
    return corpus.corpus_summary(gated(spark, sf_dir))


@query(_g("SELECT rejection_code, count(*) AS images FROM g WHERE rejection_code IS NOT NULL GROUP BY rejection_code"))
def rejection_counts(spark, sf_dir):  # noqa: ANN001, ANN201
    return corpus.rejection_counts(gated(spark, sf_dir))


_FLAWED = """flawed AS (SELECT image_id, dataset_name, CASE WHEN width < 400 THEN NULL ELSE '1.0' END AS dataset_version, '/raw/' || dataset_name AS source_root,
 CASE WHEN height = 1 THEN 'raw/' || dataset_name || '/' || source_relpath WHEN height = 2 THEN '/other/' || source_relpath ELSE '/raw/' || dataset_name || '/' || source_relpath END AS source_path,
 source_relpath, source_class, CASE WHEN height = 3 THEN 'x.txt' ELSE ordinal || '.txt' END AS original_filename,
 CASE WHEN source_class LIKE 'FR%' THEN 'yesterday' ELSE '2024-01-01T00:00:00' END AS source_modified_at, CASE WHEN source_class LIKE 'ES%' THEN '' ELSE '2024-01-01T00:00:00' END AS first_seen_at, 'run-1' AS first_seen_run_id,
 CASE WHEN height = 4 THEN substr(content_hash, 2) ELSE content_hash END AS content_hash, CASE WHEN height = 5 THEN 'z' || substr(pixel_hash, 2) ELSE pixel_hash END AS pixel_hash,
 CASE WHEN height = 6 THEN NULL ELSE width END AS width, CASE WHEN height = 7 THEN 0 ELSE height END AS height, file_size_bytes FROM base)"""


_META = """SELECT image_id, 'metadata' AS validator, 'metadata_invalid' AS code, "check", 'error' AS severity FROM (SELECT image_id, unnest(list_filter([
 CASE WHEN dataset_version IS NULL THEN 'provenance' END, CASE WHEN first_seen_at = '' THEN 'first_seen' END, CASE WHEN source_modified_at = 'yesterday' THEN 'timestamp:source_modified_at' END,
 CASE WHEN first_seen_at = '' THEN 'timestamp:first_seen_at' END, CASE WHEN source_path NOT LIKE '/%' THEN 'path_absolute' END, CASE WHEN source_path LIKE '/%' AND NOT starts_with(source_path, source_root || '/') THEN 'path_outside_root' END,
 CASE WHEN string_split(source_path, '/')[-1] <> original_filename THEN 'filename' END, CASE WHEN NOT ends_with(source_relpath, original_filename) THEN 'relpath' END,
 CASE WHEN length(content_hash) <> 64 THEN 'hash:content_hash' END, CASE WHEN length(pixel_hash) <> 40 OR NOT regexp_full_match(pixel_hash, '[0-9a-fA-F]+') THEN 'hash:pixel_hash' END,
 CASE WHEN (width IS NULL) <> (height IS NULL) THEN 'dimensions_partial' END, CASE WHEN width <= 0 OR height <= 0 THEN 'dimensions_positive' END], lambda x: x IS NOT NULL)) AS "check" FROM flawed)"""


def _flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest with a flaw of each kind that metadata checks look for."""
    b = manifest.base(spark, sf_dir)
    h = F.col("height")
    path = F.concat(F.lit("/raw/"), "dataset_name", F.lit("/"), "source_relpath")
    return b.select(
        "image_id", "dataset_name", F.when(F.col("width") < 400, None).otherwise("1.0").alias("dataset_version"), F.concat(F.lit("/raw/"), "dataset_name").alias("source_root"),
        F.when(h == 1, F.substr(path, F.lit(2))).when(h == 2, F.concat(F.lit("/other/"), "source_relpath")).otherwise(path).alias("source_path"), "source_relpath", "source_class",
        F.when(h == 3, "x.txt").otherwise(F.concat(F.col("ordinal").cast("string"), F.lit(".txt"))).alias("original_filename"),
        F.when(F.col("source_class").startswith("FR"), "yesterday").otherwise("2024-01-01T00:00:00").alias("source_modified_at"), F.when(F.col("source_class").startswith("ES"), "").otherwise("2024-01-01T00:00:00").alias("first_seen_at"), F.lit("run-1").alias("first_seen_run_id"),
        F.when(h == 4, F.substr("content_hash", F.lit(2))).otherwise(F.col("content_hash")).alias("content_hash"), F.when(h == 5, F.concat(F.lit("z"), F.substr("pixel_hash", F.lit(2)))).otherwise(F.col("pixel_hash")).alias("pixel_hash"),
        F.when(h != 6, F.col("width")).alias("width"), F.when(h == 7, 0).otherwise(h).alias("height"), "file_size_bytes",
    )


@query(sql.over(f"{sql.BASE}, {_FLAWED}", _META))
def metadata_issues(spark, sf_dir):  # noqa: ANN001, ANN201
    return validation.metadata_issues(_flawed(spark, sf_dir))


_FOUND = f"""found AS (SELECT *, CASE WHEN "check" LIKE 'timestamp%' THEN 'warning' ELSE severity END AS level FROM ({_META})),
 va AS (SELECT f.image_id, CASE WHEN count(i."check") FILTER (level = 'error') > 0 THEN 'rejected' ELSE 'accepted' END AS status, count(i."check") FILTER (level = 'error') AS rejection_count,
 min(i."check") FILTER (level = 'error') AS rejection_reason, count(i."check") FILTER (level = 'warning') AS validation_warnings FROM flawed f LEFT JOIN found i USING (image_id) GROUP BY f.image_id)"""
_va = lambda q: sql.over(f"{sql.BASE}, {_FLAWED}, {_FOUND}", q)


def _validated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = duplicates._checkpoint(_flawed(spark, sf_dir))
    found = validation.metadata_issues(rows).withColumn("severity", F.when(F.col("check").startswith("timestamp"), "warning").otherwise(F.col("severity")))
    return validation.validated(rows, found), found


@query(_va("SELECT image_id, status, rejection_count, CASE WHEN rejection_count > 0 THEN 'metadata_invalid' END AS rejection_code, CASE WHEN rejection_count > 0 THEN 'validate' END AS rejection_stage, rejection_reason, status = 'rejected' AS rejected, validation_warnings FROM va"))
def validated_manifest(spark, sf_dir):  # noqa: ANN001, ANN201
    return _validated(spark, sf_dir)[0].select("image_id", "status", "rejection_count", "rejection_code", "rejection_stage", "rejection_reason", "rejected", "validation_warnings")


@query(_va("SELECT 'status' AS kind, status AS name, count(*) AS images FROM va GROUP BY status UNION ALL SELECT 'code', level || ':' || code, count(*) FROM found GROUP BY 2 UNION ALL SELECT 'validator', validator, count(*) FROM found GROUP BY 2"))
def validation_report(spark, sf_dir):  # noqa: ANN001, ANN201
    return validation.validation_report(*_validated(spark, sf_dir))


@query(sql.over(sql.BASE, "SELECT dataset_name, count(*) AS images FROM base WHERE dataset_name <> 'src0' GROUP BY dataset_name"))
def version_mismatches(spark, sf_dir):  # noqa: ANN001, ANN201
    items = manifest.base(spark, sf_dir).select("dataset_name", "dataset_version")
    declared = items.select("dataset_name").distinct().withColumn("dataset_version", F.when(F.col("dataset_name") == "src0", "1.0").otherwise("2.0"))
    return validation.version_mismatches(items, declared)


_LISTED = "listed AS (SELECT source_relpath AS path FROM base WHERE ordinal % 7 <> 3)"


@query(sql.over(f"{sql.BASE}, {_LISTED}", "SELECT image_id, source_relpath AS source_path FROM base WHERE source_relpath NOT IN (SELECT path FROM listed)"))
def missing_files(spark, sf_dir):  # noqa: ANN001, ANN201
    items = manifest.base(spark, sf_dir).select("ordinal", "image_id", F.col("source_relpath").alias("source_path"))
    return validation.missing_files(items, items.filter("ordinal % 7 <> 3").select(F.col("source_path").alias("path"))).select("image_id", "source_path")


@query(sql.over(f"{sql.BASE}, {_LISTED}, ids AS (SELECT *, substr(content_hash, 1, 16) AS id FROM base)", "SELECT 'records' AS \"check\", count(*) AS images FROM base UNION ALL SELECT 'duplicate_id', (SELECT count(*) FROM base) - (SELECT count(DISTINCT id) FROM ids) UNION ALL SELECT 'duplicate_entry', 0 UNION ALL SELECT 'orphan', count(*) FROM base WHERE dataset_name = 'src0' UNION ALL SELECT 'missing_file', count(*) FROM base WHERE ordinal % 7 = 3"))
def integrity_statistics(spark, sf_dir):  # noqa: ANN001, ANN201
    items = manifest.base(spark, sf_dir).select("ordinal", F.substring("content_hash", 1, 16).alias("image_id"), "dataset_name", "source_relpath", F.col("source_relpath").alias("source_path"))
    sources = items.select("dataset_name").distinct().filter("dataset_name <> 'src0'")
    return validation.integrity_statistics(items, sources, items.filter("ordinal % 7 <> 3").select(F.col("source_path").alias("path")))


@query(_r("SELECT label AS subject, CASE WHEN label = 'a b' THEN 'whitespace' ELSE 'forbidden_characters' END AS \"check\" FROM (VALUES ('a b'), ('c/d')) t(label) UNION ALL SELECT '0', 'shared_index' UNION ALL SELECT DISTINCT raw_label, 'unknown_alias' FROM res WHERE canonical LIKE 'fr%'"))
def label_space_issues(spark, sf_dir):  # noqa: ANN001, ANN201
    resolved = _resolved(spark, sf_dir)
    known = labels.mapping(resolved.filter("canonical not like 'fr%'"))
    more = spark.createDataFrame([("a b", 0), ("c/d", 1_000_000)], "label string, class_index long")
    return validation.label_space_issues(known.unionByName(more), labels.alias_table(resolved))


_IMAGES = """im AS (SELECT ordinal AS path_no, CASE ordinal % 11 WHEN 0 THEN 'a/' || ordinal || '.gif' ELSE 'a/' || ordinal || '.JPG' END AS path, CASE ordinal % 13 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE file_size_bytes END AS file_size_bytes,
 CASE ordinal % 17 WHEN 0 THEN NULL WHEN 1 THEN 'webp' WHEN 2 THEN 'png' ELSE 'jpeg' END AS image_format, CASE ordinal % 19 WHEN 0 THEN 1 ELSE width END AS width, CASE ordinal % 23 WHEN 0 THEN 200000000 ELSE height + 1 END AS height,
 CASE ordinal % 29 WHEN 0 THEN 'CMYK' ELSE 'RGB' END AS color_mode, CASE ordinal % 31 WHEN 0 THEN 9 END AS exif_orientation, ordinal % 37 <> 0 AS complete, ordinal % 5 = 0 AS decode_failed, CASE ordinal % 41 WHEN 0 THEN 2 ELSE 3 END AS channels FROM base)"""


@query(sql.over(f"{sql.BASE}, {_IMAGES}", """SELECT path, CASE WHEN path LIKE '%.gif' THEN 'unsupported_format' WHEN file_size_bytes IS NULL THEN 'unreadable_file' WHEN file_size_bytes = 0 THEN 'empty_file' WHEN image_format IS NULL THEN 'unreadable_file'
 WHEN width < 2 OR height < 2 THEN 'invalid_dimensions' WHEN width * height > 178956970 THEN 'oversized_image' WHEN image_format = 'webp' THEN 'unsupported_format' WHEN color_mode = 'CMYK' THEN 'invalid_color_mode'
 WHEN decode_failed THEN CASE WHEN complete THEN 'decode_failed' ELSE 'truncated_image' END WHEN channels = 2 THEN 'unexpected_channels' END AS code,
 array_to_string(list_filter([CASE WHEN exif_orientation = 9 THEN 'exif_orientation' END, CASE WHEN image_format <> CASE WHEN path LIKE '%.gif' THEN 'gif' ELSE 'jpeg' END THEN 'format_mismatch' END], lambda x: x IS NOT NULL), ';') AS warnings,
 CASE color_mode WHEN 'CMYK' THEN 4 ELSE 3 END AS bands FROM im"""))
def image_chain(spark, sf_dir):  # noqa: ANN001, ANN201
    at = lambda n, hit, value, other: F.when(F.col("ordinal") % n == hit, value).otherwise(other)
    b = manifest.base(spark, sf_dir)
    name = F.concat(F.lit("a/"), F.col("ordinal").cast("string"))
    files = b.select(
        at(11, 0, F.concat(name, F.lit(".gif")), F.concat(name, F.lit(".JPG"))).alias("path"), at(13, 0, None, at(13, 1, F.lit(0), F.col("file_size_bytes"))).alias("file_size_bytes"),
        at(17, 0, None, at(17, 1, F.lit("webp"), at(17, 2, F.lit("png"), F.lit("jpeg")))).alias("image_format"), at(19, 0, F.lit(1), F.col("width")).alias("width"), at(23, 0, F.lit(200_000_000), F.col("height") + 1).alias("height"),
        at(29, 0, F.lit("CMYK"), F.lit("RGB")).alias("color_mode"), F.when(F.col("ordinal") % 31 == 0, 9).alias("exif_orientation"), (F.col("ordinal") % 37 != 0).alias("complete"), "ordinal",
    )
    measured = files.select("path", (F.col("ordinal") % 5 == 0).alias("decode_failed"), "height", "width", at(41, 0, F.lit(2), F.lit(3)).alias("channels"))
    out = validation.image_chain(files, measured, modes=("RGB",))
    return out.select("path", "code", F.array_join("warnings", ";").alias("warnings"), validation.bands(F.col("color_mode")).alias("bands"))


@query(_m("SELECT image_id, CASE WHEN x = 'missing' THEN 'label_missing' ELSE 'label_unmapped' END AS code, x AS \"check\" FROM (SELECT image_id, CASE WHEN label LIKE 'fr%' THEN 'missing' WHEN label LIKE 'de%' THEN 'whitespace' WHEN label LIKE 'es%low%' THEN 'unmapped' WHEN label LIKE 'en%unrated' THEN 'class_index' END AS x FROM m) WHERE x IS NOT NULL"))
def label_issues(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = manifest.manifest(spark, sf_dir).select("image_id", "label")
    known = labels.mapping(_resolved(spark, sf_dir)).filter("label not like 'es%low%'")
    marked = rows.join(known, "label", "left").withColumn("class_index", F.when(F.col("label").like("en%unrated"), -1).otherwise(F.col("class_index")))
    marked = marked.withColumn("label", F.when(F.col("label").like("fr%"), None).when(F.col("label").like("de%"), F.concat(F.lit("a "), "label")).otherwise(F.col("label")))
    return validation.label_issues(marked, known)


@query(sql.over(sql.BASE, "SELECT image_id, dataset_name FROM base WHERE dataset_name NOT IN (SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)"))
def integrity_orphans(spark, sf_dir):  # noqa: ANN001, ANN201
    marked = read(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").alias("ordinal"))
    items = manifest.base(spark, sf_dir).select("ordinal", "image_id", "dataset_name")
    return validation.orphans(items, items.join(marked, "ordinal", "left_semi").select("dataset_name").distinct()).select("image_id", "dataset_name")


@query(sql.over(sql.BASE, "SELECT ordinal, content_hash FROM base QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY ordinal) > 1"))
def integrity_duplicates(spark, sf_dir):  # noqa: ANN001, ANN201
    return validation.repeated(manifest.base(spark, sf_dir).select("ordinal", "content_hash"), ["content_hash"])


@query(_r("SELECT DISTINCT raw_label AS alias, canonical AS label FROM res WHERE canonical NOT LIKE 'en%'"))
def alias_unknown(spark, sf_dir):  # noqa: ANN001, ANN201
    resolved = _resolved(spark, sf_dir)
    return validation.unknown_aliases(labels.alias_table(resolved), labels.mapping(resolved.filter("canonical like 'en%'"))).select("alias", "label")


@query(_m("SELECT image_id, unnest(list_filter([CASE WHEN width < 500 THEN 'low_resolution' END, CASE WHEN width > 5000 THEN 'oversized_image' END, CASE WHEN height < 3 THEN 'low_resolution' END, CASE WHEN aspect_ratio < 50 OR aspect_ratio > 500 THEN 'extreme_aspect_ratio' END], lambda x: x IS NOT NULL)) AS code FROM m"))
def geometry_findings(spark, sf_dir):  # noqa: ANN001, ANN201
    rules = gate.GateRules(min_width=500, max_width=5000, min_height=3, min_aspect=50.0, max_aspect=500.0)
    found = F.filter(F.array(*[F.when(cond, F.lit(code)) for code, cond in gate.geometry_findings(rules)]), lambda x: x.isNotNull())
    return manifest.manifest(spark, sf_dir).select("image_id", F.explode(found).alias("code"))


@query(_s("SELECT image_id, round(quality_score, 6) AS quality_score, quality_grade FROM s"))
def quality_score(spark, sf_dir):  # noqa: ANN001, ANN201
    return scored(spark, sf_dir).select("image_id", "quality_score", "quality_grade")


@query(_g("SELECT image_id, action, rejection_code, len(failures) AS failures, quality_duplicate_status FROM g"))
def gate_decision(spark, sf_dir):  # noqa: ANN001, ANN201
    return gated(spark, sf_dir).select("image_id", "action", "rejection_code", F.size("failures").alias("failures"), "quality_duplicate_status")


@query(_g("SELECT count(*) AS images, count(*) FILTER (action = 'accept') AS accepted, count(*) FILTER (action = 'warn') AS warned, count(*) FILTER (action = 'reject') AS rejected, count(*) FILTER (quality_grade = 'A') AS grade_a, count(*) FILTER (quality_grade = 'B') AS grade_b, count(*) FILTER (quality_grade = 'C') AS grade_c, count(*) FILTER (quality_grade = 'D') AS grade_d, count(*) FILTER (quality_grade = 'F') AS grade_f, round(avg(quality_score), 6) AS mean_score, round(list_sort(list(quality_score))[count(*) // 2 + 1], 6) AS median_score FROM g"))
def quality_report(spark, sf_dir):  # noqa: ANN001, ANN201
    return gate.quality_report(gated(spark, sf_dir))


@query("SELECT doc_id, round(-sum((n / t) * log2(n / t)), 6) + 0.0::DOUBLE AS entropy FROM (SELECT doc_id, count(*)::DOUBLE AS n, sum(count(*)) OVER (PARTITION BY doc_id)::DOUBLE AS t FROM (SELECT doc_id, unnest(string_split(text, '')) AS c FROM documents) GROUP BY doc_id, c) GROUP BY doc_id")
def text_entropy(spark, sf_dir):  # noqa: ANN001, ANN201
    manifest.ship(spark)
    return read(spark, sf_dir, "documents").select("doc_id", (manifest.character_entropy(F.col("text")) + 0.0).alias("entropy"))


@query(sql.over(sql.BASE, "SELECT DISTINCT a, b FROM (SELECT min(ordinal) OVER (PARTITION BY content_hash) AS a, ordinal AS b FROM base UNION ALL SELECT min(ordinal) OVER (PARTITION BY pixel_hash), ordinal FROM base) WHERE a <> b"))
def exact_duplicates(spark, sf_dir):  # noqa: ANN001, ANN201
    return duplicates.exact_links(manifest.base(spark, sf_dir).select("ordinal", "content_hash", "pixel_hash"))


@query(_h(f", nodes AS (SELECT min(ordinal) AS ordinal, perceptual_hash, h0, h1 FROM h GROUP BY perceptual_hash, h0, h1) SELECT x.ordinal AS a, y.ordinal AS b, {sql.DISTANCE}::BIGINT AS distance FROM nodes x JOIN nodes y ON x.ordinal < y.ordinal WHERE {sql.DISTANCE} <= 5 UNION ALL SELECT n.ordinal, h.ordinal, 0 FROM h JOIN nodes n USING (perceptual_hash) WHERE h.ordinal <> n.ordinal").replace(" , nodes", ", nodes"))
def near_pairs_hamming(spark, sf_dir):  # noqa: ANN001, ANN201
    return duplicates.near_links(hashes(spark, sf_dir))


@query("WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings), s AS (SELECT vec_id, list_sum(list_transform(range(1, 33), lambda i: bits[i] * (1::BIGINT << (32 - i)::INTEGER)))::BIGINT AS h0, list_sum(list_transform(range(33, 65), lambda i: bits[i] * (1::BIGINT << (64 - i)::INTEGER)))::BIGINT AS h1 FROM v), e AS (SELECT x.vec_id AS a, y.vec_id AS b FROM s x JOIN s y ON x.vec_id <> y.vec_id WHERE bit_count(xor(x.h0, y.h0)) + bit_count(xor(x.h1, y.h1)) <= 16), r(a, b) AS (SELECT a, a FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT a AS ordinal, min(b) AS root FROM r GROUP BY a")
def near_components(spark, sf_dir):  # noqa: ANN001, ANN201
    items = duplicates._checkpoint(duplicates.sign_hash(read(spark, sf_dir, "embeddings")))
    return duplicates.clusters(duplicates.near_links(items, radius=16))


@query(_c("SELECT ordinal, root, image_id, representative, duplicate_group, cluster_size FROM grouped"))
def exact_representatives(spark, sf_dir):  # noqa: ANN001, ANN201
    return grouped_of(hashes(spark, sf_dir)).select("ordinal", "root", "image_id", "representative", "duplicate_group", "cluster_size")


@query(_c("SELECT ordinal, representative, duplicate_group, kind, round(similarity, 6) AS similarity FROM grouped WHERE ordinal <> representative"))
def duplicate_links(spark, sf_dir):  # noqa: ANN001, ANN201
    items = hashes(spark, sf_dir)
    return duplicates.links_to_representative(items, grouped_of(items))


@query(_c("SELECT count(DISTINCT root) AS groups, coalesce(max(cluster_size), 0) AS largest, count(*) FILTER (kind <> 'representative') AS links, count(*) FILTER (kind = 'exact_duplicate') AS exact, count(*) FILTER (kind = 'near_duplicate') AS near FROM grouped"))
def duplicate_report(spark, sf_dir):  # noqa: ANN001, ANN201
    items = hashes(spark, sf_dir)
    grouped = grouped_of(items)
    return duplicates.duplicate_report(duplicates.links_to_representative(items, grouped), grouped)


@query(_c("SELECT size, count(*) AS clusters FROM (SELECT count(*) AS size FROM grouped GROUP BY duplicate_group) GROUP BY size"))
def duplicate_cluster_sizes(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.cluster_sizes(grouped_of(hashes(spark, sf_dir)))


_SIGNS = "WITH v AS (SELECT vec_id AS ordinal, label::VARCHAR AS label, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings), s AS (SELECT ordinal, label, list_sum(list_transform(range(1, 33), lambda i: bits[i] * (1::BIGINT << (32 - i)::INTEGER)))::BIGINT AS h0, list_sum(list_transform(range(33, 65), lambda i: bits[i] * (1::BIGINT << (64 - i)::INTEGER)))::BIGINT AS h1 FROM v), p AS (SELECT x.label AS la, y.label AS lb, bit_count(xor(x.h0, y.h0)) + bit_count(xor(x.h1, y.h1)) AS d FROM s x JOIN s y ON x.ordinal < y.ordinal) "


@query(_SIGNS + "SELECT round(avg(d), 4) AS mean_distance, round(avg(d) / 64, 6) AS normalized FROM p")
def diversity_global(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.diversity_global(duplicates.sign_hash(read(spark, sf_dir, "embeddings")))


@query(_SIGNS + "SELECT la AS label, round(avg(d) / 64, 6) AS diversity FROM p WHERE la = lb GROUP BY la")
def diversity_per_class(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.diversity_per_class(duplicates.sign_hash(read(spark, sf_dir, "embeddings")))


@query(_h("SELECT round(count(DISTINCT perceptual_hash)::DOUBLE / count(perceptual_hash), 6) AS unique_hash_ratio FROM h"))
def unique_hash_ratio(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.unique_hash_ratio(narrow(spark, sf_dir))


@query(_m("SELECT dataset_name, count(*) AS images, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM m GROUP BY dataset_name"))
def source_shares(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.source_shares(manifest.base(spark, sf_dir))


@query(_m("SELECT label, count(*) AS sources, first(dataset_name ORDER BY images DESC, dataset_name) AS top_source, round(max(images)::DOUBLE / sum(images), 6) AS top_share, max(images)::DOUBLE / sum(images) > 0.8 AS dominated, count(*) = 1 AS single_source FROM (SELECT label, dataset_name, count(*) AS images FROM m GROUP BY label, dataset_name) GROUP BY label"))
def class_source_mix(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.class_source_mix(manifest.manifest(spark, sf_dir))


@query(_m("SELECT round(1 - count(*) FILTER (n > 1)::DOUBLE / count(*), 6) AS label_consistency FROM (SELECT source_class, count(DISTINCT label) AS n FROM m GROUP BY source_class)"))
def label_consistency(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.label_consistency(manifest.manifest(spark, sf_dir))


@query(_s("SELECT dataset_name, round(avg(quality_contrast), 6) AS mean FROM s GROUP BY dataset_name"))
def mean_by_source(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.mean_by_source(scored(spark, sf_dir), "quality_contrast")


@query(_s("SELECT round((max(mean) - min(mean)) / max(mean), 6) AS spread FROM (SELECT round(avg(megapixels), 6) AS mean FROM s GROUP BY dataset_name)"))
def spread(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.spread(analysis.mean_by_source(scored(spark, sf_dir), "megapixels"))


_CLUSTERS = """lc AS (SELECT duplicate_group AS group_id, count(*) AS group_size, array_to_string(list_sort(list(DISTINCT label)), ' | ') AS labels, array_to_string(list_sort(list(DISTINCT dataset_name)), ' | ') AS sources,
 array_to_string(list(image_id ORDER BY ordinal)[1:20], ' ') AS image_ids, count(DISTINCT label) AS distinct_labels, count(DISTINCT dataset_name) AS distinct_sources, count(*) FILTER (status = 'accepted') AS retained_images FROM g WHERE duplicate_group IS NOT NULL GROUP BY duplicate_group)"""
_lc = lambda q: sql.over(f"{sql.GATED}, {_CLUSTERS}", q)


@query(_lc("SELECT *, CASE WHEN distinct_labels > 1 THEN 'label_conflict' WHEN retained_images > 1 THEN 'split_leakage' WHEN distinct_sources > 1 THEN 'cross_source_overlap' ELSE 'contained' END AS risk FROM lc"))
def leakage_clusters(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.leakage_clusters(gated(spark, sf_dir))


@query(_lc("SELECT count(*) AS clusters, coalesce(sum(group_size), 0)::BIGINT AS clustered_images, count(*) FILTER (distinct_labels > 1) AS cross_class, count(*) FILTER (distinct_sources > 1) AS cross_source, coalesce(max(group_size), 0) AS largest, coalesce(sum(retained_images) FILTER (retained_images > 1), 0)::BIGINT AS at_risk FROM lc"))
def leakage_summary(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.leakage_summary(analysis.leakage_clusters(gated(spark, sf_dir)))


@query(_c("SELECT round(coalesce(avg(1 - (pow(0.7::DOUBLE, n) + pow(0.15::DOUBLE, n) + pow(0.15::DOUBLE, n))), 0), 6) AS leak_probability FROM (SELECT count(*) AS n FROM grouped GROUP BY duplicate_group)"))
def leak_probability(spark, sf_dir):  # noqa: ANN001, ANN201
    grouped = grouped_of(hashes(spark, sf_dir)).groupBy("duplicate_group").agg(F.count(F.lit(1)).alias("retained_images"))
    return analysis.leak_probability(grouped)


_SCORE = """k AS (SELECT * FROM g WHERE status = 'accepted'), cc AS (SELECT label, count(*) AS images FROM k GROUP BY label),
 gi AS (SELECT gini FROM (""" + _EVEN.format("SELECT images AS n FROM cc") + """)), dv AS (SELECT round(avg(bit_count(xor(x.h0, y.h0)) + bit_count(xor(x.h1, y.h1))) / 64, 6) AS normalized FROM k x JOIN k y ON x.ordinal < y.ordinal),
 q AS (SELECT avg(quality_score) AS mq, abs(stddev_pop(megapixels) / avg(megapixels)) AS cv FROM k), lb AS (SELECT round(1 - count(*) FILTER (n > 1)::DOUBLE / count(*), 6) AS lc FROM (SELECT source_class, count(DISTINCT label) AS n FROM k GROUP BY source_class)),
 sd AS (SELECT evenness AS sd FROM (""" + _EVEN.format("SELECT round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS n FROM k GROUP BY dataset_name") + """)),
 dp AS (SELECT round(count(*) FILTER (quality_duplicate_status = 'exact_duplicate')::DOUBLE / count(*), 6) + round(count(*) FILTER (quality_duplicate_status = 'near_duplicate')::DOUBLE / count(*), 6) AS dup FROM k),
 lp AS (SELECT round(coalesce(avg(1 - (pow(0.7::DOUBLE, n) + pow(0.15::DOUBLE, n) + pow(0.15::DOUBLE, n))), 0), 6) AS leak FROM (SELECT count(*) AS n FROM k WHERE duplicate_group IS NOT NULL GROUP BY duplicate_group HAVING count(*) > 1)),
 c AS (SELECT leak, 1 - gini AS a1, 1 - dup AS a2, least(1, normalized / 0.5::DOUBLE) AS a3, mq AS a4, lc AS a5, greatest(0::DOUBLE, 1 - cv) AS a6, sd AS a7 FROM gi, dv, q, lb, sd, dp, lp),
 t AS (SELECT *, round((a1 * 0.25::DOUBLE + a2 * 0.15::DOUBLE + a3 * 0.15::DOUBLE + a4 * 0.2::DOUBLE + a5 * 0.1::DOUBLE + a6 * 0.05::DOUBLE + a7 * 0.1::DOUBLE) / (0.25::DOUBLE + 0.15::DOUBLE + 0.15::DOUBLE + 0.2::DOUBLE + 0.1::DOUBLE + 0.05::DOUBLE + 0.1::DOUBLE), 6) AS score FROM c)"""


@query(sql.over(f"{sql.KEPT}, {_SCORE}", "SELECT round(a1, 6) AS class_balance, round(a2, 6) AS duplicate_ratio, round(a3, 6) AS diversity, round(a4, 6) AS quality_score, round(a5, 6) AS label_consistency, round(a6, 6) AS resolution_consistency, round(a7, 6) AS source_diversity, round(1 - leak, 6) AS leakage_containment, score, CASE WHEN score >= 0.85 THEN 'A' WHEN score >= 0.70 THEN 'B' WHEN score >= 0.55 THEN 'C' WHEN score >= 0.40 THEN 'D' ELSE 'F' END AS grade FROM t"))
def dataset_score(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = gated(spark, sf_dir, KEPT_RULES).drop("failures")
    return analysis.dataset_score(duplicates._checkpoint(rows))


_SPLIT = """u AS (SELECT label, coalesce(duplicate_group, image_id) AS unit, count(*) AS images FROM sp GROUP BY 1, 2),
 p AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || unit), unit) AS place, count(*) OVER (PARTITION BY label) AS n FROM u),
 z AS (SELECT *, greatest(1, round_even(n * (0.7::DOUBLE / (0.7::DOUBLE + 0.15::DOUBLE + 0.15::DOUBLE)), 0)::BIGINT) AS nt, round_even(n * (0.15::DOUBLE / (0.7::DOUBLE + 0.15::DOUBLE + 0.15::DOUBLE)), 0)::BIGINT AS nv0 FROM p),
 y AS (SELECT *, CASE WHEN nt + nv0 >= n AND n > 2 THEN greatest(1, n - nt - 1) ELSE nv0 END AS nv FROM z),
 assigned AS (SELECT sp.image_id, sp.label, y.unit, CASE WHEN place <= nt THEN 'train' WHEN place <= nt + nv THEN 'val' ELSE 'test' END AS split FROM sp JOIN y ON sp.label = y.label AND coalesce(sp.duplicate_group, sp.image_id) = y.unit)"""
_LEFT = "sp AS (SELECT h.image_id, h.label, grouped.duplicate_group FROM h LEFT JOIN grouped USING (ordinal))"
_sp = lambda q: sql.over(f"{sql.CLUSTERED}, {_LEFT}, {_SPLIT}", q)


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items count as accepted, so that groups of several items are split."""
    items = hashes(spark, sf_dir)
    rows = items.join(grouped_of(items).select("ordinal", "duplicate_group"), "ordinal", "left").withColumn("status", F.lit("accepted"))
    return splitting.assign(rows.select("image_id", "label", "duplicate_group", "status"))


@query(_sp("SELECT * FROM assigned"))
def split_assignment(spark, sf_dir):  # noqa: ANN001, ANN201
    return _assigned(spark, sf_dir)


@query(_sp("SELECT label, split, count(*) AS images, count(DISTINCT unit) AS units FROM assigned GROUP BY label, split"))
def split_counts(spark, sf_dir):  # noqa: ANN001, ANN201
    return splitting.split_counts(_assigned(spark, sf_dir))


@query(_mc("SELECT label, images FROM cc WHERE images < 30"))
def dropped_classes(spark, sf_dir):  # noqa: ANN001, ANN201
    return splitting.dropped_classes(manifest.manifest(spark, sf_dir).withColumn("status", F.lit("accepted")), 30)


@query(_mc("SELECT image_id, label, round(1::DOUBLE / images, 6) AS weight FROM m JOIN cc USING (label)"))
def sampler_weights(spark, sf_dir):  # noqa: ANN001, ANN201
    return splitting.sampler_weights(manifest.manifest(spark, sf_dir))


@query(_m("SELECT sha1(image_id || chr(0) || dataset_name || chr(0) || source_relpath || chr(0) || file_size_bytes || chr(0) || label) AS identity FROM m"))
def composition_identities(spark, sf_dir):  # noqa: ANN001, ANN201
    return corpus.identities(manifest.manifest(spark, sf_dir)).select(F.sha1("identity").alias("identity"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS events, round(sum(value), 6) AS value FROM events GROUP BY 1, 2")
def event_windows(spark, sf_dir):  # noqa: ANN001, ANN201
    from ..streaming import events

    return events.windowed(read(spark, sf_dir, "events"))


@query("SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s")
def event_sessions(spark, sf_dir):  # noqa: ANN001, ANN201
    from ..streaming import events

    return events.sessions(read(spark, sf_dir, "events"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_events(spark, sf_dir):  # noqa: ANN001, ANN201
    from ..streaming import events

    return events.distinct_items(read(spark, sf_dir, "events"), ["user_id", "event_type"]).select("user_id", "event_type")


@query(_g("SELECT quality_grade, action, count(*) AS images FROM g GROUP BY quality_grade, action"))
def grade_counts(spark, sf_dir):  # noqa: ANN001, ANN201
    return gate.grade_counts(gated(spark, sf_dir))


_REASON = """CASE WHEN rejection_code IS NULL THEN NULL WHEN rejection_code = 'blurry' THEN 'sharpness ' || printf('%.4g', quality_blur_score) || ' is under 80' WHEN rejection_code = 'too_dark' THEN 'brightness ' || printf('%.4g', quality_brightness) || ' is under 25'
 WHEN rejection_code = 'too_bright' THEN 'brightness ' || printf('%.4g', quality_brightness) || ' is over 235' WHEN rejection_code = 'low_contrast' THEN 'contrast ' || printf('%.4g', quality_contrast) || ' is under 15'
 WHEN rejection_code = 'low_quality_score' THEN 'score ' || printf('%.4g', quality_score) || ' is under 0.35' WHEN rejection_code = 'extreme_aspect_ratio' THEN 'aspect ratio ' || printf('%.4g', aspect_ratio) || ' is outside [0.25, 2000]'
 WHEN rejection_code = 'low_resolution' THEN 'size ' || width || 'x' || height || ' is out of bounds' ELSE replace(rejection_code, '_', ' ') END"""


@query(_g(f"SELECT image_id, status, rejection_code, {_REASON} AS rejection_reason, 'ingest;gate' AS operations, 2 AS operation_count, CASE WHEN status = 'rejected' THEN 1 ELSE 0 END AS rejection_count FROM g"))
def applied_decisions(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = records.append_operation(gated(spark, sf_dir).drop("status"), records.operation("ingest", "ingest", dataset=F.col("dataset_name")))
    out = records.flat_operations(gate.applied(rows, TEXT_RULES))
    return out.select("image_id", "status", "rejection_code", "rejection_reason", "operations", "operation_count", F.size("rejections").alias("rejection_count"))


@query(_g("SELECT image_id, label, status FROM g WHERE status = 'accepted'"))
def accepted_view(spark, sf_dir):  # noqa: ANN001, ANN201
    return records.profile_scope(gated(spark, sf_dir)).select("image_id", "label", "status")


@query(_sp("SELECT image_id, label FROM assigned WHERE split = 'val'"))
def in_split(spark, sf_dir):  # noqa: ANN001, ANN201
    return records.in_split(_assigned(spark, sf_dir).withColumn("status", F.lit("accepted")), "val").select("image_id", "label")


@query(_m("SELECT image_id, ordinal, label FROM m WHERE ordinal = 17"))
def point_lookup(spark, sf_dir):  # noqa: ANN001, ANN201
    return records.lookup(manifest.manifest(spark, sf_dir), 17, "ordinal").select("image_id", "ordinal", "label")


@query(_m("SELECT image_id, dataset_name, label, width::BIGINT AS width, round(megapixels, 6) AS megapixels, NULL::VARCHAR AS split, true AS no_channels, 58::BIGINT AS columns FROM m"))
def typed_manifest(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = manifest.manifest(spark, sf_dir).withColumn("width", F.col("width").cast("string")).withColumn("channels", F.lit("three")).withColumn("status", F.lit("accepted"))
    frame = records.to_frame(rows.select(*[c for c in rows.columns if c in schema.COLUMNS]), accepted_only=True)
    return frame.select("image_id", "dataset_name", "label", "width", "megapixels", "split", F.col("channels").isNull().alias("no_channels"), F.lit(len(frame.columns)).alias("columns"))


@query(_m("SELECT image_id, '{\"image_id\":\"' || image_id || '\",\"dataset_name\":\"' || dataset_name || '\",\"label\":\"' || label || '\",\"width\":' || width || '}' AS document FROM m"))
def trace_documents(spark, sf_dir):  # noqa: ANN001, ANN201
    return schema.trace(manifest.manifest(spark, sf_dir).select("width", "label", "image_id", "dataset_name"))


@query(_s("SELECT label AS key, 'label' AS name, count(*) AS images FROM s GROUP BY label UNION ALL SELECT dataset_name, 'dataset_name', count(*) FROM s GROUP BY dataset_name"))
def counts_by(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = manifest.manifest(spark, sf_dir)
    part = lambda c: statistics.counts_by(rows, c).select(F.col(c).alias("key"), F.lit(c).alias("name"), "images")
    return part("label").unionByName(part("dataset_name"))


@query(_s(f"SELECT name, count(*) AS \"unique\", array_to_string(list(v || '=' || n ORDER BY n DESC, v)[1:3], ' | ') AS top FROM (SELECT name, v, count(*) AS n FROM ({_LONG}) WHERE v IS NOT NULL GROUP BY name, v) GROUP BY name"))
def most_common(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.most_common(scored(spark, sf_dir), _CATEGORIES, 3)


_FIELDS = ("width", "quality_score", "megapixels")


@query(sql.over(sql.SCORED + ", " + ", ".join(f"q{i} AS (WITH " + _histogram_sql("s", c) + ")" for i, c in enumerate(_FIELDS)), " UNION ALL ".join(f"SELECT '{c}' AS name, * FROM q{i}" for i, c in enumerate(_FIELDS))))
def histograms(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.histograms(scored(spark, sf_dir), _FIELDS)


@query(_mc("SELECT row_number() OVER (ORDER BY images DESC, label) AS place, label, images, round(sum(images) OVER (ORDER BY images DESC, label)::DOUBLE / sum(images) OVER (), 6) AS cumulative_share FROM cc"))
def cumulative_shares(spark, sf_dir):  # noqa: ANN001, ANN201
    return statistics.cumulative_shares(analysis.class_counts(manifest.manifest(spark, sf_dir)))


@query(_c("SELECT duplicate_group AS group_id, image_id, kind AS role, round(similarity, 6) AS similarity, cluster_size, label FROM grouped"))
def duplicate_members(spark, sf_dir):  # noqa: ANN001, ANN201
    items = hashes(spark, sf_dir)
    grouped = grouped_of(items)
    return artefacts.duplicate_members(items, grouped, duplicates.links_to_representative(items, grouped))


_k = lambda q: sql.over(f"{sql.KEPT}, k AS (SELECT * FROM g WHERE status = 'accepted')", q)


@query(_k("SELECT round(count(*) FILTER (quality_duplicate_status = 'exact_duplicate')::DOUBLE / count(*), 6) AS duplicate_ratio, round(count(*) FILTER (quality_duplicate_status = 'near_duplicate')::DOUBLE / count(*), 6) AS near_duplicate_ratio FROM k"))
def duplicate_ratios(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.duplicate_ratios(records.profile_scope(gated(spark, sf_dir, KEPT_RULES)))


@query(_k("SELECT image_id, action, rejection_code, status FROM g"))
def kept_duplicates(spark, sf_dir):  # noqa: ANN001, ANN201
    return gated(spark, sf_dir, KEPT_RULES).select("image_id", "action", "rejection_code", "status")


@query(_SIGNS + "SELECT la AS label, round(avg(d) / 64, 6) AS diversity FROM p WHERE la = lb GROUP BY la ORDER BY diversity, label LIMIT 3")
def least_diverse(spark, sf_dir):  # noqa: ANN001, ANN201
    return analysis.least_diverse(duplicates.sign_hash(read(spark, sf_dir, "embeddings")), 3)


_DIGEST = "d AS (SELECT sha256(image_id || chr(0) || dataset_name || chr(0) || source_relpath || chr(0) || file_size_bytes || chr(0) || label) AS h FROM m)"


@query(sql.over(f"{sql.MANIFEST}, {_DIGEST}", "SELECT substr(h, 1, 2) AS bucket, count(*) AS items, sum(('0x' || substr(h, 3, 8))::BIGINT)::BIGINT AS digest FROM d GROUP BY 1"))
def composition_buckets(spark, sf_dir):  # noqa: ANN001, ANN201
    return versioning.composition_buckets(manifest.manifest(spark, sf_dir))


@query("WITH b AS (SELECT ('0x' || unnest(regexp_extract_all(hex(encode(text)), '..')))::BIGINT AS v FROM documents), t AS (SELECT count(*) AS bytes, round(avg(v / 255::DOUBLE), 6) AS mean, round(stddev_pop(v / 255::DOUBLE), 6) AS std FROM b) SELECT v * 64 // 256 AS bin, count(*) AS count, first(bytes) AS bytes, first(mean) AS mean, first(std) AS std FROM b, t GROUP BY 1")
def rgb_statistics(spark, sf_dir):  # noqa: ANN001, ANN201
    """The channel sums over the bytes of texts, which stand in for one channel's pixels."""
    counted = rgb.byte_statistics(read(spark, sf_dir, "documents"), "text")
    return counted.filter("count > 0")


@query(_s("SELECT image_id, round(least(1, abs(quality_blur_score - 300) / 300::DOUBLE), 6) AS confidence, quality_blur_score >= 300 AS sharp, CASE WHEN quality_blur_score >= 300 THEN 'ok' WHEN quality_blur_score >= 200 THEN 'warning' ELSE 'critical' END AS status FROM s"))
def blur_results(spark, sf_dir):  # noqa: ANN001, ANN201
    score = F.col("quality_blur_score")
    return scored(spark, sf_dir).select("image_id", scalar.blur_confidence(score, 300.0).alias("confidence"), (score >= 300).alias("sharp"), scalar.status(score >= 300, score >= 200).alias("status"))


@query("SELECT o_orderkey, printf('%016x', o_orderkey) AS word, printf('%08x', o_orderkey) AS short FROM orders")
def hex_words(spark, sf_dir):  # noqa: ANN001, ANN201
    key = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", scalar.to_hex(key).alias("word"), scalar.to_hex(key, 8).alias("short"))


@query(_r("SELECT label, coalesce(class_index, -1) AS class_index, image_id FROM (SELECT canonical AS label, row_number() OVER (ORDER BY canonical) - 1 AS class_index FROM (SELECT DISTINCT canonical FROM res WHERE canonical NOT LIKE 'fr%')) RIGHT JOIN m USING (label)"))
def class_indices(spark, sf_dir):  # noqa: ANN001, ANN201
    known = labels.mapping(_resolved(spark, sf_dir).filter("canonical not like 'fr%'"))
    return labels.with_class_index(manifest.manifest(spark, sf_dir), known).select("label", F.coalesce("class_index", F.lit(-1)).alias("class_index"), "image_id")


@query("SELECT s.source AS dataset_name, lower(d.lang) || '_deep_' || k AS raw_label, count(*) AS image_count, CASE WHEN s.source = 'src0' AND k = 1 THEN 'corn' WHEN d.lang = 'en' AND k = 0 THEN 'en_deep' WHEN d.lang IN ('en', 'de') THEN d.lang END AS crop, CASE WHEN s.source = 'src0' AND k = 1 THEN 'corn___rust' WHEN d.lang = 'en' AND k = 0 THEN 'en_deep___0' WHEN d.lang IN ('en', 'de') THEN d.lang || '___deep_' || k ELSE d.lang || '_deep_' || k END AS canonical, CASE WHEN s.source = 'src0' AND k = 1 THEN 'source_override' WHEN d.lang = 'en' AND k = 0 THEN 'alias' WHEN d.lang IN ('en', 'de') THEN 'crop_vocabulary' ELSE 'condition_only' END AS rule FROM documents d JOIN (SELECT doc_id, source, doc_id % 2 AS k FROM documents) s USING (doc_id) GROUP BY s.source, d.lang, k")
def label_ladder(spark, sf_dir):  # noqa: ANN001, ANN201
    """Overrides, aliases, the longest known prefix and the plain condition, on names without a delimiter."""
    d = read(spark, sf_dir, "documents")
    items = d.select(F.col("source").alias("dataset_name"), F.concat(F.lower("lang"), F.lit("_deep_"), (F.col("doc_id") % 2).cast("string")).alias("source_class"))
    rules = labels.LabelRules(crops=("en", "de"), aliases={"en_deep_0": "en_deep___0"}, overrides={"src0": {f"{x}_deep_1": "Corn___Rust" for x in ("en", "de", "fr", "es")}}, infer_crops=False)
    return labels.resolve(labels.distinct_labels(items), rules).select("dataset_name", "raw_label", "image_count", "crop", "canonical", "rule")


_FINDINGS = f"""cc AS (SELECT label, count(*) AS images FROM k GROUP BY label), ev AS ({_EVEN.format("SELECT images AS n FROM cc")}),
 im AS (SELECT round(max(images)::DOUBLE / min(images), 4) AS ratio, count(*) AS classes, count(*) FILTER (images < 0.25 * (SELECT avg(images) FROM cc)) AS rare, count(*) FILTER (images < 20) AS small, count(*) FILTER (images < 7) AS bad FROM cc),
 hd AS (SELECT least(count(*) FILTER (upto < 0.8) + 1, count(*)) AS head FROM (SELECT sum(images) OVER (ORDER BY images DESC, label)::DOUBLE / sum(images) OVER () AS upto FROM cc)),
 mx AS (SELECT label, max(images)::DOUBLE / sum(images) > 0.8 AS dominated, count(*) = 1 AS alone FROM (SELECT label, dataset_name, count(*) AS images FROM k GROUP BY label, dataset_name) GROUP BY label),
 sd AS ({_EVEN.format("SELECT round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS n FROM k GROUP BY dataset_name")}),
 lb AS (SELECT round(1 - count(*) FILTER (n > 1)::DOUBLE / count(*), 6) AS lc FROM (SELECT source_class, count(DISTINCT label) AS n FROM k GROUP BY source_class)),
 sp AS (SELECT round((max(a) - min(a)) / max(a), 6) AS size, round((max(b) - min(b)) / max(b), 6) AS score FROM (SELECT round(avg(megapixels), 6) AS a, round(avg(quality_score), 6) AS b FROM k GROUP BY dataset_name)),
 lc2 AS (SELECT count(*) AS images, count(DISTINCT label) AS labels, count(DISTINCT dataset_name) AS sources, count(*) FILTER (status = 'accepted') AS kept FROM g WHERE duplicate_group IS NOT NULL GROUP BY duplicate_group),
 lk AS (SELECT count(*) AS clusters, coalesce(sum(kept) FILTER (kept > 1), 0) AS risk, round(coalesce(avg(1 - (pow(0.7::DOUBLE, kept) + pow(0.15::DOUBLE, kept) + pow(0.15::DOUBLE, kept))) FILTER (kept > 1), 0), 6) AS leak, count(*) FILTER (labels > 1) AS cross_class, count(*) FILTER (sources > 1) AS cross_source FROM lc2),
 f AS (SELECT 'imbalance.ratio' AS key, ratio::DOUBLE AS value_num, CASE WHEN ratio <= 10 THEN 'ok' WHEN ratio <= 20 THEN 'warning' ELSE 'critical' END AS status FROM im
 UNION ALL SELECT 'imbalance.gini', gini, CASE WHEN gini <= 0.5 THEN 'ok' WHEN gini <= 0.7 THEN 'warning' ELSE 'critical' END FROM ev UNION ALL SELECT 'imbalance.evenness', evenness, CASE WHEN evenness >= 0.8 THEN 'ok' WHEN evenness >= 0.6 THEN 'warning' ELSE 'critical' END FROM ev
 UNION ALL SELECT 'imbalance.rare_classes', rare, CASE WHEN rare = 0 THEN 'ok' WHEN rare <= 0.1 * classes THEN 'warning' ELSE 'critical' END FROM im UNION ALL SELECT 'imbalance.undersized_classes', small, CASE WHEN small = 0 THEN 'ok' WHEN small <= 3 THEN 'warning' ELSE 'critical' END FROM im
 UNION ALL SELECT 'imbalance.long_tail', head, 'info' FROM hd UNION ALL SELECT 'imbalance.split_feasibility', bad, CASE WHEN bad = 0 THEN 'ok' ELSE 'critical' END FROM im
 UNION ALL SELECT 'bias.source_diversity', evenness, CASE WHEN evenness >= 0.6 THEN 'ok' WHEN evenness >= 0.35 THEN 'warning' ELSE 'critical' END FROM sd
 UNION ALL SELECT 'bias.dominated_classes', count(*) FILTER (dominated), CASE WHEN count(*) FILTER (dominated) = 0 THEN 'ok' WHEN count(*) FILTER (dominated) <= 0.5 * count(*) THEN 'warning' ELSE 'critical' END FROM mx UNION ALL SELECT 'bias.single_source_classes', count(*) FILTER (alone), 'info' FROM mx
 UNION ALL SELECT 'bias.label_consistency', lc, CASE WHEN lc >= 1 THEN 'ok' WHEN lc >= 0.95 THEN 'warning' ELSE 'critical' END FROM lb
 UNION ALL SELECT 'bias.resolution_consistency', size, CASE WHEN size <= 0.5 THEN 'ok' WHEN size <= 0.8 THEN 'warning' ELSE 'critical' END FROM sp UNION ALL SELECT 'bias.quality_consistency', score, CASE WHEN score <= 0.3 THEN 'ok' WHEN score <= 0.5 THEN 'warning' ELSE 'critical' END FROM sp
 UNION ALL SELECT 'leakage.clusters', clusters, 'info' FROM lk UNION ALL SELECT 'leakage.at_risk_images', risk, CASE WHEN risk = 0 THEN 'ok' ELSE 'critical' END FROM lk UNION ALL SELECT 'leakage.random_split_probability', leak, CASE WHEN leak = 0 THEN 'ok' ELSE 'critical' END FROM lk
 UNION ALL SELECT 'leakage.cross_class_clusters', cross_class, CASE WHEN cross_class = 0 THEN 'ok' WHEN cross_class <= greatest(1, clusters // 20) THEN 'warning' ELSE 'critical' END FROM lk UNION ALL SELECT 'leakage.cross_source_clusters', cross_source, 'info' FROM lk)"""


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings but those on hashes, on a manifest with retained duplicates."""
    rows = duplicates._checkpoint(gated(spark, sf_dir, KEPT_RULES).drop("failures"))
    rules = findings.Rules(grouped_split=False)
    kept = records.profile_scope(rows)
    return findings.imbalance_findings(kept, rules).unionByName(findings.bias_findings(kept, rules)).unionByName(findings.leakage_findings(analysis.leakage_clusters(rows), rules))


@query(_k("SELECT key, round(value_num, 6) AS value_num, status FROM f").replace("AS (SELECT * FROM g WHERE status = 'accepted') SELECT key", f"AS (SELECT * FROM g WHERE status = 'accepted'), {_FINDINGS} SELECT key"))
def analysis_findings(spark, sf_dir):  # noqa: ANN001, ANN201
    return _findings(spark, sf_dir).select("key", "value_num", "status")


@query(_k("SELECT split_part(key, '.', 1) AS area, count(*) AS metrics, max_by(status, CASE status WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 WHEN 'ok' THEN 1 ELSE 0 END) AS status FROM f GROUP BY 1").replace("AS (SELECT * FROM g WHERE status = 'accepted') SELECT split_part", f"AS (SELECT * FROM g WHERE status = 'accepted'), {_FINDINGS} SELECT split_part"))
def worst_status(spark, sf_dir):  # noqa: ANN001, ANN201
    return findings.worst(_findings(spark, sf_dir))


_DIVERSITY = """dv AS (SELECT round(avg(bit_count(xor(x.h0, y.h0)) + bit_count(xor(x.h1, y.h1))) / 64, 6) AS normalized FROM k x JOIN k y ON x.ordinal < y.ordinal), un AS (SELECT round(count(DISTINCT perceptual_hash)::DOUBLE / count(*), 6) AS u,
 round(count(*) FILTER (quality_duplicate_status = 'exact_duplicate')::DOUBLE / count(*), 6) AS e, round(count(*) FILTER (quality_duplicate_status = 'near_duplicate')::DOUBLE / count(*), 6) AS r FROM k),
 pc AS (SELECT x.label, round(avg(bit_count(xor(x.h0, y.h0)) + bit_count(xor(x.h1, y.h1))) / 64, 6) AS d FROM k x JOIN k y ON x.ordinal < y.ordinal AND x.label = y.label GROUP BY x.label)"""


@query(_k("SELECT 'diversity.normalized' AS key, normalized AS value_num, CASE WHEN normalized >= 0.25 THEN 'ok' WHEN normalized >= 0.15 THEN 'warning' ELSE 'critical' END AS status, NULL AS value_str FROM dv UNION ALL SELECT 'diversity.unique_hashes', u, CASE WHEN u >= 0.95 THEN 'ok' WHEN u >= 0.85 THEN 'warning' ELSE 'critical' END, NULL FROM un UNION ALL SELECT 'diversity.duplicate_ratio', e, CASE WHEN e <= 0.02 THEN 'ok' WHEN e <= 0.1 THEN 'warning' ELSE 'critical' END, NULL FROM un UNION ALL SELECT 'diversity.near_duplicate_ratio', r, CASE WHEN r <= 0.05 THEN 'ok' WHEN r <= 0.15 THEN 'warning' ELSE 'critical' END, NULL FROM un UNION ALL (SELECT 'diversity.least_diverse_classes', d, 'info', label FROM pc ORDER BY d, label LIMIT 1)").replace("AS (SELECT * FROM g WHERE status = 'accepted') SELECT 'div", f"AS (SELECT * FROM g WHERE status = 'accepted'), {_DIVERSITY} SELECT 'div"))
def diversity_findings(spark, sf_dir):  # noqa: ANN001, ANN201
    rows = duplicates._checkpoint(records.profile_scope(gated(spark, sf_dir, KEPT_RULES)).drop("failures"))
    return findings.diversity_findings(rows)
