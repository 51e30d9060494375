"""Label harmonisation: raw folder names to canonical labels, once for each distinct name."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..cluster import ship
from ..functions.scalar import slug


@dataclass(frozen=True)
class LabelRules:
    delimiters: tuple[str, ...] = ("___", "__")
    canonical_format: str = "{crop}___{condition}"
    condition_only_format: str = "{condition}"
    lowercase: bool = True
    normalize: bool = True
    aliases: Mapping[str, str] = field(default_factory=dict)
    overrides: Mapping[str, Mapping[str, str]] = field(default_factory=dict)  # by dataset
    default_crops: Mapping[str, str] = field(default_factory=dict)  # by dataset
    crops: tuple[str, ...] = ()
    infer_crops: bool = True
    healthy_terms: tuple[str, ...] = ("healthy", "normal", "fresh")
    healthy_label: str = "healthy"


@F.pandas_udf(StringType())
def strip_marks(values):  # noqa: ANN001, ANN201
    """ASCII without accents; Spark has no Unicode normaliser."""
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode())


def _plain(text: str, fallback: str = "unknown") -> str:
    import re

    s = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().strip().lower()
    s = re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]+", "_", re.sub(r"[\s\-/\\.]+", "_", s))).strip("_")
    return s or fallback


def _lookup(raw: Column, normal: Column, table: Mapping[str, str]) -> Column:
    if not table:
        return F.lit(None).cast("string")
    known = F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, v)])
    return F.coalesce(F.try_element_at(known, raw), F.try_element_at(known, normal))


def _split(text: Column, rules: LabelRules) -> Column:
    """struct(crop, condition) at the first of the longest delimiter that occurs; null without one."""
    out = None
    for d in sorted(rules.delimiters, key=len, reverse=True):
        at = F.instr(text, d)
        pair = F.struct(slug(F.substring(text, F.lit(1), at - 1)).alias("crop"), slug(F.substring(text, at + len(d), F.length(text))).alias("condition"))
        out = F.when(at > 0, pair) if out is None else out.when(at > 0, pair)
    return out if out is not None else F.lit(None).cast("struct<crop:string,condition:string>")


def distinct_labels(items: DataFrame) -> DataFrame:
    """dataset_name, raw_label and their image_count; empty and null names are left out."""
    named = items.filter(F.col("source_class").isNotNull() & (F.col("source_class") != ""))
    return named.groupBy("dataset_name", F.col("source_class").alias("raw_label")).agg(F.count(F.lit(1)).alias("image_count"))


def ascii_names(names: DataFrame, column: str = "raw_label") -> DataFrame:
    """names with `_ascii`, `column` without accents; only names that have any go through Python."""
    ship(names.sparkSession)
    other = F.col(column).rlike("[^\\x00-\\x7F]")
    plain = names.filter(~other).withColumn("_ascii", F.col(column))
    return plain.unionByName(names.filter(other).withColumn("_ascii", strip_marks(F.col(column))))


def crop_vocabulary(names: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """crop: the distinct crops, given, defaulted, or met in delimited names and alias targets."""
    given = {_plain(c) for c in rules.crops if c} | {_plain(c) for c in rules.default_crops.values()}
    if rules.infer_crops:
        for target in rules.aliases.values():
            for d in sorted(rules.delimiters, key=len, reverse=True):
                if d in target:
                    given.add(_plain(target.partition(d)[0]))
                    break
    spark = names.sparkSession
    out = spark.createDataFrame([(c,) for c in sorted(given)], "crop string")
    if rules.infer_crops:
        out = out.unionByName(ascii_names(names).select(_split(F.col("_ascii"), rules)["crop"].alias("crop")).filter("crop is not null"))
    return out.distinct()


def resolve(names: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """Each (dataset_name, raw_label) with normalized, crop, condition, canonical and rule.

    The ladder: the dataset's overrides, aliases, delimiter, longest known crop, the dataset's default crop,
    condition only. The crop lookup joins each name's prefixes with the vocabulary, so it is an equi-join.
    """
    rows = ascii_names(names).withColumn("normalized", slug(F.col("_ascii")))
    if not rules.normalize:
        return rows.select(*names.columns, "normalized", F.lit(None).cast("string").alias("crop"), F.col("raw_label").alias("condition"), F.col("raw_label").alias("canonical"), F.lit("passthrough").alias("rule"))
    over = F.lit(None).cast("string")
    for dataset, table in rules.overrides.items():
        over = F.when(F.col("dataset_name") == dataset, _lookup(F.col("raw_label"), F.col("normalized"), table)).otherwise(over)
    rows = rows.withColumn("_over", over).withColumn("_alias", _lookup(F.col("raw_label"), F.col("normalized"), rules.aliases))
    rows = rows.withColumn("_text", F.coalesce("_over", "_alias", "_ascii"))
    rows = rows.withColumn("_pair", _split(F.col("_text"), rules)).withColumn("_slug", slug(F.col("_text")))
    cuts = F.filter(F.transform(F.sequence(F.lit(1), F.length("_slug")), lambda i: F.when((F.substring(F.col("_slug"), i, F.lit(1)) == "_") & (i > 1), F.substring(F.col("_slug"), F.lit(1), i - 1))), lambda x: x.isNotNull())
    keyed = rows.withColumn("_id", F.struct("dataset_name", "raw_label"))
    met = keyed.filter("_pair is null").select("_id", F.explode(cuts).alias("crop")).join(crop_vocabulary(names, rules), "crop").groupBy("_id").agg(F.max_by("crop", F.length("crop")).alias("_crop"))
    rows = keyed.join(met, "_id", "left")
    default = F.lit(None).cast("string")
    for dataset, crop in rules.default_crops.items():
        default = F.when(F.col("dataset_name") == dataset, F.lit(_plain(crop))).otherwise(default)
    crop = F.coalesce(F.col("_pair")["crop"], F.col("_crop"), default)
    condition = F.coalesce(F.col("_pair")["condition"], F.when(F.col("_crop").isNotNull(), F.expr("substring(_slug, length(_crop) + 2)")), F.col("_slug"))
    healthy = sorted({_plain(t) for t in rules.healthy_terms})
    condition = F.when(condition.isin(healthy), F.lit(_plain(rules.healthy_label))).otherwise(condition)
    rule = F.when(F.col("_over").isNotNull(), "source_override").when(F.col("_alias").isNotNull(), "alias").when(F.col("_pair").isNotNull(), "delimiter").when(F.col("_crop").isNotNull(), "crop_vocabulary").when(default.isNotNull(), "default_crop").otherwise("condition_only")
    rows = rows.withColumn("crop", crop).withColumn("condition", condition).withColumn("rule", rule)

    def fill(template: str) -> Column:
        out = F.replace(F.replace(F.lit(template), F.lit("{crop}"), F.coalesce("crop", F.lit(""))), F.lit("{condition}"), F.col("condition"))
        return F.lower(out) if rules.lowercase else out

    canonical = F.when(F.col("crop").isNotNull(), fill(rules.canonical_format)).otherwise(fill(rules.condition_only_format))
    return rows.withColumn("canonical", canonical).select(*names.columns, "normalized", "crop", "condition", "canonical", "rule")


def few(df: DataFrame, most: int = 100_000) -> DataFrame:
    """df to be broadcast if it has at most `most` rows, which are then held as a table of the driver; else df, for a shuffle join."""
    rows = df.limit(most + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= most else df


def attach(items: DataFrame, resolved: DataFrame) -> DataFrame:
    """items with label, crop, condition and label_rule; null where there is no class. Names are sent to all tasks if they are counted to be few."""
    right = few(resolved.select(F.col("dataset_name").alias("_dataset"), F.col("raw_label").alias("_raw"), F.col("canonical").alias("label"), "crop", "condition", F.col("rule").alias("label_rule")))
    kept = [c for c in items.columns if c not in ("label", "crop", "condition", "label_rule")]
    return items.select(*kept).join(right, (F.col("dataset_name") == F.col("_dataset")) & (F.col("source_class") == F.col("_raw")), "left").drop("_dataset", "_raw")


def harmonise(items: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """items with label, crop, condition and label_rule; null where there is no class."""
    return attach(items, resolve(distinct_labels(items), rules))


def rule_counts(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("rule").agg(F.count(F.lit(1)).alias("labels"))


def mapping(resolved: DataFrame) -> DataFrame:
    """label and class_index, in the order of the labels."""
    return resolved.select(F.col("canonical").alias("label")).distinct().withColumn("class_index", F.row_number().over(Window.orderBy("label")).cast("long") - 1)


def alias_table(resolved: DataFrame) -> DataFrame:
    """alias and label: raw names, with their dataset in front where datasets disagree."""
    known = resolved.groupBy("raw_label").agg(F.count_distinct("canonical").alias("n"))
    named = resolved.join(known, "raw_label")
    alias = F.when(F.col("n") == 1, F.col("raw_label")).otherwise(F.concat_ws(":", "dataset_name", "raw_label"))
    return named.select(alias.alias("alias"), F.col("canonical").alias("label")).distinct()


def with_class_index(items: DataFrame, labels: DataFrame, most: int = 100_000) -> DataFrame:
    """class_index for items that aren't rejected, null for the others."""
    known = labels.select(F.col("label").alias("_label"), "class_index")
    joined = items.drop("class_index").join(few(known, most), F.col("label") == F.col("_label"), "left").drop("_label")
    return joined.withColumn("class_index", F.when(F.col("status") != "rejected", F.col("class_index"))) if "status" in items.columns else joined
