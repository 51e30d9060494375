"""The manifest: one wide row per item, and the vocabularies of its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONGS = ("class_index", "rejection_count", "width", "height", "channels", "file_size_bytes", "exif_orientation", "quality_width", "quality_height", "operation_count", "source_size_bytes")
DOUBLES = ("aspect_ratio", "megapixels", "quality_score", "quality_blur_score", "quality_sharpness", "quality_brightness", "quality_contrast", "quality_colorfulness", "quality_entropy", "quality_megapixels", "quality_aspect_ratio", "quality_perceptual_similarity")
BOOLEANS = ("rejected",)

# The manifest's column names in their order.
COLUMNS = [
    "image_id", "dataset_name", "dataset_version", "source_relpath", "source_class", "source_split", "original_filename", "label",
    "class_index", "crop", "condition", "label_rule", "status", "split", "rejected", "rejection_stage", "rejection_code",
    "rejection_reason", "rejection_count", "width", "height", "channels", "aspect_ratio", "megapixels", "image_format", "color_mode",
    "file_size_bytes", "exif_orientation", "content_hash", "pixel_hash", "perceptual_hash", "duplicate_of", "duplicate_group",
    "quality_score", "quality_grade", "quality_blur_score", "quality_sharpness", "quality_brightness", "quality_contrast",
    "quality_colorfulness", "quality_entropy", "quality_width", "quality_height", "quality_megapixels", "quality_aspect_ratio",
    "quality_duplicate_status", "quality_perceptual_similarity", "operations", "operation_count", "output_path", "first_seen_run_id",
    "first_seen_at", "source_size_bytes", "source_modified_at", "source_root", "source_path", "source_attributes_json", "metadata_json",
]


def column_type(name: str) -> str:
    return "long" if name in LONGS else "double" if name in DOUBLES else "boolean" if name in BOOLEANS else "string"


def ordered(columns: list[str]) -> list[str]:
    """Known columns first, in the manifest's order, then the others by name."""
    return [c for c in COLUMNS if c in columns] + sorted(c for c in columns if c not in COLUMNS)


def typed(df: DataFrame) -> DataFrame:
    """df with known columns in order and of their types; what can't be cast is null, unknown columns stay."""
    known = set(COLUMNS)
    return df.select(*[F.col(c).try_cast(column_type(c)).alias(c) if c in known else F.col(c) for c in ordered(df.columns)])


def complete(df: DataFrame) -> DataFrame:
    """All manifest columns, those that df lacks as nulls."""
    missing = [F.lit(None).cast(column_type(c)).alias(c) for c in COLUMNS if c not in df.columns]
    return typed(df.select("*", *missing))


def trace(df: DataFrame) -> DataFrame:
    """image_id and its row as a JSON document."""
    return df.select("image_id", F.to_json(F.struct(*[F.col(c) for c in ordered(df.columns)])).alias("document"))


def rejection(stage: str, code: Column | str, message: Column | str) -> Column:
    """An entry of a row's rejections."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(F.lit(stage).alias("stage"), lit(code).alias("code"), lit(message).alias("message"))


REJECTIONS = "array<struct<stage:string,code:string,message:string>>"


def reject(df: DataFrame, when: Column, entry: Column) -> DataFrame:
    """Adds a rejection where `when` holds. Rows keep earlier ones, and a rejected row never becomes accepted again."""
    had = F.coalesce(F.col("rejections"), F.array().cast(REJECTIONS)) if "rejections" in df.columns else F.array().cast(REJECTIONS)
    hit = F.coalesce(when, F.lit(False))
    status = F.col("status") if "status" in df.columns else F.lit("pending")
    return df.withColumn("rejections", F.when(hit, F.concat(had, F.array(entry))).otherwise(had)).withColumn("status", F.when(hit, "rejected").otherwise(status))


def accept(df: DataFrame) -> DataFrame:
    """Pending rows become accepted."""
    return df.withColumn("status", F.when(F.col("status") == "rejected", "rejected").otherwise("accepted"))


def primary(df: DataFrame) -> DataFrame:
    """rejection_stage, rejection_code, rejection_reason and rejection_count from the rejections."""
    first = F.try_element_at("rejections", F.lit(1))
    return df.select("*", first["stage"].alias("rejection_stage"), first["code"].alias("rejection_code"), first["message"].alias("rejection_reason"), F.size("rejections").cast("long").alias("rejection_count"), (F.col("status") == "rejected").alias("rejected"))
