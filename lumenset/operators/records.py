"""Views of the manifest, lookups, and the trail of operations that each row carries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import complete

OPERATIONS = "array<struct<stage:string,name:string,detail:map<string,string>>>"


def status_view(df: DataFrame, status: str) -> DataFrame:
    """The rows that are accepted, rejected or pending."""
    return df.filter(F.col("status") == status)


def in_split(df: DataFrame, split: str) -> DataFrame:
    return df.filter((F.col("status") == "accepted") & (F.col("split") == split))


def lookup(df: DataFrame, value: object, column: str = "image_id") -> DataFrame:
    """The one row with that id (or value of another unique column); none if there is none."""
    return df.filter(F.col(column) == F.lit(value)).limit(1)


def to_frame(df: DataFrame, accepted_only: bool = False) -> DataFrame:
    """The manifest's columns in order and of their types, all or accepted rows only."""
    return complete(status_view(df, "accepted") if accepted_only else df)


def profile_scope(df: DataFrame, include_rejected: bool = False) -> DataFrame:
    """The rows that profiles describe."""
    return df if include_rejected else status_view(df, "accepted")


def operation(stage: str, name: str, **detail: Column | object) -> Column:
    """An entry of the trail; details are text."""
    pairs = [x for k, v in detail.items() for x in (F.lit(k), (v if isinstance(v, Column) else F.lit(v)).cast("string"))]
    return F.struct(F.lit(stage).alias("stage"), F.lit(name).alias("name"), (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("detail"))


def append_operation(df: DataFrame, entry: Column, when: Column | None = None) -> DataFrame:
    """df with entry at the end of `operations`, where `when` holds; the entries before it stay as they are."""
    had = F.coalesce(F.col("operations"), F.array().cast(OPERATIONS)) if "operations" in df.columns else F.array().cast(OPERATIONS)
    more = F.concat(had, F.array(entry.cast(OPERATIONS[6:-1])))
    return df.withColumn("operations", more if when is None else F.when(F.coalesce(when, F.lit(False)), more).otherwise(had))


def flat_operations(df: DataFrame) -> DataFrame:
    """`operations` as the names joined by semicolons, and operation_count."""
    names = F.transform("operations", lambda x: x["name"])
    return df.withColumn("operation_count", F.size("operations").cast("long")).withColumn("operations", F.array_join(names, ";"))


def constructed(scanned: DataFrame) -> DataFrame:
    """Records of scanned files: format by suffix, pending, or rejected where there is no class, with the ingest operation."""
    suffix = F.lower(F.regexp_extract("original_filename", r"\.([^.]*)$", 1))
    rows = scanned.withColumn("image_format", F.when(suffix == "jpg", "jpeg").otherwise(F.nullif(suffix, F.lit(""))))
    rows = rows.withColumn("status", F.when(F.col("source_class").isNull(), "rejected").otherwise("pending"))
    return append_operation(rows, operation("ingest", "ingest", dataset=F.col("dataset_name"), path=F.col("source_relpath")))
