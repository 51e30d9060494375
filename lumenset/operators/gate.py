"""The quality gate: components, score, grade and one explained decision per row, all as one CASE ladder."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cluster import ship
from ..functions import scalar
from ..schema import REJECTIONS
from .records import append_operation, operation


@dataclass(frozen=True)
class GateRules:
    # The default thresholds, weights and references of the gate.
    blur_min: float | None = 80.0
    brightness_min: float = 25.0
    brightness_max: float = 235.0
    max_clipped_fraction: float | None = None
    contrast_min: float | None = 15.0
    min_width: int | None = 64
    min_height: int | None = 64
    max_width: int | None = None
    max_height: int | None = None
    min_megapixels: float | None = None
    max_megapixels: float | None = None
    min_aspect: float = 0.25
    max_aspect: float = 4.0
    weights: dict = field(default_factory=lambda: {"blur": 0.4, "brightness": 0.2, "contrast": 0.25, "resolution": 0.15})
    min_score: float = 0.35
    warn_score: float = 0.55
    reference_blur: float = 400.0
    reference_contrast: float = 70.0
    reference_megapixels: float = 0.25
    grades: dict = field(default_factory=lambda: {"A": 0.85, "B": 0.70, "C": 0.55, "D": 0.40})
    fallback_grade: str = "F"
    reject_on_failure: bool = True
    exact_action: str = "reject"
    near_action: str = "reject"
    scoring: bool = True


def components(df: DataFrame, rules: GateRules) -> dict[str, Column]:
    """The measures in [0, 1] that df has columns for."""
    has = set(df.columns)
    out = {}
    if "quality_blur_score" in has:
        out["blur"] = scalar.ratio(F.col("quality_blur_score"), rules.reference_blur)
    if "quality_brightness" in has:
        out["brightness"] = scalar.brightness_score(F.col("quality_brightness"), rules.brightness_min, rules.brightness_max)
    if "quality_contrast" in has:
        out["contrast"] = scalar.ratio(F.col("quality_contrast"), rules.reference_contrast)
    if "megapixels" in has:
        out["resolution"] = scalar.ratio(F.col("megapixels"), rules.reference_megapixels)
    if "quality_entropy" in has:
        out["entropy"] = scalar.ratio(F.col("quality_entropy"), 8.0)
    if "quality_colorfulness" in has:
        out["colorfulness"] = scalar.ratio(F.col("quality_colorfulness"), 100.0)
    return out


def scored(df: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """df with quality_score and quality_grade."""
    return df.withColumn("quality_score", scalar.weighted_score(components(df, rules), rules.weights)).withColumn("quality_grade", scalar.grade(F.col("quality_score"), rules.grades, rules.fallback_grade))


def geometry_findings(rules: GateRules) -> list[tuple[str, Column]]:
    """(code, condition) of the bounds on size and aspect, in the order in which they are reported."""
    out = []
    for name, low, high in (("width", rules.min_width, rules.max_width), ("height", rules.min_height, rules.max_height), ("megapixels", rules.min_megapixels, rules.max_megapixels)):
        if low is not None:
            out.append(("low_resolution", F.col(name) < low))
        if high is not None:
            out.append(("oversized_image", F.col(name) > high))
    out.append(("extreme_aspect_ratio", (F.col("aspect_ratio") < rules.min_aspect) | (F.col("aspect_ratio") > rules.max_aspect)))
    return out


def failures(df: DataFrame, rules: GateRules) -> Column:
    """The codes of all failed checks, in order."""
    has = set(df.columns)
    checks: list[tuple[str | Column, Column]] = []
    if "quality_blur_score" in has and rules.blur_min is not None:
        checks.append(("blurry", F.col("quality_blur_score") < rules.blur_min))
    if "quality_brightness" in has:
        checks.append(("too_dark", F.col("quality_brightness") < rules.brightness_min))
        checks.append(("too_bright", F.col("quality_brightness") > rules.brightness_max))
    if rules.max_clipped_fraction is not None and {"shadow_fraction", "highlight_fraction"} <= has:
        side = F.when(F.col("highlight_fraction") >= F.col("shadow_fraction"), "too_bright").otherwise("too_dark")
        checks.append((side, F.col("highlight_fraction") + F.col("shadow_fraction") > rules.max_clipped_fraction))
    if "quality_contrast" in has and rules.contrast_min is not None:
        checks.append(("low_contrast", F.col("quality_contrast") < rules.contrast_min))
    checks += geometry_findings(rules)
    entries = [F.when(cond, code if isinstance(code, Column) else F.lit(code)) for code, cond in checks]
    return F.filter(F.array(*entries), lambda x: x.isNotNull())


def decided(df: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """df (scored; quality_duplicate_status optional) with failures, action (accept, warn, reject) and rejection code.

    Order: failed decode, rejected duplicate, failed check, low score, warnings. A representative that fails the gate
    is rejected although its duplicates are rejected for its sake.
    """
    rows = df.withColumn("failures", failures(df, rules))
    kind = F.col("quality_duplicate_status") if "quality_duplicate_status" in df.columns else F.lit("unique")
    act = F.when(kind == "exact_duplicate", rules.exact_action).when(kind == "near_duplicate", rules.near_action).otherwise("keep")
    broken = F.col("decode_failed") if "decode_failed" in df.columns else F.lit(False)
    failed = F.size("failures") > 0
    low = F.lit(rules.scoring) & (F.coalesce("quality_score", F.lit(0.0)) < rules.min_score)
    poor = F.lit(rules.scoring) & (F.coalesce("quality_score", F.lit(0.0)) < rules.warn_score)
    strict = F.lit(rules.reject_on_failure)
    code = F.when(broken, "unreadable_file").when(act == "reject", kind).when(failed & strict, F.get("failures", F.lit(0))).when(low, "low_quality_score")
    action = F.when(code.isNotNull(), "reject").when(failed | (act == "warn") | poor, "warn").otherwise("accept")
    return rows.withColumn("action", action).withColumn("rejection_code", code)


def significant(x: Column, digits: int = 4) -> Column:
    """A number as text with so many significant digits, without zeros at the end; scientific from 10 ** digits on and under 0.0001.

    Python rounds the number itself, halves to even, as C's printf does; Java's formatter rounds its shortest decimal form, halves up.
    """

    def said(values):  # noqa: ANN001, ANN202
        import pyarrow as pa

        return pa.array([None if v is None else f"%.{digits}g" % v for v in values.to_pylist()], pa.string())

    return F.arrow_udf(said, "string")(x.cast("double"))


def reason(rules: GateRules) -> Column:
    """A sentence for rejection_code, with the value and the bound that it missed."""
    code = F.col("rejection_code")
    missed = [("low_quality_score", "score", "quality_score", "under", rules.min_score), ("blurry", "sharpness", "quality_blur_score", "under", rules.blur_min), ("too_dark", "brightness", "quality_brightness", "under", rules.brightness_min), ("too_bright", "brightness", "quality_brightness", "over", rules.brightness_max), ("low_contrast", "contrast", "quality_contrast", "under", rules.contrast_min)]
    name, value, bound = F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("string")
    for c, said, column, word, limit in missed:
        if limit is not None:
            name, value, bound = F.when(code == c, said).otherwise(name), F.when(code == c, F.col(column)).otherwise(value), F.when(code == c, f"is {word} {limit:.4g}").otherwise(bound)
    name, value, bound = (F.when(code == "extreme_aspect_ratio", new).otherwise(old) for new, old in ((F.lit("aspect ratio"), name), (F.col("aspect_ratio"), value), (F.lit(f"is outside [{rules.min_aspect:g}, {rules.max_aspect:g}]"), bound)))
    size = F.concat(F.lit("size "), F.concat_ws("x", F.col("width").cast("long"), F.col("height").cast("long")), F.lit(" is out of bounds"))
    return F.when(name.isNotNull(), F.concat_ws(" ", name, F.coalesce(significant(value), F.lit("null")), bound)).when(code.isin("low_resolution", "oversized_image"), size).when(code.isNotNull(), F.replace(code, F.lit("_"), F.lit(" ")))


def applied(df: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """Decided rows with status, the rejection with its reason, and the gate's operation in the trail; warnings stay accepted."""
    ship(df.sparkSession)
    said = reason(rules)
    had = F.coalesce(F.col("rejections"), F.array().cast(REJECTIONS)) if "rejections" in df.columns else F.array().cast(REJECTIONS)
    entry = F.struct(F.lit("quality").alias("stage"), F.col("rejection_code").alias("code"), said.alias("message"))
    rejected = F.col("action") == "reject"
    status = F.when(rejected, "rejected").otherwise(F.when(F.col("status") == "rejected", "rejected").otherwise("accepted") if "status" in df.columns else F.lit("accepted"))
    rows = df.withColumn("rejections", F.when(rejected, F.concat(had, F.array(entry).cast(REJECTIONS))).otherwise(had)).withColumn("rejection_reason", F.when(rejected, said)).withColumn("status", status)
    return append_operation(rows, operation("quality", "gate", action=F.col("action"), score=F.col("quality_score")))


def grade_counts(df: DataFrame) -> DataFrame:
    """quality_grade, action and images."""
    return df.groupBy("quality_grade", "action").agg(F.count(F.lit(1)).alias("images"))


def quality_report(df: DataFrame) -> DataFrame:
    """One row: images, actions, images of each of the grades, mean and upper median score."""
    n = F.count(F.lit(1))
    grades = [F.count_if(F.col("quality_grade") == g).alias(f"grade_{g.lower()}") for g in "ABCDF"] if "quality_grade" in df.columns else []
    return df.agg(n.alias("images"), F.count_if(F.col("action") == "accept").alias("accepted"), F.count_if(F.col("action") == "warn").alias("warned"), F.count_if(F.col("action") == "reject").alias("rejected"), *grades, F.avg("quality_score").alias("mean_score")).join(F.broadcast(upper_median(df, "quality_score")))


def upper_median(df: DataFrame, column: str) -> DataFrame:
    """The value at place n div 2 (from 0) in ascending order, without sorting all rows in one task: distinct values are counted first."""
    from pyspark.sql import Window

    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("k"))
    run = counts.withColumn("upto", F.sum("k").over(Window.orderBy("v"))).withColumn("n", F.sum("k").over(Window.partitionBy()))
    return run.filter("upto > n div 2").agg(F.min("v").alias("median_score"))
