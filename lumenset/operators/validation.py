"""Validation: predicates that name what is wrong with a row, as long-form issues."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import blank, is_timestamp
from ..schema import REJECTIONS, accept, primary
from .corpus import numbered
from .records import append_operation, operation

# The fields that every row must have, the form of a label and the signs it must not hold.
REQUIRED = ("dataset_name", "dataset_version", "source_root", "source_path", "source_relpath", "source_class", "original_filename")
PATTERN = r"^[A-Za-z0-9][A-Za-z0-9_.\-]*$"
FORBIDDEN = ("/", "\\", ":", "*", "?", '"', "<", ">", "|")


def issues(df: DataFrame, checks: list[tuple[str, Column]], validator: str, code: str = "metadata_invalid", severity: str = "error", key: str = "image_id") -> DataFrame:
    """key, validator, code, check and severity: a row for each check that holds. One scan whatever the number of checks."""
    found = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks]), lambda x: x.isNotNull())
    return df.select(key, F.explode(found).alias("check")).select(key, F.lit(validator).alias("validator"), F.lit(code).alias("code"), "check", F.lit(severity).alias("severity"))


def metadata_checks(columns: list[str], required: tuple[str, ...] = REQUIRED, first_seen: bool = True) -> list[tuple[str, Column]]:
    has = set(columns)
    col = lambda c: F.col(c) if c in has else F.lit(None).cast("string")
    missing = None
    for c in required:
        missing = blank(col(c)) if missing is None else missing | blank(col(c))
    out = [("identity", blank(F.col("image_id")) | F.col("image_id").rlike("\\s")), ("provenance", missing)]
    stamps = ["source_modified_at"] + (["first_seen_at"] if first_seen else [])
    if first_seen:
        out.append(("first_seen", blank(col("first_seen_run_id")) | blank(col("first_seen_at"))))
    out += [(f"timestamp:{c}", blank(col(c)) | ~is_timestamp(col(c))) for c in stamps]
    path, root = col("source_path"), col("source_root")
    out += [
        ("path_absolute", ~path.startswith("/")),
        ("path_outside_root", path.startswith("/") & ~(path.startswith(F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))) | (path == root))),
        ("filename", F.element_at(F.split(path, "/"), -1) != col("original_filename")),
        ("relpath", ~col("source_relpath").endswith(col("original_filename"))),
    ]
    for c, n in (("content_hash", 64), ("pixel_hash", 40)):
        out.append((f"hash:{c}", (F.length(col(c)) != n) | ~col(c).rlike("^[0-9a-fA-F]+$")))
    out.append(("hash:perceptual_hash", ~col("perceptual_hash").rlike("^[0-9a-fA-F]+$")))
    if {"width", "height"} <= has:
        w, h = F.col("width"), F.col("height")
        out += [("dimensions_partial", w.isNull() != h.isNull()), ("dimensions_positive", (w <= 0) | (h <= 0))]
        out.append(("file_size", (w > 0) & (h > 0) & (col("file_size_bytes").cast("long") <= 0)))
    return out


def metadata_issues(df: DataFrame, **options) -> DataFrame:
    return issues(df, metadata_checks(df.columns, **options), "metadata")


def label_defect(label: Column, max_length: int = 128, forbidden: tuple[str, ...] = FORBIDDEN, pattern: str = PATTERN, allow_whitespace: bool = False) -> Column:
    """The first structural defect of a label, or null."""
    bad = None
    for ch in forbidden:
        bad = label.contains(ch) if bad is None else bad | label.contains(ch)
    out = F.when(label.isNull() | (label == ""), "empty")
    if not allow_whitespace:
        out = out.when(label.rlike("\\s"), "whitespace")
    return out.when(label != F.trim(label), "untrimmed").when(F.length(label) > max_length, "too_long").when(bad, "forbidden_characters").when(~label.rlike(pattern), "pattern")


def label_issues(df: DataFrame, labels: DataFrame) -> DataFrame:
    """image_id, code and check for labels that are missing, malformed, unknown, or carry another index than the mapping's."""
    known = labels.select("label", F.col("class_index").alias("_index"))
    j = df.join(F.broadcast(known) if known.limit(100_001).count() <= 100_000 else known, "label", "left")
    defect = label_defect(F.col("label"))
    check = F.when(blank(F.col("label")), "missing").when(defect.isNotNull(), defect).when(F.col("_index").isNull(), "unmapped").when(~F.col("class_index").eqNullSafe(F.col("_index")), "class_index")
    code = F.when(F.col("check") == "missing", "label_missing").otherwise("label_unmapped")
    return j.select("image_id", check.alias("check")).filter("check is not null").select("image_id", code.alias("code"), "check")


def shared_indices(labels: DataFrame) -> DataFrame:
    return labels.groupBy("class_index").agg(F.count(F.lit(1)).alias("labels")).filter("labels > 1")


def unknown_aliases(aliases: DataFrame, labels: DataFrame) -> DataFrame:
    """Aliases whose label the mapping lacks."""
    return aliases.join(labels.select("label"), "label", "left_anti")


def invalid_labels(labels: DataFrame, **form) -> DataFrame:
    """Labels of the mapping with a structural defect."""
    return labels.select("label", label_defect(F.col("label"), **form).alias("defect")).filter("defect is not null")


def label_space_issues(labels: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """subject and check of the mapping's defects: labels out of form, class indices that labels share, aliases without a label."""
    out = invalid_labels(labels).select(F.col("label").alias("subject"), F.col("defect").alias("check"))
    out = out.unionByName(shared_indices(labels).select(F.col("class_index").cast("string").alias("subject"), F.lit("shared_index").alias("check")))
    if aliases is not None:
        out = out.unionByName(unknown_aliases(aliases, labels).select(F.col("alias").alias("subject"), F.lit("unknown_alias").alias("check")))
    return out


def repeated(df: DataFrame, keys: list[str], order: str = "ordinal") -> DataFrame:
    """All rows but the first of each key, which comes from an aggregate that combines before its shuffle."""
    first = df.groupBy(*keys).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return df.join(first, keys).filter(F.col(order) != F.col("_first")).select(*df.columns)


def numbered_repeats(df: DataFrame, keys: list[str], order: str = "ordinal") -> DataFrame:
    """The rows of `repeated` with their number in the key's order, from 1."""
    return numbered(repeated(df, keys, order), keys, [order], "_k").withColumn("repeat", F.col("_k") + 1).drop("_k")


def missing_files(df: DataFrame, listing: DataFrame) -> DataFrame:
    """Rows whose source_path a fresh listing (path) lacks."""
    return df.join(listing.select(F.col("path").alias("source_path")), "source_path", "left_anti")


def disagreements(ours: Mapping[str, object], theirs: Mapping[str, object] | None, keys: tuple[str, ...]) -> list[tuple[str, str]]:
    """(key, message) where two records of the same run or corpus differ; one entry if there is no other record."""
    if theirs is None:
        return [("missing", "there is no record to compare with")]
    return [(k, f"{ours.get(k)!r} is not {theirs.get(k)!r}") for k in keys if ours.get(k) != theirs.get(k)]


def fingerprint_agreement(current: Mapping[str, object], stored: Mapping[str, object] | None) -> list[tuple[str, str]]:
    """What a stored fingerprint says otherwise than the corpus in hand."""
    return disagreements(current, stored, ("fingerprint", "composition", "labels", "sources", "config"))


def manifest_agreement(run: Mapping[str, object], stored: Mapping[str, object] | None) -> list[tuple[str, str]]:
    """What a stored run manifest says otherwise than this run."""
    return disagreements(run, stored, ("run_id", "config_hash", "dataset_version"))


def integrity_statistics(df: DataFrame, sources: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """check and images, a row for each corpus-wide check, and the total number of rows."""
    count = lambda name, rows: rows.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("images"))
    parts = [("records", df), ("duplicate_id", repeated(df, ["image_id"])), ("duplicate_entry", repeated(df, ["dataset_name", "source_relpath"])), ("orphan", orphans(df, sources))]
    if listing is not None:
        parts.append(("missing_file", missing_files(df, listing)))
    out = None
    for name, rows in parts:
        out = count(name, rows) if out is None else out.unionByName(count(name, rows))
    return out


def apply_issues(df: DataFrame, found: DataFrame, stage: str = "validate", key: str = "image_id") -> DataFrame:
    """df with a rejection for each error among the issues (key, code, check, severity), and their number of warnings.

    A row may be rejected for several reasons, in the order of code and check; warnings only annotate. Issues are put
    together per row before they meet df, and rows without any stay as they are.
    """
    entry = F.struct(F.lit(stage).alias("stage"), F.col("code").alias("code"), F.col("check").alias("message"))
    per = found.groupBy(F.col(key).alias("_key")).agg(F.array_sort(F.collect_list(F.when(F.col("severity") == "error", entry))).alias("_errors"), F.count_if(F.col("severity") != "error").alias("_warnings"))
    had = F.coalesce(F.col("rejections"), F.array().cast(REJECTIONS)) if "rejections" in df.columns else F.array().cast(REJECTIONS)
    status = F.col("status") if "status" in df.columns else F.lit("pending")
    j = df.join(per, F.col(key) == F.col("_key"), "left")
    errors = F.coalesce("_errors", F.array().cast(REJECTIONS))
    out = j.withColumn("status", F.when(F.size(errors) > 0, "rejected").otherwise(status)).withColumn("rejections", F.concat(had, errors.cast(REJECTIONS)))
    return out.withColumn("validation_warnings", F.coalesce("_warnings", F.lit(0))).drop("_key", "_errors", "_warnings")


def store_observations(df: DataFrame, observed: DataFrame, columns: list[str], key: str = "source_path") -> DataFrame:
    """df with the observed columns of the rows that weren't rejected; the others keep theirs."""
    right = observed.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    j = df.join(right, F.col(key) == F.col("_key"), "left")
    had = lambda c: F.col(c) if c in df.columns else F.lit(None)
    return j.select(*[F.col(c) for c in df.columns if c not in columns], *[F.when(F.col("status") == "rejected", had(c)).otherwise(F.coalesce(F.col(f"_{c}"), had(c))).alias(c) for c in columns])


def validated(df: DataFrame, found: DataFrame) -> DataFrame:
    """df after validation: issues applied, what is left accepted, the first rejection in columns, the operation in the trail."""
    rows = append_operation(accept(apply_issues(df, found)), operation("validate", "validate"))
    return primary(rows)


def validation_report(df: DataFrame, found: DataFrame) -> DataFrame:
    """kind, name and images: rows by status, errors and warnings by code, and issues by validator."""
    part = lambda rows, kind, name: rows.groupBy(F.lit(kind).alias("kind"), name.cast("string").alias("name")).agg(F.count(F.lit(1)).alias("images"))
    out = part(df, "status", F.col("status"))
    out = out.unionByName(part(found, "code", F.concat_ws(":", "severity", "code")))
    return out.unionByName(part(found, "validator", F.col("validator")))


#: The number of bands of an image's mode.
BANDS = {"1": 1, "L": 1, "P": 1, "LA": 2, "RGB": 3, "YCbCr": 3, "LAB": 3, "HSV": 3, "RGBA": 4, "CMYK": 4, "I": 1, "F": 1}


def bands(mode: Column) -> Column:
    """How many bands a colour mode has; null for unknown modes."""
    out = F.lit(None).cast("int")
    for name, n in BANDS.items():
        out = F.when(mode == name, n).otherwise(out)
    return out


def decode_error(failed: Column, complete: Column, probed: Column) -> Column:
    """The code of a failed decode: unreadable_file without a header, truncated_image without an end, decode_failed else."""
    return F.when(~failed, None).when(~probed, "unreadable_file").when(~complete, "truncated_image").otherwise("decode_failed")


def pixel_shape(height: Column, width: Column, channels: Column) -> Column:
    """What is wrong with a decoded array's shape, or null."""
    return F.when(F.coalesce(height, F.lit(0)) * F.coalesce(width, F.lit(0)) <= 0, "empty_pixels").when(~F.coalesce(channels, F.lit(0)).isin(1, 3, 4), "unexpected_channels")


def image_chain(probed: DataFrame, measured: DataFrame | None = None, **ladder) -> DataFrame:
    """image_ladder, then for the rows without an error the decode: its error code and the array's shape. Decoding is skipped without `measured`.

    Files over the pixel limit have an error before any decode; give `measured` only the paths that `image_ladder` let through.
    """
    rows = image_ladder(probed, **ladder)
    if measured is None:
        return rows
    m = measured.select(F.col("path").alias("_path"), "decode_failed", F.col("height").alias("_h"), F.col("width").alias("_w"), F.col("channels").alias("_c"))
    j = rows.join(m, F.col("path") == F.col("_path"), "left")
    broken = decode_error(F.coalesce("decode_failed", F.lit(False)), F.coalesce("complete", F.lit(False)), F.col("image_format").isNotNull())
    shape = F.when(F.col("_path").isNotNull() & ~F.coalesce("decode_failed", F.lit(False)), pixel_shape(F.col("_h"), F.col("_w"), F.col("_c")))
    return j.withColumn("code", F.coalesce("code", broken, shape)).drop("_path", "decode_failed", "_h", "_w", "_c")


def orphans(df: DataFrame, sources: DataFrame) -> DataFrame:
    return df.join(sources.select("dataset_name"), "dataset_name", "left_anti")


def version_mismatches(df: DataFrame, sources: DataFrame) -> DataFrame:
    s = sources.select("dataset_name", F.col("dataset_version").alias("_declared"))
    return df.join(s, "dataset_name").filter("dataset_version <> _declared").groupBy("dataset_name").agg(F.count(F.lit(1)).alias("images"))


def image_ladder(df: DataFrame, extensions: tuple[str, ...] = (".jpg", ".jpeg", ".png"), formats: tuple[str, ...] = ("jpeg", "png", "mpo"), modes: tuple[str, ...] = (), min_dimension: int = 2, max_pixels: int | None = 178_956_970, max_bytes: int | None = None) -> DataFrame:
    """df of probed files with code, the first error: extension, file, size, probe, geometry, format, mode. Decoding comes after, for rows without one."""
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    code = F.when(~suffix.isin(*extensions), "unsupported_format").when(F.col("file_size_bytes").isNull(), "unreadable_file").when(F.col("file_size_bytes") == 0, "empty_file")
    if max_bytes is not None:
        code = code.when(F.col("file_size_bytes") > max_bytes, "oversized_image")
    code = code.when(F.col("image_format").isNull(), "unreadable_file").when((F.col("width") < min_dimension) | (F.col("height") < min_dimension), "invalid_dimensions")
    if max_pixels is not None:
        code = code.when(F.col("width") * F.col("height") > max_pixels, "oversized_image")
    code = code.when(~F.col("image_format").isin(*formats), "unsupported_format")
    if modes:
        code = code.when(~F.upper("color_mode").isin(*modes), "invalid_color_mode")
    declared = F.when(suffix == ".jpg", "jpeg").otherwise(F.expr("substring(lower(regexp_extract(path, '([.][^./]*)$', 1)), 2)"))
    warnings = F.filter(F.array(F.when(~F.col("exif_orientation").between(1, 8), F.lit("exif_orientation")), F.when(declared != F.col("image_format"), F.lit("format_mismatch"))), lambda x: x.isNotNull())
    return df.withColumn("code", code).withColumn("warnings", warnings)
