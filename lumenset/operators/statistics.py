"""Descriptive statistics and distributions of manifest columns. Each summary of several columns is one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERCENTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
NUMERIC = ("width", "height", "megapixels", "aspect_ratio", "file_size_bytes", "quality_brightness", "quality_contrast", "quality_entropy", "quality_blur_score", "quality_score")
CATEGORICAL = ("label", "dataset_name", "image_format", "color_mode", "quality_grade", "quality_duplicate_status", "crop")


def long_form(df: DataFrame, columns: tuple[str, ...], kind: str) -> DataFrame:
    """name and value, a row for each column and row; columns that df lacks are left out."""
    present = [c for c in columns if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).try_cast(kind).alias("value")) for c in present])
    return df.select(F.explode(pairs).alias("p")).select("p.name", "p.value")


def numeric_summary(df: DataFrame, columns: tuple[str, ...] = NUMERIC, percentiles: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """name, count, missing, mean, std (of the population), min, max, cv and the percentiles, interpolated in a line.

    Moments come from one wide aggregate that combines before its shuffle, a row a partition whatever the columns.
    """
    present = [c for c in columns if c in df.columns]
    value = lambda c: F.col(c).try_cast("double")
    aggregates = [F.struct(F.lit(c).alias("name"), F.count(value(c)).alias("count"), F.count_if(value(c).isNull()).alias("missing"), F.avg(value(c)).alias("mean"), F.stddev_pop(value(c)).alias("std"), F.min(value(c)).alias("min"), F.max(value(c)).alias("max")) for c in present]
    moments = df.agg(F.array(*aggregates).alias("a")).select(F.explode("a").alias("a")).select("a.*")
    found = quantiles(df, tuple(present), percentiles)
    # a row a column on either side
    joined = moments.join(F.broadcast(found), "name", "left").filter("count + missing > 0")
    return joined.select("name", "count", "missing", "mean", "std", "min", "max", F.abs(F.try_divide("std", "mean")).alias("cv"), *[F.col(f"p{round(p * 100):02d}") for p in percentiles])


def quantiles(df: DataFrame, columns: tuple[str, ...], shares: tuple[float, ...]) -> DataFrame:
    """name and p05, p25 and so on: exact quantiles, interpolated in a line, of the values that aren't null.

    Values are counted, and the counts dealt to ranges of (column, value); a sum over the ranges says which one holds a
    place, and only inside a range are counts added up in order. No task holds all values of a column.
    """
    from .duplicates import _checkpoint

    counts = long_form(df, columns, "double").filter("value is not null").groupBy("name", "value").agg(F.count(F.lit(1)).alias("k"))
    held = _checkpoint(counts.repartitionByRange("name", "value").withColumn("_range", F.spark_partition_id()))
    parts = held.groupBy("name", "_range").agg(F.sum("k").alias("_sum"))
    per = Window.partitionBy("name")
    before = F.coalesce(F.sum("_sum").over(per.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select(F.col("name").alias("_name"), F.col("_range").alias("_range2"), before.alias("_before"), F.sum("_sum").over(per).alias("_n"))
    inside = held.withColumn("_in", F.sum("k").over(Window.partitionBy("_range", "name").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ranked = inside.join(starts, (F.col("name") == F.col("_name")) & (F.col("_range") == F.col("_range2"))).withColumn("_last", F.col("_before") + F.col("_in") - 1).withColumn("_first", F.col("_last") - F.col("k") + 1)
    at = lambda p: (F.col("_n") - 1) * F.lit(p)
    value_at = lambda place: F.max(F.when((F.col("_first") <= place) & (place <= F.col("_last")), F.col("value")))
    wanted = [f(at(p)) for p in shares for f in (F.floor, F.ceil)]
    ends = ranked.groupBy("name").agg(F.max("_n").alias("_n"), *[value_at(w).alias(f"_v{i}") for i, w in enumerate(wanted)])
    out = []
    for i, p in enumerate(shares):
        low, high, rest = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}"), at(p) - F.floor(at(p))
        out.append(F.when(rest == 0, low).otherwise(low + (high - low) * rest).alias(f"p{round(p * 100):02d}"))
    return ends.select("name", *out)


def category_counts(df: DataFrame, columns: tuple[str, ...] = CATEGORICAL) -> DataFrame:
    """name, key and count of the values that aren't null."""
    return long_form(df, columns, "string").filter("value is not null").groupBy("name", F.col("value").alias("key")).agg(F.count(F.lit(1)).alias("count"))


def category_distribution(df: DataFrame, columns: tuple[str, ...] = CATEGORICAL, top: int | None = 50) -> DataFrame:
    """The commonest values of each column with rank and share; shares are of the kept values. Labels and sources are never cut."""
    counts = category_counts(df, columns)
    w = Window.partitionBy("name")
    ranked = counts.withColumn("rank", F.row_number().over(w.orderBy(F.desc("count"), "key")))
    if top:
        ranked = ranked.filter((F.col("rank") <= top) | F.col("name").isin("label", "dataset_name"))
    return ranked.withColumn("share", F.col("count") / F.sum("count").over(w))


def categorical_summary(df: DataFrame, columns: tuple[str, ...] = CATEGORICAL) -> DataFrame:
    """name, count, missing, unique and the commonest value; `most_common` lists more of them."""
    total = long_form(df, columns, "string").groupBy("name").agg(F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("missing"))
    best = category_counts(df, columns).groupBy("name").agg(F.count(F.lit(1)).alias("unique"), F.min_by("key", F.struct(-F.col("count"), "key")).alias("top"))
    return total.join(best, "name", "left").select("name", "count", "missing", F.coalesce("unique", F.lit(0)).alias("unique"), "top")


def most_common(df: DataFrame, columns: tuple[str, ...] = CATEGORICAL, top: int = 5) -> DataFrame:
    """name, unique and `top` values, as text `value=count`, commonest first."""
    counts = category_counts(df, columns)
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("count"), "key")))
    said = F.struct("rank", F.concat_ws("=", "key", F.col("count").cast("string")).alias("said"))
    return ranked.groupBy("name").agg(F.count(F.lit(1)).alias("unique"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") <= top, said))), lambda x: x["said"]), " | ").alias("top"))


def histograms(df: DataFrame, columns: tuple[str, ...], bins: int = 40) -> DataFrame:
    """name, bin, lo, hi and count of all columns, in two scans whatever their number. Columns without values have no bins."""
    present = tuple(c for c in columns if c in df.columns)
    ends = df.agg(F.array(*[F.struct(F.lit(c).alias("name"), F.min(F.col(c).try_cast("double")).alias("lo"), F.max(F.col(c).try_cast("double")).alias("hi")) for c in present]).alias("e"))
    ends = ends.select(F.explode("e").alias("e")).select("e.*").filter("lo is not null")
    one = F.col("lo") == F.col("hi")
    place = F.when(one, 0).otherwise(F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)))
    counts = long_form(df, present, "double").filter("value is not null").join(F.broadcast(ends), "name").groupBy("name", place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = ends.select("name", "lo", "hi", F.explode(F.when(one, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(bins - 1)))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    edges = every.select("name", "bin", (F.col("lo") + F.col("bin") * width).alias("lo"), F.when(one | (F.col("bin") == bins - 1), F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("hi"))
    return edges.join(counts, ["name", "bin"], "left").select("name", "bin", "lo", "hi", F.coalesce("count", F.lit(0)).alias("count"))


def cumulative_shares(counts: DataFrame, key: str = "label") -> DataFrame:
    """place, key, images and the share of all images that this key and the larger ones have. There are as many rows as keys."""
    run = Window.orderBy(F.desc("images"), key)
    n = F.col("images").cast("double")
    return counts.select(F.row_number().over(run).alias("place"), key, "images", (F.sum(n).over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow)) / F.sum(n).over(Window.partitionBy())).alias("cumulative_share"))


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """bin, lo, hi and count over [min, max]; the last bin is closed, empty bins are listed, equal values make one bin."""
    v = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    ends = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).filter("lo is not null")
    one = F.col("lo") == F.col("hi")
    place = F.when(one, 0).otherwise(F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)))
    counts = v.join(F.broadcast(ends)).groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = ends.select("lo", "hi", F.explode(F.when(one, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(bins - 1)))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    edges = all_bins.select("bin", (F.col("lo") + F.col("bin") * width).alias("lo"), F.when(one | (F.col("bin") == bins - 1), F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("hi"))
    return edges.join(counts, "bin", "left").select("bin", "lo", "hi", F.coalesce("count", F.lit(0)).alias("count"))


def resolution_distribution(df: DataFrame, top: int = 25) -> DataFrame:
    """The commonest WIDTHxHEIGHT."""
    pairs = df.filter("width is not null and height is not null").groupBy(F.concat_ws("x", F.col("width").cast("long"), F.col("height").cast("long")).alias("resolution")).agg(F.count(F.lit(1)).alias("count"))
    return pairs.orderBy(F.desc("count"), "resolution").limit(top)


def class_distribution(df: DataFrame) -> DataFrame:
    """Per label: images, sources, mean measures, share and rank."""
    table = df.groupBy("label").agg(
        F.count(F.lit(1)).alias("images"),
        F.count_distinct("dataset_name").alias("sources"),
        *([F.avg("quality_score").alias("mean_quality_score")] if "quality_score" in df.columns else []),
        F.avg("megapixels").alias("mean_megapixels"),
        F.avg("quality_blur_score").alias("mean_sharpness"),
        F.avg("quality_brightness").alias("mean_brightness"),
        *([F.min("class_index").alias("class_index")] if "class_index" in df.columns else []),
    )
    return table.withColumn("share", F.col("images") / F.sum("images").over(Window.partitionBy())).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("images"), F.col("label").asc_nulls_last())))


def source_distribution(df: DataFrame) -> DataFrame:
    """Per source: images, classes, mean measures, version and share."""
    table = df.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("images"),
        F.count_distinct("label").alias("classes"),
        F.avg("megapixels").alias("mean_megapixels"),
        F.avg("file_size_bytes").alias("mean_file_size_bytes"),
        F.min_by("dataset_version", "ordinal").alias("version"),
    )
    return table.withColumn("share", F.col("images") / F.sum("images").over(Window.partitionBy()))


def cluster_sizes(df: DataFrame) -> DataFrame:
    """size and the number of duplicate clusters of that size."""
    sizes = df.filter("duplicate_group is not null").groupBy("duplicate_group").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("clusters"))


def totals(df: DataFrame) -> DataFrame:
    clusters = [F.count_distinct("duplicate_group").alias("clusters")] if "duplicate_group" in df.columns else []
    return df.agg(F.count(F.lit(1)).alias("images"), F.count_distinct("label").alias("classes"), F.count_distinct("dataset_name").alias("sources"), F.sum("file_size_bytes").alias("bytes"), F.sum("megapixels").alias("megapixels"), *clusters)


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("images"))


def evenness(counts: DataFrame, column: str = "images") -> DataFrame:
    """groups, total, gini, entropy and normalised entropy of a table of counts, in one row.

    Equal counts are added up first, so the running sum is over distinct counts only.
    """
    grouped = counts.select(F.col(column).cast("double").alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("k"))
    run = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    ranked = grouped.withColumn("before", F.coalesce(F.sum("k").over(run), F.lit(0)))
    index_sum = F.col("k") * F.col("before") + F.col("k") * (F.col("k") + 1) / 2
    sums = ranked.agg(F.sum("k").alias("groups"), F.sum(F.when(F.col("n") > 0, F.col("k"))).alias("used"), F.sum(F.col("k") * F.col("n")).alias("total"), F.sum(index_sum * F.col("n")).alias("weighted"), F.sum(F.when(F.col("n") > 0, F.col("k") * F.col("n") * F.log2("n"))).alias("nlogn"))
    groups, total = F.col("groups"), F.col("total")
    gini = F.coalesce(2 * F.try_divide("weighted", groups * total) - F.try_divide(groups + 1, groups), F.lit(0.0))
    entropy = F.when(total > 0, F.log2(total) - F.col("nlogn") / total).otherwise(F.lit(0.0))
    normal = F.when(F.coalesce("used", F.lit(0)) == 0, F.lit(0.0)).when(F.col("used") == 1, F.lit(1.0)).otherwise(F.try_divide(entropy, F.log2("used")))
    return sums.select(F.coalesce(groups, F.lit(0)).alias("groups"), F.coalesce(total, F.lit(0.0)).cast("long").alias("total"), gini.alias("gini"), F.coalesce(entropy, F.lit(0.0)).alias("entropy"), F.coalesce(normal, F.lit(0.0)).alias("evenness"))


def shares(counts: DataFrame, column: str = "images") -> Column:
    return F.col(column) / F.sum(column).over(Window.partitionBy())
