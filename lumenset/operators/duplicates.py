"""Exact and near duplicates: links, clusters, representatives."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import shared_root
from ..functions import scalar


def _checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a copy in the shared folder."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def exact_links(items: DataFrame, hashes: tuple[str, ...] = ("content_hash", "pixel_hash"), across_classes: bool = True) -> DataFrame:
    """a, b (ordinals, a < b): each item with the first one that has its hash. Stars, not all pairs, so links grow with the items."""
    out = None
    for h in hashes:
        key = [h] if across_classes else [h, "label"]
        held = items.filter(F.col(h).isNotNull())
        first = held.groupBy(*key).agg(F.min("ordinal").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        links = held.join(first, key).filter("ordinal <> a").select("a", F.col("ordinal").alias("b"))
        out = links if out is None else out.unionByName(links)
    return out.distinct()


def bands_of(radius: int, bits: int, nodes: int, most_masks: int = 512) -> tuple[int, int]:
    """(bands, errors): hashes within the radius agree but for `errors` bits in one of so many bands. The pair with the fewest expected rows."""
    best, least = (radius + 1, 0), float("inf")
    for errors in range(radius + 1):
        bands = radius // (errors + 1) + 1
        width = bits / bands
        masks = sum(math.comb(math.ceil(width), i) for i in range(errors + 1))
        if masks > most_masks or math.ceil(width) > 63:
            continue
        rows = nodes * bands * (masks + 1 + nodes * masks / 2.0**width)
        if rows < least:
            best, least = (bands, errors), rows
    return best


def near_links(items: DataFrame, radius: int = 5, bits: int = 64, across_classes: bool = True) -> DataFrame:
    """a, b, distance of items whose hashes differ in at most `radius` bits.

    A 64-bit hash is cut into bands so that two hashes within the radius agree in one of them but for a bit or so; every
    hash is stored under its bands and asked for under all values that near in each band. For the default radius that
    is 3 bands of 21 bits with one wrong bit: 66 rows asked for each hash, and one candidate in 30,000 pairs. Longer
    hashes meet by equal bands. Equal hashes are put together first: only distinct hashes take part in the join.
    """
    if radius == 0:
        return exact_links(items, ("perceptual_hash",), across_classes).withColumn("distance", F.lit(0))
    key = ["perceptual_hash"] if across_classes else ["perceptual_hash", "label"]
    held = items.filter("perceptual_hash is not null")
    nodes = held.groupBy(*key).agg(F.min("ordinal").alias("ordinal"))
    words = bits // 64
    keep = ["ordinal", "perceptual_hash", *(["label"] if not across_classes else [])]
    if words == 1:
        nodes = _checkpoint(nodes)
        count, errors = bands_of(radius, bits, nodes.count())
        edges = [round(i * bits / count) for i in range(count + 1)]
        value = F.conv("perceptual_hash", 16, -10).cast("long")
        band = lambda i: F.shiftrightunsigned(value, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1 if edges[i + 1] - edges[i] < 64 else -1).cast("long"))
        cut = F.array(*[F.struct(F.lit(i).alias("band"), band(i).alias("value")) for i in range(count)])
        stored = nodes.select(*keep, F.explode(cut).alias("c")).select(*keep, "c.band", "c.value")
        masks = [[sum(1 << b for b in chosen) for e in range(errors + 1) for chosen in itertools.combinations(range(edges[i + 1] - edges[i]), e)] for i in range(count)]
        by_band = F.array(*[F.array(*[F.lit(m).cast("long") for m in ms]) for ms in masks])
        asked = stored.withColumn("mask", F.explode(F.get(by_band, F.col("band")))).withColumn("value", F.col("value").bitwiseXOR(F.col("mask"))).drop("mask")
    else:
        count = radius + 1
        edges = [round(i * bits / count) for i in range(count + 1)]
        binary = F.concat(*[F.lpad(F.conv(F.substring("perceptual_hash", 16 * i + 1, 16), 16, 2), 64, "0") for i in range(words)])
        cut = F.array(*[F.struct(F.lit(i).alias("band"), F.substring(binary, edges[i] + 1, edges[i + 1] - edges[i]).alias("value")) for i in range(count)])
        stored = asked = nodes.select(*keep, F.explode(cut).alias("c")).select(*keep, "c.band", "c.value")
    x, y = asked.alias("x"), stored.alias("y")
    on = (F.col("x.band") == F.col("y.band")) & (F.col("x.value") == F.col("y.value")) & (F.col("x.ordinal") < F.col("y.ordinal"))
    if not across_classes:
        on = on & F.col("x.label").eqNullSafe(F.col("y.label"))
    d = scalar.hamming(F.col("x.perceptual_hash"), F.col("y.perceptual_hash"), words)
    pairs = x.join(y, on & (d <= radius)).select(F.col("x.ordinal").alias("a"), F.col("y.ordinal").alias("b"), d.alias("distance")).distinct()
    same = held.join(nodes.withColumnRenamed("ordinal", "a"), key).filter("ordinal <> a").select("a", F.col("ordinal").alias("b"), F.lit(0).alias("distance"))
    return pairs.unionByName(same)


def comparisons(items: DataFrame, radius: int = 5, bits: int = 64) -> int:
    """How many candidate pairs the search of near_links compares, as expected for evenly spread hashes."""
    n = items.filter("perceptual_hash is not null").select("perceptual_hash").distinct().count()
    count, errors = bands_of(radius, bits, n)
    width = bits / count
    return round(n * (n - 1) / 2 * count * sum(math.comb(round(width), i) for i in range(errors + 1)) / 2.0**width)


def clusters(links: DataFrame) -> DataFrame:
    """ordinal and root, the least ordinal of its connected component, for all linked items.

    Each round joins labels over the links, takes the least, and jumps to the label's label; rounds grow with the
    logarithm of a chain. The lineage is cut after each by a checkpoint in the shared folder.
    """
    both = _checkpoint(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = _checkpoint(both.groupBy(F.col("a").alias("ordinal")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        met = both.join(labels.withColumnRenamed("ordinal", "b"), "b").groupBy(F.col("a").alias("ordinal")).agg(F.min("root").alias("near"))
        step = labels.join(met, "ordinal").select("ordinal", F.least("root", "near").alias("next"), F.col("root").alias("had"))
        jump = step.select(F.col("ordinal").alias("next"), F.col("next").alias("far"))
        new = _checkpoint(step.join(jump, "next").select("ordinal", F.least("next", "far").alias("root"), "had"))
        changed = new.filter("root <> had").limit(1).count()
        labels = new.select("ordinal", "root")
        if not changed:
            return labels


def representatives(members: DataFrame, keep: str = "highest_quality") -> DataFrame:
    """members (ordinal, root, image_id, quality_score, megapixels) with representative, cluster size and group id.

    keep: first, highest_quality or largest; ties go to the first. Group sizes come from an aggregate, and the choice
    is a min_by that combines before its shuffle, so a cluster with a third of all items needs no single task.
    """
    order = {"first": [F.col("ordinal")], "highest_quality": [-F.coalesce("quality_score", F.lit(0.0)), F.col("ordinal")], "largest": [-F.coalesce("megapixels", F.lit(0.0)), F.col("ordinal")]}[keep]
    best = members.groupBy("root").agg(F.min_by("image_id", F.struct(*order)).alias("duplicate_group"), F.min_by("ordinal", F.struct(*order)).alias("representative"), F.count(F.lit(1)).alias("cluster_size"))
    return members.join(best.filter("cluster_size >= 2"), "root")


def links_to_representative(items: DataFrame, grouped: DataFrame, bits: int = 64) -> DataFrame:
    """Each duplicate's ordinal, duplicate_group, kind (exact_duplicate or near_duplicate) and similarity to the representative."""
    m = grouped.filter("ordinal <> representative").select("ordinal", "representative", "duplicate_group")
    hashes = items.select("ordinal", "content_hash", "pixel_hash", "perceptual_hash")
    head = hashes.select(F.col("ordinal").alias("representative"), F.col("content_hash").alias("c"), F.col("pixel_hash").alias("p"), F.col("perceptual_hash").alias("h"))
    j = m.join(hashes, "ordinal").join(head, "representative")
    exact = F.coalesce(F.col("content_hash") == F.col("c"), F.lit(False)) | F.coalesce(F.col("pixel_hash") == F.col("p"), F.lit(False))
    similar = F.coalesce(F.round(1 - scalar.hamming(F.col("perceptual_hash"), F.col("h"), bits // 64) / F.lit(float(bits)), 6), F.lit(0.0))
    return j.select("ordinal", "representative", "duplicate_group", F.when(exact, "exact_duplicate").otherwise("near_duplicate").alias("kind"), F.when(exact, F.lit(1.0)).otherwise(similar).alias("similarity"))


def duplicate_status(items: DataFrame, grouped: DataFrame, links: DataFrame) -> DataFrame:
    """items with duplicate_group, duplicate_of, quality_duplicate_status and quality_perceptual_similarity."""
    g = grouped.select("ordinal", "duplicate_group", "representative")
    k = links.select("ordinal", "kind", "similarity")
    out = items.join(g, "ordinal", "left").join(k, "ordinal", "left")
    state = F.coalesce(F.col("kind"), F.when(F.col("representative") == F.col("ordinal"), "representative").otherwise("unique"))
    return out.select(*[c for c in items.columns], "duplicate_group", F.when(F.col("kind").isNotNull(), F.col("duplicate_group")).alias("duplicate_of"), state.alias("quality_duplicate_status"), F.col("similarity").alias("quality_perceptual_similarity"))


def duplicate_report(links: DataFrame, grouped: DataFrame) -> DataFrame:
    """groups, links, exact, near and the largest cluster."""
    a = grouped.agg(F.count_distinct("root").alias("groups"), F.coalesce(F.max("cluster_size"), F.lit(0)).alias("largest"))
    b = links.agg(F.count(F.lit(1)).alias("links"), F.count_if(F.col("kind") == "exact_duplicate").alias("exact"), F.count_if(F.col("kind") == "near_duplicate").alias("near"))
    return a.join(F.broadcast(b))


def mean_pairwise_distance(df: DataFrame, by: list[str], column: str = "perceptual_hash", bits: int = 64) -> DataFrame:
    """Mean Hamming distance over all pairs, per group, without forming a pair.

    A bit that is set in k of n hashes differs in k * (n - k) pairs, so one aggregate of bit counts gives the exact
    mean at any size; samples aren't needed. Groups of one item are left out.
    """
    held = df.filter(F.col(column).isNotNull())
    words = bits // 64
    ones = []
    for w in range(words):
        value = F.conv(F.substring(column, 16 * w + 1, 16), 16, -10).cast("long")
        ones += [F.sum(F.shiftrightunsigned(value, b).bitwiseAND(F.lit(1).cast("long"))).alias(f"_o{w}_{b}") for b in range(64)]
    sums = held.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *ones)
    apart = sum((F.col(f"_o{w}_{b}").cast("double") * (F.col("n") - F.col(f"_o{w}_{b}")) for w in range(words) for b in range(64)), F.lit(0.0))
    return sums.filter("n >= 2").select(*by, "n", (apart / (F.col("n").cast("double") * (F.col("n") - 1) / 2)).alias("mean_distance"))


def sign_hash(vectors: DataFrame) -> DataFrame:
    """ordinal, label and perceptual_hash of embeddings: a bit for each of 64 components that is positive."""
    bit = F.array_join(F.transform(F.slice("embedding", 1, 64), lambda x: F.when(x > 0, "1").otherwise("0")), "")
    return vectors.select(F.col("vec_id").alias("ordinal"), F.col("label").cast("string").alias("label"), F.lower(F.lpad(F.conv(bit, 2, 16), 16, "0")).alias("perceptual_hash"))


def ranked(df: DataFrame, by: list[str], order: list) -> DataFrame:  # noqa: ANN001
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
