"""What a corpus is made of, as hashes, and the version that follows from a change."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import digest
from .corpus import composition_hash, identities


def mapping_hash(labels: DataFrame) -> str:
    """The digest of label -> class index; there are as many rows as classes."""
    return digest({r["label"]: r["class_index"] for r in labels.select("label", "class_index").collect()})


def source_hash(items: DataFrame) -> str:
    """The digest of the sources' names and versions."""
    rows = items.select("dataset_name", "dataset_version").distinct().collect()
    return digest(sorted((r[0] or "", r[1] or "") for r in rows))


def fingerprint(items: DataFrame, labels: DataFrame, config_hash: str) -> dict[str, str]:
    """The four component hashes and the digest over them."""
    parts = {"composition": composition_hash(items), "labels": mapping_hash(labels), "sources": source_hash(items), "config": config_hash}
    return {**parts, "fingerprint": digest(parts)}


def composition_buckets(items: DataFrame) -> DataFrame:
    """bucket, items, and the sum of part of the identities' digests: what a corpus is made of, comparable bucket by bucket."""
    rows = identities(items).select(F.sha2("identity", 256).alias("h"))
    return rows.groupBy(F.substring("h", 1, 2).alias("bucket")).agg(F.count(F.lit(1)).alias("items"), F.sum(F.conv(F.substring("h", 3, 8), 16, 10).cast("long")).alias("digest"))


def bump(version: str, part: str) -> str:
    """The next semantic version: major, minor or patch goes up by one and the parts after it go to 0."""
    core = version.split("-")[0].split("+")[0].split(".")
    if len(core) != 3 or not all(x.isdigit() for x in core):
        raise ValueError(f"{version} is not a semantic version")
    numbers = [int(x) for x in core]
    at = ("major", "minor", "patch").index(part)
    return ".".join(str(n + 1 if i == at else 0 if i > at else n) for i, n in enumerate(numbers))


def resolve_version(current: Mapping[str, str], previous: Mapping[str, str] | None, initial: str = "1.0.0", bumps: bool = True) -> tuple[str, str]:
    """(version, reason) of a corpus from its fingerprint and the last one's, which holds its `version` too.

    The first corpus has the initial version; other labels raise the minor part, another composition the patch.
    """
    if not previous or not previous.get("version"):
        return initial, "initial"
    version = previous["version"]
    if previous.get("fingerprint") == current["fingerprint"] or not bumps:
        return version, "unchanged"
    if previous.get("labels") != current["labels"]:
        return bump(version, "minor"), "labels_changed"
    if previous.get("composition") != current["composition"]:
        return bump(version, "patch"), "composition_changed"
    return version, "unchanged"
