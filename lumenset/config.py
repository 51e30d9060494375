"""Configuration of a run: defaults, files with includes, environment, overrides; unknown keys are errors."""

from __future__ import annotations

import copy
import json
import os
import posixpath
from collections.abc import Mapping

from pyspark.sql import SparkSession

from .operators.gate import GateRules
from .operators.labels import LabelRules
from .sources import store

PREFIX = "LUMENSET__"

# The defaults that change results.
DEFAULTS: dict = {
    "project": "lumenset",
    "seed": 42,
    "sources": [],
    "discovery": {"root": None, "exclude": [".*", "_*", "*backup*", "*bak", "*tmp*", "*temp*", "*archive*"], "version": "unversioned", "class_depth": 1},
    "output": {"root": None},
    "stages": {"validate": True, "quality": True, "profile": True, "analyse": True, "split": True, "package": False, "reports": True},
    "execution": {"max_images": None, "max_images_per_class": None},
    "corpus": {
        "delimiters": ["___", "__"], "canonical_format": "{crop}___{condition}", "condition_only_format": "{condition}", "lowercase": True, "normalize": True, "crops": [], "infer_crops": True,
        "healthy_terms": ["healthy", "normal", "fresh"], "healthy_label": "healthy", "aliases": {}, "alias_file": None, "include": [], "exclude": [], "minimum_class_size": 1, "first_seen": True, "id_strategy": "path",
    },
    "versioning": {"initial": "1.0.0", "bump": True},
    "validation": {"extensions": [".jpg", ".jpeg", ".png"], "formats": ["jpeg", "png", "mpo"], "modes": [], "min_dimension": 2, "max_pixels": 178_956_970, "max_bytes": None, "decode": True},
    "quality": {
        "blur_min": 80.0, "brightness_min": 25.0, "brightness_max": 235.0, "max_clipped_fraction": None, "contrast_min": 15.0, "min_width": 64, "min_height": 64, "max_width": None, "max_height": None,
        "min_aspect": 0.25, "max_aspect": 4.0, "min_score": 0.35, "warn_score": 0.55, "reject_on_failure": True, "exact_action": "reject", "near_action": "reject",
    },
    "measures": {"longest": 512, "blur": "laplacian", "contrast": "std", "hash": "phash"},
    "duplicates": {"hashes": ["content_hash", "pixel_hash"], "radius": 5, "bits": 64, "keep": "highest_quality", "across_classes": True},
    "profiling": {"bins": 40, "top_classes": 50, "top_resolutions": 25, "rgb_sample": 4000, "rgb_side": 256, "rgb_bins": 64, "include_rejected": False},
    "analysis": {"rare_ratio": 0.25, "min_class_size": 20, "max_imbalance": 10.0, "max_source_share": 0.8},
    "split": {"ratios": [0.70, 0.15, 0.15], "seed": None, "min_samples": 3, "drop_small": True, "group": True},
    "packaging": {"mode": "resize", "width": 224, "height": 224},
}

#: Keys that say where things lie; the location-free fingerprint leaves them out.
PLACES = (("output", "root"), ("discovery", "root"), ("corpus", "alias_file"))


def merged(base: Mapping, more: Mapping, where: str = "") -> dict:
    """base with the values of more; mappings merge key by key. Keys that base lacks are errors, but below empty mappings."""
    out = copy.deepcopy(dict(base))
    for k, v in more.items():
        if k not in out and base:
            raise ValueError(f"unknown key {where}{k}")
        out[k] = merged(out[k], v, f"{where}{k}.") if isinstance(out.get(k), dict) and isinstance(v, Mapping) else copy.deepcopy(v)
    return out


def _file(spark: SparkSession, path: str, seen: tuple[str, ...] = ()) -> dict:
    """A configuration file over the files that it includes, whose names are relative to its own folder."""
    if path in seen:
        raise ValueError(f"{path} includes itself")
    own = store.read_mapping(spark, path)
    out: dict = {}
    for name in own.pop("include", []):
        out = _over(out, _file(spark, name if "://" in name or name.startswith("/") else posixpath.join(posixpath.dirname(path), name), (*seen, path)))
    return _over(out, own)


def _over(a: dict, b: Mapping) -> dict:
    return {**a, **{k: _over(a[k], v) if isinstance(a.get(k), dict) and isinstance(v, Mapping) else v for k, v in b.items()}}


def scalar(text: str):  # noqa: ANN201
    """A value of the environment: JSON where it is any, else the text."""
    try:
        return json.loads(text)
    except ValueError:
        return text


def _nested(pairs: Mapping[str, object], separator: str) -> dict:
    out: dict = {}
    for key, value in pairs.items():
        *path, last = key.split(separator)
        at = out
        for p in path:
            at = at.setdefault(p, {})
        at[last] = value
    return out


def load(spark: SparkSession | None = None, path: str | None = None, overrides: Mapping[str, object] | None = None, environment: Mapping[str, str] | None = None) -> dict:
    """Defaults, then the file, then LUMENSET__A__B variables, then overrides ("a.b": value); the last one wins."""
    given = os.environ if environment is None else environment
    config = merged(DEFAULTS, _file(spark, path) if path else {})
    config = merged(config, _nested({k[len(PREFIX) :].lower(): scalar(v) for k, v in given.items() if k.startswith(PREFIX)}, "__"))
    config = merged(config, _nested(overrides or {}, "."))
    check(config)
    return config


def check(config: Mapping) -> None:
    """Raises ValueError for values that no run can use."""
    ratios = config["split"]["ratios"]
    rules = [
        (len(ratios) == 3 and all(r >= 0 for r in ratios) and abs(sum(ratios) - 1) <= 1e-6, "split.ratios must be three shares that add up to 1"),
        ("{condition}" in config["corpus"]["canonical_format"] and "{condition}" in config["corpus"]["condition_only_format"], "label formats must hold {condition}"),
        (config["quality"]["warn_score"] >= config["quality"]["min_score"], "quality.warn_score must not be under min_score"),
        (config["quality"]["exact_action"] in ("reject", "warn", "keep") and config["quality"]["near_action"] in ("reject", "warn", "keep"), "duplicate actions are reject, warn or keep"),
        (config["duplicates"]["keep"] in ("first", "highest_quality", "largest"), "duplicates.keep is first, highest_quality or largest"),
        (config["packaging"]["mode"] in ("resize", "copy", "link", "none"), "packaging.mode is resize, copy, link or none"),
        (config["corpus"]["id_strategy"] in ("path", "content"), "corpus.id_strategy is path or content"),
        (config["measures"]["blur"] in ("laplacian", "tenengrad") and config["measures"]["contrast"] in ("std", "rms", "michelson") and config["measures"]["hash"] in ("phash", "dhash", "ahash"), "measures: blur is laplacian or tenengrad, contrast std, rms or michelson, hash phash, dhash or ahash"),
        (set(config["duplicates"]["hashes"]) <= {"content_hash", "pixel_hash"}, "duplicates.hashes are content_hash and pixel_hash"),
        (0 <= config["duplicates"]["radius"] < config["duplicates"]["bits"], "duplicates.radius must be under the number of bits"),
    ]
    for holds, message in rules:
        if not holds:
            raise ValueError(message)


def fingerprint(config: Mapping) -> str:
    return store.digest(config)


def location_free_fingerprint(config: Mapping) -> str:
    """Equal for runs that differ only in where things lie."""
    out = copy.deepcopy(dict(config))
    for section, key in PLACES:
        out[section].pop(key, None)
    out["sources"] = [{k: v for k, v in s.items() if k != "path"} for s in out["sources"]]
    return store.digest(out)


def alias_table(spark: SparkSession, config: Mapping) -> dict[str, str]:
    """Aliases of the file, which inline ones override."""
    path = config["corpus"]["alias_file"]
    listed = store.read_mapping(spark, path) if path else {}
    return {str(k): str(v) for k, v in {**listed, **config["corpus"]["aliases"]}.items()}


def label_rules(spark: SparkSession, config: Mapping) -> LabelRules:
    c = config["corpus"]
    named = [s for s in config["sources"] if s.get("enabled", True)]
    return LabelRules(
        delimiters=tuple(c["delimiters"]), canonical_format=c["canonical_format"], condition_only_format=c["condition_only_format"], lowercase=c["lowercase"], normalize=c["normalize"],
        aliases=alias_table(spark, config), overrides={s["name"]: s["overrides"] for s in named if s.get("overrides")}, default_crops={s["name"]: s["default_crop"] for s in named if s.get("default_crop")},
        crops=tuple(c["crops"]), infer_crops=c["infer_crops"], healthy_terms=tuple(c["healthy_terms"]), healthy_label=c["healthy_label"],
    )


def gate_rules(config: Mapping) -> GateRules:
    return GateRules(**config["quality"])
