"""Scalar functions as column expressions; all stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Between the parts of a stable id.
SEPARATOR = "\x1f"


def as_column(x) -> Column:  # noqa: ANN001
    return x if isinstance(x, Column) else F.col(x)


def slug(x: Column, fallback: str = "unknown") -> Column:
    """The label form of ASCII text: lower case, words joined by single underscores, never empty.

    Text with other letters needs its marks taken off first: see labels.with_slugs, which does so once a distinct label.
    """
    s = F.lower(F.trim(x))
    s = F.regexp_replace(s, r"[\s\-/\\.]+", "_")
    s = F.regexp_replace(s, r"[^a-z0-9_]+", "_")
    s = F.regexp_replace(s, r"_+", "_")
    s = F.regexp_replace(s, r"^_+|_+$", "")
    return F.when(x.isNull() | (s == ""), F.lit(fallback)).otherwise(s)


def stable_id(*parts: Column, length: int = 16) -> Column:
    """The first digits of a SHA-1 over the parts."""
    return F.substring(F.sha1(F.concat_ws(SEPARATOR, *[p.cast("string") for p in parts])), 1, length)


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), x))


def ratio(value: Column, reference: float) -> Column:
    """value over reference within [0, 1]; 0 where the reference isn't positive."""
    return F.when(value.isNull(), None).otherwise(clamp(value / F.lit(float(reference))) if reference > 0 else F.lit(0.0))


def brightness_score(mean: Column, low: float, high: float) -> Column:
    """1 inside [low, high], falling in a line to 0 at black and white."""
    dark = F.greatest(F.lit(0.0), mean / low) if low > 0 else F.lit(0.0)
    light = F.greatest(F.lit(0.0), (255.0 - mean) / (255.0 - high)) if high < 255 else F.lit(0.0)
    return F.when(mean.isNull(), None).when(mean.between(low, high), 1.0).when(mean < low, dark).otherwise(light)


def grade(score: Column, thresholds: dict[str, float], fallback: str) -> Column:
    """The grade with the highest threshold that the score reaches."""
    out = F.when(score.isNull(), fallback)
    for name, least in sorted(thresholds.items(), key=lambda x: -x[1]):
        out = out.when(score >= least, name)
    return out.otherwise(fallback)


def weighted_score(components: dict[str, Column], weights: dict[str, float]) -> Column:
    """Mean of the measured components by weight, to six places; 0 if none is measured."""
    used = [(components[k], float(w)) for k, w in weights.items() if k in components]
    if not used:
        return F.lit(0.0)
    top = sum((F.coalesce(c * w, F.lit(0.0)) for c, w in used[1:]), F.coalesce(used[0][0] * used[0][1], F.lit(0.0)))
    bottom = sum((F.when(c.isNotNull(), w).otherwise(0.0) for c, w in used[1:]), F.when(used[0][0].isNotNull(), used[0][1]).otherwise(0.0))
    return F.coalesce(F.round(F.try_divide(top, bottom), 6), F.lit(0.0))


def hash_words(hex_hash: Column, words: int = 1) -> list[Column]:
    """A hexadecimal hash as signed 64-bit words."""
    return [F.conv(F.substring(hex_hash, 16 * i + 1, 16), 16, -10).cast("long") for i in range(words)]


def hamming(a: Column, b: Column, words: int = 1) -> Column:
    """Differing bits of two hexadecimal hashes of words * 16 digits; null if either is."""
    pairs = list(zip(hash_words(a, words), hash_words(b, words), strict=True))
    out = F.bit_count(pairs[0][0].bitwiseXOR(pairs[0][1]))
    for x, y in pairs[1:]:
        out = out + F.bit_count(x.bitwiseXOR(y))
    return out.cast("int")


def to_hex(word: Column, digits: int = 16) -> Column:
    return F.lpad(F.lower(F.hex(word)), digits, "0")


def blank(x: Column) -> Column:
    return x.isNull() | (F.trim(x) == "")


def is_timestamp(x: Column) -> Column:
    return F.coalesce(x.try_cast("timestamp").isNotNull(), F.lit(False))


def blur_confidence(score: Column, threshold: float) -> Column:
    return F.lit(1.0) if threshold <= 0 else F.least(F.lit(1.0), F.abs(score - threshold) / threshold)


def status(healthy: Column, tolerable: Column) -> Column:
    """The three states of a metric."""
    return F.when(healthy, "ok").when(tolerable, "warning").otherwise("critical")
