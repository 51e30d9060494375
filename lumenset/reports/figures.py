"""Figures as tables of data, each with an inline SVG of bars; one that fails doesn't stop the others."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analysis, statistics


def bars(title: str, rows: Sequence[tuple[str, float]], width: int = 640) -> str:
    """Horizontal bars, labelled, longest value over the whole width."""
    top = max((abs(v or 0) for _, v in rows), default=0) or 1
    out = [f'<text x="4" y="16" font-weight="bold">{escape(title)}</text>']
    for i, (name, value) in enumerate(rows):
        y = 28 + 18 * i
        out.append(f'<text x="4" y="{y + 12}">{escape(str(name))[:40]}</text><rect x="240" y="{y}" width="{(width - 320) * abs(value or 0) / top:.1f}" height="14" fill="#48c"/><text x="{width - 70}" y="{y + 12}">{value or 0:.4g}</text>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{36 + 18 * len(rows)}" font-family="sans-serif" font-size="12">{"".join(out)}</svg>'


def tables(df: DataFrame, found: DataFrame | None = None) -> dict[str, Callable[[], DataFrame]]:
    """The figures' data by name, each a frame of (name, value), made when called."""
    kept = df.filter("status = 'accepted'") if "status" in df.columns else df
    pair = lambda f, name, value: f.select(F.col(name).cast("string").alias("name"), F.col(value).cast("double").alias("value"))
    histogram = lambda c: pair(statistics.histogram(kept, c).orderBy("bin"), "lo", "count")
    out = {
        "class_distribution": lambda: pair(analysis.class_counts(kept).orderBy(F.desc("images"), "label").limit(50), "label", "images"),
        "source_distribution": lambda: pair(analysis.source_shares(kept).orderBy(F.desc("images")).limit(50), "dataset_name", "share"),
        "quality_scores": lambda: histogram("quality_score"),
        "resolutions": lambda: pair(statistics.resolution_distribution(kept), "resolution", "count"),
        "cumulative_share": lambda: pair(statistics.cumulative_shares(analysis.class_counts(kept)).orderBy("place").limit(200), "label", "cumulative_share"),
        "rejections": lambda: pair(df.filter("rejection_code is not null").groupBy("rejection_code").agg(F.count(F.lit(1)).alias("images")).orderBy(F.desc("images")), "rejection_code", "images"),
        "cluster_sizes": lambda: pair(statistics.cluster_sizes(df).orderBy("size"), "size", "clusters"),
    }
    if found is not None:
        out["findings"] = lambda: pair(found.orderBy("key"), "key", "value_num")
    return out


def render(df: DataFrame, found: DataFrame | None = None, most: int = 500) -> tuple[dict[str, str], dict[str, str]]:
    """SVG by figure, and the message of each figure that failed."""
    drawn, failed = {}, {}
    for name, make in tables(df, found).items():
        try:
            drawn[name] = bars(name.replace("_", " "), [tuple(r) for r in make().limit(most).collect()])
        except Exception as e:  # noqa: BLE001  a figure is no reason to fail a run
            failed[name] = str(e).splitlines()[0][:300]
    return drawn, failed
