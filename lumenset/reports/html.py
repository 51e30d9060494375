"""Self-contained HTML pages of small tables. Rows are given by the caller, who bounds them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analysis, findings, gate, statistics

STYLE = "body{font:14px sans-serif;margin:2em;max-width:72em}table{border-collapse:collapse;margin:1em 0}td,th{border:1px solid #ccc;padding:.2em .6em;text-align:left}.ok{color:#070}.warning{color:#a60}.critical{color:#b00}"


def cell(value: object) -> str:
    return escape(f"{value:.6g}" if isinstance(value, float) else "" if value is None else str(value))


def table(columns: Sequence[str], rows: Sequence[Sequence]) -> str:
    head = "".join(f"<th>{escape(c)}</th>" for c in columns)
    body = "".join("<tr>" + "".join(f'<td class="{cell(v)}">{cell(v)}</td>' if v in ("ok", "warning", "critical") else f"<td>{cell(v)}</td>" for v in row) + "</tr>" for row in rows)
    return f"<table><tr>{head}</tr>{body}</table>" if rows else "<p>none</p>"


def frame(df: DataFrame, most: int = 1000) -> str:
    """A frame's first `most` rows in its order, and how many there are where that isn't all."""
    rows = df.limit(most + 1).collect()
    note = f"<p>the first {most} rows</p>" if len(rows) > most else ""
    return table(df.columns, [tuple(r) for r in rows[:most]]) + note


def page(title: str, sections: Mapping[str, str]) -> str:
    body = "".join(f"<h2>{escape(name)}</h2>{content}" for name, content in sections.items())
    return f'<!doctype html><html><head><meta charset="utf-8"><title>{escape(title)}</title><style>{STYLE}</style></head><body><h1>{escape(title)}</h1>{body}</body></html>'


def quality_page(df: DataFrame, report: DataFrame, top: int = 25) -> str:
    """The gate's outcome: totals, grades, rejections, and the largest duplicate groups."""
    groups = df.filter("duplicate_group is not null").groupBy("duplicate_group").agg(F.count(F.lit(1)).alias("images"), F.count_if(F.col("status") == "accepted").alias("retained"))
    return page("Quality", {
        "Totals": frame(gate.quality_report(df)), "Grades": frame(gate.grade_counts(df).orderBy("quality_grade", "action")),
        "Rejections": frame(df.filter("rejection_code is not null").groupBy("rejection_code").agg(F.count(F.lit(1)).alias("images")).orderBy(F.desc("images"), "rejection_code")),
        "Duplicates": frame(report), f"The {top} largest groups": frame(groups.orderBy(F.desc("images"), "duplicate_group").limit(top)),
    })


def profile_page(df: DataFrame, channels: Sequence[Mapping] = ()) -> str:
    """Totals, summaries and distributions of the manifest."""
    sections = {
        "Totals": frame(statistics.totals(df)), "Numbers": frame(statistics.numeric_summary(df).orderBy("name")), "Categories": frame(statistics.categorical_summary(df).orderBy("name")),
        "Classes": frame(statistics.class_distribution(df).orderBy("rank")), "Sources": frame(statistics.source_distribution(df).orderBy("dataset_name")), "Resolutions": frame(statistics.resolution_distribution(df)),
    }
    if channels:
        sections["Channels"] = table(["channel", "pixels", "mean", "std"], [[r["channel"], r["pixels"], r["mean"], r["std"]] for r in channels])
    return page("Profile", sections)


def analysis_page(df: DataFrame, found: DataFrame) -> str:
    """Findings by area, the score, and the clusters that may leak."""
    clusters = analysis.leakage_clusters(df)
    return page("Analysis", {
        "Areas": frame(findings.worst(found).orderBy("area")), "Findings": frame(found.orderBy("key")), "Score": frame(analysis.dataset_score(df)),
        "Clusters at risk": frame(clusters.filter("risk <> 'contained'").orderBy(F.desc("group_size"), "group_id").limit(100)),
    })
