"""Queries of the pixel kernels, over the embeddings as small images, with SQL that does the same arithmetic."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from ..cluster import ship
from ..functions import kernels
from .catalogue import query, read

SCHEMA = "vec_id long, brightness double, shadow double, highlight double, std double, michelson double, rms double, entropy double, laplacian double, tenengrad double, colourfulness double, average_hash string, small string"

#: An image of 8 x 8 pixels: the first 64 components scaled to bytes between the least and the largest of them.
_PIXELS = """px AS (SELECT vec_id, list_transform(e, lambda x: floor((x - list_min(e)) / (list_max(e) - list_min(e)) * 255)::BIGINT) AS v FROM (SELECT vec_id, list_transform(embedding[1:64], lambda x: x::DOUBLE) AS e FROM embeddings)),
 pt AS (SELECT vec_id, v, i // 8 AS r, i % 8 AS c FROM px, range(64) t(i)),
 nb AS (SELECT vec_id, r, c, v[r * 8 + c + 1] AS x, CASE r WHEN 0 THEN 1 ELSE r - 1 END AS u, CASE r WHEN 7 THEN 6 ELSE r + 1 END AS d, CASE c WHEN 0 THEN 1 ELSE c - 1 END AS l, CASE c WHEN 7 THEN 6 ELSE c + 1 END AS q, v FROM pt),
 g AS (SELECT vec_id, r, c, x, v[u * 8 + c + 1] + v[d * 8 + c + 1] + v[r * 8 + l + 1] + v[r * 8 + q + 1] - 4 * x AS lap,
 v[u * 8 + q + 1] + 2 * v[r * 8 + q + 1] + v[d * 8 + q + 1] - v[u * 8 + l + 1] - 2 * v[r * 8 + l + 1] - v[d * 8 + l + 1] AS gx, v[d * 8 + l + 1] + 2 * v[d * 8 + c + 1] + v[d * 8 + q + 1] - v[u * 8 + l + 1] - 2 * v[u * 8 + c + 1] - v[u * 8 + q + 1] AS gy,
 v[64 - r * 8 - c] AS mirrored, avg(x) OVER (PARTITION BY vec_id) AS mean FROM nb),
 en AS (SELECT vec_id, -sum(n / 64.0::DOUBLE * log2(n / 64.0::DOUBLE)) AS entropy FROM (SELECT vec_id, x, count(*) AS n FROM g GROUP BY vec_id, x) GROUP BY vec_id),
 sm AS (SELECT vec_id, string_agg(p::VARCHAR, ' ' ORDER BY r, c) AS small FROM (SELECT vec_id, r // 2 AS r, c // 2 AS c, round_even(avg(x), 0)::BIGINT AS p FROM g GROUP BY 1, 2, 3) GROUP BY vec_id)"""


def measured(data: list[float]) -> tuple:
    import numpy as np

    e = np.asarray(data[:64], dtype=np.float64)
    luma = np.floor((e - e.min()) / (e.max() - e.min()) * 255).astype(np.uint8).reshape(8, 8)
    rgb = np.stack([luma, luma.reshape(-1)[::-1].reshape(8, 8), np.zeros_like(luma)], axis=2)
    small = kernels.downscale(np.repeat(luma[..., None], 3, axis=2), 4)[..., 0]
    return (float(luma.mean()), float((luma <= 16).mean()), float((luma >= 240).mean()), kernels.contrast(luma), kernels.contrast(luma, "michelson"), kernels.contrast(luma, "rms"), kernels.entropy(luma), kernels.laplacian_variance(luma), kernels.tenengrad(luma), kernels.colourfulness(rgb), kernels.average_hash(luma), " ".join(map(str, small.reshape(-1).tolist())))


@query(f"""WITH {_PIXELS} SELECT g.vec_id, round(avg(x), 6) AS brightness, round(count(*) FILTER (x <= 16) / 64.0::DOUBLE, 6) AS shadow, round(count(*) FILTER (x >= 240) / 64.0::DOUBLE, 6) AS highlight, round(stddev_pop(x), 6) AS std,
 round(CASE WHEN max(x) + min(x) > 0 THEN (max(x) - min(x))::DOUBLE / (max(x) + min(x)) * 255 ELSE 0 END, 6) AS michelson, round(stddev_pop(x), 6) AS rms, round(first(entropy), 6) AS entropy, round(var_pop(lap), 6) AS laplacian, round(avg(gx * gx + gy * gy), 6) AS tenengrad,
 round(sqrt(var_pop(x - mirrored) + var_pop((x + mirrored) / 2.0::DOUBLE)) + 0.3::DOUBLE * sqrt(pow(avg(x - mirrored), 2) + pow(avg((x + mirrored) / 2.0::DOUBLE), 2)), 6) AS colourfulness,
 printf('%08x', sum(CASE WHEN x > mean AND r < 4 THEN 1::BIGINT << (31 - r * 8 - c)::INTEGER ELSE 0 END)::BIGINT) || printf('%08x', sum(CASE WHEN x > mean AND r >= 4 THEN 1::BIGINT << (63 - r * 8 - c)::INTEGER ELSE 0 END)::BIGINT) AS average_hash, first(small) AS small
 FROM g JOIN en USING (vec_id) JOIN sm USING (vec_id) GROUP BY g.vec_id""")
def image_measures(spark, sf_dir):  # noqa: ANN001, ANN201
    """One array a row, all measures of it."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows = [(i, *measured(v)) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)

    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, SCHEMA)
