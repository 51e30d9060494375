"""Near duplicates by SimHash and vantage-point trees.

Distinct fingerprints are dealt to cells by their Hamming distances to a few vantage points. A fingerprint lives in
one cell and queries the cells that its distance plus or minus the radius reaches. Each cell is searched by a tree
that splits again and again by distance to a vantage point of its own and visits, by the triangle inequality, only
bands within the radius. The leaves compare all fingerprints, so the pairs found are exact. Cells return forests
that connect what the pairs connect; components are then formed over all cells.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, ship
from .components import components

LEAF = 1 << 17
_PART = 1 << 16


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """64 bits by majority over the XXH64 hashes (seed 42) of the text's shingles; 0 if it has no word."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and \x20, \x09-\x0D only
    if not words:
        return 0
    digest = functools.partial(xxhash.xxh64_intdigest, seed=42)
    if len(words) < shingle_words:
        return digest(b" ".join(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    return majority(np.fromiter(map(digest, shingles), dtype="<u8", count=len(words) - shingle_words + 1))


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set if it is in over half of the hashes (unsigned 64-bit numbers); 0 for none."""
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _PART):
        part = np.ascontiguousarray(hashes[at : at + _PART], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, th (a hash that tells texts of a doc_id apart) and fp, the fingerprint as a signed long, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))], names=["doc_id", "th", "fp"])

    ship(docs.sparkSession)
    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(run, "doc_id long, th long, fp long")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each value to the least one that the pairs (a, b) connect it with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


class Links:
    """Pairs found in a cell, folded into a forest whenever they become many."""

    def __init__(self, most: int = 500_000):
        self.a, self.b, self.held, self.most = [], [], 0, most

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.held += len(a)
            if self.held > self.most:
                self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.a:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        a, b = forest(np.concatenate(self.a), np.concatenate(self.b))
        self.a, self.b, self.held = [a], [b], len(a)
        self.most = max(self.most, 2 * self.held)
        return a, b


def search(homes: np.ndarray, asking: np.ndarray, radius: int, links: Links, depth: int = 0) -> None:
    """Adds all pairs of a home and an asking fingerprint that differ in 1 to `radius` bits."""
    if not len(homes) or not len(asking):
        return
    if len(homes) * len(asking) <= LEAF or len(homes) < 24 or depth > 24:
        step = max(1, LEAF // len(asking))
        for i in range(0, len(homes), step):
            part = homes[i : i + step]
            x, q = np.nonzero(np.bitwise_count(part[:, None] ^ asking[None, :]) <= radius)
            differ = part[x] != asking[q]
            links.add(part[x][differ], asking[q][differ])
        return
    vantage = homes[len(homes) // 2]
    dh, dq = np.bitwise_count(homes ^ vantage), np.bitwise_count(asking ^ vantage)
    oh, oq = np.argsort(dh, kind="stable"), np.argsort(dq, kind="stable")
    homes, asking, dh, dq = homes[oh], asking[oq], dh[oh].astype(np.int16), dq[oq].astype(np.int16)
    for t in np.unique(dh):
        h = homes[np.searchsorted(dh, t) : np.searchsorted(dh, t, "right")]
        q = asking[np.searchsorted(dq, t - radius) : np.searchsorted(dq, t + radius, "right")]
        search(h, q, radius, links, depth + 1)


def vantage_points(nodes: DataFrame, levels: int) -> list[int]:
    """Fingerprints whose distances to a sample of 256 spread most, the next ones far from those chosen."""
    sample = np.array([r[0] for r in nodes.orderBy(F.xxhash64("fp"), "fp").select("fp").limit(256).collect()], dtype=np.int64).view(np.uint64)
    spread = [float(np.bitwise_count(sample ^ v).std()) for v in sample]
    chosen = [int(np.argmax(spread))]
    while len(chosen) < min(levels, len(sample)):
        apart = [min(min(int(np.bitwise_count(sample[i] ^ sample[c])), 64 - int(np.bitwise_count(sample[i] ^ sample[c]))) for c in chosen) for i in range(len(sample))]
        chosen.append(int(np.argmax(apart)))
    return [int(sample.view(np.int64)[i]) for i in chosen]


def near_links(nodes: DataFrame, radius: int = 4, cell_rows: int = 20_000) -> DataFrame:
    """Links (a, b) that connect all fingerprints of nodes (fp, distinct) at `radius` or fewer differing bits."""
    ship(nodes.sparkSession)
    n = nodes.count()
    levels = min(3, max(1, int(np.ceil(np.log10(max(1, n) / 200_000)))))
    if n < 2:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    points = vantage_points(nodes, levels)
    levels = len(points)
    at = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("int") for p in points]
    homes = nodes.select("fp", *[d.alias(f"c{i}") for i, d in enumerate(at)])
    cells = [f"c{i}" for i in range(levels)]
    # at most 65 ** 3 rows of small numbers, whatever the input
    chunks = homes.groupBy(*cells).agg(F.ceil(F.count(F.lit(1)) / cell_rows).cast("int").alias("chunks"))
    asking = nodes
    for i, d in enumerate(at):  # one direction is enough at the first level: each pair is met from its nearer side
        reach = F.sequence(d if i == 0 else F.greatest(F.lit(0), d - radius), F.least(F.lit(64), d + radius))
        asking = asking.withColumn(f"c{i}", F.explode(reach))
    chunks = F.broadcast(chunks)
    living = homes.join(chunks, cells).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("home", F.lit(True))
    visiting = asking.join(chunks, cells).withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")).withColumn("home", F.lit(False))
    columns = [*cells, "chunk", "home", "fp"]

    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().astype(np.int64).view(np.uint64)
        home = table.column("home").to_numpy().astype(bool)
        links = Links()
        search(np.sort(fps[home]), np.sort(fps[~home]), radius, links)
        a, b = links.fold()
        return pa.table({"a": a.astype(np.uint64).view(np.int64), "b": b.astype(np.uint64).view(np.int64)})

    return living.select(*columns).unionByName(visiting.select(*columns)).groupBy(*cells, "chunk").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 4) -> DataFrame:
    """doc_id, th, fp and component_id, the least doc_id of all documents that links lead to, for each row of docs.

    Null and empty texts have fingerprint 0, like any other; rows with null doc_id take part and never name a
    component that has other rows. An empty table gives no rows.
    """
    fps = checkpoint(fingerprints(docs))
    nodes = checkpoint(fps.groupBy("fp").agg(F.min("doc_id").alias("owner")))
    roots = components(checkpoint(near_links(nodes.select("fp"), radius)))
    labelled = checkpoint(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    named = labelled.groupBy("root").agg(F.min("owner").alias("component_id"))
    return fps.join(labelled.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "th", "fp", "component_id")


def representatives(docs: DataFrame, radius: int = 4, labelled: DataFrame | None = None) -> DataFrame:
    """The rows of docs that stay: of each component the document with the least doc_id (a null one only where no other is).

    Components are those of `labelled` (doc_id, th, component_id), else those of fingerprints within the radius.

    Of several rows with that doc_id in a component, one stays, chosen by a hash of its text. Rows without doc_id form
    a component only with one another; of those one stays.
    """
    rows = (near_duplicates(docs, radius) if labelled is None else labelled).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = rows.groupBy("doc_id", "component_id").agg(F.min("th").alias("__th")).select(F.col("doc_id").alias("__doc"), "__th")
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    kept = keyed.join(stay, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__th")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__key"]).drop("__key")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    """Contract query: fingerprint and component of every document."""
    from .common import table

    out = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
