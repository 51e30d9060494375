"""Approximate nearest neighbours by inverted lists and an adaptive scan over dimensions.

Unit vectors are turned by a random rotation, so that any first m dimensions tell about the whole distance. Each
probed list is scanned in blocks of columns; after each block a hypothesis test compares the partial distances with
the best found so far and abandons candidates that are very likely too far. What survives is scored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, ship

COLUMNS = 16


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id and v (array of double) of the vectors that take part: not null, no null or non-finite component, not zero, and with an id.

    Vectors of other than the most common length are left out by `neighbours`. Other columns are not read.
    """
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.filter(F.col(id_column).isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)).select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"))
    return kept


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means over unit rows."""
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), size=min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        near = (sample @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), c)
    return c


def scan(columns: list[np.ndarray], at: np.ndarray, query: np.ndarray, k: int, trust: float) -> np.ndarray:
    """Those of the places `at` that survive: all that the tests don't show to be farther than the k-th best of them.

    columns: the rotated candidates in blocks of COLUMNS dimensions, dimension by dimension. query: rotated.
    """
    if len(at) <= 4 * k:
        return at
    dims = len(query)
    partial = ((columns[0][:, at] - query[: len(columns[0]), None]) ** 2).sum(axis=0)
    seeds = at[np.argpartition(partial, 4 * k - 1)[: 4 * k]]
    done, full = 0, np.zeros(len(seeds))
    for block in columns:
        full += ((block[:, seeds] - query[done : done + len(block), None]) ** 2).sum(axis=0)
        done += len(block)
    limit = np.partition(full, k - 1)[k - 1] * (1 + 1e-9) + 1e-12
    done = len(columns[0])
    for block in columns[1:]:
        keep = np.flatnonzero(partial <= limit * done / dims * (1 + trust / np.sqrt(done)) ** 2)
        at = at[keep]
        partial = partial[keep] + ((block[:, at] - query[done : done + len(block), None]) ** 2).sum(axis=0)
        done += len(block)
    return at[partial <= limit]


def _once(ids: np.ndarray, given: np.ndarray) -> np.ndarray:
    """Places of the rows that differ from all earlier ones in id or vector."""
    order = np.argsort(ids, kind="stable")
    same = ids[order][1:] == ids[order][:-1]
    if not same.any():
        return np.arange(len(ids))
    seen, stay = set(), []
    for i, (vec_id, row) in enumerate(zip(ids.tolist(), given, strict=True)):
        key = (vec_id, row.tobytes())
        if key not in seen:
            seen.add(key)
            stay.append(i)
    return np.array(stay)


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, sample_rows: int = 20_000, lists: int | None = None, probes: float = 0.65, least_probes: int = 24, cell_rows: int = 4096, trust: float = 2.1, seed: int = 3) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest by cosine, ties to the smaller vec_id.

    vectors and queries (vec_id, v) as `usable` gives them; a query's own vec_id is no candidate. Every vector is in
    the index. Rows with the same vec_id are one item: equal ones count once, and of different vectors of an item, or
    of a query, the nearest counts, so that no vec_id comes twice in a query's result. An empty table gives no rows.

    The lists' centres are fitted to about sample_rows vectors, chosen by a hash of the id; that bound is the index's
    only sample. Each query probes the share `probes` of the lists: vectors without clusters, like random ones, need
    about half of them for a recall of 0.9 (measured: 0.5 gives 0.92 to 0.94, 0.65 about 0.97). Neighbouring lists lie
    together in a cell of about cell_rows vectors, which a query is sent to once with the lists that it probes there;
    longer lists are cut into several cells and queries into chunks of as many, so a list that holds a third of all
    vectors is scanned by many tasks. The score is computed in double precision from the vectors as given.
    """
    ship(vectors.sparkSession)
    sizes = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = sizes[0]
    vectors, queries = vectors.filter(F.size("v") == dims), queries.filter(F.size("v") == dims)
    n = sizes[1]
    share = min(1.0, sample_rows / n)
    part = vectors.filter(F.pmod(F.xxhash64(F.col("vec_id"), F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).limit(2 * sample_rows).toArrow()
    sample = unit(_matrix(part.column("v"))) if part.num_rows else np.eye(1, dims)
    sample = sample[np.lexsort(sample.T[::-1])]
    lists = lists or int(min(2048, max(1, np.sqrt(n))))
    centres = centroids(sample, lists, seed)
    centres = centres[np.argsort(centres @ centres[0], kind="stable")]
    turn = rotation(dims, seed)
    probed = int(min(len(centres), max(least_probes, np.ceil(probes * len(centres)))))

    def assign(batches):  # noqa: ANN001, ANN202
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                near = (unit(_matrix(batch.column(1))) @ centres.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], names=["vec_id", "v", "list"])

    index = checkpoint(vectors.mapInArrow(assign, "vec_id long, v array<double>, list int"))
    # a number a list, and there are at most 2048 unless `lists` says otherwise
    held = {r["list"]: r["count"] for r in index.groupBy("list").count().collect()}
    group, cells, filled = np.full(len(centres), -1), [], cell_rows
    for i in range(len(centres)):
        if not held.get(i):
            continue
        if filled + held[i] > cell_rows:
            cells.append(0)
            filled = 0
        group[i], filled = len(cells) - 1, filled + held[i]
        cells[-1] = max(1, -(-filled // cell_rows))
    cells = np.array(cells)
    chunks = max(1, -(-queries.count() // cell_rows))

    def ask(batches):  # noqa: ANN001, ANN202
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                cosines = unit(_matrix(batch.column(1))) @ centres.T
                near = np.zeros(cosines.shape, dtype=bool)
                np.put_along_axis(near, np.argpartition(-cosines, probed - 1, axis=1)[:, :probed], True, axis=1)
                rows, found, wanted = [], [], []
                for i, mine in enumerate(near):
                    for g in np.unique(group[mine & (group >= 0)]):
                        rows.append(i)
                        found.append(g)
                        wanted.append(np.flatnonzero(mine & (group == g)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), batch.column(1).take(pa.array(rows, pa.int64())), pa.array(found, pa.int32()), pa.array(wanted, pa.list_(pa.int32()))], names=["vec_id", "v", "group", "lists"])

    deal = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")
    of_list = F.array(*[F.lit(int(g)) for g in group])
    in_group = F.array(*[F.lit(int(c)) for c in cells])
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = index.withColumn("group", F.get(of_list, F.col("list"))).withColumn("cell", deal(F.get(in_group, F.col("group")))).withColumn("chunk", every(F.lit(chunks))).select("group", "cell", "chunk", "list", "vec_id", "v")
    asked = queries.mapInArrow(ask, "vec_id long, v array<double>, group int, lists array<int>")
    right = asked.withColumn("chunk", deal(F.lit(chunks))).withColumn("cell", every(F.get(in_group, F.col("group")))).select("group", "cell", "chunk", "lists", "vec_id", "v")

    def run(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if candidates.num_rows and asking.num_rows:
            ids, given, lies = candidates.column("vec_id").to_numpy(), _matrix(candidates.column("v")), candidates.column("list").to_numpy()
            stay = _once(ids, given)
            ids, given, lies = ids[stay], given[stay], lies[stay]
            most = int(np.unique(ids, return_counts=True)[1].max())
            lengths = np.sqrt((given * given).sum(axis=1))
            turned = np.ascontiguousarray(((given / lengths[:, None]) @ turn).T)
            columns = [turned[c : c + COLUMNS] for c in range(0, dims, COLUMNS)]
            asked_ids, asked_given = asking.column("vec_id").to_numpy(), _matrix(asking.column("v"))
            wanted = asking.column("lists").to_pylist()
            first = _once(asked_ids, asked_given)
            asked_turned = unit(asked_given) @ turn
            for i in first:
                q, given_q = asked_ids[i], asked_given[i]
                at = np.flatnonzero(np.isin(lies, wanted[i]))
                found = scan(columns, at, asked_turned[i], (k + 1) * most, trust)  # one more: the query itself may be among them
                found = found[ids[found] != q]
                scores = (given[found] * given_q[None, :]).sum(axis=1) / (lengths[found] * np.sqrt((given_q * given_q).sum()))
                order = np.lexsort((ids[found], -scores))
                best = order[np.sort(np.unique(ids[found][order], return_index=True)[1])[:k]]
                out[0].append(np.full(len(best), q))
                out[1].append(ids[found][best])
                out[2].append(scores[best])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"query_id": join(out[0], np.int64).astype(np.int64), "vec_id": join(out[1], np.int64).astype(np.int64), "score": join(out[2], np.float64).astype(np.float64)})

    keys = ["group", "cell", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_ann(spark, sf_dir: str) -> DataFrame:
    """Contract query: the five nearest of every vector whose vec_id is divisible by 50."""
    from .common import table

    vectors = usable(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return neighbours(vectors, vectors.filter("vec_id % 50 = 0"))
