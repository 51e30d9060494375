"""Toxicity by nearest labelled examples.

Examples are TF-IDF vectors over all words that two examples share; words whose presence depends on the label
(chi-square) weigh more by the logarithm of their odds. An inverted index holds them in blocks, with the largest weight
of each term in a block: terms that many examples have as rows of a matrix, all others as lists of places and weights.
A block whose bound can't reach a query's neighbours so far is skipped for that query; the cosines found are exact.
Neighbours vote with the square of their cosine; a logistic curve fitted to votes out of fold, weighted to the true
share of the labels, calibrates the score, and the neighbours are the evidence.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpoint, release, ship
from .langid import fold

_WORD = re.compile(r"[^\W\d_]+")
_LONG = 1 << 22
BLOCK = 512
BATCH = 256


def words_of(text: str | None) -> Counter:
    """How often each word of the whole text occurs, in lower case."""
    said = (text or "").lower()
    return Counter(_WORD.findall(said) if len(said) <= _LONG else (m[0] for m in _WORD.finditer(said)))


@dataclass
class Vectors:
    """Sparse unit vectors, row by row: row, term and weight of each entry, and the number of rows. Examples' weights are rounded to 32 bits."""

    rows: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    n: int


@dataclass
class Block:
    start: int
    n: int
    matrix: np.ndarray  # of the terms that many examples have
    starts: np.ndarray  # where each term's list starts
    places: np.ndarray
    held: np.ndarray


@dataclass
class Model:
    vocabulary: dict[str, int]
    weight: np.ndarray  # of each term
    labels: np.ndarray
    ids: list
    prior: float
    neighbours: int
    slope: float = 1.0
    shift: float = 0.0
    place: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # a term's row in the blocks' matrices, or -1
    bounds: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # terms x blocks: the largest weight
    blocks: list[Block] = field(default_factory=list)

    def unit(self, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int) -> Vectors:
        weights = (1 + np.log(counts)) * self.weight[terms]
        norm = np.sqrt(np.bincount(rows, weights * weights, minlength=n))
        return Vectors(rows, terms, weights / norm[rows] if len(rows) else weights, n)

    def vectors(self, counted: list[dict[str, int]]) -> Vectors:
        """Unit vectors of word counts; words out of the vocabulary are left out."""
        find = self.vocabulary.get
        terms = [np.fromiter(map(find, c, [-1] * len(c)), np.int64, len(c)) for c in counted]
        counts = [np.fromiter(c.values(), np.float64, len(c)) for c in counted]
        rows = np.repeat(np.arange(len(counted)), [len(t) for t in terms])
        terms, counts = np.concatenate(terms or [np.zeros(0, np.int64)]), np.concatenate(counts or [np.zeros(0)])
        known = terms >= 0
        return self.unit(rows[known], terms[known], counts[known], len(counted))

    def index(self, held: Vectors, block: int = BLOCK) -> None:
        """Puts the vectors into blocks, in their order."""
        size, n = len(self.weight), (held.n + block - 1) // block
        often = np.bincount(held.terms, minlength=size) > max(8, held.n // 16)
        self.place = np.where(often, np.cumsum(often) - 1, -1).astype(np.int32)
        self.bounds, self.blocks = np.zeros((size, n), np.float32), []
        for b in range(n):
            at = slice(*np.searchsorted(held.rows, [b * block, (b + 1) * block]).tolist())
            places, terms, weights = (held.rows[at] - b * block).astype(np.int32), held.terms[at], held.weights[at].astype(np.float32)
            width = min(block, held.n - b * block)
            np.maximum.at(self.bounds[:, b], terms, weights)
            matrix = np.zeros((int(often.sum()), width), np.float32)
            dense = often[terms]
            matrix[self.place[terms[dense]], places[dense]] = weights[dense]
            places, terms, weights = places[~dense], terms[~dense], weights[~dense]
            order = np.argsort(terms, kind="stable")
            starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=size))]).astype(np.int32)
            self.blocks.append(Block(b * block, width, matrix, starts, places[order], weights[order]))

    def nearest(self, asked: Vectors, k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Cosines and places of each row's k examples of the largest positive cosine (0 and -1 where there are fewer), never example skip[row]."""
        best, found = np.zeros((asked.n, k)), np.full((asked.n, k), -1, dtype=np.int64)
        if not self.blocks or not len(asked.rows):
            return best, found
        bound = np.zeros((asked.n, len(self.blocks)))
        first = np.flatnonzero(np.diff(asked.rows, prepend=-1))
        bound[asked.rows[first]] = np.add.reduceat(asked.weights[:, None] * self.bounds[asked.terms], first, axis=0)
        place = self.place[asked.terms]
        often = place >= 0
        dense = np.zeros((asked.n, len(self.blocks[0].matrix)))
        dense[asked.rows[often], place[often]] = asked.weights[often]
        rows, terms, weights = asked.rows[~often], asked.terms[~often], asked.weights[~often]
        for b, block in enumerate(self.blocks):
            open_ = (bound[:, b] > 0) & (bound[:, b] * (1 + 1e-9) >= best[:, -1])
            mine = np.flatnonzero(open_)
            if not len(mine):
                continue
            cosines = dense[mine] @ block.matrix.astype(np.float64)
            some = open_[rows]
            low = block.starts[terms[some]].astype(np.int64)
            many = block.starts[terms[some] + 1] - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()) if len(many) else low
            to = np.repeat((np.cumsum(open_) - 1)[rows[some]] * block.n, many) + block.places[at]
            cosines += np.bincount(to, np.repeat(weights[some], many) * block.held[at], minlength=len(mine) * block.n).reshape(cosines.shape)
            if skip is not None:
                own = np.flatnonzero((skip[mine] >= block.start) & (skip[mine] < block.start + block.n))
                cosines[own, skip[mine][own] - block.start] = 0
            both = np.concatenate([best[mine], cosines], axis=1)
            places = np.concatenate([found[mine], np.broadcast_to(np.arange(block.start, block.start + block.n), cosines.shape)], axis=1)
            top = np.argpartition(-both, k - 1, axis=1)[:, :k]
            both, places = np.take_along_axis(both, top, 1), np.take_along_axis(places, top, 1)
            order = np.lexsort((places, -both), axis=1)
            best[mine], found[mine] = np.take_along_axis(both, order, 1), np.take_along_axis(places, order, 1)
        found[best <= 0] = -1
        return best, found

    def vote(self, cosines: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The toxic share of the neighbours by squared cosine, with the prior for a quarter of a perfect neighbour."""
        mass, squares = 0.25, np.where(places >= 0, cosines, 0) ** 2
        up = (squares * (self.labels[places] if len(self.labels) else 0)).sum(axis=1)
        return (up + mass * self.prior) / (squares.sum(axis=1) + mass)

    def calibrated(self, vote: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * vote + self.shift, -50, 50)))


def _learned(words: list[str], rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, toxic: np.ndarray, ids: list, prior: float, neighbours: int, min_chi2: float) -> Model:
    """A model of the examples 0..len(toxic)-1, whose entries (row, term, count) are given; not calibrated yet."""
    n, n1 = len(toxic), toxic.sum()
    n0 = n - n1
    a, both = np.bincount(terms, toxic[rows], minlength=len(words)), np.bincount(terms, minlength=len(words)).astype(float)
    b = both - a
    chi2 = n * (a * (n0 - b) - b * (n1 - a)) ** 2 / np.maximum(1e-9, both * (n - both) * n1 * n0)
    odds = np.abs(np.log((a + 0.5) / (n1 + 1) / ((b + 0.5) / (n0 + 1))))
    kept = both >= 2
    model = Model({w: i for i, w in enumerate(w for w, k in zip(words, kept, strict=True) if k)}, ((np.log((1 + n) / (1 + both)) + 1) * (1 + np.where(chi2 >= min_chi2, odds, 0)))[kept], np.zeros(0), [], prior, neighbours)
    at = np.cumsum(kept) - 1
    use = kept[terms]
    held = model.unit(rows[use], at[terms[use]], counts[use], n)
    # examples with the same leading term lie together, which tightens the blocks' bounds
    leads = np.full(n, -1)
    order = np.lexsort((held.weights, held.rows))
    leads[held.rows[order]] = held.terms[order]
    order = np.lexsort((np.arange(n), leads))
    to = np.empty(n, np.int64)
    to[order] = np.arange(n)
    sort = np.argsort(to[held.rows], kind="stable")
    model.labels, model.ids = toxic[order].astype(float), [ids[i] for i in order]
    model.index(Vectors(to[held.rows][sort], held.terms[sort], held.weights[sort], n))
    return model


def _votes(model: Model, rows: np.ndarray, words: list[str], terms: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    known = np.array([model.vocabulary.get(w, -1) for w in words], dtype=np.int64)[terms]
    use = known >= 0
    votes = np.zeros(n)
    for at in range(0, n, BATCH):
        part = use & (rows >= at) & (rows < at + BATCH)
        asked = model.unit(rows[part] - at, known[part], counts[part], min(BATCH, n - at))
        votes[at : at + BATCH] = model.vote(*model.nearest(asked, model.neighbours))
    return votes


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = 4000, neighbours: int = 15, min_chi2: float = 10.0, seed: int = 11) -> Model | None:
    """Learns from labels (doc_id, toxic); None if no labelled document has a text.

    The sample is bounded: about sample_docs rows, up to a quarter of them toxic, chosen by a hash of doc_id. Labels
    that contradict each other are left out, copies of a text count once, a doc_id with several texts has an example of
    each. Words that only one example has are left out. The curve's votes come from models of the other half of the
    examples. neighbours and min_chi2 were chosen by three folds inside the learning fold, not by held-out rows.
    """
    ship(docs.sparkSession)
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").drop("most")
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    if not sizes:
        return None
    take = {1: sample_docs // 4, 0: sample_docs - sample_docs // 4}
    share = F.when(F.col("toxic") == 1, min(1.0, take[1] / max(1, sizes.get(1, 0)))).otherwise(min(1.0, take[0] / max(1, sizes.get(0, 0))))
    picked = known.filter((F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)) < share).limit(2 * sample_docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                words = [sorted(words_of(t.as_py()).items()) for t in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([[w for w, _ in ws] for ws in words], pa.list_(pa.string())), pa.array([[n for _, n in ws] for ws in words], pa.list_(pa.int32()))], names=["doc_id", "toxic", "words", "counts"])

    # at most 2 * sample_docs ids of two numbers each: small by construction
    texts = docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text")
    counted = texts.mapInArrow(count, "doc_id long, toxic int, words array<string>, counts array<int>")
    sample = checkpoint(counted.groupBy("toxic", "words", "counts").agg(F.min("doc_id").alias("doc_id")).limit(2 * sample_docs))
    held = sample.orderBy("doc_id", "toxic", F.xxhash64("words", "counts")).toArrow().combine_chunks()
    if not held.num_rows:
        return None
    toxic, ids = held.column("toxic").to_numpy().astype(np.int64), held.column("doc_id").to_pylist()
    lists = held.column("words").combine_chunks()
    rows = np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
    coded = pc.dictionary_encode(lists.flatten())
    words, terms = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = held.column("counts").combine_chunks().flatten().to_numpy().astype(float)
    prior = sizes.get(1, 0) / sum(sizes.values())
    half = np.array([zlib.crc32(repr((ws.as_py(), ns.as_py())).encode("utf-8", "surrogatepass")) % 2 for ws, ns in zip(lists, held.column("counts").combine_chunks(), strict=True)])  # copies go together
    del held, lists, coded, sample
    votes = np.full(len(ids), prior)
    for side in (0, 1):
        learn, ask = np.flatnonzero(half != side), np.flatnonzero(half == side)
        if not len(learn) or not len(ask):
            continue
        to = np.cumsum(half != side) - 1
        part = half[rows] != side
        other = _learned(words, to[rows[part]], terms[part], counts[part], toxic[learn], learn.tolist(), prior, neighbours, min_chi2)
        votes[ask] = _votes(other, (np.cumsum(half == side) - 1)[rows[~part]], words, terms[~part], counts[~part], len(ask))
        del other
    model = _learned(words, rows, terms, counts, toxic, ids, prior, neighbours, min_chi2)
    # the sample has more toxic examples than the labels: each side weighs as much as it has of the labels
    up, down = max(1, toxic.sum()) / len(toxic), max(1, (1 - toxic).sum()) / len(toxic)
    model.slope, model.shift = _logistic(votes, toxic.astype(float), np.where(toxic == 1, prior / up, (1 - prior) / down))
    del words, rows, terms, counts, votes
    release(docs.sparkSession)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a weighted logistic curve, with targets drawn in as by Platt and a weak ridge."""
    up, down = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    w, design = np.array([1.0, 0.0]), np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        ridge = np.array([1e-3, 1e-3])
        gradient = design.T @ (weight * (p - target)) + ridge * w
        step = np.linalg.solve(design.T @ (design * (weight * p * (1 - p))[:, None]) + np.diag(ridge), gradient)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _scored(model: Model | None, texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each part of texts: how many rows, scores, and the cosines and places of the nearest examples."""
    for at in range(0, len(texts), BATCH):
        part = texts.slice(at, BATCH)
        if model is None:
            yield len(part), np.zeros(len(part)), np.zeros((len(part), 0)), np.zeros((len(part), 0), np.int64)
            continue
        cosines, places = model.nearest(model.vectors([words_of(t.as_py()) for t in part]), model.neighbours)
        yield len(part), model.calibrated(model.vote(cosines, places)), cosines, places


def judge(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs, all columns as they are, with the score of each text and predicted = 1 from a score of 0.5 on.

    Columns of docs named score or predicted are replaced.
    """
    ship(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.concatenate([s for _, s, _, _ in _scored(model, batch.column(at))] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, schema)


SCORE_SCHEMA = "doc_id long, held_out boolean, score double, predicted int, evidence array<struct<doc_id:long,cosine:double,toxic:int>>"


def score(docs: DataFrame, model: Model | None, evidence: int = 3) -> DataFrame:
    """The score of each whole text of docs (doc_id, text, held_out), with its nearest examples.

    Texts that are null, empty or without a word of the vocabulary get the calibrated prior; without a model, 0.
    Repeated rows are scored each, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        for batch in batches:
            at = 0
            for n, scores, cosines, places in _scored(model, batch.column(1)):
                shown = [[{"doc_id": model.ids[i], "cosine": c, "toxic": int(model.labels[i])} for c, i in zip(cs, ps, strict=True) if i >= 0] for cs, ps in zip(cosines[:, :evidence].tolist(), places[:, :evidence].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), batch.column(2).slice(at, n), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32)), pa.array(shown, struct)], names=["doc_id", "held_out", "score", "predicted", "evidence"])
                at += n

    ship(docs.sparkSession)
    return docs.select("doc_id", "text", "held_out").mapInArrow(run, SCORE_SCHEMA)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: a toxicity score for every text of documents."""
    from .common import table

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").filter(~fold(5, 0)))
    return score(docs.withColumn("held_out", fold(5, 0)), model)
