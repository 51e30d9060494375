"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed byte bigrams and trigrams; each language has a few clustered
centroids, and the language of the nearest one by cosine wins. A text farther from it than nearly all training
texts of that language were is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship

DIMS_BITS = 12
DIMS = 1 << DIMS_BITS
_FOLD = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], dtype=np.uint32)
_LETTER = re.compile(r"[^\W\d_]")
_PART = 1 << 20


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of the whole text, taken in parts of a megabyte so that memory stays bounded."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass") + b" ", dtype=np.uint8)
    out = np.zeros(DIMS, dtype=np.int64)
    for at in range(0, max(1, len(data) - 2), _PART):
        x = _FOLD[data[at : at + _PART + 2]]
        two = (x[:-1] << np.uint32(8)) | x[1:]
        three = (two[:-1] << np.uint32(8)) | x[2:]
        for grams in ((two[: len(three)] | np.uint32(0xFF000000)), three):
            out += np.bincount((grams * np.uint32(2654435761)) >> np.uint32(32 - DIMS_BITS), minlength=DIMS)
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # row by row
    owner: np.ndarray  # the language of each centroid
    farthest: np.ndarray  # cosine distance up to which a text counts as of the centroid's language

    def vectors(self, term_counts: np.ndarray) -> np.ndarray:
        x = np.log1p(term_counts).astype(np.float32) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def predict(self, term_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score, cosine, rejected; the score is a softmax over each language's best cosine."""
        cosines = self.vectors(term_counts) @ self.centroids.T
        best = np.stack([cosines[:, self.owner == k].max(axis=1) for k in range(len(self.languages))], axis=1)
        chosen = best.argmax(axis=1)
        top = best.max(axis=1)
        score = 1.0 / np.exp((best - top[:, None]) / 0.02).sum(axis=1)
        nearest = np.where(self.owner[None, :] == chosen[:, None], cosines, -2).argmax(axis=1)
        return chosen, score, top, 1 - top > self.farthest[nearest]


def cluster(x: np.ndarray, k: int, seed: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means centroids of unit rows, started far apart."""
    rng = np.random.default_rng(seed)
    at = [int(rng.integers(len(x)))]
    while len(at) < min(k, len(x)):
        at.append(int((x @ x[at].T).max(axis=1).argmin()))
    c = x[at]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(docs: DataFrame, learn: Column, sample_docs: int = 2000, centroids: int = 4, seed: int = 7) -> Model | None:
    """Learns from text and lang of the rows where `learn` holds; None if there are no such rows.

    At most sample_docs rows are used, or four a language where that is more, in equal numbers per language, chosen by
    a hash of doc_id and text: this is the documented bound of the classifier's training sample, and no language is left
    out of it. Rows that repeat count once. Null languages and texts without letters are left out.
    """
    ship(docs.sparkSession)
    usable = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    sizes = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return None
    each = max(4, sample_docs // len(sizes))
    # four times as many are drawn as are kept, so that a draw that is short of rows is out of the question
    share = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, 4 * each / n))])
    hashed = usable.select("lang", "text", F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 40)).alias("h"))
    drawn = hashed.filter(F.col("h") / float(1 << 40) < share[F.col("lang")]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    picked = drawn.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("place") <= each)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([counts(t.as_py()).astype(np.uint32).tobytes() for t in batch.column(1)], pa.binary())], names=["lang", "counts"])

    rows = picked.select("lang", "text").mapInArrow(measure, "lang string, counts binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r[0], bytes(r[1])))
    term_counts = np.stack([np.frombuffer(r[1], np.uint32) for r in rows])
    present = (term_counts > 0).sum(axis=0)
    idf = (np.log((1 + len(rows)) / (1 + present)) + 1).astype(np.float32)
    model = Model(sorted({r[0] for r in rows}), idf, np.empty(0), np.empty(0), np.empty(0))
    x, langs = model.vectors(term_counts), np.array([r[0] for r in rows])
    found, owner, farthest = [], [], []
    for k, lang in enumerate(model.languages):
        own = x[langs == lang]
        c = cluster(own, centroids, seed)
        cosines = own @ c.T
        near = cosines.argmax(axis=1)
        for j in range(len(c)):
            d = 1 - cosines[near == j, j]
            farthest.append(min(1.0, 1.25 * float(np.quantile(d, 0.99)) + 0.05) if len(d) else 0.0)
        found.append(c)
        owner += [k] * len(c)
    model.centroids, model.owner, model.farthest = np.concatenate(found).astype(np.float32), np.array(owner), np.array(farthest)
    return model


LANGUAGE_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, cosine double, rejected boolean"


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """The language of each whole text of docs (doc_id, text, held_out): one row for each, repeated rows included.

    `und` with score 0 for null texts and texts without letters, or if nothing was learned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column(1)
                lettered = [i for i in range(batch.num_rows) if model is not None and has_letter(texts[i].as_py())]
                n = batch.num_rows
                lang, score, cosine, rejected = ["und"] * n, [0.0] * n, [0.0] * n, [True] * n
                if lettered:
                    chosen, s, c, r = model.predict(np.stack([counts(texts[i].as_py()) for i in lettered]))
                    for i, k, a, b, far in zip(lettered, chosen, s, c, r, strict=True):
                        lang[i], score[i], cosine[i], rejected[i] = model.languages[k], min(1.0, float(a)), float(b), bool(far)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lang), pa.array(score), pa.array(cosine), pa.array(rejected)], names=[x.split()[0] for x in LANGUAGE_SCHEMA.split(", ")])

    ship(docs.sparkSession)
    return docs.select("doc_id", "text", "held_out").mapInArrow(run, LANGUAGE_SCHEMA)


def fold(modulus: int, kept: int) -> Column:
    """Whether crc32 of doc_id as text leaves `kept`; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == kept, F.lit(False))


def op1_language(spark, sf_dir: str) -> DataFrame:
    """Contract query: the language of every text of documents."""
    from .common import table

    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = fit(docs, F.col("doc_id").isNotNull() & ~fold(3, 1))
    return identify(docs.withColumn("held_out", fold(3, 1)), model)
