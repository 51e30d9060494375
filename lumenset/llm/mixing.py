"""Mixing: raking of token weights to source, language and topic marginals, then sampling by calibrated probabilities.

Tokens are counted per (source, language, topic) cell; iterative proportional fitting scales the cells until their
sums over each attribute meet that attribute's target shares. A document's probability is its cell's weight, scaled
so that the most wanted cell is kept whole, and a hash of the document decides whether it stays.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, ship, sized

MARGINS = ("source", "lang", "topic")
TOPICS = 8


_WORDS = re.compile("[^ \t\r\n]+").findall


class _Groups(dict):
    """The group of a word: its first and last code points and its length, added, modulo TOPICS."""

    def __missing__(self, word: str) -> int:
        if len(self) > 50_000:
            self.clear()
        out = self[word] = (ord(word[0]) + ord(word[-1]) + len(word)) % TOPICS
        return out


_groups = _Groups()


def said(texts: pa.Array) -> pa.Array:
    """How many words (between blanks, tabs and line ends) each whole text has, and how many of each group; none for null."""
    counts = []
    for text in texts:
        of = bytes(map(_groups.__getitem__, _WORDS(text.as_py() or "")))
        counts.append((len(of), [of.count(i) for i in range(TOPICS)]))
    return pa.StructArray.from_arrays([pa.array([n for n, _ in counts], pa.int64()), pa.array([g for _, g in counts], pa.list_(pa.int64()))], names=["tokens", "groups"])


def topic_of(groups: Column, usual: Column) -> Column:
    """Stand-in for corpora without a topic column: the group of words that the whole text uses most beyond its language's use of it.

    groups: the text's words by group; usual: those of all texts of its language. Ties go to the first group.
    """
    number = lambda c: c.cast("double")
    total = lambda c: number(F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y))
    n, t = total(groups), total(usual)
    beyond = F.array(*[F.coalesce(F.try_divide(number(groups[i]) - F.try_divide(n * number(usual[i]), t), F.sqrt(number(usual[i]))), F.lit(-1e300)) for i in range(TOPICS)])
    return F.concat(F.lit("t"), (F.array_position(beyond, F.array_max(beyond)) - 1).cast("string"))


def targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Shares in proportion to a power of the margin's tokens: under 1, large values give way to small ones."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("tokens"))
    total = sums.agg(F.sum(F.pow("tokens", F.lit(power))).alias("total"))
    return sums.join(F.broadcast(total)).select(margin, F.try_divide(F.pow("tokens", F.lit(power)), F.col("total")).alias("share"))


def rake(cells: DataFrame, shares: dict[str, DataFrame], rounds: int = 40, most_local: int = 200_000, tolerance: float = 0.0) -> DataFrame:
    """cells (source, lang, topic, tokens) with `fitted`, tokens whose margins are `shares` of the total.

    Cells are counted first: up to most_local of them are fitted in numpy, more by Spark, with the same steps, which
    stop after `rounds` rounds or once a round changes nothing beyond the tolerance; `margins` tells what is reached.
    Values without a target share get none of the tokens. Null values of an attribute count as a value.
    """
    spark = cells.sparkSession
    if cells.limit(most_local + 1).count() <= most_local:
        rows = sorted(cells.collect(), key=lambda r: tuple((r[m] is not None, r[m] or "") for m in MARGINS))
        fitted = np.array([float(r["tokens"]) for r in rows])
        total = fitted.sum()
        codes, wanted = [], []
        for m in MARGINS:
            share = {r[0]: r[1] or 0.0 for r in shares[m].collect()}  # no more values than cells
            values = sorted({r[m] for r in rows}, key=lambda v: (v is not None, v or ""))
            place = {v: i for i, v in enumerate(values)}
            codes.append(np.array([place[r[m]] for r in rows], dtype=np.int64))
            wanted.append(np.array([share.get(v, 0.0) * total for v in values]))
        for _ in range(rounds):
            worst = 0.0
            for code, want in zip(codes, wanted, strict=True):
                have = np.bincount(code, fitted, minlength=len(want))
                factor = np.divide(want, have, out=np.zeros_like(want), where=have > 0)
                fitted = fitted * factor[code]
                worst = max(worst, float(np.abs(factor[have > 0] - 1).max(initial=0)))
            if worst < tolerance:
                break
        out = [(*[r[m] for m in MARGINS], int(r["tokens"]), float(f)) for r, f in zip(rows, fitted, strict=True)]
        return spark.createDataFrame(out, "source string, lang string, topic string, tokens long, fitted double")
    total = cells.agg(F.sum("tokens")).first()[0]
    fitted = cells.withColumn("fitted", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for m in MARGINS:
            have = fitted.groupBy(m).agg(F.sum("fitted").alias("have")).withColumnRenamed(m, "_m")
            want = shares[m].withColumnRenamed(m, "_w")
            factors = have.join(want, F.col("_m").eqNullSafe(F.col("_w")), "left").select("_m", F.coalesce(F.try_divide(F.col("share") * total, F.col("have")), F.lit(0.0)).alias("factor"))
            fitted = fitted.join(factors, F.col(m).eqNullSafe(F.col("_m")), "left").withColumn("fitted", F.col("fitted") * F.col("factor")).drop("_m", "factor")
        fitted = checkpoint(fitted)
        if fitted.groupBy(MARGINS[0]).agg(F.sum("fitted").alias("have")).join(shares[MARGINS[0]], MARGINS[0]).agg(F.max(F.abs(F.col("have") / total - F.col("share")))).first()[0] < tolerance:
            break
    return fitted


def uniform(seed: int) -> Column:
    """A number in [0, 1) that only doc_id and the seed decide; 13 hexadecimal digits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / float(16**13)


def margins(fitted: DataFrame, shares: dict[str, DataFrame]) -> DataFrame:
    """margin, value, share and reached: the target and the fitted share of each value of each attribute."""
    out = None
    total = fitted.agg(F.sum("fitted").alias("total"))
    for m in MARGINS:
        have = fitted.groupBy(F.col(m).alias("value")).agg(F.sum("fitted").alias("fitted")).join(F.broadcast(total))
        want = shares[m].select(F.col(m).alias("wanted"), "share")
        rows = have.join(want, F.col("value").eqNullSafe(F.col("wanted")), "left").select(F.lit(m).alias("margin"), "value", F.coalesce("share", F.lit(0.0)).alias("share"), F.coalesce(F.try_divide("fitted", "total"), F.lit(0.0)).alias("reached"))
        out = rows if out is None else out.unionByName(rows)
    return out


def mix(docs: DataFrame, power: float = 0.7, seed: int = 5, shares: dict[str, DataFrame] | None = None) -> DataFrame:
    """docs (doc_id, text, source, lang, other columns; topic optional) with tokens, topic, weight, probability, kept.

    weight is the fitted over the actual tokens of the document's cell, probability that over the largest weight.
    Without a column topic, `topic_of` stands in. A document without words has weight and probability 0 in a cell
    without tokens, else its cell's. Null sources and languages are values of their own. Rows that share a doc_id are
    kept or left together if their cells agree. Columns named tokens, weight, probability or kept are replaced.
    """
    ship(docs.sparkSession)
    docs = docs.drop("tokens", "weight", "probability", "kept")
    given = "topic" in docs.columns
    rows = docs.withColumn("__said", F.arrow_udf(said, "struct<tokens:long,groups:array<long>>")(F.col("text")))
    seen = checkpoint(rows.select("source", "lang", "__said", *(["topic"] if given else [])))
    if not given:
        usual = seen.groupBy(F.col("lang").alias("__lang")).agg(*[F.sum(F.col("__said.groups")[i]).alias(f"g{i}") for i in range(TOPICS)])
        usual = sized(checkpoint(usual.select("__lang", F.array(*[f"g{i}" for i in range(TOPICS)]).alias("__usual"))), 200_000)
        topical = lambda df: df.join(usual, F.col("lang").eqNullSafe(F.col("__lang")), "left").withColumn("topic", topic_of(F.col("__said.groups"), F.col("__usual"))).drop("__lang", "__usual")
        rows, seen = topical(rows), topical(seen)
    cells = checkpoint(seen.groupBy(*MARGINS).agg(F.sum("__said.tokens").alias("tokens")))
    shares = shares or {m: targets(cells, m, power) for m in MARGINS}
    fitted = rake(cells, shares).withColumn("weight", F.coalesce(F.try_divide(F.col("fitted"), F.col("tokens")), F.lit(0.0)))
    top = fitted.agg(F.max("weight")).first()[0] or 1.0
    fitted = fitted.select(*[F.col(m).alias(f"__{m}") for m in MARGINS], "weight", F.least(F.lit(1.0), F.col("weight") / top).alias("probability"))
    same = [F.col(m).eqNullSafe(F.col(f"__{m}")) for m in MARGINS]
    joined = rows.join(sized(fitted, 200_000), same[0] & same[1] & same[2], "left").drop(*[f"__{m}" for m in MARGINS])
    out = joined.withColumn("tokens", F.col("__said.tokens")).withColumn("kept", uniform(seed) < F.col("probability"))
    return out.select(*docs.columns, "tokens", *([] if given else ["topic"]), "weight", "probability", "kept")


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document with its cell, weight and probability, and whether it is in the mixture."""
    from .common import table

    out = mix(table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang"))
    return out.select("doc_id", "source", "lang", "topic", "tokens", F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "kept")


#: The same in DuckDB: the fit is a recursive query of 40 rounds over the cells.
SQL = """WITH RECURSIVE a AS (SELECT doc_id, source, lang, list_transform(coalesce(regexp_extract_all(text, '[^ \\t\\r\\n]+'), []), lambda w: (unicode(w) + unicode(right(w, 1)) + length(w)) % 8) AS gs FROM documents),
 b AS (SELECT doc_id, source, lang, len(gs)::BIGINT AS tokens, list_transform(range(8), lambda i: len(list_filter(gs, lambda g: g = i))::DOUBLE) AS n FROM a),
 u AS (SELECT lang AS l, list_transform(range(8), lambda i: list_sum(list_transform(list(n), lambda x: x[i + 1]))) AS s FROM b GROUP BY lang),
 z AS (SELECT b.*, list_transform(range(8), lambda i: coalesce((n[i + 1] - list_sum(n) * s[i + 1] / nullif(list_sum(s), 0)) / sqrt(nullif(s[i + 1], 0)), -1e300)) AS z FROM b JOIN u ON b.lang IS NOT DISTINCT FROM u.l),
 d AS (SELECT doc_id, source, lang, tokens, 't' || (list_position(z, list_max(z)) - 1) AS topic FROM z),
 c AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL),
 ps AS (SELECT source, pow(sum(tokens), 0.7) AS p FROM c GROUP BY source), pl AS (SELECT lang, pow(sum(tokens), 0.7) AS p FROM c GROUP BY lang), pt AS (SELECT topic, pow(sum(tokens), 0.7) AS p FROM c GROUP BY topic),
 w AS (SELECT c.*, ps.p / (SELECT sum(p) FROM ps) * (SELECT sum(tokens) FROM c) AS ws, pl.p / (SELECT sum(p) FROM pl) * (SELECT sum(tokens) FROM c) AS wl, pt.p / (SELECT sum(p) FROM pt) * (SELECT sum(tokens) FROM c) AS wt
  FROM c JOIN ps ON c.source IS NOT DISTINCT FROM ps.source JOIN pl ON c.lang IS NOT DISTINCT FROM pl.lang JOIN pt ON c.topic = pt.topic),
 r AS (SELECT 0 AS i, *, tokens AS f FROM w UNION ALL SELECT i + 1, source, lang, topic, tokens, ws, wl, wt, f * coalesce(wt / nullif(sum(f) OVER (PARTITION BY topic), 0), 0) FROM
  (SELECT * EXCLUDE (f), f * coalesce(wl / nullif(sum(f) OVER (PARTITION BY lang), 0), 0) AS f FROM (SELECT * EXCLUDE (f), f * coalesce(ws / nullif(sum(f) OVER (PARTITION BY source), 0), 0) AS f FROM r WHERE i < 40))),
 x AS (SELECT source, lang, topic, coalesce(f / nullif(tokens, 0), 0) AS weight FROM r WHERE i = 40), y AS (SELECT *, least(1, weight / (SELECT max(weight) FROM x)) AS probability FROM x)
 SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, round(weight, 6) AS weight, round(probability, 6) AS probability, ('0x' || substr(md5('5:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496::DOUBLE < probability AS kept
 FROM d JOIN y ON d.source IS NOT DISTINCT FROM y.source AND d.lang IS NOT DISTINCT FROM y.lang AND d.topic = y.topic"""
