"""What line deduplication does once a text, and where the edit distance stops."""

import random

from pyspark.sql import functions as F

from lumenset.llm import linededup


def test_texts_are_hashed_before_their_lines_are_cut(spark):
    docs = spark.createDataFrame([(1, "ab\ncd"), (2, " \n\t\n\x1cx")], "doc_id long, text string")
    lines = linededup._lines(docs, 1)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("xxhash64(text")
    assert sorted((r.doc, r.pos, r.line) for r in lines.collect()) == [(1, 0, "ab"), (1, 1, "cd"), (2, 2, "\x1cx")]


def test_far_lines_stop_early_and_stay_far(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(300):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(4, 30)))
        b = list(a)
        for _ in range(rnd.randint(0, 9)):
            b[rnd.randrange(len(b))] = rnd.choice("abc")
        rows.append((a, "".join(rnd.sample(b, 1) + b[rnd.randint(0, 2) :])))
    rows = [(a, b) for a, b in rows if len(b) > 3]
    for t in (1, 2, 3):
        near = linededup.within_edits(F.col("a"), F.col("b"), t)
        got = spark.createDataFrame(rows, "a string, b string").select((near == (F.levenshtein("a", "b") <= t)).alias("same")).collect()
        assert all(r.same for r in got)


def test_signature_counts_letters(spark):
    text = "".join(linededup.LETTERS) + "eeé" * 20 + "Zß"
    got = spark.createDataFrame([(text,)], "s string").select(*[linededup.signature(F.col("s"), i).alias(f"p{i}") for i in range(linededup.PARTS)]).first()
    for i in range(linededup.PARTS):
        want = 0
        for x in linededup.LETTERS[16 * i : 16 * i + 16]:
            want = want << 4 | text.count(x) % 16
        assert got[i] & (2**64 - 1) == want
