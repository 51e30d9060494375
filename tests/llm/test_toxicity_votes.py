"""Clean examples vote, and significance alone admits a word."""

import random

from lumenset.llm import toxicity


def test_clean_examples_vote_and_rare_words_count(spark):
    rnd = random.Random(6)
    common = ["w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(60)]
    rows, labels = [], []
    for i in range(2000):
        toxic = int(i % 4 == 0)
        words = rnd.choices(common, k=30)
        if toxic:
            words += ["slur"] * 3 if i % 80 == 0 else ["idiot", "scum"]  # the slur marks 25 of 2,000 examples
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), sample_docs=4000)
    assert (model.labels == 0).sum() == 1500 and (model.labels == 1).sum() == 500
    long_clean = " ".join(rnd.choices(common, k=5000)) + " idiot"
    asked = spark.createDataFrame([(0, "slur slur slur " + " ".join(rnd.choices(common, k=30)), False), (1, long_clean, False), (2, " ".join(common[:30]), False)], "doc_id long, text string, held_out boolean")
    got = {r.doc_id: r for r in toxicity.score(asked, model).collect()}
    assert [got[i].predicted for i in range(3)] == [1, 0, 0]
    assert all(e.toxic == 0 for e in got[2].evidence)
