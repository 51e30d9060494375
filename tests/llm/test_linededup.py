import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenset.llm import linededup
from lumenset.llm.components import components

SCHEMA = "doc_id long, text string, extra string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(rows, threshold, least):
    """(doc_id, text) -> text after exact and near removal, by all pairs."""
    order = sorted({(d if d is not None else linededup.LAST, t) for d, t in rows if t is not None})
    first, places = {}, []
    for d, t in order:
        for pos, line in enumerate(t.split("\n")):
            if len(line) >= least and line not in first:
                first[line] = (d, pos)
    kept = {}
    for d, t in order:
        kept[(d, t)] = [line for pos, line in enumerate(t.split("\n")) if len(line) < least or first[line] == (d, pos)]
    lines = sorted(first, key=lambda x: first[x])
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            if abs(len(a) - len(b)) <= threshold and distance(a, b) <= threshold:
                a_, b_ = sorted((find(a), find(b)), key=lambda x: first[x])
                root[b_] = a_
    gone = {x for x in lines if find(x) != x}
    return {k: "\n".join(x for x in v if x not in gone) for k, v in kept.items()}


def variant(rnd, line, edits):
    out = list(line)
    for _ in range(edits):
        at = rnd.randrange(len(out))
        kind = rnd.randrange(3)
        if kind == 0:
            out[at] = rnd.choice("xyzé")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rnd.choice("xyzé"))
    return "".join(out)


def test_bit_parallel_distance(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(400):
        a = "".join(rnd.choice("abé ") for _ in range(rnd.randint(5, 40)))
        rows.append((a, variant(rnd, a, rnd.randint(0, 5))))
    for t in (1, 2, 3):
        usable = [(a, b) for a, b in rows if min(len(a), len(b)) > t]
        got = spark.createDataFrame(usable, "a string, b string").select("a", "b", linededup.within_edits(F.col("a"), F.col("b"), t).alias("w")).collect()
        assert [r.w for r in got] == [distance(r.a, r.b) <= t for r in got]


def test_equals_brute_force(spark):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcdefg  ") for _ in range(rnd.randint(24, 60))) for _ in range(25)]
    rows = []
    for d in range(60):
        lines = [variant(rnd, rnd.choice(base), rnd.choice([0, 0, 1, 2, 3])) for _ in range(rnd.randint(0, 5))] + rnd.choice([[], ["short"], [""], ["short", "short"]])
        rnd.shuffle(lines)
        rows.append((d, "\n".join(lines)))
    rows += [(100, None), (101, ""), (None, base[0]), (102, base[1] + "\n" + base[1])]
    expected = brute(rows, 2, 24)
    df = spark.createDataFrame([(d, t, "e") for d, t in rows], SCHEMA)
    original = dict(rows)
    got = linededup.dedup_lines(df).collect()
    assert len(got) == len(rows)
    for r in got:
        t = original[r.doc_id]
        want = None if t is None else expected[(r.doc_id if r.doc_id is not None else linededup.LAST, t)]
        assert r.text == want, (r, want)
        assert r.extra == "e"
        if t is not None:
            assert r.n_lines - r.n_exact - r.n_near == (len(want.split("\n")) if want or r.n_exact + r.n_near == 0 else 0) or want == ""


def test_every_close_pair_meets(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(300):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(24, 33)))
        rows += [(2 * i, a), (2 * i + 1, variant(rnd, a, rnd.randint(1, 2)))]
    rows = [r for r in rows if len(r[1]) >= 24]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links = linededup.near_line_links(df, 2, 24).select(F.col("a.doc").alias("a"), F.col("b.doc").alias("b"))
    root = {r.node: r.root for r in components(links).collect()}
    by = dict(rows)
    for i in range(300):
        a, b = by.get(2 * i), by.get(2 * i + 1)
        if a and b and a != b and distance(a, b) <= 2:
            assert root[2 * i] == root[2 * i + 1]
    for r in links.collect():
        assert distance(by[r.a], by[r.b]) <= 2


def test_empty_and_clashing_columns(spark):
    schema = T.StructType.fromDDL("doc_id long, text string, doc string, th string, pos string, line string")
    assert linededup.dedup_lines(spark.createDataFrame([], schema)).count() == 0
    line = "a line that is long enough to count"
    got = linededup.dedup_lines(spark.createDataFrame([(1, line, "d", "t", "p", "l"), (2, line, "d", "t", "p", "l"), (2, line, "d", "t", "p", "l")], schema)).orderBy("doc_id").collect()
    assert [(r.text, r.doc, r.th, r.pos, r.line) for r in got] == [(line, "d", "t", "p", "l"), ("", "d", "t", "p", "l"), ("", "d", "t", "p", "l")]


def test_lines_of_any_length(spark):
    rnd = random.Random(7)
    short = ["Les.", "No", "x", "All rights reserved.", "Über 12", "abc", "qrstuvw", "klmno pqr", "9"]
    rows = [(d, "\n".join(variant(rnd, x, 1) if len(x) > 6 and rnd.random() < 0.2 else x for x in rnd.choices([*short, "", " "], k=rnd.randint(1, 6)))) for d in range(40)]

    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in linededup.dedup_all_lines(df).collect()}
    first = {}
    for d, t in rows:
        for pos, line in enumerate(t.split("\n")):
            if line.strip():
                first.setdefault(line, (d, pos))
    root = {x: x for x in first}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in first:
        for b in first:
            if a < b and min(len(a), len(b)) > 2 and distance(a, b) <= 2:
                near, far = sorted((find(a), find(b)), key=first.get)
                root[far] = near
    for d, t in rows:
        stay = [x for pos, x in enumerate(t.split("\n")) if not x.strip() or first[x] == (d, pos) and find(x) == x]
        assert got[d].text == "\n".join(stay), (t, got[d])
    assert sum(r.n_exact for r in got.values()) > 50 and sum(r.n_near for r in got.values()) > 0


def test_documents_without_id_are_told_apart(spark):
    line = "a line that is long enough to count"
    rows = [(None, line + "\nfirst ending, of its own kind"), (None, line + "\nanother close, unlike it at all"), (linededup.LAST - 1, "some other words, nothing more here")]
    rows += [(4, "x" * 30 + "\none"), (4, "x" * 29 + "y\ntwo")]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = [r.text.split("\n") for r in got]
    assert sum(line in t for t in texts) == 1 and sum(r.n_exact for r in got) == 1
    assert sum(t[0][:29] == "x" * 29 for t in texts) == 1 and sum(r.n_near for r in got) == 1


def test_rows_of_one_doc_id_are_documents_of_their_own(spark):
    a, b = "the first of two lines that are unlike", "quite another sentence, with its own words"
    rows = [(3, a + "x"), (5, a), (5, b), (8, b + "y"), (9, a), (9, a), (None, b), (None, b + "\nnew"), (None, "new")]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), least_exact=1).collect()
    left = [(r.doc_id, line) for r in got for line in (r.text or "").split("\n") if line]
    assert sorted(left, key=str) == [(3, a + "x"), (5, b), (None, "new")]
    assert sum(r.n_near for r in got) == 2 and len(got) == len(rows)


def test_a_frequent_line_is_found_by_all_tasks(spark):
    rnd = random.Random(2)
    rows = [(d, rnd.choice("abcde"), d % 7, rnd.choice([1, 1, 1, 2, 3, 4, 5, 6]), 0) for d in range(400)]
    found = spark.createDataFrame(rows, "doc long, th_ string, pos int, h1 long, h2 long").withColumn("th", F.xxhash64("th_")).drop("th_")
    first = {}
    for r in sorted(found.collect(), key=lambda r: (r.doc, r.pos, r.th)):
        first.setdefault(r.h1, (r.doc, r.pos, r.th))
    want = sorted((r.doc, r.pos, r.th) for r in found.collect() if first[r.h1] != (r.doc, r.pos, r.th))
    for frequent in (2, 10_000):
        assert sorted(tuple(r) for r in linededup._repeats(found, frequent).collect()) == want


def test_large_groups_of_near_lines(spark):
    rows = [(i, f"counter number {i:04d} of a page that repeats and repeats") for i in range(300)] + [(1000 + i, "x" * 30 + "ab"[i] + "y" * 10) for i in range(2)]
    got = linededup.dedup_all_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = sorted(r.doc_id for r in got if r.text)
    assert kept == [0, 1000]
