"""Each operator against brute force, a round trip or held-out rows, with nulls, empties, ties, repeats and extra columns."""

import hashlib
import itertools
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lumenset.llm import ann, chat, components, langid, media, mixing, pack, shard, simhash, toxicity

DOCS = "doc_id long, text string, lang string, source string, extra string"
WORDS = {"en": "the of and to in that is was for with".split(), "de": "der die und das nicht ein zu von ist mit".split(), "fr": "le la les des une dans est pour que avec".split()}


def sentence(rnd, lang, n=40):
    return " ".join(rnd.choice(WORDS[lang]) + rnd.choice(["", "", ".", ","]) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(0)
    rows = [(i, sentence(rnd, lang), lang, f"s{i % 3}", "x") for i, lang in enumerate(rnd.choices(list(WORDS), k=300))]
    rows += [(300, None, "en", "s0", "x"), (301, "", None, "s0", "x"), (302, "12 34 !!", "de", None, "x"), (None, sentence(rnd, "en"), "en", "s1", "x"), (5, rows[5][1], rows[5][2], "s2", "x"), (303, sentence(rnd, "fr", 20_000), "fr", "s1", "x")]
    return spark.createDataFrame(rows, DOCS).cache()


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_language(spark, docs):
    model = langid.fit(docs, ~langid.fold(3, 1), sample_docs=120, centroids=3)
    rows = langid.identify(docs.withColumn("held_out", langid.fold(3, 1)), model).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert held and all(r.lang_pred == truth[r.doc_id] and 0 <= r.score <= 1 for r in held)
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (300, 301, 302)} == {300: "und", 301: "und", 302: "und"}
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert langid.fit(empty(spark), F.lit(True)) is None
    assert langid.identify(docs.withColumn("held_out", F.lit(False)), None).filter("lang_pred <> 'und'").count() == 0


def test_language_counts_in_parts():
    text = "abc déf " * 300_000
    data = text.encode()
    assert len(data) > langid._PART
    assert langid.counts(text).sum() == 2 * len(data)  # one bigram and one trigram for each place of the padded bytes


def test_toxicity(spark):
    rnd = random.Random(2)
    bad = ["idiot", "moron", "scum"]
    rows, labels = [], []
    for i in range(600):
        toxic = int(i % 8 == 0)
        words = sentence(rnd, "en", 60).split() + (rnd.sample(bad, 2) if toxic else [])
        rnd.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    rows += [(600, None), (601, ""), (None, "idiot scum moron")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, known.filter(~langid.fold(5, 0)), sample_docs=400)
    got = {r.doc_id: r for r in toxicity.score(docs.withColumn("held_out", langid.fold(5, 0)), model).collect()}
    assert len(got) == len(rows)
    held = [(got[i].predicted, t) for i, t in labels if got[i].held_out]
    assert held and all(p == t for p, t in held)
    assert got[600].predicted == 0 and got[601].predicted == 0 and got[None].predicted == 1
    assert all(e.toxic == 1 for e in got[None].evidence)
    judged = toxicity.judge(docs.withColumn("score", F.lit("mine")), model)
    assert judged.columns == ["doc_id", "text", "score", "predicted"] and judged.filter("predicted = 1").count() == sum(t for _, t in labels) + 1
    assert toxicity.fit(docs, known.limit(0)) is None
    assert toxicity.score(docs.withColumn("held_out", F.lit(False)), None).filter("score <> 0").count() == 0


def test_block_max_index_is_exact():
    rnd = np.random.default_rng(0)
    model = toxicity.Model({f"w{i}": i for i in range(124)}, rnd.random(124) + 0.5, np.zeros(0), [], 0.1, 5)
    counted = [{f"w{w}": int(rnd.integers(1, 4)) for w in rnd.choice(124, size=rnd.integers(1, 8), replace=False, p=np.r_[np.full(4, 0.2), np.full(120, 0.2 / 120)])} for _ in range(500)]
    counted = [*counted, *counted[:100], {"w1": 1}, {"other": 3}, {}]  # ties, and examples without a word
    held = model.vectors(counted)
    model.index(held, block=64)
    assert (model.place >= 0).any() and (model.place < 0).any()
    dense = np.zeros((len(counted), 124))
    dense[held.rows, held.terms] = held.weights
    assert np.allclose(np.linalg.norm(dense[:600], axis=1), 1)
    for skip in (None, np.arange(len(counted))):
        cosines, places = model.nearest(held, 7, skip)
        for i, q in enumerate(dense):
            all_ = dense @ q
            if skip is not None:
                all_[i] = 0
            want = np.sort(all_[all_ > 1e-12])[::-1][:7]
            at = places[i][places[i] >= 0]
            assert np.allclose(cosines[i][: len(want)], want) and len(at) == len(want) == len(set(at))
            assert np.allclose(all_[at], want)


def test_contradicting_labels_and_long_texts(spark):
    rnd = random.Random(5)
    rows = [(i, sentence(rnd, "en", 30) + (" idiot scum" if i % 3 == 0 else "")) for i in range(90)]
    labels = [(i, int(i % 3 == 0)) for i in range(90)] + [(1, 1), (3, 0), (None, 1), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert not {1, 3} & set(model.ids) and len(model.ids) == 88 and model.prior == 29 / 88
    old, toxicity._LONG = toxicity._LONG, 10
    try:
        assert toxicity.words_of("One two ONE_3 é") == {"one": 2, "two": 1, "é": 1}
    finally:
        toxicity._LONG = old


TURNS = "conv_id long, turn long, role string, text string, extra string"


def conversations(spark):
    rnd = random.Random(3)
    odd = ["</turn>\n", "<turn user>\n", "\\", "\\<", "", "a\nb", "é\U0001f600", "\\### Assistant: </turn> ok", chat.marker(""), "\ue000\ue001\ue001\ue002", "\ue001", "n\\n"]
    rows = []
    for c in range(30):
        for t in range(rnd.randint(1, 6)):
            rows.append((c, t, rnd.choice(["user", "assistant", "system", "we>ird\nrole"]), "".join(rnd.choices(odd, k=rnd.randint(0, 4))), "x"))
    rows += [(100, 0, None, None, "x"), (100, None, "assistant", "first", "x"), (None, 0, "assistant", "no id", "x"), (101, 0, "assistant", "twice", "x"), (101, 0, "assistant", "twice", "x")]
    rows += [(102, t, "user" if t % 2 else "assistant", f"turn {t}", "x") for t in range(300)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, TURNS)


def test_chat_round_trip(spark):
    rows, df = conversations(spark)
    turns = chat.format_turns(df)
    got = {r.conv_id: r for r in chat.read_back(turns).collect()}
    by = defaultdict(list)
    for c, t, role, text, _ in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    whole = {r.conv_id: r.formatted for r in chat.assemble(turns).collect()}
    for c, turns_ in by.items():
        turns_.sort()
        said = [(role, text) for _, _, role, text in turns_]
        assert got[c].n_turns == len(said)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        loss = "".join(t for r, t in said if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert not got[c].rewrites_history
        assert whole[c] == chat.TurnTemplate().render(said) and got[c].formatted_chars == len(whole[c])


def test_chat_templates(spark):
    class Rewriting(chat.TurnTemplate):
        def render(self, messages):
            return f"{len(messages)} turns\n" + chat.TurnTemplate.render(self, messages)


    class Ending(chat.TurnTemplate):
        def render(self, messages):
            return chat.TurnTemplate.render(self, messages) + "<end>"

    _, df = conversations(spark)
    df = df.filter("conv_id < 30 or conv_id = 102")
    assert chat.format_turns(df, Rewriting()).filter("not rewrites_history").count() == 0
    ended = chat.format_turns(df.filter("conv_id = 102"), Ending())
    assert ended.filter("rewrites_history").count() == 0
    assert chat.assemble(ended).first().formatted.endswith("</turn>\n<end>")
    assert chat.format_turns(df.limit(0)).count() == 0


def test_packing(spark, docs):
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    pieces = pack.pack_documents(docs, path, size=128, open_windows=4).collect()
    originals = Counter((r.doc_id, r.text or "") for r in docs.collect())
    ids = {}
    for (d, t), n in originals.items():
        ids[d] = (np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4"), n)
    seen = Counter()
    windows = defaultdict(list)
    for p in pieces:
        own, _ = ids[p.doc_id]
        assert p.doc_tokens == len(own) and zlib.crc32(own[p.start : p.start + p.length].tobytes()) == p.ids_crc32
        seen[p.doc_id] += p.length
        windows[p.sequence_id].append((p.offset, p.length))
    assert seen == {d: len(own) * n for d, (own, n) in ids.items()}
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 128
    assert sum(n for w in windows.values() for _, n in w) / (128 * len(windows)) > 0.9
    assert pack.pack_documents(empty(spark), path).count() == 0


def test_ids_equal_the_tokenizers():
    known = pack.Ids(str(public_tokenizers.path("word_bpe_49k.json")), most=50)
    assert known.local
    rnd = random.Random(1)
    signs = "ab'_.!? \n\t\x1c\u0301éÉΣ1²|<>-　"
    latin = "asTé'_.!? \n\t1²ªº½×|<>-\x85\xa0"
    texts = ["".join(rnd.choice(s) for _ in range(40)) for s in (signs, latin) for _ in range(600)]
    texts += ["it's I'LL ''s 'start 5's _'s '_s x'5", "<|endoftext|>x", "a<|startoftext|>b ’s", "x" * 500, "", "l'été _'d 'D !'d"]
    for text in texts:
        assert known.of(text) == np.asarray(known.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    old, pack._LONG = pack._LONG, 50
    try:
        text = " ".join(texts[600:900])
        assert known.of(text) == known.whole(text)
    finally:
        pack._LONG = old


def test_other_tokenizers_encode_whole_texts(spark):
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    known = pack.Ids(path)
    assert not known.local
    text = "Two  words,\n and it's MORE"
    piece = pack.pack_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), path).first()
    want = np.asarray([*known.tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
    assert (piece.length, piece.ids_crc32) == (len(want), zlib.crc32(want.tobytes()))


def test_mixing(spark, docs):
    clashing = docs.select("*", *[F.lit("mine").alias(c) for c in ("kept", "probability", "weight", "tokens", "fitted", "share", "l", "_source")])
    out = mixing.mix(clashing)
    assert out.columns == [*docs.columns, "fitted", "share", "l", "_source", "tokens", "topic", "weight", "probability", "kept"]
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 <= r.probability <= 1 for r in rows)
    assert all(r.tokens == len((r.text or "").split()) for r in rows)
    usual = defaultdict(lambda: np.zeros(8))
    groups = [np.bincount([(ord(w[0]) + ord(w[-1]) + len(w)) % 8 for w in (r.text or "").split()], minlength=8) for r in rows]
    for r, g in zip(rows, groups, strict=True):
        usual[r.lang] += g
    for r, g in zip(rows, groups, strict=True):
        u = usual[r.lang]
        z = [(g[i] - g.sum() * u[i] / u.sum()) / np.sqrt(u[i]) if u[i] else -1e300 for i in range(8)]
        assert r.topic == f"t{int(np.argmax(z))}"
    cells = out.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))
    shares = {m: mixing.targets(cells, m, 0.7) for m in mixing.MARGINS}
    fitted = mixing.rake(cells, shares, rounds=200)
    reached = mixing.margins(fitted, shares).collect()
    assert {r.margin for r in reached} == set(mixing.MARGINS) and all(abs(r.share - r.reached) < 0.02 for r in reached)
    assert mixing.mix(empty(spark)).count() == 0
    named = mixing.mix(docs.withColumn("topic", F.lit("mine")))
    assert named.filter("topic <> 'mine'").count() == 0 and named.columns == [*docs.columns, "topic", "tokens", "weight", "probability", "kept"]


def test_raking_by_spark_equals_numpy(spark):
    cells = spark.createDataFrame([("a", "x", "t", 10), ("a", "y", "t", 30), ("b", "x", "u", 40), ("b", "y", "t", 20), (None, "x", "u", 5)], "source string, lang string, topic string, tokens long")
    shares = {m: mixing.targets(cells, m, 0.5) for m in mixing.MARGINS}
    near = {tuple(r)[:3]: r.fitted for r in mixing.rake(cells, shares, rounds=3).collect()}
    far = {tuple(r)[:3]: r.fitted for r in mixing.rake(cells, shares, rounds=3, most_local=0).select("source", "lang", "topic", "fitted").toDF("source", "lang", "topic", "fitted").collect()}
    assert near.keys() == far.keys() and all(abs(near[k] - far[k]) < 1e-6 for k in near)


def test_permutation():
    for n in (0, 1, 2, 3, 5, 64, 1000, 4097):
        p = shard.permute(np.arange(n), n, 9)
        assert sorted(p) == list(range(n))
        assert list(shard.permute(p, n, 9, inverse=True)) == list(range(n))
    assert list(shard.permute(np.arange(1000), 1000, 1)) != list(shard.permute(np.arange(1000), 1000, 2))


def test_sharding(spark, docs):
    rows = docs.select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c"))
    rows = rows.unionByName(spark.createDataFrame([(7777, 1)] * 50, "doc_id long, c long"))
    got = shard.shuffle_shards(rows, ["doc_id", "c"], shards=7, seed=4).collect()
    n = rows.count()
    assert len(got) == n
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    ordered = sorted(got, key=lambda r: r.row_number_global)
    assert [r.row_number_global for r in ordered] == list(range(n))
    assert [(r.doc_id is not None, r.doc_id or 0) for r in ordered] == sorted((r.doc_id is not None, r.doc_id or 0) for r in got)
    assert all(shard.row_at(r.shard, r.slot, n, 7, 4) == r.row_number_global for r in got[:40])
    again = shard.shuffle_shards(rows.repartition(9), ["doc_id", "c"], shards=7, seed=4).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert shard.shuffle_shards(rows.limit(0), ["doc_id", "c"]).count() == 0
    named = rows.select("*", *[F.lit("x").alias(c) for c in ("shard", "slot", "_copies", "_bucket", "_p")])
    assert shard.shuffle_shards(named, ["doc_id", "c"], shards=7).columns == ["doc_id", "c", "_copies", "_bucket", "_p", "row_number_global", "shard", "slot"]


def test_media(spark, docs, tmp_path):
    root = str(tmp_path / "media")
    index = media.store_texts(docs, root)
    texts = [r.text for r in docs.collect()]
    want = {hashlib.sha256(media.payload_of(t)).hexdigest(): media.payload_of(t) for t in texts}
    rows = index.collect()
    assert sorted(r.digest for r in rows) == sorted(want)
    import tarfile

    held = {}
    for p in (tmp_path / "media").iterdir():
        with tarfile.open(p) as t:
            held |= {m.name[:-4]: t.extractfile(m).read() for m in t}
    assert {d: media.decode(b) for d, b in held.items()} == want
    assert {r.digest: r.payload_sha256 for r in media.media_columns(index, root).collect()} == {d: d for d in want}
    assert {r.digest: (r.width, r.height, r.bit_depth) for r in media.metadata_columns(index, root).collect()} == {d: (len(p), 1, 8) for d, p in want.items()}
    digests = docs.select(media.payload_digest("text").alias("d")).collect()
    assert [r.d for r in digests] == [hashlib.sha256(media.payload_of(t)).hexdigest() for t in texts]
    assert media.store_texts(empty(spark), str(tmp_path / "none")).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 64)).astype(np.float32)
    x[100:160] = x[100]
    rows = [(i, [float(v) for v in x[i]]) for i in range(600)]
    odd = [(1000, None), (1001, [0.0] * 64), (1002, [None] * 64), (1003, [float("nan")] * 64), (1004, [1.0, 2.0]), (None, [1.0] * 64)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    vectors = ann.usable(df)
    got = defaultdict(list)
    for r in ann.neighbours(vectors, vectors.filter("vec_id % 50 = 0"), cell_rows=50).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    hits = 0
    for q in range(0, 600, 50):
        scores = y @ y[q]
        scores[q] = -9
        want = sorted(range(600), key=lambda i: (-round(scores[i], 12), i))[:5]
        assert len(got[q]) == 5 and all(abs(s - scores[v]) < 1e-12 for v, s in got[q])
        hits += len(set(want) & {v for v, _ in got[q]})
    assert hits / 60 >= 0.9
    assert [v for v, _ in got[100]] == [101, 102, 103, 104, 105]
    assert ann.neighbours(vectors.limit(0), vectors.limit(0)).count() == 0


def test_neighbours_of_repeated_rows(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((300, 16))
    rows = [(i, x[i].tolist()) for i in range(300)] * 3 + [(0, x[200].tolist()), (7, x[0].tolist()), (8, x[0].tolist())]
    vectors = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = defaultdict(list)
    for r in ann.neighbours(vectors, vectors.filter("vec_id % 50 = 0"), probes=1.0, trust=50.0, cell_rows=64).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.rank, r.score))
    held = defaultdict(list)
    for i, v in rows:
        held[i].append(np.array(v) / np.linalg.norm(v))
    for q in range(0, 300, 50):
        best = {i: max(float(a @ b) for a in held[q] for b in vs) for i, vs in held.items() if i != q}
        want = sorted(best, key=lambda i: (-round(best[i], 12), i))[:5]
        assert sorted((v for v, _, _ in got[q]), key=lambda i: (-round(best[i], 12), i)) == want and [r for _, r, _ in got[q]] == [1, 2, 3, 4, 5]
        assert all(abs(s - best[v]) < 1e-12 for v, _, s in got[q])


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1"), reason="no generated tables here")
def test_recall_on_the_generated_vectors(spark):
    got = defaultdict(set)
    for r in ann.op9_ann(spark, "/root/testdata/sf0.1").collect():
        got[r.query_id].add(r.vec_id)
    rows = ann.usable(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")).toPandas()
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.v)
    x = x / np.linalg.norm(x, axis=1)[:, None]
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        scores = np.where(ids == ids[q], -9, x @ x[q])
        best = set(ids[np.lexsort((ids, -scores))[:5]].tolist())
        hits, total = hits + len(best & got[int(ids[q])]), total + 5
    assert hits / total >= 0.9


def reference_components(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in parent}


def test_components(spark):
    rnd = random.Random(8)
    links = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(70)] + [(900, 1000 + i) for i in range(100)] + [(3000, 3000)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == reference_components(links)


def test_simhash_equals_brute_force(spark):
    rnd = random.Random(6)
    base = [sentence(rnd, "en", 120) for _ in range(40)]
    texts = []
    for b in base:
        for _ in range(6):
            w = b.split()
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(WORDS["de"])
            texts.append(" ".join(w))
    texts += ["", None, "  ", "ONE two", "one TWO", "a\x0bb c d e", base[0], base[0]]
    df = spark.createDataFrame([(i * 3 + 1, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp string")
    rows = simhash.near_duplicates(df).collect()
    assert len(rows) == len(texts)
    fps = {r.doc_id: r.fp & (2**64 - 1) for r in rows}
    assert all(fps[i * 3 + 1] == simhash.fingerprint(t) for i, t in enumerate(texts))
    want = reference_components([(a, b) for a, b in itertools.combinations_with_replacement(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 4])
    assert {r.doc_id: r.component_id for r in rows} == want
    kept = simhash.representatives(df.unionByName(df))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == df.columns
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_tree_search_finds_all_pairs():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 2**63, 3000, dtype=np.uint64)
    near = base[:800] ^ (np.uint64(1) << rnd.integers(0, 64, 800).astype(np.uint64))
    fps = np.unique(np.concatenate([base, near, near ^ np.uint64(3)]))
    links = simhash.Links(most=10**9)
    old, simhash.LEAF = simhash.LEAF, 2000
    try:
        simhash.search(fps, fps, 4, links)
    finally:
        simhash.LEAF = old
    found = set(zip(np.concatenate(links.a).tolist(), np.concatenate(links.b).tolist(), strict=True))
    x, y = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    assert found == {(int(fps[i]), int(fps[j])) for i, j in zip(x, y, strict=True) if i != j}
    a, b = links.fold()
    assert dict(zip(a.tolist(), b.tolist(), strict=True)) == {k: v for k, v in reference_components(found).items() if k != v}


def test_cells_by_several_vantage_points(spark):
    rnd = np.random.default_rng(2)
    base = rnd.integers(-(2**62), 2**62, 900)
    near = base ^ (np.int64(1) << rnd.integers(0, 60, 900))
    fps = np.unique(np.concatenate([base, near]))
    nodes = spark.createDataFrame([(int(v),) for v in fps], "fp long")
    for cell_rows in (20_000, 20):
        links = [(r.a, r.b) for r in simhash.near_links(nodes, 4, cell_rows).collect()]
        u = fps.view(np.uint64)
        x, y = np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= 4)
        pairs = [(int(fps[i]), int(fps[j])) for i, j in zip(x, y, strict=True) if i < j]
        both = lambda ls: {frozenset(k for k, v in c.items() if v == r) for c in [reference_components(ls)] for r in set(c.values())}
        assert both(links) == both(pairs)
