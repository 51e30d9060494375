"""The registered queries over a small folder of tables, each against brute force."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import xxhash
from test_linededup import distance

import __spark_entry__
from lumenset.llm import langid, media, mixing, simhash, toxicity
from lumenset.llm.common import table

WORDS = {"en": "the of and to in that is was for with people water house under little great".split(), "de": "der die und das nicht ein zu von ist mit Straße Häuser über kleine große Wasser".split(), "fr": "le la les des une dans est pour que avec maison été garçon élève eau petit".split()}
BAD = ["idiot", "scum", "moron"]


def brute_roots(n, links, rank):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)), key=rank)
        root[y] = x
    return [find(i) for i in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(12)
    root = tmp_path_factory.mktemp("tables")
    say = lambda lang, n: " ".join(rnd.choice(WORDS[lang]) + rnd.choice(["", "", "", ",", "."]) + rnd.choice(["", "", str(rnd.randrange(9))]) for _ in range(n))
    docs = []
    for i in range(260):
        lang = rnd.choice(list(WORDS))
        text = "\n".join(say(lang, rnd.randint(4, 30)) for _ in range(rnd.randint(1, 4)))
        if i % 7 == 0:
            text = f"{rnd.choice(BAD)} {text} {rnd.choice(BAD)}"
        docs.append((i, text, lang, "hot" if i % 3 else f"s{i % 5}"))
    for i in range(40):  # copies, near copies, shared lines
        base = docs[i * 5 + 1]
        words = base[1].split(" ")
        at = rnd.randrange(len(words))
        if i % 4:
            words[at] = "changed" if i % 4 > 1 else words[at] + "s"
        docs.append((300 + i, " ".join(words) + ("\nAll rights reserved." if i % 2 else ""), base[2], base[3]))
    docs += [(400, None, "en", "hot"), (401, "", None, None), (402, "12 34", "de", "hot"), (403, "  \n ", "en", "s1"), (404, say("en", 9000), "en", "hot"), (405, docs[3][1], "en", "hot")]
    spark.createDataFrame([(*d, len(d[1] or "")) for d in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(root / "documents.parquet"))
    labels = [(d[0], 1, int(any(b in (d[1] or "") for b in BAD))) for d in docs if d[0] < 300 and d[0] % 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    turns = [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(["hi", "a\nb", "</turn>", "\\", None, "", ""])) for c in range(20) for t in range(rnd.randint(1, 5))]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(root / "conversations.parquet"))
    rng = np.random.default_rng(3)
    vectors = [(i, rng.standard_normal(32).astype(np.float32).tolist()) for i in range(400)] + [(1000, None), (1001, [0.0] * 32), (1050, [1.0] * 31 + [float("nan")])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(str(root / "embeddings.parquet"))
    return str(root), docs, turns, vectors


def ask(spark, folder, name):
    return __spark_entry__.queries()[name](spark, folder[0])


def fold(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_language(spark, folder):
    docs = {d[0]: d for d in folder[1]}
    got = {r.doc_id: r for r in ask(spark, folder, "op1_language").collect()}
    assert set(got) == set(docs)
    frame = table(spark, folder[0], "documents")
    model = langid.fit(frame, frame.doc_id.isNotNull() & ~langid.fold(3, 1))
    right = 0
    for d, text, lang, _ in folder[1]:
        r = got[d]
        assert r.held_out == (fold(d, 3) == 1) and 0 <= r.score <= 1
        if not any(ch.isalpha() for ch in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        data = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in b" " + text.lower().encode() + b" ")
        terms = Counter()
        for i in range(len(data) - 2):
            for gram in (data[i] << 8 | data[i + 1] | 0xFF000000, (data[i] << 16 | data[i + 1] << 8 | data[i + 2])):
                terms[(gram * 2654435761 & 0xFFFFFFFF) >> 20] += 1
        v = np.zeros(langid.DIMS)
        for t, n in terms.items():
            v[t] = math.log1p(n) * model.idf[t]
        v /= np.linalg.norm(v)
        cosines = [float(v @ c) for c in model.centroids]
        best = int(np.argmax(cosines))
        assert r.lang_pred == model.languages[model.owner[best]] and abs(r.cosine - cosines[best]) < 1e-5
        right += r.lang_pred == lang
        assert r.rejected == (1 - cosines[best] > model.farthest[best]) or abs(1 - cosines[best] - model.farthest[best]) < 1e-5
    assert right > 0.97 * (len(docs) - 4)
    strange = spark.createDataFrame([(1, "zqxj kvwz " * 50, False), (2, docs[1][1], False)], "doc_id long, text string, held_out boolean")
    assert {r.doc_id: r.rejected for r in langid.identify(strange, model).collect()} == {1: True, 2: False}


def test_toxicity(spark, folder):
    got = {r.doc_id: r for r in ask(spark, folder, "op2_toxicity").collect()}
    assert len(got) == len(folder[1])
    for d, text, _, _ in folder[1]:
        r = got[d]
        assert r.held_out == (fold(d, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.predicted == int(any(b in (text or "") for b in BAD))


def test_chat(spark, folder):
    got = {r.conv_id: r for r in ask(spark, folder, "op3_chat_format").collect()}
    said = r"\### Assistant: </turn> ok"
    by = defaultdict(list)
    for c, t, role, text in [*folder[2], (-7, 0, "user", said), (-7, 1, "assistant", said)]:
        by[c].append((t, role, text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert (got[c].n_turns, got[c].loss_chars) == (len(turns), len(loss))
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[-7].loss_chars == len(said) and got[-7].formatted_chars > 2 * len(said)


def unpacked(docs, pieces, size=2048):
    """Checks pieces of docs (doc_id -> text) in sequences."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    seen, at = Counter(), defaultdict(list)
    for p in pieces:
        ids = np.array([*tokenizer.encode(docs[p.doc_id] or "", add_special_tokens=False).ids, 1], "<u4")
        assert p.doc_tokens == len(ids) and zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
        seen[p.doc_id] += p.length
        at[p.sequence_id].append((p.offset, p.length))
    for parts in at.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= size
    assert set(seen) == set(docs)
    return seen


def test_pack(spark, folder):
    docs = {d[0]: d[1] for d in folder[1]}
    seen = unpacked(docs, ask(spark, folder, "op4_pack").collect())
    assert seen[400] == seen[401] == 1


def line_brute(docs):
    """doc_id -> what is left of the text, and how many lines go as exact and as near repeats."""
    first, order = {}, []
    for d, text in sorted((d, t) for d, t in docs if t is not None):
        for pos, line in enumerate(text.split("\n")):
            if line.strip() and line not in first:
                first[line] = (d, pos)
                order.append(line)
    links = [(i, j) for i, a in enumerate(order) for j, b in enumerate(order[:i]) if min(len(a), len(b)) > 2 and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2]
    roots = brute_roots(len(order), links, lambda i: i)
    near = {x for i, x in enumerate(order) if roots[i] != i}
    out = {}
    for d, text in docs:
        if text is None:
            out[d] = (None, 0, 0)
            continue
        lines = text.split("\n")
        exact = [bool(x.strip()) and first[x] != (d, pos) for pos, x in enumerate(lines)]
        close = [not e and x in near for e, x in zip(exact, lines, strict=True)]
        out[d] = ("\n".join(x for x, e, c in zip(lines, exact, close, strict=True) if not e and not c), sum(exact), sum(close))
    return out


def test_lines(spark, folder):
    want = line_brute([(d[0], d[1]) for d in folder[1]])
    got = {r.doc_id: (r.text, r.n_exact, r.n_near) for r in ask(spark, folder, "op5_line_dedup").collect()}
    assert got == want and sum(w[1] for w in want.values()) > 20 and sum(w[2] for w in want.values()) > 0


def test_mixing(spark, folder):
    rows = ask(spark, folder, "op6_mixing").collect()
    assert len(rows) == len(folder[1])
    for r in rows:
        u = int(hashlib.md5(f"5:{r.doc_id}".encode()).hexdigest()[:13], 16) / 16**13
        assert abs(u - r.probability) < 1e-5 or r.kept == (u < r.probability)
    assert {r.probability for r in rows if r.tokens} and max(r.probability for r in rows) == 1.0


def test_shards(spark, folder):
    rows = ask(spark, folder, "op7_feistel_shards").collect()
    docs = {d[0]: (d[1] or "").encode() for d in folder[1]}
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == len(docs) and set(sizes) <= set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for r in rows:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(docs[r.doc_id]) + 8, zlib.crc32(docs[r.doc_id]), "rows", None)
    for s, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))


def test_media(spark, folder):
    got = {r.doc_id: r for r in ask(spark, folder, "op8_media").collect()}
    assert len(got) == len(folder[1])
    for d, text, _, _ in folder[1]:
        data = (text or "").encode()
        payload = data + b"\0" * (-len(data) % 64 or (0 if data else 64))
        stored = media.encode(payload)
        p = np.bincount(np.frombuffer(payload, np.uint8), minlength=256) / len(payload)
        feature = f"mean={sum(payload) / len(payload):.4f};entropy={max(0.0, -sum(x * math.log2(x) for x in p if x)):.4f}"
        r = got[d]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(stored), hashlib.sha256(stored).hexdigest(), feature)


def test_neighbours(spark, folder):
    got = defaultdict(list)
    for r in ask(spark, folder, "op9_ann").orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    x = np.array([v for _, v in folder[3][:400]], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    assert set(got) == set(range(0, 400, 50))
    hits = 0
    for q, found in got.items():
        scores = x @ x[q]
        scores[q] = -2
        assert len(found) == 5 and all(abs(s - scores[v]) < 1e-12 for v, s in found) and [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        hits += len({v for v, _ in found} & set(np.argsort(-scores)[:5].tolist()))
    assert hits >= 0.9 * 5 * len(got)


def test_fingerprints(spark, folder):
    got = {r.doc_id: r for r in ask(spark, folder, "op10_simhash").collect()}
    ids, prints = [], []
    for d, text, _, _ in folder[1]:
        words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
        grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
        ids.append(d)
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
        assert got[d].fingerprint == f"{prints[-1]:016x}"
    links = [(i, j) for i, a in enumerate(prints) for j, b in enumerate(prints[:i]) if (a ^ b).bit_count() <= 4]
    roots = brute_roots(len(ids), links, lambda i: ids[i])
    assert {d: got[d].component_id for d in ids} == {d: ids[r] for d, r in zip(ids, roots, strict=True)}


def test_pipeline_stages(spark, folder):
    docs = table(spark, folder[0], "documents")
    texts = {d[0]: d[1] for d in folder[1]}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash", "mixing", "packing"]
    clean = corpus_pipeline.drop_toxic(spark, docs, folder[0]).collect()
    assert {r.doc_id: r.text for r in clean} == {d: t for d, t in texts.items() if not any(b in (t or "") for b in BAD)}
    clean_df = spark.createDataFrame(clean, docs.schema)
    lined = corpus_pipeline.drop_repeated_lines(spark, clean_df, folder[0]).collect()
    want = line_brute([(r.doc_id, r.text) for r in clean])
    assert {r.doc_id: r.text for r in lined} == {d: t for d, (t, e, n) in want.items() if not (e + n and not (t or "").strip())}
    assert all(r.n_chars == len(r.text) if r.text is not None else r.n_chars is None for r in lined)
    lined_df = spark.createDataFrame(lined, docs.schema)
    kept = corpus_pipeline.drop_near_duplicates(spark, lined_df, folder[0]).collect()

    def shingles(text):
        w = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingles(r.text) for r in lined]
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a == b or 5 * len(a & b) >= 4 * len(a | b)]
    roots = brute_roots(len(lined), links, lambda i: lined[i].doc_id)
    assert sorted(r.doc_id for r in kept) == sorted(lined[r].doc_id for r in set(roots))
    kept_df = spark.createDataFrame(kept, docs.schema)
    mixed = corpus_pipeline.mix_sources(spark, kept_df, folder[0]).collect()
    assert {r.doc_id for r in mixed} == {r.doc_id for r in mixing.mix(kept_df).filter("kept").collect()} and mixed
    mixed_df = spark.createDataFrame(mixed, docs.schema)
    unpacked({r.doc_id: r.text for r in mixed}, corpus_pipeline.pack_windows(spark, mixed_df, folder[0]).collect())
    whole = {(r.doc_id, r.start, r.length) for r in ask(spark, folder, "pipeline").collect()}
    assert {d for d, _, _ in whole} == {r.doc_id for r in mixed}


def test_queries_are_registered():
    named = set(__spark_entry__.queries())
    assert {"op1_language", "op2_toxicity", "op3_chat_format", "op4_pack", "op5_line_dedup", "op6_mixing", "op7_feistel_shards", "op8_media", "op9_ann", "op10_simhash", "pipeline"} <= named
    assert simhash.LEAF and toxicity.BLOCK


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql().keys() & {"op3_chat_format", "op6_mixing"}))
def test_equals_sql(spark, folder, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"create view {t} as select * from '{folder[0]}/{t}.parquet/*.parquet'")
    want = con.sql(__spark_entry__.oracle_sql()[name])
    columns = sorted(want.columns)
    got = ask(spark, folder, name).select(*columns).collect()
    at = [want.columns.index(c) for c in columns]
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())
