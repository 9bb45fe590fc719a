"""Near copies of texts and vectors against all pairs; components; the pipeline's stages."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hirelens.llm import near_vectors, queries, shingle_join
from hirelens.llm.graph import components


def closed(nodes, links):
    least = {n: n for n in nodes}
    while True:
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            return least


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = closed({n for e in links for n in e}, links)
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def sets(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def texts():
    rng = random.Random(2)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 4) + str(rng.randrange(40))
    base = [[word() for _ in range(rng.randint(3, 90))] for _ in range(25)]
    shared = [word() for _ in range(30)]
    rows = []
    for i in range(220):
        w = list(rng.choice(base[:6] if i % 2 else base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = word()
        if i % 5 == 0:
            w += shared
        rows.append((i + 10, " ".join(w).upper() if i % 7 == 0 else "\t".join(w)))
    return rows + [(1, None), (2, ""), (3, " \n "), (4, "One two"), (5, "one TWO"), (900, "long " * 30_000), (901, "Long " * 20_000), (10, rows[0][1])]


@pytest.mark.parametrize("block", [2000, 4])
def test_jaccard_equals_all_pairs(docs_of, empty_docs, monkeypatch, block):
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    rows = texts()
    own = {i: sets(t) for i, t in rows}
    ids = sorted(own)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if own[a] and own[b] and 100 * len(own[a] & own[b]) >= 75 * len(own[a] | own[b])
    ]
    want = closed(ids, links)
    assert len(links) > 300 and len(set(want.values())) > 20
    got = shingle_join.jaccard_components(docs_of([*rows, (None, rows[0][1])])).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == (len(own[r["doc_id"]]), want[r["doc_id"]])
    assert shingle_join.jaccard_components(empty_docs).count() == 0


def test_bitmaps_never_rule_out_similar_sets():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 40, 700):
        for _ in range(40):
            x = rng.integers(0, 2**63, n).astype(np.uint64)
            y = np.unique(np.concatenate([x[rng.random(n) < 0.9], rng.integers(0, 2**63, max(1, n // 9)).astype(np.uint64)]))
            shared = len(np.intersect1d(x, y))
            if 100 * shared >= 75 * (n + len(y) - shared):
                assert shingle_join.may_link(shingle_join.parities(x), shingle_join.parities(y), n + len(y))


def test_gaps_keep_the_pairs_that_may_link_and_order_them():
    rng = np.random.default_rng(8)
    base = np.unique(rng.integers(0, 2**63, 60).astype(np.uint64))
    sets = [base, base[:57], base[:48], base[:20], np.unique(rng.integers(0, 2**63, 60).astype(np.uint64)), base[:50]]
    marks = [shingle_join.parities(s) for s in sets]
    bits = pa.array([*(m.tobytes() for m in marks[:-1]), None], pa.binary())
    size = np.array([len(s) for s in sets])
    u, v = np.triu_indices(len(sets), 1)
    gaps = shingle_join._gaps(bits, size, u, v)
    for a, b, gap in zip(u, v, gaps.tolist()):
        known = b < len(sets) - 1 and max(map(len, (marks[a], marks[b]))) <= 2 * min(map(len, (marks[a], marks[b])))
        if known:
            assert (gap >= 0) == shingle_join.may_link(marks[a], marks[b], int(size[a] + size[b]))
        else:
            assert gap == 8
    of = dict(zip(zip(u.tolist(), v.tolist()), gaps.tolist()))
    assert 0 <= of[0, 1] < of[0, 2]


def vector_rows():
    rng = np.random.default_rng(6)
    centers = rng.standard_normal((30, 16))
    rows = []
    for i in range(400):
        v = centers[i % 30 if i % 3 else 0] + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.3, 1.0])
        rows.append((i, [float(x) for x in v.astype(np.float32)]))
    bad = [(1000, None), (1001, [0.0] * 16), (1002, [1.0, None] + [0.0] * 14), (1003, [float("nan")] + [1.0] * 15), (1004, [float("inf")] * 16), (1005, []), (1006, rows[0][1][:8])]
    return rows, bad


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors_equal_all_pairs(spark, block):
    rows, bad = vector_rows()
    m = np.array([v for _, v in rows])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(m @ m.T >= 0.95, 1))
    schema = "vec_id long, embedding array<float>, label int, rep string, n long"
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in [*rows, *bad, (None, rows[0][1])]], schema)
    wide = near_vectors.Tables(tables=40)
    got = {r["vec_id"]: r for r in near_vectors.near_vectors(frame, tables=wide, block=block).collect()}
    assert len(got) == len(rows) + len(bad) + 1
    degree = np.bincount(np.concatenate([a, b]), minlength=len(rows))
    want = closed(range(len(rows)), list(zip(a.tolist(), b.tolist())))
    assert len(a) > 500
    for i, _ in rows:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (degree[i], want[i], want[i] == i)
    for i, _ in bad:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert (got[None]["n_links"], got[None]["component_id"], got[None]["kept"]) == (0, None, False)
    assert near_vectors.near_vectors(frame.limit(0)).count() == 0


def test_recall_with_production_tables(spark):
    frame = queries.read(spark, "/root/testdata/sf0.1", "embeddings")
    rows = frame.select("embedding").collect()
    m = np.array([r["embedding"] for r in rows], float)
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    true = int(((m @ m.T) >= 0.95).sum() - len(m))
    found = near_vectors.near_vectors(frame).agg(F.sum("n_links")).first()[0]
    assert 0.9 * true <= found <= true


def test_default_tables_find_pairs_close_to_the_threshold(spark):
    rng = np.random.default_rng(12)
    u = rng.standard_normal((3000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.standard_normal(u.shape)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    c = rng.uniform(0.95, 0.97, (len(u), 1))
    m = np.concatenate([u, c * u + np.sqrt(1 - c * c) * w]).astype(np.float32)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(m.tolist())], "vec_id long, embedding array<float>")
    m = m.astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(m @ m.T >= 0.95, 1))
    assert len(a) > 2900
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors.near_vectors(frame).collect()}
    degree, want = np.bincount(np.concatenate([a, b]), minlength=len(m)), closed(range(len(m)), list(zip(a.tolist(), b.tolist())))
    assert got == {i: (degree[i], want[i]) for i in range(len(m))}


def test_pipeline_stages(spark, docs_of):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = queries.read(spark, sf, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece"
    ]
    before = docs.count()
    extra = [(10_001, None, "en", "s", 0), (10_002, "", "en", "s", 0), (10_003, "12 !!", "en", "s", 5)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    left = corpus_pipeline.keep_known_language(spark, docs, sf).cache()
    assert left.filter("doc_id > 10000").isEmpty() and left.count() == before and left.columns == docs.columns
    once = corpus_pipeline.keep_one_of_near_copies(spark, left, sf)
    groups = shingle_join.jaccard_components(left)
    assert once.count() == groups.select("component_id").distinct().count() and once.columns == docs.columns
    clean = corpus_pipeline.drop_benchmark_leaks(spark, left, sf)
    leaked = {r["doc_id"] for r in queries.op8_decontamination(spark, sf).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in left.collect()} - leaked and leaked
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece_ids", "n_pieces"] and 0 < out.count() < before


def plain_languages(rows):
    """The rows whose language plain naive Bayes finds with a probability of at least 0.5."""
    import math
    import zlib
    from collections import Counter

    steps = [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D]

    def buckets(text):
        codes = [ord(c) for c in (text or "").lower()]
        for n in (1, 2, 3):
            for at in range(len(codes) - n + 1):
                total = n * 0x3243F6A9 & 0xFFFFFFFF
                for i in range(n):
                    total = (total + codes[at + i] * steps[i]) & 0xFFFFFFFF
                    total ^= total >> 15
                    total = total * 0x2C1B3C6D & 0xFFFFFFFF
                yield total >> 16

    train = [r for r in rows if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 4 != 2 and r[2] is not None]
    counts, prior = {r[2]: Counter() for r in train}, Counter(r[2] for r in train)
    for r in train:
        counts[r[2]].update(buckets(r[1]))
    left = []
    for r in rows:
        own = Counter(buckets(r[1]))
        total = [
            math.log(prior[x] / len(train)) + sum(k * math.log((counts[x][g] + 0.5) / (counts[x].total() + 0.5 * 65536)) for g, k in own.items())
            for x in sorted(counts)
        ]
        share = 1 / sum(math.exp(t - max(total)) for t in total)
        if any(c.isalpha() for c in r[1] or "") and share >= 0.5:
            left.append(r)
    return left


def plain_leaks(text, items):
    """Whether any part of the text is within the edit limit of an item, by a plain table of edits."""
    import re

    w = lambda t: re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", (t or "").lower())
    have = w(text)
    for item in map(w, items):
        line = [0] * (len(have) + 1)
        for x in item:
            after = [line[0] + 1]
            for j, y in enumerate(have):
                after.append(min(after[-1] + 1, line[j + 1] + 1, line[j] + (x != y)))
            line = after
        if item and min(line) <= int(len(item) * 0.2 + 1e-9):
            return True
    return False


def test_pipeline_equals_a_plain_chain(spark, tmp_path):
    import corpus_pipeline
    from hirelens.llm import token_counts

    from .test_text_scans import plain_lines
    from .test_tokenizers import brute

    rng = random.Random(21)
    vocabulary = {
        "en": [a + b for a in ("th", "wh", "str", "ing", "ough") for b in ("at", "ere", "ee", "ow", "ack", "ight")],
        "de": [a + b for a in ("sch", "pf", "zw", "ung", "ei") for b in ("ä", "und", "icht", "ü", "ach", "aß")],
    }
    words = lambda lang, n: [rng.choice(vocabulary[lang]) + str(rng.randrange(30)) for _ in range(n)]
    items = [" ".join(words("en", n)) for n in (15, 30, 59, 130)]
    common = "a line of at least forty characters that many documents share"
    rows = []
    for i in range(40):
        lang = "de" if i % 3 == 0 else "en"
        lines = [" ".join(words(lang, rng.randint(4, 25))) for _ in range(rng.randint(1, 4))]
        if i % 5 == 0:
            lines.insert(rng.randrange(len(lines) + 1), common)
        rows.append((100 + i, "\n".join(lines), lang))
    for i in range(8):  # near copies, some with a smaller id, and exact ones
        part = rows[i * 4][1].split(" ")
        if i % 2 and len(part) > 40:
            part[rng.randrange(len(part))] = "other"
        rows.append((90 + i if i % 3 else 300 + i, " ".join(part), rows[i * 4][2]))
    for i, item in enumerate(items):  # leaks, whole, edited, halved, and without an id
        edited = item.split()
        for p in rng.sample(range(len(edited)), len(edited) // 10):
            edited[p] = "other"
        for k, part in enumerate((item.upper(), " ".join(edited), " ".join(item.split()[: len(edited) // 2]))):
            rows.append((400 + 10 * i + k, " ".join([*words("en", 20), part, *words("en", 9)]), "en"))
    rows += [
        (None, " ".join([*words("en", 12), items[1], *words("en", 5)]), "en"), (None, " ".join(words("de", 20)), "de"), (None, None, None),
        (500, None, "en"), (501, "", "de"), (502, "12 34 !!", "en"), (503, common, "en"), (504, f"{common}\n{common}", "en"), (999, common.upper(), "en"),
        (505, " ".join(words("de", 30)), None), (506, " ".join(words("de", 25)), "en"), rows[3],
    ]
    left = plain_languages(rows)
    assert {500, 501, 502}.isdisjoint(r[0] for r in left)
    cut = [(i, text) for i, _, dropped, text in plain_lines([r[:2] for r in left]) if not dropped or text.strip(" ")]
    assert len(cut) < len(left) and 503 not in dict(cut)
    own = [(i, sets(t)) for i, t in cut if i is not None]
    links = [(i, j) for k, (i, x) in enumerate(own) for j, y in own[k + 1 :] if x and y and 100 * len(x & y) >= 75 * len(x | y)]
    least = closed({i for i, _ in own}, links)
    once = [r for r in cut if r[0] is None or least[r[0]] == r[0]]
    assert len(once) < len(cut)
    leaked = [r for r in once if plain_leaks(r[1], items)]
    assert len(leaked) == 9 and any(i is None for i, _ in leaked)
    table, by_byte = token_counts.load_pieces(queries.tokenizer())
    want = [(i, brute(t, table, by_byte) if t else []) for i, t in once if (i, t) not in leaked]
    docs = [(i, t, lang, "src", len(t or "")) for i, t, lang in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(((r["doc_id"], list(r["piece_ids"])) for r in got), key=str) == sorted(want, key=str)
    assert all(r["n_pieces"] == len(r["piece_ids"]) for r in got)


@pytest.mark.parametrize("stage", ["language_id", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece"])
def test_stages_take_odd_rows(spark, docs_of, empty_docs, stage):
    import corpus_pipeline

    run = dict(corpus_pipeline.STAGES)[stage]
    odd = docs_of([(1, None), (2, ""), (None, "the and of"), (3, "the and of " * 20_000), (3, "the and of " * 20_000)])
    assert run(spark, odd, "/root/testdata/sf0.001").count() <= 5
    assert run(spark, empty_docs, "/root/testdata/sf0.001").count() == 0


def test_batches_stay_small_and_the_setting_comes_back(spark):
    from hirelens.llm import common

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, most = spark.conf.get(name), common.BATCH_BYTES
    wide = spark.range(0, 3000, 1, 1).select(F.encode(F.repeat(F.lit("x"), 4000), "utf-8").alias("b"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.get_total_buffer_size()]})

    with common.small_batches(spark):
        found = [r["n"] for r in wide.mapInArrow(sizes, "n long").collect()]
    assert len(found) > 2 and max(found) < 2 * most and spark.conf.get(name) == before
    with pytest.raises(RuntimeError), common.small_batches(spark):
        raise RuntimeError
    assert spark.conf.get(name) == before
