"""Quality (1), licences (4), toxicity (6), nearest vectors (9) and the
pipeline: brute force and held-out accuracy."""
import math
import random
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from llm_cases import SMOKE, texts_of
from wagelens.llm import license_scan, nearest_vectors, quality, toxicity
from wagelens.llm.shared import free_worker, worker_memory

SF = "/root/testdata/sf0.01"


def brute_kneser_ney(texts, order=quality.ORDER):
    """Probability function of the same model, from plain dictionaries."""
    counts = [None] * (order + 1)
    counts[order] = Counter()
    for t in texts:
        b = b"\0" * (order - 1) + t.encode()
        for i in range(order - 1, len(b)):
            counts[order][b[i - order + 1:i + 1]] += 1
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    total, taken, cut = [None], [None], [None]
    for k in range(1, order + 1):
        n = [0] + [sum(v == i for v in counts[k].values()) for i in range(1, 5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
        d = [0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.1), i - 0.05) if n[i] else 0.5 * min(i, 2) for i in (1, 2, 3)]
        t, s = defaultdict(int), defaultdict(float)
        for g, c in counts[k].items():
            t[g[:-1]] += c
            s[g[:-1]] += d[min(c, 3)]
        total.append(t), taken.append(s), cut.append(d)

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / 256
        h, c = gram[:-1], counts[k][gram]
        if h not in total[k]:
            return p(gram[1:])
        return (c - cut[k][min(c, 3)]) / total[k][h] * (c > 0) + taken[k][h] / total[k][h] * p(gram[1:])

    def logppl(t):
        b = b"\0" * (order - 1) + t.encode()
        return -sum(math.log(p(b[i - order + 1:i + 1])) for i in range(order - 1, len(b))) / (len(b) - order + 1)

    return logppl


@pytest.mark.parametrize("shard_rows", [quality.SHARD_ROWS, 400])
def test_perplexity_equals_brute_force(spark, edges, monkeypatch, shard_rows):
    monkeypatch.setattr(quality, "SHARD_ROWS", shard_rows)
    rnd = random.Random(1)
    train = [" ".join(rnd.choice(["the", "thé", "cat", "sat", "on"]) for _ in range(12)) for _ in range(20)]
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(train)], "doc_id long, text string")
    want = brute_kneser_ney(train)
    for r in quality.perplexity(edges.where("doc_id <> 13"), quality.train(texts)).collect():
        t = dict(texts_of(edges))[r.doc_id]
        assert (r.logppl is None) == (not t)
        if t:
            assert r.logppl == pytest.approx(want(t), rel=1e-4)


def test_quality_keeps_clean_and_drops_junk(spark, nothing):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert len(quality.classify(docs, labels).columns) == 6
    assert got[got.quality == 1].keep.mean() > 0.95 and got[got.quality == 0].keep.mean() < 0.2
    assert quality.classify(docs, labels.limit(0)).where("keep").count() == docs.where("length(text) > 0").count()
    assert quality.classify(nothing, labels).count() == 0


def test_small_languages_keep_their_clean_documents(spark):
    rnd = random.Random(2)
    words = {"big": ["the", "cat", "sat", "on", "mats"], "few": ["der", "hund", "lief", "zum", "haus"]}
    say = lambda lang, n: " ".join(rnd.choices(words[lang], k=n))
    free = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, say("big", 30), "big") for i in free[:250]] + [(i, say("few", 30), "few") for i in free[250:258]]
    fresh = [(3000 + i, say("few", 30), "few") for i in range(60)]
    junk = [(4000 + i, "".join(rnd.choices("qxzjkvw#%&0123456789", k=120)), lang) for i, lang in enumerate(["big", "few"] * 5)]
    docs = spark.createDataFrame(rows + fresh + junk, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality long")
    keep = {r.doc_id: r.keep for r in quality.classify(docs, labels).collect()}
    assert all(keep[r[0]] for r in fresh) and not any(keep[r[0]] for r in junk)


def test_licences_of_lines(spark, edges, nothing):
    rows = [(600, "abc def\nReleased under the MIT License.\nrest"), (601, "Licensed under CC BY-NC 4.0."),
            (602, "This work is licensed under the GNU General Public License, version 3."), (603, "the version of the work is under way")]
    docs = edges.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    docs = docs.unionByName(spark.read.parquet(f"{SMOKE}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text"), allowMissingColumns=True)
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert [got[i].families for i in range(600, 604)] == ["mit", "cc-by-nc", "gpl-3", ""]
    assert got[600].found[0].paragraph == 1 and got[600].n_paragraphs == 3 and got[3].n_paragraphs == 0
    assert all(not got[i].found for i in (1, 2, 3, 4, 12, 13, 14))
    assert license_scan.scan(nothing).count() == 0


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 9, 700)
    terms = np.concatenate([rng.choice(40, n, replace=False) for n in sizes])
    weights = rng.random(len(terms))
    off = np.concatenate(([0], np.cumsum(sizes)))
    index = toxicity.build_index(off, terms, weights, 40)
    dense = np.zeros((700, 40))
    dense[np.repeat(np.arange(700), sizes), terms] = weights
    for _ in range(60):
        q = np.sort(rng.choice(40, rng.integers(1, 7), replace=False))
        w = rng.random(len(q))
        cosine = np.round(dense[:, q] @ w, 12)
        best = [e for e in np.lexsort((np.arange(700), -cosine)) if cosine[e] > 0][:15]
        got = toxicity.nearest(index, q, w, 15)
        assert [e for _, e in got] == best
        assert np.allclose([c for c, _ in got], cosine[best])


@pytest.mark.parametrize("hot", [1024, 6])
def test_nearest_examples_of_many_rows_are_exact(monkeypatch, hot):
    monkeypatch.setattr(toxicity, "HOT", hot)
    rng = np.random.default_rng(4)
    dense = np.where(rng.random((900, 50)) < 0.15, rng.random((900, 50)), 0)
    row, term = np.nonzero(dense)
    off = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=900))))
    index = toxicity.build_index(off, term, dense[row, term], 50, 8)
    got = list(toxicity.nearest_rows(index, off, term, dense[row, term], 7, list(range(900))))
    for i, found in enumerate(got):
        cosine = np.round(dense @ dense[i], 12)
        cosine[i] = 0
        best = [e for e in np.lexsort((np.arange(900), -cosine)) if cosine[e] > 0][:7]
        assert np.allclose([c for c, _ in found], cosine[best], rtol=1e-5) and [e for _, e in found] == best


@pytest.mark.parametrize("common", [0, 0.003, 1])
def test_stored_matrices_are_mapped_and_exact(tmp_path, monkeypatch, common):
    monkeypatch.setattr(toxicity, "COMMON", common, raising=False)
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words, rng.integers(1, 12), replace=False)) for _ in range(300)]
    term = np.unique(toxicity.row_terms(pa.array(words), None)[1])
    at = SimpleNamespace(**{n: str(tmp_path / n) for n in ("terms", "examples", "index")})
    for name, table in ("terms", pa.table({"term": term.view(np.int64), "weight": rng.random(len(term)).astype(np.float32) + 0.5})), \
                       ("examples", pa.table({"doc_id": np.arange(300), "toxic": np.arange(300) % 2, "text": texts})):
        (tmp_path / name).mkdir()
        pq.write_table(table, tmp_path / name / "part.parquet")
    free_worker()
    list(toxicity.write_index(at)([pa.RecordBatch.from_pydict({"id": [0]})]))
    model, index = toxicity.fitted(at)
    for part in index.parts:
        # No worker makes a copy of its own.
        assert part.matrix.size == 0 or isinstance(part.matrix.base, np.memmap) or isinstance(part.matrix.base.base, np.memmap)
    off, t, w = toxicity.vectors(pa.array(texts), model)
    dense = np.zeros((300, len(term)))
    dense[np.repeat(np.arange(300), np.diff(off)), t] = w
    for i, found in enumerate(toxicity.nearest_rows(index, off, t, w, 15, list(range(300)))):
        cosine = dense @ dense[i]
        cosine[i] = 0
        best = np.sort(cosine[cosine > 1e-9])[::-1][:15]
        assert len(found) == len(best) and np.allclose([c for c, _ in found], best, rtol=1e-5)
        assert np.allclose([cosine[e] for _, e in found], best, rtol=1e-5)
    free_worker()


def test_new_vocabulary_drops_what_a_worker_keeps(tmp_path):
    pq.write_table(pa.table({"term": [3, 1], "weight": pa.array([0.5, 2.0], pa.float32())}), tmp_path / "part.parquet")
    worker_memory()["table of another operator"] = np.zeros(10)
    words, weight = toxicity.words_of(str(tmp_path))
    assert words.tolist() == [1, 3] and weight.tolist() == [2.0, 0.5]
    assert list(worker_memory()) == [("toxicity words", str(tmp_path))]
    free_worker()


def test_toxicity_searches_by_every_term(spark):
    # One word too rare for any test of significance is all that two texts share.
    texts = [f"plain{i} words{i} about nothing{i}" for i in range(40)]
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = [(i, t) for i, t in zip(ids, texts)] + [(900, "seldomly plain3"), (901, "ABOUT"), (902, "unknown1 zzz"), (903, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k < 4)) for k, i in enumerate(ids[:40])], "doc_id long, toxic long")
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert got[900].near[0] == ids[3] and 0 < got[900].cosine[0] < 1
    assert len(got[901].near) == toxicity.NEAREST and not got[902].near and not got[903].near
    assert all(got[i].near[0] == i for i in ids[:40])
    # idf counts the 42 documents with text, of which 41 hold "about", not the 40 examples.
    weight = toxicity.term_weights(43, np.array([41.0]), 40, 4, np.array([40.0]), np.array([4.0]))
    assert weight[0] == pytest.approx(math.log(44 / 42) + 1)


def test_toxicity_on_held_out_rows(spark, edges, nothing):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.score(docs, labels).select("doc_id", "held_out", "score", "predicted").join(labels, "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out))
    held = got[got.held_out]
    assert held.score.between(0, 1).all() and ((held.score >= 0.7) == (held.predicted == 1)).all()
    named = held[held.predicted == 1]
    assert named.toxic.mean() > 0.9 and held[held.toxic == 1].predicted.mean() > 0.6
    few = toxicity.score(edges, labels.limit(0)).collect()
    assert len(few) == edges.count() and all(r.score == 0.0 for r in few)
    assert toxicity.score(nothing, labels).count() == 0
    assert toxicity.reject(edges, labels).schema == edges.schema


def test_nearest_vectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = table.toPandas()
    vectors, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    found = nearest_vectors.neighbours(table, opened=24).toPandas()
    recall = []
    for i in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[i]
        score[i] = -np.inf
        mine = found[found.query_id == ids[i]].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and (mine.score.diff().dropna() <= 0).all()
        assert np.allclose(mine.score, [vectors[np.flatnonzero(ids == v)[0]] @ vectors[i] for v in mine.vec_id])
        recall.append(len(set(mine.vec_id) & set(ids[np.argsort(-score)[:20]])) / 20)
    assert np.mean(recall) >= 0.9


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (5, [1.0, 1.0]), (4, [1.0, 1.0]), (6, [None, 1.0]),
            (20, [1.0, 1.0]), (20, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (60, [inf, 1.0])]
    rows += [(101 + 2 * i, [0.5, 0.5]) for i in range(60)]  # one very common vector
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id int, embedding array<double>, score string")
    got = nearest_vectors.neighbours(table).orderBy("query_id", "rank").collect()
    mine = [(r.vec_id, r.score) for r in got if r.query_id == 20]
    assert mine == [(4, 2.0), (5, 2.0), (0, 1.0), *((101 + 2 * i, 1.0) for i in range(17))]
    assert {r.query_id for r in got} == {0, 20}
    assert nearest_vectors.neighbours(table.limit(0)).count() == 0


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    size = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.store(stage(spark, docs, SMOKE), name)
        assert docs.schema.names == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0.7 * size < docs.count() <= size
        assert docs.where("n_chars <> length(text)").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE)
    assert {r.doc_id for r in last.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
