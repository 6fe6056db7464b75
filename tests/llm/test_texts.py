"""Jaccard join (3), suffix-array dedup (5), packing (7), decontamination (8)
against brute force."""
import hashlib
import random
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import SMOKE, texts_of
from wagelens.llm import components, decontaminate, jaccard_join, packing, suffix_array, suffix_dedup
from wagelens.llm.kernels import ALNUM_WORDS, text_buffer

FOLD = {i: i + 32 for i in range(65, 91)}


def near_copies(n, seed=3):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(400)}" for _ in range(150)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(len(words))] = f"z{i}"
        out.append((100 + i, " ".join(words)))
    return out


def components_of(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
        sets[i] = {tuple(w[j:j + 4]) for j in range(max(1, len(w) - 3))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard_join_equals_brute_force(spark, edges, nothing):
    more = spark.createDataFrame(near_copies(70), "doc_id long, text string")
    docs = edges.unionByName(more, allowMissingColumns=True)
    docs = docs.unionByName(spark.read.parquet(f"{SMOKE}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text"), allowMissingColumns=True)
    want = components_of(texts_of(docs))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(docs).collect()}
    assert got == want
    kept = jaccard_join.one_per_group(docs)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, (_, c) in want.items() if c == i}
    assert jaccard_join.join(nothing).count() == 0


def test_sketches_bound_the_overlap_of_every_pair():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 2**64, 900, np.uint64)
    sets = [np.unique(np.concatenate((common[:k], rng.integers(0, 2**64, n - k, np.uint64)))) for n, k in
            ((1, 0), (4, 4), (5, 4), (300, 280), (330, 280), (900, 900), (1000, 880), (3000, 0), (3000, 0))]
    # Many tokens of one bucket: the count passes a byte.
    sets.append(np.arange(2000, dtype=np.uint64))
    fine = jaccard_join.sketches(np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets]))))
    assert [len(f) for f in fine] == [1, 1, 2, 128, 128, 256, 256, 1024, 1024, 0]
    pairs = [(a, b) for a in range(len(sets)) for b in range(len(sets))]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs]), pa.array([len(sets[a]) for a, _ in pairs]), pa.array([fine[a] for a, _ in pairs]),
         pa.array([p[1] for p in pairs]), pa.array([len(sets[b]) for _, b in pairs]), pa.array([fine[b] for _, b in pairs])],
        ["rep", "n", "fine", "peer", "m", "other"])
    (left,) = jaccard_join.within_sketch(85)([batch])
    left = set(zip(left.column("rep").to_pylist(), left.column("peer").to_pylist()))
    for a, b in pairs:
        both = len(np.intersect1d(sets[a], sets[b]))
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            assert (a, b) in left
    # Unlike sets of like size go without their tokens being read; nothing is known of the last.
    assert (7, 8) not in left and (9, 7) in left


def test_jaccard_join_reads_whole_sets_of_likely_pairs_only(spark, monkeypatch):
    rnd = random.Random(7)
    # Rare words common to all texts make them candidates; the rest is different.
    docs = spark.createDataFrame([(i, "a b c d e " + " ".join(f"w{rnd.randrange(10**9)}" for _ in range(1000))) for i in range(6)], "doc_id long, text string")
    seen, kept = {}, jaccard_join.store

    def store(df, name, *more):
        seen[name] = kept(df, name, *more)
        return seen[name]

    monkeypatch.setattr(jaccard_join, "store", store)
    monkeypatch.setattr(jaccard_join, "within_bound", lambda *names: lambda batches: batches)
    assert {r.component_id for r in jaccard_join.join(docs).collect()} == set(range(6))
    assert seen["between"].count() > 0 and seen["opened-sets"].count() == 0


def test_fragments_do_not_depend_on_the_pieces_hashed_together(monkeypatch):
    rnd = random.Random(11)
    texts = ["".join(rnd.choice("ab ") for _ in range(n)) for n in (0, 49, 50, 51, 700, 3, 64, 1000)]
    data, off = text_buffer(pa.array(texts))
    whole = suffix_dedup.fragments(data, off)
    assert len(whole[0]) > 20
    for piece in (1, 7, 64, len(data) - 49, len(data)):
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        for x, y in zip(whole, suffix_dedup.fragments(data, off)):
            assert np.array_equal(x, y)


def test_doubling_equals_sorted_suffixes():
    rng = np.random.default_rng(5)
    for names in (np.zeros(50, int), rng.integers(0, 3, 400), np.tile(rng.integers(0, 600, 30), 12), rng.permutation(700)):
        want = sorted(range(len(names)), key=lambda i: names[i:].tolist())
        assert suffix_array.doubling(names).tolist() == want


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components.components(links, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_suffix_array_sorts():
    rng = np.random.default_rng(0)
    for n in range(1, 120):
        text = rng.integers(0, 1 + n % 5 + 1, n)
        if n % 4 == 0:
            text = np.tile(rng.integers(0, 3, 1 + n % 7), 20)
        got = suffix_array.suffix_array(text, 256)
        assert list(got) == sorted(range(len(text)), key=lambda i: tuple(text[i:]))


def removed(rows, length=50):
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        for j in range(len(b) - length + 1):
            first.setdefault(b[j:j + length], i)
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if first[b[j:j + length]] < i:
                gone[j:j + length] = b"\1" * length
        runs = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def test_suffix_dedup_equals_brute_force(spark, edges, nothing):
    rnd = random.Random(1)
    noise = lambda n: "".join(rnd.choice("xyz") for _ in range(n))
    passage = "".join(rnd.choice("abcd é") for _ in range(120))
    rows = [(200 + i, noise(20) + passage + noise(20)) for i in range(90)]  # a frequent passage
    docs = edges.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    want = removed(texts_of(docs))
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.dedup(docs).collect()}
    assert got == want and sum(w[1] for w in want.values()) > 5000
    assert suffix_dedup.dedup(nothing).count() == 0


def test_fragments_and_spans_travel_as_one_row_a_block_and_receiver():
    rnd = random.Random(2)
    passage = "".join(rnd.choice("abcd") for _ in range(400))
    rows = [(i, passage[:200 + 20 * i]) for i in range(8)]
    data, off = text_buffer(pa.array([t for _, t in rows]))
    row = suffix_dedup.fragments(data, off)[0]
    marks = [np.arange(n, dtype="<u4").tobytes() for n in np.bincount(row, minlength=len(rows)).tolist()]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows]), pa.array(marks)], ["doc_id", "text", "marks"])
    hot = SimpleNamespace(value=np.zeros(0, np.uint64))
    sent = list(suffix_dedup.send_fragments(hot, 50, 3)([batch]))
    assert sum(b.num_rows for b in sent) <= 3 < len(row)
    spans = list(suffix_dedup.sort_shard(50, 2)(sent))
    by_bucket = [b.slice(i, 1) for b in spans for i in range(b.num_rows)]
    got = {}
    for bucket in range(2):
        for b in suffix_dedup.merge_spans([x for x in by_bucket if x.column("bucket")[0].as_py() == bucket]):
            got |= {d: np.frombuffer(s, "<u4").tolist() for d, s in zip(*(c.to_pylist() for c in b.columns))}
    # The first text owns its 200 bytes, each longer one adds 20 with the strings that reach them.
    assert got == {i: [0, 200 + 20 * (i - 1)] for i in range(1, 8)}


def test_packing_gives_each_token_one_place(spark, edges, nothing):
    from tokenizers import Tokenizer

    rnd = random.Random(2)
    odd = ["a  b", "a   b c", "\n\n x \n y", "x\n \ny", " lead", "trail ", "tab\t \tz", "<|endoftext|> a", "don't I'll", "a\x85 b\x1c c", "12 3 4,5."]
    rows = [(300 + i, t) for i, t in enumerate(odd)] + [(400 + i, " ".join(f"t{rnd.randrange(99)}" for _ in range(rnd.randrange(900)))) for i in range(40)]
    docs = edges.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    got = packing.pack(docs, packing.tokenizer_path()).toPandas()
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    for i, t in texts_of(docs):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        mine = got[got.doc_id == i].sort_values("piece")
        assert list(mine.piece) == list(range(len(mine))) and mine.length.sum() == len(ids) and (mine.length.iloc[1:] == 2048).all()
        for p in mine.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == [0, *s.length.cumsum()[:-1]] and s.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1
    assert packing.pack(nothing, packing.tokenizer_path()).count() == 0


def test_plan_is_best_fit_decreasing():
    rnd = random.Random(4)
    counts = {length: rnd.randrange(1, 9) for length in range(1, 21)}
    runs = packing.plan_slots(counts, 20)
    free: list = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        fits = [i for i, f in enumerate(free) if f >= length]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= length
        else:
            free.append(20 - length)
    assert len({first + i for _, _, n, first, _ in runs for i in range(n)}) == len(free)


def hits(rows, items, width=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))
    windows: dict = {}
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[j:j + width]), set()).add(str(i))
    out = {}
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j:j + n])]
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                  bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination_equals_brute_force(spark, edges, nothing, block_bytes, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 200)
    rnd = random.Random(6)
    text = lambda n: " ".join(rnd.choice("the of and Löwe x9 Zebra quick".split()) for _ in range(n))
    items = [(1, text(30)), (2, text(13)), (3, "the of and"), (4, None), (5, "..."), (6, text(20)), (7, "one two three four five")]
    rows = [(500 + i, text(rnd.randrange(60)) + " " + (items[i % 7][1] or "") + " tail " + text(5)) for i in range(30)]
    docs = edges.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate.find_phrases, "__defaults__", (decontaminate.WINDOW, block_bytes))
    got = {r.doc_id: tuple(r)[1:6] for r in decontaminate.contamination(docs, bench).collect()}
    assert got == hits(texts_of(docs), items)
    assert decontaminate.contamination(nothing, bench).count() == 0
    clean = decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count()
    assert clean == 0 and ALNUM_WORDS.sum() == 164
