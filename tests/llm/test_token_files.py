"""Token files (op13): exact round trips against the tokenizer itself."""

import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_cases import EDGES
from tokenizers import Tokenizer

from wagelens.llm import token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def plain(path, texts, end):
    tokenizer = Tokenizer.from_file(path)
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


def check(rows, order, encoded):
    at, want = 0, []
    for i, ids in zip(order, encoded):
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_round_trip_of_edges(spark, edges, path):
    ordered = sorted(EDGES)
    out = token_files.round_trip(edges, path)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    check(out.collect(), [i for i, _ in ordered], plain(path, [t for _, t in ordered], 2))


def test_empty_table(spark, nothing):
    assert token_files.round_trip(nothing, WORDS).collect() == []


def test_null_and_repeated_ids(spark):
    rows = [(None, "no id"), (None, "none here"), (5, "same"), (5, "same"), (5, "other text"), (-4, "below zero"), (0, None)]
    out = token_files.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), WORDS).collect()
    assert [r["doc_id"] for r in sorted(out, key=lambda r: r["start"])] == [None, None, -4, 0, 5, 5, 5]
    want = sorted((r[0] is not None, r[0] or 0, zlib.crc32(np.array(ids, "<u4").tobytes()))
                  for r, ids in zip(rows, plain(WORDS, [t for _, t in rows], 2)))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["ids_crc32"]) for r in out) == want


def test_chunks_encode_as_whole_texts(monkeypatch):
    rng = random.Random(8)
    parts = ["don't", "we'LL", "'start", "it's's", "\"'s", "x1y22", "...", "é", "é", "́a", "İstanbul", "日本語", "🙂🙂",
             "<|endoftext|>", "<|ENDOFTEXT|>", "a" * 60, "\x1c", "b\x1fc", "ﬁ", "Straße", "ΣΑΣ", "σας", "été", "ÉTÉ", "e\u0301te", "Öl,", "öl,", "слово.", "İ", "ı", "ŉ", "ǆ", "ªº", "µ", "the", "Model", "co-op,"]
    gaps = [" ", "  ", "\n", "\t", " ", " ", "　", "\x85", "", " ", "\r\n"]
    texts = ["".join(x for _ in range(rng.randrange(40)) for x in (rng.choice(parts), rng.choice(gaps))) for _ in range(300)]
    monkeypatch.setattr(token_files, "REMEMBERED", 60)
    monkeypatch.setattr(token_files, "AT_ONCE", 50)
    encode = token_files.ChunkIds(Tokenizer.from_file(WORDS), "<u2").encode
    got = []
    for a in range(0, len(texts), 37):
        got += [np.frombuffer(b, "<u2").tolist() for b in encode(pa.array(texts[a:a + 37], pa.string()))]
    tokenizer = Tokenizer.from_file(WORDS)
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_many_files_and_mapped_access(spark, tmp_path):
    texts = [f"word{i} " * (i % 7) for i in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    folder = str(tmp_path / "corpus")
    manifest = token_files.write(docs, folder, WORDS, end_id=70_000, file_ids=50)
    assert manifest["dtype"] == "<u4" and len(manifest["files"]) > 8          # the end id needs four bytes
    open(f"{folder}/notes.ids", "wb").close()
    again = token_files.write(docs, folder, WORDS, end_id=2, file_ids=50)
    assert again["dtype"] == "<u2"
    left = {f.rsplit(".", 1)[0] for f in os.listdir(folder)}
    assert left == {f["name"] for f in again["files"]} | {"manifest", "notes"}
    corpus, want = token_files.TokenFiles(folder), plain(WORDS, texts, 2)
    assert len(corpus) == 200 and [corpus[i].tolist() for i in range(200)] == want
    assert isinstance(corpus.parts(0)[0], np.memmap)
    bases = [f["base"] for f in again["files"]]
    assert bases == np.cumsum([0, *(f["ids"] for f in again["files"])]).tolist()[:-1]
    check(token_files.read(spark, folder).collect(), range(200), want)
