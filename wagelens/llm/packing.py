"""Best-fit packing of tokenised documents into sequences (op7).

Planning works on the histogram of piece lengths, not on documents: at most
``capacity`` counts reach the driver whatever the size of the corpus.  Best
fit runs over groups of equal lengths and equal open sequences, so the plan
is a short list of slot runs "n pieces of length L, from rank r on, go to
sequences s, s+1, ... at place p".  Pieces then take their slots by their
rank within the length; ranks run within hash buckets of a length, so a
length that holds a third of all pieces is not one task's work.

Defined results: null text is empty and has the closing id alone; repeated
rows are packed as often as they occur; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.shared import id_and_text, small_batches, store

CAPACITY = 2048
END_ID = 0
#: Words, and chunks of text, whose ids a task remembers.
REMEMBERED = 500_000

#: Fixed value: how byte-level tokenizers of this kind cut a text into words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_MARKS = frozenset(".,")
COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_symbols() -> dict[int, str]:
    """The printable character by which a byte-level vocabulary spells each
    byte: itself where printable, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(other)}


def tokenizer_path() -> str:
    """The tokenizer file of the registered query; ``pack`` takes any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def chunk_encoder(path: str):
    """``text -> little-endian ids`` with remembered parts.

    A byte-level BPE splits a text into words before merging, and a word
    takes along one space in front.  Cutting before a space therefore never
    changes ids, unless the space stands between two other white-space
    characters or the text holds a special token; such texts are encoded
    whole.  Chunks between spaces repeat, and so do the words within new
    chunks; only a new word goes through the merges."""
    import re

    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if type(tokenizer.pre_tokenizer).__name__ != "ByteLevel":
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    words_of, merge = regex.compile(WORD).findall, tokenizer.model.tokenize
    symbols = byte_symbols()
    odd = re.compile(r" (?<=\s )(?=\s)").search

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            spelled = word.encode().decode("latin-1").translate(symbols)
            out = np.array([t.id for t in merge(spelled)], "<u4").tobytes()
            if len(self) < REMEMBERED:
                self[word] = out
            return out

    class Chunks(dict):
        def __missing__(self, chunk: str) -> bytes:
            if chunk.isalpha():
                out = words[" " + chunk]
            elif chunk[-1:] in END_MARKS and chunk[:-1].isalpha():
                out = words[" " + chunk[:-1]] + words[chunk[-1]]
            else:
                out = b"".join([words[w] for w in words_of(" " + chunk)])
            if len(self) < REMEMBERED:
                self[chunk] = out
            return out

    words, chunks = Words(), Chunks()

    def ids(text: str) -> bytes:
        if "<|" in text or odd(text) or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        return b"".join([*(words[w] for w in words_of(first)), *map(chunks.__getitem__, rest)])

    return ids


def cut_pieces(tokenizer_path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        ids = chunk_encoder(tokenizer_path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                raw = ids(text or "") + end
                n = len(raw) // 4
                # The first piece takes the remainder, so later ones are full.
                at, k = 0, 0
                size = n % capacity or min(n, capacity)
                while at < n:
                    rows.append((doc, k, at, size, zlib.crc32(raw[4 * at:4 * (at + size)])))
                    at, k, size = at + size, k + 1, capacity
            cols = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def plan_slots(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Returns slot runs (length, first rank, pieces, first sequence, offset).
    Open sequences of one free size form groups of consecutive numbers; a
    step fills a whole group or uses up a length, so runs stay few."""
    runs, free, opened = [], {}, 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            fits = [f for f in free if f >= length and free[f]]
            if fits:
                best = min(fits)
                first, n = free[best].pop()
                take = min(n, left)
                if take < n:
                    free[best].append((first + take, n - take))
            else:
                best, first, take = capacity, opened, left
                # New sequences that this length fills as far as it can; a last one for the rest.
                take = max(1, left // (capacity // length))
                opened += take
            runs.append((length, rank, take, first, capacity - best))
            free.setdefault(best - length, []).append((first, take))
            rank, left = rank + take, left - take
    return runs


def take_slots(shared):
    """Each piece takes the slot of its rank within its length."""

    def run(batches):
        length, lo, seq, off = shared.value
        begin = length * (np.int64(1) << 44) + lo
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            k = np.searchsorted(begin, batch.column("length").to_numpy() * (np.int64(1) << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in COLUMNS), pa.array(seq[k] + rank - lo[k]), pa.array(off[k])],
                [*COLUMNS, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its sequence and place."""
    spark = docs.sparkSession
    small_batches(spark)
    pieces = store(id_and_text(docs).mapInArrow(cut_pieces(tokenizer_path, capacity, end_id), PIECES), "pieces")
    # A length may hold a third of all pieces: ranks run within (bucket, length)
    # and each bucket starts where the ones before it end.
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (pieces.withColumn("row", F.row_number().over(within)).join(first, ["length", "bucket"])
              .select(*COLUMNS, (F.col("first") + F.col("row") - 1).alias("rank")))
    # At most ``capacity`` rows.
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    runs = sorted(plan_slots(histogram, capacity))
    table = np.array(runs, np.int64).reshape(-1, 5)
    slots = spark.sparkContext.broadcast((table[:, 0], table[:, 1], table[:, 3], table[:, 4]))
    return ranked.mapInArrow(take_slots(slots), PIECES + ", sequence_id long, offset long")
