"""Benchmark decontamination with an FM-index per shard of documents (op8).

A shard is a bounded run of documents inside one Spark task, so the whole
operator is one narrow pass without a shuffle.  Shard words are coded over
the alphabet of the test phrases' words; every other word separates.  The
shard's suffixes are sorted, its Burrows-Wheeler transform is kept in a
wavelet matrix, and all phrases run backward search together.  Occurrences
are located from sampled suffix positions and merged into removal spans.

Phrases travel to the tasks as a broadcast whose size is checked: above
``block_bytes`` of benchmark text they are split into blocks, and each block
makes a pass of its own over the documents with the spans found so far.

Defined results: null or wordless text has zero words and is clean; a null
or wordless item has no window; repeated rows each give a row; an empty
benchmark leaves every document clean; columns besides ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.llm.kernels import ALNUM_WORDS, word_hashes
from wagelens.llm.shared import blocks_for, materialize, small_batches

WINDOW = 13
#: Coded words in one index; bounds the memory of a task.
SHARD_WORDS = 1_000_000
SHARD_DOCS = 50_000
SAMPLE_EVERY = 8
#: Benchmark text bytes whose phrases are broadcast at once.
BLOCK_BYTES = 32 << 20

FOUND = "doc_id long, text string, n_words long, spans array<struct<start:int,end:int>>, items array<string>"


def code_phrases(ids: list, texts: list, window: int) -> SimpleNamespace:
    """Distinct windows of a block of items, coded over their own alphabet."""
    h, row, count = word_hashes(pa.array(texts, pa.string()), ALNUM_WORDS)
    alphabet = np.unique(h)
    code = np.searchsorted(alphabet, h) + 1
    first = np.concatenate(([0], np.cumsum(count))).astype(np.int64)
    seen: dict[tuple, list] = {}
    for i in range(len(ids)):
        words = code[first[i]:first[i + 1]].tolist()
        for j in range(max(1, len(words) - window + 1) if words else 0):
            seen.setdefault(tuple(words[j:j + window]), []).append(i)
    words = np.zeros((len(seen), window), np.int64)  # right-aligned
    for k, w in enumerate(seen):
        words[k, window - len(w):] = w
    owners = [np.unique(v) for v in seen.values()]
    length = np.array([len(w) for w in seen], np.int64)
    return SimpleNamespace(
        alphabet=alphabet, items=[None if x is None else str(x) for x in ids], words=words, length=length,
        owner=np.concatenate(owners) if owners else np.zeros(0, np.int64),
        owner_at=np.concatenate(([0], np.cumsum([len(v) for v in owners]))).astype(np.int64),
        shortest=int(length.min()) if len(length) else window)


def suffix_order(code: np.ndarray) -> np.ndarray:
    """Sorted suffixes of a text whose zeros are separators, each one distinct
    (ordered by place).  Prefix doubling; only unsettled suffixes are re-sorted."""
    n = len(code)
    first = np.where(code == 0, np.cumsum(code == 0) - 1, code + n)
    order = np.argsort(first, kind="stable")
    place, active, key = np.arange(n), order, first[order]
    rank = np.empty(n, np.int64)
    height = 1
    while True:
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        rank[active] = place[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        tied = ~(new & np.append(new[1:], True))
        place, active = place[tied], active[tied]
        if len(active) == 0:
            return order
        # The last place is a separator, so a tied suffix never reaches past it.
        key = rank[active] * np.int64(n + 1) + rank[active + height]
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        order[place] = active
        height *= 2


class FMIndex:
    """Burrows-Wheeler transform of a coded shard in a wavelet matrix."""

    def __init__(self, code: np.ndarray, alphabet: int, every: int = SAMPLE_EVERY):
        n = len(code)
        order = suffix_order(code)
        self.bwt = np.where(order > 0, code[order - 1], 0)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(code, minlength=alphabet + 2))))
        # Run starts (a separator precedes) and every few places are sampled.
        self.sampled = (self.bwt == 0) | (order % every == 0)
        self.sample = np.where(self.sampled, order, -1)
        self.levels = []
        rest = self.bwt
        for bit in range(max(1, int(alphabet + 1).bit_length()) - 1, -1, -1):
            ones = (rest >> bit) & 1
            count = np.concatenate(([0], np.cumsum(ones))).astype(np.int32)
            self.levels.append((bit, count, n - int(count[-1])))
            rest = np.concatenate((rest[ones == 0], rest[ones == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the first ``at`` symbols."""
        low, high = np.zeros_like(at), at
        for bit, count, zeros in self.levels:
            one = (symbol >> bit) & 1
            a, b = count[low].astype(np.int64), count[high].astype(np.int64)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return high - low

    def search(self, words: np.ndarray, length: np.ndarray):
        """Suffix ranges of right-aligned phrases: (phrase numbers, from, to)."""
        width = words.shape[1]
        which = np.arange(len(words))
        low, high = self.before[words[:, -1]], self.before[words[:, -1] + 1]
        for j in range(1, width + 1):
            live = low < high
            which, low, high = which[live], low[live], high[live]
            more = length[which] > j
            if j == width or not more.any():
                return which, low, high
            c = words[which[more], width - 1 - j]
            low, high = low.copy(), high.copy()
            low[more] = self.before[c] + self.rank(c, low[more])
            high[more] = self.before[c] + self.rank(c, high[more])

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix ranks, by walking back to a sampled one."""
        place = np.empty(len(rows), np.int64)
        open_, step = np.arange(len(rows)), 0
        while len(open_):
            done = self.sampled[rows]
            place[open_[done]] = self.sample[rows[done]] + step
            open_, rows = open_[~done], rows[~done]
            c = self.bwt[rows]
            rows = self.before[c] + self.rank(c, rows)
            step += 1
        return place


def find_in_shard(code: np.ndarray, doc: np.ndarray, phrases: SimpleNamespace):
    """Hit flag per coded word and the distinct (document, item) pairs."""
    index = FMIndex(code, len(phrases.alphabet))
    which, low, high = index.search(phrases.words, phrases.length)
    size = high - low
    which = np.repeat(which, size)
    rows = np.repeat(low - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
    place = index.locate(rows)
    cover = np.zeros(len(code) + 1, np.int64)
    np.add.at(cover, place, 1)
    np.add.at(cover, place + phrases.length[which], -1)
    owners = phrases.owner_at[which + 1] - phrases.owner_at[which]
    at = np.repeat(phrases.owner_at[which] - np.concatenate(([0], np.cumsum(owners)[:-1])), owners)
    item = phrases.owner[at + np.arange(int(owners.sum()))] if len(which) else np.zeros(0, np.int64)
    pairs = np.unique(np.repeat(doc[place], owners) * np.int64(len(phrases.items) + 1) + item)
    return np.cumsum(cover)[:-1] > 0, pairs // (len(phrases.items) + 1), pairs % (len(phrases.items) + 1)


def merge_spans(a: list, b: list) -> list:
    out: list = []
    for s, e in sorted([*((x["start"], x["end"]) for x in a or ()), *b]):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return [{"start": int(s), "end": int(e)} for s, e in out]


def scan_pass(shared, keep_text: bool):
    """One pass: Arrow batches of documents in, the same rows with merged
    spans and items out.  Rows gather until a shard is full."""

    def finish(held: list, phrases: SimpleNamespace):
        n = sum(b.num_rows for b, *_ in held)
        code = np.concatenate([x[1] for x in held])
        word = np.concatenate([x[2] for x in held])
        base = np.cumsum([0, *(b.num_rows for b, *_ in held)])
        doc = np.concatenate([x[3] + k for x, k in zip(held, base)])
        spans: dict[int, list] = {}
        found: dict[int, list] = {}
        if (code > 0).any():
            hit, d, i = find_in_shard(code, doc, phrases)
            for a, b in zip(d.tolist(), i.tolist()):
                found.setdefault(a, []).append(phrases.items[b])
            edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
            for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                spans.setdefault(int(doc[s]), []).append((int(word[s]), int(word[e - 1]) + 1))
        k = 0
        for b, _, _, _, count in held:
            old_s, old_i = b.column("spans").to_pylist(), b.column("items").to_pylist()
            new_s = [merge_spans(x, spans.get(k + j, [])) for j, x in enumerate(old_s)]
            new_i = [sorted({*(x or ()), *(y for y in found.get(k + j, ()) if y is not None)}) for j, x in enumerate(old_i)]
            text = b.column("text") if keep_text else pa.nulls(b.num_rows, pa.string())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), text.cast(pa.string()), pa.array(count, pa.int64()), pa.array(new_s, kind),
                 pa.array(new_i, pa.list_(pa.string()))], ["doc_id", "text", "n_words", "spans", "items"])
            k += b.num_rows
        assert k == n

    def code_batch(batch, phrases: SimpleNamespace):
        h, row, count = word_hashes(batch.column("text"), ALNUM_WORDS)
        if len(phrases.alphabet) == 0 or len(h) == 0:
            z = np.zeros(0, np.int64)
            return z, z, z, count
        at = np.minimum(np.searchsorted(phrases.alphabet, h), len(phrases.alphabet) - 1)
        known = phrases.alphabet[at] == h
        first = np.concatenate(([0], np.cumsum(count)))
        number = np.arange(len(h)) - first[row]
        # Runs of phrase words long enough to hold the shortest phrase.
        start = np.flatnonzero(known & ~(np.concatenate(([False], known[:-1])) & (number > 0)))
        last = np.concatenate((known[1:] & (number[1:] > 0), [False]))
        end = np.flatnonzero(known & ~last) + 1
        long = end - start >= phrases.shortest
        start, size = start[long], (end - start)[long] + 1  # one more for the separator
        at_word = np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
        sep = np.zeros(len(at_word), bool)
        sep[np.cumsum(size) - 1] = True
        at_word[sep] -= 1
        code = np.where(sep, 0, at[at_word] + 1)
        return code, number[at_word], row[at_word], count

    def run(batches):
        phrases = shared.value
        held, words, docs = [], 0, 0
        for batch in batches:
            part = code_batch(batch, phrases)
            if not keep_text:
                batch = batch.drop_columns(["text"]).append_column("text", pa.nulls(batch.num_rows, pa.string()))
            held.append((batch, *part))
            words, docs = words + len(part[0]), docs + batch.num_rows
            if words >= SHARD_WORDS or docs >= SHARD_DOCS:
                yield from finish(held, phrases)
                held, words, docs = [], 0, 0
        if held:
            yield from finish(held, phrases)

    return run


def find_phrases(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: word count, merged hit spans (word numbers, end
    exclusive) and the items found."""
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text IS NOT NULL")
    blocks = blocks_for(items.agg(F.sum(F.octet_length("text"))).first()[0], block_bytes)
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"))
    for k in range(blocks):
        # At most about block_bytes of benchmark text reach the driver at once.
        rows = (items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items).collect()
        phrases = code_phrases([r[0] for r in rows], [r[1] for r in rows], window)
        out = out.mapInArrow(scan_pass(spark.sparkContext.broadcast(phrases), k < blocks - 1), FOUND)
        if k < blocks - 1:
            out = materialize(out)
    return out.drop("text")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, hit words, items, and the contamination decision
    (at least one word in twenty is hit)."""
    found = find_phrases(docs, benchmark, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "spans")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = contamination(docs, benchmark).where("contaminated").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti")
