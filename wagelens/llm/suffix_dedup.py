"""Suffix-array removal of repeated passages (op5).

A byte goes when a ``length``-byte string that covers it also starts in a
document with a smaller doc_id.  Only places that can take part are sorted:

1. Every ``length``-byte string has an anchor: its ``GRAM``-byte piece of
   least hash.  Strings that follow each other share anchors, so a document
   is a chain of fragments, one an anchor.  Anchor hashes of a block of
   documents travel as sorted byte arrays to hash buckets; a bucket marks the
   anchors that it meets in two blocks (a block marks those it meets twice
   itself and sends one copy).  Equal strings have equal anchors, so nothing
   outside marked fragments can repeat.
2. Marked fragments go to suffix shards by anchor, equal ones of a block as
   one with the list of their places, all of a block and shard as one
   compressed row.  Fragments of a very frequent anchor
   are cut into their strings and dealt by string, so that no anchor fills a
   shard.
3. A shard builds its suffix array by induced sorting, finds in permuted
   order which suffixes share ``length`` bytes with the one before, and gives
   each string the least doc_id that holds it.
4. Spans of strings with a smaller owner travel packed in the same way to
   buckets of documents, are merged per document and cut out.

Defined results: null text is empty; texts below ``length`` bytes stay whole;
rows of equal doc_id do not remove from each other; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.llm.kernels import BASE, U64, mix, prefix_hash, span_hash, text_buffer
from wagelens.llm.shared import discard, id_and_text, small_batches, store
from wagelens.llm.suffix_array import shares_with_previous, suffix_array

LENGTH = 50
GRAM = 16  # a power of two, at most LENGTH
#: Anchors of one block: bounds what a task holds before it sends.
BLOCK_ANCHORS = 1_000_000
BLOCK_BYTES = 8 << 20
#: Bytes of one suffix shard.
SHARD_BYTES = 4 << 20
#: An anchor this frequent within one block counts as very frequent; the list
#: only decides how its fragments are dealt.
FREQUENT_IN_BLOCK = 64
FREQUENT = 100_000
#: Places hashed together: what fits a processor's own cache.
PIECE = 1 << 16
SEPARATOR = 0xFF  # occurs in no UTF-8 text


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``GRAM`` bytes from each place on, by doubling."""
    h = (data.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15)
    n = 1
    while n < GRAM:
        h = h[:-n] * U64(BASE) ^ (h[n:] + (h[n:] >> U64(29)))
        h ^= h >> U64(32)
        n *= 2
    return h * U64(0x94D049BB133111EB)


def anchors(h: np.ndarray, length: int) -> np.ndarray:
    """Place of the ``GRAM``-byte piece of least hash in each string of ``length``
    bytes, the first of equal ones."""
    key = (h & ~U64((1 << 28) - 1)) | np.arange(len(h), dtype=U64)
    width, n = length - GRAM + 1, 1
    while 2 * n <= width:
        key = np.minimum(key[:-n], key[n:])
        n *= 2
    if n < width:
        key = np.minimum(key[:-(width - n)], key[width - n:])
    return (key & U64((1 << 28) - 1)).astype(np.int64)


def fragments(data: np.ndarray, off: np.ndarray, length: int = LENGTH):
    """Chains of strings with a common anchor: (row, first string's place,
    number of strings, anchor hash), in text order."""
    z = np.zeros(0, np.int64)
    if len(data) < length:
        return z, z, z, np.zeros(0, U64)
    anchor, h = np.empty(len(data) - length + 1, np.int64), np.empty(len(data) - GRAM + 1, U64)
    for at in range(0, len(anchor), PIECE):
        piece = gram_hashes(data[at:at + PIECE + length - 1])
        h[at:at + len(piece)] = piece
        anchor[at:at + PIECE] = anchors(piece, length) + at
    # Strings that would cross the end of their row do not count.
    whole = np.ones(len(anchor) + length, bool)
    for j in off[1:].tolist():
        whole[max(0, j - length + 1):j] = False
    whole = whole[:len(anchor)]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    start = np.flatnonzero(new & whole)
    edge = np.flatnonzero(new | ~whole)
    nxt = np.append(edge, len(anchor))[np.searchsorted(edge, start, side="right")]
    return np.searchsorted(off, start, side="right") - 1, start, nxt - start, h[anchor[start]]


def send_anchors(buckets: int):
    """Blocks of documents: anchors to hash buckets, and per block one row with
    its documents and the anchors that it holds in two or more of them."""

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        held, size = [], 0
        for batch in batches:
            data, off = text_buffer(batch.column("text"))
            row, _, _, anchor = fragments(data, off)
            held.append((np.array(batch.column("doc_id").to_pylist(), object), np.bincount(row, minlength=len(off) - 1), anchor))
            size += len(anchor)
            if size >= BLOCK_ANCHORS:
                yield from flush(held, (task << 32) + number)
                held, size, number = [], 0, number + 1
        if held:
            yield from flush(held, (task << 32) + number)

    def flush(held, block):
        docs = np.concatenate([x[0] for x in held])
        count = np.concatenate([x[1] for x in held])
        anchor = np.concatenate([x[2] for x in held])
        row = np.repeat(np.arange(len(docs)), count)
        order = np.argsort(anchor, kind="stable")
        a, r = anchor[order], row[order]
        new = np.ones(len(a), bool)
        new[1:] = a[1:] != a[:-1]
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(a)))
        many = np.minimum.reduceat(r, first) != np.maximum.reduceat(r, first) if len(a) else np.zeros(0, bool)
        each = np.repeat(many, sizes)
        own = np.sort(order[each]).astype("<u4")
        some = docs != None  # noqa: E711  (an object array)
        ids = np.where(some, docs, 0).astype("<i8")
        out = [(buckets, block, 0, np.concatenate((ids.view("u1"), some.astype("u1"), count.astype("<u4").view("u1"))).tobytes(),
                own.tobytes(), len(docs))]
        # One copy of an anchor known to repeat, all of the others.
        send = ~each
        send[first[many]] = True
        a, place = a[send], np.where(each[send], np.uint32(0xFFFFFFFF), order[send].astype(np.uint32)).astype("<u4")
        into = (a >> U64(40)).astype(np.int64) * buckets >> 24
        cut = np.searchsorted(into, np.arange(buckets + 1))
        for b in range(buckets):
            if cut[b] < cut[b + 1]:
                out.append((b, block, 1, a[cut[b]:cut[b + 1]].astype("<u8").view("u1").reshape(-1, 8)[:, :6].tobytes(),
                            place[cut[b]:cut[b + 1]].tobytes(), 0))
        hot = sizes >= FREQUENT_IN_BLOCK
        if hot.any():
            out.append((buckets, block, 2, anchor[order][first[hot]].tobytes(), sizes[hot].astype("<i8").tobytes(), 0))
        for row_ in out:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row_, (
                pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64()))], ["bucket", "block", "kind", "a", "b", "n"])

    return run


SENT = "bucket int, block long, kind int, a binary, b binary, n long"


def mark_shared(batches):
    """Places of anchors that two blocks of a bucket hold, per block."""
    by_bucket: dict[int, list] = {}
    for batch in batches:
        for bucket, block, a, b in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "a", "b"))):
            raw = np.zeros((len(a) // 6, 8), np.uint8)
            raw[:, :6] = np.frombuffer(a, np.uint8).reshape(-1, 6)
            by_bucket.setdefault(bucket, []).append((block, raw.view("<u8").ravel(), np.frombuffer(b, "<u4")))
    for parts in by_bucket.values():
        names = np.array([p[0] for p in parts], np.int64)
        block = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
        anchor, place = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        order = np.argsort(anchor, kind="stable")
        a, b, p = anchor[order], block[order], place[order]
        first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        shared = np.minimum.reduceat(b, first) != np.maximum.reduceat(b, first)
        keep = np.repeat(shared, np.diff(np.append(first, len(a)))) & (p != 0xFFFFFFFF)
        b, p = b[keep], p[keep]
        by = np.argsort(b, kind="stable")
        b, p = b[by], p[by]
        cut = np.searchsorted(b, np.arange(len(parts) + 1))
        full = np.flatnonzero(cut[1:] > cut[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[full]), pa.array([p[cut[i]:cut[i + 1]].tobytes() for i in full], pa.binary())], ["block", "places"])


def marks_of_block(frame):
    """Per document of a block: the numbers of its marked fragments."""
    import pandas as pd

    out = {"doc_id": [], "marks": []}
    head = frame[frame["a"].notna()]
    if len(head):
        raw, n = head["a"].iloc[0], int(head["n"].iloc[0])
        ids, some = np.frombuffer(raw[:8 * n], "<i8"), np.frombuffer(raw[8 * n:9 * n], "u1")
        first = np.concatenate(([0], np.cumsum(np.frombuffer(raw[9 * n:], "<u4").astype(np.int64))))
        places = np.unique(np.concatenate([np.frombuffer(x, "<u4") for x in frame["places"]]))
        cut = np.searchsorted(places, first)
        for i in np.flatnonzero((cut[1:] > cut[:-1]) & (some == 1)).tolist():
            out["doc_id"].append(int(ids[i]))
            out["marks"].append((places[cut[i]:cut[i + 1]] - first[i]).astype("<u4").tobytes())
    return pd.DataFrame(out).astype({"doc_id": "int64"})


def send_fragments(shared, length: int, shards: int):
    """Marked fragments of a block of documents, equal ones once, with places."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, off = text_buffer(batch.column("text"))
            row, start, n, anchor = fragments(data, off, length)
            first = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(off) - 1))))
            chosen = np.zeros(len(row), bool)
            for i, m in enumerate(batch.column("marks").to_pylist()):
                if m:
                    number = np.frombuffer(m, "<u4").astype(np.int64)
                    chosen[first[i] + number] = True
            ids = batch.column("doc_id").to_numpy()
            row, start, n, anchor = row[chosen], start[chosen], n[chosen], anchor[chosen]
            held.append((data, ids[row], start, start - off[row], n, anchor))
            size += len(data)
            if size >= BLOCK_BYTES:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    def flush(held):
        data = np.concatenate([x[0] for x in held])
        base = np.cumsum([0, *(len(x[0]) for x in held)])
        doc, _, local, n, anchor = (np.concatenate([x[i] for x in held]) for i in range(1, 6))
        start = np.concatenate([x[2] + k for x, k in zip(held, base)])
        if len(doc) == 0:
            return
        key = anchor.copy()
        frequent = shared.value
        if len(frequent):
            hot = frequent[np.minimum(np.searchsorted(frequent, anchor), len(frequent) - 1)] == anchor
            if hot.any():  # their strings one by one, dealt by string
                each = n[hot]
                step = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
                more = [np.repeat(x[hot], each) for x in (doc, start, local)]
                more[1], more[2] = more[1] + step, more[2] + step
                doc, start, local = (np.concatenate((x[~hot], y)) for x, y in zip((doc, start, local), more))
                n = np.concatenate((n[~hot], np.ones(len(step), np.int64)))
                key = np.concatenate((key[~hot], np.zeros(len(step), U64)))
        content = span_hash(prefix_hash(data), start, start + n + length - 1)
        # Only the shard travels: a hash of eight bytes a row would not compress.
        shard = (mix(np.where(key == 0, content, key)) % U64(shards)).astype(np.int32)
        # Equal fragments of the block become one, in the order of the texts.
        order = np.lexsort((doc, content))
        c = content[order]
        first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
        many = np.diff(np.append(first, len(c)))
        rep = order[first]
        by = np.lexsort((rep, shard[rep]))
        first, many, rep = first[by], many[by], rep[by]
        edge = np.flatnonzero(np.concatenate(([True], shard[rep][1:] != shard[rep][:-1])))
        rows, held = [], 0
        for lo, hi in zip(edge, np.append(edge[1:], len(rep))):
            r = rep[lo:hi]
            size, each = n[r] + length - 1, order[ranges(first[lo:hi], many[lo:hi])]
            rows.append((int(shard[r[0]]), *packed(size.astype("<u4"), many[lo:hi].astype("<u4"), steps(doc[each]), local[each].astype("<u4"),
                                                   data[ranges(start[r], size)])))
            held += len(rows[-1][-1])
            if held >= SHARD_BYTES:  # bounded batches
                yield row_batch(rows, "shard")
                rows, held = [], 0
        if rows:
            yield row_batch(rows, "shard")

    return run


def steps(ids: np.ndarray) -> np.ndarray:
    """Ids as the difference to the one before: near ones become small."""
    return np.diff(ids.astype(np.int64), prepend=np.int64(0)).astype("<i8")


def packed(*arrays: np.ndarray) -> tuple[list[int], bytes]:
    """Byte lengths of the arrays, and all of them compressed as one."""
    parts = [a.tobytes() for a in arrays]
    return [len(p) for p in parts], pa.compress(b"".join(parts), codec="zstd", asbytes=True)


def unpacked(lengths: list[int], body: bytes, types: tuple[str, ...]) -> list[np.ndarray]:
    raw = pa.decompress(body, decompressed_size=sum(lengths), codec="zstd", asbytes=True)
    at = np.cumsum([0, *lengths])
    return [np.frombuffer(raw[a:z], t) for a, z, t in zip(at, at[1:], types)]


def row_batch(rows: list[tuple], key: str) -> pa.RecordBatch:
    to, lengths, body = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(lengths, pa.list_(pa.int64())), pa.array(body, pa.binary())], [key, "lengths", "body"])


def sort_shard(length: int, buckets: int):
    """Suffix array of a shard's fragments; spans of repeated strings, packed
    for the bucket of their document."""

    def run(batches):
        # One partition may hold several shards; each is sorted by itself.
        shards: dict[int, list] = {}
        for batch in batches:
            for s, lengths, body in zip(*(batch.column(c).to_pylist() for c in ("shard", "lengths", "body"))):
                shards.setdefault(s, []).append((lengths, body))
        for s in sorted(shards):
            doc, start, stop = resolve([unpacked(*p, ("<u4", "<u4", "<i8", "<u4", "u1")) for p in shards.pop(s)])
            bucket = (mix(doc.astype(U64)) % U64(buckets)).astype(np.int32)
            order = np.lexsort((start, doc, bucket))
            bucket, doc, start, size = bucket[order], doc[order], start[order].astype("<u4"), (stop - start)[order].astype("<u4")
            cut = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows = [(int(bucket[a]), *packed(steps(doc[a:z]), start[a:z], size[a:z])) for a, z in zip(cut, np.append(cut[1:], len(doc)))]
            if rows:
                yield row_batch(rows, "bucket")

    def resolve(parts):
        size, many, data, place = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 4, 3))
        size, many, place = size.astype(np.int64), many.astype(np.int64), place.astype(np.int64)
        doc = np.concatenate([np.cumsum(p[2]) for p in parts])
        off = np.concatenate(([0], np.cumsum(size)))
        # Equal fragments of several blocks become one part.
        _, rep, part = np.unique(span_hash(prefix_hash(data), off[:-1], off[1:]), return_index=True, return_inverse=True)
        size = size[rep]
        begin = np.cumsum(size + 1) - size - 1
        text = np.full(int((size + 1).sum()), SEPARATOR, np.uint8)
        text[ranges(begin, size)] = data[ranges(off[rep], size)]
        part = np.repeat(part, many)
        owner = np.full(len(rep), np.iinfo(np.int64).max)
        np.minimum.at(owner, part, doc)

        order = suffix_array(text, 256)
        joined = shares_with_previous(text, order, length)[order]
        group = np.flatnonzero(~joined)
        holder = np.repeat(np.arange(len(rep)), size + 1)
        least = np.minimum.reduceat(owner[holder[order]], group)
        of_string = np.empty(len(text), np.int64)
        of_string[order] = np.repeat(least, np.diff(np.append(group, len(text))))

        strings = size - length + 1
        first = np.cumsum(strings) - strings
        owners = of_string[ranges(begin, strings)]
        top, low = np.maximum.reduceat(owners, first), np.minimum.reduceat(owners, first)
        whole = doc > top[part]  # every string of the fragment repeats
        some = np.flatnonzero(~whole & (doc > low[part]))
        n = strings[part[some]]
        who = np.repeat(np.arange(len(some)), n)
        gone = owners[ranges(first[part[some]], n)] < doc[some][who]
        edge = np.ones(len(who) + 1, bool)
        edge[1:-1] = (who[1:] != who[:-1]) | (gone[1:] != gone[:-1])
        cut = np.flatnonzero(edge)
        a, b = cut[:-1][gone[cut[:-1]]], cut[1:][gone[cut[:-1]]]
        at = some[who[a]] if len(a) else np.zeros(0, np.int64)
        base = place[at] - (np.cumsum(n) - n)[who[a]] if len(a) else np.zeros(0, np.int64)
        out_doc = np.concatenate((doc[whole], doc[at]))
        start = np.concatenate((place[whole], base + a))
        stop = np.concatenate((place[whole] + size[part[whole]], base + b + length - 1))
        return out_doc, start, stop

    return run


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ...`` for ``size[i]`` numbers, all in a row."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def merge_spans(batches):
    """Per document the maximal runs of its spans, as (start, end) pairs."""
    parts = [unpacked(lengths, body, ("<i8", "<u4", "<u4")) for batch in batches
             for lengths, body in zip(batch.column("lengths").to_pylist(), batch.column("body").to_pylist())]
    if not parts:
        return
    ids, who = np.unique(np.concatenate([np.cumsum(p[0]) for p in parts]), return_inverse=True)
    start, size = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (1, 2))
    order = np.lexsort((start, who))
    who, start, size = who[order], start[order], size[order]
    # Places of one document after those of the one before, never adjacent.
    base = who.astype(np.int64) << 33
    reach = np.maximum.accumulate(base + start + size)
    new = np.concatenate(([True], (base + start)[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(who)) - 1
    pairs = np.stack((start[first], reach[last] - base[last]), axis=1).astype("<u4")
    cut = np.searchsorted(who[first], np.arange(len(ids) + 1))
    for a in range(0, len(ids), 20_000):
        z = min(a + 20_000, len(ids))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[a:z]), pa.array([pairs[cut[i]:cut[i + 1]].tobytes() for i in range(a, z)], pa.binary())], ["doc_id", "spans"])


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, spans): the byte runs to remove of each document that has any,
    as pairs of 32-bit start and end."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = id_and_text(docs)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 2 * partitions
    sent = store(texts.mapInArrow(send_anchors(buckets), SENT), "anchors")
    met = store(sent.where("kind = 1").repartition(partitions, "bucket").mapInArrow(mark_shared, "block long, places binary"), "met")
    heads = sent.where("kind = 0").select("block", "a", F.col("b").alias("places"), "n")
    known = heads.unionByName(met.select("block", F.lit(None).cast("binary").alias("a"), "places", F.lit(0).cast("long").alias("n")))
    marks = store(known.groupBy("block").applyInPandas(marks_of_block, "doc_id long, marks binary"), "marks")

    # Very frequent anchors: a list of at most FREQUENT hashes.
    hot: dict[int, int] = {}
    counts = sent.where("kind = 2").select("a", "b").mapInArrow(unpack_counts, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    for r in counts.orderBy(F.desc("n"), "anchor").limit(FREQUENT).collect():
        hot[r[0]] = r[1]
    shared = spark.sparkContext.broadcast(np.sort(np.array(list(hot), np.int64).view(U64)))
    for done in (sent, met):
        discard(done)
    # A mark stands for one fragment of about ``length`` and a third bytes.
    size = (marks.agg(F.sum(F.octet_length("marks"))).first()[0] or 0) // 4 * (length + length // 3)
    shards = max(partitions, -(-size // SHARD_BYTES))
    marked = texts.where("doc_id IS NOT NULL").join(marks, "doc_id")
    parts = marked.select("doc_id", "text", "marks").mapInArrow(
        send_fragments(shared, length, shards), "shard int, lengths array<long>, body binary")
    spans = parts.repartition(shards, "shard").mapInArrow(sort_shard(length, buckets), "bucket int, lengths array<long>, body binary")
    return store(spans.repartition(partitions, "bucket").mapInArrow(merge_spans, "doc_id long, spans binary"), "spans")


def unpack_counts(batches):
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(a, np.int64)), pa.array(np.frombuffer(b, "<i8"))], ["anchor", "n"])


def summarise(batches):
    for batch in batches:
        rows = []
        for doc, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
            raw = (text or "").encode()
            runs = np.frombuffer(spans or b"", "<u4").reshape(-1, 2).tolist()
            at, kept = 0, hashlib.sha256()
            for a, b in runs:
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            rows.append((doc, len(raw), sum(b - a for a, b in runs), len(runs), kept.hexdigest()))
        cols = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.string()])],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    return id_and_text(docs).join(repeated_spans(docs, length), "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(
        summarise, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
