"""Toxicity from the nearest labelled examples (op6).

Examples are a bounded sample of labelled documents (``EXAMPLES`` rows, those
of least hashed id).  All their terms make the vector space: tf-idf with
document frequencies counted over the whole corpus, each term weighted up by
how much it tells the labels apart (never down), scaled to length one.  The
examples go into an index in blocks with each term's largest weight in the
block, and every document that shares a term finds its ``NEAREST`` examples by
exact cosine: blocks whose bound cannot reach the current k-th score are
skipped, nothing else is.  The examples vote with weights that fall with
distance, and the share of votes is calibrated on the examples themselves,
each one scored without itself.

The examples' terms (at most ``EXAMPLES`` rows) and the term table are stored
in the shared folder; one task builds the index from them and writes it as flat
files, matrices included, which every worker maps into memory.  None of it passes the driver.  The
scoring pass is narrow.

Defined results: null and empty texts, and texts without any term of the
space, score the calibrated share of such examples; repeated rows each give
a row; a document labelled twice is toxic if one label says so, and of several
texts of one example the least counts; without any labelled row every score is ``NO_LABELS``; other columns
are ignored (``reject`` keeps them).
"""

from __future__ import annotations

import json
import math
import uuid
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.llm.kernels import ALNUM_WORDS, LOWER, U64, prefix_hash, span_hash, text_buffer, word_spans
from wagelens.llm.shared import discard, free_worker, give_back, id_and_text, least_hashed, mapped, opened, read_whole, scratch_path, small_batches, store, worker_memory

#: Bound of the fitted model.
EXAMPLES = 20_000
#: Besides words, their first bytes are terms (inflected and joined forms).
BEGINNINGS = (4, 5, 6, 7)
NEAREST = 15
BLOCK = 64
BINS = 20
THRESHOLD = 0.7
#: Terms of a cluster held as matrices (the rest as postings): at most so many,
#: and such whose share of its examples times that of all examples is over
#: ``COMMON``; clusters, and the terms that make them.
HOT, COMMON, CLUSTERS, COARSE = 4096, 0.003, 12, 512
#: A posting: the example's place and the term's weight in it.
ENTRY = np.dtype([("place", np.int32), ("weight", np.float32)])
#: Parts in which the postings are sorted, to bound what a worker holds meanwhile.
TERM_RANGES = 16
#: Rows scored together, and the error of single precision.
ROWS, SLACK = 128, 1e-5
#: Places of which the best one counts towards the k-th score.
GROUP = 32
NO_LABELS = 0.0
PRIOR = 2.0


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def row_terms(column, vocabulary: np.ndarray | None = None):
    """Distinct (row, term, count) of a text column in order and the number of
    rows.  Terms are words and their beginnings, as hashes; with a sorted
    ``vocabulary`` only its own, as places in it."""
    data, off = text_buffer(column)
    data = np.frombuffer(data.tobytes().translate(LOWER.tobytes()), np.uint8)
    start, end, row = word_spans(data, off, ALNUM_WORDS)
    if len(start) == 0:
        return np.zeros(0, np.int64), np.zeros(0, U64 if vocabulary is None else np.int64), np.zeros(0, np.int64), len(off) - 1
    prefix = prefix_hash(data)
    # Each different word of the batch is cut once.
    _, one, word = np.unique(span_hash(prefix, start, end), return_index=True, return_inverse=True)
    first, last = start[one], end[one]
    owner, cut = [], []
    for size in (0, *BEGINNINGS):
        longer = np.flatnonzero(last - first > size)
        owner.append(longer)
        cut.append(span_hash(prefix, first[longer], first[longer] + size if size else last[longer]) ^ U64(size))
    owner, cut = np.concatenate(owner), np.concatenate(cut)
    if vocabulary is None:
        known, term = np.unique(cut, return_inverse=True)
    else:
        # Searched in order, neighbours read the same part of the vocabulary.
        by, known, term = np.argsort(cut), vocabulary, np.empty(len(cut), np.int64)
        term[by] = np.searchsorted(vocabulary, cut[by])
        hit = known[np.minimum(term, len(known) - 1)] == cut if len(known) else np.zeros(len(cut), bool)
        owner, term = owner[hit], term[hit]
    order = np.argsort(owner, kind="stable")
    of_word = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(one)))))
    at, many = runs(of_word[word], of_word[word + 1])
    width = max(len(known), 1)
    key = np.sort(np.repeat(row, many) * width + term[order][at])
    new = np.flatnonzero(np.concatenate((np.ones(len(key[:1]), bool), key[1:] != key[:-1])))
    row, term = np.divmod(key[new], width)
    return row, known[term] if vocabulary is None else term, np.diff(np.append(new, len(key))), len(off) - 1


def runs(first: np.ndarray, last: np.ndarray):
    """Numbers of the ranges ``first[i]:last[i]`` one after the other, and their lengths."""
    many = last - first
    return np.arange(many.sum()) + np.repeat(first - (np.cumsum(many) - many), many), many


def count_terms(batches):
    """Partial counts (term, documents, positive documents) of a task."""

    def flush(parts):
        if parts:
            term, label = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            kind, at = np.unique(term, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind.view(np.int64)), pa.array(np.bincount(at, minlength=len(kind))),
                 pa.array(np.bincount(at, weights=label, minlength=len(kind)).astype(np.int64))], ["term", "n", "pos"])

    free_worker()
    parts, size = [], 0
    for batch in batches:
        row, term, _, _ = row_terms(batch.column("text"))
        parts.append((term, batch.column("toxic").to_numpy()[row]))
        size += len(term)
        if size > 2_000_000:
            yield from flush(parts)
            parts, size = [], 0
    yield from flush(parts)
    del parts
    give_back()


def count_documents(path: str):
    """Partial document counts of the vocabulary's terms, one array per task."""

    def run(batches):
        words, _ = words_of(path)
        n = np.zeros(len(words), np.int64)
        for batch in batches:
            _, term, _, _ = row_terms(batch.column("text"), words)
            n += np.bincount(term, minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(words[at].view(np.int64)), pa.array(n[at])], ["term", "df"])
        give_back()

    return run


def unit(row, term, tf, weight: np.ndarray, n: int):
    """Rows of unit vectors: (offsets, terms, weights)."""
    w = (1 + np.log(tf)) * weight[term]
    norm = np.sqrt(np.bincount(row, weights=w * w, minlength=n))
    return np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))), term, w / norm[row]


def vectors(column, model: SimpleNamespace):
    """Rows of unit vectors over the model's vocabulary."""
    row, term, tf, n = row_terms(column, model.vocabulary)
    return unit(row, term, tf, model.weight, n)


def clusters_of(example, terms, weights, n: int, n_terms: int) -> np.ndarray:
    """Cluster number of each example: k-means by cosine on the most frequent
    terms.  It decides which examples share a block, never a result."""
    df = np.bincount(terms, minlength=n_terms)
    place = np.full(n_terms, -1, np.int32)
    chosen = np.argsort(-df, kind="stable")[:COARSE]
    place[chosen] = np.arange(len(chosen))
    at = place[terms]
    dense = np.zeros((n, len(chosen)), np.float32)
    dense[example[at >= 0], at[at >= 0]] = weights[at >= 0]
    middle = dense[np.unique(np.linspace(0, n - 1, CLUSTERS).astype(int))]
    for _ in range(6):
        cluster = np.argmax(dense @ middle.T, axis=1)
        middle = np.stack([dense[cluster == c].sum(0) for c in range(len(middle))])
        middle /= np.maximum(np.sqrt((middle * middle).sum(1, keepdims=True)), 1e-9)
    return cluster


def build_index(off, terms, weights, n_terms: int, block: int = BLOCK, matrices: bool = True) -> SimpleNamespace:
    """All terms of the examples.  Like examples lie together in blocks of
    ``block`` places; the ``HOT`` most frequent terms of a cluster are one
    matrix per block, with the largest weight of each term in the block, and
    all other terms postings by term.  Without ``matrices`` the caller makes
    those one after the other."""
    off, terms, weights = np.asarray(off), np.asarray(terms, np.int32), np.asarray(weights, np.float32)
    n = len(off) - 1
    if n == 0:
        return SimpleNamespace(n=0, n_terms=n_terms)
    example = np.repeat(np.arange(n, dtype=np.int32), np.diff(off))
    if np.any((terms[1:] <= terms[:-1]) & (example[1:] == example[:-1])):
        order = np.lexsort((terms, example))
        terms, weights = terms[order], weights[order]
    cluster = clusters_of(example, terms, weights, n, n_terms)
    # A cluster fills whole blocks; places left over hold no example.
    place_of, held, parts, end = np.zeros(n, np.int32), [], [], 0
    kept, everywhere = np.ones(len(terms), bool), np.bincount(terms, minlength=n_terms)
    for c in np.unique(cluster):
        mine = np.flatnonzero(cluster == c)
        place_of[mine] = end + np.arange(len(mine))
        blocks = -(-len(mine) // block)
        held.append(np.pad(mine, (0, blocks * block - len(mine)), constant_values=-1))
        own = np.flatnonzero((cluster == c)[example])
        df = np.bincount(terms[own], minlength=n_terms)
        hot = np.argsort(-df, kind="stable")[:HOT]
        hot = hot[df[hot] / len(mine) * (everywhere[hot] / n) > COMMON]
        hot_at = np.full(n_terms, -1, np.int16)
        hot_at[hot] = np.arange(len(hot))
        h = hot_at[terms[own]]
        kept[own[h >= 0]] = False
        first = end // block
        parts.append(SimpleNamespace(first=first, last=first + blocks, hot_at=hot_at))
        end += blocks * block
    # The postings by term, made for one range of terms after the other.
    count = np.bincount(terms[kept], minlength=n_terms)
    start = np.concatenate(([0], np.cumsum(count)))
    posting = np.zeros(start[-1], ENTRY)
    edges = np.unique(np.searchsorted(start, np.linspace(0, start[-1], TERM_RANGES + 1)))
    for lo, hi in zip(edges, edges[1:]):
        rare = np.flatnonzero(kept & (terms >= lo) & (terms < hi))
        rare = rare[np.argsort(terms[rare], kind="stable")]
        mine = posting[start[lo]:start[lo] + len(rare)]
        mine["place"], mine["weight"] = place_of[example[rare]], weights[rare]
    index = SimpleNamespace(n=n, block=block, blocks=end // block, off=off, terms=terms, weights=weights, n_terms=n_terms, parts=parts, start=start,
                            posting=posting.view(np.int64), place_of=place_of, example=np.concatenate(held))
    for part in parts if matrices else []:
        part.matrix, part.top = matrix_of(index, part)
    return index


def matrix_of(index: SimpleNamespace, part: SimpleNamespace) -> tuple[np.ndarray, np.ndarray]:
    """The frequent terms of a part's examples as one matrix per block, and
    each term's largest weight in the block."""
    wide = int(part.hot_at.max(initial=-1)) + 1
    matrix = np.zeros((part.last - part.first, wide, index.block), np.float32)
    for at, e in enumerate(index.example[part.first * index.block:part.last * index.block].tolist()):
        if e >= 0:
            mine = slice(index.off[e], index.off[e + 1])
            h = part.hot_at[index.terms[mine]]
            matrix[at // index.block, h[h >= 0], at % index.block] = index.weights[mine][h >= 0]
    return matrix, matrix.max(2).T.copy()


def least_of(score: np.ndarray, k: int) -> np.ndarray:
    """What the ``k``-th score of each row reaches at least: the ``k``-th largest
    of the best of groups of places."""
    group = math.gcd(score.shape[2], GROUP)
    best = score.reshape(len(score), -1, group).max(2)
    return np.partition(best, -k, axis=1)[:, -k] if best.shape[1] >= k else np.zeros(len(score), np.float32)


def hide(score: np.ndarray, index: SimpleNamespace, without, a: int, z: int) -> None:
    """The example that row ``a``, ``a + 1``, ... may not find scores 0."""
    if without is not None:
        for i, e in enumerate(without[a:z]):
            if e >= 0:
                score[i].reshape(-1)[index.place_of[e]] = 0


def nearest_rows(index: SimpleNamespace, off, terms, weights, k: int, without=None):
    """Per row of unit vectors the ``k`` examples of largest cosine (> 0):
    [(cosine, example)], ties to the smaller example.  The postings are summed
    first; of the blocks those are scored whose bound reaches what the k-th
    cosine is at least by these sums."""
    asked = np.zeros(index.n_terms)
    for a in range(0, len(off) - 1, ROWS):
        z = min(a + ROWS, len(off) - 1)
        n, base = z - a, off[a]
        if index.n == 0 or off[z] == base:
            yield from ([] for _ in range(n))
            continue
        t, w = terms[base:off[z]], weights[base:off[z]]
        row, w32 = np.repeat(np.arange(n), np.diff(off[a:z + 1])), w.astype(np.float32)
        wide = index.blocks * index.block
        score = np.zeros((n, index.blocks, index.block), np.float32)
        for i in range(n):
            mine = slice(off[a + i] - base, off[a + i + 1] - base)
            at, many = runs(index.start[t[mine]], index.start[t[mine] + 1])
            if len(at):
                met = index.posting.take(at, mode="clip").view(ENTRY)
                score[i].reshape(-1)[:] = np.bincount(met["place"], weights=np.repeat(w32[mine], many) * met["weight"], minlength=wide)
        # The postings' sums are known; the matrices add at most their largest weights.
        hide(score, index, without, a, z)
        least = least_of(score, k)
        bound, queries = score.max(2), []
        for part in index.parts:
            h = part.hot_at[t]
            hot = np.flatnonzero(h >= 0)
            q = np.zeros((n, part.matrix.shape[1]), np.float32)
            q[row[hot], h[hot]] = w32[hot]
            queries.append(q)
            bound[:, part.first:part.last] += q @ part.top
        chosen = (bound > 0) & (bound >= (least - SLACK)[:, None])
        for part, q in zip(index.parts, queries):
            for b in (part.first + np.flatnonzero(chosen[:, part.first:part.last].any(0))).tolist():
                rows = np.flatnonzero(chosen[:, b])
                score[rows, b] += (q if len(rows) == n else q[rows]) @ part.matrix[b - part.first]
        hide(score, index, without, a, z)
        score[~chosen] = 0
        least = least_of(score, k)
        near = score.reshape(n, wide)
        near = (near > 0) & (near >= (least - SLACK)[:, None])
        for i in range(n):
            found = np.flatnonzero(near[i])
            if len(found) > k:
                value = score[i].ravel()[found]
                found = found[value >= np.partition(value, -k)[-k] - SLACK]
            if len(found) == 0:
                yield []
                continue
            # The last few are scored anew in double precision.
            found = index.example[found]
            mine = slice(off[a + i] - base, off[a + i + 1] - base)
            asked[t[mine]] = w[mine]
            cosine = np.array([asked.take(index.terms[x:y], mode="clip") @ index.weights[x:y].astype(float)
                               for x, y in zip(index.off[found].tolist(), index.off[found + 1].tolist())])
            asked[t[mine]] = 0
            best = np.lexsort((found, -np.round(cosine, 12)))[:k]
            yield list(zip(cosine[best].tolist(), found[best].tolist()))


def nearest(index: SimpleNamespace, terms, weights, k: int, without: int = -1):
    """``nearest_rows`` of a single vector."""
    return next(nearest_rows(index, np.array([0, len(terms)]), np.asarray(terms), np.asarray(weights), k, [without]))


def votes(found, labels) -> float:
    """Share of votes for the positive label; a nearer example weighs more."""
    weight = [1 / (1 - min(c, 1.0) + 0.05) for c, _ in found]
    return sum(w * labels[e] for w, (_, e) in zip(weight, found)) / sum(weight)


def words_of(path: str) -> tuple[np.ndarray, np.ndarray | None]:
    """The sorted vocabulary of a stored term table and, if it has them, the
    weights; read once per worker."""
    memory, key = worker_memory(), ("toxicity words", path)
    if key not in memory:
        # What a query's other operators, or its other steps, keep here is done with.
        free_worker()
        held = read_whole(path, None)
        term = held.column("term").to_numpy().view(U64)
        by = np.argsort(term)
        memory[key] = term[by], held.column("weight").to_numpy()[by] if "weight" in held.column_names else None
    return memory[key]


#: Arrays of the index and of one of its parts that are stored.
ARRAYS = ("off", "terms", "weights", "start", "posting", "place_of", "example")
PART_ARRAYS = ("hot_at", "matrix", "top")


def example_vectors(path: str, vocabulary: np.ndarray, weight: np.ndarray):
    """Ids, labels and unit vectors (offsets, terms, weights) of the stored examples."""
    rows = read_whole(path, ["doc_id", "toxic", "text"]).sort_by("doc_id").combine_chunks()
    off, terms, weights = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
    for batch in rows.to_batches(max_chunksize=ROWS):
        row, term, tf, n = row_terms(batch.column("text"), vocabulary)
        first, term, w = unit(row, term, tf, weight, n)
        off.append(first[1:] + off[-1][-1])
        terms.append(term.astype(np.int32))
        weights.append(w.astype(np.float32))
    return rows.column("doc_id").to_numpy(), rows.column("toxic").to_numpy(), np.concatenate(off), np.concatenate(terms), np.concatenate(weights)


def write_index(at: SimpleNamespace):
    """One task builds the index of the stored examples (their number is
    bounded) and writes its arrays as flat files beside a description."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([build()])], ["arrays"])
        free_worker()

    def build() -> int:
        vocabulary, weight = words_of(at.terms)
        ids, labels, off, terms, weights = example_vectors(at.examples, vocabulary, weight)
        give_back()
        index = build_index(off, terms, weights, len(vocabulary), matrices=False)
        parts = index.parts if index.n else []
        about = {"n": index.n, "n_terms": index.n_terms, "parts": [[int(p.first), int(p.last)] for p in parts], "arrays": {}}
        if index.n:
            about |= {"block": index.block, "blocks": int(index.blocks)}
        store, folder = opened(at.index)
        store.create_dir(folder, recursive=True)
        attempt = uuid.uuid4().hex[:12]

        def write(name: str, array) -> None:
            array = np.ascontiguousarray(array)
            about["arrays"][name] = [f"{name}-{attempt}", array.dtype.str, list(array.shape)]
            with store.open_output_stream(f"{folder}/{name}-{attempt}") as out:
                out.write(memoryview(array).cast("B") if array.size else b"")

        for name, array in {"vocabulary": vocabulary, "term_weight": weight, "ids": ids, "labels": labels}.items():
            write(name, array)
        for name in ARRAYS if index.n else []:
            write(name, getattr(index, name))
        # One part's matrices are held at a time.
        for i, part in enumerate(parts):
            for name, array in zip(PART_ARRAYS, (part.hot_at, *matrix_of(index, part))):
                write(f"{name}-{i}", array)
        # The description comes last: it names whole files only.
        with store.open_output_stream(f"{folder}/about.json") as out:
            out.write(json.dumps(about).encode())
        return len(about["arrays"])

    return run


def fitted(at: SimpleNamespace):
    """The model and its index, memory-mapped: the workers of a machine share
    one copy in its page cache.  The last one is kept open."""
    memory, key = worker_memory(), "toxicity index"
    if memory.get(key, (None,))[0] != at.index:
        free_worker()
        store, folder = opened(at.index)
        with store.open_input_stream(f"{folder}/about.json") as file:
            about = json.loads(file.read())
        held = {name: np.asarray(mapped(store, f"{folder}/{file}", dtype)).reshape(shape) for name, (file, dtype, shape) in about["arrays"].items()}
        model = SimpleNamespace(vocabulary=held["vocabulary"], weight=held["term_weight"], ids=held["ids"], labels=held["labels"])
        index = SimpleNamespace(n=about["n"], n_terms=about["n_terms"])
        if index.n:
            parts = [SimpleNamespace(first=a, last=z, **{name: held[f"{name}-{i}"] for name in PART_ARRAYS})
                     for i, (a, z) in enumerate(about["parts"])]
            index = SimpleNamespace(n=about["n"], n_terms=about["n_terms"], block=about["block"], blocks=about["blocks"], parts=parts,
                                    **{name: held[name] for name in ARRAYS})
        memory[key] = (at.index, model, index)
    return memory[key][1:]


def vote_rows(at: SimpleNamespace, k: int, itself: bool):
    """Raw share of votes per row (null: no example is near) and the evidence."""

    def run(batches):
        model, index = fitted(at)
        place = {d: i for i, d in enumerate(model.ids.tolist())} if itself else {}
        for batch in batches:
            off, terms, weights = vectors(batch.column("text"), model)
            without = [place[d] for d in batch.column("doc_id").to_pylist()] if itself else None
            raw, near, sim = [], [], []
            for found in nearest_rows(index, off, terms, weights, k, without):
                raw.append(votes(found, model.labels) if found else None)
                near.append([int(model.ids[e]) for _, e in found])
                sim.append([c for c, _ in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(raw, pa.float64()), pa.array(near, pa.list_(pa.int64())),
                 pa.array(sim, pa.list_(pa.float64()))], ["doc_id", "raw", "near", "cosine"])
        give_back()

    return run


RAW = "doc_id long, raw double, near array<long>, cosine array<double>"


def calibrate(counts: list[tuple], bins: int) -> list[float]:
    """Monotone probability per bin (pool adjacent violators) from
    (bin, rows, positive rows), smoothed towards the overall rate."""
    n, pos = [0.0] * bins, [0.0] * bins
    for b, rows, yes in counts:
        n[b], pos[b] = float(rows), float(yes)
    # Each bin starts with a little weight at its own middle.
    pools = [[p + PRIOR * (i + 0.5) / bins, m + PRIOR, 1] for i, (m, p) in enumerate(zip(n, pos))]
    out: list = []
    for pool in pools:
        out.append(pool)
        while len(out) > 1 and out[-2][0] / out[-2][1] >= out[-1][0] / out[-1][1]:
            last = out.pop()
            out[-1] = [a + b for a, b in zip(out[-1], last)]
    return [p / m for p, m, width in out for _ in range(width)]


def score(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted`` and the evidence
    (nearest examples and their cosines)."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = id_and_text(docs)
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"))
              .where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    marked = store(marked, "marked")
    chosen = least_hashed(marked, F.xxhash64("doc_id"), EXAMPLES).orderBy(F.xxhash64("doc_id"), "doc_id").limit(EXAMPLES)
    # Copies of a text count as one example, that of the least id.
    examples = store(texts.join(F.broadcast(chosen), "doc_id").where("text IS NOT NULL").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
                     .groupBy("text", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text", "toxic"), "examples", example_path := scratch_path(spark, "examples"))

    total, positive = examples.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counted = store(examples.select("text", "toxic").mapInArrow(count_terms, "term long, n long, pos long").groupBy("term")
                    .agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")), "term-counts", words := scratch_path(spark, "term-counts"))
    # How many documents of the corpus hold each term.
    spread = (texts.select("text").where("text IS NOT NULL").mapInArrow(count_documents(words), "term long, df long")
              .groupBy("term").agg(F.sum("df").alias("df")))
    documents = texts.where("text IS NOT NULL").count()
    at = SimpleNamespace(terms=scratch_path(spark, "terms"), examples=example_path, index=scratch_path(spark, "index"))
    store(counted.join(spread, "term", "left").fillna(0, ["df"])
          .mapInArrow(weigh_terms(documents, total, positive), "term long, weight float"), "terms", at.terms)
    discard(counted)
    spark.range(0, 1, 1, 1).mapInArrow(write_index(at), "arrays long").collect()

    own = examples.join(examples.select("doc_id", "text").mapInArrow(vote_rows(at, NEAREST, True), RAW), "doc_id")
    in_bin = F.when(F.col("raw").isNotNull(), F.least(F.floor(F.col("raw") * BINS), F.lit(BINS - 1)).cast("int"))
    counts = own.groupBy(F.coalesce(in_bin, F.lit(-1)).alias("bin")).agg(F.count("*"), F.sum("toxic")).collect()
    curve = calibrate([tuple(r) for r in counts if r[0] >= 0], BINS)
    far = next((((r[2] or 0) + 0.5 * PRIOR * (positive / max(total, 1))) / (r[1] + 0.5 * PRIOR) for r in counts if r[0] < 0),
               positive / total if total else NO_LABELS)

    raw = texts.mapInArrow(vote_rows(at, NEAREST, False), RAW)
    # Within a bin the raw share still orders documents, by a millionth at most.
    fine = F.element_at(F.array(*map(F.lit, curve)), in_bin + 1) * (1 - 1e-6) + F.col("raw") * 1e-6
    value = F.when(F.col("raw").isNull(), F.lit(float(far))).otherwise(fine)
    return raw.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score"),
                      (value >= THRESHOLD).cast("int").alias("predicted"), "near", "cosine")


def term_weights(documents: int, df, total: int, positive: int, n, pos) -> np.ndarray:
    """Weight of each term: idf over the corpus, times one plus the root of its
    chi-square among the examples' labels.  No term weighs less than its idf."""
    negative = total - positive
    d = float(positive) * negative * n * (total - n)
    chi = np.where(d > 0, total * (pos * negative - (n - pos) * positive) ** 2 / np.where(d > 0, d, 1.0), 0.0)
    return (np.log((documents + 1) / (df + 1)) + 1) * (1 + np.sqrt(chi))


def weigh_terms(documents: int, total: int, positive: int):
    def run(batches):
        for batch in batches:
            n, pos, df = (batch.column(c).to_numpy().astype(float) for c in ("n", "pos", "df"))
            weight = term_weights(documents, df, total, positive, n, pos).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("term"), pa.array(weight)], ["term", "weight"])

    return run


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic; all columns."""
    bad = score(docs, labels).where("predicted = 1").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti")
