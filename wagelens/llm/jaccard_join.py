"""N-gram Jaccard join with a token-group matrix (op3).

Sets of distinct 4-word shingles link when 100 * overlap >= 85 * union.

1. Documents with equal sets form a class; its least doc_id represents it.
2. Tokens are ordered rare first (a bounded list of frequent tokens, counted
   over all documents, goes last).  Two linked sets share a token among the
   first ``n - ceil(0.85 n) + 1`` of each, so only those are joined, and only
   representatives that share one are looked at further.
3. Similar sets are partitioned into groups: verified links to a few leaders
   per min-hash key give clusters, cut into groups of about ``GROUP`` sets.
   The clusters are linked already, so no pair inside one is needed.
4. The token-group matrix holds, for each group, its token union counted over
   token buckets.  A query (a set of another cluster that shares a prefix
   token) bounds its overlap with the group from the two rows; only
   qualifying groups are opened.  A pair's bound is taken once more from
   sketches as fine as the sets are large, and what is left compared exactly.
5. Connected components of all links.

No pair of equal texts and no pair within a cluster is ever made, so a group
of copies costs rows in proportion to its size; between clusters nothing is
left out: steps 2 and 4 only discard what the threshold rules out.  Whole sets travel only
for pairs that the sketches (a byte per two to four tokens) leave.

Defined results: null, empty and wordless texts have no shingles and are
their own component; repeated rows each give a row; an empty table gives no
rows; other columns are ignored (``one_per_group`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.llm.components import components
from wagelens.llm.kernels import U64, fold64, mix, shingle_sets
from wagelens.llm.shared import by_ids, free_worker, id_and_text, small_batches, store

WIDTH = 4
PERCENT = 85
#: Frequent tokens that go last in the token order.  The list only decides
#: the order, which any choice leaves exact; this bounds its broadcast.
FREQUENT = 200_000
FREQUENT_FROM = 16
BINS = 16
KEYS = 4
ALIKE = 10
BUCKETS = 64
GROUP = 64
PAIR = "rep long, n long, row binary, peer long, m long, other binary"


def count_locally(width: int):
    """Tokens that occur in two or more documents of a task's batches, with counts."""

    def run(batches):
        free_worker()
        held, size = [], 0
        for batch in batches:
            held.append(shingle_sets(batch.column("text"), width)[0])
            size += len(held[-1])
            if size > 2_000_000:
                yield from flush(held)
                held, size = [], 0
        yield from flush(held)

    def flush(held):
        if held:
            token, n = np.unique(np.concatenate(held), return_counts=True)
            many = n > 1
            yield pa.RecordBatch.from_arrays([pa.array(token[many].view(np.int64)), pa.array(n[many])], ["token", "n"])

    return run


def describe(width: int, percent: int, shared):
    """Per document: set size, digests, prefix tokens, min-hash of each bin,
    and the set counted over token buckets, few and many."""

    def run(batches):
        free_worker()
        frequent, place = shared.value
        for batch in batches:
            value, off = shingle_sets(batch.column("text"), width)
            n = np.diff(off)
            row = np.repeat(np.arange(len(n)), n)
            key = np.zeros(len(value), np.int64)
            if len(frequent) and len(value):
                at = np.minimum(np.searchsorted(frequent, value), len(frequent) - 1)
                key = np.where(frequent[at] == value, place[at], 0)
            order = np.argsort(row * np.int64(1 << 24) + key, kind="stable")
            first = n - (percent * n + 99) // 100 + 1
            take = np.arange(len(value)) - off[row] < first[row]
            prefix_off = np.concatenate(([0], np.cumsum(np.where(n > 0, first, 0))))
            prefix = value[order][take].view(np.int64)
            # Values are sorted within a row: a bin's least is its first.
            bins = (value >> U64(64 - 4)).astype(np.int64)
            new = np.ones(len(value), bool)
            new[1:] = (bins[1:] != bins[:-1]) | (row[1:] != row[:-1])
            sig = np.zeros((len(n), BINS), np.int64)
            sig[row[new], bins[new]] = value[new].view(np.int64)
            rows = np.bincount(row * BUCKETS + bucket_of(value), minlength=BUCKETS * len(n)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(fold64(value, off).view(np.int64)),
                 pa.array(fold64(mix(value ^ U64(0xA24BAED4963EE407)), off).view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(prefix_off.astype(np.int32)), pa.array(prefix)),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, BINS * len(n) + 1, BINS, dtype=np.int32)), pa.array(sig.ravel())),
                 pa.array([r.tobytes() for r in rows.reshape(-1, BUCKETS)], pa.binary()), pa.array(sketches(value, off), pa.binary())],
                ["doc_id", "n", "d1", "d2", "prefix", "sig", "row", "fine"])

    return run


def bucket_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> U64(20)).astype(np.int64) % BUCKETS


def sketches(value: np.ndarray, off: np.ndarray) -> list[bytes]:
    """Each set counted over 2**k buckets, the first k bits of a token, in bytes;
    k gives two to four tokens a bucket.  Empty where a count passes a byte."""
    n = np.diff(off)
    bits = np.zeros(len(n), np.int64)
    while np.any(n > 4 << bits):
        bits += n > 4 << bits
    first = np.concatenate(([0], np.cumsum(1 << bits)))
    row = np.repeat(np.arange(len(n)), n)
    # Two shifts, as one by 64 is not defined.
    bucket = (value >> U64(1)) >> (63 - bits[row]).astype(U64)
    count = np.bincount(first[row] + bucket.astype(np.int64), minlength=first[-1])
    small = count.astype(np.uint8).tobytes()
    most = np.maximum.reduceat(count, first[:-1]) if len(n) else n
    return [small[a:b] if m < 256 else b"" for a, b, m in zip(first[:-1].tolist(), first[1:].tolist(), most.tolist())]


def within_sketch(percent: int):
    """The pairs whose sketches allow the threshold.  The longer sketch is added
    up to the length of the shorter one; an empty one allows everything."""

    def run(batches):
        for batch in batches:
            ok = []
            n, m = batch.column("n").to_pylist(), batch.column("m").to_pylist()
            for x, y, i, j in zip(batch.column("fine").to_pylist(), batch.column("other").to_pylist(), n, m):
                size = min(len(x), len(y))
                if size:
                    a, b = (np.frombuffer(z, np.uint8).reshape(size, -1).sum(1, dtype=np.int64) for z in (x, y))
                    most = int(np.minimum(a, b).sum())
                    ok.append((100 + percent) * most >= percent * (i + j))
                else:
                    ok.append(True)
            yield batch.select(["rep", "peer"]).filter(pa.array(ok, pa.bool_()))

    return run


def whole_sets(width: int):
    """Sorted tokens of each set as bytes."""

    def run(batches):
        free_worker()
        for batch in batches:
            value, off = shingle_sets(batch.column("text"), width)
            parts = [value[a:b].tobytes() for a, b in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(parts, pa.binary())], ["rep", "tokens"])

    return run


def union_row(frame):
    """Matrix row of one group: its token union counted over the buckets."""
    import pandas as pd

    union = np.unique(np.concatenate([np.frombuffer(t, U64) for t in frame["tokens"]]))
    return pd.DataFrame({"comp": [frame["comp"].iloc[0]], "grp": [frame["grp"].iloc[0]], "least": [frame["n"].min()],
                         "matrix_row": [np.bincount(bucket_of(union), minlength=BUCKETS).astype(np.int32).tobytes()]})


def within_bound(percent: int, own: str, other: str, least: str):
    """Keep the rows whose bucket counts allow the threshold."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a = np.frombuffer(b"".join(batch.column(own).to_pylist()), np.int32).reshape(-1, BUCKETS)
                b = np.frombuffer(b"".join(batch.column(other).to_pylist()), np.int32).reshape(-1, BUCKETS)
                most = np.minimum(a, b).sum(1)
                n, m = batch.column("n").to_numpy(), batch.column(least).to_numpy()
                ok = (100 * most >= percent * n) & ((100 + percent) * most >= percent * (n + m))
                yield batch.filter(pa.array(ok))

    return run


def truly_linked(percent: int):
    """Exact check of pairs that carry both token arrays."""

    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("tokens").to_pylist(), batch.column("other").to_pylist()):
                a, b = np.frombuffer(x, U64), np.frombuffer(y, U64)
                at = np.searchsorted(b, a)
                both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                ok.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["rep", "peer"]).filter(pa.array(ok, pa.bool_()))

    return run


def similar_size(percent: int, a: str, b: str):
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def verify(pairs: DataFrame, alike: DataFrame, texts: DataFrame, width: int, percent: int, name: str) -> tuple[DataFrame, DataFrame]:
    """The pairs (rep, peer) that link, and the whole sets of all pairs that their sketches leave."""
    fine = alike.select("rep", "n", "fine")
    bounded = (pairs.select("rep", "peer").distinct().join(fine, "rep")
               .join(fine.select(F.col("rep").alias("peer"), F.col("n").alias("m"), F.col("fine").alias("other")), "peer"))
    pairs = store(bounded.select("rep", "n", "fine", "peer", "m", "other").mapInArrow(within_sketch(percent), "rep long, peer long"), name + "-pairs")
    ids = store(pairs.select(F.explode(F.array("rep", "peer")).alias("doc_id")).distinct(), name + "-ids")
    sets = store(by_ids(texts, ids, "left_semi").mapInArrow(whole_sets(width), "rep long, tokens binary"), name + "-sets").dropDuplicates(["rep"])
    rows = (pairs.join(sets, "rep").join(sets.select(F.col("rep").alias("peer"), F.col("tokens").alias("other")), "peer")
            .select("rep", "peer", "tokens", "other"))
    return store(rows.mapInArrow(truly_linked(percent), "rep long, peer long"), name), sets


def join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles`` and ``component_id``."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = id_and_text(docs)

    frequent = (texts.select("text").mapInArrow(count_locally(width), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
                .where(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "token").limit(FREQUENT).collect())
    tokens = np.array([r[0] for r in frequent], np.int64).view(U64)
    by = np.argsort(tokens)
    # Most frequent first in the list: it gets the last place in the order.
    place = (len(tokens) - np.arange(len(tokens)))[by]
    shared = spark.sparkContext.broadcast((tokens[by], place))

    described = store(texts.mapInArrow(
        describe(width, percent, shared),
        "doc_id long, n long, d1 long, d2 long, prefix array<long>, sig array<long>, row binary, fine binary"), "shingles")
    full = described.where("n > 0")
    classes = store(full.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    copies = store(full.select("doc_id", "d1", "d2").join(classes, ["d1", "d2"]).where("doc_id <> rep").select("doc_id").distinct(), "copies")
    reps = by_ids(full, copies, "left_anti").withColumnRenamed("doc_id", "rep")

    postings = reps.select("rep", "n", F.posexplode("prefix").alias("pos", "token"))
    met = postings.groupBy("token").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("token")
    postings = store(postings.join(met, "token"), "postings")
    active = postings.select("rep").distinct()

    # Clusters: links to the least and the greatest representative of each key.
    alike = store(active.join(reps.select("rep", "n", "sig", "row", "fine").dropDuplicates(["rep"]), "rep"), "signatures")
    keys = alike.select("rep", F.posexplode(F.slice("sig", 1, KEYS)).alias("bin", "key")).where("key <> 0")
    ends = keys.groupBy("bin", "key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    led = (keys.join(ends, ["bin", "key"]).select("rep", F.explode(F.array("lo", "hi")).alias("peer"))
           .where("rep <> peer").distinct())
    peers = alike.select(F.col("rep").alias("peer"), F.col("n").alias("m"), F.col("sig").alias("sig2"), F.col("row").alias("other"))
    same = F.aggregate(F.zip_with("sig", "sig2", lambda x, y: (x == y).cast("int")), F.lit(0), lambda a, x: a + x)
    led = led.join(alike.drop("fine"), "rep").join(peers, "peer").where(similar_size(percent, "n", "m") & (same >= ALIKE))
    led = led.select("rep", "n", "row", "peer", "m", "other").mapInArrow(within_bound(percent, "row", "other", "m"), PAIR)
    first_links, sets = verify(led, alike, texts, width, percent, "led")
    clusters = components(first_links, "rep", "peer")

    sized = clusters.groupBy("component").agg(F.count("*").alias("csize"))
    clusters = clusters.join(sized, "component").select(F.col("node").alias("rep"), F.col("component").alias("comp"), "csize")
    grouped = store(active.join(clusters, "rep", "left").select(
        "rep", F.coalesce("comp", "rep").alias("comp"), F.coalesce("csize", F.lit(1)).alias("csize"),
    ).withColumn("grp", F.pmod(F.xxhash64("rep"), F.ceil(F.col("csize") / GROUP).cast("long"))), "groups")

    # Queries are the sets of the smaller cluster, groups those of the larger.
    postings = postings.join(grouped, "rep")
    met = postings.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    postings = store(postings.join(met, "token"), "between")
    groups = postings.groupBy("token", "comp", "grp").agg(
        F.first("csize").alias("gsize"), F.min("n").alias("least"), F.max("n").alias("most"), F.min("pos").alias("gpos"),
    ).withColumnRenamed("comp", "gcomp").withColumnRenamed("grp", "ggrp")
    need = F.ceil(percent * (F.col("n") + F.col("least")) / (100 + percent))
    met = postings.join(groups, "token").where(
        (F.struct("csize", "comp") < F.struct(F.col("gsize").alias("csize"), F.col("gcomp").alias("comp")))
        & (100 * F.col("n") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("n"))
        & (F.least(F.col("n") - F.col("pos"), F.col("most") - F.col("gpos")) >= need))
    queries = met.select("rep", F.col("gcomp").alias("comp"), F.col("ggrp").alias("grp")).distinct()

    rows = alike.select("rep", "n", "row")
    alone = rows.join(grouped.where("csize = 1"), "rep").select("comp", "grp", F.col("n").alias("least"), F.col("row").alias("matrix_row"))
    together = rows.select("rep", "n").join(grouped.where("csize > 1"), "rep").join(sets, "rep").select("comp", "grp", "n", "tokens")
    matrix = alone.union(together.groupBy("comp", "grp").applyInPandas(
        union_row, "comp long, grp long, least long, matrix_row binary"))
    bounded = (queries.join(rows, "rep").join(matrix, ["comp", "grp"]).select("rep", "n", "row", "comp", "grp", "least", "matrix_row")
               .mapInArrow(within_bound(percent, "row", "matrix_row", "least"),
                           "rep long, n long, row binary, comp long, grp long, least long, matrix_row binary"))
    opened = (bounded.select("rep", "n", "row", "comp", "grp")
              .join(grouped.select(F.col("rep").alias("peer"), "comp", "grp"), ["comp", "grp"])
              .join(rows.select(F.col("rep").alias("peer"), F.col("n").alias("m"), F.col("row").alias("other")), "peer")
              .where(similar_size(percent, "n", "m")).select("rep", "n", "row", "peer", "m", "other")
              .mapInArrow(within_bound(percent, "row", "other", "m"), PAIR))
    links = first_links.union(verify(opened, alike, texts, width, percent, "opened")[0])

    labels = components(links, "rep", "peer").withColumnRenamed("node", "rep")
    of_class = classes.join(labels, "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component"))
    return described.select("doc_id", "n", "d1", "d2").join(of_class, ["d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id names its component; all columns."""
    kept = join(docs).where("component_id = doc_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi")
