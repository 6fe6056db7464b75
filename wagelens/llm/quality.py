"""Quality by language-model perplexity (op1).

An interpolated modified Kneser-Ney model over byte n-grams is trained on
the trusted documents (quality label 1, outside the held-out third) but for
one in ``CALIBRATE``, which the model does not see.  Counts,
continuation counts, discounts and interpolated probabilities are DataFrame
aggregations and joins on hashed histories, so the tables are sharded and
grow with the corpus.  For scoring, the tables are dealt into shards by the
last two bytes of the history (orders 1 and 2 go to all); a shard holds all
that a place needs, fits ``SHARD_ROWS`` and is broadcast, and each shard adds
its places' log-probabilities in one narrow pass.

The threshold of a language comes from quantiles of the log-perplexity of its
unseen trusted documents, counted on a fixed grid: ``q75 + FENCE * (q75 - q25)``;
copies count once.  Languages with fewer than ``LEAST`` such documents are
calibrated on all their trusted ones, each part scored by a model that has not
seen it; where even these are fewer, the limit over all languages holds if it
is the larger one.

Defined results: null and empty texts have null perplexity and are not kept;
a null language counts as ''; a language without trusted documents takes the
threshold over all; without any trusted document every text is kept; repeated
rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.kernels import U64, text_buffer
from wagelens.llm.shared import blocks_for, by_ids, materialize, small_batches, store

ORDER = 5
#: Rows of one broadcast model shard (12 bytes each, in a table half full).
SHARD_ROWS = 4_000_000
FENCE = 5.0
GRID = 512
FLUSH = 8_000_000
CALIBRATE = 4
#: Calibration documents from which on a language has its own limit.
LEAST = 30


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def grams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte n-gram that ends at each place, as a number; a text starts after
    ``ORDER - 1`` zero bytes.  The last byte lies in the low bits."""
    out = data.astype(np.int64)
    row_start = np.repeat(off[:-1], np.diff(off))
    at = np.arange(len(data)) - row_start
    for j in range(1, ORDER):
        moved = np.zeros(len(data), np.int64)
        moved[j:] = data[:-j] if j else data
        out |= np.where(at >= j, moved, 0) << (8 * j)
    return out


def count_grams(batches):
    """Partial counts of a task."""

    def flush(held):
        if held:
            gram, n = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], ["gram", "c"])

    held, size = [], 0
    for batch in batches:
        held.append(grams(*text_buffer(batch.column("text"))))
        size += len(held[-1])
        if size >= FLUSH:
            yield from flush(held)
            held, size = [], 0
    yield from flush(held)


def train(texts: DataFrame) -> DataFrame:
    """Model rows ``(order, gram, p, weight)``: interpolated probability of a
    seen n-gram, or (``p`` null) the weight that a seen history leaves to the
    next lower order."""
    counts = store(texts.select("text").mapInArrow(count_grams, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c")), "counts")
    by_order = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        # How many different bytes precede: each row of the next order is one.
        low = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        by_order[k] = store(by_order[k + 1].groupBy(low.alias("gram")).agg(F.count("*").alias("c")), f"counts{k}")

    lower, rows = None, []
    for k in range(1, ORDER + 1):
        # Four numbers per order: how many n-grams have count 1, 2, 3, 4.
        n = [0] + list(by_order[k].agg(*(F.count(F.when(F.col("c") == i, 1)) for i in range(1, 5))).first())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
        d = [0.0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.1), i - 0.05) if n[i] else 0.5 * min(i, 2) for i in (1, 2, 3)]
        c = F.col("c")
        discount = F.when(c == 1, d[1]).when(c == 2, d[2]).otherwise(d[3])
        table = by_order[k].withColumn("history", F.shiftright("gram", 8))
        of_history = table.groupBy("history").agg(F.sum("c").alias("total"), F.sum(discount).alias("taken"))
        table = table.join(of_history, "history").withColumn("own", (c - discount) / F.col("total")).withColumn("rest", F.col("taken") / F.col("total"))
        if lower is None:
            probability = table.select("gram", (F.col("own") + F.col("rest") / 256).alias("p"))
        else:
            low = F.col("gram").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1)).alias("low")
            probability = (table.select("gram", "own", "rest", low).join(lower.select(F.col("gram").alias("low"), F.col("p").alias("q")), "low")
                           .select("gram", (F.col("own") + F.col("rest") * F.col("q")).alias("p")))
        lower = store(probability, f"order{k}")
        left = of_history.select("history", (F.col("taken") / F.col("total")).alias("weight"))
        rows += [lower.select(F.lit(k).alias("order"), "gram", "p", F.lit(None).cast("double").alias("weight")),
                 left.select(F.lit(k).alias("order"), F.col("history").alias("gram"), F.lit(None).cast("double").alias("p"), "weight")]
    model = rows[0]
    for r in rows[1:]:
        model = model.unionByName(r)
    return model


def hash_table(keys: np.ndarray, values: np.ndarray):
    """Open addressing over numpy arrays: (slots, values, longest probe)."""
    size = 1 << max(4, int(2 * len(keys)).bit_length())
    slots, held = np.full(size, -1, np.int64), np.zeros(size, np.float32)
    at = place_of(keys, size)
    left, probe = np.arange(len(keys)), 0
    while len(left):
        spot = (at[left] + probe) & (size - 1)
        free = slots[spot] < 0
        first = np.zeros(len(left), bool)
        first[np.unique(spot[free], return_index=True)[1]] = True if free.all() else False
        if not free.all():
            tried = np.flatnonzero(free)
            first[tried[np.unique(spot[tried], return_index=True)[1]]] = True
        slots[spot[first]] = keys[left[first]]
        held[spot[first]] = values[left[first]]
        left, probe = left[~first], probe + 1
    return slots, held, probe


def place_of(keys: np.ndarray, size: int) -> np.ndarray:
    return ((keys.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(40)).astype(np.int64) & (size - 1)


def look_up(table, keys: np.ndarray) -> np.ndarray:
    """Value of each key, nan where it is absent."""
    slots, held, probes = table
    out = np.full(len(keys), np.nan, np.float32)
    at, left = place_of(keys, len(slots)), np.arange(len(keys))
    for probe in range(probes):
        spot = (at[left] + probe) & (len(slots) - 1)
        found = slots[spot]
        hit = found == keys[left]
        out[left[hit]] = held[spot[hit]]
        left = left[~hit & (found >= 0)]
        if len(left) == 0:
            break
    return out


def log_probability(tables, gram: np.ndarray) -> np.ndarray:
    """log p of each place: longest seen n-gram, times the weights above it."""
    out = np.zeros(len(gram))
    left, key = np.arange(len(gram)), gram
    for k in range(ORDER, 0, -1):
        seen, weights = tables[k]
        p = look_up(seen, key)
        hit = ~np.isnan(p)
        out[left[hit]] += np.log(p[hit])
        left, key = left[~hit], key[~hit]
        if len(left) == 0:
            return out
        w = look_up(weights, key >> 8)
        out[left] += np.where(np.isnan(w), 0.0, np.log(np.where(np.isnan(w), 1.0, w)))
        key = key & ((1 << (8 * (k - 1))) - 1)
    out[left] -= np.log(256.0)
    return out


def shard_of(gram: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a place, from the last two bytes of its history."""
    return ((gram >> 8) & 0xFFFF) * 40503 % 65536 * shards >> 16


def add_shard(shared, shard: int, shards: int, last: bool):
    def run(batches):
        tables = {k: tuple(hash_table(*t) for t in pair) for k, pair in shared.value.items()}
        for batch in batches:
            data, off = text_buffer(batch.column("text"))
            gram = grams(data, off)
            row = np.repeat(np.arange(len(off) - 1), np.diff(off))
            if shards > 1:
                mine = shard_of(gram, shards) == shard
                gram, row = gram[mine], row[mine]
            total = batch.column("logp").to_numpy() + np.bincount(row, weights=log_probability(tables, gram), minlength=len(off) - 1)
            text = pa.nulls(batch.num_rows, pa.string()) if last else batch.column("text")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), text, pa.array(total), pa.array(np.diff(off))], ["doc_id", "lang", "text", "logp", "n_bytes"])

    return run


def perplexity(docs: DataFrame, model: DataFrame) -> DataFrame:
    """Per document: ``doc_id, lang, n_bytes, logppl`` (null without text)."""
    spark = docs.sparkSession
    model = store(model, "model")
    shards = blocks_for(model.where("order > 2").count(), SHARD_ROWS)
    history = F.when(F.col("p").isNull(), F.col("gram")).otherwise(F.shiftright("gram", 8))
    key = F.col("history").bitwiseAND(F.lit(0xFFFF))
    shard = F.floor(key * 40503 % 65536 * shards / 65536)
    dealt = model.withColumn("history", history).withColumn("shard", F.when(F.col("order") > 2, shard).otherwise(-1))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                      F.col("text").cast("string").alias("text"), F.lit(0.0).alias("logp"))
    for s in range(shards):
        # About SHARD_ROWS rows, and the lowest two orders.
        rows = dealt.where(F.col("shard").isin(-1, s)).select("order", "gram", "p", "weight").toArrow()
        order, gram = rows.column("order").to_numpy(), rows.column("gram").to_numpy()
        p, weight = (rows.column(c).to_numpy() for c in ("p", "weight"))
        tables = {}
        for k in range(1, ORDER + 1):
            seen, left = (order == k) & ~np.isnan(p), (order == k) & ~np.isnan(weight)
            tables[k] = ((gram[seen], p[seen]), (gram[left], weight[left]))
        shared = spark.sparkContext.broadcast(tables)
        out = out.mapInArrow(add_shard(shared, s, shards, s == shards - 1), "doc_id long, lang string, text string, logp double, n_bytes long")
        if s < shards - 1:
            out = materialize(out.drop("n_bytes"))
    return out.select("doc_id", "lang", "n_bytes", F.when(F.col("n_bytes") > 0, -F.col("logp") / F.col("n_bytes")).alias("logppl"))


def quantiles(scored: DataFrame, by: list[str]) -> DataFrame:
    """Threshold and number of documents per group from grid counts of the log-perplexity."""
    counts = (scored.where("logppl IS NOT NULL").select(*by, "logppl", "n_bytes").distinct()
              .groupBy(*by, F.floor(F.col("logppl") * GRID).alias("bin")).agg(F.count("*").alias("n")))
    upto = Window.partitionBy(*by).orderBy("bin")
    whole = Window.partitionBy(*by)
    ranked = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(whole))
    q = lambda x: F.min(F.when(F.col("upto") >= x * F.col("total"), F.col("bin"))) / GRID
    return ranked.groupBy(*by).agg(F.sum("n").alias("n"), q(0.25).alias("q25"), q(0.75).alias("q75")).select(
        *by, "n", (F.col("q75") + FENCE * (F.col("q75") - F.col("q25")) + 1.0 / GRID).alias("limit"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: ``doc_id, lang, n_bytes, perplexity, threshold, keep``."""
    small_batches(docs.sparkSession)
    trusted = store(labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"))
                    .where(~held_out(F.col("doc_id"))).distinct(), "trusted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                        F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATE))
    unseen = lambda k: by_ids(texts, trusted.where(part != k), "left_semi")
    scored = store(perplexity(docs, train(unseen(0))), "perplexity")
    known = first = store(by_ids(scored, trusted.where(part == 0), "left_semi"), "known")
    enough = quantiles(first, ["lang"]).where(F.col("n") >= LEAST).select("lang")
    others = store(by_ids(texts, trusted.where(part != 0), "left_semi").join(enough, "lang", "left_anti").where("text <> ''"), "others")
    for k in range(1, CALIBRATE):
        mine = others.where(part == k)
        if not mine.isEmpty():
            known = known.unionByName(store(perplexity(mine, train(unseen(k))), f"known{k}").select(known.columns))
    by_language = quantiles(known, ["lang"])
    # The first part speaks for all languages as they are mixed, if it is large enough.
    over = lambda table: quantiles(table.withColumn("all", F.lit(1)), ["all"]).select("n", "limit").first()
    overall = over(first)
    if not overall or overall["n"] < LEAST:
        overall = over(known)
    whole = F.lit(overall["limit"] if overall else None).cast("double")
    limit = F.when(F.col("n") >= LEAST, F.col("limit")).otherwise(F.greatest("limit", whole))
    return scored.join(by_language, "lang", "left").select(
        "doc_id", "lang", "n_bytes", F.exp("logppl").alias("perplexity"), F.exp(limit).alias("threshold"),
        F.coalesce(F.col("logppl") <= limit, F.col("logppl").isNotNull()).alias("keep"))
