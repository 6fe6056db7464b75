"""Near-duplicate audit.

Design: one ``groupBy(fingerprint)`` aggregate computes every per-group
fact (size, conflict flags, canonical member) with partial (map-side)
aggregation, and is joined back to the rows on the fingerprint.  A window
``partition by fingerprint`` would put a hot group (a third of the rows
sharing one fingerprint) into a single task with one giant sort; the
aggregate + join keeps that group split across map tasks and lets AQE's
skew-join split the hot partition on the row side.

* conflict = more than one distinct non-null value  <=>  min(x) != max(x)
  (both ignore nulls), so no ``count(distinct)`` / Expand is needed;
* canonical row = least id of the highest priority present: one min per
  priority, whatever the id's sign, size or type.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagelens.functions.columns import false_if_null, normalized_key
from wagelens.rules import STRICT, RuleSet

FP = "posting_fingerprint"


def fingerprint(columns, lowercase: bool = True, already_normalized: bool = False) -> Column:
    """SHA-1 hex of the pipe-joined normalised key columns."""
    return F.sha1(F.concat_ws("|", *[normalized_key(c, lowercase, already_normalized) for c in columns]))


def canonical_priority(salary_avg="salary_avg", salary_min="salary_min",
                       salary_max="salary_max", bounds: bool = True) -> Column:
    """2 for a present target + 1 for two positive bounds (where they count)."""
    has_avg = F.col(salary_avg).isNotNull().cast("int")
    if not bounds:
        return has_avg * 2
    positive = false_if_null((F.col(salary_min) > 0) & (F.col(salary_max) > 0)).cast("int")
    return has_avg * 2 + positive


def conflict_name(column: str) -> str:
    short = {"salary_avg": "salary", "job_level": "level", "is_remote": "remote"}.get(column, column)
    return f"duplicate_{short}_conflict"


# Values of ``canonical_priority``, best first.
PRIORITIES = (3, 2, 1, 0)


def _fixed_width(c: str, dtype) -> list[Column]:
    """Values compared through fixed-width stand-ins so the aggregate stays
    a (partial) HashAggregate: numbers / booleans as they are, strings by a
    pair of independent hashes (collision odds ~2**-96)."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return [F.when(F.col(c).isNotNull(), F.xxhash64(c)), F.when(F.col(c).isNotNull(), F.hash(c))]
    return [F.col(c)]


def group_facts(df: DataFrame, key: str = FP, conflict_columns=("salary_avg", "job_level", "is_remote"),
                id_col: str = "job_id", priority: Column | None = None) -> DataFrame:
    """E2/E3/E4 per group, one row per key.  Every aggregate buffer is
    fixed-width, so Spark plans a HashAggregate with map-side partial
    aggregation (a hot fingerprint is pre-combined in every map task)."""
    prio = canonical_priority() if priority is None else priority
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("duplicate_group_size")]
    for c in conflict_columns:
        differs = F.lit(False)
        for v in _fixed_width(c, types[c]):
            differs = differs | false_if_null(F.min(v) != F.max(v))
        aggs.append(differs.alias(conflict_name(c)))
    aggs.append(F.coalesce(*[F.min(F.when(prio == p, F.col(id_col))) for p in PRIORITIES]).alias("_canonical_id"))
    return df.groupBy(key).agg(*aggs)


def duplicate_audit(df: DataFrame, rules: RuleSet = STRICT, id_col: str = "job_id",
                    already_normalized: bool = False, reuse_input: bool = True,
                    persisted: list | None = None) -> DataFrame:
    """Fingerprint, group size, conflict flags, canonical action.

    The fingerprinted rows feed two branches (the narrow group aggregate
    and the join back).  With ``reuse_input`` they are persisted once, so
    the text normalisation and SHA-1 run once per row and the source is
    scanned once; a lost cached block is recomputed from lineage.  The
    persisted frame is appended to ``persisted`` (when given) so the caller
    can release it once the result has been materialised."""
    with_fp = df.withColumn(FP, fingerprint(rules.dedup_columns, rules.dedup_lowercase, already_normalized))
    if reuse_input:
        with_fp = with_fp.persist(StorageLevel.MEMORY_AND_DISK)
        if persisted is not None:
            persisted.append(with_fp)
    facts = group_facts(with_fp, FP, rules.conflict_columns, id_col,
                        canonical_priority(bounds=rules.bounds_decide_canonical))
    conflict_cols = [conflict_name(c) for c in rules.conflict_columns]
    any_conflict = F.lit(False)
    for c in conflict_cols:
        any_conflict = any_conflict | F.col(c)
    out = (with_fp.join(facts, FP, "inner")
           .withColumn("duplicate_conflict", any_conflict)
           .withColumn("duplicate_action",
                       F.when(F.col("duplicate_conflict"), F.lit("conflict_review"))
                        .when(F.col(id_col) == F.col("_canonical_id"), F.lit("keep"))
                        .otherwise(F.lit("drop_duplicate")))
           .drop("_canonical_id"))
    return out


def repeated_members(df: DataFrame, key_columns, lowercase: bool = False) -> DataFrame:
    """Every member of a key group with more than one row
    (``duplicated(subset, keep=False)``), with the group size."""
    with_fp = df.withColumn(FP, fingerprint(key_columns, lowercase))
    sizes = with_fp.groupBy(FP).agg(F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1")
    return with_fp.join(sizes, FP, "inner")


def repeat_group_summary(silver: DataFrame) -> DataFrame:
    """Per repeated group (rows, labelled rows, distinct salaries), then
    the distribution of group shapes (two-level aggregate)."""
    per_group = (silver.where(F.col("duplicate_group_size") > 1)
                 .groupBy(FP)
                 .agg(F.count(F.lit(1)).alias("group_rows"),
                      F.count("salary_avg").alias("labelled_rows"),
                      F.count_distinct("salary_avg").alias("distinct_salaries")))
    return (per_group.groupBy("group_rows", "labelled_rows", "distinct_salaries")
            .agg(F.count(F.lit(1)).alias("groups"),
                 F.sum(F.col("group_rows") - 1).alias("extra_rows")))


def distinct_by_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Keep the first row per key under an explicit order
    (deterministic, unlike ``dropDuplicates``).  Implemented as a
    ``min(struct(order..., row))`` aggregate so a hot key is combined
    map-side instead of sorted in one task."""
    others = [c for c in df.columns if c != key]
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                      F.struct(*[F.col(c) for c in others]).alias("_row"))
    best = df.groupBy(key).agg(F.min(packed).alias("_best"))
    return best.select(key, *[F.col(f"_best._row.{c}").alias(c) for c in others])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that still occur more than once (empty when unique)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
