"""Contracts (A2-A6, A12) and profiling.

Every check is an aggregate (one scan, partial aggregation) whose small
result is unpivoted with ``inline``; nothing is iterated on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagelens.functions.columns import WHITESPACE_RUN, attach_row, attach_scalars, false_if_null
from wagelens.operators import quantiles
from wagelens.rules import COUNTRY_FX, EXPECTED_COLUMNS, EXPECTED_COUNTRIES, EXPECTED_LEVELS


def unpivot_row(agg_row: DataFrame, names: list[str], key: str = "metric", value: str = "value",
                value_type: str = "bigint") -> DataFrame:
    """One-row aggregate -> (key, value) rows."""
    return agg_row.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias(key), F.col(n).cast(value_type).alias(value)) for n in names])))


# --------------------------------------------------------------------- A
def schema_check(df: DataFrame, expected: list[str]) -> DataFrame:
    """A2: expected vs present columns with Spark type and populated rows
    (types from the schema, counts from one aggregate)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    present = [c for c in df.columns]
    agg = df.agg(*[F.count(c).alias(c) for c in present])
    entries = [F.struct(F.lit(c).alias("column"), F.lit(c in types).alias("present"),
                        F.lit(types.get(c)).cast("string").alias("dtype"),
                        (F.col(c) if c in types else F.lit(None)).cast("bigint").alias("non_null_rows"),
                        F.lit(c in expected).alias("expected"))
               for c in list(expected) + [c for c in present if c not in expected]]
    return agg.select(F.inline(F.array(*entries)))


def key_contract(df: DataFrame, key: str) -> DataFrame:
    """A3: key complete and unique."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count(key).alias("non_null_keys"),
                  F.count_distinct(key).alias("distinct_keys")) \
        .withColumn("key_valid", (F.col("rows") == F.col("non_null_keys"))
                    & (F.col("rows") == F.col("distinct_keys")))


def domain_contract(df: DataFrame, column: str, expected: list[str]) -> DataFrame:
    """A4: observed distinct values vs the expected domain, both ways
    (full outer join of two small sets)."""
    spark = df.sparkSession
    observed = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    domain = spark.createDataFrame([(v,) for v in expected], f"{column} string") \
        .withColumn("_expected", F.lit(True))
    joined = observed.join(F.broadcast(domain), column, "full_outer")
    return joined.select(
        F.lit(column).alias("column"), F.col(column).alias("value"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.when(F.col("_expected").isNull(), "unexpected")
         .when(F.col("rows").isNull(), "missing").otherwise("ok").alias("status"))


def row_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """A5: violations per row rule (rule must hold; null counts as held
    only when the rule says so explicitly)."""
    agg = df.agg(*[F.sum((~false_if_null(r)).cast("long")).alias(n) for n, r in rules.items()])
    return unpivot_row(agg, list(rules), "rule", "violations")


def salary_row_rules() -> dict[str, Column]:
    pos = lambda c: F.col(c).isNull() | (F.col(c) > 0)
    return {
        "salary_min_positive": pos("salary_min"),
        "salary_max_positive": pos("salary_max"),
        "salary_avg_positive": pos("salary_avg"),
        "salary_min_le_max": F.col("salary_min").isNull() | F.col("salary_max").isNull()
        | (F.col("salary_min") <= F.col("salary_max")),
        "has_salary_boolean": F.col("has_salary").isNotNull(),
        "is_remote_boolean": F.col("is_remote").isNotNull(),
    }


def shape(df: DataFrame, expected_rows: int | None = None, expected_cols: int | None = None) -> DataFrame:
    """Rows and columns with a warn flag (never fails)."""
    out = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("bigint"))
    if expected_rows is not None:
        out = out.withColumn("shape_as_expected", (F.col("rows") == expected_rows)
                             & (F.col("columns") == (expected_cols or len(df.columns))))
    return out


def preview(df: DataFrame, columns: list[str], key: str, n: int = 5) -> DataFrame:
    """First n rows by key (TakeOrderedAndProject, no global sort)."""
    return df.select(*columns).orderBy(key).limit(n)


# --------------------------------------------------------------------- B
def column_profile(df: DataFrame) -> DataFrame:
    """B1: dtype, missing count and %, distinct count including null.

    Every column is scanned by itself and its values become 128-bit hashes,
    counted per (column, hash) map-side; the counts per column come from
    those.  Rows are never expanded over the columns, and one exchange of
    hashes serves all of them."""
    pairs = None
    for i, c in enumerate(df.columns):
        v = F.col(c)
        one = df.select(F.lit(i).alias("_i"), *[F.when(v.isNotNull(), F.xxhash64(F.lit(s), v)).alias(f"_h{s}") for s in (1, 2)])
        pairs = one if pairs is None else pairs.unionAll(one)
    distinct = pairs.groupBy("_i", "_h1", "_h2").agg(F.count(F.lit(1)).alias("_w"))
    per = distinct.groupBy("_i").agg(
        F.count(F.lit(1)).alias("distinct_count"), F.sum("_w").alias("_n"),
        F.coalesce(F.sum(F.when(F.col("_h1").isNull(), F.col("_w"))), F.lit(0)).alias("missing_count"))
    names = F.array(*[F.lit(c) for c in df.columns])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in df.schema.fields])
    return per.select(
        names[F.col("_i")].alias("column"), types[F.col("_i")].alias("dtype"), "missing_count",
        F.round(100.0 * F.col("missing_count") / F.col("_n"), 2).alias("missing_pct"), "distinct_count")


def missing_columns(profile: DataFrame) -> DataFrame:
    """B2: columns with missing values, ascending by share."""
    return profile.where("missing_count > 0").orderBy("missing_pct", "column")


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample SD, minimum, quartiles and maximum, rounded."""
    v, names = F.col(column), ["q25", "q50", "q75"]
    stats = df.agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                   F.min(v).alias("min"), F.max(v).alias("max"))
    q = quantiles.quantiles_of_counts(quantiles.value_counts(df, [], column), [], column, [0.25, 0.5, 0.75], names)
    return attach_row(stats, q.select(*names)).select(
        "count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", *names, "max")])


def value_counts(df: DataFrame, column: str, dropna: bool = False) -> DataFrame:
    """Count and % per value, null as its own bucket unless dropped."""
    base = df if not dropna else df.where(F.col(column).isNotNull())
    counts = base.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = base.agg(F.count(F.lit(1)).alias("_total"))
    return (attach_scalars(counts, total)
            .withColumn("pct", F.round(100.0 * F.col("count") / F.col("_total"), 4)).drop("_total"))


def category_order(df: DataFrame, column: str) -> DataFrame:
    """Categories by descending frequency (ties by value) with rank."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    # Rank over the small distinct-value table, not over rows.
    from pyspark.sql import Window
    w = Window.orderBy(F.desc("count"), F.asc(column))
    return counts.withColumn("rank", F.row_number().over(w))


def crosstab_margins(df: DataFrame, a: str, b: str, label: str = "All") -> DataFrame:
    """Crosstab counts with row/column/grand margins, long form."""
    cube = df.cube(a, b).agg(F.count(F.lit(1)).alias("count"),
                             F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
    return cube.select(
        F.when(F.col("_ga") == 1, F.lit(label)).otherwise(F.col(a).cast("string")).alias(a),
        F.when(F.col("_gb") == 1, F.lit(label)).otherwise(F.col(b).cast("string")).alias(b),
        "count")


def exact_duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier identical row (grouped, map-side combined)."""
    cols = columns or df.columns
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
              .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("exact_duplicate_rows")))


def feature_quality(silver: DataFrame) -> DataFrame:
    """Missing / moved / extracted / mismatch counts."""
    agg = silver.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("experience_required").isNull().cast("long")).alias("experience_missing_source"),
        F.sum(F.col("experience_invalid").cast("long")).alias("experience_invalid"),
        F.sum(F.col("experience_missing").cast("long")).alias("experience_missing_clean"),
        F.sum(F.col("skills_extracted").cast("long")).alias("skills_extracted"),
        F.sum(F.col("num_skills_mismatch").cast("long")).alias("num_skills_mismatch"))
    return unpivot_row(agg, agg.columns, "metric", "value")


def salary_availability(df: DataFrame) -> DataFrame:
    """Declared ``has_salary`` vs actual presence of ``salary_avg``."""
    return (df.groupBy(F.col("has_salary"), F.col("salary_avg").isNotNull().alias("salary_avg_present"))
              .agg(F.count(F.lit(1)).alias("rows")))


def step_funnel(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Rows before, flagged, removed, remaining for each sequential
    rule; a row is removed by the first rule that flags it.  One aggregate."""
    first = F.lit(None).cast("int")
    for i in reversed(range(len(steps))):
        first = F.when(false_if_null(steps[i][1]), F.lit(i)).otherwise(first)
    tagged = df.select(first.alias("_first"), *[false_if_null(c).alias(f"_f{i}") for i, (_, c) in enumerate(steps)])
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i in range(len(steps)):
        aggs.append(F.sum(F.col(f"_f{i}").cast("long")).alias(f"flag{i}"))
        aggs.append(F.sum((F.col("_first") == i).cast("long")).alias(f"rem{i}"))
    row = tagged.agg(*aggs)
    structs, removed_before = [], F.lit(0).cast("bigint")
    for i, (name, _) in enumerate(steps):
        before = F.col("_n") - removed_before
        rem = F.coalesce(F.col(f"rem{i}"), F.lit(0)).cast("bigint")
        structs.append(F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("rule"),
                                before.cast("bigint").alias("rows_before"),
                                F.coalesce(F.col(f"flag{i}"), F.lit(0)).cast("bigint").alias("flagged"),
                                rem.alias("removed"), (before - rem).cast("bigint").alias("remaining")))
        removed_before = removed_before + rem
    return row.select(F.inline(F.array(*structs)))


def quality_summary(silver: DataFrame, source_columns: int) -> DataFrame:
    """The metric/value summary of a Silver build (one aggregate)."""
    s = F.col("salary_quality_status")
    agg = silver.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.lit(source_columns).cast("bigint").alias("source_columns"),
        F.sum(F.col("salary_avg").isNull().cast("long")).alias("source_missing_salary_avg"),
        F.sum((s == "model_ready").cast("long")).alias("canonical_model_ready_rows"),
        F.sum((s == "unlabeled").cast("long")).alias("canonical_unlabeled_rows"),
        F.sum(s.isin("duplicate_conflict", "invalid_bounds", "unit_review", "midpoint_mismatch",
                     "review_other").cast("long")).alias("salary_or_duplicate_review_rows"),
        F.sum((F.col("duplicate_action") == "drop_duplicate").cast("long")).alias("duplicate_rows_removed"),
        F.sum((F.col("duplicate_action") == "conflict_review").cast("long")).alias("duplicate_conflict_rows"),
        F.sum(F.col("experience_invalid").cast("long")).alias("invalid_experience_rows"),
        F.sum(F.col("skills_extracted").cast("long")).alias("rows_with_parsed_skills"),
        F.sum((F.col("duplicate_group_size") > 1).cast("long")).alias("near_duplicate_group_rows"),
    )
    return unpivot_row(agg, agg.columns, "metric", "value")


def enforce_contract(bronze: DataFrame, key: str = "job_id") -> None:
    """A2-A5 enforced: raise ``ValueError`` when columns are missing, the key
    is null or repeated, a country or level is unknown, or a country has no
    currency.  One aggregate over three pruned columns and one over the key."""
    missing = sorted(set(EXPECTED_COLUMNS) - set(bronze.columns))
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    text = lambda c: F.trim(F.regexp_replace(F.col(c), WHITESPACE_RUN, " "))
    mapped = [c for c, *_ in COUNTRY_FX]
    count = lambda bad: F.count(F.when(bad, 1))
    found = bronze.agg(
        count(F.col(key).isNull()).alias("null_key"),
        count(~text("country").isin(EXPECTED_COUNTRIES)).alias("country"),
        count(~text("job_level").isin(EXPECTED_LEVELS)).alias("level"),
        count(~F.coalesce(text("country").isin(mapped), F.lit(False))).alias("currency")).first()
    said = {"null_key": f"{key} is null", "country": "unknown country", "level": "unknown job level",
            "currency": "country without a currency"}
    broken = [f"{said[k]} in {n} rows" for k, n in found.asDict().items() if n]
    twice = bronze.groupBy(key).count().where((F.col("count") > 1) & F.col(key).isNotNull()).limit(1).count()
    if twice:
        broken.append(f"{key} is repeated")
    if broken:
        raise ValueError("Bronze breaks its contract: " + "; ".join(broken))
