"""Cleaning, currency conversion and quality classification.

All operators are narrow projections (no shuffle).  Lookups against the
five-row FX reference are ``create_map`` literals, so they cost nothing
at any scale; three-valued logic is pinned to pandas' False-on-NaN with
``false_if_null`` before every negation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagelens.functions.columns import (WHITESPACE_RUN, coerce_double, false_if_null, isclose,
                                        normalize_text, right_closed_bucket)
from wagelens.rules import COUNTRY_FX, MAX_ANNUAL_SALARY_USD, SENIOR_LEVELS, STRICT, RuleSet

SALARY_COLUMNS = ["salary_min", "salary_avg", "salary_max"]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def normalize_strings(df: DataFrame, columns=None) -> DataFrame:
    """Whitespace normalisation over every string column, blank -> null.

    Two projections: the regex result is a column of the first, and the
    blank -> null test of the second references it twice; Catalyst keeps
    the projections apart (it does not collapse a non-cheap expression
    referenced twice), so each value goes through the regex once."""
    columns = set(string_columns(df) if columns is None else columns)
    collapsed = df.select(*[F.trim(F.regexp_replace(F.col(c), WHITESPACE_RUN, " ")).alias(c)
                            if c in columns else F.col(c) for c in df.columns])
    return collapsed.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) if c in columns else F.col(c)
                              for c in df.columns])


def _lookup(mapping: dict, key: Column) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), key) if pairs else F.lit(None)


def fx_maps(fx_rows=COUNTRY_FX):
    currency = {c: cur for c, cur, _, _, _ in fx_rows}
    rate = {c: float(r) for c, _, r, _, _ in fx_rows}
    floor = {c: float(f) for c, _, _, _, f in fx_rows}
    return currency, rate, floor


def add_currency(df: DataFrame, country: str = "country", fx_rows=COUNTRY_FX) -> DataFrame:
    """Currency and local-units-per-USD by country (null when unmapped;
    ``fx_coverage_violations`` reports those)."""
    currency, rate, _ = fx_maps(fx_rows)
    return df.withColumns({"currency": _lookup(currency, F.col(country)),
                           "lcu_per_usd": _lookup(rate, F.col(country))})


def add_usd(df: DataFrame, columns=SALARY_COLUMNS, rate: str = "lcu_per_usd") -> DataFrame:
    """C3 + C6: numeric coercion, local copies preserved, USD = local / rate."""
    cols = {}
    for c in columns:
        x = coerce_double(c)
        cols.update({c: x, f"{c}_local": x, f"{c}_usd": x / F.col(rate)})
    return df.withColumns(cols)


def salary_flags(df: DataFrame, rules: RuleSet = STRICT, fx_rows=COUNTRY_FX) -> DataFrame:
    """Invalid bounds, midpoint mismatch, ranges, unit review."""
    smin, smax, savg = F.col("salary_min"), F.col("salary_max"), F.col("salary_avg")
    avg_usd = F.col("salary_avg_usd")
    complete = smin.isNotNull() & smax.isNotNull()
    if rules.bounds_rule == "phase1":
        has_target = avg_usd.isNotNull()
        bad = (smin.isNull() | smax.isNull() | false_if_null(smin <= 0)
               | false_if_null(smax <= 0) | false_if_null(smin > smax))
        invalid = has_target & bad
    else:
        has_target = false_if_null(avg_usd > 0)
        positive = false_if_null((smin > 0) & (smax > 0))
        ordered = false_if_null((smin <= savg) & (savg <= smax))
        invalid = has_target & ~(complete & positive & ordered)
    mid_usd = (F.col("salary_min_usd") + F.col("salary_max_usd")) / 2
    if rules.midpoint_basis == "local":
        close = isclose(savg, (smin + smax) / 2, rules.midpoint_rtol, rules.midpoint_atol)
    else:
        close = isclose(avg_usd, mid_usd, rules.midpoint_rtol, rules.midpoint_atol)
    mismatch = has_target & complete & ~false_if_null(close)
    floors = dict(rules.unit_floor_usd)
    floor = _lookup({c: floors.get(c, floors.get("*", 0.0)) for c, *_ in fx_rows}, F.col("country"))
    if "*" in floors:
        floor = F.coalesce(floor, F.lit(floors["*"]))
    out_of_range = false_if_null(avg_usd < floor)
    if rules.unit_cap_usd is not None:
        out_of_range = out_of_range | false_if_null(avg_usd > F.lit(rules.unit_cap_usd))
    unit = has_target & out_of_range if rules.bounds_rule == "null_out" else has_target & ~invalid & out_of_range
    return df.withColumns({
        "salary_has_target": has_target,
        "salary_invalid_bounds": invalid,
        "salary_midpoint_usd": mid_usd,
        "salary_midpoint_mismatch": mismatch,
        "salary_range_local": smax - smin,
        "salary_range_usd": F.col("salary_max_usd") - F.col("salary_min_usd"),
        "salary_unit_review": unit})


def quality_status(df: DataFrame, rules: RuleSet = STRICT) -> DataFrame:
    """First-match status classifier."""
    action = F.col("duplicate_action")
    has_target = F.col("salary_has_target")
    invalid, unit, mism = (F.col("salary_invalid_bounds"), F.col("salary_unit_review"),
                           F.col("salary_midpoint_mismatch"))
    if rules.bounds_rule == "phase1":
        ready = has_target & ~invalid & ~unit
        status = (F.when(ready, "model_ready").when(unit, "unit_review")
                  .when(invalid, "invalid_bounds").otherwise("unlabeled"))
    elif rules.bounds_rule == "null_out":
        # Bad salaries are gone already; bounds and midpoints only report.
        status = F.when(has_target & unit, "unit_review") if rules.low_unit == "review" else F.when(F.lit(False), "")
        status = status.when(has_target, "model_ready").otherwise("unlabeled")
        if rules.dedup_effect == "remove":
            status = (F.when(action == "conflict_review", "duplicate_conflict")
                      .when(action == "drop_duplicate", "duplicate_removed").otherwise(status))
    else:
        canonical = action == "keep" if rules.dedup_effect == "remove" else F.lit(True)
        ready = canonical & has_target & ~invalid & ~unit & ~mism
        unlabeled = canonical & F.col("salary_avg").isNull()
        status = F.when(ready, "model_ready")
        if rules.dedup_effect == "remove":
            status = (F.when(action == "conflict_review", "duplicate_conflict")
                      .when(action == "drop_duplicate", "duplicate_removed")
                      .when(ready, "model_ready"))
        status = (status.when(unlabeled, "unlabeled").when(invalid, "invalid_bounds")
                  .when(unit, "unit_review").when(mism, "midpoint_mismatch")
                  .otherwise("review_other"))
    return df.withColumn("salary_quality_status", status)


def salary_issue_flags(df: DataFrame) -> DataFrame:
    """C10 (capstone): per-reason salary issue flags and a reason list."""
    cols = [F.col(c) for c in SALARY_COLUMNS]
    non_positive = F.lit(False)
    for c in cols:
        non_positive = non_positive | false_if_null(c <= 0)
    complete = cols[0].isNotNull() & cols[1].isNotNull() & cols[2].isNotNull()
    bad_order = complete & ~false_if_null((F.col("salary_min") <= F.col("salary_avg"))
                                          & (F.col("salary_avg") <= F.col("salary_max")))
    wrong_flag = F.col("has_salary") != F.col("salary_avg").isNotNull()
    wrong_flag = false_if_null(wrong_flag)
    return df.withColumns({"non_positive_salary": non_positive,
                           "invalid_salary_order": bad_order,
                           "incorrect_salary_flag": wrong_flag,
                           "salary_issue": non_positive | bad_order | wrong_flag})


def repair_salary(df: DataFrame, disordered: bool = True) -> DataFrame:
    """C11: null every salary component of a record with a non-positive
    (capstone: or disordered) salary, then recompute ``has_salary``."""
    flagged = df if "non_positive_salary" in df.columns else salary_issue_flags(df)
    bad = F.col("non_positive_salary")
    if disordered:
        bad = bad | F.col("invalid_salary_order")
    out = flagged.withColumns({c: F.when(~bad, F.col(c)) for c in SALARY_COLUMNS})
    return out.withColumn("has_salary", false_if_null(F.col("salary_avg") > 0))


def drop_tiny_targets(df: DataFrame, floor: float) -> DataFrame:
    """C9 (beginner): a converted target below ``floor`` counts as missing;
    the row stays for scoring."""
    suspect = false_if_null(F.col("salary_avg_usd") < floor)
    out = df.withColumn("salary_unit_suspect", suspect)
    out = out.withColumn("salary_avg_usd", F.when(~F.col("salary_unit_suspect"), F.col("salary_avg_usd")))
    return out.withColumn("has_salary", F.col("salary_avg_usd").isNotNull())


def experience_features(df: DataFrame, rules: RuleSet = STRICT, column: str = "experience_required") -> DataFrame:
    """C13 + C14: range filter with audit flags and right-closed tiers."""
    x = coerce_double(column)
    valid = x.between(rules.experience_min, rules.experience_max)
    clean = F.when(valid, x)
    return df.withColumns({
        "experience_invalid": x.isNotNull() & ~false_if_null(valid),
        "experience_required_clean": clean,
        "experience_missing": clean.isNull().cast("int"),
        "experience_tier": right_closed_bucket(clean, rules.tier)})


def seniority(df: DataFrame, level: str = "job_level") -> DataFrame:
    """is_senior flag and salary segment label."""
    senior = false_if_null(F.col(level).isin(*SENIOR_LEVELS)).cast("int")
    return df.withColumns({"is_senior": senior,
                           "salary_segment": F.when(senior == 1, "Premium").otherwise("Standard")})


def log_target(df: DataFrame, column: str = "salary_avg_usd", out: str = "log_salary_avg_usd",
               guard_positive: bool = False) -> DataFrame:
    """log1p target (null for values <= -1; optionally only for > 0)."""
    x = F.col(column)
    value = F.when(x > 0, F.log1p(x)) if guard_positive else F.log1p(x)
    return df.withColumn(out, value)


def fx_coverage_violations(df: DataFrame, country: str = "country", fx_rows=COUNTRY_FX) -> DataFrame:
    """C5 check: countries with no conversion rate (empty when covered)."""
    known = [c for c, *_ in fx_rows]
    return (df.where(~false_if_null(F.col(country).isin(*known)))
              .groupBy(country).agg(F.count(F.lit(1)).alias("rows")))
