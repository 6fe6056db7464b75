"""Skill-array features (D1-D9): native array functions, no Python UDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.functions.columns import attach_scalars, parse_skill_list, sum_columns
from wagelens.rules import ALL_SKILLS, STRICT, RuleSet, skill_column


def skill_features(df: DataFrame, rules: RuleSet = STRICT, source: str = "skills",
                   declared: str = "num_skills") -> DataFrame:
    """Parsed list, extracted flag, multi-hot flags, parsed
    count, mismatch with the declared count, pipe-joined form."""
    # One projection per dependency level (a withColumn per flag would
    # re-analyse the growing plan once per skill).
    out = df.withColumn("skills_list", parse_skill_list(source, rules.skills_sorted_distinct))
    names = [skill_column(s) for s in rules.skills]
    flags = {"skills_extracted": (F.size("skills_list") > 0).cast("int")}
    for skill, name in zip(rules.skills, names):
        if rules.skill_match == "substring":
            flag = F.coalesce(F.lower(F.col(source)).contains(skill), F.lit(False))
        else:
            flag = F.array_contains("skills_list", skill)
        flags[name] = flag.cast("int")
    out = out.withColumns(flags).withColumn("parsed_skill_count", sum_columns(names).cast("int"))
    return out.withColumns({
        "num_skills_mismatch": ~F.col(declared).eqNullSafe(F.col("parsed_skill_count")),
        "skills_clean": F.array_join("skills_list", "|")})


def skill_vocabulary(df: DataFrame, column: str = "skills_list") -> DataFrame:
    """Distinct flattened skills."""
    return df.select(F.explode(column).alias("skill")).distinct()


def skill_frequency(df: DataFrame, column: str = "skills_list") -> DataFrame:
    """Postings per skill and % of all postings.  The explode is
    combined map-side by the aggregate; the total is a one-row aggregate
    joined by broadcast (proven size: one row)."""
    total = df.agg(F.count(F.lit(1)).alias("total_postings"))
    per = (df.select(F.explode(F.array_distinct(F.col(column))).alias("skill"))
             .groupBy("skill").agg(F.count(F.lit(1)).alias("postings")))
    return (attach_scalars(per, total)
               .withColumn("pct_postings", F.round(100.0 * F.col("postings") / F.col("total_postings"), 4))
               .drop("total_postings"))


def selected_skill_count(df: DataFrame, skills=ALL_SKILLS) -> DataFrame:
    """Number of selected skills in a scoring request."""
    return df.withColumn("num_skills", sum_columns([skill_column(s) for s in skills]).cast("int"))
