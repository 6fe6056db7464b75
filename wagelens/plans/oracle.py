"""DuckDB SQL used as the independent correctness oracle.

The Spark side is DataFrame code; this module spells the same semantics
in plain SQL over the driver's pre-registered tables.  ``POSTINGS`` and
``SILVER`` are CTE chains reused by every oracle query.  Where Spark uses
skew-safe aggregate forms (min != max, min(struct)) the SQL uses the
textbook forms (count(distinct) > 1, row_number) so the two are
independent derivations.
"""

from __future__ import annotations

from wagelens.rules import ALL_SKILLS

_SKILL_BITS = ", ".join(
    f"CASE WHEN (h >> {i}) % 2 = 1 THEN '''{s}''' END" for i, s in enumerate(ALL_SKILLS))

POSTINGS = f"""
p0 AS (
  SELECT o_orderkey AS k,
         CASE WHEN o_orderkey % 40 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS g
  FROM orders),
p1 AS (
  SELECT k, g,
    CAST(floor(g / 7.0) AS BIGINT) % 5 AS ci,
    CAST(floor(g / 3.0) AS BIGINT) % 5 AS ri,
    (g * 31) % 256 AS h,
    CAST((CASE WHEN k % 73 = 0 THEN 10 ELSE 1 END) * (30000 + (g * 7919) % 120000) AS DOUBLE) AS b
  FROM p0),
p2 AS (
  SELECT *,
    CASE ci WHEN 0 THEN 'USA' WHEN 1 THEN 'UK' WHEN 2 THEN 'Canada' WHEN 3 THEN 'India' ELSE 'Australia' END AS country,
    CASE ci WHEN 0 THEN 1.00E0 WHEN 1 THEN 0.78E0 WHEN 2 THEN 1.37E0 WHEN 3 THEN 83.67E0 ELSE 1.52E0 END AS fx,
    CASE ri WHEN 0 THEN 'data scientist' WHEN 1 THEN 'data engineer' WHEN 2 THEN 'data analyst'
            WHEN 3 THEN 'business analyst' ELSE 'machine learning engineer' END AS kw,
    ((ci >= 2 AND g % 4 <> 0) OR k % 80 = 41) AS nosal,
    CASE WHEN g % 20 = 0 THEN 'Junior' WHEN g % 20 < 10 THEN 'Mid' WHEN g % 20 < 18 THEN 'Senior' ELSE 'Lead' END AS lv,
    CASE WHEN k % 120 = 1 THEN 5000.0E0 ELSE 0.0E0 END AS bump
  FROM p1),
p3 AS (
  SELECT *,
    CASE WHEN nosal THEN NULL WHEN k % 97 = 0 THEN 0.0E0 WHEN k % 89 = 0 THEN 10000.0E0
         WHEN k % 83 = 0 THEN 40.0E0 WHEN k % 71 = 0 THEN 0.0E0
         ELSE round(b * 0.9E0 * fx, 2) + bump END AS smin,
    CASE WHEN nosal THEN NULL WHEN k % 89 = 0 THEN NULL WHEN k % 83 = 0 THEN 60.0E0
         WHEN k % 97 <> 0 AND k % 71 = 0 THEN 0.0E0
         ELSE round(b * 1.1E0 * fx, 2) + bump END AS smax
  FROM p2),
postings AS (
  SELECT k AS job_id,
    CASE WHEN g % 11 = 0 THEN ' ' || upper(kw) || '   ' || lv || ' ' ELSE kw || ' ' || lower(lv) END AS job_title,
    CASE WHEN g % 1000 = 999 THEN NULL ELSE 'Company ' || CAST(g % 97 AS VARCHAR) END AS company,
    'City ' || CAST(g % 53 AS VARCHAR) AS location,
    smin AS salary_min,
    smax AS salary_max,
    'Posting ' || CAST(g AS VARCHAR) AS description,
    country,
    kw AS search_keyword,
    CASE WHEN g % 10 = 0 THEN CAST(CAST(floor(g / 10.0) AS BIGINT) % 45 AS DOUBLE) END AS experience_required,
    CASE g % 4 WHEN 0 THEN 'Bachelor' WHEN 1 THEN 'Master' WHEN 2 THEN 'PhD' ELSE 'Not specified' END AS degree_required,
    CASE WHEN g % 500 = 8 THEN 'not a list'
         WHEN g % 10 >= 7 THEN '[' || concat_ws(', ', {_SKILL_BITS}) || ']'
         ELSE '[]' END AS skills,
    CAST(CASE WHEN g % 10 >= 7 THEN bit_count(h) ELSE 0 END AS INTEGER) AS num_skills,
    CASE WHEN k % 200 = 1 THEN 'Lead' ELSE lv END AS job_level,
    ((g % 3 = 0) <> (k % 280 = 1)) AS is_remote,
    CASE WHEN nosal THEN NULL WHEN smax IS NULL THEN 10000.0E0
         WHEN k % 79 = 0 AND k % 97 <> 0 AND k % 83 <> 0 AND k % 71 <> 0 THEN (smin + smax) / 2 * 1.01E0
         ELSE (smin + smax) / 2 END AS salary_avg,
    (NOT nosal AND smax IS NOT NULL) AS has_salary
  FROM p3)"""


def _norm(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '')"


_STRING_COLS = ["job_title", "company", "location", "description", "country",
                "search_keyword", "degree_required", "skills", "job_level"]
_SKILL_FLAGS = ",\n    ".join(
    f"CAST(list_contains(skills_list, '{s}') AS INTEGER) AS skill_{s.replace(' ', '_')}" for s in ALL_SKILLS)
_SKILL_SUM = " + ".join(f"skill_{s.replace(' ', '_')}" for s in ALL_SKILLS)

SILVER = POSTINGS + f""",
s0 AS (
  SELECT job_id, {", ".join(f"{_norm(c)} AS {c}" for c in _STRING_COLS)},
         salary_min, salary_max, experience_required, num_skills, is_remote, salary_avg, has_salary
  FROM postings),
s1 AS (
  SELECT *, sha1(concat_ws('|', lower(coalesce(job_title, '')), lower(coalesce(company, '')),
             lower(coalesce(location, '')), lower(coalesce(country, '')), lower(coalesce(description, ''))))
             AS posting_fingerprint,
         (CASE WHEN salary_avg IS NOT NULL THEN 2 ELSE 0 END
          + CASE WHEN salary_min > 0 AND salary_max > 0 THEN 1 ELSE 0 END) AS prio
  FROM s0),
sg AS (
  SELECT posting_fingerprint, count(*) AS duplicate_group_size,
         count(DISTINCT salary_avg) > 1 AS duplicate_salary_conflict,
         count(DISTINCT job_level) > 1 AS duplicate_level_conflict,
         count(DISTINCT is_remote) > 1 AS duplicate_remote_conflict
  FROM s1 GROUP BY posting_fingerprint),
s2 AS (
  SELECT s1.*, sg.duplicate_group_size, sg.duplicate_salary_conflict, sg.duplicate_level_conflict,
         sg.duplicate_remote_conflict,
         (sg.duplicate_salary_conflict OR sg.duplicate_level_conflict OR sg.duplicate_remote_conflict)
           AS duplicate_conflict,
         row_number() OVER (PARTITION BY s1.posting_fingerprint ORDER BY prio DESC, job_id) AS rn
  FROM s1 JOIN sg USING (posting_fingerprint)),
s3 AS (
  SELECT *,
    CASE WHEN duplicate_conflict THEN 'conflict_review' WHEN rn = 1 THEN 'keep' ELSE 'drop_duplicate' END
      AS duplicate_action,
    CASE country WHEN 'USA' THEN 'USD' WHEN 'UK' THEN 'GBP' WHEN 'Canada' THEN 'CAD'
                 WHEN 'India' THEN 'INR' WHEN 'Australia' THEN 'AUD' END AS currency,
    CASE country WHEN 'USA' THEN 1.00E0 WHEN 'UK' THEN 0.78E0 WHEN 'Canada' THEN 1.37E0
                 WHEN 'India' THEN 83.67E0 WHEN 'Australia' THEN 1.52E0 END AS lcu_per_usd,
    CASE country WHEN 'India' THEN 3000.0E0 ELSE 20000.0E0 END AS floor_usd
  FROM s2),
s4 AS (
  SELECT *,
    salary_min AS salary_min_local, salary_avg AS salary_avg_local, salary_max AS salary_max_local,
    salary_min / lcu_per_usd AS salary_min_usd, salary_avg / lcu_per_usd AS salary_avg_usd,
    salary_max / lcu_per_usd AS salary_max_usd
  FROM s3),
s5 AS (
  SELECT *,
    coalesce(salary_avg_usd > 0, false) AS salary_has_target,
    (salary_min IS NOT NULL AND salary_max IS NOT NULL) AS complete_bounds,
    coalesce(salary_min > 0 AND salary_max > 0, false) AS positive_bounds,
    coalesce(salary_min <= salary_avg AND salary_avg <= salary_max, false) AS ordered_bounds,
    (salary_min_usd + salary_max_usd) / 2 AS salary_midpoint_usd
  FROM s4),
s6 AS (
  SELECT *,
    salary_has_target AND NOT (complete_bounds AND positive_bounds AND ordered_bounds) AS salary_invalid_bounds,
    salary_has_target AND complete_bounds
      AND NOT coalesce(abs(salary_avg_usd - salary_midpoint_usd) <= 0.01E0 + 1e-7 * abs(salary_midpoint_usd), false)
      AS salary_midpoint_mismatch,
    salary_max - salary_min AS salary_range_local,
    salary_max_usd - salary_min_usd AS salary_range_usd
  FROM s5),
s7 AS (
  SELECT *,
    salary_has_target AND NOT salary_invalid_bounds
      AND (coalesce(salary_avg_usd < floor_usd, false) OR coalesce(salary_avg_usd > 500000.0E0, false))
      AS salary_unit_review
  FROM s6),
s8 AS (
  SELECT *,
    CASE WHEN duplicate_action = 'conflict_review' THEN 'duplicate_conflict'
         WHEN duplicate_action = 'drop_duplicate' THEN 'duplicate_removed'
         WHEN duplicate_action = 'keep' AND salary_has_target AND NOT salary_invalid_bounds
              AND NOT salary_unit_review AND NOT salary_midpoint_mismatch THEN 'model_ready'
         WHEN duplicate_action = 'keep' AND salary_avg IS NULL THEN 'unlabeled'
         WHEN salary_invalid_bounds THEN 'invalid_bounds'
         WHEN salary_unit_review THEN 'unit_review'
         WHEN salary_midpoint_mismatch THEN 'midpoint_mismatch'
         ELSE 'review_other' END AS salary_quality_status,
    experience_required IS NOT NULL AND NOT coalesce(experience_required BETWEEN 0 AND 30, false)
      AS experience_invalid,
    CASE WHEN experience_required BETWEEN 0 AND 30 THEN experience_required END AS experience_required_clean,
    CAST(CASE WHEN job_level IN ('Senior', 'Lead') THEN 1 ELSE 0 END AS INTEGER) AS is_senior,
    CASE WHEN regexp_matches(trim(skills), '^\\[.*\\]$') THEN
      list_sort(list_distinct(list_filter(
        list_transform(regexp_extract_all(trim(skills), '''[^'']*''|"[^"]*"'),
                       lambda x: lower(trim(substr(x, 2, length(x) - 2)))),
        lambda x: length(x) > 0)))
    ELSE CAST([] AS VARCHAR[]) END AS skills_list,
    lower(coalesce(job_title, '')) AS job_title_text,
    ln(1 + salary_avg_usd) AS log_salary_avg_usd
  FROM s7),
silver AS (
  SELECT *,
    CAST(CASE WHEN experience_required_clean IS NULL THEN 1 ELSE 0 END AS INTEGER) AS experience_missing,
    CASE WHEN experience_required_clean > -0.01 AND experience_required_clean <= 2 THEN 'Entry'
         WHEN experience_required_clean > 2 AND experience_required_clean <= 5 THEN 'Intermediate'
         WHEN experience_required_clean > 5 AND experience_required_clean <= 10 THEN 'Experienced'
         WHEN experience_required_clean > 10 AND experience_required_clean <= 30 THEN 'Highly Experienced'
    END AS experience_tier,
    CASE WHEN is_senior = 1 THEN 'Premium' ELSE 'Standard' END AS salary_segment,
    CAST(CASE WHEN len(skills_list) > 0 THEN 1 ELSE 0 END AS INTEGER) AS skills_extracted,
    array_to_string(skills_list, '|') AS skills_clean,
    {_SKILL_FLAGS}
  FROM s8),
silver_x AS (
  SELECT *, CAST({_SKILL_SUM} AS INTEGER) AS parsed_skill_count,
         num_skills IS DISTINCT FROM CAST({_SKILL_SUM} AS INTEGER) AS num_skills_mismatch
  FROM silver),
training AS (SELECT * FROM silver_x WHERE salary_quality_status = 'model_ready'),
scoring AS (SELECT * FROM silver_x WHERE salary_quality_status = 'unlabeled'),
review AS (SELECT * FROM silver_x WHERE salary_quality_status IN
           ('duplicate_conflict', 'invalid_bounds', 'unit_review', 'midpoint_mismatch', 'review_other'))"""


def with_postings(select_sql: str) -> str:
    return f"WITH {POSTINGS}\n{select_sql}"


def with_silver(select_sql: str) -> str:
    """``silver_x`` is the full strict Silver table; ``training``,
    ``scoring`` and ``review`` are its layers."""
    return f"WITH {SILVER}\n{select_sql}"


_NORMED = ", ".join(f"{_norm(c)} AS {c}" for c in
                    ("job_title", "company", "location", "country", "description", "job_level"))
_RATE = "CASE country WHEN 'USA' THEN 1.00E0 WHEN 'UK' THEN 0.78E0 WHEN 'Canada' THEN 1.37E0 " \
        "WHEN 'India' THEN 83.67E0 WHEN 'Australia' THEN 1.52E0 END"


def capstone_status_counts() -> str:
    """Capstone: a record with a non-positive component, or an average
    outside its bounds where all three are present, loses its salaries; the
    labelled rest below 10,000 USD is set aside; duplicates stay."""
    return with_postings(f""",
p AS (SELECT {_NORMED}, salary_min, salary_avg, salary_max FROM postings),
fixed AS (
  SELECT CASE WHEN coalesce(least(salary_min, salary_avg, salary_max) <= 0, false)
              OR coalesce(salary_min > salary_avg, false) AND salary_max IS NOT NULL
              OR coalesce(salary_avg > salary_max, false) AND salary_min IS NOT NULL
         THEN NULL ELSE salary_avg / {_RATE} END AS target
  FROM p)
SELECT CASE WHEN target IS NULL THEN 'unlabeled' WHEN target < 10000 THEN 'unit_review'
            ELSE 'model_ready' END AS salary_quality_status, count(*) AS rows
FROM fixed GROUP BY 1""")


def beginner_status_counts() -> str:
    """Beginner: conflicting copies go to review, of the others one labelled
    row stays; a record with a non-positive component loses its salaries and
    a target below 1,000 USD counts as missing; every other label trains."""
    keys = "job_title, company, location, country, description"
    return with_postings(f""",
p AS (SELECT job_id, {_NORMED}, salary_min, salary_avg, salary_max, is_remote FROM postings),
g AS (
  SELECT {", ".join(f"coalesce({k}, '') AS k_{k}" for k in keys.split(", "))},
         count(DISTINCT salary_avg) > 1 OR count(DISTINCT job_level) > 1 OR count(DISTINCT is_remote) > 1 AS conflict,
         min(job_id) FILTER (WHERE salary_avg IS NOT NULL) AS labelled, min(job_id) AS any_row
  FROM p GROUP BY ALL),
j AS (
  SELECT p.*, g.conflict, coalesce(g.labelled, g.any_row) = p.job_id AS kept,
         CASE WHEN coalesce(least(salary_min, salary_avg, salary_max) <= 0, false) THEN NULL
              ELSE salary_avg / {_RATE} END AS usd
  FROM p JOIN g ON {" AND ".join(f"coalesce(p.{k}, '') = g.k_{k}" for k in keys.split(", "))})
SELECT CASE WHEN conflict THEN 'duplicate_conflict' WHEN NOT kept THEN 'duplicate_removed'
            WHEN coalesce(usd >= 1000, false) THEN 'model_ready' ELSE 'unlabeled' END AS salary_quality_status,
       count(*) AS rows
FROM j GROUP BY 1""")
