"""Rule presets, reference tables and contract domains.

The reference holds four rule sets that disagree (strict end-to-end,
phase-1 validation, capstone, beginner).  One parametrised implementation
reads a :class:`RuleSet`; the presets below only hold values.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
RANDOM_STATE = 42
TEST_SIZE = 0.20
CV_FOLDS = 5
LEGACY_MAE_USD = 18_500.0
INDUSTRY_MAE_USD = 8_000.0
MAX_ANNUAL_SALARY_USD = 500_000.0

# country -> (currency, local currency units per USD, reference year, strict floor in USD)
COUNTRY_FX = [
    ("USA", "USD", 1.00, 2024, 20_000.0),
    ("UK", "GBP", 0.78, 2024, 20_000.0),
    ("Canada", "CAD", 1.37, 2024, 20_000.0),
    ("India", "INR", 83.67, 2024, 3_000.0),
    ("Australia", "AUD", 1.52, 2024, 20_000.0),
]

EXPECTED_COLUMNS = [
    "job_id", "job_title", "company", "location", "salary_min", "salary_max",
    "description", "country", "search_keyword", "experience_required",
    "degree_required", "skills", "num_skills", "job_level", "is_remote",
    "salary_avg", "has_salary",
]
EXPECTED_COUNTRIES = ["USA", "UK", "Canada", "India", "Australia"]
EXPECTED_LEVELS = ["Junior", "Mid", "Senior", "Lead"]
ALL_SKILLS = ["python", "sql", "spark", "aws", "excel", "machine learning", "power bi", "tableau"]
TOP_SKILLS = ["python", "sql", "spark", "aws"]
SENIOR_LEVELS = ["Senior", "Lead"]
SEGMENT_LABELS = {0: "Standard", 1: "Premium"}

REVIEW_STATUSES = ["duplicate_conflict", "invalid_bounds", "unit_review",
                   "midpoint_mismatch", "review_other"]

# Columns that carry the target and must never become model features.
LEAKAGE_COLUMNS = [
    "salary_min", "salary_max", "salary_avg", "has_salary",
    "salary_min_local", "salary_max_local", "salary_avg_local",
    "salary_min_usd", "salary_max_usd", "salary_avg_usd",
    "salary_midpoint_usd", "salary_range_local", "salary_range_usd",
    "log_salary_avg_usd", "salary_quality_status",
]

# Boolean text tokens (capstone boolean parser).
TRUE_TOKENS = ["true", "1", "yes"]
FALSE_TOKENS = ["false", "0", "no"]

# Ridge alpha path and tuning grids (strict preset).
RIDGE_ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0, 1_000.0]
FOREST_GRID = {"numTrees": [250, 500], "maxDepth": [8, 14, None],
               "minInstancesPerNode": [1, 3], "featureSubsetStrategy": ["sqrt", "0.7"]}
BOOSTING_GRID = {"maxIter": [100, 200, 350], "stepSize": [0.03, 0.05, 0.10],
                 "maxDepth": [2, 3], "minInstancesPerNode": [1, 5]}
# ---------------------------------------------------------------------------


def skill_column(skill: str) -> str:
    return "skill_" + skill.replace(" ", "_")


@dataclass(frozen=True)
class TierRule:
    edges: tuple[float, ...]            # right-closed bin edges, len(labels)+1
    labels: tuple[str, ...]
    include_lowest: bool = False        # first bin closed on the left
    missing_label: str | None = None    # label for null input (None keeps null)


@dataclass(frozen=True)
class RuleSet:
    name: str
    dedup_columns: tuple[str, ...]
    dedup_lowercase: bool
    dedup_effect: str                   # "remove" | "flag"
    bounds_rule: str                    # "strict" | "phase1" | "null_out"
    unit_floor_usd: dict = field(default_factory=dict)  # country -> floor; "*" default
    unit_cap_usd: float | None = MAX_ANNUAL_SALARY_USD
    midpoint_rtol: float = 1e-7
    midpoint_atol: float = 0.01
    midpoint_basis: str = "usd"          # "usd" | "local"
    experience_min: float = 0.0
    experience_max: float = 30.0
    tier: TierRule = TierRule((-0.01, 2, 5, 10, 30),
                              ("Entry", "Intermediate", "Experienced", "Highly Experienced"))
    skills: tuple[str, ...] = tuple(ALL_SKILLS)
    skill_match: str = "membership"     # "membership" | "substring"
    skills_sorted_distinct: bool = True
    conflict_columns: tuple[str, ...] = ("salary_avg", "job_level", "is_remote")
    bounds_decide_canonical: bool = True  # two positive bounds break ties between copies
    # "null_out" presets only: which records lose their salaries, and what a
    # target below the unit floor means.
    repair_disordered: bool = True
    target_floor_usd: float | None = None  # targets below it count as missing
    low_unit: str = "review"            # "review" | "flag"
    log_guard_positive: bool = False    # log target for positive salaries only

    def with_(self, **changes) -> "RuleSet":
        return replace(self, **changes)

    def floor_for(self, country: str) -> float:
        return self.unit_floor_usd.get(country, self.unit_floor_usd.get("*", 0.0))


_FIVE_KEYS = ("job_title", "company", "location", "country", "description")

STRICT = RuleSet(
    name="strict",
    dedup_columns=_FIVE_KEYS,
    dedup_lowercase=True,
    dedup_effect="remove",
    bounds_rule="strict",
    unit_floor_usd={c: f for c, _, _, _, f in COUNTRY_FX},
)

PHASE1 = RuleSet(
    name="phase1",
    dedup_columns=("job_title", "company", "location", "description"),
    dedup_lowercase=True,
    dedup_effect="flag",
    bounds_rule="phase1",
    unit_floor_usd={"*": 10_000.0},
    midpoint_rtol=1e-5,
    midpoint_atol=1e-8,
    midpoint_basis="local",
    log_guard_positive=True,
    tier=TierRule((-0.01, 2, 5, 10, float("inf")),
                  ("0-2 years", "3-5 years", "6-10 years", "11+ years"),
                  missing_label="Missing"),
    skills=tuple(TOP_SKILLS),
)

CAPSTONE = RuleSet(
    name="capstone",
    dedup_columns=_FIVE_KEYS,
    dedup_lowercase=False,
    dedup_effect="flag",
    bounds_rule="null_out",
    unit_floor_usd={"*": 10_000.0},
    unit_cap_usd=None,
    experience_max=35.0,
    tier=TierRule((0, 2, 5, 10, 35),
                  ("Entry", "Intermediate", "Experienced", "Highly Experienced"),
                  include_lowest=True),
    skill_match="substring",
    skills_sorted_distinct=False,
)

BEGINNER = RuleSet(
    name="beginner",
    dedup_columns=_FIVE_KEYS,
    dedup_lowercase=False,
    dedup_effect="remove",
    bounds_rule="null_out",
    unit_floor_usd={"*": 10_000.0},
    unit_cap_usd=None,
    experience_max=35.0,
    tier=TierRule((-0.01, 2, 5, 10, 35),
                  ("Entry", "Intermediate", "Experienced", "Highly Experienced"),
                  missing_label="Unknown"),
    skills_sorted_distinct=False,
    bounds_decide_canonical=False,
    repair_disordered=False,
    target_floor_usd=1_000.0,
    low_unit="flag",
)

PRESETS = {r.name: r for r in (STRICT, PHASE1, CAPSTONE, BEGINNER)}
