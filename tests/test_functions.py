import math
import statistics

from pyspark.sql import functions as F

from wagelens.functions.columns import (coerce_double, isclose, normalize_text, normalized_key,
                                        parse_bool, parse_skill_list, right_closed_bucket)
from wagelens.rules import BEGINNER, CAPSTONE, PHASE1, STRICT


def _one(spark, values, expr, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_normalize_text_edge_cases(spark):
    vals = [None, "", "   ", "a\t\nb", "x  y", "  keep  case "]
    assert _one(spark, vals, normalize_text("x")) == [None, None, None, "a b", "x y", "keep case"]
    assert _one(spark, vals, normalized_key("x")) == ["", "", "", "a b", "x y", "keep case"]


def test_coerce_double(spark):
    assert _one(spark, ["12", "x", "", None, "1e3"], coerce_double("x")) == [12.0, None, None, None, 1000.0]


def test_parse_bool(spark):
    got = _one(spark, ["true", " FALSE ", "Yes", "no", "1", "0", "maybe", None], parse_bool("x"))
    assert got == [True, False, True, False, True, False, None, None]


def test_isclose_is_asymmetric_in_b(spark):
    df = spark.createDataFrame([(100.0, 100.01), (100.0, 100.011), (0.0, 0.0)], "a double, b double")
    got = [r[0] for r in df.select(isclose("a", "b", 1e-7, 0.01)).collect()]
    assert got == [True, False, True]


def test_right_closed_tiers_under_presets(spark):
    xs = [-1.0, 0.0, 2.0, 2.5, 5.0, 10.0, 30.0, 30.5, 35.0, 36.0, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    strict = [r[0] for r in df.select(right_closed_bucket(F.when(F.col("x").between(0, 30), F.col("x")),
                                                          STRICT.tier)).collect()]
    assert strict == [None, "Entry", "Entry", "Intermediate", "Intermediate", "Experienced",
                      "Highly Experienced", None, None, None, None]
    phase1 = [r[0] for r in df.select(right_closed_bucket(F.when(F.col("x").between(0, 30), F.col("x")),
                                                          PHASE1.tier)).collect()]
    assert phase1[1] == "0-2 years" and phase1[6] == "11+ years" and phase1[-1] == "Missing"
    cap = [r[0] for r in df.select(right_closed_bucket("x", CAPSTONE.tier)).collect()]
    assert cap[1] == "Entry" and cap[8] == "Highly Experienced" and cap[9] is None
    beg = [r[0] for r in df.select(right_closed_bucket(F.when(F.col("x").between(0, 35), F.col("x")),
                                                       BEGINNER.tier)).collect()]
    assert beg[8] == "Highly Experienced" and beg[9] == "Unknown" and beg[-1] == "Unknown"


def test_parse_skill_list_cases(spark):
    vals = ["[]", "['Python ', 'python']", '["it\'s"]', "not a list", None, "nan", "['', 'sql']",
            "['sql', 'aws']"]
    got = _one(spark, vals, parse_skill_list("x"))
    assert got == [[], ["python"], ["it's"], [], [], [], ["sql"], ["aws", "sql"]]
    kept = _one(spark, ["['sql', 'aws', 'sql']"], parse_skill_list("x", sorted_distinct=False))
    assert kept == [["sql", "aws", "sql"]]


def test_inverse_normal_matches_reference_library(spark):
    from wagelens.operators.stats import inv_norm_cdf
    ps = [0.001, 0.01, 0.02425, 0.1, 0.3175, 0.5, 0.8, 0.99, 0.999]
    got = _one(spark, ps, inv_norm_cdf(F.col("x")), "x double")
    for p, g in zip(ps, got):
        assert math.isclose(g, statistics.NormalDist().inv_cdf(p), rel_tol=1e-8, abs_tol=1e-8)


def test_parse_skill_list_reads_whole_literals_only(spark):
    vals = ["['a', b]", "[1, 2]", "('sql',)", "('sql')", "{'x'}", "['it\\'s']", "['a',\n 'b',]", "['a' 'b']", "{}", "['a'] x"]
    got = _one(spark, vals, parse_skill_list("x"))
    assert got == [[], ["1", "2"], ["sql"], [], ["x"], ["it's"], ["a", "b"], [], [], []]


def test_parse_bool_knows_six_tokens(spark):
    assert _one(spark, ["T", "n", "y", "f"], parse_bool("x")) == [None] * 4
