import pytest

from wagelens.operators.dedup import distinct_by_key, duplicate_audit
from wagelens.rules import STRICT
from pyspark.sql import functions as F


def _rows(spark, rows):
    schema = ("job_id long, job_title string, company string, location string, country string, description string, "
              "salary_avg double, salary_min double, salary_max double, job_level string, is_remote boolean")
    return spark.createDataFrame(rows, schema)


def test_null_and_value_is_not_a_conflict_and_ties_break_on_id(spark):
    rows = [
        (1, "A", "C", "L", "UK", "d", None, None, None, "Mid", True),
        (2, "a ", "c", "L", "UK", "d", 10.0, 9.0, 11.0, "Mid", True),   # same fingerprint, higher priority
        (3, "B", "C", "L", "UK", "d", 10.0, 9.0, 11.0, "Mid", True),
        (4, "B", "C", "L", "UK", "d", 12.0, 9.0, 13.0, "Mid", True),    # two salaries -> conflict
        (5, "E", "C", "L", "UK", "d", 5.0, 4.0, 6.0, "Mid", False),
        (6, "E", "C", "L", "UK", "d", 5.0, 4.0, 6.0, "Mid", False),     # equal priority -> lower id kept
    ]
    out = {r.job_id: r for r in duplicate_audit(_rows(spark, rows), STRICT).collect()}
    assert not out[1].duplicate_conflict and out[1].duplicate_action == "drop_duplicate"
    assert out[2].duplicate_action == "keep" and out[2].duplicate_group_size == 2
    assert out[3].duplicate_salary_conflict and out[4].duplicate_action == "conflict_review"
    assert out[5].duplicate_action == "keep" and out[6].duplicate_action == "drop_duplicate"


def test_distinct_by_key_keeps_first_in_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 2, "b"), (1, 2, "z")], "k long, o long, v string")
    got = sorted((r.k, r.o, r.v) for r in distinct_by_key(df, "k", [F.col("o")]).collect())
    assert got == [(1, 1, "a"), (2, 2, "b")]


@pytest.mark.parametrize("ids", [(-5, -4), (2**61, 2**61 + 1), (-(2**63), 2**63 - 1), (0, 1)])
def test_every_group_keeps_one_row_whatever_the_ids(spark, ids):
    rows = [(i, "A", "C", "L", "UK", "d", 10.0, 9.0, 11.0, "Mid", True) for i in ids]
    out = {r.job_id: r.duplicate_action for r in duplicate_audit(_rows(spark, rows), STRICT).collect()}
    assert out == {ids[0]: "keep", ids[1]: "drop_duplicate"}


def test_string_ids(spark):
    df = _rows(spark, [(i, "A", "C", "L", "UK", "d", 10.0, 9.0, 11.0, "Mid", True) for i in (2, 1)])
    df = df.withColumn("job_id", F.concat(F.lit("x"), F.col("job_id").cast("string")))
    out = {r.job_id: r.duplicate_action for r in duplicate_audit(df, STRICT).collect()}
    assert out == {"x1": "keep", "x2": "drop_duplicate"}
