import __spark_entry__ as entry


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and set(df.columns) == {"country", "total_postings", "model_ready", "unlabeled",
                                                  "coverage_pct"}


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 100
