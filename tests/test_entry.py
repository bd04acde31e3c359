import importlib

import pytest

entry = importlib.import_module("__spark_entry__")

# Queries whose result SQL cannot give: iterations, projections, look-around patterns.
ROWS_ONLY = {"prototype_histograms", "site_summary_with_place", "site_centroid", "site_region", "reproject_zone",
             "likely_srid_cascade", "feature_count_postholes", "value_status_postholes", "run_judge_values",
             "features_csv_with_place", "run_export_csv"}


def test_names_match():
    assert {n for n in set(entry.queries()) - set(entry.oracle_sql())
            if n not in entry.LLM_QUERIES} == ROWS_ONLY
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "pk" and df.count() > 0


@pytest.mark.parametrize("name", ["feature_core", "find_count", "class_counts", "relations_layer"])
def test_relational_plans_stay_in_the_jvm(spark, name):
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
