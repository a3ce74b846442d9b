"""Physical-plan checks: no Python UDF, no single-partition window, pushed filters and pruned scans."""

from roadpulse.registry import queries
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_registered_queries(spark):
    for name in ["x1_feature_table", "r8_estimated_cost", "d8_spillover", "f6_correction_factors"]:
        p = _plan(queries()[name](spark, SF_SMALL))
        assert "EvalPython" not in p and "PythonUDF" not in p, name


def test_lag_window_is_partitioned(spark):
    """A single-partition exchange may only feed the final merge of a global (partial) aggregate."""
    for name in ["l3_rolling_global_6h", "l2_rolling_zone_7d", "l6_point_in_time_cause_means"]:
        lines = _plan(queries()[name](spark, SF_SMALL)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "HashAggregate" in lines[i + 1], (name, lines[i : i + 2])


def test_scan_pushdown_and_pruning(spark):
    df = queries()["s2_scan_events_pruned"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in p
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in p


def test_no_cartesian_product(spark):
    """Joins are equi-joins or against one-row broadcast aggregates; no pair-emitting product."""
    for name in ["x1_feature_table", "d8_spillover", "a9_box_stats_top_causes", "d3_d5_estimates", "v2_severity_auc"]:
        assert "CartesianProduct" not in _plan(queries()[name](spark, SF_SMALL)), name


def test_row_features_are_projections(spark):
    for name in ["t1_calendar_parts", "g4_lat_lng_grid", "p1_cause_severity_rank"]:
        p = _plan(queries()[name](spark, SF_SMALL))
        assert "Join" not in p and "Exchange" not in p, name
