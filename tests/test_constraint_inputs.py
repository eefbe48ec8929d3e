"""check_constraints, check_constraints_damaged: the events of the FR run are made once, however many constraints read them."""

import datetime as dt

from noticespark.plans.registry import QUERIES


def test_constraints_read_staged_events(spark, tmp_path):
    day = dt.datetime(1998, 2, 6)
    orders = [(k, day + dt.timedelta(days=k), "5-LOW") for k in range(60)]
    lines = [(k, k % 5, 1, n, 5.0, day) for k in range(60) for n in (1, 2)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    for name, broken in (("check_constraints", 0), ("check_constraints_damaged", 1)):
        report = QUERIES[name](spark, str(tmp_path))
        plan = report._jdf.queryExecution().optimizedPlan().toString()
        assert "html" not in plan.replace("raw_html_path", "")   # no page is parsed while constraints are counted
        found = {r.rule: r.violations for r in report.collect()}
        assert found["data_not_null"] == broken * 2 and found["confidence_score_range"] == broken * 2
        assert found["parent_event_id_fk"] == 0 or broken
