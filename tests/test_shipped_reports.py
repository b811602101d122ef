"""Every report of the shipped configuration reads its table."""

from kempt.plans import queries
from kempt.plans.config import reports_from_config, stack_reports
from tests.conftest import rows


def test_reports_of_texts_alone_are_stacked(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None)], "k string, v string")
    assert rows(stack_reports({"r": df})) == [("r", "a|x", "rows", 2.0), ("r", "b", "rows", 1.0)]


def test_every_shipped_report_is_returned(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["config_shipped_stacked"](spark, sf).select("report").distinct().collect()
    assert set(reports_from_config(queries.loans(spark, sf), queries.SHIPPED)) <= {r.report for r in got}
