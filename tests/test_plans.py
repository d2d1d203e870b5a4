"""Physical plans: what must not move, what must be pushed down, and what must never appear."""

import pytest
from fixture_queries import QUERIES
from fixture_queries.base import scored_lineitem, table
from tallyroute.operators import evaluate, split

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True, scope="module")
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_everything_with_everything(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan and "InPandas" not in plan


@pytest.mark.parametrize(
    "name",
    ["engineered_features", "encoded_segments", "student_features", "student_scores", "batch_scores",
     "order_row_errors", "record_field_errors", "ranked_explanations", "exact_split", "ordered_feature_matrix"],
)
def test_row_work_does_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SF))


@pytest.mark.parametrize(
    "name, exchanges",
    [("overview_kpis", 1), ("class_report", 1), ("confusion_matrix", 1), ("feature_importance", 1),
     ("batch_summary", 1), ("field_ranges", 1), ("column_stats", 1), ("directed_last_edge", 7)],
)
def test_number_of_shuffles(spark, name, exchanges):
    assert plan_of(QUERIES[name](spark, SF)).count("Exchange ") <= exchanges


def test_search_pushes_its_ranges_and_uses_a_top_k(spark):
    plan = plan_of(QUERIES["customer_search_page"](spark, SF))
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in plan and "LessThanOrEqual(c_acctbal,9000.0)" in plan
    assert "TakeOrderedAndProject" in plan


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["overview_kpis"](spark, SF))
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_returnflag:string>" in plan
    page = plan_of(QUERIES["customer_status_page"](spark, SF))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in page
    assert "EqualTo(c_mktsegment,BUILDING)" in page


def test_split_reads_only_its_key_to_find_the_cuts(spark):
    hashed = split.exact_split(table(spark, SF, "orders"), ["o_orderkey"]).select("split")
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan_of(hashed)


def test_sweep_reduces_before_its_windows(spark):
    plan = plan_of(evaluate.threshold_sweep(scored_lineitem(spark, SF), "label", "score"))
    assert plan.index("Window") < plan.index("HashAggregate")
