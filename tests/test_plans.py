"""Plan shapes that the scale design depends on, read from final adaptive plans."""

from odometrix.plans.driver_tables import QUERIES
from tests.conftest import SF_ORACLE


def final_plan(spark, name):
    df = QUERIES[name](spark, SF_ORACLE)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # a plan without any exchange is not adaptive at all
    assert "isFinalPlan=true" in plan or "AdaptiveSparkPlan" not in plan
    return plan.split("== Initial Plan ==")[0]


def test_breakdowns_aggregate_the_log_before_the_join(spark):
    plan = final_plan(spark, "breakdowns_by_label")
    join_at = plan.index("HashJoin")
    assert plan.index("partial_count(1)") > join_at  # below the join
    assert "EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>" in plan


def test_abnormalities_count_per_hour_before_the_tag_join(spark):
    plan = final_plan(spark, "abnormalities_by_tag")
    lines = plan.splitlines()
    tag_join = next(i for i, ln in enumerate(lines) if "HashJoin [hour" in ln)
    assert any("partial_count(1)" in ln for ln in lines[tag_join:])


def test_profile_join_is_inner_with_readings_streamed(spark):
    plan = final_plan(spark, "deviation_flags")
    assert "LeftOuter" not in plan and "RightOuter" not in plan
    assert "Inner" in plan


def test_range_faults_is_one_codegen_stage_without_shuffle(spark):
    plan = final_plan(spark, "range_faults")
    assert "Exchange" not in plan
    assert plan.count("*(1)") >= 2  # one whole-stage codegen span


def test_last_per_period_is_a_hash_aggregate_with_partials(spark):
    plan = final_plan(spark, "last_per_period")
    assert "SortAggregate" not in plan
    assert "partial_max_by" in plan


def test_top_n_is_a_distributed_top_k(spark):
    plan = final_plan(spark, "top_n")
    assert "TakeOrderedAndProject" in plan
    ties = final_plan(spark, "top_n_with_ties")
    assert "Subquery" in ties and "Window" not in ties
