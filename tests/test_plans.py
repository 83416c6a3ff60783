"""Plan shape of the headline queries: no cartesian product, no nested-loop
join, no row-at-a-time Python, no single-partition exchange in the source
pipelines."""

import re

import pytest

from outletlab.checks import queries as Q

SF = "/root/testdata/sf0.001"


def executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["cooler_features", "sales_features", "currency_impute",
                                 "customer_master", "nearest_outlet", "impute_hierarchical", "abt",
                                 "chi_square", "association_matrix", "stratified_split",
                                 "auc_by_class", "classification_metrics", "scan_union_partitions",
                                 "scan_company_partitions", "ingest_stamp"])
def test_no_pairs_no_python(spark, key):
    plan = executed_plan(Q.QUERIES[key](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, f"{key}: {bad}"


@pytest.mark.parametrize("key", ["cooler_features", "sales_features", "currency_impute"])
def test_source_pipelines_stay_partitioned(spark, key):
    assert "SinglePartition" not in executed_plan(Q.QUERIES[key](spark, SF))


def formatted(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_partition_filters_reach_the_scan(spark):
    plan = formatted(spark, Q.scan_company_partitions(spark, SF))
    assert "PartitionFilters: [COMP_CODE" in plan and "IN (0480,0491)" in plan


def test_dynamic_partition_pruning_by_country(spark):
    plan = formatted(spark, Q.scan_union_partitions(spark, SF))
    assert "dynamicpruning" in plan.lower()


def test_sales_lines_are_never_dealt_by_day(spark):
    """The calendar is broadcast on its counted size, whatever the planner would do."""
    from outletlab.operators import features as fe

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed_plan(Q.sales_lines(spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "hashpartitioning(CALDAY" not in plan
    days = spark.range(300_000).selectExpr("cast(id as string) as CALDAY", "'2001001' as FISCPER")
    raw = spark.createDataFrame([], ", ".join(f"{c} string" for c in (
        "CUSTOMER", "CALDAY", "MATERIAL", "FIELDNM005", "FIELDNM013", "FIELDNM016", "FIELDNM017", "FIELDNM018", "FISCPER")))
    with pytest.raises(ValueError, match="calendar_days has 300000 rows"):
        fe.sales_lines(raw, days)


def test_selection_cells_are_not_dealt_by_feature_or_pair(spark):
    """Sort-merge joins on these few keys alone would gather the cells; the
    margins they meet are counted and broadcast."""
    for key, column in (("chi_square", "feature"), ("association_matrix", "pair")):
        plan = executed_plan(Q.QUERIES[key](spark, SF))
        final = plan.split("== Initial Plan ==")[0]
        assert not re.search(rf"SortMergeJoin \[{column}#\d+\], .*Inner", final), final


def test_currency_lines_are_made_once_and_gaps_read_apart(spark):
    plan = formatted(spark, Q.currency_impute(spark, SF))
    assert "lineitem" not in plan and plan.count("currency_lines") >= 2
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert sum("NOT" in f for f in filters) == 1 and len(filters) == 3, filters  # one scan of the gaps, two of the known part


def test_stored_sides_of_the_star_are_joined_where_they_are(spark):
    """Sources bucketed by customer: no row of theirs is moved by the joins."""
    from outletlab.session import scratch_path
    from outletlab.sources import files as fs

    sides = [Q._customers(spark, SF), Q._demographics(spark, SF).drop("LONGITUDE", "LATITUDE"), Q.cooler_features(spark, SF), Q.sales_features(spark, SF)]
    sides = [fs.save_bucketed(s, f"star_side_{i}", scratch_path(spark, f"star_side_{i}"), "CUSTOMER") for i, s in enumerate(sides)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = sides[0]
        for side in sides[1:]:
            star = star.join(side, "CUSTOMER", "left")
        plan = executed_plan(star)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") >= 3 and "Exchange" not in plan.split("== Initial Plan ==")[0]
    assert star.count() == sides[0].count()
