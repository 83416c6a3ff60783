"""Incremental base table."""

from outletlab.plans.base_table import incremental_base_table


def test_incremental_keeps_previous_and_appends_new(spark):
    current = spark.createDataFrame([("1", 1.0, "a"), ("2", 2.0, "b"), ("3", 3.0, "c")],
                                    "CUSTOMER string, x double, y string")
    previous = spark.createDataFrame([("b-old", "2.5", "1")], "y string, x string, CUSTOMER string")
    out = {r.CUSTOMER: r for r in incremental_base_table(current, previous, "20240101").collect()}
    assert out["1"].pardt == "20220512" and out["1"].x == 2.5 and out["1"].y == "b-old"
    assert out["2"].pardt == "20240101" and out["3"].pardt == "20240101"
    again = incremental_base_table(current, incremental_base_table(current, previous, "20240101"), "20240102")
    assert again.count() == 3                                  # idempotent: nothing new the second time
    assert {r.pardt for r in again.collect()} == {"20220512", "20240101"}


SF = "/root/testdata/sf0.001"


def rounded(rows):
    return {r.CUSTOMER: tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows}


def test_building_some_customers_gives_the_rows_of_the_whole_build(spark):
    from outletlab.checks import queries as Q
    from outletlab.plans.base_table import analytical_base_table
    from outletlab.session import cut_lineage

    customers = cut_lineage(Q._customers(spark, SF), "customers")
    sources = tuple(cut_lineage(s, "source") for s in Q._sources(spark, SF))
    whole = rounded(analytical_base_table(customers, *sources).collect())
    wanted = customers.filter("CAST(CUSTOMER AS LONG) % 3 = 1").select("CUSTOMER")
    some = rounded(analytical_base_table(customers, *sources, wanted=wanted).collect())
    assert some == {k: whole[k] for k in {r.CUSTOMER for r in wanted.collect()}} and 0 < len(some) < len(whole)


def test_two_runs_of_one_day_store_two_snapshots(spark):
    import re
    import time

    from outletlab.plans.base_table import store_snapshot
    from outletlab.session import scratch_path
    from outletlab.sources import files as fs

    root = scratch_path(spark, "snapshots")
    first = store_snapshot(spark, spark.createDataFrame([("1", 1.0)], "CUSTOMER string, x double"), root, "xx", "20240101")
    time.sleep(1.1)
    second = store_snapshot(spark, spark.createDataFrame([("1", 9.0), ("2", 2.0)], "CUSTOMER string, x double"), root, "xx", "20240101")
    assert first != second and all(re.search(r"/XX/output/xx_abt_20240101_\d{6}\.csv$", p) for p in (first, second))
    assert {(r.CUSTOMER, r.x) for r in fs.load_latest_csv(spark, root).collect()} == {("1", "1.0"), ("2", "2.0")}
