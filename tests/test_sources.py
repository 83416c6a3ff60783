"""File sources and sinks."""

import os
import tempfile
import time

from outletlab.sources import country as cy
from outletlab.sources import files as fs


def test_multi_path_read_is_a_union(spark):
    root = tempfile.mkdtemp(prefix="paths-")
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "z")], "k int, v string")
    fs.write_parquet(a, f"{root}/a")
    fs.write_parquet(b, f"{root}/b")
    got = fs.read_paths(spark, [f"{root}/a", f"{root}/b"])
    assert sorted(r.k for r in got.collect()) == [1, 2, 3]


def test_partition_codes_keep_leading_zeros(spark):
    root = tempfile.mkdtemp(prefix="parts-")
    df = spark.createDataFrame([("0526", 1), ("0480", 2), ("1100", 3)], "code string, v int")
    fs.write_parquet(df, f"{root}/t", partition_by="code")
    got = fs.read_partitioned(spark, f"{root}/t", "code", ["0526", "1100"], schema=df.schema)
    assert sorted((r.code, r.v) for r in got.collect()) == [("0526", 1), ("1100", 3)]
    dim = cy.country_dimension(spark)
    orgs = {r.SALESORG for r in cy.sales_orgs(dim, "ru").collect()}
    assert orgs == {"3801", "3802", "3803", "3804", "3805", "3806"}
    assert [r.COMP_CODE for r in cy.company_codes(dim, "at").collect()] == ["0526"]


def test_csv_explicit_schema_and_bad_values(spark):
    root = tempfile.mkdtemp(prefix="csv-")
    with open(f"{root}/x.csv", "w") as f:
        f.write("A|B\n1|x\n|y\n")
    got = fs.read_csv(spark, root, fs.string_schema(["A", "B"]), sep="|").collect()
    assert [(r.A, r.B) for r in got] == [("1", "x"), (None, "y")]


def test_newest_file_names_the_dataset(spark):
    root = tempfile.mkdtemp(prefix="latest-")
    for name in ("old", "new"):
        fs.write_csv(spark.createDataFrame([(name,)], "v string"), f"{root}/out/{name}.csv")
        time.sleep(1.1)
    os.utime(f"{root}/out", None)
    assert fs.latest_dataset_directory(spark, root).endswith("/out/new.csv")
    back = fs.load_latest_csv(spark, root, fs.string_schema(["v"]))
    assert [r.v for r in back.collect()] == ["new"]


def test_external_table_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="tbl-")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    back = fs.save_table(df, "outletlab_tbl_test", f"{root}/t")
    assert back.collect()[0].asDict() == {"k": 1, "v": "a"}


def test_snapshot_columns_go_by_the_header(spark):
    root = tempfile.mkdtemp(prefix="header-")
    fs.write_csv(spark.createDataFrame([("1", "x")], "b string, a string"), f"{root}/out/s.csv")
    row = fs.load_latest_csv(spark, root).select("a", "b").first()
    assert (row.a, row.b) == ("x", "1")


def test_scratch_folder_rules(spark, monkeypatch):
    from outletlab import session

    frame = session.cut_lineage(spark.range(5), "kept")
    assert frame.count() == 5
    path = session._scratch[spark.sparkContext.applicationId][-1]

    class Cluster:
        """A session on a cluster whose checkpoint folder isn't set."""
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://somewhere:7077"
            getCheckpointDir = staticmethod(lambda: None)

    try:
        session.checkpoint_root(Cluster)
    except ValueError as error:
        assert "spark.checkpoint.dir" in str(error)
    else:
        raise AssertionError("a cluster without a shared folder was accepted")
    kept = {spark.sparkContext.applicationId: [path]}
    monkeypatch.setattr(session, "_scratch", kept)
    assert session.drop_scratch(spark) == 1 and not os.path.exists(path.removeprefix("file:"))
