"""The validation stage: quarantined scan, atomic publication, profiles by footer, guard without a job."""
import hashlib

import pytest
from pyspark.sql import functions as F

from panelforge.operators import validate as va
from panelforge.plans.design import design_from_labelled
from panelforge.plans.validation import run_validation
from panelforge.sources.publish import current_version
from panelforge.sources.scan import scan_interim, scan_panel, scan_rejects
from panelforge.sources.sinks import sink_interim, sort_panel

SCHEMA = "entity long, period int, ret double"


@pytest.fixture
def landed(tmp_path):
    (tmp_path / "drop.csv").write_text("entity,period,ret\n1,200001,0.5\n2,200001,oops\n1,200001,0.5\n3,200001,NaN\n4,200001\n5,2000x1,1.0\n")
    return str(tmp_path / "drop.csv")


def test_lines_that_do_not_fit_are_quarantined(spark, landed):
    good, bad = scan_panel(spark, landed, SCHEMA, "csv"), scan_rejects(spark, landed, SCHEMA)
    assert sorted((r["entity"], r["ret"]) for r in good.collect()) == [(1, 0.5), (1, 0.5), (3, None)]
    assert sorted(r["line"] for r in bad.collect()) == ["2,200001,oops", "4,200001", "5,2000x1,1.0"]
    assert good.select("entity").count() == 3 and bad.count() == 3  # also if the faulty column is not asked for
    assert all(r["file_path"].endswith("drop.csv") for r in bad.collect())


def test_validation_run(spark, landed, tmp_path):
    out = run_validation(spark, landed, SCHEMA, str(tmp_path / "interim"), required=["ret", "gone"], target="ret", prohibited=["period"])
    report = {r["check_name"]: r["n"] for r in out["report"].collect()}
    assert report == {"rejected_lines": 3, "rows": 3, "missing_values": 1, "duplicate_rows": 1, "infinite_columns": 0,
                      "invalid_probability_columns": 0, "negative_risk_columns": 0, "constant_columns": 2, "absent_columns": 1,
                      "prohibited_columns": 1, "interim_rows": 2}
    assert sorted(r["entity"] for r in out["panel"].collect()) == [1, 3]


def test_a_key_that_repeats_stops_the_run(spark, tmp_path):
    (tmp_path / "d.csv").write_text("entity,period,ret\n1,200001,0.5\n1,200001,0.7\n")
    with pytest.raises(va.ValidationError):
        run_validation(spark, str(tmp_path / "d.csv"), SCHEMA, str(tmp_path / "interim"), required=["ret"], target="ret")


def test_readers_see_whole_versions_only(spark, tmp_path):
    path = str(tmp_path / "interim")
    with pytest.raises(FileNotFoundError):
        scan_interim(spark, path)
    first = spark.createDataFrame([(2, 200001, 1.0), (1, 200001, 2.0)], SCHEMA)
    one = sink_interim(first, path)
    assert current_version(spark, path) == one and scan_interim(spark, path).count() == 2
    broken = first.withColumn("ret", F.raise_error(F.lit("writer dies")).cast("double"))
    with pytest.raises(Exception):
        sink_interim(broken, path)
    assert current_version(spark, path) == one and scan_interim(spark, path).count() == 2
    two = sink_interim(first.limit(1), path)
    assert two != one and scan_interim(spark, path).count() == 1


def test_sorted_panel_is_in_key_order(spark):
    df = spark.range(5000).selectExpr("(id * 7919) % 100 entity", "cast(200001 + id % 12 as int) period", "id ret").repartition(6)
    got = [(r["entity"], r["period"]) for r in sort_panel(df).collect()]
    assert got == sorted(got)


def test_profile_takes_each_files_own_columns(spark, tmp_path):
    spark.createDataFrame([(1, 200001, 0.5), (2, 200002, 0.5)], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "d" / "drop=1"))
    spark.createDataFrame([(3, 200003)], "entity long, period int").coalesce(1).write.parquet(str(tmp_path / "d" / "drop=2"))
    rows = {r["file_path"].split("drop=")[1][0]: r for r in va.drop_profile(spark, str(tmp_path / "d" / "*" / "*.parquet"), entity="entity", period="period").collect()}
    assert (rows["1"]["n_columns"], rows["1"]["n_rows"], rows["1"]["n_periods"]) == (3, 2, 2)
    assert (rows["2"]["n_columns"], rows["2"]["n_rows"], rows["2"]["n_entities"]) == (2, 1, 1)
    file = next((tmp_path / "d" / "drop=1").glob("*.parquet"))
    assert rows["1"]["sha256"] == hashlib.sha256(file.read_bytes()).hexdigest() and rows["1"]["n_bytes"] == file.stat().st_size
    assert va.raw_immutable(va.drop_profile(spark, str(tmp_path / "d" / "*" / "*.parquet")), va.drop_profile(spark, str(tmp_path / "d" / "*" / "*.parquet"))).count() == 0
    other = va.drop_profile(spark, str(tmp_path / "d" / "drop=1" / "*.parquet"))
    both = va.drop_profile(spark, str(tmp_path / "d" / "*" / "*.parquet"))
    assert [r["status"] for r in va.raw_immutable(both, other).collect()] == ["removed"]
    changed = other.withColumn("sha256", F.lit("x"))
    assert [r["status"] for r in va.raw_immutable(other, changed).collect()] == ["changed"]
    assert [r["status"] for r in va.raw_immutable(other, both).collect()] == ["added"]


def _labelled(spark, month):
    rows = [(i, 199901, "a", float(i), 199902 if i else month, "train", 0.1 * i) for i in range(8)]
    return spark.createDataFrame(rows, "entity long, period int, category string, ret double, target_month int, split string, target double")


def test_every_design_guards_its_fit_rows(spark):
    design_from_labelled(_labelled(spark, 199912), ["ret"])
    with pytest.raises(va.ValidationError):
        design_from_labelled(_labelled(spark, 200001), ["ret"])
    design_from_labelled(_labelled(spark, 200001).withColumn("split", F.when(F.col("target_month") > 199912, "val").otherwise("train")), ["ret"])


def test_the_guard_runs_no_job_of_its_own(spark):
    guard = va.FitGuard(_labelled(spark, 200001), F.col("split") == "train", limit=199912)
    guard.rows.agg(F.avg("ret")).collect()
    with pytest.raises(va.ValidationError):
        guard.check()
