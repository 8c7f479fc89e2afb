"""Landing, reading, refreshing and reporting feeds; the table store."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from rollcall.operators.verify import ContractBroken
from rollcall.plans.build import build
from rollcall.sources.contracts import CONTRACTS
from rollcall.sources.feeds import (
    landed_partitions,
    landed_violations,
    load_feeds,
    load_report,
    read_feed,
    read_manifest,
    write_feed,
)
from rollcall.catalog.queries import estate as shared_estate
from rollcall.plans.estate import Estate
from rollcall.settings import Settings
from rollcall.sources.adapter import RetailAdapter
from rollcall.sources.store import SessionStore, TableStore, shared_folder


@pytest.fixture(scope="module")
def landed(spark, estate, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landed"))
    for feed in CONTRACTS:
        write_feed(estate[feed], root, feed)
    return root


@pytest.mark.parametrize("feed", CONTRACTS)
def test_a_feed_survives_the_round_trip(spark, estate, landed, feed):
    back, sent = read_feed(spark, landed, feed), estate[feed]
    columns = [f.name for f in CONTRACTS[feed].fields]
    assert back.columns == columns and back.schema == CONTRACTS[feed].schema
    assert back.exceptAll(sent.select(columns)).isEmpty()
    assert sent.select(columns).exceptAll(back).isEmpty()


def test_day_ranges_prune_partitions(spark, landed):
    days = read_feed(spark, landed, "hr_employee_snapshot", "2024-01-05", "2024-01-06")
    assert {str(r[0]) for r in days.select("snapshot_date").distinct().collect()} == {"2024-01-05", "2024-01-06"}
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_scans_read_only_the_asked_columns_and_push_filters(spark, landed):
    df = read_feed(spark, landed, "badge_taps").where("direction = 'in'").select("emp_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(direction,in)" in plan
    assert "ReadSchema: struct<emp_id:string,direction:string>" in plan


def test_only_the_refreshed_days_change(spark, estate, tmp_path):
    root = str(tmp_path)
    hr = estate["hr_employee_snapshot"]
    write_feed(hr, root, "hr_employee_snapshot")
    one = hr.where("snapshot_date = '2024-01-05'").withColumn("badge_type", F.lit("new"))
    write_feed(one, root, "hr_employee_snapshot", replace_days_only=True)
    back = read_feed(spark, root, "hr_employee_snapshot")
    assert back.count() == hr.count()
    assert {str(r[0]) for r in back.where("badge_type = 'new'").select("snapshot_date").distinct().collect()} == {"2024-01-05"}
    write_feed(one, root, "hr_employee_snapshot")
    assert read_feed(spark, root, "hr_employee_snapshot").count() == one.count()


def test_columns_are_united_by_name_across_files(spark, landed, estate, tmp_path):
    root = str(tmp_path / "feed")
    sites = estate["workplace_dim"]
    sites.write.parquet(f"{root}/workplace_dim")
    shuffled = sites.select(*reversed(sites.columns)).drop("timezone")
    shuffled.write.mode("append").parquet(f"{root}/workplace_dim")
    back = read_feed(spark, root, "workplace_dim")
    assert back.count() == 2 * sites.count()
    assert back.where("city IS NULL OR region IS NULL").isEmpty()
    assert back.where("timezone IS NULL").count() >= sites.count()


def test_the_load_report_counts_rows_and_partitions(spark, estate, landed):
    report = {r["feed"]: r for r in load_report(spark, landed).collect()}
    hr = estate["hr_employee_snapshot"]
    assert report["hr_employee_snapshot"]["rows"] == hr.count()
    assert report["hr_employee_snapshot"]["partitions"] == hr.select("snapshot_date").distinct().count()
    assert report["leave_requests"]["rows"] == estate["leave_requests"].count()
    assert set(report) == set(CONTRACTS)
    assert all(r["partitions_validated"] == r["partitions"] for r in report.values())


def test_a_broken_day_is_one_partition_fewer(spark, estate, tmp_path):
    root, hr = str(tmp_path), estate["hr_employee_snapshot"]
    bad = F.col("snapshot_date") == "2024-01-05"
    write_feed(hr.withColumn("employee_type", F.when(~bad, F.col("employee_type")).otherwise("robot")), root, "hr_employee_snapshot")
    row = load_report(spark, root, ("hr_employee_snapshot",)).first()
    assert row["partitions_validated"] == row["partitions"] - 1 and row["violations"] == hr.where(bad).count()
    parts = landed_partitions(spark, root, "hr_employee_snapshot").where("violations > 0").collect()
    assert [p["partition"] for p in parts] == ["dt=2024-01-05"] and parts[0]["rows"] == row["violations"]


def test_folders_of_landed_rows_are_cut_without_a_pattern(spark, estate, tmp_path):
    """The folder is worked out for every row of a landed feed."""
    root = f"file://{tmp_path}"
    write_feed(estate["badge_taps"].limit(50), root, "badge_taps")
    found = landed_partitions(spark, root, "badge_taps")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan and "substring_index" in plan
    assert {r["partition"][:3] for r in found.collect()} == {"dt="}


def test_sound_files_pass_the_contracts_and_build(spark, estate, landed):
    assert landed_violations(spark, landed).where("violations > 0").isEmpty()
    built = build(spark, landed)
    assert built["int_employee_day"].count() == estate["int_employee_day"].count()


def test_broken_files_stop_the_load(spark, estate, tmp_path):
    root = str(tmp_path)
    for feed in CONTRACTS:
        write_feed(estate[feed].limit(50), root, feed)
    leave = estate["leave_requests"].drop("status").withColumn("note", F.lit("x"))
    leave.withColumn("start_date", F.lit("soon")).write.mode("overwrite").parquet(f"{root}/leave_requests")
    with pytest.raises(ContractBroken) as stop:
        load_feeds(spark, root)
    for said in ("status missing: 1", "note unexpected: 1", "start_date type:"):
        assert said in str(stop.value)


def test_small_days_land_in_one_file(spark, landed):
    files = (
        spark.read.parquet(f"{landed}/hr_employee_snapshot")
        .select(F.col("_metadata.file_path").alias("f"), "dt")
        .distinct()
        .groupBy("dt")
        .count()
    )
    assert files.where("count > 1").isEmpty()


def test_manifests_become_rows(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"a": 1, "b": 12}, indent=2))
    assert {(r["key"], r["value"]) for r in read_manifest(spark, str(path)).collect()} == {("a", 1.0), ("b", 12.0)}


def test_the_store_lives_in_the_shared_folder_and_can_be_dropped(spark):
    store = TableStore(spark)
    assert store.root.startswith(shared_folder(spark))
    kept = store.put("t", spark.range(5))
    assert kept.count() == 5 and "t" in kept.inputFiles()[0]
    store.drop()
    with pytest.raises(Exception):
        spark.read.parquet(f"{store.root}/t").count()


def test_queries_of_a_session_share_stored_tables(spark, sf_dir, tmp_path):
    shared = SessionStore.of(spark)
    shared_estate(spark, sf_dir)["kept_taps"]
    before = shared.written
    for name in ("int_tap_day", "stg_badge_taps", "kept_taps"):
        shared_estate(spark, sf_dir)[name].count()
    assert shared.written == before
    other = Settings(repeat_window_seconds=10)
    Estate(spark, RetailAdapter(spark, sf_dir), other, shared)["kept_taps"]
    assert shared.written == before + 1
    at = str(tmp_path / "t")
    spark.range(5).write.parquet(at)
    assert shared.put("t", spark.read.parquet(at)).count() == 5
    spark.range(7).write.mode("overwrite").parquet(at)
    assert shared.put("t", spark.read.parquet(at)).count() == 7
    written = shared.written
    assert shared.put("t", spark.read.parquet(at)).count() == 7 and shared.written == written
    shared.drop()
    assert shared_estate(spark, sf_dir)["kept_taps"].count() > 0 and shared.written > written
