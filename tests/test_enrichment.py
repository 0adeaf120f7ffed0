import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from wattline.operators.enrichment import DuplicateDevices, enrich_capacity, profile_devices
from wattline.sources.devices import normalize_devices, read_devices, read_devices_normalized


@pytest.fixture
def readings(spark):
    rows = [("D1", 1.0), ("D1", 2.0), ("D9", 3.0), (None, 4.0)]
    return spark.createDataFrame(rows, "device_id string, power_w double")


def devices(spark, *rows):
    return spark.createDataFrame(list(rows), "device_id string, capacity_kwh double")


def test_unmatched_and_null_devices_get_no_capacity(spark, readings):
    found = enrich_capacity(readings, devices(spark, ("D1", 200.0), ("D2", 1.0), (None, 7.0), (None, 8.0)))
    assert {(r.device_id, r.power_w, r.capacity_kwh) for r in found.collect()} == {
        ("D1", 1.0, 200.0), ("D1", 2.0, 200.0), ("D9", 3.0, None), (None, 4.0, None)
    }


def test_small_dimension_is_broadcast(spark, readings):
    plan = plan_of(enrich_capacity(readings, devices(spark, ("D1", 200.0))))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_dimension_beyond_the_limit_is_merged(spark, readings):
    dimension = devices(spark, ("D1", 200.0), ("D2", 5.0))
    big = enrich_capacity(readings, dimension, broadcast_limit_bytes=10)
    assert "SortMergeJoin" in plan_of(big) and "Broadcast" not in plan_of(big)
    assert rows_of(big) == rows_of(enrich_capacity(readings, dimension))


def test_hot_device_is_split_when_merging(spark, settings):
    settings(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="32",
    )
    readings = spark.range(0, 60_000, 1, 16).selectExpr(
        "if(id % 3 = 0, 'hot', concat('D', id % 500)) AS device_id", "rand(3) AS power_w"
    )
    dimension = spark.range(500).selectExpr("concat('D', id) AS device_id", "double(id) AS capacity_kwh")
    joined = enrich_capacity(readings, dimension, broadcast_limit_bytes=10)
    assert len(joined.collect()) == 60_000
    assert "SortMergeJoin(skew=true)" in plan_of(joined)


def test_hot_device_without_adaptive_execution(spark, settings):
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="12")
    readings = spark.range(30_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'D1' WHEN id % 3 = 1 THEN concat('D', id % 500) END AS device_id", "'s' AS salts"
    )
    dimension = spark.range(400).selectExpr("concat('D', id) AS device_id", "double(id) AS capacity_kwh")
    joined = enrich_capacity(readings, dimension, broadcast_limit_bytes=10)
    assert joined.columns == ["device_id", "id", "salts", "capacity_kwh"]
    tasks = joined.groupBy("device_id", F.spark_partition_id().alias("p")).count()
    for hot in ("device_id = 'D1'", "device_id IS NULL"):
        found = tasks.where(hot).collect()
        assert len(found) >= 3 and max(r["count"] for r in found) < 10_000 / 2
    assert "SortMergeJoin" in plan_of(joined)
    plain = readings.join(F.broadcast(dimension), "device_id", "left")
    assert rows_of(joined) == rows_of(plain) and joined.count() == 30_000


def test_salted_join_of_nothing(spark, settings):
    settings(spark__sql__adaptive__enabled="false")
    empty = spark.createDataFrame([], "device_id string, x long")
    assert enrich_capacity(empty, devices(spark, ("D1", 1.0)), broadcast_limit_bytes=0).count() == 0


def test_duplicate_devices(spark, readings):
    twice = devices(spark, ("D1", 300.0), ("D1", 200.0), ("D1", None), ("D2", 1.0))
    assert profile_devices(twice).duplicates == 2
    with pytest.raises(DuplicateDevices):
        enrich_capacity(readings, twice)
    kept = enrich_capacity(readings, twice, "keep_one")
    assert kept.count() == 4 and kept.where("capacity_kwh = 200").count() == 2
    assert enrich_capacity(readings, twice, "fan_out").count() == 8
    with pytest.raises(ValueError):
        enrich_capacity(readings, twice, "other")


def test_device_file(spark, tmp_path):
    path = tmp_path / "devices.csv"
    path.write_text("capacity_kwh,device_type,device_id\n200,battery,007\nabc,battery,D2\n,x, D3 \n")
    rows = read_devices(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("007", 200.0), ("D2", None), (" D3 ", None)]


def test_normalized_device_file(spark, tmp_path):
    path = tmp_path / "devices.csv"
    path.write_text("device_id,site_id\n 007 , 01 \n")
    assert [tuple(r) for r in read_devices_normalized(spark, str(path)).collect()] == [("007", "01", 200.0)]
    given = spark.createDataFrame([("a", "b", "x")], "device_id string, site_id string, capacity_kwh string")
    assert normalize_devices(given).first().capacity_kwh is None


def test_device_files_with_another_header_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("device_id,site_id,device_type,capacity_kwh\nD1,01,battery,200\n")
    (tmp_path / "b.csv").write_text("device_id,site_id,device_type,capacity_kwh\nD2,01,battery,300\n")
    assert {tuple(r) for r in read_devices(spark, str(tmp_path)).collect()} == {("D1", 200.0), ("D2", 300.0)}
    (tmp_path / "c.csv").write_text("capacity_kwh,site_id,device_type,device_id\n300,01,battery,D3\n")
    with pytest.raises(Exception, match="header"):
        read_devices(spark, str(tmp_path)).collect()
