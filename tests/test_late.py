import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F
from test_runs import DAYS, Lost, failing, fill, state

from wattline import schema
from wattline.operators.kpis import figures, merged_states, site_daily, site_states
from wattline.operators.quality import written_layout
from wattline.plans import late
from wattline.plans.daily import RunOptions, compact_days, merge_late, run_days
from wattline.sources import lake


def deliver_late(raw, spark, n):
    """Rows of the first day in the folder of another, one more with every call."""
    day = f"2025-09-{n + 1:02d}"
    raw.lines(day, "01", "D01", *[
        raw.reading(DAYS[0], f"1{k}:00:0{n % 10}", "D01", "01", power_w=100.0 + n, energy_wh=1.0, temperature_c=30.0, status="FAULT")
        for k in range(2)
    ])
    run_days(spark, raw.paths, [day])


def checked(spark, paths, dates=DAYS[:1]):
    """States and figures are those of all readings."""
    readings = lake.read_silver(spark, paths.silver, dates)
    wanted = rows_of(site_daily(readings).select(*schema.names(schema.GOLD)))
    assert rows_of(lake.read_gold(spark, paths.gold, dates)) == wanted
    assert rows_of(figures(lake.read_states(spark, paths.states, dates)).select(*schema.names(schema.GOLD))) == wanted
    return readings.count()


def test_ten_merges_leave_one_file_per_small_site_day(spark, raw):
    fill(raw, DAYS[0])
    run_days(spark, raw.paths, DAYS[:1])
    for n in range(10):
        deliver_late(raw, spark, n)
        merge_late(spark, raw.paths, DAYS[:1])
    assert checked(spark, raw.paths) == 8 + 20
    found = written_layout(lake.read_silver(spark, raw.paths.silver, DAYS[:1])).first()
    assert (found.files, found.folders) == (2, 2)
    assert not late.folders(spark, f"{raw.paths.merging}/*")


def test_only_scattered_site_days_are_rewritten(spark, raw):
    fill(raw, DAYS[0])
    run_days(spark, raw.paths, DAYS[:1])
    before = set(lake.read_silver(spark, raw.paths.silver).inputFiles())
    for n in range(2):
        deliver_late(raw, spark, n)
        merge_late(spark, raw.paths, DAYS[:1], compact=False)
    rows = rows_of(lake.read_silver(spark, raw.paths.silver))
    assert compact_days(spark, raw.paths, DAYS[:1], file_bytes=10) == 0  # files are large enough
    assert len(lake.scattered_folders(spark, raw.paths.silver, DAYS[:2])) == 1
    assert compact_days(spark, raw.paths, DAYS) == 1 and compact_days(spark, raw.paths, DAYS) == 0
    after = set(lake.read_silver(spark, raw.paths.silver).inputFiles())
    assert len(before & after) == 1 and len(after) == 2 and rows_of(lake.read_silver(spark, raw.paths.silver)) == rows
    assert compact_days(spark, raw.paths, ["1999-01-01"]) == 0


@pytest.mark.parametrize("name", ["write_silver", "write_states", "write_gold"])
@pytest.mark.parametrize("mend", ["merge", "run"])
def test_merge_that_failed_is_finished_by_the_next_call(spark, raw, monkeypatch, name, mend):
    fill(raw, DAYS[0], power=5.0)
    fill(raw, DAYS[1], off_date=[DAYS[0]])
    run_days(spark, raw.paths, DAYS[:2])
    failing(monkeypatch, lake, name)
    with pytest.raises(Lost):
        merge_late(spark, raw.paths, DAYS[:1])
    if mend == "merge":
        merge_late(spark, raw.paths, DAYS[:1])
    else:
        fill(raw, DAYS[2])
        run_days(spark, raw.paths, DAYS[2:])
    assert checked(spark, raw.paths) == 10
    assert not late.folders(spark, f"{raw.paths.merging}/*")


def test_rows_of_a_merge_that_was_not_begun_are_dropped(spark, raw, monkeypatch):
    fill(raw, DAYS[0])
    run_days(spark, raw.paths, DAYS[:1])
    spark.range(3).write.parquet(f"{raw.paths.merging}/merge-x")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{raw.paths.merging}/merge-x/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    before = state(spark, raw.paths)
    merge_late(spark, raw.paths, DAYS[:1])
    assert state(spark, raw.paths) == before and not late.folders(spark, f"{raw.paths.merging}/*")


def test_compaction_that_failed_loses_no_row(spark, raw, monkeypatch):
    fill(raw, DAYS[0])
    run_days(spark, raw.paths, DAYS[:1])
    deliver_late(raw, spark, 1)
    merge_late(spark, raw.paths, DAYS[:1], compact=False)
    rows, whole = rows_of(lake.read_silver(spark, raw.paths.silver)), lake.write_silver

    def lost(df, base, *a, **b):  # between removing the old partition and putting the new one in its place
        late.drop_dir(spark, f"{base}/event_date={DAYS[0]}/site_id=01")
        raise Lost

    monkeypatch.setattr(lake, "write_silver", lost)
    with pytest.raises(Lost):
        compact_days(spark, raw.paths, DAYS[:1])
    monkeypatch.setattr(lake, "write_silver", whole)
    assert compact_days(spark, raw.paths, DAYS[:1]) == 0
    assert rows_of(lake.read_silver(spark, raw.paths.silver)) == rows


def test_figures_after_a_merge_do_not_read_the_old_readings(spark, raw, monkeypatch):
    fill(raw, DAYS[0], power=5.0)
    fill(raw, DAYS[1], off_date=[DAYS[0], "2025-06-01"])
    run_days(spark, raw.paths, DAYS[:2])
    plans, write_gold, write_states = [], lake.write_gold, lake.write_states
    monkeypatch.setattr(lake, "write_gold", lambda df, base: plans.append(plan_of(df)) or write_gold(df, base))
    monkeypatch.setattr(lake, "write_states", lambda df, base: plans.append(plan_of(df)) or write_states(df, base))
    read, dates = lake.read_silver, []
    monkeypatch.setattr(lake, "read_silver", lambda s, base, days=None: dates.append(list(days)) or read(s, base, days))
    merge_late(spark, raw.paths, [DAYS[0], "2025-06-01"], compact=False)
    assert len(plans) == 2 and not any(raw.paths.silver + "/" in p or f"{raw.paths.silver}]" in p for p in plans)
    # the keys of the dates, and the one date that had no states yet
    assert dates == [[DAYS[0], "2025-06-01"], ["2025-06-01"]]
    monkeypatch.undo()
    assert checked(spark, raw.paths, [DAYS[0], "2025-06-01"]) == 12


def test_lake_without_states(spark, raw):
    fill(raw, DAYS[0], power=5.0)
    fill(raw, DAYS[1], off_date=[DAYS[0]])
    run_days(spark, raw.paths, DAYS[:2])
    late.drop_dir(spark, raw.paths.states)
    merge_late(spark, raw.paths, DAYS[:1])
    assert checked(spark, raw.paths) == 10


def test_repeated_devices_in_a_merge(spark, raw):
    raw.devices("device_id,site_id,device_type,capacity_kwh\nD01,01,battery,200\nD01,01,battery,300\n")
    fill(raw, DAYS[0], power=5.0)
    fill(raw, DAYS[1], off_date=[DAYS[0]])
    run_days(spark, raw.paths, DAYS[:2], RunOptions(duplicate_devices="fan_out"))
    for _ in range(2):
        merge_late(spark, raw.paths, DAYS[:1], "fan_out")
        assert checked(spark, raw.paths) == 8 + 4 + 1 + 2


def test_rerun_of_a_merged_date(spark, raw):
    fill(raw, DAYS[0], power=5.0)
    fill(raw, DAYS[1], off_date=[DAYS[0]])
    run_days(spark, raw.paths, DAYS[:2])
    merge_late(spark, raw.paths, DAYS[:1])
    run_days(spark, raw.paths, DAYS[:1])
    assert checked(spark, raw.paths) == 8
    merge_late(spark, raw.paths, DAYS[:1])
    assert checked(spark, raw.paths) == 10


def test_states_add_up_to_the_figures(spark):
    nan = float("nan")
    rows = [("2025-08-01", s, p, e, t, st) for s in ("a", None) for p in (None, 1.0, nan) for e in (None, 2.5) for t in (None, 4.0)
            for st in ("OK", "FAULT", None)]
    rows += [("2025-08-02", "none", None, None, None, None)]
    df = spark.createDataFrame(rows, "day string, site_id string, power_w double, energy_wh double, temperature_c double, status string")
    df = df.withColumn("event_date", F.to_date("day"))
    parts = [site_states(df.where(f"pmod(hash(*), 3) = {i}")) for i in range(3)]
    whole = figures(merged_states(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    wanted = site_daily(df)
    assert rows_of(whole.select(*wanted.columns)) == rows_of(wanted)
