import random

import pytest
from conftest import plan_of, rows_of

from wattline import schema, session
from wattline.plans import daily
from wattline.plans.daily import LakePaths, run_days
from wattline.plans.late import same
from wattline.session import fresh_dir, shuffle_sized_for, work_root
from wattline.sources import lake


def test_shuffle_is_sized_from_the_input_and_restored(spark, tmp_path):
    setting = "spark.sql.shuffle.partitions"
    spark.range(100_000).selectExpr("id", "rand(1) AS x").write.parquet(str(tmp_path / "t"))
    df, before = spark.read.parquet(str(tmp_path / "t")), spark.conf.get(setting)
    with shuffle_sized_for(df) as wanted:
        assert wanted == int(before)  # never lowered
    with shuffle_sized_for(df, 10_000) as wanted:
        assert int(before) < wanted < 1000 and spark.conf.get(setting) == str(wanted)
    size = session.input_bytes(df)
    with pytest.raises(RuntimeError), shuffle_sized_for(df, size // 30_000) as wanted:
        assert 30_000 <= wanted <= 31_000  # follows the size
        raise RuntimeError
    with shuffle_sized_for(df, size // 30_000, most_partitions=20_000) as wanted:
        assert wanted == 20_000
    assert session.passes_for(df, size // 30_000, 20_000) == 2 and session.passes_for(df) == 1
    with shuffle_sized_for(df, size // 30_000, 20_000, passes=2) as wanted:
        assert 15_000 <= wanted <= 15_500
    assert spark.conf.get(setting) == before


def test_days_that_need_too_many_partitions_go_in_passes(spark, raw):
    for day in ("2025-08-01", "2025-08-02", "2025-08-03"):
        raw.lines(day, "01", "D1", *[raw.reading(day, f"0{h}:00:00", "D1", "01", energy_wh=1.0) for h in range(4)])
    dates = ["2025-08-01", "2025-08-02", "2025-08-03"]
    own = session.input_bytes(daily.read_raw_days(spark, raw.paths.raw, dates[:1]))
    two = daily.RunOptions(bytes_per_partition=own + 10, most_partitions=2)
    assert daily._passes(spark, raw.paths, dates, two) == [dates[:2], dates[2:]]
    assert daily._passes(spark, raw.paths, dates, daily.RunOptions()) == [dates]
    assert [r.rows_total for r in run_days(spark, raw.paths, dates, two).collect()] == [4, 4, 4]


@pytest.mark.parametrize("off_date", ["late", "overwrite"])
def test_a_day_beyond_the_ceiling_runs_in_parts_of_its_keys(spark, raw, tmp_path, monkeypatch, off_date):
    rng, dates = random.Random(3), ["2025-08-01", "2025-08-02"]
    for day in dates:
        raw.lines(day, "01", "D1", *[
            raw.reading(rng.choice([day, day, "2025-08-03"]), f"0{rng.randrange(4)}:00:00", rng.choice(["D1", "D2", "D3", None]),
                        rng.choice(["01", "02", None]), energy_wh=float(n), power_w=rng.choice([-1.0, 5.0, None]))
            for n in range(60)
        ], raw.reading(day, "bad", "D1", "01"), raw.reading(day, "bad", "D1", "01"), "no json")
    size = session.input_bytes(daily.read_raw_days(spark, raw.paths.raw, dates[:1]))
    parts, prepared = [], daily._prepare_in_parts
    monkeypatch.setattr(daily, "_prepare_in_parts", lambda raw, n, path: parts.append(n) or prepared(raw, n, path))
    states = []
    for name, ceiling in (("whole", {}), ("parts", {"bytes_per_partition": size // 20, "most_partitions": 5})):
        paths = LakePaths.below(str(tmp_path / name), raw.paths.devices)
        paths = LakePaths(raw.paths.raw, *[getattr(paths, f) for f in ("silver", "gold", "metrics", "devices", "late")])
        quality = run_days(spark, paths, dates, daily.RunOptions(off_date=off_date, **ceiling))
        late = lake.read_dates(spark, paths.late, daily.LATE, ["2025-08-03"])
        states.append([rows_of(x) for x in (lake.read_silver(spark, paths.silver), lake.read_gold(spark, paths.gold), quality, late)])
    assert parts == [4, 4] or parts == [5, 5]
    assert states[0] == states[1] and all(states[0][:3]) and bool(states[0][3]) == (off_date == "late")


def test_work_folder_is_the_one_the_cluster_names(spark):
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert first != second and first.startswith(f"{work_root(spark)}/x-")


def test_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        work_root(Session())


def test_null_equality_is_an_equi_join(spark):
    df = spark.range(5).selectExpr("string(id) AS device_id", "timestamp_seconds(id) AS ts")
    for kind in ("left_semi", "left_anti"):
        plan = plan_of(df.alias("l").join(df.alias("r").hint("merge"), same(schema.KEY), kind))
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("seed", range(3))
def test_order_and_files_of_records_do_not_matter(spark, raw, tmp_path, seed):
    rng = random.Random(seed)
    pick = rng.choice
    records = [
        raw.reading("2025-08-01", f"0{rng.randrange(3)}:00:0{rng.randrange(4)}", pick(["D1", "D2", None]),
                    pick(["01", "02", "", None]), power_w=pick([None, -1.0, 2.0, 3.0]), energy_wh=float(rng.randrange(9)),
                    temperature_c=pick([None, 20.0, 99.0]), soc_percent=pick([None, 50.0, 101.0]),
                    status=pick(["OK", "FAULT", None]))
        for _ in range(200)
    ]
    states = []
    for run in range(2):
        paths = LakePaths.below(f"{tmp_path}/{run}", raw.paths.devices)
        writer = type(raw)(paths)
        mixed = rng.sample(records, len(records))
        files = 1 + run * 4
        for i in range(files):
            writer.lines("2025-08-01", f"folder{i % 2}", f"file{i}", *mixed[i::files])
        quality = run_days(spark, paths, ["2025-08-01"])
        states.append([rows_of(x) for x in (
            lake.read_silver(spark, paths.silver), lake.read_gold(spark, paths.gold), quality
        )])
    assert states[0] == states[1]
    keys = {(r["device_id"], r["ts_utc"]) for r in records}
    assert f"duplicate_keys={len(records) - len(keys)}" in states[0][2][0]
