import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wattline import schema  # noqa: E402
from wattline.plans.daily import LakePaths  # noqa: E402
from wattline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark__master="local[8,4]",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("work")),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def settings(spark):
    """Change Spark settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def lake_paths(tmp_path):
    return LakePaths.below(str(tmp_path))


class Day:
    """Writes raw files and the device file of a lake."""

    def __init__(self, paths):
        self.paths = paths

    def lines(self, day, site, device, *lines):
        folder = Path(self.paths.raw) / day.replace("-", "/") / site
        folder.mkdir(parents=True, exist_ok=True)
        text = [x if isinstance(x, str) else json.dumps(x) for x in lines]
        (folder / f"{device}.jsonl").write_text("\n".join(text) + "\n")

    def reading(self, day, clock, device, site, **fields):
        return {"ts_utc": f"{day}T{clock}Z", "device_id": device, "site_id": site} | fields

    def devices(self, text):
        path = Path(self.paths.devices)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


@pytest.fixture
def raw(lake_paths):
    day = Day(lake_paths)
    day.devices("device_id,site_id,device_type,capacity_kwh\nD1,01,battery,200\nD2,02,battery,abc\n")
    return day


def plan_of(df, mode="simple"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


SILVER_COLUMNS = schema.names(schema.SILVER)
