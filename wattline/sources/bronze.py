"""Raw telemetry: one JSON object per line, in one folder per day.

Two folder layouts are read, always by path, because the site comes from the record itself:

* `dated`:  `<base>/2025/08/01/<site>/<device>.jsonl`, as devices deliver it
* `keyed`:  `<base>/raw_date=2025-08-01/raw_site=<site>/part-*.json`, as `write_bronze` writes it
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schema
from wattline.functions.times import parse_utc, utc_date
from wattline.sources.paths import gathered, load_or_empty

# layout -> (folder of a day, file pattern, number of path segments from the day to the file)
_LAYOUTS = {
    "dated": ("%Y/%m/%d", "*.jsonl", 5),
    "keyed": ("raw_date=%Y-%m-%d", "*.json", 3),
}


def read_raw_days(
    spark: SparkSession, base: str, dates: Sequence[str], layout: str = "dated"
) -> DataFrame:
    """Records of the given days in one scan, with the day of their folder as `process_date`.

    Days without a folder contribute nothing. The day folders are the scan's roots, so the files
    below them are listed by Spark (in parallel when there are many sites), not on the driver.
    """
    folder, files, segments = _LAYOUTS[layout]
    days = sorted({date.fromisoformat(d).strftime(folder) for d in dates})
    if not days:
        return spark.createDataFrame([], f"{schema.TELEMETRY}, process_date string")
    path = f"{base}/{days[0]}" if len(days) == 1 else f"{base}/{{{','.join(days)}}}"
    reader = (
        spark.read.schema(schema.TELEMETRY)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", files)
    )
    # exactly one folder level (the site) lies between a day and its files
    tail = F.substring_index("_metadata.file_path", "/", -segments)
    day = F.substring(tail, 1, len(days[0]))
    process_date = F.right(day, F.lit(len("2025-08-01")))
    if "/" in days[0]:
        process_date = F.translate(process_date, "/", "-")
    return load_or_empty(
        spark,
        f"{schema.TELEMETRY}, process_date string",
        lambda: reader.json(path)
        .where(day.isin(days))
        .select("*", process_date.alias("process_date")),
    )


def read_raw_day(
    spark: SparkSession, base: str, process_date: str, layout: str = "dated"
) -> DataFrame:
    """Records of one day; an empty frame of the same schema when the day has no files."""
    return read_raw_days(spark, base, [process_date], layout).select(*schema.names(schema.TELEMETRY))


def write_bronze(df: DataFrame, base: str, day: Column | None = None) -> None:
    """Write records as JSON lines into the `keyed` layout.

    Day and site become folders as *copies*, so the site also stays in the record. `day` defaults
    to the UTC date of `ts_utc`. A record without a day would lie where no run reads it, so it is an
    error and nothing is written: give `day`, the date of delivery, where times may be bad.
    """
    if day is None:
        day = utc_date(parse_utc(F.col("ts_utc")))
    day = F.coalesce(day.cast("string"), F.raise_error(F.lit("a record has no day")).cast("string"))
    rows = df.select(
        *schema.names(schema.TELEMETRY),
        day.alias("raw_date"),
        F.col("site_id").alias("raw_site"),
    )
    (
        gathered(rows, "raw_date", "raw_site")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", False)
        .partitionBy("raw_date", "raw_site")
        .json(base)
    )
