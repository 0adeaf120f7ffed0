"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattline.session import drop_dir, fresh_dir

# Words as the contracts name them: runs of anything but the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs: DataFrame) -> Column:
    """The text column, null read as empty."""
    return F.coalesce(docs["text"], F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def written(df: DataFrame, label: str, **options) -> DataFrame:
    """Write a table to the shared work folder and read it: later steps then all see the same rows,
    and a lost executor costs no recomputation."""
    path = fresh_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that `written` made and nothing reads any more."""
    folder = df.inputFiles()[0].rpartition("/")[0] if df.inputFiles() else None
    if folder:
        drop_dir(df.sparkSession, folder)


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have."""
    while name in df.columns:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """Every fifth document by crc32 of its id as text; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, rows_per_label: int) -> DataFrame:
    """(doc_id, text, label): at most `rows_per_label` training documents of either label.

    Only rows that are not held out. Several labels of one document: the smallest counts; null
    labels don't. The sample is the rows with the smallest hash of the id, so it does not change
    between runs. Of rows that share an id, the smallest text is used.
    """
    spark = docs.sparkSession
    known = (
        labels.select("doc_id", F.col(column).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    chosen = []
    for label in (0, 1):
        one = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_label)
        chosen += [(r.doc_id, label) for r in one.select("doc_id").collect()]
    ids = spark.createDataFrame(chosen, "doc_id long, label int")
    return (
        docs.select("doc_id", text_of(docs).alias("text"))
        .join(F.broadcast(ids), "doc_id")  # 2 * rows_per_label rows at most
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )


def numbered(rows: DataFrame, key: str, column: str) -> DataFrame:
    """`rows` with `column`: a row's number, from 0, among the rows of its `key`.

    Only rows whose key repeats are written and numbered: within stretches of 1024 of the written rows,
    after the key's rows in the stretches before. So a key with a third of all rows is many small groups.
    """
    again = written(rows.groupBy(key).count().where("count > 1").select(key), "again")
    n_again = again.count()
    if not n_again:
        return rows.withColumn(column, F.lit(0).cast("long"))
    few = sent_whole(again, n_again, 64)
    at, earlier = unused(rows, "__stretch"), unused(rows, "__earlier")
    repeats = rows.join(few, key, "left_semi").withColumn(column, F.monotonically_increasing_id())
    repeats = written(repeats, "repeats").withColumn(at, F.call_function("shiftright", column, F.lit(10)))
    before = W.partitionBy(key).orderBy(at).rowsBetween(W.unboundedPreceding, -1)
    stretches = repeats.groupBy(key, at).agg(F.count(F.lit(1)).alias(earlier))
    stretches = stretches.withColumn(earlier, F.coalesce(F.sum(earlier).over(before), F.lit(0)))
    within = F.row_number().over(W.partitionBy(key, at).orderBy(column)) - 1
    placed = repeats.withColumn(column, within).join(stretches, [key, at])
    placed = placed.withColumn(column, F.col(column) + F.col(earlier)).select(*rows.columns, column)
    return rows.join(few, key, "left_anti").withColumn(column, F.lit(0).cast("long")).unionByName(placed)


def sent_whole(small: DataFrame, rows: int, row_bytes: int, most_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """`small` marked for broadcast if `rows` of `row_bytes` fit in `most_bytes`; else as it is, for a shuffled join."""
    return F.broadcast(small) if rows * row_bytes <= most_bytes else small
