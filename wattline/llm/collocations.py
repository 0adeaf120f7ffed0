"""Phrase collocation mining, set-oriented: sorted occurrence relations, merge-joined to ever longer phrases.

A relation has a row (doc, place, after, phrase) for each occurrence of each frequent phrase of k words. It is
written in buckets of `doc`, in order of place, so every later step merges it without a shuffle. Nothing is sorted
for that: a task writes one bucket and has its rows in order, and the table is named twice in the catalog, as
sorted by the place and by the place after, so that both sides of a merge-join lie as it needs them. Words of one piece stand at
consecutive places and between pieces a place stays empty, so neighbours are of one piece. A step makes
relation k + 1:

1. merge-join: an occurrence at a place and one at the next are an occurrence of k + 1 words, the pair of the two
   phrases being its name;
2. group and count the pairs; those with `least` occurrences are the frequent phrases of k + 1 words;
3. semi-join: only the occurrences of frequent phrases remain, under a new number, before the next step.

A phrase is never more frequent than its parts, so nothing is lost. Every frequent phrase carries how often its
first and last 1, 2, ... words occur (`heads`, `tails`), which is all that scores need.

Texts are read twice: to count the words and to make the first relation. Texts are split into words and runs of
piece ends at once; A-Z is lower-cased in the distinct words. A frequent word costs one row per task in the
counts. Phrases are numbered from 0 on, so that a pair of numbers is one long. Frequent phrases are broadcast to
the occurrences up to 96 MiB (1.5 million of them), else joined by a shuffle whose large partitions adaptive
execution splits. A spelling is found by its 64-bit hash; if a frequent one shares its hash with any other word of
the texts, language and bytes are joined too. Places and numbers are written as differences.

Defined cases: a null text has no words; a null lang is `und`; a text without piece ends is one piece of any
length; repeated rows count as often as they occur; an empty table gives an empty result; other columns are not
read; words are compared by their bytes; of phrases equal in score and count the smaller by bytes comes first.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattline.llm.common import discard, sent_whole, text_of, written
from wattline.session import drop_dir, fresh_dir, shuffle_sized_for

LEAST = 100  # occurrences of a candidate
LONGEST = 5  # words
FIRST = 2000  # phrases of a language

ENDS = r".,;:!?\x0A-\x0D"
TOKEN = rf"[^\x20\x09{ENDS}]+|[{ENDS}]+"  # a word, or a run of piece ends
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
INPUT_BYTES = 32 * 1024 * 1024  # of the documents' files for one bucket; its words take about ten times that
PAIR_BYTES, WORD_BYTES = 64, 160  # of a row in memory: a long and a number, or a word too
BROADCAST_BYTES = 96 * 1024 * 1024

# Merge what is bucketed by document as it lies: in buckets and in their order.
AS_IT_LIES = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "1",  # a bucket is written in the order of its task's rows
    "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",  # most groups are small, a first map of few only costs
}

# Columns as differences from row to row (of places nothing, of numbers their bits) without a dictionary.
DIFFERENCES = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false", "compression": "none"}

# A task that counts pairs has about 4 million of them, so that their groups stay in memory.
COUNTED = {"spark.sql.files.maxPartitionBytes": "16m"}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class Relations:
    """Tables (doc, place, ...) in buckets of `doc`, in order of place, in the shared work folder."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.paths = spark, buckets, {}

    def write(self, rows: DataFrame, dealt: bool) -> str:
        """The table's name. `dealt`: a task of `rows` holds just one bucket, in order of doc and place."""
        name, path = f"occurrences_{uuid.uuid4().hex}", fresh_dir(self.spark, "occurrences")
        self.paths[name] = path
        rows = rows if dealt else rows.repartition(self.buckets, "doc").sortWithinPartitions("doc", "place")
        rows.write.options(path=path, **DIFFERENCES).bucketBy(self.buckets, "doc").saveAsTable(name)
        return name

    def read(self, name: str, by: str) -> DataFrame:
        """The table, known to be sorted by `doc` and `by`."""
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.spark.table(name).schema)
        path = self.paths[name].replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name}_{by} ({columns}) USING parquet "
            f"CLUSTERED BY (doc) SORTED BY (doc, {by}) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        return self.spark.table(f"{name}_{by}")

    def drop(self, name: str) -> None:
        for own in (name, f"{name}_place", f"{name}_after"):
            self.spark.sql(f"DROP TABLE IF EXISTS {own}")
        drop_dir(self.spark, self.paths.pop(name))

    def drop_all(self) -> None:
        for name in list(self.paths):
            self.drop(name)


def _tokens(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(docs["lang"], F.lit("und")).alias("lang")
    return docs.select(lang, text_of(docs).alias("text"))


def _found(text: str):
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, token, word, f): every spelling of every word with its number of occurrences, written."""
    tokens = _tokens(docs).select("lang", F.explode(_found("text")).alias("token"))
    counts = tokens.groupBy("lang", "token").agg(F.count(F.lit(1)).alias("f"))
    return written(
        counts.where(~F.col("token").rlike(f"^[{ENDS}]")).withColumn("word", F.translate("token", UPPER, UPPER.lower())),
        "words",
    )


def _key():
    return F.xxhash64("lang", "token").alias("key")


def _numbered(phrases: DataFrame) -> DataFrame:
    """The phrases with `id`, an int from 0 on: after the rows of the parts before."""
    made = written(phrases.withColumn("id", F.monotonically_increasing_id()), "parts")
    part, within = F.call_function("shiftright", "id", F.lit(33)), F.col("id").bitwiseAND(F.lit(2**33 - 1))
    starts, start = [], 0
    for p, n in sorted(made.groupBy(part.alias("part")).count().collect()):
        starts.append((p, start))
        start += n
    parts = F.broadcast(made.sparkSession.createDataFrame(starts, "part long, start long"))
    numbered = made.join(parts, part == F.col("part")).withColumn("id", (F.col("start") + within).cast("int"))
    out = written(numbered.select(phrases.columns + ["id"]), "phrases")
    discard(made)
    return out


def _pair(left: str, right: str):
    return F.call_function("shiftleft", F.col(left).cast("long"), F.lit(32)).bitwiseOR(F.col(right).cast("long")).alias("pair")


def frequent_words(words: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, last, f, heads, tails, id) of the frequent words; left and right are null."""
    nothing = F.lit(None).cast("int")
    counts = words.groupBy("lang", "word").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return _numbered(
        counts.select(
            "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("heads"),
            F.array("f").alias("tails"), nothing.alias("left"), nothing.alias("right"),
        )
    )


def longer(pairs: DataFrame, shorter: DataFrame, least: int) -> DataFrame:
    """The frequent phrases of k + 1 words among the pairs of phrases of k words."""
    counts = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= least)
    left, right = F.call_function("shiftright", "pair", F.lit(32)), F.col("pair").bitwiseAND(F.lit(2**32 - 1))
    counts = counts.select(left.cast("int").alias("left"), right.cast("int").alias("right"), "f")
    first = shorter.select(F.col("id").alias("left"), "lang", "phrase", "heads")
    rest = shorter.select(F.col("id").alias("right"), "last", "tails")
    return _numbered(
        counts.join(first, "left").join(rest, "right").select(
            "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f",
            F.concat("heads", F.array("f")).alias("heads"), F.concat("tails", F.array("f")).alias("tails"), "left", "right",
        )
    )


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n), and the frequent phrases of 1, 2, ... words: lang, phrase, f, heads, tails, left, right, id.

    heads[i - 1] is how often the phrase's first i words occur, tails[i - 1] its last i; left and right are the
    ids of the phrases of one word less in it.
    """
    spark = docs.sparkSession
    with shuffle_sized_for(docs, INPUT_BYTES) as buckets, _settings(spark, AS_IT_LIES):
        relations = Relations(spark, buckets)
        try:
            words = word_counts(docs)
            totals = written(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
            found = [frequent_words(words, least)]
            known = found[0].select("lang", F.col("phrase").alias("word"), "id")
            spelled = written(words.join(known, ["lang", "word"]).select(_key(), "lang", "token", "id"), "spellings")
            n_spelled = spelled.count()
            keys = sent_whole(spelled.select("key"), n_spelled, PAIR_BYTES, BROADCAST_BYTES)
            if words.select(_key()).join(keys, "key").count() == n_spelled:
                by, n_bytes, dictionary = ["key"], PAIR_BYTES, spelled.select("key", "id")
            else:  # a frequent spelling shares its key
                by, n_bytes, dictionary = ["key", "lang", "token"], WORD_BYTES, spelled
            discard(words)
            small = sent_whole(dictionary, n_spelled, n_bytes, BROADCAST_BYTES)
            rows = _tokens(docs).withColumn("doc", F.monotonically_increasing_id())
            rows = rows.repartition(buckets, "doc").sortWithinPartitions("doc")
            rows = rows.select("doc", "lang", F.posexplode(_found("text")).alias("place", "token"))
            rows = rows.select("doc", "place", _key(), *by[1:]).join(small, by)
            after = (F.col("place") + 1).alias("after")
            now = relations.write(rows.select("doc", "place", after, "id"), small is not dictionary)
            for _ in range(longest - 1):
                pairs = relations.write(
                    relations.read(now, "after").select("doc", "after", "place", F.col("id").alias("left"))
                    .join(
                        relations.read(now, "place").select("doc", F.col("place").alias("after"), F.col("id").alias("right"))
                        .hint("merge"),
                        ["doc", "after"],
                    )
                    .select("doc", "place", "left", "right"),
                    dealt=True,
                )
                relations.drop(now)
                with _settings(spark, COUNTED):
                    found.append(longer(spark.table(pairs).select(_pair("left", "right")), found[-1], least))
                known = found[-1].select(_pair("left", "right"), "id")
                small = sent_whole(known, known.count(), PAIR_BYTES, BROADCAST_BYTES)
                kept = relations.read(pairs, "place").select("doc", "place", _pair("left", "right")).join(small, "pair")
                now = relations.write(kept.select("doc", "place", after, "id"), small is not known)
                relations.drop(pairs)
            return totals, found
        finally:
            relations.drop_all()


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of every language's best phrases.

    The score of a phrase is the lowest of its cuts, 1000 a n / (l r) rounded down in whole numbers. A phrase that
    always occurs inside a longer one is left out; as frequencies fall with length, one word more is all to look at.
    """
    totals, found = frequent_phrases(docs, least, longest)
    return ranked(totals, found, first)


def ranked(totals: DataFrame, found: list[DataFrame], first: int) -> DataFrame:
    """The best phrases among the frequent ones of 1, 2, ... words."""
    every = []
    for phrases, next_ in zip(found[1:], [*found[2:], None]):
        if next_ is not None:
            inside = next_.select(F.col("left").alias("id"), "f").union(next_.select("right", "f"))
            inside = inside.groupBy("id").agg(F.max("f").alias("within"))
            phrases = phrases.join(inside, "id", "left").where(F.col("within").isNull() | (F.col("within") < F.col("f")))
        every.append(phrases.select("lang", "phrase", "f", "heads", "tails"))
    if not every:
        every = [found[0].where("false").select("lang", "phrase", "f", "heads", "tails")]
    size = F.size("heads")
    whole = "decimal(20, 0)"

    def cut(i):
        l, r = F.element_at("heads", i), F.element_at("tails", size - i)
        score = F.call_function("div", F.col("f").cast(whole) * F.col("n").cast(whole) * 1000, l.cast(whole) * r.cast(whole))
        return F.struct(score.alias("score"), i.alias("i"), l.alias("l"), r.alias("r"))

    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        reduce(DataFrame.unionByName, every)
        .join(F.broadcast(totals) if totals.count() < 100_000 else totals, "lang")
        .withColumn("c", F.array_min(F.transform(F.sequence(F.lit(1), size - 1), cut)))
        .select("lang", "phrase", F.col("f").alias("a"), F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= first)
        .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
    )


def report(docs: DataFrame) -> DataFrame:
    return collocations(docs)


REPORT_SQL = r"""
WITH RECURSIVE p AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
f AS (
  SELECT lang, k, phrase, count(*) AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
        FROM p, range(1, 6) AS s(k))
  GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inner_ AS (
  SELECT DISTINCT c.lang, c.k, c.phrase
  FROM c JOIN (SELECT lang, k - j AS k, a, array_to_string(w[i:i + k - j - 1], ' ') AS phrase
               FROM c, range(1, 4) AS s(j), range(1, 5) AS t(i) WHERE k - j > 1 AND i <= j + 1) AS x
       ON c.lang = x.lang AND c.k = x.k AND c.phrase = x.phrase AND 100 * x.a >= 100 * c.a),
cuts AS (
  SELECT c.lang, c.phrase, c.a, h.f AS l, t.f AS r, n.n, j, (1000::HUGEINT * c.a * n.n) // (h.f::HUGEINT * t.f) AS score
  FROM c, range(1, 5) AS s(j), f AS h, f AS t, n
  WHERE j < c.k AND h.lang = c.lang AND h.k = j AND h.phrase = array_to_string(c.w[:j], ' ')
    AND t.lang = c.lang AND t.k = c.k - j AND t.phrase = array_to_string(c.w[j + 1:], ' ') AND n.lang = c.lang
    AND NOT EXISTS (SELECT 1 FROM inner_ AS i WHERE i.lang = c.lang AND i.k = c.k AND i.phrase = c.phrase)),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
