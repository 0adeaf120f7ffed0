"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source serves its documents in a shuffled order (md5 of the seed and the row's source, id, text and
number among equal rows), again from the start for a second epoch, at a rate proportional to its target. A document longer than `piece_words` is served in
pieces. A piece has a virtual finish time, the words its source has served by then divided by the
source's target; all pieces of all sources are sorted by finish time and cut where the words reach the
budget. So every source ends within about one piece of its target, whatever its size.

How it stays distributed: only ids and sizes travel. A running sum over a source is a sum within
buckets of the shuffled order plus the sums of the buckets before; a source with n rows has about
sqrt(n) buckets of sqrt(n) rows, so a source with a third of all rows is many small groups, also where rows
share an id, have none, or are copies. The global
sort works alike over ranges of finish time, which hold about equally many words by construction.

Defined cases: a null text has size 0; a document without words is never taken; null is a source of
its own, last in order; repeated rows are documents of their own; an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattline.llm.common import numbered, text_of, word_count, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # words of the mix, as a multiple of all words
MOST = 2  # no document, and no source, is taken more often than this
PIECE_WORDS = 1000

UP_TO_HERE = (W.unboundedPreceding, W.currentRow)
BEFORE = (W.unboundedPreceding, -1)


def before(column: str, window) -> Column:
    """Sum of what precedes the row."""
    return F.coalesce(F.sum(column).over(window.rowsBetween(*BEFORE)), F.lit(0))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: rank, source, source_size, n_rows, target.

    In order of the source's cap per weight, a source is capped if its share of what the capped ones
    before it leave exceeds its cap; from the first that is not, none is. That is the fixed point of
    resharing the excess. The windows hold one row per source.
    """
    by_cap = W.orderBy((F.col("cap") / F.col("weight")).asc(), "rank")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
        .withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * most)
    )
    everything = W.partitionBy()
    return (
        sources.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("left", F.col("budget") - before("cap", by_cap))
        .withColumn("weights_left", F.sum("weight").over(everything) - before("weight", by_cap))
        .withColumn("rate", F.col("left") / F.col("weights_left"))
        .withColumn("capped", F.col("cap") < F.col("weight") * F.col("rate"))
        # the rate of the first source that isn't capped holds for all that follow
        .withColumn("rate", F.first(F.when(~F.col("capped"), F.col("rate")), ignorenulls=True).over(by_cap.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        .withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("rate")))
        .select("rank", "source", "source_size", "n_rows", "target")
    )


def row_key(source: Column, doc_id: Column, text: Column) -> Column:
    """One key for rows of equal source, id and text."""
    return F.md5(
        F.concat(
            F.coalesce(F.md5(source.cast("binary")), F.lit("null")), F.lit(":"),
            F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"),
            F.md5(text.cast("binary")),
        ).cast("binary")
    )


def document_sizes(docs: DataFrame) -> DataFrame:
    text = text_of(docs)
    return docs.select("doc_id", "source", word_count(text).alias("size"), row_key(docs["source"], docs["doc_id"], text).alias("key"))


def bucketed(hex_digest: Column, n: Column) -> Column:
    """Which of `n` equal ranges of the digest's first 32 bits."""
    return F.floor(F.conv(F.substring(hex_digest, 1, 8), 16, 10).cast("long") * n / F.lit(2**32))


def in_source_order(sizes: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Every document with the words that its source serves before it in one epoch."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), "key", F.col("nth").cast("string")).cast("binary"))
    placed = (
        sizes.alias("d")
        .join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("digest", digest)
        .withColumn("bucket", bucketed(F.col("digest"), F.ceil(F.sqrt("n_rows"))))
    )
    buckets = placed.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    buckets = buckets.select("rank", "bucket", before("words", W.partitionBy("rank").orderBy("bucket")).alias("earlier"))
    order = W.partitionBy("rank", "bucket").orderBy("digest")
    return (
        placed.withColumn("within", before("size", order))
        .join(buckets, ["rank", "bucket"])
        .withColumn("served", F.col("earlier") + F.col("within"))
    )


def schedule(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    piece_words: int = PIECE_WORDS,
    seed: int = 0,
) -> DataFrame:
    """The pieces in the order of the mix: doc_id, source, size, source_size, target, epoch, first_word,
    words, finish, position (words of the mix before the piece), taken (words of it that the mix takes).

    Documents without words have one row with null epoch. `key` and `nth`, its
    number among the rows of that key, name the input row.
    """
    sizes = written(numbered(written(document_sizes(docs), "mix-sizes"), "key", "nth"), "mix-rows")
    sources = written(source_targets(sizes, weights, share, most), "mix-sources")
    ordered = in_source_order(sizes, sources, seed)
    pieces = F.ceil(F.col("size") / piece_words)
    cut = (
        ordered.withColumn("number", F.explode_outer(F.when(F.col("size") > 0, F.sequence(F.lit(0), pieces * most - 1))))
        .withColumn("epoch", F.floor(F.col("number") / pieces))
        .withColumn("first_word", (F.col("number") % pieces) * piece_words)
        .withColumn("words", F.when(F.col("epoch").isNotNull(), F.least(F.lit(piece_words), F.col("size") - F.col("first_word"))))
        .withColumn(
            "finish",
            (F.col("epoch") * F.col("source_size") + F.col("served") + F.col("first_word") + F.col("words"))
            / F.when(F.col("target") > 0, F.col("target")),
        )
        .select(
            "rank", "key", "nth", "digest", "doc_id", "source", "size", "source_size", "target",
            "epoch", "first_word", "words", "finish",
        )
    )
    cut = written(cut, "mix-pieces")
    ranges = F.lit(max(1, int(cut.count() ** 0.5)))
    cut = cut.withColumn("range", F.floor(F.col("finish") * ranges))
    sums = cut.where("words is not null").groupBy("range").agg(F.sum("words").alias("total"))
    sums = sums.select("range", before("total", W.orderBy("range")).alias("earlier"))  # about sqrt(pieces) rows
    # pieces that are never served would make one group: they are spread by their document's digest
    spread = F.when(F.col("range").isNull(), F.col("digest"))
    order = W.partitionBy("range", spread).orderBy("finish", "rank", "digest", "epoch", "first_word")
    budget = sources.agg(F.floor(F.sum("source_size") * F.lit(float(share)))).first()[0] or 0
    position = F.col("earlier") + F.col("within")
    return (
        cut.withColumn("within", before("words", order))
        .join(sums, "range", "left")
        .withColumn("position", position)
        .withColumn("taken", F.coalesce(F.least(F.col("words"), F.greatest(F.lit(budget) - F.col("position"), F.lit(0))), F.lit(0)))
        .drop("range", "within", "earlier", "digest")
    )


def taken_rows(docs: DataFrame, **settings) -> DataFrame:
    """`mix` with the key and number of the row."""
    return (
        schedule(docs, **settings)
        .groupBy("key", "nth")
        .agg(
            *[F.first(c).alias(c) for c in ("doc_id", "source", "size", "source_size", "target")],
            F.sum("taken").cast("long").alias("taken"),
        )
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (repeats counted)."""
    return taken_rows(docs, **settings).drop("key", "nth")


def report(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, a document as often as its taken words are nearest to whole copies.

    Of rows equal in source, id and text, which one gets which number of copies is open; the result has
    the input's columns and rows only. A null id is an id.
    """
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    copies = taken_rows(docs, **settings).where("taken > 0").select("key", "nth", times.alias("times")).where("times > 0")
    copies = copies.withColumnsRenamed({c: f"__{c}" for c in copies.columns})
    named = {c: f"__{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in named.items()])
    text = F.coalesce(F.col(named["text"]), F.lit(""))
    own = own.withColumn("__key", row_key(F.col(named["source"]), F.col(named["doc_id"]), text))
    return (
        numbered(own, "__key", "__nth")
        .join(copies, ["__key", "__nth"])
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
        .select(*[F.col(n).alias(c) for c, n in named.items()])
    )


REPORT_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('0:' || md5(coalesce(md5(source), 'null') || ':' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, '')))
             || ':' || (row_number() OVER (PARTITION BY source, doc_id, coalesce(text, '')) - 1)) AS digest
  FROM documents),
s0 AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
s1 AS (
  SELECT *, [3, 1, 2][rank % 3 + 1] AS weight, (SELECT sum(source_size)::DOUBLE * 1.5 FROM s0) AS budget FROM s0),
fill AS (  -- deal by weight, cap what is above, deal again
  SELECT 0 AS step, rank, source_size, weight, budget, false AS capped,
         budget / (SELECT sum(weight) FROM s1) AS rate FROM s1
  UNION ALL
  SELECT step + 1, rank, source_size, weight, budget, now,
         (budget - coalesce(sum(2 * source_size) FILTER (WHERE now) OVER (), 0)) / nullif(sum(weight) FILTER (WHERE NOT now) OVER (), 0)
  FROM (SELECT *, capped OR weight * rate > 2 * source_size AS now,
               bool_or(NOT capped AND weight * rate > 2 * source_size) OVER () AS changed FROM fill) WHERE changed),
t AS (
  SELECT rank, CASE WHEN capped THEN (2 * source_size)::DOUBLE ELSE weight * rate END AS target
  FROM fill WHERE step = (SELECT max(step) FROM fill)),
s AS (SELECT s1.source, s1.rank, s1.source_size, t.target FROM s1 JOIN t USING (rank)),
o AS (
  SELECT d.*, s.rank, s.source_size, s.target,
         sum(d.size) OVER (PARTITION BY s.rank ORDER BY d.digest ROWS UNBOUNDED PRECEDING) - d.size AS served
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
p AS (
  SELECT o.*, e.epoch, k.piece * 1000 AS first_word, least(1000, o.size - k.piece * 1000) AS words
  FROM o, range(0, 2) AS e(epoch), LATERAL (SELECT unnest(range(0, (o.size + 999) // 1000)) AS piece) AS k),
q AS (
  SELECT *, ((epoch * source_size + served + first_word + words)::DOUBLE) / target AS finish FROM p WHERE target > 0),
r AS (
  SELECT *, sum(words) OVER (ORDER BY finish, rank, digest, epoch, first_word ROWS UNBOUNDED PRECEDING) - words AS position FROM q),
z AS (
  SELECT rank, digest, sum(greatest(0, least(words, (SELECT floor(sum(source_size) * 1.5) FROM s0) - position)))::BIGINT AS taken
  FROM r GROUP BY rank, digest)
SELECT o.doc_id, o.size, o.source_size, o.target, coalesce(z.taken, 0) AS taken FROM o LEFT JOIN z ON o.rank = z.rank AND o.digest = z.digest
"""
