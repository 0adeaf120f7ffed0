r"""Line dedup: an exact set-similarity join of lines, in DataFrame operations only.

A line's set is its distinct words (split at ASCII blanks). A line is removed if an earlier line (by row, then
place in the text) has a Jaccard similarity of `percent` or more with it. Lines with equal sets are
one class with its first occurrence; all later lines of a class go, and the first goes if a similar class
began earlier.

Texts are split once: every line's set is written as the sorted 64-bit hashes of its words, and all that follows
reads that table. Words are told apart by their hash.

The join: words are ordered by rarity (counts over all lines in 2 ** 16 buckets of word hashes; any order
is exact, a rare first one is fast), and a class is filed under each two neighbours among its rarest words.
Two similar sets share such a pair: with a words only in x and b only in y, at most 2a + b of x's pairs of
neighbours are not y's (a word that is taken out breaks two of them, one that is put in breaks one), so the
first shared pair is among the first 2a + b + 1 of x, and likewise of y. With n words and 80 percent, 2a + b
is at most 0.4n. Pairs of rare words are shared by few classes that are not similar, so most keys have
one class only and end there, in a count. Classes under one key must fit in length and in the bits of a 64-bit
parity of the words: each word that only one set has flips one bit. What is left is verified on the whole sets.

A class needs one earlier similar class, not all. So the classes of a crowded key (more than `ENDS`) are first
compared with the key's earliest class, which settles most lines of large groups of near copies without a pair
of each two of them. Classes that this leaves open are joined with all earlier classes of their keys.

Defined cases: lines without words always stay and are not counted; null and empty texts have no lines; rows
are in order of their id, null last; rows that share an id or have none are documents of their own, in order
of their texts' md5; of rows equal in id and text one comes first, the others lose all lines with words; an
empty table gives an empty result; input columns are kept by `without_similar_lines`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import discard, sent_whole, text_of, written

PERCENT = 80
BUCKETS = 2**16
LAST = 2**63 - 1  # place of null ids
ENDS = 32  # classes of a key; with more, each is first compared with the earliest of them
WIDE = 67  # percent from which on similar sets always share neighbours among their rarest words
DICTIONARY = 8 * 1024 * 1024  # bytes of the distinct hashes of a file, which are then written once
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
KEY = ["__d", "__h"]
ID = ["d", "h", "l"]


def words(line: Column) -> Column:
    """Sorted hashes of a line's distinct words; none if it has no words."""
    other = F.lit(False)
    for blank in "\t\x0b\x0c\r":
        other = other | line.contains(blank)
    own = F.when(other, F.translate(line, "\t\x0b\x0c\r", "    ")).otherwise(line)
    hashes = F.transform(F.split(own, " "), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(F.array_remove(hashes, F.xxhash64(F.lit("")))))


def keyed(docs: DataFrame) -> DataFrame:
    """`docs` with a row's key: __d (id, null last) and __h, which tells apart rows of one __d by their text.

    __h is a byte that puts null ids after others, then the text's md5; in a table where no two rows
    share an id it is empty. Both follow from the row alone, so they are the same at every reading.
    """
    own = docs.withColumn("__d", F.coalesce("doc_id", F.lit(LAST)))
    shared = not own.groupBy("__d").count().where("count > 1").isEmpty()
    null_last = F.when(F.col("doc_id").isNull(), F.lit("01")).otherwise(F.lit("00"))
    digest = F.unhex(F.concat(null_last, F.md5(text_of(docs).cast("binary"))))
    return own.withColumn("__h", digest if shared else F.lit("").cast("binary"))


def lines_of(own: DataFrame) -> DataFrame:
    """d, h (key of the row), l (place from 0), line."""
    own = own.select(F.col("__d").alias("d"), F.col("__h").alias("h"), text_of(own).alias("text"))
    return own.select("d", "h", F.posexplode(F.split("text", "\n")).alias("l", "line"))


def sets_of(own: DataFrame) -> DataFrame:
    """u (number), d, h, l, w (sorted hashes of the distinct words), n (words), bits, k1, k2 (of the set) of the lines
    with words, written once.

    Lines are chosen by their text: a condition on `w` would split and hash every line twice.
    """
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))
    lines = lines_of(own).where(F.btrim("line", F.lit(" \t\x0b\x0c\r")) != "").select(*ID, words(F.col("line")).alias("w"))
    lines = lines.select(
        F.monotonically_increasing_id().alias("u"), *ID, "w", F.size("w").alias("n"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(bit(x))).alias("bits"),
        F.xxhash64("w").alias("k1"), F.xxhash64(F.lit(1), "w").alias("k2"),
    )
    return written(lines, "sets", **{"parquet.dictionary.page.size": DICTIONARY})


def bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def rarity(sets: DataFrame) -> list[int]:
    """For each bucket of word hashes a class of its count over all lines, a fixed number of entries.

    Classes 0 to 127 divide the logarithm between the least and the greatest count of a bucket.
    """
    counts = sets.select(F.explode("w").alias("x")).groupBy(bucket(F.col("x")).alias("bucket")).count()
    found = counts.collect()  # BUCKETS rows at most
    out = [0] * BUCKETS
    if found:
        least, most = (math.log(f(r["count"] for r in found)) for f in (min, max))
        for r in found:
            out[r["bucket"]] = int(127 * (math.log(r["count"]) - least) / max(most - least, 1e-9))
    return out


def by_rarity(w: Column, scales: list[int]) -> Column:
    """The words as numbers, the rarest first: 7 bits of the count's class, then 56 bits of the hash."""
    low, scale = F.lit(2**56 - 1), F.split(F.lit(",".join(map(str, scales))), ",").cast("array<bigint>")
    number = lambda h: F.call_function("shiftleft", F.get(scale, bucket(h)), F.lit(56)).bitwiseOR(h.bitwiseAND(low))
    return F.sort_array(F.transform(w, number))


def without(rows: DataFrame, some: DataFrame) -> DataFrame:
    """`rows` whose u is not in the written table `some`."""
    return rows.join(sent_whole(some, some.count(), 16), "u", "left_anti")


def copies_of(sets: DataFrame) -> DataFrame:
    """u of the lines that are not the first of their class (of the lines with an equal set)."""
    classes = sets.groupBy("k1", "k2").agg(F.min(F.struct(*ID, "u")).alias("first"), F.count(F.lit(1)).alias("size"))
    several = written(classes.where("size > 1").select("k1", "k2", F.col("first.u").alias("first")), "several")
    return written(sets.join(sent_whole(several, several.count(), 32), ["k1", "k2"]).where("u != first").select("u"), "copies")


def fitting(x, y, percent: int) -> Column:
    """Whether the lengths and parities of two sets allow that they are similar."""
    both = x("n") + y("n")
    needed = F.floor((both * percent + 99 + percent) / F.lit(100 + percent))
    return (F.least(x("n"), y("n")) * 100 >= F.greatest(x("n"), y("n")) * percent) & (
        F.bit_count(x("bits").bitwiseXOR(y("bits"))) <= both - 2 * needed
    )


def keys_of(classes: DataFrame, scales: list[int], percent: int) -> DataFrame:
    """u, key: each class under the pairs of words that are neighbours among its rarest ones (single words below `WIDE`)."""
    n, off = F.col("n"), 100 - percent
    rows = classes.where(F.col("u").isNotNull() & (F.floor(n * 100 / percent) > n))  # others are similar to no other set
    if percent < WIDE:
        return rows.select("u", F.explode(F.slice(by_rarity(F.col("w"), scales), F.lit(1), F.floor(n * off / 100).cast("int") + 1)).alias("key"))
    first = F.least(F.floor(n * (2 * off) / 100).cast("int") + 1, n - 1)
    rows = rows.select("u", by_rarity(F.col("w"), scales).alias("w"), first.alias("first"))
    neighbours = F.arrays_zip(F.slice("w", F.lit(1), F.col("first")).alias("a"), F.slice("w", F.lit(2), F.col("first")).alias("b"))
    return rows.select("u", F.inline(neighbours)).select("u", F.xxhash64("a", "b").alias("key"))


def members_of(classes: DataFrame, scales: list[int], percent: int) -> DataFrame:
    """key, size (classes under it), u, d, h, l, n, bits: the classes under the keys that more than one class has.

    The keys are shuffled once: counting and choosing read the same shuffle, without a sort. That needs the same
    columns and conditions on both sides, so `keys_of` says that u is not null and the count reads u.
    """
    keys = keys_of(classes, scales, percent).repartition("key")
    counts = keys.groupBy("key").agg(F.min("u").alias("least"), F.max("u").alias("most"), F.count(F.lit(1)).alias("size"))
    several = counts.where("least < most").select("key", "size")
    shared = keys.join(several.hint("shuffle_hash"), "key")
    return written(shared.join(classes.select("u", *ID, "n", "bits").hint("shuffle_hash"), "u"), "members")


def compared(members: DataFrame, percent: int) -> DataFrame:
    """x, y (numbers): each class of a crowded key with its earliest class, if that can be similar."""
    crowded = members.where(F.col("size") > ENDS)
    firsts = written(crowded.groupBy("key").agg(F.min(F.struct(*ID, "u", "n", "bits")).alias("y")), "firsts")
    found = crowded.join(sent_whole(firsts, firsts.count(), 80), "key")
    found = found.where((F.struct(*[F.col(f"y.{c}") for c in ID]) < F.struct(*ID)) & fitting(F.col, lambda c: F.col(f"y.{c}"), percent))
    return found.select(F.col("u").alias("x"), F.col("y.u").alias("y")).distinct()


def sharing(members: DataFrame, gone: DataFrame, percent: int) -> DataFrame:
    """x, y (numbers): classes that are not gone with the earlier classes that share keys and can be similar.

    Under a crowded key what is gone is left out before the join. Under the others both sides are the same rows,
    which are shuffled once, and it is left out after the join.
    """

    def joined(x, y):
        x, y = (rows.select("key", *[F.col(c).alias(f"{name}_{c}") for c in ("u", *ID, "n", "bits")]) for rows, name in ((x, "x"), (y, "y")))
        id_x, id_y = (F.struct(*[F.col(f"{name}_{c}").alias(c) for c in ID]) for name in "xy")
        fits = fitting(lambda c: F.col(f"x_{c}"), lambda c: F.col(f"y_{c}"), percent)
        return x.join(y, "key").where((id_y < id_x) & fits).select(F.col("x_u").alias("u"), F.col("y_u").alias("y"))

    crowded, others = (members.where(size) for size in (F.col("size") > ENDS, F.col("size") <= ENDS))
    found = without(joined(others, others), gone).unionByName(joined(without(crowded, gone), crowded))
    return found.withColumnRenamed("u", "x").distinct()


def sides_of(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, w of every line that is a side of the pairs."""
    sides = written(pairs.select(F.explode(F.array("x", "y")).alias("u")).distinct(), "sides")
    return written(sets.select("u", "w").join(sent_whole(sides, sides.count(), 16), "u", "left_semi"), "sides", **{"parquet.dictionary.page.size": DICTIONARY})


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """u: the distinct x of the pairs that are similar."""
    common = F.size(F.array_intersect("xw", "yw"))
    return (
        pairs.join(sets.select(F.col("u").alias("x"), F.col("w").alias("xw")), "x")
        .join(sets.select(F.col("u").alias("y"), F.col("w").alias("yw")), "y")
        .where(common * 100 >= (F.size("xw") + F.size("yw") - common) * percent)
        .select(F.col("x").alias("u"))
        .distinct()
    )


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def kept_classes(own: DataFrame, percent: int = PERCENT) -> DataFrame:
    """First occurrences (d, h, l) of the classes that stay, of a table with keys."""
    with shuffles_removed(own.sparkSession):
        sets, gone = compared_sets(own, percent)
    return without(sets.select("u", *ID), gone).select(*ID)


def compared_sets(own: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The written sets of the lines, and u of those that don't stay."""
    sets = sets_of(own)
    copies = copies_of(sets)
    members = members_of(without(sets, copies), rarity(sets), percent)
    near = written(compared(members, percent), "near")
    gone = written(verified(near, sides_of(near, sets), percent), "gone")
    shared = written(sharing(members, gone, percent), "shared")
    discard(members)
    gone = gone.unionByName(verified(shared, sides_of(shared, sets), percent))
    return sets, written(copies.unionByName(gone), "gone")


def kept_of(own: DataFrame, percent: int = PERCENT) -> DataFrame:
    return kept_classes(own, percent).groupBy("d", "h").agg(F.sort_array(F.collect_list("l")).alias("kept"))


def kept_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """d, h (key of the row), kept: ascending places of the lines with words that stay."""
    return kept_of(keyed(docs), percent)


def with_kept(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows with keys and their `__kept`, empty where nothing stays; the keys go.

    Of rows that are equal in key one gets the places. Only such rows are written, with a number
    that is then fixed.
    """
    again = written(rows.groupBy(*KEY).count().where("count > 1").select(*KEY), "again")
    n_again = again.count()
    none = F.array().cast("array<int>")
    later = None
    if n_again:
        few = sent_whole(again, n_again, 32)
        repeats = written(rows.join(few, KEY, "left_semi").withColumn("__u", F.monotonically_increasing_id()), "repeats")
        firsts = repeats.groupBy(*KEY).agg(F.min("__u").alias("__u"))
        later = repeats.join(firsts, [*KEY, "__u"], "left_anti").drop("__u").withColumn("__kept", none)
        rows = rows.join(few, KEY, "left_anti").unionByName(repeats.join(firsts, [*KEY, "__u"], "left_semi").drop("__u"))
    kept = kept.withColumnsRenamed({"d": "__d", "h": "__h", "kept": "__kept"})
    found = rows.join(kept, KEY, "left").withColumn("__kept", F.coalesce("__kept", none))
    return (found.unionByName(later) if later is not None else found).drop(*KEY)


def without_similar_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`docs` with the removed lines taken out of the texts; null texts stay null."""
    names = {c: c if c in ("doc_id", "text") else f"column_{i}" for i, c in enumerate(docs.columns)}
    own = keyed(docs.toDF(*names.values()))
    stays = F.filter(
        F.split("text", "\n"),
        lambda line, n: ~line.rlike(r"[^\x20\x09-\x0D]") | F.array_contains("__kept", n),
    )
    found = with_kept(own, kept_of(own, percent)).withColumn("text", F.array_join(stays, "\n"))
    return found.select(*names.values()).toDF(*names)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines (with words), n_removed, kept_sha256 (places that stay, comma-joined)."""
    own = keyed(docs)
    n = F.size(F.filter(F.split(text_of(own), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long")
    return with_kept(own.select("doc_id", n.alias("n_lines"), *KEY), kept_of(own)).select(
        "doc_id", "n_lines", (F.col("n_lines") - F.size("__kept")).cast("long").alias("n_removed"),
        F.sha2(F.array_join(F.col("__kept").cast("array<string>"), ",").cast("binary"), 256).alias("kept_sha256"),
    )


REPORT_SQL = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS l, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS w
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
s AS (SELECT * FROM l WHERE len(w) > 0),
c AS (SELECT row_number() OVER (ORDER BY spot) AS c, w, len(w) AS n, spot FROM (SELECT w, min({'d': doc_id, 'l': l}) AS spot FROM s GROUP BY w)),
t AS (SELECT c, n, unnest(w) AS word FROM c),
f AS (SELECT word, count(*) AS f FROM t GROUP BY word),
p AS (SELECT c, n, word FROM t JOIN f USING (word)
      QUALIFY row_number() OVER (PARTITION BY c ORDER BY f, word) <= n - (4 * n + 4) // 5 + 1),
j AS (SELECT DISTINCT x.c AS x, y.c AS y FROM p AS x JOIN p AS y ON x.word = y.word AND y.c < x.c AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)),
o AS (SELECT j.x, j.y, len(list_intersect(a.w, b.w)) AS o, a.n + b.n AS n FROM j JOIN c AS a ON a.c = j.x JOIN c AS b ON b.c = j.y),
k AS (SELECT spot.d AS doc_id, spot.l AS l FROM c WHERE c NOT IN (SELECT x FROM o WHERE 5 * o >= 4 * (n - o))),
g AS (SELECT doc_id, count(*) AS n_kept, string_agg(l::VARCHAR, ',' ORDER BY l) AS kept FROM k GROUP BY doc_id),
m AS (SELECT doc_id, count(*) FILTER (WHERE len(w) > 0) AS n_lines FROM l GROUP BY doc_id)
SELECT doc_id, n_lines, n_lines - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM m LEFT JOIN g USING (doc_id)
"""
