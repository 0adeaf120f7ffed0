"""Sharding by extendible hashing.

The directory is a binary tree over the leading bits of a document's hash (md5 of its id). A node that
exceeds the byte limit is split on the next bit; nodes that fit are shards. A document larger than the
limit is a shard alone.

How it is found: bytes per hash prefix of some bits more than the shards need (one aggregation, a
few dozen prefixes for each shard), summed up for all shorter prefixes; a document's shard is its
shortest prefix that fits. Prefixes that are still too large get further bits in a further round, for
their documents only. Rows whose hashes agree in all bits (repeats of one id) are dealt on by 64 bits
that each row is given once, when the rows are written, in as many rounds as it takes: these bits differ
between any two rows.

Defined cases: null ids hash as the text `null`; a null text has 0 bytes; an empty table has no
shards; repeated rows are documents of their own. Shard `` (no bits) is the whole table. Columns of
the input keep their names; those that this module adds win over input columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import text_of, written

LIMIT_BYTES = 64 * 1024 * 1024
BITS = 60
OWN_BITS = 64  # bits that tell apart rows of one id
SPARE_BITS = 4  # a shard is made of 2 ** SPARE_BITS measured prefixes or more, on average


def hash_bits(doc_id: Column) -> Column:
    """The first 60 bits of the md5 of the id as text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def prefix(bits: Column, n: Column) -> Column:
    return F.call_function("shiftright", bits, (F.lit(BITS) - n).cast("int"))


def bit_text(prefix_: Column, n: Column) -> Column:
    return F.call_function("lpad", F.bin(prefix_), n.cast("int"), F.lit("0"))


def leaves(keys: DataFrame, start: int, depth: int, limit: int) -> DataFrame:
    """For every prefix of `depth` bits: `leaf`, the bits of the shortest prefix, of `start` bits or
    more, that fits; null if none does. Also the shard's bytes and rows."""
    fine = keys.groupBy(prefix(F.col("bits"), F.lit(depth)).alias("fine")).agg(
        F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    fine = written(fine, "shard-sizes")
    level = F.explode(F.sequence(F.lit(start), F.lit(depth)))
    up = fine.withColumn("leaf", level).withColumn("node", F.call_function("shiftright", F.col("fine"), (F.lit(depth) - F.col("leaf")).cast("int")))
    nodes = up.groupBy("leaf", "node").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
    fits = nodes.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
    found = (
        up.select("fine", "leaf", "node")
        .join(fits, ["leaf", "node"])
        .groupBy("fine")
        .agg(F.min(F.struct("leaf", "shard_bytes", "shard_rows")).alias("found"))
    )
    return fine.select("fine").join(found, "fine", "left").select("fine", "found.*")


ADDED = ["n_bytes", "shard", "depth", "shard_bytes", "shard_rows"]


def with_shards(docs: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """`docs` with n_bytes (UTF-8), shard (bits as text), depth, shard_bytes, shard_rows."""
    kept = [c for c in docs.columns if c not in ADDED]
    names = {c: c if c in ("doc_id", "text") else f"column_{i}" for i, c in enumerate(kept)}
    out = _with_shards(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), limit_bytes)
    return out.select(*names.values(), *ADDED).toDF(*names, *ADDED)


def _with_shards(rest: DataFrame, limit_bytes: int) -> DataFrame:
    keyed = rest.withColumn("n_bytes", F.octet_length(text_of(rest)).cast("long")).withColumn("__bits", hash_bits(F.col("doc_id")))
    keys = written(
        keyed.select(F.col("__bits").alias("bits"), "n_bytes"),
        "shard-keys",
    )
    total = keys.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit_bytes)))) + SPARE_BITS)
    start, rounds = 0, []
    while True:
        found = written(leaves(keys, start, depth, limit_bytes), "shard-leaves")
        rounds.append((depth, found.where("leaf is not null")))
        left = found.where("leaf is null").select("fine")
        if left.isEmpty():
            break
        if depth == BITS:
            return _dealt(keyed, rounds, left, limit_bytes)
        keys = written(keys.withColumn("fine", prefix(F.col("bits"), F.lit(depth))).join(left, "fine", "left_semi").drop("fine"), "shard-keys")
        start, depth = depth + 1, min(BITS, depth + 2 * SPARE_BITS)
    return _placed(keyed, rounds).drop("__bits")


def _placed(keyed: DataFrame, rounds: list[tuple[int, DataFrame]]) -> DataFrame:
    """Every row with the shard that one of the rounds found; null where none did."""
    out = keyed
    for k, (depth, found) in enumerate(rounds):
        named = found.select(*[F.col(c).alias(f"__{c}{k}") for c in ("fine", "leaf", "shard_bytes", "shard_rows")])
        out = out.join(named, prefix(F.col("__bits"), F.lit(depth)) == F.col(f"__fine{k}"), "left")
    n = range(len(rounds))
    leaf = F.coalesce(*[F.col(f"__leaf{k}") for k in n])
    return (
        out.withColumn("shard", F.when(leaf.isNotNull(), bit_text(prefix(F.col("__bits"), leaf), leaf)))
        .withColumn("depth", leaf)
        .withColumn("shard_bytes", F.coalesce(*[F.col(f"__shard_bytes{k}") for k in n]))
        .withColumn("shard_rows", F.coalesce(*[F.col(f"__shard_rows{k}") for k in n]))
        .drop(*[f"__{c}{k}" for k in n for c in ("fine", "leaf", "shard_bytes", "shard_rows")])
    )


def _dealt(keyed: DataFrame, rounds: list, left: DataFrame, limit: int) -> DataFrame:
    """Also places rows that agree in all bits: rows of one id go on with bits of their own.

    The whole table is written once with its places, so the bits of a row cannot change.
    """
    rows = written(_placed(keyed, rounds).withColumn("__own", F.xxhash64(F.monotonically_increasing_id())), "shard-rows")
    open_ = rows.where("shard is null").withColumn("__id", bit_text(F.col("__bits"), F.lit(BITS)))
    sizes = written(open_.select("__id", "__own", "n_bytes"), "shard-repeats")
    # several levels at once: rows of a repeated id only, each with its own path of bits
    most = sizes.groupBy("__id").agg(F.sum("n_bytes").alias("b")).agg(F.max("b")).first()[0]
    start, depth = 1, min(OWN_BITS, math.ceil(math.log2(max(2, most / limit))) + 2 * SPARE_BITS)
    out = rows.where("shard is not null")
    while True:
        found = written(_own_leaves(sizes, start, depth, limit), "shard-leaves")
        out = out.unionByName(_on_own_bits(open_, found.where("leaf is not null"), depth))
        crowded = found.where("leaf is null").select("__id", "fine")
        if crowded.isEmpty():
            return out.drop("__bits", "__own")
        sizes = sizes.withColumn("fine", own_prefix(F.lit(depth))).join(crowded, ["__id", "fine"], "left_semi").drop("fine")
        sizes = written(sizes, "shard-repeats")
        start, depth = depth + 1, min(OWN_BITS, depth + 2 * SPARE_BITS)


def own_prefix(n: Column) -> Column:
    """The first `n` (1 to 64) of the bits that a row has of its own."""
    return F.call_function("shiftrightunsigned", F.col("__own"), (F.lit(OWN_BITS) - n).cast("int"))


def _own_leaves(sizes: DataFrame, start: int, depth: int, limit: int) -> DataFrame:
    """As `leaves`, for every id and every prefix of `depth` of its rows' own bits.

    Own bits are a bijection of distinct numbers, so at full depth every row is alone and fits.
    """
    fine = sizes.groupBy("__id", own_prefix(F.lit(depth)).alias("fine")).agg(F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("r"))
    fine = written(fine, "shard-sizes")
    up = fine.withColumn("leaf", F.explode(F.sequence(F.lit(start), F.lit(depth)))).withColumn(
        "node", F.call_function("shiftrightunsigned", F.col("fine"), (F.lit(depth) - F.col("leaf")).cast("int"))
    )
    nodes = up.groupBy("__id", "leaf", "node").agg(F.sum("b").alias("sb"), F.sum("r").alias("sr"))
    fits = nodes.where((F.col("sb") <= limit) | (F.col("sr") == 1))
    found = up.join(fits, ["__id", "leaf", "node"]).groupBy("__id", "fine").agg(F.min(F.struct("leaf", "sb", "sr")).alias("f"))
    return fine.select("__id", "fine").join(found, ["__id", "fine"], "left").select("__id", "fine", "f.*")


def _on_own_bits(open_: DataFrame, found: DataFrame, depth: int) -> DataFrame:
    """The rows whose shard lies among `found`, placed in it."""
    named = found.select("__id", *[F.col(c).alias(f"__{c}") for c in ("fine", "leaf", "sb", "sr")])
    leaf = F.col("__leaf")
    return (
        open_.withColumn("__fine", own_prefix(F.lit(depth)))
        .join(named, ["__id", "__fine"])
        .withColumn("shard", F.concat("__id", bit_text(own_prefix(leaf), leaf)))
        .withColumn("depth", F.lit(BITS) + leaf)
        .withColumn("shard_bytes", F.col("__sb"))
        .withColumn("shard_rows", F.col("__sr"))
        .drop("__id", "__fine", "__leaf", "__sb", "__sr")
    )


def write_shards(docs: DataFrame, path: str, limit_bytes: int = LIMIT_BYTES) -> None:
    """Write the documents as Parquet, a folder for each shard (`shard=b<bits>`).

    A shard goes to one task, as it is at most `limit_bytes` of text (or one document).
    """
    shards = with_shards(docs, limit_bytes).withColumn("shard", F.concat(F.lit("b"), "shard"))
    shards.repartition("shard").write.partitionBy("shard").parquet(path)


def report(docs: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    return with_shards(docs.select("doc_id", "text"), limit_bytes).select(
        "doc_id", "n_bytes", "shard", F.col("depth").cast("long").alias("depth"), "shard_bytes", "shard_rows"
    )


REPORT_SQL = f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS bits FROM documents),
a AS (SELECT d.*, k.depth::BIGINT AS depth, bits >> (60 - k.depth)::INT AS node FROM d, range(0, 61) AS k(depth)),
n AS (SELECT *, sum(n_bytes) OVER (PARTITION BY depth, node)::BIGINT AS shard_bytes,
             count(*) OVER (PARTITION BY depth, node) AS shard_rows FROM a)
SELECT doc_id, n_bytes, lpad(bin(node), depth::INT, '0') AS shard, depth, shard_bytes, shard_rows
FROM n WHERE shard_bytes <= {LIMIT_BYTES} OR shard_rows = 1
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""
