"""Near duplicates by MinHash and an LSH forest.

A document's set is its distinct shingles of consecutive words (lower-cased A-Z, split at ASCII blanks).
Documents with equal sets are one class. Each class has a MinHash signature, and each tree of the
forest has its own stretch of `REACH` values of it. A tree is a sorted order: its stretches are sorted
over all tasks, so the classes that share the longest prefix with a class stand next to it. Neighbours with
at least `DEPTH` values in common form a region. Each region is cut into blocks of a depth of its own: as a
whole where it is small, else at the shortest common prefixes between neighbours, deeper and deeper, until a
block fits in a task. Members of a block are candidates of each other.

The first orders, and every order's crowded regions, are compared that way. Then every region of any
order whose members hang together with different components is looked at again: all its pairs of different
components are covered, at any size of the region (a crowded one is dealt to blocks that together have all of
them), unless an earlier tree has them too. So depth decides what is compared first, and loses nothing. The
price is work that grows with the square of a large region's members that hang together with none.

Candidates whose lengths and signatures leave a link possible are confirmed on the full sets, best
estimates first, and only where they would join two components: a task returns the components of its
region, not pairs. Members of one component are not compared again, so of a large group of near copies
mostly the few that hang together with none are compared with the rest.

How whole is it: the number of trees is the least for which a pair exactly at the threshold shares no
region with a probability of `MISS` at most, and the estimate rejects such a pair with about the same.
Sets too small to be near anything but themselves need no forest.

Defined cases: null and empty texts have empty sets and are linked with nothing; a text with fewer words
than a shingle has its whole sequence as the one shingle; repeated rows are linked; a null doc_id takes
part but is never the smallest (a component of null ids only has a null component_id); columns of the
input are kept by `near_unique`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import discard, sent_whole, text_of, written
from wattline.llm.components import components

DEPTH, REACH = 3, 8  # values of a tree that a region shares, and that a tree has
MISS = 1e-6
FIRST_TREES = 4  # orders whose regions are all compared before the others
ORDER_ROWS = 250_000  # rows of an order that a task sorts
FRAME_ROWS = 20_000
MOST_MEMBERS, MOST_SHINGLES = 4096, 4_000_000  # of one block
WORDS, PERCENT = 5, 80

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.random.default_rng(20).integers(0, 2**63, 64, dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Forest:
    words: int = WORDS
    percent: int = PERCENT
    miss: float = MISS

    @property
    def trees(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** DEPTH))

    @property
    def values(self) -> int:
        return self.trees * REACH

    @property
    def least_set(self) -> int:
        """Smallest set that can be near a different one: near itself and one shingle more."""
        return math.ceil(self.percent / (100 - self.percent)) if self.percent < 100 else 2**31

    @property
    def least_equal(self) -> int:
        """Equal signature values below which a link is given up: five deviations under the threshold."""
        t = self.percent / 100
        return math.floor(self.values * t - 5 * math.sqrt(self.values * t * (1 - t)))


def shingles(text: str, words: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of the whole text."""
    own = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not own:
        return np.zeros(0, np.uint64)
    if len(own) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(own), seed=len(own))], np.uint64)
    if len(known) > 1_000_000:
        known.clear()
    hashes = []
    for w in own:
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh64_intdigest(w)
        hashes.append(h)
    h = np.array(hashes, np.uint64)
    n = len(h) - words + 1
    out = np.zeros(n, np.uint64)
    for k in range(words):
        part = (h[k : k + n] ^ (out >> np.uint64(29))) * _MIX[k]
        out = (out ^ part) * _MIX[32 + k]
        out ^= out >> np.uint64(32)
    return np.unique(out)


class Signer:
    def __init__(self, values: int):
        rng = np.random.default_rng(7)
        self.a = (rng.integers(0, 2**32, values, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
        self.b = rng.integers(0, 2**32, values, dtype=np.uint64).astype(np.uint32)

    def __call__(self, own: np.ndarray) -> np.ndarray:
        """The least value of each hash function over a set."""
        least = np.full(len(self.a), 2**32 - 1, np.uint32)
        x = (own >> np.uint64(32)).astype(np.uint32)
        for begin in range(0, len(x), 8192):
            v = x[begin : begin + 8192, None] * self.a + self.b
            v ^= v >> np.uint32(15)
            v *= np.uint32(0x2C1B3C6D)
            v ^= v >> np.uint32(12)
            np.minimum(least, v.min(axis=0), out=least)
        return least


def summaries(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, text_hash, key (of the set, null if empty), n_shingles, signature (null for small sets)."""

    @F.pandas_udf("struct<key: binary, n: long, signature: binary>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        sign = Signer(forest.values)
        for texts in batches:
            rows = []
            for text in texts:
                own = shingles(text, forest.words, known)
                key = xxhash.xxh128_digest(own.tobytes()) if len(own) else None
                rows.append((key, len(own), sign(own).astype(">u4").tobytes() if len(own) >= forest.least_set else None))
            yield pd.DataFrame(rows, columns=["key", "n", "signature"])

    text = text_of(docs)
    return (
        docs.select("doc_id", text.alias("text"))
        .select("doc_id", F.xxhash64("text").alias("text_hash"), run.asNondeterministic()("text").alias("s"))
        .select("doc_id", "text_hash", "s.key", "s.n", "s.signature")
    )


def _prefix(tree, values: int):
    return F.call_function("substring", F.col("signature"), tree * (4 * REACH) + 1, F.lit(4 * values))


def _region_members(classes: DataFrame, forest: Forest) -> tuple[DataFrame, DataFrame]:
    """Regions with two members or more (tree, prefix, members, weight), and their members."""
    spread = (
        classes.where("signature is not null")
        .select("key", "n", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))).alias("tree"), "signature")
        .select("key", "n", "tree", _prefix(F.col("tree"), DEPTH).alias("prefix"))
    )
    regions = written(
        spread.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("weight")).where("members > 1"),
        "regions",
    )
    few = sent_whole(regions, regions.count(), 64)
    return regions, written(spread.select("key", "tree", "prefix").join(few, ["tree", "prefix"]), "members")


def _links(blocks: DataFrame, forest: Forest) -> DataFrame:
    """(a, b): every member that confirmed pairs join, with the smallest member that they join it to.

    `blocks`: block, key, component, tree, n, signature, text; the rows of a block meet in one task.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        held: list[pd.DataFrame] = []
        for frame in frames:
            begin = 0
            cuts = np.flatnonzero(frame["block"].values[1:] != frame["block"].values[:-1]) + 1
            for cut in [*cuts.tolist(), len(frame)]:
                part = frame.iloc[begin:cut]
                if held and held[-1]["block"].iloc[0] != part["block"].iloc[0]:
                    yield from _stars(held, forest, known)
                    held = []
                held.append(part)
                begin = cut
        if held:
            yield from _stars(held, forest, known)

    return (
        blocks.repartition("block").sortWithinPartitions("block").mapInPandas(run, "a binary, b binary")
    )


def _stars(parts: list[pd.DataFrame], forest: Forest, known: dict) -> Iterator[pd.DataFrame]:
    keys = np.array([k for p in parts for k in p["key"]], object)
    if len(keys) < 2:
        return
    first = np.unique(np.array([k for p in parts for k in p["component"]], object), return_inverse=True)[1]
    if first.max() == 0:
        return
    n = np.concatenate([p["n"].values for p in parts])
    texts = [t for p in parts for t in p["text"]]
    signatures = np.stack([np.frombuffer(s, ">u4") for p in parts for s in p["signature"]]).astype(np.uint32)
    tree = int(parts[0]["tree"].iloc[0])
    # one number for each tree's prefix, to see whether an earlier tree has the pair
    heads = signatures.reshape(len(keys), forest.trees, REACH)[:, :tree, :DEPTH].astype(np.uint64)
    heads = (heads * _MIX[:DEPTH]).sum(axis=2, dtype=np.uint64)

    left, right, equal = [], [], []
    for i in range(len(keys) - 1):
        j = np.arange(i + 1, len(keys))
        j = j[(first[j] != first[i]) & (100 * np.minimum(n[j], n[i]) >= forest.percent * np.maximum(n[j], n[i]))]
        if tree and len(j):
            j = j[~(heads[j] == heads[i]).any(axis=1)]
        if len(j):
            same = (signatures[j] == signatures[i]).sum(axis=1)
            j, same = j[same >= forest.least_equal], same[same >= forest.least_equal]
            left.append(np.full(len(j), i, np.int32))
            right.append(j.astype(np.int32))
            equal.append(same.astype(np.int32))
    if not left:
        return
    left, right, equal = map(np.concatenate, (left, right, equal))
    parent = {c: c for c in range(first.max() + 1)}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    sets: dict[int, set] = {}

    def own(i):
        if (found := sets.get(i)) is None:
            found = sets[i] = set(shingles(texts[i], forest.words, known).tolist())
        return found

    joined = False
    for k in np.argsort(-equal, kind="stable").tolist():
        i, j = int(left[k]), int(right[k])
        a, b = root(int(first[i])), root(int(first[j]))
        if a == b:
            continue
        x, y = own(i), own(j)
        common = len(x & y)
        if 100 * common >= forest.percent * (len(x) + len(y) - common):
            parent[max(a, b)] = min(a, b)
            joined = True
    if not joined:
        return
    least: dict[int, bytes] = {}
    roots = [root(int(c)) for c in first]
    for r, key in zip(roots, keys):
        least[r] = min(key, least.get(r, key))
    out = [(key, least[r]) for r, c, key in zip(roots, first, keys) if least[r] != key]
    yield pd.DataFrame(out, columns=["a", "b"])


def _cut(common: np.ndarray, n: np.ndarray, members: int, shingles: int) -> list[tuple[int, int, int]]:
    """(begin, end, depth) of the blocks of a region in sorted order; a block's members share `depth` values.

    common: values that each member shares with the next. Blocks of one member are left out.
    """
    weight = np.concatenate(([0], np.cumsum(n)))
    blocks, open_ = [], [(0, len(n))]
    while open_:
        begin, end = open_.pop()
        inner = common[begin : end - 1]
        if end - begin < 2:
            continue
        if end - begin <= members and weight[end] - weight[begin] <= shingles:
            blocks.append((begin, end, int(inner.min())))
        elif inner.min() < REACH:
            edges = [begin, *(begin + 1 + np.flatnonzero(inner == inner.min())).tolist(), end]
            open_ += list(zip(edges, edges[1:]))
        else:  # equal stretches: as many as fit, one after the other
            while begin < end:
                fit = int(np.searchsorted(weight, weight[begin] + shingles, side="right")) - 1
                stop = min(end, begin + members, max(fit, begin + 1))
                if stop - begin > 1:
                    blocks.append((begin, stop, REACH))
                begin = stop
    return sorted(blocks)


def _ordered_blocks(members: DataFrame, signed: DataFrame, crowded) -> DataFrame:
    """key, tree, block, depth: the members of regions, sorted by their stretches and cut into blocks.

    A small region's rows have the same range key, so they meet in one task; a crowded one may lie in
    several, by its order.
    """
    most = (MOST_MEMBERS, MOST_SHINGLES)
    stretch = F.call_function("substring", F.col("signature"), F.col("tree") * (4 * REACH) + 1, F.lit(4 * REACH))
    rows = members.withColumn("large", crowded).join(signed.select("key", "n", "signature"), "key")
    rows = rows.select("key", "n", "tree", "prefix", "large", stretch.alias("stretch"))
    tasks = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(members.count() / ORDER_ROWS))
    ranges = ["tree", "prefix", *[F.when(F.col("large"), F.col(c)) for c in ("stretch", "key")]]
    order = rows.repartitionByRange(tasks, *ranges).sortWithinPartitions("tree", "stretch", "key")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["key", "n", "stretch"]
        held: dict[str, list] = {c: [] for c in names}
        out: list[tuple] = []
        region = None

        def finish():
            keys = held["key"]
            if len(keys) > 1:
                values = np.frombuffer(b"".join(held["stretch"]), ">u4").reshape(-1, REACH)
                common = np.cumprod(values[1:] == values[:-1], axis=1).sum(axis=1)
                for a, b, depth in _cut(common, np.array(held["n"]), *most):
                    out.extend((k, region[0], keys[a], depth) for k in keys[a:b])
            for own in held.values():
                own.clear()

        for frame in frames:
            regions = list(zip(frame["tree"].tolist(), frame["prefix"].tolist()))
            edges = [i for i in range(len(regions)) if i == 0 or regions[i] != regions[i - 1]]
            columns = [frame[c].tolist() for c in names]
            for begin, end in zip(edges, [*edges[1:], len(regions)]):
                if regions[begin] != region:
                    finish()
                    region = regions[begin]
                for own, values in zip(held.values(), columns):
                    own.extend(values[begin:end])
            if len(out) > FRAME_ROWS:
                yield pd.DataFrame(out, columns=["key", "tree", "head", "depth"])
                out.clear()
        finish()
        yield pd.DataFrame(out, columns=["key", "tree", "head", "depth"])

    found = order.drop("large").mapInPandas(run, "key binary, tree int, head binary, depth int")
    return found.select("key", "tree", F.xxhash64(F.lit("order"), "tree", "head").alias("block"), "depth")


def _dealt(members: DataFrame) -> DataFrame:
    """Members of crowded regions in blocks that cover all pairs of different components.

    The largest component of a region is dealt to blocks of its own, which need no pairs among them;
    the others are dealt to parts, and every part meets every block and every part.
    """
    counts = members.groupBy("tree", "prefix", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    chosen = counts.groupBy("tree", "prefix").agg(
        F.max(F.struct("c", "component", "w")).alias("top"), F.sum("c").alias("all_c"), F.sum("w").alias("all_w"), F.count(F.lit(1)).alias("kinds")
    ).where("kinds > 1")

    def parts(c, w):
        return F.greatest(F.lit(1), F.ceil(2 * c / F.lit(MOST_MEMBERS)), F.ceil(2 * w / F.lit(MOST_SHINGLES))).cast("int")

    chosen = chosen.select(
        "tree", "prefix", F.col("top.component").alias("major"),
        parts(F.col("top.c"), F.col("top.w")).alias("majors"),
        parts(F.col("all_c") - F.col("top.c"), F.col("all_w") - F.col("top.w")).alias("others"),
    )
    rows = members.join(chosen, ["tree", "prefix"]).withColumn("h", F.xxhash64("key"))
    mine = F.pmod("h", F.when(F.col("component") == F.col("major"), F.col("majors")).otherwise(F.col("others"))).cast("int")
    rows = rows.withColumn("part", mine)
    pair = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.cast("int").alias("a"), b.cast("int").alias("b"))
    of_major = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda b: pair("m", F.col("part"), b))
    with_major = F.transform(F.sequence(F.lit(0), F.col("majors") - 1), lambda a: pair("m", a, F.col("part")))
    with_others = F.transform(
        F.sequence(F.lit(0), F.col("others") - 1), lambda b: pair("o", F.least(F.col("part"), b), F.greatest(F.col("part"), b))
    )
    places = F.when(F.col("component") == F.col("major"), of_major).otherwise(F.concat(with_major, with_others))
    return rows.select("key", "tree", "prefix", "component", F.explode(places).alias("p")).select(
        "key", "tree", "component", F.xxhash64("tree", "prefix", "p.kind", "p.a", "p.b").alias("block")
    )


def near_components(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, class (key of the component; null for empty sets)."""
    rows = written(summaries(docs, forest), "summaries")
    classes = written(
        rows.where("key is not null")
        .groupBy("key")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("r"), F.first("n").alias("n"), F.first("signature").alias("signature"))
        .select("key", "r.doc_id", "r.text_hash", "n", "signature"),
        "classes",
    )
    regions, members = _region_members(classes, forest)

    needed = members.select("key").distinct().join(classes, "key")
    needed = written(needed, "needed")
    wanted = needed.select("key", F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash"))
    wanted = sent_whole(wanted, needed.count(), 64)
    own = docs.select("doc_id", text_of(docs).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    texts = own.join(wanted, own["doc_id"].eqNullSafe(F.col("r_id")) & (own["text_hash"] == F.col("r_hash")))
    texts = texts.select("key", "text").dropDuplicates(["key"])
    texts = written(texts.join(needed.select("key", "n", "signature"), "key"), "texts")

    crowded = (F.col("members") > MOST_MEMBERS) | (F.col("weight") > MOST_SHINGLES)
    block = F.xxhash64("tree", "prefix")
    some_crowded = not regions.where(crowded).isEmpty()
    first = _ordered_blocks(members.where(crowded | (F.col("tree") < FIRST_TREES)), texts, crowded).drop("depth")
    links = written(_links(first.withColumn("component", F.col("key")).join(texts, "key"), forest), "links")
    labels = written(components(links), "components")

    labelled = members.join(labels, members["key"] == labels["node"], "left").select(
        members["key"], "tree", "prefix", "members", "weight", F.coalesce("component", members["key"]).alias("component")
    )
    labelled = written(labelled, "labelled")
    rest = labelled.where(~crowded & (F.col("tree") >= FIRST_TREES))
    mixed = rest.groupBy("tree", "prefix").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    second = rest.join(mixed.select("tree", "prefix"), ["tree", "prefix"], "left_semi").select("key", "tree", "component", block.alias("block"))
    if some_crowded:
        second = second.unionByName(_dealt(labelled.where(crowded).join(texts.select("key", "n"), "key")))
    more = written(_links(second.join(texts, "key"), forest), "links")
    links = links.unionByName(more)
    final = components(links.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    for done in (regions, members, labelled, texts, needed):
        discard(done)

    own = classes.select("key", "doc_id").join(final, F.col("key") == F.col("node"), "left")
    own = written(own.select("key", "doc_id", F.coalesce("component", "key").alias("class")), "classes")
    least = own.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    place = own.select("key", "class").join(least, "class")
    empty = rows.where("key is null").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("binary").alias("class")
    )
    return (
        rows.where("key is not null")
        .join(place, "key")
        .select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id", "class")
        .unionByName(empty)
    )


def near_unique(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """One document of each component, the one with the smallest id; documents with empty sets all stay.

    Of repeated rows with that id one stays, the smallest text hash first.
    """
    found = written(near_components(docs, forest), "components")
    least = found.where("class is not null").groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("r")
    )
    stay = least.select(F.col("r.doc_id").alias("__id"), F.col("r.text_hash").alias("__hash"))
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in names.items()],
        text_of(docs).rlike(r"^[\x20\x09-\x0D]*\z").alias("__empty"),
        F.xxhash64(text_of(docs)).alias("__text_hash"),
    )
    kept = (
        own.where("not __empty")
        .join(stay, F.col(names["doc_id"]).eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")))
        .dropDuplicates(["__id", "__hash"])
    )
    return kept.select(*names.values()).unionByName(own.where("__empty").select(*names.values())).toDF(*names)


def report(docs: DataFrame) -> DataFrame:
    found = near_components(docs.select("doc_id", "text"), Forest(words=3, percent=85))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


REPORT_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM t AS a JOIN t AS b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id, doc_id AS reached FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""
