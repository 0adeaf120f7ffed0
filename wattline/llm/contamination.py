"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark texts, or a join.

Every run of `window` words of an item is a pattern (an item with fewer words is one pattern). A
document is normalised once, scanned once, and the words inside any occurrence are hit. The patterns are
made in Spark; up to `AUTOMATON_BYTES` of them go to the tasks as one automaton. More never pass through
the driver: windows of the documents and patterns meet in a join on 128 bits of their hash. Texts are
compared as UTF-8 bytes, one character per byte, so lower-casing, splitting and matching all work on
byte strings; occurrences are mapped back to code points of the original text.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z: digits, a-z and everything
outside ASCII.

Defined cases: a null or empty text has no words and is never hit; items that repeat, also under
several ids, all count; a null item text has no windows; an item with a null id hits words like any other, but
has no name among the items; an empty benchmark hits nothing; columns of `docs` are all kept, the result is one struct column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import text_of, unused, written

WINDOW = 13
# Bytes of the distinct patterns, and of their item ids, that one automaton holds (about 40 times as much
# memory in a task). A larger benchmark is joined.
AUTOMATON_BYTES = 4 * 1024 * 1024
FRAME_ROWS = 20_000  # windows that a task holds at once

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEPT else 32 for c in range(256))
_ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

RESULT = (
    "n_words long, n_hit long, items array<string>, "
    "spans array<struct<start: long, end: long>>"
)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


def windows(own: list[bytes], window: int) -> Iterator[str]:
    """Patterns of an item; the blanks at both ends keep matches on whole words."""
    last = max(1, len(own) - window + 1) if own else 0
    return (f" {b' '.join(own[i:i + window]).decode('latin-1')} " for i in range(last))


def patterns_of(benchmark: DataFrame, window: int) -> DataFrame:
    """pattern, ids: every distinct pattern with the sorted ids of its items (none if all are null), written once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for item, text in zip(frame["item"], frame["text"]):
                held = []
                for pattern in windows(words(text), window):
                    held.append(pattern)
                    if len(held) == FRAME_ROWS:
                        yield pd.DataFrame({"item": item, "pattern": held})
                        held = []
                if held:
                    yield pd.DataFrame({"item": item, "pattern": held})

    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item"), "text")
    made = items.mapInPandas(run, "item string, pattern string")
    return written(made.groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("ids")), "patterns")


def automaton(patterns: dict[str, list[str]]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for pattern, ids in patterns.items():
        found.add_word(pattern, (pattern.count(" ") - 1, ids))
    found.make_automaton()
    return found


def covered(text: str, starts: np.ndarray, sizes: np.ndarray) -> tuple[int, int, list[tuple[int, int]]]:
    """Words, words inside any of the stretches, and these united, in code points of `text`, end exclusive."""
    places = [m.span() for m in _ORIGINAL_WORD.finditer(text)]
    change = np.zeros(len(places) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + sizes, -1)
    hit = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return len(places), int(hit.sum()), [(places[a][0], places[b - 1][1]) for a, b in zip(edges[::2], edges[1::2])]


def scan(found, text: str) -> tuple[int, int, list[str], list[tuple[int, int]]]:
    """Words, hit words, items and the hit stretches of `text` in code points, end exclusive."""
    own = words(text)
    if not own:
        return 0, 0, [], []
    flat = f" {b' '.join(own).decode('latin-1')} "
    matches = list(found.iter(flat)) if found is not None else []
    if not matches:
        return len(own), 0, [], []
    blanks = np.flatnonzero(np.frombuffer(flat.encode("latin-1"), np.uint8) == 32)
    ends = np.searchsorted(blanks, np.fromiter((m[0] for m in matches), np.int64, len(matches)))
    sizes = np.fromiter((m[1][0] for m in matches), np.int64, len(matches))
    count, hit, spans = covered(text, ends - sizes, sizes)
    items = sorted({i for m in matches for i in m[1][1]})
    return count, hit, items, spans


def scanner(docs: DataFrame, patterns: dict[str, list[str]] | None) -> Column:
    sent = docs.sparkSession.sparkContext.broadcast(patterns or {})

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        found = automaton(sent.value) if sent.value else None
        for texts in batches:
            yield pd.DataFrame(
                [(n, h, i, [{"start": a, "end": b} for a, b in s]) for n, h, i, s in (scan(found, t or "") for t in texts)],
                columns=["n_words", "n_hit", "items", "spans"],
            )

    return run.asNondeterministic()(docs["text"])


def with_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    column: str = "contamination",
    window: int = WINDOW,
    block_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """`docs` with a struct `column`: n_words, n_hit, items (ids as sorted strings), spans."""
    patterns = patterns_of(benchmark, window)
    id_bytes = F.aggregate("ids", F.lit(0), lambda n, x: n + F.octet_length(x))
    pattern_bytes, ids_bytes = patterns.agg(F.sum(F.length("pattern")), F.sum(id_bytes)).first()
    if max(pattern_bytes or 0, ids_bytes or 0) <= block_bytes:
        return docs.withColumn(column, scanner(docs, {r.pattern: r.ids for r in patterns.collect()}))
    return joined(docs, patterns, column)


def joined(docs: DataFrame, patterns: DataFrame, column: str) -> DataFrame:
    """`docs` with the findings of any number of patterns, which meet the documents' windows in a join.

    A finding depends on the text only, so it is joined back by the text's digest. The driver gets the
    patterns' word counts alone.
    """

    @F.pandas_udf("binary")
    def digest(batch: pd.Series) -> pd.Series:
        return batch.map(lambda p: xxhash.xxh128_digest(p.encode("latin-1")))

    n_words = F.length("pattern") - F.length(F.replace(F.col("pattern"), F.lit(" "), F.lit(""))) - 1
    known = patterns.select(digest("pattern").alias("g"), n_words.alias("n"), "ids")
    known = written(known, "patterns")
    sizes = sorted(r.n for r in known.select("n").distinct().collect())  # `window` numbers at most

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, text in zip(frame["key"], frame["text"]):
                own = words(text)
                held = []
                for n in sizes:
                    for at in range(len(own) - n + 1):
                        held.append((key, at, n, xxhash.xxh128_digest(b" " + b" ".join(own[at : at + n]) + b" ")))
                        if len(held) == FRAME_ROWS:
                            yield pd.DataFrame(held, columns=["key", "at", "n", "g"])
                            held = []
                if held:
                    yield pd.DataFrame(held, columns=["key", "at", "n", "g"])

    own = docs.select(F.md5(text_of(docs).cast("binary")).alias("key"), text_of(docs).alias("text"))
    made = own.mapInPandas(run, "key string, at long, n int, g binary")
    hits = written(made.join(known.select("g"), "g", "left_semi").distinct(), "hits")
    places = hits.groupBy("key").agg(F.collect_list(F.struct("at", "n")).alias("p"))
    ids = hits.select("key", "g").distinct().join(known.select("g", F.explode("ids").alias("item")), "g")
    ids = ids.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("__items"))
    own_key, key, at, n, items = (unused(docs, f"__{c}") for c in ("own_key", "key", "at", "n", "items"))
    found = places.join(ids, "key", "left").select(
        F.col("key").alias(key), F.col("p.at").alias(at), F.col("p.n").alias(n), F.coalesce("__items", F.array()).alias(items)
    )
    found = written(found, "found")

    @F.pandas_udf(RESULT)
    def finish(texts: pd.Series, at: pd.Series, n: pd.Series, items: pd.Series) -> pd.DataFrame:
        rows = []
        for text, a, k, own in zip(texts.fillna(""), at, n, items):
            if a is None:
                rows.append((len(words(text)), 0, [], []))
                continue
            count, hit, spans = covered(text, np.asarray(a, np.int64), np.asarray(k, np.int64))
            rows.append((count, hit, list(own), [{"start": x, "end": y} for x, y in spans]))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    out = docs.withColumn(own_key, F.md5(text_of(docs).cast("binary"))).join(found, F.col(own_key) == F.col(key), "left")
    return out.withColumn(column, finish.asNondeterministic()("text", at, n, items)).drop(own_key, key, at, n, items)


def contaminated(found: Column, percent: int = 5) -> Column:
    """At least one word hit, and `percent` of a hundred words or more."""
    return (found["n_hit"] > 0) & (found["n_hit"] * 100 >= found["n_words"] * percent)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    own = unused(docs, "__contamination")
    return with_contamination(docs, benchmark, own).where(~contaminated(F.col(own))).drop(own)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: counts, items as a digest, the decision, and the hit stretches."""
    own = F.col("c")
    return with_contamination(docs.select("doc_id", "text"), benchmark, "c").select(
        "doc_id",
        own["n_words"].alias("n_words"),
        own["n_hit"].alias("n_hit"),
        F.size(own["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", own["items"]).cast("binary"), 256).alias("items_sha256"),
        contaminated(own).alias("contaminated"),
    )


REPORT_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
p AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, list_slice(w, i, i + least(13, len(w)) - 1) AS g
  FROM b, LATERAL (SELECT unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i) WHERE len(w) > 0),
g AS (
  SELECT doc_id, s.n, i, list_slice(w, i, i + s.n - 1) AS g
  FROM d, (SELECT DISTINCT n FROM p) AS s, LATERAL (SELECT unnest(range(1, len(w) - s.n + 2)) AS i)),
m AS (SELECT g.doc_id, g.i, g.n, p.item_id FROM g JOIN p ON g.n = p.n AND g.g = p.g),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM m, LATERAL (SELECT unnest(range(i, i + n)) AS k) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM m GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
