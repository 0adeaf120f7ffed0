r"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces, in DataFrame operations only.

Sections are parted by `\n\n`, paragraphs by `\n`; a paragraph is cut into pieces that end with `.`, `!`
or `?` or after 64 other code points, so every character is in one place of the tree. A node's digest is
the SHA-256 of its kind and its children's digests; equal roots mean equal texts. The fingerprint is text:
the root's first 32 digits and a colon, then the sections, parted by `/`: the first 16 digits of the section's
digest, `=`, and its paragraphs, parted by `.`: 16 digits, `-`, and 8 digits of each piece's digest. Where roots
differ, `differing` compares the sections' digests, goes down where these differ, and tells the paragraphs; `likeness` is the share of distinct pieces that two fingerprints have in common: how often a piece
occurs does not count, so a line written twice and the same line a thousand times have likeness 1.

The next document (ascending doc_id, after the last the first) is found in cells: a cell is a block of 1024
ids, or, where a block has more rows than that (ids repeat or are missing), a stretch of one id's rows in
order of their text's hash. One shuffle by cell, sized from the input; each cell also gets a copy of the
first document of the cell after it. The order of blocks is found the same way, blocks of blocks. Rows equal in
id and text meet in no cell: one of them takes part, and the others are followed by a copy of themselves.

Defined cases: a null text is empty, an empty text has a tree without pieces; two empty texts have
likeness 1, an empty and another one 0; null ids come last; documents with one id are in order of their
text's hash, and rows that are wholly equal are each other's next in any order; a table of one document
has itself as the next; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattline.llm.common import numbered, sent_whole, text_of, unused, written
from wattline.session import MOST_PARTITIONS, input_bytes

PIECE = r"[^.!?]{1,64}[.!?]*|[.!?]+"
BLOCK_BITS = 10
CELL_ROWS = 2**BLOCK_BITS  # a block with more rows is cut
BYTES_PER_PARTITION = 64 * 1024 * 1024  # of the input, whose texts and fingerprints are several times as large
ROOT_DIGITS, INNER_DIGITS, PIECE_DIGITS = 32, 16, 8
NO_ID = 2**62  # block of null ids, after all others


def node(kind: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(kind), children).cast("binary"), 256)


def pieces(text: Column) -> Column:
    """Digests of the pieces: section, paragraph, piece."""
    return F.transform(
        F.split(text, "\n\n"),
        lambda section: F.transform(
            F.split(section, "\n"),
            lambda paragraph: F.transform(F.regexp_extract_all(paragraph, F.lit(PIECE), F.lit(0)), lambda x: node("x", x)),
        ),
    )


def inner(kind: str, children: Column, between: str) -> Column:
    """A node above others, which have a digest and a printed form: struct of digest, print.

    The children stand in an array of their own, as they would be made twice otherwise.
    """
    made = F.transform(
        F.array(children),
        lambda own: F.struct(
            node(kind, F.array_join(F.transform(own, lambda c: c["digest"]), "")).alias("digest"),
            F.array_join(F.transform(own, lambda c: c["print"]), between).alias("print"),
        ),
    )
    return F.element_at(made, 1)


def headed(nodes: Column, mark: str) -> Column:
    """Nodes whose printed form starts with their own digest."""
    return F.transform(
        nodes,
        lambda x: F.struct(
            x["digest"].alias("digest"), F.concat(F.substring(x["digest"], 1, INNER_DIGITS), F.lit(mark), x["print"]).alias("print")
        ),
    )


def fingerprint(tree: Column) -> Column:
    def paragraph(p):
        return inner("p", F.transform(p, lambda x: F.struct(x.alias("digest"), F.substring(x, 1, PIECE_DIGITS).alias("print"))), "")

    def section(s):
        return inner("s", headed(F.transform(s, paragraph), "-"), ".")

    top = F.array(inner("r", headed(F.transform(tree, section), "="), "/"))
    return F.element_at(F.transform(top, lambda r: F.concat(F.substring(r["digest"], 1, ROOT_DIGITS), F.lit(":"), r["print"])), 1)


def with_fingerprint(df: DataFrame, text: str, column: str) -> DataFrame:
    own = unused(df, "__tree")
    return df.withColumn(own, pieces(F.col(text))).withColumn(column, fingerprint(F.col(own))).drop(own)


def sections_of(print_: Column) -> Column:
    return F.split(F.substring(print_, ROOT_DIGITS + 2, 2**31 - 1), "/")


def piece_set(print_: Column) -> Column:
    """The distinct pieces: what stands between a paragraph's `-` and the next `.` or `/`."""
    after_heads = F.filter(F.split(print_, "-"), lambda x, i: i > 0)
    pieces_only = F.transform(after_heads, lambda x: F.substring_index(F.substring_index(x, ".", 1), "/", 1))
    return F.array_distinct(F.regexp_extract_all(F.array_join(pieces_only, ""), F.lit(f"[0-9a-f]{{{PIECE_DIGITS}}}"), F.lit(0)))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else twice the common distinct pieces by the distinct pieces of both (0 to 1)."""
    x, y = piece_set(a), piece_set(b)
    both = F.size(x) + F.size(y)
    return F.when(a == b, F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) * 2.0 / both)


def differing(a: Column, b: Column) -> Column:
    """Paragraphs of `b` (section and paragraph from 0) that differ from those at the same place of `a`.

    Digests are compared from the root down: equal roots are not looked into, nor equal sections, and
    paragraphs are compared by their own digests, not by their pieces.
    """
    places = "array<struct<section: int, paragraph: int>>"

    def digest(x):
        return F.coalesce(F.substring(x, 1, INNER_DIGITS), F.lit("none"))

    def paragraphs(x):
        return F.split(F.substring(x, INNER_DIGITS + 2, 2**31 - 1), r"\.")

    def in_section(new, s):
        old = F.try_element_at(sections_of(a), s + 1)
        own = F.transform(
            paragraphs(new),
            lambda p, n: F.when(
                digest(F.try_element_at(paragraphs(old), n + 1)) != digest(p), F.struct(s.alias("section"), n.alias("paragraph"))
            ),
        )
        found = F.filter(own, lambda place: place.isNotNull())
        return F.when(digest(old) == digest(new), F.array().cast(places)).otherwise(found)

    found = F.flatten(F.transform(sections_of(b), in_section))
    return F.when(a == b, F.array().cast(places)).otherwise(found)


def block_of(id_: Column) -> Column:
    return F.coalesce(F.call_function("shiftright", id_, F.lit(BLOCK_BITS)), F.lit(NO_ID))


def successors(keys: DataFrame) -> DataFrame:
    """(key, after) of distinct keys in ascending order; `after` of the last is null."""
    bounds = keys.agg(F.min("key"), F.max("key")).first()
    if bounds[0] is None or bounds[1] - bounds[0] < 2**BLOCK_BITS:  # so many keys at most
        return keys.select("key", F.lead("key").over(W.orderBy("key")).alias("after"))
    order = W.partitionBy("of").orderBy("key")
    rows = keys.withColumn("of", F.call_function("shiftright", "key", F.lit(BLOCK_BITS))).withColumn("after", F.lead("key").over(order))
    rows = written(rows, "order")
    firsts = written(rows.groupBy("of").agg(F.min("key").alias("least")), "order")
    above = successors(firsts.select(F.col("of").alias("key")))
    ahead = above.join(firsts.select(F.col("of").alias("after"), "least"), "after").select(F.col("key").alias("of"), "least")
    ends = rows.where("after is null").drop("after").join(ahead, "of", "left").select("key", F.col("least").alias("after"))
    return rows.where("after is not null").select("key", "after").unionByName(ends)


def celled(own: DataFrame, crowded: DataFrame, bits: int) -> DataFrame:
    """`own` with `cell`, the row's part of its block: 0, or in crowded blocks id and leading bits of the hash.

    Cells of a block are in the order of (id, hash).
    """
    if not bits:
        return own.withColumn("cell", F.lit(0).cast("long"))
    low = F.coalesce(F.col("doc_id").bitwiseAND(F.lit(2**BLOCK_BITS - 1)), F.lit(0))
    lead = F.call_function("shiftright", "hash", F.lit(64 - bits)) + 2 ** (bits - 1)
    cell = F.when(F.col("crowded"), F.call_function("shiftleft", low, F.lit(bits)) + lead).otherwise(0)
    return own.join(crowded, "block", "left").withColumn("cell", cell.cast("long")).drop("crowded")


def cell_ends(blocks: DataFrame, cells: DataFrame) -> DataFrame:
    """(block, cell, first_id, first_hash): every cell with the least row of the cell after it; the last has the first."""
    after = successors(blocks.select(F.col("block").alias("key")))
    least = blocks.agg(F.min("block")).first()[0]
    follows = after.select(F.col("key").alias("block"), F.coalesce("after", F.lit(least)).alias("of"))
    tops = cells.groupBy("block").agg(F.min("cell").alias("cell"))
    follows = follows.join(tops.withColumnRenamed("block", "of"), "of").select("block", "of", F.col("cell").alias("top"))
    # cells of one block: a thousandth of its rows, about
    placed = cells.withColumn("later", F.lead("cell").over(W.partitionBy("block").orderBy("cell"))).join(follows, "block")
    placed = placed.select(
        "block", "cell",
        F.when(F.col("later").isNull(), F.col("of")).otherwise(F.col("block")).alias("to_block"),
        F.coalesce("later", "top").alias("to_cell"),
    )
    targets = cells.select(F.col("block").alias("to_block"), F.col("cell").alias("to_cell"), "first.doc_id", "first.hash")
    return placed.join(targets, ["to_block", "to_cell"]).select(
        "block", "cell", F.col("doc_id").alias("first_id"), F.col("hash").alias("first_hash")
    )


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint, next_text, next_fingerprint."""
    own = docs.select("doc_id", text_of(docs).alias("text")).withColumn("block", block_of(F.col("doc_id")))
    own = own.withColumn("hash", F.xxhash64("text"))
    same = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5(F.col("text").cast("binary"))).cast("binary"))
    own = numbered(own.withColumn("same", same), "same", "nth").drop("same")
    copies = own.where("nth > 0").select("doc_id", "text")
    own = own.where("nth = 0").drop("nth")
    blocks = written(own.groupBy("block").agg(F.count(F.lit(1)).alias("n")), "blocks")
    most = blocks.agg(F.max("n")).first()[0] or 0
    bits = max(0, (most - 1) // CELL_ROWS).bit_length()
    crowded = blocks.where(F.col("n") > CELL_ROWS).select("block", F.lit(True).alias("crowded"))
    own = celled(own, sent_whole(crowded, crowded.count() if bits else 0, 16), bits)
    cells = written(own.groupBy("block", "cell").agg(F.min(F.struct("doc_id", "hash")).alias("first")), "cells")
    wanted = written(cell_ends(blocks, cells), "ends")
    wanted = sent_whole(wanted, wanted.count(), 48)
    # the first document of the cell after, at the end of each cell
    ends = (
        own.select("doc_id", "hash", "text")
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("hash") == F.col("first_hash")))
        .groupBy("block", "cell")
        .agg(F.min("text").alias("text"))
        .select("block", "cell", F.lit(True).alias("end"), F.lit(None).cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    )
    rows = own.select("block", "cell", F.lit(False).alias("end"), "doc_id", "hash", "text").unionByName(ends)
    n = math.ceil(input_bytes(docs) / BYTES_PER_PARTITION)
    more = n > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(*([min(n, MOST_PARTITIONS)] if more else []), "block", "cell")
    order = W.partitionBy("block", "cell").orderBy("end", F.col("doc_id").asc_nulls_last(), "hash", "text")
    found = (
        with_fingerprint(rows, "text", "fingerprint")
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_fingerprint", F.lead("fingerprint").over(order))
        .where("not end")
        .drop("block", "cell", "end", "hash")
    )
    copies = with_fingerprint(copies, "text", "fingerprint")
    return found.unionByName(copies.withColumn("next_text", F.col("text")).withColumn("next_fingerprint", F.col("fingerprint")))


def report(docs: DataFrame) -> DataFrame:
    n = F.col("n_chars")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.call_function("substring", F.col("text"), F.lit(1), (n - half).cast("int")),
        F.call_function("substring", F.col("next_text"), F.lit(1), half),
    )
    rows = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", edited)
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    return with_fingerprint(rows, "edited", "edited_fingerprint").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def _sql_print(text: str) -> tuple[str, str]:
    tree = (
        f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), "
        f"lambda p: list_transform(regexp_extract_all(p, '{PIECE}'), lambda x: sha256('x' || x))))"
    )
    paragraphs = "list_transform(s, lambda p: {'d': sha256('p' || array_to_string(p, '')), 'p': array_to_string(list_transform(p, lambda x: x[:8]), '')})"
    paragraphs = f"list_transform({paragraphs}, lambda p: {{'d': p.d, 'p': p.d[:16] || '-' || p.p}})"
    sections = f"list_transform(list_transform(t, lambda s: {paragraphs}), lambda s: {{'d': sha256('s' || array_to_string(list_transform(s, lambda p: p.d), '')), 'p': array_to_string(list_transform(s, lambda p: p.p), '.')}})"
    top = f"sha256('r' || array_to_string(list_transform({sections}, lambda s: s.d), ''))"
    return tree, f"{top}[:32] || ':' || array_to_string(list_transform({sections}, lambda s: s.d[:16] || '=' || s.p), '/')"


def _sql_near(a: str, b: str) -> str:
    x, y = (f"list_distinct(regexp_extract_all(regexp_replace({c}[34:], '[0-9a-f]{{16}}[=-]', '', 'g'), '[0-9a-f]{{8}}'))" for c in (a, b))
    return (
        f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN len({x}) + len({y}) = 0 THEN 0.0 "
        f"ELSE len(list_intersect({x}, {y})) * 2.0::DOUBLE / (len({x}) + len({y})) END"
    )


_TREE, _PRINT = _sql_print("text")
REPORT_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, length(text) AS n_chars,
             coalesce(lead(text) OVER (ORDER BY doc_id), first(text) OVER (ORDER BY doc_id)) AS next_text FROM d),
e AS (SELECT *, text[:n_chars - n_chars // 2] || substr(next_text, 1, n_chars // 2) AS edited FROM n),
own AS (SELECT doc_id, {_PRINT} AS f FROM (SELECT doc_id, {_TREE} AS t FROM e)),
ed AS (SELECT doc_id, {_PRINT} AS g FROM (SELECT doc_id, {_TREE.replace('string_split(text,', 'string_split(edited,')} AS t FROM e)),
nx AS (SELECT doc_id, f, coalesce(lead(f) OVER (ORDER BY doc_id), first(f) OVER (ORDER BY doc_id)) AS h FROM own)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, f AS fingerprint, g AS edited_fingerprint,
       {_sql_near('f', 'g')} AS near_edited, {_sql_near('f', 'h')} AS near_next
FROM e JOIN nx USING (doc_id) JOIN ed USING (doc_id)
"""
