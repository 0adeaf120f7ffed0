import hashlib
import re

import pytest
from fixtures import documents, empty, plan_of, rows
from pyspark.sql import functions as F

from wattline.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(text):
    return [[[sha("x" + x) for x in re.findall(r"[^.!?]{1,64}[.!?]*|[.!?]+", p)] for p in s.split("\n")] for s in text.split("\n\n")]


def fingerprint(text):
    digests, prints = [], []
    for section in tree(text):
        own = [sha("p" + "".join(p)) for p in section]
        digests.append(sha("s" + "".join(own)))
        leaves = [d[:16] + "-" + "".join(x[:8] for x in p) for d, p in zip(own, section)]
        prints.append(digests[-1][:16] + "=" + ".".join(leaves))
    return sha("r" + "".join(digests))[:32] + ":" + "/".join(prints)


def likeness(a, b):
    if a == b:
        return 1.0
    leaves = (re.sub("[0-9a-f]{16}[=-]", "", p[33:]) for p in (a, b))
    x, y = (set(re.findall("[0-9a-f]{8}", p)) for p in leaves)
    return 2.0 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def single():
    """One row for each id, ids far apart included."""
    own = {r[0]: r for r in rows() if r[0] is not None}
    own |= {k: (k, f"text {k}\n\nsecond section. third!\nlast", "", "", 0) for k in (1023, 1024, 1025, 5000, 10**12)}
    return sorted(own.values())


def test_report_equals_brute_force(spark):
    table = single()
    found = {r.doc_id: r for r in merkle.report(documents(spark, table)).collect()}
    assert len(found) == len(table)
    for (doc, text, *_), (_, after, *_) in zip(table, table[1:] + table[:1]):
        text, after, r = text or "", after or "", found[doc]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint(text), fingerprint(edited))
        assert r.edited_sha256 == sha(edited)
        assert r.near_edited == likeness(fingerprint(text), fingerprint(edited))
        assert r.near_next == likeness(fingerprint(text), fingerprint(after))


def test_repeated_and_missing_ids(spark):
    found = merkle.report(documents(spark)).collect()
    assert len(found) == len(rows())
    assert {r.fingerprint for r in found} == {fingerprint(r[1] or "") for r in rows()}
    lonely = merkle.report(documents(spark, [(3, "only one. here", "", "", 0)])).first()
    assert lonely.near_next == 1.0


def following(table):
    """Every row with the text after it, by id (null last), the text's hash among rows of an id, first after last."""
    order = sorted(table, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1]))
    return sorted(((r[0], r[1], n[1]) for r, n in zip(order, order[1:] + order[:1])), key=repr)


@pytest.mark.parametrize("crowded", ["none", "null ids", "one id", "copies"])
def test_crowded_ids_are_cut_and_follow_one_another(spark, monkeypatch, crowded):
    monkeypatch.setattr(merkle, "CELL_ROWS", 8)
    table = [(i * 300, f"text {i}") for i in range(40)]
    table += {"none": [], "null ids": [(None, f"n {i}") for i in range(100)], "one id": [(901, f"o {i}") for i in range(100)]}.get(
        crowded, [(901, "a copy")] * 50 + [(None, None)] * 50 + [(901, "another")]
    )
    docs = documents(spark, [(i, t, "", "", 0) for i, t in table])
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    found = merkle.with_next(docs).collect()
    assert sorted(((r.doc_id, r.text, r.next_text) for r in found), key=repr) == following([tuple(r) for r in hashed])
    assert all(r.next_fingerprint == fingerprint(r.next_text) for r in found)


def test_the_cells_of_a_crowded_block_are_small(spark):
    own = documents(spark, [(None, f"n {i}", "", "", 0) for i in range(5000)]).select("doc_id", "text")
    own = own.withColumn("block", merkle.block_of(F.col("doc_id"))).withColumn("hash", F.xxhash64("text"))
    crowded = own.select("block", F.lit(True).alias("crowded")).distinct()
    sizes = merkle.celled(own, crowded, 3).groupBy("cell").count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1000


def test_successors_over_several_levels(spark):
    keys = sorted({0, 1, 5, 1023, 1024, 2**20, 2**20 + 1, 2**40, 2**62, -1, -(2**62), *range(3000, 9000, 7)})
    found = merkle.successors(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert {r.key: r.after for r in found.collect()} == dict(zip(keys, keys[1:] + [None]))


def test_edits_are_located(spark):
    old = "one. two.\nthree\n\nfour\nfive! six\n\nseven"
    new = "one. two.\nthree\n\nfour\nfive! 6\n\nseven\neight"
    df = spark.createDataFrame([(old, new), (old, old), (old, ""), ("", old)], "a string, b string")
    for side in "ab":
        df = merkle.with_fingerprint(df, side, f"f{side}")
    found = df.select("a", "b", merkle.differing(F.col("fa"), F.col("fb")).alias("d")).collect()
    places = [[(p.section, p.paragraph) for p in r.d] for r in found]
    assert places[:3] == [[(1, 1), (2, 1)], [], [(0, 0)]]
    assert places[3] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]


def test_plan(spark):
    plan = plan_of(merkle.report(documents(spark)))
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


def test_empty(spark):
    assert merkle.report(empty(spark)).count() == 0
