import re
from collections import defaultdict

import pytest
from fixtures import documents, empty, plain, plan_of, rows

from wattline.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Deal the budget by weight, cap, deal the rest again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        rate = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * rate > most * sizes[s]}
        if not over:
            return out | {s: weight[s] * rate for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_taken_words(spark):
    found = mixing.mix(documents(spark)).collect()
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows():
        sizes[source] += size(text)
    wanted = targets(sizes)
    assert len(found) == len(rows())
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for s, t in wanted.items():
        assert abs(taken[s] - t) <= mixing.PIECE_WORDS
    assert sum(taken.values()) == int(1.5 * sum(sizes.values()))


def test_reruns_agree_whatever_the_partitioning(spark):
    a = mixing.report(documents(spark))
    b = mixing.report(documents(spark, rows()[::-1], extra=False).repartition(7))
    assert plain(a) == plain(b)


def test_schedule_is_one_order_without_gaps(spark):
    pieces = [p for p in mixing.schedule(documents(spark), piece_words=50).collect() if p.words]
    pieces = sorted((p for p in pieces if p.position is not None), key=lambda p: p.position)
    at = 0
    for p in pieces:
        assert p.position == at
        at += p.words
    assert all(a.finish <= b.finish for a, b in zip(pieces, pieces[1:]))


def test_other_weights_and_one_capped_source(spark):
    own = [(i, "a " * 10, "en", "tiny" if i == 0 else "big" if i < 50 else "mid", 0) for i in range(80)]
    found = mixing.mix(documents(spark, own), weights=(1, 1, 50), share=1.5).collect()
    by = {r.source: r.target for r in found}
    assert by == targets({"tiny": 10, "big": 490, "mid": 300}, (1, 1, 50))
    assert by["tiny"] == 20


def test_empty_tables(spark):
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed(empty(spark)).count() == 0
    only_blank = documents(spark, [(1, None, "en", "a", 0), (2, "", "en", None, 0)])
    assert sorted((r.doc_id, r.target, r.taken) for r in mixing.mix(only_blank).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_mixed_repeats_documents_as_taken(spark):
    docs = documents(spark)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    words = sum(size(r.text) for r in out.collect())
    longest = max(size(t) for _, t, *_ in rows())
    assert abs(words - 1.5 * sum(size(r[1]) for r in rows())) <= 4 * longest
    assert max(r["count"] for r in out.where("doc_id = 3").groupBy("doc_id", "text").count().collect() or [{"count": 0}]) <= 2


@pytest.mark.parametrize("most", [1, 3, 5])
def test_mixed_makes_all_copies_that_the_mix_takes(spark, most):
    own = [(i, f"a b {i}", "en", "a", 0) for i in range(20)] + [(20, "c d e", "en", None, 0)] * 2 + [(None, "f g", "en", "b", 0)]
    docs = documents(spark, own)
    settings = {"share": float(most), "most": most}
    wanted = defaultdict(int)
    for r in mixing.mix(docs, **settings).collect():
        wanted[r.doc_id] += int(r.taken / r["size"] + 0.5)
    found = defaultdict(int)
    for r in mixing.mixed(docs, **settings).collect():
        found[r.doc_id] += 1
    assert found == wanted and max(wanted.values()) >= most


def test_rows_without_an_id_and_copies_make_no_large_group(spark):
    own = [(None, f"text {i}", "en", "a", 0) for i in range(2000)]
    own += [(7, "the same row", "en", "a", 0)] * 2000 + [(i, f"own {i}", "en", "a", 0) for i in range(2000)]
    sizes = mixing.numbered(mixing.document_sizes(documents(spark, own)), "key", "nth")
    assert sizes.select("key", "nth").distinct().count() == len(own)
    sources = mixing.source_targets(sizes)
    largest = mixing.in_source_order(sizes, sources, 0).groupBy("rank", "bucket").count().agg({"count": "max"}).first()[0]
    assert largest <= 3 * len(own) ** 0.5
    assert mixing.mixed(documents(spark, own), share=1.0, most=1).count() == len(own)


def test_sql_counterpart_on_hostile_rows(spark):
    import duckdb

    own = duckdb.connect()
    own.register("documents", documents(spark, extra=False).toArrow())
    wanted = own.sql(mixing.REPORT_SQL).fetchall()
    assert sorted(wanted, key=repr) == plain(mixing.report(documents(spark)))


def test_no_python_in_the_plan(spark):
    plan = plan_of(mixing.report(documents(spark)))
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))
