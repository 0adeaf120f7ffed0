"""Each stage of the pipeline against a plain version, on what its predecessor kept."""

from collections import Counter

import corpus_pipeline
import pytest
import test_contamination
import test_neardup
from fixtures import documents, plain, rows, words
from test_classifiers import LABELS, corpus
from test_mixing import size


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    docs, labels = corpus(160)
    good = [(r[0] + 2000 if r[0] is not None else None, *r[1:]) for r in rows() if r[0] is None or 0 <= r[0] < 100]
    good += [(3000 + k, f"River light early. {docs[2 * k + 1][1]} stone", "en", "b", 0) for k in range(20)]
    copies = [(4000 + k, docs[1][1] + " paper" * (k % 2), "en", "c", 0) for k in range(8)]
    passage = " ".join(words(__import__("random").Random(1), 30, 50))
    leaked = [(5000 + k, f"River light {passage} early stone.", "en", "a", 0) for k in range(3)]
    documents(spark, docs + good + copies + leaked).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        after = docs.collect()
        assert after and set(columns) <= set(docs.columns)
        if number < 4:
            assert docs.columns == columns
            was = Counter(before)
            assert all(n <= was[r] * (2 if number == 3 else 1) for r, n in Counter(after).items())
        table = [(r.doc_id, r.text) for r in before]
        if number == 0:
            junk = {i for i in range(160) if i % 2 == 0}
            assert len(junk & {r.doc_id for r in after}) < 4
            assert len({i for i in range(160) if i % 2} - {r.doc_id for r in after}) < 4
        elif number == 1:
            wanted = test_neardup.brute_force(table, 5, 80)
            groups = {c for _, n, c in wanted if n and c is not None}
            assert {r.doc_id for r in after if test_neardup.shingle_set(r.text, 5) and r.doc_id is not None} == groups
        elif number == 2:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            clean = [r[0] for r in test_contamination.brute_force(table, items) if not r[5]]
            assert sorted(map(repr, (r.doc_id for r in after))) == sorted(map(repr, clean)) and len(after) < len(before)
        elif number == 3:
            target = 1.5 * sum(size(t) for _, t in table)
            assert abs(sum(size(r.text) for r in after) - target) < 0.2 * target
        else:
            assert len(after) == len(before) and {r.shard for r in after} == {""}
        before = after


def test_run_is_the_chain_of_the_stages(spark, sf_dir):
    first, second = corpus_pipeline.run(spark, sf_dir), corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "text", "shard", "n_bytes"} <= set(first.columns)
    assert plain(first.select("doc_id", "text", "shard")) == plain(second.select("doc_id", "text", "shard"))
